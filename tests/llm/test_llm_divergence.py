"""The source audit, against a plain count and against SQL; its trees against sums over all terms."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import compare
import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm import oracle, queries, source_divergence

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, term string, n long, part string"


def plain(rows):
    counts, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(source_divergence.TERM, text or "")]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
        langs[lang].update(terms)
    out = []
    for lang, seen in docs.items():
        kept = [t for t, n in seen.items() if n >= 30]
        of = {s: c for (x, s), c in counts.items() if x == lang}

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in of.items()}
        q = shares(langs[lang])
        for s, c in of.items():
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in of if o != s]
            terms = [(q[t] - p[s][t], t) for t in kept if c[t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:50])):
                out += [(lang, s, part, item, -value, rank) for rank, (value, item) in enumerate(items, 1)]
    return sorted(out)


def found(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


def test_audit_as_sql(spark):
    got = queries.QUERIES["op12_source_divergence"](spark, SF)
    assert compare.difference(got, compare.connect(SF), oracle.SQL["op12_source_divergence"]) is None


@pytest.mark.parametrize("block, part, held", [(256, 64, 200_000), (16, 3, 50)])
def test_audit_against_counts(spark, monkeypatch, block, part, held):
    """Also with small blocks and parts, so that sources of different parts meet in every block."""
    for name, value in (("BLOCK", block), ("PART", part), ("HELD_KEYS", held)):
        monkeypatch.setattr(source_divergence, name, value)
    rng = random.Random(1)
    words = [f"{rng.choice(('Wort', 'ÉTÉ', 'été', '中文', 'a', 'Z'))}{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(200)]
    rows = []
    for i in range(700):
        lang, source = rng.choice(("en", "en", "de", None, "")), rng.choice(("hot", "hot", "s1", "s2", "é", None, "", "z", "A"))
        text = " ".join(rng.choices(words, weights=range(200, 0, -1), k=rng.randrange(40)))
        rows.append((i if i % 9 else None, text if i % 13 else None, lang, source, "t", 1, "p"))
    rows += [(1, "one1two3three", "xx", s, "t", 1, "p") for s in ("a", "b", "c")] + [(2, "", "alone", "only", "", 0, "")]
    rows += rows[:50] + [(3, "word Word3wORD " * 100_000, "en", "long", "", 0, "")]
    rng.shuffle(rows)
    assert found(source_divergence.audit(spark.createDataFrame(rows, DOC).repartition(5))) == plain(rows)


def test_no_document(spark):
    assert source_divergence.audit(spark.createDataFrame([], DOC)).collect() == []


@pytest.mark.parametrize("width", [1, 2, 3, 64, 100])
def test_trees_against_sums(width):
    rng = np.random.default_rng(width)
    counts = rng.poisson(0.7, (6, width))
    counts[1] = counts[0]
    forest = source_divergence.Forest(counts)
    assert forest.roots[0] == forest.roots[1]
    p = [source_divergence.probabilities(forest.leaves, int(c.sum()), width) for c in counts]
    full = [source_divergence.probabilities(c, int(c.sum()), width) for c in counts]
    for i in range(6):
        for j in range(6):
            assert forest.distance(i, j, p[i], p[j]) == int(np.abs(full[i] - full[j]).sum())
            gain = sorted(((int(full[i][t] - full[j][t]), -t) for t in range(width) if counts[i][t] and full[i][t] > full[j][t]), reverse=True)
            got = forest.largest(i, j, p[i], p[j], 5)
            assert sorted(got, key=lambda x: (-x[0], x[1]))[:5] == [(g, -t) for g, t in gain[:5]]
            assert len(got) == sum(g >= gain[min(4, len(gain) - 1)][0] for g, _ in gain)


def test_equal_pairs_are_priced_once():
    """Two sources with a few distinct counts over many terms meet in a few pairs a level."""
    counts = np.zeros((2, 4096), dtype=np.int64)
    counts[0, :10], counts[1, 5:20] = 1, 2
    (left, _), levels = source_divergence.Forest(counts).meet(*source_divergence.Forest(counts).roots)
    assert len(left) == 4 and sum(len(first) for first, _ in levels) < 60


def test_large_counts_are_exact():
    c = 3 * 10**13
    assert source_divergence.probabilities(np.array([c]), 2 * c, 7)[0] == 1 + 10**9 * (c + 5) // (2 * c + 35)


def test_terms_are_cut_as_bytes():
    odd = "".join(map(chr, range(1, 128))) + " É\x85é\xa0ß\u2003x ſK 😀Z_a-b"
    want = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(source_divergence.TERM, odd)]
    batch = pa.record_batch([pa.array(c, pa.string()) for c in ([odd, "", "b A a"], ["x"] * 3, ["y"] * 3)], names=["text", "lang", "source"])
    rows = pa.Table.from_batches(source_divergence._counted(iter([batch]))).to_pylist()
    want, docs = Counter(want + ["b", "a", "a"]), Counter([*set(want), "a", "b"])
    assert {(r["term"], r["n"], r["docs"]) for r in rows} == {("", 0, 0), *((t, want[t], docs[t]) for t in want)}
