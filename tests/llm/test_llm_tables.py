"""Packing, SentencePiece, similarity join, top-k and language model: against brute force."""

from __future__ import annotations

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkmart.llm import common, graph, jaccard, neural_lm, packing, sentencepiece_np, topk

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", ".", ",", "'s", "don't", "!!", "|", "\x00", "7", "½", "<|endoftext|>", "中文", "😀", "(,", "\xa0", " ,", "▁", "er", "the", "http", "://"]


def odd_texts(n, seed=1, longest=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(longest))) for _ in range(n)]


# Packing -----------------------------------------------------------------


def test_ids_are_the_tokenizers_own():
    texts = odd_texts(4000) + ["x" * 3000, "word " * 3000, "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>'s <|endoftext|>", "<|endof text|>"]
    tokenizer = Tokenizer.from_file(BPE)
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    encoder = packing.Encoder(BPE)
    assert encoder.joins
    got = list(itertools.chain.from_iterable(encoder.encode(texts[i : i + 500]) for i in range(0, len(texts), 500)))
    assert got == want


def test_words_go_to_the_model_alone():
    """Letters are encoded without the pattern that looks for words, to the same ids."""
    encoder = packing.Encoder(BPE)
    want = encoder.tokenizer
    words = ["the", " the", " Über", "éÿÀ", " a", " ſ", "ª", " 12", "don't", " x,", "'s"]
    ids = {x: np.array(want.encode(x, add_special_tokens=False).ids, dtype=np.uint32).tobytes() for x in words}
    assert encoder.fresh(words) == ids
    encoder.tokenizer = type("OnlyModel", (), {"model": want.model, "encode_batch_fast": staticmethod(lambda parts, **_: [] if not parts else 1 / 0)})
    assert encoder.fresh(words[:5]) == {x: ids[x] for x in words[:5]}


def test_largest_counts(spark):
    def kept(counts, limit):
        df = spark.createDataFrame([(f"w{i:03}", n) for i, n in enumerate(counts)], "word string, n long")
        return sorted((r["n"], r["word"]) for r in common.largest_counts(df, limit, "word").collect())

    assert kept([5, 3, 3, 1], 3) == [(3, "w001"), (3, "w002"), (5, "w000")]
    assert kept([5, 3, 3, 1], 2) == [(5, "w000")]  # of equal counts all or none
    assert kept([], 4) == []
    # More rows than the limit with counts above it
    assert kept(range(100, 112), 8) == [(n, f"w{n - 100:03}") for n in range(104, 112)]
    assert kept([9] * 12, 8) == [(9, f"w{i:03}") for i in range(8)]
    assert kept([2**40 + i for i in range(12)], 8) == [(2**40 + i, f"w{i:03}") for i in range(4, 12)]
    assert kept([2**40, 2**41, 2**41 + 1, 50], 3) == [(2**40, "w000"), (2**41, "w001"), (2**41 + 1, "w002")]


def test_packing(spark):
    texts = [None, "", "a", "b c " * 3000] + odd_texts(300, 2) + ["copy of it"] * 700
    rows = [(i if i % 50 else None, t, 9) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOC + ", length int")
    capacity = 64
    got = packing.pack_documents(docs, BPE, capacity).collect()
    by_doc = collections.defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        assert 0 < r["length"] <= capacity and len(r["ids"]) == 4 * r["length"]
    tokenizer = Tokenizer.from_file(BPE)
    for i, t, _ in rows:
        if i is not None:
            pieces = sorted(by_doc[i], key=lambda r: r["piece"])
            ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
            assert b"".join(r["ids"] for r in pieces) == np.array(ids, dtype="<u4").tobytes()
            assert [r["start"] for r in pieces] == [sum(x["length"] for x in pieces[:k]) for k in range(len(pieces))]
            assert all(r["length"] == capacity for r in pieces[1:])
    places = collections.defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for some in places.values():
        ends = 0
        for offset, length in sorted(some):
            assert offset == ends
            ends += length
        assert ends <= capacity
    assert len(places) <= 1 + math.ceil(sum(r["length"] for r in got) / capacity)
    assert packing.pack_digests(docs.limit(0), BPE).count() == 0


def test_fullest_combination():
    rng = random.Random(5)
    for _ in range(200):
        counts = {rng.randrange(1, 20): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        room = rng.randrange(1, 60)
        lengths = sorted(counts, reverse=True)
        chosen = packing.fullest(lengths, counts, room)
        assert all(k <= counts[x] for x, k in chosen.items())
        sums = {sum(x * k for x, k in zip(lengths, ks)) for ks in itertools.product(*(range(counts[x] + 1) for x in lengths))}
        assert sum(x * k for x, k in chosen.items()) == max(s for s in sums if s <= room)


def test_plan_places_everything():
    rng = random.Random(6)
    uniform = {rng.randrange(1, 2049): rng.randrange(1, 300) for _ in range(400)}  # half of them need a bin of their own
    short = collections.Counter(min(2048, 1 + int(rng.expovariate(1 / 500))) for _ in range(20_000))
    check_plan(uniform, 1.025)
    check_plan(dict(short), 1.002)


def check_plan(histogram, above_least):
    bins = packing.plan(histogram)
    used = collections.Counter()
    for chosen, times in bins:
        assert sum(x * k for x, k in chosen.items()) <= 2048
        for x, k in chosen.items():
            used[x] += k * times
    assert used == histogram
    # No packing needs fewer than the tokens fill, or than there are pieces of more than half.
    least = max(sum(x * n for x, n in histogram.items()) / 2048, sum(n for x, n in histogram.items() if x > 1024))
    assert sum(t for _, t in bins) <= above_least * least + 1


# SentencePiece -----------------------------------------------------------


def test_byte_pair_model_is_exact(spark):
    texts = odd_texts(1500) + ["".join(random.Random(i).choice("abcdehinorst") for _ in range(i % 70)) for i in range(800)] + ["", " ", "x" * 2000]
    texts += [r["text"] for r in common.table(spark, SF, "documents").select("text").limit(40).collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    codec = sentencepiece_np.Codec(open(PIECES, "rb").read())
    got = codec.encode(texts)
    assert [np.frombuffer(x, dtype=np.uint32).tolist() for x in got] == library.encode(texts)
    assert [codec.decode(x) for x in got] == [library.decode(np.frombuffer(x, dtype=np.uint32).tolist()) for x in got]
    assert codec.encode(texts) == got  # again, from what is remembered


def message(*fields):
    """A protocol-buffer message of (number, value) with bytes, float or int values."""
    out = b""
    for number, value in fields:
        if isinstance(value, bytes):
            out += bytes([number << 3 | 2, *([len(value)] if len(value) < 128 else [len(value) & 127 | 128, len(value) >> 7])]) + value
        elif isinstance(value, float):
            out += bytes([number << 3 | 5]) + np.float32(value).tobytes()
        else:
            out += bytes([number << 3, value])
    return out


def test_unigram_model_is_exact():
    rng = random.Random(8)
    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1)] + [(c, -rng.uniform(3, 5), 1) for c in "abcd"]
    pieces += [(p, -rng.uniform(2, 9), 1) for p in sorted({"".join(rng.choice("abcd▁"[: 4 + (k == 0)]) for k in range(rng.randrange(2, 6))) for _ in range(60)})]
    pieces = [p for i, p in enumerate(pieces) if p[0] not in {q[0] for q in pieces[:i]}]
    data = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in pieces)
    data += message((2, message((3, 1)))) + message((3, message((3, 1), (4, 0))))
    codec = sentencepiece_np.Codec(data)
    score = {p: s for p, s, k in pieces if k == 1}
    for _ in range(300):
        word = "▁" + "".join(rng.choice("abcdx") for _ in range(rng.randrange(1, 12)))
        best = [(0.0, [])]
        for j in range(1, len(word) + 1):
            options = []
            for i in range(max(0, j - codec.model.longest), j):
                s = score.get(word[i:j], codec.model.floor if j - i == 1 else None)
                if s is not None:
                    options.append((best[i][0] + s, best[i][1] + [word[i:j]]))
            best.append(max(options, key=lambda o: o[0]))
        want = [codec.model.number.get(p, 0) for p in best[-1][1]]
        want = [x for k, x in enumerate(want) if x or k == 0 or want[k - 1]]
        assert np.frombuffer(codec.encode([word[1:]])[0], dtype=np.uint32).tolist() == want


def test_sentencepiece_table(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "▁ a", 1), (2, "the  end\n", 1)], DOC + ", ids int")
    got = sentencepiece_np.digests(docs, PIECES).collect()
    assert len(got) == 4 and all(r["round_trip"] for r in got)
    assert sentencepiece_np.digests(docs.limit(0), PIECES).count() == 0


# Similarity join ---------------------------------------------------------


def brute_components(rows):
    low = {c: c + 32 for c in range(65, 91)}
    sets = []
    for _, t in rows:
        w = re.findall(common.WORD, (t or "").translate(low))
        sets.append(frozenset(tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return collections.Counter((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows))


def test_jaccard_against_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = [(900, None), (901, ""), (901, " \n"), (902, "A b"), (903, "a B"), (904, "a b c"), (None, "only null id here"), (None, "x"), (905, "X")]
    for family in range(6):
        text = [word() for _ in range(rng.choice([30, 80, 200]))]
        for k in range(25):
            mine = list(text)
            for _ in range(rng.randrange(0, 1 + len(text) // 25)):
                mine[rng.randrange(len(mine))] = word()
            if rng.random() < 0.2:
                mine = mine[: int(len(mine) * rng.uniform(0.8, 1))]
            rows.append((family * 100 + k, " ".join(mine).upper() if k % 7 == 0 else " ".join(mine)))
    rows += [(1000 + k, " ".join(passage + [word() for _ in range(40)])) for k in range(60)]  # a shared passage
    rows += [(2000 + k, "same text for all of us here") for k in range(40)] + rows[20:25]
    rows += [(3000, "word " * 50_000)]
    rng.shuffle(rows)
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], DOC + ", n int, component_id int")
    got = jaccard.link_components(table).collect()
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows)


def test_group_bound_follows_the_common_order(spark):
    """Of the group {x, y}, x has a prefix that ends in a frequent token and y a shorter one; z links with y only."""
    a, f = np.arange(1, 24, dtype=np.uint64), np.arange(100, 185, dtype=np.uint64)
    sets = {1: [*a[:15], *f], 2: [*a, *f[:77]], 3: [*a[8:], *f[:77]]}
    tokens = {k: jaccard.ordered(np.array(v, dtype=np.uint64), f) for k, v in sets.items()}
    links = {(p, q) for p in sets for q in sets if p < q and 100 * len({*sets[p]} & {*sets[q]}) >= jaccard.PERCENT * len({*sets[p]} | {*sets[q]})}
    assert links == {(1, 2), (2, 3)}
    firsts = {k: t[: jaccard.prefix_length(len(t))] for k, t in tokens.items()}
    assert [bool(p[-1] >= jaccard.FREQUENT) for p in firsts.values()] == [True, False, False]
    rows = [(k, len(tokens[k]), bytearray(p.tobytes()), int(p[-1:].view(np.int64)[0])) for k, p in firsts.items()]
    classes = spark.createDataFrame(rows, "id long, n long, prefix binary, last long")
    groups = spark.createDataFrame([(1, 1), (2, 1)], "id long, component long")
    units = jaccard.units_of(classes, groups, groups)
    found = jaccard.qualifying(jaccard.shared_rows(jaccard.prefix_rows(classes)), classes, units)
    assert {tuple(r) for r in found.collect()} == {(3, 1)}


def variants(n, seed=4):
    """One text with 2 to 13 of 120 words changed: many near misses, some links."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    text = [word() for _ in range(120)]
    out = []
    for _ in range(n):
        mine = list(text)
        for k in rng.sample(range(120), rng.randrange(2, 14)):
            mine[k] = word()
        out.append(" ".join(mine))
    return out


@pytest.mark.parametrize("compared", [2**24, 1500, 0])
def test_jaccard_near_misses(spark, monkeypatch, compared):
    """Near misses of one text among others, with parts so small that a cluster takes many; also with finer clusters."""
    monkeypatch.setattr(jaccard, "MAX_COMPARED", compared)
    monkeypatch.setattr(jaccard, "PART_MEMBERS", 7)
    monkeypatch.setattr(jaccard, "PART_QUERIES", 5)
    rows = [(k, t) for seed in (1, 2, 3) for k, t in enumerate(variants(60, seed), 100 * seed)]
    got = jaccard.link_components(spark.createDataFrame(rows, DOC)).collect()
    want = brute_components(rows)
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert len({c for _, _, c in want}) > 20


def test_jaccard_join_follows_the_documents(spark):
    """Near misses of one text do not meet in the matrix join, however many they are; in it they would by their square."""
    def joined(n):
        texts = [t for seed in range(4) for t in variants(n, seed)]
        docs = spark.createDataFrame(list(enumerate(texts)), DOC)
        found = jaccard.signatures(docs, np.array([], dtype=np.uint64))
        classes = common.written(found.select(F.col("key").alias("id"), "n", "prefix", "last"), "classes")
        rows = jaccard.shared_rows(jaccard.prefix_rows(classes))
        wanted = jaccard.pivots(rows, jaccard.centrality(rows, classes))
        none = spark.createDataFrame([], "a long, b long")
        alone = spark.createDataFrame([], "id long, component long")
        clusters = jaccard.clusters_of(classes, rows, wanted, none, alone)
        return [jaccard.meetings(rows, classes, jaccard.units_of(classes, alone, c)).count() for c in (alone, clusters)]

    (before, small), (before_4, large) = joined(20), joined(80)
    assert before_4 > 12 * before and large <= 4 * max(small, 100), (before, before_4, small, large)


def test_jaccard_empty_and_alone(spark):
    empty = spark.createDataFrame([], DOC)
    assert jaccard.link_components(empty).count() == 0
    alone = spark.createDataFrame([(1, "one two three four five"), (2, None)], DOC)
    assert {tuple(r) for r in jaccard.link_components(alone).collect()} == {(1, 2, 1), (2, 0, 2)}


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 160)] + [(rng.randrange(50), rng.randrange(50)) for _ in range(30)] + [(500, k) for k in range(501, 700)] + [(7, 7)]
    got = {r["id"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


# Top-k -------------------------------------------------------------------


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = [(int(i), [float(x) for x in rng.normal(size=6)]) for i in range(700)]
    vectors += [(700 + i, list(vectors[i][1])) for i in range(0, 100)]  # ties
    vectors += [(900, None), (950, [None, 1.0]), (1000, [float("nan")] * 6), (1050, [float("inf")] * 6), (1100, []), (1150, [2.0, -1.0]), (None, [1.0] * 6)]
    vectors += vectors[:3]  # repeated rows
    table = spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id long, embedding array<double>, score int")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(table, F.col("vec_id") % 50 == 0).collect()}
    whole = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[i] = [math.floor(256 * x) for x in v]
    want = {}
    for q in whole:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
            want.update({(q, k + 1): (i, -s) for k, (s, i) in enumerate(scores[:5])})
    assert got == want


def test_top_k_small(spark):
    kind = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0]), (1, [-1.0])], kind)
    assert [tuple(r) for r in topk.top_k(two, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, -65536)]
    assert topk.top_k(two.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(two.where("vec_id = 1"), F.col("vec_id") % 50 == 0).count() == 0


def test_blocks_are_pruned():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(16, 8)) * 4000
    blocks = []
    for i, c in enumerate(centres):
        x = (c + rng.normal(size=(64, 8)) * 30).astype(np.int64)
        blocks.append((np.arange(64) + 64 * i, x, x.max(axis=0), x.min(axis=0)))
    ids, queries = np.arange(0, 1024, 50), np.concatenate([b[1] for b in blocks])[::50]
    best, names, scored = topk.search_blocks(ids, queries, blocks, 5)
    everything = queries @ np.concatenate([b[1] for b in blocks]).T
    everything[np.arange(len(ids)), ids] = np.iinfo(np.int64).min
    assert (best == np.sort(everything, axis=1)[:, :-6:-1]).all()
    assert scored < 0.5 * len(ids) * len(blocks)


# Language model ----------------------------------------------------------


@pytest.fixture(scope="module")
def small_model(spark):
    docs = common.table(spark, SF, "documents").select("doc_id", "text").cache()
    held = common.fold("doc_id", 10) == 0
    return docs, held, *neural_lm.train(docs.where(~held))


def test_language_model_scores(spark, small_model):
    docs, held, model, counts = small_model
    odd = spark.createDataFrame([(5000, None), (5001, ""), (None, "nowordlikethis " * 3), (5002, "The THE the")], DOC)
    table = docs.unionByName(odd).withColumn("score", F.lit("x"))
    got = neural_lm.score(table, model, counts).collect()
    learned = [r["text"] for r in docs.where(~held).collect()]
    words = lambda t: re.findall(common.WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    counted = collections.Counter(w for t in learned for w in words(t))
    total, ends = sum(counted.values()) + len(learned), len(learned)
    per = math.log10(total + 0.1 * (len(counted) + 2))
    v = model.vocabulary
    a, b, sums = model.tables()
    numbers = {w: i for i, w in enumerate(v.words[: v.size])}
    others = total - ends - sum(counted[w] for w in numbers)
    share = math.log10(others + 0.1 * (len(counted) - len(numbers) + 1))
    want = collections.Counter()
    near = []
    for r in table.collect():
        some = words(r["text"])
        base = sum(math.log10(counted[w] + 0.1) - per for w in some) + math.log10(ends + 0.1) - per
        ids = [v.end, v.end, *(numbers.get(w, v.unknown) for w in some), v.end]
        neural = sum((a[ids[k - 1], ids[k]] + b[ids[k - 2], ids[k]] - sums[ids[k - 1], ids[k - 2]]) / math.log(10) for k in range(2, len(ids)))
        neural += sum(math.log10(counted[w] + 0.1) - share for w in some if w not in numbers)
        want[r["doc_id"], len(some) + 1, sum(counted[w] > 0 for w in some) + 1, total] += 1
        near.append((str(r["doc_id"]), len(some), base, neural))
    assert want == collections.Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got)
    for w, r in zip(sorted(near), sorted(got, key=lambda r: (str(r["doc_id"]), r["n_tokens"], r["base_score"]))):
        assert math.isclose(w[2], r["base_score"], rel_tol=1e-9) and math.isclose(w[3], r["score"], rel_tol=1e-4, abs_tol=1e-3)


def test_language_model_learns(small_model):
    docs, held, model, counts = small_model
    a, b, sums = model.tables()
    assert np.allclose(np.exp(a[3] + b[5] - sums[3, 5]).sum(), 1)
    sums = neural_lm.score(docs.where(held), model, counts).agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_language_model_learns_from_all_tokens(spark, monkeypatch):
    """With next to nothing in the sample, what the documents outside it say is learned all the same."""
    monkeypatch.setattr(neural_lm, "SAMPLE_TOKENS", 1e-6)
    monkeypatch.setattr(neural_lm, "TASK_TOKENS", 20_000, raising=False)  # several tasks a round
    circle = " ".join("abcdefghij")
    docs = spark.createDataFrame([(i, " ".join([circle] * 10)) for i in range(2000)], DOC)
    model, _ = neural_lm.train(docs)
    a, b, sums = model.tables()
    numbers = {w: i for i, w in enumerate(model.vocabulary.words)}
    for before, last, after in ("abc", "efg", "ija"):
        h2, h1, w = numbers[before], numbers[last], numbers[after]
        assert np.exp(a[h1, w] + b[h2, w] - sums[h1, h2]) > 0.5


def test_places_alike_are_learned_together():
    """All places count, but equal ones take a share of the examples."""
    words = [chr(97 + i) for i in range(10)]
    v = neural_lm.Vocabulary("x", words, np.full(10, 4000), 10, 44_000, 11, 4000)
    rng = np.random.default_rng(1)
    stream, at = neural_lm.stream_of(v, [np.append(rng.integers(0, 10, 10), v.end) for _ in range(4000)])
    w, h1, h2, weight = neural_lm.examples(v, stream, at, 4)
    want = collections.Counter(zip(stream[at].tolist(), stream[at - 1].tolist(), stream[at - 2].tolist()))
    got = collections.Counter()
    for *key, n in zip(w.tolist(), h1.tolist(), h2.tolist(), weight.tolist()):
        got[tuple(key)] += n
    assert got.keys() == want.keys() and all(math.isclose(got[x], want[x], rel_tol=1e-5) for x in want)
    assert weight.max() <= 4 and len(w) < 0.4 * len(at)


def test_tasks_learn_from_every_place(spark, monkeypatch):
    """Texts that say the same words again, dealt to two tasks a round: the mean of what single places teach."""
    monkeypatch.setattr(neural_lm, "TASK_TOKENS", 2_000)
    rng = np.random.default_rng(8)
    v = neural_lm.Vocabulary("x", [f"w{i}" for i in range(6)], np.full(6, 2200), 6, 15_000, 7, 1200)
    texts = [np.append(rng.integers(0, 6, 11), v.end).astype(np.int16) for _ in range(1200)]
    ids = spark.createDataFrame([(i, bytearray(t.tobytes())) for i, t in enumerate(texts)], "id long, ids binary")
    got = neural_lm.refined(v, neural_lm.beginning(v), ids)
    want = neural_lm.beginning(v)
    for number in range(neural_lm.ROUNDS):
        own = ids.where(F.pmod(F.xxhash64("id", "ids"), F.lit(neural_lm.ROUNDS)) == number)
        dealt = own.repartition(2, "id", "ids").sortWithinPartitions("id", "ids").select("ids", F.spark_partition_id().alias("task")).collect()
        found = []
        for task in range(2):
            mine = [np.frombuffer(r["ids"], dtype=np.int16).astype(np.int64) for r in dealt if r["task"] == task]
            parameters = [x.copy() for x in want]
            stream, at = neural_lm.stream_of(v, mine)
            neural_lm.learn(v, parameters, stream, at, np.random.default_rng([number, task]))
            found.append((len(at), parameters))
        want = [sum(n * x for n, x in same) / sum(n for n, _ in same) for same in zip(*[[(n, x) for x in p] for n, p in found])]
    assert all(np.allclose(x, y, rtol=1e-3, atol=1e-3) for x, y in zip(got, want))


def test_words_are_cut_as_bytes():
    odd = ["", None, "A b", "É É\x85é\xa0a\u2003B", "\x1c\x1d x\x1ey\x1f", "\tA\n\x0b\x0c\rZ@[`{ ", "ſK İI", "a\x00b 😀C"]
    got = [[w.decode() for w in words] for words in common.lower_words(pa.array(odd, pa.string()))]
    assert got == [neural_lm.tokens_of(t) for t in odd]


def test_grouped_places_teach_the_same():
    """Contexts that a batch computes once, and places learned as one, lead to what single places lead to."""
    words = [chr(97 + i) for i in range(10)]
    v = neural_lm.Vocabulary("x", words, np.full(10, 4000), 10, 44_000, 11, 4000)
    texts = [np.append(np.roll(np.arange(10), i % 10), v.end) for i in range(4000)]
    for most in (1, 4):
        stream, at = neural_lm.stream_of(v, texts)
        parameters = neural_lm.beginning(v)
        neural_lm.learn(v, parameters, stream, at, np.random.default_rng(1), most)
        a, b, sums = neural_lm.model_of(v, parameters).tables()
        assert all(np.exp(a[i + 1, i + 2] + b[i, i + 2] - sums[i + 1, i]) > 0.5 for i in range(8))


def test_language_model_without_training(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], DOC)
    model, counts = neural_lm.train(docs.limit(0))
    got = {r["doc_id"]: r for r in neural_lm.score(docs, model, counts).collect()}
    assert got[1]["base_score"] == 0 and got[1]["n_known"] == 0 and got[2]["n_tokens"] == 1 and got[1]["score"] < 0
    assert neural_lm.score(docs.limit(0), model, counts).count() == 0


def test_counts_cover_all_documents(spark):
    docs = common.table(spark, SF, "documents")
    want = collections.Counter(w for r in docs.collect() for w in neural_lm.tokens_of(r["text"]))
    assert {r["word"]: r["n"] for r in neural_lm.word_counts(docs).collect()} == want
    assert zlib.crc32(b"7") % 10 == common_fold(spark, 7)


def common_fold(spark, x):
    return spark.createDataFrame([(x,)], "doc_id long").select(common.fold("doc_id", 10)).first()[0]
