"""How far the sources of a language use its words apart, from hash-consed segment trees.

The kept terms of a language are dealt to blocks, and a block numbers its terms.  Over these numbers
each source has a segment tree whose leaves are counts.  Trees are hash-consed: level by level, equal
pairs of children become one node, for all sources of the block together.  Two sources are compared
by walking their trees at the same time, and each pair of nodes is priced once however often it
occurs: most of a block is pairs of the same few small counts, or of empty subtrees.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import hold, written
from sparkmart.operators.joins import bounded_broadcast

#: Fixed values of the audit: what a term is, in how many documents it occurs, the smoothing and the unit.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCUMENTS, SMOOTHING, UNIT, TOP = 30, 5, 1_000_000_000, 50

#: Terms to a block, unless the language has more sources; then as many as it has sources, so that
#: the pairs a block tells of are no more than the counts that it may hold.
BLOCK = 512

#: Sources of a language that meet in one task; more are compared part by part.
PART = 64

#: Counted (language, source, term) keys that a task holds before it hands them on.
HELD_KEYS = 400_000

#: `TERM` in UTF-8: A-Z in lower case, and a space for every byte that no term has, as all of them are ASCII.
_TERM_BYTES = bytes(ord(chr(c).lower()) if re.match(TERM, chr(c)) else 32 for c in range(128)) + bytes(range(128, 256))

#: Leaf of the places that only fill a tree up to a power of two; it costs nothing.
_FILL = -1

#: Languages up to which their figures are broadcast.
MAX_LANGS = 10_000

_PAIRS = "lang string, source string, other string, term string, value long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term of each (lang, source), summed within a task as far as it holds them.

    The empty term stands for the group itself.
    """
    hold()
    # Both counters of a group get their keys in the same order
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def told():
        for (lang, source), (n, docs) in counts.items():
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            columns = {"lang": pa.repeat(lang, len(n)), "source": pa.repeat(source, len(n)), "term": terms}
            columns |= {"n": pa.array(list(n.values()), pa.int64()), "docs": pa.array(list(docs.values()), pa.int64())}
            yield from pa.table(columns).to_batches(max_chunksize=20_000)

    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for text, lang, source in zip(texts, *(batch.column(c).to_pylist() for c in ("lang", "source"))):
            if (lang, source) not in counts:
                counts[lang, source] = Counter({b"": 0}), Counter({b"": 0})
                held += 1
            n, docs = counts[lang, source]
            before = len(n)
            terms = text.translate(_TERM_BYTES).split()
            n.update(terms)
            docs.update(dict.fromkeys(terms).keys())  # a mapping would be added up in Python
            held += len(n) - before
            if held > HELD_KEYS:
                yield from told()
                counts.clear()
                held = 0
    yield from told()


def probabilities(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """``p`` of each count, exactly; 0 for places that only fill."""
    below = total + SMOOTHING * terms
    return np.array([0 if c == _FILL else 1 + UNIT * (c + SMOOTHING) // below for c in counts.tolist()], dtype=np.int64)


class Forest:
    """The trees of several sources over the same term numbers, with equal subtrees stored once.

    ``counts``: a row per source.  ``roots[i]``: the node of source i at the top level.
    """

    def __init__(self, counts: np.ndarray):
        width = 1 << max(0, int(counts.shape[1] - 1).bit_length())
        full = np.full((counts.shape[0], width), _FILL, dtype=np.int64)
        full[:, : counts.shape[1]] = counts
        self.leaves, nodes = np.unique(full, return_inverse=True)
        nodes = nodes.reshape(full.shape)
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        most = len(self.leaves)
        while nodes.shape[1] > 1:
            keys, nodes_above = np.unique(nodes[:, ::2] * most + nodes[:, 1::2], return_inverse=True)
            self.children.append((keys // most, keys % most))
            nodes, most = nodes_above.reshape(nodes.shape[0], -1), len(keys)
        self.roots = nodes[:, 0]

    def meet(self, a: int, b: int) -> tuple[tuple[np.ndarray, np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
        """A simultaneous walk from two roots: the distinct pairs of leaves, and the levels above them.

        A level lists, for each distinct pair of its nodes, where the pairs of left and of right children are in the level below.
        """
        left, right = np.array([a]), np.array([b])
        levels = []
        for first, second in reversed(self.children):
            below_left = np.concatenate([first[left], second[left]])
            below_right = np.concatenate([first[right], second[right]])
            most = int(below_right.max()) + 1
            keys, at = np.unique(below_left * most + below_right, return_inverse=True)
            levels.append((at[: len(left)], at[len(left) :]))
            left, right = keys // most, keys % most
        return (left, right), levels[::-1]

    def distance(self, i: int, j: int, p: np.ndarray, q: np.ndarray) -> int:
        """The sum of |p - q| over all terms; ``p`` and ``q`` by leaf."""
        (left, right), levels = self.meet(self.roots[i], self.roots[j])
        price = np.abs(p[left] - q[right])
        for first, second in levels:
            price = price[first] + price[second]
        return int(price[0])

    def largest(self, i: int, j: int, p: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(p - q, term number) of the terms that i has and uses more than j: the k largest, and all equal to the last.

        Pairs of nodes are priced by the largest difference below them; the search opens the best pair first.
        """
        (left, right), levels = self.meet(self.roots[i], self.roots[j])
        gain = np.where(self.leaves[left] > 0, p[left] - q[right], 0)
        prices = [gain]
        for first, second in levels:
            prices.append(np.maximum(prices[-1][first], prices[-1][second]))
        found: list[tuple[int, int]] = []
        open_pairs = [(-int(prices[-1][0]), len(levels), 0, 0)]
        while open_pairs:
            gain, level, number, pair = heapq.heappop(open_pairs)
            if gain >= 0 or len(found) >= k and -gain < found[k - 1][0]:
                break
            if level == 0:
                found.append((-gain, number))
                continue
            below = prices[level - 1]
            for side, at in enumerate(levels[level - 1]):
                if below[at[pair]] > 0:
                    heapq.heappush(open_pairs, (-int(below[at[pair]]), level - 1, 2 * number + side, int(at[pair])))
        return found


def _compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One block and two parts of the sources: distances of their pairs, and on the diagonal the largest terms.

    Rows without a source tell the language's own count of each term of the block; rows without a term tell a source and its total.
    """
    lang, _, first, second = (k.as_py() for k in key)
    # The numbers follow how frequent terms are, so that empty places are neighbours
    words = table.filter(pc.field("source").is_null()).sort_by([("n", "descending"), ("term", "ascending")])
    groups = table.filter(pc.field("source").is_valid() & pc.field("term").is_null())
    cells = table.filter(pc.field("source").is_valid() & pc.field("term").is_valid())
    terms, sources = words.column("term").to_pylist(), groups.column("source").to_pylist()
    counts = np.zeros((len(sources) + 1, len(terms)), dtype=np.int64)
    rows, numbers = (pc.index_in(cells.column(c), of.column(c)).to_numpy() for c, of in (("source", groups), ("term", words)))
    counts[rows, numbers] = cells.column("n").to_numpy()
    counts[-1] = words.column("n").to_numpy()
    part, total = groups.column("part").to_pylist(), groups.column("total").to_pylist()
    out: list[tuple] = []
    if terms and sources:
        forest = Forest(counts)
        kept, lang_total = groups.column("terms")[0].as_py(), groups.column("lang_total")[0].as_py()
        p = [probabilities(forest.leaves, n, kept) for n in total]
        if first == second:
            q = probabilities(forest.leaves, lang_total, kept)
            for i, source in enumerate(sources):
                best = forest.largest(i, len(sources), p[i], q, TOP)
                out += [(lang, source, None, terms[t], value) for value, t in best]
    for i, j in itertools.combinations(sorted(range(len(sources)), key=lambda i: (part[i], sources[i])), 2):
        if (part[i], part[j]) == (first, second):
            out.append((lang, sources[i], sources[j], None, forest.distance(i, j, p[i], p[j]) if terms else 0))
    names = [f.split()[0] for f in _PAIRS.split(", ")]
    kinds = [pa.string()] * 4 + [pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, kinds)], names=names)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it); a row with an empty term for every (lang, source)."""
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    found = texts.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def audit(docs: DataFrame) -> DataFrame:
    """Rows ``pair`` and ``term`` of every (lang, source): lang, source, part, item, value, rank.

    ``docs``: text, lang, source; a null one is empty, other columns play no part, and each row is a
    document of its own.  Whole texts are counted, within the task that reads them, then over all
    tasks; only terms kept by their language go on.  A language without kept terms has pairs of value 0,
    an empty table has no rows.  Ties in value go by the item's UTF-8 bytes.

    A task compares the sources of at most two parts (``PART`` sources each) over one block of terms,
    so it holds no more than ``2 * PART * max(BLOCK, sources)`` counts, whatever the table's size.
    """
    counted = written(term_counts(docs), "term-counts")
    words = counted.where("term <> ''")
    kept = written(
        words.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= MIN_DOCUMENTS)
        .select("lang", "term", "n"), "kept-terms",
    )
    kept_counts = written(words.join(kept.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "n"), "kept-counts")

    langs = (
        counted.where("term = ''").groupBy("lang").agg(F.count("*").alias("sources"))
        .join(kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total")), "lang", "left")
        .na.fill(0, ["terms", "lang_total"])
        .withColumn("size", F.greatest(F.lit(BLOCK), "sources"))
        .withColumn("blocks", F.expr("greatest(1, (terms + size - 1) div size)"))
        .withColumn("parts", F.expr(f"(sources + {PART - 1}) div {PART}"))
    )
    langs, _ = bounded_broadcast(written(langs, "langs"), MAX_LANGS)
    totals = kept_counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    part = F.pmod(F.xxhash64("source"), "parts").alias("part")
    block = F.pmod(F.xxhash64("term"), "blocks").alias("block")
    groups = counted.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").na.fill(0, ["total"])

    everywhere = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    nothing = {"term": F.lit(None).cast("string"), "n": F.lit(0).cast("long")}
    of_groups = groups.join(langs, "lang").select("lang", everywhere, "parts", part, "source", "total", "terms", "lang_total").withColumns(nothing)
    of_counts = kept_counts.join(langs, "lang").select("lang", block, "parts", part, "source", "term", "n")
    of_terms = kept.join(langs, "lang").select("lang", block, "parts", "term", "n")

    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    of_sources = of_groups.unionByName(of_counts, allowMissingColumns=True).select("*", others)
    met = of_sources.withColumns({"first": F.least("part", "other"), "second": F.greatest("part", "other")}).drop("other", "parts")
    firsts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("first")
    seconds = F.explode(F.sequence(F.col("first"), F.col("parts") - 1)).alias("second")
    all_terms = of_terms.select("*", firsts).select("*", seconds).drop("parts")
    where = ("lang", "block", "first", "second")
    # Dealt by the block too: the joins above may have left everything of a language in one place
    dealt = met.unionByName(all_terms, allowMissingColumns=True).repartition(*where)
    found = written(dealt.groupBy(*where).applyInArrow(_compare, _PAIRS), "divergence")

    once = found.where("term IS NULL").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("source").alias("item"))))
    pairs = once.select("lang", both.alias("p"), "value").select("lang", "p.source", F.lit("pair").alias("part"), "p.item", "value")
    terms = found.where("term IS NOT NULL").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(order).alias("rank")
    return pairs.select("*", ranked).unionByName(terms.select("*", ranked).where(F.col("rank") <= TOP))
