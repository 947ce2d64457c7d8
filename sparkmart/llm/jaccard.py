"""Similarity join of documents on 4-word shingles, by token-group matrix.

Documents are put into groups of similar ones.  A group stores the union of its members' tokens
(shingles), as rows of a token-group matrix.  The overlap of a document with a group's union
bounds its overlap with every member, and only groups whose bound reaches the threshold are
opened and compared member by member.

* Equal sets are one class, of which one representative goes on.
* Tokens have one order for all: frequent ones (found by counting a fixed share of the
  documents) last, else by hash.  Similar sets share one of their first tokens, so the matrix
  holds the first tokens only; the order keeps frequent passages out of it where a text has
  anything else.
* Each document is compared with its pivot, the most central document that it shares most first
  tokens with.  That takes one comparison a document and joins most of what links.
* Documents that share enough of their first tokens with their pivots are one cluster, linked or not, and so
  are those whose first tokens reach the same frequent passage.  What
  does not hang together in a cluster yet is compared in it, whole set with whole set, in
  parts of bounded size: near misses, which no bound tells apart, never meet by tokens.
* The groups of the matrix are what a component has in a cluster.  A document and a group of
  another cluster: the document's first tokens up to the end of the shortest
  prefix in the group, less those that the union has, are certain to be missing in every member.
* Groups that qualify are compared by their heads at first, which joins most of them; what
  is left is opened, in parts of bounded size.

Links decide components only, so no pairs within a component are made.  Whole texts are read again
for the sets of the documents that are compared; a fixed-size bitmap leaves out the others early.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import hold, largest_counts, mixed, written
from sparkmart.llm.graph import connected_components

N = 4
#: Linked: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Documents whose tokens are counted to find frequent ones, and how many tokens may count as such.
SAMPLE_SHARE, MAX_FREQUENT, LEAST_COUNT = 1 / 16, 2**18, 3
FREQUENT = np.uint64(1 << 63)
#: Members of a part of a group that is opened, queries that meet there, and parts of a frequent token.
PART_MEMBERS, PART_QUERIES, TOKEN_PARTS = 64, 200, 32
#: Comparisons of two sets in a cluster; what would take more is clustered more finely.  A matter of cost only.
MAX_COMPARED = 2**24
#: Words of the bitmap that leaves out documents early (64 bits each).
BITMAP_WORDS = 2**18

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2**63, N, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z in lower case, and the number of each word's text."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(encoded), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    data = data + np.uint8(32) * ((data >= 65) & (data <= 90))
    inside = (data != 32) & ((data < 9) | (data > 13))
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    begins = np.concatenate([np.arange(starts[0]), np.repeat(starts, np.diff(np.append(starts, len(data))))])
    within = np.arange(len(data)) - begins
    powers = _powers(int((ends - starts).max()) + 1)
    values = np.where(inside, _BYTE[data] * powers[np.minimum(within, len(powers) - 1)], np.uint64(0))
    bounds = np.cumsum([len(e) + 1 for e in encoded])
    return mixed(np.add.reduceat(values, starts)), np.searchsorted(bounds, starts, side="right")


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct 63-bit shingle hashes of each text; a text of fewer words has one for all."""
    words, owner = word_hashes(texts)
    n = max(0, len(words) - N + 1)
    windows = np.zeros(n, dtype=np.uint64)
    for k in range(N):
        windows += words[k : k + n] * _PLACE[k]
    windows = mixed(windows) >> np.uint64(1)
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= N:
            out.append(np.unique(windows[a : b - N + 1]))
        elif b > a:
            short = (words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mixed(np.array([short])) >> np.uint64(1))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _text_batches(batches, limit: int = 2**20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of batches with at most so many characters, or one text."""
    hold()
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        at = size = 0
        for i, t in enumerate(texts):
            if size and size + len(t) > limit:
                yield batch.slice(at, i - at), texts[at:i]
                at, size = i, 0
            size += len(t)
        if len(texts) > at:
            yield batch.slice(at), texts[at:]


def row_key() -> Column:
    """A 64-bit name of a row's content."""
    return F.xxhash64("doc_id", "text")


def frequent_tokens(docs: DataFrame) -> np.ndarray:
    """The tokens with most documents in a fixed share of the documents, at most `MAX_FREQUENT`."""

    def run(batches):
        for _, texts in _text_batches(batches):
            found = shingle_sets(texts)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["token"])

    sample = docs.where(F.pmod(row_key(), F.lit(2**20)) < int(SAMPLE_SHARE * 2**20)).select("text")
    counts = sample.mapInArrow(run, "token long").groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)
    counts = written(counts, "frequent")
    chosen = largest_counts(counts, MAX_FREQUENT, "token").select("token").toPandas()
    return np.sort(chosen["token"].to_numpy(dtype=np.int64).view(np.uint64))


def ordered(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Tokens in the common order: the top bit marks frequent ones."""
    if not len(frequent) or not len(tokens):
        return tokens
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    return np.sort(tokens | np.where(frequent[at] == tokens, FREQUENT, np.uint64(0)))


def _unsigned(name: str) -> Column:
    """A token as a number that has the common order."""
    return F.col(name).bitwiseXOR(F.lit(-(2**63)))


def least_overlap(n: np.ndarray | int) -> np.ndarray | int:
    """The least intersection of a set of n tokens with any set that it links with."""
    return -(-PERCENT * n // 100)


def prefix_length(n: int) -> int:
    return n - least_overlap(n) + 1 if n else 0


def signatures(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """doc_id, key, n, two 64-bit sums that name the set, and the first tokens in the common order."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        for batch, texts in _text_batches(batches):
            sets = [ordered(s, shared.value) for s in shingle_sets(texts)]
            prefixes = [s[: prefix_length(len(s))] for s in sets]
            sums = [(mixed(s).sum(dtype=np.uint64), mixed(s ^ _BASE).sum(dtype=np.uint64)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array([a for a, _ in sums], dtype=np.uint64).view(np.int64)),
                    pa.array(np.array([b for _, b in sums], dtype=np.uint64).view(np.int64)),
                    pa.array([p.tobytes() for p in prefixes], pa.binary()),
                    pa.array(np.array([p[-1] if len(p) else 0 for p in prefixes], dtype=np.uint64).view(np.int64)),
                ],
                names=["doc_id", "key", "n", "f1", "f2", "prefix", "last"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("key"))
    return source.mapInArrow(run, "doc_id long, key long, n long, f1 long, f2 long, prefix binary, last long")


def prefix_rows(classes: DataFrame) -> DataFrame:
    """(token, id, n, pos, part) of the first tokens; frequent tokens are dealt over parts."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                some = batch.slice(at, 2000)
                sets = [np.frombuffer(x, dtype=np.uint64) for x in some.column("prefix").to_pylist()]
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                if not sizes.sum():
                    continue
                tokens = np.concatenate(sets)
                ids = np.repeat(some.column("id").to_numpy(), sizes)
                part = np.where(tokens >= FREQUENT, mixed(ids.view(np.uint64)) % np.uint64(TOKEN_PARTS), np.uint64(0))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(tokens.view(np.int64)),
                        pa.array(ids),
                        pa.array(np.repeat(some.column("n").to_numpy(), sizes)),
                        pa.array((np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)),
                        pa.array(part.astype(np.int32)),
                    ],
                    names=["token", "id", "n", "pos", "part"],
                )

    return classes.select("id", "n", "prefix").mapInArrow(run, "token long, id long, n long, pos int, part int")


def shared_rows(rows: DataFrame) -> DataFrame:
    """(token, id, n, pos) of the tokens that two documents or more have.

    A partition is sorted and read as a stream; a row waits for the next one only.  Rows of
    frequent tokens are all kept, as their parts do not see each other.
    """

    def run(batches):
        carry = None  # the last row, and whether the row before it had the same token
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in ("token", "id", "n", "pos")]
            if carry is not None:
                columns = [np.concatenate([[a], b]) for a, b in zip(carry[0], columns)]
            token = columns[0]
            same = np.zeros(len(token), dtype=bool)  # as the row before
            same[1:] = token[1:] == token[:-1]
            same[0] = carry is not None and carry[1]
            keep = (same[:-1] | same[1:] | (token[:-1] < 0))
            carry = ([c[-1] for c in columns], bool(same[-1]))
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[:-1][keep]) for c in columns], names=["token", "id", "n", "pos"])
        if carry is not None and (carry[1] or carry[0][0] < 0):
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(carry[0], kinds)], names=["token", "id", "n", "pos"]
            )

    dealt = rows.repartition("token", "part").sortWithinPartitions("token", "part", "id")
    return written(dealt.mapInArrow(run, "token long, id long, n long, pos int"), "tokens")


def centrality(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, central): how many documents have a document's first tokens, on average.

    Of a group of edited copies, the one nearest to the common text comes out highest.
    """
    often = rows.groupBy("token").agg(F.count("*").alias("df"))
    total = rows.join(often, "token").groupBy("id").agg(F.sum("df").alias("total"))
    length = F.length("prefix") / 8
    return classes.select("id", "prefix").join(total, "id", "left").select(
        "id", (F.coalesce("total", F.lit(0)) / length).alias("central")
    )


def pivots(rows: DataFrame, central: DataFrame) -> DataFrame:
    """(id, g, strong): the most central document of the most first tokens of a document.

    Pivots with a small share of a document's tokens are left out; strong ones have half of the first tokens.
    """
    scored = rows.join(central, "id").select("token", "id", "n", F.struct("central", (-F.col("id")).alias("id")).alias("rank"))
    of_token = scored.groupBy("token").agg(F.max("rank").alias("top"))
    votes = scored.join(of_token, "token").where("rank < top").groupBy("id", F.col("top").alias("pivot")).agg(
        F.count("*").alias("k"), F.min("n").alias("n")
    )
    best = votes.groupBy("id").agg(F.max(F.struct("k", "pivot")).alias("b"), F.min("n").alias("n"))
    share = lambda parts: F.col("b.k") * 100 * parts >= F.col("n") * (100 - PERCENT)
    return best.where(share(4)).select("id", (-F.col("b.pivot.id")).alias("g"), share(2).alias("strong"))


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with a bit for each id; a document whose bit is not set is none of them."""
    place = F.pmod(F.xxhash64("id"), F.lit(BITMAP_WORDS * 64))
    words = ids.select((place / 64).cast("int").alias("w"), F.expr("shiftleft(1L, cast(pmod(xxhash64(id), 64) as int))").alias("b"))
    rows = words.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    out = np.zeros(BITMAP_WORDS, dtype=np.int64)
    out[rows["w"].to_numpy(dtype=np.int64)] = rows["b"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def sets_of(docs: DataFrame, ids: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(id, tokens) of the documents whose row key is among ``ids`` (id), and a few others."""
    context = docs.sparkSession.sparkContext
    bitmap, often = context.broadcast(_bitmap(ids)), context.broadcast(frequent)

    def run(batches):
        for batch in batches:
            at = batch.column("at").to_numpy()
            wanted = bitmap.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)
            chosen = batch.filter(pa.array(wanted.astype(bool)))
            for part, texts in _text_batches([chosen]):
                sets = [ordered(s, often.value).tobytes() for s in shingle_sets(texts)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.binary())], names=["id", "tokens"])

    source = docs.select(row_key().alias("id"), "text").withColumn("at", F.pmod(F.xxhash64("id"), F.lit(BITMAP_WORDS * 64)))
    return source.mapInArrow(run, "id long, tokens binary")


def verified(docs: DataFrame, queries: DataFrame, members: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(a, b) for each query and part of a group that it links with a member of.

    ``queries`` (id, g) are compared with ``members`` (id, g) of their group: one link with a part
    is enough, since members of a group belong together already.  With a column ``label`` they
    do only as far as their labels are equal: then there is one link for each label but the
    query's own.  Members and queries of a group are dealt over parts, so that no task gets a whole group.
    """
    if "label" not in queries.columns:
        queries, members = (df.withColumn("label", F.lit(None).cast("long")) for df in (queries, members))
    queries, members = written(queries, "queries"), written(members, "members")
    sizes = (
        queries.groupBy("g").agg(F.count("*").alias("nq")).join(members.groupBy("g").agg(F.count("*").alias("nm")), "g")
        .select("g", F.ceil(F.col("nm") / PART_MEMBERS).cast("int").alias("ms"), F.ceil(F.col("nq") / PART_QUERIES).cast("int").alias("qs"))
    )
    part = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = queries.join(sizes, "g").select("id", "g", "label", every("ms").alias("m"), part("qs", 5).alias("q"), F.lit(1).alias("kind"))
    held = members.join(sizes, "g").select("id", "g", "label", part("ms", 6).alias("m"), every("qs").alias("q"), F.lit(0).alias("kind"))
    rows = asked.unionByName(held)
    ids = queries.select("id").unionByName(members.select("id")).distinct()
    sets = sets_of(docs, ids, frequent)
    dealt = rows.join(sets, "id").repartition("g", "m", "q").sortWithinPartitions("g", "m", "q", "kind")

    def run(batches):
        now, names, tokens, owner = None, [], None, None
        for batch in batches:
            a, b = [], []
            columns = [batch.column(c).to_pylist() for c in ("id", "g", "label", "m", "q", "kind", "tokens")]
            for name, g, label, m, q, kind, data in zip(*columns):
                if (g, m, q) != now:
                    now, names, labels, sets_here, tokens = (g, m, q), [], [], [], None
                mine = np.frombuffer(data, dtype=np.uint64)
                if kind == 0:
                    names.append(name)
                    labels.append(label)
                    sets_here.append(mine)
                    continue
                if not names:
                    continue
                if tokens is None:
                    tokens = np.concatenate(sets_here)
                    size = np.array([len(s) for s in sets_here])
                    owner = np.repeat(np.arange(len(names)), size)
                    sets_here = []
                at = np.minimum(np.searchsorted(mine, tokens), len(mine) - 1)
                both = np.bincount(owner[mine[at] == tokens], minlength=len(names))
                linked = np.flatnonzero(100 * both >= PERCENT * (size + len(mine) - both))
                if label is None:
                    found = [names[i] for i in linked[:1]]
                else:
                    found = {labels[i]: names[i] for i in linked if labels[i] != label}.values()
                a += [name] * len(found)
                b += found
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return written(dealt.mapInArrow(run, "a long, b long"), "links")


def _named(rows: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """``rows`` with the component of their id, or the id where it has none."""
    return rows.join(names.withColumnRenamed("component", column), "id", "left").withColumn(column, F.coalesce(column, "id"))


def units_of(classes: DataFrame, components: DataFrame, clusters: DataFrame) -> DataFrame:
    """(id, c, g, u): cluster, component and unit.  A unit is what a component has in a cluster, named by its least id."""
    placed = written(_named(_named(classes.where("n > 0").select("id"), clusters, "c"), components, "g"), "placed")
    units = placed.groupBy("c", "g").agg(F.min("id").alias("u"))
    return written(placed.join(units, ["c", "g"]).select("id", "c", "g", "u"), "units")


def clusters_of(classes: DataFrame, rows: DataFrame, wanted: DataFrame, links: DataFrame, groups: DataFrame) -> DataFrame:
    """(id, component): the cluster of each document.

    Documents that are joined to their pivots (see `pivots`), and those whose first tokens reach the same frequent
    token, as they have a passage in common; where these are too many to be compared with each
    other, those joined to their pivots; where these are, those joined strongly; where these are, those that link.
    """
    near = wanted.select(F.col("id").alias("a"), F.col("g").alias("b"), "strong")
    reached = rows.where("token < 0").groupBy("id").agg(F.min_by("token", "pos").alias("token"))
    star = reached.join(reached.groupBy("token").agg(F.min("id").alias("b")), "token").select(F.col("id").alias("a"), "b")
    joined = near.select("a", "b").unionByName(links)
    placed = _named(classes.where("n > 0").select("id"), groups, "g")
    tiers = {"wide": joined.unionByName(star), "weak": joined, "strong": near.where("strong").select("a", "b").unionByName(links)}
    for name, edges in tiers.items():
        placed = written(_named(placed, connected_components(edges, name), name), "placed")
        units = placed.groupBy(name, "g").agg(F.count("*").alias("k")).groupBy(name)
        sizes = units.agg(((F.sum("k") - F.max("k")) * F.sum("k") <= MAX_COMPARED).alias(f"{name}_fits"))
        placed = placed.join(sizes, name)
    chosen = F.coalesce(*(F.when(F.col(f"{name}_fits"), F.col(name)) for name in tiers), "g")
    return written(placed.select("id", chosen.alias("component")), "clusters")


def inside_clusters(docs: DataFrame, units: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(a, b): links between the units of each cluster, document by document, in bounded parts.

    The members of a cluster are near each other, so no bound would tell them apart, and a join over
    their tokens would have a row for each two of them and each token.  Those of the largest unit ask nothing.
    """
    sizes = units.groupBy("c", "u").agg(F.count("*").alias("k")).groupBy("c").agg(
        F.max(F.struct("k", "u")).alias("top"), F.count("*").alias("several")
    )
    several = units.join(sizes.where("several > 1").select("c", F.col("top.u").alias("largest")), "c")
    members = several.select("id", F.col("c").alias("g"), F.col("u").alias("label"))
    return verified(docs, several.where("u <> largest").select("id", F.col("c").alias("g"), F.col("u").alias("label")), members, frequent)


def meetings(rows: DataFrame, classes: DataFrame, units: DataFrame) -> DataFrame:
    """The token-group matrix joined with the documents: a row for each token of a document that a unit has.

    Only units of other clusters and components.  ``rows`` are those of `shared_rows`.  Of two units, the
    documents of the one with fewer members (then the greater id) are the queries.
    """
    placed = written(rows.select("token", "id", "n", "pos").join(units, "id"), "placed-tokens")
    unit_facts = classes.where("n > 0").select("id", "n", "last").join(units, "id").groupBy("u").agg(
        F.min(_unsigned("last")).alias("upto"), F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("members")
    ).withColumn("upto", _unsigned("upto"))  # the least in the common order, as a token again
    matrix = placed.select("token", "u", "g", "c").distinct()
    several = matrix.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token")
    matrix = written(matrix.join(several, "token").join(unit_facts, "u"), "matrix")
    own = matrix.select("token", "u", F.col("members").alias("own_members"))
    asked = placed.join(own, ["token", "u"]).withColumnsRenamed({"u": "own", "g": "own_g", "c": "own_c"})
    return asked.join(matrix, "token").where(
        "g <> own_g and c <> own_c and (members > own_members or (members = own_members and u < own))"
        f" and 100 * most >= {PERCENT} * n and 100 * n >= {PERCENT} * least"
    )


def qualifying(rows: DataFrame, classes: DataFrame, units: DataFrame) -> DataFrame:
    """(id, u): documents and units of `meetings` whose overlap bound reaches the threshold.

    The union is made of the first tokens of the members; up to the least end of their prefixes (``upto``)
    it is complete.
    """
    complete = _unsigned("token") <= _unsigned("upto")
    pairs = meetings(rows, classes, units).groupBy("id", "u").agg(
        F.count(F.when(complete, 1)).alias("found"), F.max(F.when(complete, F.col("pos"))).alias("pos"),
        F.min("n").alias("n"), F.min("least").alias("least"), F.min("upto").alias("upto"),
    )
    # A member has at least the size `least` and PERCENT of the query's; both bound the intersection.
    need = F.greatest(
        F.ceil(PERCENT * F.col("n") / 100), F.ceil(PERCENT * (F.col("n") + F.col("least")) / F.lit(100 + PERCENT))
    )
    pairs = pairs.withColumn("spare", F.col("n") - need).where("coalesce(pos + 1, 0) - found <= spare")

    def run(batches):
        for batch in batches:
            prefixes = batch.column("prefix").to_pylist()
            upto = batch.column("upto").to_numpy().view(np.uint64)
            upper = [int(np.searchsorted(np.frombuffer(p, dtype=np.uint64), u, side="right")) for p, u in zip(prefixes, upto)]
            good = np.array(upper) - batch.column("found").to_numpy() <= batch.column("spare").to_numpy()
            yield batch.select(["id", "u"]).filter(pa.array(good))

    joined = pairs.join(classes.select("id", "prefix"), "id").select("id", "u", "prefix", "upto", "found", "spare")
    return written(joined.mapInArrow(run, "id long, u long"), "qualifying")


def link_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs`` (doc_id, text), as in `linked_rows`."""
    return linked_rows(docs).select("doc_id", "n_shingles", "component_id")


def linked_rows(docs: DataFrame) -> DataFrame:
    """doc_id, key (`row_key`), n_shingles, component_id and component for every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that can be reached over links, the row's own included;
    a null doc_id counts for nothing there, so that it is null only if all reachable ids are.
    A null text or one without a word has no shingle and links with nothing, not even its like.
    Tokens, sets and rows are named by 64- and 128-bit hashes, taken as equal only if equal.
    Where ids repeat, components may share a component_id; ``component`` tells them apart.
    """
    docs = docs.select("doc_id", "text")
    frequent = frequent_tokens(docs)
    found = written(signatures(docs, frequent), "signatures")
    grouped = found.where("n > 0").groupBy("f1", "f2", "n").agg(
        F.min("key").alias("id"), F.min("doc_id").alias("least_doc"), F.max("prefix").alias("prefix"), F.max("last").alias("last")
    )
    classes = written(grouped, "classes")
    rows = shared_rows(prefix_rows(classes))

    # Clusters of near documents, and in them what links: with the pivot at first, then all with all.
    central = written(centrality(rows, classes), "central")
    wanted = written(pivots(rows, central), "pivots")
    asked = wanted.select("id", "g")
    links = verified(docs, asked, asked.select(F.col("g").alias("id"), "g").distinct(), frequent)
    groups = connected_components(links, "groups")
    clusters = clusters_of(classes, rows, wanted, links, groups)
    links = links.unionByName(inside_clusters(docs, units_of(classes, groups, clusters), frequent))
    groups = connected_components(links, "groups")

    # The heads of qualifying units, until that joins nothing more; then all their members.
    while True:
        units = units_of(classes, groups, clusters)
        pairs = qualifying(rows, classes, units).withColumnRenamed("u", "g")
        placed = central.join(units.select("id", F.col("u").alias("g")), "id")
        top = placed.groupBy("g").agg(F.max(F.struct("central", (-F.col("id")).alias("id"))).alias("top"))
        heads = written(top.join(pairs.select("g").distinct(), "g").select((-F.col("top.id")).alias("id"), "g"), "heads")
        new = verified(docs, pairs, heads, frequent)
        if not new.limit(1).count():
            break
        links = links.unionByName(new)
        groups = connected_components(links, "groups")
    members = placed.join(heads.select("g", F.col("id").alias("head")), "g").where("id <> head").select("id", "g")
    new = verified(docs, pairs.join(members.select("g").distinct(), "g", "left_semi"), members, frequent)
    groups = connected_components(links.unionByName(new), "groups")

    named = _named(classes.select("id", "f1", "f2", "n", "least_doc"), groups, "g")
    smallest = named.groupBy("g").agg(F.min("least_doc").alias("component_id"))
    by_set = named.join(smallest, "g").select("f1", "f2", "n", "component_id", F.col("g").alias("component"))
    out = found.select("doc_id", "key", "n", "f1", "f2").join(by_set, ["f1", "f2", "n"], "left")
    component_id = F.coalesce("component_id", F.when(F.col("n") == 0, F.col("doc_id"))).alias("component_id")
    return out.select("doc_id", "key", F.col("n").alias("n_shingles"), component_id, "component")
