"""Exact top-k search by inner product, pruned block by block.

A component plays the part of a term.  Documents are ordered by the nearest of a few centres and
cut into ranges; a range (block) keeps its forward index, which is the matrix of its vectors, and
each term's maximum and minimum.  A query sums, over the terms, its weight times the extreme of
the block that its sign asks for: no document of the block scores more.  It goes through the blocks
by falling bound and stops where the bound is below the k-th score found; at an equal bound it
goes on, since ties go to the smaller id.

Blocks of documents meet blocks of queries, each pair of a super-block and a query block in one
task; the few best of each pair are merged by query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import share_of_ids, written

SCALE = 256
BLOCK = 256
#: Blocks of a super-block, and queries of a query block.
SUPER_BLOCKS, QUERY_BLOCK = 32, 512
CENTRES, SAMPLE = 32, 4096
NOTHING = np.iinfo(np.int64)


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, q): floor(256 x) of every component x as a double.

    Rows take no part whose id or vector is null, or whose vector holds a null, a NaN or an
    infinity.  Of several rows with one id the least vector counts, so that repeated rows are one.
    """
    finite: Column = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = vectors.where("vec_id is not null and embedding is not null").where(finite).select("vec_id", whole.alias("q"))
    return rows.groupBy("vec_id").agg(F.min("q").alias("q"))


def _matrix(lists: list, width: int) -> np.ndarray:
    """Vectors as rows; a shorter one lacks its last components, which then count 0."""
    out = np.zeros((len(lists), width), dtype=np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _centres(rows: DataFrame, total: int, width: int) -> np.ndarray:
    """Centres fitted on a bounded sample, by a few rounds of k-means."""
    sample = rows.where(share_of_ids("vec_id", 9) < SAMPLE / max(1, total)).orderBy("vec_id").toPandas()
    x = _matrix(list(sample["q"]), width).astype(float)
    if not len(x):
        return np.zeros((1, width))
    centres = x[np.random.default_rng(3).permutation(len(x))[:CENTRES]]
    for _ in range(5):
        near = np.argmax(x @ centres.T - (centres**2).sum(axis=1) / 2, axis=1)
        centres = np.stack([x[near == i].mean(axis=0) if (near == i).any() else centres[i] for i in range(len(centres))])
    return centres


def blocks_of(rows: DataFrame, centres: np.ndarray, width: int, supers: int) -> DataFrame:
    """(super, ids, q, top, low) of ranges of documents in the order of their nearest centre."""

    def placed(batches):
        for batch in batches:
            x = _matrix(batch.column("q").to_pylist(), width)
            near = np.argmax(x @ centres.T - (centres**2).sum(axis=1) / 2, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(near.astype(np.int32)), pa.array([r.tobytes() for r in x], pa.binary())],
                names=["vec_id", "near", "q"],
            )

    def cut(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        left_ids, left, made = [], [], 0

        def block(n):
            nonlocal left_ids, left, made
            ids, data = np.array(left_ids[:n], dtype=np.int64), b"".join(left[:n])
            x = np.frombuffer(data, dtype=np.int64).reshape(len(ids), width)
            left_ids, left = left_ids[n:], left[n:]
            made += 1
            number = TaskContext.get().partitionId() * 2**20 + made // SUPER_BLOCKS
            columns = [[number], [ids.tobytes()], [data], [x.max(axis=0).tobytes()], [x.min(axis=0).tobytes()]]
            kinds = (pa.int64(), *[pa.binary()] * 4)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["super", "ids", "q", "top", "low"])

        for batch in batches:
            left_ids += batch.column("vec_id").to_pylist()
            left += batch.column("q").to_pylist()
            while len(left_ids) >= BLOCK:
                yield block(BLOCK)
        if left_ids:
            yield block(len(left_ids))

    near = rows.mapInArrow(placed, "vec_id long, near int, q binary")
    ranged = near.repartitionByRange(supers, "near", "vec_id").sortWithinPartitions("near", "vec_id")
    return ranged.mapInArrow(cut, "super long, ids binary, q binary, top binary, low binary")


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T: in floating point while every sum is below 2 ** 53, else in integers."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def search_blocks(
    query_ids: np.ndarray, queries: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], k: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """Scores and ids of the best k of each query, and how many (query, block) pairs were scored.

    All queries go on together: in a round each takes its next block, and queries that meet in a
    block are scored by one matrix product.
    """
    n = len(query_ids)
    best = np.full((n, k), NOTHING.min)
    ids = np.full((n, k), NOTHING.max)
    top, low = np.stack([b[2] for b in blocks]), np.stack([b[3] for b in blocks])
    bounds = _product(np.maximum(queries, 0), top) + _product(np.minimum(queries, 0), low)
    order = np.argsort(-bounds, axis=1, kind="stable")
    active, scored = np.arange(n), 0
    for turn in range(len(blocks)):
        at = order[active, turn]
        active = active[bounds[active, at] >= best[active, -1]]
        if not len(active):
            break
        at = order[active, turn]
        for number in np.unique(at):
            mine = active[at == number]
            block_ids, x = blocks[number][:2]
            scores = _product(queries[mine], x)
            scored += len(mine)
            own = query_ids[mine][:, None] == block_ids[None, :]
            scores = np.concatenate([best[mine], np.where(own, NOTHING.min, scores)], axis=1)
            names = np.concatenate([ids[mine], np.where(own, NOTHING.max, np.broadcast_to(block_ids, own.shape))], axis=1)
            chosen = np.lexsort((names, ~scores), axis=1)[:, :k]  # ~ turns the order, without overflow
            best[mine] = np.take_along_axis(scores, chosen, axis=1)
            ids[mine] = np.take_along_axis(names, chosen, axis=1)
    return best, ids, scored


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the best k of each query over all rows but its own.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on vec_id.  Ties go to the
    smaller id; fewer candidates give fewer rows, and no query gives none.  Scores are exact
    while they fit into 64 bits.
    """
    rows = written(quantised(vectors.select("vec_id", "embedding")), "vectors")
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("width")).first()
    total, width = facts["n"], max(1, facts["width"] or 1)
    supers = max(1, -(-total // (BLOCK * SUPER_BLOCKS)))
    blocks = written(blocks_of(rows, _centres(rows, total, width), width, supers), "blocks")
    asked = rows.where(is_query)
    parts = max(1, -(-asked.count() // QUERY_BLOCK))
    # Every row of either side carries the pair of blocks it is needed for.
    numbers = blocks.select("super").distinct()
    empty = F.lit(None).cast("binary")
    pair = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    held = blocks.select("super", pair.alias("part"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("id"), "ids", "q", "top", "low")
    in_part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part")
    by_part = asked.select(in_part, F.col("vec_id").alias("id"), F.col("q").alias("list"))
    # All super-blocks of a query: a stated query set against all rows.
    meets = numbers.select("super", pair.alias("part"))
    sought = by_part.join(meets, "part").select(
        "super", "part", F.lit(0).alias("kind"), "id", empty.alias("ids"), empty.alias("q"), empty.alias("top"), empty.alias("low"), "list"
    )
    both = held.withColumn("list", F.lit(None).cast("array<bigint>")).unionByName(sought)
    dealt = both.repartition("super", "part").sortWithinPartitions("super", "part", "kind")

    def run(batches):
        def results(ids, lists, blocks):
            if not ids or not blocks:
                return
            names = np.array(ids, dtype=np.int64)
            best, found, _ = search_blocks(names, _matrix(lists, width), blocks, k)
            real = found != NOTHING.max
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(names, real.sum(axis=1))), pa.array(found[real]), pa.array(best[real])],
                names=["query_id", "vec_id", "score"],
            )

        now, ids, lists, own = None, [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["super"], row["part"]) != now:
                    yield from results(ids, lists, own)
                    now, ids, lists, own = (row["super"], row["part"]), [], [], []
                if row["kind"] == 0:
                    ids.append(row["id"])
                    lists.append(row["list"])
                else:
                    block_ids = np.frombuffer(row["ids"], dtype=np.int64)
                    x = np.frombuffer(row["q"], dtype=np.int64).reshape(len(block_ids), width)
                    own.append((block_ids, x, np.frombuffer(row["top"], dtype=np.int64), np.frombuffer(row["low"], dtype=np.int64)))
        yield from results(ids, lists, own)

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
