"""The trie of conversation prefixes, from vertical bitmaps.

A shard is a range of conversation ids.  In each one an index maps (position, turn) to the bitset
of its conversations, and a depth-first walk intersects the bitset of a node with the postings of
the next position: what is left are its children, their bits counted are their members, and the
bits of conversations that end there are its end list.  Shards meet only as sums: what a node has
in each of them is added, and whatever may count once only (the bytes of a node, a leaf, a child)
is counted by the shard that holds the node's smallest member.  So a first turn that a third of all
conversations share costs one row a shard.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import written

#: Fixed values of the rebuilt conversations: ids to a family, and the bound of the turns taken from its first.
FAMILY, TAKEN = 5, 9

#: Ids to a shard, a multiple of ``FAMILY``; a bitset of a shard has as many bits, and some for negative ids.
SHARD = 128 * FAMILY

_ROOT = bytes(16)
_PARTIAL = (
    "shard long, node binary, parent binary, depth long, size long, conv_id long, n_convs long, n_children long, "
    "moved long, ends binary"
)
_SUMS = (
    "node binary, conv_id long, depth long, parent_conv_id long, n_convs long, moved long, "
    "n_children long, n_leaves long, distinct long, ends_sha256 string"
)


def _shard_of(conv_id: str) -> Column:
    base = f"({conv_id} - {conv_id} % {FAMILY})"
    return F.expr(f"({base} - pmod({base}, {SHARD})) div {SHARD}")


def _first_id(shard: int) -> int:
    """The smallest id that a shard can hold: remainders of negative ids are negative."""
    return shard * SHARD - (FAMILY - 1)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """shard, conv_id, turn, digest (of role and text, 128 bits of SHA-256) and size (bytes of text) of each turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        _shard_of("conv_id").alias("shard"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(told, 256), 1, 32)).alias("digest"), F.octet_length(text).cast("long").alias("size"),
    )


def rebuilt(own: dict[int, list]) -> dict[int, list]:
    """Each conversation with its first turns replaced by those of the first of its family."""
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % TAKEN
        base = c - int(np.fmod(c, FAMILY))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def _conversations(table: pa.Table) -> dict[int, list[tuple[bytes, int]]]:
    keys = [(k, "ascending") for k in ("conv_id", "turn", "digest")]
    table = table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start"))
    own: dict[int, list] = {}
    for c, digest, size in zip(*(table.column(k).to_pylist() for k in ("conv_id", "digest", "size"))):
        own.setdefault(c, []).append((digest, size))
    return own


def walk(sequences: list[list[tuple[bytes, int]]]) -> Iterator[tuple[bytes, bytes | None, int, int, int, int]]:
    """The nodes of a shard, parents first: node, parent, depth, bytes of its last text, members, ends (bitsets).

    Bit i is ``sequences[i]``.  The index and the bitsets are Python integers.
    """
    postings: list[dict[bytes, int]] = []
    longer: list[int] = []
    for i, turns in enumerate(sequences):
        while len(postings) < len(turns):
            postings.append(defaultdict(int))
            longer.append(0)
        for position, (digest, _) in enumerate(turns):
            postings[position][digest] |= 1 << i
            longer[position] |= 1 << i
    longer.append(0)
    stack = [(_ROOT, None, 0, 0, (1 << len(sequences)) - 1)]
    while stack:
        node, parent, depth, size, members = stack.pop()
        rest = members & longer[depth]
        yield node, parent, depth, size, members, members ^ rest
        while rest:
            digest, below = sequences[(rest & -rest).bit_length() - 1][depth]
            child = rest & postings[depth][digest]
            rest ^= child
            stack.append((hashlib.blake2b(node + digest, digest_size=16).digest(), node, depth + 1, below, child))


def _shard_nodes(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
    shard = key[0].as_py()
    first = _first_id(shard)
    own = rebuilt(_conversations(table))
    # Bits in the order of the ids, without those that the shard lacks
    ids = sorted(own)
    nodes = list(walk([own[c] for c in ids]))
    at = {n[0]: i for i, n in enumerate(nodes)}
    moved = [n[3] * n[4].bit_count() for n in nodes]
    children = [0] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        parent = at[nodes[i][1]]
        moved[parent] += moved[i]
        children[parent] += 1

    def packed(ends: int) -> bytes | None:
        bits = 0
        while ends:
            low = ends & -ends
            bits |= 1 << (ids[low.bit_length() - 1] - first)
            ends ^= low
        return bits.to_bytes(-(-bits.bit_length() // 8), "little") if bits else None

    def columns():
        yield pa.array([shard] * len(nodes), pa.int64())
        yield pa.array([n[0] for n in nodes], pa.binary())
        yield pa.array([n[1] for n in nodes], pa.binary())
        yield pa.array([n[2] for n in nodes], pa.int64())
        yield pa.array([n[3] for n in nodes], pa.int64())
        yield pa.array([ids[(n[4] & -n[4]).bit_length() - 1] for n in nodes], pa.int64())
        yield pa.array([n[4].bit_count() for n in nodes], pa.int64())
        yield pa.array(children, pa.int64())
        yield pa.array(moved, pa.int64())
        yield pa.array([packed(n[5]) for n in nodes], pa.binary())

    return pa.table(list(columns()), names=[f.split()[0] for f in _PARTIAL.split(", ")])


def _shard_sums(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
    """What a shard adds to its nodes: the children, leaves and bytes that are this shard's to count."""
    shard = key[0].as_py()
    rows = sorted(table.to_pylist(), key=lambda r: -r["depth"])
    conv = {r["node"]: r["conv_id"] for r in rows}
    leaves, size, children = (dict.fromkeys(conv, 0) for _ in range(3))
    out = []
    for r in rows:
        node, parent = r["node"], r["parent"]
        if own := r["owner"] == shard:
            leaves[node] += r["leaf"]
            size[node] += r["size"]
        if parent is not None:
            children[parent] += own
            leaves[parent] += leaves[node]
            size[parent] += size[node]
        told = (r["conv_id"], r["depth"], conv.get(parent), r["n_convs"], r["moved"]) if own else (None,) * 5
        out.append((node, *told, children[node], leaves[node], size[node], None))
    kinds = [pa.binary(), *[pa.int64()] * 8, pa.string()]
    columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
    return pa.table(columns, names=[f.split()[0] for f in _SUMS.split(", ")])


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash a node from its end lists, which come in the order of the shards; holds one batch."""
    node, digest, first = None, None, True

    def told(done):
        return pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], names=["node", "ends_sha256"]
        )

    for batch in batches:
        done = []
        for key, shard, ends in zip(*(batch.column(c).to_pylist() for c in ("node", "shard", "ends"))):
            if key != node:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest, first = key, hashlib.sha256(), True
            bits = np.flatnonzero(np.unpackbits(np.frombuffer(ends, np.uint8), bitorder="little"))
            ids = ",".join(map(str, (bits + _first_id(shard)).tolist()))
            digest.update((ids if first else "," + ids).encode())
            first = False
        yield told(done)
    if node is not None:
        yield told([(node, digest.hexdigest())])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    ``conversations``: conv_id, turn, role, text; other columns play no part.  Turns are ordered by
    ``turn``, null first, and by the digest of role and text among equals; a row that is there twice
    is two turns.  A null role or text is an empty one.  Rows without a conv_id belong to no
    conversation and are left out.  An empty table has no node.

    Texts are hashed where they are read, so that what moves is some fifty bytes a turn, however
    long the text.  A task holds the digests of the turns of one shard, ``SHARD`` conversations;
    end lists reach their hash as bitsets, in order and one batch at a time.
    """
    turns = turn_rows(conversations)
    partial = written(turns.groupBy("shard").applyInArrow(_shard_nodes, _PARTIAL), "trie-nodes")
    merged = partial.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("moved").alias("moved"),
        (F.max("n_children") == 0).cast("long").alias("leaf"),
    )
    known = partial.select("shard", "node", "parent", "depth", "size").join(merged.withColumn("owner", _shard_of("conv_id")), "node")
    sums = known.groupBy("shard").applyInArrow(_shard_sums, _SUMS)
    ends = partial.where("ends IS NOT NULL").select("node", "shard", "ends")
    hashed = ends.repartition("node").sortWithinPartitions("node", "shard").mapInArrow(_hash_ends, "node binary, ends_sha256 string")
    once = ("conv_id", "depth", "parent_conv_id", "n_convs", "moved", "ends_sha256")
    whole = sums.unionByName(hashed, allowMissingColumns=True).groupBy("node").agg(
        *(F.max(c).alias(c) for c in once), *(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "distinct"))
    )
    empty = F.lit(hashlib.sha256().hexdigest())
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("moved") - F.col("distinct")).alias("saved_tokens"), F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )
