"""The prefix trie, against a plain trie of tuples and against SQL."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import compare
import pytest

from sparkmart.llm import oracle, prefix_trie, queries

SF = "/root/testdata/sf0.001"
TURN = "conv_id long, turn long, role string, text string, node long, shard string"


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            pair = (role or "", text or "")
            told = f"{len(pair[0].encode())}:{pair[0]}{pair[1]}".encode()
            own[c].append(((turn is not None, turn or 0, hashlib.sha256(told).digest()[:16]), pair))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    members = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])
        turns = tuple(base[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append((c, d == len(turns)))
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(of) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (of[0][0], len(node), members[node[:-1]][0][0] if node else None, len(of), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(str(c) for c, ends in of if ends).encode()).hexdigest())
        for node, of in members.items()
    )


def found(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[1]))


def test_trie_as_sql(spark):
    got = queries.QUERIES["op11_prefix_trie"](spark, SF)
    assert compare.difference(got, compare.connect(SF), oracle.SQL["op11_prefix_trie"]) is None


def test_trie_against_tuples(spark):
    rng = random.Random(3)
    rows = []
    for c in [*range(-60, 700), *range(1275, 1290), 2**40, 2**62 + 1]:
        if rng.random() < 0.8:
            for t in range(rng.choice((1, 1, 2, 3, 4, 7, 12))):
                rows.append((c, t if rng.random() < 0.95 else None, rng.choice(("user", "assistant", "", None)), rng.choice(("a", "é", "", None, "b")), 1, "x"))
    # Copies over several shards, which share every node, and turns that are there twice
    for c in range(100_000, 103_000, 5):
        rows += [(c, t, "user", f"copy {t}", 2, "y") for t in range(4)]
    rows += rows[:40] + [(None, 1, "user", "nobody's", 1, "x")]
    rng.shuffle(rows)
    got = found(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURN).repartition(7)))
    assert got == plain(rows)


def test_long_conversation_and_long_text(spark):
    rows = [(0, t, "user", str(t), 0, "") for t in range(150)] + [(20, t, "user", str(t), 0, "") for t in range(149)]
    rows += [(700, 0, "user", "0", 0, ""), (705, 0, "user", "long " * 600_000, 0, "")]
    assert found(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURN))) == plain(rows)


def test_no_conversation(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURN)).collect() == []


@pytest.mark.parametrize("size", [1, 300])
def test_hot_node_costs_one_row_a_shard(spark, size):
    """What is shuffled of a shared prefix follows the shards, not the members."""
    rows = [(c * 5, 0, "user", "same", 0, "") for c in range(size)]
    turns = prefix_trie.turn_rows(spark.createDataFrame(rows, TURN))
    nodes = turns.groupBy("shard").applyInArrow(prefix_trie._shard_nodes, prefix_trie._PARTIAL)
    assert nodes.where("depth = 0").count() == -(-size // 128)
