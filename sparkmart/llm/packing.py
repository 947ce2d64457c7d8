"""Packing documents into sequences of a fixed number of tokens by minimum bin slack.

Tokens are made in the tasks.  Which sequence a piece goes to depends on its length alone, so
the packing is planned on the histogram of lengths, which has at most ``capacity`` entries for
any corpus: for each bin a bitset subset-sum finds the fullest combination of the lengths left
(the longest one included), and that combination is taken as often as the counts allow.  Pieces
are then numbered within their length, in shards, and look up their place in the plan.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import appended, hold, written

CAPACITY = 2048
END_ID = 0
#: Pieces of one length in a shard, to expect.
SHARD_ROWS = 500
PIECES = "doc_id long, piece int, start long, length long, ids binary"

# A tokenizer of this kind never joins a space to what stands before it, nor a letter to a mark
# that follows; so a text may be cut before every run of spaces and between a letter and a mark,
# and the ids of parts seen before are looked up.
_parts = re.compile(r"[ \n]*+[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[.,!?;:|&%$#*])|[ \n]*+[^ \n]++|[ \n]+").findall
_letters = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
_other_space = re.compile(r"[^\S \n]").search
#: Parts remembered in each of two generations, and the length of the longest.
CACHED, CACHED_LENGTH = 250_000, 64
#: Characters cut and looked up at a time.
CHARS_AT_ONCE = 2**20
#: A character that joins parts to be encoded at once; no id has it beside any other character.
JOINT = "\x00"


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Where a text holds the string of a special token, that token ends words, so the text is not cut.
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(added)).search if added else lambda text: None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        ids = self.tokenizer.encode_batch_fast([JOINT], add_special_tokens=False)[0].ids
        self.joint, piece = ids[0], self.tokenizer.id_to_token(ids[0])
        self.joins = len(ids) == 1 and all(set(x) == {piece} for x in self.tokenizer.get_vocab() if piece in x)
        self.in_bytes = self._letters_in_bytes(path)

    def _letters_in_bytes(self, path: str) -> dict[int, str] | None:
        """What the model reads for a space and for each letter; None if it may read letters in another way."""
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            stated = json.load(f)
        cut = stated.get("pre_tokenizer") or {}
        if any(_letters(t.content.strip()) for t in self.tokenizer.get_added_tokens_decoder().values()):
            return None
        if stated.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            return None
        read = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        return {c: read(chr(c))[0][0] for c in range(256) if c == 32 or _letters(chr(c))}

    def _words(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of letters with at most a space before them: one word to the model, so that nothing has to look where words end."""
        tokenize, table = self.tokenizer.model.tokenize, self.in_bytes
        return {x: array("I", [t.id for t in tokenize(x.translate(table))]).tobytes() for x in parts}

    def _each(self, parts: list[str]) -> dict[str, bytes]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return {part: array("I", e.ids).tobytes() for part, e in zip(parts, found)}

    def fresh(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts: of words one by one, of others many at once, joined by a character whose id shows where each ends."""
        words = list(filter(_letters, parts)) if self.in_bytes else []
        out, parts = self._words(words), list(set(parts).difference(words))
        if not self.joins:
            return out | self._each(parts)
        # A space at the end, or a quote at the beginning that may be a contraction's, has to stand alone.
        alone = [x for x in parts if JOINT in x or x[0] == "'" or x[-1].isspace() or self.special(x)]
        together = list(set(parts).difference(alone))
        out |= self._each(alone)
        for at in range(0, len(together), 2000):
            some = together[at : at + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([JOINT.join(some)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            cut = np.flatnonzero(ids == self.joint)
            data, begin = ids.tobytes(), [0, *(4 * cut + 4).tolist()]
            end = [*(4 * cut).tolist(), len(data)]
            out.update(zip(some, [data[a:b] for a, b in zip(begin, end)]))
        return out

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        out: list[bytes] = []
        at = size = 0
        for i, text in enumerate(texts):
            if size and size + len(text) > CHARS_AT_ONCE:
                out += self._encode(texts[at:i])
                at, size = i, 0
            size += len(text)
        return out + self._encode(texts[at:])

    def _encode(self, texts: Sequence[str]) -> list[bytes]:
        cut = [[t] if _other_space(t) or self.special(t) else _parts(t) for t in texts]
        known = self.known
        missing = set(chain.from_iterable(cut)).difference(known)
        old = {x: ids for x in missing if (ids := self.older.get(x)) is not None}
        new = self.fresh(list(missing.difference(old)))
        known |= old
        known |= new
        out = [b"".join(map(known.__getitem__, parts)) for parts in cut]
        for x in new:
            if len(x) > CACHED_LENGTH:
                del known[x]
        if len(known) > CACHED:
            self.older, self.known = known, {}
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    hold("tokens", _encoders.clear)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cuts(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter than the capacity."""
    first = n % capacity or min(n, capacity)
    if n:
        yield 0, first
    for start in range(first, n, capacity):
        yield start, capacity


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids.

    ``path``: a file of the tokenizers library.  A null text is an empty one, and each document
    ends with id 0, so that every row gives at least one piece; repeated ids give their own pieces.
    """

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows = []
            for doc_id, encoded in zip(ids, encoder(path).encode([t or "" for t in batch.column("text").to_pylist()])):
                encoded += bytes(4)
                rows += [
                    (doc_id, k, start, n, encoded[4 * start : 4 * (start + n)])
                    for k, (start, n) in enumerate(cuts(len(encoded) // 4, capacity))
                ]
            if rows:
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids"]
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def fullest(lengths: Sequence[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths that leaves least of ``room``; lengths descend.

    Bit s of ``sums`` says that some combination has the sum s.  Each length shifts it once for
    every power of two of its copies; going back through the stages finds one such combination.
    """
    sums, mask, stages = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        if length > room:
            continue
        stages.append((length, sums))
        left, step = min(counts[length], room // length), 1
        while left:
            step = min(step, left)
            sums |= (sums << (step * length)) & mask
            left -= step
            step *= 2
        if sums >> room & 1:
            break
    target, chosen = sums.bit_length() - 1, {}
    for length, before in reversed(stages):
        copies = 0
        while not before >> target & 1:
            target -= length
            copies += 1
        if copies:
            chosen[length] = copies
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(combination, number of bins) until nothing is left."""
    counts = {length: n for length, n in histogram.items() if n}
    ascending = sorted(counts)
    bins = []
    while ascending:
        longest = ascending[-1]
        counts[longest] -= 1
        upto = bisect_left(ascending, capacity - longest + 1)
        some = [x for x in reversed(ascending[:upto]) if counts[x]]
        chosen = fullest(some, counts, capacity - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(counts[x] // k for x, k in chosen.items())
        for x, k in chosen.items():
            counts[x] -= times * k
            if not counts[x]:
                ascending.pop(bisect_left(ascending, x))
        bins.append((chosen, times))
    return bins


def plan_arrays(bins: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """Rows of the plan by (length, number of the first piece): copies a bin, first bin, offset there."""
    used: dict[int, int] = {}
    rows, first_bin = [], 0
    for chosen, times in bins:
        offset = 0
        for length in sorted(chosen, reverse=True):
            copies = chosen[length]
            rows.append((length, used.get(length, 0), copies, first_bin, offset))
            used[length] = used.get(length, 0) + copies * times
            offset += copies * length
        first_bin += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "copies", "bin", "offset"), table.T))


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset, which replace columns of these names.

    ``pieces`` has doc_id, piece and length from 1 to ``capacity``, and is read twice, so it
    should be a written table.  An empty table gives no rows.
    """
    sizes = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    shards = -(-max(sizes.values(), default=1) // SHARD_ROWS)
    shard = F.pmod(F.xxhash64("doc_id", "piece", F.lit(11)), F.lit(shards)).cast("int")
    pieces = pieces.drop("sequence_id", "offset")
    columns = pieces.columns
    own = [c for c in ("_shard", "_local", "_before", "_rank") if c in columns]
    if own:
        raise ValueError(f"column names in use: {own}")
    within = Window.partitionBy("length", "_shard").orderBy("doc_id", "piece")
    ranked = pieces.withColumn("_shard", shard).withColumn("_local", F.row_number().over(within) - 1)
    held = pieces.select("length", shard.alias("_shard")).groupBy("length", "_shard").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("length", "_shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = ranked.join(starts, ["length", "_shard"]).withColumn("_rank", F.col("_before") + F.col("_local"))
    rows = plan_arrays(plan(sizes, capacity))
    shared = pieces.sparkSession.sparkContext.broadcast(rows)

    def compute(batch):
        p = shared.value
        length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
        rank = batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
        # Rows of a length are adjacent; a key of length and rank finds the last row that begins at or before it.
        key = lambda a, b: a.astype(np.float64) * 2.0**40 + b
        at = np.searchsorted(key(p["length"], p["first"]), key(length, rank), side="right") - 1
        nth = rank - p["first"][at]
        return [p["bin"][at] + nth // p["copies"][at], p["offset"][at] + nth % p["copies"][at] * length]

    fields = [("sequence_id", "long"), ("offset", "long")]
    return appended(numbered, fields, compute, keep=columns)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their ids and their places: doc_id, piece, start, length, ids, sequence_id, offset."""
    return place(written(pieces_of(docs, path, capacity), "pieces"), capacity)


def pack_digests(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """As `pack_documents`, with the crc32 of the ids in the place of the ids."""
    digested = pieces_of(docs, path, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(written(digested, "pieces"), capacity)
