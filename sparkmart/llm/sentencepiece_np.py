"""SentencePiece encoding and decoding by batched Viterbi in numpy.

Texts are cut into words, before runs of the space mark, which no piece crosses.  Words of equal
length advance together: at each position the hashes of all substrings that end there probe the
sorted keys of the pieces, and a vectorised maximum over the pieces stores the backpointer.

Both kinds of model are exact.  A unigram model maximises the sum of the scores.  A byte-pair
model is defined by merges, not by a sum, and its scores are only the order of the merges; there
a piece may follow another one only if merging would leave the two apart, which makes one
path through the same lattice the result (`BytePairs`).
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import appended, hold

SPACE = "▁"
#: Fixed values of the model format: model kinds and piece kinds.
UNIGRAM, BYTE_PAIRS = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
#: Words remembered in each of two generations, the longest of them, and words encoded at a time.
CACHED, CACHED_LENGTH, AT_ONCE = 200_000, 48, 20_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS, _SEEN_BITS = 20, 21
_FILTER_SHIFT = np.uint64(64 - _FILTER_BITS)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol-buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        elif tag & 7 == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            size = 4 if tag & 7 == 5 else 8
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class Model:
    """A model file.  Character maps and user-defined symbols are not supported and raise."""

    def __init__(self, data: bytes) -> None:
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.kind, self.dummy_prefix, self.squeeze = UNIGRAM, True, True
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                self.pieces.append(own.get(1, b"").decode())
                self.scores.append(float(np.frombuffer(own.get(2, bytes(4)), dtype="<f4")[0]))
                self.kinds.append(own.get(3, NORMAL))
            elif number == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                own = dict(_fields(value))
                if own.get(2):
                    raise ValueError("the model has a character map: normalise texts first, and use a model without")
                self.dummy_prefix, self.squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
        if self.kind not in (UNIGRAM, BYTE_PAIRS) or USER_DEFINED in self.kinds:
            raise ValueError("only unigram and byte-pair models without user-defined symbols are supported")
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes_at = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        usable = [i for i, k in enumerate(self.kinds) if k == NORMAL and self.pieces[i]]
        self.number = {self.pieces[i]: i for i in usable}
        if any(SPACE in p.lstrip(SPACE) for p in self.number):
            raise ValueError("a piece has a space inside")
        self.longest = max(map(len, self.number), default=1)
        hashes = np.array([_hash(p) for p in self.number], dtype=np.uint64)
        order = np.argsort(hashes)
        self.keys = hashes[order]
        self.ids = np.array(list(self.number.values()), dtype=np.int64)[order]
        # Most substrings are no piece: one look at their first bits leaves most of them out.
        self.present = np.zeros(2**_FILTER_BITS, dtype=bool)
        self.present[self.keys >> _FILTER_SHIFT] = True
        self.floor = min((self.scores[i] for i in usable), default=0.0) - UNKNOWN_PENALTY
        self.surface = [self._surface(i) for i in range(len(self.pieces))]

    def _surface(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        if self.kinds[i] == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if self.kinds[i] == CONTROL else self.pieces[i].replace(SPACE, " ").encode()

    def normalized(self, text: str) -> str:
        """Space marks instead of spaces, and one before the text if the model asks for it."""
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return ""
        return ((" " if self.dummy_prefix else "") + text).replace(" ", SPACE)

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 where there is none."""
        out = np.full(hashes.shape, -1, dtype=np.int64)
        maybe = self.present[hashes >> _FILTER_SHIFT]
        some = hashes[maybe]
        if len(some):
            at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
            out[maybe] = np.where(self.keys[at] == some, self.ids[at], -1)
        return out


def _hash(piece: str) -> int:
    value = 0
    for c in piece:
        value = (value * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return value


class BytePairs:
    """Which pieces of a byte-pair model may stand side by side.

    Merging goes by score, best first and then leftmost.  The symbol left of the boundary of two
    pieces grows along the right children of the left piece, the one right of it along the left
    children of the right piece.  The pieces stay apart if no two such symbols, at the time they
    stand side by side, form a piece with a better score than the next merge of either.
    Single characters, known or not, are there from the start.
    """

    def __init__(self, model: Model) -> None:
        n = len(model.pieces)
        self.n = n + 2  # number n: any character that is no piece; n + 1, also as -1: nothing
        self.score = np.full(self.n, np.inf)
        self.left, self.right = np.full(self.n, -1, dtype=np.int64), np.full(self.n, -1, dtype=np.int64)
        self.reached = np.ones(self.n, dtype=bool)
        self.reached[-1] = False
        keys, values = [], []
        for piece, i in model.number.items():
            for k in range(1, len(piece)):
                a, b = model.number.get(piece[:k]), model.number.get(piece[k:])
                if a is not None and b is not None:
                    keys.append(a * self.n + b)
                    values.append(i)
            if len(piece) > 1:
                self.score[i] = model.scores[i]
                last = self._last_merge(model, piece)
                self.reached[i] = last is not None
                self.left[i], self.right[i] = last or (-1, -1)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.values = np.array(values, dtype=np.int64)[order]
        self.merge_score = np.array(model.scores)
        # What was found for pairs before: one place for each, the last pair that came there.
        self.seen = np.full(2**_SEEN_BITS, -1, dtype=np.int64)
        self.seen_apart = np.zeros(2**_SEEN_BITS, dtype=bool)

    @staticmethod
    def _last_merge(model: Model, piece: str) -> tuple[int, int] | None:
        """The two pieces that merging joins last to make ``piece``; None if it never does."""
        parts, last = list(piece), None
        while len(parts) > 1:
            merges = [(-model.scores[m], k) for k in range(len(parts) - 1) if (m := model.number.get(parts[k] + parts[k + 1])) is not None]
            if not merges:
                return None
            k = min(merges)[1]
            last = parts[k], parts[k + 1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        a, b = (model.number.get(x) for x in last)
        return (len(model.pieces) if a is None else a, len(model.pieces) if b is None else b)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves the pieces a and b, side by side, as they are."""
        key = a * self.n + b
        place = (key.astype(np.uint64) * _BASE) >> np.uint64(64 - _SEEN_BITS)
        out = self.seen_apart[place]
        new = np.flatnonzero(self.seen[place] != key)
        out[new] = self._decide(a[new], b[new])
        self.seen[place[new]], self.seen_apart[place[new]] = key[new], out[new]
        return out

    def _decide(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), dtype=bool)
        todo = np.arange(len(a))
        limit, from_left = np.full(len(a), -np.inf), np.zeros(len(a), dtype=bool)
        if not len(self.keys):
            return out
        while len(todo):
            key = a * self.n + b
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            merged = np.where(self.keys[at] == key, self.merge_score[self.values[at]], -np.inf)
            joins = (merged > limit) | ((merged == limit) & ~from_left & (merged > -np.inf))
            out[todo[joins]] = False
            # One step back in time: undo whichever of the two was made later.
            score_a, score_b = self.score[a], self.score[b]
            more = ~joins & ~(np.isinf(score_a) & np.isinf(score_b))
            todo, a, b, score_a, score_b = todo[more], a[more], b[more], score_a[more], score_b[more]
            from_left = score_a < score_b
            limit = np.where(from_left, score_a, score_b)
            a, b = np.where(from_left, self.right[a], a), np.where(from_left, b, self.left[b])
        return out


class Codec:
    def __init__(self, data: bytes) -> None:
        self.model = Model(data)
        self.pairs = BytePairs(self.model) if self.model.kind == BYTE_PAIRS else None
        self.cut = self._cutter(self.model)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _cutter(model: Model):
        """Cuts a normalised text where no piece goes across.

        That is before a run of space marks, and between a letter and a mark that no piece has
        after a letter.  (Two characters of one piece are never cut, and merging is local to a part.)
        """
        after_letter = {b for piece in model.number for a, b in zip(piece, piece[1:]) if a.isalpha()}
        marks = "".join(c for c in ".,!?;:|&%$#*)" if c not in after_letter)
        letters = "A-Za-zÀ-ÖØ-öø-ÿ"
        before_mark = f"{SPACE}*+[{letters}]++(?=[{re.escape(marks)}])|" if marks else ""
        return re.compile(f"{before_mark}{SPACE}*+[^{SPACE}]++|{SPACE}++").findall

    def _equal(self, words: list[str]) -> list[bytes]:
        """Ids of words that all have the same length."""
        model, n, size = self.model, len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(n, size)
        unknown = len(model.pieces)
        score = np.full((n, size + 1), -np.inf)
        score[:, 0] = 0
        last = np.full((n, size + 1), -1, dtype=np.int64)  # the piece that ends here
        back = np.zeros((n, size + 1), dtype=np.int64)
        scores = np.array(model.scores + [model.floor])
        hashes = np.zeros((n, 0), dtype=np.uint64)  # of the substrings that end here, by length
        for j in range(1, size + 1):
            c = codes[:, j - 1].astype(np.uint64) + np.uint64(1)
            # A substring that is one character longer at its end: hash * base + character.
            hashes = np.concatenate([c[:, None], hashes[:, : model.longest - 1] * _BASE + c[:, None]], axis=1)
            piece = model.probe(hashes)
            piece[:, 0] = np.where(piece[:, 0] < 0, unknown, piece[:, 0])
            if self.pairs is not None:
                row, k = np.nonzero(self.pairs.reached[piece])  # number -1 is no piece and is not reached
                found, start = piece[row, k], j - 1 - k
                good = start == 0
                inner = np.flatnonzero(~good)
                good[inner] = self.pairs.apart(last[row[inner], start[inner]], found[inner])
                row = row[good]  # each word once: merging has one result
                last[row, j], back[row, j] = found[good], start[good]
                continue
            row, k = np.nonzero(piece >= 0)
            found, start = piece[row, k], j - 1 - k
            value = score[row, start] + scores[found]
            options = np.full(piece.shape, -np.inf)
            options[row, k] = value
            # The longest piece of those with the best score.
            best = piece.shape[1] - 1 - np.argmax(options[:, ::-1], axis=1)
            rows = np.arange(n)
            score[:, j], last[:, j], back[:, j] = options[rows, best], piece[rows, best], j - 1 - best
        out = []
        for word, ends, starts in zip(words, last.tolist(), back.tolist()):
            ids, j = [], size
            while j:
                i = starts[j]
                ids.append(self._bytes_of(word[i:j]) if ends[j] == unknown else (ends[j],))
                j = i
            out.append(np.fromiter(chain.from_iterable(reversed(ids)), dtype=np.uint32).tobytes())
        return out

    def _bytes_of(self, char: str) -> Sequence[int]:
        model = self.model
        return [model.bytes_at[b] for b in char.encode("utf-8", "surrogatepass")] if model.bytes_at else (model.unknown,)

    def fresh(self, words: list[str]) -> dict[str, bytes]:
        by_length: dict[int, list[str]] = {}
        for word in words:
            by_length.setdefault(len(word), []).append(word)
        out: dict[str, bytes] = {}
        for length, some in by_length.items():
            step = max(1, AT_ONCE * 16 // (length + 16))
            for at in range(0, len(some), step):
                out.update(zip(some[at : at + step], self._equal(some[at : at + step])))
        return out

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit numbers; words seen before are looked up."""
        cut = [self.cut(self.model.normalized(t)) for t in texts]
        wanted = set(chain.from_iterable(cut)).difference(self.known)
        again = {x: self.older[x] for x in wanted.intersection(self.older)}
        new = self.fresh(list(wanted.difference(again)))
        self.known.update(new)
        self.known.update(again)
        out = [b"".join(map(self.known.__getitem__, words)) for words in cut]
        for word in new:
            if len(word) > CACHED_LENGTH:
                del self.known[word]
        if len(self.known) > CACHED:
            self.older, self.known = self.known, {}
        if self.model.bytes_at:
            return out
        return [self._one_unknown(x) for x in out]

    def _one_unknown(self, ids: bytes) -> bytes:
        """Without pieces for bytes, a run of unknown characters is one unknown piece."""
        x = np.frombuffer(ids, dtype=np.uint32)
        odd = x == self.model.unknown
        return x[~(odd & np.concatenate([[False], odd[:-1]]))].tobytes() if len(x) else ids

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        surface = self.model.surface
        text = b"".join([surface[i] for i in np.frombuffer(ids, dtype=np.uint32).tolist()]).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


@functools.lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    with open(path, "rb") as file:
        return Codec(file.read())


def codec(path: str) -> Codec:
    hold("pieces", _codec.cache_clear)
    return _codec(path)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All rows and columns with ``ids``, the ids of the whole text (replacing a column of that name).

    ``path``: a model file that every executor has.  Null text is empty text and has no ids.
    """

    def compute(batch):
        return [pa.array(codec(path).encode([t or "" for t in batch.column(text).to_pylist()]), pa.binary())]

    return appended(docs, [("ids", "binary")], compute)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All rows and columns with ``decoded``, the text of ``ids``; null ids have an empty text."""

    def compute(batch):
        return [[codec(path).decode(x or b"") for x in batch.column("ids").to_pylist()]]

    return appended(encoded, [("decoded", "string")], compute)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, and whether decoding gives the text back.

    Space marks in a text come back as spaces, which is how the format reads them.
    """
    both = decode(encode(docs.select("doc_id", "text"), path), path)
    plain = F.replace(F.coalesce("text", F.lit("")), F.lit(SPACE), F.lit(" "))
    return both.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.length("decoded").cast("long").alias("n_chars"),
        (F.col("decoded") == plain).alias("round_trip"),
    )

