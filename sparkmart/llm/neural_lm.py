"""Scoring texts with a log-bilinear neural language model, beside a unigram model.

Word counts are exact and cover all training documents: the most frequent words go to every
task, all others are joined.  The neural model knows the most frequent words, ``<unk>`` for any
other and the end of a text; a word beyond them has the probability of ``<unk>`` times its share
among such words.  The model is trained in numpy by noise-contrastive estimation, in the tasks and on
all training tokens, each place by itself; the parameters of the tasks are averaged between rounds.

Words are cut and counted as UTF-8 bytes, whose ``lower`` and ``split`` know only ASCII letters and white space.

Normalisation is exact.  With two words of context the score of a word is A[h1, w] + B[h2, w],
so that the sum over all words of exp(score), for all contexts at once, is the matrix product
of exp(A) and the transpose of exp(B).
"""

from __future__ import annotations

import math
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import hold, largest_counts, lower_ascii, lower_words, share_of_ids, words_of, written

#: Words that every task knows the counts of, and words of the neural model.
MAX_KNOWN, MAX_VOCABULARY = 2**18, 2046
#: Tokens to expect in the sample, of whole documents, that the first parameters come from; all tokens follow.
SAMPLE_TOKENS = 500_000
#: Rounds of the pass over all training tokens, tokens of a task in a round as long as `MAX_TASKS`
#: are enough (one task adds up the parameters of so many), and tokens that a task holds at a time.
ROUNDS, TASK_TOKENS, MAX_TASKS, TOKENS_AT_ONCE = 4, 1_000_000, 64, 2**18
SIZE, EPOCHS, BATCH, NOISE = 32, 3, 512, 256
SMOOTHING = 0.1
#: Distinct words that a task counts before it passes them on.
COUNTED_AT_ONCE = 300_000


def tokens_of(text: str | None) -> list[str]:
    return words_of(lower_ascii(text)) if text else []


def _strings(words) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; every task adds up its own counts first."""

    def run(batches):
        counts: Counter[bytes] = Counter()

        def out():
            return pa.RecordBatch.from_arrays([_strings(counts.keys()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for words in lower_words(batch.column("text")):
                counts.update(words)
                if len(counts) > COUNTED_AT_ONCE:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    parts = docs.select("text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """Words by falling count; the neural model has the first ``size`` of them, then <unk>, then the end."""

    name: str
    words: list[str]
    counts: np.ndarray
    size: int
    n_tokens: int  # of training, ends included
    n_distinct: int
    n_ends: int

    @property
    def unknown(self) -> int:
        return self.size

    @property
    def end(self) -> int:
        return self.size + 1

    def unigram(self) -> np.ndarray:
        own = self.counts[: self.size].astype(float)
        rest = max(0.0, self.n_tokens - self.n_ends - own.sum())
        return np.concatenate([own, [rest, self.n_ends]])

    def shares(self) -> np.ndarray:
        """The distribution that noise words are drawn from."""
        share = self.unigram() + 1.0
        return share / share.sum()


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    context: np.ndarray  # words x SIZE
    turn: np.ndarray  # 2 x SIZE x SIZE: what the nearer and the farther word contribute
    target: np.ndarray  # words x SIZE
    bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A and B as in the module's docstring, and the log of the sums, by (h1, h2)."""
        a = self.context @ self.turn[0] @ self.target.T + self.bias
        b = self.context @ self.turn[1] @ self.target.T
        top_a, top_b = a.max(axis=1, keepdims=True), b.max(axis=1, keepdims=True)
        sums = np.exp(a - top_a) @ np.exp(b - top_b).T
        return a, b, np.log(sums) + top_a + top_b.T


Parameters = list[np.ndarray]  # context, target, turn and bias, then Adagrad's sums of squares for each


def beginning(vocabulary: Vocabulary, seed: int = 5) -> Parameters:
    rng = np.random.default_rng(seed)
    n = vocabulary.size + 2
    context, target = rng.normal(0, 0.1, (n, SIZE)), rng.normal(0, 0.1, (n, SIZE))
    turn = np.stack([np.eye(SIZE), 0.5 * np.eye(SIZE)])
    own = [x.astype(np.float32) for x in (context, target, turn, np.log(vocabulary.shares()))]
    return [*own, *(np.full_like(x, 0.1) for x in own)]


def stream_of(vocabulary: Vocabulary, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of texts, each with its end, behind two ends each; and the places of what is predicted."""
    pad = np.array([vocabulary.end, vocabulary.end])
    stream = np.concatenate([np.concatenate([pad, t]) for t in texts])
    starts = np.cumsum([0, *(len(t) + 2 for t in texts)])[:-1]
    return stream, np.setdiff1d(np.arange(len(stream)), np.concatenate([starts, starts + 1]), assume_unique=True)


def examples(vocabulary: Vocabulary, stream: np.ndarray, at: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What the places ``at`` tell: word, nearer and farther word before it, and the number of places, at most ``most``."""
    w, h1, h2 = stream[at], stream[at - 1], stream[at - 2]
    if most == 1:
        return w, h1, h2, np.ones(len(at), dtype=np.float32)
    n = vocabulary.size + 2
    keys, found = np.unique((h1 * n + h2) * n + w, return_counts=True)
    times = -(-found // most)
    h1, rest = np.divmod(keys.repeat(times), n * n)
    h2, w = np.divmod(rest, n)
    return w, h1, h2, (found / times).astype(np.float32).repeat(times)


def _alike(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that brings equal keys together, where each key begins in it, and the number of each place's key."""
    order = np.argsort(keys, kind="stable")
    ordered = keys.take(order)
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _added(grad: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows with equal keys, see `_alike`."""
    return np.add.reduceat(grad.take(order, axis=0), first, axis=0)


def learn(
    vocabulary: Vocabulary, parameters: Parameters, stream: np.ndarray, at: np.ndarray, rng: np.random.Generator, most: int = 1
) -> None:
    """Noise-contrastive estimation with Adagrad: one pass over the places ``at``, in random order, up to ``most`` alike as one.

    Every batch shares its noise words, drawn from the unigram distribution; the score of a
    word less the log of its expected number among the noise decides between text and noise.
    What depends on the words before it only is computed once for all places of a batch with these words, and a
    word that is drawn several times once with its number.
    Squares are divided by the mean weight of the batch, so that they add up as in batches of single places.
    """
    context, target, turn, bias, *sums = parameters
    share = vocabulary.shares()
    cumulative = np.cumsum(share)
    log_noise = np.log(NOISE * share).astype(np.float32)
    n = len(share)
    scores = np.empty(BATCH * NOISE, dtype=np.float32)

    def step(x, total, rows, grad, rate, mean):
        squares = total.take(rows, axis=0)
        squares += grad * grad / mean
        total[rows] = squares
        x[rows] -= np.float32(rate) * grad / np.sqrt(squares)

    rng.shuffle(at)
    words, nearer, farther, weights = examples(vocabulary, stream, at, most)
    places = np.arange(len(words)) if most == 1 else rng.permutation(len(words))
    for k in range(0, len(places), BATCH):
        here = places[k : k + BATCH]
        order, first, own = _alike(nearer.take(here) * n + farther.take(here))
        here = here.take(order)
        w, weight, contexts = words.take(here), weights.take(here), here.take(first)
        h1, h2, mean = nearer.take(contexts), farther.take(contexts), weight.mean()
        drawn = np.bincount(np.minimum(np.searchsorted(cumulative, rng.random(NOISE)), n - 1), minlength=n)
        noise = np.flatnonzero(drawn)
        times = drawn.take(noise).astype(np.float32)[:, None]
        r1, r2 = context.take(h1, axis=0), context.take(h2, axis=0)
        predicted = r1 @ turn[0] + r2 @ turn[1]
        wanted, others, each = target.take(w, axis=0), target.take(noise, axis=0), predicted.take(own, axis=0)
        good = (each * wanted).sum(axis=1) + bias.take(w) - log_noise.take(w)
        d_good = (-weight / (1 + np.exp(np.clip(good, -30, 30))))[:, None]
        # In one array: 1 / (1 + exp(-score)); what multiplies a row or a column goes to the smaller arrays
        d_bad = np.matmul(predicted, -others.T, out=scores[: len(first) * len(noise)].reshape(len(first), len(noise)))
        d_bad -= bias.take(noise) - log_noise.take(noise)
        np.clip(d_bad, -30, 30, out=d_bad)
        np.exp(d_bad, out=d_bad)
        d_bad += 1
        np.reciprocal(d_bad, out=d_bad)
        on = np.add.reduceat(weight, first)[:, None]
        d_predicted = np.add.reduceat(d_good * wanted, first, axis=0) + on * (d_bad @ (times * others))
        d_target = np.concatenate([d_good * each, times * (d_bad.T @ (on * predicted))])
        d_bias = np.concatenate([d_good, times * (d_bad.T @ on)])
        d_turn = np.stack([r1.T @ d_predicted, r2.T @ d_predicted])
        d_context = np.concatenate([d_predicted @ turn[0].T, d_predicted @ turn[1].T])
        seen = np.concatenate([w, noise])
        order, first, _ = _alike(seen)
        rows = seen.take(order.take(first))
        step(target, sums[1], rows, _added(d_target, order, first), 0.1, mean)
        step(bias, sums[3], rows, _added(d_bias[:, 0], order, first), 0.1, mean)
        seen = np.concatenate([h1, h2])
        order, first, _ = _alike(seen)
        step(context, sums[0], seen.take(order.take(first)), _added(d_context, order, first), 0.1, mean)
        step(turn, sums[2], np.arange(2), d_turn, 0.02, mean)


def fit(vocabulary: Vocabulary, texts: list[np.ndarray], seed: int = 5) -> Parameters:
    """Where the rounds over all tokens begin; ``texts``: word numbers, each with its end."""
    parameters, rng = beginning(vocabulary, seed), np.random.default_rng(seed)
    if texts:
        stream, at = stream_of(vocabulary, texts)
        for _ in range(EPOCHS):
            learn(vocabulary, parameters, stream, at, rng)
    return parameters


def _mean(batches) -> Iterator[pa.RecordBatch]:
    """The mean of the parameters of at most `MAX_TASKS` tasks, which the driver would have no room for."""
    total, weight = 0.0, 0
    for batch in batches:
        for n, flat in zip(batch.column("n").to_pylist(), batch.column("flat").to_pylist()):
            total, weight = total + n * np.frombuffer(flat, dtype=np.float32).astype(np.float64), weight + n
    if weight:
        yield pa.RecordBatch.from_arrays([pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())], names=["flat"])


def refined(vocabulary: Vocabulary, parameters: Parameters, ids: DataFrame) -> Parameters:
    """Parameters after one pass over all of ``ids`` (id, ids), in `ROUNDS` rounds.

    In a round every task learns from its share of the rows, starting with the same parameters; the
    mean of the tasks' results, by their tokens, is where the next round starts.  Which rows
    a task has, and in which order, follows from the rows alone.
    """
    context = ids.sparkSession.sparkContext
    vocabulary = replace(vocabulary, words=[], counts=vocabulary.counts[: vocabulary.size])  # what the tasks need of it
    tasks = min(MAX_TASKS, -(-vocabulary.n_tokens // (ROUNDS * TASK_TOKENS)))
    shapes, sizes = [x.shape for x in parameters], np.cumsum([x.size for x in parameters])[:-1]
    for number in range(ROUNDS):
        shared = context.broadcast((vocabulary, parameters))

        def run(batches, shared=shared, number=number):
            hold()
            vocabulary, parameters = shared.value[0], [x.copy() for x in shared.value[1]]
            rng = np.random.default_rng([number, TaskContext.get().partitionId()])
            done, texts, waiting = 0, [], 0

            def read():
                stream, at = stream_of(vocabulary, texts)
                learn(vocabulary, parameters, stream, at, rng)
                return len(at)

            for batch in batches:
                for x in batch.column("ids").to_pylist():
                    texts.append(np.frombuffer(x, dtype=np.int16).astype(np.int64))
                    waiting += len(texts[-1])
                    if waiting >= TOKENS_AT_ONCE:
                        done += read()
                        texts, waiting = [], 0
            if texts:
                done += read()
            if done:
                flat = np.concatenate([x.ravel() for x in parameters])
                yield pa.RecordBatch.from_arrays([pa.array([done]), pa.array([flat.tobytes()], pa.binary())], names=["n", "flat"])

        own = ids.where(F.pmod(F.xxhash64("id", "ids"), F.lit(ROUNDS)) == number)
        dealt = own.repartition(tasks, "id", "ids").sortWithinPartitions("id", "ids").coalesce(MAX_TASKS)
        results = written(dealt.mapInArrow(run, "n long, flat binary"), "parameters")
        for row in results.coalesce(1).mapInArrow(_mean, "flat binary").collect():
            mean = np.frombuffer(row["flat"], dtype=np.float32)
            parameters = [x.reshape(shape) for x, shape in zip(np.split(mean, sizes), shapes)]
    return parameters


def model_of(vocabulary: Vocabulary, parameters: Parameters) -> Model:
    context, target, turn, bias = (x.astype(np.float64) for x in parameters[:4])
    return Model(vocabulary, context, turn, target, bias)


_numbers: dict[str, dict[bytes, int]] = {}
_tables: dict[str, tuple] = {}


def _free() -> None:
    _numbers.clear()
    _tables.clear()


def _numbers_of(vocabulary: Vocabulary) -> dict[bytes, int]:
    hold("words", _free)
    if vocabulary.name not in _numbers:
        _numbers.clear()
        _numbers[vocabulary.name] = {w.encode(): i for i, w in enumerate(vocabulary.words)}
    return _numbers[vocabulary.name]


def _tables_of(model: Model) -> tuple:
    if model.vocabulary.name not in _tables:
        _tables.clear()
        _tables[model.vocabulary.name] = tuple(x.astype(np.float32) for x in model.tables())
    return _tables[model.vocabulary.name]


def train(docs: DataFrame, key: str = "doc_id") -> tuple[Model, DataFrame]:
    """The model, and the counts (word, n) of all words of ``docs`` as a written table."""
    context = docs.sparkSession.sparkContext
    counts = written(word_counts(docs), "counts")
    n_ends = docs.count()
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_tokens, n_distinct = (total["n"] or 0) + n_ends, total["v"] + (n_ends > 0)
    top = largest_counts(counts, MAX_KNOWN, "word").toPandas().sort_values(["n", "word"], ascending=[False, True])
    words = top["word"].tolist()
    vocabulary = Vocabulary(
        uuid.uuid4().hex, words, top["n"].to_numpy(dtype=np.int64), min(MAX_VOCABULARY, len(words)), n_tokens, n_distinct, n_ends
    )
    own = context.broadcast(replace(vocabulary, words=words[: vocabulary.size], counts=vocabulary.counts[: vocabulary.size]))

    def run(batches):
        hold()
        v = own.value
        numbers, end = {w.encode(): i for i, w in enumerate(v.words)}, np.int16(v.end).tobytes()
        for batch in batches:
            rows = [array("h", map(numbers.get, words, repeat(v.unknown))).tobytes() + end for words in lower_words(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.binary())], names=["id", "ids"])

    if not n_ends:
        return model_of(vocabulary, beginning(vocabulary)), counts
    ids = written(docs.select(F.col(key).cast("long").alias("id"), "text").mapInArrow(run, "id long, ids binary"), "ids")
    sample = ids.where(share_of_ids("id", 8) < SAMPLE_TOKENS / n_tokens)
    found = sample.toPandas().sort_values(["id", "ids"])
    first = fit(vocabulary, [np.frombuffer(x, dtype=np.int16).astype(np.int64) for x in found["ids"]])
    return model_of(vocabulary, refined(vocabulary, first, ids)), counts


LN10 = math.log(10)


def score(docs: DataFrame, model: Model, counts: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, n_tokens, n_known, train_tokens, base_score, score.

    Null text is empty text, which has its end alone.  Repeated ids keep their rows.  Scores
    are log10 of the text's probability; with nothing to learn from, of the smoothing alone.
    """
    v = model.vocabulary
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches) -> Iterator[pa.RecordBatch]:
        model = shared.value
        v, numbers = model.vocabulary, _numbers_of(model.vocabulary)
        a, b, log_sums = _tables_of(model)
        log_counts = np.log10(v.counts + SMOOTHING)
        for batch in batches:
            texts = list(lower_words(batch.column("text")))
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            found = np.fromiter(map(numbers.get, chain.from_iterable(texts), repeat(-1)), dtype=np.int64, count=sizes.sum())
            ends = np.cumsum(sizes)
            starts = ends - sizes
            per_text = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[np.append(starts, ends[-1:])])
            # With two ends before each text and one after it, every context is in the same array.
            ids = np.insert(np.where((found >= 0) & (found < v.size), found, v.unknown), np.repeat(starts, 2), v.end)
            ids = np.insert(ids, ends + 2 * np.arange(1, len(texts) + 1), v.end)
            shift = 3 * np.arange(len(texts))
            scored = np.ones(len(ids), dtype=bool)
            scored[starts + shift] = scored[starts + shift + 1] = False
            at = np.flatnonzero(scored)
            w, h1, h2 = ids[at], ids[at - 1], ids[at - 2]
            logs = (a[h1, w] + b[h2, w]).astype(np.float64) - log_sums[h1, h2]
            neural = np.add.reduceat(logs, starts + np.arange(len(texts))) / LN10
            base = per_text(np.where(found >= 0, log_counts[found] if len(log_counts) else 0.0, 0.0))
            among = per_text(np.where(found >= v.size, log_counts[found] if len(log_counts) else 0.0, 0.0))
            beyond = per_text((found < 0) | (found >= v.size))
            known = per_text(found >= 0)
            own = batch.column("row").to_numpy()
            empty, n = pa.nulls, len(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("id"), pa.array(sizes + 1), pa.array(known.astype(np.int64)), pa.array(base),
                    pa.array(neural + among), pa.array(beyond.astype(np.int64)), empty(n, pa.string()), empty(n, pa.int64()),
                ],
                names=names,
            )
            rare_rows, rare_words, rare_n = [], [], []
            for i in np.flatnonzero(sizes > known):
                some = Counter(map(texts[i].__getitem__, np.flatnonzero(found[starts[i] : ends[i]] < 0).tolist()))
                rare_rows += [own[i]] * len(some)
                rare_words += some.keys()
                rare_n += some.values()
            n = len(rare_rows)
            if n:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rare_rows, pa.int64()), *(empty(n, t) for t in kinds), _strings(rare_words), pa.array(rare_n, pa.int64())],
                    names=names,
                )

    names = ["row", "id", "n_tokens", "known", "base", "neural", "beyond", "word", "times"]
    schema = "row long, id long, n_tokens long, known long, base double, neural double, beyond long, word string, times long"
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), "text")
    # Written once, since the row numbers hold for one reading only.
    parts = written(numbered.mapInArrow(run, schema), "scored")
    rare = parts.where("word is not null").select("row", "word", "times")
    joined = rare.join(counts.withColumnRenamed("n", "c"), "word", "left")
    log_count = F.log10(F.coalesce("c", F.lit(0)) + SMOOTHING) * F.col("times")
    sums = joined.groupBy("row").agg(F.sum(log_count).alias("rare"), F.sum(F.when(F.col("c") > 0, F.col("times"))).alias("rare_known"))
    zero = lambda name: F.coalesce(name, F.lit(0))
    others = v.unigram()[v.unknown]
    per_token = math.log10(v.n_tokens + SMOOTHING * (v.n_distinct + 1))
    per_other = math.log10(others + SMOOTHING * (max(0, v.n_distinct - v.size - (v.n_ends > 0)) + 1))
    end = math.log10(v.n_ends + SMOOTHING)
    rows = parts.where("word is null").join(sums, "row", "left")
    base: Column = F.col("base") + zero("rare") + end - F.col("n_tokens") * per_token
    return rows.select(
        F.col("id").alias(key),
        "n_tokens",
        (F.col("known") + zero("rare_known") + int(v.n_ends > 0)).cast("long").alias("n_known"),
        F.lit(v.n_tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("neural") + zero("rare") - F.col("beyond") * per_other).alias("score"),
    )
