"""Language identification with bit-sliced Bloom filters of character n-grams.

A slot of the filter is a bit mask with one bit for each language.  The AND of the slots that an
n-gram hashes to is the set of all languages that contain it, found in one probe instead of one
for each language.  A text's n-grams are looked up, the bits of each language are counted, the
hits to expect by chance are taken off, and the language with most hits is the prediction.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import appended, code_runs, hold, mixed, share_of_ids

UNKNOWN = "und"
GRAM = 4
SLOT_BITS, PROBES = 21, 3

#: Bound of the training sample: documents of a language to expect in it, whole texts.
SAMPLE_PER_LANGUAGE = 2000
#: An n-gram belongs to a language in which it has this share of all n-grams; so a language
#: has at most 1 / MIN_SHARE of them, whatever the size of the corpus.
MIN_SHARE = 2e-5
#: The share of a language's own training texts that may score below its low score.
LOW_SHARE = 0.05


@dataclass(frozen=True)
class LanguageFilter:
    languages: list[str]
    slots: np.ndarray  # (2 ** SLOT_BITS, bytes of a mask)
    false_rate: np.ndarray  # of each language


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_hashes(texts: list[str]):
    """(hashes, first positions, text numbers) of the n-grams, run by run.

    Text is lower-cased and what is no letter becomes a space; two spaces before and after
    make n-grams of the shortest words too.
    """
    hold()
    padded = [f"  {t.lower()}  " if t else "" for t in texts]
    for codes, starts, numbers in code_runs(padded, overlap=GRAM - 1):
        letters = _letters()[codes]
        clean = np.where(letters, codes, 32).astype(np.uint64)
        n = len(clean) - GRAM + 1
        if n < 1:
            continue
        value = np.zeros(n, dtype=np.uint64)
        some = np.zeros(n, dtype=bool)
        for k in range(GRAM):
            value = (value << np.uint64(16)) ^ (value >> np.uint64(48)) ^ clean[k : k + n]
            some |= letters[k : k + n]
        owner = np.zeros(len(codes), dtype=np.int64)
        owner[starts] = 1
        owner = np.cumsum(owner) - 1
        some &= owner[:n] == owner[GRAM - 1 :]  # not across two texts, and with a letter
        hashes, owner = mixed(value[some]), owner[:n][some]
        if len(hashes):
            own, first = np.unique(owner, return_index=True)
            yield hashes, first, numbers[own]


def _slots_of(hashes: np.ndarray):
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for k in range(PROBES):
        yield ((hashes + np.uint64(k) * step) & np.uint64(2**SLOT_BITS - 1)).astype(np.int64)


def _counted(batch: pa.RecordBatch):
    by_language: dict[str, list[str]] = {}
    for text, language in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
        by_language.setdefault(language, []).append(text)
    for language, texts in by_language.items():
        for hashes, _, _ in gram_hashes(texts):
            grams, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(grams)), pa.array(grams.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"]
            )


def _sample(docs: DataFrame, key: str, per_language: int) -> tuple[list[str], DataFrame]:
    known = docs.select(key, "text", "lang").where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return [], known.select("text", "lang")
    shares = F.create_map(*[F.lit(x) for name in languages for x in (name, per_language / sizes[name])])
    return languages, known.where(share_of_ids(key, 2) < F.element_at(shares, F.col("lang"))).select("text", "lang")


def train(docs: DataFrame, key: str = "doc_id", per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageFilter:
    """Learn from the rows of ``docs`` that have text and lang.

    The sample takes every document whose hashed id is below ``per_language`` / (documents of
    its language); n-grams are counted by Spark, and what comes to the driver is bounded by
    `MIN_SHARE`.  Nothing to learn from gives a filter without languages.
    """
    languages, sample = _sample(docs, key, per_language)
    if not languages:
        return LanguageFilter([], np.zeros((1, 1), dtype=np.uint8), np.zeros(0))
    counts = sample.mapInArrow(lambda batches: (c for b in batches for c in _counted(b)), "lang string, gram long, n long")
    grams = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = grams.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = grams.where("n > 1").join(F.broadcast(totals), "lang").where(F.col("n") >= MIN_SHARE * F.col("total"))
    found = kept.select("lang", "gram").toPandas()
    slots = np.zeros((2**SLOT_BITS, -(-len(languages) // 8)), dtype=np.uint8)
    false_rate = np.zeros(len(languages))
    for i, name in enumerate(languages):
        hashes = found.loc[found["lang"] == name, "gram"].to_numpy().view(np.uint64)
        for at in _slots_of(hashes):
            slots[at, i // 8] |= np.uint8(1 << (i % 8))
        false_rate[i] = ((slots[:, i // 8] >> (i % 8)) & 1).mean() ** PROBES
    return LanguageFilter(languages, slots, false_rate)


def corrected_hits(texts: list[str], model: LanguageFilter) -> tuple[np.ndarray, np.ndarray]:
    """For each text: the hits of each language without the false ones, and the n-grams looked up."""
    hits = np.zeros((len(texts), len(model.languages)))
    total = np.zeros(len(texts))
    for hashes, first, numbers in gram_hashes(texts):
        masks = functools.reduce(np.bitwise_and, (model.slots[at] for at in _slots_of(hashes)))
        np.add.at(total, numbers, np.diff(np.append(first, len(hashes))))
        for i in range(len(model.languages)):
            bits = (masks[:, i // 8] >> np.uint8(i % 8)) & np.uint8(1)
            np.add.at(hits[:, i], numbers, np.add.reduceat(bits, first, dtype=np.int64))
    expected = total[:, None] * model.false_rate
    return np.maximum(hits - expected, 0) / (1 - np.minimum(model.false_rate, 0.999)), total


def predict(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """All rows with lang_pred and score, which replace columns of these names.

    The score is the share of the text's n-grams that the predicted language contains.  A text
    that is null or has no letter is `UNKNOWN` with score 0, as is every text if nothing was
    learned.  Equal hits go to the language first in the alphabet.  A text's letters alone decide.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch):
        model, texts = shared.value, [t or "" for t in batch.column("text").to_pylist()]
        if not model.languages:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts)]
        hits, total = corrected_hits(texts, model)
        best = hits.argmax(axis=1)
        score = np.clip(hits[np.arange(len(texts)), best] / np.maximum(total, 1), 0, 1)
        names = [model.languages[i] if n else UNKNOWN for i, n in zip(best, total)]
        return [names, np.where(total > 0, score, 0.0)]

    return appended(docs, [("lang_pred", "string"), ("score", "double")], compute)


def low_scores(docs: DataFrame, model: LanguageFilter) -> dict[str, float]:
    """By language, the score that `LOW_SHARE` of all its texts stay below, those taken for another language aside.

    Scores compare within a language only: with thousands of letters hardly any n-gram is
    frequent enough for the filter, so that the best texts of such a language score low.
    """
    if not model.languages:
        return {}
    known = docs.select("text", "lang").where("text is not null and lang is not null")
    own = predict(known, model).where("lang_pred = lang")
    return {r["lang"]: r["low"] for r in own.groupBy("lang").agg(F.percentile_approx("score", LOW_SHARE).alias("low")).collect()}
