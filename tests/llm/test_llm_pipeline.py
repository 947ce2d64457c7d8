"""The registered queries of the package against SQL, and the pipeline stage by stage."""

from __future__ import annotations

import collections
import random
import re

import __spark_entry__ as contract
import compare
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import common, jaccard, langid, oracle, pu_quality, queries, secrets

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    numbers = collections.Counter(re.match(r"op(\d+)_", n).group(1) for n in queries.QUERIES)
    assert numbers == collections.Counter(str(n) for n in range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries())
    assert set(oracle.SQL) <= set(contract.oracle_sql()) and "pipeline" not in contract.oracle_sql()


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_against_sql(spark, name):
    assert compare.difference(contract.queries()[name](spark, SF), compare.connect(SF), oracle.SQL[name]) is None


@pytest.mark.parametrize(
    "name,columns",
    [
        ("op2_language_id", "doc_id:bigint held_out:boolean lang_pred:string score:double"),
        ("op3_quality_pu", "doc_id:bigint held_out:boolean score:double predicted:int"),
        ("op5_sentencepiece", "doc_id:bigint n_pieces:bigint ids_crc32:bigint n_chars:bigint round_trip:boolean"),
        ("op6_best_fit_packing", "doc_id:bigint piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint"),
        ("op7_ngram_jaccard", "doc_id:bigint n_shingles:bigint component_id:bigint"),
        ("op9_secret_scan", "doc_id:bigint n_assign:bigint n_access:bigint n_hex:bigint base_sha256:string spans:string"),
        ("op10_lm_score", "doc_id:bigint held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double"),
    ],
)
def test_query_shape(spark, name, columns):
    found = contract.queries()[name](spark, SF)
    assert dict(found.dtypes) == dict(c.split(":") for c in columns.split())
    documents = common.table(spark, SF, "documents").count()
    assert found.select("doc_id").distinct().count() == documents
    assert found.count() == documents or name == "op6_best_fit_packing"


def as_rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_stages(spark):
    docs = common.written(common.table(spark, SF, "documents").withColumns({"score": F.lit(7), "document": F.lit("x")}), "test")
    everything = as_rows(docs)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.written(stage(spark, docs, SF), "test")
        if number < 4:
            assert out.columns == docs.columns, name
        before, after = docs.collect(), out.collect()
        if name == "language":
            found = langid.predict(docs.select("doc_id", "text"), langid.train(docs)).collect()
            good = {r["doc_id"] for r in found if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.MIN_LANGUAGE_SCORE}
            assert as_rows(out) == as_rows(docs.where(F.col("doc_id").isin(list(good)))) and len(after) > 0.95 * len(before)
        if name == "quality":
            model = pu_quality.train(docs, common.table(spark, SF, "labels"))
            good = {r["doc_id"] for r in pu_quality.classify(docs.select("doc_id", "text"), model).collect() if r["predicted"]}
            assert as_rows(out) == as_rows(docs.where(F.col("doc_id").isin(list(good)))) and 0 < len(after) < len(before)
        if name == "near_duplicates":
            found = jaccard.link_components(docs).collect()
            assert sorted(r["doc_id"] for r in after) == sorted({r["component_id"] for r in found})
            assert not as_rows(out) - everything
        if name == "mask_secrets":
            texts = {r["doc_id"]: r["text"] for r in after}
            assert {r["doc_id"]: secrets.masked(r["text"], "[SECRET]") for r in before} == texts
            assert all(r["n_chars"] == len(r["text"]) for r in after if "[SECRET]" in r["text"])
        if name == "pack":
            assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
            ends = collections.Counter()
            for r in after:
                ends[r["sequence_id"]] += r["length"]
            assert max(ends.values()) <= 2048
        docs = out


def test_stages_with_odd_rows(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, lang_pred string"
    rows = [(None, None, None, None, None, "a"), (1, "", "en", "s", 0, "b"), (2, "the same text for all", "en", "s", 21, "c")]
    rows += [(2, "The same text for all", None, "s", 21, "d"), (2, "the same text for all", "en", "s", 21, "c"), (3, "the same text for all", "en", None, 21, "e")]
    docs = spark.createDataFrame(rows, kind)
    sizes = []
    for _, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, SF), "test")
        sizes.append(docs.count())
    assert sizes[0] == 4 and sizes[2] == (1 if sizes[1] else 0)
    empty = spark.createDataFrame([], kind)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_language_with_thousands_of_letters(spark):
    """Clean texts of a large alphabet stay, although hardly any of their n-grams is frequent; gibberish goes."""
    rng = random.Random(6)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    words = ["".join(rng.choices(letters, k=rng.randint(1, 3))) for _ in range(6000)]
    zipf = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, "".join(rng.choices(words, zipf, k=300)), "zh") for i in range(400)]
    rows += [(1000 + i, " ".join(rng.choices(["the", "cat", "sat", "on", "a", "mat", "today"], k=60)), "en") for i in range(100)]
    rows += [(2000 + i, "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=300)), None) for i in range(100)]
    kept = corpus_pipeline.language(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), SF)
    found = collections.Counter(r["lang"] for r in kept.collect())
    assert found["zh"] >= 396 and found["en"] == 100 and found[None] <= 2


def test_near_duplicates_with_repeated_ids(spark):
    """Rows of one id are judged each by its own text, and wordless rows of one id all stay."""
    text = lambda c: " ".join(f"{c}{i}" for i in range(40))
    rows = [(2, text("b")), (5, text("b")), (5, text("c")), (5, text("d")), (5, text("d")), (7, text("d")), (8, " "), (8, " "), (8, None), (None, text("b"))]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert as_rows(kept) == collections.Counter([rows[0], rows[2], rows[3], *rows[6:]])


def test_quality_labels_of_documents_only(spark):
    """Labels of documents that are not in the table count for nothing."""
    docs = common.table(spark, SF, "documents").where("doc_id % 2 = 0")
    labels = common.table(spark, SF, "labels").select("doc_id", "quality")
    more = spark.range(10**6, 10**6 + 500).select(F.col("id").alias("doc_id"), F.lit(0).cast(labels.schema["quality"].dataType).alias("quality"))
    own = labels.join(docs, "doc_id", "left_semi")
    assert pu_quality.train(docs, labels.unionByName(more)).prior == pu_quality.train(docs, own).prior


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
