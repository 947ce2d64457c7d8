"""Chat formatting, line rules, language, quality, secrets: against plain Python."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import chat, common, langid, line_rules, pu_quality, secrets

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Chat formatting ---------------------------------------------------------

TRICKY = ["", "\\", "\\b", "\\h", "###", "####", "### user: x</turn>", "</turn", "<</turn>", "a\nb", "\\### Assistant: </turn> ok", "é😀", "\\t\\\\t"]


def test_chat_round_trip(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "system", "a: b", "#", "### x", None])
            text = None if rng.random() < 0.1 else "".join(rng.choice(TRICKY) for _ in range(rng.randrange(3)))
            rows.append((conv if conv else None, rng.choice([turn, turn, None, 3]), role, text, "x"))
    rows += rows[:5]  # repeated rows
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.digests(chat.parse_formatted(chat.format_conversations(table))).collect()}
    want = collections.defaultdict(list)
    for conv, turn, role, text, _ in rows:
        want[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(turns), sha(said), len(loss), sha(loss))


def test_chat_merges_same_role(spark):
    table = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    row = chat.format_conversations(table).first()
    assert row["formatted"] == "### user: a</turn>b</turn>\n### assistant: c</turn>\n"
    assert [(s["start"], s["length"]) for s in row["loss_spans"]] == [(row["formatted"].index("c</turn>"), 1)]
    assert chat.format_conversations(table.limit(0)).count() == 0


# Line rules --------------------------------------------------------------


def base(text):
    text = text or ""
    words = re.findall(common.WORD, text)
    lines = [x for x in text.split("\n") if re.search(common.WORD, x)]
    grams = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    symbols = sum(c in line_rules.SYMBOLS for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_line_counts(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t", "one", "a b", "a b c", "a b c a b c", "\x0b\x0ca b"]
    for _ in range(80):
        texts.append("".join(rng.choice(["a", "b", "cc", "é|", "#", "."]) + rng.choice([" ", "\n", " \t"]) for _ in range(rng.randrange(200))))
    texts.append("word " * 30_000)
    rows = [(i % 70, t, 1) for i, t in enumerate(texts)]
    got = line_rules.clean_lines(spark.createDataFrame(rows, DOC + ", n_words int")).collect()
    seen = collections.Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got)
    assert seen == collections.Counter((i, *base(t)) for i, t, _ in rows)
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert line_rules.clean_lines(spark.createDataFrame([], DOC)).count() == 0


def test_line_verdict(spark):
    sentences = [" ".join(f"w{i}x{j}" for j in range(12)) + "." for i in range(8)]
    clean = "\n".join(sentences)
    menu = "\n".join(" | ".join(f"m{i}x{j}" for j in range(12)) for i in range(8))
    notice = clean + "\nAll rights reserved."
    got = {r["doc_id"]: r for r in line_rules.clean_lines(spark.createDataFrame([(1, clean), (2, menu), (3, notice)], DOC)).collect()}
    assert [got[i]["kept"] for i in (1, 2, 3)] == [True, False, True]
    assert got[3]["cleaned"] == clean and got[2]["cleaned"] == ""


# Language ----------------------------------------------------------------


@pytest.fixture(scope="module")
def documents(spark):
    return common.table(spark, SF, "documents").cache()


def test_language(spark, documents):
    held = common.fold("doc_id", 4) == 2
    model = langid.train(documents.where(~held))
    found = langid.predict(documents.withColumn("score", F.lit("x")), model)  # a clashing name is replaced
    right = found.where(held).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    assert found.columns.count("score") == 1 and found.where("score < 0 or score > 1").count() == 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 .. 34"), (4, "the " * 300_000), (None, "der die das und")], DOC)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(odd, model).collect()}
    assert got == {1: "und", 2: "und", 3: "und", 4: "en", None: "de"}
    nothing = langid.train(documents.where("false"))
    assert {r["lang_pred"] for r in langid.predict(odd, nothing).collect()} == {"und"}


def test_language_hits_follow_sets():
    """The bit-sliced filter gives the memberships of plain sets, but for false positives."""
    model_sets = {"a": ["abcd", "bcde"], "b": ["bcde", "xxxx"]}
    slots = np.zeros((2**langid.SLOT_BITS, 1), dtype=np.uint8)
    for i, texts in enumerate(model_sets.values()):
        for hashes, _, _ in langid.gram_hashes(texts):
            for at in langid._slots_of(hashes):
                slots[at, 0] |= np.uint8(1 << i)
    model = langid.LanguageFilter(["a", "b"], slots, np.zeros(2))
    hits, total = langid.corrected_hits(["abcd", "bcde", "", "zzzz"], model)
    assert total.tolist() == [5, 5, 0, 5]
    assert hits[0, 0] == 5 and hits[1].tolist() == [5, 5] and hits[3].sum() == 0


# Quality -----------------------------------------------------------------


def test_quality(spark, documents):
    labels = common.table(spark, SF, "labels")
    held = common.fold("doc_id", 4) == 2
    model = pu_quality.train(documents.where(~held), labels.where(~held))
    scored = pu_quality.classify(documents, model).where(held).join(labels, "doc_id")
    right = scored.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0]
    assert right > 0.93
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "a" * 500_000), (3, "b c")], DOC)
    rows = pu_quality.classify(odd, model).collect()
    assert len(rows) == 4 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert pu_quality.train(documents, labels.where("false")) is None
    assert {r["score"] for r in pu_quality.classify(odd, None).collect()} == {1.0}
    assert pu_quality.classify(odd.limit(0), model).count() == 0


# Secrets -----------------------------------------------------------------


def test_secret_patterns(spark):
    key = "AKIA" + "Q7" * 8
    rows = [
        (1, None), (2, ""), (3, f"x {key}."), (4, "password = hunter22 and secret: abc"), (5, "deadbeef" * 5),
        (6, "API_KEY:'aB3dE5gH7jK9mN1pQ3sT'"), (7, "passwort=abcdefgh apikey=12345678"), (7, "ſecret=abcdefgh"), (None, "é token==abcdefgh"),
    ]
    got = secrets.scan(spark.createDataFrame([(*r, "z") for r in rows], DOC + ", spans string")).collect()
    counts = [(r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"]) for r in got]
    assert sorted(counts, key=str) == sorted([(1, 0, 0, 0), (2, 0, 0, 0), (3, 0, 1, 0), (4, 1, 0, 0), (5, 0, 0, 1), (6, 1, 0, 0), (7, 1, 0, 0), (7, 0, 0, 0), (None, 1, 0, 0)], key=str)
    assert {r["doc_id"]: r["base_sha256"] for r in got}[3] == sha(f"access:2:{2 + len(key)}")
    assert {r["doc_id"]: r["base_sha256"] for r in got}[None] == sha("assign:2:17")
    assert secrets.scan(spark.createDataFrame([], DOC)).count() == 0


def test_entropy_windows():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("abcdef0123456789XYZ") for _ in range(rng.randrange(20, 60)))
        marked = set()
        for i in range(len(text) - secrets.WINDOW + 1):
            counts = collections.Counter(text[i : i + secrets.WINDOW])
            entropy = -sum(n / secrets.WINDOW * math.log2(n / secrets.WINDOW) for n in counts.values())
            if entropy >= 3.5 - 1e-9:
                marked |= set(range(i, i + secrets.WINDOW))
        assert {k for a, b in secrets.high_windows(text, 3.5) for k in range(a, b)} == marked


def test_entropy_leaves_words_alone():
    rng = random.Random(3)
    random_key = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(40))
    assert secrets.entropy_spans("send " + random_key + " now") != []
    for text in ("Donaudampfschifffahrtsgesellschaftskapitaen", "123456789012345678901234567890", "550e8400-e29b-41d4-a716-446655440000", "aaaaaaaaaaaaaaaaaaaaaaaaa1"):
        assert secrets.entropy_spans(text) == []


def test_entropy_of_what_separators_join():
    """A prefix changes nothing for the secret behind it, and neither does a harmless part beside it."""
    rng = random.Random(5)
    found = {"": 0, "sig=": 0}
    for _ in range(300):
        key = "".join(rng.choices("0123456789abcdef", k=26))
        for prefix in found:
            found[prefix] += bool(secrets.entropy_spans(prefix + key))
    assert found["sig="] >= found[""] > 290
    key = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=40))
    for text in ("example/" + key, key + "_12345678", "550e8400-e29b-41d4-a716-446655440000=" + key):
        marked = {i for a, b, _ in secrets.entropy_spans(text) for i in range(a, b)}
        assert set(range(text.index(key), text.index(key) + 40)) <= marked
    for text in ("sha256-" + key + "abc=", "docs/example/getting-started-guide-for-2021", "550e8400-e29b-41d4-a716-446655440000"):
        assert secrets.entropy_spans(text) == []


def test_redact(spark):
    docs = spark.createDataFrame([(1, "password=hunter22 ok", 20, "a"), (2, None, 5, "b"), (3, "fine", 99, "c")], "doc_id long, text string, n_chars long, mask string")
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["mask"]) for r in secrets.redact(docs).collect()}
    assert got == {1: ("[SECRET] ok", 11, "a"), 2: (None, 5, "b"), 3: ("fine", 99, "c")}


def test_fold(spark):
    rows = spark.createDataFrame([(5,), (123,), (-7,)], "doc_id long").select("doc_id", common.fold("doc_id", 4).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["doc_id"]).encode()) % 4 for r in rows)
