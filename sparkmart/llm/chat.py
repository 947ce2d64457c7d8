"""Chat formatting with Spark expressions: turns to one training text, its loss mask, and back.

Template: a run of adjacent turns of one role is merged under one header::

    ### user: first text</turn>second text</turn>
    ### assistant: answer</turn>

Control strings inside a text or role are escaped by ``\\`` and a letter, and ``\\`` itself
first of all; so a marker in the output is always one that the template wrote, and replacing
the codes in reverse order restores every text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER, AFTER_ROLE, END, BETWEEN_RUNS = "### ", ": ", "</turn>", "\n"
#: In the order of escaping; a role's colon is escaped too, since a colon ends the role.
TEXT_CODES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
ROLE_CODES = (*TEXT_CODES, (":", "\\c"))
LOSS_ROLE = "assistant"


def _replaced(value: Column, codes) -> Column:
    for old, new in codes:
        value = F.replace(value, F.lit(old), F.lit(new))
    return value


def escaped(value: Column, codes=TEXT_CODES) -> Column:
    return _replaced(value, codes)


def unescaped(value: Column, codes=TEXT_CODES) -> Column:
    return _replaced(value, [(new, old) for old, new in reversed(codes)])


def format_conversations(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start, length in code points).

    ``turns`` has conv_id, turn, role, text; other columns are ignored.  A null text or role
    is an empty one.  Turns are in the order of ``turn``, null first; rows with the same turn
    are ordered by role and text, and all are kept, repeated rows as well.  Rows with a null
    conv_id form one conversation of that id.  An empty table gives no rows.  The loss mask
    covers the escaped text of every turn of ``loss_role`` and no marker.

    A conversation is one output text, so its rows meet in one task by nature; nothing else does.
    """
    none = F.lit("")
    rows = turns.select("conv_id", F.struct("turn", F.coalesce("role", none).alias("role"), F.coalesce("text", none).alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        before = F.get(F.col("turns"), i - 1)["role"]
        header = F.concat(F.lit(HEADER), escaped(t["role"], ROLE_CODES), F.lit(AFTER_ROLE))
        merged = (i > 0) & (before == t["role"])
        head = F.when(merged, none).when(i == 0, header).otherwise(F.concat(F.lit(BETWEEN_RUNS), header))
        return F.struct(head.alias("head"), escaped(t["text"]).alias("body"), (t["role"] == loss_role).alias("loss"))

    def advance(state: Column, p: Column) -> Column:
        start = state["at"] + F.length(p["head"])
        span = F.struct(start.alias("start"), F.length(p["body"]).alias("length"))
        spans = F.when(p["loss"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((start + F.length(p["body"]) + len(END)).alias("at"), spans.alias("spans"))

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    return sorted_turns.select("conv_id", F.transform("turns", piece).alias("pieces")).select(
        "conv_id",
        F.concat(
            F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""), F.lit(BETWEEN_RUNS)
        ).alias("formatted"),
        F.aggregate("pieces", nothing, advance, lambda state: state["spans"]).alias("loss_spans"),
    )


def parse_formatted(formatted: DataFrame) -> DataFrame:
    """Back from text and mask: conv_id, turns (array of role and text), loss_text, formatted."""

    def read_run(run: Column) -> Column:
        role = F.substring_index(run, AFTER_ROLE, 1)
        rest = F.substring(run, F.length(role) + len(AFTER_ROLE) + 1, F.length(run))
        texts = F.split(rest, END, -1)  # what follows the last end marker is no text
        name = unescaped(role, ROLE_CODES)
        return F.transform(
            F.slice(texts, F.lit(1), F.size(texts) - 1), lambda x: F.struct(name.alias("role"), unescaped(x).alias("text"))
        )

    runs = F.split("formatted", HEADER, -1)
    under_mask = F.transform(
        "loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))
    )
    return formatted.select(
        "conv_id",
        F.flatten(F.transform(F.slice(runs, F.lit(2), F.size(runs)), read_run)).alias("turns"),
        F.array_join(under_mask, "").alias("loss_text"),
        "formatted",
    )


def digests(parsed: DataFrame) -> DataFrame:
    """Counts and digests of what was read back from the output."""
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
