"""URL filter: host and path rules, and a character language-model ratio where no rule fits.

The URLs that the rules decide train two Markov models, of accepted and of rejected URLs.  Their order
varies: a context of up to ``ORDER`` characters is a state if the URLs show it often enough, and the
probabilities of a state are smoothed with those of its longest proper suffix.  The states make an
automaton with bounded tables, so a URL is scored within its row: no shuffle of characters, no join.
Everything here is a Spark expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import written

ALLOW, BLOCK = "allow", "block"

#: The symbols that URLs are read as: lower-case letters, 0 for any digit, marks, * for all else; the last one ends a URL.
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0/.-_?=&#%:~+@*$"
START = "^"

#: Longest context; most states, the most frequent ones; weight of the shorter context in the smoothing.
ORDER, STATES, WEIGHT = 4, 4096, 4.0

#: One URL in so many calibrates the threshold instead of training; scores are told apart by 1 / ``STEPS``.
CALIBRATION, STEPS, FARTHEST = 5, 100, 10

_A = len(SYMBOLS)


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, and for the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rest(url: Column) -> Column:
    """What follows the first ``://``; empty for null, or without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(after: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), upper, upper.lower())


def path_of(after: Column) -> Column:
    return F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column, wanted: str = "text") -> Column:
    """Of the rules that fit, the text (or verdict) of the longest; of equally long ones the longer host, then the blocking one."""
    order = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != BLOCK, r.text))
    fits = [(F.concat(F.lit("."), host).endswith("." + r.host) & path.startswith(r.path), F.lit(getattr(r, wanted))) for r in order]
    return F.coalesce(*(F.when(fit, told) for fit, told in fits), F.lit(None).cast("string"))


def coded(after: Column) -> Column:
    """A URL in the symbols of the models, with its end."""
    known = r"[^a-z0/.\-_?=&#%:~+@]"
    return F.concat(F.regexp_replace(F.regexp_replace(F.lower(after), "[0-9]", "0"), known, "*"), F.lit("$"))


def gram_counts(urls: DataFrame) -> DataFrame:
    """context, symbol, allowed, blocked: how often a symbol follows a context of 0 to ``ORDER`` symbols.

    ``urls``: symbols, verdict.  A row per character is summed by its longest context within the map tasks;
    the shorter ones are summed from what is distinct then.
    """
    text = F.concat(F.lit(START), F.col("symbols"))
    ends = F.sequence(F.lit(2), F.length(text))
    grams = F.transform(ends, lambda i: F.substring(text, F.greatest(F.lit(1), i - ORDER), F.least(i, F.lit(ORDER + 1))))
    longest = urls.select("verdict", F.explode(grams).alias("gram")).groupBy("gram").agg(
        F.count(F.when(F.col("verdict") == ALLOW, 1)).alias("allowed"), F.count(F.when(F.col("verdict") == BLOCK, 1)).alias("blocked")
    )
    lengths = F.sequence(F.lit(1), F.length("gram"))
    suffix = F.explode(F.transform(lengths, lambda k: F.substring(F.col("gram"), F.length("gram") - k + 1, k)))
    every = longest.select(suffix.alias("gram"), "allowed", "blocked")
    return every.groupBy(
        F.expr("substring(gram, 1, length(gram) - 1)").alias("context"), F.expr("right(gram, 1)").alias("symbol")
    ).agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))


def train(urls: DataFrame) -> DataFrame:
    """The automaton as one row: ``start`` state, ``moves`` and ``ratios`` by state and symbol, and ``ready``.

    A state is one of the ``STATES`` most frequent contexts.  A part of a context is at least as frequent and
    shorter, so it is a state too: the state after a symbol then follows from the state before it.
    ``ready`` is false unless there are URLs of both verdicts.
    """
    counts = written(gram_counts(urls), "url-grams")
    contexts = counts.groupBy("context").agg(F.sum(F.col("allowed") + F.col("blocked")).alias("n"))
    most = contexts.orderBy(F.desc("n"), F.length("context"), "context").limit(STATES).select("context")
    number = (F.row_number().over(Window.orderBy(F.length("context"), "context")) - 1).alias("state")
    states = written(most.select("context", number), "url-states")

    symbols = F.array(*map(F.lit, SYMBOLS))

    def by_symbol(column: str, nothing: Column) -> Column:
        entries = F.map_from_entries(F.collect_list(F.struct("symbol", column)))
        return F.transform(symbols, lambda s: F.coalesce(F.element_at(entries, s), nothing))

    seen = counts.join(states, "context").groupBy("context", "state").agg(
        *(by_symbol(c, F.lit(0).cast("long")).alias(c) for c in ("allowed", "blocked"))
    )
    # The state that a context becomes with one more symbol, where that is a state itself
    longer = states.where("context <> ''").select(
        F.expr("substring(context, 1, length(context) - 1)").alias("context"), F.expr("right(context, 1)").alias("symbol"), F.col("state").alias("child")
    )
    children = longer.where(F.col("symbol") != START).groupBy("context").agg(by_symbol("child", F.lit(None).cast("int")).alias("children"))
    none = F.array_repeat(F.lit(None).cast("int"), _A)
    table = written(seen.join(children, "context", "left").withColumn("children", F.coalesce("children", none)), "url-contexts")

    def smoothed(c: str, shorter: Column) -> Column:
        total = F.aggregate(F.col(c), F.lit(0).cast("long"), lambda x, y: x + y)
        return F.zip_with(F.col(c), shorter, lambda n, p: (n + F.lit(WEIGHT) * p) / (total + F.lit(WEIGHT)))

    even = F.array_repeat(F.lit(1.0 / _A), _A)
    moved = F.transform("children", lambda x: F.coalesce(x, F.lit(0)))
    root = table.where("context = ''").select("context", "state", smoothed("allowed", even).alias("a"), smoothed("blocked", even).alias("b"), moved.alias("moves"))
    levels = [root]
    for k in range(1, ORDER + 1):
        shorter = levels[-1].select(F.col("context").alias("suffix"), F.col("a").alias("sa"), F.col("b").alias("sb"), F.col("moves").alias("sm"))
        level = table.where(F.length("context") == k).withColumn("suffix", F.expr("substring(context, 2)")).join(shorter, "suffix")
        next_state = F.zip_with("children", "sm", lambda own, other: F.coalesce(own, other))
        levels.append(level.select("context", "state", smoothed("allowed", F.col("sa")).alias("a"), smoothed("blocked", F.col("sb")).alias("b"), next_state.alias("moves")))
    whole = levels[0]
    for level in levels[1:]:
        whole = whole.unionByName(level)
    ratio = F.zip_with("a", "b", lambda x, y: F.log(x) - F.log(y))
    in_order = F.array_sort(F.collect_list(F.struct("state", "moves", ratio.alias("ratios"))))
    start = F.max(F.when(F.col("context") == START, F.col("state")))
    both = urls.agg(F.count_if(F.col("verdict") == ALLOW).alias("n_allowed"), F.count_if(F.col("verdict") == BLOCK).alias("n_blocked"))
    model = whole.agg(
        F.coalesce(start, F.lit(0)).alias("start"), F.flatten(F.transform(in_order, lambda s: s["moves"])).alias("moves"),
        F.flatten(F.transform(in_order, lambda s: s["ratios"])).alias("ratios"),
    )
    ready = both.select(((F.col("n_allowed") > 0) & (F.col("n_blocked") > 0)).alias("ready"))
    return written(model.withColumn("ready", ready.scalar()), "url-model")


def log_ratios(urls: DataFrame, model: DataFrame) -> DataFrame:
    """``urls`` with ``score``: log-likelihood of ``symbols`` as accepted less that as rejected, by length.

    0 from a model that is not ready.  The tables of the model are scalar subqueries: each task has them once,
    as constants, and no row carries them, as the optimizer puts the subqueries where their columns are used.
    """
    tables = {f"{c} of the model": model.select(c).scalar() for c in ("start", "moves", "ratios", "ready")}
    start, moves, ratios, ready = (F.col(f"`{c}`") for c in tables)
    codes = F.transform(F.split("symbols", ""), lambda s: F.call_function("instr", F.lit(SYMBOLS), s))
    first = F.struct(start.alias("state"), F.lit(0.0).alias("sum"))

    def step(at: Column, code: Column) -> Column:
        place = at["state"] * _A + code
        return F.struct(F.element_at(moves, place).alias("state"), (at["sum"] + F.element_at(ratios, place)).alias("sum"))

    score = F.when(ready, F.aggregate(codes, first, step, lambda at: at["sum"]) / F.length("symbols")).otherwise(0.0)
    return urls.select("*", *(c.alias(name) for name, c in tables.items())).select(*(F.col(f"`{c}`") for c in urls.columns), score.alias("score"))


def threshold(scored: DataFrame) -> float:
    """The least score of an accepted URL: where the shares of both kinds that are decided rightly are largest together.

    Where no score lies between the two kinds there, it is the middle of the gap.

    ``scored``: score, verdict.  Counts by score come to one task, ``2 * FARTHEST * STEPS`` at most.
    0, where both kinds are equally likely, unless there are URLs of both kinds.
    """
    step = F.greatest(F.lit(-FARTHEST * STEPS), F.least(F.lit(FARTHEST * STEPS), F.floor(F.col("score") * STEPS))).alias("step")
    of = scored.groupBy(step).agg(F.count_if(F.col("verdict") == ALLOW).alias("a"), F.count_if(F.col("verdict") == BLOCK).alias("b"))
    below, all_steps = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rates = of.select(
        "step", F.coalesce(F.lag("step").over(Window.orderBy("step")) + 1, "step").alias("above"), F.sum("a").over(all_steps).alias("na"), F.sum("b").over(all_steps).alias("nb"),
        F.coalesce(F.sum("a").over(below), F.lit(0)).alias("lost"), F.coalesce(F.sum("b").over(below), F.lit(0)).alias("caught"),
    ).where("na > 0 AND nb > 0")
    best = rates.orderBy(F.desc(F.col("caught") * F.col("na") - F.col("lost") * F.col("nb")), "step").limit(1).collect()
    return (best[0]["above"] + best[0]["step"]) / (2 * STEPS) if best else 0.0


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule and verdict of every row, and the score that decided where no rule fits.

    ``pages``: page_id, url; other columns play no part, and every row, also a repeated one, gives one.
    A null url is an empty one; without ``://`` host and path are empty, and the models read an
    empty text.  A long url is read whole.  Where the rules decide no URL or only one kind of them, the score is 0 and
    all others are allowed.  An empty table gives no rows.
    """
    after = rest(F.coalesce(F.col("url").cast("string"), F.lit("")))
    split = pages.select("page_id", after.alias("rest"))
    split = split.select("*", host_of(F.col("rest")).alias("host"), path_of(F.col("rest")).alias("path"), coded(F.col("rest")).alias("symbols"))
    rule, ruled = (longest_rule(rules, F.col("host"), F.col("path"), c) for c in ("text", "verdict"))
    told = split.select("*", rule.alias("rule"), ruled.alias("ruled"))
    labelled = told.where(F.col("ruled").isNotNull()).select("symbols", F.col("ruled").alias("verdict"))
    calibrates = F.crc32(F.col("symbols").cast("binary")) % CALIBRATION == 0
    model = train(labelled.where(~calibrates))
    least = threshold(log_ratios(labelled.where(calibrates), model))
    decided = F.when(F.col("score") < least, BLOCK).otherwise(ALLOW)
    return log_ratios(told, model).select("page_id", "host", "path", "rule", F.coalesce("ruled", decided).alias("verdict"), "score")
