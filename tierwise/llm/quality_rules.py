"""Quality rules as weak supervision.

Each rule looks for one defect, or for one mark of sound prose, and votes bad
(-1) or good (1) on a text, or abstains (0).  How far each vote can be trusted is not
assumed but estimated: expectation-maximisation over the counts of vote
patterns finds, for good and for bad texts, how often each rule votes and
abstains, and the share of good texts.  A text's posterior probability of
being good decides: it is kept if it passes the base limits and that
probability is at least 0.5.

Features and votes take one pass over the texts.  Only the counts of vote
patterns (at most 2**rules rows, whatever the input) take part in the
iterations, each a DataFrame aggregate that returns one row of parameters.

A rule is held to be better than chance: its vote always counts at least
:data:`LEAST_RATIO` to 1 for its side.  Estimates are smoothed by
:data:`PRIOR_WEIGHT` votes at the starting values, so that on a corpus without bad texts no
arbitrary part is rejected.

Defined cases: a null, blank or empty text has no words and fails the base
limits; equal texts get equal verdicts whatever the other columns hold; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm import common

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
ITERATIONS = 20
#: Starting values: share of good texts; how often a rule votes on texts of
#: its side and of the other side.
START_GOOD = 0.9
START_RIGHT, START_WRONG = {-1: 0.3, 1: 0.8}, {-1: 0.01, 1: 0.4}
LEAST_RATIO = 1.5
PRIOR_WEIGHT = 5.0
KEEP_FROM = 0.5

# Frequent words of English, German, French and Spanish.
STOP_WORDS = ("the of and to in that is was for it with as on be at by this are from or an not "
              "der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch für "
              "de la le et les des en un du une que est pour qui dans par pas sur au il "
              "el los y del se las con una su lo como al no es").split()


def _count(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` next to the features of ``text``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    step = docs.select(*[F.col(f"`{c}`") for c in keep], text.alias("_text"))
    step = step.select("*", common.words(F.col("_text")).alias("_words"),
                       F.filter(F.split("_text", "\n"), lambda l: F.btrim(l, F.lit(common.BLANKS)) != "").alias("_lines"))
    step = step.select(
        *step.columns, F.size("_words").cast("long").alias("n_words"),
        F.array_join("_words", "").alias("_solid"), F.transform("_words", lambda w: F.xxhash64(w)).alias("_hash"))
    eight = lambda i: F.xxhash64(*[F.get("_hash", i + k) for k in range(WINDOW)])
    windows = F.when(F.col("n_words") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("_hash") - WINDOW), eight))
    step = step.select(*[c for c in step.columns if c != "_hash"],
                       F.coalesce(windows, F.array().cast("array<bigint>")).alias("_windows"))
    # Windows in order of hash: equal neighbours are repeats.
    ranked = F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"),
                    F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    step = step.select(*[c for c in step.columns if c != "_windows"], ranked.alias("_ranked"))
    same = lambda k, m: F.coalesce(F.get("_ranked", k)["h"] == F.get("_ranked", m)["h"], F.lit(False))
    found = F.sort_array(F.transform(F.filter("_ranked", lambda w, k: same(k, k - 1) | same(k, k + 1)), lambda w: w["i"]))
    step = step.select(*[c for c in step.columns if c != "_ranked"], found.alias("_at"))
    covered = F.aggregate(
        F.transform("_at", lambda a, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", k + 1) - a, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda s, x: s + x)
    stops = F.size(F.filter("_words", lambda w: w.isin(STOP_WORDS)))
    return step.select(
        *[F.col(f"`{c}`") for c in keep], "n_words", F.length("_solid").cast("long").alias("word_chars"),
        _count(F.col("_text"), r"[#*$%&|<>]+").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("_n_lines"),
        _count(F.col("_solid"), r"\p{Lu}+").alias("_upper"), _count(F.col("_solid"), r"!+").alias("_bangs"),
        _count(F.col("_solid"), r"[0-9]+").alias("_digits"),
        F.regexp_count("_solid", F.lit(r"([^\p{L}\p{N}])\1+")).cast("long").alias("_runs"),
        F.size(F.filter("_words", lambda w: F.length(w) == 1)).cast("long").alias("_lone"), stops.cast("long").alias("_stops"))


def rules() -> dict[str, tuple[int, Column]]:
    """Rule name -> its side (-1 or 1) and when it votes, over the columns of
    :func:`features`."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbols": (-1, F.col("n_symbols") > 0.25 * words),
        "repeated_windows": (-1, 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        "repeated_lines": (-1, 2 * F.col("n_dup_lines") > F.col("_n_lines")),
        "capitals": (-1, F.col("_upper") > 0.4 * chars),
        "exclamations": (-1, F.col("_bangs") > 0.3 * words),
        "digits": (-1, F.col("_digits") > 0.4 * chars),
        "word_length": (-1, (chars < 2 * words) | (chars > 14 * words)),
        "punctuation_runs": (-1, F.col("_runs") > 0.2 * words),
        "lone_characters": (-1, F.col("_lone") > 0.3 * words),
        "stop_words": (1, F.col("_stops") * 20 >= words),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _posterior(model: dict[str, float], sides: dict[str, int]) -> Column:
    """Probability of a good text, from vote columns and the model's literals."""
    odds = math.log(model["good"] / (1 - model["good"]))
    out = F.lit(odds)
    for r in sides:
        g, b = model[f"good_{r}"], model[f"bad_{r}"]
        out = out + F.when(F.col(r) != 0, math.log(g / b)).otherwise(math.log((1 - g) / (1 - b)))
    return 1 / (1 + F.exp(-out))


def fit(patterns: DataFrame, sides: dict[str, int]) -> dict[str, float]:
    """EM over ``patterns`` (vote columns and ``count``): the share of good
    texts and how often each rule votes on good and on bad ones."""
    start = {"good": START_GOOD}
    for r, side in sides.items():
        start[f"good_{r}"] = (START_RIGHT if side > 0 else START_WRONG)[side]
        start[f"bad_{r}"] = (START_WRONG if side > 0 else START_RIGHT)[side]
    model = start
    for _ in range(ITERATIONS):
        step = (patterns.withColumn("_good", F.col("count") * _posterior(model, sides))
                .withColumn("_bad", F.col("count") - F.col("_good")))
        got = step.agg(F.sum("_good").alias("good"), F.sum("_bad").alias("bad"),
                       *[F.sum(F.when(F.col(r) != 0, F.col(f"_{k}"))).alias(f"{k}_{r}") for r in sides for k in ("good", "bad")]).first()
        n = {k: got[k] or 0.0 for k in ("good", "bad")}
        model = {"good": (n["good"] + PRIOR_WEIGHT * START_GOOD) / (n["good"] + n["bad"] + PRIOR_WEIGHT)}
        for r, side in sides.items():
            rate = {k: ((got[f"{k}_{r}"] or 0.0) + PRIOR_WEIGHT * start[f"{k}_{r}"]) / (n[k] + PRIOR_WEIGHT) for k in n}
            right, wrong = ("good", "bad") if side > 0 else ("bad", "good")
            rate[wrong] = min(rate[wrong], rate[right] / LEAST_RATIO)
            model |= {f"{k}_{r}": v for k, v in rate.items()}
    return model


def judge(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the features, ``base_failed``,
    ``quality`` (posterior) and ``kept``."""
    votes = {f"vote_{r}": F.when(on, side).otherwise(0) for r, (side, on) in rules().items()}
    sides = {f"vote_{r}": side for r, (side, _) in rules().items()}
    scored = features(docs, keep).select("*", *[v.alias(n) for n, v in votes.items()])
    scored = common.stored(scored.drop("_n_lines", "_upper", "_bangs", "_digits", "_runs", "_lone", "_stops"), "votes")
    patterns = common.stored(scored.groupBy(*sides).count().orderBy(*sides).coalesce(1), "patterns")
    model = fit(patterns, sides)
    return (scored.withColumn("base_failed", base_failed()).withColumn("quality", _posterior(model, sides))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM)))


def good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep.  Columns are those of ``docs``."""
    keyed = docs.select(F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_key"), F.col("doc_id").alias("key"))
    bad = judge(keyed, ["key", "text_key"]).where("not kept").select(F.col("key").alias("_d"), F.col("text_key").alias("_t")).distinct()
    return common.without(docs, common.stored(bad, "rejected"))
