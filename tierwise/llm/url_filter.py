"""URL verdicts: domain rules, then naive Bayes over segmented names.

A rule names a domain and the beginning of a path; the longest rule that fits
decides.  Other URLs are judged by their words.  Host names run words
together, so each label is split by unigram Viterbi: the word frequencies are
those of the labels and path parts of all pages (a word counts once per
host), with a floor for :data:`LEXICON`; unknown pieces cost by length.
Multinomial naive Bayes then scores the words of host and path.  Its training
rows are all hosts: blocked ones are those with a word of :data:`SPAM`.

Words are counted over all pages, map-side first, and a host's words are
distinct before they are counted, so a host with a third of all pages weighs
as one.  The model is stored tables and holds every word, whatever the size of
the input (the splitter's dictionary: those of two hosts or more).  Each
distinct name is split once; splits and log odds are joined to names, and the
scores to URLs, by broadcasts up to :data:`BROADCAST_ROWS` rows (counted),
beyond by shuffles.  A larger dictionary is joined to the substrings of the
names that have the length of a known word.  Names of any length are split.

Defined cases: a null URL or one without ``://`` has empty host and path, no
rule and the verdict allow; equal URLs get equal verdicts, repeated rows come back
each; an empty table gives an empty result; extra columns of any name come back
as they were.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm import common

BROADCAST_ROWS = 200_000
PRIOR_BLOCK = 0.1
SMOOTHING = 0.5
#: Counts that each word of the lexicons has besides those of the corpus.
LEXICON_COUNT, SEED_COUNT = 20.0, 20.0

#: (verdict, host, path): block or allow the domain below this path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

# Words that mark unwanted sites.
SPAM = ("adult ads bet bets betting bonus casino cheap click clicks coupon crack crypto dating discount escort "
        "farm forex free gamble gambling hack jackpot keygen loan loans lottery malware mortgage naked nude payday "
        "phish phishing pills pharma poker popup porn prize promo replica rolex serial sex sexy slots spam "
        "torrent track tracker tracking viagra warez win winner xxx").split()
# Words of ordinary sites.
ORDINARY = ("about academy archive art article articles blog book books city club college company council data docs "
            "education events forum garden guide health help history home house journal learn library life local "
            "magazine mail map media museum music news online page people photo post press project radio research "
            "review school science shop society sport sports store stories study support tech times today travel tv "
            "university web wiki work world").split()
LEXICON = frozenset(SPAM) | frozenset(ORDINARY)


def parts(pages: DataFrame) -> DataFrame:
    """``pages`` with ``_host`` and ``_path``."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    found = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, found, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumn("_host", host).withColumn("_path", F.regexp_extract(url, found, 2))


def rule_verdict(host: Column, path: Column) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    out = None
    for verdict, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out


def split_words(label: str, priced: list[tuple[int, int, float]], unknown: float) -> list[str]:
    """Cheapest split of a label: words at their cost, any other piece at
    ``unknown`` and as much again for every two characters.  ``priced``: start,
    end and cost of the known words in it."""
    ending: dict[int, list[tuple[int, float]]] = {}
    for start, end, price in priced:
        ending.setdefault(end, []).append((start, price))
    best, back = [0.0] + [math.inf] * len(label), [0] * (len(label) + 1)
    open_, since = math.inf, 0  # the cheapest way that ends in an unknown piece, and its start
    for end in range(1, len(label) + 1):
        begun = best[end - 1] + unknown * 1.5
        open_ += unknown / 2
        if begun < open_:
            open_, since = begun, end - 1
        best[end], back[end] = open_, since
        for start, price in sorted(ending.get(end, ())):
            if best[start] + price <= best[end]:
                best[end], back[end] = best[start] + price, start
    out, end = [], len(label)
    while end:
        out.append(label[back[end]:end])
        end = back[end]
    return out[::-1]


_LETTERS = re.compile(r"[^\W\d_]+")


def _url_names(hosts: DataFrame) -> DataFrame:
    """The names in each host and path: ``id``, ``_host``, ``at``, ``name``,
    ``own`` (part of the host).  The path itself stays behind: a long one has
    many names."""
    @F.pandas_udf("array<struct<name:string,own:boolean>>")
    def names(host: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([[{"name": n, "own": True} for n in _LETTERS.findall(h.rsplit(".", 1)[0] if "." in h else h)]
                          + [{"name": n, "own": False} for n in _LETTERS.findall(p.lower())] for h, p in zip(host, path)], dtype=object)

    return hosts.select("id", "_host", F.posexplode(names("_host", "_path")).alias("at", "n")).select("id", "_host", "at", "n.*")


def _costs(hosts: DataFrame) -> tuple[DataFrame, float]:
    """Viterbi costs (``word``, ``cost``; stored) and that of unknown pieces,
    from the words that hosts and paths separate themselves: a word counts once
    per host; a host's own labels only where another host or a path has them
    too, else every name would be a word."""
    words = hosts.select("_host", F.explode(F.filter(F.split(F.lower("_path"), r"[^\p{L}]+"), lambda w: F.length(w) > 1)).alias("word"))
    labels = hosts.select("_host", F.explode(F.filter(F.split("_host", r"[^\p{L}]+"), lambda w: F.length(w) > 1)).alias("word"))
    counted = (words.unionByName(labels).distinct().groupBy("word").agg(F.count("*").cast("double").alias("n")).where("n > 1"))
    lexicon = hosts.sparkSession.createDataFrame([(w, LEXICON_COUNT) for w in sorted(LEXICON)], "word string, n double")
    counts = common.stored(counted.unionByName(lexicon).groupBy("word").agg(F.sum("n").alias("n")), "url-words")
    total = counts.agg(F.sum("n")).first()[0]
    return counts.select("word", (-F.log(F.col("n") / total)).alias("cost")), math.log(total) + 1.0


def _split(names: DataFrame, costs: DataFrame, unknown: float) -> DataFrame:
    """``name`` and ``words`` of distinct names; stored."""
    lengths = sorted(r[0] for r in costs.select(F.length("word")).distinct().collect())
    if costs.count() <= BROADCAST_ROWS:
        shared = names.sparkSession.sparkContext.broadcast({r["word"]: r["cost"] for r in costs.collect()})

        @F.pandas_udf("array<string>")
        def by_dictionary(name: pd.Series) -> pd.Series:
            cost, out = shared.value, []
            for label in name:
                pieces = ((i, i + n, cost.get(label[i:i + n])) for n in lengths for i in range(len(label) - n + 1))
                out.append(split_words(label, [p for p in pieces if p[2] is not None], unknown))
            return pd.Series(out, dtype=object)

        return common.stored(names.select("name", by_dictionary("name").alias("words")), "url-names")

    @F.pandas_udf("array<string>")
    def by_pieces(name: pd.Series, priced: pd.Series) -> pd.Series:
        return pd.Series([split_words(n, [(x["start"], x["end"], x["cost"]) for x in p], unknown) for n, p in zip(name, priced)], dtype=object)

    fit = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("name"))
    pieces = (names.select("name", F.explode(fit).alias("n"))
              .select("name", "n", F.explode(F.sequence(F.lit(0), F.length("name") - F.col("n"))).alias("start"))
              .select("name", "start", (F.col("start") + F.col("n")).alias("end"), F.col("name").substr(F.col("start") + 1, F.col("n")).alias("word")))
    priced = pieces.join(costs, "word").groupBy("name").agg(F.collect_list(F.struct("start", "end", "cost")).alias("priced"))
    none = F.array().cast("array<struct<start:int,end:int,cost:double>>")
    return common.stored(names.join(priced, "name", "left").select("name", by_pieces("name", F.coalesce("priced", none)).alias("words")), "url-names")


def _odds(words: DataFrame) -> DataFrame:
    """``word`` and ``odds`` of ``_host``, ``word``, ``spam`` (a word of SPAM in
    the host itself); stored."""
    named = words.groupBy("_host").agg(F.max("spam").alias("block"))
    seeds = words.sparkSession.createDataFrame(
        [(w, SEED_COUNT, 0.0) for w in SPAM] + [(w, 0.0, SEED_COUNT) for w in ORDINARY], "word string, b double, a double")
    seen = (words.select("_host", "word").distinct().join(named, "_host").groupBy("word")
            .agg(F.sum(F.col("block").cast("double")).alias("b"), F.sum((~F.col("block")).cast("double")).alias("a")))
    counts = common.stored(seen.unionByName(seeds).groupBy("word").agg(F.sum("b").alias("b"), F.sum("a").alias("a")), "url-odds")
    size, nb, na = counts.agg(F.count("*"), F.sum("b"), F.sum("a")).first()
    return counts.select("word", (F.log((F.col("b") + SMOOTHING) / (nb + SMOOTHING * size))
                                  - F.log((F.col("a") + SMOOTHING) / (na + SMOOTHING * size))).alias("odds"))


def scores(pages: DataFrame) -> DataFrame:
    """``_host``, ``_path``, ``words`` and ``spam_odds`` (prior left out) of
    every distinct host and path that has names; stored."""
    every = common.stored(parts(pages).select("_host", "_path").distinct().withColumn("id", F.monotonically_increasing_id()), "urls")
    urls = common.stored(_url_names(every), "names-of-urls")
    costs, unknown = _costs(every.where("_host <> ''"))
    split = _split(urls.select("name").distinct(), costs, unknown)
    words = (urls.where("_host <> ''").join(common.fit_to_broadcast(split, BROADCAST_ROWS), "name")
             .select("_host", "words", (F.col("own") & F.arrays_overlap("words", F.array(*map(F.lit, SPAM)))).alias("spam")))
    odds = _odds(words.select("_host", F.explode("words").alias("word"), "spam"))
    weighed = (split.select("name", F.posexplode("words").alias("k", "word"))
               .join(common.fit_to_broadcast(odds, BROADCAST_ROWS), "word", "left").groupBy("name")
               .agg(F.sort_array(F.collect_list(F.struct("k", "word", F.coalesce("odds", F.lit(0.0)).alias("odds")))).alias("w")))
    weighed = common.stored(weighed, "url-weights")
    by_url = (urls.select("id", "at", "name").join(common.fit_to_broadcast(weighed, BROADCAST_ROWS), "name").groupBy("id")
              .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "w"))), lambda x: x["w"])).alias("w")))
    return common.stored(by_url.join(every, "id").select("_host", "_path", F.transform("w", lambda x: x["word"]).alias("words"),
                                       F.aggregate("w", F.lit(0.0), lambda s, x: s + x["odds"]).alias("spam_odds")), "url-scores")


def judge(pages: DataFrame) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``words`` and
    ``spam_odds`` (log odds, prior included) in place of like-named columns."""
    prior = math.log(PRIOR_BLOCK / (1 - PRIOR_BLOCK))
    keep = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "words", "spam_odds")]
    # The caller's columns travel as one struct, so that none can clash.
    rows = parts(pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row"), F.col("url")))
    scored = common.fit_to_broadcast(scores(pages.select("url")), BROADCAST_ROWS).select(
        F.col("_host").alias("_h"), F.col("_path").alias("_p"), "words", "spam_odds")
    found = rows.join(scored, (F.col("_host") == F.col("_h")) & (F.col("_path") == F.col("_p")), "left")
    odds = F.lit(prior) + F.coalesce("spam_odds", F.lit(0.0))
    step = found.select("_row", "_host", "_path", odds.alias("_odds"), rule_verdict(F.col("_host"), F.col("_path")).alias("_rule"),
                        F.coalesce("words", F.array().cast("array<string>")).alias("_words"))
    own = F.when(F.col("_odds") > 0, "block").otherwise("allow")
    step = step.select("_row", F.struct(
        F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", own).alias("verdict"), F.col("_words").alias("words"), F.col("_odds").alias("spam_odds")).alias("_found"))
    return step.select(*[F.col("_row").getField(c).alias(c) for c in keep], "_found.*")
