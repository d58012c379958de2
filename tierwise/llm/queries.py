"""The registered queries of this package: name -> (query, oracle SQL).

Each query applies one operator, with its production parameters, to its whole
table and derives the digest columns of its contract from the operator's
output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm import (
    decontaminate, importance, language_id, line_dedup, near_dup, quality_rules, secret_scan, site_style_tree,
    source_mix, suffix_tree, token_rollup, url_filter, whitening,
)
from tierwise.llm.common import table
from tierwise.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op8_near_duplicates")
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


# Sources by code point, null last, weigh 3, 1, 2 in turn; their targets share
# 150 % of all words, each at most twice its source's.  Copies are taken in
# order of (cumulative words of the source) / target.
@register("op2_source_mix", r"""
WITH sized AS (
    SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                           lambda w: w <> ''))::BIGINT AS size
    FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
    SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight,
           row_number() OVER (ORDER BY source NULLS LAST) AS rk
    FROM per),
levels AS (
    SELECT *, ((sum(source_size) OVER () * 3)::DOUBLE / 2
               - coalesce(sum(2 * source_size) OVER (ORDER BY (2 * source_size)::DOUBLE / weight, rk
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
              / (sum(weight) OVER (ORDER BY (2 * source_size)::DOUBLE / weight, rk
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
    FROM ranked),
water AS (SELECT max(level) AS level FROM levels WHERE level * weight <= 2 * source_size),
goal AS (
    SELECT l.source, l.source_size, least(w.level * l.weight, (2 * l.source_size)::DOUBLE) AS target
    FROM levels l, water w),
flow AS (
    SELECT s.*, g.source_size, g.target,
           sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(s.doc_id::VARCHAR) ROWS UNBOUNDED PRECEDING) AS run
    FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
copies AS (
    SELECT doc_id, size, copy, (run + copy * source_size)::DOUBLE / target AS finish
    FROM flow, (VALUES (0), (1)) v(copy) WHERE size > 0),
queue AS (
    SELECT *, sum(size) OVER (ORDER BY finish, doc_id NULLS LAST, copy ROWS UNBOUNDED PRECEDING) AS used FROM copies),
taken AS (
    SELECT doc_id, sum(size)::BIGINT AS taken FROM queue
    WHERE used <= (SELECT sum(size) * 3 // 2 FROM sized) GROUP BY doc_id)
SELECT f.doc_id, f.size, f.source_size, f.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM flow f LEFT JOIN taken t ON f.doc_id = t.doc_id""")
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


# Exact containment of every item in every document, by text: shingles of five
# words; of items with fewer words, all their words in a row.
@register("op9_decontamination", r"""
WITH worded AS (
    SELECT 'd' AS side, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'),
                                                  lambda w: w <> '') AS w FROM documents
    UNION ALL
    SELECT 'i', item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'),
                                     lambda w: w <> '') FROM benchmark),
widths AS (SELECT DISTINCT least(len(w), 5) AS width FROM worded WHERE side = 'i' AND len(w) > 0),
sets AS (
    SELECT DISTINCT side, id, width, unnest(list_transform(range(1, len(w) - width + 2),
                                                           lambda i: array_to_string(w[i:i + width - 1], ' '))) AS s
    FROM worded, widths WHERE len(w) >= width AND (side = 'd' OR width = least(len(w), 5))),
sizes AS (SELECT id, width, count(*) AS n FROM sets WHERE side = 'i' GROUP BY ALL)
SELECT d.id AS doc_id, i.id AS item_id, any_value(z.n)::BIGINT AS n_item_shingles, count(*)::BIGINT AS n_common,
       count(*) / any_value(z.n)::DOUBLE AS containment
FROM sets d JOIN sets i ON d.s = i.s AND d.width = i.width AND d.side = 'd' AND i.side = 'i'
     JOIN sizes z ON z.id = i.id AND z.width = i.width
GROUP BY d.id, i.id, i.width HAVING count(*) * 10 >= any_value(z.n) * 8""")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item_shingles", "n_common", "containment")


# Chunks end after a line where the hash over two line hashes is 0 modulo 3,
# and around lines of 50 words; later occurrences of a chunk go.
@register("op10_line_dedup", r"""
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
marks AS (
    SELECT *, len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) >= 50 AS long,
           ('0x' || md5(lag(md5(line)) OVER w || md5(line))[1:8])::BIGINT % 3 = 0 AS ends
    FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
starts AS (
    SELECT *, i = 1 OR long OR lag(long) OVER w OR coalesce(lag(ends) OVER w, false) AS begins
    FROM marks WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
cuts AS (
    SELECT *, sum(begins::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS c FROM starts),
chunks AS (
    SELECT doc_id, c, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n, bool_or(long) AS long
    FROM cuts GROUP BY doc_id, c),
judged AS (
    SELECT *, (n >= 2 OR long) AND regexp_matches(text, '[^\x20\x09-\x0D]')
              AND row_number() OVER (PARTITION BY text ORDER BY doc_id, c) > 1 AS gone
    FROM chunks),
put AS (
    SELECT doc_id, coalesce(string_agg(text, chr(10) ORDER BY c) FILTER (NOT gone), '') AS text,
           sum(n)::INT AS n_lines, coalesce(sum(n) FILTER (gone), 0)::INT AS n_removed
    FROM judged GROUP BY doc_id)
SELECT d.doc_id, p.text, coalesce(p.n_lines, 0)::INT AS n_lines, coalesce(p.n_removed, 0)::INT AS n_removed
FROM documents d LEFT JOIN put p ON d.doc_id = p.doc_id""")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


# All later occurrences of runs of lines with more than 50 words: the step that
# the pipeline takes before the chunks above.
@register("op10_repeated_runs")
def op10_repeated_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "quality")


@register("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secrets(table(spark, sf_dir, "documents")))


@register("op6_url_filter")
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "spam_odds")


# All documents come in; those labelled quality 0 are deleted; English ones
# are recounted without digits-only words by a second tokenizer version; the
# deletes are sent twice and count once.
@register("op7_token_counts", r"""
WITH counted AS (
    SELECT d.doc_id, source, lang, l.quality IS NOT DISTINCT FROM 0 AS gone,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id),
final AS (
    SELECT source, lang, CASE WHEN lang = 'en' THEN 'words-2' ELSE 'words-1' END AS tokenizer,
           CASE WHEN lang = 'en' THEN len(list_filter(w, lambda x: NOT regexp_full_match(x, '[0-9]+'))) ELSE len(w) END AS n
    FROM counted WHERE NOT gone)
SELECT source, lang, tokenizer, count(*)::BIGINT AS documents, sum(n)::BIGINT AS tokens
FROM final GROUP BY source, lang, tokenizer""")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    w = token_rollup.common.words(F.col("text"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", w.alias("w"))
    docs = token_rollup.common.stored(docs.select(
        "doc_id", "source", "lang", F.size("w").cast("long").alias("first"),
        F.size(F.filter("w", lambda x: ~x.rlike("^[0-9]+$"))).cast("long").alias("second"))
        .join(quality, "doc_id", "left"), "counts")
    one, two = ("words-1", F.col("first")), ("words-2", F.col("second"))
    dropped = docs.where("quality = 0")
    ledger = token_rollup.Ledger(spark, scratch_path(spark, "ledger"))
    ledger.commit("1-insert", token_rollup.change(docs, None, one))
    ledger.commit("2-delete", token_rollup.change(dropped, one, None))
    ledger.commit("3-recount", token_rollup.change(docs.where("lang = 'en' and (quality is null or quality <> 0)"), one, two))
    ledger.commit("2-delete", token_rollup.change(dropped, one, None))
    return ledger.totals()


@register("op3_suffix_tree")
def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scores(table(spark, sf_dir, "documents"))


@register("op4_html_extraction")
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = site_style_tree.extract(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


@register("op11_language_id")
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language_id.held_out(F.col("doc_id"), 3, 1)
    model = language_id.learn(docs.where(~held).select("text", "lang"))
    return language_id.identify(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")


@register("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), "embedding")
    # The exact deviation, where it fits the contract's long.
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


@register("op13_importance_resampling")
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
