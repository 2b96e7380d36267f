"""Quality rules from document statistics and cross-document line frequency (built-in functions only).

A line is frequent for a host when, after normalising (lower case, white space
runs to one space, trimmed), it occurs in at least ``min_docs`` different texts
of that host AND next to at least ``min_contexts`` different pairs of
neighbouring lines. The second condition tells boilerplate (the same line in
ever new surroundings) from copies of a document (the same surroundings every
time), so large groups of near copies don't reject one another. Frequent lines
are removed; a document left with fewer than ``min_words`` words or less than
``min_share`` of its words is depleted and rejected.

Defined cases: null or empty text has no words and is rejected by the base rule;
a null host is a host of its own; exact copies within a host count as one text;
repeated rows get the same verdict; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.store import checkpointed

WHITE = " \t\n\x0b\f\r"
WHITE_RE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_DOCS = 20
MIN_CONTEXTS = 10
MIN_SHARE = 0.25


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _has_word(line: Column) -> Column:
    return F.length(F.translate(line, WHITE, "")) > 0


def base_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``_hk`` untouched if listed there, and the per-document counts of the base rules."""
    t = F.col("_t")
    at = docs.select(*keep, _text(text).alias("_t"))
    at = at.select(
        *keep,
        F.filter(F.split(t, WHITE_RE), lambda w: w != "").alias("_w"),
        F.length(F.translate(t, WHITE, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(t, "\n"), _has_word).alias("_l"))
    stats = [*keep, "word_chars", "n_symbols", "n_words", "n_dup_lines"]
    at = at.select(
        *keep, "word_chars", "n_symbols", F.size("_w").cast("long").alias("n_words"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    windows = F.when(F.size("_h") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("_h") - (WINDOW - 1), F.lit(1))),
        lambda i: F.xxhash64(F.slice("_h", i, WINDOW)))).otherwise(F.array().cast("array<long>"))
    at = at.select(*stats, windows.alias("_v"))
    # Only texts that repeat a window at all pay for sorting their windows.
    ordered = F.when(F.size(F.array_distinct("_v")) < F.size("_v"), F.array_sort(F.transform(
        "_v", lambda v, i: F.struct(v.alias("v"), i.alias("i")))))
    at = at.select(*stats, ordered.alias("_s"))
    at = at.select(*stats, F.array_sort(F.transform(F.filter("_s", lambda s, j: F.coalesce(
        s["v"] == F.get("_s", j - 1)["v"], F.lit(False)) | F.coalesce(
        s["v"] == F.get("_s", j + 1)["v"], F.lit(False))), lambda s: s["i"])).alias("_p"))
    covered = F.aggregate(F.transform("_p", lambda p, j: F.least(
        F.lit(WINDOW), F.coalesce(F.get("_p", j + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    at = at.select(*stats, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    return at.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _text_key(text: str, host: str) -> Column:
    return F.xxhash64(_text(text), F.lit("@"), F.col(host))


def _lines(docs: DataFrame, text: str, host: str) -> DataFrame:
    """One row per line with a word of each different text of a host: _hk, _key (host and line), _pos, _ctx, _n (words)."""
    at = docs.select(_text_key(text, host).alias("_hk"), F.col(host).alias("_host"),
                     F.split(_text(text), "\n").alias("_l"))
    at = at.select("_hk", "_host", F.transform("_l", lambda x: F.trim(
        F.regexp_replace(F.lower(x), WHITE_RE, " "))).alias("_l"))
    at = at.select("_hk", F.filter(F.transform("_l", lambda x, i: F.struct(
        F.xxhash64(x, F.lit("@"), F.col("_host")).alias("key"), i.alias("pos"),
        F.when(x == "", 0).otherwise(F.length(x) - F.length(F.translate(x, " ", "")) + 1).alias("n"))),
        lambda s: s["n"] > 0).alias("_l"))
    at = at.select("_hk", F.explode(F.transform("_l", lambda s, i: F.struct(
        s["key"].alias("key"), s["pos"].alias("pos"), s["n"].alias("n"),
        F.xxhash64(F.coalesce(F.get("_l", i - 1)["key"], F.lit(0)),
                   F.coalesce(F.get("_l", i + 1)["key"], F.lit(1))).alias("ctx")))).alias("_x"))
    return at.groupBy("_hk", F.col("_x.key").alias("_key"), F.col("_x.pos").alias("_pos")).agg(
        F.min("_x.ctx").alias("_ctx"), F.min("_x.n").alias("_n"))


def frequent_lines(lines: DataFrame, min_docs: int = MIN_DOCS, min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """_key of the lines above both limits; counts are pre-aggregated by surroundings before they meet per line."""
    once = lines.groupBy("_key", "_hk").agg(F.min_by("_ctx", "_pos").alias("_ctx"))
    by_ctx = once.groupBy("_key", "_ctx").agg(F.count("*").alias("_docs"))
    return (by_ctx.groupBy("_key").agg(F.sum("_docs").alias("_docs"), F.count("*").alias("_ctxs"))
            .where((F.col("_docs") >= min_docs) & (F.col("_ctxs") >= min_contexts)).select("_key"))


def line_removals(spark: SparkSession, docs: DataFrame, text: str = "text", host: str = "source",
                  min_docs: int = MIN_DOCS, min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """Per text and host with frequent lines: _hk, _removed (words), _gone (positions of the lines to remove)."""
    lines = checkpointed(spark, _lines(docs, text, host))
    return (lines.join(frequent_lines(lines, min_docs, min_contexts), "_key").groupBy("_hk")
            .agg(F.sum("_n").alias("_removed"), F.collect_list("_pos").alias("_gone")))


def verdicts(spark: SparkSession, docs: DataFrame, keep: list[str], text: str = "text", host: str = "source",
             min_docs: int = MIN_DOCS, min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """``keep`` columns, base counts, base_failed, n_line_words (words in removed lines) and kept."""
    slim = docs.select(*keep, F.col(text).alias("_text"), _text_key(text, host).alias("_hk"))
    stats = base_statistics(slim, [*keep, "_hk"], "_text")
    gone = line_removals(spark, docs, text, host, min_docs, min_contexts).select("_hk", "_removed")
    left = F.col("n_words") - F.col("n_line_words")
    return (stats.join(gone, "_hk", "left").drop("_hk")
            .withColumn("n_line_words", F.coalesce("_removed", F.lit(0)).cast("long")).drop("_removed")
            .withColumn("kept", ~F.col("base_failed") & (left >= MIN_WORDS) & (left >= MIN_SHARE * F.col("n_words"))))


def clean(spark: SparkSession, docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """Documents that pass, all their columns, without their frequent lines (``n_chars``, if there, follows the text)."""
    from_cols = docs.columns
    gone = line_removals(spark, docs, text, host)
    at = docs.select(*from_cols, _text_key(text, host).alias("_hk")).join(gone, "_hk", "left")
    at = base_statistics(at.select(F.struct(*from_cols).alias("_doc"), F.col(text).alias("_text"),
                                   "_removed", "_gone"), ["_doc", "_text", "_removed", "_gone"], "_text")
    left = F.col("n_words") - F.coalesce("_removed", F.lit(0))
    # The number keeps Spark from moving the condition, with all the counting in it, below the counts.
    at = at.withColumn("_row", F.monotonically_increasing_id())
    at = at.where((F.col("_row") >= 0) & ~F.col("base_failed") & (left >= MIN_WORDS) & (left >= MIN_SHARE * F.col("n_words")))
    at = at.select("_doc", F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(F.transform(
        F.filter(F.transform(F.split("_text", "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                 lambda s: ~F.array_contains("_gone", s["i"])), lambda s: s["x"]), "\n")).alias("_text"))
    out = [F.col("_text").alias(c) if c == text else
           F.when(F.col("_text").eqNullSafe(F.col("_doc")[text]), F.col("_doc")[c])
           .otherwise(F.length("_text").cast(docs.schema[c].dataType)).alias(c) if c == "n_chars" else
           F.col("_doc")[c].alias(c) for c in from_cols]
    return at.select(*out)
