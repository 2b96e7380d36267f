"""Outcome of an ingest step as typed columns instead of message strings.

One expression (``outcome``) decides for the listing check, for landed files and
for the per-source status: whatever is known to be wrong comes first, then
content that is already held, then files refused beside others, then lateness.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join

# The outcomes of one ingest run for one source. Only FAILED is an error.
FAILED = "failed"
NEW = "new"
NOTHING_NEW = "nothing_new"
DUPLICATE = "duplicate"

HELD = "content already ingested"
SECOND = "another landed file has this report date"
COPY_OF_SECOND = "copy of a file refused for its report date"


def outcome(offered: Column, hwm: Column, failures: Sequence[tuple[Column, object]] = (), duplicate: Column | None = None,
            refused: Sequence[tuple[Column, object]] = (), late: str = "not newer than the known report",
            last: Sequence[tuple[Column, object]] = ()) -> Column:
    """``struct(status, reason)`` by the first rule that holds (a NULL condition doesn't).

    ``failures``: (condition, reason) checked first; ``duplicate``: the content is
    held already; ``refused``: failures beside other files of the batch; then late
    unless ``offered`` is strictly newer than ``hwm`` (NULL: nothing known);
    ``last``: failures that only matter for a newer offer.
    """
    def result(status: str, reason) -> Column:
        reason = reason if isinstance(reason, Column) else F.lit(reason)
        return F.struct(F.lit(status).alias("status"), reason.cast("string").alias("reason"))

    rules = [(c, result(FAILED, r)) for c, r in failures]
    if duplicate is not None:
        rules.append((duplicate, result(DUPLICATE, HELD)))
    rules += [(c, result(FAILED, r)) for c, r in refused]
    rules.append((hwm.isNotNull() & (offered <= hwm), result(NOTHING_NEW, late)))
    rules += [(c, result(FAILED, r)) for c, r in last]
    out = None
    for condition, value in rules:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(result(NEW, None))


def ingest_status(wanted: DataFrame, latest: DataFrame, known: DataFrame, key) -> DataFrame:
    """Classify every wanted source.

    ``latest(key, latest_ts)`` is the newest item currently offered (absent = the
    listing had no rows -> ``failed``); ``known(key, hwm)`` is the high-water
    mark already ingested. New iff nothing is known or ``latest_ts > hwm``
    (strict: an item at or before the mark is late and ignored).
    """
    keys = [key] if isinstance(key, str) else list(key)
    j = (wanted.select(*keys).join(latest.select(*keys, "latest_ts"), keys, "left")
         .join(known.select(*keys, "hwm"), keys, "left"))
    found = outcome(F.col("latest_ts"), F.col("hwm"), [(F.col("latest_ts").isNull(), "nothing offered")])
    return j.select(*keys, found["status"].alias("status"))


def landed_status(files: DataFrame, entries: DataFrame) -> DataFrame:
    """``files(source, path, sha256, report_date, error)`` + status and reason, given the manifest's entries.

    A file fails if it has an ``error``, no date, or a source without any entry; it
    is a duplicate if the manifest holds its bytes (of whichever source). Of the
    files that remain and are newer than their source's mark, the same bytes count
    once: the earliest date (then source, then path) is the original. Of several
    originals with one source and date the first path holds the date, the others
    fail; copies of an original share its fate (``duplicate`` or failed), so that
    nothing is called a duplicate whose bytes weren't taken. The outcome depends on
    the set of files, not on their order or on unrelated files.
    """
    keys = ["source", "path"]
    known = entries.groupBy("source").agg(F.max(F.to_date("report_date")).alias("hwm"), F.lit(True).alias("has_entry"))
    held = entries.select("sha256").filter(F.col("sha256").isNotNull()).distinct().withColumn("is_held", F.lit(True))
    f = lookup_join(lookup_join(files, known, "source", "left"), held, "sha256", "left")
    # Rows that pass every other check compete; they are slim and never carry a payload.
    rivals = f.filter(F.col("error").isNull() & F.col("report_date").isNotNull() & F.col("has_entry").isNotNull() & F.col("is_held").isNull()
                      & (F.col("hwm").isNull() | (F.col("report_date") > F.col("hwm")))).select(*keys, "sha256", "report_date")
    original = rivals.groupBy("sha256").agg(F.min(F.struct("report_date", *keys)).alias("first"))
    holder = original.groupBy(F.col("first.source").alias("_s"), F.col("first.report_date").alias("_d")).agg(F.min("first.path").alias("_holder"))
    settled = original.join(holder, (F.col("first.source") == F.col("_s")) & (F.col("first.report_date") == F.col("_d"))).select(
        "sha256", "first", (F.col("first.path") != F.col("_holder")).alias("is_refused"))
    ranked = lookup_join(rivals, settled, "sha256").select(
        *keys, "is_refused", ((F.col("path") != F.col("first.path")) | (F.col("source") != F.col("first.source"))).alias("is_copy"))
    f = f.join(ranked, keys, "left")
    found = outcome(
        F.col("report_date"), F.col("hwm"),
        [(F.col("error").isNotNull(), F.col("error")), (F.col("report_date").isNull(), "no report date in file name"),
         (F.col("has_entry").isNull(), "no manifest entry to inherit")],
        duplicate=F.col("is_held") | (F.col("is_copy") & ~F.col("is_refused")),
        refused=[(F.col("is_refused") & F.col("is_copy"), COPY_OF_SECOND), (F.col("is_refused"), SECOND)])
    return f.withColumn("_o", found).select(*files.columns, F.col("_o.status").alias("status"), F.col("_o.reason").alias("reason"))
