"""The report kept up as the log grows, a batch at a time.

Kept is what the report rolls up from: one row for each phone and status, with
first and last dates, counts, and how many calls tie on the latest date. Such
rows merge: those of a batch and the kept ones give the rows of the whole log,
whatever the order of the dates. They lie in buckets by phone; a batch reads and
writes only the buckets its phones fall into, and never the log.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtrail.operators.calls import scored_calls
from dialtrail.operators.staging import staged
from dialtrail.sources import versions
from dialtrail.plans.report import (
    calls_by_day,
    calls_by_phone,
    calls_by_status,
    marked_calls,
    report_over,
)
from dialtrail.schema import REPORT_COLUMNS

BUCKETS = 64

STATE = (
    "phone string, status string, first_call timestamp_ntz, last_call timestamp_ntz, "
    "last_outbound timestamp_ntz, n_reached bigint, n_connected bigint, n_outbound bigint, "
    "n_inbound bigint, last_connected timestamp_ntz, n_last_connected bigint"
)
CONTENTS = "bucket int, token string"
BATCHES = "batch_id string"


def call_state(calls: DataFrame) -> DataFrame:
    """The rows kept for ``calls``. Calls merge by day before they are shuffled,
    so a hot phone is a few rows from each partition."""
    return calls_by_status(calls_by_day(marked_calls(calls)))


def merged_state(states: DataFrame) -> DataFrame:
    """One row for each phone and status of any number of states of parts of a
    log. Calls that tie on the latest date add up over the parts that have it."""
    by_date = states.groupBy("phone", "status", "last_connected").agg(
        F.min("first_call").alias("first_call"),
        F.max("last_call").alias("last_call"),
        F.max("last_outbound").alias("last_outbound"),
        *[
            F.sum(n).alias(n)
            for n in ("n_reached", "n_connected", "n_outbound", "n_inbound", "n_last_connected")
        ],
    )
    return by_date.groupBy("phone", "status").agg(
        F.min("first_call").alias("first_call"),
        F.max("last_call").alias("last_call"),
        F.max("last_outbound").alias("last_outbound"),
        *[F.sum(n).alias(n) for n in ("n_reached", "n_connected", "n_outbound", "n_inbound")],
        F.max_by("n_last_connected", "last_connected").alias("n_last_connected"),
        F.max("last_connected").alias("last_connected"),
    )


def _rows(spark: SparkSession, path: str, entries) -> DataFrame:
    folders = [f"{versions.folder_of(path, e.token)}/state/bucket={e.bucket}" for e in entries]
    if not folders:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(*folders)


def _contents(spark: SparkSession, path: str) -> tuple[list, DataFrame, int | None]:
    """Which version holds each bucket, at most a row a bucket; the batches
    merged; and the number of buckets."""
    found = versions.current(spark, path)
    if found is None:
        return [], spark.createDataFrame([], BATCHES), None
    entries = spark.read.schema(CONTENTS).parquet(f"{found.path}/contents").collect()
    batches = spark.read.schema(BATCHES).parquet(f"{found.path}/batches")
    return entries, batches, int(found.built_from)


def merge_calls(
    spark: SparkSession, path: str, calls: DataFrame, batch_id: str, buckets: int = BUCKETS
) -> bool:
    """Take a batch of calls into the state at ``path``; whether it had to be.

    A batch that is in already is left out, so a run that broke off can be run
    again: it counts once all of it is in, or not at all. ``buckets`` is fixed by
    the first batch. One writer at a time; the buckets a batch touches come to
    the driver as numbers.
    """
    entries, batches, fixed = _contents(spark, path)
    if not batches.filter(F.col("batch_id") == batch_id).isEmpty():
        return False
    buckets = fixed or buckets
    bucket = F.pmod(F.hash("phone"), F.lit(buckets)).alias("bucket")
    new = staged(call_state(calls).select("*", bucket), "batch")
    touched = {row.bucket for row in new.select("bucket").distinct().collect()}
    old = _rows(spark, path, [e for e in entries if e.bucket in touched]).select("*", bucket)
    merged = merged_state(old.unionByName(new).drop("bucket")).select("*", bucket)

    def write(folder: str) -> None:
        token = folder.rsplit("/", 1)[-1]
        if touched:
            merged.repartition("bucket").write.partitionBy("bucket").parquet(f"{folder}/state")
        contents = [(e.bucket, e.token) for e in entries if e.bucket not in touched]
        contents += [(number, token) for number in touched]
        spark.createDataFrame(contents, CONTENTS).coalesce(1).write.parquet(f"{folder}/contents")
        own = spark.sql("SELECT :batch_id batch_id", {"batch_id": batch_id})
        batches.unionByName(own).coalesce(1).write.parquet(f"{folder}/batches")

    versions.commit(spark, path, write, built_from=str(buckets))
    return True


def kept_state(spark: SparkSession, path: str) -> DataFrame:
    """The state of all batches merged so far; without any, no rows."""
    return _rows(spark, path, _contents(spark, path)[0])


def kept_report(leads: DataFrame, path: str) -> DataFrame:
    """The report over all calls merged at ``path``; the log is not read."""
    state = kept_state(leads.sparkSession, path)
    return report_over(leads, calls_by_phone(scored_calls(state))).select(*REPORT_COLUMNS)
