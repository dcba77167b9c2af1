"""A call log stored by phone, so that reports need not shuffle the calls.

Ordinary phones lie in buckets, each sorted by phone and date, and Spark reads a
bucket as one partition. Hot phones would make a bucket one task's work, so they
lie in a folder of their own, dealt out. They are known from the log's summary
of frequent phones, which is stored too and merged, not computed again, when
calls are added; so no report has to look for them.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtrail.operators.frequent import TRACKED, frequent_keys, key_summary, merged_summaries
from dialtrail.operators.lanes import HOT_CALLS, Lanes
from dialtrail.operators.staging import staged
from dialtrail.sources import versions
from dialtrail.schema import CALL_HISTORY

# Ordinary calls of one bucket are one task's work: take so many that a bucket
# stays near 128-256 MB.
BUCKETS = 200
# A store takes more buckets than told rather than more calls in one on average.
CALLS_PER_BUCKET = 500_000

PHONE = "phone_number_dialed"
COLUMNS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CALL_HISTORY.fields)


def write_call_store(
    calls: DataFrame,
    path: str,
    buckets: int = BUCKETS,
    hot_calls: int = HOT_CALLS,
    tracked: int = TRACKED,
) -> None:
    """Store ``calls`` at ``path``, in place of what is there, in ``buckets`` or
    as many more as ``CALLS_PER_BUCKET`` asks for, so that a task's work does not
    grow with the log. Reads the phone column once for the summary and once to
    count, then all columns."""
    calls = calls.select(*CALL_HISTORY.fieldNames())
    summary = staged(key_summary(calls, PHONE, tracked), "summary")
    _write(calls, summary, path, buckets, hot_calls, tracked)


def add_calls(spark: SparkSession, path: str, calls: DataFrame) -> None:
    """Add a batch of calls to a store. Its summary is merged with the stored
    one. The calls are written anew as a version of their own, together with
    those there, so that each bucket stays sorted and readers see either all of
    the batch or nothing; a rollup (``plans.rollup``) takes a batch for less."""
    settings = _settings(spark, path)
    calls = calls.select(*CALL_HISTORY.fieldNames())
    new = key_summary(calls, PHONE, settings.tracked)
    stored = spark.read.parquet(f"{settings.folder}/summary").select("sketch")
    summary = staged(merged_summaries(stored.unionByName(new), settings.tracked), "summary")
    everything = stored_calls(spark, path).unionByName(calls)
    _write(everything, summary, path, settings.buckets, settings.hot_calls, settings.tracked)


class Settings:
    def __init__(self, folder: str, row):
        self.folder = folder
        self.buckets, self.hot_calls, self.tracked = row.buckets, row.hot_calls, row.tracked
        self.n_hot = row.n_hot


def _settings(spark: SparkSession, path: str) -> Settings:
    found = versions.current(spark, path)
    if found is None:
        raise ValueError(f"no calls are stored at {path}")
    row = spark.read.parquet(f"{found.path}/summary").drop("sketch").first()
    return Settings(found.path, row)


def _table(folder: str) -> str:
    return "calls_" + folder.rstrip("/").rsplit("/", 1)[-1]


def _write(calls, summary, path, buckets, hot_calls, tracked):
    spark = calls.sparkSession
    hot = staged(frequent_keys(summary, hot_calls, tracked).select("hot_phone"), "hot")
    # A bounded number of names, tracked at most.
    n_hot = hot.count()
    is_hot = F.col(PHONE) == F.col("hot_phone")
    known = calls.filter(F.col(PHONE).isNotNull())
    ordinary = known.join(hot, is_hot, "left_anti") if n_hot else known
    buckets = max(buckets, -(-ordinary.count() // CALLS_PER_BUCKET))

    def write(folder: str) -> None:
        # Hashed as the buckets are: each task writes one, as one file.
        (
            ordinary.repartition(buckets, PHONE)
            .write.bucketBy(buckets, PHONE)
            .sortBy(PHONE, "call_date")
            .option("path", f"{folder}/ordinary")
            .saveAsTable(_table(folder))
        )
        if n_hot:
            known.join(hot, is_hot, "left_semi").write.parquet(f"{folder}/hot")
        calls.filter(F.col(PHONE).isNull()).write.parquet(f"{folder}/unknown")
        facts = {"buckets": buckets, "hot_calls": hot_calls, "tracked": tracked, "n_hot": n_hot}
        summary.withColumns({k: F.lit(v) for k, v in facts.items()}).write.parquet(
            f"{folder}/summary"
        )

    versions.commit(spark, path, write)


def open_call_store(spark: SparkSession, path: str) -> Lanes:
    """The stored calls for the reports, which take them in place of a table.
    In a session that did not write it, the bucketed folder is made known to the
    catalog first."""
    settings = _settings(spark, path)
    table = _table(settings.folder)
    if not spark.catalog.tableExists(table):
        spark.sql(
            f"CREATE TABLE {table} ({COLUMNS}) USING parquet CLUSTERED BY ({PHONE}) "
            f"SORTED BY ({PHONE}, call_date) INTO {settings.buckets} BUCKETS "
            f"LOCATION '{settings.folder}/ordinary'"
        )
    spread = None
    if settings.n_hot:
        spread = spark.read.schema(CALL_HISTORY).parquet(f"{settings.folder}/hot")
    return Lanes(spark.table(table), spread)


def stored_calls(spark: SparkSession, path: str) -> DataFrame:
    """All calls of a store as one table, those without a phone among them."""
    settings = _settings(spark, path)
    parts = ["ordinary", "unknown"] + (["hot"] if settings.n_hot else [])
    folders = [f"{settings.folder}/{part}" for part in parts]
    return spark.read.schema(CALL_HISTORY).parquet(*folders)
