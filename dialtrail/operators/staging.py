"""Cut lineage through a table written to a folder that all executors share."""

import uuid

from pyspark.sql import DataFrame, SparkSession

# Where staged tables go: the first of these settings that the session has.
STAGING_FOLDER = "spark.dialtrail.staging.dir"
SHARED_FOLDER = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"
# Shuffle files go when the statement that made them ends, not when the driver
# happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: list[str] = []

# Labels of tables as large as the input, which are packed more tightly.
WHOLE_TEXTS = ("numbered",)


def staging_folder(spark: SparkSession) -> str:
    """One rule for every master: a folder of the caller's own, which they may
    remove when done; else the cluster's shared folder; else a folder in the
    warehouse."""
    for name in (STAGING_FOLDER, SHARED_FOLDER):
        folder = spark.conf.get(name, None)
        if folder:
            return folder
    return spark.conf.get(WAREHOUSE).rstrip("/") + "/_staged"


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{staging_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def staged_paths() -> list[str]:
    """What this process has staged so far, for the caller to remove once the
    results built on it are no longer read."""
    return list(_written)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` now and return a scan of what was written.

    Parquet rather than ``checkpoint()``: later steps read only the columns
    they need. The shuffles of the write are of no more use and take no disk
    after it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    writer = df.write.option("compression", "zstd") if label in WHOLE_TEXTS else df.write
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)
