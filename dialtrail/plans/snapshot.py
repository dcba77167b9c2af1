"""Save a report once and reuse it; CSV only as an export."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialtrail.sources import versions
from dialtrail.schema import LEAD_REPORT


def has_snapshot(spark: SparkSession, path: str) -> bool:
    """A finished write is there; one that broke off does not count."""
    return versions.current(spark, path) is not None


def save_snapshot(
    report: DataFrame, path: str, built_from: str | None = None
) -> versions.Version:
    """Make ``report`` the snapshot at ``path``, in place of the one before."""
    return versions.commit(report.sparkSession, path, report.write.parquet, built_from)


def load_or_compute(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    schema: T.StructType = LEAD_REPORT,
    built_from: str | None = None,
) -> DataFrame:
    """Read the snapshot at ``path``; where there is none, build and write it.

    ``built_from`` names the state of the inputs, such as the last batch of the
    log; a snapshot built from another state is replaced. Left out, any will do.
    Parquet keeps what CSV cannot: the types, leading zeros, the status 'NA',
    and the empty string as against null.
    """
    found = versions.current(spark, path)
    if found is None or built_from not in (None, found.built_from):
        found = save_snapshot(build(), path, built_from)
    return spark.read.schema(schema).parquet(found.path)


CSV = {"header": True, "escape": '"', "encoding": "UTF-8"}


def export_csv(report: DataFrame, path: str) -> None:
    """Header and empty nulls; dates as ``yyyy-MM-dd HH:mm:ss``."""
    columns = [
        F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType)
        else F.col(f.name)
        for f in report.schema.fields
    ]
    report.select(*columns).write.mode("overwrite").options(**CSV).csv(path)


def read_csv_report(
    spark: SparkSession, path: str, schema: T.StructType = LEAD_REPORT
) -> DataFrame:
    """A CSV export with its types back. Empty strings come back as null. A file
    may hold line ends inside quotes, so each is one task's work; where a report
    is read again and again, keep it as a Parquet snapshot."""
    return (
        spark.read.schema(schema)
        .options(**CSV, multiLine=True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
        .csv(path)
    )
