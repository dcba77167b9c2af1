"""Turn counted copies back into rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Copies written by one task in a go; a row with more is spread over tasks.
COPIES_PER_RUN = 10_000


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def repeat_rows(
    df: DataFrame, copies: str, spread_by: Sequence[str], ordinal: str = "copy_no"
) -> DataFrame:
    """Each row ``copies`` times, numbered by ``ordinal`` from 0.

    A row is first cut into runs of copies and the runs are hashed over the
    cluster, so that a row with a billion copies is not one task's work and
    its copies are never held as one array. The number of partitions is named:
    left to itself, Spark would merge them again by the bytes of the runs, which
    are few before they are written out.
    """
    partitions = shuffle_partitions(df.sparkSession)
    last = F.col(copies) - 1
    run = F.lit(COPIES_PER_RUN).cast("bigint")
    zero = F.lit(0).cast("bigint")
    runs = df.withColumn(
        "_run", F.explode(F.sequence(zero, F.floor(last / run).cast("bigint")))
    ).repartition(partitions, *spread_by, "_run")
    start = F.col("_run") * run
    numbers = F.sequence(start, F.least(last, start + run - 1))
    kept = [name for name in df.columns if name != copies]
    return runs.select(*kept, F.explode(numbers).alias(ordinal))


def number_copies(
    df: DataFrame, spread_by: Sequence[str], ordinal: str = "copy_no"
) -> DataFrame:
    """Tell equal rows apart by ``ordinal``. They are counted and written out
    again, so that any number of them is spread over tasks."""
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return repeat_rows(counted, "_copies", spread_by, ordinal)
