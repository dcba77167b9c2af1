"""Row-level operators over the call log."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtrail.functions import fixed_values as V
from dialtrail.functions.predicates import connected, reachable


def reachable_calls(calls: DataFrame) -> DataFrame:
    """Calls whose dial did not fail, unrecorded outcomes included."""
    return calls.filter(reachable())


def connected_calls(calls: DataFrame) -> DataFrame:
    """Calls whose dial is known not to have failed."""
    return calls.filter(connected())


def stage_scores(spark: SparkSession) -> DataFrame:
    """The constant (status, score) relation."""
    rows = ", ".join(f"('{status}', {score})" for status, score in V.STAGE_SCORES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS stage_scores(status, score)")


def scored_calls(df: DataFrame) -> DataFrame:
    """Add the score of ``status``; statuses without one score 0. A collated
    status is looked up by its collation."""
    status = F.col("status").cast(df.schema["status"].dataType)
    listed = stage_scores(df.sparkSession).withColumn("status", status)
    scores = F.broadcast(listed)  # 30 fixed rows
    joined = df.join(scores, "status", "left")
    score = F.coalesce("score", F.lit(V.UNLISTED_SCORE))
    return joined.select(*df.columns, score.alias("score"))


def stage_usage(calls: DataFrame) -> DataFrame:
    """Every stage score with the number of calls that carry its status."""
    used = calls.groupBy("status").agg(F.count("*").alias("calls"))
    return (
        stage_scores(calls.sparkSession)
        .join(used, "status", "left")
        .select("status", "score", F.coalesce("calls", F.lit(0)).alias("calls"))
    )
