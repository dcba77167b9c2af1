"""The best stage score any call of a lead has earned."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtrail.functions.predicates import reachable
from dialtrail.operators.calls import scored_calls
from dialtrail.operators.lanes import Calls, per_lane
from dialtrail.operators.leads import leads_by_phone


def best_score(called: str, best: str):
    """Never called: 0. Called: the best surviving score, or null if none is."""
    return F.when(F.col(called).isNull(), F.lit(0)).otherwise(F.col(best))


def _by_phone(calls: DataFrame) -> DataFrame:
    return (
        scored_calls(
            calls.filter(F.col("phone_number_dialed").isNotNull()).select(
                "phone_number_dialed", "status", reachable().alias("reached")
            )
        )
        .groupBy(F.col("phone_number_dialed").alias("phone"))
        .agg(
            F.lit(True).alias("called"),
            F.max(F.when(F.col("reached"), F.col("score"))).alias("best"),
        )
    )


def lead_max_score(leads: DataFrame, calls: Calls) -> DataFrame:
    """One row per phone; a phone whose calls all failed has no row.

    The failed calls must reach the join: they tell a lead whose calls failed
    from one that was never called.
    """
    return (
        leads_by_phone(leads)
        .join(per_lane(calls, _by_phone), "phone", "left")
        .select(
            F.col("phone").alias("phone_number_dialed"),
            best_score("called", "best").alias("max_score"),
        )
        .filter(F.col("max_score").isNotNull())
    )
