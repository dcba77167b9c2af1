"""Who was called, who was dropped, and who was called back."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtrail.functions.predicates import dropped, inbound, outbound
from dialtrail.operators.calls import reachable_calls
from dialtrail.operators.lanes import Calls, per_lane
from dialtrail.operators.leads import leads_by_phone
from dialtrail.schema import ACTIVITY_COLUMNS


def called_back(last_outbound: str, last_drop: str) -> Column:
    """'yes' only where both dates are known and the outbound call is later."""
    return F.when(F.col(last_outbound) > F.col(last_drop), "yes").otherwise("no")


def _by_phone(calls: DataFrame) -> DataFrame:
    return (
        reachable_calls(calls)
        .filter(F.col("phone_number_dialed").isNotNull())
        .groupBy(F.col("phone_number_dialed").alias("phone"))
        .agg(
            F.min("call_date").alias("first_call_date"),
            F.max("call_date").alias("last_call_data"),
            F.count_if(outbound()).alias("n_outbound"),
            F.count_if(inbound()).alias("n_inbound"),
            F.max(F.when(dropped(), F.col("call_date"))).alias("latest_drop_call_date"),
            F.max(F.when(outbound(), F.col("call_date"))).alias(
                "max_out_bound_call_date"
            ),
        )
    )


def lead_activity(leads: DataFrame, calls: Calls) -> DataFrame:
    """One row per phone: lead values, first and last reachable call, counts.

    Counts cover each lead that shares the phone, as a join of the two tables
    would; here both sides are one row per phone before they meet.
    """
    joined = leads_by_phone(leads).join(per_lane(calls, _by_phone), "phone", "left")
    return add_activity(joined).select(*ACTIVITY_COLUMNS)


def add_activity(joined: DataFrame) -> DataFrame:
    """Per-lead counts and the call-back flag, from per-phone values."""

    def over_leads(count):
        return F.col("n_leads") * F.coalesce(count, F.lit(0))

    return joined.withColumns(
        {
            "out_bound_count": over_leads("n_outbound"),
            "in_bound_count": over_leads("n_inbound"),
            "outbound_after_drop": called_back(
                "max_out_bound_call_date", "latest_drop_call_date"
            ),
        }
    )
