"""The wide report: one row per phone and tied latest call, 17 columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtrail.functions.predicates import (
    connected,
    dropped,
    inbound,
    outbound,
    reachable,
)
from dialtrail.operators.activity import add_activity
from dialtrail.operators.calls import scored_calls
from dialtrail.operators.lanes import Calls, Hot, hot_phones, roll_up_by_phone
from dialtrail.operators.leads import leads_by_phone, with_report_date
from dialtrail.operators.repeat import repeat_rows
from dialtrail.operators.score import best_score
from dialtrail.operators.summary import status_item, summary_text
from dialtrail.schema import REPORT_COLUMNS

# Tells rows of one report apart, up to equal rows.
REPORT_ORDER = ("phone", "last_call_status")


def marked_calls(calls: DataFrame) -> DataFrame:
    """The few values of a call that the report rolls up.

    Failed calls only tell that a phone was dialled, so they lose status and
    date. They merge into one row per phone once they lie together.
    """
    reached = reachable()
    return calls.filter(F.col("phone_number_dialed").isNotNull()).select(
        F.col("phone_number_dialed").alias("phone"),
        F.when(reached, F.col("status")).alias("status"),
        F.when(reached, F.col("call_date")).alias("call_date"),
        reached.alias("reached"),
        connected().alias("connected"),
        (reached & outbound()).alias("outbound"),
        (reached & inbound()).alias("inbound"),
    )


def calls_by_day(marked: DataFrame) -> DataFrame:
    """Counts per (phone, status, call_date), the grain the report rolls up
    from. Equal calls merge here, and a hot phone spreads over its dates."""
    return marked.groupBy("phone", "status", "call_date").agg(
        F.count_if("reached").alias("n_reached"),
        F.count_if("connected").alias("n_connected"),
        F.count_if("outbound").alias("n_outbound"),
        F.count_if("inbound").alias("n_inbound"),
    )


def calls_by_status(by_day: DataFrame) -> DataFrame:
    """Roll the daily counts up to (phone, status). Dates are distinct there, so
    the count that goes with the latest one is the number of tied calls."""
    connected_date = F.when(F.col("n_connected") > 0, F.col("call_date"))
    return by_day.groupBy("phone", "status").agg(
        F.min("call_date").alias("first_call"),
        F.max("call_date").alias("last_call"),
        F.max(F.when(F.col("n_outbound") > 0, F.col("call_date"))).alias("last_outbound"),
        F.sum("n_reached").alias("n_reached"),
        F.sum("n_connected").alias("n_connected"),
        F.sum("n_outbound").alias("n_outbound"),
        F.sum("n_inbound").alias("n_inbound"),
        F.max(connected_date).alias("last_connected"),
        F.max_by("n_connected", connected_date).alias("n_last_connected"),
    )


def calls_by_phone(by_status: DataFrame) -> DataFrame:
    """Roll up to one row per phone. ``statuses`` holds one entry per distinct
    status, no more than the summary text has to spell out."""
    item = status_item(F.col("status"), F.col("n_connected")).alias("item")
    entry = F.struct("status", "n_connected", item, "last_connected", "n_last_connected")
    return by_status.groupBy("phone").agg(
        F.lit(True).alias("called"),
        F.min("first_call").alias("first_call_date"),
        F.max("last_call").alias("last_call_data"),
        F.sum("n_outbound").alias("n_outbound"),
        F.sum("n_inbound").alias("n_inbound"),
        F.max(F.when(dropped(), F.col("last_call"))).alias("latest_drop_call_date"),
        F.max("last_outbound").alias("max_out_bound_call_date"),
        F.max(F.when(F.col("n_reached") > 0, F.col("score"))).alias("best"),
        F.max("last_connected").alias("max_call_date"),
        F.collect_list(F.when(F.col("n_connected") > 0, entry)).alias("statuses"),
    )


def call_rollup(marked: DataFrame) -> DataFrame:
    return calls_by_phone(scored_calls(calls_by_status(calls_by_day(marked))))


def lead_report(
    leads: DataFrame, calls: Calls, hot: Hot | None = None
) -> DataFrame:
    """The report; looks for hot phones first (a job) unless told them."""
    return numbered_report(leads, calls, hot).select(*REPORT_COLUMNS)


def numbered_report(
    leads: DataFrame, calls: Calls, hot: Hot | None = None
) -> DataFrame:
    """The report with ``copy_no``, which tells equal rows apart.

    Calls are shuffled once, by phone, and meet the leads where they lie. The
    look for hot phones reads the phone column before that; hot phones, if any,
    take a lane of their own, which scans the calls again.
    """
    if hot is None:
        hot = hot_phones(calls, "phone_number_dialed")
    rolled = roll_up_by_phone(calls, "phone", call_rollup, hot, marked_calls)
    return report_over(leads, rolled)


def report_over(leads: DataFrame, rolled: DataFrame) -> DataFrame:
    """The numbered report from the leads and one row per phone (``calls_by_phone``)."""
    joined = leads_by_phone(leads).join(rolled, "phone", "left")

    latest = F.filter("statuses", lambda s: s.last_connected == F.col("max_call_date"))

    rows = (
        add_activity(joined)
        .withColumns(
            {
                "max_score": best_score("called", "best"),
                "status_summary": summary_text("statuses", "n_leads"),
                "latest": F.explode_outer(latest),
            }
        )
        .withColumns(
            {
                "last_call_status": F.col("latest.status"),
                "copies": F.coalesce(
                    F.col("latest.n_last_connected") * F.col("n_leads"),
                    F.lit(1).cast("bigint"),
                ),
            }
        )
    )
    report = with_report_date(rows).select(*REPORT_COLUMNS, "copies")
    return repeat_rows(report, "copies", REPORT_ORDER)


def merge_reports(
    activity: DataFrame, counted_status: DataFrame, scores: DataFrame, summary: DataFrame
) -> DataFrame:
    """The report from its four finished parts, left-merged on phone.

    Unlike the joins inside the parts, the merge matches a null phone to a null
    phone. Tied statuses come as counts (``counted_last_status``), so a phone
    with many ties meets its lead as one row per status.
    """
    merged = with_report_date(activity)
    for part in (
        counted_status,
        scores.withColumnRenamed("phone_number_dialed", "phone"),
        summary.withColumnRenamed("phone_number_dialed", "phone"),
    ):
        part = part.withColumnRenamed("phone", "_phone")
        match = F.col("phone").eqNullSafe(F.col("_phone"))
        merged = merged.join(part, match, "left").drop("_phone")
    merged = merged.withColumn("copies", F.coalesce("copies", F.lit(1)))
    report = merged.select(*REPORT_COLUMNS, "copies")
    return repeat_rows(report, "copies", REPORT_ORDER).select(*REPORT_COLUMNS)
