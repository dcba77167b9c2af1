"""The status of each lead's most recent connected call."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialtrail.operators.calls import connected_calls
from dialtrail.operators.lanes import Calls, Hot, hot_phones, roll_up_by_phone
from dialtrail.operators.leads import leads_by_phone
from dialtrail.operators.repeat import repeat_rows


def _dated_calls(calls: DataFrame) -> DataFrame:
    known = F.col("phone_number_dialed").isNotNull() & F.col("call_date").isNotNull()
    return (
        connected_calls(calls)
        .filter(known)
        .select(F.col("phone_number_dialed").alias("phone"), "call_date", "status")
    )


def _known_phones(leads: DataFrame) -> DataFrame:
    return leads_by_phone(leads.filter(F.col("phone").isNotNull())).select(
        "phone", "n_leads"
    )


def max_call_dates(leads: DataFrame, calls: DataFrame) -> DataFrame:
    """Latest connected call per phone that belongs to a lead.

    A phone whose connected calls all lack a date is kept, with a null date.
    """
    latest = (
        connected_calls(calls)
        .filter(F.col("phone_number_dialed").isNotNull())
        .groupBy(F.col("phone_number_dialed").alias("phone"))
        .agg(F.max("call_date").alias("max_call_date"))
    )
    return _known_phones(leads).join(latest, "phone").select(
        F.col("phone").alias("phone_number_dialed"), "max_call_date"
    )


def _newest(dated: DataFrame) -> DataFrame:
    """The latest calls of each phone; equal calls as one row with a count."""
    same_call = ["phone", "call_date", "status"]
    distinct_calls = dated.groupBy(*same_call).agg(F.count("*").alias("n_calls"))
    newest_first = Window.partitionBy("phone").orderBy(F.desc("call_date"))
    ranked = distinct_calls.withColumn("_rank", F.rank().over(newest_first))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def counted_last_status(
    leads: DataFrame, calls: Calls, hot: Hot | None = None
) -> DataFrame:
    """Statuses of the latest connected calls of each phone, with ``copies``:
    how many tied calls have the status, times the leads that share the phone.

    Null dates go first: ``rank`` would let a phone with only null dates
    through. Looks for hot phones first (a job) unless told them.
    """
    if hot is None:
        hot = hot_phones(calls, "phone_number_dialed")
    latest = roll_up_by_phone(calls, "phone", _newest, hot, _dated_calls)
    return _known_phones(leads).join(latest, "phone").select(
        "phone",
        F.col("call_date").alias("max_call_date"),
        F.col("status").alias("last_call_status"),
        (F.col("n_calls") * F.col("n_leads")).alias("copies"),
    )


def last_call_status(
    leads: DataFrame, calls: Calls, hot: Hot | None = None
) -> DataFrame:
    """Status of the latest connected call, once per lead and tied call."""
    counted = counted_last_status(leads, calls, hot)
    return repeat_rows(counted, "copies", ["phone", "last_call_status"]).drop("copy_no")
