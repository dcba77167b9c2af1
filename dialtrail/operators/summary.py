"""How often each status came up, as counts and as text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtrail.operators.calls import connected_calls
from dialtrail.operators.lanes import Calls, Hot, hot_phones, roll_up_by_phone
from dialtrail.operators.leads import leads_by_phone

SEPARATOR = ", "


def status_item(status: Column, n_calls: Column) -> Column:
    """``status(count)``; null if the status is."""
    return F.concat(status, F.lit("("), n_calls.cast("string"), F.lit(")"))


def first_bytes(text: Column, most: int) -> Column:
    """``text``, or of a longer one its first code points of ``most`` bytes of
    UTF-8 at most: a cut never lies inside a code point."""
    raw = text.cast("binary")

    def follows(n):  # the byte behind n of them continues a code point
        return F.hex(F.substring(raw, F.lit(n + 1), F.lit(1))).rlike("^[89AB]")

    cut = F.lit(max(most - 3, 0))
    for n in range(max(most - 2, 0), most + 1):
        cut = F.when(~follows(n), n).otherwise(cut)
    short = F.decode(F.substring(raw, F.lit(1), cut), "UTF-8")
    return F.when(F.octet_length(raw) <= most, text).otherwise(short)


def summary_text(statuses: str, n_leads: str, most_bytes: int | None = None) -> Column:
    """``DROP(2), FOLLOW(1)`` in status order, from an array of structs that
    start with ``status`` and hold ``n_connected`` and its ``item``; null where
    no status is known.

    Leads that share a phone each list the item again, with a count over all of
    them. One lead, the usual case, takes the items as they are. With
    ``most_bytes`` no item is spelled out more often than such a text can show,
    so that the text stays near that size; ``first_bytes`` cuts it.
    """
    ordered = F.sort_array(statuses)
    leads = F.col(n_leads)

    def shared_item(s):
        item = status_item(s["status"], s["n_connected"] * leads)
        times = leads - 1
        if most_bytes is not None:
            times = F.least(times, F.ceil(F.lit(most_bytes + 1) / F.octet_length(item)))
        again = F.repeat(F.concat(item, F.lit(SEPARATOR)), times.cast("int"))
        return F.concat(again, item)

    items = F.when(leads == 1, ordered["item"]).otherwise(
        F.transform(ordered, shared_item)
    )
    # The text itself is plain, even if the statuses are collated.
    return F.nullif(F.array_join(items, SEPARATOR).cast("string"), F.lit(""))


def _dialled(calls: DataFrame) -> DataFrame:
    return (
        connected_calls(calls)
        .filter(F.col("phone_number_dialed").isNotNull())
        .select(F.col("phone_number_dialed").alias("phone"), "status")
    )


def _by_status(dialled: DataFrame) -> DataFrame:
    return dialled.groupBy("phone", "status").agg(F.count("*").alias("n_connected"))


def _by_phone(dialled: DataFrame) -> DataFrame:
    """One entry per distinct status: what the text has to spell out."""
    item = status_item(F.col("status"), F.col("n_connected")).alias("item")
    entry = F.struct("status", "n_connected", item)
    return _by_status(dialled).groupBy("phone").agg(
        F.collect_list(entry).alias("statuses")
    )


def status_counts(leads: DataFrame, calls: DataFrame) -> DataFrame:
    """Connected calls per phone of a lead and status, once per such lead."""
    phones = leads_by_phone(leads).select("phone", "n_leads")
    return (
        phones.join(_by_status(_dialled(calls)), "phone")
        .select(
            F.col("phone").alias("phone_number_dialed"),
            "status",
            (F.col("n_connected") * F.col("n_leads")).alias("status_count"),
        )
    )


def status_summary(
    leads: DataFrame, calls: Calls, hot: Hot | None = None, most_bytes: int | None = None
) -> DataFrame:
    """One row per phone with its summary text, or null. Looks for hot phones
    first (a job) unless told them. With ``most_bytes`` the text ends there, on a
    whole code point, and ``summary_cut`` tells whether it was longer."""
    if hot is None:
        hot = hot_phones(calls, "phone_number_dialed")
    by_phone = roll_up_by_phone(calls, "phone", _by_phone, hot, _dialled)
    joined = leads_by_phone(leads).select("phone", "n_leads").join(by_phone, "phone", "left")
    text = summary_text("statuses", "n_leads", most_bytes).alias("status_summary")
    summary = joined.select(F.col("phone").alias("phone_number_dialed"), text)
    if most_bytes is None:
        return summary
    whole = F.col("status_summary")
    return summary.select(
        "phone_number_dialed",
        first_bytes(whole, most_bytes).alias("status_summary"),
        F.coalesce(F.octet_length(whole) > most_bytes, F.lit(False)).alias("summary_cut"),
    )
