"""Operators over the lead table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtrail.functions.fixed_values import LEADS_PER_PAGE
from dialtrail.functions.text import report_date
from dialtrail.operators.ordinal import with_ordinal
from dialtrail.schema import LEAD_COLUMNS

PAGE_ORDER = ("phone", "lead_id")


def lead_count(leads: DataFrame) -> DataFrame:
    return leads.agg(F.count("*").alias("count"))


def leads_by_phone(leads: DataFrame) -> DataFrame:
    """One row per phone, null included: ``n_leads`` and the first lead's values.

    Phones are meant to be unique; where they are not, the values all come from
    the lead with the smallest lead_id.
    """
    others = [name for name in LEAD_COLUMNS if name != "phone"]
    return (
        leads.groupBy("phone")
        .agg(
            F.count("*").alias("n_leads"),
            F.min(F.struct(*others)).alias("first_lead"),
        )
        .select("phone", "n_leads", "first_lead.*")
    )


def with_report_date(df: DataFrame) -> DataFrame:
    """Format uploaded_date for the report, if the frame has that column."""
    if "uploaded_date" not in df.columns:
        return df
    return df.withColumn("uploaded_date", report_date("uploaded_date"))


def lead_page(leads: DataFrame, limit: int = LEADS_PER_PAGE, offset: int = 0) -> DataFrame:
    """``limit`` leads from position ``offset`` in phone order, nulls first.

    A page is cut by position from the distributed sort (stages data), however
    deep it lies; an offset would pull all rows before it into one task.
    """
    numbered = with_ordinal(leads, PAGE_ORDER, "position")
    wanted = F.col("position").between(offset, offset + limit - 1)
    return numbered.filter(wanted).drop("position")


def paged_leads(leads: DataFrame, page_rows: int = LEADS_PER_PAGE) -> DataFrame:
    """All pages of the lead table at once, appended: each lead with its
    ``page_id`` (stages data)."""
    numbered = with_ordinal(leads, PAGE_ORDER, "position")
    page = F.floor(F.col("position") / page_rows).alias("page_id")
    return numbered.select(page, *leads.columns)
