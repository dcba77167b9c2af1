"""Text compared by a collation, as many databases do: 'Drop' is 'DROP', and with
an RTRIM collation so is 'DROP  '.

Phones, statuses, campaigns and dial results become columns of the collation, and
joins, groups, lists and suffixes in all operators follow it. Texts that are one
by the collation are shown by one spelling, the first in code-point order: of a
status among all calls, of a phone among all leads.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialtrail.operators.staging import staged

COLLATION = "UTF8_LCASE"
# Spellings that are broadcast; more are joined.
MOST_BROADCAST = 10_000


def one_spelling(df: DataFrame, column: str, collation: str = COLLATION) -> DataFrame:
    """``df`` with ``column`` collated, each text as its first spelling (stages
    the spellings). Null stays null. Equal texts merge before they are shuffled;
    few spellings are broadcast, so no text's rows need meet in one task."""
    key = F.collate(column, collation)
    by_key = df.filter(F.col(column).isNotNull()).groupBy(key.alias("_key"))
    shown = staged(by_key.agg(F.min(column).alias("_shown")).select("_shown"), "spellings")
    if shown.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        shown = F.broadcast(shown)
    shown = shown.withColumn("_shown", F.collate("_shown", collation))
    joined = df.withColumn("_key", key).join(shown, F.col("_key") == F.col("_shown"), "left")
    return joined.select(*[F.col("_shown" if c == column else c).alias(c) for c in df.columns])


def collated_leads(leads: DataFrame, collation: str = COLLATION) -> DataFrame:
    return one_spelling(leads, "phone", collation)


def collated_calls(calls: DataFrame, collation: str = COLLATION) -> DataFrame:
    """Calls' phones keep their spellings; results show the leads'."""
    others = ("phone_number_dialed", "campaign_id", "dialstatus")
    return one_spelling(calls, "status", collation).withColumns(
        {name: F.collate(name, collation) for name in others}
    )


def plain_text(df: DataFrame) -> DataFrame:
    """Collated columns as ordinary text again."""
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
