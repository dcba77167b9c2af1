"""Frequent keys from a small summary that is kept beside the data.

The summary is a frequent-items sketch: those of parts of a table, such as its
batches, merge into one of the whole, without the table being read again. It
tracks a bounded number of keys. A count is off by at most about 3.5 times the
rows over TRACKED, so every key with more rows than that is found.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACKED = 10_000


def key_summary(df: DataFrame, key: str, tracked: int = TRACKED) -> DataFrame:
    """One row with the summary (``sketch``) of a text column; nulls do not count.
    Summaries of its partitions are merged, never its rows."""
    sketch = F.expr(f"approx_top_k_accumulate(`{key}`, {int(tracked)})")
    return df.filter(F.col(key).isNotNull()).agg(sketch.alias("sketch"))


def merged_summaries(summaries: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """One row from any number of summaries."""
    return summaries.agg(F.expr(f"approx_top_k_combine(sketch, {int(tracked)})").alias("sketch"))


def frequent_keys(summary: DataFrame, least: int, tracked: int = TRACKED) -> DataFrame:
    """(hot_phone, n): keys with about ``least`` rows or more, at most ``tracked``."""
    found = F.explode(F.expr(f"approx_top_k_estimate(sketch, {int(tracked)})"))
    rows = summary.select(found.alias("key")).select("key.item", "key.count")
    return rows.filter(F.col("count") >= least).select(
        F.col("item").alias("hot_phone"), F.col("count").alias("n")
    )
