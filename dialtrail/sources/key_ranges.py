"""Split a read by ranges of a text key, such as the phone.

Databases split a parallel read by numbers or dates on their own, but phones are
text. The predicates made here cut the key's order into ranges of about equally
many rows; each row satisfies exactly one of them, missing keys included.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def range_bounds(df: DataFrame, column: str, ranges: int, sampled: float = 0.01) -> list[str]:
    """Up to ``ranges`` - 1 ascending texts that cut ``column`` into like shares,
    from a sample that Spark sorts into ranges (a job; one text a range comes to
    the driver). A key with a large share of the rows gives fewer bounds."""
    keys = df.select(F.col(column).alias("key")).filter(F.col("key").isNotNull())
    keys = keys if sampled >= 1 else keys.sample(sampled, 0)
    dealt = keys.repartitionByRange(ranges, "key").withColumn("part", F.spark_partition_id())
    first = dealt.groupBy("part").agg(F.min("key").alias("key"))
    texts = sorted(row.key for row in first.collect())
    return [text for text in dict.fromkeys(texts[1:]) if _is_plain(text)]


def _is_plain(text: str) -> bool:
    """Written alike in every dialect of SQL; bounds only steer the balance."""
    return text.isascii() and text.isprintable() and "\\" not in text


def range_predicates(column: str, bounds: Sequence[str]) -> list[str]:
    """One SQL predicate for each range between ``bounds`` and one for missing
    keys. Bounds must ascend in the order that the database compares by, as
    digits do in all; then the predicates are disjoint and complete."""
    if any(a >= b for a, b in zip(bounds, bounds[1:])):
        raise ValueError("bounds must ascend")
    if not all(map(_is_plain, bounds)):
        raise ValueError("bounds must be printable ASCII without a backslash")
    quoted = ["'" + bound.replace("'", "''") + "'" for bound in bounds]
    if not quoted:
        return [f"{column} IS NULL", f"{column} IS NOT NULL"]
    between = [
        f"{column} >= {low} AND {column} < {high}" for low, high in zip(quoted, quoted[1:])
    ]
    return [
        f"{column} IS NULL",
        f"{column} < {quoted[0]}",
        *between,
        f"{column} >= {quoted[-1]}",
    ]


def read_by_ranges(df: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """The rows that satisfy any of the predicates, each read by its own filter,
    as a database connection would be given it."""
    return reduce(DataFrame.unionAll, [df.filter(predicate) for predicate in predicates])
