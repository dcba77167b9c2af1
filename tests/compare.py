"""Order-insensitive comparison of a Spark result and a DuckDB result."""

import datetime
import decimal
from collections import Counter


def _value(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = tuple(columns[i] for i in order)
    return names, Counter(tuple(_value(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return bag(df.columns, [tuple(row) for row in df.collect()])


def duck_bag(relation):
    return bag(relation.columns, relation.fetchall())
