"""Text files of calls whose bad lines are set aside with a reason.

The strict loaders in ``tables`` stop at a line that does not fit. Here such a
line goes to a second table, whole, so that rows and rejects together are the
lines of the files.
"""

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialtrail.operators.staging import staged
from dialtrail.schema import CALL_HISTORY, LEAD_BANK

BAD = "_bad_line"


def calls_and_rejects(
    spark: SparkSession, path: str, fmt: str = "csv"
) -> tuple[DataFrame, DataFrame]:
    return read_with_rejects(spark, path, CALL_HISTORY, fmt)


def leads_and_rejects(
    spark: SparkSession, path: str, fmt: str = "csv"
) -> tuple[DataFrame, DataFrame]:
    return read_with_rejects(spark, path, LEAD_BANK, fmt)


def read_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``schema``, and (line, reason) of the lines that give none (stages
    the lines, taken apart).

    Files are CSV, whose header is the first line of the first by name that
    has any, and may stand in all of them, or JSON lines. Reasons:
    ``cells``, not as many cells as the header has; ``json``, no JSON object;
    otherwise the column whose text is not of its type. A line end inside quotes
    ends the line, which is then short of cells. Empty lines are no lines. A
    column that the header lacks is an error; in JSON it is null where a line
    lacks it.
    """
    files = spark.read.text(path)
    lines = files.filter(F.trim("value") != "")
    if fmt == "csv":
        firsts = (spark.read.text(name).first() for name in sorted(files.inputFiles()))
        header = next((line for line in firsts if line is not None), None)
        if header is None:
            raise ValueError(f"no header in {path}")
        names = next(csv.reader([header.value]))
        missing = [f.name for f in schema.fields if f.name not in names]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in the header of {path}")
        lines = lines.filter(F.col("value") != header.value)
        shape = ", ".join(f"`{name}` string" for name in [*names, BAD])
        options = {"escape": '"', "columnNameOfCorruptRecord": BAD}
        parsed = F.from_csv("value", F.lit(shape), options)
        whole = "cells"
    elif fmt == "json":
        shape = ", ".join(f"`{f.name}` string" for f in schema.fields) + f", `{BAD}` string"
        options = {"columnNameOfCorruptRecord": BAD, "primitivesAsString": "true"}
        parsed = F.from_json("value", F.lit(shape), options)
        whole = "json"
    else:
        raise ValueError("csv or json")
    cells = lines.select("value", parsed.alias("cells")).select(
        F.col("value").alias("line"),
        (F.col("cells").isNull() | F.col(f"cells.{BAD}").isNotNull()).alias("broken"),
        *[F.col(f"cells.{f.name}").alias(f.name) for f in schema.fields],
    )
    reason = F.when(F.col("broken"), whole)
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            typed = F.col(f.name).try_cast(f.dataType)
            reason = reason.when(F.col(f.name).isNotNull() & typed.isNull(), f.name)
    checked = staged(cells.withColumn("reason", reason), "lines")
    good = checked.filter(F.col("reason").isNull())
    rows = good.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return rows, checked.filter(F.col("reason").isNotNull()).select("line", "reason")
