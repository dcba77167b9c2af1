"""Load lead_bank and call_history with a fixed schema.

Each loader returns exactly the columns of its logical schema, so scans are
pruned to them whatever else the stored table holds. CSV and JSON carry no
schema; their columns are found by name, and what does not fit is an error.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialtrail.schema import CALL_HISTORY, LEAD_BANK


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema``; a missing column is an error."""
    return df.selectExpr(
        *[
            f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema.fields
        ]
    )


def load_leads(
    spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = False
) -> DataFrame:
    """``multi_line`` is for CSV with line ends inside quotes (see ``_read_csv``)."""
    return conform(_read_files(spark, path, fmt, multi_line, LEAD_BANK), LEAD_BANK)


def load_calls(
    spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = False
) -> DataFrame:
    return conform(_read_files(spark, path, fmt, multi_line, CALL_HISTORY), CALL_HISTORY)


def leads_table(spark: SparkSession, table: str = "lead_bank") -> DataFrame:
    return conform(spark.table(table), LEAD_BANK)


def calls_table(spark: SparkSession, table: str = "call_history") -> DataFrame:
    return conform(spark.table(table), CALL_HISTORY)


def _read_json(spark, path, schema):
    """JSON lines with the fields of ``schema`` as text. A column that no record
    has is an error: usually the first record has them all; only where nulls are
    left out of it are all records looked at for their names."""
    options = {"primitivesAsString": True, "mode": "FAILFAST"}
    first = spark.read.text(path).select(F.json_object_keys("value").alias("names")).first()
    if first is None or not set(schema.fieldNames()) <= set(first.names or []):
        return spark.read.options(**options).json(path)
    text = ", ".join(f"`{name}` string" for name in schema.fieldNames())
    return spark.read.schema(text).options(**options).json(path)


def _read_files(spark, path, fmt, multi_line, schema):
    if fmt == "csv":
        return _read_csv(spark, path, multi_line)
    if fmt == "json":
        return _read_json(spark, path, schema)
    return spark.read.format(fmt).load(path)


def _read_csv(spark, path, multi_line):
    """Columns by the names in the header, all of them text.

    The first file's header is the schema that every file's must equal. A line
    with another number of cells is an error. So is a line end inside quotes,
    unless ``multi_line`` is set; then a file is one task, as it cannot be cut.
    """
    options = {"header": True, "escape": '"', "mode": "FAILFAST", "multiLine": multi_line}
    header = spark.read.options(**options).csv(path).schema
    return (
        spark.read.schema(header)
        .options(**options, enforceSchema=False, columnPruning=False)
        .csv(path)
    )


def jdbc_leads(
    spark: SparkSession,
    options: dict,
    table: str = "lead_bank",
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    return conform(_read_jdbc(spark, options, table, predicates), LEAD_BANK)


def jdbc_calls(
    spark: SparkSession,
    options: dict,
    table: str = "call_history",
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    return conform(_read_jdbc(spark, options, table, predicates), CALL_HISTORY)


PARALLEL_JDBC = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def _read_jdbc(spark, options, table, predicates):
    """The read must be split, as one connection would carry it all: by
    ``predicates``, one connection each, which together hold every row once; or
    by options, where the database has a numeric, date or time column."""
    # Databases hand over clock times without a zone; keep them so.
    options = {"preferTimestampNTZ": "true", **options}
    if predicates:
        url = options.pop("url")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    missing = [name for name in PARALLEL_JDBC if name not in options]
    if missing:
        raise ValueError(f"a JDBC read needs predicates, or {', '.join(missing)}")
    return spark.read.format("jdbc").options(**options, dbtable=table).load()
