"""The report as text cells, in numbered batches of sheet rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtrail.functions.fixed_values import ROWS_PER_PUBLISH_BATCH
from dialtrail.functions.text import cell_text
from dialtrail.operators.ordinal import with_ordinal
from dialtrail.operators.repeat import number_copies
from dialtrail.sources import versions
from dialtrail.plans.report import REPORT_ORDER

HEADER_ROWS = 1


def published(report: DataFrame) -> DataFrame:
    """Every column as text; missing, NaN and infinite values as ''."""
    return report.select(*[cell_text(field) for field in report.schema.fields])


def publish_batches(
    report: DataFrame,
    batch_rows: int = ROWS_PER_PUBLISH_BATCH,
    order_by: Sequence[str] = REPORT_ORDER,
) -> DataFrame:
    """Published rows with ``batch_id`` and ``sheet_row`` (stages data).

    The header is row 1 of the sheet and counts towards batch 0. ``order_by``
    must tell rows apart but for equal ones, which ``copy_no`` tells apart; a
    report without that column, such as a snapshot, is given it here.
    """
    if "copy_no" not in report.columns:
        report = number_copies(report, order_by)
    numbered = with_ordinal(report, [*order_by, "copy_no"], "_position")
    position = F.col("_position") + HEADER_ROWS
    cells = [cell_text(f) for f in report.schema.fields if f.name != "copy_no"]
    return numbered.select(
        F.floor(position / batch_rows).alias("batch_id"),
        (position + 1).alias("sheet_row"),
        *cells,
    )


def write_folders(
    batches: DataFrame, folder: str, parts: Sequence[str] = (), mode: str = "errorifexists"
) -> None:
    """One CSV folder per batch, in it one file in sheet order. Before the
    report's own columns stands sheet_row, the row of the sheet that the line
    belongs to. ``parts``, columns that the batch decides, are folders above the
    batches'; with ``mode`` "append" other batches may be there."""
    folders = [*parts, "batch_id"]
    (
        batches.repartition("batch_id")
        .sortWithinPartitions(*folders, "sheet_row")
        .write.mode(mode)
        .partitionBy(*folders)
        .options(header=True, escape='"')
        .csv(folder)
    )


def write_batches(batches: DataFrame, path: str) -> None:
    """Replace what was published at ``path`` once all batches are written; a
    write that breaks off leaves what was there."""
    spark = batches.sparkSession
    versions.commit(spark, path, lambda folder: write_folders(batches, folder))


def read_folders(spark: SparkSession, folder: str, columns: Sequence[str], parts: str = ""):
    """Batches as written, with the columns of the folders' names: ``parts``,
    then batch_id."""
    schema = ", ".join(f"`{c}` string" for c in ("sheet_row", *columns))
    return (
        spark.read.schema(f"{schema}, {parts}batch_id bigint")
        .options(header=True, escape='"', multiLine=True)
        .csv(folder)
    )


def published_cells(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = [F.coalesce(c, F.lit("")).alias(c) for c in columns]
    return rows.select("batch_id", F.col("sheet_row").cast("bigint"), *cells)


def read_batches(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """What was published at ``path``: batch_id, sheet_row and the cells as text."""
    found = versions.current(spark, path)
    if found is None:
        raise ValueError(f"nothing is published at {path}")
    return published_cells(read_folders(spark, found.path, columns), columns)
