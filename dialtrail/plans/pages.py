"""Pages of leads from a sorted copy, of which a page reads the files it needs.

The copy holds the leads with their positions in page order, cut into files of a
bounded number of rows. An index of one row for each file tells its name, its
first and last position and its last phone. A page looks its files up there, so
its cost does not grow with the table or with how deep it lies.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialtrail.functions.fixed_values import LEADS_PER_PAGE
from dialtrail.operators.leads import PAGE_ORDER
from dialtrail.operators.ordinal import with_ordinal
from dialtrail.sources import versions
from dialtrail.schema import LEAD_BANK

ROWS_PER_FILE = 50_000
STORED = T.StructType([*LEAD_BANK.fields, T.StructField("position", T.LongType())])
INDEX = "file string, first_position bigint, last_position bigint, last_phone string"


def write_page_index(leads: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Sort ``leads`` into files and index them, in place of an earlier copy at
    ``path`` (stages data)."""
    numbered = with_ordinal(leads.select(*LEAD_BANK.fieldNames()), PAGE_ORDER, "position")

    def write(folder: str) -> None:
        (
            numbered.repartitionByRange("position")
            .sortWithinPartitions("position")
            .write.option("maxRecordsPerFile", rows_per_file)
            .parquet(f"{folder}/leads")
        )
        stored = leads.sparkSession.read.schema(STORED).parquet(f"{folder}/leads")
        (
            stored.groupBy(F.col("_metadata.file_name").alias("file"))
            .agg(
                F.min("position").alias("first_position"),
                F.max("position").alias("last_position"),
                F.max("phone").alias("last_phone"),
            )
            .write.parquet(f"{folder}/index")
        )

    versions.commit(leads.sparkSession, path, write)


def _folder(spark: SparkSession, path: str) -> str:
    found = versions.current(spark, path)
    if found is None:
        raise ValueError(f"no page index at {path}")
    return found.path


def _files(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(*[f"{folder}/leads/{name}" for name in names])


def _page(spark: SparkSession, folder: str, limit: int, offset: int) -> DataFrame:
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    last = offset + limit - 1
    needed = index.filter((F.col("last_position") >= offset) & (F.col("first_position") <= last))
    # No more than the page's rows.
    names = [row.file for row in needed.select("file").collect()]
    rows = _files(spark, folder, names).filter(F.col("position").between(offset, last))
    return rows.drop("position")


def indexed_page(
    spark: SparkSession, path: str, limit: int = LEADS_PER_PAGE, offset: int = 0
) -> DataFrame:
    """``limit`` leads from position ``offset`` in page order, as ``lead_page``
    gives them. A page behind the end has no rows."""
    return _page(spark, _folder(spark, path), limit, offset)


def indexed_page_from(
    spark: SparkSession, path: str, phone: str, limit: int = LEADS_PER_PAGE
) -> DataFrame:
    """``limit`` leads in page order from the first with ``phone`` or a later
    one, wherever that lies."""
    folder = _folder(spark, path)
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    # Missing phones come first and are before any.
    reaches = index.filter(F.col("last_phone") >= phone)
    first = reaches.agg(F.min_by("file", "first_position").alias("file")).first().file
    if first is None:
        return _page(spark, folder, 0, 0)
    rows = _files(spark, folder, [first]).filter(F.col("phone") >= phone)
    return _page(spark, folder, limit, rows.agg(F.min("position")).first()[0])


def indexed_pages(
    spark: SparkSession, path: str, page_rows: int = LEADS_PER_PAGE
) -> DataFrame:
    """All pages at once, each lead with its ``page_id``, without sorting."""
    stored = spark.read.schema(STORED).parquet(f"{_folder(spark, path)}/leads")
    page = F.floor(F.col("position") / page_rows).alias("page_id")
    return stored.select(page, *LEAD_BANK.fieldNames())
