"""Positions, batches, snapshots and exports."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dialtrail.operators import leads as lead_ops
from dialtrail.operators.ordinal import with_ordinal
from dialtrail.operators.repeat import COPIES_PER_RUN, repeat_rows
from dialtrail.plans.publish import publish_batches, published, write_batches
from dialtrail.plans.report import lead_report, numbered_report
from dialtrail.plans.snapshot import (
    export_csv,
    has_snapshot,
    load_or_compute,
    read_csv_report,
)
from dialtrail.schema import LEAD_REPORT, REPORT_COLUMNS
from dialtrail.sources import versions
from tests.tables import GOLDEN_CALLS, GOLDEN_LEADS, calls_of, leads_of


@pytest.fixture(scope="module")
def golden(spark):
    return leads_of(spark, GOLDEN_LEADS), calls_of(spark, GOLDEN_CALLS)


def test_ordinal_equals_global_row_number(spark):
    df = spark.range(50_000).select(
        F.when(F.col("id") % 7 > 0, (F.col("id") * 7919) % 1000).alias("a"),
        F.col("id").alias("b"),
    )
    by_window = F.row_number().over(Window.orderBy("a", "b")) - 1
    numbered = with_ordinal(df, ["a", "b"], "position")
    assert numbered.count() == 50_000
    assert numbered.filter(F.col("position") < 0).count() == 0
    expected = df.withColumn("position", by_window.cast("bigint"))
    assert numbered.exceptAll(expected).count() == 0


def test_repeated_rows_are_whole_and_spread(spark):
    many = 3 * COPIES_PER_RUN + 1
    df = spark.createDataFrame([("a", many), ("b", 1), (None, 2)], "k string, n bigint")
    repeated = repeat_rows(df, "n", ["k"])
    counts = {
        row.k: (row.n, row.numbers, row.first, row.last)
        for row in repeated.groupBy("k")
        .agg(
            F.count("*").alias("n"),
            F.countDistinct("copy_no").alias("numbers"),
            F.min("copy_no").alias("first"),
            F.max("copy_no").alias("last"),
        )
        .collect()
    }
    assert counts == {"a": (many, many, 0, many - 1), "b": (1, 1, 0, 0), None: (2, 2, 0, 1)}
    spread = repeated.filter("k = 'a'").select(F.spark_partition_id()).distinct()
    assert spread.count() > 1


def test_many_copies_are_spread_evenly(spark):
    """As Spark comes, adaptive plans included."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        copies = 20_000_000
        df = spark.createDataFrame([("a", copies)], "k string, n bigint")
        sizes = repeat_rows(df, "n", ["k"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(r["count"] for r in sizes) == copies
    assert len(sizes) > 55
    assert max(r["count"] for r in sizes) < 3 * copies / 64


def test_second_batch(spark):
    report = spark.range(250_000).select(
        F.lpad(F.col("id").cast("string"), 7, "0").alias("phone"),
        F.lit(None).cast("string").alias("last_call_status"),
    )
    batches = publish_batches(report)
    sizes = {
        row.batch_id: (row.n, row.first, row.last)
        for row in batches.groupBy("batch_id")
        .agg(
            F.count("*").alias("n"),
            F.min("sheet_row").alias("first"),
            F.max("sheet_row").alias("last"),
        )
        .collect()
    }
    # The header is row 1 and takes a place in batch 0.
    assert sizes == {
        0: (99_999, 2, 100_000),
        1: (100_000, 100_001, 200_000),
        2: (50_001, 200_001, 250_001),
    }
    misplaced = batches.filter(F.col("sheet_row") != F.col("phone").cast("bigint") + 2)
    assert misplaced.count() == 0


def test_page_equals_top_k(spark):
    leads = spark.range(1_000).select(
        F.col("id").cast("string").alias("lead_id"),
        ((F.col("id") * 37) % 300).cast("string").alias("phone"),
    )
    page = lead_ops.lead_page(leads, 50, 200).collect()
    top_k = leads.orderBy("phone", "lead_id").offset(200).limit(50).collect()
    assert len(page) == 50
    assert sorted(map(tuple, page)) == sorted(map(tuple, top_k))


def test_published_text(spark):
    df = spark.sql(
        """SELECT double('inf') AS a, double('-inf') AS b, double('nan') AS c, 1.5D AS d,
           CAST(NULL AS INT) AS e, 30 AS f, TIMESTAMP_NTZ'2024-03-10 02:30:00' AS g, '' AS h"""
    )
    assert tuple(published(df).first()) == (
        "", "", "", "1.5", "", "30", "2024-03-10 02:30:00", "",
    )


def test_written_batches_read_back(spark, golden, tmp_path):
    batches = publish_batches(numbered_report(*golden), batch_rows=4)
    for _ in range(2):  # publishing again replaces
        write_batches(batches, str(tmp_path / "sheet"))
    folder = versions.current(spark, str(tmp_path / "sheet")).path
    back = spark.read.option("header", True).csv(folder)
    assert set(back.columns) == {"batch_id", "sheet_row", *REPORT_COLUMNS}
    sizes = {int(r.batch_id): r["count"] for r in back.groupBy("batch_id").count().collect()}
    assert sizes == {0: 3, 1: 4, 2: 2}
    by_row = sorted(back.collect(), key=lambda row: int(row.sheet_row))
    assert [row.phone for row in by_row] == [
        None, "p1", "p2", "p3", "p4", "p4", "p6", "p7", "p7",
    ]


def test_report_without_numbers_is_published_alike(golden):
    numbered = publish_batches(numbered_report(*golden), batch_rows=4)
    plain = publish_batches(lead_report(*golden), batch_rows=4)
    assert plain.columns == numbered.columns
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, numbered.collect()))


def test_snapshot_is_built_once_and_typed(spark, golden, tmp_path):
    path = str(tmp_path / "snapshot")
    built = []

    def build():
        built.append(1)
        return lead_report(*golden)

    fresh = load_or_compute(spark, path, build)
    reused = load_or_compute(spark, path, build)
    assert built == [1]
    assert reused.schema == LEAD_REPORT
    assert reused.exceptAll(lead_report(*golden)).count() == 0
    assert fresh.count() == reused.count() == 9


def test_unfinished_snapshot_is_rebuilt(spark, golden, tmp_path):
    path = tmp_path / "snapshot"
    os.makedirs(path)
    (path / "part-00000.parquet").write_bytes(b"broken off")
    assert not has_snapshot(spark, str(path))
    assert load_or_compute(spark, str(path), lambda: lead_report(*golden)).count() == 9


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    report = spark.createDataFrame(
        [("L1", "0987", 'a "quoted", name\nin two lines', "05/03/2024", "s", None)
         + (None, None, 1, 0, None, None, "no", None, "NA", 30, "NA(1), ZZ(2)")],
        LEAD_REPORT,
    )
    export_csv(report, path)
    back = read_csv_report(spark, path)
    assert back.schema == LEAD_REPORT
    assert back.collect() == report.collect()


def test_csv_keeps_dates(spark, golden, tmp_path):
    path = str(tmp_path / "csv")
    report = lead_report(*golden)
    export_csv(report, path)
    dates = ["phone", "first_call_date", "max_call_date"]
    back = read_csv_report(spark, path).select(dates)
    assert back.exceptAll(report.select(dates)).count() == 0
