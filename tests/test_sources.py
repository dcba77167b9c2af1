from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from dialtrail.operators.leads import with_report_date
from dialtrail.operators.staging import fresh_path, staged_paths, staging_folder
from dialtrail.schema import CALL_HISTORY, LEAD_BANK
from dialtrail.sources import tables
from tests.tables import GOLDEN_CALLS, GOLDEN_LEADS, calls_of, leads_of


def test_extra_columns_are_not_read(spark, tmp_path):
    path = str(tmp_path / "calls")
    calls_of(spark, GOLDEN_CALLS).selectExpr("1 AS agent", "*").write.parquet(path)
    loaded = tables.load_calls(spark, path)
    assert loaded.schema == CALL_HISTORY
    assert loaded.count() == len(GOLDEN_CALLS)
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "agent" not in plan


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_leads_from_files(spark, tmp_path, fmt):
    path = str(tmp_path / "leads")
    # Each format in its own column order; JSON without nulls would lack columns.
    leads = leads_of(spark, GOLDEN_LEADS).select(*reversed(LEAD_BANK.fieldNames()))
    leads.write.format(fmt).options(header=True, ignoreNullFields=False).save(path)
    loaded = tables.load_leads(spark, path, fmt)
    assert loaded.schema == LEAD_BANK
    assert sorted(map(str, loaded.collect())) == sorted(
        map(str, leads_of(spark, GOLDEN_LEADS).collect())
    )


def test_leads_and_calls_from_views(spark):
    leads_of(spark, GOLDEN_LEADS).createOrReplaceTempView("lead_bank")
    calls_of(spark, GOLDEN_CALLS).createOrReplaceTempView("call_history")
    assert tables.leads_table(spark).count() == len(GOLDEN_LEADS)
    assert tables.calls_table(spark).count() == len(GOLDEN_CALLS)


def test_missing_column_is_an_error(spark, tmp_path):
    path = str(tmp_path / "leads")
    leads_of(spark, GOLDEN_LEADS).drop("phone").write.parquet(path)
    with pytest.raises(Exception, match="phone"):
        tables.load_leads(spark, path).schema


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_calls_from_text_files(spark, tmp_path, fmt):
    path = str(tmp_path / "calls")
    calls = calls_of(spark, GOLDEN_CALLS)
    calls.select(*reversed(calls.columns)).write.format(fmt).options(header=True).save(path)
    loaded = tables.load_calls(spark, path, fmt)
    assert loaded.schema == CALL_HISTORY
    if fmt == "csv":  # which cannot tell '' from null
        calls = calls.replace({"": None}, subset=["status"])
    assert sorted(map(str, loaded.collect())) == sorted(map(str, calls.collect()))


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_missing_column_in_text_is_an_error(spark, tmp_path, fmt):
    path = str(tmp_path / "leads")
    leads = leads_of(spark, GOLDEN_LEADS).drop("phone")
    leads.write.format(fmt).options(header=True, ignoreNullFields=False).save(path)
    with pytest.raises(Exception, match="phone"):
        tables.load_leads(spark, path, fmt).schema


def test_headers_that_differ_are_an_error(spark, tmp_path):
    path = str(tmp_path / "leads")
    leads = leads_of(spark, GOLDEN_LEADS).coalesce(1)
    leads.write.options(header=True).csv(path)
    leads.select(*reversed(leads.columns)).write.mode("append").options(header=True).csv(path)
    with pytest.raises(Exception):
        tables.load_leads(spark, path, "csv").collect()


@pytest.mark.parametrize("column", ["name", "city"])
def test_line_ends_inside_quotes(spark, tmp_path, column):
    path = str(tmp_path / "leads")
    leads = leads_of(spark, GOLDEN_LEADS).withColumn(column, F.lit("two\nlines, really"))
    leads.write.options(header=True, escape='"').csv(path)
    loaded = tables.load_leads(spark, path, "csv", multi_line=True)
    assert sorted(map(str, loaded.collect())) == sorted(map(str, leads.collect()))
    with pytest.raises(Exception, match="(?i)malformed|column"):
        tables.load_leads(spark, path, "csv").collect()


def test_jdbc_by_predicates(spark, monkeypatch):
    seen = {}

    def jdbc(self, url, table, predicates, properties):
        seen.update(url=url, table=table, predicates=predicates, properties=properties)
        return leads_of(spark, GOLDEN_LEADS)

    monkeypatch.setattr(type(spark.read), "jdbc", jdbc)
    split = ["phone < '5'", "phone >= '5' OR phone IS NULL"]
    options = {"url": "jdbc:x", "user": "u"}
    assert tables.jdbc_leads(spark, options, predicates=split).schema == LEAD_BANK
    assert seen["predicates"] == split and seen["table"] == "lead_bank"
    assert seen["properties"] == {"preferTimestampNTZ": "true", "user": "u"}


def test_jdbc_must_be_split(spark):
    with pytest.raises(ValueError, match="partitionColumn"):
        tables.jdbc_calls(spark, {"url": "jdbc:mysql://nowhere/x"})


def test_staging_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert staging_folder(spark) == shared
    assert fresh_path(spark, "x").startswith(f"{shared}/x-")
    assert staged_paths()[-1].startswith(f"{shared}/x-")


def test_staging_falls_back_to_the_warehouse(spark, monkeypatch):
    conf = {"spark.sql.warehouse.dir": "store:/warehouse/"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, *d: conf.get(k, *d)))
    assert staging_folder(session) == "store:/warehouse/_staged"
    conf["spark.checkpoint.dir"] = "store:/shared"
    assert staging_folder(session) == "store:/shared"
    conf["spark.dialtrail.staging.dir"] = "store:/mine"
    assert staging_folder(session) == "store:/mine"


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_report_date_forms(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        check_report_date_forms(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def check_report_date_forms(spark):
    texts = {
        "2024-03-05 10:00:00": "05/03/2024",
        "2024-03-05": "05/03/2024",
        "2024-03-05T23:30:00.000Z": "05/03/2024",
        "2024/03/05": "05/03/2024",
        "2024/3/5 07:08": "05/03/2024",
        "05/03/2024": "03/05/2024",  # month first
        "25/03/2024": "25/03/2024",
        "20240305": "05/03/2024",
        "5 Mar 2024": "05/03/2024",
        "5 march 2024": "05/03/2024",
        "March 5, 2024": "05/03/2024",
        "Sept. 30 2024": "30/09/2024",
        "2024-03-05 10:00 AM": "05/03/2024",
        "2024-03-10 02:30:00 PM": "10/03/2024",
        "2024-03-05 25:00 AM": None,
        "31/31/2024": None,
        "5 Foo 2024": None,
        "not a date": None,
        "2024-02-30": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(text,) for text in texts], "uploaded_date string")
    found = [row[0] for row in with_report_date(df).collect()]
    assert found == list(texts.values())


def test_report_date_needs_its_column(spark):
    df = spark.range(1)
    assert with_report_date(df) is df
