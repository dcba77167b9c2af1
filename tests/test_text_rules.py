"""Collations, key ranges, rejected lines and byte limits."""

import random

import pytest
from pyspark.sql import functions as F

from dialtrail.operators import collated
from dialtrail.operators.status import last_call_status
from dialtrail.operators.summary import first_bytes, status_summary
from dialtrail.plans.report import lead_report
from dialtrail.sources import tables
from dialtrail.sources.key_ranges import range_bounds, range_predicates, read_by_ranges
from dialtrail.sources.rejects import calls_and_rejects, leads_and_rejects
from tests.tables import GOLDEN_CALLS, GOLDEN_LEADS, calls_of, day, leads_of, looped_report

PHONE = "phone_number_dialed"


def respelt(value, turn):
    return value if value is None else [value, value.lower(), value.capitalize()][turn % 3]


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("collation,spaces", [("UTF8_LCASE", 0), ("UTF8_LCASE_RTRIM", 2)])
def test_golden_case_by_collation(spark, collation, spaces):
    """Whatever way the texts are spelt, the report is the one over capitals."""
    leads = [(a, p and p.upper(), None, None, None, None) for a, p, *_ in GOLDEN_LEADS]
    calls = [
        (respelt(p and p.upper(), i), at, *[respelt(v, i) for v in others])
        for i, (p, at, *others) in enumerate(GOLDEN_CALLS)
    ]
    pad = [
        tuple(v + " " * (i % (spaces + 1)) if isinstance(v, str) else v for v in row)
        for i, row in enumerate(calls)
    ]
    by_rule = lead_report(
        collated.collated_leads(leads_of(spark, leads), collation),
        collated.collated_calls(calls_of(spark, pad), collation),
    )
    found = [tuple(r) for r in collated.plain_text(by_rule).collect()]
    capitals = [(p and p.upper(), *rest) for p, *rest in GOLDEN_CALLS]
    assert len(found) == len(looped_report(leads, capitals))
    # Shown is the first spelling of each status, spaces and all.
    spellings = {}
    for row in pad:
        if row[3] is not None:
            key = row[3].upper().rstrip(" ") if spaces else row[3].upper()
            spellings[key] = min(spellings.get(key, row[3]), row[3])

    def shown(row):
        status, text = row[14], row[16]
        items = [i.rsplit("(", 1) for i in (text or "").split(", ") if text]
        spelt = ", ".join(f"{spellings[s]}({n}" for s, n in items) or None
        return (*row[:14], spellings.get(status, status), row[15], spelt)

    expected = [shown(r) for r in looped_report(leads, capitals)]
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_one_spelling_of_leads_and_nulls(spark):
    leads = leads_of(
        spark, [(str(i), p, None, None, None, None) for i, p in enumerate(["a1", "A1", None, "b"])]
    )
    calls = calls_of(spark, [("a1", day(1), None, "drop", "ANSWER")])
    found = last_call_status(collated.collated_leads(leads), collated.collated_calls(calls))
    assert [tuple(r) for r in found.collect()] == [("A1", day(1), "drop")] * 2
    spelt = collated.one_spelling(leads, "phone")
    assert sorted(str(r.phone) for r in spelt.collect()) == ["A1", "A1", "None", "b"]
    many = spark.range(30).selectExpr("concat(if(id % 2 = 0, 'x', 'X'), id div 2) AS t", "id")
    by_join = collated.one_spelling(many, "t")
    assert {r.t for r in by_join.collect()} == {f"X{i}" for i in range(15)}


KEYS = ["", "a", "a'b", "''", 'quo"te', "ä", "日本", "9000", "9000 ", "back\\slash", "\n", "zz", None]


@pytest.mark.parametrize("ranges", [1, 2, 5, 40])
def test_each_row_is_in_one_range(spark, ranges):
    keys = KEYS * 3 + [f"9{i:05d}" for i in range(500)] + ["hot"] * 300
    df = spark.createDataFrame(list(enumerate(keys)), "id int, k string")
    predicates = range_predicates("k", range_bounds(df, "k", ranges, sampled=1))
    back = read_by_ranges(df, predicates)
    assert rows(back) == rows(df)
    if ranges == 5:
        sizes = [df.filter(p).count() for p in predicates]
        assert len(predicates) >= 4 and max(sizes) < 0.6 * len(keys)


def test_bounds_that_would_cut_rows_off_are_refused():
    for bounds in (["b", "a"], ["a", "a"], ["back\\slash"], ["ä"]):
        with pytest.raises(ValueError):
            range_predicates("k", bounds)
    assert range_predicates("k", []) == ["k IS NULL", "k IS NOT NULL"]
    assert "k < 'it''s'" in range_predicates("k", ["it's"])


HEADER = "status,phone_number_dialed,extra,call_date,campaign_id,dialstatus"


def test_lines_are_rows_or_rejects(spark, tmp_path):
    good = [
        "NSO,p1,x,2024-01-01 10:00:00,SALES_OUTBND,ANSWER",
        ",p2,,,,",
        '"a, ""b""",p3,x,2024-01-02,INB,ANSWER',
    ]
    bad = {
        "NSO,p1,x,2024-01-01 10:00:00,SALES_OUTBND": "cells",
        "NSO,p1,x,2024-01-01 10:00:00,SALES_OUTBND,ANSWER,more": "cells",
        "NSO,p1,x,yesterday,SALES_OUTBND,ANSWER": "call_date",
        '"open,p9,x,2024-01-01,INB,ANSWER': "cells",
    }
    (tmp_path / "1.csv").write_text("\n".join([HEADER, *good, ""]) + "\n")
    (tmp_path / "2.csv").write_text("\n".join([HEADER, *bad]) + "\n\n")
    calls, rejects = calls_and_rejects(spark, str(tmp_path))
    assert {r.line: r.reason for r in rejects.collect()} == bad
    assert sorted((r.phone_number_dialed, r.status) for r in calls.collect()) == [
        ("p1", "NSO"), ("p2", None), ("p3", 'a, "b"'),
    ]
    assert calls.schema == calls_of(spark, []).schema
    with pytest.raises(ValueError, match="lead_id"):
        leads_and_rejects(spark, str(tmp_path))


def test_json_lines_are_rows_or_rejects(spark, tmp_path):
    good = '{"phone_number_dialed":"p1","call_date":"2024-01-01","status":null,"other":1}'
    bad = {"not json": "json", '{"call_date":"x"}': "call_date", '{"status":': "json"}
    (tmp_path / "a.json").write_text("\n".join([good, *bad, "", "  "]) + "\n")
    calls, rejects = calls_and_rejects(spark, str(tmp_path), "json")
    assert {r.line: r.reason for r in rejects.collect()} == bad
    assert [tuple(r) for r in calls.collect()] == [("p1", day(1), None, None, None)]
    with pytest.raises(ValueError):
        calls_and_rejects(spark, str(tmp_path), "orc")


def test_empty_files_have_no_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        calls_and_rejects(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text(HEADER + "\n")
    calls, rejects = calls_and_rejects(spark, str(tmp_path))
    assert calls.count() == rejects.count() == 0


def test_json_with_all_names_is_read_once(spark, tmp_path, monkeypatch):
    leads = leads_of(spark, GOLDEN_LEADS)
    whole, sparse = str(tmp_path / "whole"), str(tmp_path / "sparse")
    leads.coalesce(1).write.option("ignoreNullFields", False).json(whole)
    ordered = leads.withColumn("city", F.when(F.col("lead_id") == "L8", "Ulm")).coalesce(1)
    ordered.write.json(sparse)  # the first record lacks names that the last one has
    inferred = []
    reader = type(spark.read)
    read = reader.json

    def spying(self, *args, **options):
        before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
        result = read(self, *args, **options)
        after = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
        inferred.append(len(after) > len(before))
        return result

    monkeypatch.setattr(reader, "json", spying)
    assert rows(tables.load_leads(spark, whole, "json")) == rows(leads)
    assert inferred == [False]
    with pytest.raises(Exception, match="name"):
        tables.load_leads(spark, sparse, "json").schema


def test_text_is_cut_on_whole_code_points(spark):
    random_ = random.Random(1)
    texts = ["".join(random_.choices("aé€😀", k=random_.randrange(12))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    limits = list(range(14))
    cut = df.select("t", *[first_bytes(F.col("t"), n).alias(f"c{n}") for n in limits])
    for row in cut.collect():
        for n in limits:
            whole = None if row.t is None else row.t.encode()[:n].decode("utf-8", "ignore")
            assert row[f"c{n}"] == whole


def test_summaries_of_1024_bytes(spark):
    """Long statuses, and one phone that a million leads share."""
    statuses = [f"Stätus€{i:03d}" for i in range(90)]
    calls = calls_of(spark, [("p1", day(1), None, s, "ANSWER") for s in statuses])
    calls = calls.unionByName(calls_of(spark, [("p2", day(1), None, "é", "ANSWER")]))
    leads = spark.range(1_000_001).selectExpr(
        "cast(id AS string) lead_id", "if(id = 0, 'p1', 'p2') phone", "'' name",
        "'' uploaded_date", "'' source", "'' city",
    )
    found = {
        r.phone_number_dialed: (r.status_summary, r.summary_cut)
        for r in status_summary(leads, calls, [], most_bytes=1024).collect()
    }
    whole = ", ".join(f"{s}(1)" for s in statuses)
    assert found["p1"] == (whole.encode()[:1024].decode("utf-8", "ignore"), True)
    shared = "é(1000000), " * 200
    assert found["p2"] == (shared.encode()[:1024].decode("utf-8", "ignore"), True)
    plain = status_summary(leads.limit(1), calls, []).collect()
    assert [r.status_summary for r in plain] == [whole]
    enough = status_summary(leads.limit(1), calls, [], most_bytes=4096).collect()
    assert [(r.status_summary, r.summary_cut) for r in enough] == [(whole, False)]
