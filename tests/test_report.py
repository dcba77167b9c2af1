"""The report on hand-worked and random tables, in each way it can be built."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dialtrail.operators.activity import lead_activity
from dialtrail.operators.lanes import hot_phones, roll_up_by_phone
from dialtrail.operators.score import lead_max_score
from dialtrail.operators.status import counted_last_status
from dialtrail.operators.summary import status_summary
from dialtrail.plans.report import lead_report, merge_reports, numbered_report
from tests.tables import (
    GOLDEN_CALLS,
    GOLDEN_LEADS,
    GOLDEN_REPORT,
    calls_of,
    day,
    leads_of,
    looped_report,
)

PHONES = ["p1", "p2", "p4", "p7"]


def merged(leads, calls, hot):
    return merge_reports(
        lead_activity(leads, calls),
        counted_last_status(leads, calls, hot),
        lead_max_score(leads, calls),
        status_summary(leads, calls, hot),
    )


def rows(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def golden(spark):
    return leads_of(spark, GOLDEN_LEADS), calls_of(spark, GOLDEN_CALLS)


@pytest.mark.parametrize("build", [lead_report, merged])
@pytest.mark.parametrize("hot", [[], PHONES])
def test_golden(golden, build, hot):
    assert rows(build(*golden, hot)) == Counter(GOLDEN_REPORT)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_golden_in_any_zone(spark, golden, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert rows(lead_report(*golden)) == Counter(GOLDEN_REPORT)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_loops_agree_with_golden():
    undated = [lead[:3] + (None,) + lead[4:] for lead in GOLDEN_LEADS]
    expected = [row[:3] + (None,) + row[4:] for row in GOLDEN_REPORT]
    assert Counter(looped_report(undated, GOLDEN_CALLS)) == Counter(expected)


def test_copies_are_numbered(golden):
    numbered = numbered_report(*golden, []).filter("phone = 'p7'")
    assert [row.copy_no for row in numbered.orderBy("copy_no").collect()] == [0, 1]


def test_empty_tables(spark, golden):
    leads, calls = golden
    nobody, nothing = leads.limit(0), calls.limit(0)
    assert lead_report(nobody, calls).count() == 0
    uncalled = lead_report(leads, nothing).collect()
    assert len(uncalled) == 7
    assert {row.max_score for row in uncalled} == {0}
    assert {row.max_call_date for row in uncalled} == {None}


def test_hot_phones_are_found(golden):
    _, calls = golden
    found = hot_phones(calls, "phone_number_dialed", hot_calls=2, sampled=1)
    assert sorted(row.hot_phone for row in found.collect()) == ["p1", "p4", "p7"]


def test_a_missing_phone_stays_ordinary(spark):
    calls = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "phone string")
    for hot in ([], ["a"], ["a", "b"], calls.select(F.col("phone").alias("hot_phone")).limit(1)):
        rolled = roll_up_by_phone(calls, "phone", lambda c: c.groupBy("phone").count(), hot)
        assert {r.phone: r["count"] for r in rolled.collect()} == {"a": 2, "b": 1, None: 1}


phone = st.sampled_from(["p1", "p2", "p3", None])
leads_rows = st.lists(phone, min_size=1, max_size=6).map(
    lambda phones: [(f"L{i}", p, f"n{i}", None, "s", "c") for i, p in enumerate(phones)]
)
calls_rows = st.lists(
    st.tuples(
        st.sampled_from(["p1", "p2", "p9", None]),
        st.sampled_from([1, 2, 3, None]).map(day),
        st.sampled_from(["A_BND", "B_INB", "OTHER", None]),
        st.sampled_from(["DROP", "TIMEOT", "DPSD", "NA", "ZZ", "", None]),
        st.sampled_from(["ANSWER", "FAILED", "NUMBER_FAILURE", None]),
    ),
    max_size=14,
)


@settings(
    max_examples=10,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(lead_rows=leads_rows, call_rows=calls_rows)
def test_random_tables(spark, lead_rows, call_rows):
    leads, calls = leads_of(spark, lead_rows), calls_of(spark, call_rows)
    expected = Counter(looped_report(lead_rows, call_rows))
    assert rows(lead_report(leads, calls, [])) == expected
    assert rows(lead_report(leads, calls, ["p1", "p9"])) == expected
    assert rows(merged(leads, calls, ["p2"])) == expected
