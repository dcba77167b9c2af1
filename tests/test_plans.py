"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import DataFrameWriter

from dialtrail.operators.calls import reachable_calls
from dialtrail.operators.score import lead_max_score
from dialtrail.operators.status import last_call_status
from dialtrail.operators.summary import status_summary
from dialtrail.plans.report import lead_report
from dialtrail.registry import queries
from dialtrail.sources.tables import load_calls, load_leads
from tests.tables import GOLDEN_CALLS, GOLDEN_LEADS, calls_of, leads_of

SF_DIR = "/root/testdata/sf0.001"
# These stage data when built, so their plan is only the last step.
STAGED = re.compile(
    "(paged_union|lead_page|publish_|report_snapshot|lead_bank_from_csv)"
    "|.*_(stored|kept|frequent|collated|accepted|rejects)(_[a-z]+)?$"
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    leads_of(spark, GOLDEN_LEADS).write.parquet(f"{folder}/leads")
    calls_of(spark, GOLDEN_CALLS).write.parquet(f"{folder}/calls")
    return load_leads(spark, f"{folder}/leads"), load_calls(spark, f"{folder}/calls")


@pytest.fixture
def no_automatic_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("name", [n for n in queries() if not STAGED.match(n)])
def test_no_product_and_no_python(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    for banned in ("CartesianProduct", "NestedLoop", "Python", "SinglePartition"):
        assert banned not in text or (banned, name) == ("SinglePartition", "lead_count")


@pytest.mark.parametrize("name", [n for n in queries() if STAGED.match(n)])
def test_no_product_and_no_single_task_before_staging(spark, monkeypatch, name):
    """What is written on the way, seen before it is. Only the starts of the
    range partitions, one row each, and the partitions' summaries of frequent
    phones, a bounded sketch each, are added up in one task."""
    seen = []

    def spying(writer, kind):
        write = getattr(writer, kind)

        def spy(self, *args, **options):
            seen.append(plan(self._df))
            return write(self, *args, **options)

        monkeypatch.setattr(writer, kind, spy)

    for kind in ("parquet", "csv"):
        spying(DataFrameWriter, kind)
    seen.append(plan(queries()[name](spark, SF_DIR)))
    assert len(seen) > 1
    for text in seen:
        for banned in ("CartesianProduct", "NestedLoop", "Python"):
            assert banned not in text
        for below in text.split("SinglePartition")[1:]:
            assert re.search("_size|approx_top_k", below.split("Exchange")[0])


def shuffles(text):
    return re.findall(r"(?<!Broadcast)Exchange hashpartitioning\(([^)]*)", text)


def keys(text):
    return [re.sub(r"#\d+L?", "", part) for part in shuffles(text)]


def test_report_shuffles_calls_once(no_automatic_broadcast, tables):
    text = plan(lead_report(*tables, []))
    # leads by phone, calls by phone, and the spread of the finished rows
    assert [k.rsplit(", ", 1)[0] for k in keys(text)].count("phone") == 2
    assert len(keys(text)) == 3
    assert text.count("BroadcastExchange") == 1  # the 30 scores
    assert text.count("FileScan") == 2


def test_hot_lane_joins_where_it_lies(no_automatic_broadcast, tables):
    text = plan(lead_report(*tables, ["p1"]))
    # the hot lane's own three; nothing after the union of the lanes
    assert len(keys(text)) == 6
    above_union = text[: text.index("Union")]
    assert len(shuffles(above_union)) == 2  # the finished rows, the leads


@pytest.mark.parametrize("operator", [last_call_status, status_summary])
def test_parts_shuffle_calls_once(no_automatic_broadcast, tables, operator):
    calls_side = [k for k in keys(plan(operator(*tables, []))) if "status" not in k]
    assert len(calls_side) == 2  # calls and leads, each by phone


def test_old_dates_go_before_the_shuffle(no_automatic_broadcast, tables):
    text = plan(last_call_status(*tables, ["p1", "p4"]))
    assert "WindowGroupLimit" in text


def test_call_filter_reaches_the_scan(tables):
    text = plan(reachable_calls(tables[1]))
    assert re.search(r"PushedFilters: \[Or\(IsNull\(dialstatus\),Not\(In\(dialstatus", text)


def test_score_keeps_failed_calls_until_the_join(tables):
    scan = plan(lead_max_score(*tables))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", scan)
    assert not any("dialstatus" in part for part in pushed)
