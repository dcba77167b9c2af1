"""Every registered query: an operator applied to a sample lead and call table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtrail.operators import (
    activity,
    calls,
    collated,
    frequent,
    leads,
    score,
    status,
    summary,
)
from dialtrail.operators.lanes import hot_phones
from dialtrail.operators.staging import fresh_path, staged
from dialtrail.plans import pages, publish, report, resume, rollup, snapshot
from dialtrail.schema import REPORT_COLUMNS
from dialtrail.sources import call_store, key_ranges, rejects, versions
from dialtrail.sources import sample_tables as samples
from dialtrail.sources.tables import load_leads

Query = Callable[[SparkSession, str], DataFrame]

# Suffix of the query name: the lead and call tables it runs over.
MAPPINGS = {
    "": (samples.sample_leads, samples.sample_calls),
    "_events": (samples.sample_leads, samples.sample_calls_by_day),
    "_shared": (samples.shared_leads, samples.shared_calls),
    "_dated": (samples.dated_leads, samples.sample_calls),
    "_prices": (samples.order_prices, samples.sample_calls),
    "_cased": (samples.cased_leads, samples.cased_calls),
    "_padded": (samples.cased_leads, samples.padded_calls),
    "_accented": (samples.sample_leads, samples.accented_calls),
}

PAGE = {"limit": 500, "offset": 400}
DEEP_PAGE = {"limit": 300, "offset": 1100}
SMALL_BATCH = 500
# Low enough for the phone with a third of the shared calls to take its own lane.
SAMPLE_HOT_CALLS = 1_000
SAMPLE_BUCKETS = 4
SAMPLE_FILE_ROWS = 100
PAGE_PHONE = "9000000700"
SAMPLE_RANGES = 8
SAMPLE_BYTES = 30


def _activity_part(*columns):
    return lambda lb, ch: activity.lead_activity(lb, ch).select("phone", *columns)


def _merged(lb, ch):
    hot = hot_phones(ch, "phone_number_dialed")
    return report.merge_reports(
        activity.lead_activity(lb, ch),
        status.counted_last_status(lb, ch, hot),
        score.lead_max_score(lb, ch),
        summary.status_summary(lb, ch, hot),
    )


def _snapshot(lb, ch):
    spark = lb.sparkSession
    return snapshot.load_or_compute(
        spark, fresh_path(spark, "snapshot"), lambda: report.lead_report(lb, ch)
    )


def _snapshot_reused(lb, ch):
    spark = lb.sparkSession
    path = fresh_path(spark, "snapshot")

    def not_again():
        raise RuntimeError("a snapshot that is there was built again")

    snapshot.load_or_compute(spark, path, lambda: report.lead_report(lb, ch))
    return snapshot.load_or_compute(spark, path, not_again)


def _written(lb, ch):
    spark = lb.sparkSession
    path = fresh_path(spark, "sheet")
    publish.write_batches(_small_batches(lb, ch), path)
    return publish.read_batches(spark, path, REPORT_COLUMNS)


def _from_csv(lb, ch):
    spark = lb.sparkSession
    path = fresh_path(spark, "leads")
    lb.select(*reversed(lb.columns)).write.options(header=True, escape='"').csv(path)
    return load_leads(spark, path, "csv")


def _broken_off(report, path):
    """What a write that breaks off leaves: a folder that no manifest names, and
    a manifest whose folder is not there."""
    spark = report.sparkSession
    report.write.parquet(versions.folder_of(path, "broken-off"))
    snapshot.save_snapshot(report.filter("phone IS NULL"), path)
    lost = {"sequence": 1_000, "token": "lost", "files": 1, "built_from": None}
    spark.createDataFrame([tuple(lost.values())], versions.MANIFEST).write.mode("append").json(
        f"{path}/manifest"
    )


def _snapshot_replaced(lb, ch):
    """An older report, a broken write on top of it, then the report itself."""
    spark = lb.sparkSession
    path = fresh_path(spark, "snapshot")
    snapshot.save_snapshot(report.lead_report(lb, calls.connected_calls(ch)), path, "day 1")
    _broken_off(report.lead_report(lb, ch), path)
    return snapshot.load_or_compute(
        spark, path, lambda: report.lead_report(lb, ch), built_from="day 2"
    )


def _snapshot_kept(lb, ch):
    """The report, and a broken write on top of it."""
    spark = lb.sparkSession
    path = fresh_path(spark, "snapshot")
    snapshot.save_snapshot(report.lead_report(lb, ch), path)
    report.lead_report(lb, ch).limit(5).write.parquet(versions.folder_of(path, "broken-off"))
    return snapshot.load_or_compute(spark, path, lambda: lb.sparkSession.range(0))


def _resumed(lb, ch):
    """Batches of an older report are published first; what differs is replaced."""
    spark = lb.sparkSession
    path = fresh_path(spark, "sheet")
    older = report.numbered_report(lb, ch.filter("campaign_id IS NOT NULL"))
    resume.publish_resumable(publish.publish_batches(older, SMALL_BATCH), path, 2)
    resume.publish_resumable(_small_batches(lb, ch), path, 2)
    return resume.read_published(spark, path, REPORT_COLUMNS)


def _stored(operator):
    """The operator over a call store, the sample's hot phones in its hot part."""

    def run(lb, ch):
        path = fresh_path(lb.sparkSession, "calls")
        call_store.write_call_store(ch, path, SAMPLE_BUCKETS, SAMPLE_HOT_CALLS)
        return operator(lb, call_store.open_call_store(lb.sparkSession, path))

    return run


def _stored_in_two(lb, ch):
    spark = lb.sparkSession
    path = fresh_path(spark, "calls")
    early = F.pmod(F.xxhash64(*ch.columns), F.lit(2)) == 0
    call_store.write_call_store(ch.filter(early), path, SAMPLE_BUCKETS, SAMPLE_HOT_CALLS)
    call_store.add_calls(spark, path, ch.filter(~early))
    return call_store.stored_calls(spark, path)


def _kept(lb, ch):
    """The log arrives in three batches, dates in no order, one of them twice."""
    spark = lb.sparkSession
    path = fresh_path(spark, "rollup")
    part = F.pmod(F.xxhash64(*ch.columns), F.lit(3))
    for number in (2, 0, 1, 0):
        rollup.merge_calls(spark, path, ch.filter(part == number), f"batch {number}", SAMPLE_BUCKETS)
    return rollup.kept_report(lb, path)


def _indexed(read):
    def run(lb, ch):
        path = fresh_path(lb.sparkSession, "pages")
        pages.write_page_index(lb, path, SAMPLE_FILE_ROWS)
        return read(lb.sparkSession, path)

    return run


def _frequent(operator):
    """The operator with hot phones from the summaries of two parts of the log."""

    def run(lb, ch):
        early = F.pmod(F.xxhash64(*ch.columns), F.lit(2)) == 0
        parts = [
            frequent.key_summary(ch.filter(part), call_store.PHONE) for part in (early, ~early)
        ]
        both = staged(frequent.merged_summaries(parts[0].unionByName(parts[1])), "summary")
        return operator(lb, ch, frequent.frequent_keys(both, SAMPLE_HOT_CALLS).drop("n"))

    return run


def _collated(operator):
    """The operator by a collation that looks neither at case nor at spaces behind."""
    rule = "UTF8_LCASE_RTRIM"

    def run(lb, ch):
        result = operator(collated.collated_leads(lb, rule), collated.collated_calls(ch, rule))
        return collated.plain_text(result)

    return run


def _by_ranges(lb, ch):
    bounds = key_ranges.range_bounds(ch, call_store.PHONE, SAMPLE_RANGES, sampled=1)
    return key_ranges.read_by_ranges(ch, key_ranges.range_predicates(call_store.PHONE, bounds))


def _lines_with_faults(ch):
    """The calls as CSV lines: a cell too many, or a date that is none, for some."""
    phone = F.col(call_store.PHONE)
    date = F.when(phone.endswith("4"), "soon").otherwise(F.col("call_date").cast("string"))
    cells = [F.coalesce(date if c == "call_date" else c, F.lit("")) for c in ch.columns]
    line = F.concat(F.concat_ws(",", *cells), F.when(phone.endswith("7"), ",more").otherwise(""))
    path = fresh_path(ch.sparkSession, "lines")
    header = ch.sparkSession.sql("SELECT :names line", {"names": ",".join(ch.columns)})
    header.unionByName(ch.select(line.alias("line"))).write.text(path)
    return path


def _accepted(part):
    return lambda lb, ch: rejects.calls_and_rejects(lb.sparkSession, _lines_with_faults(ch))[part]


def _bounded(lb, ch):
    return summary.status_summary(lb, ch, most_bytes=SAMPLE_BYTES)


def _hot(operator):
    """The operator with the hottest sample phones in their own lane."""

    def run(lb, ch):
        hot = hot_phones(ch, "phone_number_dialed", SAMPLE_HOT_CALLS, sampled=1)
        return operator(lb, ch, hot)

    return run


def _batches(lb, ch):
    return publish.publish_batches(report.numbered_report(lb, ch))


def _small_batches(lb, ch):
    return publish.publish_batches(report.numbered_report(lb, ch), SMALL_BATCH)


# name: (operator over leads and calls, suffixes it is registered under)
OPERATORS = {
    "lead_bank": (lambda lb, ch: lb, ["", "_shared"]),
    "call_history": (lambda lb, ch: ch, ["", "_events", "_shared"]),
    "lead_bank_from_csv": (_from_csv, [""]),
    "lead_count": (lambda lb, ch: leads.lead_count(lb), [""]),
    "lead_page": (lambda lb, ch: leads.lead_page(lb, **PAGE), ["", "_shared"]),
    "lead_page_deep": (lambda lb, ch: leads.lead_page(lb, **DEEP_PAGE), [""]),
    "paged_union": (lambda lb, ch: leads.paged_leads(lb, SMALL_BATCH), ["", "_shared"]),
    "reachable_calls": (lambda lb, ch: calls.reachable_calls(ch), [""]),
    "connected_calls": (lambda lb, ch: calls.connected_calls(ch), [""]),
    "first_last_call": (_activity_part("first_call_date", "last_call_data"), [""]),
    "direction_counts": (
        _activity_part("out_bound_count", "in_bound_count"),
        ["", "_shared"],
    ),
    "latest_drop": (_activity_part("latest_drop_call_date"), [""]),
    "latest_outbound": (_activity_part("max_out_bound_call_date"), [""]),
    "outbound_after_drop": (_activity_part("outbound_after_drop"), ["", "_events"]),
    "lead_activity": (activity.lead_activity, ["", "_events", "_shared"]),
    "max_call_dates": (status.max_call_dates, ["", "_events", "_shared"]),
    "last_call_status": (status.last_call_status, ["", "_events", "_shared"]),
    "stage_scores": (lambda lb, ch: calls.stage_usage(ch), ["", "_events"]),
    "scored_calls": (lambda lb, ch: calls.scored_calls(ch), [""]),
    "lead_max_score": (score.lead_max_score, ["", "_events", "_shared"]),
    "status_counts": (summary.status_counts, ["", "_events", "_shared"]),
    "status_summary": (summary.status_summary, ["", "_events", "_shared"]),
    "uploaded_date_fmt": (
        lambda lb, ch: leads.with_report_date(lb.select("lead_id", "uploaded_date")),
        ["", "_dated"],
    ),
    "lead_report": (report.lead_report, ["", "_events", "_shared"]),
    "lead_report_merged": (_merged, ["", "_events", "_shared"]),
    "lead_report_published": (
        lambda lb, ch: publish.published(report.lead_report(lb, ch)),
        ["", "_events", "_shared"],
    ),
    "publish_batches": (_batches, ["", "_events"]),
    "publish_small_batches": (_small_batches, ["", "_events", "_shared"]),
    "report_snapshot": (_snapshot, ["", "_shared"]),
    "report_snapshot_reused": (_snapshot_reused, [""]),
    "publish_written": (_written, ["", "_shared"]),
    "cells_published": (lambda lb, ch: publish.published(lb), ["_prices"]),
    "last_call_status_hot": (_hot(status.last_call_status), ["_shared"]),
    "status_summary_hot": (_hot(summary.status_summary), ["_shared"]),
    "lead_report_hot": (_hot(report.lead_report), ["_shared"]),
    "last_call_status_frequent": (_frequent(status.last_call_status), ["_shared"]),
    "lead_report_frequent": (_frequent(report.lead_report), ["_shared"]),
    "call_history_stored": (_stored_in_two, ["", "_shared"]),
    "lead_activity_stored": (_stored(activity.lead_activity), ["", "_shared"]),
    "last_call_status_stored": (_stored(status.last_call_status), ["", "_shared"]),
    "lead_max_score_stored": (_stored(score.lead_max_score), ["", "_shared"]),
    "status_summary_stored": (_stored(summary.status_summary), ["", "_shared"]),
    "lead_report_stored": (_stored(report.lead_report), ["", "_events", "_shared"]),
    "lead_report_kept": (_kept, ["", "_events", "_shared"]),
    "lead_report_collated": (_collated(report.lead_report), ["_cased", "_padded"]),
    "last_call_status_collated": (_collated(status.last_call_status), ["_cased", "_padded"]),
    "call_history_by_ranges": (_by_ranges, ["", "_shared"]),
    "call_history_accepted": (_accepted(0), [""]),
    "call_rejects": (_accepted(1), [""]),
    "status_summary_bounded": (_bounded, ["_accented", "_shared"]),
    "report_snapshot_replaced": (_snapshot_replaced, [""]),
    "report_snapshot_kept": (_snapshot_kept, [""]),
    "publish_resumed": (_resumed, ["", "_shared"]),
    "lead_page_indexed": (_indexed(lambda s, p: pages.indexed_page(s, p, **PAGE)), ["", "_shared"]),
    "lead_page_deep_indexed": (_indexed(lambda s, p: pages.indexed_page(s, p, **DEEP_PAGE)), [""]),
    "lead_page_from": (
        _indexed(lambda s, p: pages.indexed_page_from(s, p, PAGE_PHONE, PAGE["limit"])),
        ["", "_shared"],
    ),
    "paged_union_indexed": (
        _indexed(lambda s, p: pages.indexed_pages(s, p, SMALL_BATCH)),
        ["", "_shared"],
    ),
}


def _over(operator, mapping) -> Query:
    lead_source, call_source = mapping

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(lead_source(spark, sf_dir), call_source(spark, sf_dir))

    return run


def queries() -> dict[str, Query]:
    return {
        name + suffix: _over(operator, MAPPINGS[suffix])
        for name, (operator, suffixes) in OPERATORS.items()
        for suffix in suffixes
    }
