"""What each of several filters removes, in every order they may be applied in.

Filters that look at a document alone form a removal game: the worth of a
coalition of filters is the number of documents that any of them fails. One pass
over the documents counts, for each part, how many fail which filters. From the
worths of all coalitions follow the steps of every order, as differences, and
the Hart-Mas-Colell potential, computed recursively: a coalition's potential is
its worth plus the potentials of it without each of its filters, over its size.
A filter's Shapley value is the potential of all filters minus that of all
others.
"""

import itertools
import math
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtrail.operators.staging import staged

# Orders of one part are n! rows times n; a part is worked on as a whole.
MOST_FILTERS = 7

WORD_BREAKS = "[\\x20\\x09-\\x0D]+"
FEWEST_WORDS = 200
LEAST_DISTINCT = 50  # percent of the words
MOST_CAPITALS = 2  # percent of the code points
MARKS = "[#$%&*|]"

MEASURES = ("n_docs", "n_good", "n_toxic")
COUNTS = (
    "kept",
    "removed",
    "redundant",
    "unique_fails",
    "good_lost",
    "toxic_lost",
    "shapley",
)


def text_filters(text: str = "text") -> dict[str, Column]:
    """Failure conditions that need the text alone; never null. A null text is
    empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, WORD_BREAKS), lambda w: w != "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(whole, "[^A-Z]+", ""))
    return {
        "A": n_words < FEWEST_WORDS,
        "B": n_distinct.cast("bigint") * 100 < n_words.cast("bigint") * LEAST_DISTINCT,
        "C": capitals.cast("bigint") * 100 > F.length(whole).cast("bigint") * MOST_CAPITALS,
        "D": whole.rlike(MARKS),
    }


def failed(filters: Mapping[str, Column]) -> Column:
    """A bit for each filter that is failed, the first filter's the lowest."""
    bits = [
        F.when(fails, F.lit(1 << i)).otherwise(F.lit(0))
        for i, fails in enumerate(filters.values())
    ]
    return sum(bits[1:], bits[0])


def later_copies(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, digest, n, ..) with ``is_copy``: a smaller doc_id has
    the same digest. A null doc_id is no smaller and has none smaller.

    The least id of a digest is found with map-side merging and meets the rows
    on digest and id, so a text with a third of all rows is no task's work.
    """
    known = rows.filter(F.col("doc_id").isNotNull())
    least = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn(
        "is_first", F.lit(True)
    )
    marked = known.join(least, ["digest", "doc_id"], "left")
    is_copy = F.col("is_first").isNull().alias("is_copy")
    without_id = rows.filter(F.col("doc_id").isNull()).withColumn("is_copy", F.lit(False))
    return marked.select(*rows.columns, is_copy).unionByName(without_id)


def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic), one row per doc_id: 1 if any of its rows says so."""
    says = [
        F.max(F.when(F.col(name) == 1, 1).otherwise(0)).alias(out)
        for name, out in (("quality", "good"), ("toxic", "toxic"))
    ]
    return labels.filter(F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")
    ).agg(*says)


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n_docs, n_good, n_toxic): the documents of each source that
    fail just these of the filters A to E (stages a short row per document).

    E, an identical text under a smaller doc_id anywhere in the table, is the
    highest bit. Equal texts are told by SHA-256. Equal rows are merged into one
    with a count, before any join.
    """
    text = F.coalesce("text", F.lit(""))
    rows = staged(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
            F.sha2(text.cast("binary"), 256).alias("digest"),
            failed(text_filters()).alias("failed"),
        )
        .withColumn("digest", F.unhex("digest"))
        .groupBy("doc_id", "part", "digest", "failed")
        .agg(F.count("*").alias("n")),
        "failed",
    )
    copy_bit = 1 << len(text_filters())
    marked = later_copies(rows).withColumn(
        "failed", F.col("failed") + F.when(F.col("is_copy"), copy_bit).otherwise(0)
    )
    # Rows without an id have no label and no place in the join.
    labelled = marked.filter(F.col("doc_id").isNotNull()).join(
        known_labels(labels), "doc_id", "left"
    )
    plain = marked.filter(F.col("doc_id").isNull()).withColumns(
        {"good": F.lit(0), "toxic": F.lit(0)}
    )
    return (
        labelled.unionByName(plain)
        .groupBy("part", "failed")
        .agg(
            F.sum("n").alias("n_docs"),
            F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("n_good"),
            F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("n_toxic"),
        )
    )


def worths(counts: np.ndarray, n_filters: int) -> np.ndarray:
    """What each coalition of filters removes: (.., 2 ** n) sums, over sets of
    failed filters, of those that share a filter with the coalition."""
    sets = np.arange(1 << n_filters)
    meets = (sets[:, None] & sets[None, :]) != 0
    return counts @ meets.astype(np.int64)


def potentials(worth: np.ndarray, n_filters: int) -> np.ndarray:
    """n! times the potential of each coalition, in whole numbers: a coalition's
    denominators divide the factorial of its size."""
    scale = math.factorial(n_filters)
    potential = np.zeros_like(worth)
    for coalition in sorted(range(1, 1 << n_filters), key=int.bit_count):
        inside = [i for i in range(n_filters) if coalition >> i & 1]
        total = scale * worth[..., coalition]
        for i in inside:
            total = total + potential[..., coalition ^ 1 << i]
        potential[..., coalition] = total // len(inside)
    return potential


def order_table(names: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Every order of the filters, step by step: the orders' names, the step, its
    filter's place in ``names`` and the coalition before the step."""
    n = len(names)
    orders, steps, filters, before = [], [], [], []
    for order in itertools.permutations(range(n)):
        done = 0
        for step, i in enumerate(order, 1):
            orders.append("".join(names[j] for j in order))
            steps.append(step)
            filters.append(i)
            before.append(done)
            done |= 1 << i
    return orders, np.array(steps), np.array(filters), np.array(before)


def audit(counts: DataFrame, names: str = "ABCDE") -> DataFrame:
    """The audit of each part from ``counts`` (part, failed, n_docs, n_good,
    n_toxic); a bit of ``failed`` for each letter of ``names``, the first the
    lowest. One row for each part, order of the filters and step, zeros included.

    A part comes to one row of at most 2 ** n counts before any task sees it
    whole. No rows give no rows.
    """
    n = len(names)
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"from 1 to {MOST_FILTERS} filters")
    orders, steps, filters, before = order_table(names)
    after = before | 1 << filters
    everything = (1 << n) - 1
    entry = F.struct("failed", *MEASURES)
    parts = counts.groupBy("part").agg(F.collect_list(entry).alias("entries"))

    def rows_of(entries) -> dict[str, np.ndarray]:
        games = np.zeros((len(MEASURES), 1 << n), np.int64)
        for e in entries:
            games[:, e["failed"]] += [e[m] for m in MEASURES]
        worth = worths(games, n)
        docs, good, toxic = worth
        removed = docs[after] - docs[before]
        grand = potentials(docs, n)
        return {
            "kept": games[0].sum() - docs[after],
            "removed": removed,
            "redundant": docs[1 << filters] - removed,
            "unique_fails": docs[everything] - docs[everything ^ 1 << filters],
            "good_lost": good[after] - good[before],
            "toxic_lost": toxic[after] - toxic[before],
            "shapley": grand[everything] - grand[everything ^ 1 << filters],
        }

    def run(batches):
        for batch in batches:
            for part, entries in zip(
                batch.column("part").to_pylist(), batch.column("entries").to_pylist()
            ):
                found = rows_of(entries)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(orders), pa.string()),
                        pa.array(orders, pa.string()),
                        pa.array(steps, pa.int32()),
                        *(pa.array(found[c], pa.int64()) for c in COUNTS),
                    ],
                    ["part", "filter_order", "step", *COUNTS],
                )

    longs = ", ".join(f"{c} bigint" for c in COUNTS)
    return parts.mapInArrow(run, f"part string, filter_order string, step int, {longs}")


def audited_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over every source of ``docs``.

    A null text is empty, a null source is the part '', a document without a
    label is neither good nor toxic, equal rows each count, and columns other
    than doc_id, text and source are not looked at. No documents give no rows.
    """
    return audit(failure_counts(docs, labels))


ORACLE_SQL = r"""
with docs as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as body from documents),
words as (
  select *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as words,
         min(doc_id) over (partition by body) as least
  from docs),
labelled as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good,
         max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id),
fails as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
         list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: case f
           when 'A' then len(words) < 200
           when 'B' then 100 * len(list_distinct(words)) < 50 * len(words)
           when 'C' then 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * length(body)
           when 'D' then regexp_matches(body, '[#$%&*|]')
           else coalesce(words.doc_id > least, false) end) as failed
  from words left join labelled on labelled.doc_id = words.doc_id),
kinds as (
  select part, failed, count(*) as n, sum(good) as n_good, sum(toxic) as n_toxic
  from fails group by part, failed),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps as (
  select filter_order, step, filter_order[step] as own,
         string_split(filter_order[1:step], '') as upto,
         case when step = 1 then [] else string_split(filter_order[1:step - 1], '') end as before
  from orders, (select unnest(range(1, 6)) as step)),
removals as (
  select part, filter_order, step, own,
         sum(case when list_has_any(failed, upto) then 0 else n end) as kept,
         sum(case when hits and not gone then n else 0 end) as removed,
         sum(case when hits and gone then n else 0 end) as redundant,
         sum(case when failed = [own] then n else 0 end) as unique_fails,
         sum(case when hits and not gone then n_good else 0 end) as good_lost,
         sum(case when hits and not gone then n_toxic else 0 end) as toxic_lost
  from (select kinds.*, steps.*, list_contains(failed, own) as hits,
               list_has_any(failed, before) as gone
        from kinds, steps)
  group by all)
select part, filter_order, cast(step as integer) as step,
       cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, own) as bigint) as shapley
from removals
"""
