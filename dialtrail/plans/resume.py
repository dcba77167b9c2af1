"""Publishing that goes on where it broke off.

A ledger beside the batches tells, for each batch that is written, how many rows
it has, two checksums over them and the step that wrote it. A run compares the
batches it is given with the ledger, writes those that are missing or differ, step
by step, and in the end names the batches that make up what is published. Until
then readers see what was published before.

A job costs as much for a small step as for a large one, so small steps are
written together, the more of them the more steps are done: a run that breaks off
loses one step, or an eighth of those it has written and no more than
``ROWS_AT_ONCE`` rows.
"""

import itertools
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtrail.operators.staging import fresh_path, staged
from dialtrail.sources import versions
from dialtrail.plans.publish import published_cells, read_folders, write_folders

# Batches of one step, which is in the ledger as a whole or not at all.
BATCHES_PER_STEP = 1_000
# Steps are written together while they hold no more rows than this.
ROWS_AT_ONCE = 1_000_000
# Of the steps done, so many are written by one job: an eighth.
SHARE_AT_ONCE = 8

LEDGER = "batch_id bigint, n_rows bigint, check_a bigint, check_b bigint, step string"
SAME = ["batch_id", "n_rows", "check_a", "check_b"]


def batch_checks(batches: DataFrame) -> DataFrame:
    """Rows and checksums of each batch: whatever order its rows come in, and
    merged before they are shuffled. A cell in another row changes them."""
    cells = [name for name in batches.columns if name != "batch_id"]
    by_a, by_b = (F.xxhash64(F.lit(seed), *cells) for seed in (1, 2))
    return batches.groupBy("batch_id").agg(
        F.count("*").alias("n_rows"),
        F.bit_xor(by_a).alias("check_a"),
        # Halves of the hash, so that the sum holds for four billion rows.
        F.sum(F.pmod(by_b, F.lit(1 << 31))).alias("check_b"),
    )


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    folder = f"{path.rstrip('/')}/ledger"
    if versions.n_files(spark, folder) is None:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(folder)


def _steps(path: str) -> str:
    return f"{path.rstrip('/')}/steps"


def steps_together(steps: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """(step, run) for each (step, rows), in order: which run writes it. A run
    takes one step, or an eighth of those before it while they are small."""
    placed, run, first, rows = [], -1, 0, 0
    for at, (step, own) in enumerate(steps):
        if at - first >= max(1, first // SHARE_AT_ONCE) or rows + own > ROWS_AT_ONCE or not at:
            run, first, rows = run + 1, at, 0
        rows += own
        placed.append((step, run))
    return placed


def _laid_out(batches: DataFrame, todo: DataFrame) -> Callable[[int], DataFrame]:
    """The rows of the batches to do, in a folder for each run; reads a run's."""
    spark = batches.sparkSession
    rows = batches.join(todo.select("batch_id", "_step", "_run"), "batch_id")
    folder = fresh_path(spark, "rows")
    rows.write.partitionBy("_run").parquet(folder)
    own = rows.drop("_run").schema
    return lambda run: spark.read.schema(own).parquet(f"{folder}/_run={run}")


def publish_resumable(
    batches: DataFrame, path: str, batches_per_step: int = BATCHES_PER_STEP
) -> list[str]:
    """Publish ``batches`` at ``path``; the steps that had to be written.

    ``batches`` should be stored (``publish_batches`` stages its rows), as they
    are read for their checksums, and once more to lay the rows that are to be
    written out by run, so that each run reads its own. The steps' numbers and
    rows, one for each ``batches_per_step`` batches, come to the driver; the
    batches do not. One run of this function at a time.
    """
    spark = batches.sparkSession
    wanted = staged(batch_checks(batches), "checks")
    missing = wanted.join(_ledger(spark, path), SAME, "left_anti")
    step_of = F.floor(F.col("batch_id") / batches_per_step)
    todo = staged(missing.withColumn("_step", step_of), "todo")
    sizes = todo.groupBy("_step").agg(F.sum("n_rows")).orderBy("_step").collect()
    runs = steps_together(map(tuple, sizes))
    if runs:
        run_of = spark.createDataFrame(runs, "_step bigint, _run bigint")
        todo = staged(todo.join(run_of, "_step"), "runs")
        laid_out = _laid_out(batches, todo)
    written = []
    for run, steps in itertools.groupby(runs, key=lambda own: own[1]):
        token = uuid.uuid4().hex
        step = F.format_string(f"%09d-{token}", "_step").alias("step")
        rows = laid_out(run).select(*batches.columns, step)
        write_step(rows, path, token)
        entries = todo.filter(F.col("_run") == run).select(*SAME, step).coalesce(1)
        entries.write.mode("append").parquet(f"{path.rstrip('/')}/ledger")
        written += [f"{number:09d}-{token}" for number, _ in steps]
    contents = (
        wanted.join(_ledger(spark, path), SAME)
        .groupBy("batch_id")
        .agg(F.min("step").alias("step"))
    )
    versions.commit(spark, path, contents.write.parquet)
    return written


def write_step(rows: DataFrame, path: str, token: str) -> None:
    """Write the rows of one step or more, told by the column ``step``, whose
    names end in ``token``, each step in a folder of its own."""
    write_folders(rows, _steps(path), ["step"], "append")


def read_published(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """What was published last: batch_id, sheet_row and the cells as text. Only
    folders of steps that still count are read."""
    found = versions.current(spark, path)
    if found is None:
        raise ValueError(f"nothing is published at {path}")
    contents = spark.read.schema("batch_id bigint, step string").parquet(found.path)
    steps = [row.step for row in contents.select("step").distinct().collect()]
    if not steps:
        cells = [F.lit("").alias(c) for c in columns]
        return contents.select("batch_id", F.col("batch_id").alias("sheet_row"), *cells)
    rows = read_folders(spark, _steps(path), columns, parts="step string, ")
    own = rows.filter(F.col("step").isin(steps)).join(contents, ["step", "batch_id"], "left_semi")
    return published_cells(own, columns)
