"""Groups of rows within sorted partitions, handed on whole."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_runs(batches, keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of a partition that is sorted by ``keys``, cut between groups, each
    with the places where its groups begin and its length. The keys are longs
    without nulls. Memory: a batch and the largest group."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.table(batch)
        starts = _starts(table, keys)
        if held and not _same(held[-1], table, keys):
            yield from _whole(held, keys)
            held = []
        if len(starts) == 1:
            held.append(table)
            continue
        cut = int(starts[-1])
        held.append(table.slice(0, cut))
        yield from _whole(held, keys)
        held = [table.slice(cut)]
    yield from _whole(held, keys)


def _whole(held, keys):
    if held:
        table = pa.concat_tables(held).combine_chunks()
        yield table, np.append(_starts(table, keys), table.num_rows)


def _starts(table, keys):
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        value = table.column(k).to_numpy()
        new[1:] |= value[1:] != value[:-1]
    return np.flatnonzero(new)


def _same(before, after, keys):
    return all(before.column(k)[-1].as_py() == after.column(k)[0].as_py() for k in keys)


def pair_blocks(
    rows: DataFrame, spread: str, weight: Column, most: int, low: str, high: str
) -> DataFrame:
    """Let large groups meet block by block. A group whose ``weight`` (the same
    in all its rows) is w is cut into ceil(w / most) blocks by the value of
    ``spread``; each row goes to every pair of blocks that its own is in, ``low``
    and ``high``, so any two rows of the group meet somewhere and no task holds
    more than two blocks."""
    blocks = F.greatest(F.lit(1), F.ceil(weight / most)).cast("bigint")
    return (
        rows.withColumn("_blocks", blocks)
        .withColumn("_own", F.pmod(F.xxhash64(spread), F.col("_blocks")))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1)))
        .withColumns({low: F.least("_own", "_other"), high: F.greatest("_own", "_other")})
        .drop("_blocks", "_other")
    )
