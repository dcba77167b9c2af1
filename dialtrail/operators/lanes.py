"""Roll calls up by phone in one shuffle, hot phones apart."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtrail.operators.staging import staged

# A phone with fewer calls is safe to gather in one task as it is.
HOT_CALLS = 1_000_000
SAMPLED = 1 / 1_000

Hot = DataFrame | Sequence[str]


@dataclass(frozen=True)
class Lanes:
    """A call log that is stored in two parts which share no phone: ``gathered``
    holds all calls of a phone in one place, ``spread`` those of hot phones,
    dealt out; none where no phone is hot. Calls without a phone are in neither.
    """

    gathered: DataFrame
    spread: DataFrame | None


Calls = DataFrame | Lanes


def per_lane(calls: Calls, group: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``group``, whose groupings all contain the phone, over each lane."""
    if not isinstance(calls, Lanes):
        return group(calls)
    gathered = group(calls.gathered)
    return gathered if calls.spread is None else gathered.unionByName(group(calls.spread))


def hot_phones(
    calls: Calls, phone: str, hot_calls: int = HOT_CALLS, sampled: float = SAMPLED
) -> Hot:
    """A table of the phones with about ``hot_calls`` calls or more, all of
    them, from a sample (a job, which reads the phone column of the whole log);
    an empty list if there are none. The table is written, to be read twice.

    The table only decides how work is spread. A phone that is missed or listed
    needlessly costs time and changes no result. Stored lanes need none.
    """
    if isinstance(calls, Lanes):
        return []
    share = calls.select(phone) if sampled >= 1 else calls.select(phone).sample(sampled, 0)
    found = (
        share.filter(F.col(phone).isNotNull())
        .groupBy(F.col(phone).alias("hot_phone"))
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= hot_calls * min(sampled, 1))
        .select("hot_phone")
    )
    return [] if found.isEmpty() else staged(found, "hot")


def roll_up_by_phone(
    calls: Calls,
    phone: str,
    roll_up: Callable[[DataFrame], DataFrame],
    hot: Hot,
    prepare: Callable[[DataFrame], DataFrame] = lambda calls: calls,
) -> DataFrame:
    """``roll_up``, a chain of groupings that all contain ``phone`` and keep it,
    over calls as ``prepare``, row by row, makes them.

    Ordinary phones, a missing one among them, are gathered first, so that all
    the groupings run where the rows lie. Hot phones, a table or a few names, go
    through the groupings' own shuffles, which merge rows before sending them;
    without any that lane is not planned. Both lanes come out hashed by phone.
    Calls that are stored in lanes are rolled up as they lie.
    """
    if isinstance(calls, Lanes):
        return per_lane(calls, lambda lane: roll_up(prepare(lane)))
    calls = prepare(calls)
    if not isinstance(hot, DataFrame):
        if not hot:
            return roll_up(calls.repartition(phone))
        names = [(name,) for name in hot]
        hot = calls.sparkSession.createDataFrame(names, "hot_phone string")
    is_hot = F.col(phone) == F.col("hot_phone")
    ordinary = roll_up(calls.join(hot, is_hot, "left_anti").repartition(phone))
    return ordinary.unionByName(roll_up(calls.join(hot, is_hot, "left_semi")))
