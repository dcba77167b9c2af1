"""Three-valued predicates over one call.

``connected`` and ``reachable`` differ only for a null dialstatus, and that
difference is meant: each report uses the one its definition asks for.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialtrail.functions import fixed_values as V


def connected() -> Column:
    """The dial did not fail. Null for a null dialstatus, so a filter drops it."""
    return ~F.col("dialstatus").isin(V.FAILED_DIAL_STATUSES)


def reachable() -> Column:
    """The dial did not fail, or its outcome was not recorded. Never null."""
    return F.col("dialstatus").isNull() | connected()


def outbound() -> Column:
    return F.col("campaign_id").endswith(V.OUTBOUND_SUFFIX)


def inbound() -> Column:
    return F.col("campaign_id").endswith(V.INBOUND_SUFFIX)


def dropped() -> Column:
    return F.col("status").isin(V.DROP_STATUSES)
