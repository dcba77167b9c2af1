"""Global row positions without sorting everything in one task."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialtrail.operators.repeat import shuffle_partitions
from dialtrail.operators.staging import staged

# monotonically_increasing_id: partition number above bit 33, row below it.
ROW_BITS = 33


def with_ordinal(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Add the 0-based position of each row in ``order_by`` order, nulls first.

    Range partitions sort on their own and number their rows; the positions
    then need only the size of each partition. The sorted rows are staged
    once, since range bounds are sampled and both uses must see the same cut.
    The number of ranges is named, so that Spark does not merge them by bytes.
    Rows with equal keys share a partition, so give keys that tell rows apart.
    """
    ordered = staged(
        df.repartitionByRange(shuffle_partitions(df.sparkSession), *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "ordinal",
    )
    part = F.shiftright("_slot", ROW_BITS).alias("_part")
    sizes = ordered.groupBy(part).agg(F.count("*").alias("_size"))
    # One row per range partition: a bounded frame, whatever the data size.
    starts = sizes.select(
        "_part",
        (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_start"),
    )
    row = F.col("_slot").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*df.columns, (F.col("_start") + row).alias(name))
    )
