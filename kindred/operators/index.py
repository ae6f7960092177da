"""Dense integer ids and the joins that apply them."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from kindred.storage import materialize


def dense_index(df, column):
    """Map each distinct value of `column` to 0..n-1 in value order: `(id, idx)`.

    The values are range-partitioned, sorted within partitions and written once with
    their position. A value's index is that position plus the number of rows in earlier
    partitions. The running total goes over one row per partition, never over the ids.
    """
    ids = df.select(F.col(column).alias("id")).where(F.col("id").isNotNull()).distinct()
    ordered = materialize(
        ids.repartitionByRange("id").sortWithinPartitions("id").withColumn("_pos", F.monotonically_increasing_id()),
        "ids",
    )
    # monotonically_increasing_id keeps the partition in the bits above the lower 33.
    part = F.shiftright("_pos", 33)
    parts = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per partition
        .select("id", (F.col("_offset") + F.col("_pos").bitwiseAND((1 << 33) - 1)).alias("idx"))
    )


def encode_ids(df, id_map, column, into):
    """Add `into`, the dense index of `column`; rows without an index are dropped."""
    return df.join(id_map.select(F.col("id").alias(column), F.col("idx").alias(into)), column)


def decode_ids(df, id_map, column, into):
    """Add `into`, the id whose dense index is in `column`."""
    return df.join(id_map.select(F.col("idx").alias(column), F.col("id").alias(into)), column)
