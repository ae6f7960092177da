"""Joins in which a few keys may hold most of the rows."""

import math
from functools import reduce

from pyspark.sql import functions as F

from kindred.storage import first_row

# Joined rows one task should produce.
ROWS_PER_TASK = 2_000_000
# Joined rows above which a single key is split over several tasks.
ROWS_PER_SALT = 10_000_000
# Longest list of hot keys that is broadcast; a longer one is joined by a shuffle.
MAX_HOT_KEYS = 10_000
# Most tasks of one join, and most parts a key is split into, whatever it produces.
MAX_TASKS = 200_000
MAX_PARTS = 4_000_000
# Largest side of a lookup that every executor gets a copy of, and what a row of it takes besides its text.
LOOKUP_BYTES, ROW_BYTES = 64 << 20, 64


def as_list(on):
    return [on] if isinstance(on, str) else list(on)


def join_tasks(spark, rows):
    """Tasks for a join that produces `rows` rows."""
    return max(spark.sparkContext.defaultParallelism, min(MAX_TASKS, math.ceil(rows / ROWS_PER_TASK)))


def small(rows, limit=LOOKUP_BYTES):
    """`rows` for broadcast if their measured size allows, else None."""
    text = [F.coalesce(F.octet_length(F.col(name)), F.lit(0)) for name, kind in rows.dtypes if kind == "string"]
    size = F.sum(reduce(lambda x, y: x + y, text, F.lit(ROW_BYTES)))
    return F.broadcast(rows) if (first_row(rows.agg(size))[0] or 0) <= limit else None


def looked_up(rows):
    """`rows` for a lookup: broadcast if small, so that what looks up in them is not shuffled."""
    held = small(rows)
    return rows if held is None else held


def self_weights(df, on):
    """Per key, the rows of either side and those a self-join produces: the square of its size."""
    count = F.count(F.lit(1)).cast("double")
    return df.groupBy(*as_list(on)).agg((count * count).alias("_weight"), count.alias("_l"), count.alias("_r"))


def join_weights(left, right, on):
    """Per key, the rows a join reads and produces.

    A key that only one side holds counts as well, since its rows travel all the same.
    """
    keys = as_list(on)
    count = F.count(F.lit(1)).cast("double")
    sizes = left.groupBy(*keys).agg(count.alias("_l")).join(right.groupBy(*keys).agg(count.alias("_r")), keys, "full")
    n_left, n_right = F.coalesce("_l", F.lit(0.0)), F.coalesce("_r", F.lit(0.0))
    weight = (n_left * n_right + n_left + n_right).alias("_weight")
    return sizes.select(*keys, weight, n_left.alias("_l"), n_right.alias("_r"))


def total_and_top(weights):
    total, top = first_row(weights.agg(F.sum("_weight"), F.max("_weight")))
    return total or 0.0, top or 0.0


def hot_keys(weights, on, rows_per_salt=ROWS_PER_SALT):
    """All keys whose weight exceeds `rows_per_salt`, with the number of `_parts` that bring each down to it.

    The list is marked for broadcast if it is short.
    """
    parts = F.least(F.ceil(F.col("_weight") / rows_per_salt), F.lit(MAX_PARTS)).cast("int").alias("_parts")
    sides = [c for c in ("_l", "_r") if c in weights.columns]
    found = weights.where(F.col("_weight") > rows_per_salt).select(*as_list(on), parts, *sides)
    return F.broadcast(found) if found.limit(MAX_HOT_KEYS + 1).count() <= MAX_HOT_KEYS else found


def _grids(hot, keys):
    """Lines and columns of each hot key's grid.

    Left rows are copied to every column and right rows to every line, so the longer side
    gets the more positions.
    """
    ratio = F.greatest(F.col("_l"), F.lit(1.0)) / F.greatest(F.col("_r"), F.lit(1.0))
    lines = F.least(F.greatest(F.ceil(F.sqrt(F.col("_parts") * ratio)), F.lit(1)), F.col("_parts"))
    sized = hot.withColumn("_lines", lines.cast("int"))
    return sized.select(*keys, "_lines", F.ceil(F.col("_parts") / F.col("_lines")).cast("int").alias("_columns"))


def _on_grid(df, keys, hot, own, other):
    """Place rows on the grid of their key: one position along `own`, every one along `other`.

    The position comes from the row's own content, so a retried task finds the same one.
    """
    rest = [F.col(c) for c in df.columns if c not in keys] or [F.lit(0)]
    length = {"_line": F.coalesce("_lines", F.lit(1)), "_column": F.coalesce("_columns", F.lit(1))}
    return (
        df.join(hot, keys, "left")
        .withColumn(own, F.pmod(F.xxhash64(*rest), length[own]).cast("int"))
        .withColumn(other, F.explode(F.sequence(F.lit(0), length[other] - 1)))
        .drop("_lines", "_columns")
    )


def wide_join(left, right, on, rows_per_salt=ROWS_PER_SALT, weights=None, measured=None):
    """Inner equi-join that produces many more rows than it reads.

    Such joins are sized by their output: both sides go to a number of partitions that
    follows from the weights, while adaptive execution, which only sees the small input,
    would choose too few. `weights` defaults to `join_weights`; one job takes their sum
    and maximum unless `measured` has them.

    Rows of keys too large for one task are laid out on a grid, left rows by line and
    right rows by column, so that each pair of rows meets in exactly one cell. No row is
    lost or repeated.
    """
    keys = as_list(on)
    weights = join_weights(left, right, keys) if weights is None else weights
    total, top = measured or total_and_top(weights)
    tasks = join_tasks(left.sparkSession, total)
    if top <= rows_per_salt:
        return left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys)
    hot = _grids(hot_keys(weights, keys, rows_per_salt), keys)
    cell = [*keys, "_line", "_column"]
    lines = _on_grid(left, keys, hot, "_line", "_column").repartition(tasks, *cell)
    columns = _on_grid(right, keys, hot, "_column", "_line").repartition(tasks, *cell)
    return lines.join(columns, cell).drop("_line", "_column")


def self_join(df, on, left, right, rows_per_salt=ROWS_PER_SALT):
    """Join `df` with itself on `on`: `left` and `right` are its columns on either side."""
    keys = as_list(on)
    return wide_join(df.select(*keys, *left), df.select(*keys, *right), keys, rows_per_salt, self_weights(df, keys))
