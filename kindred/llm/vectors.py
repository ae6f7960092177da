"""What the two searches over embeddings share."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F


def usable(table, column="embedding", zero=True):
    """`(vec_id, vector)` of the rows that take part.

    Left out are null ids, null vectors, vectors that hold a null or a component that is
    not finite and, unless `zero`, vectors of zeros or without components.
    """
    vector = table[column]
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = table.select(table["vec_id"].cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", sound))
    return rows if zero else rows.where(F.exists("vector", lambda x: x != 0))


def matrix(column, width, dtype):
    """Arrow lists as the rows of a matrix, short ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    result = np.zeros((len(lengths), width), dtype=dtype)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    result[row, place] = values
    return result


def widest(rows):
    """Components of the longest vector."""
    return rows.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("n")).first()["n"]


def best(scores, ids, k, slack=0):
    """Places of the `k` highest scores, ties to the smaller id.

    With `slack`, all places within it below the k-th score come back too, for scores that
    are worked out anew.
    """
    places = np.arange(len(scores))
    if len(scores) > k:
        places = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k] - slack)
    order = np.lexsort((ids[places], -scores[places]))
    return places[order] if slack else places[order[:k]]


def ranked(found, k):
    """The `k` highest of `(query_id, vec_id, score)` for each query with their rank; few rows a query come in."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rows = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return rows.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
