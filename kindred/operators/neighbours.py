"""Neighbours that count for a request: similar to its target, rated with its context.

For item-based prediction the target is the item and the context the user; for
user-based prediction it is the other way round.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators.ratings import other_id
from kindred.operators.skew import LOOKUP_BYTES, ROWS_PER_SALT, small, wide_join
from kindred.storage import materialize_observed

# Rows walked in place that cost no more than one that is shuffled for its lookup.
WALKED_PER_SHUFFLED = 16


def neighbour_rows(requests, ratings, lists, target, value="stars", rows_per_salt=ROWS_PER_SALT, lookup_bytes=LOOKUP_BYTES, finish=None):
    """Rows `(user_id, item_id, neighbour, similarity, value)` of distinct requests.

    A neighbour qualifies if it is in the target's similarity list and has a rating with
    the context. Each request takes the shorter way to that intersection: through the
    ratings of its context, or through the list of its target. So neither a context with
    very many ratings nor a target with very many neighbours multiplies with the number
    of its requests unless both are large. Keys that still produce much are salted.

    What is walked is looked up on the other side. If all lists, or all ratings of requested
    contexts, measure up to `lookup_bytes`, they are broadcast, and the way that looks up in
    them is taken unless it is many times longer: nothing it walks is shuffled, and a
    request's rows stay in one task. `finish` is applied to the rows of each way, as a
    request goes only one.
    """
    context = other_id(target)
    keys = ["user_id", "item_id"]
    requests = requests.select(*keys)
    list_size = lists.groupBy(F.col("target").alias(target)).agg(F.count(F.lit(1)).alias("by_target"))
    rated = ratings.select(F.col(target).alias("neighbour"), context, F.col(value).alias("value"))
    degree = rated.groupBy(context).agg(F.count(F.lit(1)).alias("by_context"))
    lists = lists.withColumnRenamed("target", target)
    by_context, by_target = F.col("by_context"), F.col("by_target")
    few_lists = small(lists, lookup_bytes)
    if few_lists is not None:
        lists, by_target = few_lists, by_target * WALKED_PER_SHUFFLED
    else:
        few_rated = small(rated.join(requests.select(context).distinct(), context, "left_semi"), lookup_bytes)
        if few_rated is not None:
            rated, by_context = few_rated, by_context * WALKED_PER_SHUFFLED
    through_context = by_context <= by_target
    routed, seen = materialize_observed(
        requests.join(list_size, target).join(degree, context),
        "routes",
        context=F.count_if(through_context),
        target=F.count_if(~through_context),
    )
    found = []
    if seen["context"] or not seen["target"]:
        walked = wide_join(routed.where(through_context).select(*keys), rated, context, rows_per_salt)
        found.append(walked.join(lists, [target, "neighbour"]))
    if seen["target"]:
        walked = wide_join(routed.where(~through_context).select(*keys), lists, target, rows_per_salt)
        found.append(walked.join(rated, [context, "neighbour"]))
    found = [df.select(*keys, "neighbour", "similarity", "value") for df in found]
    return reduce(DataFrame.unionByName, [finish(df) if finish else df for df in found])


def top_k_neighbours(rows, k):
    """The `k` most similar neighbours of each request; ties go to the smaller id."""
    order = Window.partitionBy("user_id", "item_id").orderBy(F.desc("similarity"), F.asc("neighbour"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def collapse_equal_similarity(rows):
    """Keep one neighbour per request and similarity (12 decimals): the largest id."""
    # A field at a time, since a struct could not be kept by a hash aggregate and all rows would be sorted.
    kept = [F.max_by(c, "neighbour").alias(c) for c in ("similarity", "value")]
    return (
        rows.groupBy("user_id", "item_id", F.round("similarity", 12).alias("level"))
        .agg(F.max("neighbour").alias("neighbour"), *kept)
        .select("user_id", "item_id", "neighbour", "similarity", "value")
    )


def weighted_score(rows):
    """Similarity-weighted mean of `value` per request: `(user_id, item_id, score)`."""
    weighted = F.sum(F.col("similarity") * F.col("value")) / F.sum("similarity")
    return rows.groupBy("user_id", "item_id").agg(weighted.alias("score"))
