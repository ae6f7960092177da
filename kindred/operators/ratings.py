"""Ratings: duplicates, ids, statistics, per-entity lists, request classification.

Ratings are rows `(user_id, item_id, stars)`, unique on the two ids.
"""

from pyspark.sql import functions as F

KEYS = ("user_id", "item_id")


def other_id(by):
    """The id column on the other side of a rating."""
    if by not in KEYS:
        raise ValueError(f"expected one of {KEYS}, got {by!r}")
    return KEYS[1] if by == KEYS[0] else KEYS[0]


def dedupe_ratings(df, order_cols):
    """One rating per (user, item): the one that is last by `order_cols`."""
    return df.groupBy(*KEYS).agg(F.max_by("stars", F.struct(*order_cols)).alias("stars"))


def distinct_ids(df, column):
    return df.select(column).distinct()


def rating_stats(ratings):
    """One row: ratings, distinct users, distinct items, mean stars."""
    return ratings.agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("item_id").alias("n_items"),
        F.avg("stars").alias("mean_stars"),
    )


def user_means(ratings):
    return ratings.groupBy("user_id").agg(F.avg("stars").alias("user_mean"), F.count(F.lit(1)).alias("user_n"))


def item_means(ratings):
    return ratings.groupBy("item_id").agg(F.avg("stars").alias("item_mean"), F.count(F.lit(1)).alias("item_n"))


def _chunked(rows, owner, entry, chunk_rows):
    """Add `chunk`: an owner of n rows has ceil(n / chunk_rows) of them, dealt out by the md5 of `entry` as text."""
    sizes = rows.groupBy(owner).agg(F.ceil(F.count(F.lit(1)) / chunk_rows).alias("_chunks"))
    digest = F.conv(F.substring(F.md5(F.col(entry).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")
    return rows.join(sizes, owner).withColumn("chunk", F.pmod(digest, F.col("_chunks")).cast("int"))


def adjacency(ratings, by, chunk_rows):
    """Sorted list of the ids an entity is rated with: `(by, chunk, members)`.

    The lists of an entity have `chunk_rows` ids on average, are disjoint and together
    complete; the caller chooses the length, and the rule is the same at every size.
    """
    other = other_id(by)
    rows = _chunked(ratings.select(by, other), by, other, chunk_rows)
    return rows.groupBy(by, "chunk").agg(F.sort_array(F.collect_list(other)).alias("members"))


def rating_vectors(ratings, by, chunk_rows):
    """Map from the other id to stars: `(by, chunk, vector)`, chunked like `adjacency`."""
    other = other_id(by)
    rows = _chunked(ratings.select(by, other, "stars"), by, other, chunk_rows)
    return rows.groupBy(by, "chunk").agg(
        F.map_from_entries(F.collect_list(F.struct(other, "stars"))).alias("vector")
    )


def member_sets(members, chunk_rows):
    """Set of members per item: `(item_id, chunk, members)`, chunked like `adjacency`."""
    rows = _chunked(members.select("item_id", "member_id").distinct(), "item_id", "member_id", chunk_rows)
    return rows.groupBy("item_id", "chunk").agg(F.sort_array(F.collect_list("member_id")).alias("members"))


def classify_requests(requests, ratings):
    """Add `user_known` and `item_known`: does the id occur in the ratings?"""
    users = distinct_ids(ratings, "user_id").withColumn("_u", F.lit(True))
    items = distinct_ids(ratings, "item_id").withColumn("_i", F.lit(True))
    return (
        requests.join(users, "user_id", "left")
        .join(items, "item_id", "left")
        .select(
            *requests.columns,
            F.col("_u").isNotNull().alias("user_known"),
            F.col("_i").isNotNull().alias("item_known"),
        )
    )


def known_requests(requests, ratings):
    """Requests whose user and item both occur in the ratings."""
    return requests.join(distinct_ids(ratings, "user_id"), "user_id", "left_semi").join(
        distinct_ids(ratings, "item_id"), "item_id", "left_semi"
    )


def unknown_requests(requests, ratings, by="user_id"):
    """Requests whose `by` id does not occur in the ratings."""
    return requests.join(distinct_ids(ratings, by), by, "left_anti")
