"""Item-based and user-based collaborative filtering.

Both take ratings unique on (user, item) and return the request rows, in any number and
with all their columns, plus `prediction`.
"""

from pyspark.sql import functions as F

from kindred.functions import clip
from kindred.operators.dense import dense_neighbours
from kindred.operators.neighbours import (
    collapse_equal_similarity,
    neighbour_rows,
    top_k_neighbours,
    weighted_score,
)
from kindred.operators.pairs import neighbour_lists, prefers_dense, prepare
from kindred.operators.ratings import item_means, other_id, user_means
from kindred.operators.skew import looked_up
from kindred.storage import materialize

DEFAULT_STARS = 3.0
ITEM_SUPPORT = 30
USER_SUPPORT = 60


def stage_ratings(ratings):
    """Write the rating columns once for the branches that read them."""
    return materialize(ratings.select("user_id", "item_id", F.col("stars").cast("double").alias("stars")), "ratings")


def _with_means(ratings, requests):
    """Requests with the means of their ids, written once; NULL marks an unknown id."""
    users = looked_up(user_means(ratings).select("user_id", "user_mean"))
    items = looked_up(item_means(ratings).select("item_id", "item_mean"))
    return materialize(requests.join(users, "user_id", "left").join(items, "item_id", "left"), "requests")


def similar_neighbours(
    ratings, known, target, min_support, values=None, value="stars",
    include_self=False, collapse=False, top_k=None, finish=None, **tuning,
):
    """Neighbour rows of the distinct `known` requests, or what `finish` makes of all rows of a request."""
    lists = materialize(
        neighbour_lists(ratings, target, min_support, include_self=include_self, requests=known, **tuning), "neighbours"
    )

    def of_each_request(rows):
        if collapse:
            rows = collapse_equal_similarity(rows)
        if top_k:
            rows = top_k_neighbours(rows, top_k)
        return finish(rows) if finish else rows

    return neighbour_rows(known, values if values is not None else ratings, lists, target, value, finish=of_each_request)


def neighbour_scores(
    ratings, known, target, min_support, values=None, value="stars",
    include_self=False, collapse=False, top_k=None, dense=None, **tuning,
):
    """Similarity-weighted means of the distinct `known` requests: `(user_id, item_id, score)`.

    Where ratings are dense, similarities and sums come from products of matrices and no
    row is made for a neighbour; `dense` sets whether.
    """
    values = values if values is not None else ratings
    if not (include_self or collapse or tuning) and dense is not False:
        prepared = prepare(ratings, target, min_support, requests=known)
        if dense or prefers_dense(prepared):
            ids = F.col("t").alias(target), F.col("o").alias(other_id(target))
            rows = dense_neighbours(prepared.facts, known, values, target, prepared.entities, min_support, value, top_k)
            if top_k:
                return weighted_score(top_k_neighbours(rows.select(*ids, "neighbour", "similarity", "value"), top_k))
            return rows.groupBy(*ids).agg((F.sum("num") / F.sum("den")).alias("score"))
        tuning = {"prepared": prepared}
    return similar_neighbours(
        ratings, known, target, min_support, values, value,
        include_self=include_self, collapse=collapse, top_k=top_k, finish=weighted_score, **tuning,
    )


def item_neighbours(ratings, requests, min_support=ITEM_SUPPORT, stage=True, **options):
    """Items that count for each known request: `(user_id, item_id, neighbour, similarity, value)`."""
    ratings = stage_ratings(ratings) if stage else ratings
    known = _with_means(ratings, requests.select("user_id", "item_id").distinct())
    known = known.where("user_mean IS NOT NULL AND item_mean IS NOT NULL").select("user_id", "item_id")
    return similar_neighbours(ratings, known, "item_id", min_support, **options)


def _finish(requests, based, is_known, scores, rule, clip_to):
    """Requests with their prediction; only known ones may have a score, so the others stay out of the join."""
    keys = ["user_id", "item_id"]
    scored = based.where(is_known).join(scores.select(*keys, "score"), keys, "left")
    scored = scored.unionByName(based.where(~is_known).withColumn("score", F.lit(None).cast("double")))
    prediction = rule if clip_to is None else clip(rule, *clip_to)
    return scored.select(*requests.columns, prediction.alias("prediction"))


def item_cf_predict(
    ratings, requests, min_support=ITEM_SUPPORT, cold_start="constant", default=DEFAULT_STARS, top_k=None,
    include_self=False, collapse_equal_similarity=False, clip_to=None, stage=True, **tuning,
):
    """Mean of the user's ratings of similar items, weighted by similarity.

    Without such items the user's mean is taken. If an id is unknown, `cold_start`
    decides: `"constant"` gives `default`; `"means"` gives the mean of the known side,
    and `default` when neither is known.
    """
    if cold_start not in ("constant", "means"):
        raise ValueError("cold_start must be 'constant' or 'means'")
    ratings = stage_ratings(ratings) if stage else ratings
    based = _with_means(ratings, requests)
    is_known = F.col("user_mean").isNotNull() & F.col("item_mean").isNotNull()
    known = based.where(is_known).select("user_id", "item_id").distinct()
    scores = neighbour_scores(
        ratings, known, "item_id", min_support,
        include_self=include_self, collapse=collapse_equal_similarity, top_k=top_k, **tuning,
    )
    rule = F.when(is_known, F.coalesce("score", "user_mean"))
    if cold_start == "means":
        rule = rule.otherwise(F.coalesce("item_mean", "user_mean", F.lit(float(default))))
    else:
        rule = rule.otherwise(F.lit(float(default)))
    return _finish(requests, based, is_known, scores, rule, clip_to)


def user_cf_predict(
    ratings, requests, min_support=USER_SUPPORT, default=DEFAULT_STARS, top_k=None,
    include_self=False, collapse_equal_similarity=False, clip_to=None, stage=True, **tuning,
):
    """The user's mean plus the weighted deviation of similar users from their own means.

    Means go over all ratings of a user. Without similar users the item's mean is taken,
    and `default` if an id is unknown. The score may leave the scale unless `clip_to` is set.
    """
    ratings = stage_ratings(ratings) if stage else ratings
    based = _with_means(ratings, requests)
    is_known = F.col("user_mean").isNotNull() & F.col("item_mean").isNotNull()
    known = based.where(is_known).select("user_id", "item_id").distinct()
    deviations = ratings.join(user_means(ratings), "user_id").select(
        "user_id", "item_id", (F.col("stars") - F.col("user_mean")).alias("deviation")
    )
    scores = neighbour_scores(
        ratings, known, "user_id", min_support, deviations, "deviation",
        include_self=include_self, collapse=collapse_equal_similarity, top_k=top_k, **tuning,
    )
    rule = F.when(is_known, F.coalesce(F.col("user_mean") + F.col("score"), F.col("item_mean")))
    return _finish(requests, based, is_known, scores, rule.otherwise(F.lit(float(default))), clip_to)
