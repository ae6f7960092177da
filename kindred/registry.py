"""Every operator as a query over the test tables: `name -> f(spark, folder) -> DataFrame`.

Scores are rounded to 6 decimals; lists and maps come out as text.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from kindred.models.baseline import BiasBaseline, bias_baseline
from kindred.models.factors import BiasedFactorization, mf_fit, mf_predict, normal_rest, predict_by_factors
from kindred.models.trees import gbt_fit, gbt_predict, predict_by_nodes, tree_nodes
from kindred.models.tuning import bias_grid, factor_grid, tune, tuning_report
from kindred.operators.blend import (
    FOUR_MODEL_HIGH,
    FOUR_MODEL_LOW,
    TWO_MODEL_HIGH,
    TWO_MODEL_LOW,
    align_scores,
    switch_blend,
    weighted_sum,
)
from kindred.operators.evaluate import error_histogram, pair_precision_recall, prediction_errors, rmse
from kindred.operators.features import assemble_features
from kindred.operators.index import decode_ids, dense_index, encode_ids
from kindred.operators.lsh import bucket_sizes, lsh_bands, lsh_candidate_pairs
from kindred.operators.neighbours import collapse_equal_similarity
from kindred.operators.pairs import canonical_pairs, co_ratings, item_pearson, pair_sums, user_pearson
from kindred.operators.ratings import (
    adjacency,
    classify_requests,
    distinct_ids,
    item_means,
    known_requests,
    member_sets,
    rating_stats,
    rating_vectors,
    unknown_requests,
    user_means,
)
from kindred.operators.sets import exact_jaccard_pairs, jaccard
from kindred.plans.cf import DEFAULT_STARS, item_cf_predict, item_neighbours, similar_neighbours, stage_ratings, user_cf_predict
from kindred.plans.ensemble import ensemble_predict, evaluate, hybrid_predict
from kindred.plans.similar_items import lsh_similar_items, member_signatures, prepare_members, written_members
from kindred.sources import tables, text
from kindred.storage import discard, materialize, scratch_path, settled

ITEM_SUPPORT = 30
# Users of the click ratings share about 20 items; none share the usual 60.
USER_SUPPORT = 20
TOP_K = 6
# Short, so that most owners have several lists.
CHUNK = 16
# Reviews at which the blends switch; items on both sides occur.
SWITCH = 100
THRESHOLD = 0.5
# Higher, since hundreds of thousands of orders share half of a few suppliers.
ORDER_THRESHOLD = 0.8
# Added to the id of an item for that of its twin.
MIRROR = 1_000_000
KEYS = ["user_id", "item_id"]

clicks = tables.click_ratings
purchases = tables.purchase_ratings


def all_requests(spark, folder):
    """Pairs of the purchases, mostly of unknown ids, and of the clicks, all of known ones."""
    bought, clicked = tables.purchase_lines(spark, folder), tables.click_events(spark, folder)
    return bought.select(*KEYS).union(clicked.select(*KEYS)).distinct()


def click_requests(spark, folder):
    return clicks(spark, folder).select(*KEYS)


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def as_text(df, column):
    """A list column as its length and its comma-separated text."""
    return df.withColumn("n", F.size(column)).withColumn(column, F.array_join(F.col(column).cast("array<string>"), ","))


def numeric_keys(df):
    return df.withColumns({c: F.col(c).cast("bigint") for c in KEYS if c in df.columns})


# Sources and sinks: written from the tables, then read back.


def io_ratings(spark, folder):
    path = scratch_path(spark, "ratings-csv")
    text.write_ratings(clicks(spark, folder), path)
    return numeric_keys(text.read_ratings(spark, path))


def io_requests(spark, folder):
    path = scratch_path(spark, "requests-csv")
    text.write_ratings(purchases(spark, folder), path)
    return numeric_keys(text.read_requests(spark, path))


def io_user_features(spark, folder):
    path = scratch_path(spark, "user-json")
    tables.user_features(spark, folder).withColumn("name", F.lit("unread")).write.json(path)
    return rounded(numeric_keys(text.read_user_features(spark, path)), "average_stars")


def io_item_features(spark, folder):
    path = scratch_path(spark, "item-json")
    tables.item_features(spark, folder).withColumnRenamed("item_id", "business_id").write.json(path)
    return rounded(numeric_keys(text.read_item_features(spark, path)), "stars")


def io_scored(spark, folder):
    truth_path, scored_path = scratch_path(spark, "truth-csv"), scratch_path(spark, "predictions-csv")
    truth = purchases(spark, folder)
    means = item_means(clicks(spark, folder))
    prediction = F.coalesce("item_mean", F.lit(DEFAULT_STARS)).alias("prediction")
    scored = truth.join(means, "item_id", "left").select(*KEYS, prediction)
    text.write_ratings(truth, truth_path)
    text.write_predictions(scored, scored_path, order_by="user_id", spaced_header=True)
    errors = prediction_errors(text.read_predictions(spark, scored_path), text.read_truth(spark, truth_path))
    return rounded(numeric_keys(errors), "prediction", "error")


def io_request_order(spark, folder):
    """Predictions written in the order of the request file: each with the place it has in either file."""
    requests_path, scored_path = scratch_path(spark, "requests-csv"), scratch_path(spark, "predictions-csv")
    text.write_ratings(purchases(spark, folder).orderBy("item_id", F.desc("user_id")), requests_path)
    requests = text.read_requests(spark, requests_path, keep_order=True)
    text.write_predictions(requests.withColumn("prediction", F.lit(1.0)), scored_path, order_by="request_pos")
    back = numeric_keys(text.read_requests(spark, scored_path, keep_order=True))
    order = Window.partitionBy("item_id").orderBy("request_pos")  # the order within an item shows in SQL
    return back.select(*KEYS, F.row_number().over(order).cast("bigint").alias("place"))


def io_pairs(spark, folder):
    path = scratch_path(spark, "pairs-csv")
    pairs = item_pearson(clicks(spark, folder), ITEM_SUPPORT, positive_only=True)
    text.write_pairs(pairs.select("item_2", "item_1", "similarity"), path, spaced_header=True)
    back = spark.read.option("header", True).schema("item_1 bigint, item_2 bigint, similarity double").csv(path)
    return rounded(back, "similarity")


# Ids, statistics, lists.


def distinct_users(spark, folder):
    return distinct_ids(clicks(spark, folder), "user_id")


def distinct_items(spark, folder):
    return distinct_ids(clicks(spark, folder), "item_id")


def stats(spark, folder):
    return rounded(rating_stats(clicks(spark, folder)), "mean_stars")


def dense_index_users(spark, folder):
    return dense_index(clicks(spark, folder), "user_id")


def dense_index_tokens(spark, folder):
    return dense_index(tables.document_members(spark, folder), "member_id")


def encode_decode(spark, folder):
    ratings = stage_ratings(clicks(spark, folder))
    users, items = dense_index(ratings, "user_id"), dense_index(ratings, "item_id")
    encoded = encode_ids(encode_ids(ratings, users, "user_id", "user_idx"), items, "item_id", "item_idx")
    plain = encoded.select("user_idx", "item_idx", "stars")
    return decode_ids(decode_ids(plain, users, "user_idx", "user_id"), items, "item_idx", "item_id")


def sets_of_items(spark, folder):
    members = clicks(spark, folder).withColumnRenamed("user_id", "member_id")
    return as_text(member_sets(members, CHUNK), "members")


def vectors(spark, folder):
    found = rating_vectors(clicks(spark, folder), "item_id", CHUNK)
    entries = F.transform(
        F.array_sort(F.map_entries("vector")), lambda e: F.concat_ws(":", e["key"], e["value"].cast("int"))
    )
    return found.select("item_id", "chunk", F.size("vector").alias("n"), F.array_join(entries, ",").alias("vector"))


def adjacency_of_users(spark, folder):
    return as_text(adjacency(clicks(spark, folder), "user_id", CHUNK), "members")


def adjacency_of_items(spark, folder):
    return as_text(adjacency(purchases(spark, folder), "item_id", CHUNK), "members")


def means_of_users(spark, folder):
    return rounded(user_means(clicks(spark, folder)), "user_mean")


def means_of_items(spark, folder):
    return rounded(item_means(clicks(spark, folder)), "item_mean")


def classified(spark, folder):
    return classify_requests(all_requests(spark, folder), clicks(spark, folder))


def known_semi(spark, folder):
    return known_requests(all_requests(spark, folder), clicks(spark, folder))


def unknown_anti(spark, folder):
    return unknown_requests(all_requests(spark, folder), clicks(spark, folder), "user_id")


# Pairs.


def co_support_items(spark, folder):
    sums = pair_sums(clicks(spark, folder), "item_id", ITEM_SUPPORT)
    return sums.select(F.col("a").alias("item_1"), F.col("b").alias("item_2"), F.col("n").alias("common"))


def co_rated_pairs(spark, folder):
    ratings = stage_ratings(clicks(spark, folder))
    pairs = item_pearson(ratings, ITEM_SUPPORT, positive_only=True).select("item_1", "item_2")
    rows = co_ratings(ratings, pairs, "item_id")
    return rows.groupBy("item_1", "item_2").agg(
        F.count(F.lit(1)).alias("common"),
        F.sum(F.col("stars_1") * F.col("stars_2")).alias("dot"),
        F.sum(F.col("user_id") * F.col("stars_1")).alias("weighted"),
    )


def pearson_of_items(spark, folder):
    return rounded(item_pearson(clicks(spark, folder), ITEM_SUPPORT), "similarity")


def pearson_of_items_by_parts(spark, folder):
    """The same, with raters above a low degree kept out of the self-join and keys split into parts."""
    return rounded(item_pearson(clicks(spark, folder), ITEM_SUPPORT, hot_degree=100, rows_per_salt=20_000, blocks=0), "similarity")


def pearson_of_items_in_blocks(spark, folder):
    """The same, joined by pairs of blocks of items."""
    return rounded(item_pearson(clicks(spark, folder), ITEM_SUPPORT, hot_degree=100, blocks=5), "similarity")


def pearson_of_suppliers(spark, folder):
    return rounded(item_pearson(purchases(spark, folder), ITEM_SUPPORT), "similarity")


def pearson_of_users(spark, folder):
    return rounded(user_pearson(clicks(spark, folder), USER_SUPPORT), "similarity")


def reversed_pairs(spark, folder):
    pairs = item_pearson(clicks(spark, folder), ITEM_SUPPORT).select("item_2", "item_1", "similarity")
    return rounded(canonical_pairs(pairs.toDF("item_1", "item_2", "similarity"), "item_1", "item_2"), "similarity")


def top_k_neighbors(spark, folder):
    rows = item_neighbours(clicks(spark, folder), all_requests(spark, folder), ITEM_SUPPORT, top_k=TOP_K)
    return rounded(rows, "similarity")


def equal_similarity_collapse(spark, folder):
    ratings, requests = clicks(spark, folder), all_requests(spark, folder)
    rows = collapse_equal_similarity(item_neighbours(ratings, requests, ITEM_SUPPORT))
    return rounded(rows, "similarity")


def _mirrored(ratings):
    """Ratings with a twin of each item, whose similarities all equal those of the item."""
    twins = ratings.withColumn("item_id", F.col("item_id") + MIRROR)
    return ratings.select(*KEYS, "stars").unionByName(twins.select(*KEYS, "stars"))


def equal_similarity_items(spark, folder):
    """Of an item and its twin one stays for each request."""
    rows = item_neighbours(_mirrored(clicks(spark, folder)), all_requests(spark, folder), ITEM_SUPPORT)
    return rounded(collapse_equal_similarity(rows), "similarity")


def equal_similarity_users(spark, folder):
    """Users with few common items often have equal similarities."""
    ratings = stage_ratings(purchases(spark, folder))
    known = materialize(known_requests(click_requests(spark, folder), ratings), "known")
    rows = similar_neighbours(ratings, known, "user_id", 3, collapse=True)
    return rounded(rows, "similarity")


# Collaborative filtering.


def item_cf_basic(spark, folder, **options):
    options = {"min_support": ITEM_SUPPORT, **options}
    scored = item_cf_predict(clicks(spark, folder), all_requests(spark, folder), **options)
    return rounded(scored, "prediction")


def item_cf_means(spark, folder):
    return item_cf_basic(spark, folder, cold_start="means")


def item_cf_topk(spark, folder):
    return item_cf_basic(spark, folder, top_k=TOP_K)


def item_cf_with_self(spark, folder):
    return item_cf_basic(spark, folder, include_self=True)


def item_cf_collapsed(spark, folder):
    return item_cf_basic(spark, folder, collapse_equal_similarity=True)


def item_cf_purchases(spark, folder):
    scored = item_cf_predict(
        purchases(spark, folder), click_requests(spark, folder), ITEM_SUPPORT, cold_start="means"
    )
    return rounded(scored, "prediction")


def user_cf(spark, folder):
    scored = user_cf_predict(clicks(spark, folder), all_requests(spark, folder), USER_SUPPORT)
    return rounded(scored, "prediction")


def user_cf_topk(spark, folder):
    scored = user_cf_predict(
        clicks(spark, folder), all_requests(spark, folder), USER_SUPPORT, top_k=TOP_K, clip_to=(1, 5)
    )
    return rounded(scored, "prediction")


# Similar sets.


def _signatures(spark, folder):
    members = materialize(tables.document_members(spark, folder), "document-members")
    written = written_members(members)
    discard(members)
    signatures = settled(spark, lambda: member_signatures(members, written=written), "signatures")
    discard(written[0])
    return signatures


def minhash_rows(spark, folder):
    return _signatures(spark, folder).select("item_id", F.posexplode("signature").alias("pos", "value"))


def band_rows(spark, folder):
    return lsh_bands(_signatures(spark, folder)).withColumn(
        "band_key", F.array_join(F.col("band_key").cast("array<string>"), ",")
    )


def band_buckets(spark, folder):
    return bucket_sizes(lsh_bands(_signatures(spark, folder))).groupBy("band").agg(
        F.count(F.lit(1)).alias("buckets"), F.sum("n").alias("items"), F.max("n").alias("largest")
    )


def lsh_candidates(spark, folder):
    return lsh_candidate_pairs(lsh_bands(_signatures(spark, folder)))


def lsh_verified(spark, folder):
    members = materialize(tables.document_members(spark, folder), "document-members")
    written = written_members(members)
    discard(members)

    def candidates():
        signatures = materialize(member_signatures(members, written=written), "signatures")  # bands are read several times
        return lsh_candidate_pairs(lsh_bands(signatures))

    return rounded(jaccard(settled(spark, candidates, "candidates"), written[0]), "similarity")


def jaccard_exact(spark, folder):
    members = materialize(tables.document_members(spark, folder), "document-members")
    return rounded(exact_jaccard_pairs(members, THRESHOLD), "similarity")


def jaccard_of_orders(spark, folder):
    """Orders are short sets, and each supplier is in very many of them."""
    members = materialize(tables.order_members(spark, folder), "order-members")
    return rounded(exact_jaccard_pairs(members, ORDER_THRESHOLD), "similarity")


def similar_documents(spark, folder):
    return rounded(lsh_similar_items(tables.document_members(spark, folder), threshold=THRESHOLD), "similarity")


def similar_documents_by_parts(spark, folder):
    """The same, with every bucket of more than two documents split by rare members."""
    found = lsh_similar_items(tables.document_members(spark, folder), threshold=THRESHOLD, hot_bucket=2)
    return rounded(found, "similarity")


def precision_recall(spark, folder):
    members = tables.document_members(spark, folder)
    prepared = prepare_members(members, with_lists=True)
    found = settled(spark, lambda: lsh_similar_items(members, threshold=THRESHOLD, prepared=prepared), "found-pairs")
    truth = settled(spark, lambda: exact_jaccard_pairs(members, THRESHOLD, prepared=prepared), "true-pairs")
    return rounded(pair_precision_recall(found, truth), "precision", "recall")


# Features, baseline, blends, evaluation.


def _attributes(spark, folder):
    return tables.user_features(spark, folder), tables.item_features(spark, folder)


def request_features(spark, folder):
    found = assemble_features(all_requests(spark, folder), *_attributes(spark, folder))
    return rounded(found, "user_average_stars", "item_stars")


def training_features(spark, folder):
    found = assemble_features(clicks(spark, folder), *_attributes(spark, folder), on_missing="error")
    return rounded(found, "user_average_stars", "item_stars")


def baseline(spark, folder):
    ratings = stage_ratings(clicks(spark, folder))
    return rounded(bias_baseline(ratings, all_requests(spark, folder)), "prediction")


def _scores(spark, folder, models):
    """Scores of deterministic models by name; the item mean stands in for the trees."""
    ratings, requests = stage_ratings(clicks(spark, folder)), all_requests(spark, folder)
    keyed = materialize(assemble_features(requests, *_attributes(spark, folder)), "request-keys")
    pairs = keyed.select(*KEYS)
    makers = {
        "tree": lambda: keyed.select(*KEYS, F.col("item_stars").alias("prediction")),
        "item_cf": lambda: item_cf_predict(ratings, pairs, ITEM_SUPPORT, cold_start="means", stage=False),
        "user_cf": lambda: user_cf_predict(ratings, pairs, USER_SUPPORT, stage=False),
        "mf": lambda: bias_baseline(ratings, pairs),
    }
    reviews = keyed.select(*KEYS, F.col("item_review_count").alias("prediction"))
    return align_scores({"item_review_count": reviews, **{name: makers[name]() for name in models}})


def blend_two(spark, folder):
    scores = _scores(spark, folder, ("tree", "item_cf"))
    blended = switch_blend(scores, TWO_MODEL_LOW, TWO_MODEL_HIGH, threshold=SWITCH)
    return rounded(blended.select(*KEYS, "prediction"), "prediction")


def blend_four(spark, folder):
    scores = _scores(spark, folder, ("tree", "item_cf", "user_cf", "mf"))
    blended = switch_blend(scores, FOUR_MODEL_LOW, FOUR_MODEL_HIGH, threshold=SWITCH)
    return rounded(blended.select(*KEYS, "prediction"), "prediction")


def aligned_scores(spark, folder):
    return rounded(_scores(spark, folder, ("tree", "item_cf", "mf")), "tree", "item_cf", "mf")


def _item_cf_scored(spark, folder):
    truth = materialize(purchases(spark, folder), "truth")
    return item_cf_predict(clicks(spark, folder), truth.select(*KEYS), ITEM_SUPPORT), truth


def item_cf_rmse(spark, folder):
    return rounded(rmse(*_item_cf_scored(spark, folder)), "rmse")


def item_cf_errors(spark, folder):
    return error_histogram(*_item_cf_scored(spark, folder))


def evaluation_incomplete(spark, folder):
    """Only known requests are predicted; the rest of the truth is unmatched."""
    ratings, truth = stage_ratings(clicks(spark, folder)), materialize(purchases(spark, folder), "truth")
    known = known_requests(truth.select(*KEYS), ratings)
    score, histogram = evaluate(item_cf_predict(ratings, known, ITEM_SUPPORT, stage=False), truth)
    return _metric_rows(score, histogram, ("n", "unmatched", "rmse"))


def _metric_rows(score, histogram, names):
    """One row a metric and a bin: `(metric, value)`."""
    rows = [F.struct(F.lit(c).alias("metric"), F.round(F.col(c).cast("double"), 6).alias("value")) for c in names]
    as_row = score.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    bins = F.concat(F.lit("errors "), F.col("label")).alias("metric")
    return as_row.unionByName(histogram.select(bins, F.col("n").cast("double").alias("value")))


# Trained models: what they predict rests on training; that their tables say the same, and that
# the last step of the factors is solved, is checked by SQL.


def _training(spark, folder):
    return assemble_features(clicks(spark, folder), *_attributes(spark, folder))


def tree_predictions(spark, folder):
    model = gbt_fit(materialize(_training(spark, folder), "training"))
    requests = assemble_features(all_requests(spark, folder), *_attributes(spark, folder))
    return gbt_predict(model, requests)


def tree_rest(spark, folder):
    """What the trees predict beyond their table of nodes: 0 for every request."""
    model = gbt_fit(materialize(_training(spark, folder), "training"))
    requests = materialize(assemble_features(all_requests(spark, folder), *_attributes(spark, folder)), "requests")
    by_nodes = predict_by_nodes(tree_nodes(spark, model), requests, model.stages[-1].getMaxDepth())
    return _rest(gbt_predict(model, requests), by_nodes, 6)


def _rest(predicted, other, digits):
    both = predicted.select(*KEYS, "prediction").join(other.select(*KEYS, F.col("prediction").alias("again")), KEYS)
    return both.select(*KEYS, F.abs(F.round(F.col("prediction") - F.col("again"), digits)).alias("rest"))


def factor_rest(spark, folder):
    """What the users' factors leave of their normal equations: 0 for every user, to the 4 digits that floats allow."""
    rest = normal_rest(mf_fit(stage_ratings(purchases(spark, folder))))
    return rest.select("user_id", "n", F.round("rest", 4).alias("rest"))


def factor_products(spark, folder):
    """What the factor model predicts beyond baseline and product of the factor tables: 0 for every request."""
    ratings, requests = stage_ratings(clicks(spark, folder)), materialize(all_requests(spark, folder), "requests")
    model = mf_fit(ratings)
    return _rest(mf_predict(model, requests), predict_by_factors(model, requests), 4)


def factor_predictions(spark, folder):
    ratings = stage_ratings(purchases(spark, folder))
    return mf_predict(mf_fit(ratings), click_requests(spark, folder))


def factor_cold_starts(spark, folder):
    """Requests with an id that the factors do not know: the baseline alone, within the scale."""
    ratings, requests = stage_ratings(clicks(spark, folder)), all_requests(spark, folder)
    predicted = mf_predict(mf_fit(ratings), requests)
    unknown = classify_requests(predicted, ratings).where("not (user_known and item_known)")
    return rounded(unknown.select(*KEYS, "prediction"), "prediction")


def tune_mf(spark, folder):
    estimator = BiasedFactorization(maxIter=5)
    grid = factor_grid(estimator, rank=(2, 4), max_iter=(2, 5), reg=(0.1, 1.0))
    return tuning_report(spark, tune(stage_ratings(clicks(spark, folder)), estimator, grid))


def tune_bias(spark, folder):
    estimator = BiasBaseline()
    return rounded(tuning_report(spark, tune(clicks(spark, folder), estimator, bias_grid(estimator))), "rmse")


def hybrid(spark, folder):
    return hybrid_predict(
        clicks(spark, folder), all_requests(spark, folder), *_attributes(spark, folder), ITEM_SUPPORT, SWITCH
    )


def ensemble(spark, folder):
    return ensemble_predict(
        clicks(spark, folder), all_requests(spark, folder), *_attributes(spark, folder),
        ITEM_SUPPORT, USER_SUPPORT, SWITCH,
    )


def _rest_of_blend(spark, folder, predicted, low, high):
    """What a blend leaves beyond the weighted scores of its models: 0 for every request."""
    reviews = tables.item_features(spark, folder).select("item_id", "review_count")
    weighted = F.when(F.coalesce("review_count", F.lit(0)) < SWITCH, weighted_sum(low)).otherwise(weighted_sum(high))
    rows = predicted.join(reviews, "item_id", "left")
    return rows.select(*KEYS, F.abs(F.round(F.col("prediction") - weighted, 6)).alias("rest"))


def hybrid_parts(spark, folder):
    return rounded(hybrid(spark, folder).select(*KEYS, "item_cf"), "item_cf")


def hybrid_blend(spark, folder):
    return _rest_of_blend(spark, folder, hybrid(spark, folder), TWO_MODEL_LOW, TWO_MODEL_HIGH)


def ensemble_parts(spark, folder):
    return rounded(ensemble(spark, folder).select(*KEYS, "item_cf", "user_cf"), "item_cf", "user_cf")


def ensemble_blend(spark, folder):
    return _rest_of_blend(spark, folder, ensemble(spark, folder), FOUR_MODEL_LOW, FOUR_MODEL_HIGH)


def ensemble_metrics(spark, folder):
    truth = purchases(spark, folder)
    predictions = materialize(ensemble(spark, folder), "ensemble")
    score, histogram = evaluate(predictions, truth)
    return _metric_rows(score, histogram, ("rmse", "unmatched"))


QUERIES = {
    "io_ratings": io_ratings,
    "io_requests": io_requests,
    "io_user_features": io_user_features,
    "io_item_features": io_item_features,
    "io_scored": io_scored,
    "io_pairs": io_pairs,
    "io_request_order": io_request_order,
    "dedupe_ratings": clicks,
    "dedupe_purchases": purchases,
    "distinct_users": distinct_users,
    "distinct_items": distinct_items,
    "rating_stats": stats,
    "dense_index_users": dense_index_users,
    "dense_index_tokens": dense_index_tokens,
    "encode_decode": encode_decode,
    "member_sets": sets_of_items,
    "rating_vectors": vectors,
    "adjacency": adjacency_of_users,
    "adjacency_items": adjacency_of_items,
    "user_means": means_of_users,
    "item_means": means_of_items,
    "classify_requests": classified,
    "known_semi": known_semi,
    "unknown_anti": unknown_anti,
    "co_support_items": co_support_items,
    "co_ratings": co_rated_pairs,
    "item_pearson": pearson_of_items,
    "item_pearson_by_parts": pearson_of_items_by_parts,
    "item_pearson_in_blocks": pearson_of_items_in_blocks,
    "item_pearson_purchases": pearson_of_suppliers,
    "user_pearson": pearson_of_users,
    "canonical_pairs": reversed_pairs,
    "top_k_neighbors": top_k_neighbors,
    "equal_similarity_collapse": equal_similarity_collapse,
    "equal_similarity_items": equal_similarity_items,
    "equal_similarity_users": equal_similarity_users,
    "item_cf_basic": item_cf_basic,
    "item_cf_means": item_cf_means,
    "item_cf_topk": item_cf_topk,
    "item_cf_self": item_cf_with_self,
    "item_cf_collapsed": item_cf_collapsed,
    "item_cf_purchases": item_cf_purchases,
    "user_cf": user_cf,
    "user_cf_topk": user_cf_topk,
    "minhash_signatures": minhash_rows,
    "lsh_bands": band_rows,
    "lsh_buckets": band_buckets,
    "lsh_candidates": lsh_candidates,
    "jaccard": lsh_verified,
    "jaccard_exact": jaccard_exact,
    "jaccard_orders": jaccard_of_orders,
    "lsh_similar_items": similar_documents,
    "lsh_similar_by_parts": similar_documents_by_parts,
    "pair_precision_recall": precision_recall,
    "features": request_features,
    "features_training": training_features,
    "bias_baseline": baseline,
    "align_scores": aligned_scores,
    "blend_two": blend_two,
    "blend_four": blend_four,
    "item_cf_rmse": item_cf_rmse,
    "error_histogram": item_cf_errors,
    "evaluation_incomplete": evaluation_incomplete,
    "gbt_predict": tree_predictions,
    "gbt_rest": tree_rest,
    "mf_predict": factor_predictions,
    "mf_rest": factor_rest,
    "mf_products": factor_products,
    "mf_cold": factor_cold_starts,
    "tune_mf": tune_mf,
    "tune_bias": tune_bias,
    "hybrid_parts": hybrid_parts,
    "hybrid_blend": hybrid_blend,
    "ensemble_parts": ensemble_parts,
    "ensemble_blend": ensemble_blend,
    "hybrid_predict": hybrid,
    "ensemble_predict": ensemble,
    "ensemble_metrics": ensemble_metrics,
}
