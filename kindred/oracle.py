"""DuckDB SQL for every query of the registry that SQL can express.

Written from the definitions, by the plainest route: full self-joins where the Spark
side prunes, `row_number` where it sorts in ranges, and so on.
"""

from kindred.functions import hash_coefficients

EVENTS = """
ev AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, ts, event_id,
         CAST(CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
                              WHEN 'signup' THEN 4 ELSE 5 END AS DOUBLE) AS stars
  FROM events)"""
CLICKS = EVENTS + """,
clicks AS (
  SELECT user_id, item_id, stars FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, event_id DESC) AS rn FROM ev)
  WHERE rn = 1)"""
PURCHASES = """
purchases AS (
  SELECT user_id, item_id, stars FROM (
    SELECT o_custkey AS user_id, l_suppkey AS item_id,
           CAST(least(5, 1 + floor((l_quantity - 1) / 10)) AS DOUBLE) AS stars,
           row_number() OVER (PARTITION BY o_custkey, l_suppkey
                              ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  WHERE rn = 1)"""
REQUESTS = """
requests AS (SELECT user_id, item_id FROM purchases UNION SELECT user_id, item_id FROM clicks)"""
FEATURES = """
uf AS (SELECT user_id, count(*) AS review_count, avg(stars) AS average_stars FROM ev GROUP BY 1),
itf AS (SELECT item_id, count(*) AS review_count, avg(stars) AS stars FROM ev GROUP BY 1)"""
FEATURE_COLUMNS = """
  coalesce(u.review_count, 0) AS user_review_count, round(coalesce(u.average_stars, 2.5), 6) AS user_average_stars,
  coalesce(i.review_count, 0) AS item_review_count, round(coalesce(i.stars, 2.5), 6) AS item_stars"""
TOKENS = """
members AS (
  SELECT DISTINCT doc_id AS item_id, member_id
  FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS member_id FROM documents)
  WHERE member_id <> ''),
ids AS (SELECT member_id, row_number() OVER (ORDER BY member_id) - 1 AS idx
        FROM (SELECT DISTINCT member_id FROM members))"""


def _with(*parts):
    return "WITH " + ",".join(parts) + "\n"


def _sums(ratings, entity, other, support, p=""):
    return f"""
{p}sums AS (
  SELECT x.{entity} AS a, y.{entity} AS b, count(*) AS n, sum(x.stars) AS sx, sum(y.stars) AS sy,
         sum(x.stars * y.stars) AS sxy, sum(x.stars * x.stars) AS sxx, sum(y.stars * y.stars) AS syy
  FROM {ratings} x JOIN {ratings} y ON x.{other} = y.{other} AND x.{entity} < y.{entity}
  GROUP BY 1, 2 HAVING count(*) >= {support}),
{p}sims AS (
  SELECT a, b, n, CASE WHEN n * sxx - sx * sx > 0 AND n * syy - sy * sy > 0
                       THEN (n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)) ELSE 0 END AS s
  FROM {p}sums)"""


def _lists(ratings, entity, support, include_self=False, p=""):
    own = f"""
  UNION ALL
  SELECT {entity}, {entity}, 1.0 FROM {ratings} GROUP BY 1
  HAVING count(*) >= {support} AND count(*) * sum(stars * stars) > sum(stars) * sum(stars)"""
    return f"""
{p}lists AS (
  SELECT a AS target, b AS neighbour, s FROM {p}sims WHERE s > 0
  UNION ALL
  SELECT b, a, s FROM {p}sims WHERE s > 0{own if include_self else ''})"""


MEANS = """
um AS (SELECT user_id, avg(stars) AS user_mean, count(*) AS user_n FROM {0} GROUP BY 1),
im AS (SELECT item_id, avg(stars) AS item_mean, count(*) AS item_n FROM {0} GROUP BY 1)"""


def _neighbour_rows(ratings, requests, target, p=""):
    """Neighbour rows with their rank by similarity and their order among equals."""
    context = "user_id" if target == "item_id" else "item_id"
    return f"""
{p}nb AS (
  SELECT q.user_id, q.item_id, l.neighbour, l.s, r.stars AS value, r.user_id AS rater
  FROM {requests} q
  JOIN {p}lists l ON l.target = q.{target}
  JOIN {ratings} r ON r.{context} = q.{context} AND r.{target} = l.neighbour),
{p}ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY s DESC, neighbour) AS rank,
         row_number() OVER (PARTITION BY user_id, item_id, round(s, 12) ORDER BY neighbour DESC) AS equal_rank
  FROM {p}nb)"""


def _item_cf(ratings="clicks", requests="requests", support=30, policy="constant", keep="TRUE", include_self=False):
    unknown = {"constant": "3.0", "means": "coalesce(im.item_mean, um.user_mean, 3.0)"}[policy]
    return [
        MEANS.format(ratings),
        _sums(ratings, "item_id", "user_id", support),
        _lists(ratings, "item_id", support, include_self),
        _neighbour_rows(ratings, requests, "item_id"),
        f"""
icf AS (
  SELECT q.user_id, q.item_id,
         CASE WHEN um.user_mean IS NOT NULL AND im.item_mean IS NOT NULL
              THEN coalesce(w.score, um.user_mean) ELSE {unknown} END AS prediction
  FROM {requests} q LEFT JOIN um USING (user_id) LEFT JOIN im USING (item_id)
  LEFT JOIN (SELECT user_id, item_id, sum(s * value) / sum(s) AS score FROM ranked WHERE {keep} GROUP BY 1, 2) w
    ON w.user_id = q.user_id AND w.item_id = q.item_id)""",
    ]


def _user_cf(keep="TRUE", support=20):
    """User CF; its steps are prefixed so that it fits next to item CF, and it needs the means."""
    return [
        _sums("clicks", "user_id", "item_id", support, "u_"),
        _lists("clicks", "user_id", support, p="u_"),
        _neighbour_rows("clicks", "requests", "user_id", "u_"),
        f"""
ucf AS (
  SELECT q.user_id, q.item_id,
         CASE WHEN um.user_mean IS NOT NULL AND im.item_mean IS NOT NULL
              THEN coalesce(um.user_mean + w.score, im.item_mean) ELSE 3.0 END AS prediction
  FROM requests q LEFT JOIN um USING (user_id) LEFT JOIN im USING (item_id)
  LEFT JOIN (SELECT k.user_id, k.item_id, sum(k.s * (k.value - v.user_mean)) / sum(k.s) AS score
             FROM u_ranked k JOIN um v ON v.user_id = k.rater WHERE {keep} GROUP BY 1, 2) w
    ON w.user_id = q.user_id AND w.item_id = q.item_id)""",
    ]


SCORED = "SELECT user_id, item_id, round(prediction, 6) AS prediction FROM "

BASELINE = """
mu AS (SELECT avg(stars) AS m FROM clicks),
bi AS (SELECT item_id, sum(stars - m) / (10.0 + count(*)) AS item_bias FROM clicks, mu GROUP BY 1),
bu AS (SELECT user_id, sum(stars - m - item_bias) / (10.0 + count(*)) AS user_bias
       FROM clicks JOIN bi USING (item_id), mu GROUP BY 1),
base AS (SELECT q.user_id, q.item_id, m + coalesce(user_bias, 0) + coalesce(item_bias, 0) AS prediction
         FROM requests q LEFT JOIN bu USING (user_id) LEFT JOIN bi USING (item_id), mu)"""
TREE = """
tree AS (SELECT q.user_id, q.item_id, coalesce(i.stars, 2.5) AS prediction, coalesce(i.review_count, 0) AS reviews
         FROM requests q LEFT JOIN itf i USING (item_id))"""


def _signatures(count=100):
    coefficients = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(hash_coefficients(count)))
    return f"""
h(pos, a, b) AS (VALUES {coefficients}),
sig AS (
  SELECT item_id, pos, min((a * idx + b) % (SELECT count(*) FROM ids)) AS value
  FROM members JOIN ids USING (member_id), h GROUP BY 1, 2),
bands AS (
  SELECT item_id, CAST(pos // 4 AS INTEGER) AS band,
         string_agg(CAST(value AS VARCHAR), ',' ORDER BY pos) AS band_key
  FROM sig GROUP BY 1, 2),
cand AS (
  SELECT DISTINCT x.item_id AS item_1, y.item_id AS item_2
  FROM bands x JOIN bands y ON x.band = y.band AND x.band_key = y.band_key AND x.item_id < y.item_id)"""


JACCARD = """
sizes AS (SELECT item_id, count(*) AS n FROM members GROUP BY 1),
common AS (
  SELECT x.item_id AS item_1, y.item_id AS item_2, count(*) AS c
  FROM members x JOIN members y ON x.member_id = y.member_id AND x.item_id < y.item_id GROUP BY 1, 2),
jac AS (
  SELECT item_1, item_2, c, p.n AS n_1, q.n AS n_2, c / CAST(p.n + q.n - c AS DOUBLE) AS similarity
  FROM common JOIN sizes p ON p.item_id = item_1 JOIN sizes q ON q.item_id = item_2),
exact AS (SELECT item_1, item_2, similarity FROM jac WHERE similarity >= 0.5)"""


def _chunks(ratings, owner, entry, lists, length=16):
    """Lists of an owner, split by the first 32 bits of the md5 of the other id."""
    return f"""SELECT {owner}, CAST(digest % chunks AS INTEGER) AS chunk, CAST(count(*) AS INTEGER) AS n, {lists}
  FROM (SELECT *, CAST('0x' || substr(md5(CAST({entry} AS VARCHAR)), 1, 8) AS BIGINT) AS digest FROM {ratings})
  JOIN (SELECT {owner}, CAST(ceil(count(*) / {length}.0) AS BIGINT) AS chunks FROM {ratings} GROUP BY 1) USING ({owner})
  GROUP BY 1, 2"""


# RMSE of the baseline by fold and damping; folds by the first 32 bits of the md5 of both ids.
_FOLDS = """, folded AS (
  SELECT *, CAST('0x' || substr(md5(user_id || ':' || item_id), 1, 8) AS BIGINT) % 5 AS fold FROM clicks),
grid AS (SELECT unnest([1.0, 10.0, 100.0]) :: DOUBLE AS reg),
train AS (SELECT f.fold AS held, t.* FROM (SELECT DISTINCT fold FROM folded) f JOIN folded t ON t.fold <> f.fold),
mu AS (SELECT held, avg(stars) AS m FROM train GROUP BY 1),
bi AS (SELECT held, reg, item_id, sum(stars - m) / (reg + count(*)) AS item_bias
       FROM train JOIN mu USING (held), grid GROUP BY 1, 2, 3),
bu AS (SELECT held, reg, user_id, sum(stars - m - item_bias) / (reg + count(*)) AS user_bias
       FROM train JOIN mu USING (held) JOIN bi USING (held, item_id) GROUP BY 1, 2, 3),
scored AS (
  SELECT f.fold, grid.reg, sqrt(avg(pow(stars - m - coalesce(item_bias, 0) - coalesce(user_bias, 0), 2))) AS rmse
  FROM folded f JOIN mu ON mu.held = f.fold, grid
  LEFT JOIN bi ON bi.held = f.fold AND bi.reg = grid.reg AND bi.item_id = f.item_id
  LEFT JOIN bu ON bu.held = f.fold AND bu.reg = grid.reg AND bu.user_id = f.user_id GROUP BY 1, 2),
means AS (SELECT reg, avg(rmse) AS rmse FROM scored GROUP BY 1)
SELECT 'biasReg=' || CAST(reg AS VARCHAR) AS params, round(rmse, 6) AS rmse, rmse = min(rmse) OVER () AS best FROM means"""


def oracle_queries():
    clicks, both = _with(CLICKS), _with(CLICKS, PURCHASES, REQUESTS)
    item_sims = _with(CLICKS, _sums("clicks", "item_id", "user_id", 30))
    pair_rows = "SELECT a AS item_1, b AS item_2, round(s, 6) AS similarity FROM sims"
    item_cf = _item_cf()
    lsh = _with(TOKENS, _signatures(), JACCARD)
    list_text = "string_agg(CAST({0} AS VARCHAR), ',' ORDER BY {0}) AS members"
    errors = "SELECT i.prediction - p.stars AS e FROM icf i JOIN purchases p USING (user_id, item_id)"
    known = "user_id IN (SELECT user_id FROM clicks) AND item_id IN (SELECT item_id FROM clicks)"
    known_errors = f"{errors} WHERE {known}"
    zeros = _with(CLICKS, PURCHASES, REQUESTS) + "SELECT user_id, item_id, CAST(0 AS DOUBLE) AS rest FROM requests"
    neighbours = _with(CLICKS, PURCHASES, REQUESTS, *item_cf)
    scores = [CLICKS, PURCHASES, REQUESTS, FEATURES, *_item_cf(policy="means"), *_user_cf(), BASELINE, TREE]
    blends = _with(*scores) + "SELECT user_id, item_id, CAST(0 AS DOUBLE) AS rest FROM requests"
    found = {
        "io_ratings": clicks + "SELECT user_id, item_id, stars FROM clicks",
        "io_requests": _with(PURCHASES) + "SELECT user_id, item_id FROM purchases",
        "io_user_features": _with(EVENTS, FEATURES)
        + "SELECT user_id, review_count, round(average_stars, 6) AS average_stars FROM uf",
        "io_item_features": _with(EVENTS, FEATURES)
        + "SELECT item_id, review_count, round(stars, 6) AS stars FROM itf",
        "io_scored": _with(CLICKS, PURCHASES, MEANS.format("clicks"))
        + """SELECT user_id, item_id, round(coalesce(item_mean, 3.0), 6) AS prediction, stars,
                    round(coalesce(item_mean, 3.0) - stars, 6) AS error
             FROM purchases LEFT JOIN im USING (item_id)""",
        "io_pairs": item_sims + pair_rows + " WHERE s > 0",
        "dedupe_ratings": clicks + "SELECT user_id, item_id, stars FROM clicks",
        "dedupe_purchases": _with(PURCHASES) + "SELECT user_id, item_id, stars FROM purchases",
        "distinct_users": _with(EVENTS) + "SELECT DISTINCT user_id FROM ev",
        "distinct_items": _with(EVENTS) + "SELECT DISTINCT item_id FROM ev",
        "rating_stats": clicks
        + """SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
                    round(avg(stars), 6) AS mean_stars FROM clicks""",
        "dense_index_users": "SELECT user_id AS id, row_number() OVER (ORDER BY user_id) - 1 AS idx "
        "FROM (SELECT DISTINCT user_id FROM events)",
        "dense_index_tokens": _with(TOKENS) + "SELECT member_id AS id, idx FROM ids",
        "encode_decode": clicks
        + """SELECT user_id, item_id, stars, u.idx AS user_idx, i.idx AS item_idx FROM clicks
             JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS idx
                   FROM (SELECT DISTINCT user_id FROM clicks)) u USING (user_id)
             JOIN (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS idx
                   FROM (SELECT DISTINCT item_id FROM clicks)) i USING (item_id)""",
        "member_sets": clicks + _chunks("clicks", "item_id", "user_id", list_text.format("user_id")),
        "rating_vectors": clicks
        + _chunks("clicks", "item_id", "user_id", "string_agg(user_id || ':' || CAST(stars AS INTEGER), ',' ORDER BY user_id) AS vector"),
        "adjacency": clicks + _chunks("clicks", "user_id", "item_id", list_text.format("item_id")),
        "adjacency_items": _with(PURCHASES) + _chunks("purchases", "item_id", "user_id", list_text.format("user_id")),
        "user_means": _with(CLICKS, MEANS.format("clicks"))
        + "SELECT user_id, round(user_mean, 6) AS user_mean, user_n FROM um",
        "item_means": _with(CLICKS, MEANS.format("clicks"))
        + "SELECT item_id, round(item_mean, 6) AS item_mean, item_n FROM im",
        "classify_requests": both
        + """SELECT user_id, item_id, user_id IN (SELECT user_id FROM clicks) AS user_known,
                    item_id IN (SELECT item_id FROM clicks) AS item_known FROM requests""",
        "known_semi": both
        + """SELECT user_id, item_id FROM requests WHERE user_id IN (SELECT user_id FROM clicks)
             AND item_id IN (SELECT item_id FROM clicks)""",
        "unknown_anti": both
        + "SELECT user_id, item_id FROM requests WHERE user_id NOT IN (SELECT user_id FROM clicks)",
        "co_support_items": item_sims + "SELECT a AS item_1, b AS item_2, n AS common FROM sums",
        "co_ratings": item_sims
        + """SELECT a AS item_1, b AS item_2, count(*) AS common, sum(x.stars * y.stars) AS dot,
                    sum(x.user_id * x.stars) AS weighted
             FROM sims JOIN clicks x ON x.item_id = a JOIN clicks y ON y.item_id = b AND y.user_id = x.user_id
             WHERE s > 0 GROUP BY 1, 2""",
        "item_pearson": item_sims
        + "SELECT a AS item_1, b AS item_2, n AS common, round(s, 6) AS similarity FROM sims",
        "item_pearson_purchases": _with(PURCHASES, _sums("purchases", "item_id", "user_id", 30))
        + "SELECT a AS item_1, b AS item_2, n AS common, round(s, 6) AS similarity FROM sims",
        "user_pearson": _with(CLICKS, _sums("clicks", "user_id", "item_id", 20))
        + "SELECT a AS user_1, b AS user_2, n AS common, round(s, 6) AS similarity FROM sims",
        "canonical_pairs": item_sims + pair_rows,
        "top_k_neighbors": neighbours
        + """SELECT user_id, item_id, neighbour, round(s, 6) AS similarity, value, CAST(rank AS INTEGER) AS rank
             FROM ranked WHERE rank <= 6""",
        "equal_similarity_collapse": neighbours
        + "SELECT user_id, item_id, neighbour, round(s, 6) AS similarity, value FROM ranked WHERE equal_rank = 1",
        "item_cf_basic": neighbours + SCORED + "icf",
        "item_cf_means": _with(CLICKS, PURCHASES, REQUESTS, *_item_cf(policy="means")) + SCORED + "icf",
        "item_cf_topk": _with(CLICKS, PURCHASES, REQUESTS, *_item_cf(keep="rank <= 6")) + SCORED + "icf",
        "item_cf_self": _with(CLICKS, PURCHASES, REQUESTS, *_item_cf(include_self=True)) + SCORED + "icf",
        "item_cf_collapsed": _with(CLICKS, PURCHASES, REQUESTS, *_item_cf(keep="equal_rank = 1")) + SCORED + "icf",
        "item_cf_purchases": _with(CLICKS, PURCHASES, REQUESTS, *_item_cf("purchases", "clicks", policy="means"))
        + SCORED + "icf",
        "user_cf": _with(CLICKS, PURCHASES, REQUESTS, MEANS.format("clicks"), *_user_cf()) + SCORED + "ucf",
        "user_cf_topk": _with(CLICKS, PURCHASES, REQUESTS, MEANS.format("clicks"), *_user_cf(keep="k.rank <= 6"))
        + "SELECT user_id, item_id, round(least(greatest(prediction, 1.0), 5.0), 6) AS prediction FROM ucf",
        "minhash_signatures": lsh + "SELECT item_id, CAST(pos AS INTEGER) AS pos, CAST(value AS BIGINT) AS value FROM sig",
        "lsh_bands": lsh + "SELECT item_id, band, band_key FROM bands",
        "lsh_buckets": lsh
        + """SELECT band, count(*) AS buckets, CAST(sum(n) AS BIGINT) AS items, max(n) AS largest
             FROM (SELECT band, band_key, count(*) AS n FROM bands GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1""",
        "lsh_candidates": lsh + "SELECT item_1, item_2 FROM cand",
        "jaccard": lsh
        + """SELECT item_1, item_2, coalesce(c, 0) AS common, p.n AS n_1, q.n AS n_2,
                    round(coalesce(similarity, 0), 6) AS similarity
             FROM cand LEFT JOIN jac USING (item_1, item_2)
             JOIN sizes p ON p.item_id = item_1 JOIN sizes q ON q.item_id = item_2""",
        "jaccard_orders": _with(
            """
members AS (SELECT DISTINCT l_orderkey AS item_id, l_suppkey AS member_id FROM lineitem)""", JACCARD
        )
        + "SELECT item_1, item_2, round(similarity, 6) AS similarity FROM jac WHERE similarity >= 0.8",
        "jaccard_exact": _with(TOKENS, JACCARD) + "SELECT item_1, item_2, round(similarity, 6) AS similarity FROM exact",
        "lsh_similar_items": lsh
        + "SELECT item_1, item_2, round(similarity, 6) AS similarity FROM exact JOIN cand USING (item_1, item_2)",
        "pair_precision_recall": lsh
        + """SELECT n_found, n_true, n_found AS n_both, CASE WHEN n_found > 0 THEN CAST(1 AS DOUBLE) END AS precision,
                    round(n_found / CAST(n_true AS DOUBLE), 6) AS recall
             FROM (SELECT count(*) AS n_found FROM exact JOIN cand USING (item_1, item_2)),
                  (SELECT count(*) AS n_true FROM exact)""",
        "features": _with(CLICKS, PURCHASES, REQUESTS, FEATURES)
        + f"""SELECT q.user_id, q.item_id, {FEATURE_COLUMNS} FROM requests q
              LEFT JOIN uf u USING (user_id) LEFT JOIN itf i USING (item_id)""",
        "features_training": _with(CLICKS, FEATURES)
        + f"""SELECT q.user_id, q.item_id, q.stars, {FEATURE_COLUMNS} FROM clicks q
              LEFT JOIN uf u USING (user_id) LEFT JOIN itf i USING (item_id)""",
        "bias_baseline": _with(CLICKS, PURCHASES, REQUESTS, BASELINE) + SCORED + "base",
        "align_scores": _with(*scores)
        + """SELECT user_id, item_id, reviews AS item_review_count, round(tree.prediction, 6) AS tree,
                    round(icf.prediction, 6) AS item_cf, round(base.prediction, 6) AS mf
             FROM tree JOIN icf USING (user_id, item_id) JOIN base USING (user_id, item_id)""",
        "blend_two": _with(*scores)
        + """SELECT user_id, item_id, round(CASE WHEN reviews < 100 THEN 0.5 * t.prediction + 0.5 * icf.prediction
                    ELSE 0.8 * t.prediction + 0.2 * icf.prediction END, 6) AS prediction
             FROM tree t JOIN icf USING (user_id, item_id)""",
        "blend_four": _with(*scores)
        + """SELECT user_id, item_id, round(CASE WHEN reviews < 100
                    THEN 0.7 * t.prediction + 0.05 * icf.prediction + 0.05 * ucf.prediction + 0.2 * base.prediction
                    ELSE 0.8 * t.prediction + 0.05 * icf.prediction + 0.05 * ucf.prediction + 0.1 * base.prediction
                    END, 6) AS prediction
             FROM tree t JOIN icf USING (user_id, item_id) JOIN ucf USING (user_id, item_id)
             JOIN base USING (user_id, item_id)""",
        "item_cf_rmse": neighbours + f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS unmatched, round(sqrt(avg(e * e)), 6) AS rmse FROM ({errors})",
        "error_histogram": neighbours
        + f"""SELECT bin, label, count(e) AS n
              FROM (VALUES (0, '[0,1)'), (1, '[1,2)'), (2, '[2,3)'), (3, '[3,4)'), (4, '[4,inf)'), (5, 'unmatched')) v(bin, label)
              LEFT JOIN ({errors}) x ON least(floor(abs(e)), 4) = bin GROUP BY 1, 2""",
        "evaluation_incomplete": neighbours
        + f""", e AS ({known_errors}),
              counts AS (SELECT (SELECT count(*) FROM e) AS n, (SELECT count(*) FROM purchases) AS n_true)
              SELECT 'n' AS metric, CAST(n AS DOUBLE) AS value FROM counts
              UNION ALL SELECT unnest(['unmatched', 'errors unmatched']), CAST(n_true - n AS DOUBLE) FROM counts
              UNION ALL SELECT 'rmse', round(sqrt(avg(e * e)), 6) FROM e
              UNION ALL SELECT 'errors ' || label, CAST(count(e) AS DOUBLE)
              FROM (VALUES (0, '[0,1)'), (1, '[1,2)'), (2, '[2,3)'), (3, '[3,4)'), (4, '[4,inf)')) v(bin, label)
              LEFT JOIN e ON least(floor(abs(e)), 4) = bin GROUP BY label""",
        "gbt_rest": zeros,
        "mf_products": zeros,
        "mf_rest": _with(PURCHASES) + "SELECT user_id, count(*) AS n, CAST(0 AS DOUBLE) AS rest FROM purchases GROUP BY 1",
        "tune_bias": _with(CLICKS) + _FOLDS,
        "equal_similarity_items": _with(
            CLICKS, PURCHASES, REQUESTS,
            """
twins AS (SELECT user_id, item_id, stars FROM clicks UNION ALL SELECT user_id, item_id + 1000000, stars FROM clicks)""",
            _sums("twins", "item_id", "user_id", 30), _lists("twins", "item_id", 30), _neighbour_rows("twins", "requests", "item_id"),
        )
        + "SELECT user_id, item_id, neighbour, round(s, 6) AS similarity, value FROM ranked WHERE equal_rank = 1",
        "io_request_order": _with(PURCHASES)
        + """SELECT user_id, item_id, row_number() OVER (PARTITION BY item_id ORDER BY user_id DESC) AS place
             FROM purchases""",
        "equal_similarity_users": _with(
            CLICKS, PURCHASES, _sums("purchases", "user_id", "item_id", 3), _lists("purchases", "user_id", 3),
            _neighbour_rows("purchases", "clicks", "user_id"),
        )
        + "SELECT user_id, item_id, neighbour, round(s, 6) AS similarity, value FROM ranked WHERE equal_rank = 1",
        "mf_cold": _with(CLICKS, PURCHASES, REQUESTS, BASELINE)
        + """SELECT user_id, item_id, round(least(greatest(prediction, 1.0), 5.0), 6) AS prediction FROM base
             WHERE user_id NOT IN (SELECT user_id FROM clicks) OR item_id NOT IN (SELECT item_id FROM clicks)""",
        "hybrid_parts": neighbours + "SELECT user_id, item_id, round(prediction, 6) AS item_cf FROM icf",
        "ensemble_parts": _with(*scores)
        + """SELECT user_id, item_id, round(icf.prediction, 6) AS item_cf, round(ucf.prediction, 6) AS user_cf
             FROM icf JOIN ucf USING (user_id, item_id)""",
        "hybrid_blend": blends,
        "ensemble_blend": blends,
    }
    found["item_pearson_by_parts"] = found["item_pearson_in_blocks"] = found["item_pearson"]
    found["lsh_similar_by_parts"] = found["lsh_similar_items"]
    return found

