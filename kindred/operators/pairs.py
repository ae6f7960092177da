"""Pairs of items (or users): co-ratings, co-support and Pearson similarity.

Pairs come out once, smaller id first. Ratings must be unique on (user, item).
"""

import math
from collections import namedtuple

from pyspark.sql import functions as F

from kindred.functions import pearson_from_sums
from kindred.operators.dense import dense_is_cheaper, dense_pearson
from kindred.operators.ratings import other_id
from kindred.operators.skew import ROWS_PER_SALT, ROWS_PER_TASK, join_tasks, wide_join
from kindred.storage import materialize, materialize_observed

# Degree above which one of the top raters leaves the self-join, see `pair_sums`.
HOT_DEGREE = 3_000
# Most blocks of entities a self-join is cut into.
MAX_BLOCKS = 4_000
# What a shuffled row of sums, a copied rating and an entry of a list take, and most entities of a rater that are sent as lists.
SUMS_BYTES, COPY_BYTES, ENTRY_BYTES = 60, 12, 5
WIDEST = 10_000

# What is counted before a way is chosen: eligible ratings, numbers of neighbours, targets and ratings of what is no neighbour, sizes of raters, their sums.
Prepared = namedtuple("Prepared", "facts entities degrees seen")


def canonical_pairs(pairs, first, second):
    """Order the two id columns of each pair, smaller first."""
    low, high = F.least(first, second), F.greatest(first, second)
    rest = [c for c in pairs.columns if c not in (first, second)]
    return pairs.select(low.alias(first), high.alias(second), *rest)


def _sized(pairs, facts):
    """Pairs with the numbers of members of both sides; sides without any are dropped."""
    sizes = facts.groupBy("e").agg(F.count(F.lit(1)).alias("n"))
    return pairs.join(sizes.select(F.col("e").alias("a"), F.col("n").alias("n_a")), "a").join(
        sizes.select(F.col("e").alias("b"), F.col("n").alias("n_b")), "b"
    )


def shared_members(pairs, facts, keep=None, keep_empty=False, rows_per_salt=ROWS_PER_SALT):
    """Rows `(a, b, n_a, n_b, o, x, y)` for each `o` that both sides of a demanded pair hold.

    `pairs` has columns `a, b`, and `n_a, n_b` if they are known; `facts` has `e, o, r`,
    unique on `(e, o)`. Each pair reads the members of its smaller side and looks them up
    in the larger one, so a side with very many members is walked only by sides of its own
    size. `keep` drops pairs by the sizes `n_a`, `n_b` before that. With `keep_empty` the
    members missing on the other side stay, with NULL in the value of that side.
    """
    sized = pairs if "n_a" in pairs.columns else _sized(pairs, facts)
    if keep is not None:
        sized = sized.where(keep)
    swap = F.col("n_a") > F.col("n_b")
    probes = materialize(
        sized.select(
            "a", "b", "n_a", "n_b",
            swap.alias("swap"),
            F.when(swap, F.col("b")).otherwise(F.col("a")).alias("small"),
            F.when(swap, F.col("a")).otherwise(F.col("b")).alias("large"),
        ),
        "probes",
    )
    members = facts.select(F.col("e").alias("small"), "o", F.col("r").alias("rs"))
    walked = wide_join(probes, members, "small", rows_per_salt)
    found = walked.join(
        facts.select(F.col("e").alias("large"), "o", F.col("r").alias("rl")),
        ["large", "o"],
        "left" if keep_empty else "inner",
    )
    return found.select(
        "a", "b", "n_a", "n_b", "o",
        F.when(F.col("swap"), F.col("rl")).otherwise(F.col("rs")).alias("x"),
        F.when(F.col("swap"), F.col("rs")).otherwise(F.col("rl")).alias("y"),
    )


def co_ratings(ratings, pairs, by="item_id"):
    """Both ratings of every co-rater of the demanded pairs.

    `pairs` has two id columns; the result adds the co-rater's id and `stars_1`, `stars_2`.
    """
    first, second = pairs.columns[:2]
    other = other_id(by)
    facts = ratings.select(F.col(by).alias("e"), F.col(other).alias("o"), F.col("stars").alias("r"))
    demanded = pairs.select(F.col(first).alias("a"), F.col(second).alias("b"))
    return shared_members(demanded, facts).select(
        F.col("a").alias(first), F.col("b").alias(second), F.col("o").alias(other),
        F.col("x").alias("stars_1"), F.col("y").alias("stars_2"),
    )


def _eligible_facts(ratings, entity, other, min_support, targets, requests=None):
    """Ratings of entities that can reach the support, with `t`: is it a target, and `h`: can it be a neighbour?

    With `requests`, a neighbour must hold a context that is asked for. An entity that is
    neither target nor neighbour is dropped, and two targets that cannot be neighbours make
    no pair.
    """
    facts = ratings.select(F.col(entity).alias("e"), F.col(other).alias("o"), F.col("stars").alias("r"))
    facts = facts.dropna()  # an unknown rating or id supports nothing, whatever way a pair is summed
    eligible = facts.groupBy("e").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_support).select("e")
    if targets is None:
        eligible = eligible.withColumn("t", F.lit(True))
    else:
        wanted = targets.select(F.col(entity).alias("e")).distinct().withColumn("w", F.lit(True))
        eligible = eligible.join(wanted, "e", "left").select("e", F.col("w").isNotNull().alias("t"))
    if requests is not None:
        asked = requests.select(F.col(other).alias("o")).dropna().distinct()
        held = ratings.select(F.col(entity).alias("e"), F.col(other).alias("o")).join(asked, "o", "left_semi").select("e").distinct()
        eligible = eligible.join(held.withColumn("h", F.lit(True)), "e", "left").fillna(False, ["h"]).where("t OR h")
    else:
        eligible = eligible.withColumn("h", F.lit(True))
    return facts.join(eligible, "e")


def _add_hot_raters(sums, hot_facts):
    """Add the co-ratings of the few raters that were kept out of the self-join."""
    vectors = hot_facts.groupBy("e").agg(F.map_from_entries(F.collect_list(F.struct("o", "r"))).alias("v"))
    both = sums.join(vectors.select(F.col("e").alias("a"), F.col("v").alias("va")), "a", "left").join(
        vectors.select(F.col("e").alias("b"), F.col("v").alias("vb")), "b", "left"
    )
    common = F.filter(
        F.transform(
            F.map_entries("va"),
            lambda s: F.struct(s["value"].alias("x"), F.try_element_at("vb", s["key"]).alias("y")),
        ),
        lambda s: s["y"].isNotNull(),
    )
    both = both.withColumn("hits", F.when(F.col("va").isNotNull() & F.col("vb").isNotNull(), common))

    def plus(column, value):
        extra = F.aggregate("hits", F.lit(0.0), lambda acc, s: acc + value(s))
        return (F.col(column) + F.coalesce(extra, F.lit(0.0))).alias(column)

    return both.select(
        "a", "b", "ta", "tb",
        (F.col("n") + F.coalesce(F.when(F.col("hits").isNotNull(), F.size("hits")), F.lit(0))).alias("n"),
        plus("sx", lambda s: s["x"]),
        plus("sy", lambda s: s["y"]),
        plus("sxy", lambda s: s["x"] * s["y"]),
        plus("sxx", lambda s: s["x"] * s["x"]),
        plus("syy", lambda s: s["y"] * s["y"]),
    )


def _smaller_first(sums):
    """Pairs whose first side is a target, with the smaller id first and a mark for either side."""
    swap = F.col("a") > F.col("b")
    pick = lambda yes, no, name: F.when(swap, yes).otherwise(no).alias(name)
    true, both = F.lit(True), F.col("tb")
    return sums.select(
        pick(F.col("b"), F.col("a"), "a"), pick(F.col("a"), F.col("b"), "b"), pick(both, true, "ta"), pick(true, both, "tb"),
        "n", pick(F.col("sy"), F.col("sx"), "sx"), pick(F.col("sx"), F.col("sy"), "sy"), "sxy",
        pick(F.col("syy"), F.col("sxx"), "sxx"), pick(F.col("sxx"), F.col("syy"), "syy"),
    )


def _six_sums(rows, *keys):
    """The sums that correlations are made of."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("x").alias("sx"),
        F.sum("y").alias("sy"),
        F.sum(F.col("x") * F.col("y")).alias("sxy"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"),
        F.sum(F.col("y") * F.col("y")).alias("syy"),
    )


def _degrees(facts):
    """Per rater: entities, targets and possible neighbours among them, and the pairs of both it makes, each once."""
    count = lambda where: F.count_if(where).cast("double")
    sizes = facts.groupBy("o").agg(
        F.count(F.lit(1)).cast("double").alias("_n"), count("h").alias("_r"), count("t").alias("_l"), count(F.expr("t AND h")).alias("_b")
    )
    made = F.col("_l") * F.col("_r") - F.col("_b") * (F.col("_b") + 1) / 2
    return sizes.withColumns({"_weight": F.col("_l") * F.col("_r") + F.col("_l") + F.col("_r"), "_made": made}).drop("_b")


def _measured(degrees, hot_degree):
    """One row: rows that are read and made, the largest weight, the most entities of a rater, and the number of hot raters."""
    sums = [F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("_weight", "_made", "_r", "_l")]
    return degrees.agg(
        *sums, F.count(F.lit(1)).alias("contexts"), F.max("_weight").alias("top"), F.max("_n").alias("widest"), F.count_if(F.col("_n") > hot_degree).alias("hot")
    ).first()


def _partial_sums(spark, seen, pairs):
    """Rows that a join by raters shuffles, combined in its tasks."""
    return min(seen["_made"], join_tasks(spark, seen["_made"]) * min(ROWS_PER_TASK, pairs))


def blocks_for(spark, seen, pairs, once=True):
    """Blocks of entities for a self-join, or 0 if its partial sums are the smaller shuffle.

    Joined by raters, a task makes partial sums of about all pairs, so as many rows as
    tasks times `pairs` are shuffled. Joined by pairs of blocks, the ratings are copied to
    each block instead, or to half of them if pairs of blocks meet `once`, and what a task
    sums up is final.
    """
    blocks = min(MAX_BLOCKS, math.ceil(math.sqrt((2 if once else 1) * join_tasks(spark, seen["_made"]))))
    copies = (seen["_r"] + seen["_l"]) / 2 * (blocks + 1) if once else (seen["_r"] + seen["_l"]) * blocks
    return blocks if copies < _partial_sums(spark, seen, pairs) else 0


def _lists_are_less(light, degrees, seen, shuffled, rows_per_salt):
    """Is what raters send to their entities as lists less than `shuffled` bytes, and little for any one entity?"""
    if not seen["_made"] or seen["widest"] > WIDEST or seen["_made"] * ENTRY_BYTES + seen["_r"] * COPY_BYTES >= shuffled:
        return False
    sent = light.join(degrees.select("o", "_n"), "o").groupBy("e").agg(F.sum("_n").alias("n"))
    return sent.agg(F.max("n")).first()[0] <= 4 * rows_per_salt


def _narrow(rows, column, *kinds):
    """`column` in the first of the narrower types `kinds` that holds all its values, if any does."""
    wide = rows.schema[column].dataType.simpleString()
    if wide not in ("bigint", "double"):
        return rows
    same = [F.coalesce(F.col(column).try_cast(kind).cast(wide) == F.col(column), F.lit(False)) for kind in kinds]
    fits = rows.agg(*[F.bool_and(s) for s in same]).first()
    return next((rows.withColumn(column, F.col(column).cast(kind)) for kind, fit in zip(kinds, fits) if fit), rows)


def _sums_by_lists(light, tasks):
    """Sums of all pairs, each in the task of its smaller entity.

    A rater sends each of its entities the list of those with larger ids, as plain arrays.
    What is shuffled are their entries, which take a fraction of the room of a row of sums.
    """
    kinds = {c: light.schema[c].dataType.simpleString() for c in ("e", "r")}
    narrow = _narrow(_narrow(light.select("o", "e", "r"), "e", "int"), "r", "tinyint", "float")
    lists = narrow.groupBy("o").agg(F.array_sort(F.collect_list(F.struct("e", "r"))).alias("m"))
    lists = lists.select(F.col("m.e").alias("es"), F.col("m.r").alias("rs"))
    sent = lists.select(F.posexplode("es").alias("p", "a"), "es", "rs").where(F.col("p") + 1 < F.size("es"))
    rest = lambda c: F.slice(c, F.col("p") + 2, F.size(c) - F.col("p") - 1)
    sent = sent.select("a", F.element_at("rs", F.col("p") + 1).alias("x"), rest("es").alias("es"), rest("rs").alias("rs")).repartition(tasks, "a")
    met = sent.select("a", F.col("x").cast(kinds["r"]).alias("x"), F.explode(F.arrays_zip("es", "rs")).alias("q"))
    met = met.select("a", F.col("q.es").alias("b"), "x", F.col("q.rs").cast(kinds["r"]).alias("y"))
    sums = _six_sums(met.where("a < b"), "a", "b")  # a rating that comes twice pairs no entity with itself
    return sums.withColumns({"a": F.col("a").cast(kinds["e"]), "b": F.col("b").cast(kinds["e"]), "tb": F.lit(True)})


def _sums_in_blocks(light, blocks, all_targets, once=True):
    """Sums of all pairs with a target, each in the one cell of blocks that its sides fall into.

    Ratings are dealt out by cell alone, which serves the lists of each rater and the sums
    as well: one shuffle. A target on the right meets the blocks up to its own, so a pair
    of targets is made once; any other entity meets all of them. A list holds what one
    rater has in one block. Where not all targets can be neighbours, a pair does not always
    meet both ways, so all blocks meet both ways, not `once`.
    """
    placed = light.withColumn("k", F.pmod(F.xxhash64("e"), F.lit(blocks)).cast("int"))
    last = F.lit(blocks - 1)
    # With targets alone nothing on the right lies in a block before that on the left.
    from_block = F.col("k") if all_targets else F.lit(0)
    entry = F.struct(F.col("e"), F.col("r"), F.col("t"), F.col("h"))
    sides = {
        "left": (placed.where("t"), F.sequence(from_block, last), F.col("k") * blocks + F.col("other"), F.lit(once) & (F.col("k") < F.col("other"))),
        "right": (
            placed.where("h"), F.sequence(F.lit(0), F.when(F.lit(once) & F.col("t"), F.col("k")).otherwise(last)),
            F.col("other") * blocks + F.col("k"), F.lit(once) & (F.col("other") < F.col("k")),
        ),
    }
    copies = [
        rows.withColumn("other", F.explode(others)).select(
            cell.alias("cell"), apart.alias("apart"), "o", F.lit(side == "left").alias("is_left"), entry.alias("entry")
        )
        for side, (rows, others, cell, apart) in sides.items()
    ]
    cells = blocks * (blocks + 1) // 2 if all_targets else blocks * blocks
    dealt = copies[0].unionByName(copies[1]).repartition(cells, "cell")
    lists = dealt.groupBy("cell", "apart", "o").agg(
        *(F.collect_list(F.when(F.col("is_left") == left, F.col("entry"))).alias(name) for name, left in (("la", True), ("lb", False)))
    )
    met = lists.where((F.size("la") > 0) & (F.size("lb") > 0)).withColumn("p", F.explode("la")).drop("la")
    met = met.withColumn("q", F.explode("lb")).select(
        "cell", "apart", F.col("p.e").alias("a"), F.col("q.e").alias("b"), (F.col("q.t") & F.col("p.h")).alias("tb"), F.col("p.r").alias("x"), F.col("q.r").alias("y")
    )
    made_once = ~F.col("tb") | F.col("apart") | (F.col("a") < F.col("b"))
    return _six_sums(met.where(made_once & (F.col("a") != F.col("b"))), "cell", "a", "b", "tb").drop("cell")


def _sums_by_raters(light, degrees, seen, all_targets, rows_per_salt):
    """The same sums from a join by raters, partial ones combined before they are shuffled."""
    left = light.where("t").select("o", F.col("e").alias("a"), F.col("r").alias("x"), F.col("h").alias("ha"))
    right = light.where("h").select("o", F.col("e").alias("b"), F.col("r").alias("y"), F.col("t").alias("tb"))
    met = wide_join(left, right, "o", rows_per_salt, degrees.drop("_made", "_n"), (seen["_weight"], seen["top"] or 0.0))
    met = met.withColumn("tb", F.col("tb") & F.col("ha"))
    # A pair of two targets meets twice and counts once.
    once = F.col("a") < F.col("b")
    return _six_sums(met.where(once if all_targets else once | (~F.col("tb") & (F.col("a") != F.col("b")))), "a", "b", "tb")


def demanded_pairs(requests, facts, by, most):
    """Pairs `(a, b, n_a, n_b, ta, tb)` of a requested target and what its context holds, and the rows it takes to sum them.

    A request asks only for the neighbours its context has rated. Gives `(None, rows)` as
    soon as finding and walking these pairs comes to more than `most` rows.
    """
    asked = requests.select(F.col(by).alias("t"), F.col(other_id(by)).alias("o")).dropna().distinct()
    held = facts.groupBy("o").agg(F.count(F.lit(1)).cast("double").alias("n"))
    rows = asked.groupBy("o").agg(F.count(F.lit(1)).alias("q")).join(held, "o").agg(F.sum(F.col("q") * F.col("n"))).first()[0] or 0.0
    if rows > most:
        return None, rows
    met = wide_join(asked, facts.select("o", "e"), "o").where("t <> e")
    sides = met.select(F.least("t", "e").alias("a"), F.greatest("t", "e").alias("b"), "t")
    pairs = sides.groupBy("a", "b").agg(F.max(F.col("t") == F.col("a")).alias("ta"), F.max(F.col("t") == F.col("b")).alias("tb"))
    pairs, seen = materialize_observed(_sized(pairs, facts), "demanded-pairs", walk=F.sum(F.least("n_a", "n_b")))
    rows += seen["walk"] or 0
    return (pairs if rows <= most else None), rows


def prepare(ratings, by, min_support, targets=None, hot_degree=HOT_DEGREE, requests=None):
    """Write the ratings that count for pairs and count what a join of them would read and make."""
    if requests is not None:
        targets = requests.select(by)
    facts, entities = materialize_observed(
        _eligible_facts(ratings, by, other_id(by), min_support, targets, requests), "pair-facts",
        all=F.approx_count_distinct(F.when(F.col("h"), F.col("e"))), barred=F.count_if(~F.col("h")), targets=F.approx_count_distinct(F.when(F.col("t"), F.col("e"))),
    )
    degrees = _degrees(facts)
    return Prepared(facts, entities, degrees, _measured(degrees, hot_degree))


def prefers_dense(prepared):
    """Are products of matrices the cheapest way to the pairs of these ratings?"""
    seen, entities = prepared.seen, prepared.entities
    return dense_is_cheaper(seen["_made"], entities["targets"], entities["all"], seen["contexts"])


def pair_sums(
    ratings, by="item_id", min_support=1, targets=None, hot_degree=HOT_DEGREE, rows_per_salt=ROWS_PER_SALT, requests=None, blocks=None,
    prepared=None,
):
    """Co-rating sums of every pair with at least `min_support` co-raters.

    Result: `a < b`, `ta`, `tb` (is the side a target), `n, sx, sy, sxy, sxx, syy`. With
    `targets`, only pairs with a target on at least one side; the self-join has the
    targets alone on its left side, so its rows fall with their number. With `requests`,
    rows of both ids, their ids on the `by` side are the targets, and pairs that no
    request asks for may be missing. Ratings with a null id or null stars do not count.

    Rows are counted first; then the cheapest of four ways is taken, each of which gives
    the whole result: demanded pairs one by one, a join by raters whose partial sums are
    shuffled, a join by pairs of blocks of entities, whose ratings are copied instead, or,
    where all entities are targets, lists that each rater sends to its entities. `blocks`
    sets the number of blocks, 0 for the join by raters.

    All of these prunings keep the result whole:

    * An entity with fewer raters than the support cannot be in a pair.
    * The `min_support - 1` raters with most ratings are left out of the self-join when
      they exceed `hot_degree`. A pair with full support has at least one rater who is
      not among so few, so it is found without them. Their part is then added from one
      short vector per entity, and the square of their degree is never produced.
    * Other raters with many ratings are salted, or spread over the cells of blocks.

    Calling this writes the eligible ratings and counts the join's keys, before any action,
    unless `prepared` has them from `prepare`.
    """
    if requests is not None:
        targets = requests.select(by)
    facts, entities, degrees, seen = prepared or prepare(ratings, by, min_support, targets, hot_degree, requests)
    if requests is not None:
        pairs, _ = demanded_pairs(requests, facts, by, seen["_made"])
        if pairs is not None:
            sums = _six_sums(shared_members(pairs.select("a", "b", "n_a", "n_b"), facts.select("e", "o", "r")), "a", "b")
            return sums.where(F.col("n") >= min_support).join(pairs.select("a", "b", "ta", "tb"), ["a", "b"])
    light, hot_facts = facts, None
    if min_support > 1 and seen["hot"]:
        hottest = degrees.where(F.col("_n") > hot_degree).orderBy(F.desc("_n"), "o").limit(min_support - 1).select("o")
        hottest = F.broadcast(hottest)  # at most min_support - 1 rows
        light = facts.join(hottest, "o", "left_anti")
        hot_facts = facts.join(hottest, "o", "left_semi")
        degrees = degrees.join(hottest, "o", "left_anti")
        seen = _measured(degrees, hot_degree)
    spark, once = ratings.sparkSession, not entities["barred"]
    by_lists = False
    if blocks is None:
        pairs = entities["all"] * entities["targets"] / (2 if targets is None else 1)
        blocks = blocks_for(spark, seen, pairs, once)
        if targets is None:
            copied = (seen["_r"] + seen["_l"]) / 2 * (blocks + 1)
            shuffled = copied * COPY_BYTES if blocks else _partial_sums(spark, seen, pairs) * SUMS_BYTES
            by_lists = _lists_are_less(light, degrees, seen, shuffled, rows_per_salt)
    if by_lists:
        sums = _sums_by_lists(light, join_tasks(spark, seen["_made"]))
    elif blocks:
        sums = _sums_in_blocks(light, blocks, targets is None, once)
    else:
        sums = _sums_by_raters(light, degrees, seen, targets is None, rows_per_salt)
    sums = _smaller_first(sums)
    if hot_facts is not None:
        sums = _add_hot_raters(sums, hot_facts)
    return sums.where(F.col("n") >= min_support)


def _pearson(ratings, by, min_support, positive_only, targets, dense=None, **tuning):
    """`dense` says whether pairs are summed by products of matrices; by default where that is cheaper."""
    if targets is None and not tuning and dense is not False:
        prepared = prepare(ratings, by, min_support)
        if dense or prefers_dense(prepared):
            pairs = dense_pearson(prepared.facts, prepared.entities["all"], min_support)
            pairs = pairs.select("a", "b", F.lit(True).alias("ta"), F.lit(True).alias("tb"), "common", "similarity")
            return pairs.where(F.col("similarity") > 0) if positive_only else pairs
        tuning = {"prepared": prepared}
    sums = pair_sums(ratings, by, min_support, targets, **tuning)
    similarity = pearson_from_sums(*(F.col(c) for c in ("n", "sx", "sy", "sxy", "sxx", "syy")))
    pairs = sums.select("a", "b", "ta", "tb", F.col("n").alias("common"), similarity.alias("similarity"))
    return pairs.where(F.col("similarity") > 0) if positive_only else pairs


def item_pearson(ratings, min_support=30, positive_only=False, targets=None, **tuning):
    """Pearson similarity of items over their co-raters: `(item_1, item_2, common, similarity)`."""
    pairs = _pearson(ratings, "item_id", min_support, positive_only, targets, **tuning)
    return pairs.select(F.col("a").alias("item_1"), F.col("b").alias("item_2"), "common", "similarity")


def user_pearson(ratings, min_support=60, positive_only=False, targets=None, **tuning):
    """Pearson similarity of users over co-rated items: `(user_1, user_2, common, similarity)`."""
    pairs = _pearson(ratings, "user_id", min_support, positive_only, targets, **tuning)
    return pairs.select(F.col("a").alias("user_1"), F.col("b").alias("user_2"), "common", "similarity")


def neighbour_lists(ratings, by, min_support, targets=None, include_self=False, **tuning):
    """Positive similarities seen from each target: `(target, neighbour, similarity)`.

    With `requests=` in place of `targets`, the neighbours that a request can use.
    """
    pairs = _pearson(ratings, by, min_support, True, targets, **tuning)
    sides = F.array(
        F.struct(F.col("a").alias("target"), F.col("b").alias("neighbour"), F.col("ta").alias("wanted")),
        F.struct(F.col("b").alias("target"), F.col("a").alias("neighbour"), F.col("tb").alias("wanted")),
    )
    lists = (
        pairs.select(F.explode(sides).alias("s"), "similarity")
        .where("s.wanted")
        .select("s.target", "s.neighbour", "similarity")
    )
    if not include_self:
        return lists
    # An entity equals itself wherever it has the support and any variance.
    own = ratings.groupBy(F.col(by).alias("target")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("stars").alias("sx"), F.sum(F.col("stars") * F.col("stars")).alias("sxx")
    )
    own = own.where((F.col("n") >= min_support) & (F.col("n") * F.col("sxx") > F.col("sx") * F.col("sx")))
    if tuning.get("requests") is not None:
        targets = tuning["requests"]
    if targets is not None:
        own = own.join(targets.select(F.col(by).alias("target")).distinct(), "target", "left_semi")
    return lists.unionByName(own.select("target", F.col("target").alias("neighbour"), F.lit(1.0).alias("similarity")))
