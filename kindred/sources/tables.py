"""Ratings, requests, attributes and member sets taken from the test tables.

Two sets of ratings exist. Each serves as training data with the pairs of the other as
requests, so every row of the tables is used and all four combinations of known and
unknown ids occur:

* clicks: `events`, item = the number in `props`, stars from the kind of event;
* purchases: `orders` with `lineitem`, item = supplier, stars from the quantity.
"""

from pyspark.sql import functions as F

from kindred.operators.ratings import dedupe_ratings

# Stars of an event by its type; any other type has 5. Fixed values.
EVENT_STARS = {"error": 1, "view": 2, "click": 3, "signup": 4}


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def click_events(spark, folder):
    """All events as `(user_id, item_id, stars, ts, event_id)`, repeats included."""
    stars = F.lit(5)
    for kind, value in EVENT_STARS.items():
        stars = F.when(F.col("event_type") == kind, value).otherwise(stars)
    return table(spark, folder, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        stars.cast("double").alias("stars"),
        "ts",
        "event_id",
    )


def click_ratings(spark, folder):
    return dedupe_ratings(click_events(spark, folder), ("ts", "event_id"))


def purchase_lines(spark, folder):
    """All order lines as `(user_id, item_id, stars, l_orderkey, l_linenumber, l_quantity)`."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")
    stars = F.least(F.lit(5), 1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("double")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "user_id", F.col("l_suppkey").alias("item_id"), stars.alias("stars"),
        "l_orderkey", "l_linenumber", "l_quantity",
    )


def purchase_ratings(spark, folder):
    return dedupe_ratings(purchase_lines(spark, folder), ("l_orderkey", "l_linenumber", "l_quantity"))


def user_features(spark, folder):
    """Attributes of the users of all click events."""
    events = click_events(spark, folder)
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("review_count"), F.avg("stars").alias("average_stars"))


def item_features(spark, folder):
    """Attributes of the items of all click events."""
    events = click_events(spark, folder)
    return events.groupBy("item_id").agg(F.count(F.lit(1)).alias("review_count"), F.avg("stars").alias("stars"))


def document_members(spark, folder):
    """Distinct `(item_id, member_id)`: document and lower-case token of letters and digits of any script."""
    texts = table(spark, folder, "documents").select("doc_id", "text")
    # A few files would leave most cores idle in the costly split below.
    texts = texts.repartition("doc_id")
    tokens = F.array_distinct(F.split(F.lower("text"), "[^\\p{L}\\p{N}]+"))
    return texts.select(F.col("doc_id").alias("item_id"), F.explode(tokens).alias("member_id")).where("member_id <> ''")


def order_members(spark, folder):
    """Distinct `(item_id, member_id)`: order and supplier. Short sets of few suppliers."""
    lines = table(spark, folder, "lineitem")
    return lines.select(F.col("l_orderkey").alias("item_id"), F.col("l_suppkey").alias("member_id")).distinct()
