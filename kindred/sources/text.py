"""Text files: rating and request CSV, attribute JSON lines, result CSV.

The CSV dialect is plain: fields are split at commas and nothing is quoted.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

USER_FEATURES = StructType(
    [
        StructField("user_id", StringType()),
        StructField("review_count", LongType()),
        StructField("average_stars", DoubleType()),
    ]
)
ITEM_FEATURES = StructType(
    [
        StructField("business_id", StringType()),
        StructField("review_count", LongType()),
        StructField("stars", DoubleType()),
    ]
)


def _plain_csv(spark, path, names, extra=()):
    """The first `len(names)` columns as text, without any line that repeats the header's first field."""
    reader = spark.read.option("header", True).option("quote", "").option("ignoreLeadingWhiteSpace", True)
    found = reader.csv(path).columns  # reads one line
    if len(found) < len(names):
        raise ValueError(f"{path} has {len(found)} columns, expected at least {len(names)}")
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(found))])
    rows = reader.option("enforceSchema", True).schema(schema).csv(path)
    columns = [F.col(f"c{i}").alias(name) for i, name in enumerate(names)]
    # A blank first field is NULL and no header.
    return rows.where(~F.col("c0").eqNullSafe(F.lit(found[0]))).select(*columns, *extra)


def _number(column, strict):
    """Parse a DOUBLE: bad text fails the query, or with `strict=False` becomes NULL."""
    parsed = F.col(column).try_cast("double")
    if not strict:
        return parsed
    message = F.concat(F.lit(f"{column} is not a number: "), F.coalesce(column, F.lit("NULL")))
    return F.when(parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def _id(column, strict):
    """An id: a blank one fails the query, or with `strict=False` stays NULL."""
    if not strict:
        return F.col(column)
    return F.coalesce(column, F.raise_error(F.lit(f"{column} is missing"))).alias(column)


def read_ratings(spark, path, strict=True):
    """Ratings `(user_id, item_id, stars)`; tolerant mode drops rows without a number and keeps blank ids as NULL."""
    rows = _plain_csv(spark, path, ("user_id", "item_id", "raw_stars"))
    rows = rows.select(_id("user_id", strict), _id("item_id", strict), _number("raw_stars", strict).alias("stars"))
    return rows if strict else rows.where(F.col("stars").isNotNull())


def read_requests(spark, path, keep_order=False):
    """Requested pairs `(user_id, item_id)`; further columns of the file are not read, blank ids are NULL.

    `keep_order` adds `request_pos`, which sorts the rows like the lines of the file.
    """
    if not keep_order:
        return _plain_csv(spark, path, ("user_id", "item_id"))
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return _plain_csv(spark, path, ("user_id", "item_id"), (position.alias("request_pos"),))


def _read_json(spark, path, schema, strict):
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_user_features(spark, path, strict=True):
    """User attributes `(user_id, review_count, average_stars)`; other keys are not parsed."""
    return _read_json(spark, path, USER_FEATURES, strict)


def read_item_features(spark, path, strict=True):
    """Item attributes `(item_id, review_count, stars)`; other keys are not parsed."""
    return _read_json(spark, path, ITEM_FEATURES, strict).withColumnRenamed("business_id", "item_id")


def _read_scored(spark, path, value):
    rows = _plain_csv(spark, path, ("user_id", "item_id", value))
    return rows.select(_id("user_id", True), _id("item_id", True), _number(value, True).alias(value))


def read_truth(spark, path):
    """Labelled requests `(user_id, item_id, stars)`."""
    return _read_scored(spark, path, "stars")


def read_predictions(spark, path):
    """Written predictions `(user_id, item_id, prediction)`."""
    return _read_scored(spark, path, "prediction")


def _write_csv(df, path, names, spaced_header, mode):
    """Write with the given header; `spaced_header` puts a blank after each of its commas."""
    header = [name if i == 0 or not spaced_header else f" {name}" for i, name in enumerate(names)]
    (
        df.toDF(*header)
        .write.mode(mode)
        .option("header", True)
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", False)
        .csv(path)
    )


def write_pairs(pairs, path, spaced_header=False, mode="errorifexists"):
    """Similar pairs as CSV, smaller id first, sorted by both ids and the similarity."""
    first, second, similarity = pairs.columns[:3]
    canonical = pairs.select(
        F.least(first, second).alias("a"), F.greatest(first, second).alias("b"), F.col(similarity).alias("s")
    )
    names = ("business_id_1", "business_id_2", "similarity")
    _write_csv(canonical.orderBy("a", "b", "s"), path, names, spaced_header, mode)


def write_predictions(predictions, path, order_by=None, spaced_header=False, mode="errorifexists"):
    """Predictions as CSV; `order_by="request_pos"` restores the order of the request file."""
    ordered = predictions.orderBy(order_by) if order_by else predictions
    rows = ordered.select("user_id", "item_id", "prediction")
    _write_csv(rows, path, ("user_id", "business_id", "prediction"), spaced_header, mode)


def write_ratings(ratings, path, mode="errorifexists"):
    """Ratings as CSV in the layout `read_ratings` expects."""
    rows = ratings.select("user_id", "item_id", "stars")
    _write_csv(rows, path, ("user_id", "business_id", "stars"), False, mode)
