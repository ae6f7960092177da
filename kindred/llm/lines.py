"""Line dedup in DataFrame operations alone: later copies of a line go, its first document keeps it.

Lines travel as 128-bit hashes with the place they stand at. The hashes are dealt out by
ranges and sorted by document and position behind the hash, so a running window streams
each hash once and sees its first document first. What comes back for a document is a
run-length compressed bitmap of the lines that stay, not text.

A line that is a large share of all lines would fill one range. Such hashes are found on a
sample beforehand, which only chooses their way: their first document comes from an exact
aggregate over all rows, combined before it is shuffled, and is broadcast to the lines.
"""

import string

from pyspark.sql import Window
from pyspark.sql import functions as F

from kindred.storage import materialize, materialize_observed

MIN_CHARS = 10
# Lines a range should hold.
ROWS_PER_RANGE = 2_000_000
# One line in so many, chosen by its place, tells which hashes are hot.
SAMPLED = 16
# Most hot hashes: they are those above one part in so many of all lines.
MAX_HOT = 200_000
# Where documents without an id stand: behind all others, as if they were one.
NO_ID = (1 << 63) - 1

_BLANKS = " \t\n\x0b\x0c\r"
_KEY = ["h1", "h2"]
_ROW = ["_d", "_t"]


def _with_row_key(docs):
    """Document and text hash: rows alike in both get the same decision."""
    return docs.withColumns({"_d": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)), "_t": F.xxhash64("text")})


def _lines_of(text):
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(docs, min_chars=MIN_CHARS):
    """`(_d, _t, pos, h1, h2)` for each line whose key has at least `min_chars` code points.

    The key is the line without blanks (0x20, 0x09-0x0D) at its ends, A-Z in lower case.
    """
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    lines = _with_row_key(docs).select(*_ROW, F.posexplode(_lines_of(lowered)).alias("pos", "line"))
    keys = lines.withColumn("key", F.btrim("line", F.lit(_BLANKS))).where(F.char_length("key") >= min_chars)
    return keys.select(*_ROW, "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))


def _hot(lines, rows, ranges):
    """Hashes that hold more than half the lines of a range, by a sample; at most `2 * ranges` or `MAX_HOT`."""
    limit = rows / min(2 * ranges, MAX_HOT) / SAMPLED
    drawn = lines.where(F.pmod(F.xxhash64(*_ROW, "pos"), F.lit(SAMPLED)) == 0)
    return drawn.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select(*_KEY)


def later_lines(lines, rows, rows_per_range=ROWS_PER_RANGE):
    """`(_d, _t, pos)` of the lines whose hash is in a document with a smaller id as well; `rows` counts `lines`."""
    spark = lines.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_range))
    hot = materialize(_hot(lines, rows, ranges), "hot-lines")
    firsts = lines.join(F.broadcast(hot), _KEY).groupBy(*_KEY).agg(F.min("_d").alias("first"))
    common = lines.join(F.broadcast(materialize(firsts, "first-lines")), _KEY)
    # A range of h1 holds its hashes whole, so the window needs no further shuffle.
    dealt = lines.join(F.broadcast(hot), _KEY, "left_anti").repartitionByRange(ranges, "h1")
    stream = Window.partitionBy(*_KEY).orderBy("_d", "_t", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rare = dealt.withColumn("first", F.first("_d").over(stream))
    place = [*_ROW, "pos"]
    return rare.where("_d > first").select(*place).unionByName(common.where("_d > first").select(*place))


def keep_bitmaps(docs, keep=("doc_id",), min_chars=MIN_CHARS, rows_per_range=ROWS_PER_RANGE):
    """The columns `keep` with `n_lines, n_dropped, keep_runs` for every row.

    A text is split at `\\n`. Lines with a key of at least `min_chars` code points that is
    in two documents or more are dropped except in the document with the smallest id, where
    all of them stay. `keep_runs` is the bitmap of the lines that stay, as sorted runs
    `(start, length)`; a row with nothing left has none.

    A null or empty text is one empty line. Rows with one id count as one document, so they
    do not drop each other's lines; rows without an id count as one document behind all
    others. Equal rows get equal results. Other columns are not read; an empty table gives
    no rows. Equal 128-bit hashes are taken for equal keys. Runs Spark jobs.
    """
    lines, seen = materialize_observed(line_hashes(docs, min_chars), "lines", rows=F.count(F.lit(1)))
    later = later_lines(lines, seen["rows"], rows_per_range)
    dropped = later.groupBy(*_ROW).agg(F.array_sort(F.collect_set("pos")).alias("p"))
    changed = dropped.select(
        *_ROW,
        F.size("p").cast("bigint").alias("n_dropped"),
        F.expr("filter(p, (x, i) -> NOT (get(p, i - 1) <=> x - 1))").alias("from"),
        F.expr("filter(p, (x, i) -> NOT (get(p, i + 1) <=> x + 1))").alias("to"),
    )
    # Kept runs lie between the dropped ones, of which there may be none next to an end.
    begins = "concat(array(0), transform(to, x -> x + 1))"
    ends = "concat(from, array(cast(n_lines as int)))"
    runs = f"filter(zip_with({begins}, {ends}, (a, b) -> struct(a as start, b - a as length)), r -> r.length > 0)"
    rows = _with_row_key(docs.select(*dict.fromkeys([*keep, "doc_id", "text"])))
    rows = rows.withColumn("n_lines", F.size(_lines_of(F.col("text"))).cast("bigint"))
    if "text" not in keep:
        rows = rows.drop("text")
    found = rows.join(changed, _ROW, "left").select(
        *keep,
        "n_lines",
        F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"),
        F.coalesce(F.expr(runs), F.expr("array(struct(0 as start, cast(n_lines as int) as length))")).alias("keep_runs"),
    )
    return found


def kept_texts(marked):
    """Rows of `keep_bitmaps` that kept `text`, with `kept_text`: the lines of the runs, joined by `\\n`."""
    # The generator keeps the split from being repeated for each run.
    split = marked.withColumn("_lines", F.explode(F.array(F.when(F.col("n_dropped") > 0, _lines_of(F.col("text"))))))
    kept = F.expr("array_join(flatten(transform(keep_runs, r -> slice(_lines, r.start + 1, r.length))), '\\n')")
    text = F.when(F.col("n_dropped") > 0, kept).otherwise(F.coalesce("text", F.lit("")))
    return split.select(*marked.columns, text.alias("kept_text"))


def digests(kept):
    """`(doc_id, n_lines, n_dropped, kept_sha256)` of rows of `kept_texts`."""
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, CAST(generate_subscripts(l, 1) AS BIGINT) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
firsts AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT doc_id, pos, line, coalesce(doc_id > first, false) AS dropped
  FROM keyed LEFT JOIN firsts USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""
