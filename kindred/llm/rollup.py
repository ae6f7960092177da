"""Token counts as totals that are kept by signed changes.

Inserts, deletes and revised counts come in batches. Each batch is summed to one row for
each source, language and tokenizer version and stored in a partition of its own; totals
are sums over all batches. A batch that is delivered again replaces its own partition, so
a commit may be repeated after any failure.
"""

from pyspark.sql import functions as F

GROUP = ("source", "lang", "tokenizer")
DELTAS = "batch_id string, source string, lang string, tokenizer string, documents bigint, tokens bigint"


def inserts(counts, *more):
    """Changes that add the documents of `counts` `(source, lang, tokenizer, tokens)`."""
    return counts.select(*GROUP, F.lit(1).alias("documents"), F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"), *more)


def deletes(counts, *more):
    """Changes that take the documents of `counts` out again."""
    return counts.select(*GROUP, F.lit(-1).alias("documents"), (-F.coalesce("tokens", F.lit(0))).cast("bigint").alias("tokens"), *more)


def revisions(counts, *more):
    """Changes from an earlier count to another: `counts` has `old_tokens` as well."""
    change = F.coalesce("tokens", F.lit(0)) - F.coalesce("old_tokens", F.lit(0))
    return counts.select(*GROUP, F.lit(0).alias("documents"), change.cast("bigint").alias("tokens"), *more)


def commit(changes, folder, batch_id):
    """Commit changes as batch `batch_id`, a name or a column of the changes; an earlier commit of it is replaced.

    Rows are summed before they are shuffled, so a source that holds a third of all rows
    costs a row for each task. Null sources and languages are groups of their own; a null
    batch is an error. A batch without rows leaves an earlier commit of it as it is.
    """
    batch = batch_id if not isinstance(batch_id, str) else F.lit(batch_id)
    named = changes.withColumn("batch_id", F.coalesce(batch.cast("string"), F.raise_error(F.lit("a batch has no name"))))
    summed = named.groupBy("batch_id", *GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    writer = summed.repartition("batch_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_id").parquet(folder)


def totals(spark, folder):
    """`(source, lang, tokenizer, documents, tokens)`: sums of all commits, without groups that came to nothing."""
    deltas = spark.read.schema(DELTAS).parquet(folder)
    summed = deltas.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    return summed.where("documents <> 0 or tokens <> 0")


def token_counts(docs):
    """`(doc_id, source, lang, tokenizer, old_tokens, tokens)`: each document under each tokenizer version.

    `words-1` counts runs without blanks, `bytes-1` the bytes of UTF-8; null texts have
    none. `old_tokens` is the estimate that is known before the text is read: a word for
    every six characters, a byte for each.
    """
    text, chars = F.coalesce(docs["text"], F.lit("")), F.coalesce(docs["n_chars"], F.lit(0))
    versions = F.array(
        F.struct(F.lit("words-1").alias("tokenizer"), F.floor(chars / 6).alias("old_tokens"), F.regexp_count(text, F.lit("[^ \\t-\\r]+")).cast("bigint").alias("tokens")),
        F.struct(F.lit("bytes-1").alias("tokenizer"), chars.cast("bigint").alias("old_tokens"), F.octet_length(text).cast("bigint").alias("tokens")),
    )
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["source"].alias("source"), docs["lang"].alias("lang"), F.explode(versions).alias("_v"))
    return rows.select("doc_id", "source", "lang", "_v.*")


def maintained(docs, withdrawn, folder, batches=4):
    """Totals of `docs` without `withdrawn` ids, reached as a running system would.

    Documents arrive in `batches` inserts with estimated counts, the first of which is
    delivered twice; the counted texts follow as revisions, and the withdrawn documents
    are deleted with what they then count.
    """
    counts = token_counts(docs)
    batch = F.coalesce(F.pmod("doc_id", F.lit(batches)), F.lit(0))
    arriving = counts.withColumn("tokens", F.col("old_tokens")).withColumn("batch_id", F.concat(F.lit("insert-"), batch))
    added = inserts(arriving, "batch_id")
    commit(added, folder, F.col("batch_id"))
    commit(added.where("batch_id = 'insert-0'"), folder, F.col("batch_id"))
    commit(revisions(counts), folder, "revise")
    gone = withdrawn.select(withdrawn["doc_id"].alias("doc_id")).distinct()
    commit(deletes(counts.join(gone, "doc_id")), folder, "delete")
    return totals(docs.sparkSession, folder)


SQL = """
WITH kept AS (
  SELECT source, lang, coalesce(text, '') AS text FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 AND doc_id IS NOT NULL)
), counted AS (
  SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n FROM kept
  UNION ALL
  SELECT source, lang, 'bytes-1' AS tokenizer, strlen(text) AS n FROM kept
)
SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS documents, CAST(sum(n) AS BIGINT) AS tokens
FROM counted GROUP BY source, lang, tokenizer
"""
