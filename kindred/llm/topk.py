"""Exact top-k search: exhaustive, term at a time.

Components of a vector are weighted terms. A block of candidates is turned into postings,
for each term the candidates that hold it and their weights. Each query scatters its
weight times the postings of its terms into a dense array of scores, one entry a
candidate; partition selection keeps the best of the block, and the best of all blocks
and tasks are merged.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kindred.llm.vectors import best, matrix, ranked, usable, widest
from kindred.llm.words import worker_state

# Queries that are sent out at once, and those scored against a batch at once.
QUERIES_A_ROUND = 8192
QUERIES_AT_ONCE = 256

SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantized(rows, factor=1024):
    """Components x as floor(factor * x), as whole numbers."""
    return rows.select("vec_id", F.transform("vector", lambda x: F.floor(factor * x.cast("double"))).alias("vector"))


def postings(weights):
    """`(term, candidates, weights)` of each term that any row of `weights` holds."""
    for term in range(weights.shape[1]):
        holders = np.flatnonzero(weights[:, term])
        if len(holders):
            yield term, holders, weights[holders, term]


def accumulate(queries, lists, n):
    """Scores of `n` candidates for each row of `queries`, term at a time."""
    scores = np.zeros((len(queries), n), dtype=np.int64)
    for term, holders, weights in lists:
        asking = np.flatnonzero(queries[:, term])
        if not len(asking):
            continue
        gain = queries[asking, term][:, None] * weights[None, :]
        if len(holders) == n:
            scores[asking] += gain
        else:
            scores[asking[:, None], holders[None, :]] += gain
    return scores


class Leaders:
    """The best `k` found so far of each query."""

    def __init__(self, n, k):
        self.k, self.found = k, [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))] * n

    def meet(self, i, ids, scores):
        ids, scores = np.concatenate([self.found[i][0], ids]), np.concatenate([self.found[i][1], scores])
        keep = best(scores, ids, self.k)
        self.found[i] = ids[keep], scores[keep]


def search_round(candidates, queries, k, width):
    """`(query_id, vec_id, score)`: the best of each task, for one round of queries."""
    spark = candidates.sparkSession
    held = queries.toArrow()  # at most about QUERIES_A_ROUND rows
    ids = held["vec_id"].to_numpy()
    shared = spark.sparkContext.broadcast((ids, matrix(held["vector"], width, np.int64)))

    def work(batches):
        worker_state()
        ids, weights = shared.value
        leaders = Leaders(len(ids), k)
        for batch in batches:
            own = batch.column("vec_id").to_numpy()
            lists = list(postings(matrix(batch.column("vector"), width, np.int64)))
            for start in range(0, len(ids), QUERIES_AT_ONCE):
                scores = accumulate(weights[start : start + QUERIES_AT_ONCE], lists, len(own))
                for i, row in enumerate(scores, start):
                    places = np.flatnonzero(own != ids[i])
                    keep = places[best(row[places], own[places], k)]
                    leaders.meet(i, own[keep], row[keep])
        for query, (found, score) in zip(ids, leaders.found):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), query)), pa.array(found), pa.array(score)], schema=SCHEMA
            )

    return candidates.mapInArrow(work, "query_id bigint, vec_id bigint, score bigint")


def exact_top_k(embeddings, k=10, every=100, factor=1024):
    """`(query_id, rank, vec_id, score)`: for each query its `k` highest integer inner products.

    Queries are the rows whose `vec_id` is a multiple of `every`; candidates are all rows
    but those with the query's own id. Ranks start at 1, ties go to the smaller `vec_id`;
    a query with fewer candidates gets them all. Rows with a null id, a null vector or a
    component that is null or not finite take no part; missing components of shorter
    vectors count as 0, so vectors of zeros or without components score 0. A query that
    is repeated is answered once, by its highest scores over the repeats; a repeated
    candidate id appears once, with its highest score. Other columns are not read.
    Components so large that a score might not fit 64 bits are an error.

    Queries go out in rounds of bounded size, each against all candidates; between the
    rounds and tasks only `k` rows for each query are shuffled.
    """
    rows = quantized(usable(embeddings), factor)
    width = widest(rows)
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    asking = rows.where(is_query)
    size = F.greatest(F.array_max("vector").cast("double"), -F.array_min("vector").cast("double"))
    n, largest_query, largest = rows.agg(F.count_if(is_query), F.max(F.when(is_query, size)), F.max(size)).first()
    if width * (largest_query or 0) * (largest or 0) >= 2.0**63:
        raise ValueError("scores of these components do not fit 64 bits; lower the factor")
    rounds = max(1, -(-n // QUERIES_A_ROUND))
    found = None
    for i in range(rounds):
        queries = asking if rounds == 1 else asking.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == i)
        part = search_round(rows, queries, k, width)
        found = part if found is None else found.unionByName(part)
    return ranked(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k)


SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ordered AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ordered WHERE rank <= 10
"""
