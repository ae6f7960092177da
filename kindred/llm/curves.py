"""Approximate nearest neighbours on shifted space-filling curves.

Vectors are projected onto a few random directions, shifted and ordered along a Hilbert
curve, several times over. Spark deals each ordering out by ranges of keys; a query meets
the rows of the ranges around its own key, and what it meets on all curves is merged and
ranked by the exact inner product.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kindred.llm.vectors import best, matrix, ranked, usable, widest
from kindred.llm.words import worker_state
from kindred.storage import materialize

CURVES = 16
DIMS = 8
BITS = 5
# Share of all rows a query meets to either side of its own block, on each curve.
WINDOW = 0.03
# Most rows of a block, about.
BLOCK_ROWS = 8192
# Vectors that set the scale of the projections.
SAMPLE_ROWS = 10_000


def hilbert_keys(cells, bits):
    """Place of each row of `cells` (n by d, whole numbers below 2**bits) along the Hilbert curve.

    Works on all rows at once: bits are taken from the highest down, each level undoing
    the reflections and exchanges of the one above; the transposed bits are then
    Gray-decoded and interleaved. d * bits must not exceed 63.
    """
    x = cells.T.astype(np.int64).copy()
    d = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(d):
            high = (x[i] >> level) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[d - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flip
    keys = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            keys = (keys << 1) | ((x[i] >> level) & 1)
    return keys


class Curves:
    """Several Hilbert orderings, each of another projection, shifted against each other."""

    def __init__(self, sample, curves, dims, bits, seed=1):
        """sample: rows of vectors, for the scale of each projection."""
        width = sample.shape[1]
        self.dims, self.bits = min(dims, width), bits
        random = np.random.default_rng(seed)
        self.planes = [np.linalg.qr(random.normal(size=(width, width)))[0][:, : self.dims] for _ in range(curves)]
        self.middle = sample.mean(axis=0)
        self.scales = [np.maximum(((sample - self.middle) @ plane).std(axis=0), 1e-12) for plane in self.planes]
        self.shifts = [random.random(self.dims) * 0.2 - 0.1 for _ in range(curves)]

    def __len__(self):
        return len(self.planes)

    def keys(self, vectors, curve):
        """Keys of rows of vectors; six standard deviations span the cells, the rest is cut off to the edge."""
        at = (vectors - self.middle) @ self.planes[curve] / self.scales[curve] * 0.15 + 0.5 + self.shifts[curve]
        cells = np.clip(at * (1 << self.bits), 0, (1 << self.bits) - 1).astype(np.int64)
        return hilbert_keys(cells, self.bits)


def fit_curves(rows, width, curves=CURVES, dims=DIMS, bits=BITS, sample_rows=SAMPLE_ROWS):
    """Curves scaled by about `sample_rows` vectors, those with the smallest hashes of their ids."""
    total = rows.count()
    share = min(1.0, sample_rows / max(total, 1))
    chosen = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = matrix(chosen.toArrow()["vector"], width, np.float64)
    return Curves(sample if len(sample) else np.zeros((1, width)), curves, dims, bits), total


def ordered_blocks(rows, fitted, width, blocks):
    """Every vector once for each curve, `(block, vec_id, vector)`, written; blocks are ranges of keys."""
    shared = rows.sparkSession.sparkContext.broadcast(fitted)

    def work(batches):
        worker_state()
        fitted = shared.value
        for batch in batches:
            vectors = matrix(batch.column("vector"), width, np.float64)
            for curve in range(len(fitted)):
                keys = fitted.keys(vectors, curve)
                columns = [pa.array(np.full(len(keys), curve, dtype=np.int32)), pa.array(keys), batch.column("vec_id"), batch.column("vector")]
                yield pa.RecordBatch.from_arrays(columns, ["curve", "key", "vec_id", "vector"])

    kind = rows.schema["vector"].dataType.simpleString()
    keyed = rows.mapInArrow(work, f"curve int, key bigint, vec_id bigint, vector {kind}")
    dealt = keyed.repartitionByRange(blocks, "curve", "key", "vec_id")
    return materialize(dealt.select(F.spark_partition_id().alias("block"), "vec_id", "vector"), "curves")


def search_blocks(table, asking, k, width):
    """`(query_id, vec_id, score)`: the best of each block for the queries sent to it."""

    def work(candidates, queries):
        worker_state()
        ids, asked = candidates["vec_id"].to_numpy(), queries["query_id"].to_numpy()
        vectors, wanted = matrix(candidates["vector"], width, np.float64), matrix(queries["vector"], width, np.float64)
        rows = []
        for start in range(0, len(asked), 256):
            for i, near in enumerate(wanted[start : start + 256] @ vectors.T, start):
                places = np.flatnonzero(ids != asked[i])
                places = places[best(near[places], ids[places], k, slack=1e-9)]
                # Summed anew in one order, so that equal vectors have equal scores in every block.
                exact = (vectors[places] * wanted[i]).sum(axis=1)
                keep = best(exact, ids[places], k)
                rows.append((np.full(len(keep), asked[i]), ids[places[keep]], exact[keep]))
        columns = [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    groups = table.groupBy("block").cogroup(asking.groupBy("block"))
    return groups.applyInArrow(work, "query_id bigint, vec_id bigint, score double")


def nearest(embeddings, k=20, every=20, curves=CURVES, window=WINDOW, block_rows=BLOCK_ROWS):
    """`(query_id, rank, vec_id, score)`: for each query the `k` largest inner products found.

    Queries are the rows whose `vec_id` is a multiple of `every`. On each curve a query
    meets the rows of its own block of keys and of the blocks next to it, `window` of all
    rows to either side at least; what all curves find is merged and ranked by the inner
    product in double precision, ties to the smaller `vec_id`. Rows with the query's own
    id are no candidates.

    Rows with a null id, null or zero vectors and such as hold null or non-finite
    components take no part; missing components of shorter vectors count as 0. A repeated
    id appears once for a query, with its highest score. Other columns are not read.

    Blocks have at most about `block_rows` rows, more blocks to either side making up the
    window. Vectors without structure need a share of all rows for a given recall, so the
    window is a share.
    """
    rows = usable(embeddings, zero=False)
    width = widest(rows)
    fitted, total = fit_curves(rows, width, curves)
    wide = max(256, int(np.ceil(window * total)))
    reach = -(-wide // block_rows)
    size = -(-wide // reach)
    table = ordered_blocks(rows, fitted, width, max(1, -(-curves * total // size)))
    asking = table.where(F.pmod("vec_id", F.lit(every)) == 0).select(
        F.explode(F.sequence(F.col("block") - reach, F.col("block") + reach)).alias("block"),
        F.col("vec_id").alias("query_id"), "vector",
    )
    found = search_blocks(table, asking.distinct(), k, width)
    return ranked(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k)
