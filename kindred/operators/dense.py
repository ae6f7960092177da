"""Pearson similarities as products of matrices, for entities that share most of their contexts.

A self-join makes a row for each pair and shared context. Where ratings are dense, these
rows are many times the ratings, while the sums behind a correlation are products of
matrices of entities by contexts. Entities are dealt into blocks, each pair of blocks is a
cell and goes to one task, which keeps a few lines of a product at a time. The sums of
integer and half-star ratings are exact, as in the join.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.operators.cells import HELD_BYTES, compared, written_blocks
from kindred.session import reachable
from kindred.storage import first_row

# Joined rows below which the join does as well.
LEAST_ROWS = 10_000_000
# Multiplications that cost no more than one joined row.
PRODUCTS_PER_ROW = 50
# Most contexts, which bound the lists of an entity.
MOST_CONTEXTS = 20_000
# Entities of a block on either side, lines of a product that are held at once, contexts of one product.
LEFT_BLOCK, RIGHT_BLOCK = 4_096, 16_384
LINES = 64
WIDTH = 512
# Largest whole number up to which single precision is exact.
EXACT_SINGLE = 2**24


def dense_is_cheaper(made, targets, entities, contexts):
    """Do products of matrices cost less than a join that makes `made` rows?"""
    bounded = contexts <= min(entities, MOST_CONTEXTS)
    return bounded and made >= LEAST_ROWS and targets * entities * contexts <= PRODUCTS_PER_ROW * made


def _block(blocks):
    return F.pmod(F.xxhash64("e"), F.lit(blocks)).cast("int")


def _lists(rows, key, **columns):
    """Per `key`, lists of the given columns in the same order."""
    lists = rows.groupBy(key).agg(F.collect_list(F.struct(*[F.col(c).alias(n) for n, c in columns.items()])).alias("_l"))
    return lists.select(key, *[F.col(f"_l.{n}").alias(n) for n in columns])


def _deal(left, right, cells):
    """Both sides by cell, each side in the order of its ids. More partitions than cells, so that few share one."""
    columns = left.columns + [c for c in right.columns if c not in left.columns]

    def whole(rows, is_left):
        missing = {c: F.lit(None).cast((left if c in left.columns else right).schema[c].dataType) for c in columns if c not in rows.columns}
        return rows.withColumns(missing).select(*columns, F.lit(is_left).alias("is_left"))

    dealt = whole(left, True).unionByName(whole(right, False)).repartition(4 * cells, "cell")
    return dealt.sortWithinPartitions("cell", "is_left", "e")


def _by_cell(batches):
    """Tables of one cell each, from batches in the order of cells."""
    held, current = [], None
    for batch in batches:
        cells = batch.column("cell").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if held and cells[start] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = cells[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _sides(table):
    is_left = table["is_left"]
    return [table.filter(mask).combine_chunks() for mask in (is_left, pc.invert(is_left))]


def _flat(table, column):
    """Line numbers and values of a column of lists."""
    lists = table[column].combine_chunks() if table.num_rows else pa.array([], table.schema.field(column).type)
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    return pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64), pc.list_flatten(lists)


class _Entries:
    """A sparse matrix by lines: cut by columns into chunks of `step`, made dense a few lines at a time.

    An entry that comes twice counts twice, as it would in a join.
    """

    def __init__(self, rows, columns, values, lines, width, step):
        self.lines, self.parts = lines, []
        for first in range(0, width, step):
            inside = (columns >= first) & (columns < first + step)
            self.parts.append((rows[inside], columns[inside] - first, values[inside], min(step, width - first)))

    def dense(self, part, powers, start=0, end=None, dtype=np.float64):
        rows, columns, values, width = self.parts[part]
        end = self.lines if end is None else min(end, self.lines)
        low, high = np.searchsorted(rows, [start, end])
        at = (rows[low:high] - start) * width + columns[low:high]
        shape, own = (end - start, width), values[low:high]
        return [
            np.bincount(at, own**p if p else None, shape[0] * shape[1])[: shape[0] * shape[1]].reshape(shape).astype(dtype, copy=False)
            for p in powers
        ]


def _co_rated(left, right, step):
    """Entries of both sides over the contexts that both have, and the precision that is exact."""
    flats = [_flat(side, "o") for side in (left, right)]
    codes = pa.concat_arrays([values for _, values in flats]).dictionary_encode()
    n_codes, codes = len(codes.dictionary), codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    codes = [codes[: len(flats[0][1])], codes[len(flats[0][1]) :]]
    shared = np.logical_and(*(np.bincount(c, minlength=n_codes) > 0 for c in codes))
    place, width = np.cumsum(shared) - 1, int(shared.sum())
    entries, top, whole = [], 0.0, True
    for side, (rows, _), code in zip((left, right), flats, codes):
        stars = _flat(side, "r")[1].to_numpy(zero_copy_only=False)
        kept = shared[code]
        entries.append(_Entries(rows[kept], place[code[kept]], stars[kept], side.num_rows, width, step))
        top, whole = max(top, np.abs(stars).max(initial=0.0)), whole and bool(np.all(stars * 2 == np.rint(stars * 2)))
    repeats = max((np.bincount(rows * step + columns).max(initial=0) for e in entries for rows, columns, _, _ in e.parts), default=0)
    single = whole and repeats <= 1 and 4 * (max(top, 1.0) * max(width, 1)) ** 2 < EXACT_SINGLE
    return entries, np.float32 if single else np.float64


def _similarities(left, right, min_support, lines, step):
    """For a few lines of the left side at a time: first line, co-raters and Pearson similarity with every right one."""
    (of_left, of_right), dtype = _co_rated(left, right, step)
    parts = range(len(of_right.parts))
    kept = of_right.dense(0, (0, 1, 2), dtype=dtype) if len(parts) == 1 else None
    for start in range(0, left.num_rows, lines):
        end = min(start + lines, left.num_rows)
        sums = [0] * 6 if len(parts) else np.zeros((6, end - start, right.num_rows))
        for part in parts:
            m, x, q = of_left.dense(part, (0, 1, 2), start, end, dtype)
            other_m, other_x, other_q = kept or of_right.dense(part, (0, 1, 2), dtype=dtype)
            for i, (a, b) in enumerate(((m, other_m), (x, other_m), (m, other_x), (x, other_x), (q, other_m), (m, other_q))):
                sums[i] = sums[i] + a @ b.T if part else a @ b.T
        n, sx, sy, sxy, sxx, syy = sums
        num, dx, dy = n * sxy, n * sxx, n * syy
        num -= sx * sy
        dx -= sx * sx
        dy -= sy * sy
        varied = (dx > 0) & (dy > 0)
        scale = np.multiply(dx, dy, dtype=np.float64)
        np.sqrt(scale, out=scale, where=varied)
        similarity = np.zeros(n.shape)
        np.divide(num, scale, out=similarity, where=varied)
        yield start, n, similarity, n >= max(1, min_support)


def dense_pearson(facts, entities, min_support):
    """All pairs with the support, one way round: `(a, b, common, similarity)`, smaller id first."""
    reachable(facts.sparkSession)
    cores, lines_held, step = facts.sparkSession.sparkContext.defaultParallelism, LINES, WIDTH
    blocks = max(math.ceil(entities / LEFT_BLOCK), math.ceil(math.sqrt(4 * cores)))
    packed = _lists(facts, "e", o="o", r="r").withColumn("k", _block(blocks))
    written = written_blocks(packed.select("k", "e", "o", "r"), blocks, "pair-blocks")
    kind = facts.schema["e"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("common", T.LongType()), T.StructField("similarity", T.DoubleType())])

    def compare(cells):
        for k_1, left, k_2, right in cells:
            first, second = left["e"].combine_chunks(), right["e"].combine_chunks()
            for start, n, similarity, keep in _similarities(left, right, min_support, lines_held, step):
                if k_1 == k_2:  # the same entities on both sides, in the same order
                    keep &= np.arange(start, start + len(n))[:, None] < np.arange(right.num_rows)[None, :]
                i, j = np.nonzero(keep)
                found = [first.take(pa.array(i + start)), second.take(pa.array(j)), pa.array(n[i, j].astype(np.int64)), pa.array(similarity[i, j])]
                yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in found], ["a", "b", "common", "similarity"])

    found = compared(written, written, F.col("k_1") <= F.col("k_2"), compare, schema)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "common", "similarity")


def _best(weights, held, start, asked_rows, asked_columns, k):
    """Of each asked line and column, the `k` rows of largest weight that hold the column; ties to the first row."""
    found = []
    for line in np.unique(asked_rows):
        columns = asked_columns[asked_rows == line]
        own = weights[line - start]
        some = np.flatnonzero(own > 0)
        if not len(some):
            continue
        order, length = some[np.argsort(-own[some], kind="stable")], 64 * k
        while len(columns):
            have = held[np.ix_(order[:length], columns)] > 0
            rank = np.cumsum(have, axis=0)
            done = (rank[-1] >= k) | (length >= len(order))
            at, column = np.nonzero(have & (rank <= k) & done[None, :])
            found.append((np.full(len(at), line), columns[column], order[at]))
            columns, length = columns[~done], length * 8
    return [np.concatenate(c) for c in zip(*found)] if found else None


class _Asked:
    """Requests of a block of targets, whose neighbours come block by block."""

    def __init__(self, left):
        self.rows_asked, asked = _flat(left, "q")
        asked = asked.dictionary_encode()
        self.targets, self.contexts = left["e"].combine_chunks(), asked.dictionary
        self.columns_asked = asked.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def _ids(self, places):
        return self.targets.take(pa.array(self.rows_asked[places])), self.contexts.take(pa.array(self.columns_asked[places]))


class _Sums(_Asked):
    """Weighted sums of each request; a request all of whose values are null has none."""

    def __init__(self, left):
        super().__init__(left)
        self.num, self.den, self.some = np.zeros(len(self.rows_asked)), np.zeros(len(self.rows_asked)), np.zeros(len(self.rows_asked), bool)

    def add(self, places, num, den, nulls):
        self.num[places] += num
        self.den[places] += den
        self.some[places] |= den > 0 if nulls is None else (den > 0) & ~nulls

    def rows(self):
        places = np.flatnonzero(self.den > 0)
        yield (*self._ids(places), pa.array(self.num[places], mask=~self.some[places]), self.den[places])


class _Best(_Asked):
    """The `k` neighbours of largest weight of each request; ties to the smaller id."""

    def __init__(self, left, k):
        super().__init__(left)
        self.k, self.least = k, np.zeros(len(self.rows_asked))
        self.order = np.lexsort((self.columns_asked, self.rows_asked))
        self.key = (self.rows_asked * max(1, len(self.contexts)) + self.columns_asked)[self.order]
        self.held = {}

    def add(self, piece, line, column, neighbours, row, weights, values, nulls):
        """Neighbours of the requests of a `piece`, lines and columns that come again with each block."""
        at = self.order[np.searchsorted(self.key, line * max(1, len(self.contexts)) + column)]
        keep = weights >= self.least[at]
        at, ids = at[keep], neighbours.take(pa.array(row[keep]))
        new = [at, weights[keep], values[keep], nulls[keep]]
        if piece in self.held:
            *old, old_ids = self.held[piece]
            new, ids = [np.concatenate(both) for both in zip(old, new)], pa.concat_arrays([old_ids, ids])
        at, weight = new[:2]
        rank = ids.to_numpy(zero_copy_only=False) if pa.types.is_integer(ids.type) else pc.rank(ids, sort_keys="ascending", tiebreaker="dense").to_numpy()
        order = np.lexsort((rank, -weight, at))
        place = np.arange(len(order)) - np.searchsorted(at[order], at[order])
        order = order[place < self.k]
        self.held[piece] = [*[column[order] for column in new], ids.take(pa.array(order))]
        last = order[place[place < self.k] == self.k - 1]
        self.least[at[last]] = weight[last]

    def rows(self):
        for at, weights, values, nulls, ids in self.held.values():
            yield (*self._ids(at), ids, weights, pa.array(values, mask=nulls))


def dense_neighbours(facts, known, values, target, counts, min_support, value, top_k=None):
    """Per request what its neighbours come to, without a row for each of them.

    With `top_k`, rows `(t, o, neighbour, similarity, value)` among which the `top_k` of a
    request are; else `(t, o, num, den)`, parts of the sums of similarity times value and of
    similarity. `t` is the requested id on the `target` side, `o` the other one, `facts`
    has eligible `(e, o, r)`, `counts` their targets and entities.
    """
    context = "user_id" if target == "item_id" else "item_id"
    reachable(facts.sparkSession)
    cores, lines_held, step = facts.sparkSession.sparkContext.defaultParallelism, LINES, WIDTH
    rights = max(1, math.ceil(counts["all"] / RIGHT_BLOCK))
    lefts = max(math.ceil(counts["targets"] / LEFT_BLOCK), 3 * cores)  # each meets all blocks of the other side in as few tasks as these fit into
    packed = _lists(facts, "e", o="o", r="r")
    asked = known.select(F.col(target).alias("e"), F.col(context).alias("q")).dropna().groupBy("e").agg(F.collect_list("q").alias("q"))
    rated = values.select(F.col(target).alias("e"), F.col(context).alias("vo"), F.col(value).cast("double").alias("v")).dropna(subset=["e", "vo"])
    # Lists of structs keep a null value, lists of a plain column would lose it.
    rated = _lists(rated, "e", vo="vo", v="v")
    left = packed.join(asked, "e").withColumn("k", _block(lefts)).select("k", "e", "o", "r", "q")
    right = packed.join(rated, "e").withColumn("k", _block(rights)).select("k", "e", "o", "r", "vo", "v")
    left, right = written_blocks(left, lefts, "target-blocks"), written_blocks(right, rights, "neighbour-blocks")
    held = first_row(right.agg(F.sum(F.octet_length("b"))))[0] or 0
    kind, other_kind = facts.schema["e"].dataType, facts.schema["o"].dataType
    names = [("neighbour", kind), ("similarity", T.DoubleType()), ("value", T.DoubleType())] if top_k else [("num", T.DoubleType()), ("den", T.DoubleType())]
    schema = T.StructType([T.StructField(n, k) for n, k in [("t", kind), ("o", other_kind), *names]])

    def score(cells):
        block, sums = None, None
        for k_1, left, _, right in cells:
            if k_1 != block:
                if block is not None:
                    yield from sums.rows()
                block, sums = k_1, (_Best(left, top_k) if top_k else _Sums(left))
            asked_rows, contexts, asked_columns = sums.rows_asked, sums.contexts, sums.columns_asked
            held_rows, held = _flat(right, "vo")
            held = pc.index_in(held, value_set=contexts)
            wanted = pc.is_valid(held).to_numpy(zero_copy_only=False)
            numbers = _flat(right, "v")[1]
            is_null = pc.is_null(numbers).to_numpy(zero_copy_only=False)[wanted]
            numbers = pc.fill_null(numbers, 0.0).to_numpy(zero_copy_only=False)[wanted]
            entries = held_rows[wanted], pc.fill_null(held, 0).to_numpy(zero_copy_only=False).astype(np.int64)[wanted]
            of_right = _Entries(*entries, numbers, right.num_rows, len(contexts), step)
            valid = _Entries(*entries, (~is_null).astype(np.float64), right.num_rows, len(contexts), step) if is_null.any() else None
            parts = range(len(of_right.parts))
            kept = of_right.dense(0, (0, 1)) if len(parts) == 1 else None
            itself = pc.index_in(left["e"].combine_chunks(), value_set=right["e"].combine_chunks())
            itself = pc.fill_null(itself, -1).to_numpy(zero_copy_only=False)
            neighbours = right["e"].combine_chunks()
            for start, n, similarity, keep in _similarities(left, right, min_support, lines_held, step):
                lines = np.arange(len(n))
                own = itself[start : start + len(n)]
                keep[lines[own >= 0], own[own >= 0]] = False
                weights = np.where(keep & (similarity > 0), similarity, 0.0)
                low, high = np.searchsorted(asked_rows, [start, start + len(n)])
                rows, columns = asked_rows[low:high], asked_columns[low:high]
                for part in parts:
                    first = part * step
                    inside = (columns >= first) & (columns < first + step)
                    if not inside.any():
                        continue
                    at, column = rows[inside], columns[inside] - first
                    count, total = kept or of_right.dense(part, (0, 1))
                    if top_k:
                        best = _best(weights, count, start, at, column, top_k)
                        if best is not None:
                            line, column, row = best
                            null = valid.dense(part, (1,))[0][row, column] == 0 if valid is not None else np.zeros(len(row), bool)
                            sums.add((start, part), line, column + first, neighbours, row, weights[line - start, row], total[row, column], null)
                        continue
                    places = low + np.flatnonzero(inside)
                    nulls = (weights @ valid.dense(part, (1,))[0])[at - start, column] == 0 if valid is not None else None
                    sums.add(places, (weights @ total)[at - start, column], (weights @ count)[at - start, column], nulls)
        if block is not None:
            yield from sums.rows()

    def batches(cells):
        for columns in score(cells):
            arrays = [c if isinstance(c, pa.Array) else c.combine_chunks() if isinstance(c, pa.ChunkedArray) else pa.array(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, ["t", "o", *[n for n, _ in names]])

    return compared(left, right, F.lit(True), batches, schema, right_tasks=math.ceil(held / HELD_BYTES) or 1)
