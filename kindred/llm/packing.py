"""Packing of tokenised documents into sequences: cutting stock by column generation.

Documents that fit into a sequence have a length class. A pattern says how many documents
of each class fill one sequence. A linear program over the histogram of classes chooses
how often each pattern is used; a knapsack dynamic program prices new patterns with the
duals until none improves. The rounded patterns are dealt out to the documents by their
rank within their class. Longer documents are cut into whole sequences and a remainder,
which goes through the program as well; whole sequences fill what the program leaves.

Only the histogram, as long as a sequence has classes, reaches the driver.
"""

import warnings
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from kindred.llm.bytebpe import in_slices, part_encoder
from kindred.storage import materialize

SEQUENCE = 2048
END_ID = 1
# Lengths are rounded up to multiples of this for the program.
CLASS_STEP = 8
# Sequences whose room is summed up in one group.
ROOM_BLOCK = 4096
PACKED = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
# Relative distance from the bound at which the program ends, and pivots for each class after
# which it is taken as it is, with a warning; some twenty are needed.
GAP = 1e-5
MOST_PIVOTS = 200
# What a pattern must be worth beyond a sequence to improve the program.
TOLERANCE = 1e-7
# Pivots after which the inverse is worked out anew.
REFRESH = 1000
# Share of the waste-free duals in those that price.
CALM = 0.9

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "class int, part int, place bigint, ids binary"
)
_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
_ARROW = pa.schema([(name, _TYPES[kind]) for name, kind in (f.split() for f in PIECES.split(", "))])


def price(sizes, values, capacity):
    """Most valuable filling of `capacity`, any number of each size, by the knapsack program: `(value, counts)`."""
    best = np.zeros(capacity + 1)
    chosen = np.zeros(capacity + 1, dtype=np.int64)  # size of the last piece; 0 for room that stays empty
    worth_of = np.full(capacity + 1, -np.inf)
    worth_of[sizes] = values
    for room in range(1, capacity + 1):
        worth = worth_of[1 : room + 1] + best[room - 1 :: -1] if room > 1 else worth_of[1:2]
        top = worth.argmax()
        best[room] = best[room - 1]
        if worth[top] > best[room] + 1e-12:
            best[room], chosen[room] = worth[top], top + 1
    taken, room = np.zeros(capacity + 1, dtype=np.int64), capacity
    while room > 0:
        taken[chosen[room]] += 1
        room -= max(chosen[room], 1)
    counts = taken[sizes]
    return best[capacity], counts


def fractional_patterns(sizes, demand, capacity, gap=GAP, most_pivots=MOST_PIVOTS):
    """Patterns, how often each is used, fractions allowed, so that demand is met exactly, and a bound below the optimum.

    Revised simplex with an explicit inverse; the first basis has one pattern a class.
    Early duals are wild, so new patterns are priced close to the duals of a program
    without waste, where a piece is worth its length; the true duals have the last word.
    It ends within `gap` of the bound: the volume, or what the duals prove, since divided
    by the worth of the best pattern they are feasible. A warning tells the gap if
    `most_pivots` for each class come first.
    """
    even = sizes / capacity
    own = capacity // sizes
    patterns = np.diag(own)
    inverse = np.diag(1.0 / own)
    used, duals = demand / own, 1.0 / own
    bound = float(demand @ even)
    for pivot in range(1, most_pivots * len(sizes) + 1):
        if used.sum() <= bound * (1 + gap):
            break
        _, column = price(sizes, CALM * even + (1 - CALM) * duals, capacity)
        if duals @ column <= 1 + TOLERANCE:
            worth, column = price(sizes, duals, capacity)
            bound = max(bound, used.sum() / max(worth, 1.0))
            if worth <= 1 + TOLERANCE:
                break
        step = np.einsum("ij,j->i", inverse, column)  # on one core: the product is too small for threads
        ratios = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratios.argmin())
        amount = ratios[out]
        if not np.isfinite(amount):
            break
        used = np.maximum(used - amount * step, 0)
        used[out] = amount
        row = inverse[out] / step[out]
        duals = duals - (duals @ column - 1) * row
        inverse -= np.outer(step, row)
        inverse[out] = row
        patterns[:, out] = column
        if pivot % REFRESH == 0:  # rounding errors add up
            inverse = np.linalg.inv(patterns)
            used, duals = np.maximum(inverse @ demand, 0), inverse.sum(axis=0)
    if used.sum() > bound * (1 + 10 * gap):
        warnings.warn(f"packing stopped at {used.sum():.2f} sequences; the optimum is at least {bound:.2f}", stacklevel=2)
    return patterns.T, used, bound


def first_fit(sizes, counts, capacity):
    """Patterns for few pieces: the largest first, each into the first sequence with room."""
    rooms, filled = np.zeros(0, dtype=np.int64), []
    for i in range(len(sizes) - 1, -1, -1):
        for _ in range(int(counts[i])):
            fits = np.flatnonzero(rooms >= sizes[i])
            if not len(fits):
                rooms = np.append(rooms, capacity)
                filled.append(np.zeros(len(sizes), dtype=np.int64))
            at = fits[0] if len(fits) else len(rooms) - 1
            rooms[at] -= sizes[i]
            filled[at][i] += 1
    return filled


def whole_patterns(sizes, demand, capacity):
    """`[(counts, times)]` with whole numbers that use up `demand` exactly.

    Fractions are rounded down, then up where pieces are left for it; what remains, a few
    pieces for each pattern of the basis, is placed by first fit.
    """
    patterns, used, _ = fractional_patterns(sizes, demand.astype(float), capacity)
    times = np.floor(used + 1e-9).astype(np.int64)
    left = demand - times @ patterns
    for j in np.argsort(-(used - times), kind="stable"):
        while times[j] and (left < 0).any():  # a rounding error of the program
            times[j] -= 1
            left = left + patterns[j]
        if used[j] - times[j] > 1e-9 and (patterns[j] <= left).all():
            times[j] += 1
            left = left - patterns[j]
    result = [(patterns[j], int(times[j])) for j in range(len(times)) if times[j]]
    return result + [(counts, 1) for counts in first_fit(sizes, left, capacity)]


def allotments(histogram, capacity):
    """Rows `(class, first_rank, until, sequence, each, slot)` from `{class: pieces}`, and the number of sequences.

    Pieces of the class with ranks from `first_rank` on go to sequences from `sequence`
    on, `each` to a sequence, at places from `slot` on.
    """
    sizes = np.array(sorted(histogram), dtype=np.int64)
    if not len(sizes):
        return [], 0
    demand = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
    taken, sequence, rows = np.zeros(len(sizes), dtype=np.int64), 0, []
    for counts, times in whole_patterns(sizes, demand, capacity):
        slot = 0
        for i in np.flatnonzero(counts)[::-1]:
            each = int(counts[i])
            rows.append((int(sizes[i]), int(taken[i]), int(taken[i]) + each * times, sequence, each, slot))
            taken[i] += each * times
            slot += each
        sequence += times
    assert (taken == demand).all()
    return rows, sequence


def pieces(docs, tokenizer_json, length=SEQUENCE, end_id=END_ID, class_step=CLASS_STEP):
    """Tokenised documents, written.

    A document that fits into a sequence is one row with its class; `place` is its number
    in its task and class. A longer one is a row of class 0 with ids for every whole
    `length` tokens, where `place` is the number of tokens of such rows before it in its
    task, and what is left of it a row with its class.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    end = np.array([end_id], dtype="<u4").tobytes()

    def work(batches):
        encoder, part = part_encoder(shared.value), TaskContext.get().partitionId()
        met = [0] * (length // class_step + 1)
        for batch in batches:
            ids_of, at = batch.column("doc_id").to_pylist(), 0
            for texts in in_slices(batch.column("text").to_pylist()):
                rows = []
                for ids in encoder(texts):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, length):
                        piece = ids[start * 4 : (start + length) * 4]
                        size = len(piece) // 4
                        # Only whole sequences out of long documents are poured; the rest of one is a piece.
                        kind = -(-size // class_step) if total <= length or size < length else 0
                        crc = zlib.crc32(piece) if kind else None
                        rows.append((ids_of[at], start, size, crc, total, kind, part, met[kind], None if kind else piece))
                        met[kind] += 1 if kind else size
                    at += 1
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    return materialize(rows.mapInArrow(work, PIECES), "pieces")


def _before(column, *order):
    """Sum of `column` over all rows before, in tables of one row for each task or block."""
    window = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def _place_whole(table, length, class_step):
    """Documents and remainders in one piece: their rows with `sequence_id` and `offset`, and the number of sequences."""
    table = table.where("class > 0").drop("ids")
    counts = table.groupBy("part", "class").agg(F.count(F.lit(1)).alias("_n"))
    earlier_parts = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("_base", F.coalesce(F.sum("_n").over(earlier_parts), F.lit(0))).drop("_n")
    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("_n").alias("n")).collect()}
    rows, sequences = allotments(histogram, length // class_step)
    plan = table.sparkSession.createDataFrame(
        rows, "class int, _from bigint, _until bigint, _sequence bigint, _each bigint, _slot bigint"
    )
    ranked = table.join(bases, ["part", "class"]).withColumn("_rank", F.col("_base") + F.col("place"))
    # The plan has a row for each class of each pattern in the basis: bounded by the classes of one sequence.
    placed = ranked.join(F.broadcast(plan), "class").where("_rank >= _from and _rank < _until")
    ahead = F.col("_rank") - F.col("_from")
    placed = placed.withColumn("sequence_id", F.col("_sequence") + F.floor(ahead / F.col("_each")).cast("long"))
    order = Window.partitionBy("sequence_id").orderBy("_slot", ahead % F.col("_each"))
    earlier = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(earlier, F.lit(0)).cast("long")), sequences


def _room(placed, length):
    """Room left in each sequence, laid end to end: `(sequence_id, _fill, _from, _until)`."""
    filled = placed.groupBy("sequence_id").agg(F.sum("length").alias("_fill"))
    rooms = filled.withColumn("_gap", length - F.col("_fill")).where("_gap > 0")
    rooms = rooms.withColumn("_block", F.floor(F.col("sequence_id") / ROOM_BLOCK))
    blocks = rooms.groupBy("_block").agg(F.sum("_gap").alias("_gaps"))
    blocks = blocks.select("_block", _before("_gaps", "_block").alias("_base"))
    within = Window.partitionBy("_block").orderBy("sequence_id")
    rooms = rooms.join(blocks, "_block").withColumn("_until", F.col("_base") + F.sum("_gap").over(within))
    rooms = rooms.select("sequence_id", "_fill", (F.col("_until") - F.col("_gap")).alias("_from"), "_until")
    return materialize(rooms, "rooms")


def _pour(table, rooms, sequences, length):
    """Whole sequences out of long documents, laid end to end, cut where the rooms end; beyond the rooms, every `length` tokens."""
    long = table.where("class = 0")
    parts = long.groupBy("part").agg(F.sum("length").alias("_n")).select("part", _before("_n", "part").alias("_base"))
    narrow = long.select("part", "place", "length").join(parts, "part")
    narrow = narrow.withColumn("_at", F.col("_base") + F.col("place")).drop("_base")
    room = rooms.agg(F.coalesce(F.max("_until"), F.lit(0)).alias("n")).first()["n"]
    stretches = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / length), F.floor((F.col(b) - 1) / length)))
    left = narrow.where(F.col("_at") < room).withColumn("_end", F.col("_at") + F.col("length"))
    left = left.withColumn("_stretch", stretches("_at", "_end"))
    right = rooms.withColumn("_stretch", stretches("_from", "_until"))
    first, last = F.greatest("_at", "_from"), F.least("_end", "_until")
    # Where two stretches see the same overlap, the one that holds its first token keeps it.
    inside = left.join(right, "_stretch").where((first < last) & (F.floor(first / length) == F.col("_stretch")))
    inside = inside.select(
        "part", "place", (first - F.col("_at")).alias("_skip"), (last - first).alias("_size"),
        "sequence_id", (F.col("_fill") + first - F.col("_from")).alias("offset"),
    )
    beyond = narrow.where(F.col("_at") + F.col("length") > room)
    begin = F.greatest(F.col("_at") - room, F.lit(0))
    beyond = beyond.withColumn("_begin", begin).withColumn("_end", F.col("_at") + F.col("length") - room)
    beyond = beyond.withColumn("_number", stretches("_begin", "_end"))
    first = F.greatest(F.col("_begin"), F.col("_number") * length)
    last = F.least(F.col("_end"), (F.col("_number") + 1) * length)
    beyond = beyond.select(
        "part", "place", (first + room - F.col("_at")).alias("_skip"), (last - first).alias("_size"),
        (F.col("_number") + sequences).alias("sequence_id"), (first % length).alias("offset"),
    )
    cut = inside.unionByName(beyond).join(long.select("part", "place", "doc_id", "start", "doc_tokens", "ids"), ["part", "place"])
    ids = F.expr("substring(ids, cast(_skip * 4 + 1 as int), cast(_size * 4 as int))")
    return cut.select(
        "doc_id", (F.col("start") + F.col("_skip")).alias("start"), F.col("_size").alias("length"),
        F.crc32(ids).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )


def pack(docs, tokenizer_json, length=SEQUENCE, end_id=END_ID, class_step=CLASS_STEP):
    """Place every token of every document in a sequence of at most `length` tokens.

    Rows `(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`, one for each
    piece: tokens `start` to `start + length` of the document with `end_id` behind it stand
    in `sequence_id` from `offset` on; sequences are gapless and numbered from 0.
    `ids_crc32` is the crc32 of the piece's ids as little-endian unsigned 32-bit numbers.

    Documents that fit into a sequence stay whole and are placed by the program, as are the
    remainders of longer ones modulo `length`. The rest of the longer ones, whole sequences,
    is laid end to end: it fills the room that the program leaves, and then sequences of its
    own, of which only the last one is short. Where there is too little of it, the rest of
    the room stays empty: what rounding lengths up to `class_step` and patterns down costs.

    A null text counts as empty, so it is one piece with `end_id` alone. Repeated rows are
    packed each; a null id stays null; an empty table gives no rows; other columns are not
    read. Runs Spark jobs for the histogram and the room. `with_ids` adds the ids themselves.
    """
    if length % class_step:
        raise ValueError("length must be a multiple of class_step")
    table = pieces(docs, tokenizer_json, length, end_id, class_step)
    placed, sequences = _place_whole(table, length, class_step)
    placed = materialize(placed.select(*PACKED), "placed")
    poured = _pour(table, _room(placed, length), sequences, length)
    return placed.unionByName(poured.select(*PACKED))


def with_ids(packed, encoded, end_id=END_ID):
    """`packed` rows with `ids`, the piece's ids in bytes; `encoded`: `(doc_id, ids)` of unique documents.

    Rows without an id match none and are left out; an empty table gives no rows.
    """
    whole = encoded.select("doc_id", F.concat("ids", F.lit(np.array([end_id], dtype="<u4").tobytes())).alias("_ids"))
    piece = F.expr("substring(_ids, cast(start * 4 + 1 as int), cast(length * 4 as int))")
    return packed.join(whole, "doc_id").withColumn("ids", piece).drop("_ids")
