"""Cross-tokenizer alignment: which tokens of two vocabularies stand for the same bytes, and how usual that is.

Both tokenizers spell the same bytes, so their tokens are two tilings of a text. Where both
end a token a group ends; tokens that overlap are linked. How many documents link a pair
of ids is counted outside of memory: tasks cut their documents into blocks and write for
each block and radix of the first id a zstd run of its pairs, each with the documents that
hold it. The pairs of the runs, already summed by block, are merged k at a time in the
order of the first id, which gives the counts and each id's largest one; then every run is
read once more and adds to its documents what their pairs count.
"""

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import functions as F

from kindred.llm.bytebpe import PartEncoder, in_slices, token_bytes
from kindred.llm.runs import merge_runs, read_numbers, read_run, write_numbers, write_run
from kindred.llm.words import worker_state
from kindred.storage import materialize

# Linked occurrences in one block of documents.
BLOCK_LINKS = 2_000_000
# The lowest bits of the first id tell the radix partition.
RADIX_BITS = 6
# Runs that are merged at once.
FAN_IN = 64
# Bytes of runs that one task reads to add up contributions.
PART_BYTES = 32 << 20
# Longer texts are encoded in stretches of about so many characters.
STRETCH = 50_000

_CUT = re.compile(r"(?<=\S)(?= \S)")
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK_ROWS = pa.schema(
    [("block", pa.int64()), ("slot", pa.int32()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS)]
    + [("groups", pa.string()), ("groups_sha256", pa.string())]
    + [("radix", pa.int32()), ("pairs", pa.binary()), ("members", pa.binary())]
)
_BLOCK_DDL = (
    "block bigint, slot int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups string, groups_sha256 string, radix int, pairs binary, members binary"
)


class Spelling:
    """The bytes of each id, end to end."""

    def __init__(self, table):
        self.sizes = np.array([len(t) for t in table], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(table), dtype=np.uint8)

    def __call__(self, ids):
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.data[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


def piece_bytes(model):
    """The bytes of each piece of a sentencepiece model: U+2581 is a blank, <0xHH> a byte."""
    pieces = ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]


def stretches(text, size=STRETCH):
    """Cut a text before single blanks that follow a visible character, about every `size` characters.

    Where no piece goes on behind such a place the ids are those of the whole text.
    """
    at, parts = 0, []
    while len(text) - at > size and (found := _CUT.search(text, at + size)):
        parts.append(text[at : found.start()])
        at = found.start()
    parts.append(text[at:])
    return parts


class Pairs:
    """Ids of both vocabularies as one number: radix, rest of the first id, second id."""

    def __init__(self, size_a, size_b):
        self.size_a, self.size_b = size_a, size_b
        self.bits_a = max((size_a - 1).bit_length(), RADIX_BITS)
        self.bits_b = max((size_b - 1).bit_length(), 1)
        self.slot_bits = 64 - self.bits_a - self.bits_b
        self.rest = self.bits_a - RADIX_BITS

    def number(self, a, b):
        a = a.astype(np.uint64)
        radix = (a & np.uint64((1 << RADIX_BITS) - 1)) << np.uint64(self.rest)
        return (radix | a >> np.uint64(RADIX_BITS)) << np.uint64(self.bits_b) | b.astype(np.uint64)

    def first(self, pairs):
        """The part of the number that is the first id; ids come in its order."""
        return pairs >> np.uint64(self.bits_b)

    def ids(self, pairs):
        a = self.first(pairs)
        rest = a & np.uint64((1 << self.rest) - 1)
        return rest << np.uint64(RADIX_BITS) | a >> np.uint64(self.rest), pairs & np.uint64((1 << self.bits_b) - 1)

    def edges(self, pairs):
        """Where the radix partitions begin in sorted pairs."""
        bounds = np.arange(1, 1 << RADIX_BITS, dtype=np.uint64) << np.uint64(self.rest + self.bits_b)
        return np.concatenate([[0], np.searchsorted(pairs, bounds), [len(pairs)]]).astype(np.int64)


class Aligner:
    """Aligns slices of texts; made once in a worker."""

    def __init__(self, tokenizer_json, model_proto):
        self.a = PartEncoder(tokenizer_json)
        self.a.tokenizer.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_proto)
        table_a, table_b = token_bytes(tokenizer_json), piece_bytes(self.b)
        self.bytes_a, self.bytes_b = Spelling(table_a), Spelling(table_b)
        self.pairs = Pairs(len(table_a), len(table_b))
        # Texts are cut only where no piece of this model could reach across.
        self.stretch = STRETCH if not any(re.search(rb"\S ", t) for t in table_b) else 1 << 62
        most = max(len(table_a), len(table_b))
        self.written = [mark + str(i).encode() for mark in (b";", b",", b"|") for i in range(most)]
        self.most = most

    def encode(self, texts):
        """Ids of both sides and for each side the text that each of them is in."""
        ids_a = list(self.a([" " + t if t else None for t in texts]))
        flat_a = np.frombuffer(b"".join(ids_a), dtype="<u4").astype(np.int64)
        cut = [stretches(" " + t, self.stretch) if t else [] for t in texts]
        ids_b = self.b.encode([p[1:] for p in chain.from_iterable(cut)], num_threads=1) if any(cut) else []
        counts = [len(i) for i in ids_b]
        flat_b = np.fromiter(chain.from_iterable(ids_b), dtype=np.int64, count=sum(counts))
        rows = np.arange(len(texts))
        owner_b = np.repeat(np.repeat(rows, [len(p) for p in cut]), counts)
        return [(flat_a, np.repeat(rows, [len(i) // 4 for i in ids_a])), (flat_b, owner_b)]

    def same_bytes(self, texts, sides):
        """Which texts both sides spell, a blank before them; empty ones count as not."""
        wanted = [b" " + t.encode() if t else b"" for t in texts]
        lengths = np.array([len(w) for w in wanted], dtype=np.int64)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        data = np.frombuffer(b"".join(wanted), dtype=np.uint8)
        same = lengths > 0
        for (ids, owner), spelling in zip(sides, (self.bytes_a, self.bytes_b)):
            sizes = np.zeros(len(texts), dtype=np.int64)
            np.add.at(sizes, owner, spelling.sizes[ids])
            same &= sizes == lengths
            spelled = spelling(ids)
            if np.array_equal(sizes, lengths) and np.array_equal(spelled, data):
                continue
            own = np.concatenate([[0], np.cumsum(sizes)])
            for i in np.flatnonzero(same).tolist():
                same[i] = np.array_equal(spelled[own[i] : own[i + 1]], data[bounds[i] : bounds[i + 1]])
        return same

    def __call__(self, texts):
        """`(counts, groups, pairs, owner)`: numbers and written groups of each text, linked pairs and their texts."""
        sides = self.encode(texts)
        same = self.same_bytes(texts, sides)
        (a, text_a), (b, text_b) = [(ids[same[owner]], owner[same[owner]]) for ids, owner in sides]
        n = len(texts)
        if not len(a):
            empty = np.zeros(0, dtype=np.uint64)
            return np.zeros((4, n), dtype=np.int64), [""] * n, empty, empty.astype(np.int64)
        ends_a, ends_b = np.cumsum(self.bytes_a.sizes[a]), np.cumsum(self.bytes_b.sizes[b])
        last_a = ends_b[np.searchsorted(ends_b, ends_a)] == ends_a
        last_b = ends_a[np.searchsorted(ends_a, ends_b)] == ends_b
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        # Every stretch between neighbouring ends lies in one token of either side.
        ends = np.sort(np.concatenate([ends_a, ends_b[~last_b]]), kind="stable")
        in_a, in_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        owner = text_a[in_a]
        counts = np.array([np.bincount(x, minlength=n) for x in (text_a, text_b, text_a[last_a], owner)], dtype=np.int64)
        # The written order: of each group the first side, then the second.
        before_a = np.concatenate([[0], np.cumsum(np.bincount(group_a))])
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b))])
        inner_a = np.concatenate([[False], ~last_a[:-1]])
        inner_b = np.concatenate([[False], ~last_b[:-1]])
        written = np.empty(len(a) + len(b), dtype=np.int64)
        written[np.arange(len(a)) + before_b[group_a]] = a + np.where(inner_a, self.most, 0)
        written[np.arange(len(b)) + before_a[group_b + 1]] = b + np.where(inner_b, self.most, 2 * self.most)
        bounds = np.concatenate([[0], np.cumsum(counts[0] + counts[1])]).tolist()
        words = self.written.__getitem__
        groups = [b"".join(map(words, written[x:y].tolist()))[1:].decode() for x, y in zip(bounds, bounds[1:])]
        return counts, groups, self.pairs.number(a[in_a], b[in_b]), owner


def aligner(tokenizer_json, model_proto):
    """The aligner of this worker process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
    return worker_state((tokenizer_json, model_proto), lambda: Aligner(tokenizer_json, model_proto))


def _runs_of(pairs, links, slots):
    """Rows `(radix, pairs, members)` of one block: distinct pairs with their numbers of documents, and these documents."""
    shift = np.uint64(pairs.slot_bits)
    keys, times = np.unique(links << shift | slots.astype(np.uint64), return_counts=True)
    numbers = keys >> shift
    members = keys & np.uint64((1 << pairs.slot_bits) - 1)
    edges = pairs.edges(numbers)
    for radix in np.flatnonzero(np.diff(edges)).tolist():
        part = slice(edges[radix], edges[radix + 1])
        distinct, sizes = np.unique(numbers[part], return_counts=True)
        # Slots rise within a pair; steps back to the next pair's first one wrap around 32 bits.
        steps = np.diff(members[part].astype(np.uint32), prepend=np.uint32(0))
        body = write_numbers(np.concatenate([steps.astype(np.uint64), times[part].astype(np.uint64)]))
        yield radix, write_run(distinct, sizes), body


def _members(body):
    both = read_numbers(body)
    n = len(both) // 2
    return np.cumsum(both[:n].astype(np.uint32), dtype=np.uint32), both[n:].astype(np.int64)


def encoded_blocks(docs, shared, with_groups, block_links):
    """One pass over the texts: a row for each document, and the runs of each block."""

    def work(batches):
        align = aligner(*shared.value)
        task = TaskContext.get().partitionId() << 32
        block, slots, links, owners, held = task, 0, [], [], 0

        def flush():
            return [
                pa.RecordBatch.from_pylist([{"block": block, "radix": r, "pairs": p, "members": m}], _BLOCK_ROWS)
                for r, p, m in _runs_of(align.pairs, np.concatenate(links), np.concatenate(owners))
            ]

        for batch in batches:
            ids, row = batch.column("doc_id"), 0
            for texts in in_slices(batch.column("text").to_pylist()):
                counts, groups, found, owner = align(texts)
                n = len(texts)
                written = pa.array([g or None for g in groups] if with_groups else [None] * n, pa.string())
                columns = [pa.array(np.full(n, block)), pa.array(np.arange(slots, slots + n), pa.int32()), ids.slice(row, n)]
                columns += [pa.array(c) for c in counts] + [written, pa.array([_digest(g) for g in groups])]
                columns += [pa.nulls(n, f.type) for f in list(_BLOCK_ROWS)[-3:]]
                yield pa.RecordBatch.from_arrays(columns, schema=_BLOCK_ROWS)
                links.append(found)
                owners.append(owner + slots)
                row, slots, held = row + n, slots + n, held + len(found)
                if held >= block_links:
                    yield from flush()
                    block, slots, links, owners, held = block + 1, 0, [], [], 0
        if held:
            yield from flush()

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(work, _BLOCK_DDL)


def _digest(groups):
    from hashlib import sha256

    return sha256(groups.encode()).hexdigest() if groups else ""


def merged_counts(runs, blocks, fan_in=FAN_IN):
    """`(radix, pairs)`: one run for each radix partition, merged from those of `blocks` blocks, some `fan_in` at a time."""

    def merge(key, table):
        worker_state()
        run = merge_runs(table["pairs"].to_pylist())
        return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()), "pairs": pa.array([run], pa.binary())})

    parts = max(1, -(-blocks // fan_in))
    rows = runs.select("radix", F.pmod(F.xxhash64("block"), F.lit(parts)).alias("part"), "pairs")
    while True:
        rows = rows.groupBy("radix", "part").applyInArrow(merge, "radix int, part bigint, pairs binary")
        if parts == 1:
            return rows.select("radix", "pairs")
        parts = -(-parts // fan_in)
        rows = rows.withColumn("part", F.pmod("part", F.lit(parts)))


def _with_maxima(pairs, run):
    """Sorted pairs of a run, their counts, and which are the highest of their first id."""
    frames = list(read_run(run))
    numbers, counts = (np.concatenate(column) for column in zip(*frames))
    counts, side = counts.astype(np.int64), pairs.first(numbers)
    begin = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
    highest = np.repeat(np.maximum.reduceat(counts, begin), np.diff(np.append(begin, len(side))))
    return numbers, counts, counts == highest


def contributions(runs, counts, pairs, part_bytes=PART_BYTES):
    """`(block, data)` of each run: what its pairs add to the documents of the block."""
    sizes = runs.groupBy("radix").agg(F.sum(F.length("pairs") + F.length("members")).alias("n")).collect()  # 64 rows
    parts = [1] * (1 << RADIX_BITS)
    for row in sizes:
        parts[row["radix"]] = max(1, -(-row["n"] // part_bytes))
    most = F.element_at(F.array(*[F.lit(p) for p in parts]), F.col("radix") + 1)
    dealt = runs.select("radix", F.pmod(F.xxhash64("block"), most).cast("int").alias("part"), "block", "pairs", "members")
    copies = counts.select("radix", F.explode(F.sequence(F.lit(0), most - 1)).alias("part"), F.col("pairs").alias("counts"))

    def add(key, some, totals):
        worker_state()
        blocks, data = [], []
        if some.num_rows:
            numbers, count, best = _with_maxima(pairs, totals["counts"][0].as_py())
        for block, run, body in zip(*(some[c] for c in ("block", "pairs", "members"))):
            own, documents = (np.concatenate(column) for column in zip(*read_run(run.as_py())))
            at = np.repeat(np.searchsorted(numbers, own), documents.astype(np.int64))
            slots, times = _members(body.as_py())
            order = np.argsort(slots, kind="stable")
            slots, times, at = slots[order], times[order], at[order]
            begin = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
            sums = [np.add.reduceat(x, begin) for x in (times * count[at], times * best[at])]
            steps = np.diff(slots[begin].astype(np.uint64), prepend=np.uint64(0))
            blocks.append(block.as_py())
            data.append(write_numbers(np.concatenate([steps, *(s.astype(np.uint64) for s in sums)])))
        return pa.table({"block": pa.array(blocks, pa.int64()), "data": pa.array(data, pa.binary())})

    groups = dealt.groupBy("radix", "part").cogroup(copies.groupBy("radix", "part"))
    return groups.applyInArrow(add, "block bigint, data binary")


def _summed_up(documents, added):
    """Rows of `documents` with `count_sum` and `n_best` out of all contributions to their block."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in documents.schema)
    names = documents.columns

    def finish(key, rows, parts):
        worker_state()
        n = rows.num_rows
        slots = rows["slot"].to_numpy()
        totals = np.zeros((2, int(slots.max()) + 1 if n else 0), dtype=np.int64)
        for data in parts["data"]:
            steps, sums, best = read_numbers(data.as_py()).reshape(3, -1)
            at = np.cumsum(steps).astype(np.int64)
            totals[0, at] += sums.astype(np.int64)
            totals[1, at] += best.astype(np.int64)
        columns = [rows[c] for c in names] + [pa.array(t[slots], pa.int64()) for t in totals]
        return pa.table(columns, names=[*names, "count_sum", "n_best"])

    both = documents.groupBy("block").cogroup(added.groupBy("block"))
    return both.applyInArrow(finish, kinds + ", count_sum bigint, n_best bigint")


def align(
    docs, tokenizer_json, model_proto, with_groups=False, block_links=BLOCK_LINKS, fan_in=FAN_IN, part_bytes=PART_BYTES
):
    """Align two tokenizers on every text: a frame of documents and one of counted pairs.

    `tokenizer_json` is a byte-level tokenizer (A), `model_proto` the bytes of a
    sentencepiece model that adds a blank (B); both encode a blank and the text, without
    special tokens, whose strings are plain text.

    Documents: `doc_id, n_a, n_b` tokens, `n_groups` stretches between common ends,
    `n_links` overlapping pairs of tokens, `count_sum` of the links' counts, `n_best` links
    whose count is the highest of their A id, `groups_sha256`, and `groups` written out if
    asked for. Pairs: `a, b, n_docs, best`; `n_docs` is the number of documents, that is
    rows, that link the two ids.

    A row without tokens has zeros and an empty digest: a null or empty text, or one that
    the tokens of either side do not spell byte by byte. Repeated rows count each; null ids
    stay; other columns are not read; empty tables give no rows. Runs Spark jobs.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((tokenizer_json, model_proto))
    model = sentencepiece.SentencePieceProcessor(model_proto=model_proto)
    pairs = Pairs(len(token_bytes(tokenizer_json)), model.get_piece_size())
    written = materialize(encoded_blocks(docs, shared, with_groups, block_links), "aligned-blocks")
    shared.unpersist()  # what follows reads the written rows
    documents = written.where("radix is null").drop("radix", "pairs", "members")
    runs = written.where("radix is not null").select("block", "radix", "pairs", "members")
    blocks = runs.agg(F.count_distinct("block")).first()[0]
    counts = materialize(merged_counts(runs, blocks, fan_in), "pair-counts")
    found = _summed_up(documents, contributions(runs, counts, pairs, part_bytes))

    def rows(batches):
        for batch in batches:
            for run in batch.column("pairs").to_pylist():
                numbers, n_docs, best = _with_maxima(pairs, run)
                a, b = pairs.ids(numbers)
                columns = [pa.array(c.astype(np.int64)) for c in (a, b, n_docs)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(best)], ["a", "b", "n_docs", "best"])

    order = ["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256", *(["groups"] if with_groups else [])]
    return found.select(*order), counts.select("pairs").mapInArrow(rows, "a bigint, b bigint, n_docs bigint, best boolean")
