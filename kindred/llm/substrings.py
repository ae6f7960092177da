"""Substring dedup: suffix automata of reference shards.

A window of consecutive words whose sequence starts earlier as well is removed. Spark
first finds the passages that can repeat and where each of their windows comes first:
every window has an anchor, the gram of fewer words with the smallest hash in it, equal
windows have equal anchors, and only windows whose anchor occurs twice are counted by
their own hash. The first places of repeated windows are the reference. It is cut into
cells, a bounded range of the words of one document each, which are dealt out to shards
together with the passages that may repeat them; a cell that is repeated very often goes
to several shards, each with a part of these passages. A shard's suffix automaton reads
its cells and gives matching statistics, the longest reference that ends at each word.
What does not match for a whole window, word by word, stays.
"""

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kindred.llm.automaton import SuffixAutomaton
from kindred.llm.learn import mapped, narrowed
from kindred.llm.mapped import GATHERED, Gathering, Shards, edges_of, find, mapped_folder, packed, shard_bits, summed, unpacked, write_shard
from kindred.llm.words import Words, gram_hashes, mix, sliding_argmin, text_pieces, within_rows, worker_state
from kindred.storage import scratch_path

WINDOW = 20
ANCHOR = 8
# Characters of text for each shard of the tables and of the reference, about.
SHARD_CHARS = 8_000_000
# First words of windows in one cell of the reference.
SPAN = 4096
# Repeated windows of a cell for each shard it goes to.
HOT = 250_000
# Rows with one id whose windows may still be dealt out by their places.
SAME_ID = 64
# Most digests of passages a task keeps, so that it does not send one again.
SENT = 500_000
# Where documents without an id stand: behind all others, as if they were one.
NO_ID = np.iinfo(np.int64).max

_PLACE_ROWS = pa.schema([("shard", pa.int32()), *((c, pa.binary()) for c in ("keys", "docs", "starts", "counts"))])
_PASSAGES = pa.schema([("shard", pa.int32()), ("reference", pa.bool_()), ("words", pa.binary())])


class Windows:
    """Windows of the rows of one piece: their first words, hashes and anchors."""

    def __init__(self, data, bounds, window, anchor):
        self.words = Words(data, bounds)
        self.starts = within_rows(self.words.counts, window)
        self.window, self.anchor = window, anchor
        places = sliding_argmin(grams := gram_hashes(self.words.hashes, anchor), window - anchor + 1)[self.starts]
        self.anchors, self.of_anchor = np.unique(places, return_inverse=True)
        self.anchor_hashes = grams[self.anchors]

    def narrow(self, keep):
        """Keep the windows whose anchors are marked; gives their hashes."""
        self.starts = self.starts[keep[self.of_anchor]]
        return gram_hashes(self.words.hashes, self.window)[self.starts]

    def places(self, ids):
        """Document and first word in it, for each window."""
        row = np.searchsorted(self.words.first, self.starts, side="right") - 1
        return ids[row], self.starts - self.words.first[row]


def _batches(batches, window, anchor):
    """Windows of the stretches of Arrow batches, with the ids of their rows."""
    worker_state()
    for batch in batches:
        ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
        for row, data, bounds in text_pieces(batch.column("text")):
            yield ids[row : row + len(bounds) - 1], Windows(data, bounds, window, anchor)


def find_anchors(docs, folder, bits, window, anchor):
    """Store the hashes of anchors that occur twice."""

    def send(gathering):
        keys, counts = gathering.take()
        edges = edges_of(keys, bits)
        used = [int(i) for i in np.flatnonzero(np.diff(edges))]
        columns = [used, [keys[edges[i] : edges[i + 1]].tobytes() for i in used], [packed(np.minimum(counts[edges[i] : edges[i + 1]], 2)) for i in used]]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["shard", "keys", "counts"])

    def gather(batches):
        gathering = Gathering()
        for _, windows in _batches(batches, window, anchor):
            gathering.add(windows.anchor_hashes)
            if gathering.held > GATHERED:
                yield send(gathering)
        yield send(gathering)

    def store(key, rows):
        worker_state()
        keys = np.concatenate([np.frombuffer(k, dtype=np.uint64) for k in rows["keys"].to_pylist()])
        counts = np.concatenate([unpacked(c).astype(np.int64) for c in rows["counts"].to_pylist()])
        keys, counts = summed(keys, counts)
        write_shard(folder, f"anchors-{key[0].as_py()}", {"anchors": keys[counts > 1]})
        return pa.table({"n": [int((counts > 1).sum())]})

    rows = docs.mapInArrow(gather, "shard int, keys binary, counts binary")
    rows.groupBy("shard").applyInArrow(store, "n bigint").agg(F.sum("n")).collect()
    return Shards(folder, bits, ("anchors",))


def earliest(keys, docs, starts, counts):
    """Sorted distinct keys with their earliest place and how often they occur."""
    order = np.lexsort((starts, docs, keys))
    keys, docs, starts, counts = keys[order], docs[order], starts[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], docs[first], starts[first], np.add.reduceat(counts, first) if len(first) else counts


def crowded_ids(docs):
    """Sorted ids that stand on many rows, and the one for rows without: a cell would hold all their texts."""
    many = docs.where("doc_id is not null").groupBy("doc_id").count().where(F.col("count") > SAME_ID)
    return np.unique(np.array([r["doc_id"] for r in many.select("doc_id").collect()] + [NO_ID], dtype=np.int64))


def cells_of(hashes, docs, starts, crowded, span):
    """The cell of each window, by the place where it comes first; windows of crowded ids are cells of their own."""
    cells = mix(mix(docs.astype(np.uint64)) + (starts // span).astype(np.uint64))
    return np.where(find(crowded, docs) >= 0, mix(hashes), cells)


def find_places(docs, anchors, window, anchor, crowded):
    """Store the hashes of windows that occur twice, with the place where each comes first.

    Gives this table and the cells that are repeated often: `(cells, shares)`, sorted, with
    the number of shares each is to be dealt in.
    """
    folder, bits = anchors.folder, anchors.bits
    # What windows of few repeats add to a cell is left out of its count: a quarter of HOT at most.
    span, few = SPAN, max(HOT // SPAN // 4, 1)

    def send(held):
        keys, docs, starts, counts = earliest(*(np.concatenate(c) for c in zip(*held)))
        edges = edges_of(keys, bits)
        used = [int(i) for i in np.flatnonzero(np.diff(edges))]
        parts = [slice(edges[i], edges[i + 1]) for i in used]
        columns = [[keys[p].tobytes() for p in parts], *([packed(c[p]) for p in parts] for c in (docs, starts, counts))]
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], schema=_PLACE_ROWS)

    def gather(batches):
        held, n = [], 0
        for ids, windows in _batches(batches, window, anchor):
            hashes = windows.narrow(anchors.look_up(windows.anchor_hashes)[0])
            held.append(earliest(hashes, *windows.places(ids), np.ones(len(hashes), dtype=np.int64)))
            n += len(held[-1][0])
            if n > GATHERED:
                yield send(held)
                held, n = [], 0
        if held:
            yield send(held)

    def store(key, rows):
        worker_state()
        keys = np.concatenate([np.frombuffer(k, dtype=np.uint64) for k in rows["keys"].to_pylist()])
        columns = [np.concatenate([unpacked(c).astype(np.int64) for c in rows[name].to_pylist()]) for name in ("docs", "starts", "counts")]
        keys, docs, starts, counts = earliest(keys, *columns)
        repeated = {n: v[counts > 1] for n, v in (("windows", keys), ("docs", docs), ("starts", starts))}
        write_shard(folder, f"windows-{key[0].as_py()}", repeated)
        often = (counts > few) & (find(crowded, docs) < 0)
        cells, counts = summed(cells_of(keys[often], docs[often], starts[often], crowded, span), counts[often])
        return pa.table({"cell": cells.view(np.int64), "n": counts})

    rows = docs.mapInArrow(gather, "shard int, keys binary, docs binary, starts binary, counts binary")
    counted = rows.groupBy("shard").applyInArrow(store, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    often = counted.where(F.col("n") > HOT).collect()
    cells = np.array([r["cell"] for r in often], dtype=np.int64).view(np.uint64)
    shares = np.array([-(-r["n"] // HOT) for r in often], dtype=np.int64)
    order = np.argsort(cells)
    return Shards(folder, bits, ("windows", "docs", "starts")), (cells[order], shares[order])


def look_at(ids, windows, anchors, places):
    """Keep the repeated windows of a piece; gives their hashes, the documents and places they come first in, and whether that is here."""
    hashes = windows.narrow(anchors.look_up(windows.anchor_hashes)[0])
    found, (docs, starts) = places.look_up(hashes)
    windows.starts = windows.starts[found]
    docs, starts = docs[found], starts[found]
    own_docs, own_starts = windows.places(ids)
    return hashes[found], docs, starts, (docs == own_docs) & (starts == own_starts)


def passages(docs, anchors, places, window, anchor, crowded, hot):
    """`(shard, reference, words)`: stretches of windows that come first, and of later ones, by the cell of the first.

    A cell of `hot` goes to a shard for each of its shares, and every later stretch to one
    of them, by its words. A stretch that a task meets several times is sent once.
    """
    bits, span = anchors.bits, SPAN

    def shard_of(cell, share=0):
        value = mix(np.array([cell + share * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64))[0]
        return int(value) >> 64 - bits if bits else 0

    def work(batches):
        sent = set()
        for ids, windows in _batches(batches, window, anchor):
            hashes, firsts, at, here = look_at(ids, windows, anchors, places)
            cells = cells_of(hashes, firsts, at, crowded, span)
            place = find(hot[0], cells)
            shares = np.where(place >= 0, hot[1][place], 1) if len(hot[0]) else np.ones(len(cells), dtype=np.int64)
            starts, words = windows.starts, windows.words
            row = np.searchsorted(words.first, starts, side="right")
            new = (np.diff(starts) != 1) | (cells[1:] != cells[:-1]) | (np.diff(here.astype(np.int8)) != 0) | (np.diff(row) != 0)
            begin = np.flatnonzero(np.concatenate([[True], new])) if len(starts) else np.zeros(0, dtype=np.int64)
            stop = np.append(begin[1:], len(starts)) - 1 if len(begin) else begin
            rows = []
            for a, b in zip(begin.tolist(), stop.tolist()):
                stretch = words.data[words.starts[starts[a]] : words.ends[starts[b] + window - 1]].tobytes()
                # Blanks may differ between copies; words alone count.
                stretch, cell, first, n = b" ".join(stretch.split()), int(cells[a]), bool(here[a]), int(shares[a])
                if (key := blake2b(stretch, digest_size=16, key=b"%d %d" % (cell, first)).digest()) not in sent:
                    sent.add(key)
                    own = range(n) if first else [int.from_bytes(key[:8]) % n]
                    rows += [(shard, first, stretch) for shard in sorted({shard_of(cell, i) for i in own})]
            if len(sent) > SENT:
                sent.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PASSAGES)], schema=_PASSAGES)

    return docs.mapInArrow(work, "shard int, reference boolean, words binary")


def unmatched(rows, folder, bits, window):
    """Store the hashes of windows that no automaton of their shard accepts: different windows with equal hashes."""

    def match(key, rows):
        worker_state()
        numbers, automaton, wrong = {}, SuffixAutomaton(), []
        number = lambda words: [numbers.setdefault(w, len(numbers)) for w in words.split(b" ")]
        reference, stretches = rows["reference"].to_pylist(), rows["words"].to_pylist()
        for stretch in dict.fromkeys(s for s, r in zip(stretches, reference) if r):
            automaton.add(number(stretch))
        for stretch in dict.fromkeys(s for s, r in zip(stretches, reference) if not r):
            sizes = np.array(automaton.matching(number(stretch)))
            short = np.flatnonzero(sizes[window - 1 :] < window)
            if len(short):
                data = np.frombuffer(stretch, dtype=np.uint8)
                wrong.append(gram_hashes(Words(data, np.array([0, len(data)])).hashes, window)[short])
        found = np.unique(np.concatenate(wrong)) if wrong else np.zeros(0, dtype=np.uint64)
        edges = edges_of(found, bits)
        used = [int(i) for i in np.flatnonzero(np.diff(edges))]
        return pa.table({"shard": pa.array(used, pa.int32()), "keys": pa.array([found[edges[i] : edges[i + 1]].tobytes() for i in used], pa.binary())})

    def store(key, rows):
        worker_state()
        keys = np.unique(np.concatenate([np.frombuffer(k, dtype=np.uint64) for k in rows["keys"].to_pylist()]))
        write_shard(folder, f"unmatched-{key[0].as_py()}", {"unmatched": keys})
        return pa.table({"n": [len(keys)]})

    wrong = rows.groupBy("shard").applyInArrow(match, "shard int, keys binary")
    wrong.groupBy("shard").applyInArrow(store, "n bigint").agg(F.sum("n")).collect()
    return Shards(folder, bits, ("unmatched",))


def kept_texts(words, kept):
    """For each row its kept words, one blank between them, as bytes."""
    places = np.flatnonzero(kept)
    sizes = words.ends[places] - words.starts[places] + 1
    ends = np.cumsum(sizes)
    padded = np.append(words.data, np.uint8(0x20))
    at = np.repeat(words.starts[places] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
    joined = padded[at]
    joined[ends - 1] = 0x20
    data = joined.tobytes()
    first = np.searchsorted(places, words.first)
    edges = np.concatenate([[0], ends])[first]
    return [data[a : max(a, b - 1)] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def drop_repeats(docs, window=WINDOW, anchor=ANCHOR, folder=None, shard_chars=SHARD_CHARS, keep=("doc_id",)):
    """The columns `keep` with `kept_text, n_words, n_removed` for every row: what is left without repeated windows.

    Words are runs without blanks, unchanged. A window is `window` consecutive words of one
    document; all words of a window are removed if its sequence starts earlier as well: in
    a document with a smaller id, or further ahead in the same one. Windows are judged on
    the texts as they came. `text` holds the kept words with one blank between them.

    A null or empty text has no words and gives an empty text; a text with fewer words
    than a window is kept. Repeated rows with one id count as one document, so they do not
    remove each other; rows without an id count as one document behind all others. Other
    columns are not read; an empty table gives no rows. `folder` holds the tables, by
    default a fresh one below spark.checkpoint.dir. Runs Spark jobs.

    Windows are counted by 64-bit hashes and compared word by word before they are removed.
    """
    if not 0 < anchor <= window:
        raise ValueError("an anchor must lie within a window")
    table, docs = docs, narrowed(docs)
    folder = mapped_folder(folder or scratch_path(docs.sparkSession, "substrings"))
    chars = docs.agg(F.coalesce(F.sum(F.length("text") + 1), F.lit(0)).alias("n")).first()["n"]
    bits = shard_bits(chars, shard_chars)
    anchors = find_anchors(docs, folder, bits, window, anchor)
    crowded = crowded_ids(docs)
    places, hot = find_places(docs, anchors, window, anchor, crowded)
    wrong = unmatched(passages(docs, anchors, places, window, anchor, crowded, hot), folder, bits, window)

    def work(batches):
        for batch in batches:
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            texts, counts, gone = [], [], []
            for row, data, bounds in text_pieces(batch.column("text")):
                windows = Windows(data, bounds, window, anchor)
                words = windows.words
                hashes, _, _, here = look_at(ids[row : row + len(bounds) - 1], windows, anchors, places)
                later = ~here & ~wrong.look_up(hashes)[0]
                cover = np.zeros(len(words) + 1, dtype=np.int32)
                np.add.at(cover, windows.starts[later], 1)
                np.add.at(cover, np.minimum(windows.starts[later] + window, len(words)), -1)
                kept = np.cumsum(cover[:-1]) == 0
                texts += kept_texts(words, kept)
                counts.append(words.counts)
                gone.append(np.diff(np.concatenate([[0], np.cumsum(~kept)])[words.first]))
            numbers = [np.concatenate(c) if c else np.zeros(0, dtype=np.int64) for c in (counts, gone)]
            yield batch, [pa.array(texts, pa.binary()).cast(pa.string()), *(pa.array(n.astype(np.int64)) for n in numbers)]

    found = mapped(table, dict.fromkeys(["doc_id", *keep]), "kept_text string, n_words bigint, n_removed bigint", work)
    return found.select(*keep, "kept_text", "n_words", "n_removed")


def digests(kept):
    """`(doc_id, n_words, n_removed, kept_sha256)` of rows of `drop_repeats`."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
