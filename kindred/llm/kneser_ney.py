"""Language model scores: interpolated modified Kneser-Ney over word bigrams.

The model is counted in Spark and stored as sorted arrays of hashes and ids in the shared
folder; workers map the files into memory and look up sorted batches of keys, so they
hold only the pages they touch. Words are numbered by the order of their hashes; a bigram
is the number of its context followed by the number of its word, and its table is split
into shards by context. A context that fills a shard alone is split by its followers.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kindred.llm.learn import narrowed, remainder
from kindred.llm.mapped import COUNT_TYPES, GATHERED, Gathering, Maps, edges_of, find, mapped_folder, packed, shard_bits, summed, unpacked, write_shard
from kindred.llm.words import Words, mix, text_pieces, worker_state
from kindred.storage import scratch_path

# Characters of training text for each shard of the tables, about.
SHARD_CHARS = 8_000_000
END_HASH = mix(np.array([0x656E64], dtype=np.uint64))[0]

SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def with_ends(values, per_row, end):
    """`values` with `end` behind each row, and where rows start."""
    sizes = per_row + 1
    last = np.cumsum(sizes) - 1
    result = np.empty(len(values) + len(per_row), dtype=values.dtype)
    inner = np.ones(len(result), dtype=bool)
    inner[last] = False
    result[inner], result[last] = values, end
    return result, last + 1 - sizes


class Vocabulary:
    """Numbers of words by their hashes, in mapped shards of the hash range."""

    def __init__(self, folder, bits, sizes):
        self.folder, self.bits, self.sizes = folder, bits, sizes
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.words = int(self.offsets[-1])
        self.start, self.unknown = self.words, self.words + 1  # numbers of what is no word
        self.maps = Maps(folder)

    def shard(self, kind, i):
        return self.maps.arrays(f"words-{i}" if kind in ("words", "counts") else f"sums-{i}")[kind]

    def numbers(self, hashes):
        """Numbers of sorted distinct hashes."""
        result = np.full(len(hashes), self.unknown, dtype=np.int64)
        edges = edges_of(hashes, self.bits)
        for i in np.flatnonzero(np.diff(edges) * self.sizes):
            at = find(self.shard("words", i), hashes[edges[i] : edges[i + 1]])
            result[edges[i] : edges[i + 1]] = np.where(at >= 0, self.offsets[i] + at, self.unknown)
        return result

    def columns(self, kinds, numbers):
        """Values of sorted numbers of words, one array a kind; 0 for what is no word."""
        result = [np.zeros(len(numbers), dtype=np.int64) for _ in kinds]
        edges = np.searchsorted(numbers, self.offsets)
        for i in np.flatnonzero(np.diff(edges)):
            for values, kind in zip(result, kinds):
                part = slice(edges[i], edges[i + 1])
                values[part] = self.shard(kind, i)[numbers[part] - self.offsets[i]]
        return result


class Layout:
    """Which shard of the bigram table a context and word belong to."""

    def __init__(self, vocabulary, hot):
        """hot: `{context: parts}` of contexts that have shards of their own."""
        self.vocabulary = vocabulary
        self.hot = np.array(sorted(hot), dtype=np.int64)
        self.parts = np.array([hot[int(c)] for c in self.hot], dtype=np.int64)
        self.first = (1 << vocabulary.bits) + np.cumsum(self.parts) - self.parts
        self.shards = (1 << vocabulary.bits) + int(self.parts.sum())

    def of(self, contexts, words):
        shards = np.searchsorted(self.vocabulary.offsets, contexts, side="right") - 1
        shards = np.minimum(shards, (1 << self.vocabulary.bits) - 1)
        at = np.minimum(np.searchsorted(self.hot, contexts), len(self.hot) - 1)
        own = np.flatnonzero(self.hot[at] == contexts)
        shards[own] = self.first[at[own]] + words[own] * self.parts[at[own]] // (self.vocabulary.words + 2)
        return shards


def _emit(fields, schema):
    columns = [pa.array(c, f.type) for c, f in zip(fields, schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


_WORD_ROWS = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def count_words(texts, folder, bits):
    """Store the sorted hashes and counts of all words; returns the vocabulary, tokens and hot words."""

    def send(gathering):
        keys, counts = gathering.take()
        edges = edges_of(keys, bits)
        used = np.flatnonzero(np.diff(edges))
        return _emit(
            ([int(i) for i in used], [keys[edges[i] : edges[i + 1]].tobytes() for i in used], [packed(counts[edges[i] : edges[i + 1]]) for i in used]),
            _WORD_ROWS,
        )

    def gather(batches):
        worker_state()
        gathering = Gathering()
        for batch in batches:
            for _, data, bounds in text_pieces(batch.column("text")):
                words = Words(data, bounds, lower=True)
                gathering.add(with_ends(words.hashes, words.counts, END_HASH)[0])
                if gathering.held > GATHERED:
                    yield send(gathering)
        yield send(gathering)

    def store(key, rows):
        worker_state()
        keys = np.concatenate([np.frombuffer(k, dtype=np.uint64) for k in rows["keys"].to_pylist()])
        counts = np.concatenate([unpacked(c).astype(np.int64) for c in rows["counts"].to_pylist()])
        keys, counts = summed(keys, counts)
        shard = key[0].as_py()
        write_shard(folder, f"words-{shard}", {"words": keys, "counts": counts})
        hot = np.flatnonzero(counts * 4 > counts.sum())  # three words at most
        return pa.table(
            {"shard": [shard], "words": [len(keys)], "tokens": [int(counts.sum())]}
            | {n: pa.array([v.tolist()], pa.list_(pa.int64())) for n, v in (("hot", hot), ("n", counts[hot]))}
        )

    rows = texts.mapInArrow(gather, "shard int, keys binary, counts binary")
    rows = rows.groupBy("shard").applyInArrow(store, "shard bigint, words bigint, tokens bigint, hot array<bigint>, n array<bigint>")
    found = {r["shard"]: r for r in rows.collect()}  # a row a shard
    sizes = np.array([found[i]["words"] if i in found else 0 for i in range(1 << bits)], dtype=np.int64)
    vocabulary = Vocabulary(folder, bits, sizes)
    tokens = sum(r["tokens"] for r in found.values())
    hot = {int(vocabulary.offsets[i]) + w: n for i, r in found.items() for w, n in zip(r["hot"], r["n"])}
    return vocabulary, tokens, hot


def numbered(vocabulary, words):
    """Numbers of the words of each row with its end, and where the rows start."""
    hashes, starts = with_ends(words.hashes, words.counts, END_HASH)
    distinct, which = np.unique(hashes, return_inverse=True)
    return vocabulary.numbers(distinct)[which], starts


def contexts_of(numbers, starts, start):
    contexts = np.empty_like(numbers)
    contexts[1:] = numbers[:-1]
    contexts[starts] = start
    return contexts


_PAIR_ROWS = pa.schema([("shard", pa.int32()), ("steps", pa.binary()), ("words", pa.binary()), ("counts", pa.binary())])
_STAT_ROWS = "kind string, shard int, numbers binary, v0 binary, v1 binary, v2 binary, v3 binary"


def count_pairs(texts, vocabulary, layout):
    """Store the bigram shards; returns rows of sums for contexts and words, and of counts of counts."""
    folder = vocabulary.folder
    shared = texts.sparkSession.sparkContext.broadcast((vocabulary, layout))

    def send(gathering, layout):
        keys, counts = gathering.take()
        contexts, words = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        shards = layout.of(contexts, words)
        order = np.argsort(shards, kind="stable")
        edges = np.searchsorted(shards[order], np.arange(layout.shards + 1))
        rows = ([], [], [], [])
        for i in np.flatnonzero(np.diff(edges)):
            part = order[edges[i] : edges[i + 1]]
            for column, values in zip(rows, (i, packed(np.diff(contexts[part], prepend=0)), packed(words[part]), packed(counts[part]))):
                column.append(values)
        return _emit(rows, _PAIR_ROWS)

    def gather(batches):
        worker_state()
        vocabulary, layout = shared.value
        gathering = Gathering()
        for batch in batches:
            for _, data, bounds in text_pieces(batch.column("text")):
                numbers, starts = numbered(vocabulary, Words(data, bounds, lower=True))
                pairs = contexts_of(numbers, starts, vocabulary.start).astype(np.uint64) << np.uint64(32)
                gathering.add(pairs | numbers.astype(np.uint64))
                if gathering.held > GATHERED:
                    yield send(gathering, layout)
        yield send(gathering, layout)

    def store(key, rows):
        worker_state()
        vocabulary, layout = shared.value
        keys, counts = [], []
        for steps, words, n in zip(*(rows[c].to_pylist() for c in ("steps", "words", "counts"))):
            contexts = np.cumsum(unpacked(steps).astype(np.int64)).astype(np.uint64)
            keys.append(contexts << np.uint64(32) | unpacked(words).astype(np.uint64))
            counts.append(unpacked(n).astype(np.int64))
        keys, counts = summed(np.concatenate(keys), np.concatenate(counts))
        shard = key[0].as_py()
        times = counts.astype(next(k for k in COUNT_TYPES if counts.max() <= np.iinfo(k).max))
        write_shard(folder, f"pairs-{shard}", {"pairs": keys, "times": times})
        contexts = (keys >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]]))
        sums = [np.add.reduceat(v, first) for v in (counts, counts == 1, counts == 2, counts > 2)]
        followed, before = np.unique((keys & np.uint64(0xFFFFFFFF)).astype(np.int64), return_counts=True)
        result = []
        for kind, numbers, values in (("context", contexts[first], [v.astype(np.int64) for v in sums]), ("word", followed, [before])):
            home = np.minimum(np.searchsorted(vocabulary.offsets, numbers, side="right") - 1, (1 << vocabulary.bits) - 1)
            edges = np.searchsorted(home, np.arange((1 << vocabulary.bits) + 1))
            for i in np.flatnonzero(np.diff(edges)):
                part = slice(edges[i], edges[i + 1])
                sent = [packed(v[part]) for v in values] + [None] * (4 - len(values))
                result.append((kind, int(i), packed(numbers[part] - vocabulary.offsets[i]), *sent))
        result.append(("counts", -1, packed(np.bincount(np.minimum(counts, 5), minlength=6)[1:5]), None, None, None, None))
        names = ("kind", "shard", "numbers", "v0", "v1", "v2", "v3")
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, zip(*result), (pa.string(), pa.int32(), *[pa.binary()] * 5))})

    rows = texts.mapInArrow(gather, "shard int, steps binary, words binary, counts binary")
    return rows.groupBy("shard").applyInArrow(store, _STAT_ROWS)


def store_stats(stats, vocabulary):
    """Store sums for contexts and words; returns counts of counts of both orders and the sums of the start."""
    folder = vocabulary.folder
    shared = stats.sparkSession.sparkContext.broadcast(vocabulary)

    def store(key, rows):
        worker_state()
        vocabulary, shard = shared.value, key[0].as_py()
        pairs = np.zeros(4, dtype=np.int64)
        if shard < 0:
            for data in rows["numbers"].to_pylist():
                pairs += unpacked(data)
            return pa.table({"shard": [shard], "seen": [pairs.tolist()], "followed": [0], "start": [[0, 0, 0, 0]]})
        size = int(vocabulary.sizes[shard])
        names = ("follow", "once", "twice", "often", "before")
        sums = {name: np.zeros(size + 1, dtype=np.int64) for name in names}  # the last shard has the start behind it
        for row in rows.to_pylist():
            numbers = unpacked(row["numbers"]).astype(np.int64)
            targets = names[:4] if row["kind"] == "context" else names[4:]
            for name, column in zip(targets, ("v0", "v1", "v2", "v3")):
                sums[name][numbers] += unpacked(row[column]).astype(np.int64)  # numbers are distinct within a row
        write_shard(folder, f"sums-{shard}", {name: values[:size] for name, values in sums.items()})
        before = sums["before"][:size]
        seen = np.bincount(np.minimum(before, 5), minlength=6)[1:5]
        start = [int(sums[name][size]) for name in names[:4]]
        return pa.table({"shard": [shard], "seen": [seen.tolist()], "followed": [int(before.sum())], "start": [start]})

    schema = "shard bigint, seen array<bigint>, followed bigint, start array<bigint>"
    pairs, words, followed, start = np.zeros(4), np.zeros(4), 0, np.zeros(4, dtype=np.int64)
    for row in stats.groupBy("shard").applyInArrow(store, schema).collect():  # a row a shard
        if row["shard"] < 0:
            pairs += row["seen"]
        else:
            words += row["seen"]
            followed += row["followed"]
            start += np.array(row["start"])
    return pairs, words, followed, start


def discounts(seen):
    """Discounts for counts of 0 to 3 and more, from how many entries have the counts 1 to 4."""
    n1, n2, n3, n4 = (float(n) for n in seen)
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0, 0.5, 0.75, 1.0])
    share = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * share * n2 / n1, 2 - 3 * share * n3 / n2, 3 - 4 * share * n4 / n3]
    return np.array([0, *(min(max(d, 0.05), k * 0.95) for k, d in enumerate(raw, 1))])


class Model:
    """What a worker needs to score: places of the mapped tables and a few numbers."""

    def __init__(self, vocabulary, layout, tokens, pairs, words, followed, start):
        self.vocabulary, self.layout, self.tokens = vocabulary, layout, tokens
        self.pair_discounts, self.word_discounts = discounts(pairs), discounts(words)
        self.followed, self.start = followed, start
        kinds = np.array([words[0], words[1], max(vocabulary.words - words[0] - words[1], 0)])
        self.spread = float((kinds * self.word_discounts[1:]).sum())

    def pair_counts(self, contexts, words):
        """Counts of distinct bigrams, given in the order of context and word."""
        result = np.zeros(len(contexts), dtype=np.int64)
        if not self.vocabulary.words:
            return result
        keys = contexts.astype(np.uint64) << np.uint64(32) | words.astype(np.uint64)
        shards = self.layout.of(contexts, words)
        known = np.flatnonzero((contexts != self.vocabulary.unknown) & (words < self.vocabulary.start))
        order = known[np.argsort(shards[known], kind="stable")]
        edges = np.searchsorted(shards[order], np.arange(self.layout.shards + 1))
        for i in np.flatnonzero(np.diff(edges)):
            if (shard := self.vocabulary.maps.arrays(f"pairs-{i}")) is None:
                continue
            part, times = order[edges[i] : edges[i + 1]], shard["times"]
            at = find(shard["pairs"], keys[part])
            result[part] = np.where(at >= 0, times[at], 0)
        return result

    def lower(self, before):
        """Probability of words after any context, by how many different contexts came before them."""
        uniform = 1 / (self.vocabulary.words + 1)
        if not self.followed:
            return np.full(len(before), uniform)
        kept = np.maximum(before - self.word_discounts[np.minimum(before, 3)], 0)
        return (kept + self.spread * uniform) / self.followed

    def logs(self, numbers, starts):
        """For each token: log10 of its probability, of its base probability, and whether it is known."""
        vocabulary = self.vocabulary
        words, which = np.unique(numbers, return_inverse=True)
        seen, before = vocabulary.columns(("counts", "before"), words)
        base = np.log10((seen + 1) / (self.tokens + vocabulary.words + 1))
        keys = contexts_of(numbers, starts, vocabulary.start).astype(np.uint64) << np.uint64(32) | numbers.astype(np.uint64)
        keys, pair = np.unique(keys, return_inverse=True)
        contexts, followers = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        counts = self.pair_counts(contexts, followers)
        distinct, at = np.unique(contexts, return_inverse=True)
        sums = np.stack(vocabulary.columns(("follow", "once", "twice", "often"), distinct))
        sums[:, distinct == vocabulary.start] = self.start[:, None]
        held_back = (sums[1:] * self.pair_discounts[1:, None]).sum(axis=0)[at]
        total = sums[0][at]
        low = self.lower(before)[np.searchsorted(words, followers)]
        kept = np.maximum(counts - self.pair_discounts[np.minimum(counts, 3)], 0)
        chance = np.where(total > 0, (kept + held_back * low) / np.maximum(total, 1), low)
        return np.log10(chance)[pair], base[which], (seen > 0)[which]


def train(texts, folder, shard_chars=SHARD_CHARS):
    """Count the model of `texts` `(text)` into `folder`, a URI all workers can map; runs Spark jobs."""
    folder = mapped_folder(folder)
    texts = texts.select("text")
    chars = texts.agg(F.coalesce(F.sum(F.length("text") + 1), F.lit(0)).alias("n")).first()["n"]
    bits = shard_bits(chars, shard_chars)
    vocabulary, tokens, hot = count_words(texts, folder, bits)
    if vocabulary.unknown >= 1 << 32:
        raise ValueError("more than 2**32 - 2 different words")
    mean = max(tokens / (1 << bits), 1)
    rows = texts.count()
    parts = {word: int(np.ceil(n / mean)) for word, n in hot.items() if n > mean}
    parts[vocabulary.start] = max(1, int(np.ceil(rows / mean)))
    layout = Layout(vocabulary, parts)
    stats = count_pairs(texts, vocabulary, layout)
    return Model(vocabulary, layout, tokens, *store_stats(stats, vocabulary))


def score(docs, model, held_out):
    """Scores of every row of `docs`; `held_out` is a column of `doc_id`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        worker_state()
        model = shared.value
        for batch in batches:
            n = batch.num_rows
            columns = {"n": np.zeros(n, np.int64), "known": np.zeros(n, np.int64), "base": np.zeros(n), "score": np.zeros(n)}
            for row, data, bounds in text_pieces(batch.column("text")):
                numbers, starts = numbered(model.vocabulary, Words(data, bounds, lower=True))
                chance, base, known = model.logs(numbers, starts)
                part = slice(row, row + len(starts))
                columns["n"][part] = np.diff(starts, append=len(numbers))
                columns["known"][part] = np.add.reduceat(known.astype(np.int64), starts)
                columns["base"][part] = np.add.reduceat(base, starts)
                columns["score"][part] = np.add.reduceat(chance, starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(columns[c]) for c in ("n", "known", "base", "score"))],
                ["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    schema = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = narrowed(docs).mapInArrow(work, schema)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(int(model.tokens)).cast("bigint").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def language_model_scores(docs, folder=None, shard_chars=SHARD_CHARS):
    """Score every whole text by a model of the texts that are not held out.

    Rows `(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity)`; `held_out`: crc32 of the id as text leaves 2 when divided by 7 (null for
    a null id, whose text does not train). Tokens are the words, A-Z in lower case, and
    one end. `base_score` is the sum over tokens of log10((c + 1) / (N + V + 1)) with
    training counts, `score` the log10 probability under the model.

    A null or empty text is its end alone. Repeated rows train and are scored each; other
    columns are not read; an empty table gives no rows. Without training texts each token
    has probability 1. `folder` holds the model, by default a fresh one below
    spark.checkpoint.dir. Training runs Spark jobs.
    """
    held_out = remainder(F.col("doc_id"), 7) == 2
    folder = folder or scratch_path(docs.sparkSession, "kneser-ney")
    model = train(narrowed(docs).where(~held_out), folder, shard_chars)
    return score(docs, model, held_out)
