"""What the two classifiers share: a bounded sample, its word counts, scores by word."""

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kindred.llm.words import Words, text_pieces, worker_state
from kindred.storage import materialize

# Hash buckets a sample is cut from.
GRAIN = 1 << 30
# Most word scores a worker keeps; beyond that it starts anew.
KEPT_WORDS = 400_000
# Most values of single grams a worker keeps.
KEPT_GRAMS = 400_000


def remainder(column, n):
    """crc32 of the id written as text, modulo `n`."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(n))


def bounded_sample(texts, labelled, limit_chars):
    """Whole rows `(label, doc_id, text)` of about `limit_chars` characters for each label, written.

    `texts`: `(doc_id, text)`; `labelled`: `(doc_id, label)`, one row an id. The rows with
    the smallest hashes of their ids are taken: each label's share of the hash range
    follows from its total length, and the row with the smallest hash of all is always in.
    Only ids and lengths are shuffled for that; no label is sorted or gathered as a whole.
    A row counts as its characters and one more, so the ids that are broadcast to fetch
    the texts are at most about `limit_chars` for each label as well.
    """
    sizes = texts.where("text is not null").select("doc_id", F.length("text").alias("_size"))
    rows = sizes.join(labelled, "doc_id").withColumn("_draw", F.pmod(F.xxhash64("doc_id"), F.lit(GRAIN)))
    share = rows.groupBy("label").agg(
        F.greatest(F.min("_draw"), F.floor(F.lit(float(GRAIN)) * limit_chars / F.sum(F.col("_size") + 1)).cast("long")).alias("_most")
    )
    chosen = rows.join(F.broadcast(share), "label").where("_draw <= _most").select("doc_id", "label").distinct()
    chosen = materialize(chosen, "sample-ids")
    return materialize(texts.join(F.broadcast(chosen), "doc_id").where("text is not null"), "sample")


def word_counts(sample, lower=True):
    """Rows `(label, word, n)`: in how many different texts of the sample each word occurs.

    Copies of a text count once, and so do repeats within a text, so that a text that is
    copied often does not teach its own rare words.
    """
    texts = sample.select("label", "text").distinct()
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") if lower else F.col("text")
    words = texts.select("label", F.explode(F.array_distinct(F.split(text, "[ \\t-\\r]+"))).alias("word"))
    return words.where("word <> ''").groupBy("label", "word").agg(F.count(F.lit(1)).alias("n"))


class ChainSums:
    """Sums, over the bytes of words, of values that depend on a byte and those before it.

    A word is the chain start, bytes, end. `value(gram)` gives `width` numbers for the
    last byte of a gram of at most `order` bytes; each distinct gram is worked out once.
    """

    START, END = b"\x02", b"\x03"

    def __init__(self, value, width, order):
        self.value, self.width, self.order = value, width, order
        self.place, self.rows = {}, array("d")

    def __call__(self, words):
        if len(self.place) > KEPT_GRAMS:
            self.place, self.rows = {}, array("d")
        order, place, rows, value = self.order, self.place, self.rows, self.value
        used, bounds = [], [0]
        for word in words:
            chain = self.START + word + self.END
            for end in range(2, len(chain) + 1):
                gram = chain[end - order if end > order else 0 : end]
                at = place.get(gram)
                if at is None:
                    at = place[gram] = len(place)
                    rows.extend(value(gram))
                used.append(at)
            bounds.append(len(used))
        values = np.array(rows).reshape(-1, self.width)[np.array(used, dtype=np.int64)]
        return row_sums(values, np.array(bounds))


class WordScorer:
    """Rows of scores for the words of a text, each distinct word worked out once.

    `score` maps a list of words to an array with a row of `width` numbers for each.
    """

    def __init__(self, score, width, lower=True):
        self.score, self.width, self.lower = score, width, lower
        self.keys, self.values = np.zeros(0, dtype=np.uint64), np.zeros((0, width))

    def __call__(self, column):
        """Yield `(first row, words, scores)` for stretches of an Arrow string column."""
        for row, data, bounds in text_pieces(column):
            words = Words(data, bounds, self.lower)
            distinct, place, which = np.unique(words.hashes, return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
            known = self.keys[at] == distinct if len(self.keys) else np.zeros(len(distinct), dtype=bool)
            table = np.empty((len(distinct), self.width))
            table[known] = self.values[at[known]]
            new = np.flatnonzero(~known)
            found = [words.text(i) for i in place[new].tolist()]
            table[new] = self.score([w.lower() for w in found] if self.lower else found)
            if len(self.keys) + len(new) > KEPT_WORDS:
                self.keys, self.values = distinct, table
            elif len(new):
                order = np.argsort(keys := np.concatenate([self.keys, distinct[new]]))
                self.keys, self.values = keys[order], np.concatenate([self.values, table[new]])[order]
            yield row, words, table[which]


def row_sums(values, first):
    """Sums of the entries of each row; row i has entries first[i] to first[i + 1]."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def row_maxima(values, first, empty=0.0):
    """Largest entry of each row."""
    result = np.full(len(first) - 1, empty)
    filled = np.flatnonzero(np.diff(first) > 0)
    if len(filled):
        result[filled] = np.maximum.reduceat(values, first[:-1][filled])
    return result


def narrowed(docs, keep=("doc_id",)):
    """The text and the columns that are kept, whatever else the table holds."""
    return docs.select(*(docs[c].alias(c) for c in dict.fromkeys([*keep, "text"])))


def mapped(docs, keep, added, work):
    """Rows of `keep` with the columns `added`, a DDL string, that `work` makes.

    `work` takes an iterator of Arrow batches and yields `(batch, columns)`; the text of
    `docs` is there for it.
    """
    rows = narrowed(docs, keep)
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep]
    names = [*keep, *(part.split()[0] for part in added.split(", "))]

    def whole(batches):
        worker_state()
        for batch, columns in work(batches):
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns], names)

    return rows.mapInArrow(whole, ", ".join([*kinds, added]))
