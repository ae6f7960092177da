"""Language identification by prediction by partial matching.

For each language a byte context tree of variable order is counted from sample texts and
then frozen. A byte is coded in the longest context that has been seen; a byte that was
never seen there costs an escape, and the next shorter context codes it (escape method C:
a context with T different followers among N counts gives the escape T / (N + T)). The
exact code length of a text under each language, in bits, decides.

Words are coded one after another, each from the blank before it to the blank after it,
so that a word costs the same wherever it stands and is worked out once.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from kindred.llm.learn import ChainSums, WordScorer, bounded_sample, mapped, narrowed, remainder, row_sums, word_counts

# Bytes of context and the byte itself.
ORDER = 5
# Characters of text taken for each language; the only bound of the fit.
SAMPLE_CHARS = 1_000_000
UNDECIDED = "und"

_LETTER = regex.compile(r"\p{L}")


class ContextTree:
    """Frozen counts of one language: what followed each context of up to `order - 1` bytes."""

    def __init__(self, words, order=ORDER):
        """words: `{word: count}`."""
        grams = Counter()
        for word, n in words.items():
            chain = ChainSums.START + word + ChainSums.END
            for end in range(2, len(chain) + 1):
                for size in range(1, min(order, end) + 1):
                    grams[chain[end - size : end]] += n
        self.grams = dict(grams)
        total, kinds = Counter(), Counter()
        for gram, n in grams.items():
            total[gram[:-1]] += n
            kinds[gram[:-1]] += 1
        self.total, self.kinds = dict(total), dict(kinds)

    def bits(self, gram):
        """Code length of the last byte of `gram` after the bytes before it."""
        cost = 0.0
        for cut in range(len(gram)):
            tail = gram[cut:]
            total = self.total.get(tail[:-1])
            if not total:
                continue
            kinds = self.kinds[tail[:-1]]
            n = self.grams.get(tail)
            if n:
                return cost - math.log2(n / (total + kinds))
            cost -= math.log2(kinds / (total + kinds))
        return cost + 8.0


class LanguageModels:
    def __init__(self, counts, order=ORDER):
        """counts: `{language: {word: count}}`."""
        self.languages = sorted(counts)
        self.order = order
        self.trees = [ContextTree(counts[lang], order) for lang in self.languages]

    def scorer(self):
        width = len(self.trees)
        sums = ChainSums(lambda gram: tuple(tree.bits(gram) for tree in self.trees), width, self.order)
        return WordScorer(sums, width)


def fit(docs, sample_chars=SAMPLE_CHARS):
    """Models of the languages in `docs` `(doc_id, text, lang)`; rows without a text or language are left out.

    An id with several languages counts for the first of them in the alphabet. About `sample_chars` characters of whole texts for each language are counted; only
    these reach the driver.
    """
    labelled = docs.select(docs["doc_id"].alias("doc_id"), docs["lang"].alias("label")).where("label is not null")
    labelled = labelled.groupBy("doc_id").agg(F.min("label").alias("label"))
    counts = {}
    for lang, word, n in word_counts(bounded_sample(narrowed(docs), labelled, sample_chars)).toLocalIterator(prefetchPartitions=True):
        counts.setdefault(lang, {})[word.encode()] = n
    return LanguageModels(counts)


def code_lengths(scorer, column):
    """Bits of each row of an Arrow string column under each language."""
    result = np.zeros((len(column), scorer.width))
    for row, words, bits in scorer(column):
        result[row : row + len(words.counts)] = row_sums(bits, words.first)
    return result


def identify(docs, models, keep=("doc_id",)):
    """The columns `keep` with `lang_pred, score` for every row of `docs`.

    `score` is the share of the language among all under the exact code lengths, 2 to the
    minus bits, normalised; equal lengths go to the language first in the alphabet. A null
    text, one without a letter, and every text where no language was learned, is `und`
    with score 0. Whole texts are coded, however long; repeated rows are each answered.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def work(batches):
        models = shared.value
        scorer = models.scorer()
        names = np.array([*models.languages, UNDECIDED], dtype=object)
        for batch in batches:
            column = batch.column("text")
            lettered = np.array([t is not None and _LETTER.search(t) is not None for t in column.to_pylist()], dtype=bool)
            if not models.languages:
                best, score = np.zeros(len(column), dtype=int), np.zeros(len(column))
            else:
                bits = code_lengths(scorer, column)
                best = bits.argmin(axis=1)
                least = bits.min(axis=1)
                score = 1 / np.exp2(-np.minimum(bits - least[:, None], 1000)).sum(axis=1)
            best = np.where(lettered, best, len(models.languages))
            yield batch, [pa.array(names[best], pa.string()), pa.array(np.where(lettered, score, 0.0))]

    return mapped(docs, keep, "lang_pred string, score double", work)


def language_id(docs, sample_chars=SAMPLE_CHARS, keep=("doc_id",)):
    """The columns `keep` with `held_out, lang_pred, score` for every row of `docs`.

    Learns from the rows that have a text and a language and are not held out; `held_out`:
    crc32 of the id as text leaves 1 when divided by 3 (null for a null id). Predictions
    see texts only. Starting the fit runs Spark jobs.
    """
    held_out = remainder(F.col("doc_id"), 3) == 1
    models = fit(docs.where(~held_out), sample_chars)
    found = identify(docs, models, dict.fromkeys(["doc_id", *keep]))
    return found.select(*keep, held_out.alias("held_out"), "lang_pred", "score")
