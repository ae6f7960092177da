"""Toxicity: class-conditional Kneser-Ney models with shared backoff counts.

Words are byte chains. For each class (toxic, ordinary) the counts of a byte after the
bytes before it in its word give a Kneser-Ney distribution; what a class has not seen
backs off to continuation counts that both classes share, so a rare expression is
neither toxic nor ordinary by its mere rarity. The two log-likelihoods of each word,
normalised by its length, are compared; a text is judged by its strongest expressions
and by the mean over all its words, weighed by a logistic fit on sample rows that
neither class was counted from.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kindred.llm.learn import ChainSums, WordScorer, bounded_sample, mapped, narrowed, remainder, row_maxima, row_sums, word_counts

ORDER = 6
DISCOUNT = 0.75
# Characters of labelled text taken for each class; the only bound of the fit.
SAMPLE_CHARS = 3_000_000


def _grams(word, order):
    chain = ChainSums.START + word + ChainSums.END
    for i in range(1, len(chain)):
        yield chain[max(0, i + 1 - order) : i], chain[i]


class ClassModels:
    """Two class-conditional models over one backoff."""

    def __init__(self, counts, order=ORDER):
        """counts: `{word: (in toxic texts, in ordinary texts)}`."""
        self.order = order
        joint, tails = [Counter(), Counter()], set()
        for word, pair in counts.items():
            for context, byte in _grams(word, order):
                gram = context + bytes((byte,))
                for side in (0, 1):
                    if pair[side]:
                        joint[side][gram] += pair[side]
                if gram not in tails:
                    tails.update(gram[cut:] for cut in range(len(gram) - 1))  # each with the byte before
        # Of each context and class: counts in all, and different bytes.
        contexts = {}
        for side in (0, 1):
            for gram, n in joint[side].items():
                held = contexts.setdefault(gram[:-1], [0, 0, 0, 0])
                held[2 * side] += n
                held[2 * side + 1] += 1
        self.contexts = {context: tuple(held) for context, held in contexts.items()}
        self.before = dict(Counter(gram[1:] for gram in tails))  # different bytes before a gram
        tails = None
        held = {}
        for gram, n in self.before.items():
            pair = held.setdefault(gram[:-1], [0, 0])
            pair[0] += n
            pair[1] += 1
        self.held = {context: tuple(pair) for context, pair in held.items()}
        # What was seen is worked out here once; workers need the counts of the rest only.
        self.known = {gram: self.apart(gram, joint) for gram in {**joint[0], **joint[1]}}

    def shared(self, context, byte):
        """Continuation probability that both classes back off to."""
        chance = 1 / 257
        for cut in range(len(context), -1, -1):
            tail = context[cut:]
            if tail not in self.held:
                continue
            held, seen = self.held[tail]
            own = max(self.before.get(tail + byte, 0) - DISCOUNT, 0)
            chance = (own + DISCOUNT * seen * chance) / held
        return chance

    def apart(self, gram, joint=({}, {})):
        """Difference of the two log-likelihoods of the last byte of `gram` after the others.

        `joint` has the counts of grams for each class; what is not in it was not seen.
        """
        context, byte = gram[:-1], gram[-1:]
        if context not in self.contexts:
            return 0.0  # both back off, to the same value
        back, counts, sides = self.shared(context[1:], byte), self.contexts[context], []
        for side in (0, 1):
            total, kinds = counts[2 * side : 2 * side + 2]
            own = max(joint[side].get(gram, 0) - DISCOUNT, 0)
            sides.append((own + DISCOUNT * kinds * back) / total if total else back)
        return math.log(sides[0]) - math.log(sides[1])

    def scorer(self):
        """Scores of words: difference of the two log-likelihoods a byte, and in all."""
        known, apart = self.known, self.apart
        sums = ChainSums(lambda gram: (known[gram] if gram in known else apart(gram),), 1, self.order)

        def score(words):
            total = sums(words)[:, 0]
            return np.column_stack([total / np.array([len(w) + 1 for w in words]), total])

        return WordScorer(score, 2)


def _top_sums(values, first, n=3):
    """Sum of the `n` largest entries of each row, negative ones left out."""
    values, total = np.maximum(values, 0), np.zeros(len(first) - 1)
    left = values.copy()
    for _ in range(n):
        best = row_maxima(left, first)
        total += best
        hit = left == np.repeat(best, np.diff(first))
        place = np.flatnonzero(hit)
        owner = np.searchsorted(first, place, side="right") - 1
        place = place[np.unique(owner, return_index=True)[1]]  # one of equals a row
        left[place] = 0
    return total


def features(scorer, column):
    """For each row: mean over its words, strongest word, and the three strongest together."""
    result = np.zeros((len(column), 4))
    for row, words, scores in scorer(column):
        to = slice(row, row + len(words.counts))
        n = np.maximum(words.counts, 1)
        result[to, 0] = row_sums(scores[:, 0], words.first) / n
        result[to, 1] = row_maxima(scores[:, 1], words.first) / 5
        result[to, 2] = _top_sums(scores[:, 1], words.first) / 10
        result[to, 3] = row_maxima(scores[:, 0], words.first)
    return result


def fit_logistic(x, y, rounds=60, ridge=1e-3):
    """Weights of a logistic regression, both classes weighing the same; Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * beta
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(bend, slope)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def chances(beta, x):
    return 1 / (1 + np.exp(-np.clip(np.column_stack([x, np.ones(len(x))]) @ beta, -700, 700)))


def fit(docs, labelled, sample_chars=SAMPLE_CHARS):
    """`(word models, weights)` from `labelled` `(doc_id, toxic)`; None without both classes.

    Two thirds of the sample are counted, by the hash of the text so that copies stay
    together; the rest sets the weights. The sample, at most about `sample_chars` for
    each class, is all that reaches the driver.
    """
    labelled = labelled.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    sample = bounded_sample(narrowed(docs), labelled, sample_chars)
    sample = sample.withColumn("_part", F.pmod(F.xxhash64("text"), F.lit(3)))
    counts = {}
    for toxic, word, n in word_counts(sample.where("_part > 0")).toLocalIterator(prefetchPartitions=True):
        pair = counts.setdefault(word.encode(), [0, 0])
        pair[0 if toxic == 1 else 1] += n
    held = sample.where("_part = 0").select("label", "text").distinct().toArrow()
    labels = np.array(held["label"].to_pylist(), dtype=float)
    models = ClassModels(counts)
    if len(set(labels.tolist())) < 2:
        # Too few rows to set weights by: the strongest expression decides, at a ratio of e to the 4th.
        return models, np.array([0.0, 0.0, 10.0, 0.0, -4.0])
    x = features(models.scorer(), held["text"].combine_chunks())
    return models, fit_logistic(x, labels)


def score_toxicity(docs, fitted, keep=("doc_id",)):
    """The columns `keep` and `score` of every row; null and empty texts are scored as having no words."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def work(batches):
        models, beta = shared.value
        scorer = models.scorer()
        for batch in batches:
            yield batch, [pa.array(chances(beta, features(scorer, batch.column("text"))))]

    return mapped(docs, keep, "score double", work)


def toxicity(docs, labels, sample_chars=SAMPLE_CHARS, keep=("doc_id",)):
    """The columns `keep` with `held_out, score, predicted` for every row of `docs`.

    Learns from rows of `labels` (`doc_id`, `toxic` 0 or 1) whose id is not held out;
    `held_out`: crc32 of the id as text is a multiple of 5. A null or empty text gets the
    score of a text without words, rows without an id get a null `held_out`, repeated rows
    are each scored, an empty table gives no rows. Other columns of either table are not
    read. A document with two labels counts as toxic if either says so. Starting the fit
    runs Spark jobs.
    """
    labels = labels.select(labels["doc_id"].alias("doc_id"), labels["toxic"].alias("toxic"))
    held_out = remainder(F.col("doc_id"), 5) == 0
    fitted = fit(docs, labels.where(~held_out), sample_chars)
    scored = score_toxicity(docs, fitted, dict.fromkeys(["doc_id", *keep]))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select(*keep, held_out.alias("held_out"), "score", predicted)
