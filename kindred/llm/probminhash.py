"""MinHash near-dedup: ProbMinHash signatures, bands, verification, classes.

Each shingle of a document sends out the arrivals of a Poisson process whose rate is its
weight; an arrival falls on one component of the signature, and a component keeps the
shingle that arrives first. A shingle stops as soon as its next arrival comes later than
all components have. Two documents agree in a component with the probability Jaccard
similarity of their weights, which is the plain Jaccard similarity for equal weights.

Documents that share a band of components are compared exactly. Within a bucket all are
first compared with one of them, in a few rounds with another one each, at last with the one
that shares most buckets with others, as what the others are copies of does. After that the
documents outside the largest class of a bucket are compared with all of other classes, in
blocks; the largest class is not compared with itself. So a group of near copies costs a few
comparisons a member, and as many more as there are members it does not link.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from kindred.llm.learn import narrowed
from kindred.llm.words import Words, gram_hashes, mix, text_pieces, worker_state
from kindred.storage import materialize, materialize_observed

SHINGLE = 5
SIMILARITY = 0.8
# A pair of similarity 0.8 misses all bands with a probability of 3 in a million.
BANDS, ROWS = 24, 4
# Rounds in which the members of a bucket are compared with one of them.
PIVOT_ROUNDS = 2
# Members of a bucket that are compared with as many others in one task.
BLOCK = 256

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _multiple(n):
    return np.uint64(int(_GOLDEN) * n & 0xFFFFFFFFFFFFFFFF)


class Shingles:
    """Distinct shingles of the rows of one piece: row and hash, sorted, and how often each occurs."""

    def __init__(self, data, bounds, size=SHINGLE):
        words = Words(data, bounds)
        n = words.counts
        # A row with fewer words is one shingle of all its words.
        fits = np.where(n >= size, n - size + 1, np.minimum(n, 1))
        first = np.repeat(words.first[:-1] - (np.cumsum(fits) - fits), fits) + np.arange(int(fits.sum()))
        rows = np.repeat(np.arange(len(n)), fits)
        grams = gram_hashes(np.concatenate([words.hashes, np.zeros(size, dtype=np.uint64)]), size)
        hashes = grams[first] if len(first) else np.zeros(0, dtype=np.uint64)
        for i in np.flatnonzero(np.isin(rows, np.flatnonzero((n > 0) & (n < size)))):
            own = words.hashes[first[i] : first[i] + n[rows[i]]]
            hashes[i] = gram_hashes(own, len(own))[0] ^ np.uint64(len(own))
        order = np.lexsort((hashes, rows))
        rows, hashes = rows[order], hashes[order]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
        place = np.flatnonzero(new)
        self.rows, self.hashes = rows[place], hashes[place]
        self.counts = np.diff(place, append=len(rows))
        self.first = np.searchsorted(self.rows, np.arange(len(n) + 1))


def signatures(rows, hashes, weights, n, size):
    """ProbMinHash signatures of `n` rows, `size` components each; empty rows keep zeros."""
    arrived = np.full(n * size, np.inf)
    first = np.zeros(n * size, dtype=np.uint64)
    active, time, step = np.arange(len(rows)), np.zeros(len(rows)), 0
    while len(active):
        step += 1
        chance = mix(hashes[active] + _multiple(step))
        uniform = ((chance >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
        time[active] -= np.log(uniform) / weights[active]
        component = (mix(chance ^ _GOLDEN) % np.uint64(size)).astype(np.int64)
        target, now = rows[active] * size + component, time[active]
        np.minimum.at(arrived, target, now)
        won = now == arrived[target]
        first[target[won]] = hashes[active[won]]
        latest = arrived.reshape(n, size).max(axis=1)
        active = active[now < latest[rows[active]]]
    return first.reshape(n, size)


def band_keys(signature, bands, rows):
    """A hash for each band of each row."""
    keys = np.zeros((len(signature), bands), dtype=np.uint64)
    for i in range(rows):
        keys = mix(keys * _GOLDEN + signature[:, i : bands * rows : rows])
    return mix(keys + np.arange(bands, dtype=np.uint64) * _GOLDEN)


def fingerprints(shingles, n, weights):
    """Two sums over the distinct shingles of each row; equal weighted sets have equal sums."""
    result, times = [], weights.astype(np.uint64)
    for salt in (1, 2):
        total = np.zeros(len(shingles.hashes) + 1, dtype=np.uint64)
        np.cumsum(mix(mix(shingles.hashes + _multiple(salt << 40)) + times), out=total[1:])
        result.append((total[shingles.first[1:]] - total[shingles.first[:-1]]).view(np.int64))
    return result


def _with_text_hash(docs, *columns):
    """The rows with an id: id, hash of the text, and `columns`."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), F.xxhash64(docs["text"]).alias("text_hash"), *(docs[c].alias(c) for c in columns))
    return rows.where("doc_id is not null")


def described(docs, shingle, bands, rows, weight):
    """`(doc_id, text_hash, node, size, bands)` of rows with words, written; a node is a distinct weighted set."""

    def work(batches):
        worker_state()
        for batch in batches:
            for row, data, bounds in text_pieces(batch.column("text")):
                n = len(bounds) - 1
                found = Shingles(data, bounds, shingle)
                weights = np.ones(len(found.rows)) if weight == "set" else found.counts.astype(float)
                keys = band_keys(signatures(found.rows, found.hashes, weights, n, bands * rows), bands, rows)
                a, b = fingerprints(found, n, weights)
                offsets = np.arange(n + 1, dtype=np.int32) * bands
                columns = [batch.column(c).slice(row, n) for c in ("doc_id", "text_hash")]
                columns += [pa.array(np.diff(found.first).astype(np.int64)), pa.array(a), pa.array(b)]
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64).ravel())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "size", "print_a", "print_b", "bands"])

    schema = "doc_id bigint, text_hash bigint, size bigint, print_a bigint, print_b bigint, bands array<bigint>"
    found = _with_text_hash(docs, "text").mapInArrow(work, schema).where("size > 0")
    node = F.xxhash64("print_a", "print_b", "size").alias("node")
    return materialize(found.select("doc_id", "text_hash", node, "size", "bands"), "signatures")


def shingle_sets(docs, nodes, shingle):
    """`(node, hashes, counts)` of the texts `(doc_id, text_hash)` of `nodes`, as bytes of sorted hashes and their counts; written."""

    def work(batches):
        worker_state()
        for batch in batches:
            for row, data, bounds in text_pieces(batch.column("text")):
                found = Shingles(data, bounds, shingle)
                parts = list(zip(found.first[:-1].tolist(), found.first[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node").slice(row, len(parts)),
                        pa.array([found.hashes[a:b].tobytes() for a, b in parts], pa.binary()),
                        pa.array([found.counts[a:b].astype(np.uint32).tobytes() for a, b in parts], pa.binary()),
                    ],
                    ["node", "hashes", "counts"],
                )

    wanted = _with_text_hash(docs, "text").join(nodes, ["doc_id", "text_hash"]).select("node", "text")
    sets = wanted.mapInArrow(work, "node bigint, hashes binary, counts binary")
    # A row that is there several times gives the same set.
    one = sets.groupBy("node").agg(F.first(F.struct("hashes", "counts")).alias("s"))
    return materialize(one.select("node", "s.hashes", "s.counts"), "sets")


def probability_jaccard(a, b, x, y):
    """Similarity of weights `x` of sorted hashes `a` and `y` of `b`: for each common shingle the inverse of
    the sum over all shingles of the larger of both weights, in units of this shingle's."""
    common, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if x is None:
        return len(common) / (len(a) + len(b) - len(common))
    only_a, only_b = x.sum() - x[i].sum(), y.sum() - y[j].sum()
    # Few pairs of weights are different.
    (p, q), times = np.unique(np.stack([x[i], y[j]]), axis=1, return_counts=True)
    larger = np.maximum(p[None, :] / p[:, None], q[None, :] / q[:, None]) @ times
    return float((times / (only_a / p + only_b / q + larger)).sum())


def verified(pairs, sets, similarity, weight):
    """The pairs `(a, b)` whose similarity is at least `similarity`, with it."""

    def work(batches):
        worker_state()
        for batch in batches:
            rows = []
            for a, b, x, y, m, n in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "x", "y", "m", "n"))):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                counts = (None, None) if weight == "set" else (np.frombuffer(c, dtype=np.uint32).astype(float) for c in (m, n))
                value = probability_jaccard(x, y, *counts)
                if value >= similarity:
                    rows.append((a, b, value))
            columns = list(zip(*rows)) or [(), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "b", "similarity"])

    if weight == "set":
        sets = sets.withColumn("counts", F.lit(None).cast("binary"))
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"), F.col("counts").alias("m"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"), F.col("counts").alias("n"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", "m", "n")
    return materialize(rows.mapInArrow(work, "a bigint, b bigint, similarity double"), "links")


def components(links):
    """`(node, label)` for the ends of `links` `(a, b)`: the smallest node of each connected component.

    Each round takes the smallest label among neighbours and then the label of that label.
    """
    ends = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    ends = materialize(ends, "ends")
    labels = materialize(ends.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = ends.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("_near"))
        nearer = labels.join(near, F.col("node") == F.col("a"), "left")
        nearer = nearer.select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("_label"))
        jump = labels.select(F.col("node").alias("_label"), F.col("label").alias("_next"))
        jumped = nearer.join(jump, "_label", "left").select("node", "_old", F.coalesce("_next", "_label").alias("label"))
        labels, seen = materialize_observed(jumped, "labels", moved=F.sum((F.col("label") < F.col("_old")).cast("long")))
        labels = labels.select("node", "label")
        if not seen["moved"]:
            return labels


def _mixed(shared, labels):
    """Members `(bucket, node, size, label)` of the buckets that hold more than one class, written."""
    labelled = shared.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low < _high")
    return materialize(labelled.join(mixed.select("bucket"), "bucket").select("bucket", "node", "size", "label"), "mixed")


def _crowded(members):
    """`members` with `_near`, how many members there are in all buckets of the node."""
    full = materialize(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")), "full")
    near = members.join(full, "bucket").groupBy("node").agg(F.sum("_n").alias("_near"))
    return members.join(near, "node")


def overlaps(left, right, weights=None):
    """How many hashes each of the sorted arrays `left` shares with each of `right`.

    With the weights of both sides, also the weight of each left one in common, and of each right one.
    """
    common = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    results = [np.zeros((len(left), len(right)), dtype=np.float32) for _ in (0, *(weights or []))]

    def marks(sets, part, values=None):
        table = np.zeros((len(sets), len(part)), dtype=np.float32)
        for i, (row, hashes) in enumerate(zip(table, sets)):
            at = np.minimum(np.searchsorted(part, hashes), len(part) - 1)
            hit = part[at] == hashes
            row[at[hit]] = 1 if values is None else values[i][hit]
        return table

    for start in range(0, len(common), 16_384):
        part = common[start : start + 16_384]
        m, n = marks(left, part), marks(right, part)
        results[0] += m @ n.T
        if weights is not None:
            results[1] += marks(left, part, weights[0]) @ n.T
            results[2] += m @ marks(right, part, weights[1]).T
    return results[0] if weights is None else results


def block_pairs(members):
    """`(node, label, bucket, _low, _high, _upper)`: members of each bucket, for every two blocks that are to be compared.

    The blocks of a bucket's largest class come behind those of all other members, and only
    meet these. In the pair of blocks `_low, _high` a member lies in the higher if `_upper`.
    """
    classes = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("_n"))
    blocks = classes.groupBy("bucket").agg(F.sum("_n").alias("_all"), F.max(F.struct("_n", "label")).alias("_top"))
    in_blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    blocks = blocks.select("bucket", F.col("_top.label").alias("_most"), in_blocks(F.col("_all") - F.col("_top._n")).alias("_rest"), in_blocks(F.col("_top._n")).alias("_blocks"))
    blocks = materialize(blocks, "blocks")  # so that the members of a full bucket need not meet in one task
    top, place = F.col("label") == F.col("_most"), lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    placed = members.join(blocks, "bucket").withColumn("_own", F.when(top, F.col("_rest") + place(F.col("_blocks"))).otherwise(place(F.col("_rest"))))
    met = F.when(top, F.col("_rest")).otherwise(F.col("_rest") + F.col("_blocks"))
    placed = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), met - 1)))
    return placed.select("node", "label", "bucket", F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"), (F.col("_own") > F.col("_other")).alias("_upper"))


def links_in_buckets(members, sets, similarity, weight):
    """Links between members of different classes that share a bucket, written.

    A bucket is cut into blocks of bounded size, and two of its blocks meet in one task,
    which counts what their sets have in common; only links leave it.
    """

    def compare(key, rows):
        worker_state()
        same = key[1].as_py() == key[2].as_py()
        nodes, labels, upper = (rows[c].to_numpy(zero_copy_only=False) for c in ("node", "label", "_upper"))
        hashes = [np.frombuffer(h, dtype=np.uint64) for h in rows["hashes"].to_pylist()]
        counts = [None if c is None else np.frombuffer(c, dtype=np.uint32).astype(float) for c in rows["counts"].to_pylist()]
        sides = (np.arange(len(nodes)),) * 2 if same else (np.flatnonzero(~upper), np.flatnonzero(upper))
        found = []
        if all(len(s) for s in sides):
            sets = [[hashes[i] for i in side] for side in sides]
            if weight == "set":
                shared = overlaps(*sets)
                m, n = (np.array([len(h) for h in side], dtype=float) for side in sets)
                near = shared / (m[:, None] + n[None, :] - shared) >= similarity - 1e-6
            else:
                # In units of the larger weight w of a common shingle, all others come to at least
                # (what is not common + the larger common weight) / w; and the larger weights
                # come to both common weights less one for each common shingle, at most.
                values = [[counts[i] for i in side] for side in sides]
                shared, own, other = overlaps(*sets, values)
                m, n = (np.array([v.sum() for v in side]) for side in values)
                rest = m[:, None] + n[None, :] - np.minimum(own, other)
                near = (own + other - shared) / rest >= similarity - 1e-5
            near &= labels[sides[0]][:, None] != labels[sides[1]][None, :]
            for i, j in zip(*np.nonzero(near)):
                a, b = sorted((int(sides[0][i]), int(sides[1][j])), key=lambda k: nodes[k])
                value = probability_jaccard(hashes[a], hashes[b], counts[a], counts[b])
                if value >= similarity:
                    found.append((int(nodes[a]), int(nodes[b]), value))
        columns = list(zip(*found)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({name: pa.array(c, k) for name, c, k in zip(("a", "b", "similarity"), columns, kinds)})

    if weight == "set":
        sets = sets.withColumn("counts", F.lit(None).cast("binary"))
    grouped = block_pairs(members).join(sets, "node").groupBy("bucket", "_low", "_high")
    return materialize(grouped.applyInArrow(compare, "a bigint, b bigint, similarity double").distinct(), "links")


def linked_classes(docs, heads, similarity, shingle, weight, links=None):
    """`(node, label)` of the heads that share a class with another, by links between different texts.

    In each round the members of a bucket are compared with one of them, the same in all
    buckets of a group: the one whose hash for that round is the smallest, and in the last
    round the one with most members in its buckets. Buckets whose members are all in one
    class are done. After the rounds, the members of the other buckets are compared with
    each other where their classes differ. `links` are some that hold beforehand.
    """
    buckets = heads.select("node", "size", F.explode("bands").alias("bucket"))
    crowded = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("bucket")
    crowded = materialize(crowded, "buckets")
    shared = materialize(buckets.join(crowded, "bucket"), "members")
    wanted = heads.select("node", "head.doc_id", "head.text_hash").join(shared.select("node").distinct(), "node")
    sets = shingle_sets(docs, wanted, shingle)
    fits = lambda m, n: F.least(m, n) >= similarity * F.greatest(m, n) if weight == "set" else F.lit(True)
    members = materialize(shared.withColumn("label", F.col("node")), "mixed")
    tried = None
    for turn in range(PIVOT_ROUNDS + 1):
        ranked = _crowded(members) if turn == PIVOT_ROUNDS else members.withColumn("_near", F.lit(0))
        pivot = F.struct(-F.col("_near"), F.xxhash64("node", F.lit(turn)), "node", "size", "label")
        pivots = ranked.groupBy("bucket").agg(F.min(pivot).alias("p")).select(
            "bucket", F.col("p.node").alias("_pivot"), F.col("p.size").alias("_size"), F.col("p.label").alias("_label")
        )
        star = members.join(materialize(pivots, "pivots"), "bucket").where(F.col("label") != F.col("_label"))
        star = star.where(fits(F.col("size"), F.col("_size")))
        star = star.select(F.least("node", "_pivot").alias("a"), F.greatest("node", "_pivot").alias("b")).distinct()
        star = materialize(star if tried is None else star.join(tried, ["a", "b"], "left_anti"), "stars")
        found = verified(star, sets, similarity, weight)
        tried = star if tried is None else tried.unionByName(star)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        members = _mixed(members.drop("label"), labels)
        if members.isEmpty():
            return labels
    return components(links.unionByName(links_in_buckets(members, sets, similarity, weight)))


def _links_of_ids(table):
    """Links between the texts of rows with one id, or None where each id has one text."""
    nodes = table.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("_last")).where("a < _last")
    nodes = materialize(nodes.select("doc_id", "a"), "ids-of-several-texts")
    if nodes.isEmpty():
        return None
    pairs = table.join(nodes, "doc_id").select("a", F.col("node").alias("b")).where("a < b").distinct()
    return materialize(pairs.withColumn("similarity", F.lit(None).cast("double")), "links-of-ids")


def text_classes(docs, similarity=SIMILARITY, shingle=SHINGLE, bands=BANDS, rows=ROWS, weight="set", link_ids=False):
    """`(doc_id, text_hash, label)` of every row with an id and words: texts with one label are linked, over any number of links.

    `text_hash` is `xxhash64(text)`. Texts are judged one by one, whatever id they stand
    at; with `link_ids`, those of one id are linked as well. Options as in
    `near_duplicates`. Runs Spark jobs.
    """
    if weight not in ("set", "count"):
        raise ValueError("weight is 'set' or 'count'")
    table = described(docs, shingle, bands, rows, weight)
    head = F.min(F.struct("doc_id", "text_hash")).alias("head")
    heads = materialize(table.groupBy("node").agg(head, F.first("size").alias("size"), F.first("bands").alias("bands")), "heads")
    links = _links_of_ids(table.select("doc_id", "node")) if link_ids else None
    labels = linked_classes(docs, heads, similarity, shingle, weight, links)
    member = table.select("doc_id", "text_hash", "node").join(labels, "node", "left")
    return member.select("doc_id", "text_hash", F.coalesce("label", "node").alias("label"))


def near_duplicates(docs, similarity=SIMILARITY, shingle=SHINGLE, bands=BANDS, rows=ROWS, weight="set"):
    """`(doc_id, class_id)` for every row: the smallest id among the documents it is linked with, over any number of links.

    Documents are linked if the probability Jaccard similarity of their shingles, `shingle`
    consecutive words each, is at least `similarity`. Every distinct shingle weighs the same
    by default; with `weight="count"` it weighs as often as it occurs.

    A text with fewer words than a shingle is one shingle; a text that is null or has no
    words is alone in its class, as is a row without an id (class null). Rows with one id
    count as one document, which has the links of all its texts. Other columns are not read;
    an empty table gives no rows. Runs Spark jobs.

    Equal weighted sets of shingles are one text from the start, and only different texts
    are compared.
    """
    found = materialize(text_classes(docs, similarity, shingle, bands, rows, weight, link_ids=True), "text-classes")
    firsts = found.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    member = found.select("doc_id", "label").distinct().join(firsts, "label").select("doc_id", "class_id")
    ids = docs.select(docs["doc_id"].alias("doc_id"))
    return ids.join(member, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def drop_near_duplicates(docs, keep, similarity=SIMILARITY, shingle=SHINGLE, weight="set"):
    """The columns `keep` of the rows that stay: of each class of linked texts the one with the smallest id.

    A row goes only if its own text is linked with, or equals, that of a row that stays.
    Among texts of the smallest id the one with the smallest hash stays, and among equal
    rows the first by the other columns of `keep`. Rows without an id and texts without
    words stay. An empty table gives no rows.
    """
    found = materialize(text_classes(docs, similarity, shingle, weight=weight), "text-classes")
    place = F.struct("doc_id", "text_hash")
    chosen = found.groupBy("label").agg(F.min(place).alias("p")).select("p.doc_id", "p.text_hash", F.lit(True).alias("_stays"))
    judged = found.select("doc_id", "text_hash").distinct().join(chosen, ["doc_id", "text_hash"], "left")
    rows = docs.select(*keep, F.xxhash64("text").alias("text_hash"))
    rows = rows.join(judged.withColumn("_judged", F.lit(True)), ["doc_id", "text_hash"], "left").where("_judged is null or _stays")
    others = [F.col(c) for c in keep if c not in ("doc_id", "text")]
    order = Window.partitionBy("doc_id", "text_hash").orderBy(*(others or [F.lit(0)]))
    first = rows.where("_judged").withColumn("_place", F.row_number().over(order)).where("_place = 1")
    return first.select(*keep).unionByName(rows.where("_judged is null").select(*keep))
