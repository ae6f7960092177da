"""Prefix trie of conversations: who shares which first turns, and what that saves.

Turns become ids of a dictionary. Equal sequences become one, with the digest of all their
conversations. The distinct sequences are dealt out by ranges and cut into shards; each
shard is a ternary search tree, into which its sorted sequences go median first. A walk
back through the nodes sums up members, leaves and savings. Only nodes on the first and
the last path of a shard can go on in another one: these boundary paths are merged some
shards at a time until one group is left.
"""

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from kindred.llm.ternary import Path, TernaryTree, median_order, path_keys
from kindred.llm.words import worker_state
from kindred.operators.index import dense_index
from kindred.storage import materialize, materialize_observed

# A conversation takes fewer than so many turns from the first one of its block of ids.
HEAD_TURNS = 6
BLOCK = 100
# Turns of distinct sequences in one shard.
SHARD_TURNS = 100_000
# Tasks whose boundary paths are merged at once.
FAN_IN = 64
NOTHING = sha256(b"").hexdigest()

_NODE = [
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
]
_KEYS = [("key", pa.binary()), ("parent_key", pa.binary())]
_LONGS = pa.list_(pa.int64())
_PATH = [
    ("task", pa.int64()), ("shard", pa.int64()), ("last", pa.bool_()), ("start", pa.int64()), ("turns", _LONGS), ("chars", _LONGS),
    *((c, _LONGS) for c in ("n", "first", "kids", "leaves", "saved")), ("ends", pa.list_(pa.string())),
]
_ROWS = pa.schema(_NODE + _KEYS + _PATH)
_SQL_NAMES = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary", pa.bool_(): "boolean", _LONGS: "array<bigint>"}
_DDL = ", ".join(f"`{f.name}` {_SQL_NAMES.get(f.type, 'array<string>')}" for f in _ROWS)
_CHUNK = "s1 bigint, s2 bigint, first bigint, n bigint, ids string, turns array<bigint>, chars array<bigint>"
_SEQUENCE = "turns array<bigint>, chars array<bigint>, n bigint, first bigint, ends string"


def encoded_turns(conversations):
    """`(conv_id, turns, chars)`: of each conversation the dictionary ids of its turns, in order, and their code points.

    Turns are ordered by `turn`, null first, then by role and text. A null role or text is
    empty; rows without a `conv_id` belong to no conversation. Equal 128-bit hashes are
    taken for equal turns. Runs Spark jobs.
    """
    rows = conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("bigint").alias("conv_id"),
        conversations["turn"].alias("turn"),
        *(F.coalesce(conversations[c], F.lit("")).alias(c) for c in ("role", "text")),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    word = F.struct(F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("second"), "text", "role").alias("h2"))
    placed = rows.select("conv_id", F.row_number().over(order).alias("pos"), word.alias("word"), F.char_length("text").cast("bigint").alias("chars"))
    placed = materialize(placed, "turns")
    ids = dense_index(placed, "word").withColumnRenamed("id", "word")
    listed = placed.join(ids, "word").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "idx", "chars"))).alias("t"))
    return listed.select("conv_id", F.expr("transform(t, x -> x.idx)").alias("turns"), F.expr("transform(t, x -> x.chars)").alias("chars"))


def with_shared_heads(encoded, block=BLOCK, head_turns=HEAD_TURNS):
    """Conversations whose first h turns are those of the first conversation of their block of ids.

    h is the crc32 of the decimal id modulo `head_turns`; conversation c takes them from
    `c - c % block` (the remainder has the sign of c), none if there is no such one, and
    keeps its own turns behind its first h.
    """
    encoded = materialize(encoded, "encoded-turns")
    heads = encoded.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), *(F.slice(c, 1, head_turns - 1).alias(f"head_{c}") for c in ("turns", "chars"))
    )
    size = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(head_turns)).cast("int")
    joined = encoded.withColumns({"base": F.col("conv_id") - F.col("conv_id") % block, "h": size}).join(heads, "base", "left")
    none = F.array().cast("array<bigint>")
    parts = [
        F.concat(F.slice(F.coalesce(f"head_{c}", none), F.lit(1), F.col("h")), F.slice(c, F.col("h") + 1, F.size(c))).alias(c)
        for c in ("turns", "chars")
    ]
    return joined.select("conv_id", *parts)


def distinct_sequences(encoded):
    """`(turns, chars, n, first, ends)`: each sequence once, with its number of conversations, the smallest, and their digest.

    The digest is over all ids in order. Sequences and ids are dealt out and sorted
    together, so the ids of a common sequence are written out by many tasks; what is put
    through one digest are the written stretches, one after another.
    """
    rows = encoded.select("conv_id", "turns", "chars", F.xxhash64("turns").alias("s1"), F.xxhash64(F.lit("second"), "turns").alias("s2"))
    rows = materialize(rows, "sequences")
    parts = int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write_out(batches):
        worker_state()
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("s1", "s2")])
            begin = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
            stop = np.append(begin[1:], batch.num_rows)
            written = pc.cast(batch.column("conv_id"), pa.string()).to_pylist()
            ids = pa.array([",".join(written[a:b]) for a, b in zip(begin.tolist(), stop.tolist())], pa.string())
            first = batch.take(pa.array(begin))
            columns = [first.column("s1"), first.column("s2"), first.column("conv_id"), pa.array(stop - begin), ids]
            yield pa.RecordBatch.from_arrays([*columns, first.column("turns"), first.column("chars")], ["s1", "s2", "first", "n", "ids", "turns", "chars"])

    def digest(batches):
        worker_state()
        key, held = None, None
        done = []

        def finished(least):
            nonlocal done
            if len(done) < least:
                return []
            rows, done = done, []
            return [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["turns", "chars", "n", "first", "ends"])]

        kinds = [_LONGS, _LONGS, pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            for row in batch.to_pylist():
                if key != (row["s1"], row["s2"]):
                    if held:
                        done.append((*held[:4], held[4].hexdigest()))
                    key, held = (row["s1"], row["s2"]), [row["turns"], row["chars"], 0, row["first"], sha256()]
                else:
                    held[4].update(b",")
                held[2] += row["n"]
                held[4].update(row["ids"].encode())
            yield from finished(1_000)
        if held:
            done.append((*held[:4], held[4].hexdigest()))
        yield from finished(1)

    whole = ["s1", "s2", "conv_id"]
    chunks = rows.repartitionByRange(parts, *whole).sortWithinPartitions(*whole).mapInArrow(write_out, _CHUNK)
    return chunks.repartition(parts, "s1", "s2").sortWithinPartitions("s1", "s2", "first").mapInArrow(digest, _SEQUENCE)


def _tree_rows(paths, place, keyed, top):
    """Rows of one tree: its complete nodes, and its first and last path unless it is the `top` one."""
    tree = TernaryTree()
    for i in median_order(len(paths)):
        tree.add(paths[i], keyed)
    open_nodes, ends = {}, []
    if not top:
        for path in (paths[0], paths[-1]):
            nodes = tree.walk(path)
            ends.append((path, nodes))
            open_nodes.update(zip(nodes, path_keys(path.turns)))
    for node in tree.settle(open_nodes):
        parent = tree.parent[node]
        yield {
            "conv_id": tree.first[node], "depth": tree.depth[node], "n_convs": tree.n[node], "n_children": tree.kids[node],
            "parent_conv_id": tree.first[parent] if parent >= 0 and parent not in open_nodes else None,
            "n_leaves": tree.leaves[node], "saved_tokens": tree.saved[node], "ends_sha256": tree.ends[node] or NOTHING,
            "key": tree.key[node], "parent_key": open_nodes.get(parent),
        }
    for last, (path, nodes) in enumerate(ends):
        # Prefixes that both paths share are told by the first one.
        start = sum(a == b for a, b in zip(nodes, ends[0][1])) if last else 0
        known = tree.path(path, nodes, start)
        told = (known.n, known.first, known.kids, known.leaves, known.saved, known.ends)
        yield dict(zip((c for c, _ in _PATH), (*place, bool(last), start, path.turns, path.chars, *told)))


def _batches_of(rows, size=10_000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, _ROWS)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, _ROWS)


def _shards(sequences, turns, shard_turns):
    """Rows of the trees of all shards."""
    parts = max(int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))

    def work(batches):
        worker_state()
        task, shard, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(Path.of_sequence(row["turns"], row["chars"], row["n"], row["first"], row["ends"]))
                size += len(row["turns"]) + 1
                if size >= shard_turns:
                    yield from _batches_of(_tree_rows(held, (task, shard), False, False))
                    shard, held, size = shard + 1, [], 0
        if held:
            yield from _batches_of(_tree_rows(held, (task, shard), False, False))

    return sequences.repartitionByRange(parts, "turns").sortWithinPartitions("turns").mapInArrow(work, _DDL)


def _merged(paths, tasks, fan_in):
    """Rows of the trees that the boundary paths of `fan_in` neighbouring tasks make."""
    top = tasks <= fan_in

    def work(key, table):
        worker_state()
        rows = sorted(table.to_pylist(), key=lambda r: (r["task"], r["shard"], r["last"]))
        names = ("turns", "chars", "start", "n", "first", "kids", "leaves", "saved", "ends")
        found = [Path(*(row[c] for c in names)) for row in rows]
        return pa.Table.from_batches(_batches_of(_tree_rows(found, (key[0].as_py(), 0), True, top)), _ROWS)

    group = F.floor(F.col("task") / fan_in).cast("bigint").alias("group")
    return paths.select(*(c for c, _ in _PATH), group).groupBy("group").applyInArrow(work, _DDL)


def prefix_trie(encoded, shard_turns=SHARD_TURNS, fan_in=FAN_IN):
    """A row for each distinct sequence of first turns, from the empty one (depth 0).

    `encoded` has rows `(conv_id, turns, chars)`, one a conversation; its prefixes are
    nodes, and conversations that begin with a node are its members. `conv_id`: smallest
    member; `depth`; `parent_conv_id`: that of the node one turn shorter, null at the root;
    `n_convs` members; `n_children`; `n_leaves`: childless nodes of its subtree;
    `saved_tokens`: over the subtree, members beyond one times the code points of the last
    turn; `ends_sha256`: SHA-256 of the ids, ascending and joined by commas, of the
    members that have no further turn.

    A conversation without turns is a member of the root alone. An empty table gives no
    rows. The turns of one conversation meet in one row, as ids. Runs Spark jobs.
    """
    sequences, seen = materialize_observed(
        distinct_sequences(encoded), "distinct-sequences", turns=F.sum(F.size("turns").cast("bigint") + 1)
    )
    rows = materialize(_shards(sequences, seen["turns"] or 0, shard_turns), "shard-nodes")
    nodes, boundary = rows.where("depth is not null"), None
    paths = rows.where("depth is null")
    tasks = (paths.agg(F.max("task")).first()[0] or 0) + 1
    while True:
        rows = materialize(_merged(paths, tasks, fan_in), "boundary-nodes")
        found = rows.where("depth is not null")
        boundary = found if boundary is None else boundary.unionByName(found)
        if tasks <= fan_in:
            break
        paths, tasks = rows.where("depth is null"), -(-tasks // fan_in)
    order = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    every = nodes.unionByName(boundary).select(*order, "parent_key")
    # Children of a boundary node learn its smallest member once that is known.
    parents = boundary.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("known"))
    waiting = every.where("parent_key is not null").join(parents, "parent_key").withColumn("parent_conv_id", F.col("known"))
    return every.where("parent_key is null").select(*order).unionByName(waiting.select(*order))


def rebuilt_trie(conversations):
    """The trie of the conversations after each has taken its head from the first of its block."""
    return prefix_trie(with_shared_heads(encoded_turns(conversations)))


SQL = r"""
WITH RECURSIVE numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
-- crc32 of the decimal id, bit by bit
bytes AS (
  SELECT conv_id, [ord(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')] AS codes
  FROM (SELECT DISTINCT conv_id FROM numbered)),
crc AS (
  SELECT conv_id, codes, 1 AS spot, 0 AS bit, xor(4294967295, codes[1]) AS state FROM bytes
  UNION ALL
  SELECT conv_id, codes, CASE WHEN bit = 7 THEN spot + 1 ELSE spot END, (bit + 1) % 8,
         CASE WHEN bit = 7 AND spot < len(codes)
              THEN xor(xor(state >> 1, CASE WHEN state % 2 = 1 THEN 3988292384 ELSE 0 END), codes[spot + 1])
              ELSE xor(state >> 1, CASE WHEN state % 2 = 1 THEN 3988292384 ELSE 0 END) END
  FROM crc WHERE spot <= len(codes)),
heads AS (SELECT conv_id, xor(state, 4294967295) % 6 AS h FROM crc WHERE spot > len(codes)),
taken AS (
  SELECT h.conv_id, n.pos, n.role, n.text
  FROM heads h JOIN numbered n ON n.conv_id = h.conv_id - h.conv_id % 100 AND n.pos <= h.h
  UNION ALL
  SELECT n.conv_id, n.pos, n.role, n.text FROM numbered n JOIN heads h ON n.conv_id = h.conv_id AND n.pos > h.h),
lists AS (
  SELECT h.conv_id,
         coalesce(list({'role': t.role, 'text': t.text} ORDER BY t.pos) FILTER (WHERE t.pos IS NOT NULL), []) AS turns
  FROM heads h LEFT JOIN taken t ON t.conv_id = h.conv_id GROUP BY h.conv_id),
prefixes AS (
  SELECT conv_id, len(turns) AS size, depth, turns[1:depth] AS prefix
  FROM lists, unnest(range(0, len(turns) + 1)) AS d(depth)),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256,
         (count(*) - 1) * coalesce(length(prefix[depth].text), 0) AS own
  FROM prefixes GROUP BY prefix, depth),
kids AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (prefix)),
below AS (
  SELECT prefix[1:d] AS prefix, sum(own) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM full_nodes, unnest(range(0, depth + 1)) AS u(d) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below b ON n.prefix = b.prefix
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]"""
