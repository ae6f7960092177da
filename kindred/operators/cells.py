"""Pairs of blocks that tasks read where they were written.

A list that travels to each cell of its block is copied as often as there are blocks on the
other side, so copies grow with the square of the rows. Here a block is written once, as one
value, and each task reads the pairs of blocks it compares: nothing is shuffled for a cell.
"""

import pyarrow as pa
from pyspark.sql import functions as F

from kindred.session import reachable
from kindred.storage import materialize

# Bytes of written blocks that a task holds of one side.
HELD_BYTES = 64 << 20


def written_blocks(rows, blocks, label):
    """`(k, b)`, written: the rows of each block `k` below `blocks` as a stream of Arrow, in the order of their ids `e`."""
    reachable(rows.sparkSession)

    def pack(batches):
        held = [batch for batch in batches if batch.num_rows]
        if held:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                for batch in held:
                    stream.write_batch(batch)
            yield pa.RecordBatch.from_arrays([held[0]["k"][:1], pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["k", "b"])

    dealt = rows.repartitionById(blocks, F.col("k")).sortWithinPartitions("e")
    return materialize(dealt.mapInArrow(pack, "k int, b binary"), label)


def _unpacked(value):
    return pa.ipc.open_stream(value.as_buffer()).read_all().combine_chunks()


def compared(left, right, meet, compare, schema, right_tasks=None):
    """What `compare` yields of the pairs of blocks `(k, b)` of both sides for which `meet` holds of `k_1` and `k_2`.

    `compare` gets `(k_1, left table, k_2, right table)` of each, all pairs of a left block in a row. With
    `right_tasks`, each left block meets the right ones in so many tasks.
    """
    if right_tasks:
        right = right.coalesce(right_tasks)
    first, second = left.select(F.col("k").alias("k_1"), F.col("b").alias("b_1")), right.select(F.col("k").alias("k_2"), F.col("b").alias("b_2"))
    cells = first.hint("shuffle_replicate_nl").join(second, meet).select("k_1", "b_1", "k_2", "b_2")

    def tables(batches):
        number, table = None, None
        for batch in batches:
            for k_1, b_1, k_2, b_2 in zip(*batch.columns):
                if k_1.as_py() != number:
                    number, table = k_1.as_py(), _unpacked(b_1)
                yield number, table, k_2.as_py(), _unpacked(b_2)

    return cells.mapInArrow(lambda batches: compare(tables(batches)), schema)
