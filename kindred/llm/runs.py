"""Sorted counts as zstd runs: numbers delta coded in byte planes, and a k-way merge that reads them frame by frame."""

import heapq
import struct

import numpy as np
import zstandard

from kindred.llm.mapped import summed

# Entries of one frame: what a merge holds of each run.
FRAME = 16_384
_HEAD = struct.Struct("<III")


def _planes(values):
    """Bytes of 64-bit values by place, so that their zero bytes stand together."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _values(data):
    return np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def write_numbers(values, level=3):
    """An array of whole numbers from 0 on, compressed."""
    return zstandard.ZstdCompressor(level=level).compress(_planes(values)) if len(values) else b""


def read_numbers(data):
    return _values(zstandard.ZstdDecompressor().decompress(data)) if data else np.zeros(0, dtype=np.uint64)


def write_run(keys, counts, frame=FRAME):
    """A run of sorted distinct keys with their counts."""
    parts = []
    for at in range(0, len(keys), frame):
        some = keys[at : at + frame].astype(np.uint64)
        steps, sizes = write_numbers(np.diff(some, prepend=np.uint64(0))), write_numbers(counts[at : at + frame])
        parts += [_HEAD.pack(len(some), len(steps), len(sizes)), steps, sizes]
    return b"".join(parts)


def read_run(data):
    """Yield the frames `(keys, counts)` of a run."""
    at = 0
    while at < len(data):
        _, steps, sizes = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        yield np.cumsum(read_numbers(data[at : at + steps]), dtype=np.uint64), read_numbers(data[at + steps : at + steps + sizes])
        at += steps + sizes


def merged(runs):
    """Yield `(keys, counts)` in order over several runs, the counts of equal keys added up.

    A heap of frame ends tells how far all runs can be taken at once, so one frame of each
    is in memory.
    """
    readers = [read_run(run) for run in runs]
    held, ends = {}, []

    def refill(i):
        frame = next(readers[i], None)
        if frame is None:
            held.pop(i, None)
        else:
            held[i] = frame
            heapq.heappush(ends, (int(frame[0][-1]), i))

    for i in range(len(readers)):
        refill(i)
    while ends:
        last = ends[0][0]
        taken = []
        for i, (keys, counts) in held.items():
            cut = int(np.searchsorted(keys, np.uint64(last), side="right"))
            taken.append((keys[:cut], counts[:cut]))
            held[i] = keys[cut:], counts[cut:]
        while ends and ends[0][0] == last:
            refill(heapq.heappop(ends)[1])
        yield summed(*(np.concatenate(column) for column in zip(*taken)))


def merge_runs(runs):
    """One run out of several."""
    return b"".join(write_run(keys, counts) for keys, counts in merged(runs))
