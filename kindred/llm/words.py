"""Words of whole texts as numpy arrays: places, hashes and n-gram hashes.

A word is a run of bytes other than blank and \\x09-\\x0D. Hashes are 64 bits wide; equal
words have equal hashes in every task and run. Operators whose result must not rest on a
hash compare the words themselves afterwards.
"""

import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

# Texts are worked on in pieces of about this many bytes, so that memory does not grow
# with the batch. A longer text is a piece of its own.
PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse
_WORD_BASE = np.uint64(0xD1B54A32D192ED03)
_POWERS = {}
_STATE = {}
_SEEN = {}


def _give_back():
    """Return what earlier tasks left free in this process: a worker's heap else only grows."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def worker_state(owner=None, make=None):
    """What `owner` keeps in this worker process from task to task, made at first.

    A worker serves many operators one after another; only the last of them keeps
    anything, so that their caches do not add up. Every step calls this first; without an
    owner all is let go. Memory is given back once a task at most.
    """
    context = TaskContext.get()
    task = context.taskAttemptId() if context else None
    changed = _STATE.get("owner") != owner
    if changed:
        _STATE.clear()
    if (changed or owner is None) and _SEEN.get("task") != task:
        _SEEN["task"] = task
        _give_back()
    if changed and owner is not None:
        _STATE.update(owner=owner, state=make())
    return _STATE.get("state")


def _power_rows(base, n):
    rows = []
    for factor in (base, np.uint64(pow(int(base), -1, 1 << 64))):
        row = np.full(n, factor, dtype=np.uint64)
        row[0] = 1
        rows.append(np.multiply.accumulate(row))
    return rows


def _powers(base, n):
    """Powers of `base` and of its inverse modulo 2**64, `n` of each; those of a longer text are not kept."""
    if n > PIECE_BYTES + 1:
        return _power_rows(base, n)
    if int(base) not in _POWERS:
        _POWERS[int(base)] = _power_rows(base, PIECE_BYTES + 1)
    up, down = _POWERS[int(base)]
    return up[:n], down[:n]


def mix(x):
    """Spread 64-bit values over all 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_pieces(column, piece_bytes=PIECE_BYTES):
    """Yield `(first row, data, bounds)` for stretches of an Arrow string column.

    `data` holds the bytes of the rows one after another, row i from bounds[i] to
    bounds[i + 1]; a null row is empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        data = np.zeros(0, dtype=np.uint8)
    else:
        data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + piece_bytes, side="right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


class Words:
    """Words of the rows of one piece.

    starts, ends: byte places; row: the row of each word; first: for each row the number
    of its first word, and one entry more; hashes: one for each word.
    """

    def __init__(self, data, bounds, lower=False):
        self.data, self.bounds = data, bounds
        solid = ~_SPACE[data]
        left, right = solid.copy(), solid.copy()
        if len(data):
            left[1:] &= ~solid[:-1]
            right[:-1] &= ~solid[1:]
            inner = bounds[1:-1]
            inner = inner[(inner > 0) & (inner < len(data))]
            left[inner] = solid[inner]  # rows lie next to each other without a blank
            right[inner - 1] = solid[inner - 1]
        self.starts = np.flatnonzero(left)
        self.ends = np.flatnonzero(right) + 1
        self.first = np.searchsorted(self.starts, bounds)
        self.counts = np.diff(self.first)
        values = mix((_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(0x1F3))
        up, down = _powers(_BYTE_BASE, len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values * up[:-1], out=total[1:])
        length = (self.ends - self.starts).astype(np.uint64)
        self.hashes = mix((total[self.ends] - total[self.starts]) * down[self.starts] + length)

    def __len__(self):
        return len(self.starts)

    @property
    def row(self):
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def text(self, i):
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def gram_hashes(hashes, n):
    """Hash of `n` consecutive entries from each place on; entry i covers i to i + n - 1."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(_WORD_BASE, len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:-1], out=total[1:])
    return mix((total[n:] - total[:size]) * down[:size])


def within_rows(counts, n):
    """Places at which `n` consecutive words lie in one row, for rows of `counts` words."""
    first = np.cumsum(counts) - counts
    fits = np.maximum(counts - n + 1, 0)
    total = int(fits.sum())
    return np.repeat(first - (np.cumsum(fits) - fits), fits) + np.arange(total)


def sliding_argmin(values, width):
    """For each window of `width` entries the place of its smallest, the first one of equals."""
    size = len(values) - width + 1
    if size <= 0:
        return np.zeros(0, dtype=np.int64)
    best, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        a, b = best[:-step], best[step:]
        best = np.where(values[b] < values[a], b, a)
        span += step
    return best[:size]
