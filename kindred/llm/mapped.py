"""Sorted arrays in the shared folder, which workers map into memory, and how tasks fill them.

A table is split into shards by the highest bits of its keys, which are hashes. Tasks sum
up what they gather and send sorted stretches to the shards; a shard is one sorted array
of keys with arrays of values beside it in one file. Lookups take sorted batches of keys, so that each
page of a shard is touched once a batch.
"""

import json
import mmap
import os
import resource
import sys
import uuid
from collections import OrderedDict
from urllib.parse import urlparse

import numpy as np

# Entries a task gathers before it sends them on.
GATHERED = 6_000_000
# Arrays in a shard file begin at multiples of this many bytes.
ALIGNED = 64
# Where Python can, a mapping holds no open file.
_WITHOUT_FILE = {"trackfd": False} if sys.version_info >= (3, 13) else {}
# Shard files a table keeps mapped in one process; the system allows some 65,000 mappings.
MAPPED = 16_384 if _WITHOUT_FILE else max(resource.getrlimit(resource.RLIMIT_NOFILE)[0] // 8, 8)
COUNT_TYPES = (np.uint8, np.uint16, np.uint32, np.int64)


def mapped_folder(uri):
    """Path of a folder in the shared file system; workers must be able to map its files."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{uri}: the model needs a shared folder that is mounted on all workers (file:)")
    return parts.path


def write_shard(folder, name, arrays):
    """Store the arrays of one shard, given by name, as one file; a task that is tried again replaces it in one step."""
    os.makedirs(folder, exist_ok=True)
    own = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    header = json.dumps([[n, v.dtype.str, len(v)] for n, v in arrays.items()]).encode()
    with open(own, "wb") as out:
        out.write(len(header).to_bytes(8, "little") + header)
        for values in arrays.values():
            out.write(bytes(-out.tell() % ALIGNED))
            out.write(np.ascontiguousarray(values).data)
        out.write(bytes(ALIGNED))
    os.replace(own, os.path.join(folder, f"{name}.shard"))


class Maps:
    """Shard files of a folder, mapped when asked for; of more than MAPPED the one used longest ago is let go."""

    def __init__(self, folder):
        self.folder, self.held = folder, OrderedDict()

    def __reduce__(self):
        return Maps, (self.folder,)

    def arrays(self, name):
        """The arrays of a shard by name, or None if there is no such file: the shard is empty."""
        if name in self.held:
            self.held.move_to_end(name)
            return self.held[name]
        try:
            with open(os.path.join(self.folder, f"{name}.shard"), "rb") as file:
                data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, **_WITHOUT_FILE)
        except FileNotFoundError:
            data = None
        self.held[name] = None if data is None else _split(data)
        while len(self.held) > MAPPED:
            self.held.popitem(last=False)  # unmapped with its last array
        return self.held[name]


def _split(data):
    at = 8 + int.from_bytes(data[:8], "little")
    result = {}
    for name, kind, n in json.loads(data[8:at]):
        at += -at % ALIGNED
        result[name] = np.ndarray(n, dtype=kind, buffer=data, offset=at)
        at += result[name].nbytes
    return result


def packed(values):
    """An array of whole numbers as bytes, in the narrowest type that holds them, its name first."""
    low, top = (int(values.min()), int(values.max())) if len(values) else (0, 0)
    kind = next(k for k in COUNT_TYPES if np.iinfo(k).min <= low and top <= np.iinfo(k).max)
    return np.dtype(kind).str.encode().ljust(4) + values.astype(kind).tobytes()


def unpacked(data):
    return np.frombuffer(data, dtype=np.dtype(data[:4].decode().strip()), offset=4)


def summed(keys, counts):
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


class Gathering:
    """Keys with counts, summed up in a task."""

    def __init__(self):
        self.keys, self.counts, self.held = [], [], 0

    def add(self, keys):
        distinct, counts = np.unique(keys, return_counts=True)
        self.keys.append(distinct)
        self.counts.append(counts)
        self.held += len(distinct)

    def take(self):
        keys, counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        if self.keys:
            keys, counts = summed(np.concatenate(self.keys), np.concatenate(self.counts))
        self.keys, self.counts, self.held = [], [], 0
        return keys, counts


def edges_of(keys, bits):
    """Where the shards begin in sorted keys; one entry more than shards."""
    bounds = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]]).astype(np.int64)


def find(table, keys):
    """Places of sorted keys in a sorted array, -1 where they are not."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def shard_bits(chars, shard_chars):
    """Bits that give shards for about `shard_chars` characters of text each."""
    return max(0, int(np.ceil(np.log2(max(chars / shard_chars, 1)))))


class Shards:
    """A table of keys and values, looked up by keys in any order."""

    def __init__(self, folder, bits, kinds):
        """kinds: names of the arrays, the keys first, which also name the files; shards without a file are empty."""
        self.folder, self.bits, self.kinds = folder, bits, kinds
        self.maps = Maps(folder)

    def look_up(self, keys):
        """`(found, values)`: which keys there are, and their values, one array a kind beyond the first."""
        distinct, which = np.unique(keys, return_inverse=True)
        found = np.zeros(len(distinct), dtype=bool)
        values = [np.zeros(len(distinct), dtype=np.int64) for _ in self.kinds[1:]]
        edges = edges_of(distinct, self.bits)
        for i in np.flatnonzero(np.diff(edges)):
            if (arrays := self.maps.arrays(f"{self.kinds[0]}-{i}")) is None:
                continue
            shard = [arrays[kind] for kind in self.kinds]
            at = find(shard[0], distinct[edges[i] : edges[i + 1]])
            hit = np.flatnonzero(at >= 0)
            found[edges[i] + hit] = True
            for result, column in zip(values, shard[1:]):
                result[edges[i] + hit] = column[at[hit]]
        return found[which], [v[which] for v in values]
