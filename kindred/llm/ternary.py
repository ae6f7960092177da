"""A ternary search tree over sequences of turn ids, and what is summed up over its subtrees."""

from collections import deque
from hashlib import blake2b


def median_order(n):
    """Places 0 to n - 1, the middle of every stretch before its halves."""
    waiting = deque([(0, n)])
    while waiting:
        low, high = waiting.popleft()
        if low < high:
            middle = (low + high) // 2
            yield middle
            waiting.append((low, middle))
            waiting.append((middle + 1, high))


def path_keys(turns):
    """A 128-bit key of each prefix of a path, the empty one first."""
    state = blake2b(digest_size=16)
    keys = [state.digest()]
    for turn in turns:
        state.update(turn.to_bytes(8, "little"))
        keys.append(state.digest())
    return keys


class Path:
    """A sequence with what is known of its prefixes from `start` turns on, one entry a prefix."""

    __slots__ = ("turns", "chars", "start", "n", "first", "kids", "leaves", "saved", "ends")

    def __init__(self, turns, chars, start, n, first, kids, leaves, saved, ends):
        self.turns, self.chars, self.start = turns, chars, start
        self.n, self.first, self.kids, self.leaves, self.saved, self.ends = n, first, kids, leaves, saved, ends

    @classmethod
    def of_sequence(cls, turns, chars, n, first, ends):
        """A sequence that `n` members have, the smallest of them `first`."""
        size = len(turns) + 1
        zero = [0] * size
        return cls(turns, chars, 0, [n] * size, [first] * size, zero, zero, zero, [None] * (size - 1) + [ends])


class TernaryTree:
    """Node 0 is the root. `low`, `high`: neighbours among the children of one node; `under`: a node's own children."""

    def __init__(self):
        self.turn, self.low, self.high, self.under, self.parent, self.depth, self.chars = [], [], [], [], [], [], []
        self.n, self.first, self.kids, self.leaves, self.saved, self.ends, self.key = [], [], [], [], [], [], []
        self._node(-1, -1, 0)

    def _node(self, turn, parent, chars):
        for column, value in (
            (self.turn, turn), (self.low, 0), (self.high, 0), (self.under, 0), (self.parent, parent), (self.chars, chars),
            (self.depth, self.depth[parent] + 1 if parent >= 0 else 0), (self.n, 0), (self.first, None), (self.kids, 0),
            (self.leaves, 0), (self.saved, 0), (self.ends, None), (self.key, None),
        ):
            column.append(value)
        return len(self.turn) - 1

    def child(self, node, turn, chars):
        """The child of `node` for `turn`, made if it is new."""
        at = self.under[node]
        if not at:
            self.under[node] = found = self._node(turn, node, chars)
            return found
        while turn != self.turn[at]:
            side = self.low if turn < self.turn[at] else self.high
            if not side[at]:
                found = side[at] = self._node(turn, node, chars)
                return found
            at = side[at]
        return at

    def walk(self, path):
        """The nodes of a path, the root first."""
        nodes = [0]
        for turn, chars in zip(path.turns, path.chars):
            nodes.append(self.child(nodes[-1], turn, chars))
        return nodes

    def add(self, path, keyed=False):
        """Take in a path; gives its nodes."""
        nodes = self.walk(path)
        for node, n, first, kids, leaves, saved, ends in zip(
            nodes[path.start :], path.n, path.first, path.kids, path.leaves, path.saved, path.ends
        ):
            self.n[node] += n
            self.first[node] = first if self.first[node] is None else min(self.first[node], first)
            self.kids[node] += kids
            self.leaves[node] += leaves
            self.saved[node] += saved
            if ends is not None:
                self.ends[node] = ends
        if keyed:
            for node, key in zip(nodes, path_keys(path.turns)):
                self.key[node] = key
        return nodes

    def settle(self, still_open):
        """Yield the nodes that are complete, children before parents, and add each to its parent.

        A node is made before its children, so going back through the nodes meets children
        first, without recursion. Nodes of `still_open` are left with what their complete
        children add.
        """
        for node in range(len(self.turn) - 1, -1, -1):
            if node in still_open:
                continue
            if not self.kids[node]:
                self.leaves[node] = 1
            self.saved[node] += (self.n[node] - 1) * self.chars[node]
            yield node
            if (parent := self.parent[node]) >= 0:
                self.kids[parent] += 1
                self.leaves[parent] += self.leaves[node]
                self.saved[parent] += self.saved[node]

    def path(self, path, nodes, start):
        """What is known by now of a path's nodes, from `start` turns on."""
        some = nodes[start:]
        columns = (self.n, self.first, self.kids, self.leaves, self.saved, self.ends)
        return Path(path.turns, path.chars, start, *([column[i] for i in some] for column in columns))
