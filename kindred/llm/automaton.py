"""A suffix automaton over sequences of whole numbers."""


class SuffixAutomaton:
    """Accepts every stretch of the sequences it was given, and nothing that spans two of them."""

    def __init__(self):
        self.steps, self.link, self.length = [{}], [-1], [0]

    def _state(self, length, steps, link):
        self.steps.append(steps)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, source, token, target):
        """A copy of `target` for the shorter stretches that reach it from `source`."""
        if self.length[source] + 1 == self.length[target]:
            return target
        copy = self._state(self.length[source] + 1, dict(self.steps[target]), self.link[target])
        while source >= 0 and self.steps[source].get(token) == target:
            self.steps[source][token] = copy
            source = self.link[source]
        self.link[target] = copy
        return copy

    def add(self, sequence):
        """Take in one sequence."""
        steps, link, length = self.steps, self.link, self.length
        last = 0
        for token in sequence:
            target = steps[last].get(token)
            if target is not None:  # known from an earlier sequence
                last = self._split(last, token, target)
                continue
            state, source = self._state(length[last] + 1, {}, 0), last
            while source >= 0 and token not in steps[source]:
                steps[source][token] = state
                source = link[source]
            if source >= 0:
                link[state] = self._split(source, token, steps[source][token])
            last = state

    def matching(self, sequence):
        """For each place of a sequence, the length of the longest known stretch that ends there."""
        steps, link, length = self.steps, self.link, self.length
        state, size, result = 0, 0, []
        for token in sequence:
            target = steps[state].get(token)
            while target is None and state:
                state = link[state]
                size = length[state]
                target = steps[state].get(token)
            if target is None:
                size = 0
            else:
                state, size = target, size + 1
            result.append(size)
        return result
