"""A run-length compressed index of a small collection of strings of bytes or other numbers.

The Burrows-Wheeler transform of the collection is kept as runs of equal symbols with the suffix
positions at both ends of each run.  In repetitive collections the runs are few.  How far the text
from a position on matches somewhere else (its matching statistic) needs to be looked up at the run
ends only: inside a run the two neighbours of a suffix are also neighbours one symbol earlier, so
the statistic of the next position is one less.
"""

import numpy as np

def _packed(symbols):
    """The next symbols of each position as one number, and how many these are; behind the end comes -1."""
    n = len(symbols)
    bits = int(symbols.max()).bit_length()
    depth = 63 // bits
    padded = np.concatenate([symbols, np.zeros(depth, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(depth):
        key <<= bits
        key |= padded[i:i + n]
    return np.append(key, -1), depth


def suffix_array(packed, depth):
    """Positions in the order of their suffixes, by prefix doubling over the groups still tied.

    No two suffixes are equal, so sorts need not be stable.
    """
    n = len(packed) - 1
    order = np.argsort(packed[:n])
    values = packed[order]
    head = np.ones(n, dtype=bool)
    head[1:] = values[1:] != values[:-1]
    rank = np.empty(n + 1, dtype=np.int64)
    first = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[order] = first
    rank[n] = -1
    tied = ~head
    tied[:-1] |= tied[1:]
    slots = np.flatnonzero(tied)
    while len(slots):
        at = order[slots]
        key = rank[at] * (n + 1) + rank[np.minimum(at + depth, n)] + 1
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[slots] = at
        head = np.ones(len(slots), dtype=bool)
        head[1:] = key[1:] != key[:-1]
        first = np.maximum.accumulate(np.where(head, np.arange(len(slots)), 0))
        rank[at] = slots[first]
        tied = ~head
        tied[:-1] |= tied[1:]
        slots = slots[tied]
        depth *= 2
    return order


def common_length(packed, depth, symbols, a, b):
    """Length of the common prefix of the suffixes at each pair of positions."""
    n = len(symbols)
    length = np.zeros(len(a), dtype=np.int64)
    live = np.arange(len(a))
    while len(live):  # whole packs
        same = packed[np.minimum(a[live] + length[live], n)] == packed[np.minimum(b[live] + length[live], n)]
        live = live[same]
        length[live] += depth
    tail = np.append(symbols, -1)
    live = np.arange(len(a))
    for _ in range(depth):  # then single symbols
        same = tail[np.minimum(a[live] + length[live], n)] == tail[np.minimum(b[live] + length[live], n)]
        live = live[same]
        length[live] += 1
    return length


class RunIndex:
    """Runs of the transform of strings that are each followed by an end mark."""

    def __init__(self, strings):
        strings = [np.frombuffer(s, dtype=np.uint8) if isinstance(s, bytes) else s for s in strings]
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        values = np.concatenate(strings)
        if values.dtype != np.uint8:  # numbers of any size get small names
            values = np.unique(values, return_inverse=True)[1]
        data = np.ones(len(values) + len(strings), dtype=np.int64)  # end marks; 0 stands behind the last one
        own = np.ones(len(data), dtype=bool)
        own[self.starts + sizes] = False
        data[own] = values.astype(np.int64) + 2
        self.symbols, self.sizes = data, sizes
        packed, depth = _packed(data)
        order = suffix_array(packed, depth)
        before = data[order - 1]
        before[order == 0] = -1  # nothing stands before the first position
        head = np.ones(len(order), dtype=bool)
        head[1:] = before[1:] != before[:-1]
        at = np.flatnonzero(head)
        # The compressed index: a symbol and a length for each run, and samples at its ends.
        self.run_symbol = before[at]
        self.run_length = np.diff(np.append(at, len(order)))
        self.run_first = order[at]
        self.run_last = order[np.append(at[1:], len(order)) - 1]
        # How far the first suffix of a run agrees with the last one of the run before.
        self.agree = np.concatenate([[0], common_length(
            packed, depth, data, self.run_first[1:], self.run_last[:-1])])

    def statistics(self):
        """For each position, the longest match of the text from there with any other position.

        Streams over the text: at a sampled run end the match is known, and from one position to
        the next it shrinks by one until the next sample.
        """
        n = len(self.symbols)
        position = np.arange(n)
        longest = np.zeros(n, dtype=np.int64)
        for sample, agree in ((self.run_first, self.agree), (self.run_last, np.append(self.agree[1:], 0))):
            reach = np.zeros(n, dtype=np.int64)
            sampled = np.zeros(n, dtype=np.int64)
            reach[sample] = agree + sample
            sampled[sample] = sample
            np.maximum.accumulate(sampled, out=sampled)
            np.maximum(longest, reach[sampled] - position, out=longest)
        return longest

    def repeated(self, length):
        """For each string, at which of its positions a substring of this length begins that also
        begins at another position of the collection."""
        longest = self.statistics() >= length
        return [longest[a:max(a + n - length + 1, a)]
                for a, n in zip(self.starts.tolist(), self.sizes.tolist())]
