"""Encoding of texts chunk by chunk, where chunks repeat and their results are remembered."""

import pyarrow as pa
import regex

#: A space after other white space: there a chunk could begin inside a run that a pre-token takes.
_DOUBLE = regex.compile(r"\p{White_Space} ")
#: Chunks that are encoded at a time (libraries return large objects).
BLOCK = 1000

_kept = {}


def kept(key, build):
    """What ``build`` returned for this key in this worker process; workers serve many tasks."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = build()
    return _kept[key]


def forget():
    """Drop what this worker keeps: for steps that need the memory and keep nothing themselves."""
    _kept.clear()
    pa.default_memory_pool().release_unused()


class Memo:
    """Values of strings, remembered in two generations of ``most`` entries.

    When the younger generation is full it becomes the older one, and the older one is forgotten;
    what is used again moves to the younger one.  So the memory is bounded and frequent strings stay.
    """

    def __init__(self, compute, most=250_000):
        self.compute, self.most = compute, most
        self.young, self.old = {}, {}

    def learn(self, strings):
        """Make sure that ``young`` has the values of a set of strings."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        missing = []
        for s in strings.difference(self.young):
            if s in self.old:
                self.young[s] = self.old[s]
            else:
                missing.append(s)
        for at in range(0, len(missing), BLOCK):
            block = missing[at:at + BLOCK]
            self.young.update(zip(block, self.compute(block)))


class ChunkMemo:
    """Ids of texts for tokenizers whose pre-tokens never cross a space that follows a word.

    A text is the chunk up to its first space and the chunks that begin with a space each; the ids
    of a text are those of its chunks.  Texts with runs of white space are encoded whole.
    ``encode_many`` gives the ids of texts as little-endian unsigned 32-bit integers, in bytes.
    """

    def __init__(self, encode_many):
        self.first = Memo(encode_many, 20_000)
        # Remembered without their space.
        self.rest = Memo(lambda chunks: encode_many([" " + c for c in chunks]))

    def encode(self, texts) -> list:
        split = [[t] if _DOUBLE.search(t) else t.split(" ") for t in texts]
        self.first.learn({s[0] for s in split})
        self.rest.learn(set().union(*[s[1:] for s in split]))
        first, find = self.first.young, self.rest.young.__getitem__
        return [first[s[0]] + b"".join(map(find, s[1:])) for s in split]
