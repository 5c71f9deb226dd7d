"""Best-fit packing of tokenised documents into sequences of a fixed length.

1. The tasks that scan the documents encode them, close each with an end id and cut those that are
   too long; only lengths and digests go on.
2. The pieces are range-sorted by length and numbered, so a piece's position says its rank among
   the pieces of its length.  One count per length (at most ``size`` of them, however many pieces
   there are) describes the whole sorted list.
3. Bulk-synchronous best-fit over the two sorted lists, longest pieces first.  A super-step takes
   all pieces of one length.  A successor sweep finds the smallest gap that holds them; pieces that
   want the same gaps are told apart by rank (the piece of rank i takes the i-th gap); the gaps are
   updated and the sweep goes on until the pieces are placed.  Pieces without a gap open new
   sequences.  The outcome is that of sequential best-fit decreasing, but a step moves whole runs:
   sequences with the same gap and consecutive numbers are one run (a cohort), and a step adds at
   most three of them, so the lists stay short (below 3 × ``size`` cohorts) at every input size.
4. Each task finds the sequences of its pieces by binary search of their positions in the list of
   placements (runs of positions).  No piece ever leaves its task after the sort.

Defined cases: a null or empty text is a document of the end id alone; repeated rows are packed
each; ties of length are numbered by doc_id and piece; an empty table gives no rows; other columns
are ignored.
"""

import bisect
import re
import string
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsync.llm.byte_bpe import byte_characters
from starsync.llm.chunks import ChunkMemo, Memo, kept
from starsync.llm.common import map_texts, ship
from starsync.operators.numbering import number_rows
from starsync.session import stage

SIZE = 2048
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"

PIECES = "piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of texts by a tokenizer file of the byte-level kind; built once per worker."""

    def __init__(self, path):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.encode = ChunkMemo(self.encode_many).encode
        space = byte_characters()[ord(" ")]
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith(space)]] = True
        self.words = Memo(self.encode_words)
        self.tails = Memo(self.whole)

    def whole(self, texts) -> list:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def encode_words(self, words) -> list:
        """Ids of each word (a space and letters, a pre-token of its own).

        They are encoded as one text; the token that begins with a space is the first of a word.
        """
        ids = np.frombuffer(self.whole(["".join(words)])[0], dtype="<u4")
        at = np.flatnonzero(self.begins[ids])
        if len(at) != len(words):  # a tokenizer that splits otherwise
            return self.whole(words)
        held, at = ids.tobytes(), [*(4 * at).tolist(), 4 * len(ids)]
        return [held[a:b] for a, b in zip(at, at[1:])]

    def encode_many(self, texts) -> list:
        """Ids of each text.

        A space and letters are one pre-token, and what a mark begins behind it are others: most texts
        here are such a word or a word and a tail, and both repeat.  All others go through the tokenizer.
        """
        out, words, others = [None] * len(texts), [], []
        for i, t in enumerate(texts):
            word = WORD.match(t)
            if word and (word.end() == len(t) or t[word.end()] in MARKS):
                words.append((i, word[0], t[word.end():]))
            else:
                others.append(i)
        self.words.learn({word for _, word, _ in words})
        self.tails.learn({tail for _, _, tail in words})
        for i, word, tail in words:
            out[i] = self.words.young[word] + self.tails.young[tail]
        for i, ids in zip(others, self.whole([texts[i] for i in others])):
            out[i] = ids
        return out


#: A space and letters that are letters in all Unicode versions of the libraries.
WORD = re.compile(" [A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
#: Marks that end a pre-token of letters and begin another, whatever follows.
MARKS = frozenset(string.punctuation) - {"'"}


def cut(n: int, size: int) -> list:
    """(start, length) of the pieces of ``n`` ids: full ones, after a shorter first one if need be."""
    first = n if n <= size else n % size or size
    return [(0, first), *[(at, size) for at in range(first, n, size)]]


def pieces(docs: DataFrame, path=None, size=SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    path = path or public_tokenizers.path(TOKENIZER)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def make():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        encoder = kept(("packing", path), lambda: Encoder(path))

        def fn(batch):
            out = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc_id, ids in zip(batch["doc_id"], encoder.encode([t or "" for t in batch["text"]])):
                ids += end
                for i, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    out["doc_id"].append(doc_id)
                    out["piece"].append(i)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(ids[4 * start:4 * (start + length)]))
            return out

        return fn

    slim = docs.select("doc_id", "text")
    return map_texts(slim, make, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, {PIECES}")


def best_fit(counts, size=SIZE):
    """Placements for ``counts`` [(length, number of pieces)], in the order of the positions.

    Each placement (first position, first sequence, offset) holds up to the next one's position:
    the piece at ``first position + i`` goes to ``first sequence + i``.  Positions count pieces by
    ascending length, from 0.
    """
    starts, position = {}, 0
    for length, n in sorted(counts):
        starts[length] = position
        position += n
    gaps = []  # the sorted list of gaps in use
    cohorts = {}  # gap -> [(first sequence, number of sequences)]
    placements = []
    sequences = 0

    def add(gap, first, n):
        if gap and n:
            if gap not in cohorts:
                cohorts[gap] = []
                bisect.insort(gaps, gap)
            cohorts[gap].append((first, n))

    for length, left in sorted(counts, reverse=True):
        at = starts[length]
        while left:
            i = bisect.bisect_left(gaps, length)  # the successor: the smallest gap that is enough
            if i == len(gaps):
                gap, each = size, size // length
                first, n = sequences, -(-left // each)
                sequences += n
            else:
                gap = gaps[i]
                each = gap // length
                first, n = cohorts[gap].pop()
                if not cohorts[gap]:
                    del cohorts[gap], gaps[i]
            # Full sequences take ``each`` pieces, one may take the rest, the others stay.
            full = min(n, left // each)
            for k in range(each if full else 0):
                placements.append((at, first, size - gap + k * length))
                at += full
            left -= full * each
            add(gap - each * length, first, full)
            if left and full < n:
                for k in range(left):
                    placements.append((at, first + full, size - gap + k * length))
                    at += 1
                add(gap - left * length, first + full, 1)
                left, full = 0, full + 1
            add(gap, first + full, n - full)
    placements.sort()
    return placements, sequences


def pack(docs: DataFrame, path=None, size=SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    sized = stage(pieces(docs, path, size), "pack-pieces")
    sorted_ = stage(number_rows(sized, ["length", "doc_id", "piece"], "position"), "pack-sorted")
    counts = [(r.length, r.n) for r in  # one row for each length, at most ``size``
              sorted_.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()]
    placements, _ = best_fit(counts, size)
    spark = docs.sparkSession
    ship(spark)
    # Bounded by the lengths and the pieces of a sequence, not by the number of pieces.
    plan = spark.sparkContext.broadcast(np.array(placements, dtype=np.int64).reshape(-1, 3))

    def place(batches):
        first, sequence, offset = plan.value.T
        for batch in batches:
            position = batch.column("position").to_numpy() - 1
            at = np.searchsorted(first, position, side="right") - 1
            columns = {n: batch.column(n) for n in batch.schema.names if n != "position"}
            columns["sequence_id"] = pa.array(sequence[at] + position - first[at])
            columns["offset"] = pa.array(offset[at])
            yield pa.RecordBatch.from_pydict(columns)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted_.schema if f.name != "position")
    return sorted_.mapInArrow(place, f"{kinds}, sequence_id long, offset long")
