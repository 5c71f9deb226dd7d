"""Exact removal of long repeated passages by run-length indexes.

A byte is removed if it is covered by a string of ``length`` bytes that also starts anywhere else.

1. *Contexts.*  Each window of ``length`` bytes is filed under the least hash of its ``GRAM``-byte
   strings.  Neighbouring windows mostly have the same one; such a stretch of windows and the bytes
   it covers is a context (some 600 bytes, one for each 200 bytes of text).  Equal windows have
   equal least hashes, so a window can only be repeated under its own hash, and every window stands
   in one context of its document.
2. *Candidates.*  Hashes that occur once are gone after one aggregation.  Where all contexts of a
   hash are the same bytes, all their windows are repeated.
3. *Index.*  The distinct contexts of the other hashes are collected into shards by hash.  For each
   shard a run-compressed Burrows-Wheeler transform with sampled run ends is built; matching
   statistics are streamed over the contexts, and windows whose match is ``length`` bytes or longer
   are marked.  Repetitive shards have few runs.
4. *Crowded hashes.*  A hash with more than ``CROWD`` distinct contexts (a passage in a great part of
   all documents, with other text around it) does not go to one shard.  Its windows are told
   apart by two rolling hashes of 64 bits and counted by Spark, which is exact but for collisions
   of 128 bits and is dealt to all tasks: those counted once are not repeated.
5. Marks go back to all documents that hold the context, and the bytes are cut out.

``remove`` can also cut passages of some number of words, however few bytes they have: the same steps
run on texts whose symbols are words (codes of ``CODE`` bytes) in place of bytes.

Defined cases: a null text is an empty one (``remove`` leaves it null); texts shorter than
``length`` lose nothing; copies of a text are repeats of each other, and so are repeated rows; an
empty table gives no rows; other columns are ignored by ``spans`` and kept by ``remove``.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsync.llm.chunks import forget
from starsync.llm.common import aside, map_texts, ship, slices, utf8
from starsync.session import scratch, stage

LENGTH = 400
GRAM = 32
#: Bytes of the code of a word, and words of the strings whose hashes file a window of words.
CODE = 8
WORD_GRAM = 4
#: Windows of a text that are worked on at a time, and most windows of one context.
BLOCK = 1 << 19
MOST_WINDOWS = 2048
#: Symbols of contexts that a shard is meant to hold: few enough for a core's cache.
SHARD_BYTES = 250_000
#: Most distinct contexts of a hash that go to an index.
CROWD = 1024

_MASK = (1 << 64) - 1


class Rolling:
    """Hashes of all strings of some length in a text, from running sums (modulo 2^64)."""

    def __init__(self, seed, most):
        draw = np.random.default_rng(seed)
        self.byte = draw.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(draw.integers(0, 1 << 62)) * 8 + 5
        self.power = self._powers(base, most)
        self.inverse = self._powers(pow(base, -1, 1 << 64), most)

    @staticmethod
    def _powers(base, n):
        out = np.ones(n, dtype=np.uint64)
        if n > 1:
            out[1:] = np.uint64(base & _MASK)
            np.multiply.accumulate(out, out=out)
        return out

    def hashes(self, data: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the strings in ``data``, bytes or codes of words."""
        n = len(data)
        sums = np.zeros(n + 1, dtype=np.uint64)
        values = self.byte[data] if data.dtype == np.uint8 else data
        np.cumsum(values * self.power[:n], out=sums[1:])
        h = (sums[length:] - sums[:n - length + 1]) * self.inverse[:n - length + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbouring ones."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def symbols(data: bytes, size) -> np.ndarray:
    """A text as symbols of ``size`` bytes: 1 for bytes, ``CODE`` for words."""
    return np.frombuffer(data, dtype=np.uint8 if size == 1 else np.uint64)


def contexts(data: bytes, rolling: Rolling, length=LENGTH, gram=GRAM, size=1):
    """(first window, last window, hash, digest, inner) of each context of a text, counted in symbols
    of ``size`` bytes.

    ``inner`` tells that the least hash occurs twice in the context, so that it may repeat itself.
    """
    gram = min(gram, length)
    width = length - gram + 1
    view = symbols(data, size)
    for at in range(0, max(len(view) - length + 1, 0), BLOCK):
        part = view[at:at + BLOCK + length - 1]
        grams = rolling.hashes(part, gram)
        least = sliding_least(grams, width)
        n = len(least)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.append(first[1:], n) - 1
        if (last - first >= MOST_WINDOWS).any():
            pieces = [np.arange(a, b + 1, MOST_WINDOWS) for a, b in zip(first, last)]
            first = np.concatenate(pieces)
            last = np.append(first[1:], n) - 1
        keys = least[first]
        for a, b, h in zip(first.tolist(), last.tolist(), keys):
            digest = hashlib.blake2b(data[(at + a) * size:(at + b + length) * size], digest_size=8).digest()
            inner = np.count_nonzero(grams[a:b + width] == h) > 1
            yield at + a, at + b, h, digest, inner


def codes(text) -> bytes:
    """The words of a text (what ASCII white space separates) as codes of equal length."""
    return b"".join(map(xxhash.xxh64_digest, utf8(text).split()))


def find_contexts(docs: DataFrame, length=LENGTH, encode=utf8, size=1) -> DataFrame:
    """(doc_id, tie, first, last, h, c, own): the contexts of all texts; (doc_id, tie) names the text."""
    def make():
        forget()
        rolling = Rolling(1, BLOCK + length)
        gram = GRAM if size == 1 else WORD_GRAM

        def fn(batch):
            out = {c: [] for c in ("doc_id", "tie", "first", "last", "own")}
            h, c = [], []
            for doc_id, tie, text in zip(batch["doc_id"], batch["tie"], batch["text"]):
                for first, last, key, digest, inner in contexts(encode(text), rolling, length, gram, size):
                    out["doc_id"].append(doc_id)
                    out["tie"].append(tie)
                    out["first"].append(first)
                    out["last"].append(last)
                    out["own"].append(bool(inner))
                    h.append(key)
                    c.append(digest)
            out["h"] = np.array(h, dtype=np.uint64).view(np.int64)
            out["c"] = np.frombuffer(b"".join(c), dtype=np.int64)
            return out

        return fn

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(
        docs.select("doc_id", "tie", "text"), make,
        f"doc_id {kind}, tie long, first int, last int, h long, c long, own boolean")


def index_shard(length, size=1):
    """Group function: the contexts (h, c, data) of a shard to the windows (first, last) repeated."""
    from starsync.llm.run_index import RunIndex

    def run(_, rows):
        forget()
        data = [symbols(d, size) for d in rows.column("data").to_pylist()]
        h, c = rows.column("h").to_pylist(), rows.column("c").to_pylist()
        out = {"h": [], "c": [], "first": [], "last": []}
        for i, marked in enumerate(RunIndex(data).repeated(length)):
            for first, last in stretches(marked):
                out["h"].append(h[i])
                out["c"].append(c[i])
                out["first"].append(first)
                out["last"].append(last)
        return pa.table(out, schema=_MARKS)

    return run


_MARKS = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])


def stretches(marked: np.ndarray) -> list:
    """(first, last) of the stretches of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def crowded_windows(data: DataFrame, length, size=1) -> DataFrame:
    """(h, c, first, last) of repeated windows in the contexts ``data`` (h, c, data), by counting."""
    def split(batches):
        one, two = (Rolling(seed, MOST_WINDOWS + length) for seed in (2, 3))
        for batch in batches:
            h, c = batch.column("h").to_numpy(), batch.column("c").to_numpy()
            for i, text in enumerate(batch.column("data").to_pylist()):
                view = symbols(text, size)
                a, b = one.hashes(view, length), two.hashes(view, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(a), h[i])), pa.array(np.full(len(a), c[i])),
                     pa.array(np.arange(len(a), dtype=np.int32)),
                     pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                    ["h", "c", "first", "a", "b"])

    windows = data.select("h", "c", "data").mapInArrow(split, "h long, c long, first int, a long, b long")
    # A window that is counted once names its context; all others of a context are repeated.  So the
    # aggregation (with partial counts per task) is all that is needed, however frequent a window is.
    once = windows.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("k"), *[F.min(p).alias(p) for p in ("h", "c", "first")],
    ).where("k = 1").groupBy("h", "c").agg(F.collect_list("first").alias("once"))
    found = data.select("h", "c", ((F.length("data") / size).cast("int") - length + 1).alias("n")).join(once, ["h", "c"], "left")

    def rest(batches):
        for batch in batches:
            h, c = batch.column("h").to_pylist(), batch.column("c").to_pylist()
            out = []
            for i, (n, alone) in enumerate(zip(batch.column("n").to_pylist(), batch.column("once").to_pylist())):
                repeated = np.ones(n, dtype=bool)
                repeated[np.array(alone or [], dtype=np.int64)] = False
                out += [(h[i], c[i], first, last) for first, last in stretches(repeated)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(zip(*out) if out else [[]] * 4, _MARKS)], schema=_MARKS)

    return found.mapInArrow(rest, "h long, c long, first int, last int")


def repeated_windows(keyed: DataFrame, length=LENGTH, encode=utf8, size=1) -> DataFrame:
    """(doc_id, tie, windows): stretches (first, last) of windows of ``keyed`` (doc_id, tie, text) that
    are repeated, for each text that has any; ``encode`` gives the bytes of a text, ``size`` of them a
    symbol, and windows are counted in symbols."""
    ship(keyed.sparkSession)
    with scratch(keyed.sparkSession):
        return stage(_windows(keyed, length, encode, size), "repeated-windows", keep=True)


def _windows(keyed: DataFrame, length, encode, symbol) -> DataFrame:
    found = stage(find_contexts(keyed, length, encode, symbol), "contexts")
    # One aggregation tells which hashes can hold repeats, and whether their contexts are all alike.
    hashes = found.groupBy("h").agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("c0"), F.max("c").alias("c1"), F.max("own").alias("own"),
    ).where("n > 1 OR own").select("h", ((F.col("c0") == F.col("c1")) & ~F.col("own")).alias("alike"))
    # Staged, so that the skew join can split a hash with many contexts.
    hashes = stage(hashes, "context-hashes")
    repeats = stage(found.drop("own").join(hashes, "h"), "context-repeats")
    place = ["doc_id", "tie", "first", "last"]
    alike = repeats.where("alike").select("doc_id", "tie", F.array(F.struct("first", "last")).alias("w"))

    mixed = repeats.where("NOT alike")
    distinct = stage(mixed.groupBy("h", "c").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(p).alias(p) for p in place]), "context-kinds")
    crowds = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"))
    size = distinct.agg(F.sum(F.col("last") - F.col("first") + length)).first()[0] or 0
    shards = max(-(-size // SHARD_BYTES), 1)
    wanted = distinct.join(crowds, "h").groupBy("doc_id", "tie").agg(F.collect_list(F.struct(
        "h", "c", "first", "last", (F.col("kinds") > CROWD).alias("crowded"))).alias("parts"))

    def parts_of(batches):
        forget()
        for batch in (part for whole in batches for part in slices(whole, "text")):
            h, c, crowded, data = [], [], [], []
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist()):
                text = encode(text)
                for p in parts:
                    h.append(p["h"])
                    c.append(p["c"])
                    crowded.append(p["crowded"])
                    data.append(text[p["first"] * symbol:(p["last"] + length) * symbol])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h, pa.int64()), pa.array(c, pa.int64()), pa.array(crowded, pa.bool_()),
                 pa.array(data, pa.binary())], ["h", "c", "crowded", "data"])

    texts = stage(
        _with(keyed, wanted, "inner").select("text", "parts").mapInArrow(
            parts_of, "h long, c long, crowded boolean, data binary")
        .dropDuplicates(["h", "c"]), "context-texts")
    marks = (
        texts.where("NOT crowded").select("h", "c", "data", F.pmod("h", F.lit(shards)).alias("shard"))
        .groupBy("shard").applyInArrow(index_shard(length, symbol), "h long, c long, first int, last int")
        .unionByName(crowded_windows(texts.where("crowded"), length, symbol))
        .unionByName(distinct.where("n > 1").select(  # equal contexts in several places
            "h", "c", F.lit(0).alias("first"), (F.col("last") - F.col("first")).alias("last")))
    )
    # One row for each context, so that the join gives no more rows than there are places.
    marks = marks.groupBy("h", "c").agg(F.collect_list(F.struct("first", "last")).alias("marks"))
    inside = mixed.join(marks, ["h", "c"]).select("doc_id", "tie", F.transform("marks", lambda m: F.struct(
        (F.col("first") + m["first"]).alias("first"), (F.col("first") + m["last"]).alias("last"))).alias("w"))
    return alike.unionByName(inside).groupBy("doc_id", "tie").agg(
        F.flatten(F.collect_list("w")).alias("windows"))


def _with(keyed: DataFrame, other: DataFrame, how) -> DataFrame:
    """Join on the name of a text."""
    other = other.withColumnsRenamed({"doc_id": "_doc", "tie": "_tie"})
    return keyed.join(
        other, keyed["doc_id"].eqNullSafe(other["_doc"]) & (keyed["tie"] == other["_tie"]), how)


def _marked(docs: DataFrame, length, words=None) -> DataFrame:
    """The rows of ``docs`` and ``windows``, the repeated windows of each (null: none); with a number of
    words also ``phrases``, the repeated windows of that many words, counted in words."""
    keyed = docs.withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    windows = repeated_windows(keyed.select("doc_id", "tie", "text"), length)
    marked = _with(keyed, windows, "left").select(*keyed.columns, "windows")
    if words is None:
        return marked.drop("tie")
    phrases = repeated_windows(keyed.select("doc_id", "tie", "text"), words, codes, CODE)
    return _with(marked, phrases.withColumnRenamed("windows", "phrases"), "left").select(
        *docs.columns, "windows", "phrases")


def runs(windows, length) -> list:
    """(start, end) of the maximal stretches of bytes that the windows cover."""
    out = []
    for first, last in sorted((w["first"], w["last"]) for w in windows or ()):
        end = last + length
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


_WORD = re.compile(rb"[^ \t\n\r\x0b\x0c]+")


def phrase_runs(data: bytes, phrases, words) -> list:
    """(start, end) in the bytes of a text of the repeated windows of ``words`` words."""
    if not phrases:
        return []
    at = [m.span() for m in _WORD.finditer(data)]
    return [(at[a][0], at[b - 1][1]) for a, b in word_runs(phrases, words)]


def word_runs(phrases, words) -> list:
    """(start, end) in words of the repeated windows of ``words`` words."""
    return [(w["first"], w["last"] + words) for w in phrases or ()]


def merged(spans) -> list:
    """Spans that overlap or touch as one."""
    out = []
    for start, end in sorted(map(tuple, spans)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def without(data: bytes, spans) -> bytes:
    at, parts = 0, []
    for start, end in spans:
        parts.append(data[at:start])
        at = end
    return b"".join([*parts, data[at:]])


def spans(docs: DataFrame, length=LENGTH, words=None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans: one row for each row of ``docs``.

    With a number of ``words`` also n_phrase_words and n_phrases: the words in passages of at least
    that many that stand elsewhere, too, whatever their bytes, and the maximal runs of such words.  These
    passages are reported, not removed.
    """
    counted = ("n_phrase_words", "n_phrases") if words else ()

    def make():
        forget()

        def fn(batch):
            out = {c: [] for c in (
                "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", *counted)}
            for passages in (batch["phrases"] if counted else ()):
                covered = merged(word_runs(passages, words))
                out["n_phrase_words"].append(sum(b - a for a, b in covered))
                out["n_phrases"].append(len(covered))
            for text, windows in zip(batch["text"], batch["windows"]):
                data, found = utf8(text), runs(windows, length)
                out["n_bytes"].append(len(data))
                out["n_removed"].append(sum(b - a for a, b in found))
                out["n_spans"].append(len(found))
                out["kept_sha256"].append(hashlib.sha256(without(data, found)).hexdigest())
                out["spans"].append([{"start": a, "end": b} for a, b in found])
            return {"doc_id": batch["doc_id"]} | out

        return fn

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(
        _marked(docs.select("doc_id", "text"), length, words), make,
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start: long, end: long>>" + "".join(f", {c} long" for c in counted))


def whole_characters(data: bytes, found) -> list:
    """The spans drawn in to whole characters of UTF-8, so that what is left is text."""
    out = []
    for start, end in found:
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def remove(docs: DataFrame, length=LENGTH, words=None) -> DataFrame:
    """The rows of ``docs`` with all their columns; repeated passages are cut out of the text: those of
    ``length`` bytes, and with ``words`` also those of that many words."""
    def make():
        forget()

        def fn(batch):
            texts = []
            for text, windows, phrases in zip(
                    batch["text"], batch["windows"], batch.get("phrases") or [None] * len(batch["text"])):
                if text is not None and (windows or phrases):
                    data = utf8(text)
                    found = runs(windows, length) + phrase_runs(data, phrases, words)
                    text = without(data, whole_characters(data, merged(found))).decode()
                texts.append(text)
            return {c: texts if c == "text" else batch[c] for c in columns}

        return fn

    inner, outer = aside(docs)
    columns = inner.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema)
    return outer(map_texts(_marked(inner, length, words), make, kinds))
