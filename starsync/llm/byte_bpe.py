"""Byte-level BPE through sentencepiece.

A rank file (base64 token, rank) is written directly as a sentencepiece BPE model: each token's
bytes become characters by a fixed one-to-one map, its score is its negative rank, and the
normaliser is the identity, so the best-scored merge is the merge of the lowest rank.  Texts are
split into pre-tokens by a pattern and each pre-token is encoded by that model; ids are decoded by
the inverse map.  Encoding runs in the tasks that scan the documents, without a shuffle; a task
remembers the ids of the chunks between spaces, which repeat.

Defined cases: a null text is an empty one (no ids); special strings in texts are ordinary text;
repeated rows are encoded each; an empty table gives no rows; other columns are ignored.
"""

import base64
import hashlib
import struct

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame

from starsync.llm.chunks import ChunkMemo, kept
from starsync.llm.common import map_texts

RANKS = "byte_bpe_50k.tiktoken"


def byte_characters() -> list:
    """One printable character for each byte: the byte's own where it is printable, else the next
    free code point from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def read_ranks(path) -> list:
    """The tokens of a rank file in the order of their ranks."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value) -> bytes:
    """One field of a protocol buffer message."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise_model(tokens) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks of ``tokens``.

    Fields of the published model format: 1 pieces (1 text, 2 score, 3 type), 2 trainer (3 model
    type, 40.. special ids), 3 normaliser (1 name, 3.. flags).  The unknown piece comes last.
    """
    normal, unknown, bpe = 1, 2, 2
    chars = byte_characters()
    pieces = b"".join(
        _field(1, _field(1, "".join(chars[b] for b in token).encode()) + _field(2, float(-rank))
               + _field(3, normal))
        for rank, token in enumerate(tokens))
    pieces += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))
    trainer = _field(3, bpe) + _field(40, len(tokens))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return pieces + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes and decodes by a rank file; built once per worker."""

    def __init__(self, path, pattern):
        import regex
        import sentencepiece

        tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(tokens))
        # \s of the pattern is Unicode white space, spelled out for this regular expression library.
        self.pattern = regex.compile(
            pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
            .replace(r"\S", r"\P{White_Space}"))
        self.to_chars = dict(enumerate(byte_characters()))
        inverse = {c: b for b, c in self.to_chars.items()}
        self.bytes_of = [
            bytes(inverse[c] for c in self.model.id_to_piece(i)) for i in range(len(tokens))]
        self.encode = ChunkMemo(self.encode_many).encode

    def encode_pre_tokens(self, pre_tokens) -> list:
        """Ids of each pre-token, as little-endian unsigned 32-bit integers."""
        mapped = [p.encode().decode("latin-1").translate(self.to_chars) for p in pre_tokens]
        return [np.array(ids, dtype="<u4").tobytes()
                for ids in self.model.encode(mapped, num_threads=1)]

    def encode_many(self, texts) -> list:
        """Ids of each text: those of its pre-tokens, which are encoded together."""
        parts = [self.pattern.findall(t) for t in texts]
        ids = iter(self.encode_pre_tokens([p for part in parts for p in part]))
        return [b"".join([next(ids) for _ in part]) for part in parts]

    def decode(self, ids: bytes) -> bytes:
        return b"".join([self.bytes_of[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encode(docs: DataFrame, path=None, pattern=public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids: the ids of every whole text.

    ``ids`` (array) is left out of the plan when it is not selected.
    """
    return _run(docs, path, pattern, with_ids=True)


def digests(docs: DataFrame, path=None, pattern=public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes that they decode to."""
    return _run(docs, path, pattern, with_ids=False)


def _run(docs, path, pattern, with_ids):
    path = path or public_tokenizers.path(RANKS)

    def make():
        codec = kept(("bpe", path, pattern), lambda: Codec(path, pattern))

        def fn(batch):
            ids = codec.encode([t or "" for t in batch["text"]])
            out = {
                "doc_id": batch["doc_id"],
                "n_tokens": [len(i) // 4 for i in ids],
                "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
                "decoded_sha256": [hashlib.sha256(codec.decode(i)).hexdigest() for i in ids],
            }
            if with_ids:
                out["ids"] = [np.frombuffer(i, "<u4").astype("int32") for i in ids]
            return out

        return fn

    slim = docs.select("doc_id", "text")
    kind = slim.schema["doc_id"].dataType.simpleString()
    return map_texts(
        slim, make,
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
        + (", ids array<int>" if with_ids else ""))
