"""Byte-level BPE, packing and token counts."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from starsync.llm import byte_bpe, packing
from tests.llm.conftest import TRICKY

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts_of(spark, sf_dir):
    return [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def test_ids_equal_the_library(spark, sf_dir, reference):
    codec = byte_bpe.Codec(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN)
    rng = random.Random(1)
    texts = texts_of(spark, sf_dir) + [t or "" for _, t, _, _ in TRICKY]
    texts += ["".join(rng.choice(" \n\t ab1.'é <|>") for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["a" * 5000, "  x", "<|endoftext|>", "x" + "".join(map(chr, range(0x2ff))), "it's I'LL we've"]
    for text, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_digests(spark, tricky, no_docs, reference):
    rows = byte_bpe.digests(tricky).collect()
    want = Counter()
    for doc_id, text, _, _ in TRICKY:
        ids = np.array(reference.encode_ordinary(text or ""), dtype="<u4")
        want[doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
             hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in rows) == want
    assert byte_bpe.digests(no_docs).count() == 0
    ids = byte_bpe.encode(tricky).where("doc_id = 8").first().ids
    assert ids == reference.encode_ordinary(TRICKY[-1][1])


def sequential_best_fit(lengths, size):
    import bisect

    gaps, sequences = [], 0
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, n)
        gap = size if i == len(gaps) else gaps.pop(i)
        sequences += gap == size
        if gap > n:
            bisect.insort(gaps, gap - n)
    return sequences


def gapless(rows, size):
    held = defaultdict(list)
    for sequence, offset, length in rows:
        held[sequence].append((offset, length))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    return len(held)


def test_best_fit_is_that_of_the_sequential_algorithm():
    rng = random.Random(3)
    for _ in range(60):
        size = rng.choice([10, 64, 2048])
        lengths = sorted(rng.randint(1, size if rng.random() < 0.5 else max(1, size // 5))
                         for _ in range(rng.randint(0, 400)))
        placements, sequences = packing.best_fit(list(Counter(lengths).items()), size)
        first = [p[0] for p in placements]
        rows = []
        for i, n in enumerate(lengths):
            at, sequence, offset = placements[np.searchsorted(first, i, side="right") - 1]
            rows.append((sequence + i - at, offset, n))
        assert gapless(rows, size) == sequences == sequential_best_fit(lengths, size)


@pytest.mark.parametrize("size", [16, 2048])
def test_packing(spark, tricky, no_docs, size):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rows = packing.pack(tricky, size=size).collect()
    want = Counter()
    for doc_id, text, _, _ in TRICKY:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) if len(ids) <= size else len(ids) % size or size
        edges = [0, *range(first, len(ids), size), len(ids)]
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            want[doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert gapless([(r.sequence_id, r.offset, r.length) for r in rows], size) == sequential_best_fit(
        [r.length for r in rows], size)
    assert packing.pack(no_docs).count() == 0


def test_special_strings_and_spaces_are_the_librarys(spark, sf_dir):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    tokenizer, encoder = Tokenizer.from_file(path), packing.Encoder(path)
    texts = ["a word. Other, été! naïve? ß: it's; 'x' word.. ıʼn ﬁ ª º. ǅ Ωmega", " 's 't. a' re", ". , !",
             "a <|endoftext|> b", "a<|endoftext|>b c", "x  <|endoftext|>", " lead", "tail ", "a \n b", ""]
    texts += texts_of(spark, sf_dir)[:50]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_new_words_and_their_tails_are_encoded_together():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    tokenizer, encoder = Tokenizer.from_file(path), packing.Encoder(path)
    words = [chr(97 + i % 26) * 2 + "çthonre" * (i % 3) + chr(97 + i // 26) for i in range(300)]
    tails = ["", ".", "###", ".\nErß", '",', "<|endoftext|>b", "-x", "!  ", "_1"]
    text = "x " + " ".join(w + tails[i % len(tails)] for i, w in enumerate(words))
    calls, whole = [], encoder.whole
    encoder.whole = lambda texts: calls.append(len(texts)) or whole(texts)
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == tokenizer.encode(
        text, add_special_tokens=False).ids
    assert sum(calls) < 20  # one text holds all words, not one call for each
