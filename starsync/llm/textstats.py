"""Counts over one text, used by the quality rules and the quality classifier."""

import numpy as np

from starsync.llm.common import utf8

#: Odd multipliers that turn three word hashes into one window hash.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\v\f\r"


def repeated_words(word_hashes) -> int:
    """Words that stand in a three-word window found twice or more in the text."""
    n = len(word_hashes)
    if n < 4:
        return 0
    h = word_hashes.view(np.uint64)
    windows = h[:-2] * _MIX[0] + h[1:-1] * _MIX[1] + h[2:] * _MIX[2]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n - 2, dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= again
    return int(covered.sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in data:
        return 0
    lines = [line for line in data.split(b"\n") if line.strip(_SPACE)]
    return len(lines) - len(set(lines))


def base_counts(text) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    data = utf8(text)
    words = data.split()  # bytes.split() splits at exactly \x20 and \x09-\x0D
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words))
    chars = len(text or "") - (len(data) - len(data.translate(None, _SPACE)))
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    return len(words), chars, symbols, duplicate_lines(data), repeated_words(hashes)


#: Names of the values of ``shape``.
SHAPE = (
    "log_words", "mean_word", "symbols", "upper", "digits", "bangs", "bars", "stops", "commas",
    "non_ascii", "distinct", "repeat", "dup_lines", "line_words", "longest_line", "single_chars",
    "top_word", "controls",
)


def shape(text) -> list:
    """Ratios that describe a text for the quality classifier (all 0 for an empty text)."""
    data = utf8(text)
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(SHAPE)
    size = max(len(data), 1)
    byte = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=n)
    _, counts = np.unique(hashes, return_counts=True)
    lines = [line for line in data.split(b"\n") if line.strip(_SPACE)] or [data]
    letters = byte[65:91].sum() + byte[97:123].sum() + byte[128:].sum()
    word_bytes = size - byte[list(_SPACE)].sum()
    return [
        float(np.log1p(n)),
        float(word_bytes / n),
        float(byte[list(_SYMBOLS)].sum() / n),
        float(byte[65:91].sum() / max(letters, 1)),
        float(byte[48:58].sum() / size),
        float((byte[33] + byte[63]) / n),
        float(byte[124] / n),
        float(byte[46] / n),
        float(byte[44] / n),
        float(byte[128:].sum() / size),
        float(len(counts) / n),
        float(repeated_words(hashes) / n),
        float((len(lines) - len(set(lines))) / len(lines)),
        float(n / len(lines)),
        float(np.log1p(max(map(len, lines)))),
        float(sum(1 for w in words if len(w) == 1) / n),
        float(counts.max() / n),
        float((byte[:9].sum() + byte[14:32].sum()) / size),
    ]
