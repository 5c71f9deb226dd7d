"""Conversation repair against plain versions: every edit script by recursion, all rows by loops."""

import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from starsync.llm import conversation_repair as cr

SPACES = " \t\n\x0b\x0c\r"


def plain_cheapest(symbols):
    """(cost, audit) by trying each edit at each row, with up to three insertions before it."""
    @functools.cache
    def best(i, state, inserted):
        found = [(0, "")] if i == len(symbols) and state in (0, 3) else []
        steps = lambda kinds: [cr.STEP[state, k] for k in kinds if (state, k) in cr.STEP]
        if inserted < 3:
            found += [(c + 3, "I" + a) for q in steps("ua") for c, a in [best(i, q, inserted + 1)]]
        if i < len(symbols):
            s = symbols[i]
            options = [("D", 4, state)]
            if s not in cr.GONE:
                extra = 3 if s in cr.OPEN else 0
                options += [("K", extra, q) for q in steps(s.lower())]
                options += [("R", extra + 3, q) for q in steps("ua")]
            found += [(cost + c, e + a) for e, cost, q in options for c, a in [best(i + 1, q, 0)]]
        return min(found, default=(10**9, ""))

    return best(0, 0, 0)


def all_splits(symbols):
    """The root cell where each span takes the least over all its splits."""
    n = len(symbols)
    cell = {(i, i + 1): cr.ROWS[s] for i, s in enumerate(symbols)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            parts = [cr.combined(cell[i, k], cell[k, i + size]) for k in range(i + 1, i + size)]
            cell[i, i + size] = {key: min(p[key] for p in parts if key in p) for key in set().union(*parts)}
    return cell[0, n]


def plain(rows):
    """One row for each conversation from (conv_id, turn, role, text) rows."""
    blank = lambda x: " " if x is None else str(x)
    kept = {}
    for conv, turn, role, text in rows:
        kept.setdefault(conv, [])
        drawn = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if drawn == 0:
            continue
        text = "" if drawn == 1 else re.sub("[.!?]", "", text) if drawn == 2 else text
        kept[conv] += [(turn, "user" if drawn == 4 else role, text)] * (2 if drawn == 3 else 1)
    out = []
    for conv, own in kept.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        counts, symbols, seen = Counter(), "", set()
        for _, role, text in own:
            bare = text.rstrip(SPACES)
            place = "sua".find(role[:1]) if role[:1] else 3
            if not bare:
                fault, kinds = "blank", cr.GONE
            elif (role, text) in seen:
                fault, kinds = "duplicate", cr.GONE
            elif bare[-1] not in ".!?":
                fault, kinds = "truncated", cr.OPEN
            else:
                fault, kinds = None, cr.SOUND
            counts[fault] += 1
            seen.add((role, text))
            symbols += kinds[place]
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        first = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        cost, audit = plain_cheapest(symbols) if own else (0, "")
        lines, at = [], -((len(audit) - audit.count("D")) % 2)
        rest = iter(own)
        for e in audit:
            row = None if e == "I" else next(rest)
            if e != "D":
                role = row[1] if e == "K" else ("user", "assistant")[at % 2]
                lines.append(f"{role}:{row[2] if row else ''}")
                at += 1
        # What the edits give has to be well formed.
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest))
    return Counter(out)


def rows(df):
    return Counter((r.conv_id, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
                   for r in df.collect())


def test_cells_equal_all_edit_scripts():
    for n in range(1, 4):
        for symbols in itertools.product(cr.SOUND + cr.OPEN + cr.GONE[:1], repeat=n):
            symbols = "".join(symbols)
            assert cr.cheapest(cr.parsed([cr.ROWS[s] for s in symbols])) == plain_cheapest(symbols), symbols


@pytest.mark.parametrize("seed", range(5))
def test_halves_equal_all_splits(seed):
    draw = random.Random(seed)
    for n in (5, 8, 13, 20):
        symbols = "".join(draw.choice("suaoSUAO1234uauaua") for _ in range(n))
        halves = cr.parsed([cr.ROWS[s] for s in symbols])
        assert halves == all_splits(symbols)
        assert cr.cheapest(halves) == plain_cheapest(symbols)


TRICKY = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."), (1, 4, "user", "Tell me"),
    (2, None, None, None), (2, 1, "user", None), (2, 1, "assistant", "A tie."), (2, 1, "assistant", "A tie."),
    (None, 0, "user", "no id?"), (None, 1, "tool", "x."), (None, None, "", "y."), (3, 5, "user", "  \n"),
    (4, 0, "Assistant", "Case counts."), (4, 0, "assistant", "Ends so. "), (4, 9, "user", "naïve \U0001F600!"),
    (5, None, "user", "all turns null."), (5, None, "user", "all turns null."), (6, 0, "assistant", "Twice."),
    (6, 7, "assistant", "Twice."), (7, 0, "user", "word " * 30_000),
] + [(8, i, ("user", "assistant")[i % 2 ^ (i > 7)], f"Turn {i}.") for i in range(40)]


@pytest.fixture(scope="module")
def tricky(spark):
    return spark.createDataFrame(
        [(*r, "x", 1, "y") for r in TRICKY],
        "conv_id long, turn long, role string, text string, c string, n int, audit string").repartition(3)


def test_tricky_conversations(tricky):
    assert rows(cr.digests(tricky)) == plain(TRICKY)


def test_chunks_and_cells_are_combined(tricky, monkeypatch):
    monkeypatch.setattr(cr, "CHUNK", 3)
    monkeypatch.setattr(cr, "FAN", 2)
    monkeypatch.setattr(cr, "EDITS", 4)
    assert rows(cr.digests(tricky)) == plain(TRICKY)


def test_no_conversations(tricky):
    assert rows(cr.digests(tricky.limit(0))) == Counter()


def test_dropped_conversations_have_zeros(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    found = cr.digests(spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string"))
    assert rows(found) == Counter([(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())])


def test_repaired_rows_keep_their_texts(tricky):
    lines, figures = cr.repaired(tricky)
    own = {(r.c, r.text) for r in lines.where("edit <> 'I'").collect()}
    assert own <= {(" " if r[0] is None else str(r[0]), r[3]) for r in TRICKY}
    assert figures.count() == 9


def test_conversations_of_the_table(spark, sf_dir):
    found = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    want = plain([(r.conv_id, r.turn, r.role, r.text) for r in found.collect()])
    assert rows(cr.digests(found)) == want
