"""Repair of conversation structure by weighted interval parsing.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``: nothing, or user and
assistant in turns with at most one system turn in front.  Its rows are edited to get there: Keep (0),
Rerole to user or assistant (3), Delete (4; blank rows and repeats have to go), Insert an empty turn of
user or assistant (3); a truncated row that stays adds 3.  The cheapest edits win, of equally cheap ones
those whose initials come first.

The grammar is in Chomsky normal form over spans of rows.  A nonterminal (p, q) stands for edits that
take a dialogue from state p (nothing yet, after system, after user, after assistant) to q; its
binary rules are (p, q) -> (p, r) (r, q), its terminal rules are the edits of one row behind the
closure of insertions.  A cell holds, for each nonterminal, the least (cost, audit) over its span.  The
states in the middle are the only thing that two neighbouring spans share, so every split of a span
gives the same cell: spans are combined bottom-up by length, 1, 2, 4, ..., each from its two halves.
(Equally cheap audits of a span are never prefixes of each other, for they consume the same rows and a
longer one has more insertions; so the least parts make the least whole.)

The rows of all conversations are numbered by one range sort, so a conversation of any length is spread
over tasks.  Its faults are joins and aggregates, its symbols are parsed in chunks of ``CHUNK`` rows, and
the cells of chunks are combined upwards, ``FAN`` at a time, until one is left.

Defined cases: a null role or text is one space; a null conv_id is a conversation of its own; turns are
ordered nulls first, equal turns by role and text; an empty table gives no rows; other columns are
ignored.
"""

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from starsync.llm.chunks import Memo, kept
from starsync.llm.common import joined_sha256, map_texts, ship
from starsync.operators.numbering import number_rows
from starsync.session import stage

#: Rows whose symbols are parsed at once, and cells that are combined at once.
CHUNK, FAN = 512, 64
#: Edits that are passed on at a time.
EDITS = 20_000
RETYPE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES = range(4)
ENDS = (0, 3)
#: Symbols of rows by initial (system, user, assistant, other): sound, truncated, to be deleted.
INITIALS, SOUND, OPEN, GONE = "suao", "suao", "SUAO", "1234"

SPACE = r"\x20\x09-\x0D"


def combined(left: dict, right: dict) -> dict:
    """The cell of a span from those of its two parts."""
    out = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            if (r, q) in right:
                more, rest = right[r, q]
                new = (cost + more, audit + rest)
                if (p, q) not in out or new < out[p, q]:
                    out[p, q] = new
    return out


def _inserted() -> dict:
    """The closure of insertions: the least of any number of them, between all states."""
    once = {(p, q): (INSERT, "I") for (p, kind), q in STEP.items() if kind in "ua"}
    cell = {(p, p): (0, "") for p in STATES}
    for _ in STATES:  # no state is farther away than that
        longer = combined(cell, once)
        cell = {k: min(x[k] for x in (cell, longer) if k in x) for k in cell | longer}
    return cell


INSERTED = _inserted()


def _row(symbol: str) -> dict:
    """The cell of one row, with what is inserted in front of it."""
    cell = {(p, p): (DELETE, "D") for p in STATES}
    if symbol not in GONE:
        extra = TRUNCATED if symbol in OPEN else 0
        for (p, kind), q in STEP.items():
            if kind == symbol.lower():
                cell[p, q] = (extra, "K")
            elif kind in "ua":
                cell[p, q] = (extra + RETYPE, "R")
    return combined(INSERTED, cell)


ROWS = {symbol: _row(symbol) for symbol in SOUND + OPEN + GONE}


def parsed(cells: list) -> dict:
    """The cell of a span from the cells of its parts, bottom-up."""
    while len(cells) > 1:
        pairs = [combined(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(pairs) * 2:]
    return cells[0]


def cheapest(cell: dict) -> tuple:
    """(cost, audit) of a whole conversation."""
    whole = combined(cell, INSERTED)
    return min(whole[0, q] for q in ENDS if (0, q) in whole)


def _initial(symbol: str) -> str:
    return INITIALS[(SOUND + OPEN + GONE).index(symbol) % 4]


def span_of(symbols: str) -> str:
    """The parsed chunk as a line of text: cell, misplaced pairs, first and last initial."""
    roles = [_initial(s) for s in symbols]
    bad = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    cell = parsed([ROWS[s] for s in symbols])
    return json.dumps([[[*k, *v] for k, v in cell.items()], bad, roles[0], roles[-1]])


def joined_spans(lines: str) -> str:
    """The line of a span from those of its parts."""
    parts = [json.loads(x) for x in lines.split("\n")]
    bad = sum(x[1] for x in parts) + sum(a[3] + b[2] not in ("su", "ua", "au") for a, b in zip(parts, parts[1:]))
    cell = parsed([{(p, q): (cost, audit) for p, q, cost, audit in x[0]} for x in parts])
    return json.dumps([[[*k, *v] for k, v in cell.items()], bad, parts[0][2], parts[-1][3]])


def roles_of(audit: str):
    """(edit, row or None, role that the edit gives or None) for each edit, in order."""
    stays = len(audit) - audit.count("D")
    at, row = -(stays % 2), 0  # an odd number of turns begins with system
    for edit in audit:
        given = None
        if edit != "D":
            given = "user" if at % 2 == 0 else "assistant"
            at += 1
        yield edit, None if edit == "I" else row, given if edit in "RI" else None
        row += edit != "I"


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults drawn by the id of the row: dropped, emptied, without ends of
    sentences, repeated, or said by the user."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    drawn = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), drawn.alias("drawn"))
    text = F.when(F.col("drawn") == 1, "").when(
        F.col("drawn") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.where("drawn <> 0").select(
        "conv_id", "turn", F.when(F.col("drawn") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("drawn") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _key() -> Column:
    return F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("c")


def _numbered(rows: DataFrame) -> DataFrame:
    """(c, n, turn, role, text, d, blank, open): the rows with their number in the order of all."""
    text = F.coalesce("text", F.lit(" "))
    kept_rows = rows.select(
        _key(), "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text")).select(
        "*", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("d"),
        (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("open"))
    return number_rows(kept_rows, ["c", "turn", "role", "text"], "n")


def _symbols(rows: DataFrame):
    """(c, n, symbol) of all rows, and (c, first, blank, duplicate, truncated) of their conversations."""
    seen = stage(rows.groupBy("c", "d").agg(F.min("n").alias("seen")), "repair-seen")
    fault = (F.when(F.col("blank"), "blank").when(F.col("n") > F.col("seen"), "duplicate")
             .when(F.col("open"), "truncated"))
    named = rows.select("c", "n", "role", "d", "blank", "open").join(seen, ["c", "d"]).withColumn("fault", fault)
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    symbol = lambda kinds: F.substring(F.lit(kinds), place, F.lit(1))
    named = stage(named.select("c", "n", "fault", F.when(F.col("fault").isNull(), symbol(SOUND)).when(
        F.col("fault") == "truncated", symbol(OPEN)).otherwise(symbol(GONE)).alias("symbol")), "repair-symbols")
    count = lambda kind: F.count(F.when(F.col("fault") == kind, 1)).alias(kind)
    facts = named.groupBy("c").agg(
        F.min("n").alias("first"), count("blank"), count("duplicate"), count("truncated"))
    return named.select("c", "n", "symbol"), stage(facts, "repair-facts")


def _spans(df: DataFrame, function) -> DataFrame:
    """(c, chunk, line) from (c, chunk, text) by a function of the text, remembered by worker."""
    def make():
        memo = kept(function.__name__, lambda: Memo(lambda found: map(function, found), 5_000))

        def fn(batch):
            memo.learn(set(batch["text"]))
            return {"c": batch["c"], "chunk": batch["chunk"], "line": [memo.young[t] for t in batch["text"]]}

        return fn

    return map_texts(df.select("c", "chunk", "text"), make, "c string, chunk long, line string")


def _gathered(df: DataFrame, chunk: Column, order: str, value: str, between: str) -> DataFrame:
    """(c, chunk, text): the values of each chunk in order; a chunk has a bounded number of them."""
    listed = F.array_sort(F.collect_list(F.struct(order, value)))
    return df.groupBy("c", chunk.cast("long").alias("chunk")).agg(
        F.array_join(F.transform(listed, lambda x: x[value]), between).alias("text"))


def audits(symbols: DataFrame, facts: DataFrame) -> DataFrame:
    """(c, cost, audit, illegal) of every conversation."""
    # Staged, so that the chunks of one large conversation are dealt out anew behind the join.
    placed = stage(symbols.join(facts.select("c", "first"), "c").select(
        "c", "symbol", (F.col("n") - F.col("first")).alias("at")), "repair-placed")
    spans = stage(_spans(_gathered(placed, F.floor(F.col("at") / CHUNK), "at", "symbol", ""), span_of), "repair-spans")
    while not spans.where("chunk > 0").isEmpty():
        spans = stage(_spans(
            _gathered(spans, F.floor(F.col("chunk") / FAN), "chunk", "line", "\n"), joined_spans), "repair-spans")

    def make():
        def fn(batch):
            found = [json.loads(x) for x in batch["line"]]
            best = [cheapest({(p, q): (cost, audit) for p, q, cost, audit in x[0]}) for x in found]
            return {"c": batch["c"], "illegal": [x[1] for x in found], "cost": [b[0] for b in best],
                    "audit": [b[1] for b in best]}

        return fn

    return stage(map_texts(spans, make, "c string, illegal long, cost long, audit string", "line"), "repair-audits")


_EDIT = "c string, seq long, edit string, n long, role string"


def edits(found: DataFrame) -> DataFrame:
    """(c, seq, edit, n, role): the edits of each conversation (c, first, audit) in order; ``n`` is the row's
    number (null: an inserted turn), ``role`` what the edit gives (null: the row keeps its own)."""
    ship(found.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(_EDIT))

    def run(batches):
        held = []
        for batch in batches:
            for r in batch.to_pylist():
                for seq, (edit, at, role) in enumerate(roles_of(r["audit"])):
                    held.append((r["c"], seq, edit, None if at is None else r["first"] + at, role))
                    if len(held) == EDITS:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x, f.type) for x, f in zip(zip(*held), arrow)], schema=arrow)
                        held.clear()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), arrow)], schema=arrow)

    return found.select("c", "first", "audit").mapInArrow(run, _EDIT)


def repaired(conversations: DataFrame):
    """The repaired rows (c, seq, edit, role, text) in order of ``seq``, and one row of figures for each
    conversation: c, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    rows = _numbered(conversations)
    symbols, facts = _symbols(rows)
    found = audits(symbols, facts)
    turns = rows.where("turn IS NOT NULL").select("c", "turn").distinct().groupBy("c").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    figures = found.join(facts, "c").join(turns, "c", "left").select(
        "c", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    done = edits(found.join(facts, "c")).where("edit <> 'D'")
    lines = done.where("edit <> 'I'").join(rows.select("n", F.col("role").alias("own"), "text"), "n").select(
        "c", "seq", "edit", F.coalesce("role", "own").alias("role"), "text")
    new = done.where("edit = 'I'").select("c", "seq", "edit", "role", F.lit("").alias("text"))
    return lines.unionByName(new), figures


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, the figures and repaired_sha256 of every conversation, damaged and repaired."""
    lines, figures = repaired(damaged(conversations))
    hashes = joined_sha256(
        lines.withColumn("line", F.concat("role", F.lit(":"), "text")), "c", ["seq"], "line").withColumnRenamed(
        "sha256", "repaired_sha256")
    own = conversations.select("conv_id", _key()).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return own.join(figures, "c", "left").join(hashes, "c", "left").select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
