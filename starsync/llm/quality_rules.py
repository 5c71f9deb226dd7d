"""Quality rules with adaptive cutoffs.

Every document gets five counts, and four ratios from them.  For each ratio a mergeable quantile
sketch is kept per (lang, source): logarithmic buckets of relative width ``GAMMA`` and their
counts, so that adding two sketches is adding counts (the tasks do that before the shuffle).
Adding the sketches of a language's sources gives the language's sketch, and adding those gives
the corpus'.  Cutoffs are fences around the middle half of a sketch; a group with few rows takes
the cutoffs of its language, or of the corpus.  The cutoffs are joined to the documents.

Defined cases: a null text is an empty one (no words, base_failed); null lang or source is a group
of its own; repeated rows count as often as they stand there; an empty table gives no rows and
other columns are ignored.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsync.llm.common import map_texts
from starsync.session import stage

#: Relative width of a sketch bucket: quantiles are right to about half of it.
GAMMA = 1.02
#: Bucket of the value 0 (below every other bucket).
ZERO = -100_000
#: Groups with fewer rows use the sketch of their language, then that of the corpus.
MIN_ROWS = 200
#: A cutoff lies this many interquartile ranges outside the middle half ...
SPREAD = 3.0
#: ... and at least this far from it, so that a group whose values are all equal keeps a margin.
SLACK = {"symbols": 0.1, "word_length": 1.5, "dup_lines": 0.3, "repeats": 0.4}
#: Rules that also have a lower cutoff.
TWO_SIDED = ("word_length",)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Copies of each row of cutoffs, so that one source with most of the rows is dealt to many tasks.
SALTS = 16

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _counter():
    from starsync.llm.textstats import base_counts

    names = [c.split()[0] for c in COUNTS.split(", ")]

    def fn(rows):
        counted = [base_counts(t) for t in rows.pop("text")]
        return rows | {n: [c[i] for c in counted] for i, n in enumerate(names)}

    return fn


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the five counts of every whole text; the text itself stays behind."""
    slim = docs.select("doc_id", "lang", "source", "text")
    ids = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema if f.name != "text")
    return map_texts(slim, _counter, f"{ids}, {COUNTS}")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def ratios() -> dict:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "symbols": F.col("n_symbols") / words,
        "word_length": F.col("word_chars") / words,
        "dup_lines": F.col("n_dup_lines") * 10.0 / words,
        "repeats": F.col("n_repeat_words") / words,
    }


def bucket(value: Column) -> Column:
    """The sketch bucket of a value of 0 or more."""
    return F.when(value <= 0, F.lit(ZERO)).otherwise(
        F.ceil(F.log(value) / F.lit(math.log(GAMMA))).cast("int"))


def bucket_value(b: Column) -> Column:
    return F.when(b == ZERO, F.lit(0.0)).otherwise(
        F.pow(F.lit(GAMMA), b.cast("double")) * F.lit(2.0 / (GAMMA + 1)))


def sketches(counts: DataFrame) -> DataFrame:
    """(level, lang, source, rule, bucket, n): sketches of the sources, the languages, the corpus.

    ``level`` is 0 for a source, 1 for a language, 3 for the corpus.  Only documents that pass the
    base rules are sketched: the others are gone anyway and would pull the cutoffs towards them.
    """
    values = F.array(*[
        F.struct(F.lit(name).alias("rule"), bucket(value).alias("bucket"))
        for name, value in ratios().items()])
    leaves = (
        counts.where(~base_failed()).select("lang", "source", F.explode(values).alias("v"))
        .groupBy("lang", "source", "v.rule", "v.bucket").agg(F.count(F.lit(1)).alias("n"))
    )
    return leaves.groupingSets(
        [["lang", "source", "rule", "bucket"], ["lang", "rule", "bucket"], ["rule", "bucket"]],
        "lang", "source", "rule", "bucket",
    ).agg(F.sum("n").alias("n"),
          (F.grouping("lang") * 2 + F.grouping("source")).cast("int").alias("level"))


def quartiles(sketch: DataFrame) -> DataFrame:
    """(level, lang, source, rule, rows, q1, q3) read from the sketches."""
    group = Window.partitionBy("level", "lang", "source", "rule")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sketch.withColumn("upto", F.sum("n").over(upto)).withColumn("rows", F.sum("n").over(group))

    def at(q):
        rank = F.floor((F.col("rows") - 1) * F.lit(q))
        return bucket_value(F.min(F.when(F.col("upto") > rank, F.col("bucket"))))

    return ranked.groupBy("level", "lang", "source", "rule", "rows").agg(
        at(0.25).alias("q1"), at(0.75).alias("q3"))


def cutoffs(counts: DataFrame, min_rows=MIN_ROWS) -> DataFrame:
    """(lang, source, low_<rule>, high_<rule>) for every source: bounded by the sources."""
    margin = F.create_map(*[x for k, v in SLACK.items() for x in (F.lit(k), F.lit(v))])[F.col("rule")]
    width = F.greatest((F.col("q3") - F.col("q1")) * SPREAD, margin)
    fences = quartiles(sketches(counts)).select(
        "level", "lang", "source", "rule", "rows",
        F.when(F.col("rule").isin(*TWO_SIDED), F.col("q1") - width).alias("low"),
        (F.col("q3") + width).alias("high"))

    def wide(level, keys):
        aggs = [F.max("rows").alias(f"rows_{level}")]
        for rule in SLACK:
            own = F.col("rule") == rule
            aggs += [F.max(F.when(own, F.col("low"))).alias(f"low_{rule}_{level}"),
                     F.max(F.when(own, F.col("high"))).alias(f"high_{rule}_{level}")]
        return fences.where(F.col("level") == level).groupBy(*keys).agg(*aggs)

    sources, corpus = wide(0, ["lang", "source"]), wide(3, [])
    langs = wide(1, ["lang"]).withColumnRenamed("lang", "_lang")
    whole = corpus.select(F.struct(*corpus.columns).alias("c")).scalar()  # one row
    joined = sources.join(langs, F.col("lang").eqNullSafe(F.col("_lang")), "left").withColumn(
        "_c", whole).select("*", "_c.*")
    pick = lambda name: (
        F.when(F.col("rows_0") >= min_rows, F.col(f"{name}_0"))
        .when(F.col("rows_1") >= min_rows, F.col(f"{name}_1"))
        .otherwise(F.col(f"{name}_3")).alias(name))
    return joined.select(
        "lang", "source", *[pick(f"{end}_{rule}") for rule in SLACK for end in ("low", "high")])


def apply_rules(docs: DataFrame, min_rows=MIN_ROWS) -> DataFrame:
    """doc_id, the five counts, base_failed, kept: one row for each row of ``docs``."""
    counts = stage(text_counts(docs), "quality-counts")
    limits = (
        cutoffs(counts, min_rows)
        .withColumnsRenamed({"lang": "_lang", "source": "_source"})
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = counts.withColumn(
        "_salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    joined = salted.join(limits, (
        F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
        & (salted["_salt"] == limits["_salt"])), "left")
    outside = F.lit(False)
    for rule, value in ratios().items():
        for end, far in (("low", value < F.col(f"low_{rule}")), ("high", value > F.col(f"high_{rule}"))):
            outside = outside | F.coalesce(far, F.lit(False))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & ~outside).alias("kept"))


#: The same rows in SQL.
SQL = r"""
WITH docs AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, lang, source, text,
  regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) >= 3),
keyed AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM windows),
again AS (SELECT doc_id, i FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words
  FROM again, (VALUES (0), (1), (2)) t(o) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (SELECT doc_id, lang, source, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id)),
based AS (SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
    n_symbols / greatest(n_words, 1)::DOUBLE AS symbols,
    word_chars / greatest(n_words, 1)::DOUBLE AS word_length,
    n_dup_lines * 10.0::DOUBLE / greatest(n_words, 1)::DOUBLE AS dup_lines,
    n_repeat_words / greatest(n_words, 1)::DOUBLE AS repeats FROM counts),
vals AS (SELECT lang, source, unnest(['symbols', 'word_length', 'dup_lines', 'repeats']) AS rule,
    unnest([symbols, word_length, dup_lines, repeats]) AS v FROM based WHERE NOT base_failed),
leaves AS (SELECT lang, source, rule,
    CASE WHEN v <= 0 THEN -100000 ELSE ceil(ln(v) / ln(1.02::DOUBLE))::INT END AS bucket FROM vals),
sketch AS (SELECT 2 * grouping(lang) + grouping(source) AS level, lang, source, rule, bucket,
    count(*) AS n FROM leaves
  GROUP BY GROUPING SETS ((lang, source, rule, bucket), (lang, rule, bucket), (rule, bucket))),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rule ORDER BY bucket) AS upto,
    sum(n) OVER (PARTITION BY level, lang, source, rule) AS rws FROM sketch),
quart AS (SELECT level, lang, source, rule, rws,
    min(CASE WHEN upto > floor((rws - 1) * 0.25) THEN bucket END) AS b1,
    min(CASE WHEN upto > floor((rws - 1) * 0.75) THEN bucket END) AS b3
  FROM ranked GROUP BY ALL),
qv AS (SELECT level, lang, source, rule, rws,
    CASE WHEN b1 = -100000 THEN 0 ELSE pow(1.02::DOUBLE, b1) * (2 / 2.02::DOUBLE) END AS q1,
    CASE WHEN b3 = -100000 THEN 0 ELSE pow(1.02::DOUBLE, b3) * (2 / 2.02::DOUBLE) END AS q3,
    CASE rule WHEN 'symbols' THEN 0.1 WHEN 'word_length' THEN 1.5 WHEN 'dup_lines' THEN 0.3
      ELSE 0.4 END::DOUBLE AS slack FROM quart),
fences AS (SELECT level, lang, source, rule, rws,
    CASE WHEN rule = 'word_length' THEN q1 - greatest((q3 - q1) * 3, slack) END AS low,
    q3 + greatest((q3 - q1) * 3, slack) AS high FROM qv),
chosen AS (SELECT s.lang, s.source, s.rule,
    CASE WHEN s.rws >= 200 THEN s.low WHEN l.rws >= 200 THEN l.low ELSE c.low END AS low,
    CASE WHEN s.rws >= 200 THEN s.high WHEN l.rws >= 200 THEN l.high ELSE c.high END AS high
  FROM fences s
  JOIN fences l ON l.level = 1 AND l.rule = s.rule AND l.lang IS NOT DISTINCT FROM s.lang
  JOIN fences c ON c.level = 3 AND c.rule = s.rule WHERE s.level = 0),
cut AS (SELECT lang, source,
    max(high) FILTER (rule = 'symbols') AS high_symbols,
    max(low) FILTER (rule = 'word_length') AS low_word_length,
    max(high) FILTER (rule = 'word_length') AS high_word_length,
    max(high) FILTER (rule = 'dup_lines') AS high_dup_lines,
    max(high) FILTER (rule = 'repeats') AS high_repeats FROM chosen GROUP BY ALL)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(symbols > high_symbols OR word_length < low_word_length
    OR word_length > high_word_length OR dup_lines > high_dup_lines OR repeats > high_repeats,
    false) AS kept
FROM based b LEFT JOIN cut c
  ON c.lang IS NOT DISTINCT FROM b.lang AND c.source IS NOT DISTINCT FROM b.source
"""
