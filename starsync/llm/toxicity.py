"""Toxicity by weak supervision.

1. *Voters.*  Word stems that are typical of toxic documents are found in labelled documents of
   the training fold (counted in the tasks, the best ``STEMS`` kept); with a public word list they
   are the lexicon voters.  Pattern voters look at how dense and how varied the hits are, and some
   of them vote for "clean".
2. *Label model.*  A generative model of all votes given the unknown class, fitted by expectation
   maximisation, estimates how accurate each voter is; a forest of voter pairs (largest mutual
   information given the class) carries their correlations, so voters that repeat each other do
   not count twice.  A given label is one more voter, of fixed accuracy.
3. *Classifier.*  A logistic regression on hit densities is trained on the posterior labels and
   scores every document in the tasks that scan it.

What reaches the driver are the best stems and the votes of at most ``SAMPLE_ROWS`` labelled
documents; nothing there grows with the corpus.

Defined cases: a null text is an empty one; without usable labels the public word list votes alone;
repeated rows are scored each; an empty table gives no rows; other columns are ignored.
"""

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsync.llm.common import aside, in_training_fold, labelled_sample, map_texts

#: Most labelled rows that stems, label model and classifier are fitted on.
SAMPLE_ROWS = 20_000
#: Most stems that are kept as voters.
STEMS = 120
#: Lengths of the word beginnings that may become a stem ("$" at the end: the whole word).
STEM_LENGTHS = range(3, 10)
#: A stem must stand in this many toxic documents and be this much denser there.
MIN_DOCS = 4
MIN_LIFT = 8.0
#: Occurrences of a stem in one document that count.
BURST = 5
#: Best stems by gain among which those that overlap are left out.
CANDIDATES = 4000
LABEL_ACCURACY = 0.97
#: Words of the public lexicon: insults that are common to published toxicity word lists.
LEXICON = (
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "scum", "trash",
    "garbage", "worthless", "pathetic", "disgusting", "clown", "imbecile", "jerk", "bastard",
    "filth", "vermin", "hate", "ugly",
)
_WORD = re.compile(r"[^\W\d_]+")


def letter_words(text) -> Counter:
    return Counter(_WORD.findall((text or "").lower()))


def beginnings(word):
    """The stems a word has: its beginnings, and itself with an end mark."""
    return [word[:k] for k in STEM_LENGTHS if k <= len(word)] + [word + "$"]


class Hits:
    """Finds the longest known stem of each word; remembers words it has seen."""

    def __init__(self, stems, remember=200_000):
        self.index = {s: i for i, s in enumerate(stems)}
        self.seen, self.remember = {}, remember

    def stem(self, word):
        found = self.seen.get(word, -2)
        if found == -2:
            if len(self.seen) >= self.remember:
                self.seen.clear()
            found = max((i for i in (self.index.get(b, -1) for b in reversed(beginnings(word)))
                         if i >= 0), default=-1, key=lambda i: len(self.names[i]))
            self.seen[word] = found
        return found

    @property
    def names(self):
        return list(self.index)

    def counts(self, text):
        """Words of the text, and how often each stem begins one of them."""
        words = letter_words(text)
        found = Counter()
        for word, n in words.items():
            i = self.stem(word)
            if i >= 0:
                found[i] += n
        return words.total(), found


def features(n_words, found, weights):
    """Inputs of the classifier: densities of the hits (per hundred words) and their variety."""
    per = 100.0 / max(n_words, 1)
    own = np.zeros(len(weights) + 4)
    for i, n in found.items():
        own[i] = min(n * per, 5.0)
    total = sum(found.values())
    weighted = sum(n * weights[i] for i, n in found.items())
    own[-4] = min(total * per, 5.0)
    own[-3] = min(weighted * per, 15.0)
    own[-2] = min(len(found), 5)
    own[-1] = 1.0 if total * per >= 1.0 else 0.0
    return own


def votes(n_words, found, n_stems):
    """-1 clean, 0 no opinion, 1 toxic: one vote for each stem, then those of the patterns."""
    own = np.zeros(n_stems + 5, dtype=np.int8)
    per = 100.0 / max(n_words, 1)
    total = sum(found.values())
    dense = total * per
    for i in found:
        own[i] = 1 if dense >= 0.5 else 0
    own[n_stems] = 1 if dense >= 1.2 else -1 if dense < 0.6 else 0
    own[n_stems + 1] = 1 if len(found) >= 3 and dense >= 0.8 else 0
    own[n_stems + 2] = -1 if not total else 0
    own[n_stems + 3] = -1 if n_words >= 200 and dense < 0.8 else 0
    own[n_stems + 4] = 1 if total >= 2 and dense >= 2.5 else 0
    return own


def _one_hot(cast):
    return np.stack([(cast == v) for v in (-1, 0, 1)], axis=2).astype(float)


def dependency_forest(hot, posterior, least=0.02):
    """Parent of each voter (-1: none): maximum spanning forest of the correlations given the class."""
    n, m, _ = hot.shape
    flat = hot.reshape(n, m * 3)
    information = np.zeros((m, m))
    for weight in (posterior, 1 - posterior):
        share = weight.sum() / n
        if share < 1e-6:
            continue
        joint = ((flat * weight[:, None]).T @ flat) / weight.sum()
        single = np.diag(joint).copy()
        with np.errstate(divide="ignore", invalid="ignore"):
            part = joint * np.log(joint / (single[:, None] * single[None, :]))
        part = np.nan_to_num(part, nan=0.0, posinf=0.0, neginf=0.0)
        information += share * part.reshape(m, 3, m, 3).sum(axis=(1, 3))
    parent = np.full(m, -1)
    inside = np.zeros(m, dtype=bool)
    best, link = np.full(m, -1.0), np.full(m, -1)
    for _ in range(m):
        j = int(np.argmax(np.where(inside, -np.inf, best)))
        inside[j] = True
        parent[j] = link[j] if best[j] >= least else -1
        closer = ~inside & (information[j] > best)
        best[closer], link[closer] = information[j][closer], j
    return parent


def label_model(cast, start, given=None, steps=12):
    """Posterior probability of "toxic" for each row of votes.

    ``start`` is a first guess of it.  Voters are first taken as independent; then the forest of
    correlated pairs is learned and each voter's accuracy becomes conditional on its parent's vote.
    """
    cast = np.asarray(cast)
    hot = _one_hot(cast)
    n, m, _ = hot.shape
    code = cast + 1
    posterior = np.asarray(start, dtype=float)
    parent = np.full(m, -1)
    for phase in range(2):
        if phase:
            parent = dependency_forest(hot, posterior)
        for _ in range(steps):
            log_odds = np.full(n, np.log((posterior.sum() + 1) / (n - posterior.sum() + 1)))
            for j in range(m):
                p = parent[j]
                key = code[:, j] + (3 * code[:, p] if p >= 0 else 0)
                size = 9 if p >= 0 else 3
                tables = []
                for weight in (posterior, 1 - posterior):
                    t = np.bincount(key, weight, size).reshape(-1, 3) + 0.5
                    tables.append(np.log(t / t.sum(axis=1, keepdims=True)).ravel())
                log_odds += (tables[0] - tables[1])[key]
            if given is not None:
                known = np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
                log_odds += np.where(given == 1, known, np.where(given == 0, -known, 0.0))
            posterior = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return posterior


def logistic(x, target, ridge=1.0, steps=30):
    """Weights and bias of a logistic regression on soft targets (Newton steps)."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (target - p) - penalty * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _stem_counter():
    def fn(rows):
        docs, toxic, clean = Counter(), Counter(), Counter()
        for text, label in zip(rows["text"], rows["label"]):
            words, own = letter_words(text), Counter()
            for word, n in words.items():
                for s in beginnings(word):
                    own[s] += n
            into = toxic if label else clean
            for s, n in own.items():
                into[s] += min(n, BURST)
            if label:
                docs.update(own.keys())
            into[""] += words.total()  # the empty stem counts all words
        names = list(clean.keys() | toxic.keys())
        return {"stem": names, "docs": [docs[s] for s in names],
                "toxic": [toxic[s] for s in names], "clean": [clean[s] for s in names]}

    return fn


def find_stems(sample: DataFrame, most=STEMS) -> list:
    """(stem, weight) of the stems most typical of toxic documents, at most ``most`` of them.

    The weight is the log of how much denser the stem is in toxic text than in clean text.  A stem
    is left out when a better one is a beginning of it, or it of a better one.
    """
    from starsync.session import stage

    counted = stage(
        map_texts(sample, _stem_counter, "stem string, docs long, toxic long, clean long")
        .groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("docs", "toxic", "clean")]),
        "toxicity-stems")
    words = counted.where("stem = ''").first()
    if not words or not words.toxic or not words.clean:
        return []
    weight = F.log((F.col("toxic") / words.toxic) / ((F.col("clean") + 0.5) / words.clean))
    best = (
        counted.where((F.col("stem") != "") & (F.col("docs") >= MIN_DOCS))
        .withColumn("weight", weight).where(F.col("weight") >= np.log(MIN_LIFT))
        .withColumn("gain", F.col("toxic") * F.col("weight"))
        .orderBy(F.desc("gain"), F.desc(F.length("stem")), "stem").limit(CANDIDATES).collect()
    )
    kept = {}
    for r in best:
        stem = r.stem
        if len(kept) < most and not any(k.startswith(stem) or stem.startswith(k) for k in kept):
            kept[stem] = min(float(r.weight), 6.0)
    return list(kept.items())


def train(docs: DataFrame, labels: DataFrame, label="toxic", rows=SAMPLE_ROWS) -> dict:
    """Voters, label model and classifier from at most ``rows`` labelled documents."""
    from starsync.session import stage

    sample = stage(labelled_sample(docs, labels, label, rows), "toxicity-sample")
    found = dict(find_stems(sample))  # at most STEMS
    stems = list(found) + [w + "$" for w in LEXICON if w + "$" not in found]
    weights = [found.get(s, 3.0) for s in stems]
    model = {"stems": stems, "weights": weights, "linear": None}

    def make():
        hits = Hits(stems)

        def fn(batch):
            out = [hits.counts(t) for t in batch["text"]]
            return {"n": [n for n, _ in out], "at": [list(c) for _, c in out],
                    "hit": [list(c.values()) for _, c in out], "label": batch["label"]}

        return fn

    seen = map_texts(sample, make, "n long, at array<int>, hit array<long>, label int")
    # At most ``rows`` short rows of stem numbers and counts.
    seen = sorted((r.n, tuple(sorted(zip(r.at, r.hit))), r.label) for r in seen.collect())
    if seen and len({y for _, _, y in seen}) == 2:
        given = np.array([y for _, _, y in seen])
        cast = np.array([votes(n, dict(c), len(stems)) for n, c, _ in seen])
        x = np.array([features(n, dict(c), weights) for n, c, _ in seen])
        start = np.clip(0.05 + 0.4 * (x[:, -4] >= 1.0) + 0.4 * (given == 1), 0.02, 0.95)
        model["linear"] = logistic(x, label_model(cast, start, given))
    return model


def probability(model, n_words, found) -> float:
    x = features(n_words, found, model["weights"])
    if model["linear"] is None:  # no usable labels: the word list and its density decide
        z = 4.0 * x[-4] - 3.0
    else:
        z = float(x @ model["linear"][:-1] + model["linear"][-1])
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def with_scores(docs: DataFrame, model: dict, columns) -> DataFrame:
    """The given columns of every row of ``docs`` and its score."""
    def make():
        hits = Hits(model["stems"])

        def fn(batch):
            scores = [probability(model, *hits.counts(t)) for t in batch["text"]]
            return {c: batch[c] for c in columns} | {"_score": scores}

        return fn

    slim = docs.select(*dict.fromkeys([*columns, "text"]))
    kinds = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in columns)
    return map_texts(slim, make, f"{kinds}, _score double")


def accepted(docs: DataFrame, model: dict, cut=0.7) -> DataFrame:
    """The rows of ``docs`` below the cutoff, with all their columns."""
    inner, outer = aside(docs)
    return outer(with_scores(inner, model, inner.columns).where(F.col("_score") < cut))


def score(docs: DataFrame, labels: DataFrame, rows=SAMPLE_ROWS, cut=0.7) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``."""
    scored = with_scores(docs, train(docs, labels, rows=rows), ["doc_id"])
    return scored.select(
        "doc_id", (~in_training_fold()).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= cut).cast("int").alias("predicted"))
