"""Quality classifier: a generalised additive model with pairwise interactions.

``fit`` grows lookup tables by cyclic boosting: it goes round the features, and each time a
shallow tree over one feature's bins is fitted to the gradient and added to that feature's table.
Then the pairs whose grids still explain most of the gradient get tables of their own in the same
way.  A text's score is the sum of its bins' entries, taken for a whole batch at once.

Only the fit happens on the driver, on the features (``len(SHAPE)`` numbers a row) of at most
``SAMPLE_ROWS`` labelled documents of the training fold; scoring runs in the tasks that scan the
documents, without a shuffle.

Defined cases: a null text is an empty one, whose features are all 0; without a usable label every
score is 0.5, with labels of one kind only every score is their smoothed mean; repeated rows are
scored each; an empty table gives no rows; other columns are ignored.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsync.llm.common import in_training_fold, labelled_sample, map_texts
from starsync.llm.textstats import SHAPE

#: Most labelled rows that the fit uses (those with the smallest id hashes).
SAMPLE_ROWS = 20_000
BINS = 24
ROUNDS = 120
RATE = 0.15
PAIRS = 6
PAIR_ROUNDS = 40
PAIR_BINS = 8
RIDGE = 4.0


def bin_edges(values, bins):
    """Inner edges of about equally filled bins (fewer when values repeat)."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def to_bins(values, edges):
    return np.searchsorted(edges, values, side="right")


def _best_cut(g, h):
    """Gain and place of the best cut of a run of bins in two."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, None
    total_g, total_h = g.sum(), h.sum()
    gain = (left_g ** 2 / (left_h + RIDGE) + (total_g - left_g) ** 2 / (total_h - left_h + RIDGE)
            - total_g ** 2 / (total_h + RIDGE))
    at = int(np.argmax(gain))
    return (float(gain[at]), at + 1) if gain[at] > 1e-9 else (0.0, None)


def shallow_tree(g, h, depth=2):
    """Step function over bins: a tree of this depth fitted to gradients ``g`` with weights ``h``."""
    out = np.full(len(g), g.sum() / (h.sum() + RIDGE))
    _, at = _best_cut(g, h) if depth else (0.0, None)
    if at:
        out[:at] = shallow_tree(g[:at], h[:at], depth - 1)
        out[at:] = shallow_tree(g[at:], h[at:], depth - 1)
    return out


def shallow_grid(g, h):
    """Step function over a grid of bins: one cut along one axis, then one along the other."""
    best = (0.0, None, None)
    for axis in (0, 1):
        gain, at = _best_cut(g.sum(1 - axis), h.sum(1 - axis))
        if at and gain > best[0]:
            best = (gain, axis, at)
    _, axis, at = best
    if axis is None:
        return np.full(g.shape, g.sum() / (h.sum() + RIDGE))
    g, h = (g, h) if axis == 0 else (g.T, h.T)
    out = np.empty(g.shape)
    for rows in (slice(0, at), slice(at, None)):
        out[rows] = shallow_tree(g[rows].sum(0), h[rows].sum(0), depth=1)
    return out if axis == 0 else out.T


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x, y) -> dict:
    """Edges and tables of the model for features ``x`` (rows × features) and labels ``y``."""
    x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
    n = len(y)
    prior = (y.sum() + 0.5) / (n + 1)
    model = {"base": float(np.log(prior / (1 - prior))), "edges": [], "tables": [], "pairs": []}
    if not n or y.min() == y.max():
        return model
    score = np.full(n, model["base"])
    edges = [bin_edges(x[:, j], BINS) for j in range(x.shape[1])]
    bins = [to_bins(x[:, j], e) for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            p = _sigmoid(score)
            g = np.bincount(b, y - p, len(tables[j]))
            h = np.bincount(b, p * (1 - p), len(tables[j]))
            step = RATE * shallow_tree(g, h)
            tables[j] += step
            score += step[b]
    # Pairs: the grids on which the remaining gradient is explained best.
    coarse = [bin_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    cells = [to_bins(x[:, j], e) for j, e in enumerate(coarse)]
    p = _sigmoid(score)
    found = []
    for a in range(x.shape[1]):
        for b in range(a):
            shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
            at = cells[a] * shape[1] + cells[b]
            g = np.bincount(at, y - p, shape[0] * shape[1])
            h = np.bincount(at, p * (1 - p), shape[0] * shape[1])
            found.append((float((g ** 2 / (h + RIDGE)).sum()), a, b, shape, at))
    found.sort(key=lambda f: -f[0])
    pairs = [[a, b, np.zeros(shape), at] for _, a, b, shape, at in found[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for pair in pairs:
            grid, at = pair[2], pair[3]
            p = _sigmoid(score)
            g = np.bincount(at, y - p, grid.size).reshape(grid.shape)
            h = np.bincount(at, p * (1 - p), grid.size).reshape(grid.shape)
            step = RATE * shallow_grid(g, h)
            grid += step
            score += step.ravel()[at]
    return model | {"edges": edges, "tables": tables, "coarse": coarse,
                    "pairs": [(a, b, grid) for a, b, grid, _ in pairs]}


def predict(model, x):
    """Scores of the rows of ``x``: bin numbers by binary search, then additions of table entries."""
    x = np.asarray(x, dtype=float).reshape(-1, len(SHAPE))
    total = np.full(len(x), model["base"])
    for j, (e, t) in enumerate(zip(model["edges"], model["tables"])):
        total += t[to_bins(x[:, j], e)]
    if model["pairs"]:
        cells = [to_bins(x[:, j], e) for j, e in enumerate(model["coarse"])]
        for a, b, grid in model["pairs"]:
            total += grid[cells[a], cells[b]]
    return _sigmoid(total)


def _shaper():
    from starsync.llm.textstats import shape

    def fn(rows):
        return {"x": [shape(t) for t in rows["text"]], "label": rows["label"]}

    return fn


def train(docs: DataFrame, labels: DataFrame, label="quality", rows=SAMPLE_ROWS) -> dict:
    """Fit the model on at most ``rows`` labelled documents of the training fold."""
    sample = map_texts(
        labelled_sample(docs, labels, label, rows), _shaper, "x array<double>, label int")
    seen = sorted((tuple(r.x), r.label) for r in sample.collect())  # at most ``rows`` rows
    return fit([x for x, _ in seen], [y for _, y in seen])


def score(docs: DataFrame, labels: DataFrame, rows=SAMPLE_ROWS, cut=0.5) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``."""
    model = train(docs, labels, rows=rows)

    def make():
        from starsync.llm.textstats import shape

        def fn(batch):
            return {"doc_id": batch["doc_id"],
                    "score": predict(model, [shape(t) for t in batch["text"]]).tolist()}

        return fn

    slim = docs.select("doc_id", "text")
    scored = map_texts(slim, make, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select(
        "doc_id", (~in_training_fold()).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"))
