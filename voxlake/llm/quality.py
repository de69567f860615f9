"""Quality classifier: a generalised additive model with pairwise interactions.

Every whole text becomes about twenty shape features, each cut into at most 32 bins. Training boosts cyclically: in each
round every feature gets one shallow tree (up to three leaves) on the current gradients, which is added to the feature's
lookup table at a small rate; then the pairs of features that explain most of what is left get tables of their own by
the same cycle. A score is the intercept plus one table look-up for each feature and pair, through a sigmoid.

The model is fitted on the driver on a sample of labelled rows bounded by `max_fit` (about so many, chosen by a hash of
the id); features of the sample are computed on the executors. All texts are scored.

Defined results: null and empty texts score like any other (their features are zeros); labels that are null are
ignored and repeated labels of one id are averaged; without labels every score is 0.5; with one kind of label only the
score is constant.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import bounded_batches, spans, text_buffer
from voxlake.llm.shingles import SPACE, word_bounds, word_hashes

FEATURES = [
    "log_bytes", "letters", "upper", "digits", "spaces", "high_bytes", "lines_per_word", "word_bytes", "word_bytes_sd", "stops", "commas", "shouts",
    "bars", "symbols", "quotes", "brackets", "other", "distinct_words", "repeats", "top_word", "distinct_lines",
]
_CLASS = {
    "upper": range(65, 91), "lower": range(97, 123), "digits": range(48, 58), "high": range(128, 256), "tail": range(128, 192), "newline": [10],
    "stops": b".;:?", "commas": b",", "shouts": b"!", "bars": b"|", "symbols": b"#$%&*@+=~^<>\\", "quotes": b"\"'`", "brackets": b"()[]{}", "other": b"-_/",
}
_TABLES = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASS.items()}


def _byte_counts(data: np.ndarray, offsets: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """How often each byte stands in each text: one row of 256 numbers for a text."""
    out = np.zeros((len(offsets) - 1, 256))
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        for at in range(a, b, block):
            out[i] += np.bincount(data[at : min(b, at + block)], minlength=256)
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text of a buffer."""
    bytes_of = _byte_counts(data, offsets)
    count = {k: bytes_of @ t for k, t in _TABLES.items()}
    count["space"] = bytes_of @ SPACE
    size = np.diff(offsets).astype(float)
    chars = np.maximum(size - count["tail"], 1)
    words, first = word_hashes(data, offsets)
    n = np.diff(first).astype(float)
    some = np.maximum(n, 1)
    letters = count["upper"] + count["lower"] + count["high"] - count["tail"]
    per_word = {k: count[k] / some for k in ("stops", "commas", "shouts", "bars", "symbols", "quotes", "brackets", "other")}
    starts, ends, _ = word_bounds(data, offsets)
    lengths = (ends - starts).astype(float)
    distinct, repeats, top, lines, spread = (np.zeros(len(n)) for _ in range(5))
    for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        if b > a:
            own = words[a:b]
            _, times = np.unique(own, return_counts=True)
            distinct[i], top[i] = len(times) / (b - a) ** 0.75, times.max() / (b - a)
            repeats[i] = (own[1:] == own[:-1]).sum() / (b - a)
            spread[i] = lengths[a:b].std()
        own = data[offsets[i] : offsets[i + 1]].tobytes().split(b"\n")
        lines[i] = len(set(own)) / len(own)
    columns = {
        "log_bytes": np.log1p(size), "letters": letters / chars, "upper": count["upper"] / np.maximum(letters, 1), "digits": count["digits"] / chars, "spaces": count["space"] / chars,
        "high_bytes": count["high"] / np.maximum(size, 1), "lines_per_word": count["newline"] / some, "word_bytes": (size - count["space"]) / some, "word_bytes_sd": spread,
        "distinct_words": distinct, "repeats": repeats, "top_word": top, "distinct_lines": lines, **per_word,
    }
    return np.stack([columns[k] for k in FEATURES], axis=1)


@dataclass
class AdditiveModel:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        if self.edges:
            b = self.bins(x)
            for j, t in enumerate(self.tables):
                out += t[b[:, j]]
            for (j, k), t in zip(self.pairs, self.pair_tables, strict=True):
                out += t[b[:, j], b[:, k]]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _leaves(g: np.ndarray, h: np.ndarray, leaves: int, least: float, ridge: float) -> np.ndarray:
    """Values of the best tree of up to `leaves` leaves over ordered bins with gradient sums g and hessian sums h."""
    cuts = [0, len(g)]
    gs, hs = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))

    def worth(a, b):
        return (gs[b] - gs[a]) ** 2 / (hs[b] - hs[a] + ridge)

    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at = np.arange(a + 1, b)
            at = at[(hs[at] - hs[a] >= least) & (hs[b] - hs[at] >= least)]
            if len(at):
                gain = worth(a, at) + worth(at, b) - worth(a, b)
                best = max(best, (float(gain.max()), int(at[gain.argmax()])))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.empty(len(g))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = -(gs[b] - gs[a]) / (hs[b] - hs[a] + ridge)
    return out


def fit(x: np.ndarray, y: np.ndarray, *, bins: int = 32, rounds: int = 250, rate: float = 0.1, pairs: int = 6, pair_rounds: int = 60, pair_bins: int = 8, least: float = 1.0, ridge: float = 1.0) -> AdditiveModel:
    """Cyclic boosting of shallow trees, first for each feature, then for the strongest pairs."""
    model = AdditiveModel()
    if not len(y):
        return model
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model.intercept = float(np.log(mean / (1 - mean)))
    if y.min() == y.max():
        return model
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    b = model.bins(x)
    size = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in size]
    raw = np.full(len(y), model.intercept)
    for _ in range(rounds):
        for j in range(x.shape[1]):
            p = 1 / (1 + np.exp(-raw))
            step = rate * _leaves(np.bincount(b[:, j], p - y, size[j]), np.bincount(b[:, j], p * (1 - p), size[j]), 3, least, ridge)
            model.tables[j] += step
            raw += step[b[:, j]]
    # pairs on coarser bins: rank them by what a table of the residual would gain
    coarse = [np.minimum(np.arange(s) * pair_bins // s, pair_bins - 1) for s in size]
    cell = lambda j, k: coarse[j][b[:, j]] * pair_bins + coarse[k][b[:, k]]
    p = 1 / (1 + np.exp(-raw))
    gain = []
    for j in range(x.shape[1]):
        for k in range(j):
            g, h = np.bincount(cell(k, j), p - y, pair_bins**2), np.bincount(cell(k, j), p * (1 - p), pair_bins**2)
            gain.append((float((g**2 / (h + ridge)).sum()), k, j))
    chosen = [(j, k) for _, j, k in sorted(gain, reverse=True)[:pairs]]
    grids = [np.zeros(pair_bins**2) for _ in chosen]
    for _ in range(pair_rounds):
        for (j, k), grid in zip(chosen, grids, strict=True):
            p, c = 1 / (1 + np.exp(-raw)), cell(j, k)
            g, h = np.bincount(c, p - y, pair_bins**2).reshape(pair_bins, -1), np.bincount(c, p * (1 - p), pair_bins**2).reshape(pair_bins, -1)
            # a tree that splits one feature and then, in each part, the other
            left = _leaves(g.sum(1), h.sum(1), 2, least, ridge)
            step = np.empty_like(g)
            for value in np.unique(left):
                rows = left == value
                step[rows] = _leaves(g[rows].sum(0), h[rows].sum(0), 2, least, ridge)
            grid += rate * step.ravel()
            raw += rate * step.ravel()[c]
    model.pairs = chosen
    model.pair_tables = [grid.reshape(pair_bins, -1)[np.ix_(coarse[j], coarse[k])] for (j, k), grid in zip(chosen, grids, strict=True)]
    return model


def _feature_rows(batches):
    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        x = np.concatenate([features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in spans(offsets)] or [np.zeros((0, len(FEATURES)))])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"])


def train(docs: DataFrame, labels: DataFrame, *, allowed: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_fit: int = 20_000, **options) -> AdditiveModel:
    """Fit on labelled documents; `allowed` is a condition on the labels' id that says which may be learnt from."""
    bounded_batches(docs.sparkSession)
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = (known.filter(allowed) if allowed is not None else known).groupBy(id_col).agg(F.avg(label_col).alias("y"))
    total = known.count()
    if not total:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    share = min(1.0, max_fit / total)
    part = known.filter(F.shiftrightunsigned(F.xxhash64(id_col, F.lit("fit")), 11) < int(share * 2**53)).select(F.col(id_col).alias("label_id"), "y")
    # the sample is bounded by max_fit, so its ids may be broadcast
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(part), F.col("id") == F.col("label_id")).select("y", "text")
    got = rows.mapInArrow(_feature_rows, "y double, x array<double>").toArrow()
    x = np.array(got["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    y = got["y"].to_numpy().astype(float)
    order = np.lexsort(x.T)  # the same sample gives the same model, whatever the order of its rows
    return fit(x[order], (y[order] >= 0.5).astype(float), **options)


def quality_scores(docs: DataFrame, model: AdditiveModel, *, text_col: str = "text") -> DataFrame:
    """docs with a column score (0 to 1)."""
    bounded_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != "score"]
    at, schema = keep.index(text_col), docs.select(*keep).schema.add("score", "double")

    def scored(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(at))
            score = [model.score(features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])) for a, b in spans(offsets)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(score) if score else np.zeros(0))], names=[*keep, "score"])

    return docs.select(*keep).mapInArrow(scored, schema)
