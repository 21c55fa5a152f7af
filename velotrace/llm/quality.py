"""Quality by a generalised additive model with pairwise interactions.

Each document is described by a few measures of its whole text. The model is a sum of lookup
tables, one per measure and one per chosen pair of measures, over bins of the training values.
Tables are learned by cyclic boosting: round after round, each table in turn is moved a little by a
shallow tree fitted to the gradients, first the single tables, then those of the pairs that explain
most of what is left. Scoring adds table entries for whole batches of documents.

Training takes at most ``train_rows`` labelled rows, those with the smallest hash of their id; every
document is scored. Ids, languages, sources and labels are never among the measures.

Defined results: a null text is scored like an empty one; a document without an id is never held
out; rows that repeat are scored alike; contradicting labels of an id count as 1; null labels are
ignored. Without two kinds of labels every score is the share of ones, or 0.5 without any. Other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrace.llm.common import map_arrow

#: Labelled rows that training takes at most.
TRAIN_ROWS = 20_000
_WORD = re.compile("[^\x20\x09-\x0d]+")

MEASURES = (
    "words",
    "word_length",
    "upper",
    "digits",
    "marks",
    "sentence_marks",
    "symbols",
    "bars",
    "shouts",
    "different_words",
    "top_word",
    "repeated_pairs",
    "repeated_lines",
    "lines",
    "sentence_ends",
    "marked_ends",
    "long_words",
    "short_words",
)

# Byte classes: which bytes a measure counts.
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "sentence_marks": b".,;:?",
    "symbols": b"#$%&*@^~_=+<>\\/{}[]",
    "bars": b"|",
    "shouts": b"!",
}
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_COUNTS = np.zeros((len(_CLASSES) + 1, 256))
for _row, _bytes in enumerate([*_CLASSES.values(), _MARKS]):
    _COUNTS[_row, list(_bytes)] = 1


def measure(text: str | None) -> list[float]:
    """The measures of one text, in the order of MEASURES."""
    text = text or ""
    words = _WORD.findall(text.lower())
    if not words:
        return [0.0] * len(MEASURES)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    chars = len(text)
    counted = dict(
        zip([*_CLASSES, "marks"], _COUNTS @ np.bincount(raw, minlength=256) / chars)
    )
    n = len(words)
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in text.split("\n") if line]
    lengths = np.array([len(w) for w in words])
    ends = Counter(map(itemgetter(-1), words))
    values = counted | {
        "words": float(n),
        "word_length": float(lengths.mean()),
        "different_words": len(seen) / n,
        "top_word": max(seen.values()) / n,
        "repeated_pairs": 1 - pairs / (n - 1) if n > 1 else 0.0,
        "repeated_lines": 1 - len(set(lines)) / len(lines) if lines else 0.0,
        "lines": len(lines) / n,
        "sentence_ends": (ends["."] + ends["?"] + ends[","]) / n,
        "marked_ends": sum(c for e, c in ends.items() if not e.isalnum() and e not in ".,?") / n,
        "long_words": float((lengths > 12).mean()),
        "short_words": float((lengths <= 3).mean()),
    }
    return [values[m] for m in MEASURES]


@dataclass
class Model:
    """Bin edges per measure, a table per measure, and tables for pairs of measures."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    single: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    double: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.column_stack(
            [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
        )

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.single:
            fine = self.bins(x, self.edges)
            for j, t in enumerate(self.single):
                total += t[fine[:, j]]
        if self.double:
            coarse = self.bins(x, self.coarse)
            for (i, j), t in zip(self.pairs, self.double):
                total += t[coarse[:, i], coarse[:, j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -35, 35)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _step(g: np.ndarray, h: np.ndarray, reg: float) -> np.ndarray:
    return -g / (h + reg)


def _line_tree(g: np.ndarray, h: np.ndarray, leaves: int, reg: float) -> np.ndarray:
    """A tree over ordered bins: the best cuts, one at a time, and a step for each part."""
    cuts = [0, len(g)]
    G, H = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(cuts) <= leaves:
        best, at = 1e-9, None
        for lo, hi in zip(cuts, cuts[1:]):
            if hi - lo < 2:
                continue
            k = np.arange(lo + 1, hi)
            gl, hl = G[k] - G[lo], H[k] - H[lo]
            gr, hr = G[hi] - G[k], H[hi] - H[k]
            whole = (G[hi] - G[lo]) ** 2 / (H[hi] - H[lo] + reg)
            gain = gl**2 / (hl + reg) + gr**2 / (hr + reg) - whole
            top = int(np.argmax(gain))
            if gain[top] > best:
                best, at = gain[top], int(k[top])
        if at is None:
            break
        cuts = sorted([*cuts, at])
    out = np.zeros(len(g))
    for lo, hi in zip(cuts, cuts[1:]):
        out[lo:hi] = _step(G[hi] - G[lo], H[hi] - H[lo], reg)
    return out


def _plane_tree(g: np.ndarray, h: np.ndarray, reg: float) -> tuple[float, np.ndarray]:
    """A cut on each axis and a step for each quadrant: the gain and the table."""
    G = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    H = np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    a, b = G[1:-1, 1:-1], H[1:-1, 1:-1]
    if not a.size:
        return 0.0, np.zeros_like(g)
    top, left = (G[1:-1, -1:], H[1:-1, -1:]), (G[-1:, 1:-1], H[-1:, 1:-1])
    parts = [
        (a, b),
        (top[0] - a, top[1] - b),
        (left[0] - a, left[1] - b),
        (G[-1, -1] - top[0] - left[0] + a, H[-1, -1] - top[1] - left[1] + b),
    ]
    gain = sum(p**2 / (q + reg) for p, q in parts) - G[-1, -1] ** 2 / (H[-1, -1] + reg)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.zeros_like(g)
    steps = [_step(p[i, j], q[i, j], reg) for p, q in parts]
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :] = steps[0], steps[1]
    out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = steps[2], steps[3]
    return float(gain[i, j]), out


def train(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 150,
    pair_rounds: int = 60,
    n_pairs: int = 8,
    bins: int = 64,
    pair_bins: int = 12,
    rate: float = 0.1,
    reg: float = 2.0,
) -> Model:
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        clipped = min(max(share, 1e-3), 1 - 1e-3) if len(y) else 0.5
        return Model(float(np.log(clipped / (1 - clipped))))
    model = Model(float(np.log(share / (1 - share))))
    m = x.shape[1]
    model.edges = [_edges(x[:, j], bins) for j in range(m)]
    model.coarse = [_edges(x[:, j], pair_bins) for j in range(m)]
    fine, coarse = model.bins(x, model.edges), model.bins(x, model.coarse)
    model.single = [np.zeros(len(e) + 1) for e in model.edges]
    margin = np.full(len(y), model.base)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j in range(m):
            g, h = gradients()
            n = len(model.single[j])
            tree = rate * _line_tree(
                np.bincount(fine[:, j], g, n), np.bincount(fine[:, j], h, n), 4, reg
            )
            model.single[j] += tree
            margin += tree[fine[:, j]]

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        cell = coarse[:, i] * shape[1] + coarse[:, j]
        return np.bincount(cell, values, shape[0] * shape[1]).reshape(shape)

    g, h = gradients()
    gains = [
        (_plane_tree(grid(i, j, g), grid(i, j, h), reg)[0], i, j)
        for i in range(m)
        for j in range(i + 1, m)
    ]
    model.pairs = [(i, j) for gain, i, j in sorted(gains, reverse=True)[:n_pairs] if gain > 0]
    model.double = [np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(model.pairs):
            g, h = gradients()
            tree = rate * _plane_tree(grid(i, j, g), grid(i, j, h), reg)[1]
            model.double[k] += tree
            margin += tree[coarse[:, i], coarse[:, j]]
    return model


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_labels(labels: DataFrame, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """(doc_id, label) of at most ``rows`` labelled documents outside the fold, by hash of the id."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    return (
        known.filter(~held_out(F.col("doc_id"), folds, fold))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )


def labelled(documents: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """(doc_id, text, label) of the training rows; a repeated document counts once.

    The labels are at most ``rows`` rows, so they are broadcast.
    """
    chosen = training_labels(labels, label, folds, fold, rows)
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def _measures(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        yield batch.select(keep), np.array([measure(t) for t in texts]).reshape(-1, len(MEASURES))


def fit(documents: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, train_rows: int = TRAIN_ROWS) -> Model:
    """A model of labels.quality from rows outside the held-out fold."""
    rows = labelled(documents, labels, "quality", folds, fold, train_rows)

    def measured(batches):
        for kept, x in _measures(batches, ["doc_id", "label"]):
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(MEASURES))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1), values.cast(pa.list_(pa.float64()))], ["doc_id", "label", "x"]
            )

    found = rows.mapInArrow(measured, "doc_id long, label int, x array<double>").toPandas()
    # Of several texts under one id the same is taken in every run.
    found["order"] = found["x"].map(tuple)
    found = found.sort_values(["doc_id", "label", "order"]).drop_duplicates("doc_id")
    x = np.array(found["x"].tolist()).reshape(-1, len(MEASURES))
    return train(x, found["label"].to_numpy(dtype=np.float64))


def score(
    documents: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), name: str = "score"
) -> DataFrame:
    """The columns ``keep`` and the score, as ``name``, of every document; needs ``text``."""
    columns = list(dict.fromkeys([*keep, "text"]))
    rows = documents.select(*[F.col(f"`{c}`") for c in columns])
    kept = rows.select(*[F.col(f"`{c}`") for c in keep])

    def scored(batches):
        for part, x in _measures(batches, list(keep)):
            values = pa.array(model.score(x) if len(x) else [], pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns, values], [*keep, name])

    return map_arrow(rows, scored, kept.schema.add(name, "double"))
