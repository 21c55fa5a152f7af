"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is an embedding of the word and the mean of the embeddings of its character n-grams,
both by hash bucket. Two gated recurrent units read a window of words in both directions, attention
weighs their states, and a logistic unit scores the window. A document's score comes from its
highest window: overlapping windows cover the whole text, and no word is left out.

Labels hold for documents, not for windows: in each epoch a toxic document trains with the window
that scores highest so far, the others with windows in turn. The scores are calibrated on the
training documents. Training takes at most ``train_rows`` labelled rows, those with the smallest
hash of their id, with all windows of each; scoring covers every window of every
document. Ids, languages, sources and labels are never inputs of a score.

Defined results: a null text is scored like an empty one, and an empty one like a window without
words; a document without an id is never held out; repeated rows are scored alike; contradicting
labels of an id count as 1; null labels are ignored. Without two kinds of labels every score is the
share of ones, or 0.5 without any. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrace.llm.common import map_arrow
from velotrace.llm.quality import labelled

#: Words of a window, and from one window's start to the next one's.
WIDTH, STRIDE = 64, 48
#: Labelled rows that training takes at most, with all windows of each.
TRAIN_ROWS = 9_000
WORD_BUCKETS, GRAM_BUCKETS, EMBEDDING, HIDDEN = 4096, 16_384, 8, 12
#: Different words whose inputs a task keeps; beyond, they are computed again.
KEPT_WORDS = 150_000

_WORD = re.compile("[^\x20\x09-\x0d]+")
_EDGES = ".,;:!?\"'()[]{}*#&%$|"


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def starts(n: int) -> list[int]:
    """Where the windows of n words start; the last one ends with the text."""
    if n <= WIDTH:
        return [0]
    return [*range(0, n - WIDTH, STRIDE), n - WIDTH]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """Buckets of a list of words; the n-grams of all words lie end to end."""

    bucket: np.ndarray
    grams: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(words: list[str], at_a_time: int = 20_000) -> "Words":
        """Words without the marks around them, and their character n-grams of 3 to 5 with the
        word's ends, many hashed at once."""
        if len(words) > at_a_time:
            parts = [Words.of(words[i : i + at_a_time]) for i in range(0, len(words), at_a_time)]
            sizes = np.concatenate([p.sizes() for p in parts])
            return Words(
                np.concatenate([p.bucket for p in parts]),
                np.concatenate([p.grams for p in parts]),
                np.cumsum(sizes) - sizes,
            )
        framed = [f"<{w.strip(_EDGES) or w}>" for w in words]
        codes = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.array([len(f) for f in framed], dtype=np.int64)
        begins = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(codes)) - begins[owner]
        powers = np.multiply.accumulate(np.full(int(lengths.max(initial=0)) + 1, 0x100000001B3, np.uint64))
        whole = np.add.reduceat(codes * powers[place], begins) if len(words) else codes
        owners, grams = [], []
        for n in (3, 4, 5):
            at = np.flatnonzero(place + n <= lengths[owner])
            hashed = sum(codes[at + k] * powers[k] for k in range(n)) + np.uint64(n)
            owners.append(owner[at])
            grams.append((_mixed(hashed) % np.uint64(GRAM_BUCKETS)).astype(np.int32))
        order = np.argsort(np.concatenate(owners), kind="stable")
        sizes = np.bincount(np.concatenate(owners), minlength=len(words))
        return Words(
            (_mixed(whole) % np.uint64(WORD_BUCKETS)).astype(np.int32),
            np.concatenate(grams)[order],
            np.cumsum(sizes) - sizes,
        )

    def sizes(self) -> np.ndarray:
        return np.diff(np.append(self.first, len(self.grams)))

    def take(self, which: np.ndarray) -> "Words":
        sizes = self.sizes()[which]
        first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        at = np.repeat(self.first[which] - first, sizes) + np.arange(sizes.sum())
        return Words(self.bucket[which], self.grams[at], first)


Weights = dict[str, np.ndarray]


def new_weights(rng: np.random.Generator) -> Weights:
    d, h = 2 * EMBEDDING, HIDDEN

    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    weights = {
        "word": normal(WORD_BUCKETS, EMBEDDING, scale=0.05),
        "gram": normal(GRAM_BUCKETS, EMBEDDING, scale=0.1),
        "Wa": normal(2 * h, 2 * h, scale=0.3),
        "va": normal(2 * h, scale=0.3),
        "out": normal(2 * h, scale=0.3),
        "bias": np.zeros(1, np.float32),
    }
    for way in "fb":
        weights[f"W{way}"] = normal(d, 3 * h, scale=0.3)
        weights[f"U{way}"] = normal(h, 3 * h, scale=0.2)
        weights[f"c{way}"] = np.zeros(3 * h, np.float32)
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def embed(weights: Weights, words: Words) -> np.ndarray:
    if not len(words.bucket):
        return np.zeros((0, 2 * EMBEDDING), np.float32)
    sums = np.add.reduceat(weights["gram"][words.grams], words.first, axis=0)
    mean = sums / words.sizes()[:, None].astype(np.float32)
    return np.hstack([weights["word"][words.bucket], mean])


def _read(weights: Weights, way: str, projected: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool):
    """The states of one direction, (windows, width, HIDDEN), and what the way back needs."""
    n, width = ids.shape
    u, size = weights[f"U{way}"], HIDDEN
    h = np.zeros((n, size), np.float32)
    states = np.zeros((n, width, size), np.float32)
    steps = range(width) if way == "f" else range(width - 1, -1, -1)
    kept = []
    for t in steps:
        x, hu = projected[ids[:, t]], h @ u
        zr = _sigmoid(x[:, : 2 * size] + hu[:, : 2 * size])
        z, r = zr[:, :size], zr[:, size:]
        new = np.tanh(x[:, 2 * size :] + r * hu[:, 2 * size :])
        m = mask[:, t, None]
        after = h + m * (1 - z) * (new - h)
        if keep:
            kept.append((t, h, z, r, new, hu[:, 2 * size :], m))
        h = after
        states[:, t] = h
    return states, kept


def _pool(weights: Weights, states: np.ndarray, mask: np.ndarray):
    inner = np.tanh(states @ weights["Wa"])
    scores = inner @ weights["va"]
    scores = np.where(mask > 0, scores, -1e9)
    e = np.exp(scores - scores.max(1, keepdims=True)) * mask
    attention = e / np.maximum(e.sum(1, keepdims=True), 1e-9)
    pooled = (attention[:, :, None] * states).sum(1)
    return inner, attention, pooled, pooled @ weights["out"] + weights["bias"][0]


def project(weights: Weights, inputs: np.ndarray) -> dict[str, np.ndarray]:
    return {w: (inputs @ weights[f"W{w}"] + weights[f"c{w}"]).astype(np.float32) for w in "fb"}


def window_logits(weights: Weights, projected: dict[str, np.ndarray], ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
    states = [_read(weights, w, projected[w], ids, mask, False)[0] for w in "fb"]
    return _pool(weights, np.concatenate(states, axis=2), mask)[3]


def loss_gradients(
    weights: Weights,
    words: Words,
    ids: np.ndarray,
    mask: np.ndarray,
    y: np.ndarray,
    known: np.ndarray | None = None,
):
    """Mean logistic loss of the windows, and its gradients; ids point into ``words``.

    ``known`` tells whose own embeddings count; the others are read by their characters only.
    """
    inputs = embed(weights, words)
    if known is not None:
        inputs[:, :EMBEDDING] *= known[:, None]
    projected = project(weights, inputs)
    reads = {w: _read(weights, w, projected[w], ids, mask, True) for w in "fb"}
    states = np.concatenate([reads[w][0] for w in "fb"], axis=2)
    inner, attention, pooled, logit = _pool(weights, states, mask)
    n = len(y)
    loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
    g: Weights = {}
    dlogit = ((_sigmoid(logit) - y) / n).astype(np.float32)
    g["bias"] = np.array([dlogit.sum()], np.float32)
    g["out"] = pooled.T @ dlogit
    dpooled = dlogit[:, None] * weights["out"]
    dstates = attention[:, :, None] * dpooled[:, None, :]
    dattention = states @ dpooled[:, :, None]
    dscores = attention * (dattention[:, :, 0] - (attention * dattention[:, :, 0]).sum(1, keepdims=True))
    g["va"] = np.einsum("nt,nth->h", dscores, inner)
    dinner = dscores[:, :, None] * weights["va"] * (1 - inner**2)
    g["Wa"] = np.einsum("nti,ntj->ij", states, dinner, optimize=True)
    dstates = dstates + dinner @ weights["Wa"].T

    size, dinputs = HIDDEN, np.zeros_like(inputs)
    for k, w in enumerate("fb"):
        u = weights[f"U{w}"]
        du = np.zeros_like(u)
        dprojected = np.zeros((len(inputs), 3 * size), np.float32)
        dh = np.zeros((n, size), np.float32)
        for t, h, z, r, new, hn, m in reversed(reads[w][1]):
            dh = dh + dstates[:, t, k * size : (k + 1) * size]
            dnew = dh * m * (1 - z) * (1 - new**2)
            dz = dh * m * (h - new) * z * (1 - z)
            dr = dnew * hn * r * (1 - r)
            dx = np.hstack([dz, dr, dnew])
            dhu = np.hstack([dz, dr, dnew * r])
            du += h.T @ dhu
            dh = dh * (1 - m * (1 - z)) + dhu @ u.T
            np.add.at(dprojected, ids[:, t], dx)
        g[f"U{w}"] = du
        g[f"W{w}"] = inputs.T @ dprojected
        g[f"c{w}"] = dprojected.sum(0)
        dinputs += dprojected @ weights[f"W{w}"].T
    if known is not None:
        dinputs[:, :EMBEDDING] *= known[:, None]
    g["word"] = np.zeros_like(weights["word"])
    np.add.at(g["word"], words.bucket, dinputs[:, :EMBEDDING])
    sizes = words.sizes()
    share = dinputs[:, EMBEDDING:] / sizes[:, None].astype(np.float32)
    g["gram"] = np.zeros_like(weights["gram"])
    np.add.at(g["gram"], words.grams, np.repeat(share, sizes, axis=0))
    return loss, g


@dataclass
class Model:
    """The weights, and the line that turns a document's highest logit into its score's."""

    weights: Weights | None
    slope: float = 1.0
    shift: float = 0.0

    def score(self, logits: np.ndarray) -> np.ndarray:
        return _sigmoid(np.clip(self.slope * logits + self.shift, -35, 35))


def _padded(windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    ids = np.zeros((len(windows), WIDTH), np.int32)
    mask = np.zeros((len(windows), WIDTH), np.float32)
    for i, w in enumerate(windows):
        ids[i, : len(w)] = w
        mask[i, : len(w)] = 1
    return ids, mask


def train(
    windows: Iterable[list[str]],
    document: np.ndarray,
    label: np.ndarray,
    epochs: int = 14,
    steps: int = 500,
    batch: int = 64,
    rate: float = 0.01,
    seed: int = 7,
) -> Model:
    """``document`` numbers the document of each window from 0; ``label`` is per document.

    Few rows are gone through more often, until there are ``steps`` updates.
    """
    share = float(label.mean()) if len(label) else 0.5
    if share in (0.0, 1.0) or not len(label):
        clipped = min(max(share, 1e-3), 1 - 1e-3) if len(label) else 0.5
        return Model(None, 0.0, float(np.log(clipped / (1 - clipped))))
    vocabulary = _Ids()
    ids, mask = _padded([np.array([vocabulary[t] for t in w], dtype=np.int32) for w in windows])
    words = Words.of(list(vocabulary))

    rng = np.random.default_rng(seed)
    weights = new_weights(rng)
    moment = {k: np.zeros_like(v) for k, v in weights.items()}
    square = {k: np.zeros_like(v) for k, v in weights.items()}
    first = np.searchsorted(document, np.arange(len(label)))
    count = np.bincount(document, minlength=len(label))
    positive, negative = np.flatnonzero(label == 1), np.flatnonzero(label == 0)

    def logits(which: np.ndarray) -> np.ndarray:
        found = []
        for part in np.array_split(which, max(1, len(which) // 512)):
            used, local = np.unique(ids[part], return_inverse=True)
            projected = project(weights, embed(weights, words.take(used)))
            found.append(window_logits(weights, projected, local.reshape(len(part), WIDTH), mask[part]))
        return np.concatenate(found)

    toxic_windows = np.flatnonzero(label[document] == 1)
    n_others = max(4 * len(positive), 500)
    per_epoch = -(-(len(positive) + min(n_others, len(negative))) // batch)
    epochs = max(epochs, -(-steps // per_epoch))
    step = 0
    for epoch in range(epochs):
        if epoch:
            best = np.full(len(document), -np.inf)
            best[toxic_windows] = logits(toxic_windows)
            picked = np.array([first[d] + int(np.argmax(best[first[d] : first[d] + count[d]])) for d in positive])
        else:
            picked = first[positive] + rng.integers(0, count[positive])
        others = rng.permutation(negative)[:n_others]
        others = first[others] + rng.integers(0, count[others])
        chosen = rng.permutation(np.concatenate([picked, others]))
        pace = rate * (1 - epoch / epochs) + rate / 20
        for at in range(0, len(chosen), batch):
            which = chosen[at : at + batch]
            used, local = np.unique(ids[which], return_inverse=True)
            _, g = loss_gradients(
                weights, words.take(used), local.reshape(len(which), WIDTH), mask[which],
                label[document[which]].astype(np.float32),
                (rng.random(len(used)) < 0.5).astype(np.float32),
            )
            step += 1
            for k, v in g.items():
                moment[k] = 0.9 * moment[k] + 0.1 * v
                square[k] = 0.99 * square[k] + 0.01 * v * v
                fixed = moment[k] / (1 - 0.9**step)
                weights[k] = weights[k] - pace * fixed / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
    return Model({k: v.astype(np.float32) for k, v in weights.items()})


def calibrate(model: Model, logits: np.ndarray, label: np.ndarray, steps: int = 60) -> Model:
    """A logistic line from the highest logit of each training document to its label."""
    if model.weights is None:
        return model
    x = np.column_stack([logits, np.ones(len(logits))]).astype(np.float64)
    line = np.array([1.0, 0.0])
    for _ in range(steps):
        p = _sigmoid(np.clip(x @ line, -35, 35))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        line = line - np.clip(np.linalg.solve(curve, x.T @ (p - label) + 0.05 * (line - [1, 0])), -1, 1)
    return Model(model.weights, float(line[0]), float(line[1]))


class _Ids(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = i = len(self)
        return i


class Reader:
    """Highest logits of texts; keeps the inputs of the words it has met."""

    def __init__(self, weights: Weights):
        self.weights, self.ids = weights, _Ids()
        self.projected = {w: np.zeros((1024, 3 * HIDDEN), np.float32) for w in "fb"}
        self.known = 0

    def _learn(self) -> None:
        words = list(self.ids)[self.known :]
        if not words:
            return
        new = project(self.weights, embed(self.weights, Words.of(words)))
        for w in "fb":
            if len(self.ids) > len(self.projected[w]):
                grown = np.zeros((2 * len(self.ids), 3 * HIDDEN), np.float32)
                grown[: self.known] = self.projected[w][: self.known]
                self.projected[w] = grown
            self.projected[w][self.known : len(self.ids)] = new[w]
        self.known = len(self.ids)

    def highest(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), -np.inf)
        queue: list[np.ndarray] = []
        owners: list[int] = []
        for i, text in enumerate(texts):
            words = np.array(list(map(self.ids.__getitem__, tokens(text))), dtype=np.int64)
            for at in starts(len(words)):
                queue.append(words[at : at + WIDTH])
                owners.append(i)
                if len(queue) == 1024:
                    self._flush(queue, owners, out)
        self._flush(queue, owners, out)
        if len(self.ids) > KEPT_WORDS:
            self.ids, self.known = _Ids(), 0
        return out

    def _flush(self, queue: list[np.ndarray], owners: list[int], out: np.ndarray) -> None:
        if queue:
            self._learn()
            ids, mask = _padded(queue)
            np.maximum.at(out, owners, window_logits(self.weights, self.projected, ids, mask))
            queue.clear()
            owners.clear()


def fit(documents: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, train_rows: int = TRAIN_ROWS) -> Model:
    """A model of labels.toxic from rows outside the held-out fold."""
    rows = labelled(documents, labels, "toxic", folds, fold, train_rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kinds, parts = [], [], []
            for i, text, label in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "label"))):
                words = tokens(text)
                for at in starts(len(words)):
                    ids.append(i)
                    kinds.append(label)
                    parts.append(" ".join(words[at : at + WIDTH]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(kinds, pa.int32()), pa.array(parts, pa.string())],
                ["doc_id", "label", "words"],
            )

    found = rows.mapInArrow(cut, "doc_id long, label int, words string").toPandas()
    found = found.drop_duplicates().sort_values(["doc_id", "words"], kind="stable").reset_index(drop=True)
    document = found["doc_id"].rank(method="dense").to_numpy(dtype=np.int64) - 1
    label = found.groupby("doc_id")["label"].max().to_numpy(dtype=np.float32)
    model = train((w.split(" ") if w else [] for w in found["words"]), document, label)
    if model.weights is None:
        return model

    weights = model.weights

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(weights)
        for batch in batches:
            logits = reader.highest(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(logits, pa.float64())], ["label", "logit"])

    seen = rows.select("text", "label").mapInArrow(read, "label int, logit double").toPandas()
    seen = seen.sort_values(["logit", "label"])
    return calibrate(model, seen["logit"].to_numpy(), seen["label"].to_numpy(dtype=np.float64))


def score(documents: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The columns ``keep`` and the score, as ``name``, of every document; needs ``text``."""
    rows = documents.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, "text"])])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.weights) if model.weights is not None else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            logits = reader.highest(texts) if reader else np.zeros(len(texts))
            values = pa.array(model.score(logits), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.select(list(keep)).columns, values], [*keep, name])

    return map_arrow(rows, scored, rows.select(*[F.col(f"`{c}`") for c in keep]).schema.add(name, "double"))
