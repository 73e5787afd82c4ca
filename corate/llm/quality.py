"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (runs of ``passage_words`` words).  Each passage
is encoded from what it looks like: lengths, kinds of characters, repetition.
The encoding passes a hidden layer; gated attention,

    a_k  ~  exp(w . (tanh(V h_k) * sigmoid(U h_k)))  within the document,

weighs the passages; the score is a logistic function of sum a_k h_k.  All
weights are learned from document labels alone, by backpropagation in numpy on a
bounded sample: every passage of ``per_label`` documents of each label.  Scoring reads every passage.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import Words, bounded_sample, distinct_per_doc, fresh, mix, text_of, text_slices, with_columns_last
from corate.session import materialize

_IS = {
    "upper": slice(65, 91),
    "digit": slice(48, 58),
    "high": slice(128, 256),
}
_STOPS = np.frombuffer(b".,;:?'\"()-", np.uint8)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[33:48] = _SYMBOL[58:65] = _SYMBOL[91:97] = _SYMBOL[123:127] = True
_STOP = np.zeros(256, bool)
_STOP[_STOPS] = True
_SYMBOL &= ~_STOP


def _mask(part: slice) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[part] = True
    return mask


_CLASSES = [*(_mask(p) for p in _IS.values()), _STOP, _SYMBOL]
N_FEATURES = 17


def encode_passages(data: np.ndarray, offsets: np.ndarray, passage_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First passage of each text (and the total), and a row of features per passage.  A text has one passage at least."""
    words = Words(data, offsets)
    per_doc = np.diff(words.first)
    n_passages = np.maximum(1, -(-per_doc // passage_words))
    first = np.concatenate([[0], np.cumsum(n_passages)])
    total = int(first[-1])
    out = np.zeros((total, N_FEATURES), np.float32)
    if len(words.start) == 0:
        return first, out
    nth = np.arange(len(words.start)) - words.first[words.doc]
    passage = first[words.doc] + nth // passage_words
    n = np.maximum(1, np.bincount(passage, minlength=total)).astype(np.float64)
    mean = lambda x, by=n: np.bincount(passage, weights=x, minlength=total) / by
    size = np.maximum(1, np.bincount(passage, weights=words.length, minlength=total))
    end = words.start + words.length
    columns = [np.log1p(n) / 4, mean(words.length) / 10]
    for mask in _CLASSES:
        upto = np.concatenate([[0], np.cumsum(mask[data], dtype=np.int64)])
        columns.append(mean(upto[end] - upto[words.start], size))
    key = words.hashes()
    same_doc = words.doc[1:] == words.doc[:-1]
    columns.append(mean(np.concatenate([[False], (key[1:] == key[:-1]) & same_doc])))
    kept, _ = distinct_per_doc(passage, key)
    columns.append(np.bincount(kept, minlength=total) / n)
    begin = data[words.start]
    columns.append(mean((begin >= 65) & (begin <= 90)))
    columns.append(mean(_SYMBOL[data[end - 1]]))
    columns.append(mean((words.length == 1) & _SYMBOL[begin]))
    columns.append(mean(words.length <= 3))
    # Word triples that occur again in the document.
    triple = mix(key[:-2] ^ mix(key[1:-1] ^ mix(key[2:]))) if len(key) > 2 else np.empty(0, np.uint64)
    inside = words.doc[: len(triple)] == words.doc[2:]
    where = np.flatnonzero(inside)
    order = where[np.lexsort((triple[where], words.doc[where]))]
    again = np.zeros(len(key), bool)
    equal = (triple[order[1:]] == triple[order[:-1]]) & (words.doc[order[1:]] == words.doc[order[:-1]])
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    columns.append(mean(again))
    breaks = np.concatenate([[0], np.cumsum(data == 10, dtype=np.int64)])
    columns.append(mean(breaks[words.start] - np.concatenate([[0], breaks[words.start[:-1]]])))
    squares = np.bincount(passage, weights=words.length.astype(np.float64) ** 2, minlength=total) / n
    columns.append(np.sqrt(np.maximum(0, squares - (columns[1] * 10) ** 2)) / 10)
    columns.append(np.log1p(per_doc[np.repeat(np.arange(len(per_doc)), n_passages)]) / 8)
    empty = np.bincount(passage, minlength=total) == 0
    out[:] = np.stack(columns, 1)
    out[empty] = 0
    return first, out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class AttentionModel:
    """Weights of the network; ``center`` and ``scale`` standardise the features."""

    center: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p = self.weights
        starts, doc = first[:-1], np.repeat(np.arange(len(first) - 1), np.diff(first))
        x = (x - self.center) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[doc])
        a = e / np.add.reduceat(e, starts)[doc]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "doc": doc, "y": _sigmoid(z @ p["c"] + p["d"][0])}

    def gradients(self, f: dict[str, np.ndarray], label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, doc, a, h = self.weights, f["doc"], f["a"], f["h"]
        out = (f["y"] - label) * weight
        dz = out[:, None] * p["c"]
        da = (dz[doc] * h).sum(1)
        spread = np.bincount(doc, weights=a * da, minlength=len(out))[doc]
        de = a * (da - spread)
        dg = de[:, None] * p["w"]
        dt = dg * f["s"] * (1 - f["t"] ** 2)
        ds = dg * f["t"] * f["s"] * (1 - f["s"])
        dh = a[:, None] * dz[doc] + dt @ p["V"].T + ds @ p["U"].T
        dx = dh * (1 - h**2)
        return {
            "W": f["x"].T @ dx,
            "b": dx.sum(0),
            "V": h.T @ dt,
            "U": h.T @ ds,
            "w": (f["t"] * f["s"]).T @ de,
            "c": f["z"].T @ out,
            "d": np.array([out.sum()]),
        }


def train_attention(
    x: np.ndarray,
    first: np.ndarray,
    label: np.ndarray,
    weight: np.ndarray,
    hidden: int = 16,
    gates: int = 8,
    steps: int = 200,
    rate: float = 0.03,
    decay: float = 1e-4,
    seed: int = 42,
) -> AttentionModel:
    """Full-batch Adam on the weighted log loss."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    shapes = {"W": (d, hidden), "b": (hidden,), "V": (hidden, gates), "U": (hidden, gates), "w": (gates,), "c": (hidden,), "d": (1,)}
    weights = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) == 2 else np.zeros(s) for k, s in shapes.items()}
    weights["w"], weights["c"] = rng.normal(0, 0.3, gates), rng.normal(0, 0.3, hidden)
    model = AttentionModel(x.mean(0), x.std(0) + 1e-3, weights)
    weight = weight / weight.sum()
    m = {k: np.zeros(s) for k, s in shapes.items()}
    v = {k: np.zeros(s) for k, s in shapes.items()}
    for step in range(1, steps + 1):
        gradients = model.gradients(model.forward(x, first), label, weight)
        for k, g in gradients.items():
            g = g + decay * weights[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            weights[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_label: int = 1000,
    passage_words: int = 50,
    seed: int = 42,
) -> AttentionModel | None:
    """Learn from ``docs`` with a 0/1 label in ``labels``; null if there are none.

    Rows with a null id or label are left out, and labels without a document in ``docs``.
    Of several labels of one id the highest counts.  The sample, ``per_label`` documents of each label, keeps the labels' true
    proportions by weights; all passages of its texts are learned from.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("int").alias("_label"))
    )
    known = known.join(docs.select(F.col(id_col).alias("_id")), "_id", "left_semi")
    known = materialize(known, "quality-labels")
    counts = dict(known.groupBy("_label").count().collect())
    chosen = F.broadcast(bounded_sample(known, "_label", per_label, "_id", seed))  # 2 * per_label rows at most
    sample = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).join(chosen, "_id").select("_label", "_text")

    def encode(batches):
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            for at, data, offsets in text_slices(batch.column(1)):
                first, x = encode_passages(data, offsets, passage_words)
                kept = [x[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.record_batch({
                    "label": pa.array(label[at : at + len(kept)], pa.int32()),
                    "rows": pa.array([k.astype("<f4").tobytes() for k in kept], pa.binary()),
                })

    got = sample.mapInArrow(encode, "label int, rows binary").toPandas()
    if got["label"].nunique() == 0:
        return None
    got = got.sort_values(["label", "rows"], kind="stable")  # the same order in every run
    parts = [np.frombuffer(r, "<f4").reshape(-1, N_FEATURES) for r in got["rows"]]
    label = got["label"].to_numpy()
    weight = np.array([counts[k] / (label == k).sum() for k in label])
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return train_attention(np.concatenate(parts).astype(np.float64), first, label.astype(np.float64), weight, seed=seed)


def score_quality(
    docs: DataFrame, model: AttentionModel | None, text_col: str = "text", passage_words: int = 50, name: str = "score"
) -> DataFrame:
    """``docs`` with the probability of label 1 for each whole text (null counts as empty, which has a score too).

    Without a model (no labels to learn from) every score is 0.5.  An input
    column called ``name`` is replaced.
    """

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = np.full(len(texts), 0.5)
        if model is not None:
            for at, data, offsets in text_slices(texts):
                first, x = encode_passages(data, offsets, passage_words)
                out[at : at + len(offsets) - 1] = model.forward(x, first)["y"]
        return pa.array(out)

    own = fresh("_score", docs)
    scored = docs.withColumn(own, score(F.col(text_col)))
    return with_columns_last(scored, {name: F.col(own)}).drop(own)
