"""Language identification by a bidirectional gated recurrent network over bytes.

Each byte of a text is embedded; one gated recurrent layer reads forwards, one
backwards; a softmax over both states labels every position.  The probabilities
of a document are the mean over its positions.  Texts are read in pieces of
``piece`` bytes, each from a fresh state, so that memory is bounded by the piece
count of one batch and thousands of pieces advance together.

Training is backpropagation through time in numpy, with Adam, on the driver, on a
bounded sample: all pieces of ``per_label`` documents of each language.  Prediction reads whole texts, long
ones some pieces at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import LOWER, bounded_sample, fresh, small_side, text_of, text_slices, with_columns_last

UNDETERMINED = "und"
LONG = 8192  # pieces of one text that are laid out at once
_PAD = 256  # the symbol after the end of a text


def pieces(data: np.ndarray, offsets: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols (piece x count, padded), valid bytes of each piece, and its text."""
    size = np.diff(offsets)
    count = -(-size // piece)
    doc = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[doc] + nth * piece
    valid = np.minimum(piece, offsets[doc + 1] - start)
    at = start[None, :] + np.arange(piece)[:, None]
    inside = np.arange(piece)[:, None] < valid[None, :]
    symbols = np.where(inside, LOWER[data[np.minimum(at, max(0, len(data) - 1))]], _PAD) if len(data) else at
    return symbols.astype(np.int64), valid, doc


def _softmax(x: np.ndarray) -> np.ndarray:
    """Over the last axis, which is short: its sum is a product with ones.  Logits are bounded by the output weights."""
    x = np.exp(np.clip(x, -60, 60))
    x /= x @ np.ones((x.shape[-1], 1), x.dtype)
    return x


@dataclass
class ByteGru:
    """Weights by name; ``f`` and ``g`` mark the forward and backward layer.

    X: embedding and input weights of a symbol in one table (update and reset
    gate, candidate); U: from the state; O, o: the output layer.
    """

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def start(cls, languages: list[str], hidden: int, seed: int) -> ByteGru:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
        weights = {}
        for side in "fg":
            weights["X" + side] = draw(_PAD + 1, 3 * hidden, s=0.5)
            weights["U" + side] = draw(hidden, 3 * hidden, s=0.5 / np.sqrt(hidden))
        weights["O"] = draw(2 * hidden, len(languages), s=0.3)
        weights["o"] = np.zeros(len(languages), np.float32)
        return cls(languages, weights)

    @property
    def hidden(self) -> int:
        return self.weights["Uf"].shape[0]

    def _gates(self, side: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Tables and state weights of the update gate, the reset gate and the candidate, each in one piece."""
        split = lambda w: [np.ascontiguousarray(part) for part in np.split(w, 3, 1)]
        return split(self.weights["X" + side]), split(self.weights["U" + side])

    def _run(self, side: str, symbols: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each step (steps x pieces x hidden); with ``keep`` the gates too."""
        (xz, xr, xc), (uz, ur, uc) = self._gates(side)
        steps, n = symbols.shape
        out = np.empty((steps, n, self.hidden), xz.dtype)
        h = np.zeros((n, self.hidden), xz.dtype)
        m = np.empty_like(h)

        def gate(x: np.ndarray, u: np.ndarray, s: np.ndarray) -> np.ndarray:
            g = np.take(x, s, axis=0, mode="clip")
            g += np.matmul(h, u, out=m)
            g *= 0.5
            np.tanh(g, out=g)
            g *= 0.5
            g += 0.5
            return g

        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z, r = gate(xz, uz, symbols[t]), gate(xr, ur, symbols[t])
            inner = h @ uc
            c = r * inner
            c += np.take(xc, symbols[t], axis=0, mode="clip")
            np.tanh(c, out=c)
            before, h = h, out[t]
            np.subtract(before, c, out=h)
            h *= z
            h += c
            if keep is not None:
                keep.append((t, before, z, r, inner, c))
        return out

    def probabilities(self, symbols: np.ndarray) -> np.ndarray:
        """Language probabilities of every position (steps x pieces x languages)."""
        h = self.hidden
        o = self.weights["O"]
        return _softmax(self._run("f", symbols) @ o[:h] + self._run("g", symbols) @ o[h:] + self.weights["o"])

    def gradients(self, symbols: np.ndarray, valid: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss over the valid positions, and its gradients."""
        p, h_dim = self.weights, self.hidden
        kept = {"f": [], "g": []}
        states = {s: self._run(s, symbols, kept[s]) for s in "fg"}
        both = np.concatenate([states["f"], states["g"]], 2)
        y = _softmax(both @ p["O"] + p["o"])
        weight = (np.arange(symbols.shape[0])[:, None] < valid[None, :]).astype(np.float32)
        weight /= weight.sum()
        columns = np.arange(len(label))
        loss = -float((np.log(np.maximum(y[:, columns, label], 1e-9)) * weight).sum())
        dy = y.copy()
        dy[:, columns, label] -= 1
        dy *= weight[:, :, None]
        flat = dy.reshape(-1, dy.shape[2])
        grads = {"O": both.reshape(-1, 2 * h_dim).T @ flat, "o": flat.sum(0)}
        dboth = dy @ p["O"].T
        for side in "fg":
            dstate = dboth[:, :, :h_dim] if side == "f" else dboth[:, :, h_dim:]
            u = p["U" + side]
            dx_all, du = np.zeros((*symbols.shape, 3 * h_dim), np.float32), np.zeros_like(u)
            carry = np.zeros((len(label), h_dim), np.float32)
            for t, before, z, r, inner, c in reversed(kept[side]):
                dh = dstate[t] + carry
                dc = dh * (1 - z) * (1 - c * c)
                dz = dh * (before - c) * z * (1 - z)
                dr = dc * inner * r * (1 - r)
                dm = np.concatenate([dz, dr, dc * r], 1)
                dx_all[t] = np.concatenate([dz, dr, dc], 1)
                du += before.T @ dm
                carry = dh * z + dm @ u.T
            table = np.zeros_like(p["X" + side])
            flat_x, flat_s = dx_all.reshape(-1, 3 * h_dim), symbols.reshape(-1)
            order = np.argsort(flat_s, kind="stable")
            seen, at = np.unique(flat_s[order], return_index=True)
            table[seen] = np.add.reduceat(flat_x[order], at, axis=0)
            grads["X" + side], grads["U" + side] = table, du
        return loss, grads


def train_gru(
    languages: list[str],
    symbols: np.ndarray,
    valid: np.ndarray,
    label: np.ndarray,
    hidden: int = 8,
    steps: int = 400,
    batch: int = 256,
    rate: float = 0.03,
    seed: int = 42,
    pool: np.ndarray | None = None,
) -> ByteGru:
    """Adam on batches drawn from the pieces, or from ``pool``, numbers of pieces that may repeat."""
    pool = np.arange(len(label)) if pool is None else pool
    rng = np.random.default_rng(seed)
    model = ByteGru.start(languages, hidden, seed)
    p = model.weights
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pick = pool[rng.integers(0, len(pool), batch)]
        _, grads = model.gradients(symbols[:, pick].astype(np.int64), valid[pick], label[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        pace = rate * (1 - 0.9 * step / steps)
        for k, g in grads.items():
            g = g / max(1.0, norm)
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.01 * (g * g - v[k])
            p[k] -= (pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def document_probabilities(model: ByteGru, data: np.ndarray, offsets: np.ndarray, piece: int) -> np.ndarray:
    """The mean over all positions of each text; zeros for an empty one."""
    if len(offsets) == 2 and len(data) > LONG * piece:  # one long text, cut where pieces are cut
        cuts = range(0, len(data), LONG * piece)
        parts = [data[a : a + LONG * piece] for a in cuts]
        return sum(document_probabilities(model, p, np.array([0, len(p)]), piece) * len(p) for p in parts) / len(data)
    symbols, valid, doc = pieces(data, offsets, piece)
    totals = np.zeros((len(offsets) - 1, len(model.languages)))
    for at in range(0, len(doc), 2048):  # small enough for the processor's cache
        end = at + 2048
        y = model.probabilities(symbols[:, at:end])
        y *= (np.arange(piece)[:, None] < valid[None, at:end])[:, :, None]
        np.add.at(totals, doc[at:end], y.sum(0))
    return totals / np.maximum(1, np.diff(offsets))[:, None]


def fit_language(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_label: int = 300,
    piece: int = 96,
    seed: int = 42,
) -> ByteGru | None:
    """Learn from the rows with a text and a language; null if there are none.

    ``per_label`` documents of each language are drawn, and learned from as a whole; languages are as many as the column has.
    """
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    chosen = bounded_sample(known.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang")), "_lang", per_label, "_id", seed)
    chosen = small_side(chosen.distinct(), 1_000_000)  # per_label rows of each language
    sample = known.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), text_of(text_col).alias("_text"))
    sample = sample.join(chosen, ["_id", "_lang"]).select("_lang", "_text")

    def cut(batches):
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for at, data, offsets in text_slices(batch.column(1)):
                symbols, valid, doc = pieces(data, offsets, piece)
                yield pa.record_batch({
                    "lang": pa.array([langs[at + d] for d in doc.tolist()], pa.string()),
                    "symbols": pa.array([x.tobytes() for x in np.ascontiguousarray(symbols.T, "<i2")], pa.binary()),
                    "valid": pa.array(valid, pa.int32()),
                })

    got = sample.mapInArrow(cut, "lang string, symbols binary, valid int").toPandas()
    if got.empty:
        return None
    got = got.sort_values(["lang", "symbols"], kind="stable")  # the same order in every run
    languages = sorted(got["lang"].unique())
    symbols = np.stack([np.frombuffer(s, "<i2") for s in got["symbols"]], 1)
    label = got["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy()
    # Even out the languages, which differ in how many pieces they have.
    counts = np.bincount(label)
    pick = np.concatenate([np.resize(np.flatnonzero(label == k), counts.max()) for k in range(len(languages))])
    return train_gru(languages, symbols, got["valid"].to_numpy(), label, pool=pick, seed=seed)


def predict_language(docs: DataFrame, model: ByteGru | None, text_col: str = "text", piece: int = 96) -> DataFrame:
    """``docs`` with lang_pred and score, from the whole text.

    A null text, one without a letter of any script, or any text when there is no
    model, is ``und`` with score 0.  Equal probabilities go to the first language
    by name.  Input columns named lang_pred or score are replaced.
    """
    result = "struct<lang: string, score: double>"

    @F.arrow_udf(result)
    def predict(texts: pa.Array) -> pa.Array:
        lang, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        names = model.languages if model is not None else [UNDETERMINED]
        for at, data, offsets in text_slices(texts) if model is not None else ():
            y = document_probabilities(model, data, offsets, piece)
            rows = slice(at, at + len(y))
            lang[rows] = y.argmax(1)
            score[rows] = np.minimum(1.0, y.max(1))
        return pa.StructArray.from_arrays(
            [pa.array(np.array(names, object)[lang], pa.string()), pa.array(score)], names=["lang", "score"]
        )

    own = fresh("_lang", docs)
    judged = docs.withColumn(own, predict(F.col(text_col)))
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    columns = {
        "lang_pred": F.when(letters, F.col(f"{own}.lang")).otherwise(UNDETERMINED),
        "score": F.when(letters, F.col(f"{own}.score")).otherwise(0.0),
    }
    return with_columns_last(judged, columns).drop(own)
