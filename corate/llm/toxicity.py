"""Toxicity categories by a classifier chain.

Categories are predicted one after another.  Each has a linear (logistic) model
over the words of the text, the beginnings of longer words, and whether several different words
of the text have a beginning (compounds of one stem); the model of a
later category also sees the probabilities of all earlier ones.  In training
those are out-of-fold predictions, so that a later model learns how far to
trust them on texts they were not fitted to.  Learned in numpy on a bounded
sample, ``per_label`` documents of each label, which are read whole; features are counted and chosen by Spark, and
only what sampled texts have of the chosen ones comes to the driver.  Applied to whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import LOWER, Words, bounded_sample, distinct_per_doc, fresh, mix, text_of, text_slices, with_columns_last
from corate.session import materialize

# Signs that stand for letters in disguised words are read as those letters.
_FOLD = LOWER.copy()
for sign, letter in zip(b"013457$@", b"oieastsa", strict=True):
    _FOLD[sign] = letter
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), ord("$"), ord("@")]] = False
# Bytes of a beginning, and numbers of different words with it that are features.
BEGINNINGS = (4, 5, 7)
SEVERAL = (2, 4)


def among(keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``keys`` are in the sorted ``known``: their places, and the places there."""
    table = np.zeros(1 << 16, bool)
    table[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
    maybe = np.flatnonzero(table[(keys & np.uint64(0xFFFF)).astype(np.int64)])
    at = np.searchsorted(known, keys[maybe])
    hit = at < len(known)
    hit[hit] = known[at[hit]] == keys[maybe[hit]]
    return maybe[hit], at[hit]


def text_features(data: np.ndarray, offsets: np.ndarray, stems: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, stem) of every word, of the first bytes of longer words, and of beginnings that several words have.

    The stem is the beginning of a feature of the last kind, else 0.  With ``stems`` (sorted) only those
    beginnings are counted.
    """
    words = Words(data, offsets, _BETWEEN)
    whole = words.hashes(_FOLD)
    docs, keys, from_stem = [words.doc], [whole], [np.zeros(len(whole), np.uint64)]
    for n in BEGINNINGS:
        longer = np.flatnonzero(words.length > n)
        doc, key = words.doc[longer], mix(words.hashes(_FOLD, n)[longer] ^ np.uint64(n))
        docs.append(doc)
        keys.append(key)
        from_stem.append(np.zeros(len(key), np.uint64))
        if stems is not None:
            some = among(key, stems)[0]
            longer, doc, key = longer[some], doc[some], key[some]
        word = whole[longer]
        order = np.lexsort((word, key, doc))
        doc, key, word = doc[order], key[order], word[order]
        other = np.ones(len(doc), bool)
        other[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
        new = other.copy()
        new[1:] |= word[1:] != word[:-1]
        first = np.flatnonzero(other)
        different = np.add.reduceat(new, first) if len(first) else first
        for least in SEVERAL:
            enough = first[different >= least]
            docs.append(doc[enough])
            keys.append(mix(key[enough] + np.uint64(least)))
            from_stem.append(key[enough])
    return np.concatenate(docs), np.concatenate(keys), np.concatenate(from_stem)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Matrix:
    """Which of the chosen features (columns) each text (row) has."""

    row: np.ndarray
    column: np.ndarray
    n_rows: int

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.column], minlength=self.n_rows)

    def back(self, g: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.column, weights=g[self.row], minlength=n)


def fit_linear(
    x: Matrix, extra: np.ndarray, label: np.ndarray, weight: np.ndarray, n: int, steps: int = 150, rate: float = 0.1, ridge: float = 1e-4
) -> np.ndarray:
    """Weights of the features, of the ``extra`` columns and a constant: weighted log loss, Adam."""
    k = extra.shape[1]
    w = np.zeros(n + k + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    weight = weight / weight.sum()
    for step in range(1, steps + 1):
        out = (_sigmoid(x.dot(w[:n]) + extra @ w[n : n + k] + w[-1]) - label) * weight
        g = np.concatenate([x.back(out, n), extra.T @ out, [out.sum()]]) + ridge * w
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


def linear_probability(x: Matrix, extra: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    return _sigmoid(x.dot(w[:n]) + extra @ w[n:-1] + w[-1])


@dataclass
class Chain:
    """``keys``: the chosen features, sorted; ``stems``: the beginnings that they count; ``links``: weights by category, in their order."""

    keys: np.ndarray
    stems: np.ndarray
    links: dict[str, np.ndarray]

    def matrix(self, data: np.ndarray, offsets: np.ndarray) -> Matrix:
        doc, key, _ = text_features(data, offsets, self.stems)
        where, at = among(key, self.keys)
        return Matrix(*distinct_per_doc(doc[where], at), len(offsets) - 1)

    def predict(self, x: Matrix) -> np.ndarray:
        """Probabilities, a column per category."""
        known = np.zeros((x.n_rows, 0))
        for w in self.links.values():
            y = linear_probability(x, known, w, len(self.keys))
            known = np.concatenate([known, y[:, None]], 1)
        return known


def choose_features(found: DataFrame, categories: int, least: int, level: float) -> DataFrame:
    """Keys of ``found`` (keys, y: a 0/1 array of the categories) in at least ``least`` texts that mark some category.

    Their chi-squared statistic is over ``level``, and the category's share among
    texts with the key is at least four fifths of the way from its overall share to
    one: common words that merely go with long texts, or with clean ones, are no evidence.
    """
    whole = F.struct(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("y")[c]).alias(f"n{c}") for c in range(categories)])
    total = found.select(whole.alias("total")).scalar()
    counts = (
        found.select(F.explode("keys").alias("key"), "y")
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("df"), *[F.sum(F.col("y")[c]).alias(f"both{c}") for c in range(categories)])
        .where(F.col("df") >= least)
        .withColumn("total", total)
    )
    marks = F.lit(False)
    for c in range(categories):
        n, df = F.col("total.n"), F.col("df")
        share = F.col(f"total.n{c}") / n
        over, missing = F.col(f"both{c}") - df * share, df - df * share
        spread = F.greatest(F.lit(1e-9), df * (1 - df / n) * share * (1 - share))
        marks = marks | ((over >= 0.8 * missing) & (over * over / spread > level))
    return counts.where(marks).select("key")


def train_chain(
    x: Matrix, keys: np.ndarray, stems: np.ndarray, labels: np.ndarray, names: list[str], weight: np.ndarray, folds: int = 3, seed: int = 42
) -> Chain:
    """``labels``: a 0/1 column per category, in chain order."""
    chain = Chain(keys, stems, {})
    n_docs, n = len(labels), len(keys)
    fold = np.random.default_rng(seed).permutation(n_docs) % folds
    known = np.zeros((n_docs, 0))
    for c, name in enumerate(names):
        y = labels[:, c].astype(float)
        chain.links[name] = fit_linear(x, known, y, weight, n)
        if c + 1 < len(names):
            out = np.zeros(n_docs)
            for k in range(folds):
                w = fit_linear(x, known, y, weight * (fold != k), n)
                out[fold == k] = linear_probability(x, known, w, n)[fold == k]
            known = np.concatenate([known, out[:, None]], 1)
    return chain


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, tuple[str, ...]],
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_label: int = 2000,
    least: int = 3,
    level: float = 18.0,
    seed: int = 42,
) -> Chain | None:
    """Learn a chain that ends with ``label_col``; null without labelled texts.

    ``categories``: for each earlier category its seed words; a document with
    label 1 and one of those words is an example of it.  A category without an example
    has no say.  Rows with a null id or label, and labels without a document, are left out; of several labels of
    one id the highest counts.  The sample is bounded by its rows, ``per_label`` of each label; its texts are read whole.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).cast("int").alias("label"))
        .join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    )
    known = materialize(known, "toxic-labels")
    counts = dict(known.groupBy("label").count().collect())
    chosen = F.broadcast(bounded_sample(known, "label", per_label, "id", seed))  # 2 * per_label rows at most
    text = text_of(text_col)
    marks = [F.lower(text).rlike(r"\b(" + "|".join(words) + r")\b").cast("int") for words in categories.values()]
    sample = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.array(*marks).cast("array<int>").alias("marks")).join(chosen, "id")
    y = F.concat(F.transform("marks", lambda m: m * F.col("label")), F.array("label"))
    sample = materialize(sample.select("text", "label", y.alias("y")), "toxic-sample")

    def all_features(batches):
        for batch in batches:
            for at, data, offsets in text_slices(batch.column(0)):
                doc, key = distinct_per_doc(*text_features(data, offsets)[:2])
                n = len(offsets) - 1
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32()), pa.array(key.view(np.int64)))
                yield pa.record_batch({"keys": lists, "y": batch.column(1).slice(at, n)})

    found = materialize(sample.select("text", "y").mapInArrow(all_features, "keys array<bigint>, y array<int>"), "toxic-features")
    names = [*categories, label_col]
    keys = choose_features(found, len(names), least, level).toPandas()["key"].to_numpy(np.int64)
    keys = np.sort(keys.view(np.uint64))

    def chosen_features(batches):
        for batch in batches:
            for at, data, offsets in text_slices(batch.column(0)):
                doc, key, stem = text_features(data, offsets)
                where, column = among(key, keys)
                doc, column, stem = doc[where], column.astype(np.int64), stem[where].view(np.int64)
                order = np.lexsort((column, doc))
                n = len(offsets) - 1
                first = pa.array(np.searchsorted(doc[order], np.arange(n + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(first, pa.array(x[order])) for x in (column, stem)]
                y = batch.column(1).slice(at, n)
                yield pa.record_batch({"columns": lists[0], "stems": lists[1], "y": y})

    got = sample.select("text", "y").mapInArrow(chosen_features, "columns array<bigint>, stems array<bigint>, y array<int>")
    got = got.select(F.array_sort(F.array_distinct("columns")).alias("columns"), F.array_distinct("stems").alias("stems"), "y").toPandas()
    if got.empty:
        return None
    rows = sorted((list(y), list(c), list(s)) for y, c, s in zip(got["y"], got["columns"], got["stems"], strict=True))  # the same order in every run
    columns = np.array([r[0] for r in rows])
    label = columns[:, -1]
    weight = np.array([counts[k] / (label == k).sum() for k in label])
    doc = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    x = Matrix(doc, np.array([c for r in rows for c in r[1]], np.int64), len(rows))
    stems = np.array(sorted({s for r in rows for s in r[2]} - {0}), np.int64).view(np.uint64)
    return train_chain(x, keys, np.sort(stems), columns, names, weight, seed=seed)


def score_toxicity(docs: DataFrame, chain: Chain | None, text_col: str = "text", names: list[str] | None = None) -> DataFrame:
    """``docs`` with a probability per category of the chain, named p_<category>.

    A null or empty text gets what the models give without any word.  Without a
    chain the probabilities (of ``names``) are 0.  Input columns of these names are replaced.
    """
    names = list(chain.links) if chain is not None else list(names or ["toxic"])

    @F.arrow_udf("array<double>")
    def score(texts: pa.Array) -> pa.Array:
        out = np.zeros((len(texts), len(names)))
        if chain is not None:
            for at, data, offsets in text_slices(texts):
                out[at : at + len(offsets) - 1] = chain.predict(chain.matrix(data, offsets))
        return pa.array(list(out), pa.list_(pa.float64()))

    p = fresh("_p", docs)
    scored = docs.withColumn(p, score(F.col(text_col)))
    return with_columns_last(scored, {f"p_{c}": F.col(p)[i] for i, c in enumerate(names)}).drop(p)
