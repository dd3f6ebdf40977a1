"""Quality classifier: naive Bayes log-count ratios as feature scale, linear hinge loss by dual coordinate descent.

Features are indicators of token 1-, 2- and 3-grams.  Tokens are words, runs of one symbol and the shape
of a word (case and digits), so that junk shows whatever words it is made of.  An indicator is scaled by
the log ratio of its smoothed counts in both classes, a text's row is brought to length 1, and a linear
support vector machine is fitted by dual coordinate descent in numpy on a bounded sample.  Margins become
probabilities by a logistic fit on texts kept apart.

Scoring is a map over blocks of whole texts; the model's size is bounded by the sample's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from ledgerline.llm import samples
from ledgerline.llm.calibrate import logistic, prior_shift
from ledgerline.llm.common import narrow, text_blocks

TOKEN = re.compile(r"\n|\w+|[^\w\s]+")
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    tokens: dict[str, int]   # token -> number, of tokens that occur in a feature
    keys: np.ndarray         # sorted keys of the features
    ratio: np.ndarray        # naive Bayes scale of each
    weight: np.ndarray       # fitted weight of each
    bias: float
    slope: float             # logistic calibration
    shift: float
    prior: float             # share of label 1, the score where nothing is known


def shape(word: str) -> str:
    if word == "\n":
        return "\\n"
    if word[0].isdigit():
        return "9"
    if not (word[0].isalnum() or word[0] == "_"):
        return word[:3]
    if word.isupper():
        return "X" if len(word) == 1 else "XX"
    if word[0].isupper():
        return "Xx"
    return "x"


def _grams(ids: np.ndarray, salt: int) -> list[np.ndarray]:
    """Keys of the 1-, 2- and 3-grams of a row of token numbers (-1 breaks a gram)."""
    out = []
    x = ids.astype(np.uint64)
    for n in (1, 2, 3):
        if len(ids) < n:
            break
        key = np.full(len(ids) - n + 1, salt * 8 + n, dtype=np.uint64)
        ok = np.ones(len(key), dtype=bool)
        for k in range(n):
            part = slice(k, len(ids) - n + 1 + k)
            key = (key ^ x[part]) * MIX
            key ^= key >> np.uint64(31)
            ok &= ids[part] >= 0
        out.append(key[ok])
    return out


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _features(tokens: list[str], number, shapes) -> np.ndarray:
    """Distinct feature keys of a text: grams of its tokens and of its tokens' shapes."""
    ids = np.array([number(w) for w in tokens], dtype=np.int64)
    forms = np.array([shapes(w) for w in tokens], dtype=np.int64)
    parts = _grams(ids, 1)[:2] + _grams(forms, 2)
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def _dual_descent(rows: list[np.ndarray], vals: list[np.ndarray], y: np.ndarray, width: int, cost: np.ndarray,
                  epochs: int, rng) -> np.ndarray:
    """L1-loss linear support vector machine by dual coordinate descent; the last weight is the bias."""
    w = np.zeros(width + 1)
    alpha = np.zeros(len(rows))
    diag = np.array([v @ v for v in vals]) + 1.0
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            r, v = rows[i], vals[i]
            g = y[i] * (w[r] @ v + w[-1]) - 1
            a = min(max(alpha[i] - g / diag[i], 0.0), cost[i])
            d = (a - alpha[i]) * y[i]
            if d:
                w[r] += d * v
                w[-1] += d
                alpha[i] = a
                moved = max(moved, abs(d))
        if moved < 1e-3:
            break
    return w


def _scaled(found: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    v = ratio[found]
    n = np.sqrt(v @ v)
    return v / n if n else v


def fit(sample: list[tuple[str, int]], share: float | None = None, cost: float = 4.0, epochs: int = 30, seed: int = 11) -> Model:
    """``sample`` holds (text, 0 or 1), ``share`` is that of label 1 among all rows (the sample's if None).
    With one class only, the score is that class's share."""
    y = np.array([k for _, k in sample], dtype=np.int64)
    prior = float((y.sum() + 1) / (len(y) + 2))
    empty = Model({}, np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), 0.0, 0.0, float(np.log(prior / (1 - prior))), prior)
    if len(y) < 2 or y.min() == y.max():
        return empty
    rng = np.random.default_rng(seed)
    numbers = _Numbers()
    feats = [_features(TOKEN.findall(t), lambda w: numbers[w.lower()], lambda w: numbers["\0" + shape(w)]) for t, _ in sample]
    keys, df = np.unique(np.concatenate(feats), return_counts=True)
    keys = keys[df >= 2]
    if not len(keys):
        return empty
    rows = [np.flatnonzero(np.isin(keys, f)) if len(f) > len(keys) else _at(keys, f) for f in feats]
    pos, neg = np.ones(len(keys)), np.ones(len(keys))
    for r, k in zip(rows, y):
        (pos if k else neg)[r] += 1
    ratio = np.log(pos / (y.sum() + 2)) - np.log(neg / ((1 - y).sum() + 2))
    vals = [_scaled(r, ratio) for r in rows]
    sign = np.where(y == 1, 1.0, -1.0)
    costs = cost * np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    # margins of texts that a fit has not seen, for the calibration: three folds
    apart = np.arange(len(y)) % 3
    margin = np.zeros(len(y))
    for k in range(3):
        own = np.flatnonzero(apart != k)
        if sign[own].min() == sign[own].max():
            continue
        # the scale, too, must not know the texts apart
        p, n = np.ones(len(keys)), np.ones(len(keys))
        for i in own:
            (p if y[i] else n)[rows[i]] += 1
        r = np.log(p / (y[own].sum() + 2)) - np.log(n / ((1 - y[own]).sum() + 2))
        w = _dual_descent([rows[i] for i in own], [_scaled(rows[i], r) for i in own], sign[own], len(keys), costs[own], epochs, rng)
        for i in np.flatnonzero(apart == k):
            margin[i] = w[rows[i]] @ _scaled(rows[i], r) + w[-1]
    slope, shift = logistic(margin, y)
    shift += prior_shift(y, share)
    w = _dual_descent(rows, vals, sign, len(keys), costs, epochs, rng)
    return Model(dict(numbers), keys, ratio, w[:-1], float(w[-1]), slope, shift, prior)


def _at(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Places of those of ``found`` that lie in the sorted ``keys``."""
    if not len(keys) or not len(found):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
    return at[keys[at] == found]


def score_block(model: Model, texts: list[bytes | None]) -> np.ndarray:
    """Probability of label 1 for each text."""
    tokens = model.tokens
    known: dict[str, int] = {}
    form: dict[str, int] = {}

    def number(w: str) -> int:
        n = known.get(w)
        if n is None:
            n = known[w] = tokens.get(w.lower(), -1)
        return n

    def shaped(w: str) -> int:
        n = form.get(w)
        if n is None:
            n = form[w] = tokens.get("\0" + shape(w), -1)
        return n

    out = np.empty(len(texts))
    for i, t in enumerate(texts):
        found = _at(model.keys, _features(TOKEN.findall(t.decode("utf-8", "replace")), number, shaped)) if t else np.zeros(0, np.int64)
        if not len(found):
            out[i] = model.prior
            continue
        z = model.slope * (model.weight[found] @ _scaled(found, model.ratio) + model.bias) + model.shift
        out[i] = 1 / (1 + np.exp(-min(max(z, -30), 30)))
    return out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score`` per row; NULL, empty and all-unknown texts get the share of label 1 in the sample.

    Repeated rows and NULL ids stay rows of their own; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(score_block(shared.value, texts))],
                                             names=["doc_id", "score"])

    return narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def fit_documents(docs: DataFrame, labels: DataFrame, allowed: Column, per_class: int = 1000) -> Model:
    """Learn ``quality`` from at most ``per_class`` labelled documents of each class among the label rows where ``allowed``."""
    return fit(*samples.by_labels(docs, labels, "quality", allowed, per_class))
