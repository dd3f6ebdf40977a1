"""Toxicity: bidirectional gated recurrent network with attention pooling, trained in numpy.

Each word enters as a learned word vector next to the mean of learned vectors of its character n-grams,
and two fixed numbers: the shrunk log-odds of the word, and the largest of its character n-grams', so that
an unseen word with a telling stem has evidence too.  A training text's own counts are left out of its
log-odds.  Gated recurrent units run over a window of ``WINDOW`` words in
both directions; attention weighs the states, and a logistic unit gives the window's logit.  *All*
overlapping windows (every ``STRIDE`` words, the last one flush with the end) of a whole text are scored;
the text's score is a logistic calibration of its largest window logit.

Fitting uses a bounded sample (see ``fit_documents``) on the driver; labels belong to texts, so in later
rounds only the windows that the model itself finds toxic stand for a toxic text.
Scoring is a map over blocks: the input projections are computed once per distinct word of a block, and
the recurrence runs over thousands of windows at once.
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
from ledgerline.llm.subwords import subword_runs, sum_runs

WINDOW, STRIDE = 48, 32
HIDDEN, WORD_DIM, CHAR_DIM, ATTEND = 12, 6, 6, 8
CHAR_BUCKETS, CHAR_NGRAMS = 1 << 18, (5, 6, 7, 8)
CHAR_ROWS = 4096  # learned vectors of n-grams, shared by their buckets
SHRINK = 10  # texts that a log-odds value is shrunk by
WORD = re.compile(r"\w+")
WORDS_AT_ONCE = 1 << 14  # distinct words whose n-grams are held at once
F32 = np.float32


@dataclass(frozen=True)
class Model:
    words: dict[str, int]            # word -> row of the word table; row 0 is any other word
    p: dict[str, np.ndarray]         # parameters, and the log-odds of words and character n-grams
    slope: float
    shift: float
    prior: float


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return F32(0.5) * (np.tanh(F32(0.5) * x) + F32(1))


def _cells(x: np.ndarray, mask: np.ndarray | None, u: np.ndarray, c: np.ndarray, back: bool, keep: bool):
    """Gated recurrence over x (T, B, 3H).  Gates: update z, reset r, candidate n = tanh(x + r * (h U + c))."""
    t_all, b, h3 = x.shape
    hid = h3 // 3
    h = np.zeros((b, hid), F32)
    states = np.empty((t_all, b, hid), F32)
    kept = []
    for t in range(t_all - 1, -1, -1) if back else range(t_all):
        g = h @ u
        zr = _sigmoid(x[t, :, :2 * hid] + g[:, :2 * hid])
        z, r = zr[:, :hid], zr[:, hid:]
        inner = g[:, 2 * hid:] + c
        n = np.tanh(x[t, :, 2 * hid:] + r * inner)
        new = n + z * (h - n)
        if mask is not None:
            new = np.where(mask[t][:, None], new, h)
        if keep:
            kept.append((t, h, z, r, inner, n))
        h = new
        states[t] = h
    return states, kept


def _cells_back(d_states: np.ndarray, kept, mask, u, hid):
    d_x = np.zeros(d_states.shape[:2] + (3 * hid,), F32)
    d_u, d_c = np.zeros_like(u), np.zeros(hid, F32)
    d_next = np.zeros(d_states.shape[1:], F32)
    for t, h, z, r, inner, n in reversed(kept):
        d = d_states[t] + d_next
        m = mask[t][:, None]
        dm = np.where(m, d, 0)
        d_n = dm * (1 - z) * (1 - n * n)
        d_z = dm * (h - n) * z * (1 - z)
        d_inner = d_n * r
        d_r = d_n * inner * r * (1 - r)
        d_g = np.concatenate((d_z, d_r, d_inner), axis=1)
        d_x[t] = np.concatenate((d_z, d_r, d_n), axis=1)
        d_u += h.T @ d_g
        d_c += d_inner.sum(axis=0)
        d_next = dm * z + d_g @ u.T + np.where(m, 0, d)
    return d_x, d_u, d_c


def _forward(p, x_f, x_b, mask, keep=False):
    """Window logits from the projected inputs of both directions (T, B, 3H each)."""
    s_f, k_f = _cells(x_f, mask, p["u_f"], p["c_f"], False, keep)
    s_b, k_b = _cells(x_b, mask, p["u_b"], p["c_b"], True, keep)
    s = np.concatenate((s_f, s_b), axis=2)
    a = np.tanh(s @ p["w_a"] + p["b_a"])
    e = a @ p["v_a"]
    if mask is not None:
        e = np.where(mask, e, F32(-1e9))
    e = np.exp(e - e.max(axis=0))
    att = e / e.sum(axis=0)
    pooled = (att[:, :, None] * s).sum(axis=0)
    logit = pooled @ p["w_o"] + p["b_o"][0]
    return logit, (s, a, att, pooled, k_f, k_b)


def _gradients(p, x_f, x_b, mask, y, weight):
    """Logits of the windows, gradients of the parameters and of both projected inputs."""
    hid = p["u_f"].shape[0]
    logit, (s, a, att, pooled, k_f, k_b) = _forward(p, x_f, x_b, mask, keep=True)
    d_logit = ((_sigmoid(logit) - y) * weight / len(y)).astype(F32)
    g = {"w_o": pooled.T @ d_logit, "b_o": np.array([d_logit.sum()], F32)}
    d_pool = d_logit[:, None] * p["w_o"]
    d_att = (s * d_pool).sum(axis=2)
    d_e = att * (d_att - (att * d_att).sum(axis=0))
    g["v_a"] = np.einsum("tba,tb->a", a, d_e)
    d_a = d_e[:, :, None] * p["v_a"] * (1 - a * a)
    g["w_a"] = np.einsum("tbh,tba->ha", s, d_a)
    g["b_a"] = d_a.sum(axis=(0, 1))
    d_s = att[:, :, None] * d_pool + d_a @ p["w_a"].T
    d_xf, g["u_f"], g["c_f"] = _cells_back(d_s[:, :, :hid], k_f, mask, p["u_f"], hid)
    d_xb, g["u_b"], g["c_b"] = _cells_back(d_s[:, :, hid:], k_b, mask, p["u_b"], hid)
    return logit, g, d_xf, d_xb


def _windows(n: int) -> list[tuple[int, int]]:
    if n <= WINDOW:
        return [(0, n)]
    starts = list(range(0, n - WINDOW, STRIDE)) + [n - WINDOW]
    return [(s, s + WINDOW) for s in starts]


def _odds(df1: np.ndarray, df0: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Shrunk log-odds of label 1 from the numbers of texts of each label that hold a thing."""
    df1, df0 = np.maximum(df1, 0), np.maximum(df0, 0)
    raw = np.log((df1 + 0.5) / (n1 + 1)) - np.log((df0 + 0.5) / (n0 + 1))
    seen = df1 + df0
    return (raw * seen / (seen + SHRINK)).astype(F32)


def _max_runs(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Largest of consecutive runs; 0 for a run without a value."""
    out = np.zeros(len(counts), F32)
    some = np.flatnonzero(counts)
    if len(some):
        heads = np.concatenate(([0], np.cumsum(counts[some])[:-1]))
        out[some] = np.maximum.reduceat(values, heads)
    return out


def _mean_runs(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Means of consecutive runs; 0 for a run without a value."""
    out = np.zeros((len(counts), values.shape[1]), F32)
    some = np.flatnonzero(counts)
    if len(some):
        out[some] = sum_runs(values, counts[some]) / counts[some, None].astype(F32)
    return out


def _inputs(p, word_rows: np.ndarray, spelled: list[str]) -> np.ndarray:
    """Input vectors of distinct words."""
    out = np.empty((len(spelled), WORD_DIM + CHAR_DIM + 2), F32)
    for at in range(0, len(spelled), WORDS_AT_ONCE):
        part = slice(at, at + WORDS_AT_ONCE)
        bucket, count = subword_runs(spelled[part], CHAR_NGRAMS, CHAR_BUCKETS)
        out[part, :WORD_DIM] = p["words"][word_rows[part]]
        out[part, WORD_DIM:-2] = _mean_runs(p["chars"][bucket % CHAR_ROWS], count)
        out[part, -2] = p["word_odds"][word_rows[part]]
        out[part, -1] = _max_runs(p["char_odds"][bucket], count)
    return out


def _grid(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(T x windows) word numbers, real places, and the text of each window."""
    spans = [(i, s, e) for i, r in enumerate(runs) if len(r) for s, e in _windows(len(r))]
    idx = np.zeros((len(spans), WINDOW), dtype=np.int32)
    size = np.empty(len(spans), dtype=np.int64)
    for k, (i, s, e) in enumerate(spans):
        idx[k, :e - s] = runs[i][s:e]
        size[k] = e - s
    owner = np.array([i for i, _, _ in spans], dtype=np.int64)
    return idx.T, (np.arange(WINDOW)[:, None] < size[None, :]), owner


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _window_logits(p, table_f, table_b, idx, real, batch=1024) -> np.ndarray:
    out = np.empty(idx.shape[1], F32)
    for at in range(0, idx.shape[1], batch):
        part = np.ascontiguousarray(idx[:, at:at + batch])
        mask = real[:, at:at + batch]
        out[at:at + batch] = _forward(p, table_f[part], table_b[part], None if mask.all() else mask)[0]
    return out


def fit(sample: list[tuple[str, int]], share: float | None = None, epochs: int = 5, rate: float = 0.01, seed: int = 3,
        per_text: int = 6) -> Model:
    """``sample`` holds (text, 0 or 1), ``share`` is that of label 1 among all rows.  At most ``per_text`` windows of a text enter a training epoch."""
    y = np.array([k for _, k in sample], dtype=np.int64)
    prior = float((y.sum() + 1) / (len(y) + 2))
    rng = np.random.default_rng(seed)
    numbers = _Numbers()
    runs = [np.array([numbers[w] for w in WORD.findall(t.lower())], dtype=np.int64) for t, _ in sample]
    spelled = list(numbers)
    hid, dim = HIDDEN, WORD_DIM + CHAR_DIM + 2
    p = {"chars": rng.normal(0, 0.1, (CHAR_ROWS, CHAR_DIM)), "b_a": np.zeros(ATTEND), "v_a": rng.normal(0, 0.3, ATTEND),
         "w_a": rng.normal(0, 0.3, (2 * hid, ATTEND)), "w_o": rng.normal(0, 0.3, 2 * hid), "b_o": np.zeros(1)}
    for d in "fb":
        p["u_" + d] = rng.normal(0, 0.3, (hid, 3 * hid))
        p["c_" + d] = np.zeros(hid)
        p["w_" + d] = rng.normal(0, 0.4, (dim, 3 * hid))
        p["g_" + d] = np.zeros(3 * hid)
    if len(y) < 2 or y.min() == y.max() or not spelled:
        p |= {"words": np.zeros((1, WORD_DIM)), "word_odds": np.zeros(1), "char_odds": np.zeros(CHAR_BUCKETS)}
        return Model({}, {k: v.astype(F32) for k, v in p.items()}, 0.0, float(np.log(prior / (1 - prior))), prior)
    # every sixth text calibrates: neither the counts nor the fit see it
    apart = np.arange(len(runs)) % 6 == 5
    bucket, count = subword_runs(spelled, CHAR_NGRAMS, CHAR_BUCKETS)
    starts = np.concatenate(([0], np.cumsum(count)))
    words_in = [np.unique(r) for r in runs]
    df = np.zeros((2, len(spelled)), dtype=np.int64)
    grams = np.zeros((2, CHAR_BUCKETS), dtype=np.int64)
    for r, k, out in zip(words_in, y, apart):
        if len(r) and not out:
            df[k, r] += 1
            grams[k, np.unique(np.concatenate([bucket[starts[w]:starts[w + 1]] for w in r]))] += 1
    n1, n0 = int(y[~apart].sum()), int((1 - y[~apart]).sum())
    own = np.flatnonzero(df.sum(axis=0) >= 4)
    row = np.zeros(len(spelled), dtype=np.int64)
    row[own] = np.arange(1, len(own) + 1)
    p["words"] = rng.normal(0, 0.1, (len(own) + 1, WORD_DIM))
    p["words"][0] = 0
    p = {k: v.astype(F32) for k, v in p.items()}
    fixed = {"word_odds": np.concatenate(([F32(0)], _odds(df[1, own], df[0, own], n1, n0))),
             "char_odds": _odds(grams[1], grams[0], n1, n0)}

    def evidence(a: int, b: int) -> np.ndarray:
        """Both log-odds of every word as a text sees them that adds ``a`` and ``b`` to the counts of 1 and 0."""
        w = np.where(row > 0, _odds(df[1] - a, df[0] - b, n1 - a, n0 - b), 0)
        return np.stack((w, _max_runs(_odds(grams[1] - a, grams[0] - b, n1 - a, n0 - b)[bucket], count)), axis=1).astype(F32)

    seen_by = np.stack((evidence(0, 1), evidence(1, 0)))  # by the text's label

    idx, real, owner = _grid(runs)
    label = y[owner].astype(F32)
    train_all = np.flatnonzero(~apart[owner])
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
    step = 0

    def logits() -> np.ndarray:
        x = _inputs(p | fixed, row, spelled)
        return _window_logits(p, x @ p["w_f"] + p["g_f"], x @ p["w_b"] + p["g_b"], idx, real)

    # few texts are gone through more often
    epochs = max(epochs, min(40, 800 * 64 // max(1, min(len(train_all), per_text * len(runs)))))
    for epoch in range(epochs):
        chosen = train_all
        if epoch:
            # a toxic text is told by its most toxic windows; a clean one has none
            now = logits()
            best = np.full(len(runs), -np.inf, F32)
            np.maximum.at(best, owner, now)
            chosen = train_all[(label[train_all] == 0) | (now[train_all] >= np.minimum(best[owner[train_all]], 2) - 1)]
        # a bounded number of windows of each text, other ones in each epoch
        mixed = rng.permutation(chosen)
        by = mixed[np.argsort(owner[mixed], kind="stable")]
        head = np.concatenate(([True], owner[by][1:] != owner[by][:-1]))
        place = np.arange(len(by)) - np.maximum.accumulate(np.where(head, np.arange(len(by)), 0))
        chosen = rng.permutation(by[place < per_text])
        ones = max(float(label[chosen].mean()), 1e-6)
        for at in range(0, len(chosen), 64):
            w = chosen[at:at + 64]
            ids, mask = idx[:, w], real[:, w]
            # a word in a toxic and in a clean text are two inputs: each leaves its own text's counts out
            distinct, back = np.unique(ids.astype(np.int64) * 2 + label[w].astype(np.int64), return_inverse=True)
            back = back.reshape(ids.shape)
            of, side = distinct >> 1, distinct & 1
            # one word in five shows its characters only, so that rare words are not learned by heart
            rows = np.where(rng.random(len(distinct)) < 0.2, 0, row[of])
            n = count[of]
            b = bucket[np.repeat(starts[of] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            x = np.concatenate((p["words"][rows], _mean_runs(p["chars"][b % CHAR_ROWS], n), seen_by[side, of]), axis=1)
            weight = np.where(label[w] == 1, 0.5 / ones, 0.5 / (1 - ones + 1e-6)).astype(F32)
            _, g, d_f, d_b = _gradients(p, (x @ p["w_f"] + p["g_f"])[back], (x @ p["w_b"] + p["g_b"])[back], mask, label[w], weight)
            d_x = np.zeros_like(x)
            for d, d_in in (("f", d_f), ("b", d_b)):
                flat = d_in.reshape(-1, 3 * hid)
                per = np.zeros((len(distinct), 3 * hid), F32)
                np.add.at(per, back.ravel(), flat)
                g["w_" + d] = x.T @ per
                g["g_" + d] = per.sum(axis=0)
                d_x += per @ p["w_" + d].T
            g["words"] = np.zeros_like(p["words"])
            np.add.at(g["words"], rows, d_x[:, :WORD_DIM])
            g["chars"] = np.zeros_like(p["chars"])
            np.add.at(g["chars"], b % CHAR_ROWS, np.repeat(d_x[:, WORD_DIM:WORD_DIM + CHAR_DIM] / np.maximum(n, 1)[:, None].astype(F32), n, axis=0))
            step += 1
            lr = rate * (1 - step / (epochs * (len(train_all) / 64 + 1) + 1)) if step < epochs * (len(train_all) / 64 + 1) else rate * 0.01
            for k, grad in g.items():
                m, v = moment[k]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                p[k] -= (lr * m / (1 - 0.9 ** step) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)).astype(F32)
    # calibration on texts whose windows the fit has not seen
    now = logits()
    best = np.full(len(runs), -np.inf)
    np.maximum.at(best, owner, now.astype(np.float64))
    seen = np.isfinite(best) & apart
    slope, shift = logistic(best[seen], y[seen]) if len(set(y[seen].tolist())) == 2 else (1.0, 0.0)
    shift += prior_shift(y, share)
    return Model({spelled[i]: int(row[i]) for i in own}, p | fixed, slope, shift, prior)


def score_block(model: Model, texts: list[bytes | None]) -> np.ndarray:
    """Probability of label 1 for each text; a text without words has the calibrated floor."""
    numbers, p = _Numbers(), model.p
    runs = [np.array([numbers[w] for w in WORD.findall(t.decode("utf-8", "replace").lower())], dtype=np.int64) if t
            else np.zeros(0, np.int64) for t in texts]
    best = np.full(len(texts), -np.inf)
    if numbers:
        spelled = list(numbers)
        x = _inputs(p, np.array([model.words.get(w, 0) for w in spelled], dtype=np.int64), spelled)
        idx, real, owner = _grid(runs)
        now = _window_logits(p, x @ p["w_f"] + p["g_f"], x @ p["w_b"] + p["g_b"], idx, real)
        np.maximum.at(best, owner, now.astype(np.float64))
    # no word, no evidence: as clean as the calibration allows, never above the share of label 1
    none = min(model.prior, 0.05)
    z = np.clip(model.slope * np.where(np.isfinite(best), best, 0) + model.shift, -30, 30)
    return np.where(np.isfinite(best), 1 / (1 + np.exp(-z)), none)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score`` (0 to 1, higher: label 1 likelier) per row.

    NULL and empty texts and texts without words have a low fixed score.  Repeated rows and NULL ids stay
    rows of their own; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_blocks(batches, 6 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(score_block(shared.value, texts))],
                                             names=["doc_id", "score"])

    return narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def fit_documents(docs: DataFrame, labels: DataFrame, allowed: Column, per_class: int = 1000) -> Model:
    """Learn ``toxic`` from at most ``per_class`` labelled documents of each class among the label rows where ``allowed``."""
    return fit(*samples.by_labels(docs, labels, "toxic", allowed, per_class))
