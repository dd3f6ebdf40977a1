"""Language identification: averaged hashed subword embeddings with a linear softmax.

A word's subwords are the byte n-grams (``NGRAMS``) of ``<word>``, hashed to ``BUCKETS`` rows of an
embedding table.  A text is the average over all subwords of all its words; a linear softmax over it
gives the language.  Fitted by stochastic gradient descent in numpy on snippets of a bounded sample;
temperature and rejection threshold come from texts kept apart from the fitting.

Scoring folds embedding and output layer into one table (bucket x languages); every word of every
whole text counts.  It is a map over blocks of rows: no shuffle, state only of the block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import samples
from ledgerline.llm.common import narrow, row_blocks, small_batches, text_blocks
from ledgerline.llm.subwords import subword_runs, sum_runs

BUCKETS = 1 << 15
NGRAMS = (1, 2, 3, 4)
DIM = 16
UNKNOWN = "und"
WORDS_AT_ONCE = 1 << 14  # distinct words whose subwords are held at once
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray        # BUCKETS x languages: embedding times output layer
    bias: np.ndarray
    temperature: float
    reject_below: float


def words_of(text: str) -> list[str]:
    return [w for w in WORD.findall(text.lower()) if w[0].isalpha() or any(map(str.isalpha, w))]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(sample: list[tuple[str, str]], epochs: int = 6, rate: float = 2.0, seed: int = 7) -> Model:
    """Stochastic gradient descent over snippets of 1 to 40 words from seeded random places of the texts; one text in eight calibrates."""
    languages = tuple(sorted({y for _, y in sample}))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.5)
    rng = np.random.default_rng(seed)
    number = {x: i for i, x in enumerate(languages)}
    held = len(sample) >= 16
    snippets: list[tuple[list[str], int]] = []
    apart: list[tuple[list[str], int]] = []
    for k, (text, y) in enumerate(sample):
        w = words_of(text)
        if not w:
            continue
        if held and k % 8 == 7:
            apart.append((w, number[y]))
            continue
        for n in (int(rng.integers(1, 6)), int(rng.integers(6, 41)), 40):
            at = int(rng.integers(0, max(1, len(w) - n + 1)))       # anywhere in the whole text
            snippets.append((w[at:at + n], number[y]))
    emb = rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 1 / DIM, (DIM, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps = max(1, epochs * (len(snippets) // 64 + 1))
    done = 0
    for _ in range(epochs):
        order = rng.permutation(len(snippets))
        for at in range(0, len(order), 64):
            part = [snippets[i] for i in order[at:at + 64]]
            lr = rate * (1 - done / steps)
            done += 1
            bucket, per_word = subword_runs([w for ws, _ in part for w in ws], NGRAMS, BUCKETS)
            per_text = sum_runs(per_word, np.array([len(ws) for ws, _ in part]))
            mean = sum_runs(emb[bucket], per_text) / per_text[:, None]
            p = _softmax(mean @ out + bias)
            p[np.arange(len(part)), [y for _, y in part]] -= 1
            p /= len(part)
            back = (p @ out.T) / per_text[:, None]
            out -= lr * (mean.T @ p)
            bias -= lr * p.sum(axis=0)
            rows = np.repeat(back, per_text, axis=0)
            by = np.argsort(bucket, kind="stable")
            b = bucket[by]
            heads = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
            emb[b[heads]] -= lr * 20 * np.add.reduceat(rows[by], heads, axis=0)
    table = (emb @ out).astype(np.float32)
    temperature, reject = 1.0, 0.5
    if apart and len(languages) > 1:
        parts = []
        for at in range(0, len(apart), 32):
            some = apart[at:at + 32]
            bucket, per_word = subword_runs([w for ws, _ in some for w in ws], NGRAMS, BUCKETS)
            per_text = sum_runs(per_word, np.array([len(ws) for ws, _ in some]))
            parts.append(sum_runs(table[bucket], per_text) / per_text[:, None] + bias)
        z = np.concatenate(parts)
        y = np.array([k for _, k in apart])
        loss = {t: -np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean()
                for t in (0.1, 0.15, 0.2, 0.3, 0.5, 0.7, 1.0, 1.5, 2.0)}
        temperature = min(loss, key=loss.get)
        p = _softmax(z / temperature)
        right = p.argmax(axis=1) == y
        score = p.max(axis=1)
        # half of what 99 of 100 rightly recognised texts reach; never under chance, never over 1/2
        if right.any():
            reject = float(min(0.5, max(1 / len(languages), np.quantile(score[right], 0.01) / 2)))
    return Model(languages, table, bias, temperature, reject)


class _Codes(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def score_block(model: Model, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
    """(language or ``und``, probability) of each text."""
    codes, find = _Codes(), WORD.findall
    runs = [np.array([codes[w] for w in find(t.decode("utf-8", "replace").lower())], dtype=np.int64) if t else np.zeros(0, np.int64)
            for t in texts]
    words = list(codes)
    label, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not words or not model.languages:
        return label, score
    letter = np.array([w[0].isalpha() or any(map(str.isalpha, w)) for w in words])
    count = np.empty(len(words))
    logits = np.empty((len(words), len(model.languages)))
    for at in range(0, len(words), WORDS_AT_ONCE):
        part = slice(at, at + WORDS_AT_ONCE)
        bucket, per_word = subword_runs(words[part], NGRAMS, BUCKETS)
        count[part] = per_word
        logits[part] = sum_runs(model.table[bucket], per_word)
    count[~letter] = 0
    logits[~letter] = 0
    for i, c in enumerate(runs):
        n = count[c].sum() if len(c) else 0
        if n:
            z = (logits[c].sum(axis=0) / n + model.bias) / model.temperature
            p = np.exp(z - z.max())
            p /= p.sum()
            k = int(p.argmax())
            label[i], score[i] = model.languages[k], p[k]
    return label, score


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``rejected`` per row.

    NULL texts and texts without a letter are ``und`` with score 0 and rejected; so is every text when the
    model knows no language.  Repeated rows and NULL ids stay rows of their own; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for ids, texts in text_blocks(batches):
            label, score = score_block(m, texts)
            reject = [x == UNKNOWN or s < m.reject_below for x, s in zip(label, score)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(label, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(reject, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    return narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text the model does not reject."""
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rows in row_blocks(batches, text_col):
            label, score = score_block(m, rows.column(text_col).to_pylist())
            keep = pa.array([x != UNKNOWN and s >= m.reject_below for x, s in zip(label, score)], pa.bool_())
            rows = rows.filter(keep)
            k = rows.schema.get_field_index(text_col)
            yield from rows.set_column(k, text_col, rows.column(k).cast(pa.large_string() if pa.types.is_large_binary(rows.column(k).type) else pa.string())).to_batches()

    return docs.mapInArrow(run, docs.schema)


def fit_documents(docs: DataFrame, allowed: Column, per_language: int = 1000) -> Model:
    """Learn from at most ``per_language`` documents of each non-NULL ``lang`` among the rows where ``allowed``."""
    return fit(samples.by_column(docs, F.col("lang").cast("string"), allowed, per_language))
