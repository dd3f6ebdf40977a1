"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A block of documents (``ENCODE_BYTES``) is cut into pieces by the tokenizer's pattern; each *distinct*
piece becomes a run of byte symbols in one flat array.  An inverted index leads from the token a pair
merges into to the positions of such pairs.  Merges are replayed in rank order: the positions of the
lowest rank are taken from the index, merged all at once, and only the pairs with the touched
neighbours are looked up and indexed anew.  A document's ids are then gathered from its pieces.

Nothing is shuffled: a block depends on its own rows only, so a lost executor costs its blocks.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerline.llm.common import give_back, narrow, small_batches, text_blocks

NO_RANK = np.int64(1) << 40
#: text encoded at once; the symbol arrays of a block take about twenty times as much
ENCODE_BYTES = 2 << 20


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by id, and every pair of tokens that merges (key left << 32 | right, sorted)."""

    tokens: tuple[bytes, ...]
    pair_keys: np.ndarray
    pair_ids: np.ndarray
    pattern: str


def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read a rank file (base64 token, rank per line).  Its size is that of the vocabulary, so the
    table may go to every task.  Ids must be 0..n-1 and hold all 256 single bytes."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    tokens: list[bytes] = [b""] * len(ranks)
    for t, r in ranks.items():
        tokens[r] = t
    keys, ids = [], []
    for t, r in ranks.items():
        for cut in range(1, len(t)):
            left, right = ranks.get(t[:cut]), ranks.get(t[cut:])
            if left is not None and right is not None:
                keys.append(left << 32 | right)
                ids.append(r)
    k = np.array(keys, dtype=np.int64)
    order = np.argsort(k)
    return Vocabulary(tuple(tokens), k[order], np.array(ids, dtype=np.int64)[order], pattern)


class Encoder:
    """Merge replay over the distinct pieces of a block."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.rank = {t: i for i, t in enumerate(vocab.tokens)}
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int64)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair merges into, or NO_RANK."""
        keys = self.vocab.pair_keys
        if not len(keys):
            return np.full(len(left), NO_RANK)
        want = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        return np.where(keys[at] == want, self.vocab.pair_ids[at], NO_RANK)

    def one_piece(self, piece: bytes) -> list[int]:
        """A piece by itself: the leftmost pair of lowest rank, again and again."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            r, i = min((self.rank.get(parts[i] + parts[i + 1], int(NO_RANK)), i) for i in range(len(parts) - 1))
            if r == NO_RANK:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.rank[p] for p in parts]

    def pieces(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, offsets) - a piece that is a token stands for itself."""
        whole = np.array([self.rank.get(w, -1) for w in words], dtype=np.int64)
        open_ = np.flatnonzero(whole < 0)
        lens = np.array([len(words[i]) for i in open_], dtype=np.int64)
        raw = np.frombuffer(b"".join(words[i] for i in open_), dtype=np.uint8)
        n = len(raw)
        tok = self.byte_id.astype(np.int32)[raw]
        owner = np.repeat(np.arange(len(open_), dtype=np.int32), lens)
        pos = np.arange(n, dtype=np.int32)
        last = np.zeros(n, dtype=bool)
        first = np.zeros(n, dtype=bool)
        ends = np.cumsum(lens)
        last[ends[lens > 0] - 1] = True
        first[(ends - lens)[lens > 0]] = True
        nxt = np.where(last, np.int32(-1), pos + np.int32(1))
        prv = np.where(first, np.int32(-1), pos - np.int32(1))
        alive = np.ones(n, dtype=bool)
        again: set[int] = set()

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray, ranks: np.ndarray) -> None:
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for r, part in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts)):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(heap, r)

        del pos, first
        start = np.flatnonzero(~last).astype(np.int32)
        ranks = self.pair_rank(tok[start], tok[start + 1])
        add(start[ranks < NO_RANK], ranks[ranks < NO_RANK])
        del start, ranks
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            p = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            p = p[alive[p]]
            q = nxt[p]
            p, q = p[q >= 0], q[q >= 0]
            if not len(p):
                continue
            ok = self.pair_rank(tok[p], tok[q]) == r
            p, q = p[ok], q[ok]
            if not len(p):
                continue
            # of pairs that share a symbol the left one merges: every other one of a run
            if len(p) > 1:
                follows = np.concatenate(([False], q[:-1] == p[1:]))
                if follows.any():
                    run_start = np.maximum.accumulate(np.where(follows, 0, np.arange(len(p))))
                    take = (np.arange(len(p)) - run_start) % 2 == 0
                    p, q = p[take], q[take]
            tok[p] = r
            alive[q] = False
            after = nxt[q]
            nxt[p] = after
            has = after >= 0
            prv[after[has]] = p[has]
            before = prv[p]
            left = np.unique(np.concatenate((before[before >= 0], p[has])))
            if len(left):
                new = self.pair_rank(tok[left], tok[nxt[left]])
                # a lower rank that only now appears would have come first within its piece
                if (early := new < r).any():
                    again.update(owner[left[early]].tolist())
                add(left[new < NO_RANK], new[new < NO_RANK])

        ids_open = tok[alive]
        counts_open = np.bincount(owner[alive], minlength=len(open_)) if n else np.zeros(len(open_), dtype=np.int64)
        counts = np.ones(len(words), dtype=np.int64)
        counts[open_] = counts_open
        redo = {int(open_[o]): self.one_piece(words[open_[o]]) for o in again}
        if redo:
            starts = np.concatenate(([0], np.cumsum(counts_open)))
            rows = [redo.get(int(w)) for w in open_]
            ids_open = np.concatenate([np.array(x, dtype=np.int64) if x is not None else ids_open[starts[k]:starts[k + 1]]
                                       for k, x in enumerate(rows)])
            for w, x in redo.items():
                counts[w] = len(x)
        offsets = np.concatenate(([0], np.cumsum(counts)))
        flat = np.empty(offsets[-1], dtype=np.uint32)
        mine = np.repeat(whole < 0, counts)
        flat[mine] = ids_open
        flat[~mine] = whole[whole >= 0]
        return flat, offsets


class _Seen(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


@lru_cache(maxsize=4)
def _pattern(text: str):
    return regex.compile(text)


def encode_block(enc: Encoder, texts: list[bytes | None]) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    seen = _Seen()
    find = _pattern(enc.vocab.pattern).findall
    codes = [np.array([seen[w] for w in find(t.decode("utf-8", "replace"))], dtype=np.int32) if t else None for t in texts]
    flat, offsets = enc.pieces([w.encode() for w in seen])
    out = []
    for c in codes:
        if c is None or not len(c):
            out.append(b"")
            continue
        size = offsets[c + 1] - offsets[c]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(offsets[c] - (ends - size), size)
        out.append(flat[at].astype("<u4").tobytes())
    return out


def encode(docs: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit) per row of ``docs``.

    NULL and empty texts give no ids; repeated rows and NULL ids stay as they are; a text of any
    length is encoded whole; an empty table gives an empty result; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocab_path, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(shared.value)
        for ids, texts in text_blocks(batches, ENCODE_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(encode_block(enc, texts), pa.binary())],
                                             names=["doc_id", "ids"])

    return narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids",
           keep_ids: bool = False) -> DataFrame:
    """``doc_id``, ``bytes`` (and ``ids``): the tokens' bytes in a row.  NULL ids count as none."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_vocabulary(vocab_path, pattern).tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [b"".join(map(token, np.frombuffer(v.as_py() or b"", dtype="<u4").tolist())) for v in part.column(1)]
                cols = [part.column(0), pa.array(texts, pa.binary())] + ([part.column(1)] if keep_ids else [])
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "bytes", "ids"][:len(cols)])
            give_back()

    small_batches(encoded)
    df = encoded.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{ids_col}` as ids")
    return df.mapInArrow(run, "doc_id long, bytes binary" + (", ids binary" if keep_ids else ""))
