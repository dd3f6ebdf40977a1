"""Source divergence audit: how far the word use of sources of one language lies apart.

Two passes over the texts.  The first counts, exactly, in how many documents of its language each term stands,
and keeps those in enough of them.  Kept terms are dealt by hash into shards of bounded size; a task builds a
minimal perfect hash of each shard (levels of bit fields: a key that meets no other at its place of a level
stays there, the rest move on) with the terms themselves in slot order.  The second pass broadcasts the
shards, in rounds of bounded size, and looks every distinct word of a block up: a slot counts only where the
stored term equals the word.  Each group of language and source has a dense array of counters per shard; tasks
send these arrays, never words, and they are added up as a sorted stream.  The comparison of the sources then
runs on one shard at a time, whose size goes down as the number of sources goes up.

All arithmetic is on integers.  The shares of groups are p = 1 + floor(scale * (count + 2) / (N + 2 V)), two
shares lie floor((p - q)^2 / (p + q)) apart.

Edge cases: NULL text, language and source count as ''; texts without terms count for their group, which is
compared with zero counts; a language without kept terms has pairs of value 0 and no terms; repeated rows
count as often as they stand; no rows give no result; other columns play no part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import row_blocks, small_batches, stored

#: terms in a shard: at most the first figure; with many sources so few that sources x terms stay below the second
SHARD_TERMS, SHARD_CELLS = 4096, 1 << 20
#: bytes of shards that are broadcast in a round, and counters that a task holds before it sends them
ROUND_BYTES, TASK_SLOTS = 48 << 20, 8 << 20
#: distinct (language, term) that a task of the first pass holds before it sends them
TASK_TERMS = 400_000
#: languages whose figures are broadcast (40 bytes each); more are joined by a shuffle
SMALL_LANGS = 20_000

_LEVELS, _SPREAD = 12, 1.5

# letters of any script: every byte beyond ASCII and the ASCII letters, A-Z as a-z; the rest separates
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


# --- minimal perfect hash of one shard -------------------------------------------------------------------


def _mix(h: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words))


def build(words: list[bytes]) -> tuple[list[int], bytes, list[bytes]]:
    """(bits of each level, the bit fields packed one after the other, the words in slot order).

    Words that meet others at every level follow without a bit."""
    left, h = np.arange(len(words)), hashes(words)
    sizes, fields, order = [], [], []
    for level in range(_LEVELS):
        if not len(left):
            break
        size = max(8, math.ceil(_SPREAD * len(left)))
        at = (_mix(h[left], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        settled = alone[at]
        order += left[settled][np.argsort(at[settled])].tolist()
        sizes.append(size)
        fields.append(alone)
        left = left[~settled]
    order += left.tolist()
    bits = np.packbits(np.concatenate(fields)).tobytes() if fields else b""
    return sizes, bits, [words[i] for i in order]


class Shard:
    """Lookup in one shard; ``slots`` gives -1 for words that are not stored."""

    def __init__(self, sizes: list[int], bits: bytes, blob: bytes):
        self.sizes = sizes
        self.field = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool)
        self.rank = np.cumsum(self.field, dtype=np.int32)
        self.blob = blob
        self.ends = np.flatnonzero(np.frombuffer(blob, np.uint8) == 32)
        self.n = len(self.ends)
        settled = int(self.rank[-1]) if len(self.rank) else 0
        self.rest = {self.word(s): s for s in range(settled, self.n)}

    def word(self, slot: int) -> bytes:
        return self.blob[self.ends[slot - 1] + 1 if slot else 0:self.ends[slot]]

    def slots(self, words: list[bytes], h: np.ndarray) -> np.ndarray:
        out = np.full(len(words), -1, np.int64)
        left, base = np.arange(len(words)), 0
        for level, size in enumerate(self.sizes):
            at = base + (_mix(h[left], level) % np.uint64(size)).astype(np.int64)
            here = self.field[at]
            out[left[here]] = self.rank[at[here]] - 1
            left, base = left[~here], base + size
        for i, s in enumerate(out.tolist()):  # the place is right only where the stored word is the same
            if s < 0:
                out[i] = self.rest.get(words[i], -1)
            elif self.word(s) != words[i]:
                out[i] = -1
        return out


# --- first pass ------------------------------------------------------------------------------------------


def _document_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def send() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            words = list(counts)
            for i in range(0, len(words), 100_000):
                part = words[i:i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(part, pa.binary()).cast(pa.string()),
                                                  pa.array([counts[w] for w in part], pa.int64())], names=["lang", "term", "docs"])
        held.clear()

    for block in row_blocks(batches, "text"):
        for lang, text in zip(block.column("lang").to_pylist(), block.column("text").to_pylist()):
            held.setdefault(lang, Counter()).update(set(terms(text)))
        if sum(map(len, held.values())) > TASK_TERMS:
            yield from send()
    yield from send()


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """``lang``, ``term`` of the terms that stand in at least ``min_docs`` documents of their language."""
    counts = docs.select("lang", "text").mapInArrow(_document_counts, "lang string, term string, docs long")
    return counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term")


def _build_shard(table: pa.Table) -> pa.Table:
    words = sorted(w.encode() for w in table.column("term").to_pylist())
    sizes, bits, ordered = build(words)
    return pa.table({"lang": table.column("lang")[:1], "shard": table.column("shard")[:1], "n_shards": table.column("n_shards")[:1],
                     "n_terms": pa.array([len(words)], pa.int64()), "sizes": pa.array([sizes], pa.list_(pa.int64())), "bits": pa.array([bits], pa.binary()),
                     "blob": pa.array([b"".join(w + b" " for w in ordered)], pa.binary())})


def perfect_hashes(kept: DataFrame, langs: DataFrame) -> DataFrame:
    """One row per shard: its bit fields and its terms in slot order, each followed by a space."""
    place = F.shiftrightunsigned(F.xxhash64("term"), 1) % F.col("n_shards")
    dealt = kept.join(langs.select("lang", "n_shards"), "lang").withColumn("shard", place)
    return dealt.groupBy("lang", "shard").applyInArrow(
        _build_shard, "lang string, shard long, n_shards long, n_terms long, sizes array<long>, bits binary, blob binary")


# --- second pass -----------------------------------------------------------------------------------------


def _pack(counts: np.ndarray) -> tuple[int, bytes]:
    most = int(counts.max())
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    return width, counts.astype(f"<u{width}").tobytes()


def _recount(shards):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[str, dict[int, Shard]] = {}
        n_shards: dict[str, int] = {}
        for lang, shard, n, sizes, bits, blob in shards.value:
            of.setdefault(lang, {})[shard] = Shard(sizes, bits, blob)
            n_shards[lang] = n
        held: dict[tuple, np.ndarray] = {}

        def send() -> Iterator[pa.RecordBatch]:
            rows = [(lang, source, shard, *_pack(c)) for (lang, source, shard), c in held.items()]
            held.clear()
            for i in range(0, len(rows), 500):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 500]), (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.binary()))],
                                                 names=["lang", "source", "shard", "width", "counts"])

        for block in row_blocks(batches, "text"):
            seen: dict[str, dict[str, Counter]] = {}
            for lang, source, text in zip(*(block.column(c).to_pylist() for c in ("lang", "source", "text"))):
                if lang in of:
                    seen.setdefault(lang, {}).setdefault(source, Counter()).update(terms(text))
            for lang, groups in seen.items():
                words = list(set().union(*groups.values()))
                h = hashes(words)
                place = ((h >> np.uint64(1)) % np.uint64(n_shards[lang])).astype(np.int64)
                order = np.argsort(place, kind="stable")
                cuts = np.searchsorted(place[order], np.arange(n_shards[lang] + 1))
                slot = np.full(len(words), -1, np.int64)
                for shard, own in of[lang].items():
                    mine = order[cuts[shard]:cuts[shard + 1]]
                    if len(mine):
                        slot[mine] = own.slots([words[i] for i in mine.tolist()], h[mine])
                at = dict(zip(words, range(len(words))))
                for source, counts in groups.items():
                    word = np.fromiter(map(at.__getitem__, counts), np.int64, len(counts))
                    times = np.fromiter(counts.values(), np.int64, len(counts))
                    found = slot[word] >= 0
                    word, times = word[found], times[found]
                    sort = np.argsort(place[word], kind="stable")
                    word, times = word[sort], times[sort]
                    in_shard, first = np.unique(place[word], return_index=True)
                    for shard, a, b in zip(in_shard.tolist(), first, [*first[1:], len(word)]):
                        key = (lang, source, shard)
                        if key not in held:
                            held[key] = np.zeros(of[lang][shard].n, np.int64)
                        held[key][slot[word[a:b]]] += times[a:b]  # distinct words have distinct slots
            if sum(map(len, held.values())) > TASK_SLOTS:
                yield from send()
        yield from send()
    return count


def _add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the count arrays of equal keys, which come one after the other."""
    key, total = None, None
    names, types = ["lang", "source", "shard", "total", "counts"], (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*key, int(total.sum()), total.astype("<i8").tobytes()), types)], names=names)

    for batch in batches:
        for *k, width, counts in zip(*(c.to_pylist() for c in batch.columns)):
            counts = np.frombuffer(counts, f"<u{width}").astype(np.int64)
            if k == key:
                total += counts
            else:
                if key is not None:
                    yield row()
                key, total = k, counts
    if key is not None:
        yield row()


def recount(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``shard``, ``total``, ``counts`` (64-bit, by slot) of the shards in which a group has terms."""
    spark = docs.sparkSession
    size = F.length("blob") + F.length("bits") + 8 * F.size("sizes") + 64
    rounds = max(1, math.ceil((shards.agg(F.sum(size)).first()[0] or 0) / (ROUND_BYTES / 2)))
    while True:  # shards are small and dealt by hash, so the first number is enough but in odd cases
        dealt = shards.withColumn("round", F.pmod(F.xxhash64("lang", "shard"), F.lit(rounds)))
        most = dealt.groupBy("round").agg(F.sum(size).alias("s")).agg(F.max("s")).first()[0] or 0
        if most <= ROUND_BYTES or rounds > 1 << 20:
            break
        rounds *= 2
    parts = None
    for r in range(rounds):
        rows = dealt.where(F.col("round") == r).select("lang", "shard", "n_shards", "sizes", "bits", "blob").collect()
        found = spark.sparkContext.broadcast([(x[0], x[1], x[2], list(x[3]), bytes(x[4]), bytes(x[5])) for x in rows])
        part = docs.mapInArrow(_recount(found), "lang string, source string, shard long, width int, counts binary")
        parts = part if parts is None else parts.unionByName(part)
    by = ["lang", "source", "shard"]
    return parts.repartition(*by).sortWithinPartitions(*by).mapInArrow(_add_up, "lang string, source string, shard long, total long, counts binary")


# --- comparison ------------------------------------------------------------------------------------------


def shares(counts: np.ndarray, total: int, vocabulary: int, scale: int) -> np.ndarray:
    """1 + floor(scale * (count + 2) / (total + 2 * vocabulary)), exact also where the product passes 64 bits."""
    below = total + 2 * vocabulary
    x = counts.astype(np.int64) + 2
    if below < (1 << 62) // scale:
        return 1 + x * scale // below
    return np.array([1 + int(c) * scale // below for c in x], np.int64)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


_COMPARED = "lang string, source string, part string, item string, value long"


def _compare(top: int, scale: int):
    def compare(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        stored_terms = next(r for r in rows if r["source"] is None)
        lang, vocabulary = stored_terms["lang"], stored_terms["total"]
        words = stored_terms["counts"].split(b" ")[:-1]
        groups = sorted((r for r in rows if r["source"] is not None), key=lambda r: r["source"].encode())
        zero = np.zeros(len(words), np.int64)
        counts = [np.frombuffer(r["counts"], "<i8") if r["counts"] is not None else zero for r in groups]
        p = np.stack([shares(c, r["total"], vocabulary, scale) for c, r in zip(counts, groups)])
        q = shares(sum(counts), sum(r["total"] for r in groups), vocabulary, scale)
        out = []
        for i, r in enumerate(groups):
            values = _apart(p[i + 1:], p[i]).sum(axis=1).tolist()
            for other, v in zip(groups[i + 1:], values):
                out += [(lang, r["source"], "pair", other["source"], v), (lang, other["source"], "pair", r["source"], v)]
            value = _apart(p[i], q)
            at = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            if len(at) > top:  # all that are not below the top-th, so that ties are cut by the word
                at = at[value[at] >= np.partition(value[at], len(at) - top)[len(at) - top]]
            best = sorted((-int(value[s]), words[s]) for s in at.tolist())[:top]
            out += [(lang, r["source"], "term", w.decode(), -v) for v, w in best]
        columns = list(zip(*out)) if out else [[]] * 5
        return pa.table({n: pa.array(c, pa.int64() if n == "value" else pa.string()) for n, c in zip(("lang", "source", "part", "item", "value"), columns)})
    return compare


def divergences(docs: DataFrame, min_docs: int = 10, top: int = 10, scale: int = 1_000_000_000) -> DataFrame:
    """Rows of two parts for every group of ``lang`` and ``source``.

    ``pair``: ``item`` is another source of the language, ``value`` how far the two lie apart over all kept terms.
    ``term``: ``item`` is one of the ``top`` terms that the group uses more than its language does, ``value`` how far."""
    small_batches(docs)
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = stored(docs.select("lang", "source").distinct(), "audit_groups")
    kept = stored(kept_terms(docs, min_docs), "audit_terms")
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources")) \
        .join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary")), "lang")
    limit = F.greatest(F.lit(64), F.least(F.lit(SHARD_TERMS), F.floor(F.lit(SHARD_CELLS) / F.col("n_sources"))))
    langs = stored(sizes.select("lang", "vocabulary", F.ceil(F.col("vocabulary") / (limit * 0.9)).alias("n_shards")), "audit_langs")
    few = langs.count() <= SMALL_LANGS
    langs = F.broadcast(langs) if few else langs
    shards = stored(perfect_hashes(kept, langs), "audit_hashes")
    counted = stored(recount(docs, shards), "audit_counts")

    totals = groups.join(counted.groupBy("lang", "source").agg(F.sum("total").alias("total")), ["lang", "source"], "left") \
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"))
    every = shards.select("lang", "shard").join(totals, "lang").join(counted.drop("total"), ["lang", "source", "shard"], "left") \
        .select("lang", "shard", "source", "total", "counts")
    words = shards.join(langs, "lang").select("lang", "shard", F.lit(None).cast("string").alias("source"), F.col("vocabulary").alias("total"), F.col("blob").alias("counts"))
    compared = stored(every.unionByName(words).groupBy("lang", "shard").applyInArrow(_compare(top, scale), _COMPARED), "audit_values")

    by = ["lang", "source", "item"]
    summed = compared.where("part = 'pair'").groupBy(*by).agg(F.sum("value").alias("value"))
    others = groups.join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = others.join(summed, by, "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = compared.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).unionByName(best)
