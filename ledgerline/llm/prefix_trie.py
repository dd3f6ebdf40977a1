"""Prefix trie of conversations by truncation peeling, with member counts and subtree totals.

A conversation is the sequence of its turns; a turn is known by a digest of role and text (128 bits of
SHA-256) and the code points of its text.  Conversations are sorted by their sequence of digests over
range partitions, so that the members of a node stand next to each other and a popular prefix is spread
over as many tasks as it fills.  Each task peels blocks of neighbours: from the greatest depth down,
conversations that end at a depth are merged with the nodes that survive from below it, adjacent ones
with the same prefix are one node, its totals are summed, and the last turn is stripped.  Nodes that may
reach over a block's end (those on its first and last sequence) stay open: only what they have gathered
goes on, as one row for each of these two sequences, and the next pass peels those rows in the same way,
until one block holds all.  Each pass has at most an eighth of the rows of the one before.

What a task holds is bounded by the block and the longest conversation, never by a node's members; the
ids of a node that reaches over blocks are hashed as a sorted stream of chunks.

Edge cases: rows without conversation id belong to no conversation and are left out; NULL role or text is
empty; turns sort by number, NULL first, ties by role and then by the turn's digest; repeated rows are
repeated turns; conversations without turns are members of the root alone; no conversations have no
root; columns other than the four named ones play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import small_batches, stored

#: bytes of a turn in a sequence: 16 of digest, 4 of length (big-endian code points)
TURN = 20
#: turns in a range partition, and in a block that a task peels at once
PART_TURNS, MAX_PART_TURNS, BLOCK_TURNS = 20_000, 4_000_000, 200_000
#: turns that the last pass peels in one task; more go through a further pass
LAST_TURNS = 500_000

NONE = hashlib.sha256(b"").hexdigest()
_MAX = np.iinfo(np.int64).max
_STATS = ("n", "least", "children", "leaves", "saved")
_OUT = ("kind int, conv_id long, depth int, parent_conv_id long, n long, children long, leaves long, saved long, ends string, "
        "key binary, parent_key binary, path binary, " + ", ".join(f"{s}_at array<long>" for s in _STATS))
_NODE, _EDGE, _CHUNK = 0, 1, 2


def turn_codes(role: Column, text: Column) -> Column:
    """The 20 bytes that stand for a turn in a sequence."""
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 2 * TURN - 8), F.lpad(F.hex(F.length(text)), 8, "0")))


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turns`` (codes in order) of every conversation that has an id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.col("turn").cast("long")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(turn.isNotNull().alias("numbered"), F.coalesce(turn, F.lit(0)).alias("turn"), role.alias("role"), turn_codes(role, text).alias("code")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select("conv_id", F.col("t.code").alias("turns"))


def rebuilt(own: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """Every conversation with its first h turns replaced by those of the first id of its family.

    h is crc32 of the decimal id modulo ``most``; a family is ``family`` ids in a row, so that the
    first turns of one conversation meet at most twice so many others (ids around zero)."""
    c, h = F.col("conv_id"), F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    heads = own.where(c % family == 0).select(c.alias("head_id"), F.slice("turns", 1, most - 1).alias("head"))
    both = own.withColumn("head_id", c - c % family).withColumn("h", h.cast("int")).join(heads, "head_id", "left")
    none = F.array().cast("array<binary>")
    turns = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                     F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))))
    return both.select("conv_id", turns.alias("turns"))


def _blocks(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[list[dict]]:
    rows, held = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            size = len(row["path"]) // TURN + 1
            if rows and held + size > limit:
                yield rows
                rows, held = [], 0
            rows.append(row)
            held += size
    if rows:
        yield rows


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))) // TURN


def _key(path: bytes, depth: int) -> bytes:
    return hashlib.sha256(path[:TURN * depth]).digest()[:16]


def peel(rows: list[dict], first_pass: bool, last_pass: bool) -> list[dict]:
    """Nodes of one sorted block; of those that may reach beyond it what they have gathered so far."""
    out: list[dict] = []
    paths = [r["path"] for r in rows]
    sizes = np.array([len(p) // TURN for p in paths])
    shared = np.array([-1] + [_common(a, b) for a, b in zip(paths, paths[1:])])
    start = np.concatenate([[0], np.cumsum(sizes)])
    points = np.frombuffer(b"".join(paths), np.dtype([("digest", "V16"), ("points", ">u4")]))["points"].astype(np.int64)
    if first_pass:  # a conversation counts where it ends
        item, at = np.arange(len(rows)), sizes
        own = {"n": np.ones(len(rows), np.int64), "least": np.array([r["conv_id"] for r in rows], np.int64)}
        own |= {s: np.zeros(len(rows), np.int64) for s in _STATS[2:]}
    else:
        each = [len(r["n_at"]) for r in rows]
        item = np.repeat(np.arange(len(rows)), each)
        at = np.concatenate([np.arange(r["depth"], r["depth"] + k) for r, k in zip(rows, each)])
        own = {s: np.concatenate([np.array(r[f"{s}_at"], np.int64) for r in rows]) for s in _STATS}
    order = np.argsort(at, kind="stable")
    cuts = np.searchsorted(at[order], np.arange(sizes.max() + 2))
    edges = ([], [])  # what the first and the last sequence have gathered, from the deepest
    empty = np.zeros(0, np.int64)
    up = {"rep": empty, "open": empty.astype(bool), "ends": []} | {s: empty for s in _STATS}
    for d in range(int(sizes.max()), -1, -1):
        ended = order[cuts[d]:cuts[d + 1]]
        rep = np.concatenate([up["rep"], item[ended]])
        sort = np.argsort(rep, kind="stable")
        rep = rep[sort]
        new = shared[rep] < d
        new[1:] &= rep[1:] != rep[:-1]
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        kept = ~up["open"]
        add = lambda s, mine, f=np.add: f.reduceat(np.concatenate([mine, own[s][ended]])[sort], first)
        n, children = add("n", up["n"] * kept), add("children", kept.astype(np.int64))
        leaves, saved = add("leaves", up["leaves"] * kept), add("saved", up["saved"] * kept)
        least = add("least", np.where(kept, up["least"], _MAX), np.minimum)
        rep_of = rep[first]
        is_open = np.zeros(len(first), bool)
        if not last_pass:
            is_open[0] |= sizes[0] >= d
            is_open[-1] |= sizes[-1] >= d
        groups_up = np.empty(len(sort), np.int64)
        groups_up[sort] = group
        out += _emit(up, d + 1, groups_up[:len(up["rep"])], least, is_open, rep_of, paths, first_pass)
        ends: list[str | None] = [NONE if first_pass else None] * len(first)
        if first_pass and len(ended):
            for g, ids in _ids(groups_up[len(up["rep"]):], own["least"][ended]):
                if is_open[g]:
                    out.append({"kind": _CHUNK, "key": _key(paths[rep_of[g]], d), "conv_id": ids[0], "ends": ",".join(map(str, ids))})
                else:
                    ends[g] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        for side, g in ((0, 0), (1, len(first) - 1)):
            if is_open[g] and (side == 0 and sizes[0] >= d or side == 1 and not (g == 0 and sizes[0] >= d)):
                edges[side].append((n[g], least[g], children[g], leaves[g], saved[g]))
        leaves = np.where((children == 0) & ~is_open, 1, leaves)
        if d:
            saved = saved + np.where(is_open, 0, (n - 1) * points[start[rep_of] + d - 1])
        up = {"rep": rep_of, "open": is_open, "ends": ends, "n": n, "least": least, "children": children, "leaves": leaves, "saved": saved}
    out += _emit(up, 0, None, None, None, None, paths, first_pass)
    for side, gathered in zip((0, len(rows) - 1), edges):
        if gathered:
            columns = [list(map(int, c)) for c in zip(*reversed(gathered))]
            out.append({"kind": _EDGE, "path": paths[side], "depth": int(sizes[side]) - len(gathered) + 1} | {f"{s}_at": c for s, c in zip(_STATS, columns)})
    return out


def _ids(groups: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    order = np.lexsort([ids, groups])
    groups, ids = groups[order], ids[order]
    cut = np.flatnonzero(np.diff(groups)) + 1
    for g, part in zip(groups[np.concatenate([[0], cut])], np.split(ids, cut)):
        yield int(g), part.tolist()


def _emit(up: dict, depth: int, group, least, is_open, rep_of, paths: list[bytes], first_pass: bool) -> list[dict]:
    """The closed nodes of ``depth``; a parent that is still open is named by its key."""
    out = []
    for i in np.flatnonzero(~up["open"]).tolist():
        row = {"kind": _NODE, "conv_id": int(up["least"][i]), "depth": depth, "n": int(up["n"][i]), "children": int(up["children"][i]),
               "leaves": int(up["leaves"][i]), "saved": int(up["saved"][i]), "ends": up["ends"][i]}
        if not first_pass:
            row["key"] = _key(paths[up["rep"][i]], depth)
        if depth:
            g = group[i]
            if is_open[g]:
                row["parent_key"] = _key(paths[rep_of[g]], depth - 1)
            else:
                row["parent_conv_id"] = int(least[g])
        out.append(row)
    return out


_ARROW = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}.get(t, pa.list_(pa.int64())))
                    for n, t in (c.split(" ") for c in _OUT.split(", "))])


def _peel_all(batches: Iterable[pa.RecordBatch], limit: int, first_pass: bool, last_pass: bool) -> Iterator[pa.RecordBatch]:
    for rows in _blocks(batches, limit):
        done = peel(rows, first_pass, last_pass)
        for i in range(0, len(done), 50_000):
            yield pa.RecordBatch.from_pylist(done[i:i + 50_000], schema=_ARROW)


def _hash_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None
    for batch in batches:
        done = []
        for k, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["key", "hashed"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "hashed"])


def trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie of ``sequences`` (``conv_id`` unique, ``turns`` as of ``turns_of``).

    ``conv_id`` smallest member, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``
    (childless nodes of its subtree), ``saved_tokens`` (code points of turns that members share, summed
    over the subtree), ``ends_sha256`` (ids of the conversations that end here)."""
    spark = sequences.sparkSession
    small_batches(sequences)
    path = F.unhex(F.array_join(F.transform("turns", F.hex), ""))
    rows = stored(sequences.select("conv_id", path.alias("path"), F.size("turns").alias("size")), "trie_items")
    total = rows.agg(F.sum(F.col("size").cast("long") + 1).alias("turns"), F.max("size").alias("most")).first()
    turns, most = total["turns"] or 0, total["most"] or 0
    wide = max(1, min(math.ceil(turns / PART_TURNS), int(spark.conf.get("spark.sql.shuffle.partitions"))), math.ceil(turns / MAX_PART_TURNS))
    sort, limit, last = ["path", "conv_id"], max(BLOCK_TURNS, 16 * (most + 1)), max(LAST_TURNS, 16 * (most + 1))
    rows, passes = rows.drop("size"), []
    while True:
        first_pass, last_pass = not passes, wide == 1 and turns <= last
        dealt = rows.coalesce(1) if last_pass else rows.repartitionByRange(wide, *sort)
        done = stored(dealt.sortWithinPartitions(*sort).mapInArrow(
            partial(_peel_all, limit=2 * last if last_pass else limit, first_pass=first_pass, last_pass=last_pass), _OUT), "trie_pass")
        passes.append(done)
        if last_pass:
            break
        rows, sort = done.where(F.col("kind") == _EDGE), ["path", "depth"]
        turns = rows.agg(F.sum(F.size("n_at").cast("long")).alias("n")).first()["n"] or 0
        wide, limit = math.ceil(turns / last) or 1, last
    # nodes that reached over blocks, with their hashed ids; they are the only parents still unknown
    chunks = passes[0].where(F.col("kind") == _CHUNK).select("key", "conv_id", "ends").repartition("key").sortWithinPartitions("key", "conv_id")
    hashed = chunks.mapInArrow(_hash_chunks, "key binary, hashed string")
    nodes = [p.where(F.col("kind") == _NODE) for p in passes]
    columns = ["conv_id", "depth", "parent_conv_id", "n", "children", "leaves", "saved", "ends", "parent_key"]
    found = nodes[0].select(*columns)
    if nodes[1:]:
        late = nodes[1]
        for p in nodes[2:]:
            late = late.unionByName(p)
        late = stored(late.join(hashed, "key", "left").withColumn("ends", F.coalesce("hashed", F.lit(NONE))).select(*columns, "key"), "trie_late")
        found = found.unionByName(late.select(*columns))
        parents = late.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"))
        known = found.where("parent_key is null")
        found = known.unionByName(found.where("parent_key is not null").join(parents, "parent_key")
                                  .withColumn("parent_conv_id", F.col("found")).select(*columns))
    return found.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
                        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                        F.col("ends").alias("ends_sha256"))
