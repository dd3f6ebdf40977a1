"""Truncation peeling against a plain trie built from every prefix."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import prefix_trie as P


def sequences_of(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            code = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append((turn is not None, turn or 0, role.encode(), code, len(text), text))
    return {c: [(t[2].decode(), t[5]) for t in sorted(v)] for c, v in own.items()}


def rebuild(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c / 100) * 100
        out[c] = own.get(c - base, [])[:h] + turns[h:]
    return out


def plain(seqs):
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    out = {}
    for node, ids in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        ends = ",".join(str(c) for c in sorted(ids) if len(seqs[c]) == len(node))
        out[min(ids), len(node)] = (
            min(members[node[:-1]]) if node else None, len(ids), len(children),
            sum(not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in members) for n in below),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n), hashlib.sha256(ends.encode()).hexdigest())
    return out


def run(spark, rows, again=True):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("path", F.lit("x")).withColumn("n", F.lit(1))
    own = P.turns_of(df)
    got = P.trie(P.rebuilt(own) if again else own).collect()
    assert len({(r.conv_id, r.depth) for r in got}) == len(got)
    return {(r.conv_id, r.depth): tuple(r)[2:] for r in got}


ODD = [(1, None, "a", "x"), (1, 0, None, None), (1, 0, "", "é😀"), (None, 1, "a", "lost"), (2, 0, "u", "t"), (2, 0, "u", "t"), (2, 0, "u", "s"),
       (-5, 1, "u", "t"), (0, 3, "u", "t"), (0, 1, "u", "t"), (100, 0, "u", "t"), (107, 0, "u", "t"), (207, 0, "only", "y"), (7, -1, "u", "z" * 50_000)]


def sample(seed, n, deep=12):
    """Copies, prefixes of one another, one long conversation, a hot first turn."""
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        size = rnd.choice([1, 2, 3, 5, 8]) if c != n // 2 else deep
        copy = rnd.random() < 0.35
        for t in range(size):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", "same" if copy or t == 0 and rnd.random() < 0.5 else rnd.choice("abc") * (t + 1)))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_against_plain_trie(spark, monkeypatch, small):
    if small:  # blocks of a few turns, several passes
        monkeypatch.setattr(P, "PART_TURNS", 40)
        monkeypatch.setattr(P, "BLOCK_TURNS", 25)
        monkeypatch.setattr(P, "LAST_TURNS", 60)
    rows = sample(1, 260) + [(c + 1000, t, r, x) for c, t, r, x in ODD if c is not None] + [(None, 0, "u", "t")]
    own = sequences_of(rows)
    assert run(spark, rows, again=False) == plain(own)
    assert run(spark, rows) == plain(rebuild(own))


def test_edge_cases(spark):
    assert run(spark, ODD) == plain(rebuild(sequences_of(ODD)))
    assert run(spark, []) == {}
    assert run(spark, [(None, 1, "a", "b")]) == {}


def test_blocks_meet(spark):
    """Peeling in two passes by hand: any cut of the sorted rows gives the same nodes."""
    rows = sample(5, 40)
    items = sorted((b"".join(hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()[:16] + len(x).to_bytes(4, "big") for r, x in s), c)
                   for c, s in sequences_of(rows).items())
    items = [{"conv_id": c, "path": p} for p, c in items]
    whole = P.peel(items, True, True)
    for cut in (1, 7, 20, 39):
        first = P.peel(items[:cut], True, False) + P.peel(items[cut:], True, False)
        edges = sorted((r for r in first if r["kind"] == 1), key=lambda r: (r["path"], r["depth"]))
        last = P.peel(edges, False, True)
        tell = lambda rows: sorted((r["conv_id"], r["depth"], r["n"], r["children"], r["leaves"], r["saved"]) for r in rows if r["kind"] == 0)
        assert tell(first + last) == tell(whole)
