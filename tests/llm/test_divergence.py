"""The audit against plain counting with Python integers; the perfect hash on its own."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import divergence as D


def plain(rows, min_docs=10, top=10):
    words = lambda t: [w.translate({i: i + 32 for i in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        df[lang].update(set(words(text)))
        counts[lang, source].update(words(text))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [w for w, n in df[lang].items() if n >= min_docs]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def share(c):
            n = sum(c[w] for w in kept)
            return {w: 1 + 10 ** 9 * (c[w] + 2) // (n + 2 * len(kept)) for w in kept}
        p, q = {s: share(counts[lang, s]) for s in sources}, share(whole)
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s][w], p[o][w]) for w in kept)) for o in sources if o != s]
            terms = [(w, f(p[s][w], q[w])) for w in kept if counts[lang, s][w] > 0 and p[s][w] > q[w]]
            for part, items, limit in (("pair", pairs, len(pairs)), ("term", terms, top)):
                for k, (item, v) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]):
                    out.append((lang, s, part, item, v, k + 1))
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = D.divergences(df.withColumn("shard", F.lit("x")).withColumn("total", F.lit("y")))
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, out.collect()))


def sample(seed=1, n=400):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeéß😀") for _ in range(rnd.randrange(1, 5))) for _ in range(150)]
    rows = []
    for i in range(n):
        lang = rnd.choice(["en", "en", "en", "de", None, ""])
        source = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "É", None])
        pool = vocabulary[:90] if source == "a" else vocabulary
        rows.append((i, rnd.choice([" ", "1", "_", "\n"]).join(w.upper() if rnd.random() < 0.2 else w for w in rnd.choices(pool, k=rnd.randrange(0, 60))), lang, source))
    rows += [(1, None, "en", "empty"), (2, "123 !?", "de", "empty"), (3, "few words only", "fr", "a"), (4, None, "fr", "b"), (5, "once", "it", "alone")]
    return rows + [(None, "Same copy", "en", "b")] * 12 + [(7, "long " * 50_000, "en", "a")]


@pytest.mark.parametrize("small", [False, True])
def test_against_plain_counts(spark, monkeypatch, small):
    if small:  # many shards, several rounds, arrays sent often, joins instead of broadcasts
        for name, value in (("SHARD_TERMS", 64), ("ROUND_BYTES", 600), ("TASK_SLOTS", 10), ("TASK_TERMS", 10), ("SMALL_LANGS", 0)):
            monkeypatch.setattr(D, name, value)
    rows = sample()
    assert run(spark, rows) == plain(rows)


def test_no_rows_and_no_kept_terms(spark):
    assert run(spark, []) == []
    rows = [(1, "a b", "en", "x"), (2, "c", "en", "y"), (3, None, None, None)]
    assert run(spark, rows) == plain(rows) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_perfect_hash():
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choice("abcdef") for _ in range(rnd.randrange(1, 9))).encode() for _ in range(3000)})
    for own in (words, words[:1], []):
        sizes, bits, ordered = D.build(own)
        shard = D.Shard(sizes, bits, b"".join(w + b" " for w in ordered))
        slots = shard.slots(own, D.hashes(own))
        assert sorted(slots.tolist()) == list(range(len(own))) and all(shard.word(s) == w for s, w in zip(slots.tolist(), own))
        other = [w + b"z" for w in words]
        assert (shard.slots(other, D.hashes(other)) == -1).all()


def test_words_that_never_part(monkeypatch):
    """Equal 64-bit hashes meet at every level: such words follow without a bit and are still told apart."""
    monkeypatch.setattr(D, "hashes", lambda words: np.array([7 if w in (b"a", b"b") else 1000 + i for i, w in enumerate(words)], np.uint64))
    sizes, bits, ordered = D.build([b"a", b"b", b"c", b"d"])
    shard = D.Shard(sizes, bits, b"".join(w + b" " for w in ordered))
    words = [b"a", b"b", b"c", b"d"]
    assert sorted(shard.slots(words, D.hashes(words)).tolist()) == [0, 1, 2, 3]


def test_shares_of_large_counts():
    counts = np.array([0, 5, 10 ** 15], np.int64)
    assert D.shares(counts, 10 ** 16, 7, 10 ** 9).tolist() == [1 + 10 ** 9 * (int(c) + 2) // (10 ** 16 + 14) for c in counts]
