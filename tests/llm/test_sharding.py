"""Stratified interleaving against a plain sort, and the law its shards keep."""

import hashlib
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ledgerline.llm import sharding as S


def plain(rows, shards, seed="interleave"):
    """(id, text, source) -> sorted (id, size, crc, source, shard, slot)"""
    unit = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:8], 16) / 2 ** 32
    by = defaultdict(list)
    for i, text, source in rows:
        data = (text or "").encode()
        crc = zlib.crc32(data)
        draw = hashlib.md5(f"{seed}:{'' if i is None else i}:{crc}".encode()).digest()
        by[("" if source is None else "=" + source)].append((draw, (i is not None, i or 0), len(data) + 1, crc, i, source))
    order = []
    for stratum, own in by.items():
        for k, (_, _, size, crc, i, source) in enumerate(sorted(own, key=lambda r: r[:4])):
            order.append(((k + unit(f"{seed}:{stratum}")) / len(own), stratum, k, (i, size, crc, source)))
    out, n = [], len(order)
    for place, (_, _, _, row) in enumerate(sorted(order, key=lambda o: o[:3])):
        shard = place * shards // n
        out.append((*row, shard, place - -(-shard * n // shards)))
    return sorted(out, key=repr)


def run(spark, rows, shards=16, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("shard", F.lit("own")).withColumn("cell", F.lit(1))
    return sorted(map(tuple, S.interleave(df, shards, **more).collect()), key=repr)


def test_against_plain_sort(spark):
    rows = [(i, f"text {i % 50}", f"s{i % 7}" if i % 3 else "hot") for i in range(900)]
    rows += [(None, "x", "hot"), (None, None, None), (None, "", ""), (5, "é😀" * 9000, None), (5, "same", "a"), (5, "same", "a"), (5, "same", "a")]
    rows += [(10_000 + i, "t", f"alone{i}") for i in range(40)]
    for shards in (1, 5, 16):
        assert run(spark, rows, shards) == plain(rows, shards)


def test_shards_have_the_mixture(spark):
    rows = [(i, "t", "hot" if i % 3 == 0 else f"s{i % 5}") for i in range(3000)] + [(-i, "t", f"alone{i}") for i in range(1, 320)]
    got = run(spark, rows)
    sizes = Counter(r[4] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and sorted(sizes) == list(range(16))
    for shard in range(16):
        assert sorted(r[5] for r in got if r[4] == shard) == list(range(sizes[shard]))
    whole = Counter(r[3] for r in got)
    for source, n in whole.items():
        if n > 100:
            for shard in range(16):
                assert abs(sum(r[4] == shard and r[3] == source for r in got) - n / 16) < 8, (source, shard)
    alone = Counter(r[4] for r in got if r[3].startswith("alone"))
    assert max(alone.values()) < 40  # sources of one row are spread, too


def test_few_or_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, None)]) == [(1, 1, 0, None, 0, 0)]
    assert sorted(r[4] for r in run(spark, [(i, "t", "s") for i in range(5)])) == [k * 16 // 5 for k in range(5)]


def test_bounds_do_not_change_the_result(spark, monkeypatch):
    rows = [(i, f"t{i % 9}", f"s{i % 4}") for i in range(300)]
    want = run(spark, rows)
    monkeypatch.setattr(S, "SMALL_SOURCES", 0)
    monkeypatch.setattr(S, "MAX_CELLS", 3)
    assert run(spark, rows) == want
    assert run(spark, rows, seed="other") != want


def test_written_shards(spark, tmp_dir):
    rows = [(i, f"text {i}", f"s{i % 3}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    S.write_shards(S.interleave(df, 4, carry=["text"]), f"{tmp_dir}/shards", file_rows=10)
    back = spark.read.parquet(f"{tmp_dir}/shards").select("doc_id", "text", "shard", "slot").collect()
    assert sorted((r.doc_id, r.text) for r in back) == [(i, f"text {i}") for i in range(100)]
    assert {r.shard for r in back} == {0, 1, 2, 3} and len(back) == 100
