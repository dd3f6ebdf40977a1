"""The pipeline's stages, each against brute force on what the stage before it kept."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from ledgerline.llm import decontam

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        stage(spark, out[-1], SF).write.parquet(f"{root}/{name}")
        out.append(spark.read.parquet(f"{root}/{name}"))
    return out


def test_stages_and_columns(steps):
    assert [n for n, _ in C.STAGES] == ["language_id", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "byte_bpe"]
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes
    counts = [df.count() for df in steps]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]


def test_language_keeps_texts_with_words(steps):
    before = {r.doc_id: r for r in steps[0].collect()}
    after = {r.doc_id: r for r in steps[1].collect()}
    assert all(after[i] == before[i] for i in after)
    assert len(after) >= 0.97 * len(before)


def test_one_of_each_group_stays(steps):
    from test_simhash import groups, slow_print
    rows = steps[1].collect()
    want = set(groups([r.doc_id for r in rows], [slow_print(r.text) for r in rows]))
    assert {r.doc_id for r in steps[2].collect()} == want


def test_passages_stay_once(steps):
    before = {r.doc_id: r for r in steps[2].collect()}
    after = {r.doc_id: r for r in steps[3].collect()}
    least = {}
    for i in sorted(before):
        w = before[i].text.lower().split()
        for p in range(len(w) - 49):
            least.setdefault(tuple(w[p:p + 50]), i)
    repeats = {i for i in before for w in [before[i].text.lower().split()] for p in range(len(w) - 49) if least[tuple(w[p:p + 50])] < i}
    for i, r in after.items():
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (before[i].lang, before[i].source)
        if i not in repeats and r.text != before[i].text:      # near-duplicates only
            assert len(r.text.split()) <= len(before[i].text.split()) - 50
    assert all(i not in after or after[i].text != before[i].text for i in repeats)
    assert set(before) - set(after) <= repeats | {i for i in before if i not in after}


def test_contaminated_documents_go(spark, steps):
    from test_decontam import brute
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in steps[3].collect()]
    bad = {r[0] for r in brute(rows, items) if r[-1]}
    assert {r.doc_id for r in steps[4].collect()} == {i for i, _ in rows} - bad
    assert decontam.contamination(steps[4], spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").count() == 0


def test_token_ids(steps):
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers as P
    from ledgerline.llm import bpe
    v = bpe.load_vocabulary(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(v.tokens)}, special_tokens={})
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    rows = steps[5].collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        ids = b"".join(x.to_bytes(4, "little") for x in enc.encode_ordinary(texts[r.doc_id]))
        assert bytes(r.ids) == ids and r.n_tokens == len(ids) // 4
        assert r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark):
    """NULLs in every column, repeated rows, unnamed rows and clashing extra columns pass every stage."""
    prose = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(30).collect()]
    rows = [(i, t, "en", None, len(t), i, "x") for i, t in enumerate(prose)]
    rows += [(3, prose[3], "en", "s", 1, 0, None), (None, prose[4], None, None, None, None, None), (None, "the of and in a word of its own", "en", "s", 9, 9, "y"),
             (None, "the of and in a word of its own", "en", "s", 9, 9, "y"), (90, None, "en", "s", 0, 0, ""), (91, "", None, "s", 0, 0, ""),
             (92, "!!!", "en", "s", 3, 0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, bits long, c0 string")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    left = docs.collect()
    assert sum(r.doc_id == 3 for r in left) <= 1
    assert sum(r.doc_id is None and r.text.startswith("the of and") for r in left) == 1
    assert not {90, 91, 92} & {r.doc_id for r in left}
    assert C.STAGES[-1][1](spark, docs, SF).count() == len(left)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False))
    for _, stage in C.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_rows_that_share_an_id(spark):
    """Rows of one id with different texts belong to different groups: each group keeps one document."""
    words = [f"w{i}" for i in range(400)]
    x, y = " ".join(words[:200]), " ".join(words[200:])
    near = y + " w199"
    rows = [(5, x), (5, y), (8, near), (9, x), (None, y), (None, "lone " * 3 + "text"), (None, "lone " * 3 + "text"), (5, x)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__first", F.lit("a")).withColumn("text_hash", F.lit(1))
    got = C.simhash_near_dedup(spark, docs, SF)
    assert got.dtypes == docs.dtypes
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted([(5, x), (5, y), (None, "lone lone lone text")], key=str)


def test_long_texts_are_fitted_by_windows(spark, monkeypatch):
    from ledgerline.llm import samples
    monkeypatch.setattr(samples, "FIT_CHARS", 200)
    long = "".join(f"{i:04d} " for i in range(2000))
    docs = spark.createDataFrame([(1, long, "a"), (2, "short", "a"), (3, "", "a"), (4, None, "a"), (5, "x", None)], "doc_id long, text string, lang string")
    got = dict((y, sorted(t for t, _ in samples.by_column(docs, F.col("lang"), F.lit(True), 10) if len(t) > 5)) for y in ("a",))["a"]
    assert len(got) == 1 and len(got[0]) == 200 + samples.FIT_WINDOWS - 1
    places = [long.index(part) for part in (got[0][k * 11:k * 11 + 10] for k in range(samples.FIT_WINDOWS))]
    assert places == sorted(places) and places[-1] > 9000 and places[0] < 500      # from all over the text
    assert len(samples.by_column(docs, F.col("lang"), F.lit(True), 10)) == 2


def test_encoding_and_decoding_do_not_run_in_one_task(spark):
    """A task holds one Python worker: the ids are stored before they are decoded, and all rows are there."""
    docs = spark.createDataFrame([(1, "some text"), (None, "some text"), (2, None), (2, "")], "doc_id long, text string")
    out = C.byte_bpe(spark, docs, "")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    got = [(r.doc_id, r.n_tokens > 0) for r in out.collect()]
    assert sorted(got, key=str) == [(1, True), (2, False), (2, False), (None, True)]
