"""Quality rules: base counts against plain Python, distances against numpy."""

import re
from collections import Counter

import numpy as np

from ledgerline.llm import quality_rules as Q

SPLIT = re.compile("[ \t\n\x0b\x0c\r]+")


def counts(t):
    t = t or ""
    w = [x for x in SPLIT.split(t) if x]
    lines = [x for x in t.split("\n") if SPLIT.sub("", x)]
    grams = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    again = {p for k in range(len(w) - 4) if grams[tuple(w[k:k + 5])] > 1 for p in range(k, k + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again)


TEXTS = [None, "", "   \n ", "one", "a b c d e", "a b c d e a b c d e", "x " * 40, "a b c d e f " * 3 + "end", "l\nl\n\n \nl\nm", "# $ % | <b> && *",
         "ñandú 漢字 🙂 a\u00a0b\x0bc\x0cd", "the quick and the dead " * 30, "word " * 70_000]


def test_base_counts(spark):
    df = spark.createDataFrame([(i, t, "en", 0) for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, words int")
    got = {r.doc_id: r for r in Q.judge(df).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(t), i
        n, rep = r.n_words, r.n_repeat_words
        assert r.base_failed == (n < 10 or 100 * rep > 20 * n)
        assert not (r.base_failed and r.kept)


def test_distances(spark):
    rows = [(i, r.text, r.lang) for i, r in enumerate(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect())]
    rows += [(900, rows[0][1], None), (901, rows[1][1], "zz"), (None, rows[2][1], "en"), (902, rows[2][1], "en"), (902, rows[2][1], "en")]
    got = Q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(rows)

    def chars(t):
        out = []
        for _, p in Q.CHAR_CLASSES:
            left = re.sub(p, "", t)
            out.append(len(t) - len(left))
            t = left
        return np.array(out + [len(t)], float)

    def common(t, lang):
        w = [x for x in SPLIT.split(t) if x]
        own = [sum(x in (c, c.capitalize()) for x in w) for c in Q.COMMON_WORDS[lang]]
        return np.array(own + [len(w) - sum(own)], float)

    def js(p, q):
        p, q = p / p.sum(), q / q.sum()
        m = (p + q) / 2
        f = lambda a: np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0).sum()
        return np.sqrt(max(0, (f(p) + f(q)) / 2))

    total = {k: sum(chars(t) for _, t, lang in rows if lang == k) for k in Q.COMMON_WORDS}
    total[""] = sum(chars(t) for _, t, _ in rows)
    words = {k: sum(common(t, k) for _, t, lang in rows if lang == k) for k in Q.COMMON_WORDS}
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    for i, t, lang in rows:
        if i is None:
            continue
        k = lang if lang in Q.COMMON_WORDS else ""
        assert abs(by[i].char_distance - js(chars(t), total[k])) < 1e-9
        if k:
            assert abs(by[i].word_distance - js(common(t, k), words[k])) < 1e-9


def test_plan_has_no_python_and_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    out = Q.judge(df)
    assert out.count() == 0
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


def test_clean_documents_are_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = Q.judge(docs).join(labels, "doc_id").where("n_words >= 10").groupBy("quality").agg({"*": "count", "kept": "count"})
    rows = Q.judge(docs).join(labels, "doc_id").where("n_words >= 10").select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    assert sum(good) >= 0.97 * len(good)
    assert got is not None
