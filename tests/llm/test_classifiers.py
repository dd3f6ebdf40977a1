"""Classifiers: held-out accuracy on the tables, defined results for odd rows, repeatable fits."""

import numpy as np
import pytest

from ledgerline.llm import langid, nbsvm, toxicity
from ledgerline.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"


def auc(y, s):
    y, s = np.array(y), np.array(s)
    rank = np.argsort(np.argsort(s, kind="stable"))
    n1, n0 = y.sum(), (1 - y).sum()
    return (rank[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * n0)


def test_language_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op10_language_id"](spark, SF).collect()
    assert {r.doc_id for r in got} == set(docs)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) >= 0.98
    assert np.mean([r.rejected for r in got]) <= 0.01
    assert all(0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize("name, label, least, sf", [("op5_quality_classifier", "quality", 0.97, SF),
                                                    # few toxic texts at the small size: some 30 to learn from
                                                    ("op2_toxicity", "toxic", 0.93, "/root/testdata/sf0.1")])
def test_labels_held_out_auc(spark, name, label, least, sf):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES[name](spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert auc([labels[r.doc_id] for r in held], [r.score for r in held]) >= least
    assert all(0 <= r.score <= 1 for r in got)


ODD = [None, "", "   ", "123 456 ²", "!!! ???", "the of and", "x" * 100_000, "word " * 60_000]


def test_odd_rows(spark):
    df = spark.createDataFrame([(i if i else None, t, i) for i, t in enumerate(ODD)] + [(5, "the of and", 1)], "doc_id long, text string, score int")
    sample = [("the of and to in is " * 5 + str(k), "en") for k in range(20)] + [("der die das und ist nicht " * 5 + str(k), "de") for k in range(20)]
    out = langid.predict(df, langid.fit(sample)).collect()
    assert len(out) == len(ODD) + 1
    by = {r.doc_id: r for r in out}
    assert [by[i or None].lang_pred for i in range(5)] == ["und"] * 5 and by[4].score == 0 and by[4].rejected
    assert by[5].lang_pred == "en"
    kept = langid.accepted(df, langid.fit(sample))
    assert kept.columns == df.columns and all(r.text not in ODD[:5] for r in kept.collect())
    y = [("good plain words here", 1), ("junk ### $$$ %%%", 0)] * 30
    for model, predict in ((nbsvm.fit(y), nbsvm.predict), (toxicity.fit(y, epochs=1), toxicity.predict)):
        out = predict(df, model).collect()
        assert len(out) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in out)


def test_fits_without_data_or_with_one_class(spark):
    df = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert langid.predict(df, langid.fit([])).first().lang_pred == "und"
    assert langid.predict(df, langid.fit([("text", "en")])).first().lang_pred == "en"
    for m in (nbsvm, toxicity):
        assert 0 <= m.predict(df, m.fit([])).first().score <= 1
        assert m.predict(df, m.fit([("a", 1), ("b", 1)])).first().score > 0.5 or m is toxicity
        assert m.predict(none, m.fit([])).count() == 0


def test_fits_are_repeatable():
    y = [(f"good plain words here {k}", 1) for k in range(20)] + [(f"junk ### $$$ %%% {k}", 0) for k in range(20)]
    texts = [b"good words", b"### junk"]
    assert nbsvm.score_block(nbsvm.fit(y), texts).tolist() == nbsvm.score_block(nbsvm.fit(y), texts).tolist()
    assert toxicity.score_block(toxicity.fit(y, epochs=1), texts).tolist() == toxicity.score_block(toxicity.fit(y, epochs=1), texts).tolist()


def test_gradients():
    """The network's gradients against differences of its loss."""
    rng = np.random.default_rng(0)
    hid = 3
    p = {"w_o": rng.normal(size=2 * hid), "b_o": rng.normal(size=1), "v_a": rng.normal(size=2), "w_a": rng.normal(size=(2 * hid, 2)), "b_a": rng.normal(size=2)}
    for d in "fb":
        p["u_" + d], p["c_" + d] = rng.normal(size=(hid, 3 * hid)), rng.normal(size=hid)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    x = [rng.normal(size=(5, 4, 3 * hid)).astype(np.float32) for _ in "fb"]
    mask = np.arange(5)[:, None] < np.array([5, 3, 4, 1])[None]
    y = np.array([1, 0, 1, 0], np.float32)

    def loss():
        z = toxicity._forward(p, *x, mask)[0].astype(float)
        return (np.logaddexp(0, z) - y * z).mean()

    _, g, *_ = toxicity._gradients(p, *x, mask, y, np.ones(4, np.float32))
    for k in g:
        at = tuple(s // 2 for s in p[k].shape)
        was = p[k][at]
        p[k][at] = was + np.float32(1e-2)
        up = loss()
        p[k][at] = was - np.float32(1e-2)
        down = loss()
        p[k][at] = was
        assert abs((up - down) / 2e-2 - g[k][at]) < 2e-3, k
