import numpy as np

from tickflow.llm import language, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    langs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.QUERIES["op8_language"](spark, SF).join(langs, "doc_id").filter("held_out").collect()
    assert len(rows) > 250
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_gradients_and_lookup():
    net = language.Network.fresh(["a", "b"])
    rows = np.random.default_rng(0).integers(0, 256, (6, language.WINDOW)).astype(np.uint8)
    target = np.array([0, 1, 0, 1, 1, 0])
    assert np.allclose(net.pooled(rows)[0], net.largest(rows), atol=1e-4)
    loss = lambda: -np.log(net.chances(net.pooled(rows)[0])[np.arange(6), target]).mean()
    for p, g in zip(net.parameters(), net.step(rows, target)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept = p[at]
        p[at] = kept + 1e-2
        high = loss()
        p[at] = kept - 1e-2
        low = loss()
        p[at] = kept
        assert np.isclose((high - low) / 2e-2, g[at], rtol=0.1, atol=1e-4)


def test_edges(spark):
    words = {"x": "abra kadabra ", "y": "öüß längs "}
    data = [(i, words[k] * 20, k, "z") for i in range(40) for k in ("x" if i % 2 else "y",)]
    data += [(90, None, "x", "z"), (91, "", "y", "z"), (92, "123 456 --", None, "z"), (94, "½ ² ① Ⅷ", None, "z"), (None, "abra kadabra " * 30, None, "z"), (93, words["x"] * 9000, None, "z"), (90, None, "x", "z")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, score string")
    net = language.train(docs)
    out = {r.doc_id: r.f for r in docs.select("doc_id", language.language(docs, net).alias("f")).collect()}
    assert all(out[i].lang == ("x" if i % 2 else "y") for i in range(40))
    assert [out[i].lang for i in (90, 91, 92, 94, None, 93)] == ["und", "und", "und", "und", "x", "x"]
    assert out[90].score == 0
    assert language.train(docs.filter("doc_id < 0")) is None
    assert docs.select(language.language(docs, None).lang.alias("l")).distinct().collect() == [("und",)]
