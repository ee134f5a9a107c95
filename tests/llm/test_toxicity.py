from tickflow.llm import queries, toxicity

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = queries.QUERIES["op10_toxicity"](spark, SF).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert right / len(rows) >= 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark):
    docs = spark.createDataFrame(
        [(i, ("you awful rotten thing" if i % 2 else "a kind and gentle day") + f" number {i}", "s") for i in range(60)] + [(100, None, "s"), (101, "", "s"), (None, "x", "s"), (100, None, "s")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    scored = docs.select("doc_id", "text", toxicity.toxicity(docs, model).alias("p")).collect()
    assert len(scored) == 64
    assert all((r["p"] > 0.5) == (r["doc_id"] % 2 == 1) for r in scored if r["doc_id"] is not None and r["doc_id"] < 60)
    assert toxicity.train(docs, labels.filter("toxic = 1")) is None
    assert toxicity.train(docs.limit(0), labels) is None
    assert docs.select(toxicity.toxicity(docs, None).alias("p")).distinct().collect() == [(0.0,)]


def test_ngrams_of_long_texts_do_not_depend_on_pieces():
    text = "abc dé " * 60_000
    assert set(toxicity.ngrams(text)) == set(toxicity.ngrams(text[:700]))
    assert len(toxicity.ngrams("ab")) == 0 and len(toxicity.ngrams(None)) == 0
