from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.test_minhash import classes, sets_of
from tickflow.llm import line_dedup, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into and comes out of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("pipeline") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_names_and_columns(stages):
    assert [n for n, _, _ in stages] == ["toxicity", "line dedup", "minhash near-dedup", "mixing", "bpe"]
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_each_decision_takes_effect(spark, stages):
    (_, docs, clean), (_, _, lines), (_, _, single), (_, _, mixed), (_, _, encoded) = stages
    scores = {r.doc_id: r.predicted for r in queries.QUERIES["op10_toxicity"](spark, SF).collect()}
    assert {r.doc_id for r in clean.collect()} == {d for d, p in scores.items() if not p}
    kept = {r.doc_id: r.text for r in lines.collect()}
    assert set(kept) == {r.doc_id for r in clean.collect()}
    places = Counter(line for text in kept.values() for line in {x for _, _, x, t in line_dedup.lines_of(text or "", 4, 3) if len(t) >= 8})
    assert max(places.values()) == 1
    sets = sets_of(kept.items(), 5)
    low = classes(sets, 80)
    assert sorted(r.doc_id for r in single.collect()) == sorted(d for d in sets if low[d] == d)
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= {r.doc_id for r in single.collect()} and max(copies.values()) <= 3
    assert Counter(r.doc_id for r in encoded.collect()) == copies


def test_run_gives_the_rows_of_the_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[-1][2].collect()))


def test_odd_rows_pass_every_stage(spark):
    rows = [(1, None, "en", None, 0), (1, None, "en", None, 0), (None, "some words here", None, "s", 3), (2, "", "en", "s", 0), (3, "one two three\n" * 9, "fr", "t", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = spark.createDataFrame(stage(spark, frame, SF).collect(), frame.schema) if name != "bpe" else stage(spark, frame, SF)
        assert frame.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        frame.count()


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    """Both texts of id 5 stay, once each; id 7 is a copy of one of them and goes by the smaller id; equal rows are one."""
    one, two = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(5, one, "en", "s"), (5, two, "en", "s"), (5, one, "de", "a"), (7, two, "en", "s"), (7, two, "en", "s"), (9, "alone here", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = Counter(tuple(r) for r in corpus_pipeline.minhash_stage(spark, docs, SF).collect())
    # Which of the two texts goes by the id 5 is up to their hashes; the other one loses against id 7 if that is its copy.
    assert kept[(9, "alone here", None, None)] == 1 and sum(kept.values()) == 3
    assert {t for _, t, _, _ in kept} == {one, two, "alone here"}
    assert (5, one, "de", "a") in kept  # the first of two rows that differ in other columns only
