import random
import re
from hashlib import sha256

import numpy as np

from tickflow.llm import queries, secrets

SF = "/root/testdata/sf0.001"


def _brute(text):
    """The base kinds as the contract words them: whole matches, then the length test."""
    kinds = [
        (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ]
    found = [(m.start(), k, m.end()) for k, (p, good) in enumerate(kinds) for m in re.finditer(p, text, re.A) if good(m)]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.QUERIES["op6_secrets"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = _brute(texts[r.doc_id] or "")
        assert r.base_sha256 == sha256(base.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(base.count(k) for k in ("assign", "access", "hex"))
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_base_edges():
    for text in [
        "secret=token = abcdefgh", "PASSWORD: 'abc123-x' Api_Key=\"zzzzzz", "toKen=abcdefg ſecret=abcdefg", "é token:abcde token:abcdef",
        "AKIAAKIA12345678 AKIA" + "Z9" * 8, "f" * 23 + " " + "0" * 24 + "g" + "a1" * 30, "x" + "deadbeef" * 4, "apikey = =======", "",
    ]:
        assert secrets.listed(secrets.base_spans(text)) == _brute(text), text


def test_models_tell_held_out_strings_apart():
    chance = random.Random(2)
    syllables = ["get", "user", "name", "list", "of", "items", "set", "value", "count", "max", "config", "path", "is", "valid", "http", "client"]
    ordinary = ["_".join(chance.choices(syllables, k=4)) for _ in range(900)]
    random_ = ["".join(chance.choices(secrets.ALPHABET[:62], k=chance.randrange(16, 40))) for _ in range(900)]
    models = secrets.Models.of(secrets.pairs(random_[:600]), secrets.pairs(ordinary[:600]))
    assert sum(models.score(w) >= secrets.MARGIN for w in random_[600:]) > 290
    assert sum(models.score(w) >= secrets.MARGIN for w in ordinary[600:]) < 5


def _planted():
    """Texts with ordinary names and base secrets to learn from, and others with secrets that no base pattern finds."""
    chance = random.Random(4)
    syllables = ["get", "user", "name", "list", "items", "set", "value", "count", "config", "path", "valid", "http", "client", "download", "archive"]
    name = lambda n: "_".join(chance.choices(syllables, k=n))
    key = lambda n: "".join(chance.choices(secrets.ALPHABET[:62], k=n))
    texts = [" ".join(name(4) for _ in range(40)) + f' token = "{key(30)}" in https://{name(1)}.org/{name(3)}/{name(2)}' for _ in range(150)]
    planted = {}
    for i, form in enumerate(["see https://h.net/{a}/{b}?sig={k}&x=1 now", '{a}_credential: "{k}" end', "{a}/{b}/{k}/{a} end", "token=abcdef1 {a}={k}", "password=hunter22{b}"] * 6):
        k = key(28)
        planted[1000 + i] = (form.format(a=name(2), b=name(2), k=k), k if "{k}" in form else None)
    return texts, planted


def test_planted_secrets_that_no_base_pattern_finds(spark):
    texts, planted = _planted()
    docs = spark.createDataFrame([*enumerate(texts), *((i, t) for i, (t, _) in planted.items())], "doc_id long, text string")
    out = {r.doc_id: r.f for r in docs.select("doc_id", secrets.scan(docs, secrets.train(docs)).alias("f")).collect()}
    caught = 0
    for i, (text, k) in planted.items():
        spans = [tuple(map(int, s.split(":")[1:])) for s in out[i].spans.split(",") if s.startswith("markov")]
        if k is None:
            assert not spans
            continue
        at = text.index(k)
        for start, end in spans:  # mostly the secret, and little beside it
            common = min(end, at + len(k)) - max(start, at)
            caught += common >= 0.7 * len(k)
            assert common >= 0.5 * len(k) and (end - start) - common <= 6, (text, spans)
    assert caught >= 0.85 * sum(k is not None for _, k in planted.values())
    assert sum("markov" in out[i].spans for i in range(len(texts))) <= 2


def test_stretches_of_a_run():
    ratio = np.full((secrets._SIZE, secrets._SIZE), -1.0)
    upper = secrets.ALPHABET.index("A") + 1
    ratio[:, upper : upper + 26] = 1.0
    models = secrets.Models(ratio)
    low, high = "a" * 5, "X" * 20
    assert models.stretches(low + high + low) == [(5, 25)]
    assert models.stretches(high + "a" * 30 + high) == [(0, 20), (50, 70)]
    assert models.stretches(high + "aa" + high) == [(0, 42)]
    assert models.stretches("X" * 12 + "a" * 30) == [] and models.stretches("a" * 400) == []
    assert models.stretches("") == [] and models.stretches(high) == [(0, 20)]


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, "token=abcdef1", "s"), (2, "", "s"), (3, "k " * 90_000 + "a1" * 20, "s")], "doc_id long, text string, spans string")
    out = docs.select("doc_id", secrets.scan(docs, secrets.train(docs)).alias("f")).select("doc_id", "f.*").collect()
    assert sorted((r.doc_id or 0, r.base) for r in out) == [(0, "assign:0:13"), (1, ""), (2, ""), (2, ""), (3, "hex:180000:180040")]
    assert secrets.train(docs.limit(0)) is None
    assert docs.select(secrets.scan(docs, None).alias("f")).count() == 5
