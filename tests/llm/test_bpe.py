import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer as Reference

from tickflow.llm import queries
from tickflow.llm.bpe import Bpe, Tokenizer, decode, newer_letters, pieces_of


@pytest.fixture(scope="module")
def pair():
    path = queries.tokenizer_path()
    with open(path, encoding="utf-8") as file:
        spec = file.read()
    return Bpe(spec, newer_letters(), remembered=500), Reference.from_file(path), pieces_of(spec)


def _same(pair, text):
    ours, reference, pieces = pair
    ids = reference.encode(text, add_special_tokens=False).ids
    assert ours.encode(pa.array([text]))[0].tolist() == ids, repr(text)
    assert decode(pa.array([ids], pa.list_(pa.int32())), pieces).to_pylist() == [reference.decode(ids, skip_special_tokens=False)]


def test_random_texts_encode_as_the_library_does(pair):
    chance = random.Random(5)
    letters = "aeiounrstl 'sdmvtre,.ΣßÉÀ<|>0129ⅷªİﬁ́\x85　\n\t\x1c\x00中𝔘ſ"
    for _ in range(1500):
        _same(pair, "".join(chance.choices(letters, k=chance.randrange(40))))


def test_many_texts_at_once(pair):
    """Words that share a batch, and answers about pairs whose places in the table collide."""
    ours, reference, pieces = pair
    chance = random.Random(6)
    words = ["".join(chance.choices("aeiounrstlmé", k=chance.randint(1, 14))) + chance.choice(["", "", "!!", "'s", "1,2", "\u00a0x", "Ü"]) for _ in range(20_000)]
    texts = [None, *(" ".join(chance.choices(words, k=chance.randrange(60))) for _ in range(700)), "", " a  b\x1cc\t"]
    for some in (texts, texts[:300], texts[200:]):
        made = ours.encode_texts(pa.array(some))
        expected = [reference.encode(t or "", add_special_tokens=False).ids for t in some]
        assert made.to_pylist() == expected
        assert decode(made, pieces).to_pylist() == [reference.decode(ids, skip_special_tokens=False) for ids in expected]


def test_unknown_ids_and_nulls_decode_to_nothing(pair):
    lists = pa.array([[320, 99_999, 321], None, [], [-1, None, 320]], pa.list_(pa.int32()))
    one = pair[1].id_to_token
    assert [x or "" for x in decode(lists, pair[2]).to_pylist()] == [f"{one(320)} {one(321)}", "", "", one(320)]
    assert decode(lists.slice(2), pair[2]).to_pylist() == ["", one(320)]


def test_every_code_point(pair):
    for start in range(0, 0x30000, 64):
        _same(pair, "a" + "b".join(chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000))


@pytest.mark.parametrize("text", ["", " \n", "<|endoftext|>", "x<|startoftext|> y<|ENDOFTEXT|>", "a" * 3000, "don't're 'LL"])
def test_edges(pair, text):
    _same(pair, text)


def test_query_columns_nulls_and_repeats(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "Hello World's", "z"), (3, "Hello World's", "z"), (None, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = sorted(queries.encoded_digests(docs, Tokenizer(spark, queries.tokenizer_path())).collect(), key=str)
    assert len(out) == 5
    assert [r.n_tokens for r in out if r.doc_id in (1, 2)] == [0, 0]
    assert {r.n_tokens for r in out if r.doc_id == 3} == {3}
    assert queries.encoded_digests(docs.limit(0), Tokenizer(spark, queries.tokenizer_path())).count() == 0
