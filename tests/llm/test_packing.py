import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tickflow.llm import packing, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(queries.tokenizer_path())


def expected_pieces(reference, rows, capacity=2048):
    out = []
    for doc_id, text in rows:
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def check_layout(rows, capacity=2048):
    """Every sequence is gapless from 0 and not too long; returns how many there are."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= capacity
    return len(sequences)


def test_query_packs_every_document(spark, reference):
    rows = queries.QUERIES["op12_packing"](spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == sorted(expected_pieces(reference, docs))
    least = -(-sum(r.length for r in rows) // 2048)
    assert check_layout(rows) <= 1.02 * least + 1


def test_odd_texts(spark, reference):
    chance = random.Random(8)
    letters = "ab é中𝔘<|>\x1c\x1f\x85 \n'sΣİ0"
    rows = [(i, "".join(chance.choices(letters, k=chance.randrange(80)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, " \n"), (None, "no id"), (303, "same"), (303, "same"), (304, "<|endoftext|> x<|startoftext|>"), (305, "lorem ipsum " * 3000)]
    docs = spark.createDataFrame([(*r, 9, "z") for r in rows], "doc_id long, text string, length long, ids string")
    out = packing.pack(packing.pieces(docs, queries.tokenizer_path(), capacity=64), capacity=64).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=key)
    assert got == sorted(expected_pieces(reference, rows, 64), key=key)
    check_layout(out, 64)
    empty = packing.pack(packing.pieces(docs.limit(0), queries.tokenizer_path()))
    assert empty.count() == 0 and "sequence_id" in empty.columns


def test_sequences_hold_the_ids(spark, reference):
    rows = [(i, f"word{i} " * (i % 40)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = packing.packed_sequences(docs, queries.tokenizer_path(), capacity=32, open_bins=4).collect()
    rebuilt = defaultdict(list)
    for r in made:
        assert len(r.ids) == sum(d.length for d in r.documents) <= 32
        for d in r.documents:
            rebuilt[d.doc_id].append((d.piece, r.ids[d.offset : d.offset + d.length]))
    for doc_id, text in rows:
        ids = [i for _, part in sorted(rebuilt[doc_id]) for i in part]
        assert ids == [*reference.encode(text, add_special_tokens=False).ids, 0]


def _brute(lengths, capacity, open_bins):
    """Bounded best fit by looking at every open bin."""
    open_, closed = [], []
    for n in lengths:
        fits = [b for b in open_ if sum(b) + n <= capacity]
        if fits:
            best = max(fits, key=sum)
            best.append(n)
        else:
            if len(open_) == open_bins:
                fullest = max(open_, key=sum)
                closed.append(open_.pop(next(i for i, b in enumerate(open_) if b is fullest)))
            open_.append([n])
        closed += [b for b in open_ if sum(b) == capacity]
        open_ = [b for b in open_ if sum(b) < capacity]
    return sorted(sum(b) for b in closed), sorted(sum(b) for b in open_)


@pytest.mark.parametrize("open_bins", [1, 2, 7, 50])
def test_bins_against_a_scan_of_all_bins(open_bins):
    chance = random.Random(open_bins)
    for _ in range(30):
        lengths = [chance.randint(1, 99) for _ in range(chance.randrange(200))]
        bins, closed = packing.Bins(100, open_bins), []
        for n in lengths:
            if rows := bins.put(n, n):
                closed.append(sum(rows))
            assert bins.n <= open_bins
        # Of bins equally full either may be taken, which changes no fill.
        assert (sorted(closed), sorted(map(sum, bins.rest()))) == _brute(lengths, 100, open_bins)


def test_many_tasks_leave_few_loose_ends(spark):
    """Leftovers meet over several levels: hardly more sequences than the ids need, however many tasks began."""
    pieces = spark.range(3000).selectExpr("id as doc_id", "0 as piece", "0L as start", "1 + pmod(xxhash64(id), 1500) as length", "0L as ids_crc32")
    rows = packing.pack(pieces.repartition(40), fan_in=4, open_bins=64)
    out = rows.collect()
    assert sorted(r.doc_id for r in out) == list(range(3000))
    assert check_layout(out) <= 1.02 * -(-sum(r.length for r in out) // 2048)
    assert packing.fill(rows).first()["sequences"] == len({r.sequence_id for r in out})
