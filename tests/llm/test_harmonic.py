"""Harmonic packing against the tokenizers library: every id once, whole sequences, no padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tributary.llm import harmonic, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def corpus():
    r = random.Random(5)
    text = lambda n: " ".join("".join(r.choice("abcdefgh ") for _ in range(6)) for _ in range(n))
    docs = [(d, text(r.randint(0, 900))) for d in range(120)]
    docs += [(7, docs[7][1]), (7, docs[7][1]), (200, None), (201, ""), (202, " \n"), (None, "no id"), (None, None),
             (203, "a <|endoftext|> b"), (204, text(9_000)), (205, "中文 ½ 🙂" * 400)]
    return docs


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, 1, "x", 2) for d, t in corpus()]
    return spark.createDataFrame(rows, "doc_id long, text string, start int, sequence_id string, offset int").repartition(3)


@pytest.fixture(scope="module")
def encoder(spark):
    return packing.broadcast_encoder(spark, PATH)


def test_every_id_lies_in_one_piece_and_sequences_are_full(spark, docs, encoder):
    library = Tokenizer.from_file(PATH)
    want = [(d, np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")) for d, t in corpus()]
    rows = harmonic.pack_documents(docs, encoder).collect()
    # the pieces of the documents, by their content: repeated rows are documents of their own
    pieces = sorted((str(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    expected = []
    for d, ids in want:
        at = 0
        for n in harmonic.cuts(len(ids)):
            expected.append((str(d), at, n, zlib.crc32(ids[at:at + n].tobytes()), len(ids)))
            at += n
        assert at == len(ids)
    assert pieces == sorted(expected)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    short = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and harmonic.padded_length(at) == at
        short += at < 2048
    assert short <= 11 * 3
    assert len(sequences) <= sum(len(i) for _, i in want) // 2048 + 3 * 22


def test_sequences_hold_the_ids_of_the_places(spark, docs, encoder):
    stored = docs.coalesce(1)
    places = {(r.sequence_id, r.offset): r for r in harmonic.pack_documents(stored, encoder).collect()}
    out = {r.sequence_id: r for r in harmonic.packed_sequences(stored, encoder).collect()}
    assert {s for s, _ in places} == set(out)
    for (s, offset), r in places.items():
        assert zlib.crc32(out[s].ids[4 * offset:4 * (offset + r.length)]) == r.ids_crc32
    assert all(r.n_tokens == r.padded == len(r.ids) // 4 for r in out.values())


@pytest.mark.parametrize("n", [1, 2, 3, 1023, 1024, 1025, 2047, 2048, 2049, 4095, 10_000])
def test_cuts_are_class_tops(n):
    parts = harmonic.cuts(n)
    assert sum(parts) == n and all((2048 // p) * p == 2048 for p in parts)
    assert parts == sorted(parts, reverse=True)


def test_rests_of_a_task_are_powers_of_two():
    r = random.Random(3)
    for _ in range(50):
        classes, total, done = harmonic.Classes(64), 0, []
        for _ in range(r.randint(0, 300)):
            n = 1 << r.randint(0, 6)
            total += n
            full = classes.add(n, None)
            if full:
                assert sum(x for x, _ in full) == 64
                done.append(64)
        rest = [sum(x for x, _ in s) for s in classes.rest()]
        assert sum(done) + sum(rest) == total
        assert all(harmonic.is_power_of_two(x) and x <= 64 for x in rest)
        assert len([x for x in rest if x < 64]) == len({x for x in rest if x < 64})


def test_empty_table_and_capacity(spark, encoder):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert harmonic.pack_documents(none, encoder).collect() == []
    assert harmonic.packed_sequences(none, encoder).collect() == []
    with pytest.raises(ValueError):
        harmonic.pack_documents(none, encoder, capacity=1000)
