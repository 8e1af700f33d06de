"""Packing: ids against the library, rows against a plain packing, bounds against all packings."""

import itertools
import random
import zlib

import numpy as np
import pytest
from stewardry.llm import packing
from stewardry.llm.queries import tokenizer_file
from stewardry.llm.staging import prepare
from stewardry.llm.texts import mix as texts_mix

ODD = [
    "İstanbul it's IT'S don't <|startoftext|>x <|ENDOFTEXT|> a<|endoftext|>b 12a3b \x1c\x1d q\x0bw \t\r\n",
    "漢字 かな ①② ́ x ́y K Å ǅ ŉ'll 'LL 'Ve x' ﬁne Straße ΑΣ ΣΑΣ  ß́ à̖ q̣̇ 😀x😀",
    "ñandú x_y-z... --- a.b.c e.g., (f) a" + " " * 50 + "b",
    "",
]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))


def test_encoder_gives_the_ids_of_the_library(rows, monkeypatch):
    texts = [t or "" for _, t in rows] + ODD
    expected = [e.ids + [0] for e in library().encode_batch(texts, add_special_tokens=False)]
    own = packing.WordEncoder(tokenizer_file("word_bpe_49k.json"), 0)
    assert [ids.tolist() for ids in own.encode(texts)] == expected
    own.table.most, own.table.small = 50, 10
    assert [own.encode([t])[0].tolist() for t in texts] == expected
    monkeypatch.setattr(packing, "LONG_BYTES", 300)
    assert [ids.tolist() for ids in own.encode(texts)] == expected


def test_pieces_of_one_hash_are_encoded_whole(rows, monkeypatch):
    from stewardry.llm import pieces, token_files

    texts = [t or "" for _, t in rows] + ODD
    monkeypatch.setattr(pieces, "mix", lambda x, seed: x % np.uint64(97) if seed == 12 else texts_mix(x, seed))
    expected = [e.ids + [0] for e in library().encode_batch(texts, add_special_tokens=False)]
    own = packing.WordEncoder(tokenizer_file("word_bpe_49k.json"), 0)
    assert [ids.tolist() for k in range(len(texts)) for ids in own.encode(texts[k : k + 1])] == expected
    other = token_files.Encoder(tokenizer_file(), 2)
    for text in texts:
        ids = np.frombuffer(other.encode([text])[0], other.kind).tolist()
        assert ids == other.library.encode(text, add_special_tokens=False).ids + [2]


def best_fit_one_by_one(lengths, capacity):
    rooms = []
    for size in sorted(lengths, reverse=True):
        fitting = [k for k, r in enumerate(rooms) if r >= size]
        if fitting:
            k = min(fitting, key=lambda k: rooms[k])
            rooms[k] -= size
        else:
            rooms.append(capacity - size)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_best_fit_is_the_plain_one(seed):
    draw = random.Random(seed)
    lengths = np.array([draw.randint(1, draw.choice([5, 30, 60])) for _ in range(300)])
    bins, offsets = packing.best_fit_decreasing(lengths, 60)
    spans = {}
    for length, b, offset in zip(lengths.tolist(), bins.tolist(), offsets.tolist()):
        spans.setdefault(b, []).append((offset, length))
    for pieces in spans.values():
        ends = [0, *itertools.accumulate(length for _, length in sorted(pieces))]
        assert [offset for offset, _ in sorted(pieces)] == ends[:-1] and ends[-1] <= 60
    assert sorted(60 - sum(length for _, length in p) for p in spans.values()) == best_fit_one_by_one(lengths.tolist(), 60)


def fillings(capacity, least=1):
    yield ()
    for size in range(least, capacity + 1):
        for rest in fillings(capacity - size, size):
            yield (size, *rest)


def test_functions_are_dual_feasible():
    for capacity in (7, 12, 17):
        values, below = packing.dual_feasible(capacity)
        for bin_ in fillings(capacity):
            assert (values[:, list(bin_)].sum(axis=1) <= below).all()


def test_bound_of_pieces_that_do_not_pair():
    assert packing.lower_bound(np.array([6]), np.array([10]), 10)[0] == 10
    assert packing.lower_bound(np.array([4]), np.array([10]), 10)[0] == 5
    assert packing.lower_bound(np.array([], int), np.array([], int), 10) == (0, 0.0)


def as_pieces(spark, lengths):
    return prepare(spark).createDataFrame([(k, int(n)) for k, n in enumerate(lengths)], "row long, length long")


def test_partitions_exchange_what_is_not_full(spark):
    draw = random.Random(2)
    pieces = as_pieces(spark, [draw.randint(1, 60) for _ in range(900)])
    packed = packing.pack(pieces, 100, part_pieces=100)
    used, least = packing.certificate(packed, 100)
    alone = sum(packing.best_fit_decreasing(np.array(part), 100)[0].max() + 1 for part in np.array_split([r.length for r in pieces.collect()], 9))
    assert least <= used <= least + 1 and used <= alone
    assert sorted(r.row for r in packed.collect()) == list(range(900))


def test_partitions_that_meet_their_bounds_stay(spark):
    packed = packing.pack(as_pieces(spark, [60] * 300), 100, part_pieces=100)
    assert packing.certificate(packed, 100) == (300, 300)


def test_documents_come_back_whole(spark, documents, rows):
    packed = packing.pack_documents(spark, documents, tokenizer_file("word_bpe_49k.json"), capacity=100, part_pieces=50)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    expected = []
    for (doc_id, _), encoded in zip(rows, library().encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        ids = np.array(encoded.ids + [0], "<u4")
        parts = [ids[at : at + 100] for at in range(0, len(ids), 100)]
        expected += [(doc_id, k, 100 * k, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(parts)]
    got = [tuple(r) for r in packed.collect()]
    assert sorted((r[:5] for r in got), key=repr) == sorted(expected, key=repr)
    places = {}
    for *_, length, _, sequence, offset in got:
        places.setdefault(sequence, []).append((offset, length))
    for pieces in places.values():
        ends = [0, *itertools.accumulate(length for _, length in sorted(pieces))]
        assert [offset for offset, _ in sorted(pieces)] == ends[:-1] and ends[-1] <= 100
    used, least = packing.certificate(packed, 100)
    assert len(places) == used <= least + 1


def test_no_documents(spark, empty):
    assert packing.pack_documents(spark, empty, tokenizer_file("word_bpe_49k.json")).count() == 0
