"""Pieces against the sentencepiece library, and round trips."""

import hashlib
import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from ledgerlift.llm import pieces
from ledgerlift.llm.pieces import Lookup, Pieces, round_trip, with_ids, with_text

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = Path(PATH).read_bytes()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return Pieces(MODEL)


def some_text(rnd, library):
    parts = [" ", "  ", "▁", "a", "aa", "0", "12", "\n", "\r\n", "\t", "é", "漢字", "\U0001f600", "\x00", "ﬁ", "�", "<s>", "<0x41>"]
    return "".join(rnd.choice([rnd.choice(parts), library.id_to_piece(rnd.randrange(259, 32000))]) for _ in range(rnd.choice([1, 2, 5, 30]))) * rnd.choice([1, 1, 4])


@pytest.mark.parametrize("seed", range(5))
def test_ids_are_the_librarys(own, library, seed):
    rnd = random.Random(seed)
    texts = [some_text(rnd, library) for _ in range(300)] + [""]
    texts += [t.replace("▁", " ") for t in texts]
    ids = own.encode(texts)
    assert [x.tolist() for x in ids] == library.encode(texts)
    assert own.decode(ids) == library.decode([x.tolist() for x in ids])


@pytest.mark.parametrize("text", ["a" * 5000, " " * 3000, "abcab" * 900, "  \n" * 700, "éé漢" * 900, "thethethe" * 500])
def test_long_texts_without_blanks(own, library, text):
    assert own.encode([text, text + "x"]) [0].tolist() == library.encode(text)
    rnd = random.Random(len(text))
    mixed = "".join(rnd.choice("eastinro") for _ in range(4000))
    assert own.encode([mixed])[0].tolist() == library.encode(mixed)


def test_any_ids_decode_as_in_the_library(own, library):
    rnd = random.Random(3)
    for _ in range(800):
        ids = [rnd.randrange(32000) if rnd.random() < 0.5 else rnd.randrange(262) for _ in range(rnd.randrange(12))]
        assert own.decode([np.array(ids, np.int32)]) == [library.decode(ids)]


def test_lookup_with_many_in_one_slot():
    keys = np.arange(1, 4000, dtype=np.int64) * (1 << 20)
    table = Lookup(keys, np.arange(len(keys)))
    assert (table.of(keys) == np.arange(len(keys))).all()
    assert (table.of(keys + 1) == -1).all()
    assert (Lookup(keys[:0], keys[:0]).of(keys) == -1).all()


def test_unreadable_models():
    with pytest.raises(ValueError):
        Pieces(b"")


def test_tables(spark, library):
    texts = [None, "", " ", "Hello world", "Hello world", "x" * 20000, "é \U0001f600\n\n", "tail "]
    rows = [(i if i % 3 else None, t, "clash", [i]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string, ids array<int>")
    got = with_text(with_ids(docs, MODEL), MODEL).collect()
    assert sorted((r.row.ids[0], r.row.row, r.ids, r.decoded) for r in got) == [
        (i, "clash", library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in enumerate(texts)
    ]
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(docs, MODEL).collect()}
    expected = set()
    for i, t, *_ in rows:
        ids = library.encode(t or "")
        parts = (",".join(map(str, ids)), library.decode(ids))
        expected.add((i, len(ids), *(hashlib.sha256(p.encode()).hexdigest() for p in parts)))
    assert digests == expected
    assert round_trip(docs.limit(0), MODEL).count() == 0
    assert with_ids(docs.select("text"), MODEL).count() == len(texts)


def test_a_process_remembers_a_bounded_number_of_words(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    own = Pieces(MODEL)
    for texts in (["w%d" % i for i in range(40)], ["w%d" % i for i in range(30)] * 2, [" ".join("v%d" % i for i in range(200))], ["y" * 100]):
        assert [x.tolist() for x in own.encode(texts)] == library.encode(texts)
        assert len(own.known) <= 50
        assert max(map(len, own.known), default=0) <= pieces.LONGEST_REMEMBERED


def test_ids_and_texts_in_one_pass(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate([None, "", "Hello world", "x" * 3000, "é \U0001f600\n", "a b"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    both = with_ids(docs, MODEL, back="decoded")
    assert sorted(both.collect()) == sorted(with_text(with_ids(docs, MODEL), MODEL).collect())
    plan = round_trip(docs, MODEL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    with pytest.raises(ValueError):
        with_ids(docs, MODEL, back="ids")
