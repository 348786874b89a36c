import random
from pathlib import Path

import pytest

from tuneprep.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")
pytestmark = pytest.mark.skipif(not Path(pieces.MODEL_FILE).exists(), reason="no model file")
SCHEMA = "doc_id long, text string, piece_ids string, ids int"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def texts(vocabulary):
    rng = random.Random(8)
    words = "the of tion ing über straße niño éléphant Ünï x" * 1
    out = ["", " ", "   ", "a", "\n", "\n\n a\tb", "\x00", "▁x ▁", "<s> </s> <unk> <0x41>", "é", "�"]
    out += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz  ", k=rng.randint(1, 80))) for _ in range(300)]
    out += ["".join(rng.choices("aeinrst", k=rng.randint(1, 40))) for _ in range(500)]
    out += ["".join(rng.choices("ab= \n-_.#/*", k=rng.randint(1, 60))) for _ in range(300)]
    out += ["".join(chr(rng.choice([rng.randrange(32, 600), rng.randrange(0x3000, 0x9FFF), 0x1F600])) for _ in range(30)) for _ in range(200)]
    out += ["".join(rng.choices(words.split(), k=rng.randint(1, 30))) for _ in range(100)]
    whole = [p for p in vocabulary.pieces if not p.startswith("<")]
    out += ["".join(rng.choices(whole, k=rng.randint(2, 6))).replace("▁", " ") for _ in range(2000)]
    return out + ["no" * 3000, "word " * 4000]


def test_ids_are_those_of_the_library(vocabulary, library):
    given = texts(vocabulary)
    got = pieces.Encoder(vocabulary).encode(given)
    want = library.encode(given)
    wrong = [(t, g.tolist(), w) for t, g, w in zip(given, got, want, strict=True) if g.tolist() != w]
    assert not wrong, wrong[:3]


def test_bounds_of_parts_and_of_what_is_kept_change_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(pieces, "_TEXT_CHUNK", 50)
    monkeypatch.setattr(pieces, "_KEPT", 20)
    given = texts(vocabulary)[:900]
    got = pieces.Encoder(vocabulary).encode(given)
    assert [g.tolist() for g in got] == library.encode(given)


def unbroken():
    rng = random.Random(4)
    out = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/", k=n)) for n in (129, 1000, 5000)]
    out += ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(3000)), "x" * 3001, "ab" * 900, "no" * 700 + "\n" + "é" * 999]
    out += ["".join(rng.choices(["the", "tion", "ing", "str", "あ", "\U0001f600", "="], k=2000)), "a b\n" + "y\n" * 400 + "z" * 300]
    return out + ["a " + "\n".join("".join(rng.choices("aeinrst", k=rng.randint(0, 90))) for _ in range(200))]


@pytest.mark.parametrize("block, at_once", [(64, 3), (96, 256)])
def test_texts_without_blanks_in_blocks(vocabulary, library, monkeypatch, block, at_once):
    monkeypatch.setattr(pieces, "_BLOCK", block)
    monkeypatch.setattr(pieces, "_BLOCKS_AT_ONCE", at_once)
    monkeypatch.setattr(pieces, "_TEXT_CHUNK", 2500)
    got = pieces.Encoder(vocabulary).encode(unbroken())
    assert [g.tolist() for g in got] == library.encode(unbroken())


def test_a_long_text_without_blanks(vocabulary, library):
    rng = random.Random(6)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/", k=150_000))
    assert pieces.Encoder(vocabulary).encode([text])[0].tolist() == library.encode(text)


def test_round_trip_and_edge_cases(spark, library):
    rows = [(1, "two  words \n é ①"), (1, "two  words \n é ①"), (2, None), (3, ""), (None, "x" * 20000), (4, "▁")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    out = pieces.encode_documents(df)
    assert out.columns == df.columns
    by = {(r.doc_id, r.text): r.piece_ids for r in out.collect()}
    assert by[2, None] is None and by[3, ""] == []
    for (_, text), ids in by.items():
        assert text is None or ids == library.encode(text)
    again = out.withColumn("again", pieces.Pieces(spark).decode(out["piece_ids"])).collect()
    assert all(r.again == (r.text and r.text.replace("▁", " ")) for r in again)
    assert pieces.encode_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_decoding_is_that_of_the_library(vocabulary, library):
    for text in texts(vocabulary)[:400]:
        ids = library.encode(text)
        assert pieces.decode(ids, vocabulary) == library.decode(ids)
