"""Byte-pair encoding against the tokenizers library."""

import hashlib
import json
import random
import sys

import numpy as np
import pytest

from tallygrove.llm import bpe
from tallygrove.llm.queries import QUERIES
from tests.conftest import SMALL

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as file:
        return bpe.Encoder(file.read())


def differing(texts, encoder, library):
    out = []
    for text, wanted in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = encoder.encode(text)
        if list(ids) != wanted.ids or encoder.decode(ids) != library.decode(wanted.ids, skip_special_tokens=False):
            out.append(text)
    return out


def test_every_code_point(encoder, library):
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 5 == 0)]
    assert differing([f"a{chr(c)}b {chr(c) * 2} x{chr(c)}" for c in points], encoder, library) == []


def test_random_texts(encoder, library):
    rng = random.Random(7)
    marks = "aAbBcC \n\t\x85 'stremdlREVE.,!0129éÉßİΣσςé̈Αῼ한하你好🙂​\x00<|>endoftextstartof"
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 80))) for _ in range(5000)]
    texts += ["<|endoftext|>a<|startoftext|> <|endoftext|><|endoftext|", "", " ", "it's IT'S we'll'd", "͸"]
    assert differing(texts, encoder, library) == []


def test_equal_symbols_by_several_merges(encoder, library):
    """Overlapping candidates leave stale entries in the queue."""
    rng = random.Random(3)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    words += ["".join(rng.choice("thean") for _ in range(30)) for _ in range(3000)]
    assert differing(words, encoder, library) == []


def test_long_texts(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "AT_ONCE", 1000)
    rng = random.Random(5)
    spaced = "".join(rng.choice(["word", "É", "é ", " ", " ", "x" * 3000, "\n"]) for _ in range(3000))
    assert differing([spaced, "ab" * 200_000, "  " * 5000 + "a"], encoder, library) == []


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_WORDS", 50)
    with open(PATH, "rb") as file:
        small = bpe.Encoder(file.read())
    texts = [f"word{i} other{i % 70}s" for i in range(400)] + ["y" * 200]
    assert differing(texts, small, library) == []
    assert len(small) <= 50 and "y" * 200 not in small


def test_rows(spark, library):
    """Nulls, repeated rows, clashing names, no rows; arrays and packed ids; and back."""
    rows = [(1, None), (2, ""), (None, "No id"), (3, "twice"), (3, "twice"), (4, "Long text, " * 30_000), (5, "<|endoftext|>")]
    docs = spark.createDataFrame([(i, t, "x", 1, "d") for i, t in rows], "doc_id long, text string, id string, ids int, decoded string")
    wanted = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    plain, packed = bpe.encode(docs, PATH), bpe.encode(docs, PATH, packed=True)
    assert sorted((str(r.id), r.ids) for r in plain.collect()) == wanted
    assert sorted((str(r.id), np.frombuffer(r.ids, "<u4").tolist()) for r in packed.collect()) == wanted
    assert all(r.n_tokens == len(r.ids) for r in plain.collect())
    for coded in (plain, packed):
        texts = sorted((str(r.id), r.text) for r in bpe.decode(coded, PATH).collect())
        assert texts == sorted((i, library.decode(x, skip_special_tokens=False)) for i, x in wanted)
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    gone = spark.createDataFrame([(1, None)], "id long, ids array<int>")
    assert bpe.decode(gone, PATH).first().text == ""


def test_other_files_are_an_error(tmp_path):
    with open(PATH) as file:
        spec = json.load(file)
    spec["model"]["unk_token"] = "<unk>"
    with pytest.raises(ValueError, match="steps"):
        bpe.Encoder(json.dumps(spec).encode())


def test_query_against_the_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op13_bpe"](spark, SMALL).collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
