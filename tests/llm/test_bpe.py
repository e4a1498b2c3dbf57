import hashlib

import numpy as np
import pytest
from rows import EDGE, by_id, edge, empty
from tokenizers import Tokenizer

from tickloom.llm import bpe
from tickloom.llm.queries import VOCABULARY, load, op3_bpe

ODD = [
    "<|endoftext|> and <|endoftext|><|endoftext|>x",
    "a" * 700,
    "=-" * 300,
    "don't I'LL we've\n\n\t x  ",
    "\x00\x01 ٣٤٥ ｆｕｌｌ 👨‍👩‍👧 é",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(back)


def test_edge_rows_equal_the_library(spark, library):
    got = by_id(bpe.digests(edge(spark), VOCABULARY), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(((r[0], *expected(library, r[1])) for r in EDGE), key=str)


def test_query_equals_the_library(spark, sf_dir, library):
    got = by_id(op3_bpe(spark, sf_dir), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    rows = load(spark, sf_dir, "documents").collect()
    assert got == sorted(((r["doc_id"], *expected(library, r["text"])) for r in rows), key=str)


def test_odd_texts_and_round_trip(library):
    encoder = bpe.Encoder(bpe.Vocabulary(VOCABULARY))
    pieces = encoder.encode(ODD)
    found = [np.frombuffer(b"".join(map(encoder.known.get, words)), "<i4").tolist() for words in pieces]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in ODD]
    table = encoder.vocabulary.bytes
    assert [b"".join(table[i] for i in ids).decode() for ids in found] == ODD


def test_encode_and_decode_are_operators_of_their_own(spark, library):
    rows = bpe.decode(bpe.encode(edge(spark), VOCABULARY), VOCABULARY).collect()
    got = sorted(((r["doc_id"], r["ids"], r["text"]) for r in rows), key=str)
    ids = lambda t: library.encode(t or "", add_special_tokens=False).ids
    assert got == sorted(((r[0], ids(r[1]), r[1] or "") for r in EDGE), key=str)


def test_starting_anew_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 1_000)
    encoder = bpe.Encoder(bpe.Vocabulary(VOCABULARY), bpe._decimals)
    for text in ODD * 2:
        (words,) = encoder.encode([text])
        ids = library.encode(text, add_special_tokens=False).ids
        assert b",".join(map(encoder.known.get, words)).decode() == ",".join(map(str, ids))
        assert "".join(words) == text and not encoder.odd
    assert encoder.size < 10_000


def test_shared_prefixes_do_not_change_results():
    vocabulary = bpe.Vocabulary(VOCABULARY)
    words = {b" inter", b" international", b" internationally", b" internet", b" in", b"", b" into"}
    together = vocabulary.encode_words(words)
    assert together == {w: vocabulary.encode_words({w})[w] for w in words}


def test_empty_table(spark):
    assert bpe.digests(empty(spark), VOCABULARY).collect() == []
