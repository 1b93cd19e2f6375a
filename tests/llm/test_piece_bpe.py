"""Vectorised SentencePiece BPE against the library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from corpus_rows import ROWS, SF

from aerolake.llm import piece_bpe, queries
from aerolake.llm.queries import vocabulary

MODEL = vocabulary("piece_bpe_32k.model")
ATOMS = ["a", "b", "ab", "  ", "   ", "\n", "\t", "é", "é", "▁", "0", "12", "日本", "本", "한", "😀", "\x00", "<s>", "</s>",
         "<0x41>", "<unk>", "the", "ing", "tion", " of", "x" * 9, "ﬁ", "Ｆ", "я", "не", "ll", " " * 17]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def bpe():
    with open(MODEL, "rb") as f:
        return piece_bpe.PieceBPE(f.read())


def ids_of(bpe, texts):
    out = [[] for _ in texts]
    for rows, ids, count in bpe.slices_of(texts):
        for k, some in zip(rows, np.split(ids, np.cumsum(count)[:-1])):
            out[k] += some.tolist()
    return out


def test_ids_and_decoding_equal_the_library(bpe, library):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ATOMS) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x300, 0xD7FF), rng.randint(0xE000, 0x1FFFF)]))
                      for _ in range(40)) for _ in range(200)]
    want = library.encode(texts)
    assert ids_of(bpe, texts) == want
    for ids in want:
        assert bpe.decode([1, *ids, 2]) == library.decode([1, *ids, 2])


def test_one_merge_after_another_and_many_at_once(bpe, library):
    """Runs of blanks (one score for several pieces), repeated letters, long words and texts without a blank."""
    texts = [" " * 3000, "x" * 3000, "ab" * 1500, "日本" * 700, "a " * 700, " a" * 700, "aaaa" * 33 + "b", "12" * 900]
    assert ids_of(bpe, texts) == library.encode(texts)


def test_any_ids_decode_like_the_library(bpe, library):
    rng = random.Random(6)
    some = [0, 1, 2, 3, 60, 198, 200, 229, 230, 231, 259, 290, 300, 29871]
    for _ in range(1500):
        ids = [rng.choice(some) if rng.random() < 0.7 else rng.randrange(32000) for _ in range(rng.randint(0, 8))]
        assert bpe.decode(ids) == library.decode(ids), ids


def test_parts_and_forgetting_change_nothing(bpe, library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "HELD_BYTES", 40)
    monkeypatch.setattr(piece_bpe, "REMEMBERED", 200)
    rng = random.Random(7)
    texts = ["".join(rng.choice(ATOMS) for _ in range(rng.randint(0, 200))) for _ in range(60)]
    assert ids_of(bpe, texts) == library.encode(texts)


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def wanted(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids).encode())


def test_digest_of_edge_rows(docs, none, library):
    """Null, empty, blank, very long and repeated texts, and columns whose names clash."""
    got = piece_bpe.round_trip_digest(docs, MODEL).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == \
        sorted((d or 0, *wanted(library, t)) for d, t, _ in ROWS)
    empty = piece_bpe.round_trip_digest(none, MODEL)
    assert empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and empty.count() == 0


def test_encode_and_decode_frames(docs, library):
    ids = piece_bpe.encode(docs, MODEL, keep=("doc_id", "text"))
    for r in ids.collect():
        assert list(r.ids) == library.encode(r.text or "", add_bos=True, add_eos=True)
    plain = piece_bpe.encode(docs, MODEL, begin=False, end=False, keep=("text",)).collect()
    assert all(list(r.ids) == library.encode(r.text or "") for r in plain)
    back = piece_bpe.decode(ids.withColumnRenamed("text", "was"), MODEL, keep=("was",)).collect()
    assert all(r.text == (r.was or "") for r in back)


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op13_sentencepiece(spark, SF).collect()
    assert len(got) == len(texts)
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == wanted(library, texts[r.doc_id]) for r in got)
