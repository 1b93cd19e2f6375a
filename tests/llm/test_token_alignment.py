"""Alignment of two tokenizations against a brute-force version on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from corpus_rows import ROWS, SF
from tokenizers import Tokenizer

from aerolake.llm import queries, token_alignment
from aerolake.llm.byte_bpe import byte_characters
from aerolake.llm.queries import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Tokens of a text as (id, bytes) lists, from the libraries on the whole text."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte = {ch: i for i, ch in enumerate(byte_characters())}

    def tokens(text):
        if not text:
            return [], []
        left = [(i, bytes(byte[ch] for ch in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                 for i in b.encode(text)]
        want = (" " + text).encode()
        return (left, right) if b"".join(t for _, t in left) == want == b"".join(t for _, t in right) else ([], [])

    return tokens


def brute(plain, texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each text."""
    rows, count = [], Counter()
    for text in texts:
        left, right = plain(text)
        spans = []
        for side in (left, right):
            end, spans_of = 0, []
            for i, raw in side:
                end += len(raw)
                spans_of.append((i, end))
            spans.append(spans_of)
        links = [(i, j) for (i, e) in spans[0] for (j, f) in () or [x for x in spans[1] if x[1] == e]] \
            if len(spans[0]) < 300 else [(i, d[e]) for d in [{f: j for j, f in spans[1]}] for i, e in spans[0] if e in d]
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, start = [], 0
        where = [0, 0]
        for cut in cuts:
            sides = []
            for s in (0, 1):
                ids = []
                while where[s] < len(spans[s]) and spans[s][where[s]][1] <= cut:
                    ids.append(str(spans[s][where[s]][0]))
                    where[s] += 1
                sides.append(",".join(ids))
            groups.append("|".join(sides))
            start = cut
        count.update(links)
        rows.append((len(left), len(right), len(groups), links, ";".join(groups)))
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(na, nb, ng, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(text.encode()).hexdigest() if na else "") for na, nb, ng, links, text in rows]


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_random_texts(spark, plain):
    rng = random.Random(3)
    atoms = ["the", " word", " a", "ing", "日本", "é", "é", "😀", "<|endoftext|>", "<s>", "<0x41>", "  ", "\n", "\t", "'s", "12", "\x00",
             "\x1c", "\x85", " ", "ﬁ", " Zeit", "ñ", "xx", "."]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["a ▁ b c d", "▁"]
    aligner = token_alignment.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert any(len(part) > 3 for t in texts for part in aligner.parts(t))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r[f] for f in FIELDS) for r in token_alignment.link_statistics(frame, A, B).collect()}
    assert [got[k] for k in range(len(texts))] == brute(plain, texts)


def test_parts_and_forgetting_change_nothing(plain, monkeypatch):
    """Long texts in parts, and a table of units that starts anew, give the tokens of the whole text."""
    monkeypatch.setattr(token_alignment, "BATCH_CHARS", 50)
    monkeypatch.setattr(token_alignment, "REMEMBERED", 100)
    aligner = token_alignment.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    texts = ["", " ".join(f"word{i % 17}, más of it\u0085 (x) y  z" for i in range(300)), "x"]
    got = [[[], []] for _ in texts]
    turns = 0
    for rows, parts in token_alignment._aligned(aligner, texts):
        for k, part in zip(rows, parts):
            turns += 1
            for side, column in enumerate("ab"):
                got[k][side] += aligner.gather(column, np.array(part))[0].tolist()
    assert turns > 100
    assert got == [[[i for i, _ in side] for side in plain(t)] for t in texts]


def test_edge_rows(spark, docs, none, plain):
    got = token_alignment.link_statistics(docs, A, B).collect()
    want = brute(plain, [t for _, t, _ in ROWS])
    assert sorted((r.doc_id or 0, *[r[f] for f in FIELDS]) for r in got) == \
        sorted((d or 0, *w) for (d, _, _), w in zip(ROWS, want))
    assert token_alignment.link_statistics(none, A, B).count() == 0


def test_real_outputs(docs, plain):
    for r in token_alignment.align(docs, A, B, keep=("doc_id", "text")).collect():
        left, right = plain(r.text)
        assert [i for i, _ in left] == list(r.a_ids) and [i for i, _ in right] == list(r.b_ids)
        a_end, b_end, total = {0: 0}, {0: 0}, 0
        for table, side in ((a_end, left), (b_end, right)):
            total = 0
            for k, (_, raw) in enumerate(side):
                total += len(raw)
                table[k + 1] = total
        assert [a_end[k] for k in r.cut_a] == [b_end[k] for k in r.cut_b] == \
            sorted(set(a_end.values()) & set(b_end.values()) - {0})


def test_linkable_pairs_are_few():
    """The table of counts is bounded by the vocabularies."""
    aligner = token_alignment.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert len(aligner.keys) < 500_000


def test_query(spark, plain):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: tuple(r[f] for f in FIELDS) for r in queries.op11_token_alignment(spark, SF).collect()}
    assert got == dict(zip(texts, brute(plain, texts.values())))
