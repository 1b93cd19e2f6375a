"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from corpus_rows import ROWS, SF

from aerolake.llm import queries, spelling_variants


def distance_is_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1] == 1


def brute_words(rows):
    total = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def brute(words):
    """Rows by comparing each word with every word that agrees with it after at most one deletion on either side."""
    holds = defaultdict(set)
    for w in words:
        for v in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            holds[v].add(w)
    near = defaultdict(set)
    for group in holds.values():
        for a in group:
            near[a].update(b for b in group if b != a and distance_is_one(a, b))
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def rows_of(frame):
    rows = frame.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len({r.word for r in rows})
    return {tuple(r) for r in rows}


def vocabulary(rng, n, letters="abé"):
    words = {}
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(7, 11)))
        words[w] = rng.choice([2, 3, 20, 30, 200, 2000, 30000])
    return words


def test_random_vocabulary(spark):
    """Dense words with ties and long chains; blocks that are halved down to single places give the same pairs."""
    words = vocabulary(random.Random(2), 600)
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    want = brute(words)
    assert rows_of(spelling_variants.group_variants(frame)) == want
    assert rows_of(spelling_variants.group_variants(frame, limit=4)) == want
    assert any(root != form and form for _, form, root, *_ in want)
    pairs = spelling_variants.near_pairs(frame, limit=4).collect()
    assert len(pairs) == len({(r.word, r.near) for r in pairs}) == sum(r[4] for r in want)


def test_words_of_any_length(spark):
    words = ["a", "b", "ab", "ba", "abc", "bc", "c", "x" * 300, "x" * 301, "x" * 150 + "y" + "x" * 149, "x" * 299 + "y", "y" + "x" * 300]
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    got = {(r.word, r.near) for r in spelling_variants.near_pairs(frame).collect()}
    assert got == {(a, b) for a in words for b in words if distance_is_one(a, b)}


def test_scan_is_exact_and_skips():
    rng = random.Random(4)
    for _ in range(60):
        groups = [sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 14))})
                  for _ in range(3)]
        words = [w for g in groups for w in g]
        block = np.repeat(np.arange(3), [len(g) for g in groups])
        code = np.full((len(words), 5), -1, np.int32)
        for k, w in enumerate(words):
            code[k, :len(w)] = [ord(c) for c in w]
        a, b = spelling_variants.scan(block, code, np.array([len(w) for w in words]))
        assert sorted(zip(a.tolist(), b.tolist())) == [
            (i, j) for i in range(len(words)) for j in range(i + 1, len(words))
            if block[i] == block[j] and distance_is_one(words[i], words[j])]


def test_batches_end_between_blocks(spark, monkeypatch):
    words = vocabulary(random.Random(8), 300)
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(2)
    want = {(r.word, r.near, r.near_n) for r in spelling_variants.near_pairs(frame).collect()}
    monkeypatch.setattr(spelling_variants, "BATCH_ROWS", 9)
    assert {tuple(r) for r in spelling_variants.near_pairs(frame).collect()} == want
    table = spelling_variants.blocks(frame, 4).select("key", "mid", "word", "n", "m", "x", "y").orderBy("key", "mid").toArrow()
    monkeypatch.setattr(spelling_variants, "CELLS", 50)
    got = spelling_variants._pairs(table).to_pylist()
    assert {(r["word"], r["near"], r["near_n"]) for r in got} == want and len(got) == len(want)


def test_edge_rows(spark, docs, none):
    """Null, empty and long texts, a null key, repeated rows and clashing names."""
    assert rows_of(spelling_variants.spelling_variants(docs)) == brute(brute_words([(d, t) for d, t, _ in ROWS]))
    empty = spelling_variants.spelling_variants(none)
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.count() == 0


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute(brute_words([tuple(r) for r in rows]))
    got = rows_of(queries.op12_spelling_variants(spark, SF))
    assert got == want and sum(r[1] is not None for r in want) >= 5
