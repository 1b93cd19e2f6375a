"""Tokenizers, language model, language identification and n-gram join against libraries and brute force."""

import base64
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers as P
from corpus_rows import ROWS, SF, TEXT
from pyspark.sql import functions as F

from aerolake.llm import bloom_lm, byte_bpe, language_id, ngram_join, token_counts

RANKS, MODEL = P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model")


def test_byte_bpe_equals_tiktoken(spark, docs, none):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    want = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [t or "" for _, t, _ in ROWS] + ["<|endoftext|> it's    \x85 ​١٢ ½"]
    bpe = byte_bpe.ByteBPE(ranks, P.PATTERN)
    for t, ids in zip(texts, bpe.encode(texts)):
        assert ids == want.encode_ordinary(t) and bpe.decode_bytes(ids) == t.encode()
        assert all(s < e for s, e in bpe.offsets(t[:500], want.encode_ordinary(t[:500])))
    rows = byte_bpe.round_trip_digest(docs, RANKS, P.PATTERN).collect()
    digest = lambda t: hashlib.sha256(" ".join(map(str, want.encode_ordinary(t or ""))).encode()).hexdigest()
    assert Counter((r["doc_id"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == Counter(
        (i, digest(t), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in ROWS)
    assert not byte_bpe.round_trip_digest(none, RANKS, P.PATTERN).collect()
    back = byte_bpe.decode(byte_bpe.encode(docs, RANKS, P.PATTERN).select("doc_id", "ids"), RANKS, P.PATTERN)
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter((i, t or "") for i, t, _ in ROWS)


def test_byte_bpe_keeps_one_object_per_id(monkeypatch):
    """However many matches hold an id, it is one object; a table that starts anew changes no id."""
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    want = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe = byte_bpe.ByteBPE(ranks, P.PATTERN)
    texts = [t or "" for _, t, _ in ROWS]
    ids = [i for row in bpe.encode(texts) for i in row]
    assert len({id(i) for i in ids}) == len(set(ids))
    for remembered in (1, 40):
        monkeypatch.setattr(byte_bpe, "REMEMBERED", remembered)
        assert [bpe.encode([t])[0] for t in texts] == bpe.encode(texts) == [want.encode_ordinary(t) for t in texts]
    assert bpe.encode([]) == [] and bpe.encode([""]) == [[]]


@pytest.mark.parametrize("chunk,overlap", [(32_768, 512), (300, 8)])
def test_token_counts_equal_the_library(spark, docs, none, chunk, overlap):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = token_counts.count_tokens(docs, MODEL, chunk_chars=chunk, overlap_chars=overlap).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows) == Counter(
        (i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096) for i, t, _ in ROWS)
    assert not token_counts.count_tokens(none, MODEL).collect()


def test_base_scores_are_exact_and_model_scores_close(docs, none):
    train = language_id.remainder(F.col("doc_id"), 7) != 2
    key = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7
    toks = [((t or "").encode().lower().split() + [b"\n"], key(i) == 2, i) for i, t, _ in ROWS]
    one = Counter(w for ws, held, _ in toks if not held for w in ws)
    two = Counter(p for ws, held, _ in toks if not held for p in zip([b"\n"] + ws[:-1], ws))
    n, v = sum(one.values()), len(one)
    low = lambda c: 2 ** (c.bit_length() - 1) if c else 0
    high = lambda c: 2 ** c.bit_length() - 1
    want = defaultdict(list)
    for ws, held, i in toks:
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in ws)
        score = sum(math.log10((min(low(two[a, b]), low(one[b])) + bloom_lm.MU * (low(one[b]) + 1) / (n + v + 1))
                               / (high(one[a]) + bloom_lm.MU)) for a, b in zip([b"\n"] + ws[:-1], ws))
        want[i].append((held, len(ws), sum(one[w] > 0 for w in ws), base, score))
    rows = bloom_lm.score_documents(docs, train).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        held, size, known, base, score = want[r["doc_id"]][0]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, size, known, n)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score, rel=0.1, abs=0.5)
    assert not bloom_lm.score_documents(none, train).collect()


def test_filter_never_counts_too_low():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 5000).astype(np.uint64)
    keys = keys & np.uint64((1 << 48) - 1)
    counts = rng.integers(1, 1000, 5000)
    size, bits = bloom_lm.segment(keys, counts)
    filt = bloom_lm.LogFrequencyFilter(8, np.full(256, size, np.uint64), np.zeros(256, np.int64), bits)
    assert (filt.levels(keys) >= 1 + np.floor(np.log2(counts))).all()
    assert (filt.levels(rng.integers(0, 2**48, 5000).astype(np.uint64)) > 0).mean() < 0.02


def test_model_is_a_distribution(spark):
    """The probabilities of all words after a frequent, a rare and an unknown word add up to 1 or less: counts just
    below a power of two (held exactly or low) over histories that are held high."""
    texts = ["v a"] * 7 + [f"v w{i}" for i in range(7)] + ["r x", "v a b", "x y z"] + ["f " + f"u{i % 31}" for i in range(900)]
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    segments, bits = bloom_lm.build_segments(train)
    filt, hasher = bloom_lm.load_filter(segments, bits), bloom_lm.WordHasher()
    counts = Counter(w for t in texts for w in t.split())
    total = float(sum(counts.values()) + len(texts) + len(counts) + 2)
    vocabulary = sorted(counts)
    one = {w: 10.0 ** bloom_lm._scores(filt.levels, *bloom_lm._closed(hasher, [w]), total)[0] for w in vocabulary}
    for before in ("v", "r", "f", "unknown", "a"):
        # P(w | before) from texts that differ by w alone: P(before w end) / P(end | w) / P(before)
        mass = 0.0
        for w in vocabulary:
            tokens, _ = bloom_lm._closed(hasher, [f"{before} {w}"])
            whole = 10.0 ** bloom_lm._scores(filt.levels, tokens, np.array([3]), total)[0]
            first = 10.0 ** bloom_lm._scores(filt.levels, tokens[:1], np.array([1]), total)[0]
            start = 10.0 ** bloom_lm._scores(filt.levels, hasher.words([w])[0], np.array([1]), total)[0]
            mass += whole / first / (one[w] / start)
        assert 0.0 < mass <= 1 + 1e-9, (before, mass)


def test_scores_do_not_depend_on_the_filter_bound(docs, none, monkeypatch):
    """A filter above the broadcast bound holds the same n-grams and gives the same scores."""
    train = language_id.remainder(F.col("doc_id"), 7) != 2
    rows = lambda: sorted(map(tuple, bloom_lm.score_documents(docs, train).collect()), key=str)
    want = rows()
    monkeypatch.setattr(bloom_lm, "FILTER_BYTES", 1 << 10)
    assert rows() == want
    assert not bloom_lm.score_documents(none, train).collect()


def test_language_id(spark, docs, none):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    held = language_id.remainder(F.col("doc_id"), 3) == 1
    model = language_id.fit(table.where(~held))
    rows = language_id.identify(table.where(held), model, keep=("lang",)).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    edge = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    assert {i for i, r in edge.items() if r["lang_pred"] == "und"} == {1, 2, 3, 4}
    assert all(0 <= r["score"] <= 1 for r in edge.values())
    nothing = language_id.identify(docs, language_id.fit(none)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and not language_id.identify(none, model).collect()
    assert len(model) == 1
    parser = language_id.CrossParser(model[0])
    own = parser.own[parser.langs.index("en")]
    n = table.where(~held).where("lang = 'en' and text is not null").count()
    texts = language_id.sample_texts(table.where(~held), "text", "lang", "doc_id", [("en", n)])["en"]
    sample = own[language_id._symbols(texts, parser.numbers)[0][:language_id.SAMPLE_SYMBOLS]].tobytes()
    for t in ["The erthe of and", "été x", "жук и the", TEXT]:
        q = own[language_id._symbols([t], parser.numbers)[0]].tobytes()
        i = phrases = 0
        while i < len(q):
            j = i + 1
            while j < len(q) and q[i:j + 1] in sample:
                j += 1
            i, phrases = j, phrases + 1
        assert parser.phrases([t])[0][0, parser.langs.index("en")] == phrases


# One letter range each: three languages of Latin, two of Cyrillic and of Arabic, and five other scripts.
RANGES = {"la": (97, 122), "lb": (97, 122), "lc": (97, 122), "ca": (0x430, 0x44F), "cb": (0x430, 0x44F), "el": (0x3B1, 0x3C9),
          "aa": (0x627, 0x64A), "ab": (0x627, 0x64A), "th": (0xE01, 0xE2E), "zh": (0x4E00, 0x4F00), "ja": (0x3042, 0x3093),
          "ko": (0xAC00, 0xAD00)}


def invented(lang, rng, n):
    """A text of a language: words from its own list of 150."""
    own = np.random.default_rng(zlib.crc32(lang.encode()))
    low, high = RANGES.get(lang, (97, 122))
    words = ["".join(chr(own.integers(low, high + 1)) for _ in range(own.integers(2, 7))) for _ in range(150)]
    return " ".join(words[k] for k in rng.integers(0, 150, n))


def test_twelve_languages_in_eight_scripts(spark):
    rng = np.random.default_rng(7)
    rows = [(lang, invented(lang, rng, 80)) for lang in RANGES for _ in range(20)]
    # No key at all, and a third of the rows one text: both are learned from like any others.
    train = spark.createDataFrame([(None, t, lang) for lang, t in rows] + [(None, rows[0][1], "la")] * 120,
                                  "doc_id long, text string, lang string")
    model = language_id.fit(train)
    assert sorted(x for g in model for x in g["langs"]) == sorted(RANGES)
    tests = spark.createDataFrame([(lang, invented(lang, rng, 25)) for lang in RANGES for _ in range(15)], "lang string, text string")
    got = language_id.identify(tests, model, keep=("lang",)).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)


def test_every_label_is_learned_in_groups(spark, monkeypatch):
    rng = np.random.default_rng(8)
    names = [f"x{k:03d}" for k in range(600)]
    train = spark.createDataFrame([(k, invented(n, rng, 60), n) for k, n in enumerate(names)], "doc_id long, text string, lang string")
    tests = spark.createDataFrame([(n, invented(n, rng, 30)) for n in names[::7]], "lang string, text string")
    monkeypatch.setattr(language_id, "MODEL_BYTES", 16 << 20)
    model = language_id.fit(train)
    assert len(model) > 1 and sorted(x for g in model for x in g["langs"]) == names
    got = language_id.identify(tests, model, keep=("lang",)).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    whole = language_id.identify(tests, [language_id.train({n: [t] for _, t, n in train.collect()})], keep=("lang",)).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, got))


def components(rows):
    sets, root = [], list(range(len(rows)))
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = Counter()
    for g in groups.values():
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        for i in g:
            out[rows[i][0], len(sets[i]), min(ids, default=None)] += 1
    return out


def test_ngram_join_against_all_pairs(spark, docs, none):
    """Edge rows plus chains of near copies around a shared passage."""
    import random
    r = random.Random(5)
    word = lambda: f"w{r.randrange(400)}"
    shared = [word() for _ in range(60)]
    rows = [(i, t) for i, t, _ in ROWS]
    for g in range(6):
        base = shared + [word() for _ in range(r.choice([5, 40, 150]))]
        for _ in range(9):
            for _ in range(r.randint(0, 3)):
                base = list(base)
                base[r.randrange(len(base))] = word()
            rows.append((100 + len(rows), " ".join(base)))
    df = spark.createDataFrame([(*x, 1, "n") for x in rows], "doc_id long, text string, n long, node string").repartition(5)
    got = ngram_join.component_ids(df).collect()
    assert Counter((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got) == components(rows)
    assert len({x["component_id"] for x in got}) < len(rows) - 10
    assert not ngram_join.component_ids(none).collect()
    kept = ngram_join.one_per_component(docs)
    assert kept.columns == docs.columns
    assert Counter(x["doc_id"] for x in kept.collect()) == Counter([1, 2, 3, 4, 5, 6, 9, 10, None, 12, 13, 14])


def test_every_link_is_counted(spark, none):
    """Groups of near copies and of exact copies, against all pairs."""
    import random
    r = random.Random(8)
    word = lambda: f"w{r.randrange(300)}"
    rows = [(i, t) for i, t, _ in ROWS]
    for g in range(5):
        base = [word() for _ in range(r.choice([120, 200]))]
        for _ in range(8):
            if r.random() < 0.6:
                base = list(base)
                base[r.randrange(len(base))] = word()
            rows.append((100 + len(rows), " ".join(base)))
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    want = Counter((i, len(s), sum(k != m and bool(s & q) and 100 * len(s & q) >= 80 * len(s | q)
                                   for m, q in enumerate(sets))) for k, ((i, _), s) in enumerate(zip(rows, sets)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, ngram_join.link_counts(df).collect())) == want
    assert sum(n * k for (_, _, n), k in want.items()) > 2 * len(rows)
    assert not ngram_join.link_counts(none).collect()
