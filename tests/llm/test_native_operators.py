"""Sharding, quality rules, licence scan, URL filter and decontamination against brute force on edge rows."""

import itertools
import math
import re
import zlib
from collections import Counter

import pytest
from corpus_rows import ROWS, TEXT

from aerolake.llm import decontaminate, license_scan, quality_rules, sharding, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * sharding.LCG_MULTIPLIER + 1) % (1 << 64)
        j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_and_slots(spark, docs, none):
    out = sharding.shard_documents(docs).collect()
    assert len(out) == len(ROWS) and not sharding.shard_documents(none).collect()
    for r in out:
        assert r["shard"] == jump(r["doc_id"] or 0, 16) and r["grown_shard"] == jump(r["doc_id"] or 0, 17)
        assert r["grown_shard"] in (r["shard"], 16)
    text = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in ROWS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == text
    for s in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    keys = spark.range(-500, 500)
    many = keys.select("id", sharding.jump_hash(keys["id"], 1000).alias("s")).collect()
    assert all(r["s"] == jump(r["id"], 1000) for r in many)


def test_slots_do_not_depend_on_buckets(docs, monkeypatch):
    def rows():
        return {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard_documents(docs).collect()}

    one = rows()
    monkeypatch.setattr(sharding, "ROWS_PER_SLOT_BUCKET", 1)
    assert rows() == one


def test_slots_of_outliers_null_and_repeated_keys(spark):
    """Ranges follow the rows, wherever the keys lie; a hot key and null keys are parted by their texts."""
    import random
    r = random.Random(5)
    rows = [(i, f"t{i}") for i in range(2000)] + [(1 << 62, "far"), (-(1 << 62), "far")] \
        + [(77, f"hot {r.random()}") for _ in range(1500)] + [(None, f"none {r.random()}") for _ in range(500)] \
        + [(5, "same")] * 3
    df = spark.createDataFrame(rows, "key long, text string").selectExpr(
        "key", "crc32(cast(text AS binary)) AS crc", "0 AS shard")
    ranged = df.withColumn("part", sharding.slot_ranges(df, "key", ["crc"], 40))
    assert max(x["count"] for x in ranged.groupBy("part").count().collect()) <= 3 * len(rows) // 40
    order = lambda x: (x["key"] is not None, x["key"] or 0, x["crc"])
    assert [order(x) for x in ranged.orderBy("part").collect()][0][0] is False
    by_part = sorted(ranged.collect(), key=lambda x: (x["part"], order(x)))
    assert [order(x) for x in by_part] == sorted(map(order, by_part))


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [s for s in t.split("\n") if WORD.search(s)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_quality_measures_and_policies(docs, none):
    judged = quality_rules.judge(docs)
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                  for r in judged.collect())
    assert got == Counter((i, *quality(t)) for i, t, _ in ROWS)
    for r in judged.collect():
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["fail_bits"] & quality_rules.mask_of(
            quality_rules.POLICIES[quality_rules.CURRENT]) == 0)
    assert not quality_rules.judge(none).collect()
    led = quality_rules.stored_ledger(docs)
    for v in quality_rules.POLICIES:  # one stored ledger serves every version
        assert sorted(map(str, quality_rules.apply_policy(led, v).collect())) == sorted(
            map(str, quality_rules.judge(docs, v).collect()))
    bits = [r["fail_bits"] for r in led.collect()]
    for r in quality_rules.ablation(led).collect():
        mask, bit = quality_rules.mask_of(quality_rules.POLICIES[r["policy"]]), quality_rules.mask_of([r["rule"]])
        assert (r["n_failed"], r["n_only"], r["n_kept"], r["n_kept_without"]) == (
            sum(b & bit != 0 for b in bits), sum(b & mask == bit for b in bits), sum(b & mask == 0 for b in bits),
            sum(b & mask & ~bit == 0 for b in bits))


def dice(text, template):
    a, b = (Counter(zip(w, w[1:])) for w in map(license_scan.normal_words, (text, template)))
    return 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values())) if a else 0.0


def test_license_scan_against_all_pairs(spark, none):
    texts = ["Released under the MIT License.", "words\n released UNDER the mit license\nmore", None, "",
             "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0", TEXT,
             "This work is licensed under the GNU General Public License, version 3.\n" * 2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = set()
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        units = list(enumerate(lines, 1)) + ([(0, t)] if len(lines) > 1 else [])
        for n, u in units:
            for k, (_, template) in enumerate(license_scan.TEMPLATES):
                if dice(u, template) >= license_scan.THRESHOLD:
                    want.add((i, n, k, round(dice(u, template), 9)))
    got = license_scan.scan(df).collect()
    assert {(r["doc_id"], r["line"], r["template"], round(r["dice"], 9)) for r in got} == want and len(want) > 5
    assert not license_scan.scan(none).collect()


def test_licence_notices_inside_longer_texts(spark):
    """Notices wrapped over lines, inside a line, edited, cut by the end, side by side; none where a line matches."""
    import random
    import textwrap
    r = random.Random(3)
    other = lambda n: " ".join(f"w{r.randrange(900)}" for _ in range(n))
    mit, bsd, cc = (license_scan.TEMPLATES[k][1] for k in (2, 16, 15))
    wrapped = lambda t: textwrap.fill(t, 40)
    edited = mit.replace("free of charge", "gratis").replace("deal in", "deal freely in")
    texts = [other(200) + "\n" + wrapped(mit) + "\n" + other(200), other(30) + ". " + cc + " " + other(30),
             other(50) + "\n\n" + wrapped(edited) + "\n" + other(50), wrapped(bsd + "\n" + mit) + "\n" + other(300),
             other(90) + "\n" + wrapped(mit + " " + mit), other(90) + "\n" + wrapped(mit)[:-30],
             other(80) + "\n" + cc + "\n" + cc + "\n" + other(80), other(300), " ".join(mit.split()[:30]) + other(90)]
    rows = license_scan.scan(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()
    got = sorted((x["doc_id"], x["line"], x["template"]) for x in rows)
    second = wrapped(mit + " " + mit).split("\n")
    at = 2 + next(i for i, x in enumerate(second) if "Permission" in x and i)
    assert got == [(0, 2, 2), (1, 1, 15), (2, 3, 2), (3, 1, 16), (3, 1 + next(
        i for i, x in enumerate(texts[3].split("\n")) if "Permission" in x), 2), (4, 2, 2), (4, at, 2), (5, 2, 2),
        (6, 2, 15), (6, 3, 15)]
    best = {(x["doc_id"], x["line"]): x["dice"] for x in rows}
    assert best[0, 2] == best[1, 1] == best[4, at] == 1 and 0.8 <= best[2, 3] < 1 and 0.8 <= best[5, 2] < 1


def test_url_rules_and_mined_rules(spark):
    urls = ([(i, f"http://a{i}.example.com/de/{i}") for i in range(8)]
            + [(10 + i, f"http://www.b.example.net/de/{i}?x=1") for i in range(3)]
            + [(20 + i, f"https://c.example.org/en/{i}") for i in range(8)]
            + [(30, None), (31, "no scheme"), (32, "HTTP://X.ORG?q"), (33, "http://EXAMPLE.org/es/1"),
               (34, "http://t.com/fr/a?b#c"), (34, "http://t.com/fr/a?b#c"), (35, "http://x.net/es/")])
    pages = spark.createDataFrame([(*u, "v") for u in urls], "page_id long, url string, verdict string")
    rows = url_filter.judge_urls(pages).collect()
    assert len(rows) == len(urls)
    by = {r["page_id"]: r for r in rows}
    assert by[0]["rule"] == "com/de/" and by[0]["verdict"] == "block"
    assert by[20]["rule"] == "example.org/en/1" or by[20]["rule"] == "org/"
    assert by[21]["rule"] == "example.org/en/1" and by[21]["verdict"] == "block"
    assert by[33]["rule"] == "example.org/es/" and by[33]["host"] == "example.org"
    assert by[34]["rule"] == "com/fr/" and by[34]["verdict"] == "allow"
    assert (by[30]["host"], by[30]["path"], by[30]["rule"], by[30]["verdict"]) == ("", "", None, "allow")
    assert (by[32]["host"], by[32]["path"]) == ("x.org", "")
    assert by[10]["rule"] is None and by[10]["verdict"] == "block" and by[10]["mined_rule"] == "p=de"
    assert by[35]["verdict"] == "allow"
    assert not url_filter.judge_urls(pages.where("false")).collect()


def all_rules(sets, share, count, confidence):
    """Every combination of tokens that is a rule, without those that hold a smaller rule of at least its confidence."""
    n = len(sets)
    least = math.ceil(max(share, count / n) * n)
    held, bad = Counter(), Counter()
    for items, is_bad in sets:
        for k in range(1, len(items) + 1):
            for c in itertools.combinations(sorted(items), k):
                held[c] += 1
                bad[c] += is_bad
    rules = {c: (bad[c] / held[c], bad[c] / n) for c in held if bad[c] >= least and bad[c] / held[c] >= confidence}
    return {c: v for c, v in rules.items()
            if not any(set(q) < set(c) and rules[q][0] >= v[0] for q in rules)}


def test_mined_rules_against_all_combinations(spark):
    """Tokens that always go together, tokens of blocked URLs only, and mixed ones; the best rule of every set."""
    import random
    r = random.Random(11)
    sets = []
    for _ in range(400):
        items = {x for x in "abcdef" if r.random() < 0.4}
        if "a" in items:
            items |= {"aa", "a-a"}
        odds = 0.93 if {"b", "c"} <= items else 0.86 if "a" in items and "d" in items else 0.2
        is_bad = r.random() < odds
        if is_bad and r.random() < 0.2:
            items.add("sure")
        sets.append((sorted(items), is_bad))
    known = spark.createDataFrame(sets, "tokens array<string>, bad boolean")
    want = all_rules([(set(x), b) for x, b in sets], 0.01, 5, 0.8)
    rules = url_filter.mine_rules(known, min_support=0.01, min_count=5, min_confidence=0.8)
    got = {}
    for row in rules.collect():
        for c in itertools.product(*row["needs"]):
            got[tuple(sorted(c))] = (pytest.approx(row["confidence"]), pytest.approx(row["support"]))
    assert got == want and ("sure",) in want and len(want) > 5
    more = sets + [(["a-a", "d"], False), (["aa", "a-a", "d"], False), ([], False), (["zz"], False)]
    hits = {tuple(x["tokens"]): (x["hit"]["rule"], x["hit"]["confidence"]) for x in
            url_filter.match_rules(spark.createDataFrame(more, "tokens array<string>, bad boolean"), rules).collect()}
    for items, _ in more:
        fit = [(-v[0], -v[1], len(c), " & ".join(c)) for c, v in want.items() if set(c) <= set(items)]
        assert hits.get(tuple(items)) == ((min(fit)[3], pytest.approx(-min(fit)[0])) if fit else None)
    assert not url_filter.mine_rules(known.where("false")).collect()


def test_long_url_shapes_do_not_explode_the_miner(spark):
    """25 query names that always occur together, in blocked and in allowed URLs."""
    query = "&".join(f"k{i}=1" for i in range(25))
    urls = [(i, f"http://a{i}.example.com/de/x?{query}") for i in range(30)] \
        + [(50 + i, f"http://b{i}.example.com/fr/x?{query}") for i in range(3)] \
        + [(100 + i, f"http://c{i}.example.com/fr/y") for i in range(40)] + [(200, f"http://t.net/?{query}"),
                                                                             (201, "http://t.net/?k3=2&k24=")]
    by = {r["page_id"]: r for r in url_filter.judge_urls(
        spark.createDataFrame(urls, "page_id long, url string")).collect()}
    assert len(by) == len(urls) and by[200]["mined_rule"] == "q=k0" and by[201]["mined_rule"] == "q=k24"
    assert by[200]["verdict"] == "block" and by[200]["mined_confidence"] == pytest.approx(30 / 33)


def grams(words):
    return {" ".join(words[i:i + 5]) for i in range(len(words) - 4)}


def test_decontamination_against_all_aligned_windows(spark, docs, none):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"
    words = item.split()
    texts = [item.upper(), "before " + item + " after", " ".join(words[:-1] + ["changed"]), " ".join(words[::-1]),
             " ".join(words[:9]), " ".join(words[:4] + ["cut"] + words[4:]), None, "", TEXT, (item + ". ") * 3]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    b = spark.createDataFrame([(1, item, 0), (2, "too few words here", 0), (3, None, 0), (1, item, 0)],
                              "item_id long, text string, doc_id int")
    want = {}
    size = lambda g: sum(map(len, g))
    for i, t in enumerate(texts):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        starts = {i - j for i in range(len(w) - 4) for j in range(len(words) - 4) if w[i:i + 5] == words[j:j + 5]}
        for first in starts:
            g = grams(w[max(first, 0):max(first + len(words), 0)])
            inter = size(g & grams(words))
            if inter and inter / (size(g) + size(grams(words)) - inter) >= 0.8:
                want[i] = max(want.get(i, 0), inter / (size(g) + size(grams(words)) - inter))
    got = decontaminate.find_leaks(d, b).collect()
    assert {r["doc_id"]: pytest.approx(r["similarity"]) for r in got} == want and {r["item_id"] for r in got} == {1}
    kept = decontaminate.remove_leaks(d, b)
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - set(want) and kept.columns == d.columns
    assert not decontaminate.find_leaks(none, b).collect()
    assert decontaminate.remove_leaks(docs, b.where("false")).count() == len(ROWS)


def test_benchmark_items_without_a_key_are_found(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame([(1, "before it " + passage + " after it"), (2, "other words only, and none of those"),
                                  (None, passage)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, passage), (7, passage + " lambda mu nu xi omicron pi rho"), (None, None),
                                   (None, "one two three four five six")], "item_id long, text string")
    got = sorted(map(tuple, decontaminate.find_leaks(docs, bench).collect()), key=str)
    assert got == [(1, None, 1.0), (None, None, 1.0)]
    assert [r["doc_id"] for r in decontaminate.remove_leaks(docs, bench).collect()] == [2]


def test_short_benchmark_items_are_found_whole(spark):
    docs = spark.createDataFrame([(1, " The secret, answer: 42!\n"), (2, "the secret answer 42 and more"), (3, "the secret"),
                                  (4, None), (5, "..."), (6, "ANSWER"), (6, "ANSWER"), (None, "answer")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, "the secret answer 42"), (None, "Answer"), (3, ""), (4, None), (5, "--")],
                                  "item_id long, text string")
    got = sorted(map(tuple, decontaminate.find_leaks(docs, bench).collect()), key=str)
    assert got == [(1, 1, 1.0), (6, None, 1.0), (None, None, 1.0)]
    assert [r["doc_id"] for r in decontaminate.remove_leaks(docs, bench).orderBy("doc_id").collect()] == [2, 3, 4, 5]


def test_simhash_index_reaches_the_radius():
    """Any two bytes-wise prints within the radius share a block within the block radius."""
    import random
    r = random.Random(3)
    for _ in range(2000):
        d = sum(1 << b for b in r.sample(range(64), decontaminate.RADIUS))
        assert min(bin(d >> 8 * b & 255).count("1") for b in range(8)) <= decontaminate.BLOCK_RADIUS
