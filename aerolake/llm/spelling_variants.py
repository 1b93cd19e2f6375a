"""Spelling variants: vocabulary words that differ by one edit, found by dynamic programming over sorted lists.

*Blocks.* Let two words differ by one inserted, deleted or replaced code point, the shorter having m code points. If
their common prefix has p code points with x <= p < y, they also share their first x and their last m - y code points.
So the possible p (0 to m) are parted into three ranges, a word of L code points enters the blocks of its range keys for
m = L and m = L - 1, and each near pair meets in exactly one block that is responsible for its p. A block of more than
``BLOCK`` words is parted again by halving its range; at a range of one place a block holds at most as many words as the
alphabet has pairs of letters, so no block grows with the vocabulary without bound.

*Scan.* Blocks are dealt by key and sorted, shared ends cut off. Each word runs down the rest of its block's sorted list,
keeping the rows of the edit matrix (three cells around the diagonal) of the current list word's prefix: rows up to the
common prefix (LCP) with the list word before are reused, and when a row's least cell exceeds one edit, all list words
that share that prefix are skipped. All words of a batch of blocks move in lockstep, one row each per step, as NumPy
arrays, and leave when their block ends.

*Forms.* A word's form is its near word of largest count if that is at least ``ratio`` times its own; counts grow
tenfold along a chain of forms, so chains are short, and pointer doubling finds their last word.

Edge cases: null and empty texts hold no words; a null key counts as the empty string in the checksum; repeated rows
count again; an empty table gives an empty result. Only the key and the text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.arrow import slices
from aerolake.llm.common import bounded, written

RUN = "A-Za-zÀ-ÿ"
LEAST_CHARS = 7
# Different words that a task counts before it hands its counts on.
COUNTED = 200_000
# Words of one block above which its range is halved.
BLOCK = 20_000
# Cells (words times longest remaining part) that one lockstep scan holds.
CELLS = 1 << 21
# Entries of whole blocks that a task holds at a time.
BATCH_ROWS = 100_000


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_CHARS,
                planted: int = 31) -> DataFrame:
    """(word, n): lower-cased letter runs of all texts with at least ``least`` code points. Where ``planted`` divides
    the crc32 of ``<key>:<run>``, the run loses the code point at crc32 modulo its length first."""
    source = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("__text"))
    find = re.compile(f"[{RUN}]{{{least},}}").findall  # shorter runs cannot reach the length

    def run(batches):
        total = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                               names=["word", "n"])
            total.clear()
            return batch

        for part, texts in slices(batches, "__text"):
            for doc, body in zip(part.column(0).to_pylist(), texts):
                for w, n in Counter(find(body.encode().lower().decode())).items():  # bytes: A-Z only
                    h = zlib.crc32(f"{doc}:{w}".encode())
                    if h % planted == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                        if len(w) < least:
                            continue
                    total[w] += n
                if len(total) >= COUNTED:
                    yield out()
        yield out()

    return source.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _keyed(entries: DataFrame) -> DataFrame:
    """Adds the block's key and the part of the word that the block does not share."""
    tail = F.greatest(F.col("m") - F.col("y"), F.lit(0))
    return entries \
        .withColumn("key", F.concat_ws("|", "m", "x", "y", F.expr("substring(word, 1, x)"),
                                       F.expr("right(word, greatest(m - y, 0))"))) \
        .withColumn("mid", F.substring("word", F.col("x") + 1, F.length("word") - F.col("x") - tail))


def blocks(words: DataFrame, limit: int = BLOCK) -> DataFrame:
    """(word, n, m, x, y, key, mid): every word in each block whose ends it shares."""
    thirds = """flatten(transform(filter(array(length(word), length(word) - 1), m -> m > 0), m -> array(
        named_struct('m', m, 'x', 0, 'y', m div 3), named_struct('m', m, 'x', m div 3, 'y', 2 * m div 3),
        named_struct('m', m, 'x', 2 * m div 3, 'y', m + 1))))"""
    entries = _keyed(words.selectExpr("word", "n", f"inline({thirds})").selectExpr(
        "word", "n", "int(m) AS m", "int(x) AS x", "int(y) AS y").where("x < y"))
    settled = []
    while True:
        # Counts by a hash of the key: two keys of one hash are parted further, which costs time, never results.
        hot = entries.groupBy(F.xxhash64("key").alias("h")).agg(F.count(F.lit(1)).alias("c"), F.max(F.expr("y - x")).alias("r")) \
            .where((F.col("c") > limit) & (F.col("r") > 1)).select("h")
        hot = written(hot, "blocks")
        if hot.isEmpty():
            settled.append(entries)
            break
        h, small = F.xxhash64("key") == F.col("h"), bounded(hot)
        settled.append(entries.join(small, h, "left_anti"))
        halves = "inline(array(named_struct('p', x, 'q', (x + y) div 2), named_struct('p', (x + y) div 2, 'q', y)))"
        entries = _keyed(entries.join(small, h, "left_semi").selectExpr("word", "n", "m", "x", "y", halves)
                         .selectExpr("word", "n", "m", "int(p) AS x", "int(q) AS y").where("x < y"))
        entries = written(entries, "blocks")
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def scan(block: np.ndarray, code: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of entries of one block within one edit, as entry numbers. ``block``: block of each entry, ascending;
    ``code``: code points, -1 after the end, sorted within the block; ``size``: code points of each entry."""
    n, wide = code.shape
    fresh = np.concatenate([[True], block[1:] != block[:-1]])
    # LCP with the entry before; 0 where a block starts.
    equal = np.cumprod((code[1:] == code[:-1]) & (code[1:] >= 0), axis=1).sum(axis=1) if n > 1 else np.zeros(0, int)
    lcp = np.concatenate([[0], equal])
    lcp[fresh] = 0
    starts = np.flatnonzero(fresh)
    stop = np.concatenate([starts[1:], [n]])[np.cumsum(fresh) - 1]
    # skip[d][t]: the next entry that does not share the first d code points with t.
    skip = np.empty((wide + 1, n), np.int32)
    for d in range(1, wide + 1):
        below = np.concatenate([np.flatnonzero(lcp < d), [n]])
        skip[d] = below[np.searchsorted(below, np.arange(n), side="right")]
    lcp = np.concatenate([lcp, [0]])
    # Rows of each word's matrix: cells left of, on and right of the diagonal, capped at 2 edits.
    rows = np.full((n, wide + 2, 3), 2, np.int8)
    rows[:, 0, 1] = 0
    rows[size > 0, 0, 2] = 1
    padded = np.concatenate([np.full((n, 1), -2, code.dtype), code, np.full((n, 2), -3, code.dtype)], axis=1)
    q = np.flatnonzero(np.arange(n) + 1 < stop)
    t, depth = q + 1, np.zeros(len(q), np.int64)
    left, right = [], []
    while len(q):
        whole = depth == size[t]
        a, b, d = q[whole], t[whole], depth[whole]
        off = size[a] - d + 1
        near = (off >= 0) & (off <= 2)
        near[near] = rows[a[near], d[near], off[near]] == 1
        left.append(a[near])
        right.append(b[near])
        nxt = t + 1
        on = np.flatnonzero(~whole)
        a, d = q[on], depth[on]
        c, old = code[t[on], d], rows[a, d]
        one = np.minimum(old[:, 0] + (padded[a, d] != c), old[:, 1] + 1)
        two = np.minimum(np.minimum(old[:, 1] + (padded[a, d + 1] != c), old[:, 2] + 1), one + 1)
        two[d + 1 > size[a]] = 2
        three = np.minimum(old[:, 2] + (padded[a, d + 2] != c), two + 1)
        three[d + 2 > size[a]] = 2
        new = np.minimum(np.stack([one, two, three], axis=1), 2)
        rows[a, d + 1] = new
        alive = new.min(axis=1) < 2
        nxt[on] = np.where(alive, t[on], skip[d + 1, t[on]])
        depth = np.where(nxt == t, depth + 1, lcp[nxt])
        t = nxt
        live = t < stop[q]
        if not live.all():
            q, t, depth = q[live], t[live], depth[live]
    return np.concatenate([*left, np.zeros(0, int)]), np.concatenate([*right, np.zeros(0, int)])


def _pairs(table: pa.Table) -> pa.Table:
    """Near pairs, in both directions, of whole blocks (columns key, mid, word, n, m, x, y, sorted by key and mid)."""
    key = table.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
    mids = table.column("mid").to_pylist()
    m, x, y = (table.column(c).to_numpy() for c in ("m", "x", "y"))
    size = np.array([len(s) for s in mids], np.int64)
    points = np.frombuffer("".join(mids).encode("utf-32-le"), np.uint32).astype(np.int32)
    at = np.cumsum(size) - size
    short = size == np.where(y <= m, y - x, m - x)  # words of m code points; the others have one more
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.concatenate([first, [len(key)]]))
    wide, some = np.maximum.reduceat(size, first), np.logical_or.reduceat(short, first)
    chosen = np.flatnonzero((count > 1) & some)
    chosen = chosen[np.argsort(np.ceil(np.log2(wide[chosen] + 1)), kind="stable")]  # alike in width
    left, right, group, cells, held = [], [], [], 0, 0
    for k, b in enumerate(chosen.tolist()):
        group.append(b)
        cells = max(cells, int(wide[b]))
        held += cells * int(count[b])
        if held >= CELLS or k + 1 == len(chosen):
            entry = np.concatenate([np.arange(first[g], first[g] + count[g]) for g in group])
            code = np.full((len(entry), cells), -1, np.int32)
            inside = np.arange(cells) < size[entry][:, None]
            code[inside] = points[(at[entry][:, None] + np.arange(cells))[inside]]
            a, c = scan(key[entry], code, size[entry])
            # This block answers for the pair only if the common prefix ends in its range and one word has m points.
            same = np.cumprod((code[a] == code[c]) & (code[a] >= 0), axis=1).sum(axis=1)
            a, c = entry[a], entry[c]
            mine = (x[a] + same < y[a]) & (short[a] | short[c])
            left.append(a[mine])
            right.append(c[mine])
            group, cells, held = [], 0, 0
    a, c = (np.concatenate([*s, np.zeros(0, np.int64)]).astype(np.int64) for s in (left, right))
    rows = table.select(["word", "n"]).combine_chunks()
    one, two = rows.take(pa.array(a)), rows.take(pa.array(c))
    both = pa.concat_tables([
        pa.table({"word": one["word"], "near": two["word"], "near_n": two["n"]}),
        pa.table({"word": two["word"], "near": one["word"], "near_n": one["n"]})])
    return both.combine_chunks()


def near_pairs(words: DataFrame, limit: int = BLOCK) -> DataFrame:
    """(word, near, near_n) for every two words (column ``word``, all different, and their ``n``) that differ by one
    edit, in both directions, each once."""
    dealt = blocks(words, limit).select("key", "mid", "word", "n", "m", "x", "y") \
        .repartition("key").sortWithinPartitions("key", "mid")

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < BATCH_ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = table.column("key")[-1].as_py()
            keys = table.column("key").to_pylist()
            cut = rows - 1
            while cut > 0 and keys[cut - 1] == last:
                cut -= 1
            if cut:  # all blocks but the last, which may go on
                yield from _pairs(table.slice(0, cut)).to_batches()
                held, rows = table.slice(cut).to_batches(), rows - cut
        if rows:
            yield from _pairs(pa.Table.from_batches(held).combine_chunks()).to_batches()

    return dealt.mapInArrow(run, "word string, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each chain of forms, by pointer doubling."""
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = written(state.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if state.where("moved").isEmpty():
            return state.select("word", "root")
        state = state.select("word", "root")


def group_variants(words: DataFrame, ratio: int = 10, limit: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary of different words with their counts ``n``."""
    near = near_pairs(words, limit).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    judged = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "variants")
    ends = roots(judged.where(F.col("form").isNotNull()))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_CHARS, planted: int = 31,
                      seen: int = 2, ratio: int = 10) -> DataFrame:
    """Variants of all words of the texts that occur at least ``seen`` times."""
    words = written(count_words(df, key, text, least, planted).where(F.col("n") >= seen), "vocabulary")
    return group_variants(words, ratio)
