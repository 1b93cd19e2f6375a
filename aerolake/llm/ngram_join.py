"""N-gram Jaccard self-join by multiple global token orders.

Texts (A-Z lower-cased) become sets of 64-bit hashes of their five-word shingles; equal sets are one node. Two
nodes link when ``|A n B| / |A u B| >= 0.8``. For any global order of tokens, two sets that link share at least
``l`` of the first ``n - ceil(0.8 n) + l`` tokens of each, so filters under several orders can be intersected:

1. *Hash order.* Every node sends its ``l``-prefix (about 0.4 of its tokens, ``l = n / 5``). Tokens are counted with
   pre-aggregation; those of two nodes or more go into a bounded bitmap. A second pass keeps only nodes with enough
   prefix tokens in the bitmap to have any partner. Most texts end here.
2. *Rarest first*, ties by ``ORDERS`` different salted hashes, over the whole sets of the nodes left. A partner shares
   at least ``ceil(0.8 n)`` of the ``s`` tokens that a node shares with any other, so under each order one of the first
   ``s - ceil(0.8 n) + 1``. Pairs come from the first order's prefixes and must overlap in the prefixes of every other
   order, in size, and in the number of shared tokens on either side.
3. *Verification* of what is left by the whole sets, exactly.

Groups of copies are never expanded into all their pairs. Each token names one pivot among its nodes; a node is
verified against the pivot it shares most tokens with, verified links become components, and the next rounds only
look at tokens that still meet different components (with other pivots). The last round takes every remaining
pair across components, so no link between different texts is lost; inside a component further pairs cannot change
the result.

``links`` and ``link_counts`` take every pair of different nodes through the same filters instead, for callers that
need the links themselves or their number.

The result is the whole self-join's components; a node is identified by 64 bits of its set (two different sets
share an identity with probability n^2 / 2^65).

Edge cases: null, empty and blank texts have an empty set, link with nothing and are their own component; fewer
than five words make one shingle of them all; repeated rows and equal texts share a component; an empty table
gives an empty result. Only key and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.arrow import extended, slices
from aerolake.llm.common import bounded, written
from aerolake.llm.components import connected
from aerolake.llm.hashing import BASE, U, WordHasher, mix

SHINGLE = 5
ORDERS = 3  # rarest-first orders whose filters are intersected
PIVOT_ROUNDS = 3
PIVOT_GRADES = 20  # how finely nodes are graded as pivots
PIVOTS = 8  # pivots that a node may meet in one later round, on average tokens
CHUNK_BITS = 1 << 19  # bits of one chunk of a bitmap
MOST_BITS = 1 << 28  # a bitmap has 32 MB at most; beyond it lets more tokens pass, never fewer
BITS_PER_KEY = 32


def shingle_sets(hasher: WordHasher, texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, counts = hasher.words(texts)
    roll = np.zeros(len(words), U)
    padded = np.concatenate([words, np.zeros(SHINGLE, U)])
    for j in range(SHINGLE):
        roll = roll * BASE + padded[j:j + len(words)]
    full = mix(roll)
    out, at = [], 0
    for n in counts.tolist():
        if n >= SHINGLE:
            out.append(np.unique(full[at:at + n - SHINGLE + 1]))
        elif n:
            place = np.arange(1, n + 1).astype(U)
            out.append(mix(np.array([mix(words[at:at + n] * BASE + place).sum(dtype=U) + U(n)], U)))
        else:
            out.append(np.zeros(0, U))
        at += n
    return out


def _node(tokens: np.ndarray) -> int:
    """Signed 64-bit identity of a set."""
    place = np.arange(1, len(tokens) + 1).astype(U)
    return int(mix(np.array([mix(tokens * BASE + place).sum(dtype=U) + U(len(tokens))], U)).view(np.int64)[0])


def _least(n):
    """Tokens a partner shares at least: ceil(0.8 n)."""
    return -(-4 * n // 5)


def _slack(n):
    """``l`` of the l-prefix."""
    return max(1, n // 5)


def _prefix_size(n: int) -> int:
    return n - _least(n) + _slack(n)


def _required(n: int) -> int:
    """Prefix tokens a node shares with any partner: ``l`` of the smallest possible partner."""
    return _slack(_least(n))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def _lists(parts: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(parts) if parts else np.zeros(0, U)
    return pa.ListArray.from_arrays(np.cumsum([0] + [len(p) for p in parts]).astype(np.int32), _long(flat))


def nodes_of(docs: DataFrame, keep: list[Column], text: str) -> DataFrame:
    """``keep`` columns, n and node of every row; the node is null for empty sets."""
    source = docs.select(*keep, F.col(text).alias("__text"))

    def run(batches):
        hasher = WordHasher()
        for part, texts in slices(batches, "__text"):
            sets = shingle_sets(hasher, texts)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_node(s) if len(s) else None for s in sets], pa.int64())],
                names=[*part.schema.names[:-1], "n", "node"])

    return source.mapInArrow(run, extended(source, "n bigint, node bigint"))


def _sets(docs: DataFrame, text: str, choose) -> DataFrame:
    """(node, n, tokens) of the nodes of each task, each once a task; ``choose(node, tokens)`` gives the tokens to
    send or None."""
    def run(batches):
        hasher, seen = WordHasher(), set()
        for _, texts in slices(batches, "__text"):
            nodes, sizes, tokens = [], [], []
            for s in shingle_sets(hasher, texts):
                if len(s):
                    node = _node(s)
                    if node not in seen:
                        seen.add(node)
                        sent = choose(node, s)
                        if sent is not None and len(sent):
                            nodes.append(node)
                            sizes.append(len(s))
                            tokens.append(sent)
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                                                  _lists(tokens)], names=["node", "n", "tokens"])

    return docs.select(F.col(text).alias("__text")).mapInArrow(run, "node bigint, n bigint, tokens array<bigint>")


def _place(keys: np.ndarray, bits: int) -> np.ndarray:
    return mix(keys ^ BASE) >> U(64 - bits.bit_length() + 1)


def bitmap(keys: DataFrame, column: str) -> tuple[int, dict[int, bytes]]:
    """A bitmap of hashed bigint keys, built chunk by chunk in tasks and at most ``MOST_BITS`` long: (bits, chunks).
    A key that was put in is always found."""
    n = keys.count()
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(CHUNK_BITS.bit_length() - 1, (BITS_PER_KEY * n).bit_length()))

    def place(batches):
        for batch in batches:
            at = _place(batch.column(0).to_numpy(zero_copy_only=False).view(U), bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array((at // U(CHUNK_BITS)).astype(np.int32)), pa.array((at % U(CHUNK_BITS)).astype(np.int32))],
                names=["chunk", "at"])

    def build(batches):
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            chunk, at = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for c in np.unique(chunk):
                chunks.setdefault(int(c), np.zeros(CHUNK_BITS, bool))[at[chunk == c]] = True
        for c, flags in chunks.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([np.packbits(
                flags, bitorder="little").tobytes()], pa.binary())], names=["chunk", "flags"])

    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = keys.select(column).mapInArrow(place, "chunk int, at int").repartition(parts, "chunk") \
        .mapInArrow(build, "chunk int, flags binary").collect()
    return bits, {r["chunk"]: bytes(r["flags"]) for r in rows}


class _Bitmap:
    def __init__(self, bits: int, chunks: dict[int, bytes]):
        self.bits = bits
        self.flags = np.zeros(bits // 8, np.uint8)
        for c, b in chunks.items():
            self.flags[c * CHUNK_BITS // 8:(c + 1) * CHUNK_BITS // 8] = np.frombuffer(b, np.uint8)

    def __contains__(self, node: int) -> bool:
        return bool(self.holds(np.array([node], np.int64).view(U))[0])

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = _place(keys, self.bits)
        return (self.flags[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8)) & 1 == 1


def _lazy(shared):
    """The broadcast bitmap, unpacked once a task."""
    held = []

    def get() -> _Bitmap:
        if not held:
            held.append(_Bitmap(*shared.value))
        return held[0]
    return get


def hopeful_sets(docs: DataFrame, text: str) -> DataFrame:
    """(node, n, tokens) with the whole sets of the nodes that pass the hash order's filter: enough tokens of their
    l-prefix are in the prefix of another node."""
    sc = docs.sparkSession.sparkContext
    prefix = _sets(docs, text, lambda node, s: s[:_prefix_size(len(s))])
    there = _lazy(sc.broadcast(bitmap(_held_by_two(prefix), "token")))

    def choose(node, s):
        return s if there().holds(s[:_prefix_size(len(s))]).sum() >= _required(len(s)) else None

    return written(_sets(docs, text, choose).dropDuplicates(["node"]), "join-sets")


def _held_by_two(sets: DataFrame) -> DataFrame:
    """(token, df) of the tokens of more than one node."""
    held = sets.select("node", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("df"), F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y")
    return written(held.select("token", "df"), "join-tokens")


def prefixes(sets: DataFrame) -> DataFrame:
    """(node, n, s, order0, order1, ...): ``s`` of the node's tokens are shared among the nodes left; a partner shares
    at least ceil(0.8 n) of them, so under each order one of the first ``s - ceil(0.8 n) + 1``. Nodes with fewer
    shared tokens have no partner."""
    held = _held_by_two(sets)
    there = _lazy(sets.sparkSession.sparkContext.broadcast(bitmap(held, "token")))

    def shared(batches):
        for batch in batches:
            nodes, sizes, tokens = [], [], []
            for node, n, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                s = s.values.to_numpy(zero_copy_only=False).view(U)
                s = s[there().holds(s)]
                if len(s) >= _least(n):
                    nodes.append(node)
                    sizes.append(n)
                    tokens.append(s)
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                                                  _lists(tokens)], names=["node", "n", "tokens"])

    some = sets.select("node", "n", "tokens").mapInArrow(shared, "node bigint, n bigint, tokens array<bigint>")
    ranked = some.select("node", "n", F.explode("tokens").alias("token")).join(held, "token") \
        .groupBy("node").agg(F.first("n").alias("n"), F.collect_list(F.struct("df", "token")).alias("shared")) \
        .withColumn("s", F.size("shared").cast("bigint")).where("5 * s >= 4 * n")
    for k in range(ORDERS):
        ranked = ranked.withColumn(f"order{k}", _prefix_under(k))
    return written(ranked.drop("shared"), "join-nodes")


def _prefix_under(order: int) -> Column:
    """The first tokens under one rarest-first order."""
    ranked = F.sort_array(F.transform("shared", lambda t: F.struct(
        t["df"].alias("df"), F.xxhash64(F.lit(order), t["token"]).alias("salt"), t["token"].alias("token"))))
    size = (F.col("s") - F.floor((F.col("n") * 4 + 4) / 5) + 1).cast("int")
    return F.transform(F.slice(ranked, F.lit(1), size), lambda t: t["token"])


# Sizes and shared tokens of both sides that a link needs: the overlap is 8/18 of both sizes or more.
_MAY_LINK = ("100 * least(n_a, n_b) >= 80 * greatest(n_a, n_b) AND 18 * least(s_a, s_b) >= 8 * (n_a + n_b)")


def _filtered(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) that pass the size filter and share enough of the prefixes of every further order."""
    side = lambda x: nodes.select(
        F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("s").alias(f"s_{x}"), *[F.col(f"order{k}").alias(f"{x}{k}") for k in range(1, ORDERS)])
    joined = pairs.join(side("a"), "a").join(side("b"), "b").where(_MAY_LINK)
    # Under any order two nodes share what their prefixes share and at most the rest of one of them.
    rest = "greatest(floor((4 * n_a + 4) / 5), floor((4 * n_b + 4) / 5)) - 1"
    for k in range(1, ORDERS):
        joined = joined.where(F.size(F.array_intersect(f"a{k}", f"b{k}")) * 18 >= F.expr(
            f"greatest(18, 8 * (n_a + n_b) - 18 * ({rest}))"))
    return joined.select("a", "b")


def _crossing(postings: DataFrame, component: Column) -> DataFrame:
    """Pairs (a, b) of different components that meet in a token of the first order's prefixes. The first token that
    a pair shares leaves it at most the tokens after its ranks; rows where these are too few for a link are not made,
    so for sets of like size only the first ninth of the tokens meets."""
    side = lambda x: postings.select("token", component.alias(f"c{x}"), F.col("node").alias(x),
                                     F.col("n").alias(f"n_{x}"), F.col("s").alias(f"s_{x}"), F.col("rank").alias(f"r_{x}"))
    return side("a").join(side("b"), "token").where("ca < cb").where(_MAY_LINK) \
        .where("18 * least(s_a - r_a, s_b - r_b) >= 8 * (n_a + n_b)").select("a", "b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose whole sets reach the similarity. Every pair carries one set to the other one's place."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("of_a")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("of_b")), "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    return both.where(100 * common >= 80 * (F.size("of_a") + F.size("of_b") - common)).select("a", "b")


def _candidates(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes that the filters leave, their tokens under the first order, and their whole sets."""
    whole = hopeful_sets(docs, text)
    found = prefixes(whole)
    postings = found.select("node", "n", "s", F.posexplode("order0").alias("rank", "token"))
    return found, postings, whole.join(found.select("node"), "node", "left_semi")


def links(docs: DataFrame, text: str = "text") -> DataFrame:
    """(a, b) of every two different nodes that link, once each, inside components too. The result of a group of g
    near copies that all link has g (g - 1) / 2 rows; exact copies are one node and add none."""
    found, postings, sets = _candidates(docs, text)
    pairs = written(_filtered(_crossing(postings, F.col("node")), found), "join-pairs")
    return written(_verified(pairs, sets), "join-links")


def linked_components(docs: DataFrame, text: str = "text") -> DataFrame:
    """(node, component) of every node with a link."""
    found, postings, sets = _candidates(docs, text)
    joined, labels = None, None
    for turn in range(PIVOT_ROUNDS + 1):
        open_ = postings if labels is None else postings.join(labels, "node", "left") \
            .withColumn("component", F.coalesce("component", "node"))
        who = F.col("node") if labels is None else F.col("component")
        # Tokens that still meet different components. The pivot of a token is a node with few tokens of its own,
        # so close to what its copies have in common; later turns vary it from token to token.
        rank = [-F.round(PIVOT_GRADES * F.col("s") / F.col("n")),
                F.xxhash64(F.lit(turn), F.col("token") % (1 if turn == 0 else PIVOTS), F.col("node"))]
        met = open_.groupBy("token").agg(
            F.min(who).alias("x"), F.max(who).alias("y"),
            F.min(F.struct(*rank, F.col("node")))["node"].alias("pivot"),
            F.min_by(who, F.struct(*rank, F.col("node"))).alias("of_pivot")) \
            .where("x <> y").select("token", "pivot", "of_pivot")
        here = open_.join(met, "token")
        if turn < PIVOT_ROUNDS:
            pairs = here.where(who != F.col("of_pivot")).groupBy(F.col("node").alias("a"), F.col("pivot").alias("b")) \
                .agg(F.count(F.lit(1)).alias("n"))
            if turn == 0:
                pairs = pairs.groupBy("a").agg(F.max_by("b", F.struct("n", "b")).alias("b"))
        else:
            pairs = _crossing(here, who)
        new = written(_verified(written(_filtered(pairs, found), "join-pairs"), sets), "join-links")
        if labels is not None and new.isEmpty():
            continue
        joined = new if joined is None else joined.unionByName(new)
        labels = written(connected(joined), "join-labels")
    return labels


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, id, n, component) of every row; ``id`` tells apart texts of one key, the component is null for empty
    sets."""
    rows = written(nodes_of(docs, [F.col(key).alias("key"), F.xxhash64(key, text).alias("id")], text), "join-rows")
    return rows.join(linked_components(docs, text), "node", "left") \
        .select("key", "id", "n", F.coalesce("component", "node").alias("component"))


def component_ids(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id (the smallest key reachable by links)."""
    named = _named(docs, key, text)
    smallest = named.where("component is not null").groupBy("component").agg(F.min("key").alias("smallest"))
    return named.join(smallest, "component", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("smallest", "key").alias("component_id"))


def link_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, n_links (all other rows that link with it, copies included)."""
    rows = written(nodes_of(docs, [F.col(key).alias("key")], text), "join-rows")
    copies = written(rows.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("copies")), "join-copies")
    found = links(docs, text)
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(copies.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")) \
        .agg(F.sum("copies").alias("others"))
    counted = copies.join(others, "node", "left").select(
        "node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return rows.join(counted, "node", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_per_component(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the smallest key of their component, with all their columns. Of rows that repeat key and
    text one stays; documents without words link with nothing and stay."""
    named = written(_named(docs, key, text), "join-named")
    first = named.where("component is not null").groupBy("component").agg(F.min(F.struct("key", "id"))["id"].alias("head"))
    rest = named.join(first, "component", "left").where("head is null or head <> id")
    extra = named.join(first, "component", "left").where("head is null or head = id").groupBy("id").count().where("count > 1")
    gone = rest.where("head is not null").select("id").unionByName(extra.select("id")).distinct()
    marked = docs.withColumn("__id", F.xxhash64(key, text))
    once = marked.join(bounded(written(gone, "join-gone").withColumnRenamed("id", "__id")), "__id", "left_anti")
    again = marked.join(bounded(written(extra.select(F.col("id").alias("__id")), "join-again")), "__id", "left_semi") \
        .dropDuplicates(["__id"])
    return once.unionByName(again).drop("__id")
