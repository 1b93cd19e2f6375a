"""Language-model scores from a log-frequency Bloom filter.

Every training n-gram (unigrams and bigrams) is counted over the whole corpus. The filter stores an n-gram of
count ``c`` as the events (n-gram, 1) ... (n-gram, 1 + floor(log2 c)); probing level after level until one is absent
gives back the range [2^(l-1), 2^l - 1] of the count, too high only by false positives, never too low. Texts are scored
whole: ``P(w | v) = (min(low(v w), low(w), high(v)) + MU * P(w)) / (high(v) + MU)`` over ``P(w) = (low(w) + 1) / (N + V + 1)``
(Dirichlet smoothing), summed as log10, where ``v`` is the token before ``w`` and a text begins after an end token. The
lower ends above and the upper end below keep the mass of all words after ``v`` at 1 or less, but for false positives.

Counting is distributed: tasks count their own n-grams, send packed (n-gram, count) runs to the n-gram's bucket,
and each bucket becomes one segment of the filter, ``BITS_PER_EVENT`` bits for each of its events, so nothing is merged
on the driver. Every n-gram is held at every size. Segments of ``FILTER_BYTES`` in all or less are broadcast and each
task scores with the whole filter. Larger filters stay distributed: each slice of texts sends its distinct n-grams to
their buckets, gets their levels back, and is scored with them, with the same result.

The base score is exact: tasks count the training words themselves before one aggregation by word; the ``HEAD_WORDS``
most frequent words are broadcast and summed where a text is scored, its other words are counted per text and joined
by word, so no frequent word and no single occurrence reaches a shuffle.

Edge cases: null and empty texts are the end token alone; a null key counts as the empty text for the split;
repeated rows repeat; without training rows every count is 0. Only key and text are read.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from aerolake.llm.arrow import extended, slices
from aerolake.llm.hashing import BASE, MIX1, U, WordHasher, mix
from aerolake.llm.common import written

FILTER_BYTES = 256 << 20
BITS_PER_EVENT = 12
PROBES = 6  # bits of one event
LEVELS = 40  # most levels of a count
MU = 4.0
HEAD_WORDS = 100_000  # words whose counts are broadcast (some megabytes)
COUNTED = 100_000  # different words that a task counts before it hands its counts on
HELD_ENTRIES = 1_500_000  # n-grams a task holds before it merges or sends them

_END_HASH = U(0x2545F4914F6CDD1D)


def _closed(hasher: WordHasher, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each text closed by the end token, and tokens per text."""
    words, n = hasher.words(texts)
    out = np.full(len(words) + len(texts), _END_HASH)
    out[np.arange(len(words)) + np.repeat(np.arange(len(texts)), n)] = words
    return out, n + 1


def ngram_keys(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the unigrams, and of the bigrams that end at each token."""
    before = np.concatenate([[_END_HASH], tokens[:-1]]).astype(U)
    return mix(tokens * MIX1 + U(1)), mix(before * BASE + mix(tokens + U(2)))


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key = np.concatenate(keys) if keys else np.zeros(0, U)
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(first)
    return key[at], np.add.reduceat(n, at) if len(at) else n


def _bits_of(keys: np.ndarray, level: int, size: np.ndarray) -> list[np.ndarray]:
    """Bit positions of the event (key, level) in segments of ``size`` bits."""
    h = mix(keys + U(level * int(BASE) & 0xFFFFFFFFFFFFFFFF))
    a, b = h & U(0xFFFFFFFF), (h >> U(32)) | U(1)
    return [(((a + U(i) * b) & U(0xFFFFFFFF)) * size) >> U(32) for i in range(PROBES)]


def _levels_of(counts: np.ndarray) -> np.ndarray:
    return np.minimum(LEVELS, np.frexp(counts.astype(np.float64))[1])  # 1 + floor(log2 c)


def segment(keys: np.ndarray, counts: np.ndarray) -> tuple[int, np.ndarray]:
    """(bits, packed bytes) of one bucket's part of the filter."""
    levels = _levels_of(counts)
    size = max(64, int(levels.sum()) * BITS_PER_EVENT)
    bits = np.zeros(-(-size // 8) * 8, np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for at in _bits_of(keys[levels >= level], level, U(size)):
            bits[at] = 1
    return size, np.packbits(bits, bitorder="little")


def _low(level: np.ndarray) -> np.ndarray:
    """The least count of a level, 0 for level 0."""
    return np.floor(np.exp2(level - 1.0))


def _high(level: np.ndarray) -> np.ndarray:
    """The largest count of a level, 0 for level 0."""
    return np.exp2(level.astype(np.float64)) - 1


def _carried(keys: np.ndarray, shift: np.uint64) -> np.ndarray:
    """Keys as runs carry them: the bucket and the low 48 bits."""
    return ((keys >> shift) << shift) | (keys & U((1 << 48) - 1))


class LogFrequencyFilter:
    """The whole filter: segments side by side, found by the top bits of the key."""

    def __init__(self, bucket_bits: int, sizes: np.ndarray, starts: np.ndarray, data: np.ndarray):
        self.shift = U(64 - bucket_bits)
        self.sizes, self.starts, self.data = sizes, starts, data

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels found of each key, 0 where level 1 is absent; each different key is probed once."""
        keys, place = np.unique(_carried(keys, self.shift), return_inverse=True)
        level = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        for j in range(1, LEVELS + 1):
            key = keys[alive]
            bucket = (key >> self.shift).astype(np.int64)
            base, there = self.starts[bucket], np.ones(len(key), bool)
            for at in _bits_of(key, j, self.sizes[bucket]):
                there &= (self.data[base + (at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8)) & 1 == 1
            alive = alive[there]
            if not len(alive):
                break
            level[alive] = j
        return level[place]


def _by_bucket(key: np.ndarray, bucket_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets that the sorted keys fall into, where each bucket's keys begin, and the low 48 bits of all keys."""
    edges = np.searchsorted(key >> U(64 - bucket_bits), np.arange((1 << bucket_bits) + 1).astype(U))
    return np.flatnonzero(edges[1:] > edges[:-1]), edges, key.view(np.uint8).reshape(-1, 8)[:, :6]


def count_ngrams(texts: DataFrame, bucket_bits: int) -> DataFrame:
    """Packed runs of (bucket, keys, counts) of the column ``text``: low 48 bits of the sorted keys, then counts."""
    def run(batches):
        hasher, keys, counts, held = WordHasher(), [], [], 0

        def send():
            key, n = _merged(keys, counts)
            some, edges, low = _by_bucket(key, bucket_bits)
            for part in np.array_split(some, max(1, len(some) // 64)):
                yield pa.RecordBatch.from_arrays([
                    pa.array(part, pa.int32()),
                    pa.array([low[edges[b]:edges[b + 1]].tobytes() for b in part], pa.binary()),
                    pa.array([n[edges[b]:edges[b + 1]].astype(np.int32).tobytes() for b in part], pa.binary())],
                    names=["bucket", "keys", "counts"])

        for _, texts_ in slices(batches, "text", max_bytes=2 << 20):
            one, two = ngram_keys(_closed(hasher, texts_)[0])
            key, n = _merged([one, two], [np.ones(len(one) + len(two), np.int64)])
            keys.append(key)
            counts.append(n)
            held += len(key)
            if held > HELD_ENTRIES:
                key, n = _merged(keys, counts)
                keys[:], counts[:], held = [key], [n], len(key)
                if held > HELD_ENTRIES // 2:
                    yield from send()
                    keys.clear()
                    counts.clear()
                    held = 0
        if held:
            yield from send()

    # A run carries the bucket and the low 48 bits of its keys; bits between them count as zero everywhere.
    return texts.select("text").mapInArrow(run, "bucket int, keys binary, counts binary")


def unpack(bucket: int, keys: bytes, bucket_bits: int) -> np.ndarray:
    low = np.zeros((len(keys) // 6, 8), np.uint8)
    low[:, :6] = np.frombuffer(keys, np.uint8).reshape(-1, 6)
    return low.view(U).ravel() | (U(bucket) << U(64 - bucket_bits))


def build_segments(train: DataFrame, text: str = "text") -> tuple[DataFrame, int]:
    """The segments (bucket, size, bits) of the filter over all n-grams of the training texts, written, and the bits
    of a bucket."""
    spark = train.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket_bits = min(16, max(8, (4 * parts - 1).bit_length()))
    runs = count_ngrams(train.select(F.col(text).alias("text")), bucket_bits)

    def build(batches):
        at, keys, counts, pending = None, [], [], 0

        def done():
            key, n = _merged(keys, counts)
            size, bits = segment(key, n)
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([size], pa.int64()), pa.array([bits.tobytes()], pa.binary())],
                names=["bucket", "size", "bits"])

        for batch in batches:  # runs come bucket by bucket: one bucket is held at a time
            for bucket, key, n in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != at:
                    if at is not None:
                        yield done()
                    at, keys, counts, pending = bucket, [], [], 0
                keys.append(unpack(bucket, key, bucket_bits))
                counts.append(np.frombuffer(n, np.int32).astype(np.int64))
                pending += len(counts[-1])
                if pending > HELD_ENTRIES:
                    one, two = _merged(keys, counts)
                    keys, counts, pending = [one], [two], 0
        if at is not None:
            yield done()

    segments = runs.repartition(parts, "bucket").sortWithinPartitions("bucket") \
        .mapInArrow(build, "bucket int, size bigint, bits binary")
    return written(segments, "lm-segments"), bucket_bits


def load_filter(segments: DataFrame, bucket_bits: int) -> LogFrequencyFilter:
    """The whole filter in one place, for segments of ``FILTER_BYTES`` or less."""
    sizes, starts = np.full(1 << bucket_bits, 64, U), np.zeros(1 << bucket_bits, np.int64)
    data, at = [b"\0" * 8], 8  # buckets without n-grams share an empty segment
    for row in segments.toLocalIterator():
        sizes[row["bucket"]], starts[row["bucket"]] = row["size"], at
        data.append(bytes(row["bits"]))
        at += len(row["bits"])
    return LogFrequencyFilter(bucket_bits, sizes, starts, np.frombuffer(b"".join(data), np.uint8))


def _scores(levels, tokens: np.ndarray, n: np.ndarray, total: float) -> np.ndarray:
    """log10 probability of each text; ``levels`` gives the levels of keys."""
    one, two = ngram_keys(tokens)
    single = levels(one)
    before = np.concatenate([levels(ngram_keys(np.array([_END_HASH]))[0]), single[:-1]])
    first = np.cumsum(n) - n
    before[first] = before[0]
    history, own = _high(before), _low(single)
    pair = np.minimum(np.minimum(_low(levels(two)), own), history)
    return np.add.reduceat(np.log10((pair + MU * (own + 1) / total) / (history + MU)), first)


_LOADED: dict[str, tuple[LogFrequencyFilter, WordHasher]] = {}


def score_texts(df: DataFrame, segments: DataFrame, bucket_bits: int, n_tokens: int, n_distinct: int,
                text: str = "text", more: tuple | None = None) -> DataFrame:
    """All other columns of ``df`` and the log10 probability ``score`` of the text. ``more``: DDL of further columns and
    the function that makes them from the texts of a slice, in the worker that reads them anyway."""
    source = df.select(*[c for c in df.columns if c != text], F.col(text).alias("__text"))
    total = float(n_tokens + n_distinct + 1)
    bits = segments.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    fields, made = more or ("", lambda texts: [])
    if bits > 8 * FILTER_BYTES:
        return _score_by_bucket(source, segments, bucket_bits, total, fields, made)
    model = load_filter(segments, bucket_bits)
    shared = df.sparkSession.sparkContext.broadcast((bucket_bits, model.sizes, model.starts, model.data))
    token = uuid.uuid4().hex

    def run(batches):
        if token not in _LOADED:
            _LOADED.clear()
            _LOADED[token] = (LogFrequencyFilter(*shared.value), WordHasher())
        filt, hasher = _LOADED[token]
        for part, texts in slices(batches, "__text", max_bytes=1 << 20):
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *made(texts), pa.array(_scores(filt.levels, *_closed(hasher, texts), total), pa.float64())],
                schema=target)

    schema = extended(source, fields + "score double")
    target = to_arrow_schema(schema)
    return source.mapInArrow(run, schema)


def _score_by_bucket(source: DataFrame, segments: DataFrame, bucket_bits: int, total: float, fields: str, made) -> DataFrame:
    """``score_texts`` by a filter of any size. A slice of texts asks each bucket once for its distinct n-grams, so a
    frequent n-gram costs a bucket one key a slice; a task holds one segment or one slice at a time."""
    parts = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shift = U(64 - bucket_bits)
    wide = extended(source, fields + "__text string")
    keep, target = wide.names[:-1], to_arrow_schema(wide)

    def asked(tokens):
        return np.unique(_carried(np.concatenate(ngram_keys(tokens)), shift))

    def ask(batches):
        hasher = WordHasher()
        for part, texts in slices(batches, "__text"):
            own = uuid.uuid4().int >> 65
            names = [*target.names, "__slice", "__bucket", "__keys"]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *made(texts), part.columns[-1], pa.array([own] * len(texts), pa.int64()), pa.nulls(len(texts), pa.int32()),
                 pa.nulls(len(texts), pa.binary())], names=names)
            some, edges, low = _by_bucket(asked(_closed(hasher, texts)[0]), bucket_bits)
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(len(some), f.type) for f in target], pa.array([own] * len(some), pa.int64()),
                 pa.array(some, pa.int32()), pa.array([low[edges[b]:edges[b + 1]].tobytes() for b in some], pa.binary())],
                names=names)

    def answer(batches):
        at, held = None, None
        for batch in batches:
            out = []
            for bucket, own, size, data in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None:  # a bucket's segment comes before its questions
                    at, held = bucket, LogFrequencyFilter(bucket_bits, np.full(1 << bucket_bits, size, U), np.zeros(
                        1 << bucket_bits, np.int64), np.frombuffer(data, np.uint8))
                    continue
                keys = unpack(bucket, data, bucket_bits)
                level = held.levels(keys) if at == bucket else np.zeros(len(keys))
                out.append((own, bucket, level.astype(np.uint8).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int64(), pa.int32(), pa.binary()))], names=["slice", "bucket", "levels"])

    def score(texts, answers):
        tokens, n = _closed(WordHasher(), [t or "" for t in texts.column("__text").to_pylist()])
        keys, found = asked(tokens), sorted(zip(*(answers.column(c).to_pylist() for c in ("bucket", "levels"))))
        level = np.frombuffer(b"".join(x for _, x in found), np.uint8).astype(np.int64)
        scores = _scores(lambda k: level[np.searchsorted(keys, _carried(k, shift))], tokens, n, total)
        return pa.table([*[texts.column(c) for c in keep], pa.array(scores, pa.float64())], names=[*keep, "score"])

    scored = StructType([*wide.fields[:-1], StructField("score", DoubleType())])

    nullable = StructType([StructField(f.name, f.dataType) for f in [
        *wide.fields, *StructType.fromDDL("__slice bigint, __bucket int, __keys binary").fields]])
    table = written(source.mapInArrow(ask, nullable), "lm-slices")
    questions = table.where("__bucket is not null").select(
        F.col("__bucket").alias("bucket"), F.col("__slice").alias("slice"), F.lit(None).cast("bigint").alias("size"),
        F.col("__keys").alias("bits"))
    answers = segments.select("bucket", F.lit(None).cast("bigint").alias("slice"), "size", "bits") \
        .unionByName(questions).repartition(parts, "bucket").sortWithinPartitions("bucket", F.asc_nulls_first("slice")) \
        .mapInArrow(answer, "slice bigint, bucket int, levels binary")
    return table.where("__bucket is null").groupBy("__slice").cogroup(answers.groupBy("slice")) \
        .applyInArrow(score, scored)


def count_words(train: DataFrame, text: str = "text") -> DataFrame:
    """(word, c): how often each word of the training texts occurs; words as UTF-8 with A-Z lowered."""
    def run(batches):
        total = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
                                               names=["word", "c"])
            total.clear()
            return batch

        for _, texts in slices(batches, "__text"):
            for t in texts:
                total.update(t.encode().lower().split())  # bytes: A-Z only, split at the blanks of the contract
                if len(total) >= COUNTED:
                    yield out()
        yield out()

    return train.select(F.col(text).alias("__text")).mapInArrow(run, "word binary, c bigint") \
        .groupBy("word").agg(F.sum("c").alias("c"))


BASE_COLUMNS = "__row bigint, n_tokens bigint, __known bigint, __sum double, __other array<struct<word: binary, k: bigint>>, "


def base_sums(spark: SparkSession, head: dict[bytes, int], ends: int):
    """The function that gives, for every text: a row number, n_tokens, how many tokens are among ``head`` (word to
    count; the end token occurs ``ends`` times), the sum of log10(c + 1) over those, and its other words with their
    numbers. Row numbers are random, and kept by the table that the rows are written to."""
    shared = spark.sparkContext.broadcast({w: math.log10(c + 1) for w, c in head.items()})
    types = [f.type for f in to_arrow_schema(StructType.fromDDL(BASE_COLUMNS.rstrip(", ")))]
    end = math.log10(ends + 1)

    def made(texts):
        logs, own, rows = shared.value.get, uuid.uuid4().int >> 65 & ~0xFFFFFF, []
        for k, t in enumerate(texts):
            words = t.encode().lower().split()
            known, total, other = int(ends > 0), end, []
            for w, n in Counter(words).items():
                log = logs(w)
                if log is None:
                    other.append({"word": w, "k": n})
                else:
                    known, total = known + n, total + n * log
            rows.append((own + k, len(words) + 1, known, total, other))
        return [pa.array(c, t) for c, t in zip(zip(*rows), types)]

    return made


def score_documents(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens, base_score, score. ``train`` tells the
    rows to learn from."""
    rows = docs.select(F.col(key).alias("__key"), F.coalesce(train, F.lit(False)).alias("__train"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    learnt = rows.where("__train")
    vocab = written(count_words(learnt), "lm-words")
    n, v = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = learnt.count()
    n, v = n + ends, v + (ends > 0)
    head = {bytes(r.word): r.c for r in vocab.orderBy(F.desc("c"), "word").limit(HEAD_WORDS).collect()}
    segments, bucket_bits = build_segments(learnt)
    base = BASE_COLUMNS, base_sums(docs.sparkSession, head, ends)
    scored = written(score_texts(rows, segments, bucket_bits, n, v, more=base), "lm-scores")
    other = scored.select("__row", F.inline("__other")).join(vocab, "word", "left").groupBy("__row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("__s"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("k"))).alias("__k"))
    d = math.log10(n + v + 1)
    return scored.join(other, "__row", "left").select(
        F.col("__key").alias(key), (~F.col("__train")).alias("held_out"), "n_tokens",
        (F.col("__known") + F.coalesce("__k", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("__sum") + F.coalesce("__s", F.lit(0.0)) - F.col("n_tokens") * d).alias("base_score"), "score")
