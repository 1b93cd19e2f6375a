"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Texts are cut by the vocabulary's pattern, each match is mapped byte by byte to the 256 printable characters of
the byte-level alphabet, and the library's BPE model merges those characters by rank. Because matches are
encoded separately, equal matches have equal ids: each task keeps a bounded table of matches it has seen and
asks the library's model only for new ones, by its tokens and without the encoding object (offsets, masks, words)
that its tokenizer builds for each. The ids kept are the vocabulary's own int objects, one each, which makes look-ups
by them cheap. Offsets come from the pieces' byte lengths, so they are exact even where a token holds part of a
character; only ``encode`` gives them, the round trip digest does not compute any. Decoding reverses the byte table:
the characters of each id's vocabulary entry go back to their bytes, which are joined before they become text, so
characters split over tokens come back whole. The entries are turned back once per task, not once per token.

Edge cases: null and empty texts have no ids and decode to the empty byte string; rows are independent, so
repeated rows repeat; an empty table gives an empty result. Only named columns are kept.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from aerolake.llm.arrow import extended, slices

# Matches that a task remembers; the table starts anew beyond it, which costs time, never results.
REMEMBERED = 100_000
# Text bytes whose matches are held at a time, unless one text alone is longer.
HELD_BYTES = 1 << 19


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: visible Latin-1 bytes stand for themselves, the
    others take the code points from 256 on in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, free = [], 256
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (``base64 rank`` lines): a vocabulary of fixed, small size."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class ByteBPE:
    """Encoder and decoder over one vocabulary of ranks. Built once per task from the plain rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        from tokenizers import models

        self.chars = byte_characters()
        vocab = {self._spelled(t): i for t, i in ranks.items()}
        byte_of = {c: b for b, c in enumerate(self.chars)}
        self.pieces = {i: bytes([byte_of[c] for c in spelled]) for spelled, i in vocab.items()}
        self.names = {i: str(i) for i in self.pieces}
        self.find = regex.compile(pattern).findall
        self.own = {i: i for i in self.names}
        self.model = models.BPE(vocab=vocab, merges=self._merges(ranks), ignore_merges=True)
        self.known: dict[str, tuple[int, ...]] = {}

    def _spelled(self, token: bytes) -> str:
        return "".join([self.chars[b] for b in token])

    def _merges(self, ranks: dict[bytes, int]) -> list[tuple[str, str]]:
        """The two parts whose merge makes each token: what is left of its bytes when every merge of a lower
        rank has been applied."""
        merges = []
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                continue
            parts = [token[i:i + 1] for i in range(len(token))]
            while len(parts) > 2:
                at, best = min(((i, ranks.get(parts[i] + parts[i + 1], rank)) for i in range(len(parts) - 1)),
                               key=lambda x: x[1])
                if best >= rank:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2:
                merges.append((self._spelled(parts[0]), self._spelled(parts[1])))
        return merges

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        known, own, tokenize, matches = self.known, self.own, self.model.tokenize, [self.find(t) for t in texts]
        new = set().union(*matches).difference(known)
        if new and len(known) + len(new) > REMEMBERED:
            known.clear()
            new = set().union(*matches)
        for m in new:
            known[m] = tuple([own[t.id] for t in tokenize(self._spelled(m.encode()))])
        return [list(chain.from_iterable([known[m] for m in row])) for row in matches]

    def offsets(self, text: str, ids: list[int]) -> list[tuple[int, int]]:
        """Character span of each id: from the character its first byte belongs to, to the one after the
        character of its last byte. Tokens that share a split character overlap on it."""
        at = [0]
        for ch in text:
            at.append(at[-1] + len(ch.encode()))
        of_byte = [i for i in range(len(text)) for _ in range(at[i + 1] - at[i])]
        spans, pos = [], 0
        for i in ids:
            end = pos + len(self.pieces[i])
            spans.append((of_byte[pos], of_byte[end - 1] + 1))
            pos = end
        return spans

    def spelled_ids(self, ids: list[int]) -> str:
        """Decimal ids joined by one space."""
        names = self.names
        return " ".join([names[i] for i in ids])

    def decode_bytes(self, ids: list[int]) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in ids])


_LOADED: dict[tuple, ByteBPE] = {}


def _loaded(key: tuple, ranks: dict[bytes, int], pattern: str) -> ByteBPE:
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBPE(ranks, pattern)
    return _LOADED[key]


def _tasks(df: DataFrame, rank_path: str, pattern: str, row, fields: str, keep: list[str], text: str) -> DataFrame:
    """Run ``row(bpe, text, ids) -> tuple`` over every text; ``fields`` is the DDL of the tuple."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(spark, rank_path))
    source = df.select(*keep, F.col(text).alias("__text"))
    schema = extended(source, fields)
    target = to_arrow_schema(schema)

    def run(batches):
        bpe = _loaded((rank_path, pattern), shared.value, pattern)
        for part, texts in slices(batches, "__text", HELD_BYTES):
            made = list(zip(*(row(bpe, t, ids) for t, ids in zip(texts, bpe.encode(texts)))))
            columns = [part.column(i) for i in range(len(keep))]
            columns += [pa.array(c, type=target.field(len(keep) + i).type) for i, c in enumerate(made)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target)], schema=target)

    return source.mapInArrow(run, schema)


def encode(df: DataFrame, rank_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",),
           text: str = "text") -> DataFrame:
    """``keep`` columns, ``ids`` and the character ``offsets`` of every text."""
    return _tasks(df, rank_path, pattern, lambda b, t, ids: (ids, [{"s": s, "e": e} for s, e in b.offsets(t, ids)]),
                  "ids array<int>, offsets array<struct<s: int, e: int>>", list(keep), text)


def decode(df: DataFrame, rank_path: str, pattern: str, ids: str = "ids",
           keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, decoded ``bytes`` and ``text`` (bytes that are no UTF-8 become U+FFFD)."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(spark, rank_path))

    def run(batches):
        bpe = _loaded((rank_path, pattern), shared.value, pattern)
        for batch in batches:
            raw = [bpe.decode_bytes(x or []) for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))]
                + [pa.array(raw, pa.binary()), pa.array([r.decode("utf-8", "replace") for r in raw], pa.string())],
                names=[*keep, "bytes", "text"])

    source = df.select(*keep, ids)
    return source.mapInArrow(run, extended(source, "bytes binary, text string"))


def round_trip_digest(df: DataFrame, rank_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",),
                      text: str = "text") -> DataFrame:
    """``keep`` columns, token count, digest of the ids, digest of the bytes decoded from those ids, and whether
    they are the text's bytes."""
    def row(bpe, t, ids):
        back = bpe.decode_bytes(ids)
        return (len(ids), hashlib.sha256(bpe.spelled_ids(ids).encode()).hexdigest(),
                hashlib.sha256(back).hexdigest(), back == t.encode())

    return _tasks(df, rank_path, pattern, row,
                  "n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean", list(keep), text)
