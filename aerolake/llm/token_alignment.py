"""Alignment of two tokenizations of the same texts: a byte-level BPE (A) and a SentencePiece model (B).

Both tokenizations cover the bytes of a blank and the text. Byte offsets where a token of A and a token of B both end
are cuts; they part the tokens into groups, and the two tokens that end at a cut are linked.

*Units.* A text is cut at every single blank between two visible characters of ASCII or Latin-1, where both tokenizers
surely begin a new token: A's pattern starts a match at such a blank, and no piece of B holds a blank after
something else (checked on the vocabulary). So units are encoded and aligned alone, a seam is always a cut, equal
units have equal tokens and links, and each task keeps a bounded table of the units it has aligned.

*Lockstep merging.* One NumPy state vector holds, for every new unit of a batch of texts, a pointer into A's token ends and one
into B's. Each step compares the two ends of all units at once, emits a cut and its link where they are equal, advances
the pointer of the smaller end (both when equal), and drops units that have reached their end.

*Counts of id pairs.* Two linked tokens end at the same byte of the same bytes, so the bytes of one are a suffix of
the bytes of the other. That bounds the id pairs by the two vocabularies alone (324,300 for the
vocabularies used here), whatever the corpus: tasks count into an array of that length, one aggregation adds them
up, and the result is small enough to be broadcast for the second pass. That pass reads the links of each text from
a written table, so no text is encoded twice.

Edge cases: texts that are null, empty, or whose joined bytes in A or B differ from blank and text (a U+2581 in the
text) have no tokens; their counts are 0 and their digest is the empty string. Rows are independent except for the
counts of id pairs, in which repeated rows count again; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.arrow import extended, slices
from aerolake.llm.byte_bpe import byte_characters
from aerolake.llm.common import written

MARK = "▁"
# Text characters whose units are encoded and aligned at a time.
BATCH_CHARS = 1 << 20
# Characters of units that a task remembers; the table starts anew beyond it, which costs time, never results.
REMEMBERED = 4 << 20
SEAM = re.compile("(?<=[!-~À-ÿ]) (?=[!-~À-ÿ])")


class Aligner:
    """Both tokenizers, their tokens' bytes, and the id pairs that can be linked at all."""

    def __init__(self, a_file: str, b_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        shape = json.loads(a_file)
        cutter = shape["pre_tokenizer"] or {}
        if cutter.get("type") != "ByteLevel" or not cutter.get("use_regex") or shape["normalizer"]:
            raise ValueError("A must be a byte-level BPE that cuts texts by its own pattern")
        self.a = Tokenizer.from_str(a_file)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sp = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        of_char = {ch: i for i, ch in enumerate(byte_characters())}
        a_spelled = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            a_spelled[i] = bytes(of_char[ch] for ch in token) if all(ch in of_char for ch in token) else token.encode()
        b_spelled = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            b_spelled.append(bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else
                             b"" if sp.is_control(i) else piece.replace(MARK, " ").encode())
        self.splits = sp.normalize("x y") == f"{MARK}x{MARK}y" and \
            not any(re.search(f"[^{MARK}]{MARK}", sp.id_to_piece(i)) for i in range(sp.get_piece_size()))
        self.a_size, self.a_at, self.a_bytes = self._flat(a_spelled)
        self.b_size, self.b_at, self.b_bytes = self._flat(b_spelled)
        self.n_b = len(b_spelled)
        self.keys = self._linkable(a_spelled, b_spelled)
        self.names = [[f"{i}{mark}" for i in range(max(len(a_spelled), self.n_b))] for mark in ",|;"]
        self.name_size = np.array([len(x) for x in self.names[0]], np.int64)
        self.forget()

    @staticmethod
    def _flat(spelled: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(s) for s in spelled], np.int64)
        return size, np.cumsum(size) - size, np.frombuffer(b"".join(spelled), np.uint8)

    def _linkable(self, a_spelled: list[bytes], b_spelled: list[bytes]) -> np.ndarray:
        """Sorted keys of the id pairs of which one's bytes are a suffix of the other's."""
        b_of, a_of = {}, {}
        for table, spelled in ((a_of, a_spelled), (b_of, b_spelled)):
            for i, s in enumerate(spelled):
                if s:
                    table.setdefault(s, []).append(i)
        keys = {a * self.n_b + b for s, ids in a_of.items() for k in range(len(s)) for b in b_of.get(s[k:], ())
                for a in ids}
        keys |= {a * self.n_b + b for s, ids in b_of.items() for k in range(1, len(s)) for a in a_of.get(s[k:], ())
                 for b in ids}
        return np.array(sorted(keys), np.int64)

    def forget(self) -> None:
        """An empty table of units: number by unit; digest text and arrays by number."""
        self.known: dict[str, int] = {}
        self.held, self.text, self.bad = 0, [], np.zeros(0, bool)
        self.flat = {c: np.zeros(0, np.int32) for c in ("a", "b", "cut_a", "cut_b", "pair")}
        self.at = {c: np.zeros(1, np.int64) for c in self.flat}

    def parts(self, text: str) -> Iterator[list[str]]:
        """Units of a text, about ``BATCH_CHARS`` characters at a time."""
        start = 0
        while self.splits and len(text) - start > BATCH_CHARS:
            seam = SEAM.search(text, start + BATCH_CHARS)
            if not seam:
                break
            yield SEAM.split(text[start:seam.start()])
            start = seam.end()
        rest = text[start:] if start else text
        yield SEAM.split(rest) if self.splits else [rest]

    def numbers(self, parts: list[list[str]]) -> list[list[int]]:
        """Numbers of all units; those not in the table are aligned together and added."""
        if self.held > REMEMBERED:
            self.forget()
        known = self.known
        new = list({u for part in parts for u in part if u not in known})
        if new:
            al = self.align(new)
            known.update(zip(new, range(len(self.text), len(self.text) + len(new))))
            self.held += sum(map(len, new))
            self.text += [t[:-1] for t in self.spelled(al)]
            self.bad = np.concatenate([self.bad, al.bad])
            for c, values, count in (("a", al.ids[0], al.count[0]), ("b", al.ids[1], al.count[1]), ("cut_a", al.cut_a, al.cuts),
                                     ("cut_b", al.cut_b, al.cuts), ("pair", self.pairs(al), al.cuts)):
                if c in ("cut_a", "cut_b"):  # tokens of the unit up to the cut
                    tokens = al.count[c == "cut_b"]
                    values = values + 1 - np.repeat(np.cumsum(tokens) - tokens, count)
                self.flat[c] = np.concatenate([self.flat[c], values.astype(np.int32)])
                self.at[c] = np.concatenate([self.at[c], self.at[c][-1] + np.cumsum(count)])
        return [[known[u] for u in part] for part in parts]

    def gather(self, column: str, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The column of the units one after another, and its length per unit."""
        at = self.at[column]
        n = at[units + 1] - at[units]
        return self.flat[column][np.repeat(at[units] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], n

    @staticmethod
    def _raw(ids: np.ndarray, size: np.ndarray, at: np.ndarray, raw: np.ndarray) -> np.ndarray:
        n = size[ids]
        return raw[np.repeat(at[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]

    def align(self, units: list[str]) -> "Aligned":
        """Tokens and cuts of all units; units whose joined bytes differ from blank and text are marked as bad."""
        bodies = [(" " + u).encode() for u in units]
        want = np.frombuffer(b"".join(bodies), np.uint8)
        length = np.array([len(b) for b in bodies], np.int64)
        out = Aligned(len(units))
        bad = np.zeros(len(units), bool)
        encoded = ([e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)],
                   self.b.encode(units, num_threads=1))
        for side, size, at, raw in ((0, self.a_size, self.a_at, self.a_bytes), (1, self.b_size, self.b_at, self.b_bytes)):
            count = np.fromiter(map(len, encoded[side]), np.int64, len(units))
            ids = np.fromiter((i for row in encoded[side] for i in row), np.int32, int(count.sum()))
            ends = np.cumsum(size[ids])
            got = np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])])
            wrong = got != length
            if not wrong.any():
                differ = np.flatnonzero(self._raw(ids, size, at, raw) != want)
                wrong[np.searchsorted(np.cumsum(length), differ, side="right")] = True
            else:  # compare unit by unit those of the right length
                first = np.cumsum(count) - count
                for k in np.flatnonzero(~wrong).tolist():
                    wrong[k] = self._raw(ids[first[k]:first[k] + count[k]], size, at, raw).tobytes() != bodies[k]
            bad |= wrong
            out.ids[side], out.count[side] = ids, count
        for side, size in ((0, self.a_size), (1, self.b_size)):
            keep = np.repeat(~bad, out.count[side])
            out.ids[side] = out.ids[side][keep]
            out.count[side] = np.where(bad, 0, out.count[side])
            first = np.cumsum(out.count[side]) - out.count[side]
            ends = np.cumsum(size[out.ids[side]])
            base = np.concatenate([[0], ends])[first]
            out.ends[side] = ends - np.repeat(base, out.count[side])
        out.bad = bad
        out.cut_a, out.cut_b = lockstep(out.ends[0], out.count[0], out.ends[1], out.count[1])
        unit = np.repeat(np.arange(len(units)), out.count[0])
        out.cuts = np.bincount(unit[out.cut_a], minlength=len(units))
        return out

    def pairs(self, aligned: "Aligned") -> np.ndarray:
        """Number of the id pair of every link."""
        key = aligned.ids[0][aligned.cut_a].astype(np.int64) * self.n_b + aligned.ids[1][aligned.cut_b]
        at = np.searchsorted(self.keys, key)
        if len(key) and not (self.keys[np.minimum(at, len(self.keys) - 1)] == key).all():
            raise AssertionError("linked tokens must be suffixes of each other")
        return at.astype(np.int32)

    def spelled(self, aligned: "Aligned") -> list[str]:
        """``a1,a2|b1;a3|b2,b3;`` of every unit."""
        n = [len(aligned.ids[0]), len(aligned.ids[1])]
        if not n[0]:
            return [""] * len(aligned.bad)
        last = [np.zeros(k, bool) for k in n]
        last[0][aligned.cut_a] = last[1][aligned.cut_b] = True
        # Groups in order: the tokens of A in a group come after all tokens of B of the groups before it.
        cut_a, cut_b = np.concatenate([[-1], aligned.cut_a]) + 1, np.concatenate([[-1], aligned.cut_b]) + 1
        group = [np.cumsum(x) - x for x in last]
        place = [np.arange(n[0]) + cut_b[group[0]], np.arange(n[1]) + cut_a[group[1] + 1]]
        table, ids = np.zeros(n[0] + n[1], np.int64), np.zeros(n[0] + n[1], np.int64)
        ids[place[0]], ids[place[1]] = aligned.ids[0], aligned.ids[1]
        table[place[0]], table[place[1]] = last[0] * 1, last[1] * 2
        names = self.names
        whole = "".join([names[t][i] for t, i in zip(table.tolist(), ids.tolist())])
        ends = np.concatenate([[0], np.cumsum(self.name_size[ids])])[np.cumsum(aligned.count[0] + aligned.count[1])]
        starts = np.concatenate([[0], ends[:-1]])
        return [whole[s:e] for s, e in zip(starts.tolist(), ends.tolist())]


class Aligned:
    """Flat tokens of a batch of units: ids, byte ends and counts per side; token places of the cuts."""

    def __init__(self, units: int):
        self.ids, self.count, self.ends = [None, None], [None, None], [None, None]
        self.bad = np.zeros(units, bool)
        self.cut_a = self.cut_b = self.cuts = None


def lockstep(a_ends: np.ndarray, a_count: np.ndarray, b_ends: np.ndarray, b_count: np.ndarray):
    """Places in A and B of the tokens that end together, over all units at once. Both sides of a unit end at the same
    byte, so both pointers of a unit reach their end in the same step."""
    i, j = np.cumsum(a_count) - a_count, np.cumsum(b_count) - b_count
    stop = i + a_count
    live = a_count > 0
    i, j, stop = i[live], j[live], stop[live]
    found = []
    while len(i):
        a, b = a_ends[i], b_ends[j]
        same = a == b
        found.append((i[same], j[same]))
        i, j = i + (a <= b), j + (b <= a)
        live = i < stop
        if not live.all():  # compaction: finished units leave
            i, j, stop = i[live], j[live], stop[live]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at_a, at_b = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(at_a, kind="stable")
    return at_a[order], at_b[order]


_LOADED: dict[tuple, Aligner] = {}


def _loaded(key: tuple, a_file: str, b_model: bytes) -> Aligner:
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Aligner(a_file, b_model)
    return _LOADED[key]


def _aligned(aligner: Aligner, texts: list[str]) -> Iterator[tuple[list[int], list[list[int]]]]:
    """(row numbers, unit numbers of each) of parts of the texts in order; a long text may fill several parts. Unit
    numbers hold until the next turn."""
    rows, parts, held = [], [], 0
    for k, text in enumerate(texts):
        for part in aligner.parts(text) if text else ():
            rows.append(k)
            parts.append(part)
            held += min(len(text), BATCH_CHARS)
            if held >= BATCH_CHARS:
                yield rows, aligner.numbers(parts)
                rows, parts, held = [], [], 0
    if rows:
        yield rows, aligner.numbers(parts)


def _vocabularies(df: DataFrame, a_path: str, b_path: str):
    """Both files as broadcasts: vocabularies of fixed, small size."""
    sc = df.sparkSession.sparkContext
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return sc.broadcast(a.read()), sc.broadcast(b.read())


def _lists(rows: list[np.ndarray], kind=np.int32) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, kind), *rows]).astype(kind)))


def align(df: DataFrame, a_path: str, b_path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, the ids of both tokenizations, and for every cut how many tokens of A (``cut_a``) and of B
    (``cut_b``) lie before it: group g holds a_ids[cut_a[g-1]:cut_a[g]] and b_ids[cut_b[g-1]:cut_b[g]], and the last
    ones of both are linked."""
    a_file, b_model = _vocabularies(df, a_path, b_path)
    source = df.select(*keep, F.col(text).alias("__text"))

    def run(batches):
        aligner = _loaded((a_path, b_path), a_file.value, b_model.value)
        for part, texts in slices(batches, "__text", BATCH_CHARS):
            got, total, bad = [[[] for _ in texts] for _ in range(4)], np.zeros((2, len(texts)), np.int64), set()
            for rows, numbers in _aligned(aligner, texts):
                for k, own in zip(rows, numbers):
                    units = np.array(own)
                    if aligner.bad[units].any():
                        bad.add(k)
                    for side, (ids, cut) in enumerate((("a", "cut_a"), ("b", "cut_b"))):
                        tokens, n = aligner.gather(ids, units)
                        cuts, m = aligner.gather(cut, units)
                        got[side][k].append(tokens)
                        got[2 + side][k].append(cuts + np.repeat(np.cumsum(n) - n, m) + total[side][k])
                        total[side][k] += len(tokens)
            made = [_lists([np.concatenate(r) if r and k not in bad else np.zeros(0, np.int32) for k, r in enumerate(g)])
                    for g in got]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made],
                                             names=[*part.schema.names[:-1], "a_ids", "b_ids", "cut_a", "cut_b"])

    return source.mapInArrow(run, extended(source, "a_ids array<int>, b_ids array<int>, cut_a array<int>, cut_b array<int>"))


COUNTS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "


def _linked(df: DataFrame, a_path: str, b_path: str, a_file, b_model, keep, text: str) -> DataFrame:
    """First pass: counts and digest of each text, and its links as (number of the id pair, how often)."""
    source = df.select(*keep, F.col(text).alias("__text"))

    def run(batches):
        aligner = _loaded((a_path, b_path), a_file.value, b_model.value)
        for part, texts in slices(batches, "__text", BATCH_CHARS):
            n, bad = np.zeros((3, len(texts)), np.int64), set()
            links, sums, open_end = [[] for _ in texts], [hashlib.sha256() for _ in texts], [""] * len(texts)
            for rows, numbers in _aligned(aligner, texts):
                spelled = aligner.text
                for k, own in zip(rows, numbers):
                    units = np.array(own)
                    if aligner.bad[units].any():
                        bad.add(k)
                        continue
                    pairs, _ = aligner.gather("pair", units)
                    n[:, k] += [int((aligner.at[c][units + 1] - aligner.at[c][units]).sum()) for c in ("a", "b")] + [len(pairs)]
                    links[k].append(pairs)
                    sums[k].update((open_end[k] + ";".join([spelled[u] for u in own])).encode())
                    open_end[k] = ";"
            n[:, list(bad)] = 0
            counted = [np.unique(np.concatenate(x), return_counts=True) if x and k not in bad else
                       (np.zeros(0, np.int32), np.zeros(0, np.int64)) for k, x in enumerate(links)]
            digests = pa.array(["" if not n[2, k] else s.hexdigest() for k, s in enumerate(sums)], pa.string())
            columns = [pa.array(n[0]), pa.array(n[1]), pa.array(n[2]), pa.array(n[2]), digests,
                       _lists([p for p, _ in counted]), _lists([c for _, c in counted], np.int64)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *columns],
                names=[*part.schema.names[:-1], "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return source.mapInArrow(run, extended(source, COUNTS + "pairs array<int>, times array<bigint>"))


def pair_counts(linked: DataFrame, n_pairs: int) -> DataFrame:
    """(pair, n) over all rows: each task adds up its own rows in one array of the bounded length."""
    def run(batches):
        total = np.zeros(n_pairs, np.int64)
        for batch in batches:
            pairs, times = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
            np.add.at(total, pairs, times)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["pair", "n"])

    return linked.select("pairs", "times").mapInArrow(run, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def link_statistics(df: DataFrame, a_path: str, b_path: str, keep: tuple[str, ...] = ("doc_id",),
                    text: str = "text") -> DataFrame:
    """``keep`` columns, tokens of A and B, groups, links, how many links are their B id's most frequent ones over all
    rows, the sum of the links' corpus-wide counts, and the digest of the groups."""
    a_file, b_model = _vocabularies(df, a_path, b_path)
    aligner = Aligner(a_file.value, b_model.value)
    keys, n_b = aligner.keys, aligner.n_b
    linked = written(_linked(df, a_path, b_path, a_file, b_model, keep, text), "links")
    counts = pair_counts(linked, len(keys)).toArrow()  # at most len(keys) rows, a bound of the vocabularies
    total = np.zeros(len(keys), np.int64)
    total[counts.column("pair").to_numpy()] = counts.column("n").to_numpy()
    highest = np.zeros(n_b, np.int64)
    np.maximum.at(highest, keys % n_b, total)
    shared = df.sparkSession.sparkContext.broadcast((total, total == highest[keys % n_b]))
    source = linked.select(*keep, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")

    def run(batches):
        total, best = shared.value
        for batch in batches:
            size = batch.column(batch.num_columns - 2).value_lengths().to_numpy(zero_copy_only=False)
            pairs, times = (batch.column(batch.num_columns - k).flatten().to_numpy(zero_copy_only=False) for k in (2, 1))
            ends = np.concatenate([[0], np.cumsum(size)])
            made = [np.diff(np.concatenate([[0], np.cumsum(x)])[ends]) for x in (times * best[pairs], times * total[pairs])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *map(pa.array, made)],
                                             names=[*batch.schema.names[:-2], "n_best", "count_sum"])

    return source.mapInArrow(run, extended(source, "n_best bigint, count_sum bigint", 2)) \
        .select(*keep, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
