"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is normalised by the model's own rules and cut into words where no piece of the vocabulary reaches across, so
words never influence each other. The distinct words of a slice that the task has not seen yet become one flat NumPy
array of symbols. Each round looks up the rank of every neighbouring pair, takes the minimum of each segment, merges
the segments' leftmost best pairs all at once, and compacts the arrays, until no pair remains. Equal words share their
ids (a bounded table per task), so a text's ids are one gather over its words.

Several occurrences of a segment's best pair merge in one round only up to the first one that gives rise to a pair
of the same or a better rank; the library would merge that one next, so the later ones wait for the next round.
Segments that need one merge after another (long runs of blanks, whose pieces all have one score) would need as many
rounds as symbols; after ``ROUNDS`` rounds an agenda finishes them, merge by merge.

Characters without a piece become the pieces of their UTF-8 bytes. Decoding gathers the bytes of the pieces, drops
control ids and the one blank that encoding puts in front, and turns bytes that are no UTF-8 into U+FFFD each.

Edge cases: null and empty texts have the begin and end ids alone and decode to the empty text; rows are independent, so
repeated rows repeat; an empty table gives an empty result. Only named columns are kept. Models with pieces
marked unused or user-defined, or without byte pieces, are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.arrow import extended, slices

MARK = "▁"  # how the model writes a space
# Characters of words and ids that a task remembers; the table starts anew beyond it, which costs time, never results.
REMEMBERED = 16 << 20
# Longest word that is remembered; longer ones are merged each time.
LONGEST = 64
# Text bytes whose words are held at a time; longer texts go through in parts cut between words.
HELD_BYTES = 1 << 20
# Rounds after which segments that still have a pair are finished by the agenda.
ROUNDS = 64
NONE = np.int32(2**31 - 1)


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of all ranges [start, start + size), one after another."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(total)


class PieceBPE:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.size = sp.get_piece_size()
        raw = [i for i in range(n) if sp.is_byte(i)]
        if len(raw) != 256 or any(sp.is_unused(i) for i in range(n)):
            raise ValueError("only models with byte pieces and without unused pieces")
        text = {sp.id_to_piece(i): i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        score = {p: sp.get_score(i) for p, i in text.items()}
        place = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        # Symbols: pieces by id, then characters that only occur inside pieces.
        symbol = dict(text)
        for p in text:
            for ch in p:
                symbol.setdefault(ch, n + len(symbol) - len(text))
        self.spelling = {i: p for p, i in symbol.items()}
        self.width = max(symbol.values()) + 1
        self.of_char = np.full(0x110000, -1, np.int32)
        for p, i in symbol.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        pairs = {}
        for p, i in text.items():
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * self.width + b] = (place[score[p]], i)
        self.keys = np.array(sorted(pairs), np.int64)
        self.rank = np.array([pairs[k][0] for k in self.keys.tolist()] + [NONE], np.int32)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()] + [-1], np.int32)
        self.place_pairs()
        # Character pairs that some piece holds, over dense character numbers; a word is cut everywhere else.
        chars = sorted({ch for p in text for ch in p})
        self.dense = np.zeros(0x110000, np.int32)
        self.dense[[ord(ch) for ch in chars]] = np.arange(1, len(chars) + 1)
        self.touch = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in text:
            at = self.dense[[ord(ch) for ch in p]]
            self.touch[at[:-1], at[1:]] = True
        mark = self.dense[ord(MARK)]
        inner = self.touch[:, mark].copy()
        inner[mark] = False  # runs of blanks stay together
        self.words = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+" if not inner.any() else r"(?s).+").findall
        self.whole = bool(inner.any())
        # Bytes of every id; control ids and the unknown id have none here.
        self.byte_id = np.zeros(256, np.int32)
        spelled = [b""] * n
        for i in raw:
            value = int(sp.id_to_piece(i)[3:5], 16)
            self.byte_id[value], spelled[i] = i, bytes([value])
        for p, i in text.items():
            spelled[i] = p.replace(MARK, " ").encode()
        self.n_bytes = np.array([len(b) for b in spelled], np.int64)
        self.byte_at = np.cumsum(self.n_bytes) - self.n_bytes
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.is_byte = np.zeros(n, bool)
        self.is_byte[raw] = True
        self.unknown = sp.unk_id()
        self.unknown_text = sp.decode([self.unknown]).encode()
        self.prefixed = sp.normalize("x").startswith(MARK)  # the model puts a blank in front
        self.forget()

    # words

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.ids = np.zeros(0, np.int32)
        self.at = np.zeros(1, np.int64)

    def place_pairs(self) -> None:
        """Open addressing over the pair keys: each takes the first free slot from its own on."""
        self.shift = np.uint64(64 - max(4, int(4 * len(self.keys)).bit_length()))
        slots = 1 << (64 - int(self.shift))
        self.slot_key, self.slot_at = np.full(slots, -1, np.int64), np.full(slots, len(self.keys), np.int64)
        left, slot = np.arange(len(self.keys)), self.slot(self.keys)
        while len(left):
            free = np.flatnonzero(self.slot_key[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.slot_key[slot[won]], self.slot_at[slot[won]] = self.keys[left[won]], left[won]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, slot = left[rest], (slot[rest] + 1) % slots

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of each pair in the pair table; the last entry stands for no pair."""
        key = a.astype(np.int64) * self.width + b
        key[(a < 0) | (b < 0)] = -2
        out = np.full(len(key), len(self.keys), np.int64)
        at, slot = np.arange(len(key)), self.slot(key)
        while len(at):
            found = self.slot_key[slot]
            same = found == key[at]
            out[at[same]] = self.slot_at[slot[same]]
            on = ~same & (found >= 0)
            at, slot = at[on], (slot[on] + 1) % len(self.slot_key)
        return out

    def merge(self, sym: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols and their segments (ascending), by rounds over all segments at once. ``sym``: symbols, -1 for
        characters in no piece; ``seg``: ascending segment numbers."""
        done_sym, done_seg, place, done_place = [], [], np.arange(len(sym)), []
        for _ in range(ROUNDS):
            if not len(sym):
                break
            pair = np.full(len(sym), len(self.keys), np.int64)
            same = np.flatnonzero(seg[:-1] == seg[1:])
            pair[same] = self.lookup(sym[same], sym[same + 1])
            rank = self.rank[pair]
            first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
            of = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(sym)]])))
            best = np.minimum.reduceat(rank, first)
            live = (best != NONE)[of]
            if not live.all():  # compaction: finished segments leave
                done_sym.append(sym[~live])
                done_seg.append(seg[~live])
                done_place.append(place[~live])
                sym, seg, place, pair, rank, of = (x[live] for x in (sym, seg, place, pair, rank, of))
                if not len(sym):
                    break
            hit = rank == best[of]
            # Overlapping occurrences (a run of hits): every second one, from the left.
            at = np.flatnonzero(hit)
            opens = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (of[at[1:]] != of[at[:-1]])])
            run_start = at[opens][np.cumsum(opens) - 1]
            at = at[(at - run_start) % 2 == 0]
            new, mine = self.made[pair[at]], rank[at]
            # Ranks of the pairs that each merge gives rise to, in the order in which the library would see them.
            last = len(sym) - 1
            after = np.minimum(at + 2, last)
            right = np.where((at + 2 <= last) & (of[after] == of[at]), self.rank[self.lookup(new, sym[after])], NONE)
            before = np.maximum(at - 1, 0)
            left_sym = sym[before]
            chained = np.concatenate([[False], at[1:] == at[:-1] + 2])
            left_sym = np.where(chained, np.concatenate([[-1], new[:-1]]), left_sym)
            left = np.where((at > 0) & (of[before] == of[at]), self.rank[self.lookup(left_sym, new)], NONE)
            urgent = np.concatenate([[0], np.cumsum(np.minimum(left, right) <= mine)])
            owner = of[at]
            head = np.searchsorted(owner, owner)  # first occurrence of the same segment
            keep = urgent[:-1] == urgent[head]
            at, new = at[keep], new[keep]
            sym[at] = new
            gone = np.ones(len(sym), bool)
            gone[at + 1] = False
            sym, seg, place = sym[gone], seg[gone], place[gone]
        if len(sym):
            bounds = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1], [True]]))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                kept = self.agenda(sym[a:b].tolist())
                done_sym.append(np.array([s for _, s in kept], np.int32))
                done_place.append(place[a + np.array([k for k, _ in kept])])
                done_seg.append(np.full(len(kept), seg[a], seg.dtype))
        if not done_sym:
            return sym, seg
        order = np.argsort(np.concatenate(done_place), kind="stable")
        return np.concatenate(done_sym)[order], np.concatenate(done_seg)[order]

    def agenda(self, sym: list[int]) -> list[tuple[int, int]]:
        """(place, symbol) left of one segment by single merges, best rank first, leftmost first."""
        n = len(sym)
        nxt, prev, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def push(pairs):
            if pairs:
                a, b = np.array([sym[i] for i, _ in pairs], np.int64), np.array([sym[j] for _, j in pairs], np.int64)
                for (i, j), at in zip(pairs, self.lookup(a, b).tolist()):
                    if at < len(self.keys):
                        heapq.heappush(heap, (int(self.rank[at]), i, j, sym[i], sym[j], int(self.made[at])))

        push([(i, i + 1) for i in range(n - 1)])
        while heap:
            _, i, j, a, b, made = heapq.heappop(heap)
            if sym[i] != a or sym[j] != b or nxt[i] != j:
                continue
            sym[i], sym[j], nxt[i] = made, -2, nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
            push([(x, y) for x, y in ((prev[i], i), (i, nxt[i])) if x >= 0 and y < n])
        return [(i, s) for i, s in enumerate(sym) if s != -2]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and ids per word."""
        sizes = np.array([len(w) for w in words], np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sym, word = self.of_char[code], np.repeat(np.arange(len(words)), sizes)
        kind = self.dense[code]
        cut = np.ones(len(code), bool)
        cut[1:] = (word[1:] != word[:-1]) | ~self.touch[kind[:-1], kind[1:]]
        seg = np.cumsum(cut) - 1
        # Symbols that are no characters of the vocabulary carry their code point as a negative number.
        sym = np.where(sym < 0, -1 - code.astype(np.int64), sym)
        word_of_seg = word[cut]
        sym, seg = self.merge(sym, seg)
        word = word_of_seg[seg]
        odd = np.flatnonzero((sym < 0) | (sym >= self.size))
        if len(odd):  # no piece: the pieces of its bytes
            raw = [np.frombuffer((chr(-1 - s) if s < 0 else self.spelling[s]).encode(), np.uint8)
                   for s in sym[odd].tolist()]
            size = np.ones(len(sym), np.int64)
            size[odd] = [len(r) for r in raw]
            start = np.cumsum(size) - size
            out = np.repeat(sym, size)
            out[spread(start[odd], size[odd])] = self.byte_id[np.concatenate(raw)]
            sym, word = out, np.repeat(word, size)
        return sym.astype(np.int32), np.bincount(word, minlength=len(words))

    # texts

    def parts(self, text: str) -> Iterator[list[str]]:
        """Words of a text; a long text in parts, cut where a blank follows something else."""
        norm = self.sp.normalize(text) if text else ""
        start = 0
        while len(norm) - start > HELD_BYTES and not self.whole:
            end = norm.find(MARK, start + HELD_BYTES)
            while end > 0 and norm[end - 1] == MARK:
                end = norm.find(MARK, end + 1)
            if end < 0:
                break
            yield self.words(norm[start:end])
            start = end
        yield self.words(norm[start:] if start else norm)

    def encode(self, rows: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all word lists, one after another, and ids per list."""
        known = self.known
        new = list({w for row in rows for w in row if w not in known})
        if new and self.held > REMEMBERED:
            self.forget()
            known = self.known
            new = list({w for row in rows for w in row})
        held = len(self.at) - 1
        if new:
            ids, count = self.encode_words(new)
            self.ids = np.concatenate([self.ids, ids])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(count)])
            known.update(zip(new, range(held, held + len(new))))
            self.held += sum(map(len, new)) + 4 * len(ids)
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        word = np.fromiter((known[w] for row in rows for w in row), np.int64, int(sizes.sum()))
        count = self.at[word + 1] - self.at[word]
        ids = self.ids[spread(self.at[word], count)]
        ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum(sizes)]
        if any(len(w) > LONGEST for w in new):
            long = [w for w in new if len(w) > LONGEST]
            for w in long:
                del known[w]
        return ids, np.diff(np.concatenate([[0], ends]))

    def slices_of(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """(row numbers, ids, ids per row) of parts of the texts in order; a row may come several times in a row."""
        rows, words, held = [], [], 0
        for k, text in enumerate(texts):
            for part in self.parts(text):
                rows.append(k)
                words.append(part)
                held += min(len(text), HELD_BYTES)
                if held >= HELD_BYTES:
                    yield (rows, *self.encode(words))
                    rows, words, held = [], [], 0
        if rows:
            yield (rows, *self.encode(words))

    def raw(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids one after another (no control ids, no unknown id)."""
        return self.bytes[spread(self.byte_at[ids], self.n_bytes[ids])]

    def decode(self, ids: list[int]) -> str:
        """Text of any ids, as the library gives it."""
        out, pending, seen = [], bytearray(), False

        def flush():
            at = 0
            while at < len(pending):
                for k in (1, 2, 3, 4):
                    try:
                        out.append(bytes(pending[at:at + k]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    k = 1
                at += k
            pending.clear()

        for i in ids:
            if self.is_byte[i]:
                pending += self.raw(np.array([i])).tobytes()
                continue
            flush()
            if i == self.unknown:
                out.append(self.unknown_text.decode())
                continue
            text = self.raw(np.array([i])).tobytes().decode()
            if self.prefixed and not seen and not any(out) and text.startswith(" "):
                text, seen = text[1:], True
            out.append(text)
        flush()
        return "".join(out)


_LOADED: dict[str, PieceBPE] = {}


def loaded(path: str, model: bytes) -> PieceBPE:
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = PieceBPE(model)
    return _LOADED[path]


def read_model(df: DataFrame, path: str):
    """The model file as a broadcast: a vocabulary of fixed, small size."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, model_path: str, begin: bool = True, end: bool = True, keep: tuple[str, ...] = ("doc_id",),
           text: str = "text") -> DataFrame:
    """``keep`` columns and the ``ids`` of every text."""
    model = read_model(df, model_path)
    source = df.select(*keep, F.col(text).alias("__text"))

    def run(batches):
        bpe = loaded(model_path, model.value)
        for part, texts in slices(batches, "__text", HELD_BYTES):
            made = [[np.array([bpe.sp.bos_id()] * begin, np.int32)] for _ in texts]
            for rows, ids, count in bpe.slices_of(texts):
                for k, some in zip(rows, np.split(ids, np.cumsum(count)[:-1])):
                    made[k].append(some)
            rows = [np.concatenate([*m, np.array([bpe.sp.eos_id()] * end, np.int32)]) for m in made]
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], column], names=[*part.schema.names[:-1], "ids"])

    return source.mapInArrow(run, extended(source, "ids array<int>"))


def decode(df: DataFrame, model_path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the decoded ``text`` of every list of ids; a null list gives the empty text."""
    model = read_model(df, model_path)
    source = df.select(*keep, F.col(ids).alias("__ids"))

    def run(batches):
        bpe = loaded(model_path, model.value)
        for batch in batches:
            texts = [bpe.decode(x or []) for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())],
                                             names=[*batch.schema.names[:-1], "text"])

    return source.mapInArrow(run, extended(source, "text string"))


def round_trip_digest(df: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",),
                      text: str = "text") -> DataFrame:
    """``keep`` columns, number of ids with begin and end, digest of the ids as little-endian 32-bit integers, and digest
    of the text decoded from those ids."""
    model = read_model(df, model_path)
    source = df.select(*keep, F.col(text).alias("__text"))

    def run(batches):
        bpe = loaded(model_path, model.value)
        begin, end = (np.array([i], "<u4").tobytes() for i in (bpe.sp.bos_id(), bpe.sp.eos_id()))
        for part, texts in slices(batches, "__text", HELD_BYTES):
            n = np.full(len(texts), 2, np.int64)
            id_sums, text_sums, fresh = [hashlib.sha256(begin) for _ in texts], [hashlib.sha256() for _ in texts], [True] * len(texts)
            for rows, ids, count in bpe.slices_of(texts):
                written = memoryview(ids.astype("<u4").tobytes())
                size = bpe.n_bytes[ids]
                raw = memoryview(bpe.raw(ids).tobytes())
                at = np.concatenate([[0], np.cumsum(count)])
                byte_at = np.concatenate([[0], np.cumsum(size)])[at].tolist()
                at = at.tolist()
                for j, k in enumerate(rows):
                    n[k] += at[j + 1] - at[j]
                    id_sums[k].update(written[4 * at[j]:4 * at[j + 1]])
                    start = byte_at[j]
                    if fresh[k] and at[j + 1] > at[j]:  # the blank that encoding put in front
                        start += bpe.prefixed and raw[start:start + 1] == b" "
                        fresh[k] = False
                    text_sums[k].update(raw[start:byte_at[j + 1]])
            for s in id_sums:
                s.update(end)
            digests = [pa.array([s.hexdigest() for s in sums], pa.string()) for sums in (id_sums, text_sums)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(n), *digests],
                                             names=[*part.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(run, extended(source, "n_tokens bigint, ids_sha256 string, decoded_sha256 string"))
