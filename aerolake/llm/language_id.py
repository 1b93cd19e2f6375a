"""Language identification by cross-parsing against suffix automata of labelled text.

For each language a suffix automaton of a bounded sample of its labelled text recognises every substring of the
sample. A text is cut greedily into phrases, each the longest match of the automaton from where it starts; the
closer the text is to the sample, the longer the phrases and the fewer of them. Phrase counts are normalised by
the bits that a pointer into the sample takes (log2 of its length); the language with the least cost wins, ties go
to the first in order. The score is the margin ``1 - best / second`` (1 with a single language), in [0, 1].

Texts are read as letters and single blanks for everything between words. Every language reads letters its own way:
each letter of its sample is a symbol, all others are one foreign symbol that no phrase holds. Where a sample has
more than ``CLASSES`` different letters (Han, kana, syllables), the frequent ones keep their own symbols and the others
share ``SHARED`` symbols by code point. Long texts are parsed in blocks of ``BLOCK`` symbols, whose phrases add up, so
that many blocks run side by side as vectors; the automaton is a dense table, one row per state.

Training reads only the rows passed as ``labelled`` and takes at most ``SAMPLE_SYMBOLS`` symbols of each language, from
the first characters of about ``SAMPLE_DOCS`` different texts chosen by their hash (documented bounds). Every label is
learned: models are made in groups of ``MODEL_BYTES`` of tables, and texts are parsed group by group, carrying the
best two costs. Prediction reads whole texts and nothing else.

Edge cases: null texts and texts without a letter are ``und`` with score 0, as is everything where no language
was learned; null labels teach nothing; repeated rows repeat; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.arrow import extended, slices

UNDETERMINED = "und"
SAMPLE_SYMBOLS = 16_384  # most symbols of labelled text in one language's automaton
SAMPLE_DOCS = 64  # expected labelled texts read for a language's sample
SAMPLE_CHARS = 262_144  # most characters of them, in all
MODEL_BYTES = 128 << 20  # bytes of tables that a task holds at a time; more languages are parsed in several groups
LABELS_AT_ONCE = 256  # languages whose samples are read together
CLASSES = 64  # most symbols of a language: blank, foreign letter, letters
SHARED = 16  # of them shared by rare letters where there are more
BLOCK = 1_024


def _letter_numbers(letters: list[str]) -> np.ndarray:
    """Number of every code point: 0 no letter, 1 other letter, then ``letters`` (upper case as lower case)."""
    at = {ch: 2 + i for i, ch in enumerate(letters)}
    table = np.zeros(0x110000, np.int32)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            table[cp] = at.get(ch.lower()[:1], 1)
    return table


def _own_symbols(sample: np.ndarray, n_letters: int) -> tuple[np.ndarray, int]:
    """How a language reads the letter numbers: its symbols by number, and how many symbols it has."""
    number, count = np.unique(sample[sample > 1], return_counts=True)
    number = number[np.lexsort((number, -count))]
    own = np.ones(n_letters + 2, np.uint8)  # foreign
    own[0] = 0
    alone = CLASSES - 2 if len(number) <= CLASSES - 2 else CLASSES - 2 - SHARED
    own[number[:alone]] = 2 + np.arange(min(alone, len(number)))
    own[number[alone:]] = CLASSES - SHARED + number[alone:] % SHARED
    return own, int(own.max()) + 1


def _symbols(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts with runs of blanks as one, and how many each text has (outer blanks dropped)."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    cls = table[points]
    keep = cls > 0
    # A blank stays where a letter of the same text stands on its left and another later letter follows it.
    keep[1:] |= (cls[1:] == 0) & (cls[:-1] > 0)
    cls, owner = cls[keep], owner[keep]
    last = np.ones(len(cls), bool)
    last[:-1] = owner[1:] != owner[:-1]
    inner = ~(last & (cls == 0))
    return cls[inner], np.bincount(owner[inner], minlength=len(texts))


def suffix_table(symbols: np.ndarray, size: int = CLASSES) -> np.ndarray:
    """Dense table of the suffix automaton of ``symbols`` for greedy phrases. The cell of (state, symbol) is
    ``2 * row offset of the next state + (1 if a new phrase starts)``: without a transition the phrase ends and the
    symbol starts the next one. The last row is the state before any phrase."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols.tolist():
        cur = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    before = len(step)  # the state before any phrase, also after a symbol that the sample lacks
    first = [2 * size * step[0].get(c, before) + 1 for c in range(size)]
    table = np.tile(np.array(first, np.int32), (len(step) + 1, 1))
    for s, out in enumerate(step):
        for c, t in out.items():
            table[s, c] = 2 * size * t
    return table.ravel()


def train(samples: dict[str, list[str]], symbols_each: int = SAMPLE_SYMBOLS) -> dict:
    """Model of the languages from sample texts: plain arrays, ready to broadcast."""
    letters = sorted({ch for texts in samples.values() for t in texts for ch in t.lower() if ch.isalpha()})
    numbers = _letter_numbers(letters)
    model = {"letters": letters, "langs": [], "own": [], "tables": [], "starts": [], "bits": []}
    for lang in sorted(samples):
        sample = _symbols(samples[lang], numbers)[0][:symbols_each] if samples[lang] else np.zeros(0, np.int32)
        if len(sample):
            own, size = _own_symbols(sample, len(letters))
            table = suffix_table(own[sample], size)
            model["langs"].append(lang)
            model["own"].append(own)
            model["tables"].append(table)
            model["starts"].append(2 * (len(table) - size))  # the row before any phrase
            model["bits"].append(math.log2(len(sample) + 1))
    return model


class CrossParser:
    def __init__(self, model: dict):
        self.langs, self.tables, self.own, self.starts = (model[c] for c in ("langs", "tables", "own", "starts"))
        self.bits = np.array(model["bits"])
        self.numbers = _letter_numbers(model["letters"])

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases per (text, language) and symbols per text."""
        symbols, sizes = _symbols(texts, self.numbers)
        counts = np.zeros((len(texts), len(self.langs)), np.int64)
        if not len(symbols):
            return counts, sizes
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        per = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), per)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        start = begin[owner] + nth * BLOCK
        size = np.minimum(BLOCK, sizes[owner] - nth * BLOCK)
        order = np.argsort(-size, kind="stable")
        owner, start, size = owner[order], start[order], size[order]
        active = np.searchsorted(-size, -np.arange(int(size[0])), side="left")  # blocks longer than each step
        for k, (table, own) in enumerate(zip(self.tables, self.own)):
            mine = own[symbols]
            state = np.full(len(owner), self.starts[k], np.int32)
            done = np.zeros(len(owner), np.int32)
            for t, n in enumerate(active):
                cell = table[(state[:n] >> 1) + mine[start[:n] + t]]
                state[:n] = cell
                done[:n] += cell & 1
            counts[:, k] = np.bincount(owner, done, len(texts))
        return counts, sizes

    def costs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cost per (text, language) and symbols per text."""
        counts, sizes = self.phrases(texts)
        return counts * self.bits, sizes


def sample_texts(labelled: DataFrame, text: str, lang: str, key: str, labels: list[tuple[str, int]]) -> dict[str, list[str]]:
    """A bounded sample of the labelled texts of each of ``labels`` (with its number of rows), in hash order. One scan
    keeps the beginnings of about ``SAMPLE_DOCS`` different texts of each, whatever the size of the table; rows are chosen by
    a hash of key and text, so rows without a key count like others, and copies count once."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()) \
        .select(F.xxhash64(F.col(text), F.col(key)).alias("h"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    top = labelled.sparkSession.createDataFrame(
        [(name, int(-2 ** 63 + min(1.0, SAMPLE_DOCS / n) * (2 ** 64 - 1)) if n > SAMPLE_DOCS else 2 ** 63 - 1,
          SAMPLE_CHARS // min(n, SAMPLE_DOCS)) for name, n in labels], "lang string, top bigint, chars int")
    picked = rows.join(F.broadcast(top), "lang").where("h <= top") \
        .select("lang", "h", F.expr("substring(text, 1, chars)").alias("text")).distinct()
    out: dict[str, list[str]] = {name: [] for name, _ in labels}
    for lang_, _, body in sorted(map(tuple, picked.collect())):
        out[lang_].append(body)
    return out


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> list[dict]:
    """Models of all labels, in groups of at most ``MODEL_BYTES`` of tables (a single language may exceed it)."""
    counts = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).groupBy(F.col(lang).alias("lang")).count()
    labels = sorted((r["lang"], r["count"]) for r in counts.collect())
    groups, samples, held = [], {}, 0
    for at in range(0, len(labels), LABELS_AT_ONCE):
        for name, texts in sample_texts(labelled, text, lang, key, labels[at:at + LABELS_AT_ONCE]).items():
            symbols = min(SAMPLE_SYMBOLS, sum(map(len, texts)))
            classes = min(CLASSES, 2 + len({ch for t in texts for ch in t.lower()}))
            cost = 8 * symbols * classes  # at most two states a symbol, four bytes a cell
            if samples and held + cost > MODEL_BYTES:
                groups.append(train(samples))
                samples, held = {}, 0
            samples[name] = texts
            held += cost
    if samples:
        groups.append(train(samples))
    return [g for g in groups if g["langs"]]


_LOADED: dict[str, CrossParser] = {}


def identify(df: DataFrame, model: list[dict], keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every whole text."""
    carried = "__lang string, __best double, __second double, __letters boolean"
    state = df.select(*keep, F.lit(None).cast("string").alias("__lang"), F.lit(math.inf).alias("__best"),
                      F.lit(math.inf).alias("__second"), F.lit(False).alias("__letters"), F.col(text).alias("__text"))
    for group in model:  # one turn, unless the tables of all languages exceed the bound
        state = _parsed(state, group, carried)
    out, learnt = F.col("__letters"), sum(len(g["langs"]) for g in model)
    margin = F.lit(1.0) if learnt == 1 else F.lit(1.0) - F.col("__best") / F.greatest(F.col("__second"), F.lit(1e-9))
    return state.select(*keep, F.when(out, F.col("__lang")).otherwise(UNDETERMINED).alias("lang_pred"),
                        F.when(out, F.least(F.greatest(margin, F.lit(0.0)), F.lit(1.0))).otherwise(0.0).alias("score"))


def _parsed(state: DataFrame, group: dict, carried: str) -> DataFrame:
    """One group's turn: the least cost and its language, and the second least, over all groups so far."""
    shared, token, n = state.sparkSession.sparkContext.broadcast(group), uuid.uuid4().hex, len(state.columns) - 5

    def run(batches):
        if token not in _LOADED:
            _LOADED.clear()
            _LOADED[token] = CrossParser(shared.value)
        parser = _LOADED[token]
        names = np.array(parser.langs, object)
        for part, texts in slices(batches, "__text"):
            cost, sizes = parser.costs(texts)
            order = np.argsort(cost, axis=1, kind="stable")
            own, rows = cost[np.arange(len(texts))[:, None], order], np.arange(len(texts))
            best, second = (part.column(n + k).to_numpy(zero_copy_only=False) for k in (1, 2))
            lang = np.array(part.column(n).to_pylist(), object)
            better = own[:, 0] < best  # ties go to the first in order
            runner = own[:, 1] if own.shape[1] > 1 else np.full(len(texts), math.inf)
            second = np.where(better, np.minimum(best, runner), np.minimum(second, own[:, 0]))
            lang = np.where(better, names[order[rows, 0]], lang)
            columns = [pa.array(lang, pa.string()), pa.array(np.where(better, own[:, 0], best)), pa.array(second),
                       pa.array(sizes > 0), part.column(n + 4)]
            yield pa.RecordBatch.from_arrays([*part.columns[:n], *columns], names=part.schema.names)

    return state.mapInArrow(run, extended(state, carried + ", __text string", 5))


def remainder(key, parts: int):
    """crc32 of the key as text, modulo ``parts`` (a null key counts as the empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts
