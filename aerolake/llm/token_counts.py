"""Token counts of a SentencePiece BPE model, with overlap resynchronisation for huge documents.

A text beyond ``chunk_chars`` is encoded as overlapping chunks with offsets. Two neighbouring chunks are spliced
at a boundary in their overlap that both encodings have and that is proven stable: the two characters around it
stand next to each other in no vocabulary piece, so no merge of the whole text can reach over it, and what is
left or right of it does not change its encoding. Where the overlap holds no such boundary, it is doubled and the
left chunk encoded again, up to the whole rest of the text. The sum is exactly the count of the whole text.

Edge cases: null and empty texts count 0 tokens; rows are independent, so repeated rows repeat; an empty table
gives an empty result. Only named columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.arrow import extended, slices

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
SPACE_MARK = "▁"  # how the model writes a space


class PieceCounter:
    """Counts tokens with one SentencePiece model."""

    def __init__(self, model: bytes, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.chunk, self.overlap = chunk_chars, overlap_chars
        self.joined = set()  # character pairs that some piece holds
        for i in range(self.sp.get_piece_size()):
            if not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i)):
                piece = self.sp.id_to_piece(i)
                self.joined.update(zip(piece, piece[1:]))

    def stable(self, text: str, at: int) -> bool:
        """No merge can span the boundary before character ``at``."""
        a, b = text[at - 1].replace(" ", SPACE_MARK), text[at].replace(" ", SPACE_MARK)
        return (a, b) not in self.joined

    def _spans(self, text: str, start: int, end: int) -> list[int]:
        """Start offsets, in the whole text, of the tokens of one chunk."""
        chunk = text[start:end]
        leads = (np.frombuffer(chunk.encode() + b" ", np.uint8) & 0xC0) != 0x80  # the library counts bytes
        char_of = np.cumsum(leads) - 1 + start
        return char_of[[p.begin for p in self.sp.encode(chunk, return_type="proto").pieces]].tolist()

    def count_huge(self, text: str) -> int:
        total, cut, start = 0, 0, 0  # tokens before cut are counted
        begins, reach = None, 0
        while True:
            end = min(len(text), start + self.chunk)
            overlap = self.overlap
            right = self._spans(text, end, min(len(text), end + self.chunk + self.overlap)) if end < len(text) else None
            ends = set(right or ())
            while True:
                stop = min(len(text), end + overlap)
                if begins is None or stop > reach:
                    begins, reach = self._spans(text, start, stop), stop
                if stop == len(text):
                    return total + sum(1 for b in begins if b >= cut)
                splice = next((b for b in begins if end < b < stop and b in ends and self.stable(text, b)), None)
                if splice is not None:
                    break
                overlap *= 2
            total += sum(1 for b in begins if cut <= b < splice)
            cut, start, begins, reach = splice, end, right, min(len(text), end + self.chunk + self.overlap)

    def counts(self, texts: list[str]) -> list[int]:
        short = [t for t in texts if len(t) <= self.chunk]
        encoded = iter(self.sp.encode(short, num_threads=1)) if short else iter(())
        return [len(next(encoded)) if len(t) <= self.chunk else self.count_huge(t) for t in texts]


_LOADED: dict[str, PieceCounter] = {}


def count_tokens(df: DataFrame, model_path: str, limit: int = 4096, keep: tuple[str, ...] = ("doc_id",),
                 text: str = "text", chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """``keep`` columns, UTF-8 bytes, token count, and whether the count is above ``limit``."""
    with open(model_path, "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary of fixed, small size
    body = F.coalesce(F.col(text), F.lit(""))
    source = df.select(*keep, F.octet_length(body).cast("bigint").alias("n_bytes"), body.alias("__text"))
    key = f"{model_path} {chunk_chars} {overlap_chars}"

    def run(batches):
        if key not in _LOADED:
            _LOADED.clear()
            _LOADED[key] = PieceCounter(model.value, chunk_chars, overlap_chars)
        for part, texts in slices(batches, "__text"):
            n = pa.array(_LOADED[key].counts(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], n], names=[*part.schema.names[:-1], "n_tokens"])

    return source.mapInArrow(run, extended(source, "n_tokens bigint")).withColumn("over_limit", F.col("n_tokens") > limit)
