"""Token counts of whole texts, huge ones by overlapping chunks that are resynchronised.

A document of more than ``chunk_chars`` characters is encoded in overlapping chunks with offsets. Two
neighbouring encodings are spliced at a token boundary that both have and that is *proven* stable: merges only
make pieces of the vocabulary, so no merge reaches over a pair of characters that stands side by side in no piece,
and what lies on either side of such a pair is encoded alike in any context. Where an overlap holds no such
boundary it is doubled, at last to the whole document. Counts are those of encoding the text at once; the memory
of an encoding is bounded by the chunk for every text that has stable boundaries (any text with spaces has).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"


class ChunkedCounter:
    """Counts the pieces of a text under a sentencepiece model with identity normalisation."""

    def __init__(self, model_file: str, chunk_chars: int = 32_768, overlap_chars: int = 256):
        import sentencepiece

        self._sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self._chunk, self._overlap = chunk_chars, overlap_chars
        sizes, joined = [], set()
        for i in range(self._sp.vocab_size()):
            piece = self._sp.id_to_piece(i)
            sizes.append(1 if self._sp.is_byte(i) else len(piece.encode()))
            if not (self._sp.is_byte(i) or self._sp.is_control(i) or self._sp.is_unknown(i)):
                joined.update(zip(piece, piece[1:]))
        self._sizes = np.array(sizes, np.int64)
        self._joined = joined

    def counts(self, texts: list[str | None]) -> list[int]:
        """Short texts go to the library as one list, long ones chunk by chunk."""
        out = [0] * len(texts)
        short = [i for i, x in enumerate(texts) if x and len(x) <= self._chunk]
        for i, ids in zip(short, self._sp.encode([texts[i] for i in short], num_threads=1)):
            out[i] = len(ids)
        for i, x in enumerate(texts):
            if x and len(x) > self._chunk:
                out[i] = self.count_long(x)
        return out

    def count_long(self, text: str) -> int:
        at, end, total, done = 0, min(len(text), self._chunk), 0, 0
        left = self._starts(text, at, end)
        while left is not None and end < len(text):
            overlap = self._overlap
            while True:
                start = end - overlap
                if start <= done:  # nothing stable in all that is left of this chunk: make the chunk longer
                    end = min(len(text), end + (end - at))
                    left = self._starts(text, at, end)
                    break
                stop = min(len(text), start + max(self._chunk, 2 * overlap))
                right = self._starts(text, start, stop)
                if right is None or left is None:
                    return len(self._sp.encode(text))
                cut = self._splice(text, start, end, left, right)
                if cut is None:
                    overlap *= 2
                    continue
                total += int(np.count_nonzero((left >= done) & (left < cut)))
                at, end, left, done = start, stop, right, cut
                break
        if left is None:
            return len(self._sp.encode(text))
        return total + int(np.count_nonzero(left >= done))

    def _starts(self, text: str, at: int, end: int) -> np.ndarray | None:
        """The character at which each token of a chunk starts (a token inside a character: that character);
        None if the pieces don't add up to the text, as under another normalisation."""
        part = text[at:end].replace(" ", SPACE)
        points = np.frombuffer(part.encode("utf-32-le"), "<u4")
        byte_ends = np.cumsum(1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000))
        ends = np.cumsum(self._sizes[self._sp.encode(text[at:end])]) - len(SPACE.encode())
        if len(ends) == 0 or ends[-1] != byte_ends[-1]:
            return None
        starts = np.concatenate(([0], np.maximum(ends[:-1], 0)))
        return at + np.searchsorted(byte_ends, starts, side="right")

    def _splice(self, text: str, start: int, end: int, left: np.ndarray, right: np.ndarray) -> int | None:
        common = np.intersect1d(left, right)
        for p in common[(common > start) & (common < end)]:
            a, b = text[p - 1].replace(" ", SPACE), text[p].replace(" ", SPACE)
            if (a, b) not in self._joined:
                return int(p)
        return None


@lru_cache(maxsize=2)
def _counter(model_file: str, chunk_chars: int, overlap_chars: int) -> ChunkedCounter:
    return ChunkedCounter(model_file, chunk_chars, overlap_chars)


def n_tokens(text: Column, model_file: str, chunk_chars: int = 32_768, overlap_chars: int = 256) -> Column:
    """Tokens of a whole text, without begin or end tokens; a null or empty text has none."""

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(model_file, chunk_chars, overlap_chars)
        for texts in batches:
            yield pd.Series(counter.counts([x if isinstance(x, str) else None for x in texts]), dtype="int64")

    return tokens(text)


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, **chunking: int) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``; other columns are left out.

    No shuffle: each task counts what it has read. A null text counts as empty (0 bytes, 0 tokens), a null id and
    repeated rows are kept as they are, an empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    counted = docs.select(
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        n_tokens(F.col("text"), model_file, **chunking).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
