"""Packing token sequences by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Items dealt to ``windows`` windows of near-equal sums, by multiway differencing.

    Each item starts as a partial partition of its own, with one window filled and the others empty. The two
    partitions of the largest imbalance are merged, the fullest window of one with the emptiest of the other, until
    one is left. A partition carries its filled windows only, the fullest first; the rest are empty.
    """
    heap = [(-size, i, [(size, (i,))]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    fresh = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        apart = max(0, windows - len(a) - len(b))  # empty windows of both that would meet
        both = len(a) + len(b) - windows + apart  # filled windows of both that do meet
        keep, turned = len(a) - both, b[::-1]
        merged = a[:keep] + [(x + y, p + q) for (x, p), (y, q) in zip(a[keep:], turned[:both])] + turned[both:]
        merged.sort(key=lambda w: -w[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-spread, fresh, merged))
        fresh += 1
    filled = [list(p) for _, p in heap[0][2]] if heap else []
    return filled


def fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``: their number rises until the fullest one fits."""
    count = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = difference(sizes, count)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return windows
        count += 1


class Packer:
    """Takes the token ids of one document after another, gives rows of pieces.

    Whole windows are cut off the front of a document and stand alone. What is left is cut into pieces of at most
    ``grain`` tokens, so that windows can come out near equal, and waits until the block holds ``block`` windows'
    worth of them at the share ``fill``.
    """

    def __init__(self, first_sequence: int, capacity: int, grain: int, block: int, fill: float):
        self._next, self._capacity, self._grain = first_sequence, capacity, grain
        self._room = int(block * capacity * fill)
        self._waiting: list[tuple[int | None, int, np.ndarray, int]] = []
        self._size = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        n, whole = len(ids), len(ids) // self._capacity * self._capacity
        for start in range(0, whole, self._capacity):
            self._put(self._next, 0, (doc_id, start, ids[start : start + self._capacity], n))
            self._next += 1
        if n - whole and self._size + n - whole > self._room:
            self.flush()
        for start in range(whole, n, self._grain):
            self._waiting.append((doc_id, start, ids[start : start + self._grain], n))
        self._size += n - whole

    def flush(self) -> None:
        if not self._waiting:
            return
        for window in fit([len(p[2]) for p in self._waiting], self._capacity):
            offset = 0
            for i in sorted(window):
                self._put(self._next, offset, self._waiting[i])
                offset += len(self._waiting[i][2])
            self._next += 1
        self._waiting, self._size = [], 0

    def _put(self, sequence: int, offset: int, piece: tuple) -> None:
        doc_id, start, ids, n = piece
        self.rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes(), n, sequence, offset))


@lru_cache(maxsize=2)
def _encoder(ranks_file: str, pattern: str, specials: tuple[tuple[str, int], ...]):
    import base64

    import tiktoken

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(
        os.path.basename(ranks_file), pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(specials)
    )


@lru_cache(maxsize=2)
def _tokenizer(tokenizer_file: str):
    import tokenizers

    return tokenizers.Tokenizer.from_file(tokenizer_file)


class Encoder:
    """Token ids of whole texts, those of ``tokenizer_file``.

    ``ranks_file`` holds the same vocabulary for a library that is several times faster, but whose pattern gives
    up on blank runs of some hundred thousand characters; texts with such runs go to the tokenizer itself.
    """

    #: Blanks in a row that the fast library surely takes.
    BLANKS = 100_000
    _BLANK_RUN = re.compile(r"\s{%d}" % BLANKS)

    def __init__(self, tokenizer_file: str, ranks_file: str, pattern: str, specials: dict[str, int]):
        self._file, self._allowed = tokenizer_file, set(specials)
        self._fast = _encoder(ranks_file, pattern, tuple(specials.items()))

    def ids(self, text: str) -> np.ndarray:
        if len(text) >= self.BLANKS and self._BLANK_RUN.search(text):
            return np.array(_tokenizer(self._file).encode(text, add_special_tokens=False).ids, np.uint32)
        ids = self._fast.encode_to_numpy(text, allowed_special=self._allowed, disallowed_special=())
        return ids.astype(np.uint32, copy=False)


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    ranks_file: str,
    pattern: str,
    specials: dict[str, int],
    end_id: int = 0,
    capacity: int = 1024,
    grain: int = 256,
    block: int = 32,
    fill: float = 0.99,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids`` (little-endian unsigned 32-bit numbers), ``doc_tokens,
    sequence_id, offset``.

    Each document's ids are followed by ``end_id``; every id lies in one piece. No shuffle and no state beyond a
    block: a task packs what it reads, block by block, and numbers its sequences from its partition's number on.
    A null or empty text is the end id alone, null ids and repeated rows are packed like any other, other columns
    are left out, an empty table gives an empty result.
    """
    kinds = pa.schema(
        [
            ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_file, ranks_file, pattern, specials)
        packer = Packer(TaskContext.get().partitionId() << 36, capacity, grain, block, fill)
        end = np.array([end_id], np.uint32)

        def taken() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            columns = zip(*rows) if rows else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                packer.add(doc_id, np.concatenate((encoder.ids(text.as_py() or ""), end)))
                if len(packer.rows) >= 4096:
                    yield taken()
        packer.flush()
        yield taken()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
