"""Order-preserving packing by dynamic programming.

Documents keep their order. Cuts may fall at document ends, at sentence ends for a penalty, and, where
a sentence is longer than a sequence, inside it for a larger one. The cheapest cuts are found with

    f(j) = penalty(j) + min over i of f(i) + padding(position(j) - position(i)) + cost of a sequence

The padding is linear in the positions but for lengths that are a power of two, which need none, so
the minimum over the window of one sequence is a monotone queue on f(i) + position(i), next to at most
twelve direct predecessors.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidewake.llm import textbytes as tb
from tidewake.llm.frames import map_arrow, texts
from tidewake.llm.vocab import word_ids

_OUT = pa.schema(
    [
        *((c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")),
        ("sequence_length", pa.int64()),
    ]
)


@dataclass(frozen=True)
class Costs:
    """In tokens of padding: cuts inside a document, and what a sequence costs besides."""

    sentence_cut: int = 2
    forced_cut: int = 24
    sequence: int = 4


def cheapest_cuts(position: np.ndarray, penalty: np.ndarray, size: int, per_sequence: int) -> list[int]:
    """Indices of the chosen cuts, first and last position included; no gap may be over ``size``."""
    n = len(position)
    pos, pen = position.tolist(), penalty.tolist()
    powers = [1 << k for k in range(size.bit_length()) if 1 << k <= size]
    direct: dict[int, list[int]] = {}
    for length in powers:
        before = np.searchsorted(position, position - length)
        found = np.flatnonzero(position[np.minimum(before, n - 1)] == position - length)
        for j, i in zip(found.tolist(), before[found].tolist()):
            direct.setdefault(j, []).append(i)
    cost, came = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque([(pos[0], 0)])
    for j in range(1, n):
        here = pos[j]
        while pos[queue[0][1]] < here - size:
            queue.popleft()
        low, i = queue[0]
        best = low + size - here
        for k in direct.get(j, ()):
            if cost[k] < best:
                best, i = cost[k], k
        best += pen[j] + per_sequence
        cost[j], came[j] = best, i
        key = best + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(came[cuts[-1]])
    return cuts[::-1]


def _binary_parts(length: int) -> list[int]:
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


class Packer:
    """Packs a stream of documents; a block's last sequences stay open until the next block is there."""

    def __init__(self, sentence_ends: np.ndarray, size: int, costs: Costs, first_sequence: int, block: int = 64):
        self.ends, self.size, self.costs, self.block = sentence_ends, size, costs, block * size
        self.next_sequence = first_sequence
        self.docs: list[tuple[int | None, bytes, int]] = []  # id, all its ids, first id not yet placed
        self.held = 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        self.docs.append((doc_id, ids, 0))
        self.held += len(ids) // 4
        if self.held >= self.block:
            yield from self._pack(last=False)

    def finish(self) -> Iterator[tuple]:
        if self.docs:
            yield from self._pack(last=True)

    def _candidates(self) -> tuple[np.ndarray, np.ndarray]:
        position, penalty, at = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0
        for _, ids, start in self.docs:
            tokens = np.frombuffer(ids, "<u4")[start:]
            inner = np.flatnonzero(self.ends[tokens[:-1]]) + 1
            position += [inner + at, np.array([at + len(tokens)])]
            penalty += [np.full(len(inner), self.costs.sentence_cut), np.zeros(1, np.int64)]
            at += len(tokens)
        place, cost = np.concatenate(position), np.concatenate(penalty)
        wide = np.flatnonzero(np.diff(place) > self.size)
        if len(wide):
            inside = [np.arange(place[i] + self.size, place[i + 1], self.size) for i in wide]
            extra = np.concatenate(inside)
            place, cost = np.concatenate([place, extra]), np.concatenate([cost, np.full(len(extra), self.costs.forced_cut)])
            order = np.argsort(place, kind="stable")
            place, cost = place[order], cost[order]
        return place, cost

    def _pack(self, last: bool) -> Iterator[tuple]:
        place, penalty = self._candidates()
        cuts = place[cheapest_cuts(place, penalty, self.size, self.costs.sequence)].tolist()
        if not last:
            cuts = cuts[: max(2, len(cuts) - 4)]
        else:
            # What is left for the last sequence goes without padding into lengths that need none.
            length = cuts[-1] - cuts[-2]
            parts = _binary_parts(length)
            if self.size - length > self.costs.sequence * len(parts):
                cuts[-1:] = [cuts[-2] + s for s in np.cumsum(parts).tolist()]
        yield from self._emit(cuts)

    def _emit(self, cuts: list[int]) -> Iterator[tuple]:
        at, k, sequence_start = 0, 1, 0
        while k < len(cuts):
            doc_id, ids, start = self.docs[0]
            total = len(ids) // 4
            length = min(total - start, cuts[k] - at)
            crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
            yield doc_id, start, length, crc, total, self.next_sequence, at - sequence_start, cuts[k] - cuts[k - 1]
            at += length
            if start + length == total:
                self.docs.pop(0)
            else:
                self.docs[0] = (doc_id, ids, start + length)
            if at == cuts[k]:
                sequence_start, k = at, k + 1
                self.next_sequence += 1
        self.held -= at


def pack(
    docs: DataFrame,
    vocabulary: str,
    size: int = 2048,
    end_id: int = 1,
    costs: Costs = Costs(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` tokens; ``size`` is a power of two.

    One row per piece: doc_id, start (ids of its document before it), length, ids_crc32 (of its ids as
    little-endian unsigned 32-bit numbers), doc_tokens (with the end id), sequence_id, offset in the
    sequence, sequence_length. Every document ends with ``end_id``; a null or empty text is that id
    alone. Each partition of ``docs`` is packed in its own order, with sequence ids of its own range, so
    nothing is shuffled, and about 64 sequences are held at a time. Equal rows are packed each; a null
    doc_id stays null; other columns are not read; an empty table gives no rows. ``vocabulary`` is a
    path that every worker can read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(vocabulary)
        n = words.library.get_vocab_size()
        ends = np.zeros(max(n, end_id + 1), bool)
        # The tokens that end a sentence.
        for mark in (".", "!", "?", "...", "。"):
            token = words.library.token_to_id(mark + "</w>")
            if token is not None:
                ends[token] = True
        last = np.array([end_id], "<u4").tobytes()
        packer = Packer(ends, size, costs, TaskContext.get().partitionId() << 40)
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, schema=_OUT)

        for batch in batches:
            for part in tb.slices(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    rows.extend(packer.add(doc_id, words.encode(text or "") + last))
                if rows:
                    yield out()
        rows.extend(packer.finish())
        if rows:
            yield out()

    return map_arrow(texts(docs, id_col, text_col), run, _OUT)
