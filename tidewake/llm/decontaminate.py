"""Benchmark decontamination with one FM-index per shard of documents.

A shard is the text of some thousand documents as word numbers of the benchmark's vocabulary. Words
outside the vocabulary cannot lie in a match, so only runs of vocabulary words as long as the shortest
window are indexed, each closed by a separator. Windows of the benchmark are found by backward search
over a wavelet matrix, their places by walking to sampled suffix positions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.llm import textbytes as tb
from tidewake.llm.frames import map_arrow
from tidewake.session import stage

WINDOW_WORDS = 10
BLOCK_BYTES = 8 << 20  # benchmark text per pass over the documents, which bounds what a task is sent
ITEM_WORDS = 4096  # windows of an item that stay together
SHARD_SYMBOLS = 400_000
SHARD_BYTES = 8 << 20
SAMPLE_EVERY = 8


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes of a number sequence in order, by prefix doubling; the end is the least symbol."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64)
    width = 1
    while True:
        key = np.zeros(n, np.int64)
        if width < n:
            key[: n - width] = rank[width:] + 1
        key += rank * (n + 1)
        order = np.argsort(key, kind="stable")
        step = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank[order] = step
        if n == 0 or step[-1] == n - 1:
            return order
        width *= 2


class WaveletMatrix:
    """Ranks of a number sequence: how many of the first i symbols are c."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        current = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bit) - self.ones[-1][-1]))
            current = np.concatenate([current[bit == 0], current[bit == 1]])
        every = np.arange(sigma)
        self.begin = self._descend(every, np.zeros(sigma, np.int64))

    def _descend(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            ones = self.ones[k][i]
            i = np.where((c >> level) & 1, self.zeros[k] + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._descend(c, i) - self.begin[c]


class FMIndex:
    """Full-text index of a number sequence in which 0 separates runs; it ends with 0."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        order = suffix_array(symbols)
        self.bwt = symbols[order - 1]
        self.wavelet = WaveletMatrix(self.bwt, sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma))])
        # Sampled positions: every few, and the start of each run, so that no walk meets a separator.
        sampled = (order % SAMPLE_EVERY == 0) | (self.bwt == 0)
        self.sampled = sampled
        self.sample_rank = np.concatenate([[0], np.cumsum(sampled)])
        self.samples = order[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each pattern; patterns are aligned to the right and padded on the left."""
        n, width = patterns.shape
        low, high = np.zeros(n, np.int64), np.full(n, len(self.bwt), np.int64)
        alive = np.arange(n)
        for back in range(1, width + 1):
            alive = alive[(lengths[alive] >= back) & (low[alive] < high[alive])]
            if not len(alive):
                break
            c = patterns[alive, width - back]
            low[alive] = self.first[c] + self.wavelet.rank(c, low[alive])
            high[alive] = self.first[c] + self.wavelet.rank(c, high[alive])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position in the sequence of each row."""
        out, steps = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        rows, open_ = rows.copy(), np.arange(len(rows))
        while len(open_):
            done = self.sampled[rows[open_]]
            ready = open_[done]
            out[ready] = self.samples[self.sample_rank[rows[ready]]] + steps[ready]
            open_ = open_[~done]
            c = self.bwt[rows[open_]]
            rows[open_] = self.first[c] + self.wavelet.rank(c, rows[open_])
            steps[open_] += 1
        return out


@dataclass
class Phrases:
    """Distinct windows of some benchmark items, over the numbered words of these items."""

    vocabulary: np.ndarray
    patterns: np.ndarray
    lengths: np.ndarray
    item_start: np.ndarray
    item_of: np.ndarray
    names: list[str | None]

    @property
    def shortest(self) -> int:
        return int(self.lengths.min())


def _words_of(column: pa.Array) -> tb.Words:
    data, offsets = tb.text_bytes(column)
    return tb.split_words(tb.LOWER[data], offsets, tb.NOT_ALNUM)


def phrases_of(items: list[tuple[str | None, str | None]], size: int) -> Phrases | None:
    words = _words_of(pa.array([t for _, t in items], pa.string()))
    if not len(words.start):
        return None
    vocabulary, number = np.unique(words.hashes(), return_inverse=True)
    number = number + 1
    windows: dict[tuple, int] = {}
    owners: list[set[int]] = []
    names: dict[str | None, int] = {}
    for i, (item_id, _) in enumerate(items):
        mine = number[words.bounds[i] : words.bounds[i + 1]].tolist()
        name = names.setdefault(item_id, len(names))
        for at in range(max(1, len(mine) - size + 1) if mine else 0):
            key = tuple(mine[at : at + size])
            k = windows.setdefault(key, len(windows))
            if k == len(owners):
                owners.append(set())
            owners[k].add(name)
    lengths = np.array([len(k) for k in windows], np.int64)
    patterns = np.zeros((len(windows), int(lengths.max())), np.int64)
    for k, key in enumerate(windows):
        patterns[k, patterns.shape[1] - len(key) :] = key
    starts = np.concatenate([[0], np.cumsum([len(o) for o in owners])])
    return Phrases(vocabulary, patterns, lengths, starts, np.array([x for o in owners for x in sorted(o)]), list(names))


class Shard:
    """Documents whose words are looked up together."""

    def __init__(self, phrases: Phrases | None):
        self.phrases = phrases
        self.parts: list[pa.RecordBatch] = []
        self.words: list[tb.Words] = []
        self.symbols: list[np.ndarray] = []
        self.doc: list[np.ndarray] = []
        self.word: list[np.ndarray] = []
        self.rows, self.size, self.bytes = 0, 0, 0

    def add(self, part: pa.RecordBatch) -> None:
        words = _words_of(part.column("text"))
        self.parts.append(part)
        self.words.append(words)
        self.bytes += len(words.data)
        if self.phrases is not None and len(words.start):
            hashes = words.hashes()
            found = np.minimum(np.searchsorted(self.phrases.vocabulary, hashes), len(self.phrases.vocabulary) - 1)
            known = np.flatnonzero(self.phrases.vocabulary[found] == hashes)
            if len(known):
                cut = np.flatnonzero((np.diff(known) > 1) | (np.diff(words.text[known]) > 0)) + 1
                starts = np.concatenate([[0], cut])
                sizes = np.diff(np.concatenate([starts, [len(known)]]))
                long = np.repeat(sizes >= self.phrases.shortest, sizes)
                run = np.repeat(np.arange(len(sizes)), sizes)[long]
                kept = known[long]
                if len(kept):
                    ends = np.flatnonzero(np.diff(run, append=-1)) + 1
                    self.symbols.append(np.insert(found[kept] + 1, ends, 0))
                    self.doc.append(np.insert(words.text[kept] + self.rows, ends, -1))
                    self.word.append(np.insert(kept - words.bounds[words.text[kept]], ends, -1))
                    self.size += len(self.symbols[-1])
        self.rows += part.num_rows

    def full(self) -> bool:
        return self.size >= SHARD_SYMBOLS or self.bytes >= SHARD_BYTES

    def matches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document of the shard, first word, window) of every occurrence of every window."""
        none = np.zeros(0, np.int64)
        if not self.symbols:
            return none, none, none
        index = FMIndex(np.concatenate(self.symbols), len(self.phrases.vocabulary) + 1)
        low, high = index.search(self.phrases.patterns, self.phrases.lengths)
        hits = np.flatnonzero(high > low)
        if not len(hits):
            return none, none, none
        sizes = high[hits] - low[hits]
        window = np.repeat(hits, sizes)
        within = np.arange(len(window)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = index.locate(np.repeat(low[hits], sizes) + within)
        return np.concatenate(self.doc)[place], np.concatenate(self.word)[place], window


def merge(first: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Union of ranges as sorted ranges that do not touch."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(zip(first.tolist(), end.tolist())):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


_STATE = [("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string())), ("n_words", pa.int64())]


def _searched(batches: Iterator[pa.RecordBatch], phrases: Phrases | None, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The batches with the spans and items of these phrases added to those of earlier passes."""

    def done(shard: Shard) -> Iterator[pa.RecordBatch]:
        doc, first, window = shard.matches()
        order = np.argsort(doc, kind="stable")
        doc, first, window = doc[order], first[order], window[order]
        bounds = np.searchsorted(doc, np.arange(shard.rows + 1))
        row = 0
        for part, words in zip(shard.parts, shard.words):
            spans, items = part.column("spans").to_pylist(), part.column("items").to_pylist()
            for i in range(part.num_rows):
                s, e = bounds[row], bounds[row + 1]
                row += 1
                if s == e:
                    continue
                ends = first[s:e] + shard.phrases.lengths[window[s:e]]
                old = np.array(spans[i], np.int64).reshape(-1, 2)
                ranges = merge(np.concatenate([old[:, 0], first[s:e]]), np.concatenate([old[:, 1], ends]))
                spans[i] = [x for r in ranges for x in r]
                owners = set(items[i])
                for w in np.unique(window[s:e]):
                    owners.update(shard.phrases.names[k] for k in shard.phrases.item_of[shard.phrases.item_start[w] : shard.phrases.item_start[w + 1]])
                items[i] = sorted(x for x in owners if x is not None)
            columns = [part.column(c) for c in names]
            columns += [pa.array(spans, _STATE[0][1]), pa.array(items, _STATE[1][1]), pa.array(words.counts(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names + [c for c, _ in _STATE])

    shard = Shard(phrases)
    for batch in batches:
        for part in tb.slices(batch, "text"):
            shard.add(part)
            if shard.full():
                yield from done(shard)
                shard = Shard(phrases)
    if shard.parts:
        yield from done(shard)


def _item_parts(batches: Iterator[pa.RecordBatch], size: int, together: int) -> Iterator[pa.RecordBatch]:
    """Items of any length as runs of ``together`` windows; neighbouring runs share the words of a window but one."""
    for batch in batches:
        words = _words_of(batch.column("text"))
        items = batch.column("item").to_pylist()
        out: list[tuple[str | None, str]] = []
        for i, item in enumerate(items):
            first, last = int(words.bounds[i]), int(words.bounds[i + 1])
            for at in range(first, max(first + 1, last - size + 1), together):
                end = min(last, at + together + size - 1)
                if at < end:
                    out.append((item, words.data[words.start[at] : words.end[end - 1]].tobytes().decode()))
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.string()) for k in (0, 1)], names=["item", "text"])


def _blocks_of(items: DataFrame) -> tuple[int, Column]:
    """(number, block of an item's part) so that no block has more than ``BLOCK_BYTES`` of text, if no part has."""
    size, parts = items.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    blocks = max(1, -(-(size or 0) // BLOCK_BYTES))
    while True:
        block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
        if blocks == 1 or blocks > 2 * parts:
            return blocks, block
        largest = items.groupBy(block.alias("b")).agg(F.sum(F.octet_length("text")).alias("n")).agg(F.max("n")).first()[0]
        if largest <= BLOCK_BYTES:
            return blocks, block
        blocks *= 2


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans and items that the blocks have found in one text, as one."""
    for batch in batches:
        spans, items = [], []
        for found in batch.column("found").to_pylist():
            pairs = np.array([x for f in found for x in f["spans"]], np.int64).reshape(-1, 2)
            spans.append([x for r in merge(pairs[:, 0], pairs[:, 1]) for x in r])
            items.append(sorted({x for f in found for x in f["items"]}))
        yield pa.RecordBatch.from_arrays([batch.column("text_key"), pa.array(spans, _STATE[0][1]), pa.array(items, _STATE[1][1])], schema=_MERGED)


_MERGED = pa.schema([("text_key", pa.int64()), *_STATE[:2]])


def _with_matches(
    rows: DataFrame, benchmark: DataFrame, size: int, item_col: str, text_col: str, then: Callable | None = None, schema=None
) -> DataFrame:
    """``rows`` (with a column ``text``) and the merged word spans and items of all benchmark windows.

    ``then`` maps the batches of ``rows`` and spans to ``schema``. After a single block it runs in the pass that searches: a
    second Python pass of one stage would take another worker for every core.

    The benchmark goes to the tasks in blocks of bounded size, which the driver holds one at a time. One block
    is one pass over the documents. More are a staged pass each that keeps what it has found, by text; these
    are merged and joined to the documents.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    together = ITEM_WORDS
    items = stage(map_arrow(items.distinct(), lambda it: _item_parts(it, size, together), items.schema).distinct(), "benchmark-parts")
    blocks, block = _blocks_of(items)

    def searched(docs: DataFrame, b: int | None, then: Callable | None = None) -> DataFrame:
        texts = [] if b is None else [(r["item"], r["text"]) for r in items.filter(block == b).collect()]
        phrases, names = phrases_of(texts, size) if texts else None, docs.columns
        empty = {
            "spans": F.array().cast("array<bigint>"),
            "items": F.array().cast("array<string>"),
            "n_words": F.lit(0).cast("bigint"),
        }
        docs = docs.withColumns(empty)
        if then is not None:
            return map_arrow(docs, lambda it: then(_searched(it, phrases, names)), schema)
        return map_arrow(docs, lambda it: _searched(it, phrases, names), docs.schema)

    if blocks == 1:
        return searched(rows, 0, then)
    key = F.xxhash64("text").alias("text_key")
    found = []
    for b in range(blocks):
        hits = searched(rows.select("text", key), b).filter(F.size("spans") > 0)
        found.append(stage(hits.select("text_key", F.struct("spans", "items").alias("f")), "benchmark-hits"))
    whole = reduce(DataFrame.union, found).groupBy("text_key").agg(F.collect_set("f").alias("found"))
    whole = map_arrow(whole, _merged, _MERGED).withColumnsRenamed({"spans": "_spans", "items": "_items"})
    joined = searched(rows.select("*", key), None).join(whole, "text_key", "left")
    merged = joined.select(*rows.columns, F.coalesce("_spans", "spans").alias("spans"), F.coalesce("_items", "items").alias("items"), "n_words")
    return merged if then is None else map_arrow(merged.select(*rows.columns, "spans"), then, schema)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Which words of each document lie in a window of ``size`` benchmark words, and of which items.

    doc_id, n_words, n_hit (words inside an occurrence), n_items, items_sha256 (of the item ids sorted
    as strings and joined by commas), contaminated, spans (merged ranges of words, flat). Words are
    lower-cased runs of letters, digits and characters outside ASCII; an item shorter than a window is
    one window. A null or empty text has no words; an item without words or id is matched or listed by
    what it has; repeated rows give a row each; other columns are not read; an empty table on either
    side gives no rows or no hits.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = _with_matches(rows, benchmark, size, item_col, item_text_col)
    in_pairs = F.sequence(F.lit(0), F.size("spans") - 2, F.lit(2))
    hit = F.aggregate(in_pairs, F.lit(0).cast("long"), lambda a, i: a + F.get("spans", i + 1) - F.get("spans", i))
    n_hit = F.when(F.size("spans") > 0, hit).otherwise(F.lit(0).cast("long"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "spans",
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tb.slices(batch, "text"):
            words = _words_of(part.column("text"))
            out = part.column("text").to_pylist()
            data, offsets = tb.text_bytes(part.column("text"))
            for i, spans in enumerate(part.column("spans").to_pylist()):
                if spans:
                    at, kept = offsets[i], []
                    for s, e in zip(spans[::2], spans[1::2]):
                        kept.append(data[at : words.start[words.bounds[i] + s]].tobytes())
                        at = words.end[words.bounds[i] + e - 1]
                    kept.append(data[at : offsets[i + 1]].tobytes())
                    out[i] = b"".join(kept).decode()
            yield pa.RecordBatch.from_arrays([part.column("others"), pa.array(out, pa.string())], names=["others", "text"])


def remove_contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, text_col: str = "text") -> DataFrame:
    """The documents without the matched spans of words; all other text and columns stay as they are."""
    others = F.struct(*[F.col(c) for c in docs.columns if c != text_col], F.lit(True).alias("_row"))
    rows = docs.select(others.alias("others"), F.col(text_col).cast("string").alias("text"))
    cut = _with_matches(rows, benchmark, size, "item_id", "text", _cut, rows.schema)
    return cut.select(*[F.col("text").alias(c) if c == text_col else F.col("others")[c].alias(c) for c in docs.columns])
