"""Substring deduplication by seed and extend.

Seeds are winnowed word n-grams: every window of the threshold length holds one, and equal windows hold
the same. A seed carries the hash of its context, as far as windows around it reach. Where a smaller
document has a seed with the same context, the match extends over the whole context; where contexts
differ, one document per context is extended both ways, window by window. Overlapping matches merge
into maximal repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm import textbytes as tb
from tidewake.llm.frames import map_arrow, row_key
from tidewake.session import stage

WINDOW_WORDS = 50
SEED_WORDS = 10

_SEEDS = pa.schema([("seed", pa.int64()), ("context", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("at", pa.int32())])
_WINDOWS = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("at", pa.int32())])


def _seeds(batches: Iterator[pa.RecordBatch], window: int, size: int) -> Iterator[pa.RecordBatch]:
    reach = window - size
    for batch in batches:
        for part in tb.slices(batch, "text"):
            words = tb.split_words(*tb.text_bytes(part.column("text")), tb.SPACE)
            hashes = words.hashes()
            first, gram = tb.window_hashes(words, hashes, size)
            if not len(first):
                continue
            # Grams that cross texts take the largest value, so that none of them is a minimum by itself.
            values = np.full(len(hashes) - size + 1, np.iinfo(np.uint64).max)
            values[first] = gram
            at = tb.winnow(values, reach + 1)
            inside = words.text[at] == words.text[at + size - 1]
            long = words.counts()[words.text[at]] >= window
            at = at[inside & long]
            text = words.text[at]
            left = np.maximum(at - reach, words.bounds[text])
            right = np.minimum(at + size + reach, words.bounds[text + 1])
            sums = tb.prefix_sums(hashes, tb.SALT_B)
            context = tb.mix(tb.range_hash(sums, left, right, tb.SALT_B) + (at - left).astype(np.uint64) * tb.SALT_A)
            columns = [pa.array(values[at].view(np.int64)), pa.array(context.view(np.int64))]
            columns += [part.column(c).take(pa.array(text)) for c in ("doc_id", "key")]
            columns.append(pa.array((at - words.bounds[text]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(columns, schema=_SEEDS)


def _extended(batches: Iterator[pa.RecordBatch], window: int, size: int) -> Iterator[pa.RecordBatch]:
    """Both hashes of each window that holds one of the given seeds."""
    for batch in batches:
        for part in tb.slices(batch, "text"):
            words = tb.split_words(*tb.text_bytes(part.column("text")), tb.SPACE)
            hashes = words.hashes()
            first, h1 = tb.window_hashes(words, hashes, window, tb.SALT_A)
            _, h2 = tb.window_hashes(words, hashes, window, tb.SALT_B)
            lists = part.column("at")
            seeds = lists.flatten().to_numpy()
            seeds = seeds + np.repeat(words.bounds[:-1], pc_lengths(lists))
            wanted = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(wanted, np.maximum(seeds + size - window, 0), 1)
            np.add.at(wanted, seeds + 1, -1)
            chosen = np.flatnonzero(np.cumsum(wanted)[first] > 0)
            at, text = first[chosen], words.text[first[chosen]]
            columns = [pa.array(h1[chosen].view(np.int64)), pa.array(h2[chosen].view(np.int64))]
            columns += [part.column(c).take(pa.array(text)) for c in ("doc_id", "key")]
            columns.append(pa.array((at - words.bounds[text]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(columns, schema=_WINDOWS)


def pc_lengths(lists: pa.Array) -> np.ndarray:
    return np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), row_key(doc_id, text).alias("key"))


def repeated_spans(docs: DataFrame, window: int = WINDOW_WORDS, seed: int = SEED_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key and spans (array of start and end words) of what repeats a smaller document."""
    rows = _rows(docs, id_col, text_col)
    known = rows.filter(F.col("doc_id").isNotNull())
    seeds = stage(map_arrow(known, lambda it: _seeds(it, window, seed), _SEEDS), "passage-seeds")
    shared = (
        seeds.groupBy("seed")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min("context").alias("c1"), F.max("context").alias("c2"))
        .filter("low < high")
        .select("seed", (F.col("c1") < F.col("c2")).alias("differs"))
    )
    met = stage(seeds.join(shared, "seed"), "passage-met")
    owner = met.groupBy("seed", "context").agg(F.min("doc_id").alias("owner"))
    met = stage(met.join(owner, ["seed", "context"]), "passage-owned")
    reach = window - seed
    covered = met.filter("owner < doc_id").select("doc_id", "key", (F.col("at") - reach).alias("s"), (F.col("at") + window).alias("e"))
    extend = met.filter("differs and owner = doc_id").groupBy("doc_id", "key").agg(F.collect_set("at").alias("at"))
    # collect_set is bounded by the length of one document.
    texts = known.select("doc_id", "key", "text").join(extend, ["doc_id", "key"]).dropDuplicates(["doc_id", "key"])
    windows = stage(map_arrow(texts.select("doc_id", "key", "text", "at"), lambda it: _extended(it, window, seed), _WINDOWS), "passage-windows")
    earliest = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    matched = windows.join(earliest.select("h1", "h2", "low"), ["h1", "h2"]).filter("low < doc_id")
    spans = covered.union(matched.select("doc_id", "key", F.col("at").alias("s"), (F.col("at") + window).alias("e")))
    return spans.groupBy("doc_id", "key").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()),
        ("kept_text", pa.string()),
    ]
)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tb.slices(batch, "text"):
            words = tb.split_words(*tb.text_bytes(part.column("text")), tb.SPACE)
            counts = words.counts()
            removed, kept_texts, digests = [], [], []
            for i, spans in enumerate(part.column("spans").to_pylist()):
                n, base = int(counts[i]), int(words.bounds[i])
                keep = np.ones(n, bool)
                for span in spans or ():
                    keep[max(0, span["s"]) : span["e"]] = False
                if keep.all():
                    kept = words.line_of_words(base, base + n)
                else:
                    at = np.flatnonzero(keep) + base
                    kept = b" ".join(words.data[s:e].tobytes() for s, e in zip(words.start[at], words.end[at]))
                removed.append(n - int(keep.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept)
            columns = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests), pa.array(kept_texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=_OUT)


def drop_repeated_passages(docs: DataFrame, window: int = WINDOW_WORDS, seed: int = SEED_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document without the words of passages that a document with a smaller id has too.

    doc_id, n_words, n_removed, kept_sha256 and kept_text (the words left, joined by one space). A
    passage is a run of at least ``window`` words, equal byte for byte; words are runs of bytes other
    than ASCII white space. A null text has no words. A null id is in no order: such a document is left
    alone and removes nothing. Rows of one id do not remove each other's words, repeated rows give a
    row each, other columns are not read, an empty table gives no rows.
    """
    spans = repeated_spans(docs, window, seed, id_col, text_col)
    rows = _rows(docs, id_col, text_col)
    joined = rows.join(spans, ["doc_id", "key"], "left")
    return map_arrow(joined.select("doc_id", "text", "spans"), _without, _OUT)
