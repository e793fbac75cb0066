"""Importance resampling toward a target corpus, ranked by parallel sorting with regular samples.

Words and runs of words are hashed into buckets; a bucket's gain is the log ratio of its share in the
target and in the corpus, an array that every task holds. A document's score is its mean gain plus Gumbel
noise from a hash of its id, so the highest scores are a sample without replacement.

The ranks come from a sort in four steps: every partition sorts its rows into a run; rows at regular places
of all runs give splitters; rows between two splitters meet in one segment and are merged there; counts of
the segments before it turn a place in a segment into a rank. Only segments that reach into the draw move.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm.frames import map_arrow, row_key
from tidewake.session import stage

BUCKETS = 10_000
GRAMS = 2
PERCENT = 25
LEAST_WORDS = 20
SEED = 7
SEGMENT_ROWS = 20_000
SEGMENTS = 4_096  # at most; what the driver holds is bounded by this and by the samples
SAMPLES = 65_536  # rows at regular places of all runs, beside one more for each run

_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
STRETCH = 1 << 20

_COUNTS = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64())]
)
_RUNS = pa.schema([*_ROWS, ("run", pa.int32()), ("place", pa.int64())])
_DEALT = pa.schema([*_RUNS, ("segment", pa.int32())])
_RANKED = pa.schema([*_ROWS, ("rank", pa.int64())])


def _stretches(text: bytes) -> Iterator[bytes]:
    """Parts of a text that begin and end between words, of about a megabyte."""
    at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + STRETCH)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def feature_buckets(text: str | None, grams: int = GRAMS, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in it) for each stretch of a text.

    A checksum goes on where another ended, so that of a run of words grows from that of the run without
    its last word.
    """
    before: list[bytes] = []
    for stretch in _stretches((text or "").encode("utf-8").lower()):
        new = _WORD.findall(stretch)
        words = before + new
        sums = list(map(crc32, words))
        found = sums[len(before) :]
        for longer in range(1, grams):
            sums = list(map(crc32, words[longer:], map(crc32, repeat(b" "), sums)))
            found += sums[max(0, len(before) - longer) :]
        before = words[-(grams - 1) :] if grams > 1 else []
        yield len(new), np.array(found, np.int64) % buckets


def _bucket_counts(batches: Iterator[pa.RecordBatch], grams: int, buckets: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(buckets, np.int64)
    for batch in batches:
        for text in batch.column("text"):
            for _, found in feature_buckets(text.as_py(), grams, buckets):
                counts += np.bincount(found, minlength=buckets)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], schema=_COUNTS)


def count_buckets(docs: DataFrame, grams: int, buckets: int, text_col: str = "text") -> dict[int, int]:
    """Features per bucket over all texts; ``buckets`` numbers at most."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    counts = map_arrow(texts, lambda it: _bucket_counts(it, grams, buckets), _COUNTS).groupBy("bucket").agg(F.sum("n").alias("n"))
    return {r["bucket"]: r["n"] for r in counts.collect()}


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    s_all, t_all = sum(corpus.values()), sum(target.values())
    return np.array(
        [
            math.floor(1000 * math.log((target.get(b, 0) + 1.0) * (s_all + buckets) / ((corpus.get(b, 0) + 1.0) * (t_all + buckets))))
            for b in range(buckets)
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weights(batches: Iterator[pa.RecordBatch], gain: np.ndarray, grams: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
        for i, text in enumerate(batch.column("text")):
            for n, found in feature_buckets(text.as_py(), grams, len(gain)):
                words[i] += n
                features[i] += len(found)
                total[i] += gain[found].sum()
        weight = total // np.maximum(features, 1)
        score = weight + np.array([noise(d, seed) for d in batch.column("doc_id").to_pylist()], np.int64)
        columns = [batch.column("doc_id"), batch.column("key"), *map(pa.array, (words, features, weight, score))]
        yield pa.RecordBatch.from_arrays(columns, schema=_ROWS)


def _in_order():
    return F.desc("score"), F.asc_nulls_last("doc_id")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted run with the run's number and their places."""
    run, place = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, run, np.int32)), pa.array(np.arange(place, place + n))], schema=_RUNS
        )
        place += n


def _position(score: int, doc_id: int | None, run: int, place: int) -> tuple:
    """What rows are sorted by; no two rows share it."""
    return -score, doc_id is None, doc_id or 0, run, place


def _dealt(batches: Iterator[pa.RecordBatch], splitters: list[tuple]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("score", "doc_id", "run", "place")))
        segment = [bisect.bisect_right(splitters, _position(*r)) for r in rows]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment, pa.int32())], schema=_DEALT)


def _ranked(batches: Iterator[pa.RecordBatch], before: list[int], wanted: int) -> Iterator[pa.RecordBatch]:
    """Ranks of rows that arrive segment by segment, in order; beyond the draw there is none."""
    current, inside = None, 0
    for batch in batches:
        rank = np.zeros(batch.num_rows, np.int64)
        segment = batch.column("segment").to_numpy()
        for part in np.split(np.arange(len(segment)), np.flatnonzero(np.diff(segment)) + 1):
            if len(part):
                if segment[part[0]] != current:
                    current, inside = segment[part[0]], 0
                rank[part] = before[current] + inside + 1 + np.arange(len(part))
                inside += len(part)
        columns = [batch.column(c) for c in _ROWS.names]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(rank, mask=rank > wanted)], schema=_RANKED)


def sorted_ranks(rows: DataFrame, percent: int, segment_rows: int = SEGMENT_ROWS, samples: int = SAMPLES) -> DataFrame:
    """The rows with rank 1, 2, 3... by score downward, then id, for the first ``percent`` in a hundred; null beyond."""
    runs = stage(map_arrow(rows.sortWithinPartitions(*_in_order()), _numbered, _RUNS), "sorted-runs")
    n = runs.count()
    wanted = percent * n // 100
    step = max(1, -(-n // samples))
    taken = runs.filter(F.col("place") % step == 0).select("score", "doc_id", "run", "place").collect()
    regular = sorted(_position(*r) for r in taken)
    segments = max(1, min(SEGMENTS, -(-n // segment_rows), len(regular)))
    splitters = [regular[i * len(regular) // segments] for i in range(1, segments)]
    dealt = stage(map_arrow(runs, lambda it: _dealt(it, splitters), _DEALT), "segments")
    sizes = {r["segment"]: r["count"] for r in dealt.groupBy("segment").count().collect()}
    before = np.concatenate([[0], np.cumsum([sizes.get(s, 0) for s in range(segments)])]).tolist()
    reached = max(1, sum(b < wanted for b in before[:-1]))
    within = dealt.filter(F.col("segment") < reached).repartitionById(reached, F.col("segment"))
    within = within.sortWithinPartitions("segment", *_in_order(), "run", "place")
    ranked = map_arrow(within, lambda it: _ranked(it, before, wanted), _RANKED)
    beyond = dealt.filter(F.col("segment") >= reached).select(*_ROWS.names, F.lit(None).cast("long").alias("rank"))
    return ranked.union(beyond)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    grams: int = GRAMS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_rows: int = SEGMENT_ROWS,
    samples: int = SAMPLES,
) -> DataFrame:
    """Per document: doc_id, key, n_words, n_features, weight, score and rank, null if it was not drawn.

    ``percent`` of the documents with at least ``least_words`` words are drawn, by score downward, ties to
    the smaller id, a null id last; equal rows count one by one. Words are lower-cased (A-Z) runs of
    letters, digits and characters outside ASCII. A null or empty text has no features and weight 0; a
    null id hashes as an empty one. ``key`` names equal rows. Other columns are not read; an empty table
    gives no rows, an empty target has a count of 0 in every bucket.
    """
    gain = gains(count_buckets(docs, grams, buckets, text_col), count_buckets(target, grams, buckets, text_col), buckets)
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    texts = docs.select(doc_id.alias("doc_id"), row_key(doc_id, text).alias("key"), text.alias("text"))
    weighted = stage(map_arrow(texts, lambda it: _weights(it, gain, grams, seed), _ROWS), "document-weights")
    long_enough = F.col("n_words") >= least_words
    short = weighted.filter(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return sorted_ranks(weighted.filter(long_enough), percent, segment_rows, samples).union(short)


def drawn_documents(docs: DataFrame, target: DataFrame, percent: int = PERCENT, **options) -> DataFrame:
    """The documents drawn, with all their columns; rows equal in id and text come together."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    drawn = resample(docs, target, percent, **options).filter("rank IS NOT NULL").select("key").distinct()
    key = row_key(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"))
    return rows.join(drawn, "key", "left_semi").select("row.*")
