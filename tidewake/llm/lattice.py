"""Language-model score by a subword lattice.

A word's probability is summed over all its segmentations into the pieces of an existing vocabulary, by
forward recursion in log space. The vocabulary's scores weight the pieces as they are: nothing is fitted.
They are ranks, not log probabilities, so a piece weighs 1 / (rank + 10), as frequencies fall with rank. A
word seen in training has one more arc over its whole length, weighted by its discounted frequency; the
lattice of pieces carries the mass that discounting takes from the seen words. The document's probability
is the product over its words and its end.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidewake.llm import textbytes as tb
from tidewake.llm.frames import map_arrow
from tidewake.session import stage

HEAD_WORDS = 150_000  # the most frequent words are sent to every task; the others are joined
FLUSH_WORDS = 300_000
HEAD_BYTES = 64  # the longest word that is sent to every task

_COUNTS = pa.schema([("word", pa.binary()), ("train", pa.int64()), ("every", pa.int64())])
_PARTS = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("head_known", pa.int64()),
        ("head_base", pa.float64()),
        ("head_score", pa.float64()),
        ("word", pa.binary()),
        ("n", pa.int64()),
    ]
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of bytes other than ASCII white space."""
    return text.lower().split()


@dataclass
class Pieces:
    """A vocabulary as bytes with log weights: ``starting`` pieces begin a word, ``inner`` ones go on.

    The weights of each sort sum to 1, and the choice to end after a piece or to go on is even, which makes a
    distribution over words. Every byte is a piece of both sorts, so that every word has a segmentation.
    """

    starting: dict[bytes, float]
    inner: dict[bytes, float]


HALF = math.log(0.5)


def load_pieces(path: str) -> Pieces:
    """Pieces of a sentencepiece model of any length; their scores fall with rank, and give weights of 1 / (rank + 10)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    starting: dict[bytes, float] = {}
    inner: dict[bytes, float] = {}
    n = model.get_piece_size()
    for i in range(n):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        raw = piece.lstrip("▁").encode()
        if not raw or "▁" in piece[1:] or raw != raw.lower():
            continue
        rank = min(n, -model.get_score(i))
        (starting if piece.startswith("▁") else inner).setdefault(raw, 1 / (rank + 10.0))
    for table in (starting, inner):
        for byte in range(256):
            table.setdefault(bytes([byte]), 1 / (4.0 * n))
        whole = sum(table.values())
        for piece, weight in table.items():
            table[piece] = math.log(weight / whole)
    return Pieces(starting, inner)


class Lattice:
    """Forward sums over the segmentations of a word, whatever its length."""

    def __init__(self, pieces: Pieces):
        self.tables = [self._with_beginnings(t) for t in (pieces.starting, pieces.inner)]
        self.longest = max(map(len, [*pieces.starting, *pieces.inner]))

    @staticmethod
    def _with_beginnings(table: dict[bytes, float]) -> dict[bytes, float | None]:
        """The pieces, and None for what only begins a piece, so that a search ends where no piece goes on."""
        out: dict[bytes, float | None] = {p[:k]: None for p in table for k in range(1, len(p))}
        out.update(table)
        return out

    def log_probability(self, word: bytes) -> float:
        """Natural logarithm; only the positions that a piece can reach from here are held."""
        n, size = len(word), self.longest + 1
        ahead: list[float] = [-math.inf] * size
        ahead[0] = 0.0
        table, rest = self.tables
        exp, log1p = math.exp, math.log1p
        for begin in range(n):
            slot = begin % size
            here, ahead[slot] = ahead[slot], -math.inf
            for end in range(begin + 1, min(n, begin + self.longest) + 1):
                weight = table.get(word[begin:end], 0.0)
                if weight is None:
                    continue
                if weight == 0.0:  # no piece and no beginning of one; a weight is below 0
                    break
                into = end % size
                old, new = ahead[into], here + weight + HALF
                if old > new:
                    ahead[into] = old + log1p(exp(new - old))
                elif old == -math.inf:
                    ahead[into] = new
                else:
                    ahead[into] = new + log1p(exp(old - new))
            table = rest
        return ahead[n % size]


def _held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    train: Counter = Counter()
    other: Counter = Counter()

    def flush() -> pa.RecordBatch:
        words = list(train.keys() | other.keys())
        n = [train[w] for w in words]
        every = [train[w] + other[w] for w in words]
        train.clear()
        other.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n, pa.int64()), pa.array(every, pa.int64())], schema=_COUNTS)

    for batch in batches:
        held = batch.column("held_out").to_pylist()
        data, offsets = tb.text_bytes(batch.column("text"))
        for i, out in enumerate(held):
            (other if out else train).update(words_of(data[offsets[i] : offsets[i + 1]].tobytes()))
            if len(train) + len(other) > FLUSH_WORDS:
                yield flush()
    yield flush()


def _lattice_scores(batches: Iterator[pa.RecordBatch], lattice: Lattice) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [lattice.log_probability(w.as_py()) for w in batch.column("word")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, "lattice"])


def _score_documents(batches: Iterator[pa.RecordBatch], head: dict[bytes, tuple], end: tuple) -> Iterator[pa.RecordBatch]:
    """Per document one row with the sums over frequent words, and one per other word of it."""
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        for part in tb.slices(batch, "text"):
            rows: list[tuple] = []
            data, offsets = tb.text_bytes(part.column("text"))
            for i, (doc_id, held) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("held_out").to_pylist())):
                counts = Counter(words_of(data[offsets[i] : offsets[i + 1]].tobytes()))
                known, base, score = end
                total = 1
                for word, n in counts.items():
                    total += n
                    got = head.get(word)
                    if got is None:
                        rows.append((row, None, None, None, None, None, None, word, n))
                    else:
                        known += n * got[0]
                        base += n * got[1]
                        score += n * got[2]
                # No word begins with a space: this key meets no word and spreads the rows.
                rows.append((row, doc_id, held, total, known, base, score, b" %d" % row, 0))
                row += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PARTS)], schema=_PARTS)


def score_documents(
    docs: DataFrame, vocabulary: str, head_words: int = HEAD_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Log10 probability of every text under the lattice model and under add-one word counts.

    doc_id, held_out (crc32 of the id as text is 2 modulo 7; such documents teach nothing), n_tokens
    (words and the end), n_known (tokens seen in training), train_tokens, base_score, score. A null text
    is its end alone; a null id counts as an empty text for the split and stays null; repeated rows give
    a row each; other columns are not read; an empty table gives no rows. With no training documents the
    score is the lattice's alone. At most ``head_words`` words of at most 64 bytes go to every task, however
    large the vocabulary of the corpus grows; the others are joined. A word may be as long as its text.
    """
    doc_id = F.col(id_col).cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.col(text_col).cast("string").alias("text"), _held_out(doc_id).alias("held_out"))
    counts = map_arrow(rows.select("text", "held_out"), _count_words, _COUNTS)
    counts = stage(counts.groupBy("word").agg(F.sum("train").alias("train"), F.sum("every").alias("every")), "word-counts")
    seen = F.col("train") > 0
    totals = counts.agg(
        F.sum("train").alias("tokens"),
        F.count_if(seen).alias("distinct"),
        F.count_if(F.col("train") == 1).alias("once"),
        F.count_if(F.col("train") == 2).alias("twice"),
    ).first()
    ends = rows.filter(~F.col("held_out")).count()
    words = totals["tokens"] or 0
    n, v = words + ends, (totals["distinct"] or 0) + (1 if ends else 0)

    lattice = Lattice(load_pieces(vocabulary))

    # Absolute discounting: what it takes from the seen words weighs the lattice of pieces.
    once, twice = totals["once"] or 0, totals["twice"] or 0
    discount = once / (once + 2 * twice) if once and twice else 0.5
    left = discount * (totals["distinct"] or 0) / words if words else 1.0
    p_end = (ends + 1) / (n + 2)
    arc = F.greatest(F.col("train") - discount, F.lit(0.0)) / max(1, words)
    probability = (arc + left * F.exp("lattice")) * (1 - p_end)
    # A word far too long for a double keeps its logarithm.
    log_p = F.when(F.col("lattice") > -700, F.log10(probability)).when(seen, F.log10(arc * (1 - p_end))).otherwise(
        F.col("lattice") / math.log(10) + math.log10(left * (1 - p_end) or 1.0)
    )
    base_of = F.log10((F.col("train") + 1) / F.lit(float(n + v + 1)))
    with_lattice = StructType([*counts.schema.fields, StructField("lattice", DoubleType())])
    scored = map_arrow(counts, lambda it, m=lattice: _lattice_scores(it, m), with_lattice)
    scored = stage(scored.select("word", "every", seen.cast("long").alias("known"), base_of.alias("base"), log_p.alias("log_p")), "word-scores")

    # The frequency above which at most ``head_words`` words lie.
    top = 100_000
    short = F.octet_length("word") <= HEAD_BYTES
    sizes = scored.filter(short).groupBy(F.least("every", F.lit(top)).alias("every")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, sofar = top + 1, 0
    for r in sorted(sizes, key=lambda r: -r["every"]):
        sofar += r["n"]
        if sofar > head_words:
            break
        least = r["every"]
    head = {bytes(r["word"]): (r["known"], r["base"], r["log_p"]) for r in scored.filter(short & (F.col("every") >= least)).drop("every").collect()}
    end = (1 if ends else 0, math.log10((ends + 1) / (n + v + 1)), math.log10(p_end))
    parts = map_arrow(rows, lambda it: _score_documents(it, head, end), _PARTS)
    rest = scored.filter(~short | (F.col("every") < least)).drop("every")
    total = lambda name: F.sum(F.coalesce(F.col("n") * F.col(name), F.lit(0)))
    return (
        parts.join(rest, "word", "left")
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.max("n_tokens").alias("n_tokens"),
            (F.max("head_known") + total("known")).alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            (F.max("head_base") + total("base")).alias("base_score"),
            (F.max("head_score") + total("log_p")).alias("score"),
        )
        .drop("row")
    )
