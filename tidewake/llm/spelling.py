"""Spelling variants: words one edit apart, found by pivotal bigrams.

Bigrams are ordered by how rare they are. A word's prefix is its three rarest bigrams (and any that tie
with the last); two of them that do not overlap are its pivots, chosen by dynamic programming so that
their index lists are shortest. One edit spoils one of two such pivots at most. So of two words one edit
apart, the one whose prefix ends earlier in the order has a pivot in the other's prefix, at a place that
the lengths fix or leave one choice. Prefixes are the index, pivots look it up, and what meets is verified
inside the join.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm.frames import map_arrow, texts
from tidewake.session import stage

LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
SLIP = 199  # one run in so many loses a letter
PREFIX = 3  # bigrams: two for one edit, and one more
HELD_WORDS = 200_000
STRETCH = 1 << 20

# The letters are a-z and U+00C0 to U+00FF, so there are at most 90 * 90 bigrams.
_LETTERS = "a-zÀ-ÿ"
_NO_LETTER = re.compile(f"[^{_LETTERS}]")

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_PLACED = pa.list_(pa.struct([("gram", pa.int32()), ("at", pa.int32())]))
_GRAMS = pa.schema(
    [("word", pa.string()), ("n", pa.int64()), ("size", pa.int32()), ("last", pa.int32()), ("letters", pa.int64()), ("prefix", _PLACED), ("pivots", _PLACED)]
)


def _runs(text: str, least: int) -> Iterator[list[str]]:
    """Runs of letters, lower-cased (A-Z), stretch by stretch; too short ones are left out."""
    text = text.encode("utf-8").lower().decode("utf-8")
    pattern, at = re.compile(f"[{_LETTERS}]{{{least},}}"), 0
    while at < len(text):
        cut = _NO_LETTER.search(text, at + STRETCH)
        end = cut.start() if cut else len(text)
        yield pattern.findall(text, at, end)
        at = end


def _word_counts(batches: Iterator[pa.RecordBatch], least: int, slip: int) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for runs in _runs(text.as_py() or "", least):
                for run, n in Counter(runs).items():
                    if slip and not (h := crc32(run.encode("utf-8"), start)) % slip:
                        run = run[: h % len(run)] + run[h % len(run) + 1 :]
                        if len(run) < least:
                            continue
                    held[run] += n
            if len(held) > HELD_WORDS:
                yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], schema=_COUNTS)
                held.clear()
    yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], schema=_COUNTS)


def count_words(
    docs: DataFrame, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, slip: int = SLIP, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, n) of the words of at least ``least`` letters that occur ``least_count`` times or more.

    One distinct run of a document in ``slip``, by a checksum, loses a letter first; ``slip=0`` for none.
    """
    counts = map_arrow(texts(docs, id_col, text_col), lambda it: _word_counts(it, least, slip), _COUNTS)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def pivots(prefix: list[tuple[int, int]], weight: list[int]) -> list[tuple[int, int]]:
    """Two (bigram, place) of a prefix that do not overlap, of least total weight.

    By place: the best single one that ends before a place, extended by the one at that place.
    """
    by_place = sorted(prefix, key=lambda g: g[1])
    best, total, single, behind = None, 0, None, 0
    for gram, at in by_place:
        while by_place[behind][1] <= at - 2:
            if single is None or weight[by_place[behind][0]] < weight[single[0]]:
                single = by_place[behind]
            behind += 1
        if single is not None and (best is None or weight[single[0]] + weight[gram] < total):
            best, total = [single, (gram, at)], weight[single[0]] + weight[gram]
    return best


def _word_grams(batches: Iterator[pa.RecordBatch], rank: dict[str, int], weight: list[int]) -> Iterator[pa.RecordBatch]:
    as_rows = lambda grams: [{"gram": g, "at": at} for g, at in grams]
    for batch in batches:
        rows = []
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            order = sorted((rank[word[i : i + 2]], i) for i in range(len(word) - 1))
            last = order[PREFIX - 1][0]
            prefix = [g for g in order if g[0] <= last]
            letters = 0
            for c in set(word):
                letters |= 1 << (ord(c) * 7 % 63)
            rows.append((word, n, len(word), last, letters, as_rows(prefix), as_rows(pivots(prefix, weight))))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_GRAMS)], schema=_GRAMS)


def near_words(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) for each pair a < b of ``words`` (word, n) that one insertion, deletion or replacement parts.

    Words are distinct, of letters a-z and U+00C0 to U+00FF only, four at least.
    """
    at = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = words.select(F.explode(F.transform(at, lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("gram"))
    counted = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "gram").collect()  # 8,100 at most
    rank, weight = {r["gram"]: i for i, r in enumerate(counted)}, [r["n"] for r in counted]
    placed = stage(map_arrow(words.select("word", "n"), lambda it: _word_grams(it, rank, weight), _GRAMS), "word-bigrams")
    index = placed.select(
        F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("last").alias("b_last"), F.col("letters").alias("b_letters"), "size", F.inline("prefix")
    )
    # By how much the other word is longer, and how far the pivot has moved in it.
    moves = F.array(*[F.struct(F.lit(d).alias("longer"), F.lit(m).alias("moved")) for d, m in ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))])
    look = placed.select("word", "n", "last", "letters", "size", F.inline("pivots")).withColumn("move", F.explode(moves))
    look = look.select(
        F.col("word").alias("a"),
        F.col("n").alias("a_n"),
        "last",
        "letters",
        (F.col("size") + F.col("move.longer")).alias("size"),
        "gram",
        (F.col("at") + F.col("move.moved")).alias("at"),
    )
    met = look.join(
        index,
        (look["gram"] == index["gram"])
        & (look["at"] == index["at"])
        & (look["size"] == index["size"])
        & (F.col("last") <= F.col("b_last"))
        & (F.bit_count(F.col("letters").bitwiseXOR(F.col("b_letters"))) <= 2)
        & (F.levenshtein("a", "b", 1) == 1),
    )
    first = F.col("a") < F.col("b")
    return met.select(
        F.least("a", "b").alias("a"),
        F.when(first, F.col("a_n")).otherwise(F.col("b_n")).alias("a_n"),
        F.greatest("a", "b").alias("b"),
        F.when(first, F.col("b_n")).otherwise(F.col("a_n")).alias("b_n"),
    ).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by doubling: forms only grow in count, so chains end."""
    current = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        step = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moves = stage(step.join(current.select("root").distinct(), "root", "left_semi"), "form-steps")
        if not moves.limit(1).count():
            return current
        current = current.join(moves, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        current = stage(current, "roots")


def spelling_variants(
    docs: DataFrame,
    least: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    slip: int = SLIP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per word of the corpus: word, form, root, n, n_near, form_n.

    Words are those of ``count_words``. ``form`` is the near word of largest count (ties: first in
    code-point order) if it occurs at least ``ratio`` times as often, else null; ``root`` is the last
    word along the forms, the word itself if it has none. A null or empty text has no words, a null id
    reads as an empty one; repeated rows count each time; other columns are not read; an empty table
    gives no rows. A run of any length is one word.
    """
    if least < PREFIX + 1:
        raise ValueError(f"words need at least {PREFIX + 1} letters")
    words = stage(count_words(docs, least, least_count, slip, id_col, text_col), "words")
    pairs = stage(near_words(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(
        pairs.select(F.col("b"), F.col("a"), F.col("a_n"))
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    better = -F.col("best.less") >= ratio * F.col("n")
    formed = words.join(best, "word", "left").select(
        "word",
        F.when(better, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, -F.col("best.less")).alias("form_n"),
    )
    formed = stage(formed, "word-forms")
    roots = _roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
