"""Quality rules by distribution divergence.

A document is compared with its language: its histogram of character classes and its histogram of
the language's common words, each by Jensen-Shannon distance. The references are counted over all
documents. Two plain rules come first: too few words, and too large a share of words in repeated
eight-word windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.llm import textbytes as tb
from tidewake.llm.frames import map_arrow, spark_schema


@dataclass(frozen=True)
class Limits:
    """Thresholds; a guard below its minimum gives no verdict, so short texts are not judged on noise."""

    min_words: int = 20
    max_repeat_percent: int = 30
    min_chars_for_classes: int = 200
    max_class_distance: float = 0.34
    min_words_for_common: int = 60
    max_common_distance: float = 0.48
    min_reference_words: int = 5_000
    common_share: float = 0.002  # a common word makes up this share of its language, so at most 1 / share of them
    common_bytes: int = 12
    language_share: float = 0.01  # a language of its own; the others share one reference


# Character classes: lower case, upper case, digit, space, other white space, punctuation, symbol,
# control, not ASCII. Continuation bytes have no class, so that classes count code points.
CLASSES = 9
SKIP = 9
CLASS_OF = np.full(256, 7, np.uint8)
CLASS_OF[0x21:0x7F] = 6
CLASS_OF[0x61:0x7B] = 0
CLASS_OF[0x41:0x5B] = 1
CLASS_OF[0x30:0x3A] = 2
CLASS_OF[0x20] = 3
CLASS_OF[0x09:0x0E] = 4
CLASS_OF[[ord(c) for c in ".,;:!?'\"()-"]] = 5
CLASS_OF[0x80:0xC0] = SKIP
CLASS_OF[0xC0:] = 8
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

_COUNTS = pa.schema([("lang", pa.string()), ("kind", pa.int8()), ("key", pa.int64()), ("n", pa.int64())])
_FLUSH = 1_000_000


def _known_languages(docs: DataFrame, lang_col: str, limits: Limits) -> list[str]:
    """Languages that hold the share of documents that gives them a reference; at most 1 / share."""
    per = docs.groupBy(F.col(lang_col).cast("string").alias("lang")).count()
    total = docs.agg(F.count(F.lit(1)).alias("total"))
    rows = per.crossJoin(F.broadcast(total)).filter(F.col("count") >= F.col("total") * limits.language_share)
    return sorted(r["lang"] for r in rows.select("lang").collect() if r["lang"] is not None)


def _language(lang_col: str, known: list[str]) -> Column:
    lang = F.col(lang_col).cast("string")
    return F.when(lang.isin(known), lang) if known else F.lit(None).cast("string")


def _histogram_rows(batches: Iterator[pa.RecordBatch], limits: Limits) -> Iterator[pa.RecordBatch]:
    """Counts of character classes (kind 0) and of short words by hash (kind 1), per language."""
    names: dict[str | None, int] = {}
    held: list[np.ndarray] = []
    sizes = 0

    def summed() -> np.ndarray:
        rows = np.concatenate(held)
        order = np.lexsort((rows["key"], rows["kind"], rows["lang"]))
        rows = rows[order]
        new = np.ones(len(rows), bool)
        same = (rows["key"][1:] == rows["key"][:-1]) & (rows["kind"][1:] == rows["kind"][:-1])
        new[1:] = ~(same & (rows["lang"][1:] == rows["lang"][:-1]))
        starts = np.flatnonzero(new)
        out = rows[starts]
        out["n"] = np.add.reduceat(rows["n"], starts)
        return out

    def emit(rows: np.ndarray) -> pa.RecordBatch:
        labels = pa.array(list(names), pa.string()).take(pa.array(rows["lang"].astype(np.int64)))
        return pa.RecordBatch.from_arrays(
            [labels, pa.array(rows["kind"]), pa.array(rows["key"]), pa.array(rows["n"])], schema=_COUNTS
        )

    def push(lang: np.ndarray, kind: int, key: np.ndarray, n: np.ndarray) -> int:
        rows = np.zeros(len(key), [("lang", "i4"), ("kind", "i1"), ("key", "i8"), ("n", "i8")])
        rows["lang"], rows["kind"], rows["key"], rows["n"] = lang, kind, key, n
        held.append(rows)
        return len(rows)

    for batch in batches:
        for part in tb.slices(batch, "text"):
            data, offsets = tb.text_bytes(part.column("text"))
            langs = np.array([names.setdefault(x, len(names)) for x in part.column("lang").to_pylist()], np.int64)
            of_byte = np.repeat(langs, np.diff(offsets))
            classes = np.bincount(of_byte * (CLASSES + 1) + CLASS_OF[data], minlength=len(names) * (CLASSES + 1))
            seen = np.flatnonzero(classes)
            seen = seen[seen % (CLASSES + 1) != SKIP]
            sizes += push(seen // (CLASSES + 1), 0, seen % (CLASSES + 1), classes[seen])
            words = tb.split_words(data, offsets, tb.SPACE)
            short = words.end - words.start <= limits.common_bytes
            hashes = words.hashes().view(np.int64)
            of_word = langs[words.text]
            for lang in np.unique(of_word):
                here = of_word == lang
                key, n = np.unique(hashes[here & short], return_counts=True)
                sizes += push(np.full(len(key), lang), 1, key, n)
                sizes += push(np.array([lang]), 2, np.array([0]), np.array([here.sum()]))
            if sizes > _FLUSH:
                held[:] = [summed()]
                sizes = len(held[0])
                if sizes > _FLUSH:
                    yield emit(held.pop())
                    sizes = 0
    if held:
        yield emit(summed())


def language_references(docs: DataFrame, limits: Limits, lang_col: str = "lang", text_col: str = "text") -> dict:
    """Per language (None: all languages without one of their own): class shares, common-word hashes and shares.

    Counted over all documents. What reaches the driver is bounded: at most 1 / ``language_share`` + 1
    languages with nine classes and at most 1 / ``common_share`` words each.
    """
    known = _known_languages(docs, lang_col, limits)
    rows = docs.select(_language(lang_col, known).alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = (
        map_arrow(rows, lambda it: _histogram_rows(it, limits), _COUNTS)
        .groupBy("lang", "kind", "key")
        .agg(F.sum("n").alias("n"))
    )
    # The total of a language travels with its words as the words' largest possible share.
    least = F.when(F.col("kind") == 1, F.col("n")).otherwise(None)
    heads = counts.filter(least.isNull() | (least >= 2)).groupBy("lang", "kind", "key").agg(F.max("n").alias("n"))
    totals = {r["lang"]: r["n"] for r in heads.filter("kind = 2").collect()}
    keep = F.col("kind") == 0
    for lang, total in totals.items():
        same = F.col("lang").eqNullSafe(F.lit(lang))
        keep = keep | ((F.col("kind") == 1) & same & (F.col("n") >= max(2, limits.common_share * total)))
    out = {}
    for r in heads.filter(keep).collect():
        ref = out.setdefault(r["lang"], {"classes": np.zeros(CLASSES), "words": {}, "total": totals.get(r["lang"], 0)})
        if r["kind"] == 0:
            ref["classes"][r["key"]] = r["n"]
        else:
            ref["words"][r["key"]] = r["n"]
    for ref in out.values():
        ref["classes"] = ref["classes"] / max(1, ref["classes"].sum())
        hashes = np.array(sorted(ref["words"]), np.int64)
        shares = np.array([ref["words"][h] for h in hashes], float) / max(1, ref["total"])
        ref["hashes"], ref["shares"] = hashes, np.append(shares, max(0.0, 1 - shares.sum()))
        del ref["words"]
    return {"known": known, "of": out}


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row of p to the distribution q."""
    m = (p + q) / 2

    def part(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0).sum(axis=1)

    return np.sqrt(np.clip((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0, 1))


def _repeated_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    repeated = 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line.strip():
            seen.add(line)
    return repeated


def _measures(part: pa.RecordBatch, refs: dict, limits: Limits) -> dict[str, np.ndarray]:
    data, offsets = tb.text_bytes(part.column("text"))
    n = part.num_rows
    words = tb.split_words(data, offsets, tb.SPACE)
    n_words = words.counts()
    hashes = words.hashes()

    points = np.concatenate([[0], np.cumsum((CLASS_OF[data] != SKIP) & ~tb.SPACE[data])])
    word_chars = points[offsets[1:]] - points[offsets[:-1]]
    n_symbols = tb.per_text(SYMBOL[data], offsets)

    first, window = tb.window_hashes(words, hashes, 8)
    key = tb.mix(window ^ words.text[first].astype(np.uint64))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    n_repeat = tb.per_text(tb.cover(first[twice], 8, len(hashes)), words.bounds)
    n_dup = np.array([_repeated_lines(data[s:e].tobytes()) for s, e in zip(offsets[:-1], offsets[1:])], np.int64)
    base_failed = (n_words < limits.min_words) | (100 * n_repeat > limits.max_repeat_percent * n_words)

    of_byte = np.repeat(np.arange(n), np.diff(offsets))
    classes = np.bincount(of_byte * (CLASSES + 1) + CLASS_OF[data], minlength=n * (CLASSES + 1))
    classes = classes.reshape(n, CLASSES + 1)[:, :CLASSES].astype(float)
    chars = classes.sum(axis=1)
    class_distance = np.zeros(n)
    common_distance = np.zeros(n)
    langs = part.column("lang").to_pylist()
    for lang in set(langs):
        ref = refs.get(lang)
        if ref is None or ref["total"] < limits.min_reference_words:
            continue
        here = np.array([i for i, x in enumerate(langs) if x == lang])
        judged = here[chars[here] >= limits.min_chars_for_classes]
        if len(judged):
            class_distance[judged] = js_distance(classes[judged] / chars[judged, None], ref["classes"])
        judged = here[n_words[here] >= limits.min_words_for_common]
        if len(judged) and len(ref["hashes"]):
            row = np.full(n, -1)
            row[judged] = np.arange(len(judged))
            mine = np.flatnonzero(row[words.text] >= 0)
            values = hashes[mine].view(np.int64)
            bins = np.minimum(np.searchsorted(ref["hashes"], values), len(ref["hashes"]) - 1)
            width = len(ref["hashes"]) + 1
            bins = np.where(ref["hashes"][bins] == values, bins, width - 1)
            table = np.bincount(row[words.text[mine]] * width + bins, minlength=len(judged) * width)
            table = table.reshape(len(judged), width)
            common_distance[judged] = js_distance(table / n_words[judged, None], ref["shares"])
    kept = (
        ~base_failed
        & (class_distance <= limits.max_class_distance)
        & (common_distance <= limits.max_common_distance)
    )
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "kept": kept,
        "class_distance": class_distance,
        "common_distance": common_distance,
    }


_MEASURES = [
    *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    ("base_failed", pa.bool_()),
    ("kept", pa.bool_()),
    ("class_distance", pa.float64()),
    ("common_distance", pa.float64()),
]


def score_quality(
    docs: DataFrame,
    limits: Limits = Limits(),
    text_col: str = "text",
    lang_col: str = "lang",
    keep_cols: tuple[str, ...] = ("doc_id",),
    keep_row: bool = False,
) -> DataFrame:
    """The measures and the verdict of every document, beside ``keep_cols``.

    Words are runs of bytes other than ASCII white space. ``kept`` is false for a document with fewer
    than ``min_words`` words or too many words in repeated windows, else for one whose distance to its
    language's reference is over a limit. A null or empty text has no words and fails; a null language
    or one without a reference of its own is compared with the documents of all such languages; a
    reference of fewer than ``min_reference_words`` words gives no verdict. Equal rows get equal rows;
    an empty table gives an empty table. Only ``keep_cols`` are carried, as ``keep_<i>`` inside, so a
    column named like a measure does no harm; with ``keep_row`` all columns come back as a struct
    ``row`` instead.
    """
    refs = language_references(docs, limits, lang_col, text_col)
    known, of = refs["known"], refs["of"]
    kept = F.struct("*").alias("row") if keep_row else None
    carried = docs.select(
        *([kept] if keep_row else [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep_cols)]),
        _language(lang_col, known).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    names = [c for c in carried.columns if c not in ("lang", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, "text"):
                got = _measures(part, of, limits)
                columns = [part.column(c) for c in names] + [pa.array(got[c], t) for c, t in _MEASURES]
                yield pa.RecordBatch.from_arrays(columns, names=names + [c for c, _ in _MEASURES])

    schema = carried.select(*names).schema
    for field in spark_schema(pa.schema(_MEASURES)):
        schema = schema.add(field)
    out = map_arrow(carried, run, schema)
    if keep_row:
        return out
    return out.select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep_cols)], *[c for c, _ in _MEASURES])


def drop_low_quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, with all their columns."""
    return score_quality(docs, limits, keep_row=True).filter("kept").select("row.*")
