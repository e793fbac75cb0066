"""Repeated byte strings by longest-previous-factor arrays.

Suffix arrays are built over small neighbourhoods instead of the corpus: every string of the threshold
length holds a winnowed seed, and equal strings hold the same, so they are compared where they have it.
Seeds with one context everywhere need no suffix order: all of the context repeats. Where a seed's contexts
differ, one context of each sort goes into the suffix array of its seed. Its contexts stand in order of what
follows the seed and, read backwards, of what precedes it, each with the lengths that neighbours share. That
ranks the suffixes that begin at any distance before the seed by their first bytes up to the threshold; equal
ones stand by their places in the corpus. So the previous smaller place of a suffix, if one shares the
threshold with it, is its left neighbour: its longest previous factor reaches the threshold exactly then, and
its right neighbour is a later match. Contexts that share neither half of the threshold around their seed stay
out of the order. Seeds with too many contexts for one task are settled by hashes of the strings around them
instead: first of long stretches of neighbouring strings, then of ever shorter ones where stretches agree in
part, down to single strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm import textbytes as tb
from tidewake.llm.components import semi_join
from tidewake.llm.frames import map_arrow, row_key
from tidewake.llm.ngram_join import _groups as sorted_groups
from tidewake.llm.ngram_join import _same_group as group_numbers
from tidewake.session import stage

WINDOW_BYTES = 400
SEED_BYTES = 64
HOT_CONTEXTS = 1000
HASHED_CONTEXTS = 1000
PART_BYTES = 500_000
STRETCHES = (64, 16, 4, 1)

_PLACE = [("doc_id", pa.int64()), ("key", pa.int64()), ("at", pa.int64())]
_SEEDS = pa.schema([("seed", pa.int64()), ("context", pa.int64()), *_PLACE, ("s", pa.int64()), ("e", pa.int64())])
_CONTEXTS = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("at", pa.int64()), ("s", pa.int64()), ("bytes", pa.binary())])
_STRETCHES = pa.schema([(c, pa.int64()) for c in ("seed", "stretch", "cut", "h1", "h2", "core", "doc_id", "key", "at", "s", "e")])
_SPANS = pa.schema([("key", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])


def _seeds(batches: Iterator[pa.RecordBatch], window: int, size: int) -> Iterator[pa.RecordBatch]:
    reach = window - size
    for batch in batches:
        for part in tb.slices(batch, "text"):
            data, offsets = tb.text_bytes(part.column("text"))
            n = len(data) - size + 1
            if n <= 0:
                continue
            sums = tb.prefix_sums(data.astype(np.uint64) + tb.ONE, tb.BASE)
            begin = np.arange(n)
            gram = tb.range_hash(sums, begin, begin + size, tb.BASE)
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            crossing = text[:n] != text[size - 1 :]
            gram[crossing] = np.iinfo(np.uint64).max
            at = tb.winnow(gram, reach + 1)
            at = at[~crossing[at]]
            at = at[np.diff(offsets)[text[at]] >= window]
            left = np.maximum(at - reach, offsets[text[at]])
            right = np.minimum(at + size + reach, offsets[text[at] + 1])
            context = tb.mix(tb.range_hash(sums, left, right, tb.BASE) ^ tb.mix((right - at).astype(np.uint64) * np.uint64(4096) + (at - left).astype(np.uint64)))
            take = pa.array(text[at])
            base = offsets[text[at]]
            columns = [pa.array(gram[at].view(np.int64)), pa.array(context.view(np.int64)), part.column("doc_id").take(take), part.column("key").take(take)]
            columns += [pa.array(x - base) for x in (at, left, right)]
            yield pa.RecordBatch.from_arrays(columns, schema=_SEEDS)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        data, offsets = tb.text_bytes(batch.column("text"))
        for i, (doc_id, key, places) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "places")))):
            for p in places:
                rows.append((p["seed"], 0, doc_id, key, p["at"], p["s"], data[offsets[i] + p["s"] : offsets[i] + p["e"]].tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CONTEXTS)], schema=_CONTEXTS)


def _stretches(batches: Iterator[pa.RecordBatch], window: int, size: int, width: int) -> Iterator[pa.RecordBatch]:
    """Up to ``width`` neighbouring strings around each seed, cut at fixed distances from it: hashes of all their bytes and of those common to all."""
    reach = window - size
    for batch in batches:
        for part in tb.slices(batch, "text"):
            data, offsets = tb.text_bytes(part.column("text"))
            values = data.astype(np.uint64) + tb.ONE
            sums = {b: tb.prefix_sums(values, b) for b in (tb.BASE, tb.SALT_A, tb.SALT_B)}
            places = part.column("places").to_pylist()
            doc = np.repeat(np.arange(part.num_rows), [len(x) for x in places])
            seed, at, s, e = (np.array([p[c] for x in places for p in x], np.int64) for c in ("seed", "at", "s", "e"))
            origin = at - reach
            low, high = (s - origin) // width, (e - window - origin) // width
            count = np.maximum(high - low + 1, 0)
            who = np.repeat(np.arange(len(at)), count)
            number = low[who] + np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
            least = origin[who] + number * width
            most = np.minimum(least + width - 1, at[who])
            first, last = np.maximum(least, s[who]), np.minimum(most, e[who] - window)
            base, end = offsets[doc[who]], last + window
            cut = (first - least) * width + last - first
            hashes = [tb.range_hash(sums[b], base + first, base + end, b).view(np.int64) for b in (tb.SALT_A, tb.SALT_B)]
            core = tb.range_hash(sums[tb.BASE], base + most, base + least + window, tb.BASE).view(np.int64)
            take = pa.array(doc[who])
            columns = [pa.array(x) for x in (seed[who], number, cut, *hashes, core)]
            columns += [part.column("doc_id").take(take), part.column("key").take(take)]
            columns += [pa.array(x) for x in (at[who], first, end)]
            yield pa.RecordBatch.from_arrays(columns, schema=_STRETCHES)


def _sharing_half(table: pa.Table, window: int, size: int) -> pa.Table:
    """Contexts that agree with another of their seed in the seed and half the rest of a window, on one side.

    A common window spreads over both sides of the seed, so it covers half the rest on one of them.
    """
    half = (window - size + 1) // 2
    group = group_numbers(table).astype(np.uint64)
    at = table.column("at").to_numpy() - table.column("s").to_numpy()
    keep = np.zeros(len(table), bool)
    keys = np.zeros((2, len(table)), np.uint64)
    known = np.zeros((2, len(table)), bool)
    for lo in range(0, len(table), HASHED_CONTEXTS):
        part = table.column("bytes").slice(lo, HASHED_CONTEXTS).combine_chunks()
        data, offsets = tb.text_bytes(part)
        sums = tb.prefix_sums(data.astype(np.uint64) + tb.ONE, tb.BASE)
        rows = slice(lo, lo + len(part))
        seed = offsets[:-1] + at[rows]
        for side, begin, end in ((0, seed - half, seed + size), (1, seed, seed + size + half)):
            inside = (begin >= offsets[:-1]) & (end <= offsets[1:])
            known[side, rows] = inside
            begin, end = np.where(inside, begin, 0), np.where(inside, end, 0)
            keys[side, rows] = tb.range_hash(sums, begin, end, tb.BASE) ^ tb.mix(group[rows])
    for side in range(2):
        which = np.flatnonzero(known[side])
        _, inverse, times = np.unique(keys[side, which], return_inverse=True, return_counts=True)
        keep[which[times[inverse] > 1]] = True
    return table.filter(pa.array(keep))


def _whole_groups(table: pa.Table, limit: int) -> Iterator[pa.Table]:
    """Parts of a table of about ``limit`` bytes of contexts that cut no group."""
    group = group_numbers(table)
    sizes = pc.binary_length(table.column("bytes")).to_numpy()
    starts = np.flatnonzero(np.diff(group, prepend=0))
    total = np.cumsum(np.add.reduceat(sizes, starts)) // limit
    cuts = starts[np.flatnonzero(np.diff(total, prepend=-1))]
    for lo, hi in zip(cuts, np.append(cuts[1:], len(table))):
        yield table.slice(lo, hi - lo)


def _shared_runs(sides: np.ndarray, length: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Per context and width the number of the run of contexts that share so many bytes of this side.

    The contexts of a group are put in order of their side; neighbours that share a width are in one run of
    it. A side that ends stands before those that go on, so it parts no run.
    """
    n, most = sides.shape
    rows = np.concatenate([group.astype(">u4").view(np.uint8).reshape(n, 4), sides, length.astype(">u4").view(np.uint8).reshape(n, 4)], axis=1)
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{most + 8}").ravel())
    alike = sides[order[1:]] == sides[order[:-1]]
    shared = np.where(alike.all(axis=1), most, alike.argmin(axis=1))
    shared = np.minimum(shared, np.minimum(length[order[1:]], length[order[:-1]]))
    shared[group[order[1:]] != group[order[:-1]]] = -1
    apart = np.ones((n, most + 1), np.int32)
    apart[1:] = shared[:, None] < np.arange(most + 1)
    runs = np.empty((n, most + 1), np.int32)
    runs[order] = np.cumsum(apart, axis=0, dtype=np.int32)
    return runs


def matched_distances(data: np.ndarray, offsets: np.ndarray, seed_at: np.ndarray, group: np.ndarray, place: np.ndarray, window: int, size: int, keep_first: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, least, greatest distance before the seed at which a string of it begins that another has too).

    ``place`` numbers the contexts in the order of the corpus; with ``keep_first`` only an earlier one counts.
    """
    n, reach = len(seed_at), window - size
    left = np.minimum(seed_at, reach)
    right = np.minimum(np.diff(offsets) - seed_at - size, reach)
    step = np.arange(reach)

    def side(start: np.ndarray, length: np.ndarray, sign: int) -> np.ndarray:
        at = np.clip(start[:, None] + sign * step, 0, len(data) - 1)
        return np.where(step < length[:, None], data[at], 0).astype(np.uint8)

    first = offsets[:-1] + seed_at
    before = _shared_runs(side(first - 1, left, -1), left, group)
    after = _shared_runs(side(first + size, right, 1), right, group)[:, ::-1]
    distance = np.arange(reach + 1)
    inside = (distance <= left[:, None]) & (reach - distance <= right[:, None])
    # The suffix order: by the run on either side, which is the rank of the string, then by place.
    base = n + 1
    key = ((distance * base + before) * base + after) * base + place[:, None]
    suffixes = np.sort(key[inside])
    rank = suffixes // base
    previous = np.zeros(len(suffixes), bool)
    previous[1:] = rank[1:] == rank[:-1]
    hit = previous.copy()
    if not keep_first:
        hit[:-1] |= previous[1:]
    of_place = np.empty(n, np.int64)
    of_place[place] = np.arange(n)
    who, far = of_place[suffixes[hit] % base], suffixes[hit] // base**3
    least, greatest = np.full(n, reach + 1), np.full(n, -1)
    np.minimum.at(least, who, far)
    np.maximum.at(greatest, who, far)
    found = np.flatnonzero(greatest >= 0)
    return found, least[found], greatest[found]


def _factors(batches: Iterator[pa.RecordBatch], window: int, size: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Spans of the contexts that match another context of their seed."""
    for table in sorted_groups(batches):
        table = _sharing_half(table, window, size)
        for part in _whole_groups(table, PART_BYTES) if len(table) else ():
            data, offsets = tb.text_bytes(part.column("bytes").combine_chunks())
            doc = np.array([x if x is not None else np.iinfo(np.int64).max for x in part.column("doc_id").to_pylist()])
            key, at, begins = (part.column(c).to_numpy() for c in ("key", "at", "s"))
            place = np.empty(len(part), np.int64)
            place[np.lexsort((at, key, doc))] = np.arange(len(part))
            who, least, greatest = matched_distances(data, offsets, at - begins, group_numbers(part), place, window, size, keep_first)
            if len(who):
                # Strings of one context all hold its seed, so together they are one span.
                columns = (key[who], at[who] - greatest, at[who] - least + window)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_SPANS)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), row_key(doc_id, text).alias("key"))


def _hashed_spans(rows: DataFrame, texts: DataFrame, window: int, size: int, keep_first: bool) -> DataFrame:
    """Spans found by hashes: whole stretches that repeat; one copy of each that agrees with another in part goes on to shorter ones."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "s", "e", "at")
    alike, core = ["seed", "stretch", "cut", "h1", "h2"], ["seed", "stretch", "core"]
    found = []
    for width in STRETCHES:
        stretches = stage(map_arrow(texts, lambda it, width=width: _stretches(it, window, size, width), _STRETCHES), "byte-stretches")
        copies = stretches.groupBy(*alike, "core").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
        copies = stage(copies, "byte-copies")
        whole = copies.filter("n > 1").select(*alike, F.col("first.key").alias("first_key"), F.col("first.s").alias("first_s"))
        whole = stretches.join(whole, alike)
        if keep_first:
            whole = whole.filter("key <> first_key or s <> first_s")
        found.append(whole.select("key", "s", "e"))
        if width > 1:
            partly = copies.groupBy(*core).agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
            partly = copies.join(partly, core).select("first.key", F.struct("seed", "first.at", "first.s", "first.e").alias("place"))
            # A list is bounded by the length of its document.
            lists = stage(partly.groupBy("key").agg(F.collect_set("place").alias("places")), "byte-partly")
            texts = semi_join(rows, lists.select("key"), "key").join(lists, "key").select("doc_id", "key", "text", "places")
    return reduce(DataFrame.union, found)


def repeated_byte_spans(rows: DataFrame, window: int, seed: int, keep_first: bool, hot: int) -> DataFrame:
    """key and spans (array of start and end bytes) of what repeats elsewhere."""
    seeds = stage(map_arrow(rows, lambda it: _seeds(it, window, seed), _SEEDS), "byte-seeds")
    shared = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("c1"), F.max("context").alias("c2"))
    shared = shared.filter("n > 1").select("seed", (F.col("c1") < F.col("c2")).alias("differs"))
    met = stage(seeds.join(shared, "seed"), "byte-met")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "at", "s", "e")
    each = stage(met.groupBy("seed", "context", "differs").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("one")), "byte-contexts")
    again = each.filter("copies > 1").select("seed", "context", F.col("one.key").alias("first_key"), F.col("one.at").alias("first_at"))
    covered = met.join(again, ["seed", "context"])
    if keep_first:
        covered = covered.filter("key <> first_key or at <> first_at")
    covered = covered.select("key", "s", "e").filter(F.col("e") - F.col("s") >= window)

    differing = each.filter("differs").select("seed", "one.*")
    counts = differing.groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
    differing = differing.join(counts, "seed").select("key", F.struct("seed", "at", "s", "e", (F.col("n") > hot).alias("hot")).alias("place"))
    # A list is bounded by the length of its document.
    lists = stage(differing.groupBy("key").agg(F.collect_list("place").alias("places")), "byte-lists")
    texts = semi_join(rows, lists.select("key"), "key").join(lists, "key")

    def chosen(is_hot: bool) -> DataFrame:
        some = texts.withColumn("places", F.filter("places", lambda p: p["hot"] == F.lit(is_hot)))
        return some.filter(F.size("places") > 0).select("doc_id", "key", "text", "places")

    cold = map_arrow(chosen(False), _contexts, _CONTEXTS).repartition("bucket").sortWithinPartitions("bucket")
    spans = covered.union(map_arrow(cold, lambda it: _factors(it, window, seed, keep_first), _SPANS))
    if lists.filter(F.exists("places", lambda p: p["hot"])).limit(1).count():
        spans = spans.union(_hashed_spans(rows, chosen(True), window, seed, keep_first))
    return spans.groupBy("key").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


_OUT = pa.schema(
    [
        *((c, pa.int64()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")),
        ("kept_sha256", pa.string()),
        ("removed", pa.list_(pa.int64())),
    ]
)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tb.text_bytes(batch.column("text"))
        columns: list[list] = [[] for _ in range(5)]
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            text = data[offsets[i] : offsets[i + 1]]
            runs: list[int] = []
            for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
                if runs and s <= runs[-1]:
                    runs[-1] = max(runs[-1], e)
                else:
                    runs += [s, e]
            edges = [0, *runs, len(text)]
            kept = hashlib.sha256()
            for s, e in zip(edges[::2], edges[1::2]):
                kept.update(text[s:e].tobytes())
            removed = sum(runs[1::2]) - sum(runs[::2])
            for column, value in zip(columns, (len(text), removed, len(runs) // 2, kept.hexdigest(), runs)):
                column.append(value)
        arrays = [batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, list(_OUT)[1:]))]
        yield pa.RecordBatch.from_arrays(arrays, schema=_OUT)


def find_repeated_bytes(
    docs: DataFrame,
    window: int = WINDOW_BYTES,
    keep_first: bool = True,
    seed: int = SEED_BYTES,
    hot: int = HOT_CONTEXTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document the bytes that lie in a string of ``window`` bytes which also starts elsewhere.

    doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the remaining bytes),
    removed (starts and ends of the runs). With ``keep_first`` the earliest place of each string, by
    document id, key and offset, stays. Matches lie inside one document; the places may overlap. A null
    text is empty; a null id comes last; rows equal in id and text repeat each other, and with
    ``keep_first`` none of such rows goes by the other; other columns are not read; an empty table gives
    no rows.
    """
    rows = _rows(docs, id_col, text_col)
    spans = repeated_byte_spans(rows, window, seed, keep_first, hot)
    return map_arrow(rows.join(spans, "key", "left").select("doc_id", "text", "spans"), _without, _OUT)
