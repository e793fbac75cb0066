"""Line deduplication by a segment-partition edit join.

A line is cut in threshold + 1 segments; a line within the threshold of it has one of them unchanged, at
a place that the lengths and the edits on either side allow. So every line is filed under its segments
and looks up, for each length it may meet, the few substrings that could be such a segment. Lines that
meet are compared by a bit-parallel edit distance over the band of allowed diagonals. Copies are reduced
to one line first.

Lines of one template share a segment with very many others. Those are cut in more cells, of which the edits
touch two at most; lines that agree in all but two cells meet again, with no more left than these two. Where
too many still meet, what is left is cut again, until a few bytes are left. Lines that agree in these but for
places left out or replaced, within the threshold, are linked to one of them, without comparing pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, count, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm import textbytes as tb
from tidewake.llm.components import connected, local_roots, semi_join
from tidewake.llm.frames import map_arrow, row_key
from tidewake.llm.ngram_join import _groups as sorted_groups
from tidewake.llm.ngram_join import _same_group as group_numbers
from tidewake.session import stage

EDITS = 2
MIN_BYTES = 20
BUCKET = 400
CELLS_OF_LINE = 8
MOST_WAYS = 1 << 12  # of leaving out cells
SHORT_REST = 8
DENSE_SLICE = 100_000
MARKS = 0xF8  # this byte and those above it stand in no text
BLANK = b"\xc0"  # nor does this one
PAIRS = 4096
LONG_LINE = 4096
CELLS = 2_000_000  # bytes of the longer lines of pairs that are compared side by side

NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True

_OCCURRENCES = pa.schema([("line", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("at", pa.int32())])
_KEYS = pa.schema([("bucket", pa.int64()), ("sid", pa.int64()), ("code", pa.int32()), ("filed", pa.bool_())])
_MET = pa.schema([("bucket", pa.int64()), ("sid", pa.int64()), ("code", pa.int32()), ("hot", pa.bool_())])
_TEXTS = pa.schema([("sid", pa.int64()), ("line", pa.binary())])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_RESTS = pa.schema([("bucket", pa.int64()), ("sid", pa.int64()), ("hot", pa.bool_()), ("line", pa.binary()), ("size", pa.int32())])
_SIGNED = pa.schema([("signature", pa.int64()), ("sid", pa.int64()), ("left_out", pa.int32()), ("replaced", pa.int32())])


def _lines(part: pa.RecordBatch) -> tuple[tb.Words, np.ndarray, np.ndarray]:
    """Lines that are not empty, the hash of each, and prefix sums for hashes of their substrings."""
    lines = tb.split_words(*tb.text_bytes(part.column("text")), NEWLINE)
    sums = tb.prefix_sums(lines.data.astype(np.uint64) + tb.ONE, tb.BASE)
    size = (lines.end - lines.start).astype(np.uint64)
    return lines, tb.mix(tb.range_hash(sums, lines.start, lines.end, tb.BASE) + size), sums


def _occurrences(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tb.slices(batch, "text"):
            lines, hashes, _ = _lines(part)
            at = np.flatnonzero(lines.end - lines.start >= least)
            text = lines.text[at]
            columns = [pa.array(hashes[at].view(np.int64))]
            columns += [part.column(c).take(pa.array(text)) for c in ("doc_id", "key")]
            columns.append(pa.array((at - lines.bounds[text]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(columns, schema=_OCCURRENCES)


def _segment(length: np.ndarray, i: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of segment i of a line of that length; the later segments take what is over."""
    size, over = length // parts, length % parts
    longer = np.maximum(0, i - (parts - over))
    return size * i + longer, size + (i >= parts - over)


def _segment_keys(batches: Iterator[pa.RecordBatch], least: int, edits: int) -> Iterator[pa.RecordBatch]:
    """Where each distinct line of a slice is filed and so looks as well, and where it only looks."""
    parts = edits + 1
    for batch in batches:
        for part in tb.slices(batch, "text"):
            lines, hashes, sums = _lines(part)
            size = lines.end - lines.start
            eligible = np.flatnonzero(size >= least)
            _, one = np.unique(hashes[eligible], return_index=True)
            at = eligible[one]
            start, size, line = lines.start[at], size[at], hashes[at].view(np.int64)
            found: list[tuple[np.ndarray, np.ndarray, bool]] = []

            def add(rows: np.ndarray, begin: np.ndarray, width: np.ndarray, length: np.ndarray, i: int, filed: bool) -> None:
                content = tb.range_hash(sums, begin, begin + width, tb.BASE)
                key = tb.mix(content ^ tb.mix(length.astype(np.uint64) * np.uint64(64) + np.uint64(i)))
                found.append((key.view(np.int64), line[rows], filed))

            everyone = np.arange(len(at))
            for i in range(parts):
                begin, width = _segment(size, i, parts)
                add(everyone, start + begin, width, size, i, True)
                for shorter in range(edits + 1):
                    length = size - shorter
                    begin, width = _segment(length, i, parts)
                    low = np.maximum(begin - i, begin + shorter - (edits - i))
                    high = np.minimum(begin + i, begin + shorter + (edits - i))
                    for shift in range(-edits, 2 * edits + 1):
                        if not shorter and not shift:
                            continue
                        place = begin + shift
                        rows = np.flatnonzero(
                            (place >= low) & (place <= high) & (place >= 0) & (place + width <= size) & (length >= least)
                        )
                        if len(rows):
                            add(rows, start[rows] + place[rows], width[rows], length[rows], i, False)
            for key, rows, filed in found:
                yield _key_batch(key, rows, 0, filed)


def _key_batch(key: np.ndarray, sid: np.ndarray, code: int, filed: bool) -> pa.RecordBatch:
    columns = [key, sid, np.full(len(key), code, np.int32), np.full(len(key), filed)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_KEYS)


def _meetings(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Lines of the keys at which one line is filed and another looks; ``hot`` where there are over ``limit`` of them.

    Rows come sorted by key. Of a key only as many rows are held as show that it is hot; more are passed on.
    """
    most = 64 * limit  # a line comes to a key in a few ways at most

    def out(rows: list[np.ndarray], hot) -> pa.RecordBatch:
        bucket, sid, code, _ = rows
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (bucket, sid, code, np.broadcast_to(hot, len(bucket)))], schema=_MET)

    def settled(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not len(rows[0]):
            return
        order = np.lexsort((rows[2], rows[1], rows[0]))
        bucket, sid, code, filed = (c[order] for c in rows)
        starts = np.flatnonzero(np.concatenate([[True], np.diff(bucket) != 0]))
        new_line = np.concatenate([[True], (np.diff(bucket) != 0) | (np.diff(sid) != 0)])
        new_row = new_line | np.concatenate([[True], np.diff(code) != 0])
        lines = np.add.reduceat(new_line.astype(np.int64), starts)
        useful = (lines > 1) & np.logical_or.reduceat(filed, starts)
        sizes = np.diff(np.append(starts, len(bucket)))
        chosen = np.flatnonzero(np.repeat(useful, sizes) & new_row)
        if len(chosen):
            yield out([c[chosen] for c in (bucket, sid, code, filed)], np.repeat(lines > limit, sizes)[chosen])

    held: list[np.ndarray] = [np.zeros(0, f.type.to_pandas_dtype()) for f in _KEYS]
    hot = None
    for batch in batches:
        rows = [np.concatenate([h, batch.column(c).to_numpy(zero_copy_only=False)]) for h, c in zip(held, _KEYS.names)]
        held = [c[:0] for c in rows]
        if hot is not None and len(rows[0]):
            end = int(np.searchsorted(rows[0], hot, "right"))
            if end:
                yield out([c[:end] for c in rows], True)
            rows = [c[end:] for c in rows]
            hot = None if len(rows[0]) else hot
        if not len(rows[0]):
            continue
        last = int(np.searchsorted(rows[0], rows[0][-1], "left"))
        yield from settled([c[:last] for c in rows])
        if len(rows[0]) - last > most:
            hot = rows[0][-1]
            yield out([c[last:] for c in rows], True)
        else:
            held = [c[last:] for c in rows]
    yield from settled(held)


def _line_texts(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tb.slices(batch, "text"):
            lines, hashes, _ = _lines(part)
            eligible = np.flatnonzero(lines.end - lines.start >= least)
            _, one = np.unique(hashes[eligible], return_index=True)
            at = eligible[one]
            texts = [lines.data[s:e].tobytes() for s, e in zip(lines.start[at], lines.end[at])]
            yield pa.RecordBatch.from_arrays([pa.array(hashes[at].view(np.int64)), pa.array(texts, pa.binary())], schema=_TEXTS)


def _same_from(x: np.ndarray, y: np.ndarray) -> int:
    """How many bytes two arrays begin with in common."""
    at, step = 0, 256
    n = min(len(x), len(y))
    while at < n:
        unlike = x[at : min(n, at + step)] != y[at : min(n, at + step)]
        if unlike.any():
            return at + int(unlike.argmax())
        at, step = at + step, 2 * step
    return n


def _near(short: bytes, long: bytes, edits: int) -> bool:
    """Whether two long lines are within the edit distance: how far each diagonal comes with so many edits."""
    x, y = np.frombuffer(short, np.uint8), np.frombuffer(long, np.uint8)
    n, m = len(x), len(y)
    reach: dict[int, int] = {}
    for e in range(edits + 1):
        further = {}
        for d in range(-e, e + 1):
            # From the last edit on: a byte more in the long line, a byte replaced, a byte more in the short one.
            steps = [reach[k] + more for k, more in ((d - 1, 0), (d, 1), (d + 1, 1)) if k in reach] if e else [0]
            row = min([max(steps, default=-1), n, m - d])
            if row >= max(0, -d):
                further[d] = row + _same_from(x[row:], y[row + d :])
        reach = further
        if reach.get(m - n) == n:
            return True
    return False


def within_edits(short: list[bytes], long: list[bytes], edits: int) -> np.ndarray:
    """Whether each pair (the first not longer, and by at most ``edits``) is within the edit distance.

    Pairs are compared side by side as far as their matrix stays bounded, longest first; very long lines
    one by one.
    """
    sizes = np.array([*map(len, long)], np.int64)
    order = np.argsort(-sizes, kind="stable")
    out, at = np.zeros(len(order), bool), int((sizes > LONG_LINE).sum())
    for k in order[:at].tolist():
        out[k] = _near(short[k], long[k], edits)
    while at < len(order):
        together = order[at : at + max(1, CELLS // max(1, int(sizes[order[at]])))]
        out[together] = _banded([short[k] for k in together], [long[k] for k in together], edits)
        at += len(together)
    return out


def _banded(short: list[bytes], long: list[bytes], edits: int) -> np.ndarray:
    """``within_edits`` of pairs that are compared side by side.

    Bit k of a column j is row j - edits + k of the edit matrix; rows above the first hold j - row, so that
    their deltas are constant. The score is that of the diagonal on which the last cell lies; it never
    falls, so pairs past the threshold leave early.
    """
    out = np.zeros(len(short), bool)
    if not len(short):
        return out
    m, n = np.array([*map(len, short)]), np.array([*map(len, long)])
    order = np.argsort(-n, kind="stable")
    width = int(n.max())
    a = np.full((width + 2 * edits + 2, len(order)), 256, np.uint16)
    b = np.full((width, len(order)), 257, np.uint16)
    for col, k in enumerate(order.tolist()):
        a[edits : edits + m[k], col] = np.frombuffer(short[k], np.uint8)
        b[: n[k], col] = np.frombuffer(long[k], np.uint8)
    alive, sizes = order, n[order]
    diagonal = (edits + m - n)[order].astype(np.uint16)
    score = (n - m)[order]
    band = np.uint16((1 << (2 * edits + 1)) - 1)
    vn = np.full(len(order), (1 << (edits + 1)) - 1, np.uint16)
    vp = np.full(len(order), band & ~np.uint16((1 << (edits + 1)) - 1), np.uint16)
    top, one = np.uint16(1 << (2 * edits)), np.uint16(1)
    for j in range(width):
        going = int(np.searchsorted(-sizes, -j))  # lines longer than j
        if j % 16 == 0 or going < len(alive):
            over = np.arange(len(alive)) >= going
            out[alive[over]] = score[over] <= edits
            keep = np.flatnonzero(~over & (score <= edits))
            alive, sizes, diagonal, score, vn, vp = (x[keep] for x in (alive, sizes, diagonal, score, vn, vp))
            a, b = a[:, keep], b[:, keep]
            if not len(alive):
                return out
        same = np.zeros(len(alive), np.uint16)
        for k in range(2 * edits + 1):
            same |= (a[j + k] == b[j]).astype(np.uint16) << np.uint16(k)
        vp, vn = (vp >> one) | top, vn >> one
        x = same | vn
        d0 = ((((x & vp) + vp) ^ vp) | x) & band
        hn, hp = vp & d0, (vn | ~(vp | d0)) & band
        shifted = ((hp << one) | one) & band
        vn, vp = shifted & d0, ((hn << one) | ~(shifted | d0)) & band
        score = score + 1 - ((d0 >> diagonal) & one)
    out[alive] = score <= edits
    return out


def _linked(batches: Iterator[pa.RecordBatch], edits: int) -> Iterator[pa.RecordBatch]:
    """Per bucket a spanning forest of the lines within the threshold."""
    for table in sorted_groups(batches):
        group = group_numbers(table)
        sids, own = table.column("sid").to_numpy(), table.column("own").to_numpy()
        parts = table.column("part").to_numpy()
        cross = parts // 1_000_000 != parts % 1_000_000
        lines = table.column("line").to_pylist()
        size = np.array([*map(len, lines)])
        held_a: list[np.ndarray] = []
        held_b: list[np.ndarray] = []
        left, shift = np.arange(len(lines) - 1), 1
        links: list[tuple[int, int]] = []

        def settle() -> None:
            if not held_a:
                return
            a, b = np.concatenate(held_a), np.concatenate(held_b)
            held_a.clear()
            held_b.clear()
            for i in range(0, len(a), PAIRS):
                x, y = a[i : i + PAIRS], b[i : i + PAIRS]
                good = within_edits([lines[k] for k in x], [lines[k] for k in y], edits)
                links.extend(zip(x[good].tolist(), y[good].tolist()))

        held = 0
        while True:
            left = left[left + shift < len(lines)]
            left = left[group[left] == group[left + shift]]
            if not len(left):
                break
            right = left + shift
            good = (abs(size[left] - size[right]) <= edits) & (~cross[left] | (own[left] != own[right]))
            x, y = left[good], right[good]
            held_a.append(np.where(size[x] <= size[y], x, y))
            held_b.append(np.where(size[x] <= size[y], y, x))
            held += len(x)
            if held > 8 * PAIRS:
                settle()
                held = 0
            shift += 1
        settle()
        roots = local_roots(len(lines), links)
        rows = [(int(sids[i]), int(sids[r])) for i, r in enumerate(roots) if i != r]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=_LINKS)


def _variants(edits: int) -> list[tuple[int, ...]]:
    """By how many bytes each edited cell of the looking line is longer, for all ways within the threshold; first: all alike."""
    ways = [w for w in product(range(-edits, edits + 1), repeat=edits) if 0 <= sum(w) and sum(map(abs, w)) <= edits]
    return sorted(ways, key=lambda w: (any(w), w))


def _cell_keys(batches: Iterator[pa.RecordBatch], edits: int) -> Iterator[pa.RecordBatch]:
    """Keys of lines without some cells: each line is filed by its own cells and looks by those of lines it may meet."""
    ways = _variants(edits)
    for batch in batches:
        for part in tb.slices(batch, "line", DENSE_SLICE):
            data, offsets = tb.text_bytes(part.column("line"))
            sums = tb.prefix_sums(data.astype(np.uint64) + tb.ONE, tb.BASE)
            item, start = part.column("sid").to_numpy(), offsets[:-1]
            context = tb.mix(part.column("context").to_numpy().view(np.uint64))
            sizes = np.diff(offsets)
            for v, way in enumerate(ways):
                size = sizes - sum(way)
                edge = [size * k // CELLS_OF_LINE for k in range(CELLS_OF_LINE + 1)]
                for c, gone in enumerate(combinations(range(CELLS_OF_LINE), edits)):
                    fits, moved, since = size > 0, 0, 0
                    stretches = []
                    for cell, longer in zip(gone, way):
                        stretches.append((edge[since] + moved, edge[cell] + moved))
                        fits = fits & (edge[cell + 1] - edge[cell] + longer >= 0)
                        moved, since = moved + longer, cell + 1
                    stretches.append((edge[since] + moved, edge[-1] + moved))
                    rows = np.flatnonzero(fits)
                    if not len(rows):
                        continue
                    key = context[rows] ^ tb.mix(size[rows].astype(np.uint64) * np.uint64(1 << 20) + np.uint64(c))
                    for s, e in stretches:
                        key = tb.mix(key + tb.range_hash(sums, (start + s)[rows], (start + e)[rows], tb.BASE))
                    yield _key_batch(key.view(np.int64), item[rows], v * MOST_WAYS + c, not any(way))


def _rests(batches: Iterator[pa.RecordBatch], edits: int, mark: bytes) -> Iterator[pa.RecordBatch]:
    """What the lines of a key do not share: the cells left out, with marks between them that no edit removes."""
    ways, gones = _variants(edits), list(combinations(range(CELLS_OF_LINE), edits))
    for batch in batches:
        rests, counts = [], []
        for line, code in zip(batch.column("line").to_pylist(), batch.column("code").to_pylist()):
            way = ways[code // MOST_WAYS]
            size, moved, parts = len(line) - sum(way), 0, []
            for cell, longer in zip(gones[code % MOST_WAYS], way):
                end = size * (cell + 1) // CELLS_OF_LINE + moved + longer
                parts.append(line[size * cell // CELLS_OF_LINE + moved : end])
                moved += longer
            rests.append(mark.join(parts))
            counts.append(sum(b < MARKS for p in parts for b in p))
        columns = [batch.column(c) for c in ("bucket", "sid", "hot")] + [pa.array(rests, pa.binary()), pa.array(counts, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, schema=_RESTS)


def _signatures(batches: Iterator[pa.RecordBatch], edits: int) -> Iterator[pa.RecordBatch]:
    """A short rest with up to ``edits`` bytes left out or replaced by a blank that stands for any byte."""
    for batch in batches:
        rows: list[tuple[bytes, int, int, int]] = []
        for bucket, sid, rest in zip(*(batch.column(c).to_pylist() for c in ("bucket", "sid", "line"))):
            seen = {}
            places = [i for i, b in enumerate(rest) if b < MARKS]
            for changes in range(edits + 1):
                for chosen in combinations(places, changes):
                    for kinds in product((b"", BLANK), repeat=changes):
                        out, at = [], 0
                        for place, kind in zip(chosen, kinds):
                            out += [rest[at:place], kind]
                            at = place + 1
                        left_out = kinds.count(b"")
                        signed = b"".join([*out, rest[at:]]), changes - left_out
                        seen[signed] = min(left_out, seen.get(signed, left_out))
            head = bucket.to_bytes(8, "little", signed=True)
            rows += [(head + text, sid, left_out, replaced) for (text, replaced), left_out in seen.items()]
        if rows:
            data, offsets = tb.text_bytes(pa.array([r[0] for r in rows], pa.binary()))
            sums = tb.prefix_sums(data.astype(np.uint64) + tb.ONE, tb.BASE)
            replaced = np.array([r[3] for r in rows], np.uint64)
            number = tb.mix(tb.range_hash(sums, offsets[:-1], offsets[1:], tb.BASE) + np.diff(offsets).astype(np.uint64) * np.uint64(64) + replaced)
            columns = [pa.array(number.view(np.int64)), *(pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2, 3))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, _SIGNED)], schema=_SIGNED)


def _signed_links(rests: DataFrame, edits: int) -> DataFrame:
    """Links of short rests that share a signature within the threshold, each to the one that leaves out the least.

    Two of a signature are apart by what either leaves out and what both replace. Whoever is near another by
    a signature is near the one that leaves out the least, so these links join all that are near.
    """
    signed = stage(map_arrow(rests.select("bucket", "sid", "line"), lambda it: _signatures(it, edits), _SIGNED), "line-signatures")
    centre = signed.groupBy("signature").agg(F.min(F.struct("left_out", "sid")).alias("centre"), F.count(F.lit(1)).alias("n"))
    near = F.col("left_out") + F.col("centre.left_out") + F.col("replaced") <= edits
    met = signed.join(centre.filter("n > 1"), "signature").filter(near & (F.col("sid") != F.col("centre.sid")))
    return met.select(F.col("sid").alias("a"), F.col("centre.sid").alias("b")).distinct()


def _bucket_links(rows: DataFrame, edits: int) -> DataFrame:
    """Links of the lines (bucket, sid, line) of each bucket, compared pair by pair."""
    rows = rows.select("bucket", F.lit(0).cast("long").alias("part"), "sid", F.lit(0).alias("own"), "line")
    return map_arrow(rows.repartition("bucket").sortWithinPartitions("bucket"), lambda it: _linked(it, edits), _LINKS)


def _met(keys: DataFrame) -> DataFrame:
    limit = BUCKET
    return map_arrow(keys.repartition("bucket").sortWithinPartitions("bucket"), lambda it: _meetings(it, limit), _MET)


def dense_links(lines: DataFrame, edits: int) -> list[DataFrame]:
    """Links of lines (sid, line) that share segments with too many others, whatever their number."""
    items = lines.select("sid", F.col("sid").alias("whole"), F.lit(0).cast("long").alias("context"), "line")
    links: list[DataFrame] = []
    for level in count():
        items = stage(items, "dense-lines")
        if not items.limit(1).count():
            return links
        met = stage(_met(map_arrow(items.select("sid", "context", "line"), lambda it: _cell_keys(it, edits), _KEYS)), "dense-meetings")
        # A mark is longer than the threshold, and its byte stands in no text.
        mark = bytes([255 - level % (256 - MARKS)]) * (edits + 1)
        met = met.join(items.select("sid", "whole", "line"), "sid").select("bucket", F.col("whole").alias("sid"), "code", "hot", "line")
        rests = stage(map_arrow(met, lambda it, mark=mark: _rests(it, edits, mark), _RESTS).distinct(), "dense-rests")
        links.append(stage(_bucket_links(rests.filter("NOT hot"), edits), "dense-links"))
        # Rests near each other differ by the threshold in size, so those about the border take both ways.
        links.append(stage(_signed_links(rests.filter(F.col("hot") & (F.col("size") <= SHORT_REST + edits)), edits), "signed-links"))
        items = rests.filter(F.col("hot") & (F.col("size") > SHORT_REST)).select(
            F.xxhash64("bucket", "sid", "line").alias("sid"), F.col("sid").alias("whole"), F.col("bucket").alias("context"), "line"
        )


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), row_key(doc_id, text).alias("key"))


def line_classes(rows: DataFrame, edits: int, least: int) -> DataFrame:
    """(node, root) of the lines, by hash, that have another line within the edit distance, over chains of such lines."""
    keys = map_arrow(rows.select("text"), lambda it: _segment_keys(it, least, edits), _KEYS)
    met = stage(_met(keys).select("bucket", "sid", "hot"), "line-meetings")
    wanted = stage(met.select("sid").distinct(), "met-lines")
    texts = semi_join(map_arrow(rows.select("text"), lambda it: _line_texts(it, least), _TEXTS), wanted, "sid").dropDuplicates(["sid"])
    crowded = stage(met.filter("hot").select("sid").distinct(), "crowded-lines")
    if not crowded.limit(1).count():
        return connected(stage(_bucket_links(met.join(texts, "sid"), edits), "line-links"))
    texts = stage(texts, "met-texts")
    links = [stage(_bucket_links(met.filter("NOT hot").join(texts, "sid"), edits), "line-links")]
    links += dense_links(texts.join(crowded, "sid", "left_semi"), edits)
    return connected(reduce(DataFrame.union, links))


def repeated_lines(
    docs: DataFrame, edits: int = EDITS, least: int = MIN_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, key, n_lines (lines that count), n_removed, removed, classes.

    Lines are what line feeds separate; those of at least ``least`` bytes count, shorter ones are left
    alone. Two lines are alike within ``edits`` insertions, deletions or replacements of UTF-8 bytes, and
    a class is a chain of such lines. The first line of a class by document id, key and place stays, all
    others are ``removed`` (places among the lines that are not empty); ``classes`` are the class numbers
    of the counted lines in order. Rows equal in id and text are one document here. A null id comes last;
    a null or empty text has no lines; other columns are not read; an empty table gives no rows.
    """
    rows = _rows(docs, id_col, text_col)
    places = stage(map_arrow(rows, lambda it: _occurrences(it, least), _OCCURRENCES), "line-places")
    roots = line_classes(rows, edits, least).withColumnRenamed("node", "line")
    placed = places.join(roots, "line", "left").select(
        F.coalesce("root", "line").alias("class"), F.col("doc_id").isNull().alias("none"), "doc_id", "key", "at"
    )
    first = placed.groupBy("class").agg(F.min(F.struct("none", "doc_id", "key", "at")).alias("first"))
    judged = placed.join(first, "class").select(
        "class", "doc_id", "key", "at", ((F.col("first.key") != F.col("key")) | (F.col("first.at") != F.col("at"))).alias("again")
    )
    per = judged.groupBy("key").agg(
        F.count_distinct("at").alias("n_lines"),
        F.array_sort(F.collect_set(F.when(F.col("again"), F.col("at")))).alias("removed"),
        F.array_sort(F.collect_set(F.struct("at", "class"))).alias("by_place"),
    )
    none = F.array().cast("array<int>")
    return (
        rows.select("doc_id", "key")
        .join(per, "key", "left")
        .select(
            "doc_id",
            "key",
            F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
            F.size(F.coalesce("removed", none)).cast("long").alias("n_removed"),
            F.coalesce("removed", none).alias("removed"),
            F.coalesce(F.col("by_place.class"), F.array().cast("array<bigint>")).alias("classes"),
        )
    )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with the removed lines cut from their texts; texts that keep all lines are passed on as they are."""
    for batch in batches:
        for part in tb.slices(batch, "text"):
            removed = part.column("removed")
            rows = np.flatnonzero(removed.is_valid().to_numpy(zero_copy_only=False))
            text = part.column("text")
            cut = []
            for row in rows.tolist():
                drop, place, kept = set(removed[row].as_py()), 0, []
                for line in text[row].as_py().split("\n"):
                    if line:
                        place += 1
                        if place - 1 in drop:
                            continue
                    kept.append(line)
                cut.append("\n".join(kept))
            if cut:
                mask = np.zeros(part.num_rows, bool)
                mask[rows] = True
                text = pc.replace_with_mask(text, pa.array(mask), pa.array(cut, pa.string()))
            yield pa.RecordBatch.from_arrays([part.column("others"), text, part.column("wordless")], names=["others", "text", "wordless"])


def drop_repeated_lines(
    docs: DataFrame, edits: int = EDITS, least: int = MIN_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents without repeated lines, all columns kept; one of whose text only white space is left goes.

    The text moves once, beside the other columns and not among them.
    """
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    gone = repeated_lines(docs, edits, least, id_col, text_col).filter("n_removed > 0").select("key", "removed")
    gone = stage(gone.dropDuplicates(["key"]), "lines-gone")
    others = [c for c in docs.columns if c != text_col]
    # A document without a word to begin with is left alone.
    wordless = ~F.coalesce(text.rlike(r"\S"), F.lit(False))
    rows = docs.select(
        F.struct(*[F.col(c) for c in others], F.lit(True).alias("_row")).alias("others"),
        text.alias("text"),
        wordless.alias("wordless"),
        row_key(doc_id, text).alias("key"),
    ).join(gone, "key", "left")
    shape = rows.select("others", "text", "wordless").schema
    cut = map_arrow(rows.select("others", "text", "wordless", "removed"), _without, shape)
    cut = cut.filter(F.col("wordless") | F.col("text").rlike(r"\S"))
    return cut.select(*[F.col("text").alias(c) if c == text_col else F.col("others")[c].alias(c) for c in docs.columns])
