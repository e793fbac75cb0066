"""N-gram Jaccard join by chosen paths.

A document is the set of hashes of its five-word shingles; documents with one set are one class from the
start. In each of many runs a set samples a few of its shingles, at a rate that lets two sets over the
threshold expect a common sample; the sampled shingle is a bucket. Sets of a bucket over a size choose
further shingles, drawn anew for the path that led there; small buckets are compared pair by pair: first by
minhash sketches, then, in the first bucket that two sets share, exactly. The shingles of a set go only to
buckets in which it has a partner that it meets there first. Copies and large groups are counted inside
their buckets; pairs are never written out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm import textbytes as tb
from tidewake.llm.components import connected, local_roots, semi_join
from tidewake.llm.frames import map_arrow, row_key
from tidewake.session import stage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RUNS = 16
# Common samples that a pair at the threshold expects, in a run and in each bucket of a path that is split:
# it shares one with probability 1 - exp(-1) and 1 - exp(-1.25).
COMMON = (1.0, 1.25, 1.25)
DEPTH = len(COMMON)
BUCKET = 400
PART = 1_000_000  # a tile is numbered lesser part * PART + greater part
SKETCH = 64
MISSED = 1e-6  # share of the pairs at the threshold that the sketches may lose

_SAMPLE = pa.struct([("run", pa.int8()), ("token", pa.int64())])
_PATHS = pa.schema([("run", pa.int8()), ("bucket", pa.int64()), ("token", pa.int64()), ("sid", pa.int64())])
_SETS = pa.schema(
    [("doc_id", pa.int64()), ("key", pa.int64()), ("sid", pa.int64()), ("n", pa.int32()), ("sketch", pa.binary()), ("samples", pa.list_(_SAMPLE))]
)
# The sets of a bucket that similar sketches connect have one label, a number of one of them.
_LIKELY = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("label", pa.int64()), ("own", pa.int32()), ("sid", pa.int64())])
_MEETING = _LIKELY.append(pa.field("buckets", pa.list_(pa.int64())))
_FOUND = pa.schema([("sid", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def _salt(i: int) -> np.uint64:
    return tb.mix(np.array([i + 1], np.uint64) * tb.SALT_A)[0]


def least_equal(similarity: float, missed: float = MISSED) -> int:
    """Equal minhashes of ``SKETCH`` that a pair of that similarity has but for a share ``missed`` of such pairs."""
    below = 0.0
    for k in range(SKETCH + 1):
        below += math.comb(SKETCH, k) * similarity**k * (1 - similarity) ** (SKETCH - k)
        if below > missed:
            return k
    return SKETCH


def _chosen(hashes: np.ndarray, common: float, similarity: float, n: np.ndarray) -> np.ndarray:
    """Which of the hashes are samples; two sets have a sample in common as often as the smaller rate allows.

    Of sets over the threshold the common part is that share of the larger one at least, so a set of n
    shingles samples common / similarity of them.
    """
    limit = (common / similarity / n * 2.0**63).clip(max=2.0**63 - 1024).astype(np.uint64)
    return np.flatnonzero((tb.mix(hashes) >> tb.ONE) < limit)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of the sorted distinct shingles of each text; a shorter text is one shingle."""
    data, offsets = tb.text_bytes(column)
    words = tb.split_words(tb.LOWER[data], offsets, tb.NOT_ALNUM)
    hashes = words.hashes()
    first, gram = tb.window_hashes(words, hashes, size)
    text = words.text[first]
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        sums = tb.prefix_sums(hashes, tb.SALT_B)
        gram = np.concatenate([gram, tb.range_hash(sums, words.bounds[short], words.bounds[short + 1], tb.SALT_B)])
        text = np.concatenate([text, short])
    order = np.lexsort((gram, text))
    gram, text = gram[order], text[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
    gram, text = gram[new], text[new]
    return gram, np.searchsorted(text, np.arange(len(counts) + 1))


def _describe(batches: Iterator[pa.RecordBatch], size: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Per document with words: the identity of its set, a sketch, and the samples that each run starts from."""
    for batch in batches:
        for part in tb.slices(batch, "text"):
            gram, at = shingle_sets(part.column("text"), size)
            n = np.diff(at)
            rows = np.flatnonzero(n)
            if not len(rows):
                continue
            text = np.repeat(np.arange(len(n)), n)
            starts = at[rows]
            with np.errstate(over="ignore"):
                one = np.add.reduceat(tb.mix(gram), starts)
                two = np.add.reduceat(tb.mix(gram ^ _salt(-2 & 0xFFFF)), starts)
                sid = tb.mix(one ^ tb.mix(two + n[rows].astype(np.uint64))).view(np.int64)
            sketch = np.zeros((len(rows), SKETCH), np.uint16)
            for k in range(SKETCH):
                least = np.minimum.reduceat((gram ^ _salt(1000 + k)) * tb.SALT_B, starts)
                sketch[:, k] = (tb.mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
            found = []
            for run in range(RUNS):
                hit = _chosen(gram ^ _salt(run), COMMON[0], similarity, n[text])
                found.append((text[hit], np.full(len(hit), run), gram[hit]))
            owner, run, token = (np.concatenate(c) for c in zip(*found))
            order = np.argsort(owner, kind="stable")
            bounds = np.searchsorted(owner[order], np.append(rows, len(n)))
            samples = pa.StructArray.from_arrays([pa.array(run[order].astype(np.int8)), pa.array(token[order].view(np.int64))], fields=list(_SAMPLE))
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(take),
                    part.column("key").take(take),
                    pa.array(sid),
                    pa.array(n[rows].astype(np.int32)),
                    pa.array([r.tobytes() for r in sketch], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), samples),
                ],
                schema=_SETS,
            )


def _deeper(batches: Iterator[pa.RecordBatch], size: int, similarity: float, depth: int) -> Iterator[pa.RecordBatch]:
    """The samples of each set in each of its buckets that are split; the draw depends on the bucket, and so on the path."""
    for batch in batches:
        for part in tb.slices(batch, "text"):
            gram, at = shingle_sets(part.column("text"), size)
            sids, paths = part.column("sid").to_pylist(), part.column("paths").to_pylist()
            rows: list[tuple[int, int, np.ndarray, int]] = []
            for i, (sid, into) in enumerate(zip(sids, paths)):
                mine = gram[at[i] : at[i + 1]]
                n = np.full(len(mine), len(mine))
                for path in into:
                    salt = tb.mix(np.array([path["bucket"]], np.int64).view(np.uint64))[0]
                    rows.append((path["run"], path["bucket"], mine[_chosen(mine ^ salt, COMMON[depth], similarity, n)], sid))
            counts = [len(r[2]) for r in rows]
            if sum(counts):
                run, bucket, sid = (np.repeat(np.array([r[k] for r in rows], np.int64), counts) for k in (0, 1, 3))
                token = np.concatenate([r[2] for r in rows]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(run.astype(np.int8)), pa.array(bucket), pa.array(token), pa.array(sid)], schema=_PATHS)


def _buckets(sets: DataFrame, rows: DataFrame, size: int, similarity: float) -> DataFrame:
    """(bucket, parts, sid): final buckets of two sets or more; a large one that cannot be split further is cut in parts.

    A bucket's number begins with its run, so that the least common bucket of two sets is of an early run.
    """

    def number(token, above=None):
        mixed = F.xxhash64(token, "run") if above is None else F.xxhash64(token, above)
        return F.shiftleft(F.col("run").cast("long"), 58).bitwiseOR(F.shiftrightunsigned(mixed, 6))

    level = sets.select("sid", F.explode("samples").alias("s")).select("sid", "s.*")
    level = level.select("run", number(F.col("token")).alias("bucket"), "sid").distinct()
    out = None
    for depth in range(DEPTH):
        level = stage(level, f"paths-{depth}")
        sizes = level.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        met = level.join(sizes, "bucket")
        last = depth == DEPTH - 1
        done = met.filter(F.lit(last) | (F.col("size") <= BUCKET))
        done = done.select("bucket", "sid", F.ceil(F.col("size") / BUCKET).cast("int").alias("parts"))
        out = done if out is None else out.union(done)
        if last:
            break
        # A set has as many paths as samples.
        big = met.filter(F.col("size") > BUCKET).groupBy("sid").agg(F.collect_set(F.struct("run", "bucket")).alias("paths"))
        big = stage(big, f"split-{depth}")
        if not big.limit(1).count():
            break
        leads = big.join(sets.select("sid", F.col("lead.key").alias("key")), "sid")
        texts = semi_join(rows.select("key", "text"), leads.select("key").distinct(), "key").dropDuplicates(["key"])
        texts = texts.join(leads, "key").select("sid", "paths", "text")
        drawn = map_arrow(texts, lambda it, d=depth + 1: _deeper(it, size, similarity, d), _PATHS)
        level = drawn.select("run", number(F.col("token"), F.col("bucket")).alias("bucket"), "sid").distinct()
    return out


def _tiles(members: DataFrame) -> DataFrame:
    """Rows of a bucket in several parts once per pair of parts they take part in, with their own part."""
    mine = F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda o: F.least(o, mine).cast("long") * PART + F.greatest(o, mine),
    )
    return members.withColumn("own", mine).withColumn("part", F.explode(others))


_TILE = ("bucket", "part")
_LABELLED = (*_TILE, "label")


def _changes(table: pa.RecordBatch | pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Whether the keys of a row are not those of the row before it; there is none before the first."""
    change = np.zeros(table.num_rows - 1, bool)
    for key in keys:
        change |= np.diff(table.column(key).to_numpy()) != 0
    return change


def _groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str] = _TILE) -> Iterator[pa.Table]:
    """Whole groups of rows that arrive sorted by ``keys``, several at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.flatnonzero(_changes(batch, keys)) + 1
        if held and any(held[-1].column(key)[-1].as_py() != batch.column(key)[0].as_py() for key in keys):
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            yield pa.Table.from_batches([*held, batch.slice(0, change[-1])])
            held = [batch.slice(change[-1])]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _same_group(table: pa.Table, keys: Sequence[str] = _TILE) -> np.ndarray:
    return np.cumsum(np.append(True, _changes(table, keys)))


def _bounds(table: pa.Table, keys: Sequence[str]) -> list[int]:
    return [0, *(np.flatnonzero(_changes(table, keys)) + 1).tolist(), table.num_rows]


def _likely(batches: Iterator[pa.RecordBatch], least: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Members that have a partner with a similar sketch in a bucket, with the label of those connected so."""
    for table in _groups(batches):
        total = table.num_rows
        group = _same_group(table)
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(-1, SKETCH)
        n = table.column("n").to_numpy().astype(float)
        label = np.arange(total)
        left, shift = np.arange(total - 1), 1
        while len(left):
            left = left[left + shift < total]
            left = left[group[left] == group[left + shift]]
            for i in range(0, len(left), 20_000):
                a = left[i : i + 20_000]
                a = a[label[a] != label[a + shift]]
                b = a + shift
                near = np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b]) - 1e-9
                a, b = a[near], b[near]
                hit = (sketch[a] == sketch[b]).sum(axis=1) >= least
                if hit.any():
                    old, of = np.unique(label, return_inverse=True)
                    label = old[local_roots(len(old), zip(of[a[hit]].tolist(), of[b[hit]].tolist()))][of]
            shift += 1
        chosen = np.flatnonzero(np.bincount(label, minlength=total)[label] > 1)
        columns = {c: table.column(c).combine_chunks().take(pa.array(chosen)) for c in _LIKELY.names if c != "label"}
        columns["label"] = table.column("sid").combine_chunks().take(pa.array(label[chosen]))
        yield pa.RecordBatch.from_arrays([columns[c] for c in _LIKELY.names], schema=_LIKELY)


def _common(owner: np.ndarray, values: np.ndarray, m: int) -> np.ndarray:
    """How many values each two of m owners have in common; the diagonal is not filled."""
    _, token, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times > 1
    inside = shared[token]
    owner, token = owner[inside], (np.cumsum(shared) - 1)[token[inside]]
    common = np.zeros((m, m), np.float32)
    for c in range(0, int(shared.sum()), 4096):
        here = (token >= c) & (token < c + 4096)
        table = np.zeros((m, min(4096, int(shared.sum()) - c)), np.float32)
        table[owner[here], token[here] - c] = 1
        common += table @ table.T
    return common


def _met_first(bucket: int, part: int, own: np.ndarray, lists: pa.ListArray) -> np.ndarray:
    """Which pairs of a bucket share no bucket of a lesser number; of a tile of two parts, pairs across them only."""
    m = len(own)
    values = lists.flatten().to_numpy()
    owner = np.repeat(np.arange(m), np.diff(lists.offsets.to_numpy()))
    before = values < bucket
    first = _common(owner[before], values[before], m) == 0
    np.fill_diagonal(first, False)
    low, high = divmod(part, PART)
    return first & (own[:, None] != own[None, :]) if low != high else first


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members with a partner of their label that they meet first in this bucket."""
    for table in _groups(batches, _LABELLED):
        bounds = _bounds(table, _LABELLED)
        buckets, parts, own = (table.column(c).to_numpy() for c in ("bucket", "part", "own"))
        lists = table.column("buckets").combine_chunks()
        stays = np.zeros(table.num_rows, bool)
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            stays[lo:hi] = _met_first(int(buckets[lo]), int(parts[lo]), own[lo:hi], lists[lo:hi]).any(axis=1)
        chosen = pa.array(np.flatnonzero(stays))
        yield pa.RecordBatch.from_arrays([table.column(c).combine_chunks().take(chosen) for c in _MEETING.names], schema=_MEETING)


def _verified(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Exact links inside buckets: per set its least connected set, and how many documents it newly links to."""
    for table in _groups(batches, _LABELLED):
        bounds = _bounds(table, _LABELLED)
        sids, copies = table.column("sid").to_numpy(), table.column("copies").to_numpy()
        buckets, parts, own = (table.column(c).to_numpy() for c in ("bucket", "part", "own"))
        grams, met = table.column("grams").combine_chunks(), table.column("buckets").combine_chunks()
        values, at = grams.values.to_numpy(), grams.offsets.to_numpy()
        rows: list[tuple[int, int, int]] = []
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            m = hi - lo
            if m < 2:
                continue
            sizes = np.diff(at[lo : hi + 1]).astype(np.float32)
            common = _common(np.repeat(np.arange(m), np.diff(at[lo : hi + 1])), values[at[lo] : at[hi]], m)
            linked = common >= similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-6
            linked &= _met_first(int(buckets[lo]), int(parts[lo]), own[lo:hi], met[lo:hi])
            links = np.where(linked, copies[None, lo:hi], 0).sum(axis=1)
            if not links.any():
                continue
            roots = local_roots(m, zip(*(x.tolist() for x in np.nonzero(np.triu(linked)))))
            rows += [(int(sids[lo + i]), int(sids[lo + roots[i]]), int(links[i])) for i in np.flatnonzero(links)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=_FOUND)


# Half of a shingle's hash tells the shingles of one bucket apart: two of them fall together with
# probability 2**-32, and a verdict changes only if that happens to a pair on the threshold.
_GRAMS = pa.schema([("sid", pa.int64()), ("grams", pa.list_(pa.int32()))])


def _grams(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tb.slices(batch, "text"):
            gram, at = shingle_sets(part.column("text"), size)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array((gram >> np.uint64(32)).astype(np.uint32).view(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("sid"), lists], schema=_GRAMS)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), row_key(doc_id, text).alias("key"))


def similar_documents(
    docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, key, class_id (least id of its class), n_links (documents it is similar to), leads.

    Two documents are linked if the Jaccard similarity of their sets of ``size``-word shingles is at
    least ``similarity``; a class is a connected component. Words are lower-cased runs of letters, digits
    and characters outside ASCII; a text of fewer words than a shingle is one shingle. A null text or one
    without words is a class of its own without links. Rows count one by one, so repeated rows link to
    each other; null ids come last in a class and give a null class_id only among themselves. ``key``
    names equal rows, ``leads`` holds for the rows that stay when one of a class does. Other columns are
    not read; an empty table gives no rows.

    The recall of a pair is set by ``RUNS`` and ``COMMON``, at any threshold: at it a run misses a pair with
    probability exp(-1) in small buckets, so 16 runs miss 1e-7 of such pairs, and 2e-3 where every bucket
    on the way had to be split to full depth. The sketches lose 1e-6. What is reported is exact.
    """
    if not 0 < similarity <= 1:
        raise ValueError("similarity is over 0 and at most 1")
    rows = _rows(docs, id_col, text_col)
    described = stage(map_arrow(rows, lambda it: _describe(it, size, similarity), _SETS), "shingle-sets")
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("lead")
    sets = described.groupBy("sid").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("samples").alias("samples"), F.count(F.lit(1)).alias("copies"), lead
    )
    sets = stage(sets, "distinct-sets")
    members = stage(_tiles(_buckets(sets, rows, size, similarity)), "bucket-members")
    paired = members.join(sets.select("sid", "n", "sketch"), "sid")
    likely = map_arrow(
        paired.repartition(*_TILE).sortWithinPartitions(*_TILE).select(*_TILE, "own", "sid", "n", "sketch"),
        lambda it: _likely(it, least_equal(similarity), similarity),
        _LIKELY,
    )
    likely = stage(likely, "likely-members")
    spots = likely.groupBy("sid").agg(F.collect_list(F.struct(*_LABELLED, "own")).alias("spots"))
    spots = spots.select("sid", F.array_distinct("spots.bucket").alias("buckets"), F.explode("spots").alias("spot"))
    meeting = map_arrow(
        spots.select("sid", "buckets", "spot.*")
        .repartition(*_LABELLED)
        .sortWithinPartitions(*_LABELLED)
        .select(*_MEETING.names),
        _meeting,
        _MEETING,
    )
    meeting = stage(meeting, "meeting-members")
    wanted = meeting.select("sid").distinct()
    leads = semi_join(sets.select("sid", "copies", F.col("lead.key").alias("key")), wanted, "sid")
    leads = stage(leads, "likely-sets")
    texts = semi_join(rows.select("key", "text"), leads.select("key").distinct(), "key").dropDuplicates(["key"])
    grams = map_arrow(texts.join(leads.select("key", "sid"), "key").select("sid", "text"), lambda it: _grams(it, size), _GRAMS)
    facts = leads.select("sid", "copies").join(grams, "sid")
    found = map_arrow(
        meeting.join(facts, "sid")
        .repartition(*_LABELLED)
        .sortWithinPartitions(*_LABELLED, "sid")
        .select(*_MEETING.names, "copies", "grams"),
        lambda it: _verified(it, similarity),
        _FOUND,
    )
    found = stage(found, "set-links")
    roots = connected(found.select(F.col("sid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("sid").agg(F.sum("links").alias("links"))
    per_set = (
        sets.select("sid", "copies", "lead")
        .join(roots.withColumnRenamed("node", "sid"), "sid", "left")
        .join(links, "sid", "left")
        .select("sid", "lead", F.coalesce("root", "sid").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    classes = per_set.groupBy("root").agg(F.min("lead").alias("first"))
    per_set = per_set.select("sid", "root", "n_links").join(classes, "root")
    with_words = described.select("doc_id", "key", "sid").join(per_set, "sid").select(
        "doc_id", "key", F.col("first.doc_id").alias("class_id"), "n_links", (F.col("first.key") == F.col("key")).alias("leads")
    )
    wordless = rows.filter(~F.coalesce(F.col("text").rlike("[0-9A-Za-z\\x{80}-\\x{10FFFF}]"), F.lit(False)))
    return with_words.unionByName(
        wordless.select("doc_id", "key", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("leads"))
    )


def drop_similar(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class (the least id), and every document without words, with all columns."""
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    judged = similar_documents(docs, similarity, id_col=id_col, text_col=text_col)
    gone = judged.filter(~F.col("leads")).select("key").distinct()
    has_words = F.coalesce(text.rlike("[0-9A-Za-z\\x{80}-\\x{10FFFF}]"), F.lit(False))
    rows = docs.select(F.struct("*").alias("row"), row_key(doc_id, text).alias("key"), has_words.alias("has_words"))
    small = stage(gone, "similar-gone")
    kept = rows.join(small, "key", "left_anti")
    # Equal rows share a key, and one of them stays.
    kept = kept.filter("has_words").dropDuplicates(["key"]).unionByName(kept.filter("NOT has_words"))
    return kept.select("row.*")
