"""Neighbours, resampling and spelling variants, against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewake.llm import importance, nearest, queries, spelling
from tidewake.llm.frames import read

FOLDER = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


# --- nearest ---------------------------------------------------------------------------------------


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def exact_neighbours(rows, k, every):
    """Per query its k best (score, id), rows being distinct (id, vector)."""
    rows = list(dict.fromkeys((i, tuple(v)) for i, v in rows if usable(v)))
    out = {}
    for at, (i, v) in enumerate(rows):
        if i is None or i % every:
            continue
        a = np.array(v, float)
        scored = []
        for other, (j, w) in enumerate(rows):
            if other != at and len(w) == len(v):
                b = np.array(w, float)
                scored.append((-float((a / np.linalg.norm(a)) @ (b / np.linalg.norm(b))), j is None, j))
        out.setdefault(i, []).append([(j, -s) for s, _, j in sorted(scored)[:k]])
    return out


def collected(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def recall_of(got, want):
    """Share of the true neighbours whose score is reached; every score is exact and in order."""
    hit = total = 0
    for query, (best,) in want.items():
        mine = got.get(query, [])
        assert [r for r, _, _ in mine] == list(range(1, len(best) + 1))
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        hit += len({i for _, i, _ in mine} & {i for i, _ in best})
        total += len(best)
    return hit / total


def test_nearest_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in read(spark, SF01, "embeddings").collect()]
    got, want = collected(queries.op11_nearest(spark, SF01)), exact_neighbours(rows, 5, 50)
    assert set(got) == set(want)
    by_id = {i: np.array(v, float) for i, v in rows}
    for query, found in got.items():
        for _, i, score in found:
            a, b = by_id[query], by_id[i]
            assert score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
    assert recall_of(got, want) >= 0.9


@pytest.mark.parametrize("shape", ["isotropic", "clusters"])
def test_nearest_recall_over_many_blocks(spark, shape):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 32))
    if shape == "clusters":
        x = rng.standard_normal((40, 32))[rng.integers(0, 40, 3000)] * 2 + x * 0.4
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collected(nearest.nearest(frame, F.col("vec_id") % 20 == 0, block_values=1 << 14, query_values=1 << 11))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {}
    for q in range(0, 3000, 20):
        s = unit @ unit[q]
        s[q] = -9
        want[q] = ([(int(i), s[i]) for i in np.argsort(-s)[:5]],)
    assert recall_of(got, want) >= 0.93


def test_nearest_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [1.0, inf])]
    rows += [(50, [-1.0, 0.0]), (50, [-1.0, 0.0]), (50, [0.0, 2.0]), (None, [3.0, 0.0]), (None, [3.0, 0.0]), (100, [1.0, 2.0, 3.0]), (9, [1e200, 1e200]), (10, [1e-200, 0.0])]
    schema = "vec_id long, embedding array<double>, key string, rank int, vector string, dim int"
    frame = spark.createDataFrame([(*r, "k", 7, "v", 9) for r in rows], schema)
    got = nearest.nearest(frame, F.col("vec_id") % 50 == 0)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    found = {}
    for r in got.collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 9)))
    # copies of the direction by id, the row without an id last among them; unlike lengths do not meet
    root = round(math.sqrt(0.5), 9)
    assert sorted(found[0]) == [(1, 1, 1.0), (2, 10, 1.0), (3, None, 1.0), (4, 2, root), (5, 9, root)]
    assert 100 not in found and set(found) == {0, 50} and len(found[50]) == 10  # two rows of id 50, each a query
    assert nearest.nearest(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert nearest.nearest(frame, F.col("vec_id") == 77).count() == 0


def test_nearest_group_of_copies(spark):
    """A third of all rows is one vector: the smallest ids of it are the answer, through several blocks."""
    rng = np.random.default_rng(3)
    rows = [(i, ([1.0] * 8 if i % 3 == 0 else rng.standard_normal(8).tolist())) for i in range(1500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collected(nearest.nearest(frame, F.col("vec_id") == 300, block_values=2048))
    assert [i for _, i, _ in got[300]] == [0, 3, 6, 9, 12]


# --- resampling ------------------------------------------------------------------------------------


def brute_resample(docs, bench, percent=25, least=20, buckets=10_000, seed=7):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def features(text):
        words = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        grams = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]

    split = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in split for b in f), Counter(b for x in bench for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)}
    rows = []
    for i, n, f in split:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    order = sorted((k for k, r in enumerate(rows) if r[1] >= least), key=lambda k: (-rows[k][4], rows[k][0] is None, rows[k][0] or 0))
    rank = {k: place + 1 for place, k in enumerate(order[: percent * len(order) // 100])}
    return [(*r, rank.get(k)) for k, r in enumerate(rows)]


def same(got, want):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.fixture(scope="module")
def docs(spark):
    long = "Überlauf naïve colour COLOUR " * 40
    odd = [None, "", " \n", "word " * 19, "word " * 20, long, "one", "é" * 3000, "x y " * 300_000]
    rows = [(200_000 + i, t, "en", "s", 0, 1, 2) for i, t in enumerate(odd)]
    rows += [(None, long, None, None, None, 3, 4)] * 2 + [(200_005, long, "en", "s", 0, 5, 6)] * 3
    schema = "doc_id long, text string, lang string, source string, n_chars long, rank long, n long"
    return spark.createDataFrame(rows, schema).unionByName(read(spark, FOLDER, "documents"), allowMissingColumns=True)


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


COLUMNS = ("doc_id", "n_words", "n_features", "weight", "score", "rank")


@pytest.mark.parametrize("segment_rows,samples", [(20_000, 65_536), (11, 40)])
def test_resample(spark, docs, segment_rows, samples):
    bench = read(spark, FOLDER, "benchmark")
    got = importance.resample(docs.repartition(5), bench, segment_rows=segment_rows, samples=samples)
    want = brute_resample(pairs(docs), [r["text"] for r in bench.collect()])
    same([tuple(r) for r in got.select(*COLUMNS).collect()], want)


def test_resample_query(spark):
    want = brute_resample(pairs(read(spark, SF01, "documents")), [r["text"] for r in read(spark, SF01, "benchmark").collect()])
    got = queries.op12_resample(spark, SF01)
    assert all(t == "bigint" for _, t in got.dtypes)
    same([tuple(r) for r in got.select(*COLUMNS).collect()], want)


def test_resample_hot_and_empty(spark, docs):
    bench = read(spark, FOLDER, "benchmark")
    # a third of the rows share one id and text, and so one score
    rows = [(7 if i % 3 == 0 else i, "same words again " * 8 if i % 3 == 0 else f"text number {i} " * 9) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = importance.resample(frame, bench, percent=60, segment_rows=50, samples=300)
    same([tuple(r) for r in got.select(*COLUMNS).collect()], brute_resample(rows, [r["text"] for r in bench.collect()], percent=60))
    none = importance.resample(docs.limit(0), bench)
    assert none.count() == 0 and none.columns == ["doc_id", "key", "n_words", "n_features", "weight", "score", "rank"]
    empty = importance.resample(frame, bench.limit(0), percent=0)
    assert empty.filter("rank IS NOT NULL").count() == 0 and empty.count() == 900
    drawn = importance.drawn_documents(docs, bench)
    want = [r[0] for r in brute_resample(pairs(docs), [r["text"] for r in bench.collect()]) if r[-1]]
    assert drawn.columns == docs.columns
    assert {r["doc_id"] for r in drawn.select("doc_id").collect()} == set(want)


# --- spelling --------------------------------------------------------------------------------------


def brute_spelling(docs, least=6, least_count=5, ratio=5, slip=199):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if slip:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % slip == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= least_count}
    near = {w: set() for w in words}
    holes = {}
    for w in words:  # two words are one edit apart if they agree after a letter is left out of one or both
        for at in range(len(w)):
            holes.setdefault((at, w[:at] + w[at + 1 :]), []).append(w)
            shorter = w[:at] + w[at + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for a in group:
            near[a].update(b for b in group if b != a)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            if words[best] >= ratio * words[w]:
                form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return out


def test_spelling(spark, docs):
    names = ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aabaaa", "ababab", "bababa", "abababa", "ÀÉÎÕÜÿ", "àéîõü×", "colouring", "coloring", "colorring", "kolorring"]
    times = [400, 60, 9, 7, 300, 8, 41, 9, 90, 1500, 250, 40, 6]
    text = " ".join(f"{w}," * n for w, n in zip(names, times))
    planted = spark.createDataFrame([(1, text), (None, text), (1, "zz" * 400_000 + " " + "Zz" * 400_000)], "doc_id long, text string")
    frame = docs.select("doc_id", "text").union(planted)
    for slip, ratio in ((199, 5), (3, 2), (0, 5)):
        got = spelling.spelling_variants(frame, ratio=ratio, slip=slip)
        assert got.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
        same([tuple(r) for r in got.collect()], brute_spelling(pairs(frame), slip=slip, ratio=ratio))
    assert spelling.spelling_variants(frame.limit(0)).count() == 0


def test_spelling_query(spark):
    got = queries.op13_spelling(spark, SF01)
    same([tuple(r) for r in got.collect()], brute_spelling(pairs(read(spark, SF01, "documents"))))


def test_chain_of_forms(spark):
    words = [("abcdefgh" + "x" * i, 4**(12 - i)) for i in range(12)]
    words = [(w, n) for w, n in words]
    frame = spark.createDataFrame(words, "word string, n long")
    pairs_ = {(r["a"], r["b"]) for r in spelling.near_words(frame).collect()}
    assert pairs_ == {(words[i][0], words[i + 1][0]) for i in range(11)}
    roots = spelling._roots(spark.createDataFrame([(words[i + 1][0], words[i][0]) for i in range(11)], "word string, form string"))
    assert {r["root"] for r in roots.collect()} == {"abcdefgh"} and roots.count() == 11


def test_pivots():
    weight = [5, 1, 9, 1]
    assert spelling.pivots([(0, 0), (1, 1), (2, 3)], weight) == [(1, 1), (2, 3)]
    assert spelling.pivots([(3, 0), (3, 1), (3, 2)], weight) == [(3, 0), (3, 2)]
