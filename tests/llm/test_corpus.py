"""Operators that compare texts with each other, against brute force."""

import hashlib
import math
import re
import zlib

import public_tokenizers
import pytest

from tidewake.llm import byte_dedup, lattice, line_dedup, ngram_join, passage_dedup
from tidewake.llm.frames import read

FOLDER = "/root/testdata/sf0.001"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    passage = " ".join(f"w{i}" for i in range(70))
    odd = [None, "", " \n", passage, "lead in " + passage + " tail", passage[:200] + " cut " + passage, "x " * 400, "y x " * 200, passage]
    odd += [" ".join(f"w{i}" for i in range(20, 75)), "é" * 500 + " " + passage, " ".join(f"w{i}" for i in range(30, 79)), "the " * 20_000]
    rows = [(100_000 + i, t, "en", f"s{i % 3}", 0, "clash") for i, t in enumerate(odd)]
    rows += [(None, passage, None, None, None, "x")] * 2 + [(100_003, passage, "en", "s", 0, "again")] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string")
    return frame.unionByName(read(spark, FOLDER, "documents"), allowMissingColumns=True)


def pairs(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def same(got, want):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def without_passages(rows, size):
    least = {}
    split = [(i, SPACES.findall(t)) for i, t in rows]
    for i, words in split:
        if i is not None:
            for at in range(len(words) - size + 1):
                key = tuple(words[at : at + size])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        if i is not None:
            for at in range(len(words) - size + 1):
                if least[tuple(words[at : at + size])] < i:
                    gone.update(range(at, at + size))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("size,seed", [(50, 10), (12, 4)])
def test_passages(docs, size, seed):
    got = passage_dedup.drop_repeated_passages(docs, size, seed).drop("kept_text")
    same([tuple(r) for r in got.collect()], without_passages(pairs(docs), size))
    assert passage_dedup.drop_repeated_passages(docs.limit(0)).count() == 0


def test_lattice_base_and_split(docs):
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    rows = lattice.score_documents(docs, vocabulary, head_words=300).collect()
    train, n = {}, 0
    split = []
    for i, t in pairs(docs):
        words = t.encode().lower().split() + [None]
        held = zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
        split.append((i, held, words))
        if not held:
            n += len(words)
            for w in words:
                train[w] = train.get(w, 0) + 1
    want = {}
    for i, held, words in split:
        base = sum(math.log10((train.get(w, 0) + 1) / (n + len(train) + 1)) for w in words)
        want.setdefault(i, []).append((held, len(words), sum(w in train for w in words), n, base))
    assert len(rows) == len(split)
    for r in rows:
        held, tokens, known, total, base = want[r["doc_id"]][0]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, tokens, known, total)
        assert abs(r["base_score"] - base) <= 1e-9 * abs(base) + 1e-9
        assert math.isfinite(r["score"]) and r["score"] < 0
    assert lattice.score_documents(docs.limit(0), vocabulary).count() == 0


def lattice_total(pieces, word, begin=0):
    """Probability of a word by trying all segmentations."""
    table = pieces.inner if begin else pieces.starting
    out = 0.0
    for e in range(begin + 1, len(word) + 1):
        if word[begin:e] in table:
            out += math.exp(table[word[begin:e]]) / 2 * (1 if e == len(word) else lattice_total(pieces, word, e))
    return out


def test_lattice_sums_all_segmentations():
    pieces = lattice.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert max(map(len, [*pieces.starting, *pieces.inner])) > 12  # no piece is left out for its length
    assert all(abs(sum(map(math.exp, t.values())) - 1) < 1e-9 for t in (pieces.starting, pieces.inner))
    model = lattice.Lattice(pieces)
    for word in (b"a", b"then", "größe".encode(), b"x1-y", b"information"):
        assert abs(model.log_probability(word) - math.log(lattice_total(pieces, word))) < 1e-9


def test_lattice_of_a_very_long_word():
    """A megabyte without white space: time and memory grow with its length only."""
    import time

    model = lattice.Lattice(lattice.load_pieces(public_tokenizers.path("piece_bpe_32k.model")))
    word = ("数据abcthe" * 84_000).encode()
    start = time.perf_counter()
    got = model.log_probability(word)
    assert math.isfinite(got) and got < -1e5 and time.perf_counter() - start < 60


def test_lattice_score_against_brute_force(docs):
    """The whole score: discounted word arcs, the lattice for what discounting takes, and the ends."""
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    pieces = lattice.load_pieces(vocabulary)
    frame = docs.filter("doc_id < 25 or doc_id in (100001, 100007, 100010)")
    rows = [(i, t.encode().lower().split()) for i, t in pairs(frame)]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    train = {}
    for i, words in rows:
        for w in words if not held(i) else ():
            train[w] = train.get(w, 0) + 1
    ends, tokens = sum(not held(i) for i, _ in rows), sum(train.values())
    once, twice = (sum(n == k for n in train.values()) for k in (1, 2))
    discount = once / (once + 2 * twice)
    p_end = (ends + 1) / (tokens + ends + 2)
    model = lattice.Lattice(pieces)

    def score(word):
        arc = max(train.get(word, 0) - discount, 0) / tokens
        left = discount * len(train) / tokens * math.exp(model.log_probability(word))
        return math.log10((arc + left) * (1 - p_end))

    got = {r["doc_id"]: r["score"] for r in lattice.score_documents(frame, vocabulary, head_words=50).collect()}
    for i, words in rows:
        want = sum(map(score, words)) + math.log10(p_end)
        assert abs(got[i] - want) <= 1e-9 * abs(want)


LOWER_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text, size=5):
    words = LOWER_WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def classes(rows, similarity=0.8):
    sets = [shingles(t) for _, t in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    members = {}
    for i, (doc_id, _) in enumerate(rows):
        members.setdefault(find(i), []).append(doc_id)
    return [(d, min((x for x in members[find(i)] if x is not None), default=None), links[i]) for i, (d, _) in enumerate(rows)]


@pytest.fixture(scope="module")
def near(spark, docs):
    import random

    draw = random.Random(2)
    base = [f"v{draw.randint(0, 500)}" for _ in range(120)]
    rows = []
    for k in range(60):
        words = list(base)
        for _ in range(k % 7):
            words[draw.randint(0, 119)] = f"u{draw.randint(0, 999)}"
        rows.append((200_000 + k, " ".join(words), "en", "s", 0, ""))
    return docs.unionByName(spark.createDataFrame(rows, docs.schema))


@pytest.mark.parametrize("bucket", [400, 8])
def test_similar_documents(near, bucket, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET", bucket)
    got = ngram_join.similar_documents(near)
    want = classes(pairs(near))
    assert sum(w[2] > 0 for w in want) > 50
    same([tuple(r) for r in got.select("doc_id", "class_id", "n_links").collect()], want)
    if bucket == 400:
        kept = ngram_join.drop_similar(near)
        wordless = sum(not shingles(t) for _, t in pairs(near))
        assert kept.columns == near.columns
        groups = {c for (_, c, _), (_, t) in zip(want, pairs(near)) if shingles(t)}
        assert kept.count() == len(groups) + wordless


@pytest.mark.parametrize("bucket", [400, 8])
def test_shingles_go_to_first_meetings_only(near, bucket, monkeypatch):
    """A pair is verified in one bucket, so its sets are sent to few of those in which they look alike."""
    monkeypatch.setattr(ngram_join, "BUCKET", bucket)
    staged, whole = {}, ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", lambda df, label: staged.setdefault(label, whole(df, label)))
    ngram_join.similar_documents(near)
    likely, meeting = (staged[k].select("bucket", "part", "sid") for k in ("likely-members", "meeting-members"))
    assert meeting.exceptAll(likely).count() == 0
    assert 0 < meeting.count() < likely.count() / 2
    assert meeting.groupBy("bucket", "part").count().filter("count < 2").count() == 0


def test_pairs_met_first():
    import random

    import numpy as np
    import pyarrow as pa

    draw = random.Random(5)
    lists = [sorted(draw.sample(range(40), draw.randint(0, 6)) + [20]) for _ in range(30)]
    own = np.array([draw.randint(2, 3) for _ in lists], np.int32)
    for low, high in ((2, 2), (2, 3)):
        got = ngram_join._met_first(20, low * ngram_join.PART + high, own, pa.array([[0], *lists], pa.list_(pa.int64()))[1:])
        want = [
            [i != j and min(set(a) & set(b)) == 20 and (low == high or own[i] != own[j]) for j, b in enumerate(lists)]
            for i, a in enumerate(lists)
        ]
        assert got.tolist() == want


@pytest.mark.parametrize("similarity", [0.8, 0.5])
def test_recall_at_full_depth(spark, similarity, monkeypatch):
    """1,000 pairs at the threshold, every bucket split to full depth."""
    import random

    monkeypatch.setattr(ngram_join, "BUCKET", 1)
    draw = random.Random(11)
    rows, planted = [], []
    for k in range(1000):
        words = [f"w{draw.randrange(10**9)}" for _ in range(124)]
        # a change of five words spoils nine shingles of 120; the changes are apart
        other, spoiled = list(words), 0
        for at in range(6, 118, 10):
            if 120 - spoiled - 10 >= similarity * (120 + spoiled + 10):
                other[at : at + 2] = [f"x{draw.randrange(10**9)}", f"x{draw.randrange(10**9)}"]
                spoiled = 120 - len(shingles(" ".join(words)) & shingles(" ".join(other)))
        common = len(shingles(" ".join(words)) & shingles(" ".join(other)))
        assert similarity <= common / (240 - common) < similarity + 0.12
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        planted.append(2 * k)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.similar_documents(frame, similarity).collect()}
    found = sum(got[i] == (i, 1) == got[i + 1] for i in planted)
    assert found >= 990 and all(n == 0 or (c // 2 == i // 2) for i, (c, n) in got.items())


def test_threshold_is_checked(docs):
    with pytest.raises(ValueError):
        ngram_join.similar_documents(docs, 0.0)


def test_similar_documents_of_nothing(docs):
    assert ngram_join.similar_documents(docs.limit(0)).count() == 0


def test_components(spark):
    import random

    from tidewake.llm.components import connected, local_roots

    draw = random.Random(4)
    pairs_ = [(draw.randint(0, 400), draw.randint(0, 400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 560)]
    roots = local_roots(600, pairs_)
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(pairs_, "a long, b long")).collect()}
    assert got and all(roots[n] == r for n, r in got.items())
    assert set(got) == {x for p in pairs_ for x in p if p[0] != p[1]}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(edits):
    import random

    draw = random.Random(edits)
    short, long = [], []
    for _ in range(600):
        a = bytes(draw.choice(b"ab") for _ in range(draw.randint(1, 40)))
        b = bytearray(a)
        for _ in range(draw.randint(0, edits + 1)):
            k = draw.randint(0, len(b))
            b[k : k + draw.randint(0, 1)] = bytes(draw.choice(b"abc") for _ in range(draw.randint(0, 1)))
        x, y = sorted((a, bytes(b)), key=len)
        if len(y) - len(x) <= edits:
            short.append(x)
            long.append(y)
    got = line_dedup.within_edits(short, long, edits)
    assert got.tolist() == [edit_distance(a, b) <= edits for a, b in zip(short, long)]
    assert 0 < got.sum() < len(got)
    # very long lines take another way
    got = [line_dedup._near(a, b, edits) for a, b in zip(short, long)]
    assert got == [edit_distance(a, b) <= edits for a, b in zip(short, long)]
    line = bytes(draw.choices(b"abc", k=900_000))
    near = line[:1000] + b"x" + line[1000:-500] + b"y" + line[-500:]
    assert line_dedup.within_edits([line, line], [line[::-1], near], edits).tolist() == [False, edits >= 2]


def first_lines(rows, edits, least):
    distinct = sorted({x for _, t in rows for x in t.encode().split(b"\n") if len(x) >= least})
    parent = {x: x for x in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if abs(len(a) - len(b)) <= edits and sum(abs(a.count(c) - b.count(c)) for c in set(a + b)) <= 2 * edits:
                if edit_distance(a, b) <= edits:
                    parent[find(a)] = find(b)
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        n = gone = 0
        for x in text.encode().split(b"\n"):
            if len(x) >= least:
                n += 1
                gone += find(x) in seen
                seen.add(find(x))
        out[doc_id] = (n, gone)
    return out


@pytest.fixture(scope="module")
def lined(spark, docs):
    import random

    draw = random.Random(8)
    rows = []
    for k in range(40):
        lines = []
        for _ in range(6):
            line = bytearray(draw.choice([b"the quick brown fox jumps over it", b"a licence line that all documents share", "größere Zeilen mit Umlauten äöü".encode()]))
            for _ in range(draw.randint(0, 3)):
                i = draw.randint(0, len(line))
                line[i : i + draw.randint(0, 1)] = bytes([draw.randint(97, 122)] * draw.randint(0, 1))
            lines.append(line.decode(errors="ignore"))
        rows.append((300_000 + k, "\n".join(lines) + "\n\nshort\n", "en", "s", 0, ""))
    return docs.filter("doc_id < 60 or doc_id in (100001, 100005)").unionByName(spark.createDataFrame(rows, docs.schema))


@pytest.mark.parametrize("bucket", [400, 7])
def test_lines(lined, bucket, monkeypatch):
    monkeypatch.setattr(line_dedup, "BUCKET", bucket)
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in line_dedup.repeated_lines(lined).collect()}
    want = first_lines(pairs(lined), 2, 20)
    assert got == want and sum(g for _, g in want.values()) > 100
    if bucket == 400:
        out = line_dedup.drop_repeated_lines(lined)
        assert out.columns == lined.columns
        again = {r["doc_id"]: r["n_removed"] for r in line_dedup.repeated_lines(out).collect()}
        assert set(again.values()) == {0}


@pytest.mark.parametrize("bucket,edits", [(5, 2), (2, 1)])
def test_template_lines(spark, bucket, edits, monkeypatch):
    """Lines of one template, some near each other: all segments are crowded, and what is left is cut again and signed."""
    import random

    monkeypatch.setattr(line_dedup, "BUCKET", bucket)
    draw = random.Random(21)
    lines = [f"Posted by user {draw.randrange(300):04d} on 2024-0{draw.randint(1, 9)}-{draw.randint(10, 28)} in the forum" for _ in range(70)]
    lines += [f"Page {draw.randrange(10**6)} of the printed volume of größere Werke" for _ in range(40)]
    for line in list(lines[:30]):
        at = draw.randrange(len(line))
        lines.append(line[:at] + draw.choice(["", "x", "yz"]) + line[at + draw.randint(0, 1) :])
    rows = [(i, "\n".join(lines[i::12])) for i in range(12)]
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), edits).collect()}
    want = first_lines(rows, edits, 20)
    assert got == want and 0 < sum(g for _, g in want.values()) < len(lines)


def test_template_lines_in_near_linear_time(spark):
    """Far apart lines of one template, one a document; a quadratic comparison of these takes many minutes."""
    import random
    import time

    draw = random.Random(22)
    rows = [(i, f"Posted by user {draw.randrange(10**8):08d} at {draw.randrange(10**8):08d} in the forum") for i in range(20_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    start = time.perf_counter()
    gone = line_dedup.repeated_lines(frame).agg({"n_removed": "sum"}).first()[0]
    assert gone < 50 and time.perf_counter() - start < 150


def test_lines_of_odd_rows(spark):
    """Null ids, null texts, repeated rows and columns of clashing names; a text of one very long line."""
    long = "x y z " * 20_000
    rows = [(None, "a licence line that all share\nmine alone, and long enough", "k", True), (1, "a licence line that all share\n\nshort", "k", None)]
    rows += [(1, rows[1][1], "k", None), (2, None, None, None), (None, None, None, None), (3, "", "k", True), (4, " \n", "k", True)]
    rows += [(5, long, "k", True), (6, long + "!", "k", True), (7, "a licence line that all share", "k", True)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, others string, wordless boolean")
    out = line_dedup.drop_repeated_lines(frame)
    assert out.columns == frame.columns
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "", r["others"] or "") for r in out.collect())
    kept = [(-1, "", ""), (-1, "mine alone, and long enough", "k"), (1, rows[1][1], "k"), (1, rows[1][1], "k"), (2, "", ""), (3, "", "k"), (4, " \n", "k"), (5, long, "k")]
    assert got == sorted(kept)


def test_lines_of_nothing(docs):
    assert line_dedup.repeated_lines(docs.limit(0)).count() == 0
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def repeated_bytes(rows, window, keep_first):
    where = {}
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for k, (_, t) in enumerate(ordered):
        raw = t.encode()
        for at in range(len(raw) - window + 1):
            where.setdefault(raw[at : at + window], []).append((k, at))
    gone = [set() for _ in ordered]
    for places in where.values():
        for k, at in places[1:] if keep_first else places if len(places) > 1 else ():
            gone[k].update(range(at, at + window))
    out = []
    for (doc_id, t), drop in zip(ordered, gone):
        raw = t.encode()
        spans = sum(1 for i in drop if i - 1 not in drop)
        kept = bytes(b for i, b in enumerate(raw) if i not in drop)
        out.append((doc_id, len(raw), len(drop), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_factors_of_contexts():
    """Strings that contexts of a seed share, with ends, zero bytes and groups of their own, against all pairs."""
    import random

    import numpy as np

    draw = random.Random(3)
    window, size = 12, 4
    reach = window - size
    for _ in range(150):
        n = draw.randint(1, 14)
        group = np.array(sorted(draw.randint(1, 3) for _ in range(n)))
        left = [bytes(draw.choice([0, 97, 97, 98]) for _ in range(draw.randint(0, reach))) for _ in range(n)]
        right = [bytes(draw.choice([0, 97, 97, 98]) for _ in range(draw.randint(0, reach))) for _ in range(n)]
        contexts = [a + b"seed" + b for a, b in zip(left, right)]
        data = np.frombuffer(b"".join(contexts), np.uint8)
        offsets = np.cumsum([0, *map(len, contexts)])
        place = np.array(draw.sample(range(n), n))
        for keep_first in (True, False):
            want = {}
            for i in range(n):
                for far in range(max(0, reach - len(right[i])), len(left[i]) + 1):
                    mine = contexts[i][len(left[i]) - far : len(left[i]) - far + window]
                    for j in range(n):
                        if j != i and group[j] == group[i] and len(left[j]) >= far and len(right[j]) >= reach - far:
                            if contexts[j][len(left[j]) - far :][:window] == mine and (place[j] < place[i] or not keep_first):
                                low, high = want.get(i, (far, far))
                                want[i] = (min(low, far), max(high, far))
            seed_at = np.array([len(x) for x in left])
            got = byte_dedup.matched_distances(data, offsets, seed_at, group, place, window, size, keep_first)
            assert {i: (a, b) for i, a, b in zip(*(x.tolist() for x in got))} == want


@pytest.mark.parametrize("hot,seed", [(1000, 64), (1, 16)])
def test_bytes(docs, hot, seed):
    rows = docs.filter("doc_id is null or doc_id < 80 or doc_id between 100000 and 100011")
    got = byte_dedup.find_repeated_bytes(rows, 150, False, seed, hot).drop("removed")
    same([tuple(r) for r in got.collect()], repeated_bytes(pairs(rows), 150, False))


@pytest.mark.parametrize("hot", [1000, 1])
def test_bytes_keep_first(docs, hot):
    rows = docs.filter("doc_id < 60 or doc_id between 100000 and 100011").dropDuplicates(["doc_id"])
    got = byte_dedup.find_repeated_bytes(rows, 150, True, hot=hot).drop("removed")
    same([tuple(r) for r in got.collect()], repeated_bytes(pairs(rows), 150, True))
    assert byte_dedup.find_repeated_bytes(docs.limit(0)).count() == 0
