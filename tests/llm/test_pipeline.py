"""The stages of the pipeline, each against a brute-force version on its own input."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from test_corpus import classes, edit_distance, shingles
from test_scans import contamination, lowered, quality
from tidewake.llm import quality_rules
from tidewake.llm.frames import read

FOLDER = "/root/testdata/sf0.001"


def by_id(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def without_lines(docs, edits=2, least=20):
    """Texts without the lines that are within the distance, over chains, of an earlier one."""
    distinct = sorted({x for t in docs.values() for x in (t or "").encode().split(b"\n") if len(x) >= least}, key=len)
    parent = {x: x for x in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    counts = {x: [x.count(c) for c in b" aeinorst.,0123456789"] for x in distinct}
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if len(b) - len(a) > edits:
                break
            if sum(abs(p - q) for p, q in zip(counts[a], counts[b])) <= 2 * edits and edit_distance(a, b) <= edits:
                parent[find(a)] = find(b)
    seen, out = set(), {}
    for doc_id in sorted(docs):
        kept = []
        for x in (docs[doc_id] or "").encode().split(b"\n"):
            if len(x) >= least:
                if find(x) in seen:
                    continue
                seen.add(find(x))
            kept.append(x)
        text = b"\n".join(kept).decode()
        if text.strip() or not (docs[doc_id] or "").strip():
            out[doc_id] = text
    return out


def test_stages_against_brute_force(spark):
    docs, frames = read(spark, FOLDER, "documents"), []
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns
        frames.append(docs)
    start, sound, lined, single, clean = by_id(read(spark, FOLDER, "documents")), *map(by_id, frames)

    kept = {r["doc_id"] for r in quality_rules.score_quality(read(spark, FOLDER, "documents")).collect() if r["kept"]}
    assert set(sound) == kept and all(sound[i] == start[i] and not quality(sound[i])[5] for i in sound)
    want = without_lines(sound)
    assert {i: t or "" for i, t in lined.items()} == want
    rows = sorted(lined.items())
    verdict = classes([(i, t or "") for i, t in rows])
    leads = {c for (_, c, _), (_, t) in zip(verdict, rows) if shingles(t or "")} | {i for i, t in rows if not shingles(t or "")}
    assert set(single) == leads and all(single[i] == lined[i] for i in single)
    items = [tuple(r) for r in read(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    for i, n_words, n_hit, *_ in contamination(sorted(single.items()), items):
        assert len(lowered(clean[i])) == n_words - n_hit
    assert set(clean) == set(single)
    lengths = {r["doc_id"]: r["n_chars"] for r in frames[-1].collect()}
    assert lengths == {i: len(t or "") for i, t in clean.items()}

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    assert set(pieces) == set(clean)
    for i, parts in pieces.items():
        n, at = len(library.encode(clean[i] or "", add_special_tokens=False).ids) + 1, 0
        for first, length, whole in sorted(parts):
            assert first == at and whole == n
            at += length
        assert at == n


def test_whole_run(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(got.columns) and got.count() > 100
