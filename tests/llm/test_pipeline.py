"""The pipeline's rows against a brute-force run of its stages, and its stages on awkward rows."""

from __future__ import annotations

import re

import xxhash

import corpus_pipeline
from wardframe.llm import quality, texts

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _fingerprint(text):
    """64 bits, one at a time: what over half of the hashes of three-word shingles have set."""
    ws = text.translate(LOWER).encode().split()
    parts = [b" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or ([b" ".join(ws)] if ws else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def _least_linked(prints):
    """Of each id the smallest id that is reachable over links of three bits or fewer."""
    top = {i: i for i in prints}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if top[a] != top[b]:
                top[a] = top[b] = min(top[a], top[b])
                changed = True
    return top


def _windows(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    n = min(10, len(ws))
    return {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if n else set()


def test_pipeline_rows(spark):
    docs = texts.table(spark, SF, "documents")
    scored = quality.score(docs, texts.table(spark, SF, "labels")).collect()
    left = {r["doc_id"]: r["text"] or "" for r in scored if r["quality_score"] >= quality.REJECT_BELOW}
    last = {}
    for i in sorted(left):
        last[left[i].translate(LOWER)] = i
    left = {i: left[i] for i in last.values()}
    top = _least_linked({i: _fingerprint(t) for i, t in left.items()})
    left = {i: t for i, t in left.items() if top[i] == i}
    benchmark = set().union(*(_windows(r["text"]) for r in texts.table(spark, SF, "benchmark").collect()))
    left = {i: t for i, t in left.items() if not _windows(t) & benchmark}
    got = corpus_pipeline.run(spark, SF)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(left)


def test_stages_keep_columns_and_take_awkward_rows(spark):
    docs = texts.table(spark, SF, "documents").limit(30)
    odd = spark.createDataFrame([(None, None, None, None, None), (5000, "", "en", "s", 0), (5000, "", "en", "s", 0)], docs.schema)
    rows = docs.unionByName(odd)
    for source in (rows, rows.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, source, SF)
            assert result.count() <= source.count()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert result.columns == source.columns


def test_near_dedup_keeps_one_of_each_component(spark):
    docs = texts.table(spark, SF, "documents").where("text IS NOT NULL").dropDuplicates(["text"])
    spaced = docs.where("doc_id % 3 = 0").selectExpr("doc_id + 5000 AS doc_id", "replace(text, ' ', '  ') || ' end' AS text", "lang", "source", "n_chars")
    docs = docs.unionByName(spaced)
    top = _least_linked({r["doc_id"]: _fingerprint(r["text"]) for r in docs.collect()})
    assert any(top[i] != i for i in top)
    kept = corpus_pipeline.near_dedup(spark, docs, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i in top if top[i] == i)
