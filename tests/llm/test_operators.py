"""The training-data operators against brute force, round trips, held-out accuracy and awkward rows."""

from __future__ import annotations

import hashlib
import json
import re
import zlib

import numpy as np
import pytest
import public_tokenizers
import tiktoken
import xxhash

from tests.compare import compare, oracle_connection
from wardframe.llm import bpe, digests, html_text, langid, licenses, quality, separators, simhash, texts, urls, wumanber
from wardframe.llm.queries import END_ID, ORACLE_SQL, QUERIES, codec

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ENCODING = tiktoken.Encoding("r", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})

AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a" * 3000 + " " + "-=" * 500),
    (5, "Licence: CC BY, cc by; All Rights Reserved. GNU General Public License"),
    (6, "ünïcödé 漢字かな交じり文 🙂🙂 İstanbul ſ"),
    (7, "x\u00a0y\u2003z 'll don't 12345 \x1c\x1d ab\x00cd"),
    (8, "one two three four five six seven eight nine ten eleven twelve"),
    (8, "one two three four five six seven eight nine ten eleven twelve"),
    (9, "ONE two three four five six seven eight nine ten eleven twelve"),
    (None, "no id"),
    (None, None),
    (10, "word " * 4000 + "end"),
    (11, "!!! ??? ###"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, "clash", 1.5) for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, score double")


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.where("false")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    verdict = compare(spark, oracle_connection(SF), SF, name, QUERIES[name], ORACLE_SQL[name])
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_every_row(spark, name):
    table = "pages" if name in ("op9_urls", "op10_html") else "documents"
    assert QUERIES[name](spark, SF).count() == texts.table(spark, SF, table).count()


# --- byte-level BPE -------------------------------------------------------------------------


def test_bpe_is_what_tiktoken_gives(spark, awkward):
    want = []
    for i, t in AWKWARD:
        ids = ENCODING.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert ordered(bpe.round_trip(awkward, codec()).collect()) == ordered(want)


def test_bpe_encodes_and_decodes(spark, awkward, nothing):
    encoded = bpe.encode(awkward, codec())
    want = [(i, ENCODING.encode_ordinary(t or "")) for i, t in AWKWARD]
    assert ordered(encoded.collect()) == ordered(want)
    decoded = bpe.decode(encoded, codec()).collect()
    assert ordered((r[0], bytes(r[1]).decode()) for r in decoded) == ordered((i, t or "") for i, t in AWKWARD)
    assert bpe.encode(nothing, codec()).count() == bpe.round_trip(nothing, codec()).count() == 0


def test_bpe_on_query_texts(spark):
    docs = {r["doc_id"]: r["text"] for r in texts.table(spark, SF, "documents").collect()}
    for r in QUERIES["op1_bpe"](spark, SF).collect():
        ids = ENCODING.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(" ".join(map(str, ids)).encode()))
        assert r["decoded_sha256"] == sha(docs[r["doc_id"]].encode())


def test_bpe_long_texts_go_in_parts_and_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_BYTES", 500)
    monkeypatch.setattr(bpe, "LONG_PIECES", 7)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    own = codec()
    random = np.random.default_rng(1)
    text = " ".join("".join(chr(97 + c) for c in random.integers(0, 26, n)) for n in random.integers(1, 90, 300))
    ids = [i for part in own.encoded([text]) if part for i in part[0]]
    assert " ".join(ids) == " ".join(map(str, ENCODING.encode_ordinary(text)))
    assert len(own._ids) < 40


# --- exact dedup ----------------------------------------------------------------------------


def test_exact_dedup_rows(spark, awkward, nothing):
    groups = {}
    for i, t in AWKWARD:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    want = []
    for i, t in AWKWARD:
        own = groups[(t or "").translate(LOWER)]
        keep = max((x for x in own if x is not None), default=None)
        want.append((i, keep, len(own), i == keep, sha((t or "").translate(LOWER).encode())))
    got = digests.deduplicate(awkward, digests.new_index(spark))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert ordered(got.collect()) == ordered(want)
    assert digests.deduplicate(nothing, digests.new_index(spark)).count() == 0


def test_digest_index_goes_on(spark):
    index = digests.new_index(spark)
    one = spark.createDataFrame([(1, "A"), (2, "a"), (3, "b")], "doc_id long, text string")
    two = spark.createDataFrame([(9, "a"), (8, "c"), (7, "C")], "doc_id long, text string")
    assert {r[0]: r["kept"] for r in digests.deduplicate(one, index).collect()} == {1: False, 2: True, 3: True}
    found = {r[0]: (r["keep_id"], r["kept"]) for r in digests.deduplicate(two, index).collect()}
    assert found == {9: (2, False), 8: (8, True), 7: (8, False)}
    assert index.rows().count() == 3
    three = spark.createDataFrame([(5, "d"), (4, "D")], "doc_id long, text string")
    for _ in range(2):  # a batch that is repeated gets the same verdicts
        assert {r[0]: r["kept"] for r in digests.deduplicate(three, index, batch="third").collect()} == {5: True, 4: False}
    assert index.rows().count() == 4
    plan = one.select(digests.text_digest(one["text"]).alias("digest")).join(
        index.rows().select("digest").hint("merge"), "digest", "left_anti"
    )
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") <= 1  # none on the side of the index


def test_distinct_documents_keep_one_row_each(spark, awkward):
    kept = digests.distinct_documents(awkward)
    assert kept.columns == awkward.columns
    found = [(r["text"] or "").translate(LOWER) for r in kept.collect()]
    assert sorted(found) == sorted({(t or "").translate(LOWER) for _, t in AWKWARD})


# --- token counts ---------------------------------------------------------------------------


def _tokenizer():
    return separators.Tokenizer(RANKS, public_tokenizers.PATTERN)


def test_token_counts(spark, awkward, nothing):
    got = separators.document_token_counts(awkward, _tokenizer(), END_ID)
    assert ordered(got.collect()) == ordered((i, len(ENCODING.encode_ordinary(t or ""))) for i, t in AWKWARD)
    assert separators.document_token_counts(nothing, _tokenizer(), END_ID).count() == 0


@pytest.mark.parametrize("block", [2, 4, 6, 10, 1 << 20])
def test_blocks_are_stitched(spark, tmp_path, block):
    files = {
        "a": [1, 2, 9, 9, 3, 9],
        "b": [9],
        "c": [1, 2, 3, 4, 5, 6, 7],
        "d": [9, 1, 1, 1, 1, 1, 1, 1, 1, 9, 5],
        "e": [],
    }
    want = []
    for name, ids in files.items():
        np.array(ids, dtype="<u2").tofile(tmp_path / name)
        parts, run = [], []
        for x in ids:
            if x == 9:
                parts.append((len(run), True))
                run = []
            else:
                run.append(x)
        parts += [(len(run), False)] if run else []
        want += [(str(tmp_path / name), i, n, ended) for i, (n, ended) in enumerate(parts)]
    df = spark.createDataFrame([(str(tmp_path / n),) for n in files], "file string")
    assert ordered(separators.count_tokens(df, 9, block).collect()) == ordered(want)


# --- language ID ----------------------------------------------------------------------------


def test_language_on_held_out_documents(spark):
    rows = QUERIES["op4_language"](spark, "/root/testdata/sf0.01").collect()
    lang = {r["doc_id"]: r["lang"] for r in texts.table(spark, "/root/testdata/sf0.01", "documents").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(held) > 100 and np.mean(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_awkward(spark, awkward, nothing):
    docs = texts.table(spark, SF, "documents")
    network = langid.fit_language_network(docs, per_language=40)
    got = langid.predict_language(awkward, network).collect()
    assert len(got) == len(AWKWARD)
    none = {i for i, t in AWKWARD if not t or not re.search(r"[^\W\d_]", t)}
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == none
    assert langid.predict_language(nothing, network).count() == 0
    unlabelled = awkward.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert langid.fit_language_network(unlabelled) is None
    assert {r["lang_pred"] for r in langid.predict_language(unlabelled, None).collect()} == {"und"}


def test_network_gradient():
    random = np.random.default_rng(0)
    windows = random.integers(97, 123, (60, langid.WINDOW)).astype(np.uint8)
    windows[:30, 5:8] = np.frombuffer(b"###", np.uint8)
    net = langid.train(windows, np.repeat([0, 1], 30), ["a", "b"], epochs=6)
    assert (net.probabilities(windows).argmax(1) == np.repeat([0, 1], 30)).mean() > 0.95


# --- decontamination ------------------------------------------------------------------------


def _brute_passages(text, items):
    ws, hit, names = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(10, len(iw))
        for i in range(len(iw) - n + 1 if n else 0):
            for j in range(len(ws) - n + 1):
                if ws[j : j + n] == iw[i : i + n]:
                    hit |= set(range(j, j + n))
                    names.add(str(item))
    return len(ws), len(hit), sorted(names)


@pytest.mark.parametrize("piece", [1 << 22, 30])
@pytest.mark.parametrize("block_bytes", [1 << 23, 60])
def test_passages(spark, awkward, nothing, monkeypatch, piece, block_bytes):
    monkeypatch.setattr(texts, "PIECE_BYTES", piece)
    items = [
        (1, "zero one TWO three four, five six seven eight nine ten eleven"),
        (2, "Rights reserved"), (2, "漢字かな交じり文"), (3, None), (4, "..."), (None, "word"), (5, "word word word"),
        (10, "word"), (11, "aaa " * 12),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = wumanber.find_passages(awkward, benchmark, block_bytes=block_bytes)
    rows = got.select("doc_id", "n_words", wumanber.n_hit().alias("n"), "hit_items").collect()
    real = [(i, t) for i, t in items if i is not None]
    assert ordered(rows) == ordered((i, *_brute_passages(t, real)) for i, t in AWKWARD)
    assert wumanber.find_passages(nothing, benchmark).count() == 0
    assert all(r[2] == 0 for r in _hits(wumanber.find_passages(awkward, benchmark.where("false"))))


def _hits(found):
    return found.select("doc_id", "n_words", wumanber.n_hit()).collect()


def test_decontaminated_keeps_columns(spark, awkward):
    benchmark = spark.createDataFrame([(1, "two three four")], "item_id long, text string")
    kept = wumanber.decontaminated(awkward, benchmark)
    assert kept.columns == awkward.columns
    want = [(i, t, "clash", 1.5) for i, t in AWKWARD if "two three four" not in (t or "")]
    assert ordered(kept.collect()) == ordered(want)


def test_shared_blocks_of_random_words():
    random = np.random.default_rng(3)
    for _ in range(30):
        text = " ".join(random.choice(list("abc"), 200))
        items = [(str(i), " ".join(random.choice(list("abc"), n))) for i, n in enumerate([1, 2, 3, 5, 6, 9, 10, 11, 30])]
        n, spans, names = wumanber.Patterns(items).search(text.encode())
        assert (n, sum(e - b for b, e in spans), sorted(names)) == _brute_passages(text, items)


# --- SimHash --------------------------------------------------------------------------------


def _brute_fingerprint(text):
    ws = (text or "").encode().lower().split()
    parts = [b" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or ([b" ".join(ws)] if ws else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _brute_components(prints, radius=3):
    top = {p: p for p in prints}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in prints:
        for b in prints:
            if bin(a ^ b).count("1") <= radius:
                top[max(root(a), root(b))] = min(root(a), root(b))
    return {p: root(p) for p in prints}


def test_fingerprints_and_components(spark, awkward, nothing, monkeypatch):
    for piece in (1 << 22, 40):
        monkeypatch.setattr(texts, "PIECE_BYTES", piece)
        assert all(simhash.fingerprint((t or "").encode()) == _brute_fingerprint(t) for _, t in AWKWARD)
    got = simhash.near_duplicates(awkward).collect()
    prints = [(i, _brute_fingerprint(t)) for i, t in AWKWARD]
    tops = _brute_components([p for _, p in prints])
    least = {}
    for i, p in prints:
        if i is not None:
            least[tops[p]] = min(i, least.get(tops[p], i))
    assert ordered(got) == ordered((i, f"{p:016x}", least.get(tops[p])) for i, p in prints)
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("shard", [4000, 16])
def test_links_connect_what_is_linked(spark, shard):
    """Dense clusters, chains and far points; a small shard cuts every group into blocks."""
    random = np.random.default_rng(5)
    centres = [int(x) for x in random.integers(0, 1 << 63, 6)] + [0, (1 << 64) - 1]
    prints = set(centres)
    for c in centres:
        for _ in range(60):
            prints.add(c ^ sum(1 << int(b) for b in random.choice(64, int(random.integers(1, 4)), replace=False)))
    chain = centres[0]
    for b in range(0, 60, 3):
        chain ^= 7 << b
        prints.add(chain)
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(3)
    roots = {r["fp"]: r["root"] for r in simhash.components(simhash.links(df, shard=shard)).collect()}
    tops = _brute_components(list(prints))
    groups = {}
    for p, s in zip(prints, signed, strict=True):
        groups.setdefault(tops[p], set()).add(roots.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_bk_tree_follows_only_some_edges():
    random = np.random.default_rng(2)
    values = random.integers(0, 1 << 64, 3000, dtype=np.uint64)
    queries = np.concatenate([values[:50] ^ np.uint64(5), random.integers(0, 1 << 64, 50, dtype=np.uint64)])
    found = {(int(a), int(b)) for x, y in simhash.BKTree(values).within(3, queries, np.arange(100)) for a, b in zip(x, y, strict=True)}
    apart = np.bitwise_count(queries[:, None] ^ values[None, :])
    assert found == set(zip(*(x.tolist() for x in np.nonzero(apart <= 3)), strict=True))


@pytest.mark.parametrize("shard", [4000, 16])
def test_links_come_from_trees(spark, monkeypatch, shard):
    """Without the search of the trees nothing links, however small the shards are."""
    df = spark.createDataFrame([(i << 40,) for i in range(8)], "fp long")
    assert simhash.links(df, shard=shard).count() > 0
    monkeypatch.setattr(simhash.BKTree, "within", lambda *_: iter(()))
    assert simhash.links(df, shard=shard).count() == 0


def test_one_document_of_each_component_stays(spark, awkward):
    kept = simhash.representatives(awkward)
    assert kept.columns == awkward.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == [1, 4, 5, 6, 7, 8, 8, 10, 11]


def test_rows_stay_by_id_and_text(spark):
    """Null ids and ids of several texts: a row goes only if its own text is a copy of a smaller id's."""
    text = lambda name, between=" ": between.join(f"{name}{i}" for i in range(40))
    rows = [(1, text("a")), (None, text("a", "\n")), (None, text("b")), (None, text("c")), (None, text("c", "  "))]
    rows += [(3, text("a", "\t")), (3, text("d")), (4, text("d", " \n"))]
    kept = simhash.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    first = min((3, 4), key=lambda i: sha(rows[i][1].encode()))
    assert ordered(kept) == ordered(rows[i] for i in (0, 2, first, 6))


# --- quality --------------------------------------------------------------------------------


def test_quality_of_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = texts.table(spark, sf, "labels")
    docs = texts.table(spark, sf, "documents")
    # fit on labels of even ids, judge the others
    scored = quality.score(docs, labels.where("doc_id % 2 = 0"))
    rows = scored.join(labels.where("doc_id % 2 = 1"), "doc_id").select("quality", "quality_score").collect()
    right = [(r["quality_score"] >= quality.REJECT_BELOW) == bool(r["quality"]) for r in rows]
    assert len(rows) > 100 and np.mean(right) > 0.97


def test_quality_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (11, 0, 0), (5, 1, 1), (None, 0, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    docs = awkward.selectExpr("*", "CAST(NULL AS STRING) AS source", "text AS lang", "'x' AS quality_score")
    got = quality.score(docs, labels)
    assert got.count() == len(AWKWARD)
    assert all(0 <= r["quality_score"] <= 1 for r in got.collect())
    assert quality.accepted(docs, labels).columns == docs.columns
    assert quality.score(docs.where("false"), labels).count() == 0
    assert quality.score(docs, labels.where("false")).count() == len(AWKWARD)


def test_sites_are_shrunk(spark):
    rows = [(i, "t", "big" if i < 400 else "small" if i < 402 else f"s{i % 9}", "p") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame(
        [(i, int(i % 10 == 0) if i < 400 else int(i >= 402), 0) for i in range(700)], "doc_id long, quality int, toxic int"
    )
    rates = {r["host"]: r for r in quality.site_posteriors(docs, labels, quality.document_sites()).collect()}
    assert abs(rates["big"]["host_rate"] - 0.1) < 0.05
    assert 0.02 < rates["small"]["path_rate"] < rates["small"]["rate"]


# --- licenses -------------------------------------------------------------------------------


def _brute_licenses(text):
    ws, places = words(text), []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]
    places.sort()
    first, last = (places[0][0], places[-1][0]) if places else (None, None)
    return len(ws), len(places), first, last, ",".join(sorted({label for _, label in places}))


@pytest.mark.parametrize("piece", [1 << 22, 25])
def test_license_phrases(spark, awkward, nothing, monkeypatch, piece):
    monkeypatch.setattr(texts, "PIECE_BYTES", piece)
    for _, t in [*AWKWARD, (0, "cc by cc by all rights reserved " * 40)]:
        n, places, _ = licenses.Scanner().scan((t or "").encode())
        assert (n, len(places)) == _brute_licenses(t)[:2]
    got = licenses.scan_licenses(awkward)
    want = [(i, *_brute_licenses(t)) for i, t in AWKWARD]
    assert ordered(r[:6] for r in got.collect()) == ordered(want)
    assert licenses.scan_licenses(nothing).count() == 0


def test_templates():
    def labels(text):
        return {s[0] for s in licenses.Scanner().scan(text.encode())[2]}

    assert labels("Licensed under the Apache License, Version 2.0.") == {"apache-2.0"}
    assert labels("licensed under the apache license 2.0 (the License); you may not use this work except in compliance with the License") == {"apache-2.0"}
    assert labels("Licensed under the Apache Licence, Version 2.0.") == set()
    assert labels("Released under the terms of the MIT License") == {"mit"}
    assert labels("under the MIT or BSD License") == set()
    assert labels("This work is licensed under the GNU General Public License, version 3.") == {"gpl-3.0"}
    assert labels("Licensed under CC BY-NC 4.0.") == {"cc-by-nc-4.0"}
    assert labels("Copyright (c) 2020, Some Body. All rights reserved.") == {"copyright-notice"}
    assert labels("Copyright " + "x " * 9 + "all rights reserved") == set()


# --- URLs -----------------------------------------------------------------------------------


def test_urls_awkward(spark):
    rows = [
        (1, "http://Shop.Example.NET/en/x?q"), (2, "http://example.net/de/"), (3, "https://a.ORG/fr/"), (4, None), (5, "no scheme"),
        (6, "http://bad.site/page.html"), (7, "http://www.bad.site/page/?a"), (8, "http://other.site/"), (9, "http://x.evil.io"),
        (9, "http://x.evil.io"), (None, "://"), (10, "http://notexample.com/de/"), (11, "http://example.com/de/1"), (12, "a://b/c://d/"),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, key string")
    listed = spark.createDataFrame([("bad.site/page",), ("evil.io",), (None,), ("",), ("evil.io",)], "key string")
    got = urls.judge(pages, listed)
    found = {r["page_id"]: r for r in got.collect()}
    assert got.count() == len(rows)
    verdicts = {i: (r["rule"], r["verdict"]) for i, r in found.items()}
    assert verdicts[1] == ("example.net/en/", "allow") and verdicts[2] == ("net/", "block")
    assert verdicts[3] == ("org/fr/", "allow") and verdicts[11] == ("example.com/de/", "block")
    assert [verdicts[i][1] for i in (6, 7, 8, 9, 4, 5)] == ["block", "block", "allow", "block", "allow", "allow"]
    assert verdicts[10] == (None, "allow") and (found[12]["host"], found[12]["path"]) == ("b", "/c://d/")
    assert (found[1]["host"], found[1]["path"]) == ("shop.example.net", "/en/x")
    assert urls.judge(pages.where("false"), listed).count() == 0
    assert {r["verdict"] for r in urls.judge(pages.where("page_id = 6"), listed.where("false")).collect()} == {"allow"}


def test_listed_urls_are_made_canonical(spark):
    rows = [(1, "https://bad.site/page/?q"), (2, "http://bad.site/page2"), (3, "http://m.gone.io/x/y"), (4, "http://a.lost.org/"), (5, "http://lost.com/z")]
    listed = spark.createDataFrame([("http://www.Bad.site/page/index.html",), ("http://www.bad.SITE/page.html?x#y",), ("ftp://gone.io",), ("://",), ("https://lost.com//z/",)], "key string")
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), listed).collect()
    assert {r["page_id"]: r["listed_key"] for r in got} == {1: "bad.site/page", 2: None, 3: "gone.io", 4: None, 5: "lost.com/z"}


def test_filter_misses_nothing(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) AS key")
    made = urls.build_filter(keys)
    hashes = np.array([r[0] for r in keys.selectExpr("xxhash64(key)").collect()])
    others = np.array([r[0] for r in spark.range(20000).selectExpr("xxhash64(concat('other', id))").collect()])
    assert made.passes(hashes).all() and made.passes(others).mean() < 0.01
    small = urls.build_filter(keys, most_bytes=640)
    assert small.words.nbytes == 640 and small.passes(hashes).all()


# --- HTML -----------------------------------------------------------------------------------


def test_html_pages_hold_their_article(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in texts.table(spark, SF, "pages").collect()}
    for r in QUERIES["op10_html"](spark, SF).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]], re.S)[1]
        inner = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1)>", "\0", inner.replace("<br>", " ")))
        blocks = [" ".join(html.unescape(b).split()) for b in inner.split("\0")]
        assert r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


LONG = "This is a sentence, with commas, that makes a paragraph worth some points. " * 3


def test_html_tree():
    page = f"""<html><body><header><h1>Site</h1></header><div class="menu"><a href=x>{LONG}</a></div>
      <div id=content><h2>Title &amp; more</h2><p>{LONG}<p>Second, <b>bold&nbsp;</b>text<span class="share-buttons">share</span> ends.
      <ul><li>one<li>two</ul><pre>a
      b</pre><div class="comments"><p>{LONG}</p></div><form>{LONG}</form></div>
      <div class="sidebar"><p>{LONG}</p></div><footer>{LONG}</footer></body></html>"""
    want = ["Title & more", LONG.strip(), "Second, bold text ends.", "one", "two", "a b"]
    assert html_text.main_text(page) == "\n\n".join(want)


def test_html_values_of_other_attributes_are_no_attributes():
    inner = "<p title='a hidden place'>One <a href=\"/hidden-gems\">two</a> <a href=/p?id=search>three</a></p><p data-note='hidden' data-class=ad>four</p>"
    gone = "<p hidden>x</p><p class=\"big ad\">x</p><p id=sidebar>x</p><p style='display:none'>x</p><p title=y aria-hidden=true>x</p>"
    assert html_text.main_text(f"<article><p>{LONG}</p>{inner}{gone}</article>").split("\n\n") == [LONG.strip(), "One two three", "four"]


def test_html_keeps_all_parts_beside_the_best():
    def got(body):
        return html_text.main_text(f"<html><body>{body}</body></html>").split("\n\n")

    long, links = f"<div><p>{LONG}<p>{LONG}</div>", "<ul><li><a href=x>Home</a><li><a href=y>News</a></ul>"
    both = [LONG.strip()] * 2
    assert got(f"{links}{long}<div><p>short closing paragraph</p></div><ul><li>a<li>b</ul>") == [*both, "short closing paragraph", "a", "b"]
    assert got(f"<h4>Head</h4>{long}loose<section><h5>Sub</h5><p>x</section><table><tr><td>1</table>{links}") == ["Head", *both, "loose", "Sub", "x", "1"]
    assert got(f"<div><h2>T</h2></div><div>{long}<div>in</div></div><div><div>other wrapper</div></div>") == ["T", *both, "in", "other wrapper"]


def test_html_marks_do_not_take_the_article():
    def got(body):
        return html_text.main_text(f"<html><body>{body}</body></html>").split("\n\n")

    one, both = f"<p>{LONG}</p>", [LONG.strip()] * 2
    for name in ('div class="page has-sidebar"', 'article class="post comments-open"', 'main class="no-header"', 'form id="aspnetForm"', 'div class="right-sidebar"'):
        assert got(f"<{name}>{one}{one}</{name.split()[0]}>") == both, name
    wrapper = '<div class="nav-wrap"><div id=content>{}</div><div class="sidebar"><p>Aside, {}</p></div></div>'
    assert got(wrapper.format(one + one, LONG)) == both
    assert got(f'<article>{one}<section id="discussion"><p>We discuss</p></section><p class="search-term">term</p></article>') == [LONG.strip(), "We discuss", "term"]
    assert got(f"<article><header><h1>Title</h1></header>{one}<footer>gone</footer></article>") == ["Title", LONG.strip()]
    assert got(f'<article>{one}</article><div class="comments"><article><p>{LONG * 9}</p></article></div>') == [LONG.strip()]
    assert got(f'<article>{one}</article><div id="discussion"><p>{LONG}</p></div>') == [LONG.strip()]
    assert got(f'{one}<form><p>{LONG}</p></form><div class="sidebar"><p>{LONG}</p></div>') == [LONG.strip()]
    assert got('<div class="ad">only an advert</div>') == [""]
    assert got(f'<pre>x <span class="comment">y</span></pre>{one}') == ["x y", LONG.strip()]


def test_html_body_and_articles():
    def got(body):
        return html_text.main_text(f"<html><body>{body}</body></html>").split("\n\n")

    menu = "<ul><li><a href=x>Home</a><li><a href=y>News</a></ul>"
    assert got(f"{menu}<p>{LONG}<p>short<ul><li>item</ul>") == [LONG.strip(), "short", "item"]
    assert got(f"<h1>T</h1><article><p>{LONG * 3}</article><article><p>brief</article><p>closing</p>{menu}") == ["T", (LONG * 3).strip(), "brief", "closing"]


def test_html_of_unclosed_tags_is_linear():
    import time

    for page in ("<b>" * 20000 + "x</i>" * 20000, "<b>" * 20000 + "<p>x" * 20000, "<h1>x" * 20000, "<b><div>" * 9000 + "x</b>" * 9000, "<dl>" + "<dt>x<pre>" * 9000):
        start = time.perf_counter()
        assert "x" in html_text.main_text(page)
        assert time.perf_counter() - start < 2


def test_html_awkward(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain text"), (4, "u", "<p>a<p"), (5, "u", "<script>x"), (6, "u", "<!-- "), (None, "u", "<b>1 < 2"), (7, "u", "<div>" * 3000 + "deep")]
    got = html_text.extract(spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string"))
    found = {r["page_id"]: r["text"] for r in got.collect()}
    assert found == {1: "", 2: "", 3: "plain text", 4: "a", 5: "", 6: "", None: "1 < 2", 7: "deep"}
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_registered_in_entry():
    import __spark_entry__ as entry

    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert json.dumps(sorted(entry.oracle_sql()))
