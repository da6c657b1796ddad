"""MinHash near-dedup, the prefix trie and spelling variants against brute force and on awkward rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.test_operators import AWKWARD, awkward, nothing, ordered  # noqa: F401
from wardframe.llm import minhash, prefix_trie, texts, variants

SF = "/root/testdata/sf0.001"


# --- MinHash --------------------------------------------------------------------------------


def _sets(rows):
    found = []
    for _, text in rows:
        ws = (text or "").encode().lower().split()
        parts = {tuple(ws[i : i + 4]) for i in range(len(ws) - 3)}
        found.append(parts or ({tuple(ws)} if ws else set()))
    return found


def _brute_near(rows):
    sets = _sets(rows)
    top = list(range(len(rows)))
    pairs = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if top[a] != top[b]:
                top[a] = top[b] = min(top[a], top[b])
                changed = True
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[top[i]].append(key)
    names = [min(least[t]) if least[t] else None for t in top]
    return [(key, len(sets[i]), names[i], key == names[i]) for i, (key, _) in enumerate(rows)], len(pairs)


def _random_words(random, n):
    return ["".join(map(chr, random.integers(97, 123, 6))) for _ in range(n)]


def _groups():
    """Groups of copies near the threshold, chains, texts with one passage in common, short texts."""
    random = np.random.default_rng(3)
    vocabulary = np.array(_random_words(random, 3000))
    text = lambda n: list(random.choice(vocabulary, n))
    passage, rows = text(60), []
    for size, changes in [(60, 3), (40, 3), (25, 4), *[(2, c % 6) for c in range(40)]]:
        original = text(int(random.integers(180, 300)))
        for _ in range(size):
            copy = list(original)
            for at in random.choice(len(copy), changes, replace=False):
                copy[at] = str(random.choice(vocabulary))
            rows.append(" ".join(copy))
    chain = text(100)
    for _ in range(12):
        chain = chain[4:] + text(4)
        rows.append(" ".join(chain))
    rows += [" ".join(text(int(random.integers(5, 40))) + passage) for _ in range(60)]
    rows += [" ".join(text(k)) for k in range(8) for _ in range(2)] + ["a b", "A  b", "a b c d e f", "a b c d e f g"]
    return [(i + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("small", [False, True])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, small):
    """Small blocks and stars cut every bucket and every hub's members."""
    if small:
        monkeypatch.setattr(minhash, "BLOCK", 7)
        monkeypatch.setattr(minhash, "STAR", 5)
        monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 600)
    rows = _groups()
    want, pairs = _brute_near(rows)
    assert pairs > 300 and len({w[2] for w in want}) < len(rows) - 100
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert ordered(minhash.near_duplicates(df).collect()) == ordered(want)


def test_near_duplicates_awkward(spark, awkward, nothing):  # noqa: F811
    assert ordered(minhash.near_duplicates(awkward).collect()) == ordered(_brute_near(AWKWARD)[0])
    assert minhash.near_duplicates(nothing).count() == 0


def test_near_duplicates_of_the_table(spark):
    docs = texts.table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert ordered(minhash.near_duplicates(docs).collect()) == ordered(_brute_near(rows)[0])


def test_signatures_estimate_similarity():
    """Bins agree as often as the similarity says, whether they are many or few for the set."""
    random = np.random.default_rng(1)
    for size in (4, 20, 100, 2000):
        agreed = []
        for _ in range(60):
            every = np.unique(random.integers(0, 1 << 63, size + size // 4, dtype=np.uint64) * np.uint64(2))
            a, b = every[random.permutation(len(every))], every
            a = np.sort(a[:size])
            agreed.append((minhash.signature(a) == minhash.signature(b)).mean())
        assert abs(np.mean(agreed) - size / len(every)) < 0.03


def test_sets_do_not_depend_on_the_parts_read(monkeypatch):
    random = np.random.default_rng(6)
    data = " ".join(random.choice(_random_words(random, 50), 3000)).encode()
    whole = minhash.shingle_set(data)
    monkeypatch.setattr(texts, "PIECE_BYTES", 64)
    monkeypatch.setattr(minhash, "SET_PART", 40)
    assert whole.tobytes() == minhash.shingle_set(data).tobytes()
    assert len(whole) == len(_sets([(1, data.decode())])[0])


def test_candidates_follow_documents_not_pairs(spark, monkeypatch):
    """Rows between the steps of one group grow with the group, not with its square."""
    random = np.random.default_rng(9)
    vocabulary = np.array(_random_words(random, 3000))
    original, rows = list(random.choice(vocabulary, 100)), {}
    copies = []
    for _ in range(400):
        copy = list(original)
        for at in random.choice(100, 4, replace=False):
            copy[at] = str(random.choice(vocabulary))
        copies.append(" ".join(copy))
    materialize = minhash.materialize

    def counted(df, label="table"):
        table = materialize(df, label)
        rows.setdefault(label, []).append(table.count())
        return table

    monkeypatch.setattr(minhash, "materialize", counted)
    for n in (200, 400):
        minhash.near_duplicates(spark.createDataFrame(list(enumerate(copies[:n])), "doc_id long, text string"))
    assert all(max(n[1:], default=n[0]) <= 2.6 * n[0] + 50 for n in rows.values())


# --- the prefix trie ------------------------------------------------------------------------


def _brute_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[c].append(((turn is not None, turn or 0), digest, (role, text)))
    turns = {c: [x[2] for x in sorted(v)] for c, v in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = turns.get(c - int(np.fmod(c, 20)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, t in made.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    out = []
    for path, of in members.items():
        below = [p for p in members if p[: len(path)] == path]
        childless = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1] if p else "")) for p in below)
        ends = ",".join(str(c) for c in sorted(of) if len(made[c]) == len(path))
        children = sum(len(p) == len(path) + 1 for p in below)
        parent = min(members[path[:-1]]) if path else None
        out.append((min(of), len(path), parent, len(of), children, len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def _conversations():
    random = np.random.default_rng(12)
    rows = []
    for c in [*range(70), 200, 201, 999, -3, -41]:
        for turn in range(int(random.integers(0, 7)) + (c in (0, 20))):
            text = "  common\tturn of all " if turn == 0 and c % 3 else f"turn {random.integers(0, 3)} of it"
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", text))
    rows += [(7, None, None, "first"), (7, 1, "user", None), (7, 1, "user", None), (None, 0, "user", "lost"), (8, 2, "", ""), (8, 2, "a", "")]
    return rows


@pytest.mark.parametrize("levels,shards,held", [(4096, None, 200_000), (2, 64, 3), (3, 17, 1), (4096, 1, 2)])
def test_trie_equals_brute_force(spark, monkeypatch, levels, shards, held):
    """Few levels a shard, many shards and a queue that spills at once give the same sums."""
    monkeypatch.setattr(prefix_trie, "LEVELS", levels)
    monkeypatch.setattr(prefix_trie.SpillingQueue.__init__, "__defaults__", (held,))
    monkeypatch.setattr(prefix_trie, "CHUNK", 5 if held < 100 else 1 << 20)
    rows = _conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 AS depth", "'x' AS n_convs", "text AS side").repartition(3)
    assert ordered(prefix_trie.prefix_trie(df, shards).collect()) == ordered(_brute_trie(rows))
    assert prefix_trie.prefix_trie(df.where("false"), shards).count() == 0


def test_long_conversation_lies_in_many_tasks(spark):
    rows = [(40, t, "user", f"w {t % 7}") for t in range(9000)] + [(41, t, "user", f"w {t % 7}") for t in range(5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r["conv_id"], r["depth"]): r for r in prefix_trie.prefix_trie(df).collect()}
    head = zlib.crc32(b"41") % 4
    assert len(found) == 9001 and found[40, 0]["n_convs"] == 2
    assert found[40, 0]["saved_tokens"] == 2 * 5000 and found[40, 5000]["saved_tokens"] == 2
    assert found[40, 0]["n_leaves"] == 1 and found[40, 9000]["n_children"] == 0
    assert head < 4 and found[40, 5000]["ends_sha256"] == hashlib.sha256(b"41").hexdigest()


def test_queue_gives_messages_by_key():
    random = np.random.default_rng(2)
    keys = [tuple(map(int, k)) for k in random.integers(0, 6, (500, 3))]
    for held in (1, 7, 1000):
        queue, sums = prefix_trie.SpillingQueue(held), Counter()
        for i, key in enumerate(keys):
            queue.put(key, (i,))
        for key in sorted(set(keys), reverse=True):
            sums[key] = sum(m[0] for m in queue.take(key))
        assert sums == Counter({k: sum(i for i, x in enumerate(keys) if x == k) for k in set(keys)})


# --- spelling variants ----------------------------------------------------------------------


def _brute_variants(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.encode().lower().decode()
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    known = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    others = {w: [x for x in known if near(w, x)] for w in known}
    form = {}
    for w, n in known.items():
        best = min(others[w], key=lambda x: (-known[x], x), default=None)
        form[w] = best if best and known[best] >= 5 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return [(w, form[w], root(w), n, len(others[w]), known.get(form[w])) for w, n in known.items()]


def _spelt():
    random = np.random.default_rng(21)
    letters = list("abeé÷ÿÀ")
    words = []
    for _ in range(25):
        word = "".join(random.choice(letters, int(random.integers(6, 12))))
        for times in (900, 150, 25, 5):
            words += [word] * times
            at = int(random.integers(0, len(word)))
            word = word[:at] + str(random.choice(["", *letters])) + word[at + int(random.integers(0, 2)) :]
    words += ["aaaaaaa"] * 60 + ["aaaaaaaa"] * 9 + ["AAAAAAaaB"] * 5 + ["q" * 90] * 40 + ["q" * 91] * 6 + ["q" * 50 + "r" + "q" * 39] * 5
    words = [str(w) for w in random.permutation(words)]
    rows = [(i, " ".join(words[i * 40 : i * 40 + 40])) for i in range(-(-len(words) // 40))]
    return rows + [(None, "aaaaaaa aaaaaaab"), (3, None), (4, ""), (5, "123 _ × 漢字aaaaaaa漢")]


@pytest.mark.parametrize("blocks,held", [(4 << 20, 200_000), (3, 2)])
def test_variants_equal_brute_force(spark, monkeypatch, blocks, held):
    """A few blocks of filters at a time need many passes; results stay the same."""
    monkeypatch.setattr(variants, "MOST_BLOCKS", blocks)
    monkeypatch.setattr(variants, "HELD_WORDS", held)
    monkeypatch.setattr(variants, "HELD_EDITS", held * 10)
    monkeypatch.setattr(variants, "WORD_BITS", 32 if held > 2 else 3)
    rows = _spelt()
    want = _brute_variants(rows)
    assert sum(w[1] is not None for w in want) > 30 and any(w[2] not in (w[0], w[1]) for w in want)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, word string").repartition(3)
    assert ordered(variants.spelling_variants(df).collect()) == ordered(want)


def test_filters_spare_the_shuffle(spark):
    """Few edits that are no words pass the filters."""
    random = np.random.default_rng(4)
    words = spark.createDataFrame([(w, 5) for w in set(_random_words(random, 3000))], "word string, n long")
    layout, alphabet = variants._layout(words), variants._alphabet(words)
    part = variants._filter_part(spark, variants._blocks(words, layout), 0, layout.total)
    passed = variants.candidates(words, layout, alphabet, part, 0).count()
    assert passed < 0.005 * 3000 * 6 * 13


def test_variants_awkward(spark, awkward, nothing):  # noqa: F811
    assert ordered(variants.spelling_variants(awkward).collect()) == ordered(_brute_variants(AWKWARD))
    assert variants.spelling_variants(nothing).count() == 0
