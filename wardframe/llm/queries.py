"""The operators of this package as queries over the given tables, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.llm import (
    bpe,
    digests,
    html_text,
    langid,
    licenses,
    minhash,
    prefix_trie,
    quality,
    separators,
    simhash,
    urls,
    variants,
    wumanber,
)
from wardframe.llm.texts import table

#: The free id after the ranks of the vocabulary closes a document in a token file.
END_ID = 50256
#: Words in a host that put it on the list of op9.
LISTED_WORDS = ("ads", "bets", "casino", "track", "pills", "porn")


def _vocabulary() -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def codec() -> bpe.Codec:
    return bpe.Codec(*_vocabulary())


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), codec())


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.deduplicate(table(spark, sf_dir, "documents"), digests.new_index(spark))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = separators.Tokenizer(*_vocabulary())
    return separators.document_token_counts(table(spark, sf_dir, "documents"), tokenizer, END_ID)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predicted = langid.predict_language(docs, langid.fit_language_network(docs))
    return predicted.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = wumanber.find_passages(docs, table(spark, sf_dir, "benchmark"))
    hit = wumanber.n_hit()
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        F.col("quality_evidence").alias("evidence"),
        F.col("quality_host_rate").alias("host_rate"),
        F.col("quality_path_rate").alias("path_rate"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality.REJECT_BELOW).alias("accepted"),
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def listed_hosts(pages: DataFrame) -> DataFrame:
    """Hosts (without ``www.`` or ``m.``) with one of LISTED_WORDS among the words of their name."""
    host = F.regexp_replace(urls.host_of(F.col("url")), r"\A(?:www|m)\.", "")
    listed = F.split(host, "[^a-z0-9]+")
    return pages.select(host.alias("key"), listed.alias("words")).where(
        F.arrays_overlap("words", F.array(*map(F.lit, LISTED_WORDS)))
    ).select("key")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, listed_hosts(pages)).drop("listed_key")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_language": op4_language,
    "op5_decontamination": op5_decontamination,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_licenses": op8_licenses,
    "op9_urls": op9_urls,
    "op10_html": op10_html,
    "op11_minhash": op11_minhash,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_variants": op13_variants,
}

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CODES = "list_transform(string_split({}, ''), lambda ch: unicode(ch)::BIGINT)"
_BYTES = (
    "flatten(list_transform(string_split({}, ''), lambda ch: "
    "CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [195::BIGINT, unicode(ch) - 64] END))"
)


def _crc32(codes: str) -> str:
    step = "lambda x, i: xor(x >> 1, 3988292384 * (x & 1))"
    return f"xor(4294967295, list_reduce({codes}, lambda c, b: list_reduce(range(8), {step}, xor(c, b)), 4294967295::BIGINT))"


_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": f"""
        WITH t AS (SELECT doc_id, sha256({_LOWER.format("text")}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op5_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("text")} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark),
        windows AS (
          SELECT DISTINCT item_id, least(10, len(w)) AS n,
                 array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS words
          FROM b, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS s(i) WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT n FROM windows),
        places AS (
          SELECT d.r, i, n, array_to_string(w[i : i + n - 1], ' ') AS words
          FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) AS s(i)),
        hits AS (SELECT p.r, p.i, p.n, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.words = x.words),
        hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM hits, unnest(generate_series(i, i + n - 1)) AS s(j) GROUP BY r),
        items AS (
          SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)""",
    "op9_urls": rf"""
        WITH p AS (
          SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3 :] ELSE '' END AS rest
          FROM pages),
        u AS (
          SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
        rules(rule_host, prefix, decision) AS (VALUES
          ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        fit AS (
          SELECT u.*, (SELECT arg_max({{'rule': rule_host || prefix, 'decision': decision}}, length(rule_host || prefix))
                       FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
                         AND starts_with(path, prefix)) AS found FROM u),
        bare AS (SELECT *, regexp_replace(host, '^(www|m)\.', '') AS name FROM fit),
        listed AS (
          SELECT DISTINCT name FROM bare
          WHERE list_has_any(regexp_split_to_array(name, '[^a-z0-9]+'), {list(LISTED_WORDS)!r}) AND name <> ''),
        parents AS (
          SELECT DISTINCT name, array_to_string(string_split(name, '.')[i:], '.') AS parent
          FROM bare, unnest(generate_series(1, greatest(1, len(string_split(name, '.')) - 1))) AS s(i)),
        bad AS (SELECT DISTINCT p.name FROM parents p JOIN listed l ON p.parent = l.name)
        SELECT page_id, host, path, found.rule AS rule,
               coalesce(found.decision, CASE WHEN bad.name IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
        FROM bare LEFT JOIN bad USING (name)""",
    "op12_prefix_trie": f"""
        WITH t AS (
          SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                   sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
          FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (SELECT c, c - c % 20 AS base, {_crc32(_CODES.format('c::VARCHAR'))} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
        own AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY p) AS turns FROM t GROUP BY c),
        made AS (
          SELECT ids.c, list_concat(coalesce(b.turns, [])[:h], own.turns[h + 1:]) AS turns
          FROM ids JOIN own USING (c) LEFT JOIN own b ON b.c = ids.base),
        placed AS (SELECT c, d, turns[:d] AS path, len(turns) AS size FROM made, unnest(generate_series(0, len(turns))) AS s(d)),
        nodes AS (
          SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, path[d].text AS last,
                 coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = d), '') AS ends
          FROM placed GROUP BY path, d),
        linked AS (
          SELECT n.*, o.conv_id AS parent_conv_id,
                 (n.n_convs - 1) * coalesce(len(regexp_extract_all(n.last, '[^\\x20\\x09-\\x0D]+')), 0) AS saved
          FROM nodes n LEFT JOIN nodes o ON n.d = o.d + 1 AND n.path[:n.d - 1] = o.path),
        counts AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY ALL),
        whole AS (SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN counts USING (conv_id, d)),
        sums AS (
          SELECT a.conv_id, a.d, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens
          FROM whole a JOIN placed q ON q.c = a.conv_id AND q.d = a.d
          JOIN whole b ON b.d >= a.d AND b.path[:a.d] = a.path GROUP BY ALL)
        SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
        FROM whole JOIN sums USING (conv_id, d)""",
    "op13_variants": f"""
        WITH RECURSIVE runs AS (
          SELECT coalesce(doc_id::VARCHAR, '') || ':' AS id, unnest(regexp_extract_all({_LOWER.format("text")}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
        seen AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
        hashed AS (SELECT run, n, {_crc32(_BYTES.format('id || run'))} AS h FROM seen),
        spelt AS (
          SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        cuts AS (
          SELECT word, n, i, left(word, i - 1) AS head, substr(word, i + 1) AS tail
          FROM words, unnest(generate_series(1, length(word))) AS s(i)),
        near AS (
          SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b USING (i, head, tail) WHERE a.word <> b.word
          UNION SELECT c.word, c.n, w.word, w.n FROM cuts c JOIN words w ON c.head || c.tail = w.word
          UNION SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN words w ON c.head || c.tail = w.word),
        best AS (
          SELECT word, n, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM near GROUP BY word, n),
        judged AS (
          SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
                 CASE WHEN form_n >= 5 * words.n THEN form END AS form, CASE WHEN form_n >= 5 * words.n THEN form_n END AS form_n
          FROM words LEFT JOIN best USING (word)),
        chain(word, root) AS (
          SELECT word, word FROM words
          UNION ALL SELECT c.word, j.form FROM chain c JOIN judged j ON j.word = c.root WHERE j.form IS NOT NULL)
        SELECT word, form, root, n, n_near, form_n
        FROM judged JOIN (SELECT chain.word, chain.root FROM chain JOIN judged j ON j.word = chain.root WHERE j.form IS NULL) USING (word)""",
}
