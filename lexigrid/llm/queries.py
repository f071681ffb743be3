"""The queries of the operators, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm import (
    imatch, jaccard_join, language, packing, pii, prefix_trie, quality_rules, secret_scan, unigram, url_filter, warc, whitening,
)
from lexigrid.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies; a parameter of the operators that read one."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All secret spans of every document: fixed patterns and zstandard novelty."""
    rows = secret_scan.secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return rows.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
        count("novel").alias("n_novel"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = language.predict(F.col("text"), spark, language.fit_documents(docs))
    return docs.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), found.alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score", "p.ambiguous", "p.second"
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut and packed into sequences of 1,024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


#: The rules of the URL query, and domains of the filter's own list.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
LISTED = [
    f"{name}.example.{top}/"
    for name in ("spam-farm", "casino-win", "free-bets", "ads-track", "cheap-pills", "adult-x")
    for top in ("com", "net", "org")
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, LISTED)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces and the score of the best segmentation of every document."""
    return unigram.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document, the base verdict and that of the production policy."""
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.keeps(F.col("failed"), "base")).alias("base_failed"),
        quality_rules.keeps(F.col("failed")).alias("kept"),
        F.col("failed").cast("long").alias("failed_rules"),
    )


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness."""
    return imatch.edited(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        imatch.fingerprint(F.col("slots")).alias("fingerprint"),
        imatch.fingerprint(F.col("edited_slots")).alias("edited_fingerprint"),
        imatch.likeness(F.col("slots"), F.col("edited_slots")).alias("near_edited"),
        imatch.likeness(F.col("slots"), F.col("next_slots")).alias("near_next"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back."""
    manifest = warc.write(warc.typed(table(spark, sf_dir, "pages")))
    return warc.records(warc.read(manifest)).withColumnRenamed("key", "page_id")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document and the number of its links."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document, and the digest of the text that they decode to."""
    model = tokenizer_file("piece_bpe_32k.model")
    ids = unigram.encode(table(spark, sf_dir, "documents"), model)
    return unigram.decode(ids, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", F.sha2("text", 256).alias("decoded_sha256")
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All spans of personal data of every document: fixed patterns, and candidates by weak supervision."""
    rows = pii.personal(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("key").alias("doc_id"),
        *[F.size(f"base.{k}").cast("long").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.listed(pii.BASE), 256).alias("base_sha256"),
        pii.listed(pii.KINDS).alias("spans"),
        F.size("found").cast("long").alias("n_found"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened coordinates of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("key", "vec_id")


def queries() -> dict[str, Query]:
    own = (
        op1_secret_scan, op2_language_id, op3_packing, op4_url_filter, op5_token_counts, op6_quality_rules, op7_imatch,
        op8_warc, op9_jaccard_join, op10_sentencepiece, op11_prefix_trie, op12_pii,
        op13_whitening,
    )
    return {f.__name__: f for f in own}


QUALITY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), places AS (
  SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5
), windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, list_slice(ws, i, i + 4)) AS n FROM places
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest(range(i, i + 5)) AS p FROM windows WHERE n > 1
  ) GROUP BY rid
), m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(list_aggregate(ws, 'string_agg', '')) AS BIGINT) AS c,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutter
  FROM w LEFT JOIN covered USING (rid)
), l AS (
  SELECT doc_id, n_words, coalesce(c, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
    CAST(n_words < 10 AS INT) AS b0, CAST(100 * n_repeat_words > 20 * n_words AS INT) AS b1,
    CAST(10 * n_symbols > n_words AS INT) AS b2, CAST(100 * n_dup_lines > 40 * n_lines AS INT) AS b3,
    CAST(100 * n_stutter > 30 * n_words AS INT) AS b4, CAST(coalesce(c, 0) > 20 * n_words AS INT) AS b5,
    CAST(coalesce(c, 0) < 2 * n_words AS INT) AS b6
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  b0 + b1 > 0 AS base_failed, b0 + b1 + b2 + b3 + b4 + b5 + b6 = 0 AS kept,
  CAST(b0 + 2 * b1 + 4 * b2 + 8 * b3 + 16 * b4 + 32 * b5 + 64 * b6 AS BIGINT) AS failed_rules
FROM l
"""


_RULES = ", ".join(f"('{r}', '{v}')" for r, v in URL_RULES)
_LISTED = ", ".join(f"('{r}')" for r in LISTED)
_FITS = "(host = r_host OR suffix(host, '.' || r_host)) AND starts_with(path, r_path)"
URL_SQL = f"""
WITH rest AS (
  SELECT row_number() OVER () AS rid, page_id,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), p AS (
  SELECT rid, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM rest
), rules AS (
  SELECT rule, verdict, split_part(rule, '/', 1) AS r_host, substr(rule, strpos(rule, '/')) AS r_path
  FROM (VALUES {_RULES}) AS v(rule, verdict)
), listed AS (
  SELECT split_part(rule, '/', 1) AS r_host, substr(rule, strpos(rule, '/')) AS r_path FROM (VALUES {_LISTED}) AS v(rule)
), won AS (
  SELECT rid, rule, verdict FROM p, rules WHERE {_FITS}
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC, length(r_host) DESC) = 1
), bad AS (
  SELECT DISTINCT rid FROM p, listed WHERE {_FITS}
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bad.rid IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN won USING (rid) LEFT JOIN bad ON bad.rid = p.rid
"""

WARC_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (
  SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to, true AS intact
FROM p LEFT JOIN f USING (d)
"""


TRIE_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, turn, length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS x,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT c, list({'x': sha256(x), 'w': w} ORDER BY turn NULLS FIRST, sha256(x)) AS s FROM t GROUP BY c
), crc AS (
  SELECT c, s, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    range(1, length(c::VARCHAR) + 1), lambda i: list_prepend(unicode(substr(c::VARCHAR, i, 1))::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) % 4 AS h
  FROM o
), r AS (
  SELECT a.c, list_concat(coalesce(l.s, [])[1:a.h], a.s[a.h + 1:]) AS s FROM crc a LEFT JOIN o l ON l.c = a.c - a.c % 20
), p AS (
  SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM r
), n AS (
  SELECT d, sha256(array_to_string(list_transform(s[1:d], lambda e: e.x), '')) AS k, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(any_value(CASE WHEN d > 0 THEN s[d].w END), 0) AS w,
    any_value(list_transform(range(0, d + 1), lambda j: sha256(array_to_string(list_transform(s[1:j], lambda e: e.x), '')))) AS up,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(s) = d), '')) AS ends_sha256
  FROM p GROUP BY d, k
), below AS (
  SELECT k, d, unnest(up[1:d]) AS a, unnest(range(0, d)) AS ad FROM n
), kids AS (
  SELECT a AS k, count(*) AS n_children FROM below WHERE ad = d - 1 GROUP BY a
), sub AS (
  SELECT a AS k, count(*) FILTER (leaf) AS n_leaves, sum((n_convs - 1) * w) AS saved FROM (
    SELECT unnest(n.up) AS a, n_convs, w, kids.k IS NULL AS leaf FROM n LEFT JOIN kids ON kids.k = n.k) GROUP BY a
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) AS n_children,
  sub.n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n LEFT JOIN n u ON n.d > 0 AND u.k = n.up[n.d] LEFT JOIN kids ON kids.k = n.k JOIN sub ON sub.k = n.k
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_url_filter": URL_SQL, "op6_quality_rules": QUALITY_SQL, "op8_warc": WARC_SQL, "op11_prefix_trie": TRIE_SQL,
    }
