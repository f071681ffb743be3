"""SQL counterparts of the registered queries, written for DuckDB.

They work on token lists and plain joins and share no code with the Spark side,
except for the stop-word list and the query workload, which are data.
"""

from __future__ import annotations

from lexigrid.functions.text import STOP_WORDS
from lexigrid.plans.fixtures import WORKLOAD


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _toks(text: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(regexp_replace(lower({text}), '[^a-z\\s]', '', 'g'), '\\s+'), "
        f"lambda w: w <> '' AND w NOT IN ({_quoted(STOP_WORDS)}))"
    )


def _base() -> str:
    return f"""
WITH tok AS (SELECT doc_id, {_toks('text')} AS toks FROM documents),
occ AS (SELECT doc_id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM tok),
post AS (SELECT term, doc_id, count(*) AS tf, list(pos ORDER BY pos) AS positions FROM occ GROUP BY term, doc_id),
freq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
n AS (SELECT count(*) AS total FROM documents),
qtok AS (SELECT item_id AS query_id, {_toks('text')} AS toks FROM benchmark),
qterm AS (SELECT DISTINCT query_id, term FROM (SELECT query_id, unnest(toks) AS term FROM qtok))
"""


def _porter(source: str) -> str:
    """Stems of ``source(token)`` as successive CASE steps: table ``stems(token, term)``."""
    c, v = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
    m0, m1 = f"^({c})?{v}{c}", f"^({c})?{v}{c}{v}{c}"
    m_one = f"^({c})?{v}{c}({v})?$"
    vowel, short = f"^({c})?[aeiouy]", f"^{c}[aeiouy][^aeiouwxy]$"

    def has(x: str, pattern: str) -> str:
        return f"regexp_matches({x}, '{pattern}')"

    def suffixes(table: list[tuple[str, str]], condition: str) -> str:
        """One branch per suffix, longest first; the first that fits decides."""
        out = []
        for end, new in sorted(table, key=lambda p: -len(p[0])):
            stem = f"w[:-{len(end) + 1}]"
            cond = condition.replace("STEM", stem)
            if end == "ion":
                cond += f" AND {has(stem, '[st]$')}"
            out.append(f"WHEN suffix(w, '{end}') THEN CASE WHEN {cond} THEN {stem} || '{new}' ELSE w END")
        return "CASE " + " ".join(out) + " ELSE w END"

    two = [
        ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
        ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
        ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
        ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ]
    three = [
        ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
    ]
    four = [
        (e, "")
        for e in "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()
    ]
    first = (
        "CASE WHEN suffix(w, 'sses') THEN w[:-3] WHEN suffix(w, 'ies') THEN w[:-3] "
        "WHEN suffix(w, 'ss') THEN w WHEN suffix(w, 's') THEN w[:-2] ELSE w END"
    )
    cut = (
        f"CASE WHEN suffix(w, 'eed') THEN CASE WHEN {has('w[:-4]', m0)} THEN w[:-2] ELSE w END "
        f"WHEN suffix(w, 'ed') AND {has('w[:-3]', vowel)} THEN w[:-3] || '+' "
        f"WHEN suffix(w, 'ing') AND {has('w[:-4]', vowel)} THEN w[:-4] || '+' ELSE w END"
    )
    doubled = " OR ".join(f"suffix(b, '{x}{x}')" for x in "bcdfghjkmnpqrtvwxy")
    repair = (
        "CASE WHEN NOT suffix(w, '+') THEN w "
        "WHEN suffix(b, 'at') OR suffix(b, 'bl') OR suffix(b, 'iz') THEN b || 'e' "
        f"WHEN {doubled} THEN b[:-2] WHEN {has('b', short)} THEN b || 'e' ELSE b END"
    )
    final_y = f"CASE WHEN suffix(w, 'y') AND {has('w[:-2]', vowel)} THEN w[:-2] || 'i' ELSE w END"
    final_e = (
        f"CASE WHEN suffix(w, 'e') AND ({has('w[:-2]', m1)} OR ({has('w[:-2]', m_one)} "
        f"AND NOT {has('w[:-2]', short)})) THEN w[:-2] ELSE w END"
    )
    final_l = f"CASE WHEN suffix(w, 'll') AND {has('w', m1)} THEN w[:-2] ELSE w END"
    return f"""
p1 AS (SELECT token, {first} AS w FROM (SELECT token, token AS w FROM ({source}))),
p2 AS (SELECT token, {cut} AS w FROM p1),
p3 AS (SELECT token, {repair} AS w FROM (SELECT token, w, rtrim(w, '+') AS b FROM p2)),
p4 AS (SELECT token, {final_y} AS w FROM p3),
p5 AS (SELECT token, {suffixes(two, has('STEM', m0))} AS w FROM p4),
p6 AS (SELECT token, {suffixes(three, has('STEM', m0))} AS w FROM p5),
p7 AS (SELECT token, {suffixes(four, has('STEM', m1))} AS w FROM p6),
p8 AS (SELECT token, {final_e} AS w FROM p7),
p9 AS (SELECT token, {final_l} AS w FROM p8),
stems AS (SELECT token, CASE WHEN length(token) <= 2 THEN token ELSE w END AS term FROM p9)
"""


def _docs(term: str) -> str:
    return f"SELECT doc_id FROM post WHERE term = '{term}'"


def _phrase_test(words: list[str], mode: str, toks: str = "toks") -> str:
    """A predicate on a token list for a phrase of given words."""
    if mode == "strict":
        return f"contains(' ' || array_to_string({toks}, ' ') || ' ', ' {' '.join(words)} ')"
    at = lambda i: f"list_filter(range(1, len({toks}) + 1), lambda p: {toks}[p] = '{words[0]}' AND {toks}[p + {i}] = '{words[i]}')"
    return " AND ".join(f"len({at(i)}) > 0" for i in range(1, len(words)))


def _literal(text: str) -> str:
    """Documents for one literal of a Boolean query."""
    words = [w for w in text.split() if w not in STOP_WORDS]
    if not words:
        return "SELECT doc_id FROM tok WHERE false"
    if len(words) == 1 or " " not in text.strip():
        return f"SELECT doc_id FROM tok WHERE list_contains(toks, '{words[0]}')"
    return f"SELECT doc_id FROM tok WHERE {_phrase_test(words, 'pairwise')}"


def _bool_batch() -> str:
    selects = []
    for q, (clauses, _) in WORKLOAD.items():
        for clause in clauses:
            parts = ["SELECT doc_id FROM documents"]
            for literal in clause:
                op = "EXCEPT" if literal.startswith("-") else "INTERSECT"
                parts.append(f"{op} ({_literal(literal.lstrip('-'))})")
            body = "(" * (len(parts) - 1) + parts[0] + "".join(" " + p + ")" for p in parts[1:])
            selects.append(f"SELECT '{q}' AS query_id, doc_id FROM ({body})")
    return _base() + " UNION ".join(selects)


def _ranked(terms: str, weight: str, k: int = 10, post: str = "post", freq: str = "freq") -> str:
    """Top k per query for ``terms(query_id, term)``."""
    return f"""
SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
    SELECT t.query_id, p.doc_id, round(sum(p.tf * {weight}), 6) AS score
    FROM ({terms}) t JOIN {post} p ON p.term = t.term JOIN {freq} f ON f.term = t.term CROSS JOIN n
    GROUP BY t.query_id, p.doc_id) WHERE score > 0) WHERE rank <= {k}"""


_TFIDF = "log10(n.total / f.df)"
_JOINED = "array_to_string(positions, ' ') AS positions"


def _workload_terms() -> str:
    rows = [
        f"('{q}', '{w}')"
        for q, (_, text) in WORKLOAD.items()
        for w in sorted({w for w in text.split() if w not in STOP_WORDS})
    ]
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS v(query_id, term)"


def _single(text: str, weight: str) -> str:
    words = ", ".join(f"('{w}')" for w in sorted(set(text.split())))
    terms = f"SELECT 0 AS query_id, term FROM (VALUES {words}) AS v(term)"
    return f"SELECT doc_id, score, rank FROM ({_ranked(terms, weight)})"


def _stemmed_base(source: str) -> str:
    return f"""{_base()}, {_porter(source)},
spost AS (SELECT s.term, o.doc_id, count(*) AS tf, list(o.pos ORDER BY o.pos) AS positions
          FROM occ o JOIN stems s ON s.token = o.term GROUP BY s.term, o.doc_id),
sfreq AS (SELECT term, count(*) AS df FROM spost GROUP BY term)"""


_VOCAB = "SELECT DISTINCT term AS token FROM occ"
_ALL_VOCAB = "SELECT term AS token FROM occ UNION SELECT term FROM qterm"

_RUN_LOG = """
cfg AS (SELECT *,
  ['positional', 'tf', 'tfidf'][user_id % 3 + 1] AS indexing_stage,
  ['pickle', 'postgres'][user_id // 3 % 2 + 1] AS datastore,
  ['none', 'zlib'][user_id // 6 % 2 + 1] AS compression,
  ['none', 'skip_pointers'][user_id // 12 % 2 + 1] AS optimization,
  ['taat', 'daat'][user_id // 24 % 2 + 1] AS query_processing FROM events),
runs AS (SELECT indexing_stage, datastore, compression, optimization, query_processing,
  avg(value) AS avg, quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99,
  CASE WHEN max(ts) > min(ts) THEN count(*) / (epoch_us(max(ts)) - epoch_us(min(ts))) * 1e6 ELSE 0 END AS throughput,
  CAST(sum(length(props)) AS DOUBLE) AS size FROM cfg GROUP BY ALL)"""

_CONFIG = "indexing_stage, datastore, compression, optimization, query_processing"
_RUN_ROWS = f"""WITH {_RUN_LOG} SELECT {_CONFIG}, round(avg, 6) AS avg, round(p95, 6) AS p95,
  round(p99, 6) AS p99, round(throughput, 6) AS throughput, size FROM runs"""

_LABEL = """CASE WHEN b >= 1073741824 THEN CAST(CAST(round(b / 1073741824, 2) AS DECIMAL(20,2)) AS VARCHAR) || ' GB'
 WHEN b >= 1048576 THEN CAST(CAST(round(b / 1048576, 2) AS DECIMAL(20,2)) AS VARCHAR) || ' MB'
 WHEN b >= 1024 THEN CAST(CAST(round(b / 1024, 2) AS DECIMAL(20,2)) AS VARCHAR) || ' KB'
 ELSE CAST(b AS VARCHAR) || ' Bytes' END"""


def sql() -> dict[str, str]:
    base = _base()
    merged = f"""{base}, ball AS (
  SELECT term, doc_id, tf, positions, doc_id // 500 AS block FROM post UNION ALL
  SELECT term, query_id, count(*), list(pos ORDER BY pos), 1000000000 FROM (
    SELECT query_id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM qtok) GROUP BY term, query_id),
mrg AS (SELECT * FROM ball QUALIFY row_number() OVER (PARTITION BY term, doc_id ORDER BY block DESC) = 1)"""
    porter = _stemmed_base(_ALL_VOCAB)
    tf_rows = f"SELECT term, doc_id, CAST(tf AS INTEGER) AS tf, {_JOINED} FROM "
    mrg_stems = f"""{merged}, {_porter("SELECT DISTINCT term AS token FROM mrg")},
mocc AS (SELECT term, doc_id, unnest(positions) AS pos FROM mrg),
mspost AS (SELECT s.term, o.doc_id, count(*) AS tf, list(o.pos ORDER BY o.pos) AS positions
          FROM mocc o JOIN stems s ON s.token = o.term GROUP BY s.term, o.doc_id)"""
    echo = f"""{base}, echo AS (SELECT doc_id AS query_id, [toks[1], toks[2], toks[1]] AS toks FROM tok
  WHERE doc_id % 50 = 0 AND len(toks) > 1)"""
    streamed = f"""{base}, sall AS (SELECT term, doc_id, tf, positions FROM post UNION ALL
  SELECT term, -query_id - 1, count(*), list(pos ORDER BY pos) FROM (
    SELECT query_id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM qtok) GROUP BY term, query_id)"""
    levels = f"""{base}, lpost AS (SELECT term, doc_id, tf, positions FROM post WHERE doc_id NOT IN (SELECT item_id FROM benchmark)
  UNION ALL SELECT term, id, count(*), list(pos ORDER BY pos) FROM (
    SELECT unnest([query_id, -query_id - 1]) AS id, term, pos FROM (
      SELECT query_id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM qtok)) GROUP BY term, id),
lfreq AS (SELECT term, count(*) AS df FROM lpost GROUP BY term),
ln AS (SELECT count(*) AS total FROM (SELECT doc_id FROM documents UNION SELECT unnest([item_id, -item_id - 1]) FROM benchmark))"""
    passage = "' ' || array_to_string(q.toks, ' ') || ' '"
    return {
        "analyze_tokens": f"{base} SELECT doc_id, CAST(pos AS INTEGER) AS pos, term FROM occ",
        "positional_postings": f"{base} SELECT term, doc_id, {_JOINED} FROM post",
        "tf_postings": f"{base} {tf_rows} post",
        "document_frequency": f"{base} SELECT term, df FROM freq",
        "corpus_stats": f"{base} SELECT (SELECT count(*) FROM documents) AS total_docs, "
        "(SELECT count(DISTINCT doc_id) FROM post) AS indexed_docs",
        "term_dictionary": f"{base} SELECT row_number() OVER (ORDER BY term) AS term_id, term, df FROM freq",
        "term_dictionary_append": f"""{base} SELECT (SELECT count(*) FROM freq) + row_number() OVER (ORDER BY term)
  AS term_id, term FROM (SELECT DISTINCT term FROM qterm WHERE term NOT IN (SELECT term FROM freq))""",
        "tfidf_index": f"""{base} SELECT p.term, p.doc_id, CAST(p.tf AS INTEGER) AS tf, f.df,
  round(log10(n.total / f.df), 6) AS idf FROM post p JOIN freq f ON p.term = f.term CROSS JOIN n""",
        "merge_blocks": f"{merged} {tf_rows} mrg",
        "merge_blocks_to_tables": f"""{merged}, dict AS (SELECT term AS word, row_number() OVER (ORDER BY term) AS term_id
  FROM (SELECT DISTINCT term FROM mrg))
SELECT term_id, doc_id, CAST(tf AS INTEGER) AS tf, {_JOINED} FROM mrg JOIN dict ON word = term""",
        "index_load": f"""{base}, ids AS (SELECT term, df, row_number() OVER (ORDER BY term) AS term_id FROM freq)
SELECT f.term_id, p.term, p.doc_id, CAST(p.tf AS INTEGER) AS tf, f.df FROM post p JOIN ids f ON p.term = f.term""",
        "rejected_rows": """SELECT doc_id, 'null text' AS reason FROM documents
  WHERE doc_id NOT IN (SELECT item_id FROM benchmark)""",
        "index_violations": f"""{base} SELECT 'duplicate posting' AS violation, p.term, p.doc_id FROM post p
  JOIN qterm q ON q.query_id = p.doc_id AND q.term = p.term
UNION ALL SELECT DISTINCT 'posting without term', term, CAST(NULL AS BIGINT) FROM qterm
  WHERE term NOT IN (SELECT term FROM freq)""",
        "rejected_postings": f"""{base} SELECT term, doc_id,
  CASE WHEN length(term) = 2 THEN 'null positions' ELSE 'tf differs from positions' END AS reason
FROM post WHERE length(term) = 2 OR tf = 3""",
        "merge_blocks_porter": f"{mrg_stems} {tf_rows} mspost",
        "index_stats": f"""{merged}
SELECT 'one shot' AS build, (SELECT count(*) FROM documents) AS total_docs,
  (SELECT count(DISTINCT doc_id) FROM post) AS indexed_docs, 'plain' AS profile
UNION ALL SELECT 'stemmed', (SELECT count(*) FROM documents), (SELECT count(DISTINCT doc_id) FROM post), 'porter'
UNION ALL SELECT 'merged', (SELECT count(*) FROM (SELECT doc_id FROM documents UNION SELECT item_id FROM benchmark)),
  (SELECT count(DISTINCT doc_id) FROM mrg), 'plain'""",
        "footprint": f"""{base} SELECT codec, (SELECT count(*) FROM post) AS postings,
  (SELECT CAST(sum(tf) AS BIGINT) FROM post) AS occurrences, true AS stored, true AS no_larger
FROM (VALUES ('none'), ('gzip'), ('zstd')) AS v(codec)""",
        "read_sample": "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars FROM documents ORDER BY doc_id LIMIT 500",
        "index_freshness_stale": """SELECT count(*) AS stored_docs,
  count(*) + (SELECT count(*) FROM benchmark) AS expected_docs, false AS fresh FROM documents""",
        "index_freshness": """SELECT count(*) AS stored_docs, count(*) AS expected_docs, true AS fresh
  FROM documents""",
        "index_changed_ranges": """SELECT 'changed' AS against, CAST(0 AS BIGINT) AS first_id, CAST(1023 AS BIGINT) AS last_id,
  count(*) AS stored_docs, count(*) AS found_docs FROM documents WHERE doc_id < 1024""",
        "read_malformed": """SELECT CASE WHEN doc_id % 50 > 0 THEN doc_id END AS doc_id,
  CASE WHEN doc_id % 50 > 0 THEN CAST(length(text) AS INTEGER) END AS n_chars,
  CASE WHEN doc_id % 50 = 0 THEN substr('{"doc_id":' || doc_id || ',"text":"', 1, 12) END AS record FROM documents""",
        "sample_of_repeated_ids": """SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars FROM (
  SELECT doc_id, text FROM documents UNION ALL SELECT doc_id, ' ' || coalesce(lang, 'none') FROM documents)
ORDER BY doc_id, text LIMIT 501""",
        "catalog_rank": base + _ranked("SELECT * FROM qterm", _TFIDF),
        "rank_stored_queries": base + f"SELECT CAST(query_id AS VARCHAR) AS query_id, doc_id, score, rank FROM ({_ranked('SELECT * FROM qterm', _TFIDF)})",
        "stored_postings": f"{base} {tf_rows} post",
        "stream_ingest": f"{streamed} {tf_rows} sall",
        "stream_ingest_not": f"""{streamed} SELECT doc_id FROM documents UNION ALL SELECT -item_id - 1 FROM benchmark
EXCEPT SELECT doc_id FROM sall WHERE term = 'thth'""",
        "levels_postings": f"{levels} {tf_rows} lpost",
        "levels_rank": levels + _ranked("SELECT * FROM qterm", _TFIDF, post="lpost", freq="lfreq").replace("CROSS JOIN n", "CROSS JOIN ln AS n"),
        "phrase_table_pairwise": f"""{echo}, qocc AS (
  SELECT query_id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS slot FROM echo)
SELECT query_id, doc_id FROM (
  SELECT s.query_id, a.doc_id, count(DISTINCT s.slot) AS found FROM qocc z
  JOIN occ a ON a.term = z.term JOIN qocc s ON s.query_id = z.query_id
  JOIN occ b ON b.doc_id = a.doc_id AND b.term = s.term AND b.pos = a.pos + s.slot
  WHERE z.slot = 0 GROUP BY s.query_id, a.doc_id) WHERE found = 3""",
        "phrase_table_strict": f"""{echo} SELECT q.query_id, t.doc_id FROM echo q JOIN tok t
  ON contains(' ' || array_to_string(t.toks, ' ') || ' ', {passage})""",
        "bool_table": f"""{echo} SELECT CAST(q.query_id AS VARCHAR) AS query_id, t.doc_id FROM echo q JOIN tok t
  ON (contains(' ' || array_to_string(t.toks, ' ') || ' ', ' ' || q.toks[1] || ' ' || q.toks[2] || ' ')
      AND NOT list_contains(t.toks, 'thth'))
  OR (list_contains(t.toks, q.toks[1]) AND list_contains(t.toks, q.toks[2]) AND list_contains(t.toks, 'erin'))""",
        "term_id_lookup": f"""{base} SELECT 'thth' AS term, count(*) AS term_id FROM freq
  WHERE term <= 'thth' AND EXISTS (SELECT 1 FROM freq WHERE term = 'thth') HAVING count(*) > 0""",
        "term_ids_lookup": f"""{base}, ids AS (SELECT term, row_number() OVER (ORDER BY term) AS term_id FROM freq)
SELECT term, term_id FROM ids WHERE term IN (SELECT term FROM qterm)""",
        "postings_lookup": f"{base} {tf_rows} post WHERE term = 'thth'",
        "postings_lookup_batch": f"{base} {tf_rows} post WHERE term IN (SELECT term FROM qterm)",
        "df_lookup": f"{base} SELECT 'zygote' AS term, count(*) AS df FROM post WHERE term = 'zygote'",
        "df_lookup_zero_fill": f"""{base} SELECT w.term, coalesce(f.df, 0) AS df FROM (
  SELECT DISTINCT unnest({_toks('text')}) AS term FROM conversations) w LEFT JOIN freq f ON f.term = w.term""",
        "nested_postings": f"{base} {tf_rows} post WHERE term IN ('thth', 'thha', 'erin')",
        "bool_term": f"{base} {_docs('thth')}",
        "bool_and": f"{base} {_docs('thth')} INTERSECT {_docs('thha')}",
        "bool_and3": f"{base} {_docs('thth')} INTERSECT {_docs('thha')} INTERSECT {_docs('thble')}",
        "bool_or": f"{base} {_docs('thth')} UNION {_docs('erin')}",
        "bool_any": f"{base} {_docs('thth')} UNION {_docs('erin')} UNION {_docs('thly')}",
        "bool_not": f"{base} SELECT doc_id FROM documents EXCEPT {_docs('thth')}",
        "bool_not_stop_word": "SELECT doc_id FROM documents",
        "bool_and_not": f"{base} {_docs('thth')} INTERSECT {_docs('thha')} EXCEPT {_docs('thble')}",
        "bool_nested": f"""{base} SELECT doc_id FROM tok WHERE
  (list_contains(toks, 'thor') AND (list_contains(toks, 'thly') OR list_contains(toks, 'thing')))
  OR (NOT (list_contains(toks, 'thth') OR {_phrase_test(['anea', 'eriner'], 'strict')}) AND list_contains(toks, 'erin'))""",
        "phrase_pairwise": f"{base} SELECT doc_id FROM tok WHERE {_phrase_test(['de', 'la', 'de'], 'pairwise')}",
        "phrase_strict": f"{base} SELECT doc_id FROM tok WHERE {_phrase_test(['de', 'la', 'de'], 'strict')}",
        "phrase_batch_pairwise": f"""{base}, qocc AS (
  SELECT query_id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS slot FROM qtok)
SELECT query_id, doc_id FROM (
  SELECT s.query_id, a.doc_id, count(DISTINCT s.slot) AS found FROM qocc z
  JOIN occ a ON a.term = z.term JOIN qocc s ON s.query_id = z.query_id
  JOIN occ b ON b.doc_id = a.doc_id AND b.term = s.term AND b.pos = a.pos + s.slot
  WHERE z.slot = 0 GROUP BY s.query_id, a.doc_id) JOIN qtok USING (query_id) WHERE found = len(toks)""",
        "phrase_batch_strict": f"""{base} SELECT q.query_id, t.doc_id FROM qtok q JOIN tok t
  ON len(q.toks) > 0 AND contains(' ' || array_to_string(t.toks, ' ') || ' ', {passage})""",
        "bool_batch": _bool_batch(),
        "bool_batch_passages": f"""{base} SELECT q.query_id, t.doc_id FROM qtok q JOIN tok t
  ON len(q.toks) > 0 AND list_has_all(t.toks, q.toks)""",
        "rank_presence": f"""{base} SELECT doc_id, CAST(1.0 AS DOUBLE) AS score,
  CAST(row_number() OVER (ORDER BY doc_id) AS INTEGER) AS rank
FROM (SELECT DISTINCT doc_id FROM post WHERE term IN ('thth', 'erin')) ORDER BY doc_id LIMIT 10""",
        "rank_tf": base + _single("thth thha", "CAST(1.0 AS DOUBLE)"),
        "rank_tfidf": base + _single("anea eriner thanea", _TFIDF),
        "rank_workload": base + _ranked(_workload_terms(), _TFIDF),
        "rank_presence_batch": f"""{base} SELECT query_id, doc_id, CAST(1.0 AS DOUBLE) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS rank FROM (
    SELECT DISTINCT query_id, doc_id FROM qterm q JOIN post p ON p.term = q.term)) WHERE rank <= 10""",
        "rank_tf_batch": base + _ranked("SELECT * FROM qterm", "CAST(1.0 AS DOUBLE)"),
        "rank_tfidf_batch": base + _ranked("SELECT * FROM qterm", _TFIDF),
        "stem_words": f"{base}, {_porter(_VOCAB)} SELECT token, term FROM stems",
        "stem_postings": f"{porter} {tf_rows} spost",
        "bool_porter": f"""{porter} SELECT doc_id FROM spost WHERE term = 'er'
EXCEPT SELECT a.doc_id FROM (SELECT doc_id, unnest(positions) AS pos FROM spost
  WHERE term IN (SELECT term FROM stems WHERE token = 'anea')) a
JOIN (SELECT doc_id, unnest(positions) AS pos FROM spost
  WHERE term IN (SELECT term FROM stems WHERE token = 'eriner')) b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1""",
        "bool_porter_phrase": f"""{porter} SELECT DISTINCT a.doc_id FROM (SELECT doc_id, unnest(positions) AS pos FROM spost
  WHERE term IN (SELECT term FROM stems WHERE token = 'anea')) a
JOIN (SELECT doc_id, unnest(positions) AS pos FROM spost
  WHERE term IN (SELECT term FROM stems WHERE token = 'eriner')) b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1""",
        "rank_tfidf_porter": porter
        + _ranked(
            "SELECT DISTINCT q.query_id, s.term FROM qterm q JOIN stems s ON s.token = q.term",
            _TFIDF, post="spost", freq="sfreq",
        ),
        "latency_summary": """SELECT event_type, count(*) AS queries, round(avg(value), 6) AS avg,
  round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99
FROM events GROUP BY event_type""",
        "latency_sketches": """SELECT event_type, count(*) AS queries, round(avg(value), 6) AS avg, true AS p95, true AS p99
FROM events GROUP BY event_type""",
        "latency_summary_null_keys": """SELECT CASE WHEN event_type <> 'click' THEN event_type END AS kind, count(*) AS queries,
  round(avg(value), 6) AS avg, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99
FROM events GROUP BY 1""",
        "throughput": """SELECT user_id, queries, round(elapsed, 6) AS elapsed,
  round(CASE WHEN elapsed > 0 THEN queries / elapsed ELSE 0 END, 6) AS throughput
FROM (SELECT user_id, count(*) FILTER (event_type <> 'error') AS queries,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS elapsed FROM events GROUP BY user_id)""",
        "size_label": f"""SELECT source, lang, b AS bytes, {_LABEL} AS label FROM (
  SELECT source, lang, CAST(sum(n_chars) AS BIGINT) AS b FROM documents GROUP BY source, lang)""",
        "run_results": _RUN_ROWS,
        "results_csv": _RUN_ROWS,
        "append_runs": """SELECT event_type, user_id, round(avg(value), 6) AS avg, CAST(NULL AS VARCHAR) AS run_error
FROM events WHERE event_type <> 'error' GROUP BY event_type, user_id
UNION ALL SELECT event_type, user_id, NULL, props FROM events WHERE event_type = 'error'""",
        "coerce_numeric": """SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS avg
FROM events WHERE event_type <> 'error'""",
        "grid_gaps": f"""WITH {_RUN_LOG},
batch AS (SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type FROM events),
d1(indexing_stage) AS (VALUES ('positional'), ('tf'), ('tfidf')), d2(datastore) AS (VALUES ('pickle'), ('postgres')),
d3(compression) AS (VALUES ('none'), ('zlib')), d4(optimization) AS (VALUES ('none'), ('skip_pointers')),
d5(query_processing) AS (VALUES ('taat'), ('daat'))
SELECT day, event_type, {_CONFIG} FROM batch, d1, d2, d3, d4, d5
EXCEPT SELECT CAST(CAST(ts AS DATE) AS VARCHAR), event_type, {_CONFIG} FROM cfg""",
        "report_latency_by_mode": f"""WITH {_RUN_LOG} SELECT indexing_stage,
  round(avg(avg) FILTER (query_processing = 'taat'), 6) AS taat,
  round(avg(avg) FILTER (query_processing = 'daat'), 6) AS daat FROM runs GROUP BY indexing_stage""",
        "report_size_by_store": f"""WITH {_RUN_LOG} SELECT indexing_stage, datastore, count(*) AS builds,
  round(avg(size), 6) AS size FROM (SELECT DISTINCT datastore, compression, indexing_stage, size FROM runs)
GROUP BY indexing_stage, datastore""",
        "report_skip_delta": f"""WITH {_RUN_LOG} SELECT indexing_stage, round(a, 6) AS none,
  round(b, 6) AS skip_pointers, round(b - a, 6) AS delta FROM (
  SELECT indexing_stage, avg(avg) FILTER (optimization = 'none') AS a,
    avg(avg) FILTER (optimization = 'skip_pointers') AS b
  FROM runs WHERE query_processing = 'taat' GROUP BY indexing_stage)""",
        "report_latency_throughput": f"""WITH {_RUN_LOG} SELECT datastore, compression, round(avg, 6) AS avg,
  round(throughput, 6) AS throughput, size FROM runs""",
        "report_latency_footprint": f"""WITH {_RUN_LOG} SELECT query_processing, indexing_stage, datastore,
  round(avg, 6) AS avg, size FROM runs""",
    }
