from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexigrid.operators import postings as P
from lexigrid.plans.session import local_table

TEXTS = {
    0: "red green blue red",
    1: "blue, blue; BLUE!",
    2: "the of and",
    3: "",
    4: "green red the green",
}


def docs_of(spark, texts):
    return local_table(
        spark, {"doc_id": list(texts), "text": list(texts.values())}, "doc_id long, text string"
    )


def brute(texts):
    stop = {"the", "of", "and"}
    out = defaultdict(list)
    for d, text in texts.items():
        cleaned = "".join(c for c in text.lower() if c.isspace() or "a" <= c <= "z")
        for i, w in enumerate(w for w in cleaned.split() if w not in stop):
            out[w, d].append(i)
    return dict(out)


def as_dict(df):
    return {(r.term, r.doc_id): list(r.positions) for r in df.collect()}


def test_tf_postings_match_brute_force(spark):
    rows = P.tf_postings(docs_of(spark, TEXTS))
    assert as_dict(rows) == brute(TEXTS)
    assert rows.filter(F.col("tf") != P.term_frequency(F.col("positions"))).count() == 0
    assert rows.columns == ["term", "doc_id", "tf", "positions"]


def test_positional_postings_have_no_tf(spark):
    assert P.positional_postings(docs_of(spark, TEXTS)).columns == ["term", "doc_id", "positions"]


def test_document_frequency_and_stats(spark):
    docs = docs_of(spark, TEXTS)
    df = {r.term: r.df for r in P.document_frequency(P.term_documents(docs)).collect()}
    assert df == {"red": 2, "green": 2, "blue": 2}
    expected = (5, 3)
    assert tuple(P.corpus_stats(docs, P.tf_postings(docs)).first()) == expected
    assert tuple(P.corpus_stats_from_documents(docs).first()) == expected


word = st.sampled_from("red green blue the sky Sea. of".split())
texts = st.lists(st.lists(word, max_size=8).map(" ".join), min_size=1, max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=texts, cut=st.integers(1, 4))
def test_any_chunking_merges_to_the_single_build(spark, texts, cut):
    docs = docs_of(spark, dict(enumerate(texts)))
    whole = P.tf_postings(docs)
    blocks = whole.withColumn("block_id", F.floor(F.col("doc_id") / cut))
    assert as_dict(P.merge_blocks(blocks)) == as_dict(whole) == brute(dict(enumerate(texts)))


def test_later_block_wins(spark):
    old = P.tf_postings(docs_of(spark, {1: "red red green"})).withColumn("block_id", F.lit(0))
    new = P.tf_postings(docs_of(spark, {1: "blue red"})).withColumn("block_id", F.lit(1))
    assert as_dict(P.merge_blocks(old.unionByName(new))) == {
        ("red", 1): [1], ("green", 1): [2], ("blue", 1): [0],
    }


def test_term_dictionary_is_dense_and_appendable(spark):
    words = [f"w{i:03d}" for i in range(300)]
    first = P.term_dictionary(local_table(spark, {"term": words[::2]}, "term string"))
    got = {r.term: r.term_id for r in first.collect()}
    assert got == {w: i + 1 for i, w in enumerate(words[::2])}
    more = P.term_dictionary(local_table(spark, {"term": words}, "term string"), first)
    assert {r.term: r.term_id for r in more.collect()} == {w: i + 151 for i, w in enumerate(words[1::2])}


def test_rejected_rows(spark):
    docs = local_table(
        spark, {"doc_id": [1, None, 3], "text": ["a", "b", None]}, "doc_id long, text string"
    )
    valid, rejected = P.split_valid(docs)
    assert [r.doc_id for r in valid.collect()] == [1]
    assert sorted(r.reason for r in rejected.collect()) == ["null id", "null text"]


def test_rejected_postings(spark):
    rows = local_table(
        spark,
        {"term": ["a", None, "c", "d"], "doc_id": [1, 2, 3, 4], "tf": [1, 1, 1, 2], "positions": [[0], [0], None, [5]]},
        "term string, doc_id long, tf int, positions array<int>",
    )
    assert sorted(r.reason for r in P.rejected_postings(rows).collect()) == [
        "null key", "null positions", "tf differs from positions",
    ]


def test_index_violations(spark):
    terms = local_table(spark, {"term": ["a", "b", "b", None]}, "term string")
    postings = local_table(
        spark, {"term": ["a", "a", "z"], "doc_id": [1, 1, 2]}, "term string, doc_id long"
    )
    got = sorted((r.violation, r.term or "", r.doc_id or 0) for r in P.index_violations(terms, postings).collect())
    assert got == [
        ("duplicate posting", "a", 1), ("duplicate term", "b", 0), ("null term", "", 0), ("posting without term", "z", 0),
    ]


def test_stemmed_postings_equal_stemming_each_token(spark):
    from lexigrid.operators.analysis import analyze

    docs = docs_of(spark, {0: "running runs run ponies", 1: "pony relational relate run"})
    merged = as_dict(P.stem_postings(P.tf_postings(docs)))
    tokens = defaultdict(list)
    for r in analyze(docs, profile="porter").orderBy("pos").collect():
        tokens[r.term, r.doc_id].append(r.pos)
    assert merged == dict(tokens)
    assert merged["run", 0] == [0, 1, 2]


def test_build_equals_documents_and_counts(index):
    """Known totals of the sf0.01 corpus."""
    totals = index.postings.agg(F.count("*").alias("n"), F.sum("tf").alias("t")).first()
    assert (totals.n, totals.t) == (220_830, 311_429)
    assert index.terms.count() == 55_861
    assert tuple(index.stats.select("total_docs", "indexed_docs").first()) == (1000, 998)


def test_tfidf_index_weights(spark, corpus):
    i = corpus({0: "red green", 1: "red", 2: "sky"})
    got = {(r.term, r.doc_id): round(r.idf, 6) for r in P.tfidf_index(i.postings, i.stats).collect()}
    assert got == {("red", 0): 0.176091, ("red", 1): 0.176091, ("green", 0): 0.477121, ("sky", 2): 0.477121}
