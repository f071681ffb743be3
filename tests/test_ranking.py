import math
from collections import Counter

import pytest

from lexigrid.operators import ranking as R
from lexigrid.plans.session import local_table

TF = {
    "thth thha": "(988,20) (434,18) (774,17) (960,17) (739,11) (99,9) (306,8) (323,8) (807,8) (815,8)",
    "anea eriner thanea": "(739,8) (927,8) (411,7) (614,7) (627,7) (692,7) (11,6) (60,6) (104,6) (130,6)",
    "erin": "(440,10) (99,7) (434,7) (740,7) (774,7) (960,7) (243,6) (472,5) (662,5) (756,5)",
}
TFIDF = {
    "thth thha": "(988,12.656088) (434,11.401881) (774,10.746273) (960,10.746273) (739,6.869635)",
    "anea eriner thanea": "(739,6.026903) (927,6.026903) (411,5.357317) (614,5.357317) (627,5.357317)",
    "erin": "(440,6.635403) (99,4.644782) (434,4.644782) (740,4.644782) (774,4.644782)",
}


def parse(text):
    return [eval(pair) for pair in text.split()]


def result(df):
    rows = sorted(df.collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    return [(r.doc_id, r.score) for r in rows]


def queries_of(spark, texts):
    return local_table(
        spark, {"query_id": [f"q{i}" for i in range(len(texts))], "text": texts}, "query_id string, text string"
    )


@pytest.mark.parametrize("text", TF)
def test_tf_lists(index, text):
    assert result(R.rank(index, text, 10, "tf")) == parse(TF[text])


@pytest.mark.parametrize("text", TFIDF)
def test_tfidf_lists(index, text):
    assert result(R.rank(index, text, 5)) == parse(TFIDF[text])


def test_batch_equals_single_queries(spark, index):
    texts = [*TF, "erin thth", "the of", "zygote", "erin erin", "thha thth"]
    for scheme in R.SCHEMES:
        rows = R.rank_batch(index, queries_of(spark, texts), 7, scheme).collect()
        for i, text in enumerate(texts):
            got = [(r.doc_id, r.score) for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == f"q{i}"]
            assert got == result(R.rank(index, text, 7, scheme)), (scheme, text)


def test_top_k_is_a_prefix(index):
    longer = result(R.rank(index, "thth thha erin", 21))
    assert result(R.rank(index, "thth thha erin", 20)) == longer[:20]


def test_repeats_unknown_and_stop_words(index):
    assert result(R.rank(index, "erin the erin zygote", 5)) == result(R.rank(index, "erin", 5))
    assert result(R.rank(index, "the of", 5)) == []
    assert result(R.rank(index, "zygote", 5)) == []


def test_word_in_every_document_scores_nothing(corpus):
    i = corpus({0: "red sky", 1: "red", 2: "red sea red"})
    assert result(R.rank(i, "red")) == []
    assert result(R.rank(i, "red", scheme="tf")) == [(2, 2.0), (0, 1.0), (1, 1.0)]


def test_presence(spark, index, corpus):
    i = corpus({5: "red", 3: "blue sky", 9: "red sky", 1: "sea"})
    assert result(R.rank_presence(i, "red the sky", 2)) == [(3, 1.0), (5, 1.0)]
    texts = ["red sky", "sea", "the", "zebra"]
    rows = R.rank_presence_batch(i, queries_of(spark, texts), 2).collect()
    assert sorted((r.query_id, r.doc_id, r["rank"]) for r in rows) == [("q0", 3, 1), ("q0", 5, 2), ("q1", 1, 1)]


def test_copies_of_a_query_all_get_answers(spark, index):
    texts = ["thth thha"] * 40 + ["thha thth thth"] * 5 + ["erin"]
    rows = R.rank_batch(index, queries_of(spark, texts), 3).collect()
    assert len(rows) == 3 * 46
    answers = Counter((r.doc_id, r.score, r["rank"]) for r in rows)
    assert sorted(answers.values()) == [1, 1, 1, 45, 45, 45]


def test_scores_against_brute_force(spark, corpus):
    texts = {d: " ".join(w for i, w in enumerate("red green blue sky sea".split()) for _ in range(d * (i + 1) % 7)) for d in range(40)}
    i = corpus(texts)
    df = Counter(w for t in texts.values() for w in set(t.split()))
    for words in (["red", "sky"], ["green"], ["red", "green", "blue", "sky", "sea"]):
        scores = {
            d: round(sum(t.split().count(w) * math.log10(40 / df[w]) for w in words), 6) for d, t in texts.items()
        }
        best = sorted(((d, s) for d, s in scores.items() if s > 0), key=lambda p: (-p[1], p[0]))[:6]
        assert result(R.rank(i, " ".join(words), 6)) == best


def test_large_side_path(spark, index, monkeypatch):
    texts = list(TF)
    expected = sorted(map(tuple, R.rank_batch(index, queries_of(spark, texts)).collect()))
    monkeypatch.setattr("lexigrid.operators.ranking.is_small", lambda df: False)
    assert sorted(map(tuple, R.rank_batch(index, queries_of(spark, texts)).collect())) == expected


def test_ranges_below_the_threshold_are_not_read(spark, corpus):
    """Documents in several id ranges; a rare word lifts the threshold over what frequent words can give in some."""
    word = lambda i: "".join("abcdefghij"[int(c)] for c in f"{i:03d}")
    texts = {}
    for i in range(160):
        d = i * 1_000 - 30_000
        often = "often " * (9 if 32_768 <= d < 65_536 else 1)
        texts[d] = f"{often} plain{'' if i % 3 else ' common'} own{word(i)}" + (" scarce scarce" if i % 40 == 5 else "")
    index = corpus(texts)
    queries = {"a": "scarce often", "b": "often plain common", "c": "scarce common", "d": "scarce often plain common owndef ownabc", "e": "scarce"}
    table = local_table(spark, {"query_id": list(queries), "text": list(queries.values())}, "query_id string, text string")
    for scheme in ("tf", "tfidf"):
        for k in (1, 3, 200):
            got = {}
            for r in R.rank_batch(index, table, k, scheme).collect():
                got.setdefault(r.query_id, []).append((r.rank, r.doc_id, r.score))
            for q, text in queries.items():
                want = [(r.rank, r.doc_id, r.score) for r in R.rank(index, text, k, scheme).collect()]
                assert sorted(got.get(q, [])) == sorted(want), (scheme, k, q)
    share = R.range_share(index, table.filter("query_id = 'c'"), 3, "tf").first()
    assert share.postings > share.read == 0  # a document of `common` alone scores 1, three documents of `scarce` 2 or more
    share = R.range_share(index, table.filter("query_id = 'b'"), 3, "tf").first()
    assert share.postings == share.read > 0  # no rare word, no threshold


def test_the_bound_with_every_frequency_one(spark, corpus):
    """Ties between documents with and without rare words: a bound equal to the threshold must be read."""
    index = corpus({i: ("left right" if i < 20 else "left") + (" lone pair" if i in (30, 31) else "") for i in range(40)})
    table = local_table(spark, {"query_id": ["x"], "text": ["left right lone"]}, "query_id string, text string")
    for k in (1, 2, 5):
        got = [(r.doc_id, r.score) for r in R.rank_batch(index, table, k, "tf").orderBy("rank").collect()]
        assert got == [(r.doc_id, r.score) for r in R.rank(index, "left right lone", k, "tf").orderBy("rank").collect()]
    assert got == [(i, 2.0) for i in range(5)]
