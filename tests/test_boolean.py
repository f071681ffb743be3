import pytest
from conftest import ids
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexigrid.operators import bitmaps as BM
from lexigrid.operators import boolean as B
from lexigrid.operators import phrase as PH
from lexigrid.operators.phrase import match_phrases, phrase_slots
from lexigrid.plans.session import local_table

COLOURS = {
    0: "red green blue",
    1: "red sky green sea",
    2: "green blue",
    3: "the of",
    4: "red green blue red x sky",
    5: "blue sky sea",
}


@pytest.fixture(scope="module")
def colours(spark):
    from lexigrid.plans.build import build_index
    from lexigrid.plans.session import scratch_path

    docs = local_table(
        spark, {"doc_id": list(COLOURS), "text": list(COLOURS.values())}, "doc_id long, text string"
    )
    return build_index(docs, scratch_path(spark, "colours"), buckets=8)


def has(words):
    return {d for d, t in COLOURS.items() if words in t.split()}


def test_counts_on_the_corpus(index):
    t = lambda w: B.match_term(index, w)
    expected = [
        (t("thth"), 252),
        (t("zygote"), 0),
        (t("thth") & t("thha"), 135),
        (B.match_all(index, ["thth", "thha", "thble"]), 78),
        (t("thth") | t("erin"), 346),
        ((t("thth") & t("thha")) | t("erin"), 275),
        (t("thor") & (t("thly") | t("thing")), 143),
        ((t("thth") & t("thha")) & ~t("thble"), 57),
        (~t("thth"), 748),
        (~t("the"), 1000),
        (B.match_phrase(index, "anea eriner"), 131),
        (B.match_phrase(index, "attion thanedble anea"), 131),
        (B.match_phrase(index, "de la de"), 75),
        (B.match_phrase(index, "de la de", "strict"), 13),
        (B.match_phrase(index, "la de la"), 62),
        (B.match_phrase(index, "la de la", "strict"), 5),
        (B.match_phrase(index, "der die der"), 39),
        (B.match_phrase(index, "der die der", "strict"), 6),
    ]
    assert [m.documents().count() for m, _ in expected] == [n for _, n in expected]


def test_first_token_counts_and_stop_words(colours):
    assert ids(B.match_term(colours, "the red green").documents()) == sorted(has("red"))
    assert ids(B.match_term(colours, "the").documents()) == []
    assert ids((~B.match_term(colours, "the")).documents()) == sorted(COLOURS)


def test_phrase_modes(colours):
    match = lambda text, mode="pairwise": ids(B.match_phrase(colours, text, mode).documents())
    assert match("red green sky") == [4]
    assert match("red green sky", "strict") == []
    assert match("green blue") == [0, 2, 4]
    assert match("the") == []
    assert match("the sky") == [1, 4, 5]
    assert match("red zebra") == []


leaf = st.sampled_from("red green blue sky sea zebra".split())
trees = st.recursive(
    leaf,
    lambda t: st.one_of(st.tuples(st.just("&"), t, t), st.tuples(st.just("|"), t, t), st.tuples(st.just("~"), t)),
    max_leaves=4,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tree=trees)
def test_combinators_follow_set_algebra(colours, tree):
    everything = set(COLOURS)

    def build(t):
        if isinstance(t, str):
            return B.match_term(colours, t), has(t)
        if t[0] == "~":
            m, s = build(t[1])
            return ~m, everything - s
        (m, s), (n, u) = build(t[1]), build(t[2])
        return (m & n, s & u) if t[0] == "&" else (m | n, s | u)

    match, expected = build(tree)
    assert ids(match.documents()) == sorted(expected)


def batch(spark, index, queries, mode="pairwise"):
    rows = [
        (q, c, i, text.lstrip("-"), text.startswith("-"))
        for q, clauses in queries.items()
        for c, clause in enumerate(clauses)
        for i, text in enumerate(clause)
    ]
    names = ("query_id", "clause_id", "literal_id", "text", "negated")
    literals = local_table(
        spark, dict(zip(names, map(list, zip(*rows)))),
        "query_id string, clause_id int, literal_id int, text string, negated boolean",
    )
    out = {q: [] for q in queries}
    for r in B.match_batch(index, B.query_clauses(literals, index.profile), mode).collect():
        out[r.query_id].append(r.doc_id)
    return {q: sorted(v) for q, v in out.items()}


def test_batch(spark, colours):
    got = batch(
        spark,
        colours,
        {
            "and": [["red", "blue"]],
            "or": [["sea"], ["red", "blue"]],
            "and_not": [["red", "-sky"]],
            "not": [["-red"]],
            "not_two": [["-red", "-blue"]],
            "not_stop": [["-the"]],
            "stop": [["the"]],
            "unknown": [["red", "zebra"]],
            "not_unknown": [["red", "-zebra"]],
            "phrase": [["green blue"]],
            "not_phrase": [["green", "-green blue"]],
            "same_twice": [["red", "red"]],
            "contradiction": [["red", "-red"]],
            "first_token": [["the"], ["sea"]],
            "gap": [["red green sky", "x"]],
        },
    )
    assert got == {
        "and": [0, 4], "or": [0, 1, 4, 5], "and_not": [0], "not": [2, 3, 5], "not_two": [3],
        "not_stop": [0, 1, 2, 3, 4, 5], "stop": [], "unknown": [], "not_unknown": [0, 1, 4],
        "phrase": [0, 2, 4], "not_phrase": [1], "same_twice": [0, 1, 4], "contradiction": [],
        "first_token": [1, 5], "gap": [4],
    }


def test_batch_is_exact_when_nothing_may_be_broadcast(spark, colours, monkeypatch):
    """The joins that serve large workloads give the same answer."""
    queries = {"a": [["red", "blue"], ["-green"]], "b": [["green blue", "red"]], "c": [["-red", "-sky"]]}
    expected = batch(spark, colours, queries)
    for module in ("lexigrid.operators.boolean", "lexigrid.operators.phrase", "lexigrid.plans.session"):
        monkeypatch.setattr(f"{module}.is_small", lambda df: False)
    assert batch(spark, colours, queries) == expected


def test_phrases_nest(spark, index):
    """strict is within pairwise, pairwise within AND of the words."""
    texts = ["de la de", "la de la", "der die der", "anea eriner", "de de", "thth thha thble"]
    phrases = local_table(
        spark, {"phrase_id": list(range(len(texts))), "text": texts}, "phrase_id int, text string"
    )
    slots = phrase_slots(phrases)
    pairs = lambda df: {(r.phrase_id, r.doc_id) for r in df.collect()}
    strict = pairs(match_phrases(index, slots, mode="strict"))
    loose = pairs(match_phrases(index, slots, mode="pairwise"))
    every = {
        (i, d) for i, t in enumerate(texts) for d in ids(B.match_all(index, t.split()).documents())
    }
    assert strict <= loose <= every
    for i, t in enumerate(texts):
        single = set(ids(B.match_phrase(index, t, "strict").documents()))
        assert single == {d for p, d in strict if p == i}


def test_porter_profile(corpus):
    i = corpus({0: "running ponies", 1: "runs a pony", 2: "walk"}, "porter")
    assert ids(B.match_term(i, "run").documents()) == [0, 1]
    assert ids(B.match_phrase(i, "runs pony").documents()) == [0, 1]


IDS = [-70_000, -32_769, -32_768, -1, 0, 1, 7, 8, 32_767, 32_768, 32_769, 10**12]


def test_bitmaps_hold_any_id(spark):
    rows = spark.createDataFrame([("a", i) for i in IDS] * 2 + [("b", 5)], "term string, doc_id long")
    bits = BM.bitmaps_of(rows, "term")
    back = lambda df: sorted((r.term, r.doc_id) for r in BM.documents_of(df, "term").collect())
    assert back(bits) == [("a", i) for i in IDS] + [("b", 5)]
    others = bits.filter("term = 'b'").withColumn("bits", BM.complement(F.col("bits")))
    assert [d for _, d in back(others)] == [i for i in range(BM.RANGE) if i != 5]
    held = rows.filter("term = 'a'").distinct().join(bits.select("term", "rng", "bits"), "term")
    at = BM.range_of(F.col("doc_id")) == F.col("rng")
    kept = held.filter(at & BM.holds(F.col("bits"), BM.place_of(F.col("doc_id"))))
    assert sorted(r.doc_id for r in kept.collect()) == IDS
    assert held.filter(at & BM.holds(F.col("bits"), BM.place_of(F.col("doc_id") + 3))).count() == 0


def test_frequent_words_and_negations_over_several_ranges(spark, corpus):
    """Words of most documents, of every 50th and of one, over ids on both sides of range borders."""
    every = [i * 1_000 - 40_000 for i in range(120)]
    words = {d: {"common"} | ({"even"} if i % 2 == 0 else {"odd"}) | ({"rare"} if i % 50 == 0 else set()) | ({f"one{'abc'[i]}"} if i < 3 else set()) for i, d in enumerate(every)}
    index = corpus({d: " ".join(sorted(w)) for d, w in words.items()})
    dense = {r.term for r in index.bitmaps.select("term").distinct().collect()}
    assert dense == {"", "common", "even", "odd"}
    queries = {
        "frequent": [["common", "even"]], "none": [["even", "odd"]], "either": [["even"], ["odd"]], "not": [["-even"]], "nots": [["-even", "-rare"]],
        "rare_not": [["common", "-rare"]], "phrase_not": [["common", "-common even"]], "rare_frequent": [["rare", "common", "even"]], "rare_less": [["rare", "-even"]],
        "two_rare": [["rare", "onea"]], "mixed": [["rare", "oneb"], ["odd", "-oneb"], ["-common"]], "unknown": [["-zebra"]], "everything": [["-zebra", "-the"]],
    }

    def holds(literal, have):
        w = literal.lstrip("-").split()
        met = set(w) <= have and "zebra" not in w and "the" not in w
        return met != literal.startswith("-")

    want = {q: sorted(d for d, have in words.items() if any(all(holds(x, have) for x in c) for c in cs)) for q, cs in queries.items()}
    assert batch(spark, index, queries) == want


def test_candidates_shrink_with_every_round(spark, corpus):
    """A word of all documents is met by the candidates that are left, not by all."""
    word = lambda first, i: first + "abcdefghijklmnopqrstuvwxyz"[i // 6] + "abcdefghij"[i % 6]
    texts = {i: " ".join(["common", word("w", i % 30), word("x", i % 15), word("y", i % 6), word("z", i % 3), "pp qq rr"]) for i in range(180)}
    index = corpus(texts)
    phrase = texts[7]
    slots = phrase_slots(local_table(spark, {"phrase_id": [1], "text": [phrase]}, "phrase_id int, text string"))
    for mode in PH.MODES:
        planned = PH._planned(index, slots, "phrase_id", True)
        steps = [r["term"] for r in planned.first().steps]
        assert steps[0] == word("w", 7) and set(steps[-4:]) == {"common", "pp", "qq", "rr"}
        rows = [state.count() for state in PH.narrowed(index, planned, "phrase_id", mode, True, 8)]
        assert rows == [6, 6, 6] and len(rows) == 3
    other = phrase_slots(local_table(spark, {"phrase_id": [1], "text": [phrase.replace(word("x", 7), word("x", 8))]}, "phrase_id int, text string"))
    planned = PH._planned(index, other, "phrase_id", True)
    assert [s.count() for s in PH.narrowed(index, planned, "phrase_id", "strict", True, 8)] == [6, 0, 0]


def test_frequent_words_start_side_by_side(spark, corpus, monkeypatch):
    """Of two words of all documents only the places side by side are candidates, one row a document; copies of a phrase are equal."""
    monkeypatch.setattr(PH, "FREQUENT", 5, raising=False)
    texts = {i: "qa qb qa qb qc" if i % 20 == 0 else "qa qc qb qa qa" if i % 3 else "qb qa qc qb" for i in range(120)}
    index = corpus(texts)
    phrases = {0: "qa qb", 1: "qa qb qa", 2: "qa qc qb", 3: "qa qb", 7: "qa qb nowhere"}
    slots = phrase_slots(local_table(spark, {"phrase_id": list(phrases), "text": list(phrases.values())}, "phrase_id int, text string"))
    strict = {(i, d) for i, p in phrases.items() for d, t in texts.items() if f" {p} " in f" {t} "}
    assert {(r.phrase_id, r.doc_id) for r in match_phrases(index, slots, mode="strict").collect()} == strict
    planned = PH._planned(index, slots.filter("phrase_id = 0"), "phrase_id", True)
    for mode in PH.MODES:
        first, *_ = PH.narrowed(index, planned, "phrase_id", mode, True, 2)
        assert first.count() == 6


def test_frequent_words_pairwise(spark, corpus, monkeypatch):
    """Pairwise, each word may stand at its distance from another place of the first."""
    monkeypatch.setattr(PH, "FREQUENT", 0, raising=False)
    index = corpus({0: "qa qb qc qa qd qa", 1: "qa qb", 2: "qa qd qa", 3: "qa qb qa"})
    slots = phrase_slots(local_table(spark, {"phrase_id": [1, 2], "text": ["qa qb qa", "qa qd"]}, "phrase_id int, text string"))
    got = {(r.phrase_id, r.doc_id) for r in match_phrases(index, slots).collect()}
    assert got == {(1, 0), (1, 3), (2, 0), (2, 2)}
