"""Steps whose tasks, shuffles and memory follow the input."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_plans import plan, scans

from lexigrid.operators import boolean as B
from lexigrid.operators import lookup as L
from lexigrid.operators import phrase as PH
from lexigrid.operators import postings as P
from lexigrid.operators import ranking as R
from lexigrid.plans import build, registry
from lexigrid.plans.build import build_index
from lexigrid.plans.session import join_words, local_table, scratch_path
from lexigrid.sources import index_store as S


def texts(spark, rows):
    return local_table(spark, {"doc_id": list(range(len(rows))), "text": rows}, "doc_id long, text string")


def test_frequent_words_are_broadcast_though_the_dictionary_is_not(spark, monkeypatch):
    """Of a dictionary over the bound the frequent words are broadcast; no posting is lost, none comes twice."""
    docs = texts(spark, ["hot warm"] * 20 + ["hot mild"] * 5 + [f"hot rare{c}" for c in "abcdefgh"])
    postings = P.tf_postings(docs)
    words = P.document_frequency(postings.select("term"))
    want = sorted(map(str, postings.join(words, "term").select("term", "doc_id", "tf", "df").collect()))
    for bound in (0, 1, 2, 3, 5):
        monkeypatch.setattr("lexigrid.plans.session.BROADCAST_MAX_ROWS", bound)
        joined = join_words(postings, words)
        assert sorted(map(str, joined.select("term", "doc_id", "tf", "df").collect())) == want
        assert "LeftAnti" in plan(joined)


@pytest.mark.parametrize("profile", ["plain", "porter"])
def test_index_is_the_same_over_the_broadcast_bound(spark, monkeypatch, profile):
    docs = texts(spark, ["runs running run ponies", "pony run sky", "runs ran", "", "pony ponies sky"])
    rows = lambda i: sorted(map(str, i.postings.select("term", "doc_id", "tf", "positions", "term_id", "df").collect()))
    want = rows(build_index(docs, scratch_path(spark, "bound"), profile))
    monkeypatch.setattr("lexigrid.plans.session.BROADCAST_MAX_ROWS", 2)
    assert rows(build_index(docs, scratch_path(spark, "bound"), profile)) == want


def test_stemmed_postings_are_read_from_written_tables(spark):
    rows = P.stem_postings(P.tf_postings(texts(spark, ["runs running run ponies", "pony run", "runs runs"])))
    got = {(r.term, r.doc_id): (r.tf, r.positions) for r in rows.collect()}
    assert got == {
        ("run", 0): (3, [0, 1, 2]), ("poni", 0): (1, [3]), ("poni", 1): (1, [0]), ("run", 1): (1, [1]), ("run", 2): (2, [0, 1]),
    }
    assert "Exchange" not in plan(rows) and "Aggregate" not in plan(rows)


def test_tasks_of_a_ranking_follow_its_parts(spark, corpus, monkeypatch):
    """Three words in 30 documents each, asked for by 4 queries: 360 sums, at most 10 to a task."""
    index = corpus({i: "red green blue" if i < 30 else "sky" for i in range(60)})
    queries = local_table(
        spark, {"query_id": [1, 2, 3, 4], "text": [f"red green blue {w}" for w in ("sky", "ant", "bee", "red")]}, "query_id long, text string"
    )
    want = sorted(map(str, R.rank_batch(index, queries).collect()))
    monkeypatch.setattr("lexigrid.operators.ranking.TASK_PARTS", 10)
    weighted = R._weighted(index, R._bag_terms(R.query_bags(queries), "query_id").withColumnRenamed("query_id", "leader"), "tf", True)
    assert R._tasks(weighted) == 39  # with 'sky' 390 parts
    tops = R.rank_batch(index, queries)
    assert sorted(map(str, tops.collect())) == want


def test_a_bucket_of_a_saved_table_has_several_files(spark, corpus, monkeypatch):
    """As many tasks as the size asks for write a table; each holds words of one bucket."""
    monkeypatch.setattr("lexigrid.sources.index_store.TABLE_FILE_BYTES", 256)
    index = corpus({i: f"red w{'abcdefghijklmnopqrst'[i]} v{'abcdefghijklmnopqrst'[-i]}" for i in range(20)})
    base = scratch_path(spark, "tables").rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE t{base} LOCATION '{scratch_path(spark, 'catalog')}'")
    S.save_tables(index, f"t{base}.idx", buckets=2)
    table = spark.table(f"t{base}.idx_postings")
    files = table.select("term", F.col("_metadata.file_path").alias("file")).distinct()
    assert files.select("file").distinct().count() > 2
    assert files.groupBy("term").count().filter("count > 1").count() == 0
    assert sorted(map(str, table.select("term", "doc_id").collect())) == sorted(map(str, index.postings.select("term", "doc_id").collect()))


def test_a_micro_batch_has_a_file_for_every_core(spark, monkeypatch):
    seen = []

    def ingest(spark, source, blocks, checkpoint, files_per_batch):
        rows = spark.read.parquet(source)
        seen.append((len(rows.inputFiles()), files_per_batch, rows.select("doc_id").distinct().count()))

    monkeypatch.setattr(registry, "ingest", ingest)
    monkeypatch.setattr(registry, "build_from_blocks", lambda *a: None)
    registry._streamed(spark, SMALL)
    cores = spark.sparkContext.defaultParallelism
    (files, each, docs), _ = seen
    assert each == cores and 2 * cores < files <= 3 * cores + 1
    assert docs == registry.documents(spark, SMALL).select("doc_id").distinct().count()


def test_a_build_reads_flat_rows(spark, monkeypatch):
    """Analysed documents are written a row per posting: dictionary and document list read a plain column of them, no nested one."""
    docs = texts(spark, ["red sky red", "", "the of", None, "sky"])
    tables = {}
    keep = build.materialize
    monkeypatch.setattr(build, "materialize", lambda df, name, **options: tables.setdefault(name, keep(df, name, **options)))
    index = build_index(docs, scratch_path(spark, "flat"))
    written = tables["analyzed"]
    assert sorted(map(str, written.select("doc_id", "first", "term", "tf", "positions").collect())) == sorted(
        map(str, P.posting_rows(docs.filter("text is not null")).collect())
    )
    (scan,) = scans(P.document_frequency(P.postings_in(written).select("term")))
    assert "ReadSchema: struct<term:string>" in scan
    assert sorted(map(tuple, P.documents_in(written).collect())) == [(0, True), (1, False), (2, False), (4, True)]
    assert (index.total_docs, index.stats.first().indexed_docs) == (5, 2)


def test_flat_rows_equal_the_nested_ones(spark):
    docs = texts(spark, ["a b red sky red", "", None, "the of", "red", "sky red sky blue sky red"]).repartition(3)
    rows = P.posting_rows(docs)
    text = plan(rows)
    assert "Exchange hash" not in text and text.count("sort_array(") == 1 and text.count("regexp_replace(") == 1
    assert sorted(map(str, P.postings_in(rows).collect())) == sorted(map(str, P.tf_postings(docs).collect()))
    want = P.analyzed(docs).select("doc_id", F.size("postings") > 0)
    assert sorted(map(tuple, P.documents_in(rows).collect())) == sorted(map(tuple, want.collect()))


def workload(spark, queries):
    rows = [
        (q, c, i, text.lstrip("-"), text.startswith("-")) for q, clauses in queries.items() for c, clause in enumerate(clauses) for i, text in enumerate(clause)
    ]
    names = ("query_id", "clause_id", "literal_id", "text", "negated")
    types = "query_id string, clause_id int, literal_id int, text string, negated boolean"
    return B.query_clauses(local_table(spark, dict(zip(names, map(list, zip(*rows)))), types))


def answers(texts, queries):
    """By looking at every document; a phrase of two words stands side by side."""
    holds = lambda x, t: (f" {x.lstrip('-')} " in f" {t} ") != x.startswith("-")
    return sorted((q, d) for q, cs in queries.items() for d, t in texts.items() if any(all(holds(x, t) for x in c) for c in cs))


def test_a_workload_moves_no_candidates_or_results(spark, corpus, monkeypatch):
    """Queries with 60 copies each: what is written follows documents and distinct queries, and no row of the result is shuffled."""
    texts = {i: " ".join(["sky", "even" if i % 2 else "odd", *["rare scarce"] * (i % 20 < 1), *["seldom"] * (i % 25 < 1)]) for i in range(200)}
    kinds = [[["rare scarce", "-even"], ["rare", "sky"]], [["seldom", "sky"], ["seldom", "rare", "-odd"]], [["scarce", "odd", "sky"]]]
    queries = {f"{k}-{i}": clauses for k, clauses in enumerate(kinds) for i in range(60)}
    index, clauses, written = corpus(texts), workload(spark, queries), {}
    keep = B.materialize
    monkeypatch.setattr(B, "materialize", lambda df, name, **options: written.setdefault(name, keep(df, name, **options)))
    found = B.match_batch(index, clauses)
    assert "Exchange hashpartitioning" not in plan(found)
    assert sorted(map(tuple, found.collect())) == answers(texts, queries)
    documents = max(df.count() for name, df in written.items() if "doc_id" in df.columns)
    assert documents <= len(texts) < len(answers(texts, queries))


def test_slices_of_a_workload_lose_and_repeat_nothing(spark, corpus, monkeypatch):
    """A workload over what is broadcast at a time: clauses that a document meets twice, of frequent words, of many literals, and copies."""
    texts = {i: " ".join(["sky", "even" if i % 2 else "odd", "three" if i % 3 else "third", "five" if i % 5 else "fifth", *["rare scarce"] * (i % 20 < 1)]) for i in range(100)}
    kinds = [
        [["rare"], ["scarce"], ["sky", "odd"]], [["rare scarce", "-third"], ["rare", "third", "fifth", "odd", "sky"]], [["-rare", "-even"], ["rare", "fifth"]],
        [["rare", "-third", "-odd"], ["scarce", "-three", "-zebra"]], [["rare", "-rare"]], [["even"], ["rare scarce"]], [["zebra", "sky"]],
    ]
    queries = {f"{k}-{i}": clauses for k, clauses in enumerate(kinds) for i in range(4)}
    monkeypatch.setattr(B, "SLICE", 20, raising=False)
    monkeypatch.setattr(B, "PIECE", 2, raising=False)
    found = B.match_batch(corpus(texts), workload(spark, queries))
    assert sorted(map(tuple, found.collect())) == answers(texts, queries)


def test_few_words_of_a_large_lookup_are_shuffled(spark, corpus, monkeypatch):
    """Candidates over the broadcast bound: of the postings only those of their words meet them."""
    index = corpus({i: f"red green sky{'abcdefghij'[i % 10]}" for i in range(40)})
    needed = local_table(spark, {"term": ["red"] * 30 + ["skya"] * 40, "doc_id": [*range(30), *range(40)]}, "term string, doc_id long")
    small = lambda df: "doc_id" not in df.columns
    monkeypatch.setattr(L, "is_small", small, raising=False)
    monkeypatch.setattr("lexigrid.plans.session.is_small", small)
    rows = L.join_documents(index, needed, ["positions"])
    assert "BroadcastHashJoin" in plan(rows) and "LeftSemi" in plan(rows)
    got = sorted((r.term, r.doc_id, r.positions) for r in rows.collect())
    assert got == [("red", i, [0]) for i in range(30)] + [("skya", i, [2]) for i in range(0, 40, 10)]


@pytest.mark.parametrize("mode", PH.MODES)
def test_words_side_by_side_are_not_looked_up_again(spark, corpus, monkeypatch, mode):
    """Frequent phrases of one, two and three words; the second word of none is looked up in its candidates."""
    texts = {i: ["red sky red", "red sky", "sky red blue", "red blue red sky"][i % 4] for i in range(20)}
    index, asked, look = corpus(texts), [], PH.join_documents
    monkeypatch.setattr(PH, "FREQUENT", 3)

    def seen(index, needed, columns=()):
        asked.extend(needed.select("term").distinct().collect() if "slot" in needed.columns else [])
        return look(index, needed, columns)

    monkeypatch.setattr(PH, "join_documents", seen)
    phrases = {1: "red sky red", 2: "red sky", 3: "red", 4: "sky red blue"}
    rows = PH.match_phrases(index, PH.phrase_slots(local_table(spark, {"phrase_id": list(phrases), "text": list(phrases.values())}, "phrase_id long, text string")), mode=mode)
    words = {p: t.split() for p, t in phrases.items()}
    at = lambda i, w: {p for p, x in enumerate(texts[i].split()) if x == w}
    pairwise = lambda i, ws: bool(at(i, ws[0])) and all(any(p + k in at(i, w) for p in at(i, ws[0])) for k, w in enumerate(ws))
    strict = lambda i, ws: any(all(p + k in at(i, w) for k, w in enumerate(ws)) for p in at(i, ws[0]))
    holds = strict if mode == "strict" else pairwise
    assert sorted(map(tuple, rows.collect())) == sorted((p, i) for p, ws in words.items() for i in texts if holds(i, ws))
    assert {r.term for r in asked} == {"red", "blue"}


def test_documents_of_many_blocks_are_listed_by_several_tasks(spark):
    """A block's documents are a file: by their bytes alone one task wrote the files of all blocks."""
    docs = spark.range(400_000).select(F.col("id").alias("doc_id"), F.lit(True).alias("has_tokens"), F.xxhash64("id").alias("digest"), (F.col("id") % 24).alias("block_id"))
    path = scratch_path(spark, "blocks")
    S.write_blocks(spark.createDataFrame([], S.BLOCKS_SCHEMA), path, docs=docs, source="a:b")
    listed = S.read_block_docs(spark, path).withColumn("file", F.col("_metadata.file_path"))
    files = [r.file for r in listed.select("file").distinct().collect()]
    assert len({f.rsplit("/part-", 1)[1][:5] for f in files}) > 1
    assert all("/source=a%253Ab/batch=" in f or "/source=a%3Ab/batch=" in f for f in files)
    assert listed.agg(F.count("*"), F.count_distinct("doc_id")).first() == (400_000, 400_000)


def test_stems_are_numbered_before_their_postings_are_counted(spark, monkeypatch):
    """Only postings of stems of several words are counted and joined with the counts; ids and frequencies are those of a dictionary."""
    joined = []
    for module in (P, S):
        join = module.join_words
        monkeypatch.setattr(module, "join_words", lambda rows, words, *on, join=join: joined.append(sorted(r.term for r in rows.select(*({"term"} & set(rows.columns))).collect()) if "term" in rows.columns else None) or join(rows, words, *on))
    docs = texts(spark, ["runs running sky", "run sky", "ponies", "blue sky"])
    index = build_index(docs, scratch_path(spark, "numbered"), "porter")
    got = {(r.term, r.doc_id): (r.term_id, r.df) for r in index.postings.collect()}
    assert got == {
        ("blue", 3): (1, 1), ("poni", 2): (2, 1), ("run", 0): (3, 2), ("run", 1): (3, 2), ("sky", 0): (4, 3), ("sky", 1): (4, 3), ("sky", 3): (4, 3),
    }
    assert sorted((r.term_id, r.term, r.df) for r in index.terms.collect()) == [(1, "blue", 1), (2, "poni", 1), (3, "run", 2), (4, "sky", 3)]
    assert joined == [None, ["run", "run"]]


def test_postings_are_ordered_by_one_number(spark):
    """Term id and document in one number give the order of both, whatever the ids."""
    ids = [-(1 << 40), -1, 0, 1, (1 << 24) - 1, 1 << 24, (1 << 24) + 1, 1 << 40]
    pairs = [(t, d) for t in (1, 2, 1 << 33) for d in ids]
    rows = local_table(spark, {"term_id": [t for t, _ in pairs], "doc_id": [d for _, d in pairs]}, "term_id long, doc_id long").repartition(3, "doc_id")
    got = [tuple(r) for r in rows.coalesce(1).sortWithinPartitions(*S._order(True)).collect()]
    assert got == sorted(pairs)
    alone = rows.select(S._order(True)[0].alias("n")).distinct().count()
    assert alone == len(pairs) - 3 * 5  # ids below 0 and from 2**24 - 1 on share a number
