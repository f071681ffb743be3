import os

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_postings import as_dict, brute, docs_of

from lexigrid.operators import lookup as L
from lexigrid.operators import postings as P
from lexigrid.operators.boolean import match_term
from lexigrid.plans.build import build_from_blocks, changed_ranges
from lexigrid.plans.session import local_table, scratch_path
from lexigrid.sources import index_store as S
from lexigrid.sources.documents import read_checked, read_documents, rejects_by_file, sample
from lexigrid.streaming.ingest import ingest

TEXTS = {i: f"red{'a' * (i % 3)} green w{'b' * (i % 7)} green" for i in range(60)}


@pytest.mark.parametrize("codec", S.CODECS)
def test_codecs_read_back_alike(spark, codec):
    path = scratch_path(spark, "codec")
    S.write_postings(P.tf_postings(docs_of(spark, TEXTS)), path, 8, codec)
    assert as_dict(spark.read.schema(S.STORED_POSTINGS).parquet(path)) == brute(TEXTS)
    assert S.total_bytes(spark, path) > 0


def test_unknown_codec(spark):
    with pytest.raises(ValueError):
        S.write_postings(P.tf_postings(docs_of(spark, TEXTS)), scratch_path(spark, "x"), 8, "zlib")


@pytest.mark.parametrize("buckets", [8, 9, 16])
def test_files_are_sorted_and_buckets_hold_their_terms(spark, corpus, buckets):
    i = corpus(TEXTS, buckets=buckets)
    assert i.buckets == buckets
    rows = i.postings.select("*", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r")).collect()
    files = {}
    for r in sorted(rows, key=lambda r: r.r):
        files.setdefault(r.f, []).append((r.term, r.doc_id))
    assert all(v == sorted(v) for v in files.values())
    wrong = i.postings.filter(F.col("term_bucket") != S.bucket_of(F.col("term"), buckets))
    assert wrong.count() == 0
    assert as_dict(i.postings) == brute(TEXTS)


def test_buckets_follow_input_size():
    assert S.buckets_for(0) == 8
    assert S.buckets_for(64 * 2**30) == 128
    assert S.buckets_for(100 * 2**40) == 204_800


def test_lookup(spark, corpus):
    i = corpus({0: "red green red", 1: "red", 2: "sky"})
    one = lambda df: [tuple(r) for r in df.collect()]
    assert one(L.term_id(i, "red")) == [("red", 2)]
    assert one(L.term_id(i, "zebra")) == []
    wanted = local_table(spark, {"term": ["sky", "zebra", "red", "red"]}, "term string")
    assert sorted(one(L.term_ids(i, wanted))) == [("red", 2), ("sky", 3)]
    assert as_dict(L.postings_of_term(i, "red")) == {("red", 0): [0, 2], ("red", 1): [0]}
    assert set(as_dict(L.postings_of_terms(i, wanted))) == {("red", 0), ("red", 1), ("sky", 2)}
    assert one(L.doc_freq(i, "red")) == [("red", 2)] and one(L.doc_freq(i, "zebra")) == [("zebra", 0)]
    assert sorted(one(L.doc_freqs(i, wanted))) == [("red", 2), ("sky", 1), ("zebra", 0)]
    nested = L.nested_postings(L.only_terms(i, ["red"]))
    assert nested.first().docs[0].positions == [0, 2]
    assert as_dict(L.flatten_postings(nested)) == as_dict(L.postings_of_term(i, "red"))
    parts = L.nested_postings(L.only_terms(i, ["red"]), docs_per_row=1)
    assert parts.count() == 2
    assert as_dict(L.flatten_postings(parts)) == as_dict(L.postings_of_term(i, "red"))


def test_blocks_round_trip(spark):
    path = scratch_path(spark, "blocks")
    rows = P.tf_postings(docs_of(spark, TEXTS)).withColumn("block_id", F.floor(F.col("doc_id") / 10))
    S.write_blocks(rows, path)
    assert as_dict(P.merge_blocks(S.read_blocks(spark, path))) == brute(TEXTS)
    # Writing one block again replaces that block only.
    again = P.tf_postings(docs_of(spark, {0: "sky"})).withColumn("block_id", F.lit(0).cast("long"))
    S.write_blocks(again, path)
    blocks = S.read_blocks(spark, path)
    assert as_dict(blocks.filter("block_id = 0")) == {("sky", 0): [0]}
    assert blocks.filter("block_id > 0").count() == sum(d >= 10 for _, d in brute(TEXTS))


def test_build_from_blocks_equals_one_shot_build(spark, corpus):
    docs = docs_of(spark, TEXTS)
    path = scratch_path(spark, "blocks")
    S.write_blocks(P.tf_postings(docs).withColumn("block_id", F.floor(F.col("doc_id") / 7)), path)
    merged = build_from_blocks(spark, path, scratch_path(spark, "merged"), 8)
    single = corpus(TEXTS)
    for name in ("terms", "stats", "docs"):
        rows = [sorted(map(tuple, getattr(i, name).collect())) for i in (merged, single)]
        assert rows[0] == rows[1]
    assert as_dict(merged.postings) == as_dict(single.postings)


def test_freshness(spark, corpus):
    i = corpus(TEXTS)
    assert tuple(S.freshness(i, docs_of(spark, TEXTS)).first()) == (60, 60, True)
    assert tuple(S.freshness(i, docs_of(spark, {0: "a", 1: "b"})).first()) == (60, 2, False)


def test_rebuild_replaces(spark):
    from lexigrid.plans.build import build_index

    path = scratch_path(spark, "again")
    build_index(docs_of(spark, TEXTS), path)
    i = build_index(docs_of(spark, {0: "sky", 1: ""}), path)
    assert as_dict(i.postings) == {("sky", 0): [0]}
    assert [tuple(r) for r in i.terms.collect()] == [(1, "sky", 1)]
    assert tuple(i.stats.first()) == (2, 1, 8, "plain")


def test_profile_is_stored_and_stems_reach_merged_blocks(spark, corpus):
    path = scratch_path(spark, "blocks")
    S.write_blocks(P.tf_postings(docs_of(spark, {0: "horse", 1: "horses run"})).withColumn("block_id", F.lit(1).cast("long")), path)
    target = scratch_path(spark, "porter")
    build_from_blocks(spark, path, target, profile="porter")
    index = S.read_index(spark, target)
    assert index.profile == "porter"
    assert sorted(r.doc_id for r in match_term(index, "horses").documents().collect()) == [0, 1]


def test_size_is_measured_when_none_is_given(spark, monkeypatch):
    from lexigrid.plans.build import build_index

    monkeypatch.setattr(S, "BUCKET_BYTES", 20_000)
    docs = read_documents(spark, f"{SMALL}/documents.parquet")
    size = os.path.getsize(f"{SMALL}/documents.parquet")
    assert build_index(docs, scratch_path(spark, "sized")).buckets == max(8, size // 20_000) > 8


def test_repeated_ids_and_nulls_are_rejected_and_counted(spark):
    from lexigrid.plans.build import build_index

    rows = [(1, "red"), (1, "sky"), (1, "sky"), (2, None), (None, "blue"), (3, "sea")]
    i = build_index(spark.createDataFrame(rows, "doc_id long, text string"), scratch_path(spark, "rejects"))
    assert sorted((r.doc_id or 0, r.reason) for r in i.rejects.collect()) == [
        (0, "null id"), (1, "repeated id"), (1, "repeated id"), (2, "null text"),
    ]
    assert as_dict(i.postings) == {("sky", 1): [0], ("sea", 3): [0]}
    assert tuple(i.stats.first())[:2] == (3, 2)


def test_failed_rebuild_leaves_the_old_version(spark, monkeypatch):
    from lexigrid.plans.build import build_index

    path = scratch_path(spark, "kept")
    build_index(docs_of(spark, {0: "sky"}), path)
    monkeypatch.setattr(S, "write_terms", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        build_index(docs_of(spark, {0: "sea", 1: "red"}), path)
    assert as_dict(S.read_index(spark, path).postings) == {("sky", 0): [0]}


def test_catalog_tables(spark, corpus):
    i = corpus(TEXTS)
    spark.sql(f"CREATE DATABASE idx LOCATION '{scratch_path(spark, 'warehouse')}'")
    S.save_tables(i, "idx.t", buckets=4)
    opened = S.open_tables(spark, "idx.t")
    assert as_dict(L.postings_of_term(opened, "green")) == {k: v for k, v in brute(TEXTS).items() if k[0] == "green"}
    assert sorted(r.doc_id for r in (~match_term(opened, "green")).documents().collect()) == []
    assert changed_ranges(opened, docs_of(spark, TEXTS)).count() == 0
    assert as_dict(spark.table("idx.t_postings")) == brute(TEXTS)
    counts = P.document_frequency(spark.table("idx.t_postings"))
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    by_id = S.postings_by_id(i.postings)
    assert as_dict(S.load_postings(i.terms, by_id)) == brute(TEXTS)
    spark.sql("DROP DATABASE idx CASCADE")


def test_read_documents_sample_is_pushed_down(spark):
    docs = read_documents(spark, f"{SMALL}/documents.parquet", sample_size=10)
    assert sorted(r.doc_id for r in docs.collect()) == list(range(10))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(doc_id,9)" in plan


def test_sample_of_ids_with_gaps(spark):
    path = scratch_path(spark, "gaps")
    docs_of(spark, {10 * i: "red" for i in range(1, 21)}).write.parquet(path)
    assert sorted(r.doc_id for r in read_documents(spark, path, sample_size=5).collect()) == [10, 20, 30, 40, 50]
    assert read_documents(spark, path, sample_size=0).count() == 0


def test_other_formats(spark):
    for fmt in ("json", "orc", "csv"):
        path = scratch_path(spark, fmt)
        docs_of(spark, {0: "red", 1: "sky"}).write.format(fmt).save(path)
        docs = read_documents(spark, path, fmt=fmt, schema="doc_id long, text string")
        assert sorted(map(tuple, docs.collect())) == [(0, "red"), (1, "sky")]


def test_stream_ingest_in_two_steps_equals_batch(spark):
    source, blocks, state = (scratch_path(spark, n) for n in ("in", "blocks", "state"))
    first = {k: v for k, v in TEXTS.items() if k < 30}
    docs_of(spark, first).repartition(3).write.parquet(source)
    ingest(spark, source, blocks, state, files_per_batch=2)
    assert as_dict(P.merge_blocks(S.read_blocks(spark, blocks))) == brute(first)
    # New documents, and document 3 once more with another text.
    later = {**{k: v for k, v in TEXTS.items() if k >= 30}, 3: "sky sky"}
    docs_of(spark, later).coalesce(1).write.mode("append").parquet(source)
    ingest(spark, source, blocks, state, files_per_batch=2)
    got = as_dict(P.merge_blocks(S.read_blocks(spark, blocks)))
    assert got == brute({**TEXTS}) | {("sky", 3): [0, 1]}
    assert os.path.basename(blocks).startswith("blocks")


def test_a_second_stream_adds_to_the_first(spark):
    blocks = scratch_path(spark, "blocks")
    for texts in ({0: "red", 7: ""}, {5: "sky", 0: "sea"}, {None: "x", 8: None}):
        source = scratch_path(spark, "in")
        spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1).write.parquet(source)
        ingest(spark, source, blocks, scratch_path(spark, "state"))
    index = build_from_blocks(spark, blocks, scratch_path(spark, "merged"))
    assert as_dict(index.postings) == {("red", 0): [0], ("sea", 0): [0], ("sky", 5): [0]}
    assert sorted(r.doc_id for r in index.docs.collect()) == [0, 5, 7, 8]
    assert sorted((r.doc_id or -1, r.reason) for r in index.rejects.collect()) == [(-1, "null id"), (8, "null text")]
    assert tuple(index.stats.first())[:2] == (4, 2)


def test_scratch_lies_in_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert scratch_path(spark, "x").startswith(root)


def test_ranges_with_changed_texts_are_named(spark, corpus):
    i = corpus(TEXTS)
    ranges = lambda texts: sorted(map(tuple, changed_ranges(i, docs_of(spark, texts), 16).collect()))
    assert ranges(TEXTS) == [] and ranges(dict(sorted(TEXTS.items(), reverse=True))) == []
    assert ranges({**TEXTS, 20: "other"}) == [(16, 31, 16, 16)]
    assert ranges({**TEXTS, 20: TEXTS[21], 21: TEXTS[20]}) == [(16, 31, 16, 16)]
    less = {k: v for k, v in TEXTS.items() if k != 3}
    assert ranges({**less, 400: "new"}) == [(0, 15, 16, 15), (400, 415, 0, 1)]
    assert tuple(S.freshness(i, docs_of(spark, {**TEXTS, 20: "other"})).first()) == (60, 60, True)  # counts don't tell


def test_digests_ignore_what_is_rejected(spark):
    from lexigrid.plans.build import build_index

    docs = spark.createDataFrame([(1, "red"), (1, "sky"), (2, None), (2, None), (None, "blue"), (3, "sea"), (3, None)], "doc_id long, text string")
    i = build_index(docs, scratch_path(spark, "digests"))
    assert sorted(r.doc_id for r in i.docs.collect()) == [1, 2, 3]
    assert changed_ranges(i, docs).count() == 0
    assert changed_ranges(i, docs.filter("doc_id <> 2")).count() == 1


def test_merged_blocks_carry_the_latest_digest(spark):
    source, blocks = scratch_path(spark, "in"), scratch_path(spark, "blocks")
    docs_of(spark, {0: "red", 1: "sky"}).coalesce(1).write.parquet(source)
    state = scratch_path(spark, "state")
    ingest(spark, source, blocks, state)
    docs_of(spark, {1: "sea"}).coalesce(1).write.mode("append").parquet(source)
    ingest(spark, source, blocks, state)
    i = build_from_blocks(spark, blocks, scratch_path(spark, "merged"))
    assert changed_ranges(i, docs_of(spark, {0: "red", 1: "sea"})).count() == 0
    assert changed_ranges(i, docs_of(spark, {0: "red", 1: "sky"})).count() == 1


def test_malformed_lines_are_kept_aside_and_counted(spark):
    lines = {"json": ['{"doc_id": 1, "text": "a"}', '{"doc_id": 2, "te', "", '{"doc_id": "x", "text": "b"}', '{"doc_id": 3}'], "csv": ["1,a", "x,b", "3,c,d", "4,e"]}
    want = {"json": [(1, "a"), (3, None)], "csv": [(1, "a"), (4, "e")]}
    for fmt, rows in lines.items():
        path = scratch_path(spark, fmt)
        for part in (rows, rows[:2]):
            local_table(spark, {"value": part}, "value string").coalesce(1).write.mode("append").text(path)
        docs, rejects = read_checked(spark, path, fmt)
        assert sorted(set(map(tuple, docs.collect()))) == want[fmt]
        assert sorted(r.record for r in rejects.collect()) == sorted([rows[1], *([rows[1], rows[3]] if fmt == "json" else [rows[1], rows[2]])])
        assert sorted(r.rejects for r in rejects_by_file(rejects).collect()) == [1, 2]


def test_sample_counts_rows_of_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "c"), (1, "a"), (1, "b"), (2, "d"), (None, "e")], "doc_id long, text string")
    take = lambda n: sorted(map(tuple, sample(docs, n).collect()))
    assert take(1) == [(1, "a")] and take(2) == [(1, "a"), (1, "b")] and len(take(4)) == 4 == len(take(9)) and take(0) == []


def folders(root):
    return {os.path.join(d, n) for d, names, _ in os.walk(root) for n in names}


def test_a_scope_deletes_its_scratch_tables(spark, index):
    from lexigrid.operators.ranking import rank_batch
    from lexigrid.plans.session import scratch_scope

    queries = local_table(spark, {"query_id": [1, 2], "text": ["thth erin", "anea eriner"]}, "query_id int, text string")
    with scratch_scope(spark) as outer:
        root = outer.removeprefix("file:")
        kept = scratch_path(spark, "kept", scoped=False)
        assert not kept.startswith(outer)
        with scratch_scope(spark) as path:
            got = rank_batch(index, queries).collect()
            assert path.startswith(outer) and len(folders(root)) > 3
        assert len(got) == 20 and folders(root) == set()
        with pytest.raises(ZeroDivisionError), scratch_scope(spark):
            rank_batch(index, queries)
            raise ZeroDivisionError
        assert folders(root) == set()
        spark.range(1).write.parquet(scratch_path(spark, "own"))
        assert len(folders(root)) == 1
    assert not os.path.exists(root)


def test_old_versions_go_on_request(spark):
    from lexigrid.plans.build import build_index

    path = scratch_path(spark, "versions")
    for word in ("sky", "sea", "red"):
        build_index(docs_of(spark, {0: word}), path)
    assert S.drop_old_versions(spark, path, keep=2) == 1
    assert S.drop_old_versions(spark, path) == 1 and S.drop_old_versions(spark, path) == 0
    assert as_dict(S.read_index(spark, path).postings) == {("red", 0): [0]}


def files(path):
    return {os.path.join(d, n): os.path.getmtime(os.path.join(d, n)) for d, _, names in os.walk(path.removeprefix("file:")) for n in names if "_SUCCESS" not in n}


def test_documents_are_added_as_levels(spark):
    from lexigrid.operators.ranking import rank, rank_batch
    from lexigrid.plans.build import build_index
    from lexigrid.plans.levels import add_documents, compact

    path = scratch_path(spark, "levels")
    build_index(docs_of(spark, TEXTS), path, buckets=8)
    now, before = dict(TEXTS), files(path)
    queries = local_table(spark, {"query_id": [1, 2], "text": ["green sky sea", "wb zebra red"]}, "query_id int, text string")
    for texts in ({100: "sky sky zebra", 3: "sea green", 4: ""}, {3: "sky", 200: "zebra red", -5: None}):
        index = add_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), path, compact_at=None)
        now |= texts
        after = files(path)
        assert {f: t for f, t in after.items() if f in before} == before  # nothing that was there is written again
        level = f"{path}/version-{index.levels[-1]}"
        assert set(after) - set(before) <= set(files(level)) | {f for f in after if "/versions/" in f}
        own = spark.read.schema(S.STORED_POSTINGS).parquet(f"{level}/postings")
        assert as_dict(own) == brute({k: v for k, v in texts.items() if v})
        before = after
        single = build_index(docs_of(spark, {k: v or "" for k, v in now.items()}), scratch_path(spark, "single"), buckets=8)
        index = S.read_index(spark, path)
        assert as_dict(index.postings) == as_dict(single.postings)
        assert sorted(r.doc_id for r in index.docs.collect()) == sorted(now)
        assert tuple(index.stats.first())[:2] == tuple(single.stats.first())[:2]
        assert {r.term: r.df for r in index.terms.collect()} == {r.term: r.df for r in single.terms.collect()}
        for got, want in ((rank(index, "green sky sea"), rank(single, "green sky sea")), (rank_batch(index, queries), rank_batch(single, queries))):
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert sorted(r.doc_id for r in (~match_term(index, "green")).documents().collect()) == sorted(r.doc_id for r in (~match_term(single, "green")).documents().collect())
        ids = [r.term_id for r in index.terms.collect()]
        assert len(set(ids)) == len(ids)
        wrong = index.postings.join(index.terms.select("term", F.col("term_id").alias("t")), "term").filter("t <> term_id")
        assert wrong.count() == 0
    assert changed_ranges(index, spark.createDataFrame(list(now.items()), "doc_id long, text string")).count() == 0
    one = compact(spark, path)
    assert len(one.levels) == 1 and as_dict(one.postings) == as_dict(single.postings)
    assert tuple(one.stats.first())[:2] == tuple(single.stats.first())[:2]
    assert S.drop_old_versions(spark, path) == 3 and as_dict(S.read_index(spark, path).postings) == as_dict(single.postings)


def test_large_additions_are_compacted(spark):
    from lexigrid.plans.build import build_index
    from lexigrid.plans.levels import add_documents

    path = scratch_path(spark, "compacted")
    build_index(docs_of(spark, {0: "red"}), path, buckets=8)
    index = add_documents(docs_of(spark, TEXTS), path, compact_at=0.1)  # Bloom filters make up most of so small an index
    assert len(index.levels) == 1 and as_dict(index.postings) == brute(TEXTS)
