"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import MEDIUM, SMALL
from pyspark.sql import functions as F

from lexigrid.operators import boolean as B
from lexigrid.operators import postings as P
from lexigrid.operators import ranking as R
from lexigrid.plans import registry
from lexigrid.plans.build import build_index
from lexigrid.plans.session import local_table, scratch_path
from lexigrid.sources.documents import read_documents


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return [line for line in plan(df).splitlines() if "FileScan" in line]


# Eager parts only write scratch tables; the final plans are looked at here.
@pytest.mark.parametrize("name", sorted(set(registry.registered()) - {"footprint", "stream_ingest"}))
def test_no_python_and_no_products(spark, name):
    text = plan(registry.registered()[name](spark, SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, bad


def test_postings_are_narrow_and_analyse_once(spark):
    text = plan(P.tf_postings(read_documents(spark, f"{SMALL}/documents.parquet")))
    assert "Exchange" not in text
    assert text.count("sort_array(") == 1 and text.count("regexp_replace(") == 1
    text = plan(P.term_documents(read_documents(spark, f"{SMALL}/documents.parquet")))
    assert "Exchange" not in text and text.count("regexp_replace(") == 1


def test_scan_reads_two_columns(spark):
    (scan,) = scans(P.tf_postings(read_documents(spark, f"{SMALL}/documents.parquet")))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in scan


def test_word_lookup_prunes_buckets_and_columns(index):
    (scan,) = scans(B.match_term(index, "thth").documents())
    assert re.search(r"PartitionFilters: \[isnotnull\(term_bucket#\d+\), \(term_bucket#\d+ = \d+\)\]", scan)
    assert "EqualTo(term,thth)" in scan
    assert "ReadSchema: struct<term:string,doc_id:bigint>" in scan


def test_boolean_plans_never_read_positions(index):
    t = lambda w: B.match_term(index, w)
    match = (t("thth") & t("thha")) | ~t("erin")
    assert not [s for s in scans(match.documents()) if "positions" in s]
    assert not [s for s in scans(B.match_all(index, ["thth", "erin"]).documents()) if "positions" in s]


def test_complement_reads_all_documents_only_when_final(index):
    t = lambda w: B.match_term(index, w)
    assert len(scans((t("thth") & ~t("thha")).documents())) == 2
    assert len(scans((~t("thth")).documents())) == 2


def test_batch_ranking(spark):
    text = plan(registry.rank_tfidf_batch(spark, MEDIUM))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Partial")
    assert "dynamicpruning" in text
    assert not re.search(r"ReadSchema: struct<[^>]*positions", text)


def test_single_ranking_takes_ordered(index):
    text = plan(R.rank(index, "thth erin"))
    assert "TakeOrderedAndProject" in text


def test_only_the_file_offsets_are_windowed_without_partition(spark):
    text = plan(registry.term_dictionary(spark, SMALL))
    unpartitioned = [line for line in text.splitlines() if re.search(r"Window \[.*\], \[low#", line)]
    assert len(unpartitioned) == 1
    for name in ("rank_tfidf_batch", "rank_presence_batch", "latency_summary"):
        text = plan(registry.registered()[name](spark, SMALL))
        assert "Exchange SinglePartition" not in re.sub(r"(?s)Subquery.*?(?=\n\S|\Z)", "", text)


def test_hot_word_is_split_over_files(spark, monkeypatch):
    """A word of every document is not tied to one task of the index write."""
    monkeypatch.setattr("lexigrid.plans.session.ADVISORY_BYTES", 1)
    docs = local_table(
        spark, {"doc_id": list(range(60_000)), "text": ["hot"] * 60_000}, "doc_id long, text string"
    ).repartition(8)
    index = build_index(docs, scratch_path(spark, "hot"))
    files = index.postings.filter("term = 'hot'").select(F.col("_metadata.file_path")).distinct().count()
    assert files > 1


@pytest.mark.parametrize("name", ["tfidf_index", "index_load", "merge_blocks_to_tables"])
def test_ids_and_frequencies_lie_beside_the_postings(spark, monkeypatch, name):
    """Without any broadcast, reading postings with their ids or weights moves no posting."""
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr("lexigrid.plans.session.BROADCAST_MAX_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(registry.registered()[name](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert "Exchange" not in re.sub(r"(?s)Subquery.*?(?=\n\S|\Z)", "", text) and "Join" not in text


def test_only_stems_of_several_words_are_grouped(spark):
    rows = P.stem_postings(P.tf_postings(local_table(spark, {"doc_id": [0, 1], "text": ["horse horses run", "sky"]}, "doc_id long, text string")))
    got = {(r.term, r.doc_id): (r.tf, r.positions) for r in rows.collect()}
    assert got == {("hors", 0): (2, [0, 1]), ("run", 0): (1, [2]), ("sky", 1): (1, [0])}
    assert re.search(r"words#\d+L? = 1", plan(rows))
