import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from compare import session

    s = session("tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def index(spark):
    """The stored index of the sf0.01 documents."""
    from lexigrid.plans.registry import index_of

    return index_of(spark, MEDIUM)


@pytest.fixture
def corpus(spark):
    """Build an index over a few given texts: ``corpus({0: "..."})``."""
    from lexigrid.plans.build import build_index
    from lexigrid.plans.session import local_table, scratch_path

    def build(texts, profile="plain", buckets=8):
        docs = local_table(
            spark, {"doc_id": list(texts), "text": list(texts.values())}, "doc_id long, text string"
        )
        return build_index(docs, scratch_path(spark, "test"), profile, buckets)

    return build


def ids(df):
    return sorted(r.doc_id for r in df.collect())
