"""Personal data: the base spans against the contract, the labelers' estimates, and what the classifier reports."""

import random
import re

import pytest
from conftest import MEDIUM

from lexigrid.llm import pii, queries

CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checks(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in twice) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in CONTRACT.items() for m in re.finditer(p, text) if checks(k, m.group())]


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def found(spark, texts):
    """Base and added spans by text."""
    rows = pii.personal(documents(spark, texts)).select("key", pii.listed(pii.BASE).alias("b"), pii.listed(pii.FOUND).alias("f")).collect()
    cut = lambda s: s.split(",") if s else []
    return {r.key: (cut(r.b), cut(r.f)) for r in rows}


def test_base_spans_of_generated_texts(spark):
    rng = random.Random(3)
    bits = [
        "a", "b.c", "@", "x-1", ".", "..", "-", "%", "+", " ", "  ", "(", ")", "1", "25", "255", "256", "0300", "1.2.3", "4539578763621486", "45395787 6362-1486",
        "é", "😀", "\n", "+1 (743) 555-3824", "me@x.org", "+49", "0", "00000000000000000", "日本", "_", "１",
    ]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(4000)]
    got = found(spark, texts)
    for i, t in enumerate(texts):
        assert got[i][0] == base(t), t


def test_places_of_very_many_matches_and_long_runs(spark):
    known = {"9" * 300_000: [], "a" * 200_000: [], "+1" + " " * 200_000 + "2": [], "x.y%" * 50_000 + "@z.de": ["email:0:200005"]}  # slow in the plain form
    plain = ["é 1.1.1.1 " * 3_000, "+1-" * 20_000, "a@b.c " * 2_000, "1 " * 50_000]
    got = found(spark, [*known, *plain])
    assert [got[i][0] for i in range(len(got))] == [*known.values(), *map(base, plain)]


SAID = {
    "My SSN is 123-45-6789 as you know": "national:10:21", "pay to IBAN DE89370400440532013000 today": "account:12:34",
    "Contact Dr. Maria Smith there": "name:8:23", "write to john.doe [at] example [dot] com now": "spelt:9:40", "phone (030) 1234 5678 or": "local:6:21",
    "see version 12.05.1980 of it": None, "account 000-12-0000 shipped": None, "pay to DE00370400440532013000": None, "New York is large": None, "Licensed under the Apache License": None,
    "chapter 12-13-1999": None, "Reoi Reoi Reoi Reoi": None,
}


def test_candidates_with_evidence_are_reported_and_others_are_not(spark):
    # Among texts as they come: the model is fitted to all of them.
    corpus = [r.text for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("text").limit(300).collect()]
    got = found(spark, list(SAID) + corpus)
    for i, (text, want) in enumerate(SAID.items()):
        assert got[i][1] == ([want] if want else []), text
    assert sum(len(got[i][1]) for i in range(len(SAID), len(got))) <= 3


def test_reliabilities_are_estimated():
    rng = random.Random(1)
    true = {"format": 0.95, "cue": 0.6}
    counts = {}
    for _ in range(20_000):
        y = rng.random() < 0.3
        fmt = 1 if (rng.random() < true["format"]) == y else -1
        cue = 1 if rng.random() < (true["cue"] if y else 0.05) else 0
        gaz = 1 if (rng.random() < 0.9) == y else -1
        votes = tuple({"format": fmt, "cue": cue, "gazetteer": gaz}.get(name, 0) for name in pii.LABELERS)
        counts["card", votes] = counts.get(("card", votes), 0) + 1
    rel, prior, post = pii.estimate([(k, v, n) for (k, v), n in sorted(counts.items())])
    assert abs(prior["card"] - 0.3) < 0.05
    assert abs(rel["cue"][1][0] - 0.6) < 0.1 and rel["cue"][1][1] < 0.1
    assert rel["format"][1][0] > 0.85 and rel["format"][-1][1] > 0.85
    assert pii.estimate([])[1:] == ({}, {})


@pytest.mark.parametrize("texts", [[], [None, "", " "]])
def test_nothing_to_find(spark, texts):
    assert found(spark, texts) == {i: ([], []) for i in range(len(texts))}


def test_no_python_in_the_plan(spark):
    plan = queries.op12_pii(spark, MEDIUM)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
