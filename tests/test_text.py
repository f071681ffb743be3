import pytest
from pyspark.sql import functions as F

from lexigrid.functions.stem import stem
from lexigrid.functions.text import STOP_WORDS, literal_tokens, size_label, size_unit, size_value
from lexigrid.operators.analysis import analyze
from lexigrid.plans.session import local_table


@pytest.mark.parametrize(
    "text, expected",
    [
        ("state-of-the-art don't", ["stateoftheart", "dont"]),
        ("café 42nd", ["caf", "nd"]),
        ("a1b\u00a0war", ["ab", "war"]),
        ("art\u001cwar", ["art", "war"]),
        ("art\u0085war\u2003sky", ["art", "war", "sky"]),
        ("\u212aelvin", ["kelvin"]),
        ("That it.", []),
        ("", []),
        ("theory of relativity", ["theory", "relativity"]),
    ],
)
def test_tokens(spark, text, expected):
    assert list(literal_tokens(spark, text)) == expected


def test_stop_words(spark):
    from pyspark.ml.feature import StopWordsRemover

    words = StopWordsRemover.loadDefaultStopWords("english")
    assert list(STOP_WORDS) == [w for w in words if "'" not in w]
    assert len(STOP_WORDS) == 131


def test_sql_needs_no_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(e.registry.registered()), len(set(o) & set(e.registry.registered())), set(o) <= set(q))"
    from conftest import ROOT

    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=60)
    assert out.stdout.split() == ["82", "82", "True"], out.stderr


def test_positions_follow_stop_word_removal(spark):
    docs = local_table(spark, {"doc_id": [7], "text": ["theory of relativity"]}, "doc_id long, text string")
    assert [(r.doc_id, r.pos, r.term) for r in analyze(docs).orderBy("pos").collect()] == [
        (7, 0, "theory"),
        (7, 1, "relativity"),
    ]


def test_null_text_has_no_tokens(spark):
    docs = local_table(spark, {"doc_id": [1], "text": [None]}, "doc_id long, text string")
    assert analyze(docs).count() == 0


# Worked examples of the 1980 paper, carried through all steps.
PORTER = """
caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall
hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit
rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform radicalli radic
differentli differ vileli vile analogousli analog vietnamization vietnam predication predic operator oper
feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit
sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr electrical electr
hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop
adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust dependent depend
adoption adopt homologou homolog communism commun activate activ angulariti angular homologous homolog
effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll
generalizations gener oscillators oscil as as by by
""".split()


def test_porter_examples(spark):
    pairs = dict(zip(PORTER[::2], PORTER[1::2]))
    words = local_table(spark, {"token": list(pairs)}, "token string")
    got = {r.token: r.term for r in stem(words, "token", "term").collect()}
    assert got == pairs


def test_literal_stems(spark):
    assert list(literal_tokens(spark, "The running of ponies", "porter")) == ["run", "poni"]


def test_sizes(spark):
    sizes = [0, 512, 1023, 1024, 1536, 1048576, 1572864, 2147483648]
    df = local_table(spark, {"b": sizes}, "b long")
    rows = df.select(
        size_label(F.col("b")).alias("l"), size_value(F.col("b")).alias("v"), size_unit(F.col("b")).alias("u")
    ).collect()
    assert [r.l for r in rows] == [
        "0 Bytes", "512 Bytes", "1023 Bytes", "1.00 KB", "1.50 KB", "1.00 MB", "1.50 MB", "2.00 GB",
    ]
    assert [(r.v, r.u) for r in rows][-1] == (2.0, "GB")
