"""Headers read back and checked: each text is worked on once, and odd headers are read by the rules."""

import contextlib
import io

from pyspark.sql import functions as F

from lorewright.functions import documents
from lorewright.operators import fragments, validate
from lorewright.plans import registry

SMALL = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_header_check_renders_once(spark):
    found = plan(registry.queries()["header_check"](spark, SMALL))
    assert found.count("FileScan") == 1 and found.count("Exchange") == 1


def test_checks_asked_for(spark):
    bad = '---\nfuente: "a"\nfragmentos:\n  - subtipo: "ejemplo"\n    idioma_original: "fr"\n---\n\nSPEAKER_01: [1.5s] hola\n'
    p = fragments.parse_documents(spark.createDataFrame([(1, bad), (2, None)], "doc_id int, contenido string")).withColumn("path", F.col("doc_id").cast("string"))
    every = {tuple(r) for r in validate.document_checks(p).collect()}
    parts = validate.word_bounds(p).unionByName(validate.allowed_languages(p)).unionByName(validate.complete_header(p)).unionByName(validate.no_timestamps(p)).unionByName(validate.no_speakers(p))
    assert every == {tuple(r) for r in parts.collect()} and {r[0] for r in every} == set(validate.CONTENT_CHECKS) - {"max_palabras", "sin_duplicados"}
    for name in validate.CONTENT_CHECKS[:-2] + validate.CONTENT_CHECKS[-1:]:
        assert {tuple(r) for r in validate.document_checks(p, [name]).collect()} == {r for r in every if r[0] == name}


def test_lines_of_a_header_are_split_once():
    assert documents.header_fragments(F.col("h"))._jc.toString().count("split(") == 2


def test_parse_yaml_keeps_documents_whole(spark):
    assert plan(registry.queries()["parse_yaml"](spark, SMALL)).count("Generate") == 1


def test_odd_headers(spark):
    head = 'fuente: "a\\\\b \\"c\\""\n autor :null\nno colon\nx: "\nfuente:\u2003"last"\u00a0\n:empty\ny:a:b\nfragmentos:\n  - subtipo: "s"\n\n    subtipo:  "t" \n    k\n    i: "x\u3000"\n  - \n  - z:\u2028'
    r = spark.createDataFrame([(head,), ("",), (None,)], "h string").select(documents.header_fields(F.col("h")).alias("d"), documents.header_fragments(F.col("h")).alias("f")).collect()
    assert r[0].d == {"autor": None, "x": '"', "fuente": "last", "": "empty", "y": "a:b"}
    assert r[0].f == [{"subtipo": "t", "i": "x\u3000"}, {}, {"z": ""}] and r[1].d == {} and r[1].f == [] and r[2].d is None
