"""Language by trigram profiles: against plain Python, on texts that were not learned from, and on odd rows."""

import re
from collections import Counter

from pyspark.sql import functions as F

from lorewright.operators import profiles


def grams(text):
    out = []
    for w in re.findall(r"[^\W\d_]{1,64}", (text or "").lower()):
        p = f" {w} "
        out += [p[k : k + 3] for k in range(len(w))]
    return out


def ranks(counts, size):
    return {g: k for k, (g, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:size])}


def plain(train, text, size, margin):
    tables = {lang: ranks(Counter(g for one, t in train if one == lang for g in grams(t)), size) for lang in {one for one, t in train if one and grams(t)}}
    mine = ranks(Counter(grams(text)), size)
    if not mine:
        return "und", None, None
    most = len(mine) * size
    saved = sorted((-sum(size - abs(k - t[g]) for g, k in mine.items() if g in t), not any(g in t for g in mine), lang) for lang, t in tables.items())
    share = [(most + s) * 1_000_000 // most for s, _, _ in saved]
    second = share[1] if len(saved) > 1 else None
    sure = not saved[0][1] and (second is None or second - share[0] >= margin * 1_000_000)
    return saved[0][2] if sure else "und", share[0], second


def test_as_plain_python_has_it(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", "text").collect()
    train = [(r.lang, r.text) for r in rows if r.doc_id % 2]
    odd = [(9001, None, None), (9002, None, ""), (9003, None, "12 ?!"), (9004, None, "x" * 200), (9005, "zz", "Ünï­code ÀÉ"), (None, "en", "of the"), (9006, None, "漢字かな")]
    data = [(r.doc_id, r.lang, r.text) for r in rows] + odd
    df = spark.createDataFrame(data, "doc_id long, lang string, text string")
    got = profiles.detected(df, profiles.learned(df.where("doc_id % 2 = 1 and doc_id < 9000"), size=60), size=60).collect()
    assert {r.doc_id: (r.lang, r.distancia, r.segunda) for r in got} == {i: plain(train, t, 60, 0.01) for i, _, t in data} and len(got) == len(data)


def test_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = profiles.detected(docs.where("doc_id % 5 = 0"), profiles.learned(docs.where("doc_id % 5 <> 0")))
    right = found.join(docs.select("doc_id", F.col("lang").alias("is")), "doc_id").where("is is not null").agg(F.avg((F.col("lang") == F.col("is")).cast("int"))).first()[0]
    assert right > 0.99


def test_few_or_no_languages(spark):
    df = spark.createDataFrame([(1, "en", "the end"), (2, None, "the"), (3, None, "zz"), (4, "de", None)], "doc_id long, lang string, text string")
    one = {r.doc_id: (r.lang, r.segunda) for r in profiles.detected(df, profiles.learned(df)).collect()}
    assert one == {1: ("en", None), 2: ("en", None), 3: ("und", None), 4: ("und", None)}
    none = profiles.detected(df, profiles.learned(df.where("false"))).collect()
    assert {r.doc_id: r.lang for r in none} == dict.fromkeys((1, 2, 3, 4), "und")
    assert profiles.detected(df.where("false"), profiles.learned(df)).count() == 0
    both = profiles.learned(spark.createDataFrame([("a", "same"), ("b", "same")], "lang string, text string"))
    assert profiles.detected(spark.createDataFrame([(1, "same")], "doc_id long, text string"), both).first().lang == "und"


def test_parts_grow_with_the_texts(spark, monkeypatch):
    df = spark.createDataFrame([(k, "en" if k % 2 else "es", "the of and " * 10 if k % 2 else "los del que " * 10) for k in range(40)] + [(None, None, None)], "doc_id long, lang string, text string")
    table = profiles.learned(df)
    whole = sorted(map(str, profiles.detected(df, table).collect()))
    monkeypatch.setattr(profiles, "TASK_BYTES", 300)
    cut = profiles.detected(df, table)
    parts = -(-sum(len(r.text or "") for r in df.collect()) // 300)
    assert "hashpartitioning(_id#" in cut._jdf.queryExecution().toString() and f", {parts})" in cut._jdf.queryExecution().toString()
    assert sorted(map(str, cut.collect())) == whole and len(whole) == 41
