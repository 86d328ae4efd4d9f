"""Text functions against the rules restated in plain Python and against known values."""

import pytest
from pyspark.sql import functions as F

from lorewright.functions import text

TRANSCRIPT = """[0.50s] SPEAKER_00: Buenas tardes, gracias por venir a esta charla.
[6.10s] SPEAKER_00: Bueno, me llaman Tecla, o Teclita, según el día, y escribo guiones.
[11.80s] SPEAKER_00: O sea, trabajo en esto desde 2011, ¿vale?
[17.00s] SPEAKER_00: El tema de la tarde es el contraste.
[21.30s] SPEAKER_00: El contraste es, digamos, básicamente, poner una cosa enorme junto a una diminuta.
[30.90s] SPEAKER_00: Por ejemplo, piensa que cuentas: "Perdí la casa, el coche... y el bolígrafo bueno."
[39.40s] SPEAKER_00: ¿Vale? Lo diminuto va al final. Ahí está la gracia.
[45.20s] SPEAKER_00: Bueno, vamos a probarlo con calma, ¿no?"""
EXPECTED = [
    ("explicacion", "Buenas tardes, gracias por venir a esta charla."),
    ("explicacion", "Me llaman Tecla, o Teclita, según el día, y escribo guiones."),
    ("explicacion", "Trabajo en esto desde 2011."),
    ("explicacion", "El tema de la tarde es el contraste."),
    ("explicacion", "El contraste es, poner una cosa enorme junto a una diminuta."),
    ("ejemplo", 'Por ejemplo, piensa que cuentas: "Perdí la casa, el coche... y el bolígrafo bueno." ¿Vale?'),
    ("explicacion", "Lo diminuto va al final."),
    ("explicacion", "Ahí está la gracia."),
    ("explicacion", "Vamos a probarlo con calma."),
]


def quality_by_rule(sentence):
    """Four tenths for length, three for distinct words, three for words that carry content."""
    words = "".join(c if c.isalpha() else " " for c in sentence.lower()).split()
    content = [w for w in words if w not in text.FUNCTION_WORDS]
    n = len(words)
    return 0.4 * n / (n + 25) + 0.3 * len(set(words)) / n + 0.3 * len(content) / n


def repeats_by_rule(sentence):
    """Words and what parts them, character by character; a word like the one before goes with the white space between."""
    parts = []
    for c in sentence:
        kind = c.isalnum() or c == "_"
        if parts and parts[-1][0] == kind:
            parts[-1][1] += c
        else:
            parts.append([kind, c])
    out = []
    for k, (kind, s) in enumerate(parts):
        if kind and k >= 2 and parts[k - 1][1].isspace() and parts[k - 2][1].lower() == s.lower():
            out.pop()
            out.append("")
        else:
            out.append(s)
    return "".join(out)


def one(spark, value, make):
    """The value of a column function for one text."""
    return spark.createDataFrame([(value,)], "t string").select(make(F.col("t")).alias("x")).first().x


def test_transcript_through_the_text_core(spark):
    from lorewright.operators import fragments, transcripts

    docs, bad = transcripts.parse_transcripts(spark.createDataFrame([(1, TRANSCRIPT)], "doc_id int, text string"))
    assert bad.count() == 0 and docs.first().speaker_dominante == "SPEAKER_00"
    found = fragments.clean_fragments(fragments.split_documents(docs, text_col="texto")).withColumn("q", F.round(text.quality(F.col("texto")), 6)).orderBy("pos")
    assert [(r.subtipo, r.texto, r.q) for r in found.collect()] == [(kind, sentence, round(quality_by_rule(sentence), 6)) for kind, sentence in EXPECTED]


@pytest.mark.parametrize("value, expected", [
    ("bueno, BÁSICAMENTE, el el Gato gato", "El Gato."), ("eh, o sea", ""), ("a ,, b   c", "A, b c."), ("hola, hola, HOLA , adiós", "Hola, adiós."), ("", ""), ("¿ Vale ?", ""), ("ya está!", "Ya está!"),
])
def test_clean(spark, value, expected):
    assert one(spark, value, lambda c: text.cleaned(c, F.lit("explicacion"))) == expected


def test_examples_stay_and_unknown_kinds_fail(spark):
    assert one(spark, "eh, a  b", lambda c: text.cleaned(c, F.lit("ejemplo"))) == "eh, a  b"
    with pytest.raises(Exception, match="unknown subtype"):
        one(spark, "x", lambda c: text.cleaned(c, F.lit("otro")))


@pytest.mark.parametrize("value, expected", [("Uno. Dos! ¿Tres? Y... sigue. \"Fin.\" No", ["Uno.", "Dos!", "¿Tres?", "Y... sigue.", '"Fin." No']), ("", []), ("  \n ", []), (None, None)])
def test_sentences(spark, value, expected):
    assert one(spark, value, text.sentences) == expected


def test_repeated_words_like_the_rule(spark):
    for value in ("a a a b B b", "el él el  el", "no-no no", "uno Uno, uno", "ñu ÑU\tñu x", "", "  ", ", a a,", "a\n a", "x1 x1 X1_ x1_"):
        assert one(spark, value, text.without_repeated_words) == repeats_by_rule(value)


@pytest.mark.parametrize("value", ["Sí. No", "a.. b", "a... b? c", ". b", "! ? x", "fin.", "uno.dos tres. cuatro"])
def test_sentence_cuts_like_the_rule(spark, value):
    cuts, begin = [], 0
    for k, c in enumerate(value):
        if c == " " and k and (value[k - 1] in "!?" or value[k - 1] == "." and (k < 2 or value[k - 2] != ".")):
            cuts.append(value[begin:k].strip())
            begin = k
    assert one(spark, value, text.sentences) == [s for s in [*cuts, value[begin:].strip()] if s]


def test_cleaning_is_idempotent_on_real_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kind = F.lit("explicacion")
    twice = docs.select(text.cleaned(F.col("text"), kind).alias("a")).withColumn("b", text.cleaned(F.col("a"), kind))
    assert twice.where("a <> b").count() == 0


@pytest.mark.parametrize("value, expected", [(None, None), ("", None), ("abcd", "***"), ("abcdef", "***cdef")])
def test_mask(spark, value, expected):
    assert one(spark, value, text.masked) == expected


@pytest.mark.parametrize("value, expected", [("/chiste@bot hola @alguien1 @ab", "hola  @ab"), (None, ""), (" x ", "x"), ("mira /no", "mira /no")])
def test_message_body(spark, value, expected):
    assert one(spark, value, text.message_body) == expected


def test_slug_title_tokens_hash(spark):
    assert one(spark, "Él y Ella!", text.slug) == "l-y-ella" and one(spark, "¡!", text.slug) == "documento"
    assert one(spark, "/a.b/mi_libro-uno.v2.pdf", text.title) == "mi libro uno.v2"
    assert [one(spark, v, text.token_estimate) for v in ("", "a", "abcde", None)] == [0, 1, 2, 0]
    with pytest.raises(Exception, match="blank"):
        one(spark, "  ", text.exact_hash)


def test_nfc(spark):
    from lorewright.functions.unicode import nfc

    rows = spark.createDataFrame([("é",), (None,), ("a",)], "t string").select(nfc("t").alias("x")).collect()
    assert [r.x for r in rows] == ["é", None, "a"]


@pytest.mark.parametrize("raw, clean", [
    ("a,,,b", "A,,b."), ("a , , , b", "A,, b."), (",,a,,", "A."), (" ,. ", "."), (", ,", ""), ("", ""), ("a  b\u00a0\u00a0c\nd", "A b c\nd."), ("a , b ! c", "A, b! c."), ("a,,,,b  .", "A,,b."), ("é", "É."), ("3 a", "3 a."),
])
def test_tidied_runs(spark, raw, clean):
    assert spark.createDataFrame([(raw,)], "t string").select(text.tidied(F.col("t")).alias("t")).first().t == clean
