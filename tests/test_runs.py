"""Runs with state: answers' contracts, historic documents, pending messages, backfill, whole validation, names and candidates."""

import json

import pytest
from pyspark.sql import functions as F

from lorewright.functions import contracts
from lorewright.plans import flows, runs
from lorewright.sources import catalog, files
from lorewright.sources.store import Store
from lorewright.streaming import updates

from .test_operators import docx
from .test_text import TRANSCRIPT

RUNS = "doc_id long, para int, run int, color string, texto string"
GOOD = {"texto_normalizado": "t", "tema": "trenes", "estructura": "callback", "estado": "rematado", "sugerencias": "s"}


@pytest.mark.parametrize("raw, error", [
    (json.dumps(GOOD), None), (None, "no JSON"), ("", "no JSON"), ("{", "no JSON"), ("[1]", "no object"), ("3", "no object"),
    (json.dumps({**GOOD, "estado": "otro"}), "estado: unknown value otro"), (json.dumps({**GOOD, "tema": None}), "tema is missing"),
    (json.dumps({k: v for k, v in GOOD.items() if k != "sugerencias"}), "sugerencias is missing"), (json.dumps({**GOOD, "estructura": 3}), "estructura is no string"), (json.dumps({**GOOD, "more": [1]}), None),
])
def test_answers(spark, raw, error):
    a = spark.createDataFrame([(raw,)], "raw string").select(contracts.answer(F.col("raw")).alias("a")).first().a
    assert a.error == error and (a.texto_normalizado == "t") == (error is None)


def test_label_prompts(spark):
    row = spark.range(1).select(contracts.label_prompt(F.lit("x"), "tema", 1).alias("a"), contracts.label_prompt(F.lit("x"), "tema", 2, F.array(F.lit("uno"), F.lit("dos"))).alias("b")).first()
    assert "uno" not in row.a and row.b.endswith("- uno\n- dos") and "SIN_MATCH" in row.b
    with pytest.raises(ValueError):
        contracts.label_prompt(F.lit("x"), "tema", 2)


def coloured(spark, *docs):
    """Documents of paragraphs; each joke is a setup and a punch line in red."""
    rows = []
    for doc_id, jokes in docs:
        for p, (setup, punch) in enumerate(jokes):
            rows += [(doc_id, p, 0, None, setup + " "), (doc_id, p, 1, "FF0000", punch)]
    return spark.createDataFrame(rows, RUNS)


def ask(prompt):
    """A model that answers for the joke after the prompt; jokes with "mal" get a broken answer."""
    joke = F.substring_index(prompt, "\n\n", -1)
    whole = F.to_json(F.struct(joke.alias("texto_normalizado"), F.lit("trenes").alias("tema"), F.lit("giro raro").alias("estructura"), F.lit("rematado").alias("estado"), F.lit("").alias("sugerencias")))
    return F.when(joke.contains("mal"), "{}").otherwise(whole)


def propose(prompt):
    """Names topics only once the names are shown, and never a technique."""
    return F.when(prompt.contains("tema") & prompt.contains("- Trenes"), '{"nombre": " trenes"}').otherwise('{"nombre": "SIN_MATCH"}')


def quote(prompt):
    """The first word of the window."""
    return F.to_json(F.struct(F.regexp_extract(F.substring_index(prompt, "\n\n", -1), r"^\s*(\S+)", 1).alias("inicio")))


def stored(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    catalog.added(store, "temas", spark.createDataFrame([("Trenes",), ("Perros",), (None,)], "nombre string"))
    return store


def test_historic_documents_once_each(spark, tmp_path):
    store = stored(spark, tmp_path)
    docs = coloured(spark, (1, [("El tren salía", "sin vías"), ("El gato subió", "al censo")]), (2, [("Va mal", "la cosa")]), (3, [("El pan duro", "era un ladrillo")]))
    gate = runs.preview(store, docs).first()
    assert gate.permitir and gate.documentos == 3 and runs.preview(store, docs).first().documentos == 3
    assert runs.historic(store, docs, quote, ask, propose, token_limit=1)["exit"] == runs.NOT_RUN
    first = runs.historic(store, docs, quote, ask, propose)
    assert (first["exit"], first["finished"], first["jokes"]) == (runs.SOME_FAILED, 2, 3)
    assert [r.key for r in first["failed"].collect()] == ["2#000000"]
    jokes = runs.jokes_of(store).collect()
    assert {j.tema_id for j in jokes} == {catalog.listed(store, "temas").where("nombre = 'Trenes'").first().id} and {j.tecnica_id for j in jokes} == {None}
    assert len(jokes) == 3 and {j.tipo_fuente for j in jokes} == {"propio_historico"} and {j.version_actual for j in jokes} == {1}
    assert [(r.tipo, r.texto) for r in catalog.in_state(store).collect()] == [("tecnica", "giro raro")]
    again = runs.historic(store, docs, quote, ask, propose)
    assert (again["exit"], again["finished"], again["jokes"]) == (runs.SOME_FAILED, 0, 0) and runs.jokes_of(store).count() == 3
    mended = coloured(spark, (1, [("El tren salía", "sin vías"), ("El gato subió", "al censo")]), (2, [("Va bien", "la cosa")]), (3, [("El pan duro", "era un ladrillo")]))
    last = runs.historic(store, mended, quote, ask, propose)
    assert (last["exit"], last["finished"], last["jokes"]) == (runs.OK, 1, 1) and runs.jokes_of(store).count() == 4


def test_a_failed_joke_of_any_id_is_tried_again(spark, tmp_path):
    """The id of a document is no part of a key that is cut: one that holds the separator stays pending until all its jokes are good."""
    store = stored(spark, tmp_path)
    named = lambda *docs: coloured(spark, *[(k, jokes) for k, (_, jokes) in enumerate(docs)]).join(spark.createDataFrame([(k, n) for k, (n, _) in enumerate(docs)], "doc_id long, n string"), "doc_id").select(F.col("n").alias("doc_id"), "para", "run", "color", "texto")
    first = runs.historic(store, named(("dir/a#b.docx", [("Va mal", "la cosa")]), ("dir/a", [("El pan duro", "era un ladrillo")])), quote, ask, propose)
    assert (first["exit"], first["finished"], first["jokes"]) == (runs.SOME_FAILED, 1, 1)
    again = runs.historic(store, named(("dir/a#b.docx", [("Va bien", "la cosa")]), ("dir/a", [("El pan duro", "era un ladrillo")])), quote, ask, propose)
    assert (again["exit"], again["finished"], again["jokes"]) == (runs.OK, 1, 1)


def test_replay_asks_once(spark, tmp_path):
    """A model that answers otherwise each time: what is counted is what is marked."""
    store = Store(spark, f"file://{tmp_path}/store")
    rows = spark.createDataFrame([(k, "x") for k in range(200)], "id long, texto string")
    out = updates.replay(store, rows, lambda df: df.select("id", F.when(F.rand() < 0.5, "no").alias("error")))
    assert out["procesados"] == 200 - store.unprocessed(rows, "bronze", "chistes_telegram").count() and out["procesados"] + out["fallidos"] == 200


def test_pending_messages(spark, tmp_path):
    store = stored(spark, tmp_path)
    runs.historic(store, coloured(spark, (1, [("El tren salía", "sin vías")])), quote, ask, propose)
    rows = spark.createDataFrame([(1, "El tren salía sin vías"), (2, "esto va mal"), (3, "otro chiste distinto")], "id long, texto string")
    out = runs.messages(store, rows, ask, propose)
    assert (out["exit"], out["procesados"], out["fallidos"]) == (runs.SOME_FAILED, 2, 1)
    assert {(j.texto_normalizado, j.tipo_fuente) for j in runs.jokes_of(store).collect()} == {("El tren salía sin vías", "propio_historico"), ("otro chiste distinto", "propio")}
    again = runs.messages(store, rows, ask, propose)
    assert (again["procesados"], again["fallidos"]) == (0, 1) and runs.jokes_of(store).count() == 2


def test_backfill_and_validation(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    assert all(r.ok for r in runs.validation(store)[0].collect()) and runs.validation(store)[1] == runs.OK
    (tmp_path / "in" / "a").mkdir(parents=True)
    (tmp_path / "in" / "a" / "curso.txt").write_text(TRANSCRIPT, encoding="utf-8")
    (tmp_path / "in" / "otro.md").write_text("x")
    root = str(tmp_path / "in")
    assert runs.backfill(store, [root, str(tmp_path / "none")]) == {"vistos": 2, "nuevos": 2, "existentes": 0, "fallidos": 1, "exit": runs.SOME_FAILED}
    assert runs.backfill(store, [root]) == {"vistos": 2, "nuevos": 0, "existentes": 2, "fallidos": 0, "exit": runs.OK}
    assert runs.backfill(store, [str(tmp_path / "none")])["exit"] == runs.NOT_RUN
    flows.theory(store, root)
    flows.ingest(store)
    assert runs.ingest_numbers(store) == {"documentos": 1, "chunks": 9} and runs.ingest_numbers(store, "v9") == {"documentos": 0, "chunks": 0}
    checks, code = runs.validation(store)
    found = {r.check: r.ok for r in checks.collect()}
    assert len(found) == 12 and code == runs.SOME_FAILED and sorted(c for c, ok in found.items() if not ok) == ["idiomas_permitidos", "min_palabras"]
    path = tmp_path / "store" / "objects" / "bronze-teoria"
    for f in path.rglob("*.parquet"):
        f.unlink()
    found = {r.check: r.ok for r in runs.validation(store)[0].collect()}
    assert not found["fila_objeto_coherente"] and not found["bronze_tiene_objeto"]


def test_sync_and_mark(spark, tmp_path):
    store, folder = Store(spark, f"file://{tmp_path}/store"), tmp_path / "in" / "x"
    folder.mkdir(parents=True)
    run = lambda text, colour="": f"<w:r>{f'<w:rPr><w:color w:val=\"{colour}\"/></w:rPr>' if colour else ''}<w:t>{text}</w:t></w:r>"
    docx(folder / "uno.docx", f"<w:p>{run('Entra un tren. ')}{run('Sin vías.', 'FF0000')}</w:p><w:p></w:p><w:p>{run('Aparte.', '980000')}</w:p>")
    (folder / "roto.docx").write_bytes(b"broken")
    out = runs.sync_and_mark(store, str(tmp_path / "in"))
    assert out["bronze"]["nuevos"] == 2 and out["silver"] == {"nuevos": 1, "existentes": 0} and out["exit"] == runs.SOME_FAILED
    assert [r.path.rsplit("/", 1)[-1] for r in out["failed"].collect()] == ["roto.docx"]
    row = spark.read.parquet(store.path("silver", "historico_marcados")).first()
    assert row.contenido == "Entra un tren. [REMATE]Sin vías[/REMATE].\n\n[CHISTOIDE]Aparte[/CHISTOIDE].\n" and (row.remates, row.chistoides) == (1, 1)
    assert runs.sync_and_mark(store, str(tmp_path / "in"))["silver"] == {"nuevos": 0, "existentes": 1}


def test_marked_documents_are_read_once(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, body in (("b.md", "dos"), ("a.md", "uno"), ("c.txt", "no"), ("sub/d.md", "no")):
        (tmp_path / name).write_text(body)
    rows, state = files.marked_documents(spark, str(tmp_path))
    assert [(r.name, r.content) for r in rows.collect()] == [("a.md", "uno"), ("b.md", "dos")]
    state = spark.createDataFrame(state.collect(), state.schema)
    (tmp_path / "b.md").write_text("tres")
    assert [r.content for r in files.marked_documents(spark, str(tmp_path), state)[0].collect()] == ["tres"]
    assert files.marked_documents(spark, str(tmp_path / "none"))[0].count() == 0


def test_replay_that_fails_whole(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")

    def broken(_):
        raise OSError("the model is away")

    rows = spark.createDataFrame([(1, "x")], "id long, texto string")
    assert updates.replay(store, rows, broken) == {"procesados": 0, "fallidos": 0, "exit": 2}
    assert store.unprocessed(rows, "bronze", "chistes_telegram").count() == 1


def test_names_and_candidates(spark, tmp_path):
    store = stored(spark, tmp_path)
    names = spark.createDataFrame([("Perros",), ("Ascensores",)], "nombre string")
    assert catalog.added(store, "temas", names) == {"nuevos": 1, "existentes": 0} and catalog.added(store, "temas", names)["nuevos"] == 0
    assert sorted(r.id for r in catalog.listed(store, "temas").collect()) == [1, 2, 3]
    rows = spark.createDataFrame([("tema", "a"), ("tema", "b"), ("tecnica", "a")], "tipo string, texto string")
    assert catalog.queued(store, rows)["nuevos"] == 3 and catalog.queued(store, rows)["nuevos"] == 0
    ids = catalog.in_state(store).where("tipo = 'tema'").select("id")
    assert catalog.moved(store, ids, "rechazado") == 2 and catalog.moved(store, ids.limit(1), "aprobado") == 1
    assert [catalog.in_state(store, s).count() for s in catalog.STATES] == [1, 1, 1]
    assert catalog.moved(store, spark.createDataFrame([("no such id",)], "id string"), "aprobado") == 0
    for bad in (lambda: catalog.in_state(store, "x"), lambda: catalog.moved(store, ids, "x"), lambda: catalog.listed(store, "x")):
        with pytest.raises(ValueError):
            bad()
