"""Operators on small inputs, edge cases included."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lorewright.functions import documents, keys, markup, vectors
from lorewright.operators import cost, fragments, marking, reconcile, relational, taxonomy, transcripts, validate


def test_transcript_rejects(spark):
    docs = spark.createDataFrame([(1, "[1s] SPEAKER_00: a\nbad"), (2, ""), (3, "[1s] SPEAKER_01: a b\r\n\n[2.5s] SPEAKER_00: c d\n[3s] SPEAKER_00: e")], "doc_id int, text string")
    good, bad = transcripts.parse_transcripts(docs)
    assert {r.doc_id: r.bad_lines for r in bad.collect()} == {1: 1, 2: 0}
    assert [tuple(r) for r in good.collect()] == [(3, "a b\n\nc d e", "SPEAKER_00")]


def test_render_and_parse_are_inverse(spark):
    rows = [(1, 0, "Uno.", "explicacion", "es", "es"), (1, 1, "Por ejemplo:\n\ndos", "ejemplo", "en", "en")]
    frags = spark.createDataFrame(rows, "doc_id int, pos int, texto string, subtipo string, idioma_original string, idioma_fragmento string")
    facts = spark.createDataFrame([(1, 'a "b": c', None, "teoria", None)], "doc_id int, fuente string, autor string, tipo_fuente string, licencia string")
    whole = fragments.render_documents(frags, facts)
    content = whole.first().contenido
    assert content.startswith('---\nfuente: "a \\"b\\": c"\nautor: null\ntipo_fuente: "teoria"\nlicencia: "personal_only"\nfragmentos:\n  - subtipo: "explicacion"\n')
    back = fragments.parse_documents(whole).first()
    assert back.metadatos == {"fuente": 'a "b": c', "autor": None, "tipo_fuente": "teoria", "licencia": "personal_only"}
    assert [m["idioma_fragmento"] for m in back.fragmentos_meta] == ["es", "en"] and back.cuerpo == "Uno.\n\nPor ejemplo:\n\ndos\n"
    assert [r.chunk for r in fragments.chunk_documents(whole).orderBy("chunk_index").collect()] == ["Uno.", "Por ejemplo:", "dos"]


def test_a_text_without_header(spark):
    p = fragments.parse_documents(spark.createDataFrame([(1, "plain")], "doc_id int, contenido string")).first()
    assert p.metadatos == {} and p.fragmentos_meta == [] and p.cuerpo == "plain"
    with pytest.raises(Exception, match="no end"):
        spark.createDataFrame([("x",)], "c string").select(documents.chunks(F.col("c"))).collect()


def test_paragraphs(spark):
    rows = [(1, k, t, s) for k, (t, s) in enumerate([("a", "explicacion"), ("b", "explicacion"), ("c", "ejemplo"), ("d", "ejemplo"), ("e", "explicacion")])]
    out = fragments.paragraphs(spark.createDataFrame(rows, "doc_id int, pos int, texto string, subtipo string")).orderBy("paragraph")
    assert [r.texto for r in out.collect()] == ["a b", "c", "d", "e"]


@pytest.mark.parametrize("value, tag", [("FF0000", "REMATE"), ("980000", "CHISTOIDE"), ("ff5959", "REMATE"), ("FF5A00", None), ("auto", None), (None, None), ("xyz", None), ("770000", None), ("C80000", "REMATE")])
def test_colours(spark, value, tag):
    assert spark.createDataFrame([(value,)], "c string").select(markup.colour_tag(F.col("c")).alias("t")).first().t == tag


def test_marked_text(spark):
    red, dark = "FF0000", "980000"
    runs = [
        (1, 0, 0, None, "Hola "), (1, 0, 1, red, "toma"), (1, 0, 2, None, " "), (1, 0, 3, red, "ya. "), (1, 0, 4, dark, "¡medio!"),
        (1, 1, 0, red, "uno"), (1, 2, 0, red, "dos"), (1, 3, 0, None, None), (1, 4, 0, red, "tres"), (1, 4, 1, red, "..."), (2, 0, 0, red, " ... "), (2, 0, 1, None, "x"),
    ]
    frame = spark.createDataFrame(runs, marking.RUNS)
    out = {r.doc_id: r.markdown for r in marking.marked_text(frame).collect()}
    assert out[1] == "Hola [REMATE]toma ya[/REMATE]. ¡[CHISTOIDE]medio[/CHISTOIDE]!\n\n[REMATE]uno\n\ndos[/REMATE]\n\n[REMATE]tres[/REMATE]...\n"
    assert out[2] == "... x\n"
    assert marking.round_trip(frame, marking.marked_text(frame)).where("not ok").count() == 0
    lost = frame.where("not (doc_id = 1 and para = 2)")
    assert marking.round_trip(frame, marking.marked_text(lost)).where("not ok").count() == 1


def test_windows_and_setups(spark):
    t = "intro [CHISTOIDE]a[/CHISTOIDE] setup  uno [REMATE]fin[/REMATE] dos [/REMATE] tres [REMATE] x\ny [/REMATE] tail"
    w = marking.segment(spark.createDataFrame([(1, t)], "doc_id int, markdown string")).withColumn("inicio", F.when(F.col("pos") == 0, "setup uno").otherwise("nada"))
    a, b = marking.cut_setups(w).orderBy("pos").collect()
    assert (a.remate, a.chistoides, a.texto, a.inicio_localizado) == ("fin", ["a"], "setup  uno fin", True)
    assert (b.remate, b.ventana, b.inicio_localizado) == ("x\ny", " dos [/REMATE] tres [REMATE] x\ny [/REMATE]", False)


def test_cost_gate_is_strict(spark):
    est = cost.estimate(spark.createDataFrame([(1, "a [REMATE]b[/REMATE]")], "doc_id int, markdown string"))
    n = est.first().tokens_totales
    assert est.first().documentos == 1 and n > 0
    assert cost.gate(est, n).first().permitir and not cost.gate(est, n - 1).first().permitir
    assert cost.limits(settings={"HISTORICO_COSTE_MAX_TOKENS": "5"}) == (5, None) and cost.limits(7, settings={"HISTORICO_COSTE_MAX_EUR": "2"}) == (7, 2.0)


def test_decisions(spark):
    stored = spark.createDataFrame([(1, "x", [1.0, 0.0]), (2, "y", [0.0, 1.0]), (3, "z", None)], "id long, hash_normalizado string, embedding array<double>")
    stored = stored.withColumn("hash_normalizado", F.when(F.col("id") == 2, F.sha2(F.lit("same"), 256)).otherwise(F.col("hash_normalizado")))
    inc = spark.createDataFrame([(10, " same ", [1.0, 0.0]), (11, "near", [0.9, 0.1]), (12, "far", [-1.0, 0.2])], "key long, texto string, embedding array<double>")
    out = {r.key: (r.decision, r.chiste_id) for r in reconcile.decide(inc, stored).collect()}
    assert out == {10: ("IGUAL", 2), 11: ("CAMBIADO", 1), 12: ("NUEVO", None)}
    empty = {r.key: r.decision for r in reconcile.decide(inc, stored.limit(0)).collect()}
    assert set(empty.values()) == {"NUEVO"}


def test_decisions_in_order(spark):
    inc = spark.createDataFrame([("b", 1, "one", [1.0, 0.0]), ("b", 2, "one more", [0.99, 0.05]), ("b", 3, "one", [1.0, 0.0]), ("c", 4, "one", [1.0, 0.0])], "bucket string, key long, texto string, embedding array<double>")
    none = spark.createDataFrame([], "bucket string, id string, hash_normalizado string, embedding array<double>")
    out = {r.key: (r.decision, r.chiste_id) for r in reconcile.decide_in_order(inc, none, "key").collect()}
    assert out == {1: ("NUEVO", None), 2: ("CAMBIADO", "new:1"), 3: ("CAMBIADO", "new:1"), 4: ("NUEVO", None)}


def test_taxonomy(spark):
    table = spark.createDataFrame([(1, "Doble Sentido"), (2, "callback")], "id long, nombre string")
    rows = spark.createDataFrame([(1, "2", None), (2, "SIN_MATCH", " doble\tSENTIDO "), (3, "--5", "99999999999999999999"), (4, None, "")], "key int, a string, b string").withColumn("texto", F.lit("t"))
    got, queue = taxonomy.resolve(rows, table, ["a", "b"])
    assert {r.key: (r.id, r.intentos) for r in got.collect()} == {1: (2, 1), 2: (1, 2), 3: (None, 2), 4: (None, 2)}
    assert queue.count() == 2


def test_keys_and_numbers(spark):
    rows = spark.createDataFrame([("a", "d1", "t", "h"), ("b", "d1", "t", "g"), ("c", None, None, "h"), ("e", None, None, "h"), ("f", "h", None, "q")], "object_path string, drive_file_id string, modified_time string, hash_md5 string")
    out = relational.repeated_keys(rows).orderBy("key").collect()
    assert [(r.legacy, r.key, r.ids) for r in out] == [(False, "d1", ["a", "b"]), (True, "h", ["c", "e"])]
    n = relational.numbered(spark.range(100).repartition(7), [F.desc("id")], "n").orderBy("n").collect()
    assert [(r.n, r.id) for r in n] == [(k + 1, 99 - k) for k in range(100)]
    assert relational.numbered(spark.range(0), [F.asc("id")], "n").count() == 0


def test_null_lineage(spark):
    s = spark.createDataFrame([(1, None), (2, "x")], "object_path int, origen_hash_md5 string")
    assert validate.has_bronze(s, spark.createDataFrame([(None,)], "hash_md5 string")).count() == 1
    assert validate.summary(validate.has_bronze(s.limit(0), s.select(F.col("origen_hash_md5").alias("hash_md5"))), ("silver_tiene_bronze_teoria",)).first().ok


def test_vectors(spark):
    f = spark.createDataFrame([([1.0, 0.0], [0.99, 0.05], "[1,2]", "[]")], "a array<double>, b array<double>, s string, e string")
    r = f.select(vectors.cosine(F.col("a"), F.col("b")).alias("c"), vectors.parsed(F.col("s")).alias("s"), vectors.parsed(F.col("e")).alias("e")).first()
    assert abs(r.c - 0.998727) < 1e-5 and r.s == [1.0, 2.0] and r.e is None
    for bad in ("array(0D, 0D)", "array(1D)"):
        with pytest.raises(Exception, match="zero vector|different sizes"):
            f.select(vectors.cosine(F.col("a"), F.expr(bad))).collect()


def docx(path, body):
    """A DOCX file with this body."""
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')


def test_files(spark, tmp_path):
    from lorewright.sources import files

    run = lambda t, c=None: f"<w:r>{f'<w:rPr><w:color w:val=\"{c}\"/></w:rPr>' if c else ''}<w:t>{t}</w:t></w:r>"
    docx(tmp_path / "a b.DOCX", f"<w:p>{run('Hola ')}{run('fin', 'FF0000')}</w:p><w:tbl><w:p><w:r><w:tab/><w:t>celda</w:t><w:br/></w:r></w:p></w:tbl><w:p/>")
    with zipfile.ZipFile(tmp_path / "l.epub", "w") as z:
        z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="o/p.opf"/></rootfiles></container>')
        z.writestr("o/p.opf", '<package><manifest><item id="a" href="a.xhtml"/><item id="b" href="b.xhtml"/></manifest><spine><itemref idref="b"/><itemref idref="a"/></spine></package>')
        z.writestr("o/a.xhtml", "<html><head><title>t</title></head><body><p>Uno &amp; dos</p></body></html>")
        z.writestr("o/b.xhtml", "<html><body><h1>Cap</h1><script>x</script><p>cero</p></body></html>")
    (tmp_path / "t.txt").write_text("hola", encoding="utf-8")
    (tmp_path / "bad.epub").write_bytes(b"no zip")
    (tmp_path / "x.png").write_bytes(b"\x89")
    found = files.scan(spark, str(tmp_path))
    good, ignored = files.eligible(found)
    assert ignored.count() == 1
    out = {r.name: r for r in files.parse(good).collect()}
    assert out["a b.DOCX"].text == "Hola fin\n\ncelda" and out["l.epub"].text == "Cap\n\ncero\n\nUno & dos" and out["t.txt"].tipo_fuente == "transcripcion_curso"
    assert out["bad.epub"].text is None and "BadZipFile" in out["bad.epub"].error
    runs = files.coloured_runs(good.where("ext = '.docx'"))
    assert marking.marked_text(runs).first().markdown == "Hola [REMATE]fin[/REMATE]\n\n\tcelda\n"
    state = found.select("path", "md5")
    assert files.changed(found, state).count() == 0 and files.changed(found, state.where("path like '%txt'")).count() == 4
    assert files.scan(spark, str(tmp_path / "none")).count() == 0


def test_cloud_folder(spark, tmp_path):
    from lorewright.sources import listing

    rows = [{"id": f"f{k}", "name": n, "modifiedTime": "2026-01-01T00:00:00Z", "mimeType": t, "trashed": k == 3} for k, (n, t) in enumerate([("b.pdf", "application/pdf"), ("Doc", "application/vnd.google-apps.document"), ("i", "image/png"), ("gone", "text/plain"), ("a", "text/plain")])]
    (tmp_path / "l.json").write_text(json.dumps(rows))
    spark.dataSource.register(listing.FolderSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    df = spark.read.format("cloud_folder").option("path", str(tmp_path / "l.json")).option("pageSize", "2").load()
    assert {(r.name, r.nombre_local) for r in df.collect()} == {("b.pdf", "b.pdf"), ("Doc", "Doc.docx"), ("a", "a.txt")}
    assert [r.name for r in df.where("mime_type = 'text/plain'").collect()] == ["a"]
    assert listing.folder_query("x", {"a/b": None}) == "'x' in parents and trashed=false and (mimeType='a/b')"
    with pytest.raises(ValueError):
        listing.checked({"image/png": None})
    with pytest.raises(RuntimeError):
        listing.folder_option({})


def test_store_is_idempotent(spark, tmp_path):
    from lorewright.sources.store import BRONZE, Store, updated

    store = Store(spark, f"file://{tmp_path}/s")
    rows = spark.createDataFrame([("a b.txt", bytearray(b"1"), None, None), ("c.txt", bytearray(b"1"), None, None), ("d.txt", bytearray(b"2"), "id1", "2026-01-01T00:00:00Z")], "name string, content binary, drive_file_id string, modified_time string")
    assert store.capture(rows, "bronze", "teoria") == {"nuevos": 2, "existentes": 1}
    assert store.capture(rows, "bronze", "teoria") == {"nuevos": 0, "existentes": 3}
    kept = store.read("bronze", "teoria_documentos", BRONZE)
    assert {r.object_path for r in kept.collect()} == {"local_legacy/c4ca4238a0b923820dcc509a6f75849b/a_b.txt", "drive/id1/20260101T000000Z/d.txt"}
    with pytest.raises(Exception, match="together"):
        store.capture(rows.withColumn("modified_time", F.lit(None).cast("string")), "silver", "teoria")
    with pytest.raises(ValueError):
        keys.destination("gold", "teoria")
    docs = spark.createDataFrame([("a", "x", "f", 1)], "nombre string, contenido string, fuente string, num_fragmentos int")
    assert store.write_version(docs, docs).endswith("v1") and store.write_version(docs, docs).endswith("v2")
    with pytest.raises(ValueError, match="final"):
        store.write_version(docs, docs, 1)
    t = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id int, estado string, texto string")
    assert [tuple(r) for r in updated(t, t.where("id = 1").select("id", F.lit("z").alias("estado")), "id", ("estado",)).orderBy("id").collect()] == [(1, "z", "b"), (2, "c", "d")]
    with pytest.raises(ValueError):
        updated(t, t, "id", ("estado",))


def test_streamed_updates_and_replay(spark, tmp_path):
    from lorewright.sources.store import Store
    from lorewright.streaming import updates

    lines = [{"update_id": k, "message": {"text": f"/c hola {k}", "date": 1700000000 + k, "chat": {"id": c}}} for k, c in [(1, 7), (1, 7), (2, 8), (3, 7)]] + [{"update_id": 4}]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(map(json.dumps, lines)))
    store = Store(spark, f"file://{tmp_path}/s")
    for _ in range(2):
        stream = updates.stream_messages(updates.file_stream(spark, f"file://{folder}"), [7])
        updates.write_bronze(stream, store, f"file://{tmp_path}/cp").awaitTermination(120)
    kept = spark.read.parquet(store.path("bronze", "chistes_telegram"))
    assert {(r.telegram_update_id, r.texto_limpio) for r in kept.collect()} == {(1, "hola 1"), (3, "hola 3")} and kept.count() == 2
    rows = kept.select(F.col("telegram_update_id").alias("id"))
    fail = lambda df: df.withColumn("error", F.when(F.col("id") == 3, "boom"))
    assert updates.replay(store, rows, fail) == {"procesados": 1, "fallidos": 1, "exit": 1}
    assert [r.id for r in store.unprocessed(rows, "bronze", "chistes_telegram").collect()] == [3]
    with pytest.raises(ValueError):
        updates.allow_list(" , ")
