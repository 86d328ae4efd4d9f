"""The theory flow end to end on a small input."""

from lorewright.plans import flows
from lorewright.sources.store import Store

from .test_operators import docx
from .test_text import TRANSCRIPT


def test_theory(spark, tmp_path):
    folder = tmp_path / "in" / "deep"
    folder.mkdir(parents=True)
    (folder / "curso_uno.txt").write_text(TRANSCRIPT, encoding="utf-8")
    (folder / "bad.txt").write_text("no grammar", encoding="utf-8")
    (folder / "x.epub").write_bytes(b"broken")
    (folder / "n.xyz").write_text("?")
    docx(folder / "libro.docx", "<w:p><w:r><w:t>Los perros del barrio. El gato.</w:t></w:r></w:p>")
    store = Store(spark, f"file://{tmp_path}/store")
    out = flows.theory(store, str(tmp_path / "in"))
    assert out["silver"] == {"nuevos": 2, "existentes": 0} and out["bronze"]["nuevos"] == 4
    assert {r.path.rsplit("/", 1)[-1] for r in out["failed"].collect()} == {"bad.txt", "x.epub"} and out["ignored"].count() == 1
    again = flows.theory(store, str(tmp_path / "in"))
    assert again["silver"] == {"nuevos": 0, "existentes": 2} and again["bronze"]["nuevos"] == 0
    assert flows.theory(store, str(tmp_path / "in"), out["state"])["silver"] == {"nuevos": 0, "existentes": 0}
    first = flows.ingest(store)
    assert first["nuevos"] == 11 and flows.ingest(store) == {"nuevos": 0, "existentes": 0}
    checks = {r.check: r.ok for r in flows.validation(store).collect()}
    assert checks["sin_timestamps"] and checks["silver_tiene_bronze_teoria"] and checks["claves_unicas"] and not checks["min_palabras"]
