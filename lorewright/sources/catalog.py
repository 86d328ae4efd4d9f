"""Names that jokes are filed under (topics, techniques, sources), and candidates that wait for review."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.operators.relational import latest, with_keys
from lorewright.operators.taxonomy import PENDING
from lorewright.sources.store import Store

#: The tables of names, and the states of a candidate.
TABLES = ("temas", "tecnicas", "fuentes")
STATES = (PENDING, "aprobado", "rechazado")
NAMES = "id long, nombre string"
CANDIDATES = "id string, tipo string, texto string, created_at timestamp"
CHANGES = "id string, estado string, updated_at timestamp, turno long"


def listed(store: Store, table: str) -> DataFrame:
    """All names of a table: id, nombre."""
    if table not in TABLES:
        raise ValueError(f"unknown table {table!r}")
    return store.read("gold", table, NAMES)


def added(store: Store, table: str, names: DataFrame, name_col: str = "nombre") -> dict[str, int]:
    """Adds the names that a table lacks, with ids after its largest; null names are left out and a rerun adds nothing."""
    rows = names.select(F.col(name_col).alias("nombre")).where("nombre is not null").distinct()
    new = with_keys(rows, listed(store, table), "nombre")[1]
    return store.append_new(new.select(F.col("id").cast("long").alias("id"), "nombre"), "gold", table, F.col("nombre"), [F.col("id")])


def queued(store: Store, candidates: DataFrame) -> dict[str, int]:
    """Adds candidates (tipo, texto) to the queue; one that is there already, in whatever state, is not queued again."""
    rows = candidates.select(F.sha2(F.concat_ws("\u0000", "tipo", "texto"), 256).alias("id"), "tipo", "texto", F.current_timestamp().alias("created_at"))
    return store.append_new(rows, "gold", "candidatos", F.col("id"), [F.col("texto")])


def in_state(store: Store, state: str = PENDING) -> DataFrame:
    """Candidates (id, tipo, texto, estado, updated_at) whose last state this is; one without any change is pending."""
    if state not in STATES:
        raise ValueError(f"unknown state {state!r}")
    last = latest(store.read("gold", "candidatos_estados", CHANGES), ["id"], [F.desc("turno"), F.desc("updated_at"), F.asc("estado")]).drop("turno")
    rows = store.read("gold", "candidatos", CANDIDATES).join(last, "id", "left")
    return rows.withColumn("estado", F.coalesce("estado", F.lit(PENDING))).where(F.col("estado") == state).select("id", "tipo", "texto", "estado", "updated_at")


def moved(store: Store, ids: DataFrame, state: str) -> int:
    """Sets the state of candidates (id) and when; ids that aren't in the queue are left out. The number of changes."""
    if state not in STATES:
        raise ValueError(f"unknown state {state!r}")
    changes = store.read("gold", "candidatos_estados", CHANGES)
    turn = changes.agg(F.coalesce(F.max("turno"), F.lit(0))).first()[0] + 1
    known = store.read("gold", "candidatos", CANDIDATES).select("id").join(ids.select("id").distinct(), "id", "left_semi")
    rows = known.select("id", F.lit(state).alias("estado"), F.current_timestamp().alias("updated_at"), F.lit(turn).cast("long").alias("turno"))
    return store.append_new(rows, "gold", "candidatos_estados", F.struct("id", "turno"), [F.col("id")])["nuevos"]
