"""Message updates: extraction, allow-list, dedup, pending rows, in batch and as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorewright.functions.text import message_body
from lorewright.functions.unicode import nfc
from lorewright.sources.scratch import Scratch

#: Outcomes of an update.
NOT_A_MESSAGE, NOT_ALLOWED, DUPLICATE, ACCEPTED = "ignorado", "no_autorizado", "duplicado", "aceptado"
UPDATE = "update_id long, message struct<text string, date long, chat struct<id long>>"


def extracted(updates: DataFrame, json_col: str = "value") -> DataFrame:
    """`updates` plus telegram_update_id, chat_id, texto_raw, timestamp_telegram (UTC) from JSON; nulls where it is no text message."""
    u = F.from_json(F.col(json_col), UPDATE)
    text = F.when(u["message"]["text"] != "", u["message"]["text"])
    has = lambda c: F.when(text.isNotNull(), c)
    return updates.withColumns({"telegram_update_id": u["update_id"], "chat_id": has(u["message"]["chat"]["id"]), "texto_raw": text, "timestamp_telegram": has(F.timestamp_seconds(u["message"]["date"]))})


def allow_list(setting: str | None) -> list[int]:
    """Chat ids of a comma-separated setting; an empty or malformed one is an error."""
    parts = [p.strip() for p in (setting or "").split(",") if p.strip()]
    if not parts:
        raise ValueError("the allow-list is empty")
    return sorted({int(p) for p in parts})


def outcome(allowed: list[int], seen: Column) -> Column:
    """One of the four outcomes of an extracted update; a chat off the list never counts as a duplicate."""
    return (
        F.when(F.col("texto_raw").isNull(), NOT_A_MESSAGE).when(~F.coalesce(F.col("chat_id").isin(*allowed), F.lit(False)), NOT_ALLOWED).when(seen, DUPLICATE).otherwise(ACCEPTED)
    )


def synchronous_leg(updates: DataFrame, bronze: DataFrame, allowed: list[int]) -> DataFrame:
    """Every update's outcome, and the cleaned text of the accepted ones, in canonical composition (NFC). Of repeats in one batch the first (by time) is accepted."""
    rows = extracted(updates)
    stored = bronze.select(F.col("telegram_update_id").alias("_id"), F.lit(True).alias("_seen")).distinct()
    rows = rows.join(stored, F.col("telegram_update_id") == F.col("_id"), "left")
    ok = outcome(allowed, F.col("_seen").isNotNull()) == ACCEPTED
    key = F.when(ok, F.concat(F.lit("u"), F.col("telegram_update_id").cast("string"))).otherwise(F.concat(F.lit("x"), F.xxhash64("value").cast("string")))
    rows = rows.withColumn("_key", key).withColumn("_again", ok & (F.row_number().over(Window.partitionBy("_key").orderBy("timestamp_telegram", "value")) > 1))
    rows = rows.withColumn("estado", outcome(allowed, F.col("_seen").isNotNull() | F.col("_again")))
    return rows.withColumn("texto_limpio", F.when(F.col("estado") == ACCEPTED, message_body(nfc(F.col("texto_raw"))))).drop("_id", "_seen", "_key", "_again")


def stream_messages(raw: DataFrame, allowed: list[int], delay: str = "1 day") -> DataFrame:
    """A stream of accepted messages: extracted, filtered before any state is kept, each update once within the watermark."""
    rows = extracted(raw).where(F.col("texto_raw").isNotNull() & F.col("chat_id").isin(*allowed))
    unique = rows.withWatermark("timestamp_telegram", delay).dropDuplicatesWithinWatermark(["telegram_update_id"])
    return unique.select("telegram_update_id", "chat_id", "texto_raw", "timestamp_telegram", message_body(nfc(F.col("texto_raw"))).alias("texto_limpio"))


def write_bronze(stream: DataFrame, store, checkpoint: str, table: str = "chistes_telegram"):
    """Starts the stream into Bronze; a batch that is run again appends nothing."""

    def batch(df: DataFrame, _: int) -> None:
        store.append_new(df, "bronze", table, F.col("telegram_update_id"), [F.col("timestamp_telegram"), F.col("texto_raw")])

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replay(store, rows: DataFrame, process: Callable[[DataFrame], DataFrame], table: str = "chistes_telegram") -> dict[str, int]:
    """Runs `process` on the rows (id, ...) that aren't marked processed; it returns (id, error), and only ids without an error are marked.

    What `process` gives is written before it is read, so it is asked once. exit: 0 if all went well, 1 if some rows failed, 2 if `process` itself did, in which case nothing is marked.
    """
    pending = store.unprocessed(rows, "bronze", table)
    scratch = Scratch(store.spark, "replay")
    try:
        done = scratch.write(process(pending), "done")
        counts = done.agg(F.count_if(F.col("error").isNull()), F.count_if(F.col("error").isNotNull())).first()
    except Exception as e:  # noqa: BLE001  the rows stay pending
        print(f"replay: {type(e).__name__}")
        return {"procesados": 0, "fallidos": 0, "exit": 2}
    good = done.where("error is null").select("id")
    store.mark_processed(good, "bronze", table)
    scratch.close()
    return {"procesados": counts[0], "fallidos": counts[1], "exit": 0 if not counts[1] else 1}


def windowed(events: DataFrame, kind: str, size: str, slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Events (ts, event_type, value) counted and summed in tumbling, sliding or session windows; an extension, in batch and on streams alike."""
    w = F.session_window("ts", size) if kind == "session" else F.window("ts", size, slide)
    rows = events.withWatermark("ts", delay) if events.isStreaming else events
    return rows.groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def file_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New JSON files of a folder, one update a line."""
    return spark.readStream.format("text").load(folder)
