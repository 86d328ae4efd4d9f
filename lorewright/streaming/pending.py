"""Replay of messages as a stream with state: failed ones wait for their next try, in event time, until they succeed, have been tried often enough, or are too old."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

#: What became of a message.
DONE, GIVEN_UP, EXPIRED = "procesado", "abandonado", "caducado"
#: Keys that messages are dealt to by id, so a chat with very many is no single key; choose more where very many wait at once, since a key's list is written whole.
PARTS = 256
OUTCOME = "id long, estado string, intentos int, error string, resuelto_at timestamp"
WAITING = "id long, texto string, llegada long, intentos int, siguiente long"
COLUMNS = ["id", "texto", "llegada", "intentos", "siguiente"]
_PROVIDER, _ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Retries:
    """Tries at most, seconds to the second try (doubled for each one after), and seconds after which a message that still fails is too old."""

    tries: int = 4
    wait: int = 600
    expiry: int = 86_400


class Replay(StatefulProcessor):
    """One key's waiting messages: a list in state and a timer for the earliest time at which one is due.

    Times are those of the messages (microseconds since 1970), never of the machine, and a try counts for the time at which it was due. So what comes out
    depends on the messages alone: not on how they fall into batches, nor on a restart.
    """

    def __init__(self, attempt: Callable[[pd.DataFrame], pd.Series], rules: Retries):
        self.attempt, self.rules = attempt, rules

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("esperan", WAITING)

    def tried(self, rows: pd.DataFrame, passed: int) -> tuple[list[tuple], list[tuple]]:
        """(outcomes, messages that wait on) of messages whose try is due, and of their further ones up to the time that has passed."""
        out, rest = [], []
        while len(rows):
            again = []
            for r, error in zip(rows.itertuples(index=False), self.attempt(rows[["id", "texto", "intentos"]].assign(intentos=rows["intentos"] + 1)), strict=True):
                n, now = int(r.intentos) + 1, int(r.siguiente)
                after = now + self.rules.wait * 1_000_000 * 2 ** (n - 1)
                if error is None or pd.isna(error):
                    out.append((int(r.id), DONE, n, None, now))
                elif n >= self.rules.tries:
                    out.append((int(r.id), GIVEN_UP, n, error, now))
                elif after > int(r.llegada) + self.rules.expiry * 1_000_000:
                    out.append((int(r.id), EXPIRED, n, error, now))
                else:
                    (again if after <= passed else rest).append((int(r.id), r.texto, int(r.llegada), n, after))
            rows = pd.DataFrame(again, columns=COLUMNS)
        return out, rest

    def put(self, rest: list[tuple]) -> None:
        """Sets the state, and the timer in place of the one before."""
        due = min((-(-x[4] // 1000) for x in rest), default=None)
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        known = list(self.handle.listTimers())
        for old in known:
            if old != due:
                self.handle.deleteTimer(old)
        if due is not None and due not in known:
            self.handle.registerTimer(due)

    @staticmethod
    def rows(out: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=["id", "estado", "intentos", "error", "resuelto_at"])
        return frame.astype({"id": "int64", "intentos": "int32"}).assign(resuelto_at=pd.to_datetime(frame["resuelto_at"].astype("int64"), unit="us"))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(x) for x in self.waiting.get()]
        known = {x[0] for x in held}
        for batch in rows:
            # a message that is sent again while it waits is the same one
            batch = batch[~batch["id"].isin(known)].sort_values(["llegada", "texto"]).drop_duplicates("id")
            known |= set(batch["id"])
            out, rest = self.tried(batch.assign(intentos=0, siguiente=batch["llegada"]), timerValues.getCurrentWatermarkInMs() * 1000)
            held += rest
            if out:
                yield self.rows(out)
        self.put(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = [tuple(x) for x in self.waiting.get()]
        out, rest = self.tried(pd.DataFrame([x for x in held if x[4] <= passed], columns=COLUMNS), passed)
        self.put([x for x in held if x[4] > passed] + rest)
        if out:
            yield self.rows(out)

    def close(self) -> None:
        pass


@contextmanager
def rocks(spark: SparkSession):
    """State is kept in RocksDB while a stream starts, as this kind of state needs; the session's setting is put back."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def replayed(messages: DataFrame, attempt: Callable[[pd.DataFrame], pd.Series], rules: Retries = Retries(), delay: str = "1 hour", parts: int = PARTS) -> DataFrame:
    """One row for each message (id, texto, ts) of a stream once it is settled: id, estado, intentos, error, resuelto_at.

    attempt: for some messages (id, texto, intentos: the number of this try) their errors, None for those that succeeded. A message is tried as it comes;
    after a failure it waits rules.wait seconds, then twice as long, and so on, until it succeeds, rules.tries have failed, or the next try
    would be later than rules.expiry after it came. Tries come when the watermark (`delay` behind the latest message) passes their time.
    Null ids and times are left out. A message sent again while it waits counts once; the sink knows those that are settled.
    """
    rows = messages.withColumn("ts", F.col("ts").cast("timestamp")).where("id is not null and ts is not null").withWatermark("ts", delay)
    keyed = rows.select("ts", F.pmod(F.xxhash64("id"), F.lit(parts)).alias("clave"), F.col("id").cast("long").alias("id"), F.col("texto"), F.unix_micros("ts").alias("llegada"))
    return keyed.groupBy("clave").transformWithStateInPandas(statefulProcessor=Replay(attempt, rules), outputStructType=OUTCOME, outputMode="Append", timeMode="EventTime")


def replay_stream(store, messages: DataFrame, attempt: Callable[[pd.DataFrame], pd.Series], checkpoint: str, table: str = "chistes_telegram", rules: Retries = Retries(), delay: str = "1 hour"):
    """Starts the replay of a stream of messages up to now: outcomes go to `<table>_resueltos`, and the ids of good ones are marked as processed, last.

    Both are keyed by id, so a batch that is run again after a loss writes nothing twice, and a message that was settled before keeps its first outcome.
    """

    def batch(df: DataFrame, _: int) -> None:
        store.append_new(df, "bronze", f"{table}_resueltos", F.col("id"), [F.col("resuelto_at")])
        settled = store.read("bronze", f"{table}_resueltos", OUTCOME).join(df.select("id").distinct(), "id", "left_semi")
        store.mark_processed(settled.where(F.col("estado") == DONE), "bronze", table)

    with rocks(store.spark):
        out = replayed(messages, attempt, rules, delay)
        return out.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
