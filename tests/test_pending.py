"""The replay stream against the rule in plain Python: whatever the batches, after a restart from its checkpoint, and with repeated messages."""

import datetime
import json
import random

import pandas as pd
import pytest

from lorewright.sources.store import Store
from lorewright.streaming import pending
from lorewright.streaming.pending import Retries

SCHEMA = "id long, chat_id long, texto string, ts timestamp"
START = datetime.datetime(2024, 1, 1)
RULES = Retries(4, 600, 4000)


def attempt(rows: pd.DataFrame) -> pd.Series:
    """A message fails as often as its text says."""
    return pd.Series([None if int(t) < n else f"fallo {n}" for t, n in zip(rows["texto"], rows["intentos"], strict=True)])


def plain(messages, rules=RULES):
    out = {}
    for i, _, texto, ts in messages:
        t, n = ts, 0
        while True:
            n += 1
            after = t + datetime.timedelta(seconds=rules.wait * 2 ** (n - 1))
            if int(texto) < n:
                out[i] = ("procesado", n, None, t)
            elif n >= rules.tries:
                out[i] = ("abandonado", n, f"fallo {n}", t)
            elif after > ts + datetime.timedelta(seconds=rules.expiry):
                out[i] = ("caducado", n, f"fallo {n}", t)
            else:
                t = after
                continue
            break
    return out


def messages(n=60):
    rng = random.Random(4)
    return [(k, k % 3 if k % 7 else None, str(rng.choice([0, 0, 1, 2, 3, 5])), START + datetime.timedelta(seconds=37 * k)) for k in range(n)]


def written(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps({"id": i, "chat_id": c, "texto": t, "ts": ts.isoformat()}) for i, c, t, ts in rows))


def run(spark, store, folder, checkpoint, rules=RULES):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(f"file://{folder}")
    q = pending.replay_stream(store, stream, attempt, f"file://{checkpoint}", rules=rules, delay="1 minute")
    q.awaitTermination()
    return {r.id: (r.estado, r.intentos, r.error, r.resuelto_at) for r in store.read("bronze", "chistes_telegram_resueltos", pending.OUTCOME).collect()}


#: A last message that lets the watermark pass all tries.
LAST = (999, 9, "0", START + datetime.timedelta(days=2))


@pytest.mark.parametrize("files", [1, 4])
def test_any_batches(spark, tmp_path, files):
    rows = messages()
    for k in range(files):
        written(tmp_path / "in", k, rows[k * len(rows) // files : (k + 1) * len(rows) // files])
    written(tmp_path / "in", "z", [LAST])
    store = Store(spark, f"file://{tmp_path}/store")
    got = run(spark, store, tmp_path / "in", tmp_path / "checkpoint")
    assert got == plain([*rows, LAST])
    done = store.read("bronze", "chistes_telegram_procesados", "id long")
    assert {r.id for r in done.collect()} == {i for i, x in got.items() if x[0] == "procesado"}


def test_restart_and_repeats(spark, tmp_path):
    """A second run goes on from the state of the first; messages that are sent again, waiting or settled, count once."""
    rows = messages(30)
    written(tmp_path / "in", "a", rows[:20])
    store = Store(spark, f"file://{tmp_path}/store")
    first = run(spark, store, tmp_path / "in", tmp_path / "checkpoint")
    assert 0 < len(first) < 20
    written(tmp_path / "in", "b", rows[10:])
    written(tmp_path / "in", "z", [LAST])
    assert run(spark, store, tmp_path / "in", tmp_path / "checkpoint") == plain([*rows, LAST])
    assert spark.conf.get(pending._PROVIDER) != pending._ROCKS
