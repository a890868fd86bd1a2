"""Online scoring on the N-th click (P-09, P-10, A-10, A-11).

Clicks arrive as a stream (any Structured Streaming source with the click
schema). Per session, a keyed state counts the clicks and keeps at most the
first N of them; exactly when the count reaches N (and the session has not
fired before) the N clicks are emitted once. Later clicks never re-trigger.
State and progress live in the checkpoint, so a restarted query neither
loses counts nor fires twice. Buffered clicks are kept as typed Arrow data,
so they leave the state as they came. Emitted sessions are scored per
micro-batch with batch DataFrame code; a micro-batch owns one folder of the
sink and overwrites it, so a replayed batch changes nothing.

Inside one micro-batch clicks are ordered by (order, ts); across batches
arrival order rules, as clicks are numbered on arrival.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegerType, StructField, StructType

STATE_SCHEMA = "count LONG, fired BOOLEAN, buffer BINARY"


def _freeze(rows: pd.DataFrame) -> bytes:
    """Rows as Arrow IPC bytes: types, time stamps and null markers survive unchanged."""
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _thaw(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


def _fire_once(n: int, columns: list[str]):
    """State step: at most ``n`` clicks of a session are held at any time."""
    order = [c for c in ("order", "ts") if c in columns]

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState):
        count, fired, data = state.get if state.exists else (0, False, b"")
        kept = _thaw(bytes(data)) if data else None
        new = None  # the first clicks of this micro-batch that still fit
        room = 0 if fired else n - (0 if kept is None else len(kept))
        for part in batches:
            count += len(part)
            if room > 0:
                new = part if new is None else pd.concat([new, part], ignore_index=True)
                new = new.sort_values(order, kind="stable").head(room) if order else new.head(room)
        if new is not None and len(new):
            kept = new.reset_index(drop=True) if kept is None else pd.concat([kept, new], ignore_index=True)
        if fires := not fired and kept is not None and len(kept) >= n:
            yield kept.assign(click_count=list(range(1, n + 1)))
        fired = bool(fired or fires)
        state.update((int(count), fired, b"" if fired or kept is None else _freeze(kept)))
    return step


def nth_click_stream(clicks: DataFrame, n: int = 5) -> DataFrame:
    """P-09: streaming DataFrame of the first ``n`` clicks of every session,
    emitted once when the session reaches its ``n``-th click."""
    from clickweave.session import ship_package

    ship_package(clicks.sparkSession)
    columns = clicks.columns
    out_schema = StructType(list(clicks.schema.fields) + [StructField("click_count", IntegerType())])
    return clicks.groupBy("session_id").applyInPandasWithState(
        _fire_once(n, columns), outputStructType=out_schema, stateStructType=STATE_SCHEMA,
        outputMode="append", timeoutConf=GroupStateTimeout.NoTimeout)


def batch_folder(sink_path: str, batch_id: int) -> str:
    """The sink folder a micro-batch owns; readers of ``sink_path`` see ``batch_id`` as a column."""
    return f"{sink_path.rstrip('/')}/batch_id={batch_id}"


def read_sink(spark: SparkSession, sink_path: str, schema: str | StructType) -> DataFrame:
    """All rows of a sink; no rows if no micro-batch has written to it."""
    try:
        found = spark.read.schema(schema).parquet(sink_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return found.drop("batch_id")


def score_and_merge(score_fn, sink_path: str):
    """P-10 / A-11: ``foreachBatch`` body: score the emitted sessions with
    batch code, one prediction row per session, into the folder of this batch.
    ``foreachBatch`` runs at least once per batch: a repeated run overwrites
    the same folder. The batch is persisted, so the state step runs once."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                score_fn(batch).write.mode("overwrite").parquet(batch_folder(sink_path, batch_id))
        finally:
            batch.unpersist()
    return run


def start(clicks: DataFrame, score_fn, sink_path: str, checkpoint: str, n: int = 5, trigger_once: bool = True):
    writer = nth_click_stream(clicks, n).writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        score_and_merge(score_fn, sink_path))
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.start()


def validated_click_stream(clicks: DataFrame, sink_path: str, quarantine_path: str, checkpoint: str):
    """A-10: validate every arriving click (B-07 rules); valid rows and the
    quarantine (with the failed rules) go to separate sinks per micro-batch."""
    from clickweave.operators.clean import validate_clicks

    def run(batch: DataFrame, batch_id: int) -> None:
        checked = validate_clicks(batch).persist()
        try:
            for path, valid in ((sink_path, 1), (quarantine_path, 0)):
                checked.where(F.col("is_valid") == valid).write.mode("overwrite").parquet(batch_folder(path, batch_id))
        finally:
            checked.unpersist()

    return (clicks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
            .trigger(availableNow=True).start())
