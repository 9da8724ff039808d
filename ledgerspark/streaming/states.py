"""The status of filings as a keyed state machine, on streams and on tables.

Events (``cik``, ``accession_number``, ``fetch_status``, ``created_at``) of a filing are taken by time, then by event
number. A legal move changes the status; any other event is counted as ``illegal`` and changes nothing. The stream
keeps, for each key, the status as of the watermark and the events after it, so events that come out of order within
the allowed delay give what the whole table gives; older ones are counted as ``late`` and left out, and an
event that comes twice counts once. Nothing but changed keys is written in a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: From a status to those that may follow; the empty one is that of a filing not seen before.
LEGAL = {
    "": ["pending", "processing"], "pending": ["processing", "failed"], "processing": ["completed", "completed_with_errors", "failed"],
    "completed_with_errors": ["processing"], "failed": ["pending", "processing"], "completed": [],
}
MOVES = [f"{a}>{b}" for a, after in LEGAL.items() for b in after]
RESULT = "cik string, fetch_status string, moves long, illegal long, events long, late long, changed_at timestamp"
_STATE = "fetch_status string, moves long, illegal long, events long, late long, changed_at long, recent array<struct<at:long,id:long,status:string>>"


def status_fold(events: DataFrame, key: str = "cik") -> DataFrame:
    """(key, fetch_status, moves, illegal, events, changed_at) of a table of events. Events without key, time or status
    are left out; equal (time, number) counts once. The events of one key are folded in one row."""
    rows = events.where(F.col(key).isNotNull() & F.col("created_at").isNotNull() & F.col("fetch_status").isNotNull())
    one = F.struct(F.col("created_at").alias("at"), F.col("accession_number").alias("id"), F.col("fetch_status").alias("status"))
    rows = rows.dropDuplicates([key, "created_at", "accession_number"]).groupBy(key).agg(F.sort_array(F.collect_list(one)).alias("e"))
    begin = F.struct(F.lit("").alias("s"), F.lit(0).cast("long").alias("moves"), F.lit(None).cast("timestamp").alias("at"))

    def step(acc, x):
        legal = F.concat_ws(">", acc["s"], x["status"]).isin(MOVES)
        return F.when(legal, F.struct(x["status"].alias("s"), (acc["moves"] + 1).alias("moves"), x["at"].alias("at"))).otherwise(acc)

    out = rows.select(key, F.size("e").cast("long").alias("events"), F.aggregate("e", begin, step).alias("r"))
    return out.select(key, F.nullif("r.s", F.lit("")).alias("fetch_status"), "r.moves", (F.col("events") - F.col("r.moves")).alias("illegal"), "events", F.col("r.at").alias("changed_at"))


def _move(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    status, moves, illegal, events, late, changed, recent = state.get if state.exists else ("", 0, 0, 0, 0, -1, [])
    horizon = state.getCurrentWatermarkMs() * 1000
    held = {(at, i): s for at, i, s in recent}
    for b in batches:
        for at, i, s in zip(b["at"], b["id"], b["status"], strict=True):
            if at <= horizon:
                late += 1  # what came before the watermark is folded for good
            else:
                held.setdefault((at, i), s)

    def apply(now: tuple, rows: list) -> tuple:
        status, moves, illegal, events, changed = now
        for (at, _), s in rows:
            legal = s in LEGAL.get(status, [])
            status, moves, illegal, events, changed = (s, moves + 1, illegal, events + 1, at) if legal else (status, moves, illegal + 1, events + 1, changed)
        return status, moves, illegal, events, changed

    rows = sorted(held.items())
    past = [r for r in rows if r[0][0] <= horizon]
    base = apply((status, moves, illegal, events, changed), past)
    state.update((*base[:4], late, base[4], [(at, i, s) for (at, i), s in rows[len(past) :]]))
    status, moves, illegal, events, changed = apply(base, rows[len(past) :])
    yield pd.DataFrame({"cik": [key[0]], "fetch_status": [status or None], "moves": [moves], "illegal": [illegal], "events": [events], "late": [late], "changed_at": [pd.Timestamp(changed, unit="us") if changed >= 0 else pd.NaT]})


def stream_status(events: DataFrame, out: str, checkpoint: str, delay: str = "7 days") -> StreamingQuery:
    """Fold a stream of status events in state; the changed keys of batch n are written below ``out`` as ``batch=n``, which a
    replay of the batch replaces. ``changes`` and ``latest`` read them."""
    rows = events.where("cik is not null and created_at is not null and fetch_status is not null").withWatermark("created_at", delay)
    rows = rows.select("cik", "created_at", F.unix_micros("created_at").alias("at"), F.col("accession_number").cast("long").alias("id"), F.col("fetch_status").alias("status"))
    folded = rows.groupBy("cik").applyInPandasWithState(_move, RESULT, _STATE, "update", GroupStateTimeout.NoTimeout)

    def keep(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}")

    return folded.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def changes(spark: SparkSession, out: str) -> DataFrame:
    """What each batch changed."""
    return spark.read.schema(f"{RESULT}, batch int").parquet(out)


def latest(spark: SparkSession, out: str) -> DataFrame:
    """The newest row of each key."""
    rows = changes(spark, out)
    names = [c for c in rows.columns if c not in ("cik", "batch")]
    return rows.groupBy("cik").agg(F.max_by(F.struct(*names), "batch").alias("r")).select("cik", "r.*")
