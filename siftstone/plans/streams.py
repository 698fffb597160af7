"""Registered queries over streams: files made of the events table, read as they come, in runs that end early."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.plans.standin import table
from siftstone.sources.scratch import new_folder
from siftstone.streaming import resume, stalls

QUERIES: dict = {}
ORACLE: dict = {}


def _add(name: str, query, sql: str) -> None:
    QUERIES[name], ORACLE[name] = query, sql


def _arriving(s: SparkSession, d: str) -> tuple[str, str]:
    """(folder, schema) of the events as they come: three deliveries in order of time, each with the last third of the one before."""
    folder, events = new_folder(s, "events"), table(s, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    cut = events.agg(F.expr("percentile_approx(unix_micros(ts), array(0.22, 0.33, 0.55, 0.66), 10000)").alias("q")).first().q or [0] * 4
    at = F.unix_micros("ts")
    for low, high in ((None, cut[1]), (cut[0], cut[3]), (cut[2], None)):
        rows = events if low is None else events.filter(at > low)
        rows = rows if high is None else rows.filter(at <= high)
        rows.repartitionByRange(4, "ts").write.mode("append").parquet(folder)
    return folder, events.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")


def _resumed(s: SparkSession, d: str) -> DataFrame:
    """Runs that end by their row limit, then one that fails midway, then one that does the rest."""
    source, schema = _arriving(s, d)
    sink, checkpoint = new_folder(s, "judged"), new_folder(s, "run")
    judged = lambda rows: rows.select("event_id", "user_id", (F.col("event_type") == "error").alias("bad"))
    run = lambda judge, limit=None: resume.run_available(s, source, schema, judge, sink, checkpoint, "event_id", limit, 2)
    run(judged, 1)
    run(judged, 1)
    tries = []

    def fails(rows: DataFrame) -> DataFrame:
        tries.append(1)
        if len(tries) > 3:  # a batch asks twice: this is in the second
            raise RuntimeError("lost")
        return judged(rows)

    try:
        run(fails)
    except Exception as e:  # the stream reports what its function raised
        if "lost" not in str(e):
            raise
    run(judged)
    return resume.results(s, sink)


_add("r1_k11_o11_resumed", _resumed, "SELECT event_id, user_id, event_type = 'error' AS bad FROM events")


def _limited(s: SparkSession, d: str) -> DataFrame:
    """One run that ends by its limit: rows of the files it has read, each once, and no others."""
    source, schema = _arriving(s, d)
    sink = new_folder(s, "judged")
    n = resume.run_available(s, source, schema, lambda rows: rows, sink, new_folder(s, "run"), "event_id", 1, 100)
    return resume.progress(s, sink, table(s, d, "events")).withColumn("reported", F.lit(n) == F.col("done"))


_add("o11_p19_progress", _limited, "SELECT count(*) AS done, count(*) AS total, 100.0::DOUBLE AS percent, true AS reported FROM events")


def _stalled(s: SparkSession, d: str) -> DataFrame:
    source, schema = _arriving(s, d)
    # A delivery of four files is a batch.
    signs = s.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(source)
    found, sink = stalls.quarantined(signs.select("user_id", "ts"), "40 hours", 2, "2 days", "user_id", "ts"), new_folder(s, "stalled")
    found.writeStream.format("parquet").option("path", sink).option("checkpointLocation", new_folder(s, "run")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return s.read.parquet(sink).select(F.col("item").cast("long").alias("user_id"), F.col("at").cast("timestamp_ntz").alias("stalled_at"))


_add(
    "r4_stalled", _stalled,
    "WITH g AS (SELECT user_id, ts, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), (SELECT max(ts) - INTERVAL 2 DAY FROM events)) AS after FROM events), "
    "s AS (SELECT user_id, ts + INTERVAL 40 HOUR AS stalled_at, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS n FROM g WHERE after > ts + INTERVAL 40 HOUR) SELECT user_id, stalled_at FROM s WHERE n = 2",
)
