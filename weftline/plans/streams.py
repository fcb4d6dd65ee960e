"""Streaming queries over ``events``, fed in time order and compared with the batch result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftline.plans.registry import query
from weftline.plans.shared import once
from weftline.session import scratch
from weftline.sources.tables import load
from weftline.streaming import sinks as K, sources as S, windows as W
from weftline.streaming.handles import activity
from weftline.streaming.state import keyed_state

DELAY = "1 hour"
FILES_PER_TRIGGER = 1


def _landing(spark, sf_dir) -> str:
    """The whole event table as files in time order."""

    def write(path: str) -> None:
        S.land_in_order(load(spark, sf_dir, "events"), "ts", path)

    return once(spark, sf_dir, "events-landing", write)


def _events(spark, sf_dir, path: str | None = None) -> DataFrame:
    """The stream of events, one file of bounded size per micro-batch."""
    path = path or _landing(spark, sf_dir)
    schema = load(spark, sf_dir, "events").schema
    return S.event_time(S.stream(S.stream_session(spark), path, schema, max_files=FILES_PER_TRIGGER), "ts")


def _to_files(spark, sdf: DataFrame, label: str, by=()) -> DataFrame:
    path = scratch(spark, label)
    K.finish(K.sink(S.zoneless(sdf), path, scratch(spark, "checkpoint"), by))
    return spark.read.parquet(path)


@query("st_file_source", "SELECT * FROM events")
def st_file_source(spark, sf_dir):
    return _to_files(spark, _events(spark, sf_dir), "source")


def clean(df: DataFrame) -> DataFrame:
    """Works on a batch and on a stream alike."""
    return df.where(F.col("value") > 10).select("event_id", "user_id", F.upper("event_type").alias("kind"), "value")


@query(
    "st_filter_project",
    "SELECT event_id, user_id, upper(event_type) AS kind, value FROM events WHERE value > 10",
)
def st_filter_project(spark, sf_dir):
    return _to_files(spark, clean(_events(spark, sf_dir)), "clean")


@query("st_file_sink", "SELECT event_id, user_id, value, event_type FROM events")
def st_file_sink(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "user_id", "value", "event_type")
    return _to_files(spark, rows, "by-type", by=["event_type"])


@query("st_intake", "SELECT count(*) AS rows, true AS bounded, true AS several FROM events")
def st_intake(spark, sf_dir):
    """No micro-batch takes more than its limit: the rows of one file."""
    path, out = scratch(spark, "intake-landing"), scratch(spark, "intake")
    limit = F.greatest(F.lit(250), F.ceil(F.sum("n") / 3))
    S.land_in_order(load(spark, sf_dir, "events"), "ts", path, at_least=4)
    K.finish(K.batch_sink(S.zoneless(_events(spark, sf_dir, path).select("event_id", "ts")), out, scratch(spark, "checkpoint")))
    batches = spark.read.parquet(out).groupBy(K.BATCH).agg(F.count("*").alias("n"))
    return batches.agg(F.sum("n").alias("rows"), (F.max("n") <= limit).alias("bounded"), (F.count("*") > 2).alias("several"))


def counted() -> list[Column]:
    return [F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents")]


COUNTED_SQL = "count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents"
# Windows still open at the last watermark are held back.
CLOSED_SQL = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)"


@query(
    "st_tumbling",
    f"""SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, n, cents FROM
        (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, {COUNTED_SQL} FROM events GROUP BY 1)
        WHERE window_start + INTERVAL 1 DAY <= {CLOSED_SQL}""",
)
def st_tumbling(spark, sf_dir):
    return _to_files(spark, W.tumbling(_events(spark, sf_dir), "ts", "1 day", DELAY, counted()), "tumbling")


@query(
    "st_sliding",
    f"""SELECT window_start, window_start + INTERVAL 2 DAY AS window_end, n, cents FROM
        (SELECT window_start, {COUNTED_SQL} FROM
          (SELECT value, CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start FROM events UNION ALL
           SELECT value, CAST(date_trunc('day', ts) AS TIMESTAMP) - INTERVAL 1 DAY FROM events) GROUP BY 1)
        WHERE window_start + INTERVAL 2 DAY <= {CLOSED_SQL}""",
)
def st_sliding(spark, sf_dir):
    return _to_files(spark, W.sliding(_events(spark, sf_dir), "ts", "2 days", "1 day", DELAY, counted()), "sliding")


@query(
    "st_session",
    f"""SELECT min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end, user_id, {COUNTED_SQL} FROM
        (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS visit FROM
          (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
           FROM events))
        GROUP BY user_id, visit HAVING max(ts) + INTERVAL 6 HOUR <= {CLOSED_SQL}""",
)
def st_session(spark, sf_dir):
    visits = W.sessions(_events(spark, sf_dir), "ts", ["user_id"], "6 hours", DELAY, counted())
    return _to_files(spark, visits, "sessions")


@query(
    "st_late_data",
    """WITH again AS (SELECT ts FROM events WHERE ts < (SELECT date_trunc('day', min(ts)) FROM events) + INTERVAL 7 DAY),
       r AS (SELECT day, CAST(sum(fresh) AS BIGINT) AS accepted, CAST(sum(late) AS BIGINT) AS late FROM
         (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, CAST(ts IS NOT NULL AS INT) AS fresh, CAST(ts IS NULL AS INT) AS late
          FROM events UNION ALL
          SELECT CAST(date_trunc('day', ts) AS TIMESTAMP), 0, 1 FROM again) GROUP BY day)
       SELECT day AS window_start, accepted + late AS received, accepted, late FROM r""",
)
def st_late_data(spark, sf_dir):
    """The first week arrives a second time after everything else; every such row is late and counted.

    A row without a time belongs to no window, is not accepted, and is counted too.
    """
    path, events = scratch(spark, "late-landing"), load(spark, sf_dir, "events")
    S.land_in_order(events, "ts", path)
    week = events.agg((F.date_trunc("day", F.min("ts")) + F.expr("INTERVAL 7 DAYS")).cast("timestamp_ntz")).scalar()
    again = events.where(F.col("ts") < week)
    again.repartition(1).write.mode("append").parquet(path)
    counts = W.tumbling(_events(spark, sf_dir, path), "ts", "1 day", DELAY, [F.count("*").alias("n")])
    out = scratch(spark, "late")
    K.finish(K.upsert_sink(S.zoneless(counts), out, ["window_start"], ["n"], scratch(spark, "checkpoint"), "update"))
    accepted = K.read_upserts(spark, out, ["window_start"])
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start")
    received = spark.read.parquet(path).groupBy(day).agg(F.count("*").alias("n"))
    return K.late_report(received, accepted, ["window_start"])


@query("st_dedup", "SELECT event_id, user_id, event_type, value FROM events")
def st_dedup(spark, sf_dir):
    """Every event arrives twice. Its columns together are the key: a null number alone would be one key for many events."""

    def write(path: str) -> None:
        events = load(spark, sf_dir, "events")
        S.land_in_order(events.unionByName(events), "ts", path)

    path = once(spark, sf_dir, "events-twice", write)
    events = _events(spark, sf_dir, path)
    unique = W.dedup(events, events.columns, "ts", DELAY)
    return _to_files(spark, unique.select("event_id", "user_id", "event_type", "value"), "dedup")


@query(
    "st_enrich",
    "SELECT event_id, user_id, event_type, c_mktsegment AS segment FROM events LEFT JOIN customer ON user_id = c_custkey",
)
def st_enrich(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", "user_id", "event_type")
    static = load(events.sparkSession, sf_dir, "customer")
    users = static.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    return _to_files(spark, W.enrich(events, users, "user_id"), "enriched")


@query(
    "st_interval_join",
    """SELECT v.user_id, v.event_id AS view_id, p.event_id AS purchase_id FROM events v JOIN events p
       ON v.user_id = p.user_id AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 6 HOUR
       WHERE v.event_type = 'view' AND p.event_type = 'purchase'""",
)
def st_interval_join(spark, sf_dir):
    events = _events(spark, sf_dir)
    views = events.where(F.col("event_type") == "view")
    purchases = events.where(F.col("event_type") == "purchase")
    pairs = W.interval_join(
        views.select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts")),
        purchases.select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")),
        "user_id",
        "view_ts",
        "purchase_ts",
        within_seconds=6 * 3600,
        delay=DELAY,
    )
    return _to_files(spark, pairs.select("user_id", "view_id", "purchase_id"), "pairs")


@query(
    "st_keyed_state",
    f"SELECT user_id, n, cents AS amount FROM (SELECT user_id, {COUNTED_SQL} FROM events GROUP BY user_id)",
)
def st_keyed_state(spark, sf_dir):
    events = _events(spark, sf_dir).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    totals = keyed_state(events, "user_id", "cents", "ts", DELAY, idle_seconds=365 * 86_400)
    out = scratch(spark, "totals")
    # A key may be closed and start again in one batch; the open total is the newer one.
    totals = totals.withColumn("open", ~F.col("closed"))
    K.finish(K.upsert_sink(totals, out, ["user_id"], ["open", "n"], scratch(spark, "checkpoint"), "update"))
    return K.read_upserts(spark, out, ["user_id"]).drop("closed", "open")


@query(
    "st_state_handles",
    """WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id, ts IS NULL OR event_id IS NULL ORDER BY ts DESC, event_id DESC) AS back FROM events),
       k AS (SELECT user_id, string_agg(event_type || '=' || c, ',' ORDER BY event_type) AS kinds
             FROM (SELECT user_id, event_type, count(*) AS c FROM events WHERE event_type IS NOT NULL GROUP BY ALL) GROUP BY user_id)
       SELECT e.user_id, count(*) AS n, coalesce(CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT), 0) AS amount,
       coalesce(string_agg(event_id, ',' ORDER BY ts, event_id) FILTER (back <= 3 AND ts IS NOT NULL AND event_id IS NOT NULL), '') AS last_events,
       coalesce(any_value(kinds), '') AS kinds
       FROM e LEFT JOIN k ON e.user_id IS NOT DISTINCT FROM k.user_id GROUP BY e.user_id""",
)
def st_state_handles(spark, sf_dir):
    """Totals, the three newest events and the count per type of each user, in value, list and map state."""
    events = _events(spark, sf_dir).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    seen = activity(events, "user_id", "event_type", "cents", "ts", "event_id", DELAY, last=3, idle_seconds=365 * 86_400)
    out = scratch(spark, "activity")
    # A key may be closed and start again in one batch; the open row is the newer one.
    seen = seen.withColumn("open", ~F.col("closed"))
    K.finish(K.upsert_sink(seen, out, ["user_id"], ["open", "turn"], scratch(spark, "checkpoint"), "update"))
    return K.read_upserts(spark, out, ["user_id"]).drop("closed", "open", "turn")


def _middle_day(events: DataFrame):
    """Midnight halfway between the first and the last event."""
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    return (first + (last - first) / 2).replace(hour=0, minute=0, second=0, microsecond=0)


@query("st_recovery", "SELECT event_id, user_id, event_type, value FROM events")
def st_recovery(spark, sf_dir):
    """The query stops after half of the data and goes on from its checkpoint; a third run finds nothing new."""
    events, path = load(spark, sf_dir, "events"), scratch(spark, "recovery-landing")
    out, checkpoint = scratch(spark, "recovered"), scratch(spark, "checkpoint")
    early = F.coalesce(F.col("ts") < F.lit(_middle_day(events)), F.lit(True))

    def run() -> None:
        rows = _events(spark, sf_dir, path).select("event_id", "user_id", "event_type", "value")
        K.finish(K.sink(rows, out, checkpoint))

    for half in (early, ~early):
        S.land_in_order(events.where(half), "ts", path, at_least=2)
        run()
    run()
    return spark.read.parquet(out)


@query(
    "st_upsert",
    """SELECT user_id, event_id, event_type, ts FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def st_upsert(spark, sf_dir):
    rows = S.zoneless(_events(spark, sf_dir).select("user_id", "event_id", "event_type", "ts"))
    out = scratch(spark, "newest")
    K.finish(K.upsert_sink(rows, out, ["user_id"], ["ts", "event_id"], scratch(spark, "checkpoint")))
    return K.read_upserts(spark, out, ["user_id"])


@query(
    "st_quarantine",
    """SELECT event_id, CASE WHEN event_type = 'error' OR value IS NULL THEN 'value_is_number' WHEN value < 5 THEN 'value_in_range' END AS reason
       FROM events""",
)
def st_quarantine(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", "broken").otherwise(F.col("value").cast("string"))
    raw = _events(spark, sf_dir).select("event_id", text.alias("raw_value"))
    number = F.col("raw_value").try_cast("double")
    rules = {"value_is_number": number.isNotNull(), "value_in_range": number >= 5}
    good, bad = scratch(spark, "good"), scratch(spark, "bad")
    K.finish(K.quarantine_sink(raw, lambda df: W.split_bad(df, rules), good, bad, scratch(spark, "checkpoint")))
    kept = spark.read.parquet(good).select("event_id", F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(spark.read.parquet(bad).select("event_id", "reason"))


@query(
    "st_lambda_view",
    f"SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, {COUNTED_SQL} FROM events GROUP BY 1, 2",
)
def st_lambda_view(spark, sf_dir):
    """History up to a cut-off from the table, everything after it from the stream. Rows without a time are history."""
    events = load(spark, sf_dir, "events")
    cutoff = F.lit(str(_middle_day(events)))
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    history = events.where(F.coalesce(F.col("ts") < cutoff.cast("timestamp_ntz"), F.lit(True)))
    batch = history.groupBy(day, "event_type").agg(*counted())
    recent = _events(spark, sf_dir).where(F.col("ts") >= cutoff.cast("timestamp"))
    speed = W.tumbling(recent, "ts", "1 day", DELAY, counted(), keys=["event_type"])
    speed = S.zoneless(speed.withColumnRenamed("window_start", "day").drop("window_end"))
    out, key = scratch(spark, "speed"), ["day", "event_type"]
    K.finish(K.upsert_sink(speed, out, key, ["n"], scratch(spark, "checkpoint"), "update"))
    sums = [F.sum("n").alias("n"), F.sum("cents").alias("cents")]
    return W.lambda_view(batch, K.read_upserts(spark, out, key), key, sums)
