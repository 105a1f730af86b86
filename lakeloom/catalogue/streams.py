"""Streaming queries, run over all data present and compared with their batch results.

Each starts an available-now query, waits for it and returns what it wrote. Where several
micro-batches matter, the events are landed slice by slice and the same query is started
again from its checkpoint after each slice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.catalogue.domain import SENSOR, sensors
from lakeloom.catalogue.maintenance import SHOWN, SNAPSHOTS, log, shown
from lakeloom.catalogue.registry import Tables, query
from lakeloom.operators import quality
from lakeloom.plans import marts
from lakeloom.session import stage, workspace
from lakeloom.sources.landing import file_stream
from lakeloom.streaming import batches, joins, keyed, medallion, progress, schemas, sessions, windows
from lakeloom.streaming.run import drain, start_batches, start_files

# The times that cut the events into slices.
CUTS = ("2024-01-11", "2024-01-21")


def stream(t: Tables, name: str = "events", **more):
    """A table as a stream of its files, whether it is one file or a folder of them."""
    return file_stream(t.spark, f"{t.folder}/[{name[0]}]{name[1:]}.parquet", getattr(t, name).schema, **more)


def slices(t: Tables):
    """The events cut at ``CUTS``, in order of time."""
    at = F.col("ts")
    return [t.events.where(at < CUTS[0]), t.events.where((at >= CUTS[0]) & (at < CUTS[1])), t.events.where(at >= CUTS[1])]


def run_to_files(t: Tables, df, name: str, mode: str = "append"):
    path = workspace(t.spark, name)
    drain(start_files(df, f"{path}/data", f"{path}/checkpoint", mode=mode))
    return t.spark.read.schema(df.schema).parquet(f"{path}/data")


def run_over_slices(t: Tables, parts, start) -> list:
    """Land each part, then run ``start(landing)`` to its end; the finished queries."""
    landing = workspace(t.spark, "slices")
    done = []
    for part in parts:
        part.write.mode("append").parquet(landing)
        done.append(drain(start(landing)))
    return done


def stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


WM = "(SELECT MAX(ts) - INTERVAL 10 MINUTE FROM events)"


@query(
    "r01_watermark_drops_late_rows",
    f"""SELECT CAST(ts::DATE AS VARCHAR) AS day, COUNT(*) AS n FROM events GROUP BY 1 HAVING MIN(date_trunc('day', ts)) + INTERVAL 1 DAY <= {WM}""",
)
def r01(t: Tables):
    """Rows ten days late, sent with the second slice, change no count."""
    first, second, third = slices(t)
    late = first.where("event_id % 3 = 0").withColumn("event_id", F.col("event_id") + 1_000_000_000)
    out = workspace(t.spark, "late")

    def start(landing):
        rows = windows.with_watermark(file_stream(t.spark, landing, t.events.schema), "ts", "10 minutes")
        daily = windows.windowed(rows, "ts", "1 day", [], [F.count(F.lit(1)).alias("n")])
        return start_files(daily, f"{out}/data", f"{out}/checkpoint")

    run_over_slices(t, [first, second.unionByName(late.where(F.col("ts") < "2024-01-10")), third], start)
    return t.spark.read.parquet(f"{out}/data").select(F.to_date("window_start").cast("string").alias("day"), "n")


@query(
    "r02_tumbling_window",
    f"""SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, COUNT(*) AS n, ROUND(SUM(value), 2) AS total
        FROM events GROUP BY time_bucket(INTERVAL 6 HOUR, ts), event_type HAVING time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR <= {WM}""",
)
def r02(t: Tables):
    rows = windows.with_watermark(stream(t), "ts", "10 minutes")
    aggregates = [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")]
    out = run_to_files(t, windows.windowed(rows, "ts", "6 hours", ["event_type"], aggregates), "tumbling")
    return out.select(stamp("window_start"), "event_type", "n", "total")


@query(
    "r03_sliding_window_per_vehicle",
    f"""WITH {SENSOR}, w AS (SELECT *, UNNEST([0, 1, 2, 3, 4]) AS i FROM sensor), k AS (SELECT *, date_trunc('minute', ts) - to_minutes(i) AS s FROM w)
        SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, vehicle_id, COUNT(device_id) AS event_count, ROUND(AVG(speed_kmh), 9) AS avg_speed, ROUND(AVG(temperature_c), 9) AS avg_temp,
          ROUND(arg_max(latitude, ts), 4) AS last_latitude, ROUND(arg_max(longitude, ts), 4) AS last_longitude, ROUND(MAX(speed_kmh), 4) AS max_speed, ROUND(MIN(fuel_level_pct), 4) AS min_fuel,
          COUNT(*) FILTER (WHERE speed_kmh > 120) AS speed_violations,
          arg_max(CASE WHEN speed_kmh > 120 OR engine_status <> 'RUNNING' THEN 'CRITICAL' WHEN temperature_c > 45 OR fuel_level_pct < 10 THEN 'WARNING' ELSE 'NORMAL' END, ts) AS current_alert_level
        FROM k GROUP BY s, vehicle_id HAVING s + INTERVAL 5 MINUTE <= {WM}""",
)
def r03(t: Tables):
    rows = windows.with_watermark(sensors(stream(t)), "event_timestamp", "10 minutes")
    out = run_to_files(t, windows.fleet_metrics(marts.sensor_alerts(rows)), "sliding")
    measures = {"avg_speed": 9, "avg_temp": 9, "last_latitude": 4, "last_longitude": 4, "max_speed": 4, "min_fuel": 4}
    return out.select(
        stamp("window_start"), "vehicle_id", "event_count", *[F.round(c, n).alias(c) for c, n in measures.items()], "speed_violations", "current_alert_level"
    )


SESSION_SQL = f"""WITH o AS (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
  g AS (SELECT *, SUM(CASE WHEN before IS NULL OR ts - before >= INTERVAL 2 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM o),
  s AS (SELECT user_id, strftime(MIN(ts), '%Y-%m-%d %H:%M:%S') AS session_start, MAX(ts) AS last, COUNT(*) AS event_count, ROUND(SUM(value), 2) AS total_amount FROM g GROUP BY user_id, g)
  SELECT user_id, session_start, event_count, total_amount FROM s WHERE last + INTERVAL 2 HOUR <= {WM}"""


@query("r04_session_window", SESSION_SQL)
def r04(t: Tables):
    rows = windows.with_watermark(stream(t), "ts", "10 minutes")
    aggregates = [F.count(F.lit(1)).alias("event_count"), F.round(F.sum("value"), 2).alias("total_amount")]
    out = run_to_files(t, windows.sessions(rows, "ts", "2 hours", ["user_id"], aggregates), "sessions")
    return out.select("user_id", stamp("session_start"), "event_count", "total_amount")


@query("g05_r04_stateful_sessions", SESSION_SQL)
def r04b(t: Tables):
    """The same sessions from custom state, which also reports the open ones as they grow."""
    path = workspace(t.spark, "stateful")
    rows = stream(t).select(
        F.col("user_id").cast("string").alias("customer_id"), F.col("ts").cast("timestamp").alias("event_timestamp"), F.col("value").alias("amount")
    )
    tracked = sessions.track_sessions(rows, "10 minutes", 120)
    drain(start_batches(tracked, batches.append_handler(f"{path}/data"), f"{path}/checkpoint", mode="update"))
    ended = t.spark.read.parquet(f"{path}/data").where("session_status = 'TIMED_OUT'")
    return ended.select(F.col("customer_id").cast("bigint").alias("user_id"), stamp("session_start"), "event_count", F.round("total_amount", 2).alias("total_amount"))


@query("r05_stream_deduplication", "SELECT event_id, event_type FROM events")
def r05(t: Tables):
    """Every event lands twice, the copies a slice later; each is passed on once."""
    first, second, third = slices(t)
    out = workspace(t.spark, "dedup")

    def start(landing):
        rows = windows.with_watermark(file_stream(t.spark, landing, t.events.schema), "ts", "40 days")
        return start_files(windows.first_seen(rows, ["event_id"]), f"{out}/data", f"{out}/checkpoint")

    run_over_slices(t, [first, second.unionByName(first), third.unionByName(second).unionByName(third)], start)
    return t.spark.read.parquet(f"{out}/data").select("event_id", "event_type")


LATEST_SQL = "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id"


@query("r06_upsert_per_micro_batch", LATEST_SQL)
def r06(t: Tables):
    """Several files a batch, folded every third batch; the read merges what is left."""
    out, landing = workspace(t.spark, "upsert"), workspace(t.spark, "upsert-landing")
    columns = "event_id bigint, ts timestamp_ntz, user_id bigint, value double"
    table = keyed.keyed_table(t.spark, f"{out}/table", columns, ["user_id"], [F.desc("ts"), F.desc("event_id")], buckets=8, fold_every=3)
    for part in slices(t):
        part.repartition(3).write.mode("append").parquet(landing)
        rows = file_stream(t.spark, landing, t.events.schema, max_files=1)
        drain(start_batches(rows, table.upsert, f"{out}/checkpoint"))
    return table.rows().select("user_id", "event_id", "value")


@query("r07_multi_sink", "SELECT UNNEST(['errors', 'purchases']) AS sink, UNNEST([COUNT(*) FILTER (WHERE event_type = 'error'), COUNT(*) FILTER (WHERE event_type = 'purchase')]) AS n FROM events")
def r07(t: Tables):
    out = workspace(t.spark, "sinks")
    handle = batches.multi_sink_handler(
        {f"{out}/errors": lambda df: df.where("event_type = 'error'"), f"{out}/purchases": lambda df: df.where("event_type = 'purchase'")}
    )
    drain(start_batches(stream(t), handle, f"{out}/checkpoint"))
    counted = [t.spark.read.parquet(f"{out}/{s}").agg(F.lit(s).alias("sink"), F.count(F.lit(1)).alias("n")) for s in ("errors", "purchases")]
    return counted[0].unionByName(counted[1])


@query("r08_replay_safe_batches", "SELECT COUNT(*) AS n, ROUND(SUM(value), 2) AS total FROM events")
def r08(t: Tables):
    """Every batch is delivered twice; its folder is overwritten, so nothing doubles."""
    out = workspace(t.spark, "replay")
    handle = batches.append_handler(f"{out}/data")

    def twice(df, batch_id):
        handle(df, batch_id)
        handle(df, batch_id)

    run_over_slices(t, slices(t), lambda landing: start_batches(file_stream(t.spark, landing, t.events.schema), twice, f"{out}/checkpoint"))
    return t.spark.read.parquet(f"{out}/data").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(
    "r09_multi_source_union",
    "SELECT 'web' AS _source, COUNT(*) AS n, COUNT(*) AS with_user, 0 AS with_turn FROM events UNION ALL SELECT 'chat', COUNT(*), 0, COUNT(*) FROM conversations",
)
def r09(t: Tables):
    web = stream(t).select(F.col("event_id").alias("id"), "user_id")
    chat = stream(t, "conversations").select(F.col("conv_id").alias("id"), F.col("turn").cast("bigint").alias("turn"))
    out = run_to_files(t, joins.union_sources({"web": web, "chat": chat}), "union")
    return out.groupBy("_source").agg(F.count(F.lit(1)).alias("n"), F.count("user_id").alias("with_user"), F.count("turn").alias("with_turn"))


def sides(t: Tables):
    """Views as requests and purchases as answers, two streams of the same source."""
    left = windows.with_watermark(stream(t).where("event_type = 'view'"), "ts", "10 minutes")
    right = windows.with_watermark(stream(t).where("event_type = 'purchase'"), "ts", "10 minutes")
    return (
        left.select(F.col("event_id").alias("view_id"), F.col("user_id").alias("viewer"), F.col("ts").alias("viewed_at")),
        right.select(F.col("event_id").alias("purchase_id"), F.col("user_id").alias("buyer"), F.col("ts").alias("bought_at")),
    )


KEYS = ("viewer", "buyer", "viewed_at", "bought_at", "6 hours")
PAIRS = """v AS (SELECT event_id AS view_id, user_id, ts FROM events WHERE event_type = 'view'), p AS (SELECT event_id AS purchase_id, user_id AS buyer, ts AS bought_at FROM events WHERE event_type = 'purchase')"""


@query("j15_stream_interval_join", f"WITH {PAIRS} SELECT view_id, purchase_id FROM v JOIN p ON user_id = buyer AND bought_at >= ts AND bought_at <= ts + INTERVAL 6 HOUR")
def j15(t: Tables):
    left, right = sides(t)
    return run_to_files(t, joins.interval_join(left, right, *KEYS, salts=2), "interval").select("view_id", "purchase_id")


UNMATCHED_SQL = f"""WITH {PAIRS}, wm AS (SELECT LEAST(MAX(ts) FILTER (WHERE event_type = 'view'), MAX(ts) FILTER (WHERE event_type = 'purchase')) - INTERVAL 10 MINUTE AS wm FROM events)
  SELECT view_id FROM v WHERE ts + INTERVAL 6 HOUR < (SELECT wm FROM wm)
  AND NOT EXISTS (SELECT 1 FROM p WHERE user_id = buyer AND bought_at >= ts AND bought_at <= ts + INTERVAL 6 HOUR)"""


@query("j16_stream_unmatched", UNMATCHED_SQL)
def j16(t: Tables):
    left, right = sides(t)
    return run_to_files(t, joins.unmatched(left, right, *KEYS, salts=2), "unmatched").select("view_id")


@query("r10_interval_join_alerts", UNMATCHED_SQL.replace("SELECT view_id FROM v", "SELECT COUNT(*) AS n, COUNT(DISTINCT view_id) AS views, MIN(view_id) AS first_view FROM v"))
def r10(t: Tables):
    left, right = sides(t)
    alerts = joins.unmatched(left, right, *KEYS, salts=4).withColumn("alert", F.lit("NO_PURCHASE"))
    return run_to_files(t, alerts, "alerts").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("view_id").alias("views"), F.min("view_id").alias("first_view")
    )


@query("j17_stream_static_join", "SELECT event_id, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey")
def j17(t: Tables):
    static = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return run_to_files(t, joins.enrich(stream(t), static, "user_id"), "enrich").select("event_id", "c_mktsegment")


@query(
    "j17_hot_keys_replicated",
    f"""WITH e AS (SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id FROM events)
        SELECT event_id, user_id, c_mktsegment FROM e LEFT JOIN customer ON user_id = c_custkey""",
)
def j17b(t: Tables):
    """One user sends a third of all events; from the second batch on it is known to be hot."""
    out = workspace(t.spark, "enrich-hot")
    static = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    handle = joins.HotEnrichment(f"{out}/data", f"{out}/checkpoint/hot", static, "user_id")
    user = F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("user_id")).alias("user_id")
    parts = [part.select("event_id", "ts", user) for part in slices(t)]
    run_over_slices(t, parts, lambda landing: start_batches(file_stream(t.spark, landing, parts[0].schema), handle, f"{out}/checkpoint"))
    return t.spark.read.parquet(f"{out}/data").select("event_id", "user_id", "c_mktsegment")


@query("r11_alert_stream", f"WITH {SENSOR} SELECT event_id, CASE WHEN engine_status <> 'RUNNING' OR speed_kmh > 120 THEN 'CRITICAL' ELSE 'WARNING' END AS alert_level FROM sensor WHERE engine_status <> 'RUNNING' OR speed_kmh > 120 OR temperature_c > 45 OR fuel_level_pct < 10")
def r11(t: Tables):
    flagged = marts.sensor_alerts(sensors(stream(t)))
    return run_to_files(t, flagged.where("alert_level <> 'NORMAL'").select("event_id", "alert_level"), "alert-stream")


@query("r12_processing_time_trigger", "SELECT COUNT(*) AS n FROM events")
def r12(t: Tables):
    path = workspace(t.spark, "timed")
    running = start_files(stream(t), f"{path}/data", f"{path}/checkpoint", every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return t.spark.read.parquet(f"{path}/data").agg(F.count(F.lit(1)).alias("n"))


@query("r13_progress_metrics", "SELECT COUNT(*) AS rows_in, TRUE AS has_watermark FROM events")
def r13(t: Tables):
    path = workspace(t.spark, "progress")
    rows = windows.with_watermark(stream(t), "ts", "10 minutes")
    daily = windows.windowed(rows, "ts", "1 day", [], [F.count(F.lit(1)).alias("n")])
    name = path.rsplit("/", 1)[1].replace("-", "_")
    with progress.logged_progress(t.spark, f"{path}/log"):
        drain(start_files(daily, f"{path}/data", f"{path}/checkpoint", name=name))
    reports = progress.progress_frame(t.spark, f"{path}/log", name)
    healthy = progress.health(reports, F.lit("2024-02-01").cast("timestamp"))
    return healthy.agg(F.sum("numInputRows").alias("rows_in"), F.max(F.col("watermark_lag_min").isNotNull()).alias("has_watermark"))


@query("r14_checkpoint_resume", "SELECT COUNT(*) AS n, COUNT(DISTINCT event_id) AS ids, 3 AS runs FROM events")
def r14(t: Tables):
    """Three runs from one checkpoint; each takes up only what the earlier ones left."""
    out = workspace(t.spark, "resume")
    runs = run_over_slices(t, slices(t), lambda landing: start_files(file_stream(t.spark, landing, t.events.schema), f"{out}/data", f"{out}/checkpoint"))
    return t.spark.read.parquet(f"{out}/data").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"), F.lit(len(runs)).alias("runs")
    )


@query(
    "r15_streaming_medallion",
    f"""WITH ok AS (SELECT * FROM events WHERE value > 0.5) SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, COUNT(*) AS event_count, ROUND(SUM(value), 2) AS total_value
        FROM ok GROUP BY date_trunc('hour', ts), event_type HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) - INTERVAL 10 MINUTE FROM ok)""",
)
def r15(t: Tables):
    """Bronze to silver to gold as three streams; values up to one half are made invalid."""
    path = workspace(t.spark, "medallion")
    raw = stream(t).withColumn("value", F.when(F.col("value") > 0.5, F.col("value")))
    bronze = medallion.bronze(raw)
    drain(start_files(bronze, f"{path}/bronze", f"{path}/c-bronze"))
    silver = medallion.silver(file_stream(t.spark, f"{path}/bronze", bronze.schema))
    drain(start_files(silver, f"{path}/silver", f"{path}/c-silver"))
    clean = windows.with_watermark(file_stream(t.spark, f"{path}/silver", silver.schema), "ts", "10 minutes")
    drain(start_files(medallion.gold(clean), f"{path}/gold", f"{path}/c-gold"))
    return t.spark.read.parquet(f"{path}/gold").select(stamp("window_start"), "event_type", "event_count", F.round("total_value", 2).alias("total_value"))


@query("r15_streaming_quarantine", "SELECT event_id, 'INVALID_VALUE' AS quarantine_reason FROM events WHERE value <= 0.5")
def r15b(t: Tables):
    raw = stream(t).withColumn("value", F.when(F.col("value") > 0.5, F.col("value")))
    return run_to_files(t, medallion.quarantine(raw), "quarantine").select("event_id", "quarantine_reason")


@query("r16_epoch_millis_to_event_time", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, CAST(ts::DATE AS VARCHAR) AS event_date FROM events")
def r16(t: Tables):
    from lakeloom.functions.calendar import event_time

    raw = stream(t).select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    timed = raw.withColumn("event_time", event_time(F.col("ms")))
    out = run_to_files(t, timed, "epoch")
    return out.select("event_id", stamp("event_time"), F.to_date("event_time").cast("string").alias("event_date"))


@query("d12_change_feed_stream", f"WITH {SNAPSHOTS} SELECT {SHOWN} FROM v1")
def d12(t: Tables):
    """A change log followed as a stream, one commit at a time, into an upserted table."""
    out, changes_log = workspace(t.spark, "feed"), log(t)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in changes_log.schema)
    table = keyed.keyed_table(t.spark, f"{out}/table", columns, ["txn_id"], [F.desc("_commit_version")], buckets=8, fold_every=1)

    def handle(df, batch_id):
        table.upsert(df.where("_change_type <> 'update_preimage'"), batch_id)

    commits = [changes_log.where(F.col("_commit_version") == v) for v in (0, 1)]
    run_over_slices(t, commits, lambda landing: start_batches(file_stream(t.spark, landing, changes_log.schema), handle, f"{out}/checkpoint"))
    return shown(table.rows().where("_change_type <> 'delete'"))


@query("s18_incremental_file_stream", "SELECT COUNT(*) AS n, TRUE AS several_batches FROM events")
def s18(t: Tables):
    """A folder of files taken up one file per micro-batch."""
    landing, path = workspace(t.spark, "files"), workspace(t.spark, "files-out")
    t.events.repartition(3).write.parquet(landing)
    rows = file_stream(t.spark, landing, t.events.schema, max_files=1)
    drain(start_batches(rows, batches.append_handler(f"{path}/data"), f"{path}/checkpoint"))
    return t.spark.read.parquet(f"{path}/data").agg(
        F.count(F.lit(1)).alias("n"), (F.countDistinct("batch_id") > 1).alias("several_batches")
    )


@query(
    "s20_streaming_schema_evolution",
    f"SELECT COUNT(*) AS n, COUNT(event_type) AS typed, COUNT(*) FILTER (WHERE ts >= TIMESTAMP '{CUTS[0]}') AS expected_typed FROM (SELECT event_id, ts, CASE WHEN ts >= TIMESTAMP '{CUTS[0]}' THEN event_type END AS event_type FROM events)",
)
def s20(t: Tables):
    """The second slice brings new columns; the stored schema grows with it."""
    out = workspace(t.spark, "evolving")
    first, second, third = slices(t)
    parts = [first.select("event_id", "ts"), second.select("event_id", "ts", "event_type"), third.select("event_id", "ts", "event_type")]
    landing = workspace(t.spark, "evolving-landing")
    for part in parts:
        store = schemas.SchemaStore(t.spark, f"{out}/checkpoint-schema", parts[0].schema)
        part.write.mode("append").parquet(landing)
        handle = schemas.evolving_handler(f"{out}/data", store, "addNewColumns")
        drain(start_batches(file_stream(t.spark, landing, part.schema), handle, f"{out}/checkpoint"))
    return schemas.stored_rows(t.spark, f"{out}/data", store, "addNewColumns").agg(
        F.count(F.lit(1)).alias("n"), F.count("event_type").alias("typed"), F.count(F.when(F.col("ts") >= CUTS[0], F.lit(1))).alias("expected_typed")
    )


def json_slices(t: Tables):
    """Events as JSON lines: each slice has a field more than the one before."""
    fields = (["event_id", "ts"], ["event_id", "ts", "event_type"], ["event_id", "ts", "event_type", "value"])
    return [part.select(F.to_json(F.struct(*names)).alias("value")) for part, names in zip(slices(t), fields)]


JSON_START = T.StructType().add("event_id", T.LongType()).add("ts", T.StringType())


def evolve_json(t: Tables, mode: str, between=None):
    """Land the slices one by one and start anew from checkpoint and stored schema each time.

    ``between(out, store, failed)`` is asked after every run; it returns whether to try again.
    """
    out, landing = workspace(t.spark, "evolving-json"), workspace(t.spark, "evolving-json-landing")
    for part in json_slices(t):
        part.write.mode("append").text(landing)
        again = True
        while again:
            store = schemas.SchemaStore(t.spark, f"{out}/checkpoint-schema", JSON_START)
            handle = schemas.evolving_json_handler(f"{out}/data", store, mode)
            lines = file_stream(t.spark, landing, T.StructType().add("value", T.StringType()), format="text")
            failed = False
            try:
                drain(start_batches(lines, handle, f"{out}/checkpoint"))
            except StreamingQueryException:
                if between is None:
                    raise
                failed = True
            again = between(out, store, failed) if between else False
    return schemas.stored_rows(t.spark, f"{out}/data", store, mode), store


@query(
    "s20_add_new_columns",
    f"""SELECT COUNT(*) AS n, COUNT(CASE WHEN ts >= TIMESTAMP '{CUTS[0]}' THEN event_type END) AS typed,
          COUNT(CASE WHEN ts >= TIMESTAMP '{CUTS[1]}' THEN value END) AS valued, ROUND(SUM(CASE WHEN ts >= TIMESTAMP '{CUTS[1]}' THEN value END), 2) AS total, 3 AS versions FROM events""",
)
def s20b(t: Tables):
    stored, store = evolve_json(t, "addNewColumns")
    versions = store.versions().agg(F.count(F.lit(1)).cast("int").alias("versions"))
    return stored.agg(
        F.count(F.lit(1)).alias("n"), F.count("event_type").alias("typed"), F.count("value").alias("valued"), F.round(F.sum("value"), 2).alias("total")
    ).join(F.broadcast(versions))


@query(
    "s20_rescue",
    f"""SELECT event_id, CASE WHEN ts >= TIMESTAMP '{CUTS[0]}' THEN event_type END AS rescued_type,
          CASE WHEN ts >= TIMESTAMP '{CUTS[1]}' THEN ROUND(value, 2) END AS rescued_value FROM events""",
)
def s20c(t: Tables):
    stored, _ = evolve_json(t, "rescue")
    lost = lambda name: F.get_json_object("_rescued_data", f"$.{name}")
    return stored.select("event_id", lost("event_type").alias("rescued_type"), F.round(lost("value").cast("double"), 2).alias("rescued_value"))


@query("s20_none", "SELECT COUNT(*) AS n, COUNT(DISTINCT event_id) AS ids, 'event_id,ts' AS columns, 1 AS versions FROM events")
def s20d(t: Tables):
    stored, store = evolve_json(t, "none")
    versions = store.versions().agg(F.count(F.lit(1)).cast("int").alias("versions"))
    return stored.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"), F.lit(",".join(stored.columns)).alias("columns")
    ).join(F.broadcast(versions))


@query(
    "s20_fail_on_new_columns",
    f"""WITH s AS (SELECT CASE WHEN ts < TIMESTAMP '{CUTS[0]}' THEN 1 WHEN ts < TIMESTAMP '{CUTS[1]}' THEN 3 ELSE 5 END AS run FROM events),
          runs AS (SELECT UNNEST([1, 2, 3, 4, 5]) AS run)
        SELECT run, run IN (2, 4) AS failed, (SELECT COUNT(*) FROM s WHERE s.run <= runs.run) AS stored FROM runs""",
)
def s20e(t: Tables):
    """New columns stop the stream before anything is written; once accepted, it goes on."""
    accepted = iter((T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())))
    runs = []

    def between(out, store, failed):
        run = t.spark.read.schema(store.latest()).parquet(f"{out}/data").agg(
            F.lit(len(runs) + 1).alias("run"), F.lit(failed).alias("failed"), F.count(F.lit(1)).alias("stored")
        )
        runs.append(stage(run, "runs"))
        if failed:
            store.accept(T.StructType([next(accepted)]), batch_id=(len(runs) + 1) // 2)
        return failed

    evolve_json(t, "failOnNewColumns", between)
    return reduce(lambda a, b: a.unionByName(b), runs)


@query(
    "q12_stream_expectations",
    f"""WITH b AS (SELECT CASE WHEN ts < TIMESTAMP '{CUTS[0]}' THEN 0 WHEN ts < TIMESTAMP '{CUTS[1]}' THEN 1 ELSE 2 END AS batch_id, COUNT(*) AS rows, COUNT(*) FILTER (WHERE value <= 0.5) AS low, COUNT(*) FILTER (WHERE event_type = 'error') AS err FROM events GROUP BY 1)
        SELECT CAST(batch_id AS BIGINT) AS batch_id, UNNEST(['valid_value', 'no_error']) AS expectation, rows, UNNEST([low, err]) AS failed, rows - (SELECT COUNT(*) FROM events e WHERE (e.value <= 0.5 OR e.event_type = 'error')
          AND CASE WHEN e.ts < TIMESTAMP '{CUTS[0]}' THEN 0 WHEN e.ts < TIMESTAMP '{CUTS[1]}' THEN 1 ELSE 2 END = b.batch_id) AS stored FROM b""",
)
def q12_stream(t: Tables):
    """One row per expectation and micro-batch, next to the rows that were stored."""
    out = workspace(t.spark, "stream-expected")
    handle = quality.expectation_handler(f"{out}/data", f"{out}/log", {"valid_value": "value > 0.5", "no_error": "event_type <> 'error'"}, "drop")
    run_over_slices(t, slices(t), lambda landing: start_batches(file_stream(t.spark, landing, t.events.schema), handle, f"{out}/checkpoint"))
    stored = t.spark.read.parquet(f"{out}/data").groupBy("batch_id").agg(F.count(F.lit(1)).alias("stored"))
    return quality.expectation_results(t.spark, f"{out}/log").join(stored, "batch_id").select("batch_id", "expectation", "rows", "failed", "stored")


@query(
    "s30_sink_output_modes",
    "SELECT UNNEST(['append', 'complete', 'update']) AS mode, COUNT(*) AS n FROM events",
)
def s30(t: Tables):
    """Append to files; complete and update through micro-batches, their last state kept."""
    out = workspace(t.spark, "modes")
    drain(start_files(stream(t), f"{out}/append", f"{out}/c-append"))
    results = [t.spark.read.parquet(f"{out}/append").agg(F.lit("append").alias("mode"), F.count(F.lit(1)).alias("n"))]
    for mode in ("complete", "update"):
        handle = batches.append_handler(f"{out}/{mode}")

        def start(landing, mode=mode, handle=handle):
            counts = file_stream(t.spark, landing, t.events.schema).groupBy("event_type").agg(F.count(F.lit(1)).alias("c"))
            return start_batches(counts, handle, f"{out}/c-{mode}", mode=mode)

        run_over_slices(t, slices(t), start)
        kept = batches.current_rows(t.spark, f"{out}/{mode}", ["event_type"])
        results.append(kept.agg(F.lit(mode).alias("mode"), F.sum("c").alias("n")))
    return results[0].unionByName(results[1]).unionByName(results[2])
