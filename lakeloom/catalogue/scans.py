"""Sources and sinks: every query writes rows of the tables somewhere and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.catalogue.registry import TXN, Tables, query
from lakeloom.operators.layout import source_profile
from lakeloom.operators.merge import replace_partitions
from lakeloom.operators.ordered import row_positions
from lakeloom.session import stage, workspace
from lakeloom.sources import files, landing, messages
from lakeloom.sources import tables as table_io

ORDERS_SCHEMA = "o_orderkey bigint, o_orderdate date, o_totalprice double, o_orderpriority string"
ORDERS_SQL = "SELECT o_orderkey, CAST(o_orderdate::DATE AS VARCHAR) AS o_orderdate, o_totalprice, o_orderpriority FROM orders"


def orders(t: Tables):
    return t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice", "o_orderpriority")


def shown(df):
    return df.select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"), "o_totalprice", "o_orderpriority")


def fresh_name(t: Tables, kind: str) -> tuple[str, str]:
    path = workspace(t.spark, kind)
    return f"loom_{kind}_{path.rsplit('-', 1)[1]}", path


@query("s01_rows_with_schema", "SELECT COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def s01(t: Tables):
    """A small list made in the program, joined to a table."""
    wanted = t.spark.createDataFrame([("1-URGENT", 1), ("2-HIGH", 2)], "priority string, rank int")
    hit = t.orders.join(wanted, F.col("o_orderpriority") == F.col("priority"), "left_semi")
    return hit.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s02_csv_read", "SELECT o_orderkey, CAST(o_orderdate::DATE AS VARCHAR) AS o_orderdate, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 7 = 0 THEN 'say \"hi\", you' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def s02(t: Tables):
    path = workspace(t.spark, "csv")
    k = F.col("o_orderkey")
    printed = orders(t).select(
        "o_orderkey",
        "o_orderdate",
        F.when(k % 9 == 0, "NULL").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(k % 7 == 0, 'say "hi", you').otherwise(F.concat(F.lit("  "), F.col("o_orderpriority"))).alias("o_orderpriority"),
    )
    printed.write.options(header="true", escape='"', ignoreLeadingWhiteSpace="false").csv(path)
    return shown(files.read_csv(t.spark, path, ORDERS_SCHEMA))


BAD_LINES = "o_orderkey % 50 = 3"


def bad_csv(t: Tables) -> str:
    path = workspace(t.spark, "bad-csv")
    bad = F.col("o_orderkey") % 50 == 3
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.when(bad, "oops").otherwise(F.col("o_totalprice").cast("string")))
    t.orders.select(line).write.text(path)
    return path


@query("s03_corrupt_row_split", f"SELECT 'good' AS part, COUNT(*) AS n FROM orders WHERE NOT {BAD_LINES} UNION ALL SELECT 'bad', COUNT(*) FROM orders WHERE {BAD_LINES} UNION ALL SELECT 'kept_by_drop', COUNT(*) FROM orders WHERE NOT {BAD_LINES}")
def s03(t: Tables):
    path = bad_csv(t)
    schema = "o_orderkey bigint, o_totalprice double"
    df = files.read_csv(t.spark, path, f"{schema}, {files.CORRUPT} string", header="false", columnNameOfCorruptRecord=files.CORRUPT, multiLine="false")
    good, bad = files.split_corrupt(stage(df))
    dropped = files.read_csv(t.spark, path, schema, header="false", mode="DROPMALFORMED", multiLine="false")
    n = F.count("o_orderkey")
    out = good.agg(F.lit("good").alias("part"), n.alias("n"))
    out = out.unionByName(bad.agg(F.lit("bad").alias("part"), F.count(files.CORRUPT).alias("n")))
    return out.unionByName(dropped.where(F.col("o_totalprice").isNotNull()).agg(F.lit("kept_by_drop").alias("part"), n.alias("n")))


@query("s04_wildcard_read", ORDERS_SQL + " WHERE YEAR(o_orderdate) IN (1996, 1997)")
def s04(t: Tables):
    path = workspace(t.spark, "by-year")
    table_io.write_parquet(orders(t).withColumn("y", F.year("o_orderdate")), path, partition_by=["y"])
    return shown(files.read_parquet(t.spark, [f"{path}/y=1996", f"{path}/y=199[7]"]))


@query("s05_parquet_pruned_read", ORDERS_SQL + " WHERE YEAR(o_orderdate) = 1998 AND o_totalprice > 400000")
def s05(t: Tables):
    path = workspace(t.spark, "pruned")
    table_io.write_parquet(orders(t).withColumn("y", F.year("o_orderdate")), path, partition_by=["y"])
    enforced = orders(t).withColumn("y", F.lit(1)).schema
    return shown(files.read_parquet(t.spark, path, enforced).where("y = 1998 AND o_totalprice > 400000"))


@query("s06_parquet_compression", "SELECT UNNEST(['snappy', 'gzip', 'zstd']) AS codec, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders")
def s06(t: Tables):
    out = None
    for codec in ("snappy", "gzip", "zstd"):
        path = workspace(t.spark, codec)
        table_io.write_parquet(orders(t), path, compression=codec)
        one = t.spark.read.parquet(path).agg(F.lit(codec).alias("codec"), F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
        out = one if out is None else out.unionByName(one)
    return out


#: Customers in one multi-line document: few folders, and a document that one task can parse.
PEOPLE_PER_DOCUMENT = 50_000


@query("s07_json_lines", ORDERS_SQL)
def s07(t: Tables):
    path = workspace(t.spark, "json")
    orders(t).write.json(path)
    return shown(files.read_json(t.spark, path, ORDERS_SCHEMA))


@query("s07_json_multi_line", "SELECT c_custkey, c_name FROM customer")
def s07b(t: Tables):
    """Pretty-printed documents of up to ``PEOPLE_PER_DOCUMENT`` customers, a folder each."""
    path = workspace(t.spark, "json-documents")
    member = F.struct("c_custkey", "c_name")
    documents = t.customer.groupBy(F.floor(F.col("c_custkey") / PEOPLE_PER_DOCUMENT).alias("bucket")).agg(F.collect_list(member).alias("people"))
    documents.select("bucket", F.to_json(F.struct("people"), {"pretty": "true"}).alias("value")).write.partitionBy("bucket").text(path)
    read = files.read_json(t.spark, path, "people array<struct<c_custkey: bigint, c_name: string>>", multi_line=True)
    return read.select(F.explode("people").alias("p")).select("p.*")


@query("s12_orc", ORDERS_SQL)
def s12(t: Tables):
    path = workspace(t.spark, "orc")
    orders(t).write.orc(path)
    return shown(files.read_orc(t.spark, path))


@query("s13_xml", ORDERS_SQL)
def s13(t: Tables):
    path = workspace(t.spark, "xml")
    orders(t).write.option("rowTag", "order").option("rootTag", "orders").xml(path)
    return shown(files.read_xml(t.spark, path, "order", ORDERS_SCHEMA))


@query("s13_from_xml", "SELECT p_partkey, p_name AS name, p_size AS size FROM part")
def s13b(t: Tables):
    xml = F.concat(F.lit("<p><name>"), "p_name", F.lit("</name><size>"), F.col("p_size").cast("string"), F.lit("</size></p>"))
    return t.part.select("p_partkey", F.from_xml(xml, "name string, size int").alias("x")).select("p_partkey", "x.*")


def message_rows(t: Tables):
    """Events as messages on four partitions, with offsets in order of event id."""
    keyed = t.events.withColumn("p", (F.col("user_id") % 4).cast("int"))
    placed = row_positions(keyed, ["p"], [F.col("event_id")], F.floor(F.col("event_id") / 1_000_000), "pos")
    body = F.to_json(F.struct("event_id", "event_type", F.col("props").alias("payload"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts")))
    return placed.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.col("p").alias("partition"),
        (F.col("pos") - 1).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


EVENT_SCHEMA = "event_id bigint, event_type string, payload string, ts bigint"
OFFSETS = "m AS (SELECT *, CAST(user_id % 4 AS INT) AS partition, ROW_NUMBER() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS pos FROM events)"


@query("s15_message_decode", f"WITH {OFFSETS} SELECT 'events' AS topic, partition, pos AS \"offset\", event_id, event_type, props AS payload, epoch_us(ts) // 1000 AS ts FROM m")
def s15(t: Tables):
    return messages.decode(message_rows(t), EVENT_SCHEMA).drop("message_timestamp")


@query("s16_message_encode", """SELECT CAST(event_id AS VARCHAR) AS key, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS value FROM events""")
def s16(t: Tables):
    return messages.encode(t.events, "event_id", ["event_id", "event_type"])


@query("s17_bounded_replay", f"WITH {OFFSETS} SELECT partition, COUNT(*) AS n, MIN(event_id) AS first_event FROM m WHERE (partition = 0 AND pos >= 10 AND pos < 200) OR (partition = 2 AND pos >= 50) GROUP BY 1")
def s17(t: Tables):
    replayed = messages.decode(messages.within_offsets(message_rows(t), {0: 10, 2: 50}, {0: 200}), EVENT_SCHEMA)
    return replayed.groupBy("partition").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


def messy_lines(t: Tables):
    """JSON lines where some have an unknown field and some a value of the wrong type."""
    k = F.col("event_id")
    fields = F.concat_ws(
        ",",
        F.concat(F.lit('"event_id":'), k.cast("string")),
        F.concat(F.lit('"value":'), F.when(k % 50 == 7, '"high"').otherwise(F.col("value").cast("string"))),
        F.when(k % 20 == 3, '"channel":"web"'),
    )
    return t.events.select(F.when(k % 500 == 11, "not json").otherwise(F.concat(F.lit("{"), fields, F.lit("}"))).alias("line"))


@query(
    "s19_rescued_data",
    """SELECT CASE WHEN event_id % 500 <> 11 THEN event_id END AS event_id, CASE WHEN event_id % 500 <> 11 AND event_id % 50 <> 7 THEN value END AS value,
       CASE WHEN event_id % 500 = 11 THEN 'not json' WHEN event_id % 50 = 7 AND event_id % 20 = 3 THEN '{"channel":"web","value":"high"}'
         WHEN event_id % 50 = 7 THEN '{"value":"high"}' WHEN event_id % 20 = 3 THEN '{"channel":"web"}' END AS _rescued_data FROM events""",
)
def s19(t: Tables):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    return landing.parse_rescuing(messy_lines(t), "line", schema)


@query("s21_ingest_metadata", "SELECT o_orderkey, '2001-08-01' AS batch, 'run-7' AS run_id, TRUE AS has_file FROM orders")
def s21(t: Tables):
    tagged = files.with_ingest_columns(t.orders, "2001-08-01", "run-7")
    return tagged.select(
        "o_orderkey",
        F.col("_batch_date").alias("batch"),
        F.col("_run_id").alias("run_id"),
        (F.col("_source_file").contains("orders.parquet") & F.col("_ingested_at").isNotNull()).alias("has_file"),
    )


@query("s22_append_overwrite", "SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1")
def s22(t: Tables):
    path = workspace(t.spark, "modes")
    half = F.col("o_orderkey") % 2 == 0
    table_io.write_parquet(orders(t), path, "overwrite", ["o_orderpriority"])
    table_io.write_parquet(orders(t).where(half), path, "overwrite", ["o_orderpriority"])
    table_io.write_parquet(orders(t).where(~half), path, "append", ["o_orderpriority"])
    return t.spark.read.parquet(path).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("s23_replace_one_partition", "SELECT CAST(YEAR(o_orderdate) AS INT) AS y, COUNT(*) AS n FROM orders WHERE YEAR(o_orderdate) <> 1997 OR o_totalprice > 250000 GROUP BY 1")
def s23(t: Tables):
    path = workspace(t.spark, "replace")
    dated = orders(t).withColumn("y", F.year("o_orderdate"))
    table_io.write_parquet(dated, path, partition_by=["y"])
    replace_partitions(dated.where("y = 1997 AND o_totalprice > 250000"), path, "y")
    return t.spark.read.parquet(path).groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@query("s24_bucketed_table", "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1")
def s24(t: Tables):
    name, path = fresh_name(t, "bucketed")
    table_io.write_bucketed(t.orders, name, 8, ["o_custkey"], path, ["o_custkey", "o_orderdate"])
    return t.spark.table(name).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("s25_views_and_tables", "SELECT UNNEST(['global', 'session', 'table']) AS kind, COUNT(*) AS n FROM orders")
def s25(t: Tables):
    name, path = fresh_name(t, "named")
    t.orders.createOrReplaceTempView("loom_session_view")
    t.orders.createOrReplaceGlobalTempView("loom_global_view")
    table_io.save_external(t.orders, name, path)
    return t.spark.sql(
        f"""SELECT 'session' AS kind, count(*) AS n FROM loom_session_view
            UNION ALL SELECT 'global', count(*) FROM global_temp.loom_global_view
            UNION ALL SELECT 'table', count(*) FROM {name}"""
    )


@query("s26_managed_vs_external_drop", "SELECT UNNEST(['external', 'managed']) AS kind, UNNEST([COUNT(*), 0]) AS rows_left FROM orders")
def s26(t: Tables):
    """Dropping a managed table deletes its files; dropping an external one keeps them."""
    database, path = fresh_name(t, "drops")
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{path}/db'")
    slim = t.orders.select("o_orderkey")
    slim.write.saveAsTable(f"{database}.managed")
    table_io.save_external(slim, f"{database}.external", f"{path}/external")
    for kind in ("managed", "external"):
        t.spark.sql(f"DROP TABLE {database}.{kind}")
    out = None
    for kind, where in (("managed", f"{path}/db/managed"), ("external", f"{path}/external")):
        left = files.read_if_present(t.spark, where, slim.schema)
        counted = (slim.limit(0) if left is None else left).agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("rows_left"))
        out = counted if out is None else out.unionByName(counted)
    return out


@query("s27_ddl_insert_default", f"WITH {TXN} SELECT txn_id, amount, CASE WHEN txn_id % 2 = 0 THEN 'NEW' ELSE status END AS status FROM txn")
def s27(t: Tables):
    name, path = fresh_name(t, "ddl")
    t.txn.createOrReplaceTempView("loom_txn")
    t.spark.sql(f"CREATE TABLE {name} (txn_id BIGINT, amount DOUBLE, status STRING DEFAULT 'NEW') USING parquet LOCATION '{path}'")
    t.spark.sql(f"INSERT INTO {name} (txn_id, amount) SELECT txn_id, amount FROM loom_txn WHERE txn_id % 2 = 0")
    t.spark.sql(f"INSERT INTO {name} SELECT txn_id, amount, status FROM loom_txn WHERE txn_id % 2 = 1")
    t.spark.sql(f"INSERT INTO {name} VALUES (-1, 0.0, DEFAULT)")
    return t.spark.table(name).where("txn_id >= 0")


@query("s28_ctas_gold", f"WITH {TXN} SELECT payment_mode, COUNT(*) AS n, ROUND(SUM(amount), 2) AS total FROM txn GROUP BY 1")
def s28(t: Tables):
    name, path = fresh_name(t, "ctas")
    t.txn.createOrReplaceTempView("loom_txn")
    return table_io.create_as(
        t.spark, name, "SELECT payment_mode, count(*) AS n, round(sum(amount), 2) AS total FROM loom_txn GROUP BY payment_mode", path
    )


@query("s29_api_pages", "SELECT o_orderkey AS id, o_totalprice AS price FROM orders")
def s29(t: Tables):
    """Saved API responses, half of them with their records under another name."""
    path = workspace(t.spark, "pages")
    page = F.floor(F.col("o_orderkey") / 100).alias("page")
    record = F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    grouped = t.orders.groupBy(page).agg(F.collect_list(record).alias("records"))
    even = F.col("page") % 2 == 0
    lines = grouped.select(F.to_json(F.struct("page", F.when(even, F.col("records")).alias("data"), F.when(~even, F.col("records")).alias("results"))))
    lines.write.text(path)
    item = "array<struct<id: bigint, price: double>>"
    pages = files.read_json(t.spark, path, f"page bigint, data {item}, results {item}")
    return files.explode_pages(pages)


@query("s31_guarded_read", "SELECT 'present' AS source, COUNT(*) AS n FROM orders")
def s31(t: Tables):
    path = workspace(t.spark, "guarded")
    t.orders.limit(0).write.parquet(f"{path}/empty")
    sources = {"present": f"{t.folder}/orders.parquet", "missing": f"{path}/nowhere", "empty": f"{path}/empty"}
    found = {n: files.read_if_present(t.spark, p, t.orders.schema) for n, p in sources.items()}
    assert found["missing"] is None and found["empty"] is None
    return found["present"].agg(F.lit("present").alias("source"), F.count(F.lit(1)).alias("n"))


@query("s32_source_profile", "SELECT CAST(YEAR(o_orderdate) AS INT) AS y, TRUE AS has_files FROM orders GROUP BY 1")
def s32(t: Tables):
    path = workspace(t.spark, "profile")
    table_io.write_parquet(orders(t).withColumn("y", F.year("o_orderdate")), path, partition_by=["y"])
    profile = source_profile(t.spark, path)
    year = F.regexp_extract("directory", "y=([0-9]+)$", 1).cast("int").alias("y")
    return profile.select(year, ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files"))


@query("s33_text_lines", "SELECT COUNT(*) AS lines, CAST(SUM(LENGTH(p_name)) AS BIGINT) AS chars FROM part")
def s33(t: Tables):
    path = workspace(t.spark, "text")
    t.part.select("p_name").write.text(path)
    return t.spark.read.text(path).agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("chars"))
