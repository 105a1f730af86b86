"""Scalar functions, one query per family."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.catalogue.registry import TXN, Tables, query
from lakeloom.functions import calendar, text
from lakeloom.operators.aggregates import collect_chunks


@query(
    "f01_trim_case_length",
    """SELECT p_partkey, TRIM('  ' || p_name || ' ') AS trimmed, LTRIM('  ' || p_name) AS left_trimmed, RTRIM(p_name || ' ') AS right_trimmed,
       UPPER(p_name) AS up, LOWER(p_type) AS low, LENGTH(p_name) AS n,
       list_aggregate(list_transform(string_split(p_name, ' '), lambda x: UPPER(x[1]) || LOWER(x[2:])), 'string_agg', ' ') AS title FROM part""",
)
def f01(t: Tables):
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.ltrim(F.concat(F.lit("  "), name)).alias("left_trimmed"),
        F.rtrim(F.concat(name, F.lit(" "))).alias("right_trimmed"),
        F.upper(name).alias("up"),
        F.lower("p_type").alias("low"),
        F.length(name).cast("bigint").alias("n"),
        F.initcap(name).alias("title"),
    )


@query(
    "f02_padding",
    "SELECT p_partkey, LPAD(CAST(p_partkey AS VARCHAR), 8, '0') AS padded, RPAD(p_brand, 12, '_') AS filled FROM part",
)
def f02(t: Tables):
    return t.part.select(
        "p_partkey",
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("padded"),
        F.rpad("p_brand", 12, "_").alias("filled"),
    )


@query(
    "f03_split_substring",
    """SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[2] AS second_word,
       SUBSTRING(p_brand, 1, 5) AS head, string_split(p_brand, '#')[1] AS before_hash FROM part""",
)
def f03(t: Tables):
    words = F.split("p_name", " ")
    return t.part.select(
        "p_partkey",
        F.get(words, F.lit(0)).alias("first_word"),
        F.get(words, F.lit(1)).alias("second_word"),
        F.substring("p_brand", 1, 5).alias("head"),
        F.substring_index("p_brand", "#", 1).alias("before_hash"),
    )


@query(
    "f04_regular_expressions",
    r"""SELECT p_partkey, regexp_extract(p_brand, 'Brand#([0-9]+)', 1) AS number, regexp_replace(p_name, ' [a-z]+$', '') AS head,
       regexp_matches(p_brand, '^Brand#[0-9]{2}$') AS two_digits FROM part""",
)
def f04(t: Tables):
    return t.part.select(
        "p_partkey",
        F.regexp_extract("p_brand", r"Brand#([0-9]+)", 1).alias("number"),
        F.regexp_replace("p_name", r" [a-z]+$", "").alias("head"),
        F.regexp_like("p_brand", F.lit(r"^Brand#[0-9]{2}$")).alias("two_digits"),
    )


@query(
    "f05_locate_translate_overlay",
    """SELECT p_partkey, CAST(instr(p_brand, '#') AS INT) AS hash_at, CAST(instr(p_name, 'e') AS INT) AS e_at,
       translate(p_brand, '#Bd', '-bD') AS translated, LEFT(p_brand, 5) || ':' || SUBSTRING(p_brand, 7) AS overlaid FROM part""",
)
def f05(t: Tables):
    return t.part.select(
        "p_partkey",
        F.instr("p_brand", "#").alias("hash_at"),
        F.locate("e", "p_name").alias("e_at"),
        F.translate("p_brand", "#Bd", "-bD").alias("translated"),
        F.overlay("p_brand", F.lit(":"), 6, 1).alias("overlaid"),
    )


@query(
    "f06_concat_format",
    """SELECT p_partkey, p_brand || '/' || p_type AS joined, concat_ws(' | ', p_name, p_brand) AS piped,
       printf('%s has size %d', p_name, p_size) AS sentence, printf('%05d', p_partkey) AS number FROM part""",
)
def f06(t: Tables):
    return t.part.select(
        "p_partkey",
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
        F.concat_ws(" | ", "p_name", "p_brand").alias("piped"),
        F.format_string("%s has size %d", "p_name", "p_size").alias("sentence"),
        F.printf(F.lit("%05d"), "p_partkey").alias("number"),
    )


@query(
    "f07_digests_encoding",
    """SELECT p_partkey, sha256(p_name) AS sha, md5(p_name) AS md, hex(encode(p_name)) AS bytes, p_name AS decoded FROM part""",
)
def f07(t: Tables):
    return t.part.select(
        "p_partkey",
        F.sha2("p_name", 256).alias("sha"),
        F.md5("p_name").alias("md"),
        F.hex(F.encode("p_name", "UTF-8")).alias("bytes"),
        F.decode(F.encode("p_name", "UTF-8"), "UTF-8").alias("decoded"),
    )


@query(
    "f07_hashes_agree",
    "SELECT COUNT(*) AS n, COUNT(DISTINCT p_partkey) AS distinct_xx, TRUE AS repeatable FROM part",
)
def f07b(t: Tables):
    """Spark's own hashes: no collision of the 64-bit one here, and the same value twice."""
    hashed = t.part.select(
        F.xxhash64("p_partkey").alias("xx"),
        (F.hash("p_name", "p_partkey") == F.hash("p_name", "p_partkey")).alias("same"),
    )
    return hashed.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("xx").alias("distinct_xx"), F.min("same").alias("repeatable")
    )


@query(
    "f08_edit_distance",
    "SELECT p_partkey, CAST(levenshtein(p_name, 'small ring') AS INT) AS distance FROM part",
)
def f08(t: Tables):
    return t.part.select("p_partkey", F.levenshtein("p_name", F.lit("small ring")).alias("distance"))


_CODES = "translate(upper(p_name), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202')"
_SEQUENCE = f"{_CODES}[1] || replace(regexp_replace(substr({_CODES}, 2), '[^0-9]', '0', 'g'), '7', '')"
for _digit in "123456":
    _SEQUENCE = f"regexp_replace({_SEQUENCE}, '{_digit}+', '{_digit}', 'g')"


@query("f08_soundex", f"SELECT p_partkey, upper(p_name[1]) || rpad(left(replace(substr({_SEQUENCE}, 2), '0', ''), 3), 3, '0') AS sound FROM part")
def f08b(t: Tables):
    return t.part.select("p_partkey", F.soundex("p_name").alias("sound"))


@query(
    "f09_words_ngrams",
    r"""WITH w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '[ \t\n\v\f\r]+'), lambda x: x <> '') AS ws FROM conversations)
       SELECT conv_id, turn, len(ws) AS word_count, CASE WHEN len(ws) >= 2 THEN len(ws) - 1 ELSE 0 END AS bigrams,
       CASE WHEN len(ws) >= 2 THEN ws[1] || ' ' || ws[2] END AS first_bigram FROM w""",
)
def f09(t: Tables):
    tokens = t.conversations.select("conv_id", "turn", text.words(F.col("text")).alias("ws"))
    pairs = text.ngrams(F.col("ws"), 2)
    return tokens.select(
        "conv_id",
        "turn",
        F.size("ws").cast("bigint").alias("word_count"),
        F.size(pairs).cast("bigint").alias("bigrams"),
        F.get(pairs, F.lit(0)).alias("first_bigram"),
    )


@query(
    "f09_sentence_words",
    "SELECT conv_id, turn, 'Turn ' || turn || ' of ' || role || '|It has ' || length(text) || ' signs|Is it so' AS words FROM conversations",
)
def f09c(t: Tables):
    """Sentences and their words, of a text whose grammar is known."""
    said = F.concat(F.lit("Turn "), "turn", F.lit(" of "), "role", F.lit(". It has "), F.length("text"), F.lit(" signs. Is it so?"))
    lines = F.transform(F.sentences(said), lambda words: F.array_join(words, " "))
    return t.conversations.select("conv_id", "turn", F.array_join(lines, "|").alias("words"))


@query("f09_sentences")
def f09b(t: Tables):
    return t.conversations.select("conv_id", "turn", F.size(F.sentences("text")).alias("n_sentences"))


@query(
    "f10_parse_dates",
    """SELECT o_orderkey, CAST(o_orderdate::DATE AS VARCHAR) AS d, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts,
       CAST(epoch(o_orderdate) AS BIGINT) AS epoch, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate::DATE AS VARCHAR) END AS safe FROM orders""",
)
def f10(t: Tables):
    from lakeloom.functions.cleaning import to_date

    written = t.orders.select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss").alias("s"))
    stamp = F.to_timestamp("s", "dd/MM/yyyy HH:mm:ss")
    epoch = F.unix_timestamp("s", "dd/MM/yyyy HH:mm:ss")
    maybe = F.when(F.col("o_orderkey") % 3 == 0, "31/02/1999x").otherwise(F.substring("s", 1, 10))
    return written.select(
        "o_orderkey",
        F.to_date("s", "dd/MM/yyyy HH:mm:ss").cast("string").alias("d"),
        F.from_unixtime(F.unix_timestamp(stamp)).alias("ts"),
        epoch.alias("epoch"),
        to_date(maybe, "dd/MM/yyyy").cast("string").alias("safe"),
    )


@query("f11_current_moment", "SELECT COUNT(*) AS n, TRUE AS consistent FROM nation")
def f11(t: Tables):
    """The current date and time are fixed for a whole query."""
    same = (F.current_timestamp() == F.now()) & (F.to_date(F.current_timestamp()) == F.current_date())
    return t.nation.agg(F.count(F.lit(1)).alias("n"), F.min(same).alias("consistent"))


@query(
    "f12_date_parts",
    """SELECT event_id, CAST(year(ts) AS INT) AS y, CAST(month(ts) AS INT) AS m, CAST(day(ts) AS INT) AS d, CAST(dayofweek(ts) + 1 AS INT) AS dow, CAST(dayofyear(ts) AS INT) AS doy,
       CAST(quarter(ts) AS INT) AS q, CAST(weekofyear(ts) AS INT) AS w, CAST(hour(ts) AS INT) AS h, CAST(minute(ts) AS INT) AS mi, CAST(second(ts) AS INT) AS s FROM events""",
)
def f12(t: Tables):
    parts = {
        "y": F.year, "m": F.month, "d": F.dayofmonth, "dow": F.dayofweek, "doy": F.dayofyear, "q": F.quarter,
        "w": F.weekofyear, "h": F.hour, "mi": F.minute, "s": F.second,
    }
    return t.events.select("event_id", *[f("ts").alias(n) for n, f in parts.items()])


@query(
    "f13_date_arithmetic",
    """SELECT o_orderkey, CAST(d + 7 AS VARCHAR) AS next_week, CAST(d - 30 AS VARCHAR) AS month_ago,
       CAST((d + INTERVAL 3 MONTH)::DATE AS VARCHAR) AS next_quarter, CAST(DATE '2002-01-01' - d AS INT) AS days_since,
       CAST(datediff('hour', o_orderdate, TIMESTAMP '2002-01-01') AS BIGINT) AS hours_since,
       CAST(datediff('month', date_trunc('month', d), DATE '2002-01-01') AS DOUBLE) AS months_from_start
       FROM (SELECT *, o_orderdate::DATE AS d FROM orders)""",
)
def f13(t: Tables):
    day, end = F.to_date("o_orderdate"), F.lit("2002-01-01").cast("date")
    hours = F.timestamp_diff("HOUR", F.col("o_orderdate").cast("timestamp"), F.lit("2002-01-01").cast("timestamp"))
    return t.orders.select(
        "o_orderkey",
        F.date_add(day, 7).cast("string").alias("next_week"),
        F.date_sub(day, 30).cast("string").alias("month_ago"),
        F.add_months(day, 3).cast("string").alias("next_quarter"),
        F.datediff(end, day).alias("days_since"),
        hours.alias("hours_since"),
        F.months_between(end, F.trunc(day, "month")).alias("months_from_start"),
    )


@query(
    "f14_date_format",
    """SELECT event_id, strftime(ts, '%d/%m/%Y') AS uk, strftime(ts, '%B %Y') AS month_year, strftime(ts, '%a') AS weekday,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS iso FROM events""",
)
def f14(t: Tables):
    forms = {"uk": "dd/MM/yyyy", "month_year": "MMMM yyyy", "weekday": "E", "iso": "yyyy-MM-dd HH:mm:ss"}
    return t.events.select("event_id", *[F.date_format("ts", p).alias(n) for n, p in forms.items()])


@query(
    "f15_truncate_last_next_day",
    """SELECT event_id, strftime(date_trunc('month', ts), '%Y-%m-%d') AS month_start, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start,
       strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour_start, CAST(last_day(ts) AS VARCHAR) AS month_end,
       CAST((date_trunc('week', ts) + INTERVAL 7 DAY)::DATE AS VARCHAR) AS next_monday FROM events""",
)
def f15(t: Tables):
    return t.events.select(
        "event_id",
        F.trunc("ts", "month").cast("string").alias("month_start"),
        F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("week_start"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH").alias("hour_start"),
        F.last_day("ts").cast("string").alias("month_end"),
        F.next_day("ts", "Monday").cast("string").alias("next_monday"),
    )


@query(
    "f16_time_zones",
    """SELECT event_id, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS ist, strftime(ts - INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS utc FROM events""",
)
def f16(t: Tables):
    at, form = F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"
    return t.events.select(
        "event_id",
        F.date_format(F.from_utc_timestamp(at, "Asia/Kolkata"), form).alias("ist"),
        F.date_format(F.to_utc_timestamp(at, "Asia/Kolkata"), form).alias("utc"),
    )


@query(
    "f17_make_date_timestamp",
    """SELECT event_id, CAST(make_date(year(ts), month(ts), 1) AS VARCHAR) AS first_day,
       strftime(make_timestamp(year(ts), month(ts), day(ts), hour(ts), 30, 0.0), '%Y-%m-%d %H:%M:%S') AS half_past FROM events""",
)
def f17(t: Tables):
    half = F.make_timestamp(
        years=F.year("ts"), months=F.month("ts"), days=F.dayofmonth("ts"), hours=F.hour("ts"), mins=F.lit(30), secs=F.lit(0)
    )
    return t.events.select(
        "event_id",
        F.make_date(F.year("ts"), F.month("ts"), F.lit(1)).cast("string").alias("first_day"),
        F.date_format(half, "yyyy-MM-dd HH:mm:ss").alias("half_past"),
    )


@query(
    "f18_fiscal_calendar",
    f"""WITH {TXN} SELECT txn_id, CAST(CASE WHEN month(txn_date) >= 4 THEN year(txn_date) ELSE year(txn_date) - 1 END AS INT) AS fiscal_year,
        CASE WHEN month(txn_date) IN (4, 5, 6) THEN 'Q1' WHEN month(txn_date) IN (7, 8, 9) THEN 'Q2' WHEN month(txn_date) IN (10, 11, 12) THEN 'Q3' ELSE 'Q4' END AS fiscal_quarter,
        dayofweek(txn_date) IN (0, 6) AS is_weekend, CAST(last_day(txn_date) - txn_date AS INT) AS days_to_month_end FROM txn""",
)
def f18(t: Tables):
    day = F.col("txn_date")
    return t.txn.select(
        "txn_id",
        calendar.fiscal_year(day).alias("fiscal_year"),
        calendar.fiscal_quarter(day).alias("fiscal_quarter"),
        calendar.is_weekend(day).alias("is_weekend"),
        calendar.days_to_month_end(day).alias("days_to_month_end"),
    )


@query(
    "f19_structs",
    "SELECT p_partkey, p_name AS name, UPPER(p_brand) AS brand, p_retailprice AS price, 'shelf' AS place FROM part",
)
def f19(t: Tables):
    nested = t.part.select(
        "p_partkey",
        F.struct(F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price")).alias("item"),
    )
    rebuilt = nested.withColumn(
        "item", F.col("item").withField("brand", F.upper("item.brand")).withField("place", F.lit("shelf"))
    )
    return rebuilt.select("p_partkey", "item.*")


SIZE = 1000
LINE_ORDER = ["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_suppkey", "l_discount", "l_tax", "l_shipdate"]


def orders_with_items(t: Tables):
    """Orders with an array of item structs; an order of more than ``SIZE`` items continues
    on further rows (``chunk`` 1, 2, ...)."""
    item = F.struct(
        F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("sku"), F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
    )
    order = [F.col(c) for c in LINE_ORDER]
    lines = collect_chunks(t.lineitem, ["l_orderkey"], item, order, SIZE)
    joined = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", "o_custkey", "chunk", "items")


@query(
    "f20_explode_outer",
    "SELECT o_orderkey, l_partkey AS sku, l_quantity AS qty FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey",
)
def f20(t: Tables):
    exploded = orders_with_items(t).select("o_orderkey", F.explode_outer("items").alias("item"))
    return exploded.select("o_orderkey", "item.sku", "item.qty")


@query(
    "f20_posexplode",
    """SELECT l_orderkey AS o_orderkey, CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 AS INT) AS pos,
       l_partkey AS sku FROM lineitem""",
)
def f20b(t: Tables):
    exploded = orders_with_items(t).select("o_orderkey", "chunk", F.posexplode("items").alias("p", "item"))
    pos = (F.col("chunk") * SIZE + F.col("p")).cast("int").alias("pos")
    return exploded.select("o_orderkey", pos, "item.sku")


@query("f20_lateral_view", "SELECT l_orderkey AS o_orderkey, l_partkey AS sku, l_extendedprice AS price FROM lineitem")
def f20c(t: Tables):
    orders_with_items(t).createOrReplaceTempView("loom_order_items")
    return t.spark.sql("SELECT o_orderkey, item.sku, item.price FROM loom_order_items LATERAL VIEW explode(items) x AS item")


@query(
    "f21_array_functions",
    """SELECT doc_id, len(a) AS n, a[1] AS first, list_contains(a, 'the') AS has_the, list_sort(a)[1] AS smallest, list_slice(a, 1, 2)[2] AS second
       FROM (SELECT doc_id, string_split(text, ' ') AS a FROM documents)""",
)
def f21(t: Tables):
    a = F.split("text", " ")
    nested = F.flatten(F.array(F.slice(a, 1, 1), F.slice(a, 2, 1)))
    return t.documents.select(
        "doc_id",
        F.array_size(a).cast("bigint").alias("n"),
        F.get(a, F.lit(0)).alias("first"),
        F.array_contains(a, "the").alias("has_the"),
        F.get(F.sort_array(a), F.lit(0)).alias("smallest"),
        F.get(nested, F.lit(1)).alias("second"),
    )


@query(
    "f22_higher_order_functions",
    """SELECT l_orderkey AS o_orderkey, ROUND(SUM(l_quantity * l_extendedprice), 2) AS total, COUNT(*) FILTER (WHERE l_extendedprice > 50000) AS expensive,
       BOOL_AND(l_quantity > 5) AS all_over_5, BOOL_OR(l_quantity > 45) AS any_over_45, SUM(l_quantity) * 2 AS doubled FROM lineitem GROUP BY 1""",
)
def f22(t: Tables):
    items = F.col("items")
    with_items = orders_with_items(t).where(items.isNotNull())
    total = F.aggregate(items, F.lit(0.0), lambda acc, i: acc + i["qty"] * i["price"])
    doubled = F.transform(items, lambda i: i["qty"] * 2)
    per_chunk = with_items.select(
        "o_orderkey",
        total.alias("total"),
        F.size(F.filter(items, lambda i: i["price"] > 50000)).alias("expensive"),
        F.forall(items, lambda i: i["qty"] > 5).alias("all_over_5"),
        F.exists(items, lambda i: i["qty"] > 45).alias("any_over_45"),
        F.aggregate(doubled, F.lit(0.0), lambda acc, q: acc + q).alias("doubled"),
    )
    return per_chunk.groupBy("o_orderkey").agg(
        F.round(F.sum("total"), 2).alias("total"),
        F.sum("expensive").alias("expensive"),
        F.bool_and("all_over_5").alias("all_over_5"),
        F.bool_or("any_over_45").alias("any_over_45"),
        F.sum("doubled").alias("doubled"),
    )


@query(
    "f23_recollect_array",
    """WITH p AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 AS pos FROM lineitem)
       SELECT l_orderkey AS o_orderkey, pos // 1000 AS chunk, string_agg(CAST(l_partkey * 10 AS VARCHAR), ',' ORDER BY pos) AS skus FROM p GROUP BY 1, 2""",
)
def f23(t: Tables):
    """Explode, change every item, collect again in the old order."""
    flat = orders_with_items(t).select("o_orderkey", "chunk", F.posexplode("items").alias("pos", "item"))
    changed = flat.select("o_orderkey", "chunk", F.struct("pos", (F.col("item.sku") * 10).cast("string").alias("sku")).alias("p"))
    again = changed.groupBy("o_orderkey", "chunk").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    return again.select("o_orderkey", "chunk", F.array_join(F.transform("ps", lambda p: p["sku"]), ",").alias("skus"))


@query(
    "f24_maps",
    """SELECT p_partkey, p_brand AS brand, 'brand,type' AS keys, p_brand || ',' || p_type AS vals, TRUE AS has_type, 2 AS size FROM part""",
)
def f24(t: Tables):
    m = F.create_map(F.lit("brand"), "p_brand", F.lit("type"), "p_type")
    return t.part.select("p_partkey", m.alias("m")).select(
        "p_partkey",
        F.col("m")["brand"].alias("brand"),
        F.array_join(F.map_keys("m"), ",").alias("keys"),
        F.array_join(F.map_values("m"), ",").alias("vals"),
        F.map_contains_key("m", "type").alias("has_type"),
        F.size("m").alias("size"),
    )


@query(
    "f24_explode_map",
    "SELECT p_partkey, 'brand' AS key, p_brand AS value FROM part UNION ALL SELECT p_partkey, 'type', p_type FROM part",
)
def f24b(t: Tables):
    m = F.create_map(F.lit("brand"), "p_brand", F.lit("type"), "p_type")
    return t.part.select("p_partkey", F.explode(m).alias("key", "value"))


@query(
    "f25_map_construction",
    "SELECT p_partkey, p_name AS from_arrays, p_brand AS from_entries FROM part",
)
def f25(t: Tables):
    arrays = F.map_from_arrays(F.array(F.lit("name"), F.lit("brand")), F.array("p_name", "p_brand"))
    entries = F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("key"), F.col(c).alias("value")) for k, c in (("brand", "p_brand"), ("type", "p_type"))]))
    return t.part.select("p_partkey", arrays["name"].alias("from_arrays"), entries["brand"].alias("from_entries"))


@query(
    "f26_from_json_to_json",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, '{"id":' || event_id || ',"k":' || json_extract(props, '$.k') || '}' AS again FROM events""",
)
def f26(t: Tables):
    parsed = t.events.select("event_id", F.from_json("props", "k int").alias("p"))
    again = F.to_json(F.struct(F.col("event_id").alias("id"), "p.k"))
    return parsed.select("event_id", "p.k", again.alias("again"))


@query(
    "f27_json_path",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS by_path, CAST(json_extract(props, '$.k') AS INT) AS by_variant FROM events",
)
def f27(t: Tables):
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("by_path"),
        F.variant_get(F.parse_json("props"), "$.k", "int").alias("by_variant"),
    )


@query(
    "f28_arithmetic",
    """SELECT l_orderkey, l_linenumber, ROUND(SUM(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 6) AS charge,
       CAST(SUM(CAST(l_quantity AS BIGINT) % 7) AS BIGINT) AS odd, MAX(ABS(l_discount - 0.05)) AS gap FROM lineitem GROUP BY 1, 2""",
)
def f28(t: Tables):
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.round(F.sum(charge), 6).alias("charge"),
        F.sum(F.col("l_quantity").cast("bigint") % 7).alias("odd"),
        F.max(F.abs(F.col("l_discount") - 0.05)).alias("gap"),
    )


@query(
    "f29_deep_json_order",
    """SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS sku, l_quantity AS qty,
       ROUND(SUM(l_quantity * l_extendedprice) OVER (PARTITION BY l_orderkey), 2) AS order_total FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def f29(t: Tables):
    """Orders as nested JSON text, parsed and flattened to one row per item."""
    as_json = orders_with_items(t).where(F.col("items").isNotNull()).select(
        F.to_json(F.struct(F.col("o_orderkey").alias("order_id"), F.struct(F.col("o_custkey").alias("id")).alias("customer"), "items")).alias("line")
    )
    schema = "order_id bigint, customer struct<id:bigint>, items array<struct<sku:bigint, qty:double, price:double>>"
    parsed = as_json.select(F.from_json("line", schema).alias("o")).select("o.*")
    line_total = F.aggregate("items", F.lit(0.0), lambda acc, i: acc + i["qty"] * i["price"])
    totals = parsed.groupBy("order_id").agg(F.round(F.sum(line_total), 2).alias("order_total"))
    flat = parsed.select("order_id", F.col("customer.id").alias("customer_id"), F.explode("items").alias("i"))
    return flat.join(totals, "order_id").select("order_id", "customer_id", "i.sku", "i.qty", "order_total")
