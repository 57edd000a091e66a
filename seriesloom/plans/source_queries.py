"""Queries that write and read: text and JSON sources, lineage, publication, snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.operators import quality as Q
from seriesloom.plans.base import OBS, observations, query, table
from seriesloom.sources import tables as IO
from seriesloom.streaming import incremental as T


@query("source_text_table", """SELECT c_mktsegment AS segment, count(*) AS n, min(c_name) AS first_name, count(*) FILTER (WHERE contains(c_name || chr(10) || c_mktsegment, chr(10))) AS with_line_end FROM customer GROUP BY 1""")
def source_text_table(spark, d):
    """Customers as delimited text with quoted line ends, read as declared text columns."""
    folder = IO.shared_folder(spark)
    c = table(spark, d, "customer").select(F.concat_ws("\n", "c_name", "c_mktsegment").alias("name"), F.col("c_mktsegment").alias("segment"))
    c.write.csv(folder, sep=";", header=True, quoteAll=True, escape='"')
    r = IO.read_delimited(spark, folder, ["name", "segment"], sep=";")
    return r.groupBy("segment").agg(F.count("*").alias("n"), F.min(F.split_part("name", F.lit("\n"), F.lit(1))).alias("first_name"), F.count_if(F.col("name").contains("\n")).alias("with_line_end"))


@query("source_json_envelopes", """SELECT s_nationkey AS nation, count(*) AS n, sum(CAST(s_suppkey AS BIGINT))::BIGINT AS keys FROM supplier GROUP BY 1""")
def source_json_envelopes(spark, d):
    """Suppliers as JSON documents that hold their records under different keys."""
    folder = IO.shared_folder(spark)
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.collect_list(F.struct("s_suppkey", "s_nationkey")).alias("rows"))
    for k, name in enumerate(("data", "results", "items")):
        s.filter(F.col("s_nationkey") % 3 == k).select(F.to_json(F.struct(F.col("rows").alias(name))).alias("value")).write.option("maxRecordsPerFile", 1).text(f"{folder}/{name}")
    records = IO.read_envelopes(spark, f"{folder}/*", "s_suppkey bigint, s_nationkey int")
    return records.groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("n"), F.sum("s_suppkey").alias("keys"))


@query("source_headers", """SELECT o_orderkey AS id, o_custkey AS cliente, CAST(NULL AS VARCHAR) AS obs FROM orders""")
def source_headers(spark, d):
    """Messy headers under standard names, exact first and then contained."""
    raw = table(spark, d, "orders").select(F.col("o_custkey").alias("Código de Cliente "), F.col("o_orderkey").alias("ID"), F.col("o_totalprice").alias("Importe"))
    return IO.map_headers(raw, {"id": [], "cliente": ["codigo cliente", "cliente"], "obs": ["observaciones"]})


@query("source_lineage", """SELECT 'lineitem.parquet' AS file, 'detail' AS layer, count(*) AS n FROM lineitem UNION ALL SELECT 'orders.parquet', 'header', count(*) FROM orders UNION ALL SELECT 'part.parquet', NULL, count(*) FROM part""")
def source_lineage(spark, d):
    """Rows by the file they come from, and by what a manifest says of it; one file isn't in it."""
    rows = None
    for t in ("lineitem", "orders", "part"):
        one = IO.with_lineage(table(spark, d, t).select("*", "_metadata")).select(F.regexp_extract("source_file", r"([a-z]+\.parquet)(/[^/]*)?$", 1).alias("file"))
        rows = one if rows is None else rows.unionByName(one)
    manifest = spark.createDataFrame([("lineitem.parquet", "detail"), ("orders.parquet", "header"), ("gone.parquet", "detail")], "file string, layer string")
    return IO.with_manifest(rows, manifest, "file").groupBy("file", "layer").agg(F.count("*").alias("n"))


@query("source_layers", """SELECT c_mktsegment AS segment, count(*) AS n, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS balance_c FROM customer WHERE c_acctbal >= 0 GROUP BY 1""")
def source_layers(spark, d):
    """Customers through two layers of JSON lines; an empty table is refused and leaves the layer as it was."""
    root, kind = IO.shared_folder(spark), "id bigint, segment string, balance_c bigint"
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.round(F.col("c_acctbal") * 100).cast("bigint").alias("balance_c"))
    IO.write_layer(c, root, "normalized", "customers")
    IO.write_layer(IO.read_layer(spark, root, "normalized", "customers", kind).filter("balance_c >= 0"), root, "analytical", "customers")
    try:
        IO.write_layer(c.filter("false"), root, "analytical", "customers")
    except IO.EmptyLayer:
        pass
    return IO.read_layer(spark, root, "analytical", "customers", kind).groupBy("segment").agg(F.count("*").alias("n"), F.sum("balance_c").alias("balance_c"))


@query("source_block_rows", f"""WITH {OBS} SELECT market AS file, year, month_idx % 12 + 1 AS m, CAST(sum(volume) AS BIGINT) AS volume FROM obs GROUP BY ALL""")
def source_block_rows(spark, d):
    """Blocks of a year row and its month rows below, in a sheet for each market: months get their block's year."""
    o = observations(spark, d)
    months = o.groupBy(F.col("market").alias("file"), "year", (F.col("month_idx") % 12 + 1).alias("m")).agg(F.sum("volume").alias("volume"))
    sheet = months.select("file", (F.col("year") * 100 + F.col("m")).alias("row_no"), F.lpad(F.col("m").cast("string"), 2, "0").alias("cell"), "volume")
    heads = months.select("file", "year").distinct().select("file", (F.col("year") * 100).alias("row_no"), F.concat(F.lit("AÑO "), F.col("year").cast("string")).alias("cell"), F.lit(None).cast("bigint").alias("volume"))
    sheet = sheet.unionByName(heads).withColumn("year", F.regexp_extract("cell", r"^AÑO (\d+)$", 1).try_cast("int"))
    return IO.carry_header(sheet, ["file"], "row_no", "year").filter("cell NOT LIKE 'AÑO%'").select("file", "year", F.col("cell").cast("int").alias("m"), "volume")


@query("source_published", f"""WITH {OBS} SELECT product, count(*) AS n, max(price_c) AS high FROM obs WHERE market = 'M0' GROUP BY 1""")
def source_published(spark, d):
    """A good publication, then a candidate that fails its gate: readers still see the first."""
    out = IO.Publication(spark, IO.shared_folder(spark))
    o = observations(spark, d).select("product", "market", "price_c")
    check = lambda _, df: Q.gates(df, {"one_market": F.col("market") == "M0"})
    out.publish({"prices": o.filter("market = 'M0'")}, check)
    try:
        out.publish({"prices": o}, check)
    except Q.GateFailure:
        pass
    return out.read("prices").groupBy("product").agg(F.count("*").alias("n"), F.max("price_c").alias("high"))


@query("source_prior_coalesce", """SELECT p_partkey, coalesce(CASE WHEN p_size % 3 = 0 THEN p_retailprice END, CASE WHEN p_size % 3 = 1 THEN p_retailprice * 2 END, -1) AS price FROM part""")
def source_prior_coalesce(spark, d):
    """The first price column that has a value, in the source's order."""
    p = F.col("p_retailprice")
    part = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, p).alias("modal"), F.when(F.col("p_size") % 3 == 1, p * 2).alias("promedio"))
    return part.select("p_partkey", F.coalesce("modal", "promedio", F.lit(-1.0)).alias("price"))


@query("clean_split_variety", """SELECT p_partkey, CASE WHEN p_size % 4 = 1 THEN p_name ELSE split_part(p_name, ' ', 1) END AS product, CASE WHEN p_size % 4 = 1 THEN 'otra' ELSE split_part(p_name, ' ', 2) END AS variety, p_size % 4 <> 1 AS was_split FROM part""")
def clean_split_variety(spark, d):
    """A product name that holds a variety is split where a rule says so and the stated variety agrees."""
    first, second = (F.split_part("p_name", F.lit(" "), F.lit(k)) for k in (1, 2))
    part = table(spark, d, "part").select("p_partkey", "p_name", F.when(F.col("p_size") % 4 == 0, second).when(F.col("p_size") % 4 == 1, "otra").alias("stated"))
    rules = part.select("p_name").distinct().select("p_name", first.alias("base"), second.alias("embedded"))
    return Q.split_variety(part, rules, "p_name", "stated").select("p_partkey", "product", "variety", "was_split")


@query("filter_comparable_price", """SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > 0 AND isfinite(p_retailprice) AND (p_type = 'ECONOMY' OR p_size % 9 > 0) AND p_size <> 13""")
def filter_comparable_price(spark, d):
    """Finite positive prices with a good conversion that nobody rejected."""
    p = F.col("p_retailprice")
    confidence = F.when(F.col("p_type") == "ECONOMY", "Alta").when(F.col("p_size") % 9 > 0, "Media").otherwise("No convertible")
    finite = p.isNotNull() & ~F.isnan(p) & (F.abs(p) != float("inf"))
    return table(spark, d, "part").filter(finite & (p > 0) & confidence.isin("Alta", "Media") & (F.col("p_size") != 13)).select("p_partkey", "p_retailprice")


@query("filter_categories", f"""WITH {OBS} SELECT variety, market, CAST(sum(volume) AS BIGINT) AS volume FROM obs WHERE variety IN ('ECONOMY', 'SMALL', 'LARGE') AND NOT (market = 'M3' AND currency = 'N') GROUP BY ALL""")
def filter_categories(spark, d):
    """Whitelisted categories without the series that is published twice."""
    o = observations(spark, d).filter(F.col("variety").isin("ECONOMY", "SMALL", "LARGE") & ~((F.col("market") == "M3") & (F.col("currency") == "N")))
    return o.groupBy("variety", "market").agg(F.sum("volume").alias("volume"))


@query("gate_expected_counts", f"""WITH {OBS}, g AS (SELECT year, count(DISTINCT event_id) AS n, count(DISTINCT month) AS months FROM obs GROUP BY ALL), e AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS expected FROM orders GROUP BY ALL) SELECT year, n, months, expected, coalesce(n = expected AND months = 12, FALSE) AS good FROM g FULL JOIN e USING (year)""")
def gate_expected_counts(spark, d):
    """Orders with lines and months of each year against the table of orders."""
    expected = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("expected"))
    return Q.expected_counts(observations(spark, d), expected, ["year"], "event_id", "month", 12)


@query("gate_observed_values", f"""WITH {OBS} SELECT product, variety, market, count(*) AS rows, count(*) FILTER (WHERE price_c > 700000) AS observed, count(*) FILTER (WHERE price_c > 700000) > 0 AS good FROM obs GROUP BY ALL""")
def gate_observed_values(spark, d):
    """Parts need at least one value that counts (here, above 7,000)."""
    return Q.observed_values(observations(spark, d), ["product", "variety", "market"], F.col("price_c") > 700000)


@query("gate_unique_keys", f"""WITH {OBS}, k AS (SELECT product, market, day, count(*) AS n FROM obs GROUP BY ALL) SELECT product, count(*) AS keys, count(*) FILTER (WHERE n > 1) AS repeated, bool_and(n = 1) AS good FROM k GROUP BY product""")
def gate_unique_keys(spark, d):
    """Keys (product, market, day) that occur more than once, by product."""
    return Q.unique_keys(observations(spark, d), ["product", "market", "day"], ["product"])


@query("gate_homogeneous_groups", f"""WITH {OBS} SELECT event_id, count(DISTINCT currency) AS currency, count(DISTINCT condition) AS condition, count(DISTINCT currency) = 1 AND count(DISTINCT condition) = 1 AS good FROM obs GROUP BY ALL""")
def gate_homogeneous_groups(spark, d):
    """Events whose lines must agree in currency and condition."""
    return Q.homogeneous(observations(spark, d), ["event_id"], ["currency", "condition"])


@query("gate_dates", """WITH r AS (SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS start, CAST(l_shipdate AS DATE) AS stop, year(o_orderdate) AS part, year(l_shipdate) AS own FROM lineitem JOIN orders ON l_orderkey = o_orderkey) SELECT part AS year, count(*) AS rows, count(*) FILTER (WHERE start > DATE '2001-06-30') AS future, count(*) FILTER (WHERE stop < start) AS reversed, count(*) FILTER (WHERE part <> own) AS misplaced FROM r GROUP BY part""")
def gate_dates(spark, d):
    """Future starts, periods that end before they start, and rows outside their partition's year."""
    r = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    r = r.select(F.to_date("o_orderdate").alias("start"), F.to_date("l_shipdate").alias("stop"), F.year("o_orderdate").alias("year"))
    rules = Q.date_rules("start", "stop", F.lit("2001-06-30").cast("date"), "year", F.year("stop"))
    return r.groupBy("year").agg(F.count("*").alias("rows"), *[F.count_if(~rule).alias(name) for name, rule in rules.items()])


@query("gate_provenance", """WITH r AS (SELECT event_type, CASE WHEN event_id % 13 = 0 THEN upper(sha256(props)) WHEN event_id % 17 = 0 THEN '' ELSE sha256(props) END AS hash, CASE WHEN event_id % 19 > 0 THEN ts END AS captured FROM events) SELECT event_type, count(*) AS rows, count(*) FILTER (WHERE regexp_full_match(hash, '[0-9a-f]{64}') AND captured IS NOT NULL) AS good FROM r GROUP BY event_type""")
def gate_provenance(spark, d):
    """Rows with a proper hash and a capture time."""
    e, k = table(spark, d, "events"), F.col("event_id")
    digest = F.sha2("props", 256)
    r = e.select("event_type", F.when(k % 13 == 0, F.upper(digest)).when(k % 17 == 0, "").otherwise(digest).alias("hash"), F.when(k % 19 > 0, F.col("ts")).alias("captured"))
    return r.groupBy("event_type").agg(F.count("*").alias("rows"), F.count_if(Q.has_provenance("hash", "captured")).alias("good"))


@query("gate_repeated_content", """SELECT user_id, event_type, count(*) AS rows, count(DISTINCT props) AS contents, count(DISTINCT props) > 1 AS stops FROM events GROUP BY ALL""")
def gate_repeated_content(spark, d):
    """Identities that come with several contents; a load with one of them stops."""
    return T.conflicts(table(spark, d, "events"), ["user_id", "event_type"], ["props"])


@query("gate_stale_writer", """SELECT 1 AS built_on, TRUE AS refused, count(*) AS n FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 2, FALSE, count(*) FROM orders WHERE o_orderstatus <> 'F'""")
def gate_stale_writer(spark, d):
    """A candidate built on an older version is refused, one built on the newest is published."""
    out, o = IO.Publication(spark, IO.shared_folder(spark)), table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    check = lambda _, df: Q.gates(df, {})
    found = None
    for status, built_on in (("F", 0), ("O", 1), ("P", 1), ("OP", 2)):
        try:
            out.publish({"orders": o.filter(F.lit(status).contains(F.col("o_orderstatus")))}, check, built_on)
            refused = False
        except IO.StaleWriter:
            refused = True
        if status in ("P", "OP"):
            row = out.read("orders").agg(F.count("*").alias("n")).select(F.lit(built_on).alias("built_on"), F.lit(refused).alias("refused"), "n")
            found = row if found is None else found.unionByName(row)
    return found


@query("gate_index_equals_facts", f"""WITH {OBS} SELECT market, year, count(*) AS n, TRUE AS good FROM obs GROUP BY ALL""")
def gate_index_equals_facts(spark, d):
    """The index written beside partitioned facts, against a count of the facts."""
    folder, o = IO.shared_folder(spark), observations(spark, d).select("market", "year", "day", "price_c")
    index = IO.publish_partitioned(o, folder, ["market", "year"], "day")
    return o.groupBy("market", "year").agg(F.count("*").alias("n")).join(index, ["market", "year"], "full").select("market", "year", "n", (F.col("n") == F.col("rows")).alias("good"))


@query("snapshots_accumulated", """WITH e AS (SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H') AS hour, CAST(floor(value) AS BIGINT) % 3 AS v, strftime(ts, '%d') AS day FROM events) SELECT event_id, user_id, event_type, hour, v FROM e QUALIFY row_number() OVER (PARTITION BY user_id, event_type, hour ORDER BY CASE WHEN day < '11' THEN 0 WHEN day < '21' THEN 1 ELSE 2 END, event_id) = 1""")
def snapshots_accumulated(spark, d):
    """Three snapshots taken into one table: the first capture of an identity stays."""
    out = IO.shared_folder(spark)
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH").alias("hour"), (F.floor("value") % 3).alias("v"), F.date_format("ts", "dd").alias("day"))
    for k, (low, high) in enumerate((("00", "11"), ("11", "21"), ("11", "21"), ("21", "99"))):  # the second runs twice
        T.accumulate(e.filter((F.col("day") >= low) & (F.col("day") < high)).drop("day"), out, ["user_id", "event_type", "hour"], ["v"], ["event_id"], k - (k > 1))
    return T.accumulated_rows(spark, out, "event_id bigint, user_id bigint, event_type string, hour string, v bigint")


@query("snapshots_streamed", """WITH e AS (SELECT event_id, nullif(user_id % 50, 7) AS user_id, event_type, strftime(ts, '%Y-%m-%d') AS day, CAST(floor(value) AS BIGINT) % 3 AS v, strftime(ts, '%d') AS k FROM events) SELECT event_id, user_id, event_type, day, v FROM e QUALIFY row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY CASE WHEN k < '11' THEN 0 WHEN k < '21' THEN 1 ELSE 2 END, event_id) = 1""")
def snapshots_streamed(spark, d):
    """Three loads read as a stream into a table in key buckets; some identities have an unknown part."""
    src, out, place = (IO.shared_folder(spark) for _ in range(3))
    e = table(spark, d, "events").select("event_id", F.expr("nullif(user_id % 50, 7)").alias("user_id"), "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), (F.floor("value") % 3).alias("v"), F.date_format("ts", "dd").alias("k"))
    for low, high in (("00", "11"), ("11", "21"), ("21", "99")):
        e.filter((F.col("k") >= low) & (F.col("k") < high)).drop("k").write.mode("append").parquet(src)
        stream = spark.readStream.schema(e.drop("k").schema).parquet(src)
        T.accumulate_stream(stream, out, place, ["user_id", "event_type", "day"], ["v"], ["event_id"], buckets=16).awaitTermination()
    return T.accumulated_rows(spark, out, e.drop("k").schema)


@query("days_replaced", """WITH e AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, 1 AS capture FROM events UNION ALL SELECT event_id, strftime(ts, '%Y-%m-%d'), 2 FROM events WHERE day(ts) % 3 = 0 AND event_id % 2 = 0) SELECT day, capture, count(*) AS n FROM (SELECT * FROM e QUALIFY capture = max(capture) OVER (PARTITION BY day)) GROUP BY ALL""")
def days_replaced(spark, d):
    """A delta that replaces whole days of a partitioned table."""
    out = IO.shared_folder(spark)
    e = table(spark, d, "events").select("event_id", F.lit(1).alias("capture"), F.date_format("ts", "yyyy-MM-dd").alias("day"), F.dayofmonth("ts").alias("k"))
    T.replace_days(e.drop("k"), out, "day", "capture")
    T.replace_days(e.filter("k % 3 = 0 AND event_id % 2 = 0").withColumn("capture", F.lit(2)).drop("k"), out, "day", "capture")
    return spark.read.schema("event_id bigint, capture int, day string").parquet(out).groupBy("day", "capture").agg(F.count("*").alias("n"))
