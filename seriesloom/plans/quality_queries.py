"""Queries on cleaning, flags, filters, outliers, duplicates and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.functions import dates as D
from seriesloom.functions import numbers as N
from seriesloom.functions import text as T
from seriesloom.functions import units as U
from seriesloom.operators import quality as Q
from seriesloom.operators import series as S
from seriesloom.plans.base import OBS, SERIES, observations, query, table

# number texts of six shapes, made from whole cents in both engines
_C = "CAST(round(l_extendedprice * 100) AS BIGINT)"
RAW = f"""raw AS (SELECT l_orderkey AS k, l_linenumber AS line, c, CASE l_linenumber % 7 WHEN 0 THEN w || ',' || f WHEN 1 THEN w || '.' || f WHEN 2 THEN t || '.' || r || ',' || f WHEN 3 THEN t || ',' || r || '.' || f WHEN 4 THEN t || '.' || r WHEN 5 THEN t || ',' || r ELSE '$ ' || w END AS raw
 FROM (SELECT l_orderkey, l_linenumber, c, CAST(c // 100 AS VARCHAR) AS w, lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS f, CAST(c // 100000 AS VARCHAR) AS t, lpad(CAST(c // 100 % 1000 AS VARCHAR), 3, '0') AS r FROM (SELECT l_orderkey, l_linenumber, {_C} AS c FROM lineitem)))"""


def raw_numbers(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("c"))
    s = lambda x: F.expr(x).cast("string")
    w, f, t, r = s("c div 100"), F.lpad(s("c % 100"), 2, "0"), s("c div 100000"), F.lpad(s("(c div 100) % 1000"), 3, "0")
    shapes = [F.concat(w, F.lit(","), f), F.concat(w, F.lit("."), f), F.concat(t, F.lit("."), r, F.lit(","), f), F.concat(t, F.lit(","), r, F.lit("."), f), F.concat(t, F.lit("."), r), F.concat(t, F.lit(","), r)]
    raw = F.concat(F.lit("$ "), w)
    for i, shape in enumerate(shapes):
        raw = F.when(F.col("line") % 7 == i, shape).otherwise(raw)
    return li.withColumn("raw", raw)


def _sql_read(x, mark):
    other = "." if mark == "," else ","
    return f"TRY_CAST(replace(replace({x}, '{other}', ''), '{mark}', '.') AS DOUBLE)"


def _sql_mode(mode):
    x = "b"
    tail = r"length(regexp_extract(b, '[.,]([0-9]*)$', 1))"
    always, comma_rule, dot_rule = N.MODES[mode]
    rule = {"short": f"{tail} <= 2", "not3": f"{tail} <> 3", "decimal": "TRUE"}
    comma = "length(b) - length(replace(b, ',', '')) <= 1" if comma_rule == "groups" else rule[comma_rule]
    dot = r"NOT regexp_matches(b, '^-?\d{1,3}(\.\d{3})+$')" if dot_rule == "groups" else rule[dot_rule]
    whole = "TRY_CAST(replace(replace(b, '.', ''), ',', '') AS DOUBLE)"
    last = "TRUE" if always else "regexp_matches(b, ',[^.,]*$')"
    return f"CASE WHEN contains(b, ',') AND contains(b, '.') THEN CASE WHEN {last} THEN {_sql_read(x, ',')} ELSE {_sql_read(x, '.')} END WHEN contains(b, ',') THEN CASE WHEN {comma} THEN {_sql_read(x, ',')} ELSE {whole} END WHEN contains(b, '.') THEN CASE WHEN {dot} THEN {_sql_read(x, '.')} ELSE {whole} END ELSE {whole} END"


@query("clean_numbers", f"""WITH {RAW} SELECT k, line, raw, {', '.join(f'{_sql_mode(m)} AS {m}' for m in N.MODES)}, {', '.join(f"CASE WHEN regexp_matches(trim(raw), '{N.STRICT[s]}') THEN {_sql_read('trim(raw)', ',' if s == 'ar' else '.')} END AS strict_{s}" for s in N.STRICT)} FROM (SELECT *, regexp_replace(raw, '[^0-9.,\\-]', '', 'g') AS b FROM raw)""")
def clean_numbers(spark, d):
    numbers = N.parse_numbers(raw_numbers(spark, d).select("k", "line", "raw"), "raw", list(N.MODES))
    return numbers.select("*", *[N.parse_number(F.col("raw"), f"strict_{s}").alias(f"strict_{s}") for s in N.STRICT])


@query("clean_table_style", f"""WITH {RAW}, t AS (SELECT line % 7 AS t, bool_and(regexp_matches(raw, '{N.STRICT['ar']}')) AS ar, bool_and(regexp_matches(raw, '{N.STRICT['us']}')) AS us FROM raw GROUP BY ALL)
 SELECT CAST(t AS INTEGER) AS t, CASE WHEN ar AND us THEN 'ambiguous' WHEN ar THEN 'ar' WHEN us THEN 'us' ELSE 'inconsistent' END AS style FROM t""")
def clean_table_style(spark, d):
    return N.table_style(raw_numbers(spark, d).withColumn("t", F.col("line") % 7), "t", "raw")


@query("clean_dates", """WITH r AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 2 THEN strftime(o_orderdate, '%-d-%-m-%Y') WHEN 3 THEN strftime(o_orderdate, '%Y%m%d')
 WHEN 4 THEN CAST(CAST(o_orderdate AS DATE) - DATE '1899-12-30' AS VARCHAR) ELSE '31/02/' || strftime(o_orderdate, '%Y') END AS raw FROM orders) SELECT k, raw, CAST(CASE WHEN k % 6 < 5 THEN day END AS VARCHAR) AS parsed FROM r""")
def clean_dates(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("day"))
    f = lambda p: F.date_format("day", p)
    shapes = [f("yyyy-MM-dd"), f("dd/MM/yyyy"), f("d-M-yyyy"), f("yyyyMMdd"), F.datediff("day", F.lit("1899-12-30").cast("date")).cast("string")]
    raw = F.concat(F.lit("31/02/"), f("yyyy"))
    for i, shape in enumerate(shapes):
        raw = F.when(F.col("k") % 6 == i, shape).otherwise(raw)
    return o.select("k", raw.alias("raw")).withColumn("parsed", D.parse_date(F.col("raw")).cast("string"))


_FOLD = f"lower(translate({{x}}, '{T.ACCENTED}', '{T.PLAIN}'))"


@query("clean_text_keys", f"""WITH l AS (SELECT doc_id, {_FOLD.format(x='text')} AS f FROM documents), k AS (SELECT doc_id, trim(regexp_replace(f, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS spaced, trim(regexp_replace(f, '[^a-z0-9]+', ' ', 'g')) AS ascii FROM l) SELECT doc_id, sha256(spaced) AS spaced, sha256(replace(spaced, ' ', '')) AS joined, sha256(upper(spaced)) AS upper, ascii FROM k""")
def clean_text_keys(spark, d):
    """Keys of whole texts; the long ones by digest."""
    keys = table(spark, d, "documents").select("doc_id", *[T.text_key(F.col("text"), k).alias(k) for k in ("spaced", "joined", "upper", "ascii")])
    return keys.select("doc_id", *[F.sha2(k, 256).alias(k) for k in ("spaced", "joined", "upper")], "ascii")


@query("clean_text_repair", """SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'Caña de azúcar' WHEN 2 THEN 'Café ' || c_mktsegment WHEN 3 THEN 'Maíz a 20°' WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE c_name END AS label FROM customer""")
def clean_text_repair(spark, d):
    raw, k = F.concat(F.lit("  "), F.col("c_name")), F.col("c_custkey") % 8
    for i, x in enumerate(["#N/A", " CaÃ±a  de azÃºcar", None, "MaÃ­z a 20Â°", "None", " nan "]):
        raw = F.when(k == i, F.concat(F.lit("CafÃ©  "), F.col("c_mktsegment")) if x is None else F.lit(x)).otherwise(raw)
    return table(spark, d, "customer").select("c_custkey", T.clean_text(raw).alias("label"))


_TITLE = "concat(upper(split_part(p_name, ' ', 1)), CASE p_size % 3 WHEN 0 THEN '  DE LA ' WHEN 1 THEN '-y-' ELSE concat(' D', chr(39)) END, upper(p_type))"
_PART = "[ '-]|[^ '-]+".replace("'", "''")


@query("clean_title_labels", f"""WITH r AS (SELECT DISTINCT {_TITLE} AS raw FROM part), w AS (SELECT raw, regexp_extract_all(lower(regexp_replace(raw, '\\s+', ' ', 'g')), '{_PART}') AS p FROM r) SELECT raw, array_to_string([CASE WHEN i > 1 AND x IN ({', '.join(f"'{c}'" for c in T.CONNECTORS)}) THEN x ELSE upper(x[1]) || x[2:] END for x, i in p], '') AS label FROM w""")
def clean_title_labels(spark, d):
    return table(spark, d, "part").select(F.expr(_TITLE).alias("raw")).distinct().withColumn("label", T.title_case(F.col("raw")))


@query("clean_classify", """SELECT p_partkey, CASE WHEN starts_with(lower(p_type), 'econ') THEN 'economico' WHEN contains(lower(p_name), 'ring') THEN 'anillo' WHEN contains(lower(p_name), 'widget') THEN 'pieza' ELSE 'otro' END AS class FROM part""")
def clean_classify(spark, d):
    return table(spark, d, "part").select("p_partkey", T.classify(F.concat_ws(" ", "p_type", "p_name"), [("^econ", "economico"), ("ring", "anillo"), ("widget", "pieza")]).alias("class"))


@query("clean_aliases", """WITH r AS (SELECT DISTINCT p_type AS raw, lower(p_type) AS canonical, CASE WHEN length(p_type) % 2 = 0 THEN 'validated' ELSE 'observed' END AS status FROM part)
 SELECT p_partkey, coalesce(canonical, p_type) AS type, coalesce(c2, p_type) AS type_observed FROM part LEFT JOIN r ON p_type = raw AND status = 'validated' LEFT JOIN (SELECT raw AS raw2, canonical AS c2 FROM r) ON raw2 = p_type""")
def clean_aliases(spark, d):
    part = table(spark, d, "part")
    rules = part.select(F.col("p_type").alias("raw"), F.lower("p_type").alias("canonical"), F.when(F.length("p_type") % 2 == 0, "validated").otherwise("observed").alias("status")).distinct()
    Q.gates(rules, {}, key=["raw"])
    strict = rules.filter("status = 'validated'").select(F.col("raw").alias("p_type"), F.col("canonical").alias("c1"))
    every = rules.select(F.col("raw").alias("p_type"), F.col("canonical").alias("c2"))
    out = part.join(strict, "p_type", "left").join(every, "p_type", "left")
    return out.select("p_partkey", F.coalesce("c1", "p_type").alias("type"), F.coalesce("c2", "p_type").alias("type_observed"))


@query("clean_preferred_spelling", """WITH w AS (SELECT unnest(regexp_extract_all(text, '[\\p{L}\\p{N}]+')) AS w, doc_id FROM documents), g AS (SELECT w, min(doc_id) AS d FROM w GROUP BY w), k AS (SELECT w, %s AS key, length(w) - length(regexp_replace(w, '[áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÉÈÊÍÓÖÚÜÑÇ]', '', 'g')) AS accents, d FROM g)
 SELECT key, arg_max(w, (accents, -d, w)) AS preferred, count(*) AS spellings FROM k GROUP BY key""" % _FOLD.format(x="w"))
def clean_preferred_spelling(spark, d):
    """Of the spellings of a word in all texts, the one with most accents, then the earliest."""
    words = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"([\p{L}\p{N}]+)"), 1)).alias("w"))
    w = words.groupBy("w").agg(F.min("doc_id").alias("doc_id"))
    accents = F.length("w") - F.length(F.regexp_replace("w", "[áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÉÈÊÍÓÖÚÜÑÇ]", ""))
    return w.groupBy(T.fold(F.col("w")).alias("key")).agg(F.max_by("w", F.struct(accents, -F.col("doc_id"), "w")).alias("preferred"), F.count("*").alias("spellings"))


# a package text and its weight, which disagree in some rows
_PACK = "concat(CASE WHEN p_type = 'PROMO' THEN 'MAZO ' ELSE 'CAJON ' END, CASE WHEN p_size % 4 = 0 THEN 'chico' ELSE concat('x ', CAST(p_size AS {text}), ',0 Kg') END)"
_KG = "CASE WHEN p_partkey % 5 = 0 THEN p_size % 9 ELSE p_size END"


@query("clean_price_per_kg", f"""WITH p AS (SELECT p_partkey, p_retailprice, p_type, p_size, {_PACK.format(text='VARCHAR')} AS pack, {_KG} AS kg, CASE p_partkey % 4 WHEN 0 THEN 'kg' WHEN 3 THEN 'unidad' ELSE 'bulto' END AS unit FROM part) SELECT p_partkey, pack, CASE WHEN unit = 'kg' THEN p_retailprice WHEN unit = 'bulto' AND kg > 0 THEN p_retailprice / kg END AS price_kg,
 CASE WHEN unit = 'kg' THEN 'por kg' WHEN unit = 'bulto' AND kg > 0 THEN 'por bulto' ELSE 'sin kg' END AS method, unit = 'kg' OR (unit = 'bulto' AND kg > 0 AND kg = p_size AND p_size % 4 <> 0 AND p_type <> 'PROMO') AS validated FROM p""")
def clean_price_per_kg(spark, d):
    """Prices by kilogram, and whether the package's own text bears the weight out."""
    unit = F.when(F.col("p_partkey") % 4 == 0, "kg").when(F.col("p_partkey") % 4 == 3, "unidad").otherwise("bulto")
    p = table(spark, d, "part").select("p_partkey", "p_retailprice", F.expr(_PACK.format(text="STRING")).alias("pack"), F.expr(_KG).alias("kg"), unit.alias("unit"))
    unit, pack, kg = F.col("unit"), F.col("pack"), F.col("kg")
    return p.select("p_partkey", "pack", U.price_per_kg(F.col("p_retailprice"), unit, kg).alias("price_kg"), U.conversion_method(unit, kg).alias("method"), U.weight_validated(unit, pack, kg).alias("validated"))


@query("clean_unit_fanout", f"""WITH {OBS} SELECT event_id, line, product, 'ARS/quintal' AS unit, CAST(price_c AS DOUBLE) AS price FROM obs UNION ALL SELECT event_id, line, product, 'ARS/kg', CAST(price_c AS DOUBLE) / 100 FROM obs WHERE price_c > 0""")
def clean_unit_fanout(spark, d):
    o = observations(spark, d).select("event_id", "line", "product", "price_c")
    return Q.unit_fanout(o, "price_c", {"ARS/quintal": 1, "ARS/kg": 100}, ["ARS/kg"])


@query("clean_stable_ids", f"""WITH {OBS} SELECT event_id, line, series_id, record_id, occurrence, sha256(CAST(to_json({{'record_id': record_id, 'occurrence': CAST(occurrence AS VARCHAR)}}) AS VARCHAR)) AS observation_id FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY event_id, line, price_c, volume, variety) - 1 AS occurrence FROM
 (SELECT *, sha256(CAST(to_json({{'product': product, 'currency': currency, 'condition': condition, 'v': nullif(variety, 'PROMO')}}) AS VARCHAR)) AS series_id, sha256(CAST(to_json({{'product': product, 'market': market, 'day': CAST(day AS VARCHAR), 'v': nullif(variety, 'PROMO')}}) AS VARCHAR)) AS record_id FROM obs))""")
def clean_stable_ids(spark, d):
    """Ids of series with an unknown variety, of records, and of the observations of one record."""
    o = observations(spark, d).withColumn("v", F.nullif(F.col("variety"), F.lit("PROMO")))
    o = Q.stable_ids(o, [*SERIES, "v"], ["product", "market", "day", "v"], ["event_id", "line", "price_c", "volume", "variety"])
    return o.select("event_id", "line", "series_id", "record_id", "occurrence", "observation_id")


_FLAGS = {"precio_bajo": "price_c < 50000", "precio_alto": "price_c > 1500000", "volumen_unitario": "volume = 1", "condicion_abierta": "condition = 'O'", "fecha_futura": "day > DATE '2001-06-30'"}


@query("quality_flags", f"""WITH {OBS} SELECT event_id, line, price_c, concat_ws(',', {', '.join(f"CASE WHEN {r} THEN '{n}' END" for n, r in _FLAGS.items())}) AS flags, concat_ws(',', CASE WHEN day > DATE '2001-06-30' THEN 'fecha_futura' END, CASE WHEN price_c > 1500000 THEN 'precio_alto' END) AS blocking, NOT (price_c > 1500000 OR day > DATE '2001-06-30') AS valid FROM obs""")
def quality_flags(spark, d):
    o = Q.with_reasons(observations(spark, d), {n: F.expr(r) for n, r in _FLAGS.items()}, "f")
    block = Q.blockers(F.col("f"), ["precio_alto", "fecha_futura"])
    return o.select("event_id", "line", "price_c", F.array_join("f", ",").alias("flags"), F.array_join(block, ",").alias("blocking"), (F.size(block) == 0).alias("valid"))


@query("quality_reason_counts", f"""WITH {OBS} {' UNION ALL '.join(f"SELECT '{n}' AS reason, count(*) AS n FROM obs WHERE {r} HAVING count(*) > 0" for n, r in _FLAGS.items())}""")
def quality_reason_counts(spark, d):
    return Q.reason_counts(Q.with_reasons(observations(spark, d), {n: F.expr(r) for n, r in _FLAGS.items()}))


@query("quality_zero_cause", """SELECT event_id, CASE WHEN raw IS NULL OR raw = '' THEN 'vacio' WHEN raw = 'ANULADO' THEN 'anulacion' WHEN raw = 's/p' THEN 'texto sin precio' WHEN TRY_CAST(raw AS DOUBLE) IS NULL THEN 'error de lectura' WHEN TRY_CAST(raw AS DOUBLE) = 0 THEN 'cero explicito' ELSE 'con precio' END AS cause
 FROM (SELECT event_id, CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'ANULADO' WHEN 3 THEN 's/p' WHEN 4 THEN '0.00' WHEN 5 THEN '12x' ELSE '17.5' END AS raw FROM events)""")
def quality_zero_cause(spark, d):
    raw = F.lit("17.5")
    for i, x in enumerate([None, "", "ANULADO", "s/p", "0.00", "12x"]):
        raw = F.when(F.col("event_id") % 7 == i, F.lit(x)).otherwise(raw)
    return table(spark, d, "events").select("event_id", raw.alias("raw")).select("event_id", Q.zero_cause(F.col("raw"), ["ANULADO"], ["s/p"]).alias("cause"))


@query("quality_price_consistency", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, abs(p_retailprice - l_extendedprice / l_quantity) <= 1e-6 AS unit_agrees, abs(p_retailprice * l_quantity - l_extendedprice) <= greatest(1.0, 0.01 * abs(l_extendedprice)) AS total_agrees FROM lineitem JOIN part ON l_partkey = p_partkey""")
def quality_price_consistency(spark, d):
    """The list price against the price paid, and against the total."""
    li = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    unit, total = U.price_consistency(F.col("p_retailprice"), F.col("l_extendedprice") / F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_quantity"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", unit.alias("unit_agrees"), total.alias("total_agrees"))


@query("quality_suspicious_kg", f"""WITH {OBS} SELECT event_id, line, product, price_c, concat_ws(' | ', CASE WHEN price_c > 2000000 THEN 'precio/kg alto' END, CASE WHEN price_c < 20000 THEN 'precio/kg bajo' END, CASE WHEN volume % 9 = 0 THEN 'kg faltante o cero' END, CASE WHEN variety = 'PROMO' THEN 'envase no convertible' END) AS reasons FROM obs WHERE price_c > 2000000 OR price_c < 20000 OR volume % 9 = 0 OR variety = 'PROMO'""")
def quality_suspicious_kg(spark, d):
    o = Q.with_reasons(observations(spark, d), {"precio/kg alto": F.col("price_c") > 2000000, "precio/kg bajo": F.col("price_c") < 20000, "kg faltante o cero": F.col("volume") % 9 == 0, "envase no convertible": F.col("variety") == "PROMO"})
    return o.filter(F.size("reasons") > 0).select("event_id", "line", "product", "price_c", F.array_join("reasons", " | ").alias("reasons"))


# delivery places: some end with a basis, some have it elsewhere
_PLACE = "concat(market, CASE WHEN condition = 'O' AND currency = 'A' THEN '' WHEN condition = 'O' THEN ' / En Origen' WHEN currency = 'A' THEN ', en origen o puerto' ELSE ' / en destino ' END)"


@query("quality_labels", f"""WITH {OBS}, p AS (SELECT DISTINCT product, currency, condition, {_PLACE} AS place FROM obs) SELECT *, concat_ws(' · ', product, CASE WHEN currency <> 'N' THEN currency END, nullif(regexp_extract(place, '(?i)(En\\s+(?:origen|destino))\\s*$', 1), '')) AS label FROM p""")
def quality_labels(spark, d):
    """Labels of series with the delivery basis that the place's text ends with."""
    p = observations(spark, d).select(*SERIES, F.expr(_PLACE).alias("place")).distinct()
    return p.withColumn("label", F.concat_ws(" · ", "product", F.when(F.col("currency") != "N", F.col("currency")), F.nullif(U.delivery_basis(F.col("place")), F.lit(""))))


@query("filter_dimensions", f"""WITH {OBS} SELECT event_id, line, product, variety, market, price_c FROM obs WHERE product IN ('Brand#1', 'Brand#2', 'Brand#3') AND (nullif(variety, 'PROMO') IN ('ECONOMY', 'SMALL') OR nullif(variety, 'PROMO') IS NULL) AND month BETWEEN '1997-03' AND '1999-02'""")
def filter_dimensions(spark, d):
    """Chosen products, all markets, and qualities that don't contradict (unknown passes)."""
    quality = F.nullif(F.col("variety"), F.lit("PROMO"))
    o = observations(spark, d).filter(F.col("product").isin("Brand#1", "Brand#2", "Brand#3") & Q.compatible(quality, ["ECONOMY", "SMALL"]) & F.col("month").between("1997-03", "1999-02"))
    return o.select("event_id", "line", "product", "variety", "market", "price_c")


@query("filter_future_rows", f"""WITH {OBS} SELECT market, count(*) FILTER (WHERE day <= DATE '2000-12-31') AS kept, count(*) FILTER (WHERE day > DATE '2000-12-31') AS future, CAST(max(day) FILTER (WHERE day <= DATE '2000-12-31') AS VARCHAR) AS last_kept FROM obs GROUP BY market""")
def filter_future_rows(spark, d):
    return Q.future_rows(observations(spark, d), ["market"], "day", "2000-12-31")


@query("filter_text_search", f"""WITH s AS (SELECT p_partkey, lower(p_name || ' ' || p_type || ' ' || p_brand) AS t FROM part) SELECT p_partkey FROM s WHERE contains(t, 'ring') AND contains(t, 'brand#1')""")
def filter_text_search(spark, d):
    t = T.fold(F.concat_ws(" ", "p_name", "p_type", "p_brand"))
    hit = F.lit(True)
    for token in "Ring BRAND#1".lower().split():
        hit = hit & t.contains(token)
    return table(spark, d, "part").filter(hit).select("p_partkey")


@query("filter_quarantine", """WITH s AS (SELECT o_custkey, o_orderdate, count(DISTINCT o_orderpriority) AS kinds, count(*) AS rows FROM orders GROUP BY ALL) SELECT o_orderkey, o_custkey, CASE WHEN rows > 1 THEN 'repetido' ELSE '' END AS flags FROM orders JOIN s USING (o_custkey, o_orderdate) WHERE kinds = 1""")
def filter_quarantine(spark, d):
    good, _ = Q.quarantine(table(spark, d, "orders"), ["o_custkey", "o_orderdate"], ["o_orderpriority"], "repetido")
    return good.select("o_orderkey", "o_custkey", F.array_join("flags", ",").alias("flags"))


@query("filter_trailing_months", f"""WITH {OBS} SELECT event_id, line, product, market, price_c FROM obs WHERE day >= (SELECT max(day) - INTERVAL 6 MONTH FROM obs)""")
def filter_trailing_months(spark, d):
    return Q.trailing_months(observations(spark, d), "day", 6).select("event_id", "line", "product", "market", "price_c")


@query("filter_publication_subset", f"""WITH {OBS}, t AS (SELECT *, CASE currency WHEN 'A' THEN 'faena' WHEN 'N' THEN 'produccion' ELSE 'peso' END AS family, CASE condition WHEN 'F' THEN 'mensual' ELSE 'anual' END AS frequency FROM obs)
 SELECT family, frequency, product, month, CAST(sum(volume) AS BIGINT) AS volume FROM t WHERE NOT (variety IS NULL OR price_c < 20000) AND (family = 'faena' AND frequency = 'mensual' AND market = 'M0' OR family = 'faena' AND frequency = 'anual' AND market = 'M1' OR family = 'produccion' AND market = 'M2') GROUP BY ALL""")
def filter_publication_subset(spark, d):
    """One published table for each family and frequency before summing; families without a rule,
    entity rows and unverified scales stay out."""
    o = observations(spark, d).withColumn("family", F.when(F.col("currency") == "A", "faena").when(F.col("currency") == "N", "produccion").otherwise("peso")).withColumn("frequency", F.when(F.col("condition") == "F", "mensual").otherwise("anual"))
    o = Q.with_reasons(o, {"entidad": F.col("variety").isNull(), "escala": F.col("price_c") < 20000}).filter(F.size("reasons") == 0)
    rules = [({"family": "faena", "frequency": "mensual"}, F.col("market") == "M0"), ({"family": "faena", "frequency": "anual"}, F.col("market") == "M1"), ({"family": "produccion"}, F.col("market") == "M2")]
    return Q.published_table(o, rules).groupBy("family", "frequency", "product", "month").agg(F.sum("volume").alias("volume"))


_OUT = """WITH {obs}, e AS (SELECT product, currency, quantile_cont(CAST(price_c AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(price_c AS DOUBLE), 0.75) AS q3 FROM obs WHERE price_c > 0 GROUP BY ALL) SELECT event_id, line, price_c FROM obs JOIN e USING (product, currency) WHERE price_c < q1 - {k} * (q3 - q1) OR price_c > q3 + {k} * (q3 - q1)"""


@query("quality_outliers_grain", _OUT.format(obs=OBS, k=1.5))
def quality_outliers_grain(spark, d):
    return Q.outliers(observations(spark, d), ["product", "currency"], "price_c", 1.5).select("event_id", "line", "price_c")


@query("quality_outliers_wholesale", _OUT.format(obs=OBS, k=3))
def quality_outliers_wholesale(spark, d):
    return Q.outliers(observations(spark, d), ["product", "currency"], "price_c", 3.0).select("event_id", "line", "price_c")


@query("quality_extremes", f"""WITH {OBS}, m AS (SELECT product, variety, median(CAST(price_c AS DOUBLE)) AS m FROM obs GROUP BY ALL HAVING count(*) >= 5) SELECT event_id, line, price_c, m AS group_median FROM obs JOIN m ON obs.product = m.product AND obs.variety IS NOT DISTINCT FROM m.variety WHERE price_c > m * 10 OR price_c * 10 < m""")
def quality_extremes(spark, d):
    return Q.extremes(observations(spark, d), ["product", "variety"], "price_c").select("event_id", "line", "price_c", "group_median")


@query("quality_duplicate_groups", f"""WITH {OBS}, g AS (SELECT count(*) AS n FROM obs GROUP BY product, market, day, currency, condition HAVING count(*) > 1) SELECT count(*) AS groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS excess FROM g""")
def quality_duplicate_groups(spark, d):
    return Q.duplicate_groups(observations(spark, d), ["product", "market", "day", "currency", "condition"])


@query("quality_duplicate_candidates", f"""WITH {OBS} SELECT event_id, line, price_c, product, count(*) OVER (PARTITION BY product, market, day) > 1 AS is_duplicate_candidate FROM obs""")
def quality_duplicate_candidates(spark, d):
    return Q.duplicate_candidates(observations(spark, d), ["product", "market", "day"]).select("event_id", "line", "price_c", "product", "is_duplicate_candidate")


@query("quality_duplicate_impact", f"""WITH {OBS}, f AS (SELECT *, row_number() OVER (PARTITION BY product, market, day ORDER BY event_id, line, price_c) AS r FROM obs) SELECT product, count(*) AS rows, count(*) FILTER (WHERE r = 1) AS rows_once, CAST(sum(price_c) AS DOUBLE) / count(*) AS mean, CAST(sum(price_c) FILTER (WHERE r = 1) AS DOUBLE) / count(*) FILTER (WHERE r = 1) AS mean_once FROM f GROUP BY product""")
def quality_duplicate_impact(spark, d):
    from pyspark.sql import Window

    o = observations(spark, d).withColumn("once", F.row_number().over(Window.partitionBy("product", "market", "day").orderBy("event_id", "line", "price_c")) == 1)
    one = F.when(F.col("once"), F.col("price_c"))
    return o.groupBy("product").agg(F.count("*").alias("rows"), F.count(one).alias("rows_once"), S.mean("price_c").alias("mean"), (F.sum(one).cast("double") / F.count(one)).alias("mean_once"))


_GATES = {"precio_positivo": "price_c > 0", "fecha_valida": "day IS NOT NULL AND day <= DATE '2001-09-30'", "estado_coherente": "(volume > 1) = (price_c < 1800000)", "volumen_chico": "volume < 50"}


@query("quality_gates", f"""WITH {OBS} {' UNION ALL '.join(f"SELECT '{n}' AS gate, count(*) FILTER (WHERE NOT ({r})) AS broken FROM obs" for n, r in _GATES.items())}""")
def quality_gates(spark, d):
    return Q.gate_counts(observations(spark, d), {n: F.expr(r) for n, r in _GATES.items()})
