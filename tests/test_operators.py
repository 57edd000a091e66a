import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriesloom.operators import match, quality, series
from seriesloom.sources import tables
from seriesloom.streaming import incremental

DAY = dt.date


def test_weighted_price_needs_every_volume(spark):
    df = spark.createDataFrame([("a", 100, 10), ("a", 200, 30), ("b", 100, 10), ("b", 200, None), ("c", 100, -1), ("c", 100, 30)], "s string, p long, v long")
    got = {r.s: (r.weighted, r.volume, r.known_volume) for r in series.weighted_price(df, ["s"], "p", "v").collect()}
    assert got == {"a": (175.0, 40, 40), "b": (None, None, 10), "c": (None, 29, 30)}


def test_exact_prior_never_bridges(spark):
    df = spark.createDataFrame([("a", 1, 100.0), ("a", 2, 120.0), ("a", 4, 180.0)], "s string, m int, v double")
    got = df.withColumn("c", series.change(F.col("v"), series.exact_prior("v", ["s"], "m", 1))).orderBy("m").collect()
    assert [None if r.c is None else round(r.c, 6) for r in got] == [None, 20.0, None]


def test_day_medians_and_balanced_means(spark):
    df = spark.createDataFrame([("m", "1", "01", 10, "x"), ("m", "1", "01", 20, "x"), ("m", "1", "01", 30, "x"), ("m", "1", "02", 100, "x"), ("m", "2", "01", 1, "x"), ("m", "2", "01", 2, "y")], "k string, month string, day string, v long, g string")
    got = {r.month: (r["median"], r.days) for r in series.day_median(df, ["k"], "v", "g").collect()}
    assert got == {"1": (60.0, 2), "2": (None, 1)}
    df = spark.createDataFrame([("2025", "01", "1", 10), ("2025", "01", "1", 30), ("2025", "01", "2", 100), ("2025", "02", "1", 200)], "year string, month string, day string, v long")
    assert [r.v for r in series.balanced(df, [], ["year", "month", "day"], "v").collect()] == [130.0]


def test_exact_median_stays_decimal(spark):
    df = spark.createDataFrame([("a", x) for x in ("1.01", "1.02", "9.00")] + [("b", "1.01"), ("b", "1.02")], "s string, x string").withColumn("x", F.col("x").cast("decimal(28,10)"))
    got = {r.s: float(r["median"]) for r in series.exact_median(df, ["s"], "x").collect()}
    assert got == {"a": 1.02, "b": 1.015}


def test_rates_as_of(spark):
    rates = spark.createDataFrame([(DAY(2020, 11, 6), 1500.0), (DAY(2020, 11, 10), 1510.0), (DAY(2020, 11, 12), 1544.432)], "d date, r double")
    days = spark.createDataFrame([(DAY(2020, 11, k),) for k in (5, 6, 9, 12, 13)], "day date")
    got = {r.day.day: r.r for r in match.as_of_rates(days, rates, "day", "d", "r").collect()}
    assert got == {5: None, 6: 1500.0, 9: 1500.0, 12: 1544.432, 13: None}
    old = spark.createDataFrame([(DAY(2020, 1, 1), 1.0), (DAY(2020, 1, 20), 2.0)], "d date, r double")
    got = match.as_of_rates(spark.createDataFrame([(DAY(2020, 1, 8),), (DAY(2020, 1, 9),)], "day date"), old, "day", "d", "r").orderBy("day").collect()
    assert [r.r for r in got] == [1.0, None]


def test_matching_keeps_ambiguous_rows_apart(spark):
    left = spark.createDataFrame([(1, "a", 10), (2, "a", 10), (3, "b", 5), (4, "C", 7), (5, "z", 1)], "left_id long, k string, p int")
    right = spark.createDataFrame([(11, "a", 10), (12, "b", 6), (13, "c", 7), (14, "d", 1)], "right_id long, k2 string, p2 int").withColumn("l2", F.lower("k2"))
    left = left.withColumn("l", F.lower("k"))
    out = match.mutual_unique(left, right, [("exact", [("k", "k2")], ("p", "p2", 1)), ("folded", [("l", "l2")], None)]).collect()
    got = {(r.side, r.id): (r.other_id, r.state, r.stage) for r in out}
    assert got == {("left", 1): (None, "ambiguous", "exact"), ("left", 2): (None, "ambiguous", "exact"), ("right", 11): (None, "ambiguous", "exact"), ("left", 3): (12, "matched", "exact"), ("right", 12): (3, "matched", "exact"),
                   ("left", 4): (13, "matched", "folded"), ("right", 13): (4, "matched", "folded"), ("left", 5): (None, "left over", None), ("right", 14): (None, "left over", None)}
    rates = {(r.side, r.state): r.rate for r in match.match_rates(spark.createDataFrame(out, "side string, id long, other_id long, state string, stage string")).collect()}
    assert rates["left", "ambiguous"] == 0.4 and rates["right", "left over"] == 0.25
    folded = match.mutual_unique(left.filter("left_id < 3"), right.filter("right_id = 11"), [("folded", [("l", "l2")], None)]).collect()
    assert {(r.side, r.id, r.state) for r in folded} == {("left", 1, "ambiguous"), ("left", 2, "ambiguous"), ("right", 11, "ambiguous")}
    days = match.on_common_days(spark.createDataFrame([(1, "x"), (2, "y")], "i int, d string"), spark.createDataFrame([(3, "y"), (4, None)], "j int, e string"), "d", "e")
    assert [[tuple(r) for r in x.collect()] for x in days] == [[(2, "y")], [(3, "y")], [(1, "x")], [(4, None)]]


def test_labels_and_repairs(spark):
    from seriesloom.functions import text, units

    texts = ["  DE LA  o'higgins-DEL sur", "pan  DE da vinci", "-el y", None, "ÑANDÚ E ÍÑIGO"]
    got = [r.t for r in spark.createDataFrame([(x,) for x in texts], "x string").select(text.title_case(F.col("x")).alias("t")).collect()]
    assert got == ["De la O'Higgins-del Sur", "Pan de da Vinci", "-El y", None, "Ñandú e Íñigo"]
    texts = ["MaÃ\u00adz\u00a0 20Â°", "none", "#ref!", " NaN ", "nada", ""]
    got = [r.t for r in spark.createDataFrame([(x,) for x in texts], "x string").select(text.clean_text(F.col("x")).alias("t")).collect()]
    assert got == ["Maíz 20°", None, None, None, "nada", None]
    packs = [("bulto", "Cajon x 10,5 kg", 10.5, True), ("bulto", "CAJON X 10 KG", 12.0, False), ("bulto", "MAZO X 10 KG", 10.0, False), ("kg", "suelto", None, True), ("bulto", None, 5.0, False)]
    df = spark.createDataFrame(packs, "unit string, pack string, kg double, want boolean")
    assert all(r.want == r.got for r in df.withColumn("got", units.weight_validated(F.col("unit"), F.col("pack"), F.col("kg"))).collect())
    places = [("Rosario / en  ORIGEN ", "en  ORIGEN"), ("En origen, puerto", ""), ("En destino", "En destino")]
    assert all(r.want == r.got for r in spark.createDataFrame(places, "p string, want string").withColumn("got", units.delivery_basis(F.col("p"))).collect())


def test_latest_revision_withdraws(spark):
    df = spark.createDataFrame([("d1", 1, "x"), ("d1", 1, "y"), ("d1", 2, "x"), ("d2", 1, "z")], "day string, capture int, row string")
    assert sorted((r.day, r.row) for r in series.latest_revision(df, ["day"], ["capture"]).collect()) == [("d1", "x"), ("d2", "z")]


def test_abbreviations(spark):
    df = spark.createDataFrame([("tom. perita",), ("tomate perita",), ("tomate",), (None,), ("papa",)], "x string")
    assert [(r.short, r.long) for r in match.abbreviations(df, "x").collect()] == [("tom. perita", "tomate perita")]


def test_gates(spark):
    df = spark.createDataFrame([(1, 5), (1, 6)], "k int, v int")
    with pytest.raises(quality.GateFailure, match="unique_key"):
        quality.gates(df, {"positive": F.col("v") > 0}, key=["k"])
    with pytest.raises(quality.GateFailure, match="big"):
        quality.gates(df, {"big": F.col("v") > 5})
    with pytest.raises(quality.GateFailure, match="not_empty"):
        quality.gates(df.filter("k = 2"), {})
    quality.gates(df, {"positive": F.col("v") > 0}, key=["k", "v"], some=F.col("v") > 5)


def test_quarantine(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, "c")], "k int, c string")
    good, bad = quality.quarantine(df, ["k"], ["c"], "repetido")
    assert sorted((r.k, tuple(r.flags)) for r in good.collect()) == [(1, ("repetido",)), (1, ("repetido",)), (3, ())]
    assert [r.k for r in bad.collect()] == [2, 2]


def test_publication_keeps_the_last_valid(spark, tmp_path):
    p = tables.Publication(spark, str(tmp_path / "out"))
    check = lambda _, df: quality.gates(df, {"positive": F.col("v") > 0})
    assert p.publish({"t": spark.createDataFrame([(1,)], "v int")}, check) == 1
    with pytest.raises(quality.GateFailure):
        p.publish({"t": spark.createDataFrame([(-1,)], "v int")}, check)
    assert [r.v for r in p.read("t").collect()] == [1]
    with pytest.raises(tables.StaleWriter):
        p.publish({"t": spark.createDataFrame([(2,)], "v int")}, check, built_on=0)

    def meanwhile(name, df):  # another writer publishes between the write and the claim
        assert tables.Publication(spark, p.root).publish({"t": spark.createDataFrame([(7,)], "v int")}, check) == 2

    with pytest.raises(tables.StaleWriter):
        p.publish({"t": spark.createDataFrame([(3,)], "v int")}, meanwhile, built_on=1)
    assert p.version() == 2 and [r.v for r in p.read("t").collect()] == [7]


def test_three_markets_need_every_pair(spark):
    rows = [("p", "A", "x", "01"), ("p", "B", None, "01"), ("p", "B", None, "02"), ("p", "C", "y", "01"), ("p", "C", "x", "01"), ("p", "C", "x", "02"), ("p", "A", "x", "02"), ("q", "A", "x", "01"), ("q", "B", "x", "02"), ("q", "C", "x", "01")]
    df = spark.createDataFrame(rows, "k string, m string, a string, month string")
    got = [(r.k, r.a_0, r.a_1, r.a_2, r.common_periods, r.rows) for r in match.comparable_combinations(df, ["k"], "m", ["a"], "month", ["A", "B", "C"]).collect()]
    assert got == [("p", "x", None, "x", 2, 6)]  # x and y contradict each other though both fit the unknown


def test_comparability_rules(spark):
    from seriesloom.operators import audit

    def verdict(*changes):
        rows = [dict(m=m, currency="ARS", unit="kg", variety="v", pack="c", prec="D", grade="g") for m in ("A", "B")]
        for k, name, value in changes:
            rows[k][name] = value
        df = spark.createDataFrame([tuple(r.values()) for r in rows], "m string, currency string, unit string, variety string, pack string, prec string, grade string").withColumn("k", F.lit(1))
        return audit.comparability(df, ["k"], "m", ["A", "B"], "currency", "unit", "variety", "pack", "prec", ["variety", "grade"]).first().verdict

    assert verdict() == "comparable" and verdict((1, "m", "A")) == "sin datos" and verdict((1, "currency", "USD")) == "moneda" and verdict((1, "currency", None)) == "moneda"
    assert verdict((1, "unit", "t")) == "unidad" and verdict((0, "variety", "w")) == "variedad" and verdict((0, "pack", None)) == "presentacion" and verdict((0, "prec", "M")) == "frecuencia" and verdict((0, "grade", None)) == "dimensiones"



def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Fecha;Precio $\n"2024\n01";"1;5"\n', encoding="latin-1")
    df = tables.read_delimited(spark, str(tmp_path / "a.csv"), ["fecha", "precio"], sep=";", encoding="ISO-8859-1")
    assert [tuple(r) for r in df.collect()] == [("2024\n01", "1;5")]
    (tmp_path / "b.json").write_text('{"results": [{"k": "x", "v": 1}, {"k": "y", "v": 2}]}')
    assert [tuple(r) for r in tables.read_envelopes(spark, str(tmp_path / "b.json"), "k string, v int").collect()] == [("x", 1), ("y", 2)]
    assert tables.with_lineage(spark.read.text(str(tmp_path / "a.csv"))).select("source_file").first()[0].endswith("a.csv")
    raw = spark.createDataFrame([("1", "2", "3")], ["Fecha de Ope.", "PRECIO", "Precio Dólar"])
    assert tables.map_headers(raw, {"fecha": ["fecha de ope"], "precio": [], "dolar": ["precio dolar"], "nada": []}).first().asDict() == {"fecha": "1", "precio": "2", "dolar": "3", "nada": None}
    block = spark.createDataFrame([("f", 1, "2024"), ("f", 2, None), ("f", 3, "2025"), ("g", 1, None)], "f string, n int, y string")
    assert [r.y for r in tables.carry_header(block, ["f"], "n", "y").orderBy("f", "n").collect()] == ["2024", "2024", "2025", None]


def test_snapshots_accumulate_once(spark, tmp_path):
    src, out, counters = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "n")
    schema = "id string, price int, at int"
    run = lambda: incremental.accumulate_stream(spark.readStream.schema(schema).parquet(src), out, str(tmp_path / "ck"), ["id"], ["price"], ["at"], counters).awaitTermination(60)
    spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 5, 1)], schema).write.mode("append").parquet(src)
    run()
    spark.createDataFrame([("a", 2, 3), ("c", 7, 3), ("b", 5, 3)], schema).write.mode("append").parquet(src)
    run()
    assert sorted(map(tuple, incremental.accumulated_rows(spark, out, schema).collect())) == [("a", 1, 1), ("b", 5, 1), ("c", 7, 3)]
    n = {(r.batch_id, r.state): r.n for r in spark.read.parquet(counters + "/batch=*").collect()}
    assert n == {(0, "first"): 2, (0, "duplicate"): 1, (1, "conflict"): 1, (1, "duplicate"): 1, (1, "first"): 1}


def test_days_are_replaced_whole(spark, tmp_path):
    out, schema = str(tmp_path / "days"), "id int, capture int, day string"
    incremental.replace_days(spark.createDataFrame([(1, 1, "d1"), (2, 1, "d1"), (3, 1, "d2")], schema), out, "day", "capture")
    incremental.replace_days(spark.createDataFrame([(9, 2, "d1")], schema), out, "day", "capture")
    assert sorted((r.id, r.day) for r in spark.read.parquet(out).collect()) == [(3, "d2"), (9, "d1")]
    with pytest.raises(incremental.RepeatedContent):
        incremental.replace_days(spark.createDataFrame([(9, 0, "d1")], schema), out, "day", "capture")
    with pytest.raises(incremental.RepeatedContent):
        incremental.fail_on_conflict(spark.createDataFrame([(1, 1), (1, 2)], "k int, v int"), ["k"], ["v"])


def test_live_window_counts(spark, tmp_path):
    src = str(tmp_path / "ev")
    spark.createDataFrame([("k", dt.datetime(2024, 1, 1, 0, 5)), ("k", dt.datetime(2024, 1, 1, 0, 50)), ("k", dt.datetime(2024, 1, 1, 1, 5))], "k string, ts timestamp").write.parquet(src)
    view = incremental.windowed_counts(spark.readStream.schema("k string, ts timestamp").parquet(src), "ts", ["k"])
    q = view.writeStream.format("memory").queryName("live_counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r.n for r in spark.sql("SELECT n FROM live_counts").collect()) == [1, 2]


def test_shared_folder_needs_a_setting_on_a_cluster(spark, monkeypatch):
    class Elsewhere:
        master = "spark://head:7077"

        class getConf:
            get = staticmethod(lambda name: None)

    class Session:
        sparkContext = Elsewhere

        class conf:
            get = staticmethod(lambda name, default=None: None)

    with pytest.raises(ValueError):
        tables.shared_folder(Session)


def test_intermediates_are_discarded(spark):
    import os

    df = tables.written(spark.range(3))
    folder = tables._made[-1].removeprefix("file:")
    assert df.count() == 3 and os.path.isdir(folder)
    held, tables._made[:] = tables._made[:-1], tables._made[-1:]
    assert tables.discard_intermediates(spark) == 1 and not os.path.exists(folder)
    tables._made[:] = held
