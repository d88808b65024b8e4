"""Lists of names and parts of tables: nulls, ties, repeats and empty tables."""

from pyspark.sql import functions as F

from tidewater.operators import names as S


def test_clean_names(spark):
    raw = [" Riga ", "Riga", "(vide)", "---", "Vide", "12", "x", "", None, "12a", "\tHull"]
    got = S.clean_names(spark.createDataFrame([(r,) for r in raw], "name string"), "name").collect()
    assert sorted(r["name"] for r in got) == ["12a", "Hull", "Riga"]
    assert S.clean_names(spark.createDataFrame([], "name string"), "name").count() == 0


def test_extended(spark):
    lists = [spark.createDataFrame([(n,) for n in names], "name string") for names in (["a", "b", None], ["b", "c", None])]
    assert sorted((r["name"] or "") for r in S.extended(*lists, "name").collect()) == ["", "a", "b", "c"]


def test_part_without_repeats(spark):
    rows = [(1, "o", "x"), (2, "o", "x"), (3, "o", None), (4, "o", None), (5, "p", "x"), (6, "p", "x"), (7, None, "x"), (8, None, "x")]
    df = spark.createDataFrame(rows, "id int, port string, sig string")
    assert sorted(r["id"] for r in S.without_repeats_where(df, F.col("port") == "o", ["sig"], "id").collect()) == [1, 3, 5, 6, 7, 8]
    assert S.without_repeats_where(df.limit(0), F.col("port") == "o", ["sig"], "id").count() == 0
