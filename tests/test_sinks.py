import random

import pytest
from pyspark.sql import functions as F

from tidewater.sources import files
from tidewater.sources import tables_on_disk as D


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert D.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        D.read_version(spark, path)
    assert D.write_version(spark.range(3).withColumn("v", F.lit("a")), path) == 1
    first = D.read_version(spark, path)
    # The table is read and written anew in one step, and what was read stays readable.
    assert D.write_version(first.withColumn("v", F.upper("v")).filter("id > 0"), path) == 2
    assert sorted(map(tuple, D.read_version(spark, path).collect())) == [(1, "A"), (2, "A")]
    assert sorted(map(tuple, D.read_version(spark, path, 1).collect())) == sorted(map(tuple, first.collect())) == [(0, "a"), (1, "a"), (2, "a")]
    assert D.write_version(D.read_version(spark, path).limit(0), path) == 3
    assert D.read_version(spark, path).count() == 0
    D.drop_versions(spark, path)
    assert D.current_version(spark, path) == 3 and D.read_version(spark, path, 2).count() == 2
    with pytest.raises(Exception):
        D.read_version(spark, path, 1).count()


def test_a_version_that_another_writer_took_isnt_replaced(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    D.write_version(spark.range(1), path)
    D.write_version(spark.range(2), path)
    monkeypatch.setattr(D, "current_version", lambda *_: 1)  # as if the second had come meanwhile
    with pytest.raises(Exception):
        D.write_version(spark.range(9), path)
    monkeypatch.undo()
    assert D.read_version(spark, path).count() == 2


@pytest.mark.parametrize("files", [1, 8])
def test_files_by_name_give_the_order(spark, tmp_path, files):
    rng = random.Random(31)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None, "c"]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "year int, port string, i int").repartition(5)
    path = str(tmp_path / "sorted")
    D.write_ordered(df, path, ["year", F.desc("port"), "i"], files)
    got = [tuple(r) for f in D.ordered_files(spark, path) for r in spark.read.parquet(f).coalesce(1).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, [-ord(c) for c in r[1] or "\xff"] if r[1] else [1], r[2])
    assert got == sorted(rows, key=key) and len(D.ordered_files(spark, path)) <= files
    plan = df.repartitionByRange(files, "year").sortWithinPartitions("year")._jdf.queryExecution().executedPlan().toString()
    assert files == 1 or "rangepartitioning" in plan
    with pytest.raises(Exception):
        D.write_ordered(df, path, ["i"], files)


def test_review_files_in_any_encoding_and_their_actions(spark, tmp_path):
    head = "port_type,original_port,ship_count,best_match_canonical,similarity_score,normalization_tier,year_range,action,map_to_port,notes,web_search_query"
    body = [f"{files.INSTRUCTIONS},,,,,,,,,read me,", "origin,Gävle,3,Gavle,0.9,fuzzy,1883,MAP,Gävle,,", "origin,Riga,1,,,,,,,,", "origin,X,1,,,,, skip ,,,", "origin,Y,1,,,,,error,,,"]
    for name in ("utf-8", "iso-8859-1"):
        path = tmp_path / name
        path.write_bytes("\n".join([head, *body]).encode(name))
        rows = files.read_review(spark, str(path))
        assert [r["original_port"] for r in rows.collect()] == ["Gävle", "Riga", "X", "Y"]
        assert [r["original_port"] for r in files.undecided(rows).collect()] == ["Riga"]
        assert [tuple(r) for r in files.unknown_actions(rows).collect()] == [("SKIP", 1)]
    # K7: what is written with the instruction row first is read without it.
    out = files.with_instructions(rows, "how to").orderBy("position").drop("position")
    files.write_csv(out.coalesce(1), str(tmp_path / "out"), rows.columns)
    assert sorted(r["original_port"] for r in files.read_review(spark, str(tmp_path / "out")).collect()) == ["Gävle", "Riga", "X", "Y"]


def test_json_lines_and_text_go_both_ways(spark, tmp_path):
    rows = [(1, "a \"b\"\n", None), (2, "é", 3.5), (3, None, None)]
    schema = "id long, s string, x double"
    files.write_json(spark.createDataFrame(rows, schema), str(tmp_path / "json"))
    assert sorted(map(tuple, spark.read.schema(schema).json(str(tmp_path / "json")).collect())) == rows
    # K10: plain text, a line each.
    spark.createDataFrame([("one",), ("",), ("zwei ü",)], "value string").coalesce(1).write.text(str(tmp_path / "text"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "text")).collect()) == ["", "one", "zwei ü"]


def test_images_are_listed_by_their_names(spark, tmp_path):
    (tmp_path / "below").mkdir()
    for name in ("b.png", "a.JPG", "c.jpeg", "d.txt", "below/e.png"):
        (tmp_path / name).write_bytes(b"\x89" * 3)
    names = lambda **k: sorted(r["path"].rsplit("/", 1)[1] for r in files.images(spark, str(tmp_path), **k).collect())
    assert names() == ["a.JPG", "b.png", "c.jpeg"] and names(recursive=True) == ["a.JPG", "b.png", "c.jpeg", "e.png"]
    assert {r["length"] for r in files.images(spark, str(tmp_path)).collect()} == {3}
