import os
import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewater.operators import context as C
from tidewater.sources import tables_on_disk as D
from tidewater.streaming import events as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def streamed(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_windows_agree_with_the_batch(spark, tmp_path):
    spark.read.parquet(f"{SF}/events.parquet").orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    pick = lambda df: {(str(r["window"]["start"]), r["event_type"]): r["n"] for r in df.collect()}
    batch = pick(E.windowed(spark.read.schema(E.EVENTS).parquet(str(tmp_path / "in"))))
    stream = pick(streamed(E.windowed(E.read_events(spark, str(tmp_path / "in"))), "win", "complete"))
    assert stream == batch and batch


def test_repeats_are_dropped(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.unionByName(events).coalesce(1).write.parquet(str(tmp_path / "in"))
    got = streamed(E.first_events(E.read_events(spark, str(tmp_path / "in"))), "dup")
    assert got.count() == events.select("user_id", "event_type", "ts").distinct().count()


def test_context_lasts_over_batches(spark, tmp_path):
    lines = [(1, 1, "A"), (1, 2, None), (2, 1, None), (1, 3, None), (1, 4, "B"), (2, 2, "C"), (2, 3, None)]
    df = spark.createDataFrame(lines, "k int, n int, port string")
    for i, part in enumerate((df.filter("n <= 2"), df.filter("n > 2"))):
        part.coalesce(1).write.parquet(str(tmp_path / f"in/f{i}"))
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    got = {(r["k"], r["n"]): r["port"] for r in streamed(E.carry(source, "k", "n", "port"), "ctx").collect()}
    assert got == {(1, 1): "A", (1, 2): "A", (1, 3): "A", (1, 4): "B", (2, 1): None, (2, 2): "C", (2, 3): "C"}


JOURNAL = ["LONDON.", "MILLWALL DOCKS.", "April 16.", "Sept. 11 Essex (s)-Konigsberg-sleepers-Order", "Fatfield (s)-Memel-deals-Order", "ALLOA.", "May 3.", "April 27. Andreas @ Fredrikstad,—54,266 boards, Nil.", "SURREY DOCKS.", "plain prose", "HULL.", "12 Ann (s)-Riga-deals-Order", ""]


@pytest.mark.parametrize("files", [1, 3, 10])
def test_context_of_a_stream_is_that_of_the_batch(spark, tmp_path, files):
    """Pages come in order, a few to a micro-batch; lines within a file in any order."""
    rng = random.Random(files)
    rows = [(doc, page, n, rng.choice(JOURNAL)) for doc in range(7) for page in range(10) for n in range(rng.randrange(12))]
    schema = "doc int, page int, n int, line string"
    for i in range(files):
        own = [r for r in rows if r[1] * files // 10 == i]
        spark.createDataFrame(rng.sample(own, len(own)), schema).coalesce(1).write.parquet(str(tmp_path / f"in/f{i:02d}"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    got = streamed(E.carry_context(source, "doc", ["page", "n"]), f"context{files}").collect()
    batch = C.carry_context(spark.createDataFrame(rows, schema), ["doc"], ["page", "n"]).select("doc", "page", "n", "port", "month", "day").collect()
    assert sorted(map(str, got)) == sorted(map(str, batch)) and len({r["port"] for r in got}) > 4


def test_idle_keys_are_forgotten(spark, tmp_path):
    schema = "doc int, n int, line string"
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    q = E.carry_context(source, "doc", ["n"], idle_ms=500).writeStream.format("memory").queryName("idle").outputMode("append").trigger(processingTime="100 milliseconds").start()
    try:
        for i, rows in enumerate([[(1, 1, "HULL.")], [(1, 2, "prose")], [(1, 3, "prose")]]):
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/f{i}"))
            for _ in range(200):
                if spark.table("idle").filter(F.col("n") == i + 1).count():
                    break
                time.sleep(0.1)
            time.sleep(5 if i == 1 else 0)
    finally:
        q.stop()
    got = {r["n"]: r["port"] for r in spark.table("idle").collect()}
    assert got[1] == "Hull" and got[3] is None


class Killed(Exception):
    pass


def test_two_tables_of_a_killed_stream_have_each_row_once(spark, tmp_path):
    schema = "id long, items int"
    for i in range(4):
        spark.createDataFrame([(10 * i + k, k % 3) for k in range(10)], schema).coalesce(1).write.parquet(str(tmp_path / f"in/f{i}"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    out, checkpoint, fails = str(tmp_path / "out"), str(tmp_path / "checkpoint"), [True, True]

    def shipments(batch):
        return batch.select("id")

    def cargo(batch):
        """Fails in the middle of the second and third batch, after the first table is written."""
        first = batch.agg(F.min("id")).first()[0]
        if first in (10, 20) and fails[first // 10 - 1]:
            fails[first // 10 - 1] = False
            raise Killed
        return batch.select("id", F.explode(F.sequence(F.lit(0), "items")).alias("item"))

    for ends in (False, False, True):
        q = D.write_tables(source, out, checkpoint, {"shipments": shipments, "cargo": cargo})
        if ends:
            q.awaitTermination()
        else:
            with pytest.raises(StreamingQueryException):
                q.awaitTermination()
            whole = D.read_table(spark, out, "shipments", "id long").count()
            assert whole == D.read_table(spark, out, "cargo", "id long, item int").select("id").distinct().count() and whole in (10, 20)
    assert sorted(r["id"] for r in D.read_table(spark, out, "shipments", "id long").collect()) == list(range(40))
    assert sorted((r["id"], r["item"]) for r in D.read_table(spark, out, "cargo", "id long, item int").collect()) == [(10 * i + k, j) for i in range(4) for k in range(10) for j in range(k % 3 + 1)]
    assert D.read_table(spark, str(tmp_path / "nothing"), "cargo", "id long").count() == 0
