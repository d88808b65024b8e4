import os
import threading

from tidewater.llm import components, shared


def files(df):
    return {f.rsplit("/", 1)[0].removeprefix("file://") for f in df.inputFiles()}


def test_a_run_forgets_its_own_tables_only(spark):
    """Tables of other threads and of runs around it stay."""
    before = shared.written(spark.range(3), "before")
    with shared.run() as outer:
        first = shared.written(spark.range(4), "outer")
        with shared.run() as own:
            tables = [shared.written(spark.range(i), "inner") for i in range(1, 4)]
            made = []
            other = threading.Thread(target=lambda: made.append(shared.written(spark.range(9), "other")))
            other.start()
            other.join()
            paths = [files(t) for t in tables]
            shared.forget(spark, own)
            assert [os.path.exists(*p) for p in paths] == [False, False, True] and len(own) == 1
        assert made[0].count() == 9 and before.count() == 3 and first.count() == 4
        # What the inner run left is the outer one's now.
        shared.forget(spark, outer, keep=0)
        assert not os.path.exists(*paths[2]) and not outer
    assert made[0].count() == 9 and before.count() == 3


def test_components_leave_one_table_of_their_rounds(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with shared.run() as own:
        got = components.star_table(edges)
        assert len(own) == 2  # the edges as given and the last round
        assert {r["root"] for r in got.collect()} == {0} and got.count() == 41
