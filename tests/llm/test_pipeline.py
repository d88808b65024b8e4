import os

import pytest

import corpus_pipeline
from tidewater.llm import rules

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages_keep_what_they_should(spark):
    """Each stage against a plain version of its decisions on the same rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, seen = seen, corpus_pipeline.written(stage(spark, seen, SF), "test")
        assert seen.columns == columns
        a, b = ({r["doc_id"]: r["text"] for r in x.collect()} for x in (before, seen))
        assert set(b) <= set(a)
        if name == "quality rules":
            kept = {r["doc_id"] for r in rules.query(before, spark.read.parquet(f"{SF}/labels.parquet")).filter("kept").collect()}
            assert set(b) == kept and all(a[k] == b[k] for k in b)
        if name == "near-duplicates":
            assert len(set(b.values())) == len(b) and set(b.values()) <= set(a.values())
            assert all(min(k for k in a if a[k] == a[x]) == x for x in b)
        if name == "repeated passages":
            first = {}
            for k in sorted(a):
                data = a[k].encode()
                gone = bytearray(len(data))
                strings = [data[i : i + 50] for i in range(len(data) - 49)]
                for i, s in enumerate(strings):
                    if s in first:
                        gone[i : i + 50] = b"\x01" * 50
                first.update(dict.fromkeys(strings))
                assert b[k] == bytes(c for c, g in zip(data, gone) if not g).decode(errors="replace")
        if name == "personal data":
            assert set(a) == set(b) and not any("@mail" in t for t in b.values())
    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert set(packed["doc_id"]) == {r["doc_id"] for r in seen.collect()}
    for _, part in packed.sort_values("offset").groupby("sequence_id"):
        ends = part["length"].cumsum()
        assert (part["offset"] == ends - part["length"]).all() and ends.iloc[-1] <= 4096
