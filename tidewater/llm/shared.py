"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.between import Run, forget, run, shared_dir, written

__all__ = ["Run", "forget", "free_name", "parts", "run", "shared_dir", "shuffle_parts", "text_bytes", "written"]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores if ``df`` has such a column already (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of a text column; one scan of that column."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]


def parts(spark: SparkSession, size: int, each: int) -> int:
    """How many parts of ``each`` bytes to deal ``size`` bytes to; small inputs get a part for each MB, up to the shuffle's own number and 64."""
    return max(size // each + 1, min(shuffle_parts(spark), (size >> 20) + 1, 64))
