"""Tables that a query writes between its steps, in the folder all executors see: what must not be computed twice."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


class Run(list):
    """Paths of the tables that one run wrote, in a folder of its own."""

    def __init__(self):
        super().__init__()
        self.name = uuid.uuid4().hex


#: The run that tables belong to, apart for each thread.
_run: ContextVar[Run | None] = ContextVar("run", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where that is unset a temporary one, which only a local master can share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidewater-")
    return _local_dirs[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends here, lost executors cost nothing."""
    spark = df.sparkSession
    own = _run.get()
    path = f"{shared_dir(spark)}/tables/{'' if own is None else own.name + '/'}{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if own is not None:
        own.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def run() -> Iterator[Run]:
    """Tables written within belong to a run of their own, whatever other threads write; see ``forget``. What is left of it passes to the run around it."""
    own, around = Run(), _run.get()
    token = _run.set(own)
    try:
        yield own
    finally:
        _run.reset(token)
        if around is not None:
            around += own


def forget(spark: SparkSession, own: Run, since: int = 0, keep: int = 1) -> None:
    """Deletes the tables of a run but for the first ``since`` and the last ``keep``; nothing may read them any more."""
    until = max(since, len(own) - keep)
    for path in own[since:until]:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    del own[since:until]
