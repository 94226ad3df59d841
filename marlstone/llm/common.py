"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as a regular expression class body.
WS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only where the session names none and runs on one machine (tests) a temporary
    folder is made, set for the session and removed at exit.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="marlstone-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        folder = f"file://{folder}"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


class Tidy:
    """Removes, at its end, the tables that :func:`cut` made inside and that were not kept."""

    _open: list[Tidy] = []

    def __enter__(self) -> Tidy:
        self._made: list[DataFrame] = []
        Tidy._open.append(self)
        return self

    def keep(self, *tables: DataFrame) -> None:
        """Leave these to whoever opened the Tidy around this one."""
        paths = {getattr(t, "_marlstone_path", None) for t in tables}
        outer = Tidy._open[-2]._made if len(Tidy._open) > 1 else []
        outer += [t for t in self._made if t._marlstone_path in paths]
        self._made = [t for t in self._made if t._marlstone_path not in paths]

    def __exit__(self, kind, *_) -> None:
        Tidy._open.pop()
        for made in self._made:
            drop(made)


def cut(df: DataFrame, name: str = "cut", **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    A lost executor then costs a re-read, never a recomputation.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._marlstone_path = path
    if Tidy._open:
        Tidy._open[-1]._made.append(out)
    return out


def drop(df: DataFrame) -> None:
    """Remove the files behind a table made by :func:`cut` that nothing needs any more."""
    path = getattr(df, "_marlstone_path", None)
    if path:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: What one broadcast side may take by estimate; beyond it sides are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def hinted(side: DataFrame, row_bytes: Column | int) -> DataFrame:
    """``side`` with a broadcast hint if its rows' estimated bytes, summed first, are few enough."""
    total = side.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes)).first()[0] or 0
    return F.broadcast(side) if total <= BROADCAST_BYTES else side


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores after it as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column].cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than ``[\\x20\\x09-\\x0D]``."""
    bare = F.regexp_replace(text, f"^[{WS}]+|[{WS}]+\\z", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{WS}]+", -1))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches small enough for long texts, for the queries that run from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
