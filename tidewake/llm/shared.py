"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Where that is unset, a temporary folder in local mode, as in tests, and an error on a cluster."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if root is None:
        found = context._jsc.sc().getCheckpointDir()
        if found.isDefined():
            return found.get().rstrip("/")
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='tidewake-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, so a lost executor costs no recomputation.

    The write is a query of its own, run once, so its shuffle files go when it ends.
    """
    path = new_folder(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, True)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Remove the folders behind a materialized table that no later plan reads."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.startswith(("file:", "/")) or "://" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


#: Bytes of an Arrow batch, or of its one row.
BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows and bytes of an Arrow batch: texts may be long, and a whole batch is in memory at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


#: Rows of one key above which its row of facts is broadcast, and the most such keys.
HOT_ROWS, HOT_KEYS = 10_000, 1_000


def join_facts(rows: DataFrame, facts: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """rows with the columns of their key's row in facts, which has the rows of each key in count, total in all.

    Keys with over a thousandth of all rows are HOT_KEYS at most: their facts are
    broadcast, so their rows stay where they are. The others are joined by key.
    facts is a stored table, so to look for such keys is cheap.
    """
    hot = F.col(count) > max(HOT_ROWS, total // HOT_KEYS)
    if not facts.where(hot).limit(1).count():
        return rows.join(facts, keys)
    few = F.broadcast(facts.where(hot))
    return rows.join(few, keys).unionByName(rows.join(few.select(*keys), keys, "left_anti").join(facts.where(~hot), keys))


def unused(name: str, columns: list[str]) -> str:
    """name, with underscores added until no column has it (column names do not tell case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def write_file(path: str, data: bytes, attempt: str = "whole") -> None:
    """Under a name of the attempt's own first, so that no reader sees a part of it."""
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(f"{place}.{attempt}") as out:
        out.write(data)
    store.move(f"{place}.{attempt}", place)


def read_file(path: str) -> bytes:
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path)
    with store.open_input_stream(place) as f:
        return f.read()
