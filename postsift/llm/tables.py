"""Access to the given tables, and the folder for what is written between steps."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.operators.settle import checkpoint_folder, settle


ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Python workers of this session can import this package from where it lies."""
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Only a session in local mode without one (a test) gets a temporary folder.
    """
    if checkpoint_folder(spark) is None and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
    folder = checkpoint_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return folder


def settled(frame: DataFrame) -> DataFrame:
    """`frame`, written once to the shared folder; later steps do not repeat its computation."""
    shared_folder(frame.sparkSession)
    return settle(frame)


def with_row_key(docs: DataFrame, doc_id: str, text: str, key: str) -> tuple[DataFrame, bool]:
    """The rows with an id, and `key` (bigint): one of its own for every row, in the order of the ids.

    Where ids are unique (the second result) they are the keys. Else rows are sorted by id and
    digest of the text, written down, and numbered in that order; equal rows get a number each.
    """
    named = docs.where(F.col(f"`{doc_id}`").isNotNull())
    ids = F.col(f"`{doc_id}`")
    if not named.groupBy(ids).count().where("count > 1").limit(1).count():
        return named.withColumn(key, ids.cast("bigint")), True
    order = (ids, F.md5(F.col(f"`{text}`")))
    sorted_rows = settled(named.repartitionByRange(*order).sortWithinPartitions(*order))
    return sorted_rows.withColumn(key, F.monotonically_increasing_id()), False


def stored(frame: DataFrame) -> DataFrame:
    """`frame`, written to the shared folder as Parquet and read again."""
    path = f"{shared_folder(frame.sparkSession)}/stored-{uuid.uuid4()}"
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def discard(frame: DataFrame) -> None:
    """Remove the files of a table that `stored` returned, once nothing reads it any more; other files stay."""
    spark = frame.sparkSession
    own = re.compile(re.escape(shared_folder(spark).rstrip("/").split(":", 1)[-1].lstrip("/")) + r"/stored-[0-9a-f-]{36}$")
    for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
        if own.search(folder):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
