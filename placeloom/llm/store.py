"""Tables between the steps of one operator, kept where every executor sees them."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def settled(spark: SparkSession) -> SparkSession:
    """The session with batches of a size at which long texts fit a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; a folder of our own only where none is set and Spark runs in one process."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """`df` written as a Parquet table in the shared folder and read back: lineage ends here, row numbers stay as written."""
    path = new_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of `stored` that no later step reads."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """`name`, or a longer one where `df` has that column."""
    while name in df.columns:
        name = f"_{name}"
    return name


def numbered(docs: DataFrame, row: str | None = None) -> DataFrame:
    """(_row, doc_id, text): rows told apart by a number, so repeated and NULL ids are no matter. It is taken from the column `row`, or
    follows the scan of `docs`, which is then a table that is read."""
    return docs.select((F.col(row) if row else F.monotonically_increasing_id()).alias("_row"), "doc_id", "text")


def remainder(doc_id, n: int):
    """crc32(doc_id as text) mod n; a NULL id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))
