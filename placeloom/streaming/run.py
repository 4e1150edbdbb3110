"""Running a packet query to the end of its input."""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _drain(spark: SparkSession, out: DataFrame, folder: str, mode: str) -> list:
    """Everything there is goes through `out` into `folder`; the progress of its micro-batches."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        query = (out.writeStream.format("parquet").outputMode(mode).option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
    return query.recentProgress


def run_to_end(spark: SparkSession, source: DataFrame, build: Callable[[DataFrame], DataFrame], folder: str, mode: str = "append") -> DataFrame:
    """Write `build(source)` to Parquet under `folder` with an available-now trigger and read it back. State and progress live
    under `folder`, so a restart with the same folder goes on where it stopped."""
    out = build(source)
    _drain(spark, out, folder, mode)
    return spark.read.schema(out.schema).parquet(f"{folder}/out")


def run_deliveries(spark: SparkSession, rows: DataFrame, delivery: str, build: Callable[[DataFrame], DataFrame], folder: str,
                   state_rows: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Hand `rows` to the stream `build(source)` delivery by delivery, in order of the integer column `delivery`, which must not be NULL: each
    is appended to the source folder and drained before the next, with state and watermark carried on under `folder`.

    Gives what the stream wrote, and (delivery, n_rows, n_dropped): rows read and rows that came behind the watermark, both from the
    query's progress. Operators that aggregate before their state count groups there, not rows. `state_rows` names one more column: the rows that
    the state holds after the delivery."""
    numbers = [r[0] for r in rows.select(delivery).distinct().orderBy(delivery).collect()]
    arrived, seen = f"{folder}/in", []
    rows.write.partitionBy(delivery).parquet(f"{folder}/waiting")
    schema = rows.schema
    out = None
    for number in numbers:
        spark.read.schema(schema).parquet(f"{folder}/waiting").filter(F.col(delivery) == number).write.mode("append").parquet(arrived)
        out = build(spark.readStream.schema(schema).parquet(arrived))
        steps = _drain(spark, out, folder, "append")
        held = [sum(o.numRowsTotal for o in p.stateOperators) for p in steps[-1:]]
        seen.append((number, sum(p.numInputRows for p in steps), sum(o.numRowsDroppedByWatermark for p in steps for o in p.stateOperators), *(held if state_rows else [])))
    result = spark.read.schema(out.schema).parquet(f"{folder}/out") if numbers else rows.limit(0)
    return result, spark.createDataFrame(seen, f"{delivery} int, n_rows long, n_dropped long" + (f", {state_rows} long" if state_rows else ""))


def fresh(folder: str) -> str:
    return f"{folder}/stream-{uuid.uuid4().hex}"
