"""Demultiplexing of read shards as they arrive in a folder, with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from loomsite.operators.demux import assign

READS = "readID string, index1Seq string, anchorReadSeq string, adriftReadSeq string"


def read_shards(spark: SparkSession, path: str, schema: str | StructType = READS, per_trigger: int = 16) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def assign_stream(shards: DataFrame, samples: DataFrame) -> DataFrame:
    """Stateless: each new read joins the static sample sheet."""
    return assign(shards, samples)


def write_assigned(assigned: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Takes what is there and ends; a later run goes on after it."""
    return assigned.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: The state store that keeps what doesn't fit in memory on executors' disks.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def write_distinct(assigned: DataFrame, checkpoint: str) -> StreamingQuery:
    """Exact removal of duplicates across shards by keyed state: for each pair of sequences
    the state holds the smallest read id and the number of reads so far, of all batches. A
    batch touches the keys that it holds only; the state is in the checkpoint, so a later
    run, on other executors, goes on where the last one ended."""
    return _write_state(assigned.groupBy("anchorReadSeq", "adriftReadSeq").agg(F.min(F.struct("readID", "uniqueSample")).alias("m"), F.count(F.lit(1)).alias("n")), checkpoint)


def _write_state(state: DataFrame, checkpoint: str) -> StreamingQuery:
    spark = state.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        return state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def read_distinct(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(readID, uniqueSample, anchorReadSeq, adriftReadSeq, nDuplicateReads)`` over all
    batches so far: the smallest read id stands for all reads of its pair. It reads the
    last state, one row for each pair, however many batches led to it."""
    rows = spark.read.format("statestore").load(checkpoint)
    first, n = rows.schema["value"].dataType.names
    m = F.col(f"value.`{first}`")
    return rows.select(m["readID"].alias("readID"), m["uniqueSample"].alias("uniqueSample"), "key.anchorReadSeq", "key.adriftReadSeq", (F.col(f"value.`{n}`") - 1).alias("nDuplicateReads"))


def write_counts(assigned: DataFrame, checkpoint: str) -> StreamingQuery:
    """``running_counts`` as state in the checkpoint; no count passes through the driver."""
    return _write_state(running_counts(assigned), checkpoint)


def read_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(uniqueSample, reads)`` over all batches so far, from the last state."""
    rows = spark.read.format("statestore").load(checkpoint)
    return rows.select("key.uniqueSample", F.col(f"value.`{rows.schema['value'].dataType.names[0]}`").alias("reads"))


def running_counts(assigned: DataFrame) -> DataFrame:
    """Reads of each sample so far, for ``complete`` output."""
    return assigned.groupBy("uniqueSample").agg(F.count(F.lit(1)).alias("reads"))
