"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step handles at once; a longer text is a step of its own.
STEP_BYTES = 1 << 20

_OWN_DIR = "spark.loomsite.shared.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or where
    that is unset, under a ``local`` master only, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_DIR, None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="loomsite-")
        spark.conf.set(_OWN_DIR, found)
    return found.rstrip("/")


#: Spark's setting to drop a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, tag: str, release: bool = False) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back: it cuts the
    lineage, and a lost executor costs no recomputation of what lies before it.
    ``release`` drops the shuffle files of the write as soon as it ends, for large ones."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, str(release or before == "true").lower())
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Executors keep shuffle files until the driver forgets the plans that made them, which
    it does at its next full collection. Before a step with large shuffles of its own, this
    asks for one, so that the files of steps that ended don't add to it."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))).alias("h"),
    ).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges (a, b)`` of integers, undirected, -> ``(id, component)`` for every id
    that has an edge to another id; ``component`` is the smallest id reachable.

    Alternates large-star and small-star steps. Each is a map-side combined ``min``
    and an equi-join, so that a hub's rows can be split; each round is written to the
    shared folder. The number of rounds grows with the logarithm of the longest path.
    """
    pairs = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = materialize(pairs.distinct(), "cc")
    seen = _fingerprint(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        new = materialize(small.select("e.*").where("a <> b").distinct(), "cc")
        got = _fingerprint(new)
        now, same = new, got == seen
        seen = got
        if same:
            break
    root = now.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(root).distinct()
