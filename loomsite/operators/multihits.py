"""Networks of sites that share multi-hit reads."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomsite.functions.dna import posid
from loomsite.operators.fragments import SAMPLE, with_position

_OWN_DIR = "spark.loomsite.operators.dir"


#: Spark's setting to drop a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame) -> DataFrame:
    """Writes a table to the folder that all executors share and reads it back. The shuffle
    files of the write go as it ends: nothing else reads them, and what iterates makes many."""
    spark: SparkSession = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="loomsite-ops-")
        spark.conf.set(_OWN_DIR, base)
    path = f"{base.rstrip('/')}/graph-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def components(nodes: DataFrame, edges: DataFrame, by: list[str]) -> DataFrame:
    """``nodes (*by, node)`` with the smallest node that ``edges (*by, a, b)`` reach, as
    ``component``, within each ``by``. Labels spread along edges and then jump to their
    label's label, so the rounds grow with the logarithm of the longest path."""
    both = edges.select(*by, "a", "b").unionByName(edges.select(*by, F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = saved(both)
    now = saved(nodes.select(*by, "node").distinct().withColumn("component", F.col("node")))
    while True:
        near = both.join(now.withColumnRenamed("node", "b"), [*by, "b"]).groupBy(*by, F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = now.join(near, [*by, "node"], "left").select(*by, "node", F.col("component").alias("old"), F.least("component", F.coalesce("near", "component")).alias("component"))
        step = saved(step)
        jump = step.select(*by, F.col("node").alias("component"), F.col("component").alias("far"))
        new = step.join(jump, [*by, "component"]).select(*by, "node", "old", F.least("component", "far").alias("component"))
        new = saved(new)
        changed = new.where("component < old").limit(1).count()
        now = new.drop("old")
        if not changed:
            return now


def multihit_clusters(multi: DataFrame) -> DataFrame:
    """Clusters of the sites that multi-hit reads of a sample share: ``(trial, subject,
    sample, clusterID, nodes, reads, UMIs, posids, readIDs)``. A read links its sites by a
    star from the first, which has the same components as all its pairs; reads with one
    site make no node."""
    at = with_position(multi).withColumn("posid", posid("chromosome", "strand", "position"))
    rows = at.select(*SAMPLE, "replicate", "readID", "posid", "randomLinkerSeq").distinct()
    read = Window.partitionBy(*SAMPLE, "replicate", "readID")
    rows = saved(rows.withColumn("low", F.min("posid").over(read)).withColumn("high", F.max("posid").over(read)).where("low < high"))
    edges = rows.where("posid <> low").select(*SAMPLE, F.col("low").alias("a"), F.col("posid").alias("b")).distinct()
    of = components(rows.select(*SAMPLE, F.col("posid").alias("node")), edges, SAMPLE)
    joined = rows.join(of.withColumnRenamed("node", "posid"), [*SAMPLE, "posid"])
    out = joined.groupBy(*SAMPLE, "component").agg(
        F.count_distinct("posid").alias("nodes"),
        F.count_distinct("replicate", "readID").alias("reads"),
        F.count_distinct("randomLinkerSeq").alias("UMIs"),
        F.sort_array(F.collect_set("posid")).alias("posids"),
        F.sort_array(F.collect_set("readID")).alias("readIDs"),
    )
    number = F.row_number().over(Window.partitionBy(*SAMPLE).orderBy("component"))
    return out.withColumn("clusterID", F.concat(F.lit("MHC."), number.cast("string"))).drop("component")


def cluster_abundance(clusters: DataFrame, fragments: DataFrame, starts: str | None = None, identity: float = 0.87) -> DataFrame:
    """Adds ``clusterSonicLengths`` (distinct fragments of a cluster's reads) and
    ``nodeSonicLengths`` (those of each site, as an array of structs).

    Fragments are told apart by where their adrift reads start: with ``starts``, a column
    of the first bases of adrift reads, by clusters of like starts, those of most reads
    first, within the multi-hit cluster and within each of its sites, so that a start with
    an error counts once; without, by their breaks."""
    column = starts or "break"
    at = with_position(fragments).withColumn("posid", posid("chromosome", "strand", "position"))
    member = clusters.select(*SAMPLE, "clusterID", F.explode("posids").alias("posid"))
    hits = at.select(*SAMPLE, "readID", "posid", F.col(column).alias("start")).distinct().join(member, [*SAMPLE, "posid"])
    hits = saved(hits.join(clusters.select(*SAMPLE, "clusterID", F.explode("readIDs").alias("readID")), [*SAMPLE, "clusterID", "readID"]))

    def counted(by: list[str], name: str) -> DataFrame:
        if starts is None:
            return hits.groupBy(*by).agg(F.count_distinct("start").alias(name))
        from loomsite.operators.clusters import cluster

        return cluster(hits, by, "start", identity, [F.count_distinct("readID")]).groupBy(*by).agg(F.count_distinct("rep").alias(name))

    whole = [*SAMPLE, "clusterID"]
    node = counted([*whole, "posid"], "n").withColumn("sonicLengths", F.col("n").cast("int"))
    node = node.groupBy(*whole).agg(F.sort_array(F.collect_list(F.struct("posid", "sonicLengths"))).alias("nodeSonicLengths"))
    return clusters.join(counted(whole, "clusterSonicLengths"), whole, "left").join(node, whole, "left")
