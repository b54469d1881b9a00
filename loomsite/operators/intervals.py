"""Joins and merges of genomic intervals (1-based, both ends included).

Overlaps are found by equi-joins on bins: each interval is dealt to the bins it touches,
and a pair that shares several bins comes out of the first of them only. So a plan has
hash keys to shuffle on, whatever the sizes, and no nested loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsite.operators.scans import running

#: Bases of a bin: a little over the usual interval, so that most touch one or two.
BIN = 1 << 14


def overlaps(left: DataFrame, right: DataFrame, on: dict[str, str], left_range: tuple[str, str], right_range: tuple[str, str], max_gap: int = 0, bin_size: int = BIN) -> DataFrame:
    """All columns of both sides for each pair of intervals that overlap or are
    ``max_gap`` bases apart at most. ``on`` maps equal columns (chromosome, strand) of
    the left side to the right one's; column names of both sides must differ."""
    ls, le = (F.col(c) for c in left_range)
    rs, re = (F.col(c) for c in right_range)

    def binned(df: DataFrame, a, b):
        return df.withColumn("__bin", F.explode(F.sequence(F.floor(a / bin_size), F.floor(b / bin_size))))

    a = binned(left.where(ls <= le), ls - max_gap, le + max_gap)
    b = binned(right.where(rs <= re), rs, re).withColumnRenamed("__bin", "__rbin")
    keys = [F.col(x) == F.col(y) for x, y in on.items()] + [F.col("__bin") == F.col("__rbin")]
    first = F.col("__bin") == F.greatest(F.floor((ls - max_gap) / bin_size), F.floor(rs / bin_size))
    joined = a.join(b, [*keys, ls - max_gap <= re, rs <= le + max_gap, first])
    return joined.drop("__bin", "__rbin")


def merge(df: DataFrame, by: list[str], start: str = "start", end: str = "end", min_gap: int = 1) -> DataFrame:
    """Merges the intervals of each group that overlap or have fewer than ``min_gap``
    bases between them -> ``(*by, start, end, n)`` with the number merged."""
    known = running(df.select(*by, start, end), by, start, {"__far": ("max", end)}, ties=[end], earlier=True)
    new = F.when(F.col("__far").isNull() | (F.col(start) - F.col("__far") - 1 >= min_gap), 1).otherwise(0)
    # Of rows with one start one at most begins an island, and all of them are in it.
    marked = running(known.withColumn("__new", new), by, start, {"__island": ("sum", "__new")})
    return marked.groupBy(*by, "__island").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count(F.lit(1)).alias("n")).drop("__island")


def nearest(points: DataFrame, features: DataFrame, point: tuple[str, str], feature: tuple[str, str, str]) -> DataFrame:
    """The features nearest to each distinct point, ties kept, strand ignored.

    ``point`` names (chromosome, position), ``feature`` (chromosome, start, end); column
    names must differ. -> ``(point columns, feature columns, distance int)``: distance is
    the number of bases between, 0 for overlapping and for adjacent intervals. Points
    whose chromosome has no feature are left out.

    Points and feature bounds are merged in one order: the largest end at or before a point
    and the smallest start at or after it are running aggregates, worked out in bins with
    carries (``scans``). Joining back on these two bounds brings in ties, and overlapping
    features come from the binned join.
    """
    pc, pp = point
    fc, fs, fe = feature
    spots = points.select(pc, pp).distinct()
    inside = overlaps(spots.withColumn("__end", F.col(pp)), features, {pc: fc}, (pp, "__end"), (fs, fe)).drop("__end").withColumn("distance", F.lit(0))
    outside = spots.join(inside.select(pc, pp).distinct(), [pc, pp], "left_anti")
    bounds = features.select(F.col(fc).alias("__c"), F.col(fe).alias("__at"), F.col(fe).alias("__end"), F.lit(None).cast("int").alias("__start"))
    bounds = bounds.unionByName(features.select(F.col(fc).alias("__c"), F.col(fs).alias("__at"), F.lit(None).cast("int").alias("__end"), F.col(fs).alias("__start")))
    both = bounds.withColumn("__p", F.lit(None).cast("int")).unionByName(outside.select(F.col(pc).alias("__c"), F.col(pp).alias("__at"), F.lit(None).cast("int").alias("__end"), F.lit(None).cast("int").alias("__start"), F.col(pp).alias("__p")))
    near = running(both, ["__c"], "__at", {"__before": ("max", "__end")})
    near = running(near, ["__c"], "__at", {"__after": ("min", "__start")}, backwards=True).where("__p is not null")
    gap_before, gap_after = F.col("__p") - F.col("__before") - 1, F.col("__after") - F.col("__p") - 1
    near = near.withColumn("distance", F.least(gap_before, gap_after)).where("distance is not null")
    left = near.where(gap_before == F.col("distance")).join(features, (F.col("__c") == F.col(fc)) & (F.col("__before") == F.col(fe)))
    right = near.where(gap_after == F.col("distance")).join(features, (F.col("__c") == F.col(fc)) & (F.col("__after") == F.col(fs)))
    columns = [F.col("__c").alias(pc), F.col("__p").alias(pp), *features.columns, F.col("distance").cast("int").alias("distance")]
    found = left.select(*columns).unionByName(right.select(*columns)).distinct()
    return found.unionByName(inside.select(*found.columns))


def nearest_genes(points: DataFrame, genes: DataFrame, exons: DataFrame, point: tuple[str, str] = ("chromosome", "position")) -> DataFrame:
    """Nearest gene of each distinct (chromosome, position).

    ``genes`` and ``exons`` have ``(chromosome, start, end, strand, name2)``. A position in
    an exon takes the genes of all exons that it is in; others take the nearest genes.
    -> ``nearestGene, nearestGeneStrand`` (sorted, comma separated), ``nearestGeneDist,
    inGene, inExon, beforeNearestGene`` (null where the distance is 0)."""
    pc, pp = point

    def named(df: DataFrame) -> DataFrame:
        return df.select(F.col("chromosome").alias("__fc"), F.col("start").alias("__fs"), F.col("end").alias("__fe"), F.col("strand").alias("__strand"), F.col("name2").alias("__name"))

    def labels(df: DataFrame) -> DataFrame:
        def joined(c: str):
            return F.array_join(F.sort_array(F.collect_set(c)), ", " if c == "__name" else ",")

        return df.groupBy(pc, pp).agg(joined("__name").alias("nearestGene"), joined("__strand").alias("nearestGeneStrand"), F.min("distance").alias("nearestGeneDist"), F.min("__fs").alias("__first"))

    spots = points.select(pc, pp).distinct()
    exon = overlaps(spots.withColumn("__end", F.col(pp)), named(exons), {pc: "__fc"}, (pp, "__end"), ("__fs", "__fe")).withColumn("distance", F.lit(0))
    exon = labels(exon).withColumn("inExon", F.lit(True))
    gene = labels(nearest(spots.join(exon, [pc, pp], "left_anti"), named(genes), (pc, pp), ("__fc", "__fs", "__fe"))).withColumn("inExon", F.lit(False))
    both = exon.unionByName(gene)
    touching = F.col("nearestGeneDist") == 0
    return both.select(pc, pp, "nearestGene", "nearestGeneStrand", "nearestGeneDist", touching.alias("inGene"), "inExon", F.when(~touching, F.col(pp) < F.col("__first")).alias("beforeNearestGene"))


def transcript_points(genes: DataFrame, mode: str = "either") -> DataFrame:
    """Gene intervals for nearest-gene calls: whole, or the one base that a mode names:
    ``start`` and ``end`` of transcription follow the strand, ``center`` is the middle."""
    if mode == "either":
        return genes
    plus = F.col("strand") == "+"
    at = {"start": F.when(plus, F.col("start")).otherwise(F.col("end")), "end": F.when(plus, F.col("end")).otherwise(F.col("start")), "center": F.floor((F.col("start") + F.col("end")) / 2).cast("int")}[mode]
    return genes.withColumn("__at", at).withColumn("start", F.col("__at")).withColumn("end", F.col("__at")).drop("__at")


def site_repeats(points: DataFrame, repeats: DataFrame, point: tuple[str, str] = ("chromosome", "position")) -> DataFrame:
    """-> names and classes (sorted, comma separated) of the repeats that each distinct
    position lies in; only those in one. Strand C counts as -, others than + and - go."""
    pc, pp = point
    known = repeats.withColumn("strand", F.when(F.col("strand") == "C", "-").otherwise(F.col("strand"))).where(F.col("strand").isin("+", "-"))
    known = known.select(F.col("query_seq").alias("__fc"), F.col("query_start").alias("__fs"), F.col("query_end").alias("__fe"), "repeat_name", "repeat_class")
    hits = overlaps(points.select(pc, pp).distinct().withColumn("__end", F.col(pp)), known, {pc: "__fc"}, (pp, "__end"), ("__fs", "__fe"))
    return hits.groupBy(pc, pp).agg(*[F.array_join(F.sort_array(F.collect_set(c)), ", ").alias(c) for c in ("repeat_name", "repeat_class")])


def multihit_repeats(clusters: DataFrame, repeats: DataFrame) -> DataFrame:
    """For clusters with ``clusterID`` and an array ``posids``: the repeat class of most of
    their positions (ties: the first by name) and its percentage of all of them; null
    where none lies in a repeat."""
    from loomsite.functions.dna import parse_posid

    nodes = clusters.select("clusterID", F.explode("posids").alias("posid"))
    parts = parse_posid("posid")
    nodes = nodes.select("clusterID", "posid", parts["chromosome"].alias("chromosome"), parts["position"].alias("position"))
    hit = nodes.join(site_repeats(nodes, repeats), ["chromosome", "position"], "left")
    n = hit.groupBy("clusterID").agg(F.count_distinct("posid").alias("nodes"))
    top = hit.where("repeat_class is not null").groupBy("clusterID", "repeat_class").agg(F.count_distinct("posid").alias("k"))
    top = top.groupBy("clusterID").agg(F.min(F.struct((-F.col("k")).alias("k"), "repeat_class")).alias("m"))
    return n.join(top, "clusterID", "left").select("clusterID", F.col("m.repeat_class").alias("topRepeatClass"), (-100.0 * F.col("m.k") / F.col("nodes")).alias("topRepeatPercent"))


def leader_maps(sites: DataFrame, maps: DataFrame) -> DataFrame:
    """Adds ``repLeaderSeqMap`` to sites by their vector and leader sequence."""
    known = maps.select("vector", F.col("leaderSeq").alias("repLeaderSeq"), F.col("leaderSeqMap").alias("repLeaderSeqMap")).dropDuplicates(["vector", "repLeaderSeq"])
    return sites.join(known, ["vector", "repLeaderSeq"], "left")
