"""Counts along the pipeline, truth evaluation and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomsite.functions.dna import parse_posid
from loomsite.operators.intervals import overlaps

#: The stages at which distinct reads are counted, in their order.
STAGE_LABELS = ("PRD1", "PRD2", "PRD3", "PRD4", "PRD5", "ALR1", "ALR2", "ALR3", "ALR4", "ALR5", "BFR1", "BSF1")


def attrition(stages: dict[str, DataFrame]) -> DataFrame:
    """Distinct reads of each sample replicate at each labelled stage, long form:
    ``(uniqueSample, label, ordinal, reads)``. Tables have ``uniqueSample, readID``."""
    out = None
    for label, df in stages.items():
        n = df.groupBy("uniqueSample").agg(F.count_distinct("readID").alias("reads"))
        n = n.select("uniqueSample", F.lit(label).alias("label"), F.lit(STAGE_LABELS.index(label) + 1).alias("ordinal"), "reads")
        out = n if out is None else out.unionByName(n)
    return out


def attrition_wide(long: DataFrame, labels: list[str] | None = None) -> DataFrame:
    out = long.groupBy("uniqueSample")
    return out.agg(*[F.max(F.when(F.col("label") == x, F.col("reads"))).alias(x) for x in labels or STAGE_LABELS])


def attrition_shares(wide: DataFrame, first: str = "PRD1") -> DataFrame:
    """Wide to long, as shares of the first stage."""
    labels = [c for c in wide.columns if c != "uniqueSample"]
    long = wide.unpivot(["uniqueSample"], labels, "label", "reads")
    return long.join(wide.select("uniqueSample", F.col(first).alias("__first")), "uniqueSample").select("uniqueSample", "label", "reads", (F.col("reads") / F.col("__first")).alias("share"))


def evaluate_recovery(truth: DataFrame, found: DataFrame, width: int = 3, multi_hits: DataFrame | None = None) -> DataFrame:
    """Truth sites ``(trial, subject, sample, posid, nReads, leaderSeq)`` with the found site
    of the same sample and strand within ``width`` bases on both sides that is closest
    (ties: most reads, then the smaller position): ``found, splitSite, posDiff, readDiff,
    leaderSeqDist``. With ``multi_hits``, clusters with an array ``posids``, a site also
    counts as found where no site is near but a member of a cluster of its sample is:
    ``multiHit`` then is true and the differences are null."""
    def placed(df: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
        p = parse_posid("posid")
        return df.select(*[F.col(c).alias(prefix + c) for c in columns], p["chromosome"].alias(prefix + "c"), p["strand"].alias(prefix + "s"), p["position"].alias(prefix + "p"),
                         (p["position"] - width).alias(prefix + "a"), (p["position"] + width).alias(prefix + "b"))

    key = ["trial", "subject", "sample"]
    t = placed(truth, "", [*key, "posid", "nReads", "leaderSeq"])
    g = placed(found, "g_", [*key, "reads", "repLeaderSeq"])
    hits = overlaps(t, g, {**{k: f"g_{k}" for k in key}, "c": "g_c", "s": "g_s"}, ("a", "b"), ("g_a", "g_b"))
    order = Window.partitionBy(*key, "posid").orderBy(F.abs(F.col("p") - F.col("g_p")), F.desc("g_reads"), "g_p")
    hits = hits.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*key, "posid"))).withColumn("rank", F.row_number().over(order)).where("rank = 1")
    hits = hits.select(*key, "posid", (F.col("n") > 1).alias("splitSite"), F.abs(F.col("p") - F.col("g_p")).alias("posDiff"), F.abs(F.col("nReads") - F.col("g_reads")).alias("readDiff"), F.levenshtein("leaderSeq", "g_repLeaderSeq").alias("leaderSeqDist"))
    out = truth.join(hits, [*key, "posid"], "left")
    out = out.withColumn("found", F.col("posDiff").isNotNull()).withColumn("splitSite", F.coalesce("splitSite", F.lit(False)))
    if multi_hits is None:
        return out
    # Members by their places; where a truth site lies near several, one row is enough.
    members = multi_hits.select(*key, F.explode("posids").alias("posid")).withColumn("posid", F.regexp_replace("posid", r"\.\d+$", "")).distinct()
    m = placed(members, "m_", key)
    near = overlaps(t.drop("nReads", "leaderSeq"), m, {**{k: f"m_{k}" for k in key}, "c": "m_c", "s": "m_s"}, ("a", "b"), ("m_a", "m_b")).select(*key, "posid", F.lit(True).alias("__multi")).distinct()
    out = out.join(near, [*key, "posid"], "left").withColumn("multiHit", ~F.col("found") & F.coalesce("__multi", F.lit(False)))
    return out.withColumn("found", F.col("found") | F.col("multiHit")).drop("__multi")


def recovery_summary(evaluated: DataFrame) -> DataFrame:
    """Sites expected and recovered, in percent as sites of their own (unique) and in all."""
    total = F.col("found").cast("int")
    unique = (F.col("found") & ~F.col("multiHit")).cast("int") if "multiHit" in evaluated.columns else total
    n, got = F.count(F.lit(1)), F.sum(unique)
    return evaluated.agg(n.alias("nSitesExpected"), got.alias("nSitesRecovered"), (100.0 * got / n).alias("percentUniqueRecovery"), (100.0 * F.sum(total) / n).alias("percentTotalRecovery"), F.avg("leaderSeqDist").alias("leaderSeqDistMean"), F.stddev_samp("leaderSeqDist").alias("leaderSeqDistSD"))


def site_classes(sites: DataFrame, repeats: DataFrame) -> DataFrame:
    """``(posid, repeat_class)`` of the sites that lie in a repeat."""
    from loomsite.operators.intervals import site_repeats

    p = parse_posid("posid")
    spots = sites.select("posid", p["chromosome"].alias("chromosome"), p["position"].alias("position")).distinct()
    return spots.join(site_repeats(spots, repeats), ["chromosome", "position"]).select("posid", "repeat_class")


def missed_by_class(evaluated: DataFrame, classes: DataFrame, min_share: float = 0.02) -> DataFrame:
    """Missed sites by repeat class (``classes (posid, repeat_class)``; none: ``None``), rare
    classes as ``Other``, with shares."""
    missed = evaluated.where(~F.col("found")).select("posid").join(classes, "posid", "left")
    n = missed.groupBy(F.coalesce("repeat_class", F.lit("None")).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    n = n.join(n.agg(F.sum("n").alias("total")))
    n = n.withColumn("class", F.when(F.col("n") / F.col("total") < min_share, "Other").otherwise(F.col("class")))
    return n.groupBy("class").agg(F.sum("n").alias("n"), F.max(F.lit(100.0) / F.col("total")).alias("one")).select("class", "n", (F.col("n") * F.col("one")).alias("percent"))


def remnant_histogram(sites: DataFrame, column: str = "repLeaderSeqMap", width: int = 5) -> DataFrame:
    """Sites by binned remnant length (the first ``..N`` of a rearrangement string) and
    number of recombinations (its ``;``)."""
    length = F.regexp_extract(column, r"\.\.(\d+)", 1).cast("int")
    joins = F.regexp_count(F.col(column), F.lit(";"))
    return sites.where(F.col(column).isNotNull()).groupBy("sample", (F.floor(length / width) * width).alias("bin"), joins.alias("recombinations")).agg(F.count(F.lit(1)).alias("n"))


def cap_at_rank(df: DataFrame, by: list[str], value: str, share: float = 0.95) -> DataFrame:
    """Values over the one at the ``share`` rank of their group become that one."""
    of = Window.partitionBy(*by)
    ranked = df.withColumn("__r", F.row_number().over(of.orderBy(value))).withColumn("__n", F.count(F.lit(1)).over(of))
    limit = F.max(F.when(F.col("__r") <= F.ceil(F.col("__n") * share), F.col(value))).over(of)
    return ranked.withColumn(value, F.least(F.col(value), limit)).drop("__r", "__n")


def segments(df: DataFrame, column: str = "model") -> DataFrame:
    """One row per segment ``qs..qe[s+e]`` of a rearrangement string, in order, with its
    query range, subject range and strand."""
    parts = F.regexp_extract_all(F.col(column), F.lit(r"\d+\.\.\d+\[\d+[+-]\d+\]"), 0)
    pattern = r"(\d+)\.\.(\d+)\[(\d+)([+-])(\d+)\]"
    rows = df.select("*", F.posexplode(parts).alias("segment", "__s"))
    named = [F.regexp_extract("__s", pattern, i).cast(t).alias(n) for i, (n, t) in enumerate([("qStart", "int"), ("qEnd", "int"), ("sStart", "int"), ("strand", "string"), ("sEnd", "int")], 1)]
    return rows.select(*df.columns, "segment", *named)


def splice_columns(df: DataFrame, names: list[str], after: str) -> DataFrame:
    """``df`` with the columns ``names`` moved behind the column ``after``."""
    rest = [c for c in df.columns if c not in names]
    at = rest.index(after) + 1
    return df.select(*rest[:at], *names, *rest[at:])


def sample_labels(df: DataFrame, labels: DataFrame, pattern: str = "(GTSP\\d+)", sample: str = "sample") -> DataFrame:
    """Adds what an external table ``labels (code, ...)`` says of the code in a sample's name."""
    return df.withColumn("code", F.regexp_extract(sample, pattern, 1)).join(labels, "code", "left")


def alternative_vectors(df: DataFrame, catalogue: DataFrame, vector: str = "vector") -> DataFrame:
    """Vectors replaced by those that ``catalogue (vector, alternative)`` has for them."""
    known = catalogue.select(F.col("vector").alias("__from"), F.col("alternative").alias("__to")).dropDuplicates(["__from"])
    return df.join(known, F.col(vector) == F.col("__from"), "left").withColumn(vector, F.coalesce("__to", vector)).drop("__from", "__to")


def structure_models(reads: DataFrame, by: list[str], seq: str = "seq") -> DataFrame:
    """Structures of each unit with their reads and share of them in percent."""
    n = reads.groupBy(*by, seq).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("percent", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def top_structures(structures: DataFrame, by: list[str], top: int = 10, model: str = "model") -> DataFrame:
    """The ``top`` models of each unit by reads, with their number of segments and share."""
    of = Window.partitionBy(*by)
    n = structures.groupBy(*by, model).agg(F.sum("n").alias("n"))
    n = n.withColumn("share", F.col("n") / F.sum("n").over(of)).withColumn("segments", F.regexp_count(F.col(model), F.lit(";")) + 1)
    return n.withColumn("rank", F.row_number().over(of.orderBy(F.desc("n"), model))).where(F.col("rank") <= top)
