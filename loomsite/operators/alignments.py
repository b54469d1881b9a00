"""Alignment tables: scores, filters, and what both mates have in common."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def milli_bad(df_mrna: bool = False) -> Column:
    """Mismatches, inserts and size differences per thousand matched bases of a PSL row."""
    q, t = F.col("qEnd") - F.col("qStart"), F.col("tEnd") - F.col("tStart")
    size = F.least(q, t)
    dif = F.when(q - t < 0, F.lit(0) if df_mrna else t - q).otherwise(q - t)
    inserts = F.col("qNumInsert") if df_mrna else F.col("qNumInsert") + F.col("tNumInsert")
    total = F.col("matches") + F.col("repMatches") + F.col("misMatches")
    rounded = F.floor(3 * F.log1p(dif) + 0.5)
    return F.when((size <= 0) | (total == 0), F.lit(0.0)).otherwise(1000.0 * (F.col("misMatches") + inserts + rounded) / total)


def psl_scores(psl: DataFrame, mrna: bool = False) -> DataFrame:
    """Adds ``score`` and ``queryPercentID``: matches less mismatches and inserts (half for
    repeats), and 100 less a tenth of the bad bases per thousand."""
    score = F.col("matches") + F.floor(F.col("repMatches") / 2) - F.col("misMatches") - F.col("qNumInsert") - F.col("tNumInsert")
    return psl.withColumn("score", score.cast("long")).withColumn("queryPercentID", 100.0 - milli_bad(mrna) * 0.1)


def shift_target(psl: DataFrame) -> DataFrame:
    """Half-open target ends become inclusive ones."""
    return psl.withColumn("tEnd", F.col("tEnd") - 1)


def accept(df: DataFrame, min_identity: float = 95, max_inserts: int = 1, max_insert_bases: int = 1, max_query_start: int = 3) -> DataFrame:
    """Alignments of high identity, with few inserts on either side, that begin early."""
    ok = (F.col("queryPercentID") >= min_identity) & (F.col("qStart") <= max_query_start)
    for side in ("q", "t"):
        ok &= (F.col(f"{side}NumInsert") <= max_inserts) & (F.col(f"{side}BaseInsert") <= max_insert_bases)
    return df.where(ok)


def ends_aligned(df: DataFrame, max_unaligned: int = 5) -> DataFrame:
    return df.where(F.col("qSize") - F.col("qEnd") <= max_unaligned)


def both_mates(anchor: DataFrame, adrift: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The alignments of reads of which both mates aligned."""
    ids = anchor.select("readID").intersect(adrift.select("readID"))
    return anchor.join(ids, "readID", "left_semi"), adrift.join(ids, "readID", "left_semi")


def extend_leader(alignments: DataFrame) -> DataFrame:
    """The unaligned start of an anchor read belongs to its leader sequence.
    ``alignments (leaderSeq, anchorReadSeq, qStart)``."""
    return alignments.withColumn("leaderSeq", F.concat("leaderSeq", F.expr("substring(anchorReadSeq, 1, qStart)")))


def accept_hits(hits: DataFrame, min_identity: float = 90, coverage: float = 90, max_gaps: int = 1) -> DataFrame:
    """Local hits (12 columns and ``qlen``) over enough of the query."""
    length = F.abs(F.col("qend") - F.col("qstart")) + 1
    return hits.where((F.col("pident") >= min_identity) & (length >= F.floor(F.col("qlen") * coverage / 100)) & (F.col("gapopen") <= max_gaps))


def best_hits(hits: DataFrame) -> DataFrame:
    """One hit per query: largest bit score, then forward before backward, then place."""
    forward = F.when(F.col("send") >= F.col("sstart"), 0).otherwise(1)
    order = Window.partitionBy("qname").orderBy(F.desc("bitscore"), forward, "sseqid", "sstart", "qstart")
    return hits.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def earliest_hits(hits: DataFrame, max_start: int = 5) -> DataFrame:
    """One hit per query among those that start early: smallest e-value, then place."""
    order = Window.partitionBy("qname").orderBy("evalue", "qstart", F.desc("qend"), "sseqid", "sstart")
    return hits.where(F.col("qstart") <= max_start).withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def accept_models(hits: DataFrame, max_start: int = 5, min_score: float = 20, end_radius: int | None = 2, model_length: str = "hmmLength") -> DataFrame:
    """The best profile hit of each read (score, then the earlier start), if it starts
    early, scores enough and, unless ``end_radius`` is None, ends near the profile's end:
    a read whose best hit fails has none."""
    ok = (F.col("targetStart") <= max_start) & (F.col("fullScore") >= min_score)
    if end_radius is not None:
        ok &= F.col(model_length) - F.col("hmmEnd") <= end_radius
    order = Window.partitionBy("targetName").orderBy(F.desc("fullScore"), "targetStart", "targetEnd")
    return hits.withColumn("__n", F.row_number().over(order)).where("__n = 1").where(ok).drop("__n")


def snap_to_terminal(df: DataFrame, seq: str, end: str, terminal: str = "CA", radius: int = 2) -> DataFrame:
    """Rows whose read has ``terminal`` just before its leader's end; else the end moves to
    the last place within ``radius`` where that holds, and rows without one go."""
    n = len(terminal)
    offsets = sorted(range(-radius, radius + 1), key=lambda d: (d != 0, -d))
    moved = F.coalesce(*[F.when((F.col(end) + d >= n) & (F.expr(f"substring({seq}, {end} + {d} - {n} + 1, {n})") == terminal), F.col(end) + d) for d in offsets])
    return df.withColumn(end, moved).where(F.col(end).isNotNull())


def capture_leader(reads: DataFrame, ends: DataFrame, seq: str = "anchorReadSeq") -> DataFrame:
    """Cuts reads at ``ends (readID, qEnd)``: the start becomes ``leaderSeq``."""
    out = reads.join(ends.select("readID", F.col("qEnd").alias("__end")), "readID")
    out = out.withColumn("leaderSeq", F.expr(f"substring({seq}, 1, __end)"))
    return out.withColumn(seq, F.expr(f"substring({seq}, __end + 1)")).drop("__end")


def force_leaders(reads: DataFrame, maps: DataFrame, length: int, seq: str = "anchorReadSeq") -> DataFrame:
    """Leader ends for all reads: the mapped ones, and ``length`` bases for the others."""
    own = maps.select("readID", "qEnd")
    rest = reads.join(own, "readID", "left_anti").where(F.length(seq) > length).select("readID", F.lit(length).alias("qEnd"))
    return own.unionByName(rest)


def drop_vector_reads(reads: DataFrame, hits: DataFrame, seq: str = "adriftReadSeq") -> DataFrame:
    """Reads whose sequence has no accepted hit: hits are found on distinct sequences and
    concern all reads that share one."""
    return reads.join(hits.select(F.col("qname").alias(seq)).distinct(), seq, "left_anti")


def with_leader_maps(reads: DataFrame, maps: DataFrame) -> DataFrame:
    """The reads that ``maps (readID, ...)`` knows, with its columns; one map for a read."""
    return reads.join(maps.select("readID").distinct(), "readID", "left_semi").join(maps.dropDuplicates(["readID"]), "readID", "left")
