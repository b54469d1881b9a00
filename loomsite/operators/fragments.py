"""Fragments: what a pair of aligned reads covers, its weight, bundling and sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomsite.functions.dna import break_of, integrase_shift, oriented_strand, posid, position_of

SAMPLE = ["trial", "subject", "sample"]
PLACE = ["chromosome", "strand", "fragStart", "fragEnd"]


def with_position(df: DataFrame) -> DataFrame:
    """Adds ``position`` (the integration site) and ``break`` (the other end)."""
    return df.withColumn("position", position_of("strand", "fragStart", "fragEnd")).withColumn("break", break_of("strand", "fragStart", "fragEnd"))


def _top(df: DataFrame, by: list[str], value: str, *order) -> DataFrame:
    """One row per key: its ``value`` that comes first by ``order``, then by itself."""
    return df.groupBy(*by).agg(F.min_by(value, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col(value).alias("v"))).alias(value))


def pair_mates(anchor: DataFrame, adrift: DataFrame, min_width: int = 40, max_width: int = 100_000, query_start: bool = False) -> DataFrame:
    """Fragments of reads whose two mates aligned to one chromosome on opposite strands
    with the anchor first: a many-to-many join on (readID, tName) with residual
    conditions. Alignments have 0-based ``tStart`` and inclusive ``tEnd``; fragments are
    1-based and inclusive. -> ``(readID, chromosome, strand, fragStart, fragEnd)``, with
    ``query_start`` also the smallest ``qStart`` of the anchor alignments behind each."""
    more = [F.col("qStart")] if query_start else []
    a = anchor.select("readID", "tName", F.col("strand").alias("s"), F.col("tStart").alias("as"), F.col("tEnd").alias("ae"), *more)
    d = adrift.select("readID", "tName", F.col("strand").alias("ds"), F.col("tStart").alias("bs"), F.col("tEnd").alias("be"))
    plus = F.col("s") == "+"
    start = F.when(plus, F.col("as")).otherwise(F.col("bs")) + 1
    end = F.when(plus, F.col("be")).otherwise(F.col("ae")) + 1
    both = a.join(d, ["readID", "tName"]).where(F.col("s") != F.col("ds"))
    both = both.select("readID", F.col("tName").alias("chromosome"), F.col("s").alias("strand"), start.alias("fragStart"), end.alias("fragEnd"), *more)
    width = F.col("fragEnd") - F.col("fragStart") + 1
    both = both.where(width.between(min_width, max_width))
    return both.groupBy("readID", *PLACE).agg(F.min("qStart").alias("qStart")) if query_start else both.distinct()


def cap_placements(anchor: DataFrame, adrift: DataFrame, most: int = 1500) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(anchor, adrift, excluded): without the reads that have over ``most`` placements of
    both mates, and those reads with both counts."""
    counts = anchor.groupBy("readID").agg(F.count(F.lit(1)).alias("anchorPlacements")).join(adrift.groupBy("readID").agg(F.count(F.lit(1)).alias("adriftPlacements")), "readID")
    excluded = counts.where((F.col("anchorPlacements") > most) & (F.col("adriftPlacements") > most))
    return anchor.join(excluded, "readID", "left_anti"), adrift.join(excluded, "readID", "left_anti"), excluded


def salvage_mates(anchor: DataFrame, adrift: DataFrame, reads: DataFrame, per_read: int = 500, reach: int = 100_000, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """For reads with too many placements: ``per_read`` anchor placements each, chosen by a
    hash, and the adrift placements on the opposite strand within ``reach`` of one."""
    order = Window.partitionBy("readID").orderBy(F.md5(F.concat_ws("~", "readID", "tName", "strand", F.col("tStart").cast("string"), F.lit(str(seed)))), "tName", "strand", "tStart")
    few = anchor.join(reads.select("readID"), "readID", "left_semi").withColumn("__n", F.row_number().over(order)).where(f"__n <= {per_read}").drop("__n")
    plus = F.col("strand") == "+"
    span = few.select("readID", "tName", F.col("strand").alias("__s"), F.when(plus, F.col("tStart")).otherwise(F.col("tEnd") - reach).alias("__lo"), F.when(plus, F.col("tStart") + reach).otherwise(F.col("tEnd")).alias("__hi"))
    near = adrift.join(span, ["readID", "tName"]).where((F.col("strand") != F.col("__s")) & F.col("tStart").between(F.col("__lo"), F.col("__hi")) & F.col("tEnd").between(F.col("__lo"), F.col("__hi")))
    return few, near.select(*adrift.columns).distinct()


def read_weight(fragments: DataFrame, by: list[str]) -> DataFrame:
    """Reads behind each key: distinct reads and the duplicates that they stand for."""
    return fragments.groupBy(*by).agg((F.count_distinct("readID") + F.sum("nDuplicateReads")).alias("reads"))


def bundle(fragments: DataFrame, min_reads: int = 1) -> DataFrame:
    """One row for each distinct fragment of a replicate: reads, sorted read ids and
    molecular tags, and the leader sequence of most reads (ties: the first by letters)."""
    by = [*SAMPLE, "replicate", *PLACE]
    out = fragments.groupBy(*by).agg(
        (F.count_distinct("readID") + F.sum("nDuplicateReads")).alias("reads"),
        F.sort_array(F.collect_set("readID")).alias("readIDs"),
        F.sort_array(F.collect_set("randomLinkerSeq")).alias("rUMI_list"),
        F.min("flags").alias("flags"),
    )
    leader = fragments.groupBy(*by, "leaderSeq").agg(F.count_distinct("readID").alias("n"))
    leader = _top(leader, by, "leaderSeq", -F.col("n")).withColumnRenamed("leaderSeq", "repLeaderSeq")
    return out.join(leader, by).where(F.col("reads") >= min_reads)


def positions_per_read(fragments: DataFrame) -> DataFrame:
    """-> ``(trial, subject, sample, replicate, readID, positions, multi)``: distinct sites
    of each read; a read with several is a multi-hit."""
    by = [*SAMPLE, "replicate", "readID"]
    return with_position(fragments).groupBy(*by).agg(F.count_distinct("chromosome", "strand", "position").alias("positions")).withColumn("multi", F.col("positions") > 1)


def salvage_multihits(multi: DataFrame, unique: DataFrame) -> DataFrame:
    """The rows of multi-hit reads at the one site of theirs that the subject's uniquely
    placed reads know, for reads for which there is exactly one such site."""
    site = ["chromosome", "strand", "position"]
    known = with_position(unique).select("trial", "subject", *site).distinct()
    at = with_position(multi).join(known, ["trial", "subject", *site], "left_semi")
    by = [*SAMPLE, "replicate", "readID"]
    single = at.groupBy(*by).agg(F.count_distinct(*site).alias("k")).where("k = 1").select(*by)
    return at.join(single, by, "left_semi").drop("position", "break")


def correct_fuzzy_breaks(fragments: DataFrame) -> DataFrame:
    """Keeps the shortest fragment of a read that has several at one site."""
    by = [*SAMPLE, "replicate", "readID", "chromosome", "strand", "position"]
    order = Window.partitionBy(*by).orderBy(F.col("fragEnd") - F.col("fragStart"), "fragStart", "nDuplicateReads", "leaderSeq", "randomLinkerSeq")
    return with_position(fragments).withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n", "position", "break")


def summarize_sites(fragments: DataFrame, sum_replicates: bool = False) -> DataFrame:
    """Sites of each sample: molecular tags, sonic lengths (distinct fragment widths of
    the sample, or with ``sum_replicates`` the sum over its replicates), reads, replicates
    and the share of the sample's sonic lengths in percent."""
    f = with_position(fragments).withColumn("posid", posid("chromosome", "strand", "position")).withColumn("width", F.col("fragEnd") - F.col("fragStart") + 1)
    return _summary(f, sum_replicates)


def _summary(f: DataFrame, sum_replicates: bool) -> DataFrame:
    by = [*SAMPLE, "posid"]
    sites = f.groupBy(*by).agg(
        F.count_distinct("randomLinkerSeq").alias("rUMIs"),
        F.count_distinct(*(["replicate", "width"] if sum_replicates else ["width"])).alias("sonicLengths"),
        (F.count_distinct("readID") + F.sum("nDuplicateReads")).alias("reads"),
        F.count_distinct("replicate").alias("nRepsObs"),
    )
    total = F.sum("sonicLengths").over(Window.partitionBy(*SAMPLE))
    return sites.withColumn("percentSampleRelAbund", 100.0 * F.col("sonicLengths") / total)


def _replicates(f: DataFrame) -> DataFrame:
    return f.groupBy(*SAMPLE, "posid", "replicate").agg(
        F.count_distinct("randomLinkerSeq").alias("rUMIs"),
        F.count_distinct("width").alias("sonicLengths"),
        (F.count_distinct("readID") + F.sum("nDuplicateReads")).alias("reads"),
    )


def _pivot(long: DataFrame, replicates: list[int]) -> DataFrame:
    out = long.groupBy(*SAMPLE, "posid")
    figures = [F.max(F.when(F.col("replicate") == n, F.col(m))).alias(f"rep{n}-{m}") for n in replicates for m in ("rUMIs", "sonicLengths", "reads")]
    return out.agg(*figures)


def site_replicates(fragments: DataFrame) -> DataFrame:
    """The same figures for each replicate of a site, in long form."""
    f = with_position(fragments).withColumn("posid", posid("chromosome", "strand", "position")).withColumn("width", F.col("fragEnd") - F.col("fragStart") + 1)
    return _replicates(f)


def replicate_pivot(fragments: DataFrame, replicates: list[int]) -> DataFrame:
    """One row per site with columns ``rep<N>-<figure>`` for the replicates asked for."""
    return _pivot(site_replicates(fragments), replicates)


def place_sites(fragments: DataFrame, shift: int = 2, width: int = 6) -> DataFrame:
    """Fragments with the ``posid`` of the site they count for, their ``width`` (taken before
    positions move), ``siteLeader`` and ``siteFlags``.

    A position moves ``shift`` bases along its own strand and takes the vector's strand.
    The fragments of a dual detection (a u3 and a u5 position that ``exclusive_duals``
    pairs) count for one site instead: the strand opposite to the u3 one, the moved
    position of most of their fragments (ties: the first by letters), group 0, flags
    ``dual detect`` and both most frequent leaders, joined by a slash. ``leaderGroup``
    (1 where the column is missing) is the suffix of other sites."""
    f = with_position(fragments).withColumn("width", F.col("fragEnd") - F.col("fragStart") + 1)
    f = f.withColumn("__group", F.col("leaderGroup").cast("int") if "leaderGroup" in fragments.columns else F.lit(1))
    f = f.withColumn("__moved", integrase_shift("strand", "position", shift))
    duals = exclusive_duals(dual_candidates(fragments, width))
    key = [*SAMPLE, "chromosome"]
    id_ = F.concat_ws("/", "chromosome", "u3Strand", F.col("u3Position").cast("string"))
    side = [duals.select(*key, F.col(f"{x}Strand").alias("strand"), F.col(f"{x}Position").alias("position"), F.lit(x).alias("__side"), id_.alias("__dual"), F.col("u5Strand").alias("__strand")) for x in ("u3", "u5")]
    f = f.join(side[0].unionByName(side[1]), [*key, "strand", "position"], "left")
    mine = F.contains(F.col("flags"), F.concat(F.lit("IN_"), F.col("__side")))
    f = f.withColumn("__dual", F.when(mine, F.col("__dual")))
    of = f.where("__dual is not null").select(*SAMPLE, "__dual", "__side", F.col("__moved").cast("string").alias("at"), "leaderSeq", F.struct("replicate", "strand", "fragStart", "fragEnd").alias("frag"))

    def most(rows: DataFrame, by: list[str], value: str) -> DataFrame:
        return _top(rows.groupBy(*by, value).agg(F.count_distinct("frag").alias("n")), by, value, -F.col("n"))

    by = [*SAMPLE, "__dual"]
    leaders = most(of, [*by, "__side"], "leaderSeq").groupBy(*by).agg(F.max(F.when(F.col("__side") == "u3", F.col("leaderSeq"))).alias("a"), F.max(F.when(F.col("__side") == "u5", F.col("leaderSeq"))).alias("b"))
    joint = most(of, by, "at").join(leaders.select(*by, F.concat_ws("/", "a", "b").alias("__leader")), by)
    f = f.join(joint, by, "left")
    dual = F.col("__dual").isNotNull()
    site = F.when(dual, posid("chromosome", "__strand", "at", F.lit(0))).otherwise(posid("chromosome", oriented_strand("strand", "flags"), "__moved", "__group"))
    return f.select(*fragments.columns, site.alias("posid"), "width", F.when(dual, F.col("__leader")).otherwise(F.col("leaderSeq")).alias("siteLeader"), F.when(dual, F.lit("dual detect")).otherwise(F.col("flags")).alias("siteFlags"))


def representative_leaders(placed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The leader sequence that stands for each site ``(*by, posid)`` of rows ``(posid,
    siteLeader, width, readID, nDuplicateReads)``.

    Leader groups of one place go in the order of their numbers. The first takes its
    sequence with most distinct widths, then most reads (ties: the first by letters); each
    later one chooses the same way among those of its sequences that differ most, in
    edits, from the group before it. A place has few groups and a group few sequences;
    both are one array that a fold goes through."""
    by = by or SAMPLE
    place, group = F.regexp_replace("posid", r"\.\d+$", ""), F.coalesce(F.regexp_extract("posid", r"\.(\d+)$", 1).try_cast("int"), F.lit(1))
    n = placed.groupBy(*by, place.alias("place"), group.alias("g"), "posid", "siteLeader").agg(F.count_distinct("width").alias("w"), (F.count_distinct("readID") + F.sum("nDuplicateReads")).alias("r"))
    n = n.groupBy(*by, "place", "g", "posid").agg(F.array_sort(F.collect_list(F.struct((-F.col("w")).alias("w"), (-F.col("r")).alias("r"), F.col("siteLeader").alias("s")))).alias("seqs"))
    chain = n.groupBy(*by, "place").agg(F.array_sort(F.collect_list(F.struct("g", "posid", "seqs"))).alias("groups"))
    # One group after the other; the sequence chosen last decides what is farthest.
    start = F.array().cast("array<struct<posid:string,repLeaderSeq:string>>")

    def choose(done, x):
        last = F.get(done, F.size(done) - 1)["repLeaderSeq"]
        far = F.transform(x["seqs"], lambda q: F.struct(F.when(F.size(done) == 0, 0).otherwise(-F.levenshtein(q["s"], last)).alias("d"), q["w"].alias("w"), q["r"].alias("r"), q["s"].alias("s")))
        return F.concat(done, F.array(F.struct(x["posid"].alias("posid"), F.array_min(far)["s"].alias("repLeaderSeq"))))

    return chain.select(*by, F.explode(F.aggregate("groups", start, choose)).alias("x")).select(*by, "x.posid", "x.repLeaderSeq")


def anchor_consensus(fragments: DataFrame, column: str = "leaderSeq") -> DataFrame:
    """The sequence of each site seen with most distinct widths, then most reads."""
    f = with_position(fragments).withColumn("posid", posid("chromosome", "strand", "position"))
    by = [*SAMPLE, "posid"]
    n = f.groupBy(*by, column).agg(F.count_distinct(F.col("fragEnd") - F.col("fragStart")).alias("w"), F.count_distinct("readID").alias("r"))
    return _top(n, by, column, -F.col("w"), -F.col("r"))


def shift_sites(fragments: DataFrame, by: int = 2) -> DataFrame:
    """Sites after the integrase's offset and with the vector's orientation."""
    at = with_position(fragments)
    return at.withColumn("position", integrase_shift("strand", "position", by)).withColumn("strand", oriented_strand("strand", "flags"))


def dual_candidates(fragments: DataFrame, width: int = 6) -> DataFrame:
    """Pairs of a u3 and a u5 position of one sample on opposite strands, ``width`` bases
    apart at most: a join on sample, chromosome and strand and a band of positions."""
    site = [*SAMPLE, "chromosome", "strand", "position"]
    at = with_position(fragments)
    u3 = at.where("flags like '%IN_u3%'").select(*site).distinct()
    u5 = at.where("flags like '%IN_u5%'").select(*[F.col(c).alias(f"b_{c}") for c in site]).distinct()
    step = width + 1
    a = u3.withColumn("cell", F.explode(F.array(*[F.floor(F.col("position") / step) + i for i in (-1, 0, 1)])))
    b = u5.withColumn("b_cell", F.floor(F.col("b_position") / step))
    same = [F.col(c) == F.col(f"b_{c}") for c in (*SAMPLE, "chromosome")]
    pairs = a.join(b, [*same, F.col("cell") == F.col("b_cell"), F.col("strand") != F.col("b_strand"), F.abs(F.col("position") - F.col("b_position")) <= width])
    return pairs.select(*SAMPLE, "chromosome", F.col("strand").alias("u3Strand"), F.col("position").alias("u3Position"), F.col("b_strand").alias("u5Strand"), F.col("b_position").alias("u5Position"))


def exclusive_duals(pairs: DataFrame) -> DataFrame:
    """Each position in one pair at most: a pair is taken if it is the closest of both of
    its positions (ties: the smaller positions). Those left over make no pair."""
    distance = F.abs(F.col("u3Position") - F.col("u5Position"))
    key = [*SAMPLE, "chromosome"]
    order = [distance, F.col("u3Position"), F.col("u5Position")]
    a = F.row_number().over(Window.partitionBy(*key, "u3Strand", "u3Position").orderBy(*order))
    b = F.row_number().over(Window.partitionBy(*key, "u5Strand", "u5Position").orderBy(*order))
    return pairs.withColumn("__a", a).withColumn("__b", b).where("__a = 1 and __b = 1").drop("__a", "__b")


def rank_leader_groups(fragments: DataFrame, column: str = "leaderSeq") -> DataFrame:
    """Leader sequences (or what ``column`` names) of each site numbered from 1 by distinct widths, then reads."""
    f = with_position(fragments).withColumn("posid", posid("chromosome", "strand", "position"))
    by = [*SAMPLE, "posid"]
    n = f.groupBy(*by, column).agg(F.count_distinct(F.col("fragEnd") - F.col("fragStart")).alias("nWidths"), F.count(F.lit(1)).alias("nReads"))
    order = Window.partitionBy(*by).orderBy(F.desc("nWidths"), F.desc("nReads"), column)
    return n.withColumn("leaderGroup", F.row_number().over(order))


def with_leader_groups(fragments: DataFrame, column: str = "leaderSeq") -> DataFrame:
    """Fragments with ``leaderGroup``, the number of their leader (cluster) at their site."""
    ranked = rank_leader_groups(fragments, column).select(*SAMPLE, F.col("posid").alias("__at"), column, "leaderGroup")
    f = fragments.withColumn("__at", posid("chromosome", "strand", position_of("strand", "fragStart", "fragEnd")))
    return f.join(ranked, [*SAMPLE, "__at", column]).select(*fragments.columns, "leaderGroup")


def apply_decisions(fragments: DataFrame, decisions: DataFrame, cluster: str = "leaderSeq") -> DataFrame:
    """Fragments without the rows of clusters at sites that the decisions don't select."""
    lost = decisions.where(~F.col("selected")).select(*SAMPLE, cluster, F.col("posid").alias("__at"))
    f = fragments.withColumn("__at", posid("chromosome", "strand", position_of("strand", "fragStart", "fragEnd")))
    return f.join(lost, [*SAMPLE, cluster, "__at"], "left_anti").select(*fragments.columns)


def decide_anchor_clusters(fragments: DataFrame, cluster: str = "leaderSeq", margin: int = 5, multiple: int = 10) -> DataFrame:
    """Which site a cluster of anchor sequences belongs to, in each sample: the one with
    most fragments if it leads by ``margin``, else the one with most reads if it has
    ``multiple`` times the next one's, else none. -> one row per cluster and site with
    ``selected`` and ``criteria`` (single, frags, reads, none)."""
    f = with_position(fragments).withColumn("posid", posid("chromosome", "strand", "position"))
    by = [*SAMPLE, cluster]
    n = f.groupBy(*by, "posid").agg(F.count_distinct(F.col("fragEnd") - F.col("fragStart")).alias("frags"), F.count_distinct("readID").alias("reads"))
    of = Window.partitionBy(*by)
    by_frags, by_reads = of.orderBy(F.desc("frags"), "posid"), of.orderBy(F.desc("reads"), "posid")
    whole = Window.unboundedPreceding, Window.unboundedFollowing
    n = n.select("*", F.row_number().over(by_frags).alias("rf"), F.row_number().over(by_reads).alias("rr"), F.count(F.lit(1)).over(of).alias("k"),
                 F.nth_value("frags", 1).over(by_frags.rowsBetween(*whole)).alias("f1"), F.nth_value("frags", 2).over(by_frags.rowsBetween(*whole)).alias("f2"),
                 F.nth_value("reads", 1).over(by_reads.rowsBetween(*whole)).alias("r1"), F.nth_value("reads", 2).over(by_reads.rowsBetween(*whole)).alias("r2"))
    rule = F.when(F.col("k") == 1, "single").when(F.col("f1") - F.col("f2") >= margin, "frags").when(F.col("r1") >= F.col("r2") * multiple, "reads").otherwise("none")
    n = n.withColumn("criteria", rule)
    chosen = F.when(F.col("criteria") == "none", False).when(F.col("criteria") == "reads", F.col("rr") == 1).otherwise(F.col("rf") == 1)
    return n.withColumn("selected", chosen).select(*by, "posid", "frags", "reads", "criteria", "selected")


def keep_width(fragments: DataFrame, most: int = 3000) -> DataFrame:
    return fragments.where(F.col("fragEnd") - F.col("fragStart") + 1 <= most)


def first_rows(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in a stated order."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("__n", n).where("__n = 1").drop("__n")


def group_index(df: DataFrame, within: list[str], by: list[str]) -> DataFrame:
    """Adds ``group``: the rank, from 1, of the row's ``by`` among those of its ``within``."""
    keys = df.select(*within, *by).distinct()
    keys = keys.withColumn("group", F.row_number().over(Window.partitionBy(*within).orderBy(*by)))
    return df.join(keys, [*within, *by])


def leader_frequency(fragments: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Reads of each leader sequence of a subject (or ``by``) and its rank, frequent ones
    first (ties: by letters): the order in which sequences are offered to clustering."""
    by = by or ["trial", "subject"]
    n = fragments.groupBy(*by, "leaderSeq").agg(F.count_distinct("readID").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "leaderSeq")))


def sequence_weights(fragments: DataFrame, column: str = "leaderSeq") -> DataFrame:
    """Sequences (``column``) of each site with what orders them: the site's distinct widths,
    the sequence's reads and its length. -> ``(*SAMPLE, posid, column, reads, abundance, length)``."""
    f = with_position(fragments).withColumn("posid", posid("chromosome", "strand", "position"))
    by = [*SAMPLE, "posid"]
    site = f.groupBy(*by).agg(F.count_distinct(F.col("fragEnd") - F.col("fragStart")).alias("abundance"))
    n = f.groupBy(*by, column).agg(F.count_distinct("readID").alias("reads")).join(site, by)
    return n.withColumn("length", F.length(column))


def cluster_order(fragments: DataFrame, column: str = "leaderSeq") -> DataFrame:
    """Sequences (``column``) of each site and their ``place``, from 1, in the order of their
    sample before they are clustered: by the site's distinct widths, the sequence's reads and
    its length, all descending, then site and letters.
    -> ``(*SAMPLE, posid, column, reads, abundance, length, place)``."""
    from loomsite.operators.scans import placed

    order = [F.desc("abundance"), F.desc("reads"), F.desc("length"), F.asc("posid"), F.asc(column)]
    return placed(sequence_weights(fragments, column), SAMPLE, order, "place")


def clustered_by_order(fragments: DataFrame, column: str, identity: float = 0.87) -> DataFrame:
    """Greedy clusters of the sequences of each sample, those of abundant sites and then of
    many reads first among sequences of one length -> ``(*SAMPLE, column, rep)``."""
    from loomsite.operators.clusters import cluster

    order = [F.max("abundance"), F.sum("reads")]
    return cluster(sequence_weights(fragments.where(F.col(column).isNotNull()), column), SAMPLE, column, identity, order)


def top_position_shares(fragments: DataFrame, cluster: str = "leaderSeq", top: int = 3) -> DataFrame:
    """For each cluster of a sample its ``top`` positions by reads, with their share."""
    f = with_position(fragments).withColumn("posid", posid("chromosome", "strand", "position"))
    n = f.groupBy(*SAMPLE, cluster, "posid").agg(F.count_distinct("readID").alias("reads"))
    of = Window.partitionBy(*SAMPLE, cluster)
    n = n.withColumn("share", F.col("reads") / F.sum("reads").over(of)).withColumn("rank", F.row_number().over(of.orderBy(F.desc("reads"), "posid")))
    return n.where(F.col("rank") <= top)
