"""The stages of an integration-site analysis, as functions from DataFrames to DataFrames.

Each composes operators; nothing is executed here but by operators that iterate. A stage
that gives several tables returns them by name in a dict.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsite.functions.dna import parse_posid, posid
from loomsite.operators import alignments as al
from loomsite.operators import clusters as cl
from loomsite.operators import demux as dx
from loomsite.operators import fragments as fr
from loomsite.operators import intervals as iv
from loomsite.operators import multihits as mh
from loomsite.operators import reports as rp
from loomsite.operators import sequences as sq
from loomsite.operators import standardize as sd
from loomsite.operators import tags as tg


@dataclass(frozen=True)
class Options:
    """Parameters of the stages with their usual values."""

    index_mismatches: int = 1
    linker_mismatches: int | None = 1
    tail_mismatches: int = 2
    unique_reads: bool = True
    golay: bool = False
    auto_reverse: bool = True
    min_read: int = 30
    adapter_error: float = 0.15
    umi_scope: str = "replicate"
    min_identity: float = 95
    max_unaligned: int = 5
    max_query_start: int = 3
    min_width: int = 40
    max_width: int = 100_000
    max_fragment: int = 3000
    max_placements: int = 1500
    position_gap: int = 5
    break_gap: int = 3
    break_scope: str = "replicates"
    dual_width: int = 6
    shift: int = 2
    sum_replicates: bool = False
    terminal: str | None = "CA"
    forced_leader: int | None = None
    leader_identity: float | None = 0.85
    per_read: int = 500
    read_identity: float | None = None
    min_reads: int = 1
    anchor_start: int = 30
    adrift_start: int = 30
    start_identity: float = 0.87


#: What the kind of vector changes. A caller's own values go before these.
MODES = {
    "integrase": {},
    "AAV": {"shift": 0, "terminal": None, "forced_leader": 10},
    "transposase": {"shift": 0, "terminal": "TA"},
}


def options(mode: str = "integrase", **own) -> Options:
    return replace(Options(), **{**MODES[mode], **own})


def demultiplex(raw: DataFrame, samples: DataFrame, o: Options = Options(), replicates: DataFrame | None = None) -> dict[str, DataFrame]:
    """``raw (readID, index1Seq, anchorReadSeq, adriftReadSeq)`` to samples -> ``reads``,
    ``dupReads``, ``barcodes``, ``counts`` and ``missing`` (samples without reads). Quality
    columns (``anchorReadQual``, ``adriftReadQual``) trim their reads, ``replicates
    (uniqueSample, merged)`` merges replicates, and with ``read_identity`` one read stands
    for each cluster of anchor reads and molecular tag. Only ``auto_reverse`` runs a job."""
    for mate in ("anchorRead", "adriftRead"):
        if f"{mate}Qual" in raw.columns:
            raw = dx.trim_quality(raw, f"{mate}Seq", f"{mate}Qual")
    if o.golay:
        raw = tg.correct_barcodes(raw).withColumn("index1Seq", F.col("corrected")).drop("corrected", "bitErrors")
    if o.auto_reverse and dx.orientation_vote(raw, samples).first()["useReverse"]:
        from loomsite.functions.dna import reverse_complement

        raw = raw.withColumn("index1Seq", reverse_complement("index1Seq"))
    reads = dx.assign(raw, samples, o.index_mismatches, o.linker_mismatches)
    reads = dx.with_tags(dx.post_tag_linker(reads, samples, o.tail_mismatches), samples)
    reads = dx.with_sample_columns(reads, samples)
    if replicates is not None:
        reads = dx.merge_replicates(reads, replicates)
    kept, lost = dx.collapse_duplicates(reads) if o.unique_reads else (reads.withColumn("nDuplicateReads", F.lit(0)), reads.select(F.col("readID").alias("duplicatedRepID"), "readID").limit(0))
    if o.read_identity:
        before = mh.saved(kept)
        kept = cl.collapse_clusters(before.drop("nDuplicateReads"), cl.cluster(before, ["uniqueSample"], "anchorReadSeq", o.read_identity))
    return {"reads": kept, "dupReads": lost, "barcodes": dx.barcode_frequency(raw), "counts": dx.sample_counts(raw, samples), "missing": dx.missing_samples(kept, samples)}


def prep_reads(reads: DataFrame, leader_hits: DataFrame | None = None, vectors: DataFrame | None = None, o: Options = Options(), profiles: list[tuple[str, str]] | None = None) -> dict[str, DataFrame]:
    """Trims adapters and linkers, drops reads of the vector itself, captures leaders and
    corrects molecular tags -> ``reads`` and ``vectorHits``. Leaders end where a table of
    hits says, or else where ``profiles`` (name, consensus) do; reads without are dropped."""
    out = dx.remove_linker(reads)
    out = sq.trim_reads(out, "anchorReadSeq", "adriftReadTrimSeq", o.adapter_error, o.min_read)
    out = out.where(F.length("adriftReadSeq") >= o.min_read)
    result = {}
    if vectors is not None:
        found = sq.align(out.select(F.right("adriftReadSeq", F.lit(25)).alias("seq")), vectors, min_length=22, min_identity=90)
        result["vectorHits"] = found
        out = out.withColumn("__end", F.right("adriftReadSeq", F.lit(25))).join(found.select(F.col("seq").alias("__end")).distinct(), "__end", "left_anti").drop("__end")
    if leader_hits is not None or profiles:
        ends = sq.leader_ends(leader_hits).withColumnRenamed("qname", "readID") if leader_hits is not None else sq.capture_by_consensus(out, profiles).select("readID", "qEnd")
        if o.forced_leader:
            ends = al.force_leaders(out, ends, o.forced_leader)
        if o.terminal:
            ends = al.snap_to_terminal(ends.join(out.select("readID", "anchorReadSeq"), "readID"), "anchorReadSeq", "qEnd", o.terminal).select("readID", "qEnd")
    else:
        ends = out.select("readID", F.lit(o.forced_leader or 0).alias("qEnd"))
    out = al.capture_leader(out, ends).where(F.length("anchorReadSeq") >= o.min_read)
    scope = ["uniqueSample"] if o.umi_scope == "replicate" else []
    out = tg.correct_tags(out, scope=scope)
    if o.umi_scope == "run":
        out = tg.majority_sample(out)
    # Later stages read the reads again and again: their lineage ends here.
    return {"reads": mh.saved(out), **result}


def align_reads(reads: DataFrame, reference: DataFrame, o: Options = Options()) -> dict[str, DataFrame]:
    """Aligns the distinct sequences of both mates to ``reference (tName, tSeq)`` and joins
    the alignments back -> ``anchor`` and ``adrift``. Alignments from elsewhere (see
    ``sources.files.read_psl``) can take the place of these."""
    result = {}
    for mate, column in (("anchor", "anchorReadSeq"), ("adrift", "adriftReadSeq")):
        hits = sq.align(reads.select(F.col(column).alias("seq")), reference)
        good = al.ends_aligned(al.accept(al.shift_target(hits), o.min_identity, max_query_start=o.max_query_start), o.max_unaligned)
        result[mate] = reads.select("readID", F.col(column).alias("seq")).join(good, "seq").drop("seq")
    # The unaligned start of an anchor read belongs to its leader.
    result["anchor"] = al.extend_leader(result["anchor"].join(reads.select("readID", "leaderSeq", "anchorReadSeq"), "readID")).drop("anchorReadSeq") if {"leaderSeq", "anchorReadSeq"} <= set(reads.columns) else result["anchor"]
    # Fragments read the alignments several times: they are written once.
    result = {mate: mh.saved(rows) for mate, rows in result.items()}
    result["anchor"], result["adrift"] = al.both_mates(result["anchor"], result["adrift"])
    return {mate: mh.saved(rows) for mate, rows in result.items()}


def build_fragments(anchor: DataFrame, adrift: DataFrame, reads: DataFrame, o: Options = Options()) -> DataFrame:
    """Pairs mates and adds what the reads know -> fragments, one row per read and place.
    Reads with too many placements keep ``per_read`` of their anchor's and what is near.

    ``anchorStart`` holds the first bases of an anchor read from where its alignment begins,
    ``adriftStart`` those of an adrift read (both null where ``reads`` lacks sequences)."""
    a, b, many = fr.cap_placements(anchor, adrift, o.max_placements)
    pairs = fr.pair_mates(a, b, o.min_width, o.max_width, query_start=True)
    if o.per_read:
        few, near = fr.salvage_mates(anchor, adrift.join(many.select("readID"), "readID", "left_semi"), many, o.per_read, o.max_width)
        pairs = pairs.unionByName(fr.pair_mates(few, near, o.min_width, o.max_width, query_start=True))
    seqs = [F.col(c) if c in reads.columns else F.lit(None).cast("string").alias(c) for c in ("anchorReadSeq", "adriftReadSeq")]
    known = reads.select("readID", "uniqueSample", "leaderSeq", F.col("adriftReadRandomID").alias("randomLinkerSeq"), "nDuplicateReads", "flags", *seqs)
    parts = F.split("uniqueSample", "~")
    out = pairs.join(known, "readID")
    starts = [F.substr("anchorReadSeq", (F.col("qStart") + 1).cast("int"), F.lit(o.anchor_start)).alias("anchorStart"), F.substring("adriftReadSeq", 1, o.adrift_start).alias("adriftStart")]
    return out.select("readID", parts[0].alias("trial"), parts[1].alias("subject"), parts[2].alias("sample"), parts[3].cast("int").alias("replicate"), "chromosome", "strand", "fragStart", "fragEnd", "nDuplicateReads", "flags", "randomLinkerSeq", "leaderSeq", *starts)


def build_std_fragments(fragments: DataFrame, o: Options = Options()) -> dict[str, DataFrame]:
    """Groups leaders, standardizes positions and breaks, resolves multi-hits, molecular
    tags and anchor clusters, bundles -> ``stdFragments``, ``multiHits`` with abundances,
    ``reads`` (rows before bundling), ``decisions``. With ``leader_identity`` set, positions
    are standardized within the clusters of their subject's leaders.

    Anchor decisions are made within the clusters of ``anchorStart`` of a sample: reads of
    one genomic start at several sites are kept at the site that leads, or at none.
    Fragments without that column, or rows with a null one, take no part in decisions."""
    # What several later steps read is written once: it cuts the lineage, too.
    group = None
    if o.leader_identity:
        of = cl.cluster(fragments, ["trial", "subject"], "leaderSeq", identity=o.leader_identity)
        fragments = mh.saved(fragments.join(of.withColumnRenamed("rep", "leaderCluster"), ["trial", "subject", "leaderSeq"]))
        group = ["leaderCluster"]
    f = mh.saved(sd.standardize_integrations(fragments, o.position_gap, group))
    f = mh.saved(fr.keep_width(sd.standardize_breaks(f, o.break_gap, o.break_scope), o.max_fragment))
    by = [*fr.SAMPLE, "replicate", "readID"]
    n = mh.saved(fr.positions_per_read(f))
    unique, multi = f.join(n.where("not multi"), by, "left_semi"), f.join(n.where("multi"), by, "left_semi")
    saved = fr.salvage_multihits(multi, unique)
    rest = mh.saved(multi.join(saved.select(*by).distinct(), by, "left_anti"))
    f = mh.saved(fr.correct_fuzzy_breaks(unique.unionByName(saved)))
    f = tg.drop_lost_tags(f, tg.resolve_tag_conflicts(f))
    f = mh.saved(tg.dominant_breaks(f))
    decisions = None
    if "anchorStart" in f.columns:
        # Reads that start alike come from one place; a read end of the vector they share doesn't count.
        of = fr.clustered_by_order(f, "anchorStart", o.start_identity).withColumnRenamed("rep", "anchorCluster")
        f = mh.saved(f.join(of, [*fr.SAMPLE, "anchorStart"], "left"))
        decisions = mh.saved(fr.decide_anchor_clusters(f.where("anchorCluster is not null"), "anchorCluster"))
        f = fr.apply_decisions(f, decisions, "anchorCluster")
    if group:
        f = fr.with_leader_groups(f, "leaderCluster")
    f = mh.saved(f)
    clusters = mh.saved(mh.multihit_clusters(rest))
    abundance = mh.cluster_abundance(clusters, rest, "adriftStart" if "adriftStart" in rest.columns else None, o.start_identity)
    return {"stdFragments": fr.bundle(f, o.min_reads), "multiHits": abundance, "reads": f} | ({"decisions": decisions} if decisions is not None else {})


def build_sites(std_reads: DataFrame, o: Options = Options(), replicates: tuple[int, ...] = (1, 2, 3, 4), leader_identity: float = 0.85) -> dict[str, DataFrame]:
    """Sites of each sample -> ``sites`` (figures, share, flags, representative leader, the
    number of clusters of its leaders, consensus, and the figures of each replicate),
    ``replicates`` in long form, and the ``duals`` that were merged.

    Positions move, strands turn and dual detections merge after fragments are measured:
    a site's sonic lengths are the widths of its fragments as they were."""
    placed = mh.saved(fr.place_sites(std_reads, o.shift, o.dual_width))
    key = [*fr.SAMPLE, "posid"]
    sites = fr._summary(placed, o.sum_replicates)
    flags = placed.groupBy(*key).agg(F.min("siteFlags").alias("flags"))
    leaders = fr.representative_leaders(placed)
    consensus = placed.groupBy(*key, "leaderSeq").agg(F.count_distinct("width").alias("w"), F.count_distinct("readID").alias("r"))
    consensus = fr._top(consensus, key, "leaderSeq", -F.col("w"), -F.col("r")).withColumnRenamed("leaderSeq", "anchorReadConsensus")
    groups = cl.cluster(placed, key, "leaderSeq", identity=leader_identity).groupBy(*key).agg(F.count_distinct("rep").alias("repLeaderSeqClusters"))
    long = fr._replicates(placed)
    for part in (flags, leaders, groups, consensus, fr._pivot(long, list(replicates))):
        sites = sites.join(part, key, "left")
    return {"sites": sites, "replicates": long, "duals": fr.exclusive_duals(fr.dual_candidates(std_reads, o.dual_width))}


def call_nearest_genes(sites: DataFrame, genes: DataFrame, exons: DataFrame, gene_list: DataFrame | None = None, mode: str = "either", prefix: str = "") -> DataFrame:
    """Adds the nearest gene's columns, with a ``prefix``, so that it can be called twice."""
    from loomsite.sources.files import in_gene_list

    if gene_list is not None:
        genes, exons = in_gene_list(genes, gene_list), in_gene_list(exons, gene_list)
    if mode != "either":
        exons = exons.limit(0)
    p = parse_posid("posid")
    spots = sites.select("posid", p["chromosome"].alias("chromosome"), p["position"].alias("position")).distinct()
    found = spots.join(iv.nearest_genes(spots, iv.transcript_points(genes, mode), exons), ["chromosome", "position"]).drop("chromosome", "position")
    return sites.join(found.select("posid", *[F.col(c).alias(prefix + c) for c in found.columns if c != "posid"]), "posid", "left")


def annotate_repeats(sites: DataFrame, repeats: DataFrame, multi_hits: DataFrame | None = None) -> dict[str, DataFrame]:
    p = parse_posid("posid")
    spots = sites.select("posid", p["chromosome"].alias("chromosome"), p["position"].alias("position")).distinct()
    found = spots.join(iv.site_repeats(spots, repeats), ["chromosome", "position"]).drop("chromosome", "position")
    out = {"sites": sites.join(found, "posid", "left")}
    if multi_hits is not None:
        # Cluster numbers begin anew in each sample.
        key = [*fr.SAMPLE, "clusterID"]
        whole = F.concat_ws("~", *key)
        found = iv.multihit_repeats(multi_hits.select(whole.alias("clusterID"), "posids"), repeats)
        out["multiHits"] = multi_hits.withColumn("__whole", whole).join(found.withColumnRenamed("clusterID", "__whole"), "__whole", "left").drop("__whole")
    return out


def vector_hits(seqs: DataFrame, vectors: DataFrame, min_length: int = 12) -> DataFrame:
    """Where distinct ``seqs (seq)`` lie on vectors, in the columns of a hit table."""
    hits = sq.align(seqs.where("seq is not null"), vectors, k=8, min_length=min_length)
    plus = F.col("strand") == "+"
    return hits.select(F.col("seq").alias("qname"), F.col("tName").alias("sseqid"), (F.col("qStart") + 1).alias("qstart"), F.col("qEnd").alias("qend"), F.when(plus, F.col("tStart") + 1).otherwise(F.col("tEnd")).alias("sstart"), F.when(plus, F.col("tEnd")).otherwise(F.col("tStart") + 1).alias("send"),
                       F.pow(F.lit(2.0), -F.col("matches")).alias("evalue"), F.col("matches").cast("double").alias("bitscore"), F.col("qSize").alias("qlen"))


def map_site_leader_sequences(sites: DataFrame, vectors: DataFrame) -> DataFrame:
    """Adds ``repLeaderSeqMap``: how each site's leader lies on the vector."""
    models = sq.rearrangements(vector_hits(sites.select(F.col("repLeaderSeq").alias("seq")), vectors), min_length=12)
    return sites.join(models.select(F.col("qname").alias("repLeaderSeq"), F.col("model").alias("repLeaderSeqMap")), "repLeaderSeq", "left")


def predict_pcr_artifacts(sites: DataFrame, reference: DataFrame, vectors: DataFrame, k: int = 20, chunk: int = sq.CHUNK) -> DataFrame:
    """Adds ``PCRartifact1`` and ``PCRartifact2``: signs that the genome, or the vector, primed
    a site's reads. ``reference`` holds chromosomes in chunks of ``chunk`` bases."""
    p = parse_posid("posid")
    at = sites.withColumn("chromosome", p["chromosome"]).withColumn("strand", p["strand"]).withColumn("position", p["position"])
    return sq.priming_by_vector(sq.priming_by_leader(at, reference, k, chunk=chunk), reference, vectors, k, chunk=chunk).drop("chromosome", "strand", "position")


def anchor_read_rearrangements(reads: DataFrame, expected: DataFrame, windows: tuple[int, ...] = (300,), levels: tuple[int, ...] = (0, 1000), seeds: tuple[int, ...] = (1, 2, 3), min_reads: int = 2, prefixes: list[str] | None = None, vectors: DataFrame | None = None, identity: float = 0.9) -> dict[str, DataFrame]:
    """Merged mates -> ``stats`` of the structures in their first bases and ``structures``,
    the distinct starts of each sample and window with shares. With ``prefixes`` and
    ``vectors`` only reads that begin and end as expected take part, and ``structures`` has
    the ``model`` of each start: how it lies on the vectors."""
    merged = sq.merge_reads(reads).select("uniqueSample", "readID", "seq")
    if prefixes and vectors is not None:
        merged = sq.rearrangement_inputs(merged, prefixes, vectors)
    rows = mh.saved(sq.rarefy(merged, ["uniqueSample"], levels, seeds, windows, "seq"))
    top = rp.structure_models(rows.where("level = 0"), ["uniqueSample", "window"])
    if vectors is not None:
        models = sq.rearrangements(vector_hits(top.select("seq"), vectors), min_length=12)
        top = top.join(models.select(F.col("qname").alias("seq"), "model"), "seq", "left")
    return {"stats": sq.structure_stats(rows, ["uniqueSample"], "seq", expected, min_reads, identity), "structures": top}


def anchor_read_start_seqs(reads: DataFrame, windows: tuple[int, ...] = (10, 50, 100, 200), top: int = 5) -> DataFrame:
    return dx.start_sequences(reads, windows, top)


def barcode_assoc_linkers(raw: DataFrame, samples: DataFrame, top: int = 50) -> dict[str, DataFrame]:
    return {"barcodes": dx.top_linkers(raw, samples, top), "linkers": dx.top_barcodes(raw, top)}


def read_attrition(stages: dict[str, DataFrame]) -> DataFrame:
    return rp.attrition_wide(rp.attrition(stages), list(stages))


def evaluate_recovery(sites: DataFrame, truth: DataFrame, width: int = 3, multi_hits: DataFrame | None = None) -> dict[str, DataFrame]:
    found = rp.evaluate_recovery(truth, sites, width, multi_hits)
    return {"sites": found, "summary": rp.recovery_summary(found)}


def build_annotations(genes: DataFrame, chromosomes: list[str] | None = None) -> dict[str, DataFrame]:
    """Gene models -> ``genes`` and ``exons`` in 1-based inclusive coordinates."""
    from loomsite.sources.files import exons_of, standard_chromosomes

    units = genes.select(F.col("chrom").alias("chromosome"), (F.col("txStart") + 1).alias("start"), F.col("txEnd").alias("end"), "strand", "name2")
    exons = exons_of(genes)
    if chromosomes:
        units, exons = standard_chromosomes(units, chromosomes), standard_chromosomes(exons, chromosomes)
    return {"genes": units.distinct(), "exons": exons}


def remnant_histogram(sites: DataFrame, width: int = 5) -> DataFrame:
    return rp.remnant_histogram(sites, width=width)


def vector_features(models: DataFrame, features: DataFrame) -> DataFrame:
    """Segments of rearrangement models with the vector features that they overlap."""
    rows = rp.segments(models).withColumn("part", F.lit("vector"))
    named = features.select(F.lit("vector").alias("f_part"), F.col("name").alias("feature"), F.col("start").alias("f_start"), F.col("end").alias("f_end"))
    return iv.overlaps(rows, named, {"part": "f_part"}, ("sStart", "sEnd"), ("f_start", "f_end")).drop("part", "f_part")


def site_ids(df: DataFrame) -> DataFrame:
    return fr.with_position(df).withColumn("posid", posid("chromosome", "strand", "position"))
