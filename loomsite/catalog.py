"""The registered queries of the engine and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsite.fixtures import view, with_views
from loomsite.functions import dna
from loomsite.operators import alignments, demux, fragments, intervals, multihits, reports, tags

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None, *views: str, recursive: bool = False):
    """Registers a query; ``sql`` is what follows the definitions of ``views``: a select,
    or more common table expressions after a leading comma."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = f"{with_views(*views, recursive=recursive)} {sql.strip()}" if views else sql.strip()
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


_AT = ", fa AS (SELECT *, CASE WHEN strand = '+' THEN fragStart ELSE fragEnd END AS position, CASE WHEN strand = '+' THEN fragEnd ELSE fragStart END AS brk FROM fx_fragments), p AS (SELECT *, concat(chromosome, strand, position) AS posid FROM fa)"


@register("site_summary", _AT + """
, s AS (SELECT trial, subject, sample, posid, count(DISTINCT randomLinkerSeq) AS rUMIs, count(DISTINCT fragEnd - fragStart) AS sonicLengths,
  CAST(count(DISTINCT readID) + sum(nDuplicateReads) AS BIGINT) AS reads, count(DISTINCT replicate) AS nRepsObs FROM p GROUP BY ALL)
SELECT *, 100.0 * sonicLengths / sum(sonicLengths) OVER (PARTITION BY trial, subject, sample) AS percentSampleRelAbund FROM s""", "fx_fragments")
def site_summary(spark, d):
    return fragments.summarize_sites(view(spark, d, "fx_fragments"))


@register("replicate_pivot", _AT + """
, r AS (SELECT trial, subject, sample, posid, replicate, count(DISTINCT randomLinkerSeq) AS u, count(DISTINCT fragEnd - fragStart) AS w,
  CAST(count(DISTINCT readID) + sum(nDuplicateReads) AS BIGINT) AS n FROM p GROUP BY ALL)
SELECT trial, subject, sample, posid, """ + ", ".join(f"""max(u) FILTER (WHERE replicate = {i}) AS "rep{i}-rUMIs", max(w) FILTER (WHERE replicate = {i}) AS "rep{i}-sonicLengths", max(n) FILTER (WHERE replicate = {i}) AS "rep{i}-reads" """ for i in range(1, 5)) + "FROM r GROUP BY ALL", "fx_fragments")
def replicate_pivot(spark, d):
    return fragments.replicate_pivot(view(spark, d, "fx_fragments"), [1, 2, 3, 4])


@register("fragment_bundle", """
, k AS (SELECT trial, subject, sample, replicate, chromosome, strand, fragStart, fragEnd, CAST(count(DISTINCT readID) + sum(nDuplicateReads) AS BIGINT) AS reads,
  array_to_string(list_sort(list(DISTINCT readID)), ',') AS readIDs, array_to_string(list_sort(list(DISTINCT randomLinkerSeq)), ',') AS rUMI_list, min(flags) AS flags FROM fx_fragments GROUP BY ALL),
l AS (SELECT trial, subject, sample, replicate, chromosome, strand, fragStart, fragEnd, leaderSeq AS repLeaderSeq FROM fx_fragments GROUP BY trial, subject, sample, replicate, chromosome, strand, fragStart, fragEnd, leaderSeq
  QUALIFY row_number() OVER (PARTITION BY trial, subject, sample, replicate, chromosome, strand, fragStart, fragEnd ORDER BY count(DISTINCT readID) DESC, leaderSeq) = 1)
SELECT * FROM k JOIN l USING (trial, subject, sample, replicate, chromosome, strand, fragStart, fragEnd)""", "fx_fragments")
def fragment_bundle(spark, d):
    out = fragments.bundle(view(spark, d, "fx_fragments"))
    return out.withColumn("readIDs", F.array_join("readIDs", ",")).withColumn("rUMI_list", F.array_join("rUMI_list", ","))


@register("fragment_read_weight", """
SELECT trial, subject, sample, chromosome, strand, fragStart, fragEnd, CAST(count(DISTINCT readID) + sum(nDuplicateReads) AS BIGINT) AS reads FROM fx_fragments GROUP BY ALL""", "fx_fragments")
def fragment_read_weight(spark, d):
    return fragments.read_weight(view(spark, d, "fx_fragments"), [*fragments.SAMPLE, *fragments.PLACE])


_PER_READ = _AT + ", n AS (SELECT trial, subject, sample, replicate, readID, count(DISTINCT (chromosome, strand, position)) AS positions FROM fa GROUP BY ALL)"


@register("unique_multi_split", _PER_READ + "SELECT *, positions > 1 AS multi FROM n", "fx_fragments")
def unique_multi_split(spark, d):
    return fragments.positions_per_read(view(spark, d, "fx_fragments"))


def _split(spark, d):
    f = view(spark, d, "fx_fragments")
    n = fragments.positions_per_read(f)
    by = [*fragments.SAMPLE, "replicate", "readID"]
    return f.join(n.where("multi"), by, "left_semi"), f.join(n.where("not multi"), by, "left_semi")


@register("multihit_salvage", _PER_READ + """
, known AS (SELECT DISTINCT trial, subject, chromosome, strand, position FROM fa JOIN n USING (trial, subject, sample, replicate, readID) WHERE positions = 1),
hit AS (SELECT fa.* FROM fa JOIN n USING (trial, subject, sample, replicate, readID) SEMI JOIN known USING (trial, subject, chromosome, strand, position) WHERE positions > 1),
one AS (SELECT trial, subject, sample, replicate, readID FROM hit GROUP BY ALL HAVING count(DISTINCT (chromosome, strand, position)) = 1)
SELECT hit.* EXCLUDE (position, brk) FROM hit SEMI JOIN one USING (trial, subject, sample, replicate, readID)""", "fx_fragments")
def multihit_salvage(spark, d):
    return fragments.salvage_multihits(*_split(spark, d))


@register("multihit_components", _PER_READ + """
, m AS (SELECT DISTINCT p.trial, p.subject, p.sample, p.replicate, p.readID, posid, randomLinkerSeq FROM p JOIN n USING (trial, subject, sample, replicate, readID) WHERE positions > 1),
e AS (SELECT DISTINCT a.trial, a.subject, a.sample, a.posid AS a, b.posid AS b FROM m a JOIN m b USING (trial, subject, sample, replicate, readID)),
reach(trial, subject, sample, node, root) AS (SELECT DISTINCT trial, subject, sample, posid, posid FROM m
  UNION SELECT reach.trial, reach.subject, reach.sample, e.b, reach.root FROM reach JOIN e ON e.trial = reach.trial AND e.subject = reach.subject AND e.sample = reach.sample AND e.a = reach.node WHERE reach.root < e.b),
c AS (SELECT trial, subject, sample, node AS posid, min(root) AS component FROM reach GROUP BY ALL)
SELECT trial, subject, sample, count(DISTINCT posid) AS nodes, count(DISTINCT (replicate, readID)) AS reads, count(DISTINCT randomLinkerSeq) AS UMIs,
  concat('MHC.', row_number() OVER (PARTITION BY trial, subject, sample ORDER BY component)) AS clusterID, array_to_string(list_sort(list(DISTINCT posid)), ',') AS posids
FROM m JOIN c USING (trial, subject, sample, posid) GROUP BY trial, subject, sample, component""", "fx_fragments", recursive=True)
def multihit_components(spark, d):
    multi, _ = _split(spark, d)
    found = multihits.multihit_clusters(multi)
    return found.select("trial", "subject", "sample", "nodes", "reads", "UMIs", "clusterID", F.array_join("posids", ",").alias("posids"))


@register("fuzzy_break_correction", _AT + """
SELECT * EXCLUDE (position, brk) FROM fa QUALIFY row_number() OVER (PARTITION BY trial, subject, sample, replicate, readID, chromosome, strand, position
  ORDER BY fragEnd - fragStart, fragStart, nDuplicateReads, leaderSeq, randomLinkerSeq) = 1""", "fx_fragments")
def fuzzy_break_correction(spark, d):
    return fragments.correct_fuzzy_breaks(view(spark, d, "fx_fragments"))


@register("umi_conflict_resolution", _AT + """
, w AS (SELECT trial, subject, sample, chromosome, strand, position, count(DISTINCT fragEnd - fragStart) AS widths FROM fa GROUP BY ALL),
n AS (SELECT trial, subject, sample, randomLinkerSeq, chromosome, strand, position, count(DISTINCT readID) AS reads FROM fa GROUP BY ALL),
r AS (SELECT *, count(*) OVER (PARTITION BY trial, subject, sample, randomLinkerSeq) AS k,
  row_number() OVER (PARTITION BY trial, subject, sample, randomLinkerSeq ORDER BY widths DESC, chromosome, strand, position) AS rw,
  row_number() OVER (PARTITION BY trial, subject, sample, randomLinkerSeq ORDER BY reads DESC, chromosome, strand, position) AS rr
  FROM n JOIN w USING (trial, subject, sample, chromosome, strand, position)),
t AS (SELECT trial, subject, sample, randomLinkerSeq, max(widths) FILTER (WHERE rw = 1) AS w1, max(widths) FILTER (WHERE rw = 2) AS w2, max(reads) FILTER (WHERE rr = 1) AS r1, max(reads) FILTER (WHERE rr = 2) AS r2 FROM r GROUP BY ALL)
SELECT trial, subject, sample, randomLinkerSeq, chromosome, strand, position, widths, reads,
  CASE WHEN CASE WHEN w1 >= 2 * w2 THEN rw = 1 WHEN r1 >= 3 * r2 THEN rr = 1 ELSE false END THEN 'keep' ELSE 'drop' END AS outcome
FROM r JOIN t USING (trial, subject, sample, randomLinkerSeq) WHERE k > 1""", "fx_fragments")
def umi_conflict_resolution(spark, d):
    return tags.resolve_tag_conflicts(view(spark, d, "fx_fragments"))


@register("umi_dominant_break", _AT + """
, b AS (SELECT trial, subject, sample, randomLinkerSeq, chromosome, strand, position, brk AS top FROM fa GROUP BY trial, subject, sample, randomLinkerSeq, chromosome, strand, position, brk
  QUALIFY row_number() OVER (PARTITION BY trial, subject, sample, randomLinkerSeq, chromosome, strand, position ORDER BY count(*) DESC, brk) = 1)
SELECT fa.* EXCLUDE (position, brk) REPLACE (CASE WHEN strand = '+' THEN fragStart ELSE top END AS fragStart, CASE WHEN strand = '+' THEN top ELSE fragEnd END AS fragEnd)
FROM fa JOIN b USING (trial, subject, sample, randomLinkerSeq, chromosome, strand, position)""", "fx_fragments")
def umi_dominant_break(spark, d):
    return tags.dominant_breaks(view(spark, d, "fx_fragments"))


@register("umi_width_spread", """
SELECT trial, subject, sample, randomLinkerSeq, min(fragEnd - fragStart + 1) AS minWidth, max(fragEnd - fragStart + 1) AS maxWidth, count(DISTINCT fragEnd - fragStart) AS widths FROM fx_fragments GROUP BY ALL""", "fx_fragments")
def umi_width_spread(spark, d):
    return tags.width_spread(view(spark, d, "fx_fragments"))


@register("umi_majority_sample", """
, n AS (SELECT adriftReadRandomID, uniqueSample, count(*) AS n FROM fx_reads GROUP BY ALL),
r AS (SELECT *, row_number() OVER w AS k, lead(n) OVER w AS nxt FROM n WINDOW w AS (PARTITION BY adriftReadRandomID ORDER BY n DESC, uniqueSample)),
t AS (SELECT adriftReadRandomID, uniqueSample AS top FROM r WHERE k = 1 AND (nxt IS NULL OR n > nxt))
SELECT fx_reads.* REPLACE (top AS uniqueSample) FROM fx_reads JOIN t USING (adriftReadRandomID)""", "fx_reads")
def umi_majority_sample(spark, d):
    return tags.majority_sample(view(spark, d, "fx_reads"))


@register("umi_correction", """
, n AS (SELECT adriftReadRandomID AS u, count(*) AS n FROM fx_reads GROUP BY ALL),
f AS (SELECT a.u, count(*) AS k, min(b.u) AS t FROM n a JOIN n b ON a.n < 3 AND b.n >= 3 AND damerau_levenshtein(a.u, b.u) <= 1 GROUP BY a.u)
SELECT fx_reads.* REPLACE (coalesce(t, adriftReadRandomID) AS adriftReadRandomID) FROM fx_reads LEFT JOIN f ON f.u = adriftReadRandomID WHERE k IS NULL OR k = 1""", "fx_reads")
def umi_correction(spark, d):
    return tags.correct_tags(view(spark, d, "fx_reads"))


@register("umi_frequency", "SELECT adriftReadRandomID, count(*) AS n, count(DISTINCT uniqueSample) AS samples FROM fx_reads GROUP BY ALL", "fx_reads")
def umi_frequency(spark, d):
    return tags.tag_counts(view(spark, d, "fx_reads"))


@register("read_pair_dedup", """
SELECT * EXCLUDE (c), CAST(c - 1 AS INTEGER) AS nDuplicateReads FROM (SELECT *, count(*) OVER (PARTITION BY anchorReadSeq, adriftReadSeq) AS c, min(readID) OVER (PARTITION BY anchorReadSeq, adriftReadSeq) AS f FROM fx_reads)
WHERE readID = f""".replace("* EXCLUDE (c)", "* EXCLUDE (c, f)"), "fx_reads")
def read_pair_dedup(spark, d):
    return demux.collapse_duplicates(view(spark, d, "fx_reads"))[0]


_POLY_G = "(contains({0}, 'GGGGGGGGGG') OR len([i FOR i IN range(1, greatest(length({0}) - 8, 1)) IF hamming(substr({0}, CAST(i AS BIGINT), 10), 'GGGGGGGGGG') <= 1]) > 0)".format("index1Seq")


@register("barcode_frequency", f"SELECT index1Seq, count(*) AS n FROM fx_reads WHERE NOT {_POLY_G} GROUP BY ALL", "fx_reads")
def barcode_frequency(spark, d):
    return demux.barcode_frequency(view(spark, d, "fx_reads"))


@register("barcode_orientation_vote", """
, k AS (SELECT DISTINCT index1Seq FROM fx_samples),
c AS (SELECT count(*) FILTER (WHERE index1Seq IN (SELECT index1Seq FROM k)) AS asIs, count(*) FILTER (WHERE reverse(translate(index1Seq, 'ACGT', 'TGCA')) IN (SELECT index1Seq FROM k)) AS reversed FROM fx_reads)
SELECT asIs, reversed, reversed >= asIs AS useReverse FROM c""", "fx_reads", "fx_samples")
def barcode_orientation_vote(spark, d):
    return demux.orientation_vote(view(spark, d, "fx_reads"), view(spark, d, "fx_samples"))


@register("demultiplex_assign", """
SELECT s.uniqueSample, r.readID, r.index1Seq FROM fx_reads r JOIN fx_samples s ON hamming(r.index1Seq, s.index1Seq) <= 1
  AND hamming(substr(r.adriftReadSeq, 1, 20), substr(s.adriftReadLinkerSeq, 1, 20)) <= 1""", "fx_reads", "fx_samples")
def demultiplex_assign(spark, d):
    found = demux.assign(view(spark, d, "fx_reads"), view(spark, d, "fx_samples"))
    return found.select("uniqueSample", "readID", "index1Seq")


@register("demultiplex_counts", """
, i AS (SELECT s.uniqueSample, c, code FROM (SELECT DISTINCT index1Seq AS c FROM fx_reads) JOIN (SELECT uniqueSample, index1Seq, substr(adriftReadLinkerSeq, 1, 20) AS code FROM fx_samples) s ON hamming(c, s.index1Seq) <= 1),
l AS (SELECT s.uniqueSample, c FROM (SELECT DISTINCT substr(adriftReadSeq, 1, 20) AS c FROM fx_reads) JOIN (SELECT uniqueSample, substr(adriftReadLinkerSeq, 1, 20) AS code FROM fx_samples) s ON hamming(c, code) <= 1),
a AS (SELECT i.uniqueSample, count(*) AS index1 FROM fx_reads JOIN i ON c = index1Seq GROUP BY ALL),
b AS (SELECT l.uniqueSample, count(*) AS linker FROM fx_reads JOIN l ON c = substr(adriftReadSeq, 1, 20) GROUP BY ALL),
c AS (SELECT i.uniqueSample, count(*) AS "both" FROM fx_reads r JOIN i ON c = index1Seq JOIN l ON l.uniqueSample = i.uniqueSample AND l.c = substr(adriftReadSeq, 1, 20) GROUP BY ALL),
t AS (SELECT count(*) AS total FROM fx_reads WHERE NOT EXISTS (SELECT 1 FROM range(1, 4) g(i) WHERE hamming(substr(index1Seq, i, 10), 'GGGGGGGGGG') <= 1))
SELECT uniqueSample, coalesce(index1, 0) AS index1, coalesce(linker, 0) AS linker, coalesce("both", 0) AS "both", 100.0 * coalesce(index1, 0) / total AS index1Percent, 100.0 * coalesce(linker, 0) / total AS linkerPercent, 100.0 * coalesce("both", 0) / total AS bothPercent
FROM fx_samples LEFT JOIN a USING (uniqueSample) LEFT JOIN b USING (uniqueSample) LEFT JOIN c USING (uniqueSample), t""", "fx_reads", "fx_samples")
def demultiplex_counts(spark, d):
    return demux.sample_counts(view(spark, d, "fx_reads"), view(spark, d, "fx_samples"))


@register("post_umi_linker_filter", """
SELECT r.* FROM fx_reads r JOIN fx_samples s USING (uniqueSample)
WHERE len([i FOR i IN range(0, 3) IF hamming(substr(adriftReadSeq, CAST(32 + i AS BIGINT), 16), 'CTCCGCTTAAGGGACT') <= 2]) = 1""", "fx_reads", "fx_samples")
def post_umi_linker_filter(spark, d):
    return demux.post_tag_linker(view(spark, d, "fx_reads"), view(spark, d, "fx_samples"))


@register("barcode_top_linker", f"""
, pr AS (SELECT index1Seq, substr(adriftReadSeq, 1, 20) AS l, count(*) AS n FROM fx_reads WHERE NOT {_POLY_G} GROUP BY ALL),
c AS (SELECT index1Seq, CAST(sum(n) AS BIGINT) AS reads FROM pr GROUP BY ALL ORDER BY reads DESC, index1Seq LIMIT 50),
t AS (SELECT * FROM pr QUALIFY row_number() OVER (PARTITION BY index1Seq ORDER BY n DESC, l) = 1)
SELECT c.index1Seq, reads, l AS topLinker, 100.0 * n / reads AS topLinkerPercent, s.index1Seq IS NOT NULL AS inSheet, coalesce(substr(s.adriftReadLinkerSeq, 1, 20) = l, false) AS agrees
FROM c JOIN t USING (index1Seq) LEFT JOIN fx_samples s ON s.index1Seq = c.index1Seq""", "fx_reads", "fx_samples")
def barcode_top_linker(spark, d):
    return demux.top_linkers(view(spark, d, "fx_reads"), view(spark, d, "fx_samples"))


@register("linker_top_barcodes", """
, pr AS (SELECT substr(adriftReadSeq, 1, 20) AS linker, index1Seq, count(*) AS n FROM fx_reads GROUP BY ALL),
b AS (SELECT linker, CAST(sum(n) AS BIGINT) AS linkerReads FROM pr GROUP BY ALL ORDER BY linkerReads DESC, linker LIMIT 50)
SELECT pr.*, linkerReads, CAST(row_number() OVER (PARTITION BY linker ORDER BY n DESC, index1Seq) AS INTEGER) AS rank FROM pr JOIN b USING (linker) QUALIFY rank <= 5""", "fx_reads")
def linker_top_barcodes(spark, d):
    return demux.top_barcodes(view(spark, d, "fx_reads"))


@register("start_sequences", """
, l AS (SELECT uniqueSample, w AS "window", substr(anchorReadSeq, 1, CAST(w AS BIGINT)) AS start FROM fx_reads, (VALUES (10), (50), (100), (200)) v(w) WHERE length(anchorReadSeq) >= w),
n AS (SELECT uniqueSample, "window", start, count(*) AS n FROM l GROUP BY ALL)
SELECT *, n / sum(n) OVER (PARTITION BY uniqueSample, "window") AS frequency, CAST(row_number() OVER (PARTITION BY uniqueSample, "window" ORDER BY n DESC, start) AS INTEGER) AS rank FROM n QUALIFY rank <= 5""", "fx_reads")
def start_sequences(spark, d):
    return demux.start_sequences(view(spark, d, "fx_reads"))


_CHECKS = ", ".join(str(x) for x in tags.golay_checks())


@register("golay_correct", f"""
, b(x) AS (SELECT unnest(range(0, 24))),
e AS (SELECT 0 AS error UNION SELECT 1 << x FROM b UNION SELECT (1 << p.x) | (1 << q.x) FROM b p JOIN b q ON p.x < q.x UNION SELECT (1 << p.x) | (1 << q.x) | (1 << r.x) FROM b p JOIN b q ON p.x < q.x JOIN b r ON q.x < r.x),
lut AS (SELECT error, [bit_count(error & m) % 2 FOR m IN [{_CHECKS}]] AS syndrome FROM e),
w AS (SELECT DISTINCT index1Seq, list_sum([CASE c WHEN 'A' THEN 3 WHEN 'N' THEN 3 WHEN 'C' THEN 0 WHEN 'T' THEN 2 ELSE 1 END * (1 << (24 - 2 * i)) FOR c, i IN string_split(index1Seq, '')])::BIGINT AS word FROM fx_reads),
f AS (SELECT index1Seq, xor(word, error) AS good, bit_count(error) AS n FROM w JOIN lut ON syndrome = [bit_count(word & m) % 2 FOR m IN [{_CHECKS}]]),
g AS (SELECT index1Seq, n, array_to_string([substr('CGTA', CAST((good >> (22 - 2 * i)) & 3 AS INTEGER) + 1, 1) FOR i IN range(0, 12)], '') AS decoded FROM f)
SELECT readID, r.index1Seq, coalesce(decoded, r.index1Seq) AS corrected, CAST(n AS INTEGER) AS bitErrors FROM fx_reads r LEFT JOIN g USING (index1Seq)""", "fx_reads")
def golay_correct(spark, d):
    return tags.correct_barcodes(view(spark, d, "fx_reads")).select("readID", "index1Seq", "corrected", "bitErrors")


@register("reverse_complement", "SELECT readID, reverse(translate(anchorReadSeq, 'ACGT', 'TGCA')) AS rc FROM fx_reads", "fx_reads")
def reverse_complement(spark, d):
    return view(spark, d, "fx_reads").select("readID", dna.reverse_complement("anchorReadSeq").alias("rc"))


@register("trim_sequence", "SELECT uniqueSample, reverse(translate(right(regexp_extract(adriftReadLinkerSeq, 'N+([^N]*)$', 1), 15), 'ACGT', 'TGCA')) AS trimSeq, CAST(instr(adriftReadLinkerSeq, 'N') AS INTEGER) AS tagStart, CAST(instr(adriftReadLinkerSeq, 'N') + length(regexp_extract(adriftReadLinkerSeq, 'N+')) - 1 AS INTEGER) AS tagEnd FROM fx_samples", "fx_samples")
def trim_sequence(spark, d):
    _, start, end = dna.linker_ranges("adriftReadLinkerSeq")
    return view(spark, d, "fx_samples").select("uniqueSample", dna.trim_sequence(dna.linker_tail("adriftReadLinkerSeq")).alias("trimSeq"), start.alias("tagStart"), end.alias("tagEnd"))


_PAIR = """, a AS (SELECT * FROM fx_alignments WHERE mate = 'anchor'), b AS (SELECT * FROM fx_alignments WHERE mate = 'adrift')"""


def _mates(spark, d):
    x = view(spark, d, "fx_alignments")
    return x.where("mate = 'anchor'"), x.where("mate = 'adrift'")


@register("pair_fragments", _PAIR + """
, f AS (SELECT a.readID, a.tName AS chromosome, a.strand, CASE WHEN a.strand = '+' THEN a.tStart ELSE b.tStart END + 1 AS fragStart, CASE WHEN a.strand = '+' THEN b.tEnd ELSE a.tEnd END + 1 AS fragEnd
  FROM a JOIN b ON a.readID = b.readID AND a.tName = b.tName AND a.strand <> b.strand)
SELECT DISTINCT * FROM f WHERE fragEnd - fragStart + 1 BETWEEN 40 AND 100000""", "fx_alignments")
def pair_fragments(spark, d):
    return fragments.pair_mates(*_mates(spark, d))


@register("aligned_both_mates", _PAIR + "SELECT * FROM a SEMI JOIN b USING (readID) UNION ALL SELECT * FROM b SEMI JOIN a USING (readID)", "fx_alignments")
def aligned_both_mates(spark, d):
    a, b = alignments.both_mates(*_mates(spark, d))
    return a.unionByName(b).select(*view(spark, d, "fx_alignments").columns)


@register("alignment_filter", """
, s AS (SELECT *, 100.0 * (1 - misMatches / 60.0) AS queryPercentID FROM fx_alignments)
SELECT * FROM s WHERE queryPercentID >= 95 AND qStart <= 3 AND tNumInsert <= 1 AND qSize - qEnd <= 5""", "fx_alignments")
def alignment_filter(spark, d):
    x = view(spark, d, "fx_alignments").withColumn("queryPercentID", 100.0 * (1 - F.col("misMatches") / 60.0))
    full = x.select("*", F.lit(0).alias("qNumInsert"), F.lit(0).alias("qBaseInsert"), F.col("tNumInsert").alias("tBaseInsert"))
    return alignments.ends_aligned(alignments.accept(full)).select(*x.columns)


@register("psl_score", """
, s AS (SELECT *, 60 - misMatches AS matches, qEnd - qStart AS q, tEnd - tStart AS t FROM fx_alignments)
SELECT readID, mate, tName, tStart, CAST(matches - misMatches - tNumInsert AS BIGINT) AS score,
  CAST(100.0 - 0.1 * (1000.0 * (misMatches + tNumInsert + floor(3 * ln(1.0 + abs(q - t)) + 0.5)) / (matches + misMatches)) AS DOUBLE) AS queryPercentID FROM s""", "fx_alignments")
def psl_score(spark, d):
    x = view(spark, d, "fx_alignments").select("*", (60 - F.col("misMatches")).alias("matches"), F.lit(0).alias("repMatches"), F.lit(0).alias("qNumInsert"))
    return alignments.psl_scores(x).select("readID", "mate", "tName", "tStart", "score", "queryPercentID")


@register("placement_cap", _PAIR + """
, n AS (SELECT readID, count(*) AS k FROM a GROUP BY ALL), m AS (SELECT readID, count(*) AS k FROM b GROUP BY ALL), x AS (SELECT n.readID FROM n JOIN m USING (readID) WHERE n.k > 2 AND m.k > 2)
SELECT * FROM a ANTI JOIN x USING (readID) UNION ALL SELECT * FROM b ANTI JOIN x USING (readID)""", "fx_alignments")
def placement_cap(spark, d):
    a, b, _ = fragments.cap_placements(*_mates(spark, d), most=2)
    return a.unionByName(b).select(*view(spark, d, "fx_alignments").columns)


_SPOTS = _AT + ", spot AS (SELECT DISTINCT chromosome, position FROM fa)"


@register("exon_overlap", _SPOTS + "SELECT spot.chromosome, position, name2, txStart, txEnd FROM spot JOIN fx_genes g ON g.chromosome = spot.chromosome AND position BETWEEN txStart AND txEnd", "fx_fragments", "fx_genes")
def exon_overlap(spark, d):
    spots = fragments.with_position(view(spark, d, "fx_fragments")).select("chromosome", "position").distinct().withColumn("last", F.col("position"))
    genes = view(spark, d, "fx_genes").withColumnRenamed("chromosome", "gc")
    return intervals.overlaps(spots, genes, {"chromosome": "gc"}, ("position", "last"), ("txStart", "txEnd")).select("chromosome", "position", "name2", "txStart", "txEnd")


@register("repeat_overlap", _SPOTS + """
SELECT chromosome, position, array_to_string(list_sort(list(DISTINCT repeat_name)), ', ') AS repeat_name, array_to_string(list_sort(list(DISTINCT repeat_class)), ', ') AS repeat_class
FROM spot JOIN fx_repeats ON query_seq = chromosome AND position BETWEEN query_start AND query_end GROUP BY ALL""", "fx_fragments", "fx_repeats")
def repeat_overlap(spark, d):
    return intervals.site_repeats(fragments.with_position(view(spark, d, "fx_fragments")), view(spark, d, "fx_repeats"))


_NEAR = """, g AS (SELECT spot.chromosome, position, name2, strand, txStart, greatest(txStart - position - 1, position - txEnd - 1, 0) AS dist,
  position BETWEEN txStart AND txEnd AS inside FROM spot JOIN fx_genes USING (chromosome))"""


@register("nearest_gene", _SPOTS + _NEAR + """
, e AS (SELECT * FROM g WHERE inside AND CAST(substr(name2, 5) AS INTEGER) % 2 = 0), x AS (SELECT DISTINCT chromosome, position FROM e),
i AS (SELECT DISTINCT chromosome, position FROM g WHERE inside), near AS (
  SELECT * FROM g ANTI JOIN x USING (chromosome, position) WHERE inside OR (chromosome, position) NOT IN (SELECT (chromosome, position) FROM i)),
best AS (SELECT * FROM near QUALIFY dist = min(dist) OVER (PARTITION BY chromosome, position))
SELECT chromosome, position, array_to_string(list_sort(list(DISTINCT name2)), ', ') AS nearestGene, array_to_string(list_sort(list(DISTINCT strand)), ',') AS nearestGeneStrand,
  CAST(min(dist) AS INTEGER) AS nearestGeneDist, min(dist) = 0 AS inGene, false AS inExon, CASE WHEN min(dist) > 0 THEN position < min(txStart) END AS beforeNearestGene FROM best GROUP BY chromosome, position
UNION ALL
SELECT chromosome, position, array_to_string(list_sort(list(DISTINCT name2)), ', '), array_to_string(list_sort(list(DISTINCT strand)), ','), 0, true, true, NULL FROM e GROUP BY chromosome, position""", "fx_fragments", "fx_genes")
def nearest_gene(spark, d):
    genes = view(spark, d, "fx_genes").select("chromosome", F.col("txStart").alias("start"), F.col("txEnd").alias("end"), "strand", "name2")
    exons = genes.where("cast(substr(name2, 5) as int) % 2 = 0")
    return intervals.nearest_genes(fragments.with_position(view(spark, d, "fx_fragments")), genes, exons)


@register("interval_reduce", """
, o AS (SELECT *, max(txEnd) OVER (PARTITION BY chromosome, strand ORDER BY txStart, txEnd ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM fx_genes),
i AS (SELECT *, sum(CASE WHEN prev IS NULL OR txStart - prev - 1 >= 1 THEN 1 ELSE 0 END) OVER (PARTITION BY chromosome, strand ORDER BY txStart, txEnd ROWS UNBOUNDED PRECEDING) AS island FROM o)
SELECT chromosome, strand, min(txStart) AS start, max(txEnd) AS "end", count(*) AS n FROM i GROUP BY chromosome, strand, island""", "fx_genes")
def interval_reduce(spark, d):
    return intervals.merge(view(spark, d, "fx_genes"), ["chromosome", "strand"], "txStart", "txEnd")


@register("anchor_cluster_decision", _AT + """
, q AS (SELECT *, concat(chromosome, strand, position) AS posid FROM fa), n AS (SELECT trial, subject, sample, leaderSeq, posid, count(DISTINCT fragEnd - fragStart) AS frags, count(DISTINCT readID) AS reads FROM q GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY trial, subject, sample, leaderSeq ORDER BY frags DESC, posid) AS rf, row_number() OVER (PARTITION BY trial, subject, sample, leaderSeq ORDER BY reads DESC, posid) AS rr FROM n),
t AS (SELECT trial, subject, sample, leaderSeq, count(*) AS k, max(frags) FILTER (WHERE rf = 1) AS f1, max(frags) FILTER (WHERE rf = 2) AS f2, max(reads) FILTER (WHERE rr = 1) AS r1, max(reads) FILTER (WHERE rr = 2) AS r2 FROM r GROUP BY ALL),
c AS (SELECT *, CASE WHEN k = 1 THEN 'single' WHEN f1 - f2 >= 5 THEN 'frags' WHEN r1 >= 10 * r2 THEN 'reads' ELSE 'none' END AS criteria FROM r JOIN t USING (trial, subject, sample, leaderSeq))
SELECT trial, subject, sample, leaderSeq, posid, frags, reads, criteria, CASE criteria WHEN 'none' THEN false WHEN 'reads' THEN rr = 1 ELSE rf = 1 END AS selected FROM c""", "fx_fragments")
def anchor_cluster_decision(spark, d):
    return fragments.decide_anchor_clusters(view(spark, d, "fx_fragments"))


@register("leader_group_rank", _AT + """
, n AS (SELECT trial, subject, sample, posid, leaderSeq, count(DISTINCT fragEnd - fragStart) AS nWidths, count(*) AS nReads FROM p GROUP BY ALL)
SELECT *, CAST(row_number() OVER (PARTITION BY trial, subject, sample, posid ORDER BY nWidths DESC, nReads DESC, leaderSeq) AS INTEGER) AS leaderGroup FROM n""", "fx_fragments")
def leader_group_rank(spark, d):
    return fragments.rank_leader_groups(view(spark, d, "fx_fragments"))


@register("anchor_consensus", _AT + """
, n AS (SELECT trial, subject, sample, posid, leaderSeq, count(DISTINCT fragEnd - fragStart) AS w, count(DISTINCT readID) AS r FROM p GROUP BY ALL)
SELECT trial, subject, sample, posid, leaderSeq FROM n QUALIFY row_number() OVER (PARTITION BY trial, subject, sample, posid ORDER BY w DESC, r DESC, leaderSeq) = 1""", "fx_fragments")
def anchor_consensus(spark, d):
    return fragments.anchor_consensus(view(spark, d, "fx_fragments"))


_DUAL = _AT + """, u AS (SELECT DISTINCT trial, subject, sample, chromosome, strand, position, flags FROM fa)"""


@register("dual_detection", _DUAL + """
SELECT a.trial, a.subject, a.sample, a.chromosome, a.strand AS u3Strand, a.position AS u3Position, b.strand AS u5Strand, b.position AS u5Position
FROM u a JOIN u b ON a.flags = 'IN_u3' AND b.flags = 'IN_u5' AND a.trial = b.trial AND a.subject = b.subject AND a.sample = b.sample AND a.chromosome = b.chromosome AND a.strand <> b.strand AND abs(a.position - b.position) <= 6""", "fx_fragments")
def dual_detection(spark, d):
    return fragments.dual_candidates(view(spark, d, "fx_fragments"))


@register("integrase_shift", _AT + """
SELECT readID, chromosome, fragStart, fragEnd, CASE WHEN flags = 'IN_u3' THEN translate(strand, '+-', '-+') ELSE strand END AS strand, CASE WHEN strand = '+' THEN position + 2 ELSE position - 2 END AS position FROM fa""", "fx_fragments")
def integrase_shift(spark, d):
    return fragments.shift_sites(view(spark, d, "fx_fragments")).select("readID", "chromosome", "fragStart", "fragEnd", "strand", "position")


@register("initial_position_islands", _AT + """
, w AS (SELECT trial, subject, chromosome, strand, position, CAST(count(DISTINCT readID) + sum(nDuplicateReads) AS BIGINT) AS weight FROM fa GROUP BY ALL),
o AS (SELECT *, CASE WHEN position - lag(position) OVER k > 5 THEN 1 ELSE 0 END AS cut FROM w WINDOW k AS (PARTITION BY trial, subject, chromosome, strand ORDER BY position))
SELECT trial, subject, chromosome, strand, position, weight, CAST(sum(cut) OVER (PARTITION BY trial, subject, chromosome, strand ORDER BY position) AS BIGINT) AS island FROM o""", "fx_fragments")
def initial_position_islands(spark, d):
    from loomsite.operators.standardize import islands

    w = fragments.read_weight(fragments.with_position(view(spark, d, "fx_fragments")), ["trial", "subject", "chromosome", "strand", "position"]).withColumnRenamed("reads", "weight")
    return islands(w, ["trial", "subject", "chromosome", "strand"], "position", 5)


@register("read_attrition", _PAIR + """
, l AS (SELECT 'T~S0~G0~1' AS uniqueSample, 'ALR1' AS label, 6 AS ordinal, count(DISTINCT readID) AS reads FROM a UNION ALL SELECT 'T~S0~G0~1', 'ALR3', 8, count(DISTINCT readID) FROM b UNION ALL
  SELECT 'T~S0~G0~1', 'ALR5', 10, count(DISTINCT readID) FROM a SEMI JOIN b USING (readID)) SELECT * FROM l""", "fx_alignments")
def read_attrition(spark, d):
    a, b = (x.withColumn("uniqueSample", F.lit("T~S0~G0~1")) for x in _mates(spark, d))
    return reports.attrition({"ALR1": a, "ALR3": b, "ALR5": alignments.both_mates(a, b)[0]})


@register("recovery_eval", _AT + """
, t AS (SELECT trial, subject, sample, posid, chromosome, strand, position, count(DISTINCT readID) AS nReads, min(leaderSeq) AS leaderSeq FROM p GROUP BY ALL),
g AS (SELECT trial, subject, sample, chromosome, strand, position + 1 AS gp, nReads + 1 AS reads, leaderSeq AS rep FROM t WHERE position % 3 <> 0),
h AS (SELECT t.trial, t.subject, t.sample, t.posid, abs(position - gp) AS posDiff, abs(nReads - reads) AS readDiff, CAST(levenshtein(leaderSeq, rep) AS INTEGER) AS leaderSeqDist,
  count(*) OVER k > 1 AS splitSite, row_number() OVER (k ORDER BY abs(position - gp), reads DESC, gp) AS n
  FROM t JOIN g ON t.trial = g.trial AND t.subject = g.subject AND t.sample = g.sample AND t.chromosome = g.chromosome AND t.strand = g.strand AND abs(position - gp) <= 6
  WINDOW k AS (PARTITION BY t.trial, t.subject, t.sample, t.posid))
SELECT t.trial, t.subject, t.sample, t.posid, t.nReads, t.leaderSeq, coalesce(splitSite, false) AS splitSite, posDiff, readDiff, leaderSeqDist, posDiff IS NOT NULL AS found
FROM t LEFT JOIN h ON h.trial = t.trial AND h.subject = t.subject AND h.sample = t.sample AND h.posid = t.posid AND n = 1""", "fx_fragments")
def recovery_eval(spark, d):
    at = fragments.with_position(view(spark, d, "fx_fragments"))
    by = [*fragments.SAMPLE, "chromosome", "strand", "position"]
    t = at.groupBy(*by).agg(F.count_distinct("readID").alias("nReads"), F.min("leaderSeq").alias("leaderSeq"))
    found = t.where("position % 3 <> 0").select(*fragments.SAMPLE, dna.posid("chromosome", "strand", F.col("position") + 1).alias("posid"), (F.col("nReads") + 1).alias("reads"), F.col("leaderSeq").alias("repLeaderSeq"))
    truth = t.select(*fragments.SAMPLE, dna.posid("chromosome", "strand", "position").alias("posid"), "nReads", "leaderSeq")
    return reports.evaluate_recovery(truth, found)


@register("rearrangement_segments", """
, m AS (SELECT readID, tName, tStart, concat(qStart + 1, '..', qEnd, '[', tStart, strand, tEnd, '];', qEnd + 1, '..', qSize + 9, '[', tEnd, '+', tEnd + 9, ']') AS model FROM fx_alignments)
SELECT readID, model, CAST(i AS INTEGER) AS segment, CAST(regexp_extract(s, '(\\d+)\\.\\.(\\d+)\\[(\\d+)([+-])(\\d+)\\]', 1) AS INTEGER) AS qStart, CAST(regexp_extract(s, '(\\d+)\\.\\.(\\d+)\\[(\\d+)([+-])(\\d+)\\]', 2) AS INTEGER) AS qEnd,
  CAST(regexp_extract(s, '(\\d+)\\.\\.(\\d+)\\[(\\d+)([+-])(\\d+)\\]', 3) AS INTEGER) AS sStart, regexp_extract(s, '(\\d+)\\.\\.(\\d+)\\[(\\d+)([+-])(\\d+)\\]', 4) AS strand, CAST(regexp_extract(s, '(\\d+)\\.\\.(\\d+)\\[(\\d+)([+-])(\\d+)\\]', 5) AS INTEGER) AS sEnd
FROM (SELECT readID, model, unnest(range(0, 2)) AS i, unnest(string_split(model, ';')) AS s FROM m)""", "fx_alignments")
def rearrangement_segments(spark, d):
    model = F.expr("concat(qStart + 1, '..', qEnd, '[', tStart, strand, tEnd, '];', qEnd + 1, '..', qSize + 9, '[', tEnd, '+', tEnd + 9, ']')")
    return reports.segments(view(spark, d, "fx_alignments").select("readID", model.alias("model")))


_NEAR = """, f AS (SELECT readID, trial, subject, sample, replicate, chromosome, strand, nDuplicateReads, CASE strand WHEN '+' THEN fragStart - fragStart % 100 + fragStart % 2 * 4 ELSE fragStart - fragStart % 100 + {0} END AS a, CASE strand WHEN '+' THEN fragStart - fragStart % 100 + {1} ELSE fragStart - fragStart % 100 + 100 + fragStart % 2 * 4 END AS z FROM fx_fragments)"""


def _near(spark, d, minus_start: str, plus_end: str):
    """Fragments whose positions stand in short islands, 100 bases apart."""
    rows = view(spark, d, "fx_fragments")
    start = F.expr(f"cast(fragStart - fragStart % 100 + if(strand = '+', fragStart % 2 * 4, {minus_start}) as int)")
    end = F.expr(f"cast(fragStart - fragStart % 100 + if(strand = '+', {plus_end}, 100 + fragStart % 2 * 4) as int)")
    return rows.withColumn("fragEnd", end).withColumn("fragStart", start)


@register("standardize_integration", _NEAR.format("50", "160") + """
, w AS (SELECT trial, subject, chromosome, strand, CASE strand WHEN '+' THEN a ELSE z END AS position, count(DISTINCT readID) + sum(nDuplicateReads) AS weight FROM f GROUP BY ALL),
i AS (SELECT *, first(position) OVER (PARTITION BY trial, subject, chromosome, strand, position // 100 ORDER BY weight DESC, CASE strand WHEN '+' THEN position ELSE -position END) AS standard FROM w)
SELECT readID, f.trial, f.subject, f.sample, f.replicate, f.chromosome, f.strand, CAST(CASE f.strand WHEN '+' THEN standard ELSE a END AS INTEGER) AS fragStart, CAST(CASE f.strand WHEN '+' THEN z ELSE standard END AS INTEGER) AS fragEnd
FROM f JOIN i ON i.trial = f.trial AND i.subject = f.subject AND i.chromosome = f.chromosome AND i.strand = f.strand AND i.position = CASE f.strand WHEN '+' THEN a ELSE z END""", "fx_fragments")
def standardize_integration(spark, d):
    """Islands of two positions four bases apart: both take the heavier, ties the one upstream."""
    from loomsite.operators.standardize import standardize_integrations

    found = standardize_integrations(_near(spark, d, "50", "160"))
    return found.select("readID", *fragments.SAMPLE, "replicate", *fragments.PLACE)


@register("standardize_breaks", _NEAR.format("fragStart % 2", "150 + fragStart % 2") + """
, w AS (SELECT trial, subject, sample, replicate, chromosome, strand, CASE strand WHEN '+' THEN z ELSE a END AS brk, count(DISTINCT readID) + sum(nDuplicateReads) AS weight FROM f GROUP BY ALL),
i AS (SELECT *, first(brk) OVER (PARTITION BY trial, subject, sample, replicate, chromosome, strand, brk // 50 ORDER BY weight DESC, CASE strand WHEN '+' THEN -brk ELSE brk END) AS standard FROM w)
SELECT readID, f.trial, f.subject, f.sample, f.replicate, f.chromosome, f.strand, CAST(CASE f.strand WHEN '+' THEN a ELSE standard END AS INTEGER) AS fragStart, CAST(CASE f.strand WHEN '+' THEN standard ELSE z END AS INTEGER) AS fragEnd
FROM f JOIN i ON i.trial = f.trial AND i.subject = f.subject AND i.sample = f.sample AND i.replicate = f.replicate AND i.chromosome = f.chromosome AND i.strand = f.strand AND i.brk = CASE f.strand WHEN '+' THEN z ELSE a END""", "fx_fragments")
def standardize_breaks(spark, d):
    """Two neighbouring breaks for each site: the heavier, ties the one downstream."""
    from loomsite.operators.standardize import standardize_breaks as run

    found = run(_near(spark, d, "fragStart % 2", "150 + fragStart % 2"))
    return found.select("readID", *fragments.SAMPLE, "replicate", *fragments.PLACE)


@register("fragment_geometry", _AT + "SELECT readID, chromosome, strand, fragStart, fragEnd, position, brk AS \"break\", concat(chromosome, strand, position) AS posid, fragEnd - fragStart + 1 AS width FROM fa", "fx_fragments")
def fragment_geometry(spark, d):
    at = fragments.with_position(view(spark, d, "fx_fragments"))
    return at.select("readID", "chromosome", "strand", "fragStart", "fragEnd", "position", "break", dna.posid("chromosome", "strand", "position").alias("posid"), (F.col("fragEnd") - F.col("fragStart") + 1).alias("width"))


@register("posid_parts", _AT + "SELECT DISTINCT concat(posid, '.2') AS id, chromosome, strand, position, 2 AS \"group\", posid AS bare FROM p", "fx_fragments")
def posid_parts(spark, d):
    ids = fragments.with_position(view(spark, d, "fx_fragments")).select(dna.posid("chromosome", "strand", "position", F.lit(2)).alias("id")).distinct()
    parts = dna.parse_posid("id")
    return ids.select("id", *[c.alias(n) for n, c in parts.items()], dna.without_group("id").alias("bare"))


@register("sample_keys", "SELECT uniqueSample, split_part(uniqueSample, '~', 1) AS trial, split_part(uniqueSample, '~', 2) AS subject, split_part(uniqueSample, '~', 3) AS sample, CAST(split_part(uniqueSample, '~', 4) AS INTEGER) AS replicate, regexp_replace(uniqueSample, '~\\d+$', '') AS bare FROM fx_samples", "fx_samples")
def sample_keys(spark, d):
    parts = dna.sample_parts("uniqueSample")
    return view(spark, d, "fx_samples").select("uniqueSample", *[c.alias(n) for n, c in parts.items()], dna.without_replicate("uniqueSample").alias("bare"))


@register("read_tags", """
SELECT r.readID, substr(r.adriftReadSeq, 21, 12) AS adriftReadRandomID, concat(substr(r.adriftReadSeq, 1, 20), 'AAAAAAAAAAAA', substr(r.adriftReadSeq, 33)) AS adriftReadSeq,
  CAST(length(s.adriftReadLinkerSeq) AS INTEGER) AS adriftLinkerSeqEnd FROM fx_reads r LEFT JOIN fx_samples s USING (uniqueSample)""", "fx_reads", "fx_samples")
def read_tags(spark, d):
    found = demux.with_tags(view(spark, d, "fx_reads").drop("adriftReadRandomID"), view(spark, d, "fx_samples"))
    return found.select("readID", "adriftReadRandomID", "adriftReadSeq", "adriftLinkerSeqEnd")


@register("duplicate_map", """
SELECT f AS duplicatedRepID, readID FROM (SELECT readID, min(readID) OVER (PARTITION BY anchorReadSeq, adriftReadSeq) AS f FROM fx_reads) WHERE readID <> f""", "fx_reads")
def duplicate_map(spark, d):
    return demux.collapse_duplicates(view(spark, d, "fx_reads"))[1]


@register("vector_read_removal", """
, v AS (SELECT DISTINCT adriftReadSeq FROM fx_reads WHERE contains(adriftReadSeq, 'AAC')) SELECT * FROM fx_reads ANTI JOIN v USING (adriftReadSeq)""", "fx_reads")
def vector_read_removal(spark, d):
    reads = view(spark, d, "fx_reads")
    return alignments.drop_vector_reads(reads, reads.where("contains(adriftReadSeq, 'AAC')").select(F.col("adriftReadSeq").alias("qname"))).select(*reads.columns)


@register("terminal_snap", """
, r AS (SELECT DISTINCT anchorReadSeq FROM fx_reads),
c AS (SELECT anchorReadSeq, 24 + d AS qEnd, row_number() OVER (PARTITION BY anchorReadSeq ORDER BY d <> 0, d DESC) AS n FROM r, (VALUES (-2), (-1), (0), (1), (2)) v(d) WHERE substr(anchorReadSeq, CAST(23 + d AS BIGINT), 2) = 'CA')
SELECT anchorReadSeq, CAST(qEnd AS INTEGER) AS qEnd FROM c WHERE n = 1""", "fx_reads")
def terminal_snap(spark, d):
    reads = view(spark, d, "fx_reads").select("anchorReadSeq").distinct().withColumn("qEnd", F.lit(24))
    return alignments.snap_to_terminal(reads, "anchorReadSeq", "qEnd")


_HITS = """, h AS (SELECT readID AS qname, tName AS sseqid, 100.0 - misMatches AS pident, qStart + 1 AS qstart, qEnd AS qend, CASE strand WHEN '+' THEN tStart ELSE tEnd END AS sstart, CASE strand WHEN '+' THEN tEnd ELSE tStart END AS send,
  misMatches % 3 AS gapopen, CAST(qEnd - misMatches * 3 AS DOUBLE) AS bitscore, CAST(misMatches AS DOUBLE) AS evalue, qSize AS qlen FROM fx_alignments)"""


def _hits(spark, d):
    x = view(spark, d, "fx_alignments")
    plus = F.col("strand") == "+"
    return x.select(F.col("readID").alias("qname"), F.col("tName").alias("sseqid"), (100.0 - F.col("misMatches")).alias("pident"), (F.col("qStart") + 1).alias("qstart"), F.col("qEnd").alias("qend"), F.when(plus, F.col("tStart")).otherwise(F.col("tEnd")).alias("sstart"), F.when(plus, F.col("tEnd")).otherwise(F.col("tStart")).alias("send"),
                    (F.col("misMatches") % 3).alias("gapopen"), (F.col("qEnd") - F.col("misMatches") * 3).cast("double").alias("bitscore"), F.col("misMatches").cast("double").alias("evalue"), F.col("qSize").alias("qlen"))


@register("best_vector_hit", _HITS + """
SELECT qname, sseqid, qstart, qend, sstart, send, bitscore FROM (SELECT * FROM h WHERE pident >= 90 AND abs(qend - qstart) + 1 >= floor(qlen * 80 / 100.0) AND gapopen <= 1)
QUALIFY row_number() OVER (PARTITION BY qname ORDER BY bitscore DESC, CASE WHEN send >= sstart THEN 0 ELSE 1 END, sseqid, sstart, qstart, qend) = 1""", "fx_alignments")
def best_vector_hit(spark, d):
    good = alignments.accept_hits(_hits(spark, d), coverage=80)
    return alignments.best_hits(good).select("qname", "sseqid", "qstart", "qend", "sstart", "send", "bitscore")


@register("leader_end_from_hits", _HITS + """
, o AS (SELECT *, max(qend) OVER (PARTITION BY qname ORDER BY qstart, qend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM h),
i AS (SELECT *, sum(CASE WHEN prev IS NULL OR qstart - prev - 1 >= 5 THEN 1 ELSE 0 END) OVER (PARTITION BY qname ORDER BY qstart, qend ROWS UNBOUNDED PRECEDING) AS island FROM o),
m AS (SELECT qname, min(qstart) AS s, max(qend) AS e FROM i GROUP BY qname, island)
SELECT qname, e AS qEnd FROM m WHERE s <= 5 QUALIFY row_number() OVER (PARTITION BY qname ORDER BY e - s DESC, s) = 1""", "fx_alignments")
def leader_end_from_hits(spark, d):
    from loomsite.operators.sequences import leader_ends

    return leader_ends(_hits(spark, d))


@register("gene_list_filter", "SELECT * FROM fx_genes WHERE CAST(substr(name2, 5) AS INTEGER) % 7 = 0", "fx_genes")
def gene_list_filter(spark, d):
    from loomsite.sources.files import in_gene_list

    genes = view(spark, d, "fx_genes")
    listed = genes.where("cast(substr(name2, 5) as int) % 7 = 0").select(F.lower("name2").alias("name2"))
    return in_gene_list(genes, listed)


@register("transcript_points", """
SELECT chromosome, strand, name2, CASE strand WHEN '+' THEN txStart ELSE txEnd END AS tss, CASE strand WHEN '+' THEN txEnd ELSE txStart END AS tes, CAST(floor((txStart + txEnd) / 2.0) AS INTEGER) AS mid FROM fx_genes""", "fx_genes")
def transcript_points(spark, d):
    genes = view(spark, d, "fx_genes").select("chromosome", F.col("txStart").alias("start"), F.col("txEnd").alias("end"), "strand", "name2")
    out = None
    for mode, name in (("start", "tss"), ("end", "tes"), ("center", "mid")):
        part = intervals.transcript_points(genes, mode).select("chromosome", "strand", "name2", F.col("start").alias(name))
        out = part if out is None else out.join(part, ["chromosome", "strand", "name2"])
    return out


@register("exclusive_duals", _DUAL + """
, q AS (SELECT a.trial, a.subject, a.sample, a.chromosome, a.strand AS u3Strand, a.position AS u3Position, b.strand AS u5Strand, b.position AS u5Position
  FROM u a JOIN u b ON a.flags = 'IN_u3' AND b.flags = 'IN_u5' AND a.trial = b.trial AND a.subject = b.subject AND a.sample = b.sample AND a.chromosome = b.chromosome AND a.strand <> b.strand AND abs(a.position - b.position) <= 6),
r AS (SELECT *, row_number() OVER (PARTITION BY trial, subject, sample, chromosome, u3Strand, u3Position ORDER BY abs(u3Position - u5Position), u3Position, u5Position) AS x,
  row_number() OVER (PARTITION BY trial, subject, sample, chromosome, u5Strand, u5Position ORDER BY abs(u3Position - u5Position), u3Position, u5Position) AS y FROM q)
SELECT * EXCLUDE (x, y) FROM r WHERE x = 1 AND y = 1""", "fx_fragments")
def exclusive_duals(spark, d):
    return fragments.exclusive_duals(fragments.dual_candidates(view(spark, d, "fx_fragments")))


@register("multihit_repeat_classes", _AT + """
, c AS (SELECT concat(trial, subject, sample, chromosome) AS clusterID, posid, chromosome, position FROM p GROUP BY ALL),
h AS (SELECT DISTINCT chromosome, position, repeat_class FROM c JOIN fx_repeats ON query_seq = chromosome AND position BETWEEN query_start AND query_end),
l AS (SELECT chromosome, position, array_to_string(list_sort(list(repeat_class)), ', ') AS cls FROM h GROUP BY ALL),
k AS (SELECT clusterID, cls, count(DISTINCT posid) AS k FROM c JOIN l USING (chromosome, position) GROUP BY ALL),
n AS (SELECT clusterID, count(DISTINCT posid) AS n FROM c GROUP BY ALL),
t AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY clusterID ORDER BY k DESC, cls) = 1)
SELECT n.clusterID, cls AS topRepeatClass, CAST(100.0 * k / n AS DOUBLE) AS topRepeatPercent FROM n LEFT JOIN t USING (clusterID)""", "fx_fragments", "fx_repeats")
def multihit_repeat_classes(spark, d):
    at = fragments.with_position(view(spark, d, "fx_fragments"))
    clusters = at.groupBy(F.concat("trial", "subject", "sample", "chromosome").alias("clusterID")).agg(F.collect_set(dna.posid("chromosome", "strand", "position")).alias("posids"))
    return intervals.multihit_repeats(clusters, view(spark, d, "fx_repeats"))


@register("attrition_shares", _PAIR + """
, w AS (SELECT (SELECT count(DISTINCT readID) FROM a) AS x, (SELECT count(DISTINCT readID) FROM b) AS y)
SELECT 's' AS uniqueSample, 'PRD1' AS label, x AS reads, 1.0 AS share FROM w UNION ALL SELECT 's', 'ALR3', y, y / x FROM w""", "fx_alignments")
def attrition_shares(spark, d):
    a, b = (x.withColumn("uniqueSample", F.lit("s")) for x in _mates(spark, d))
    return reports.attrition_shares(reports.attrition_wide(reports.attrition({"PRD1": a, "ALR3": b}), ["PRD1", "ALR3"]))


@register("remnant_histogram", """
, s AS (SELECT tName AS sample, concat(qStart + 1, '..', qEnd, '[', tStart, strand, tEnd, ']', CASE WHEN tNumInsert > 0 THEN ';1..2[x]' ELSE '' END) AS m FROM fx_alignments)
SELECT sample, CAST(floor(CAST(regexp_extract(m, '\\.\\.(\\d+)', 1) AS INTEGER) / 5.0) * 5 AS BIGINT) AS bin, CAST(length(m) - length(replace(m, ';', '')) AS INTEGER) AS recombinations, count(*) AS n FROM s GROUP BY ALL""", "fx_alignments")
def remnant_histogram(spark, d):
    model = F.expr("concat(qStart + 1, '..', qEnd, '[', tStart, strand, tEnd, ']', case when tNumInsert > 0 then ';1..2[x]' else '' end)")
    return reports.remnant_histogram(view(spark, d, "fx_alignments").select(F.col("tName").alias("sample"), model.alias("repLeaderSeqMap")))


@register("capped_counts", """
, n AS (SELECT uniqueSample, adriftReadRandomID, count(*) AS n FROM fx_reads GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY uniqueSample ORDER BY n) AS k, count(*) OVER (PARTITION BY uniqueSample) AS m FROM n),
l AS (SELECT uniqueSample, max(n) FILTER (WHERE k <= ceil(m * 0.95)) AS lim FROM r GROUP BY ALL)
SELECT uniqueSample, adriftReadRandomID, least(n, lim) AS n FROM n JOIN l USING (uniqueSample)""", "fx_reads")
def capped_counts(spark, d):
    n = view(spark, d, "fx_reads").groupBy("uniqueSample", "adriftReadRandomID").agg(F.count(F.lit(1)).alias("n"))
    return reports.cap_at_rank(n, ["uniqueSample"], "n")


@register("weighted_median", _AT + """
, w AS (SELECT sample, position, CAST(count(DISTINCT readID) + sum(nDuplicateReads) AS BIGINT) AS w FROM fa GROUP BY ALL),
s AS (SELECT *, sum(w) OVER (PARTITION BY sample ORDER BY position) / sum(w) OVER (PARTITION BY sample) AS q FROM w)
SELECT sample, min(position) AS median FROM s WHERE q >= 0.5 GROUP BY ALL""", "fx_fragments")
def weighted_median(spark, d):
    from loomsite.operators.standardize import weighted_median as run

    return run(fragments.read_weight(fragments.with_position(view(spark, d, "fx_fragments")), ["sample", "position"]), ["sample"], "position", "reads")


@register("lost_tag_removal", _SQL["umi_conflict_resolution"].removeprefix(with_views("fx_fragments")).replace("SELECT trial, subject, sample, randomLinkerSeq, chromosome, strand, position, widths, reads,", ", v AS (SELECT trial, subject, sample, randomLinkerSeq, chromosome, strand, position,") + """)
SELECT fa.* EXCLUDE (position, brk) FROM fa ANTI JOIN (SELECT * FROM v WHERE outcome = 'drop') x USING (trial, subject, sample, randomLinkerSeq, chromosome, strand, position)""", "fx_fragments")
def lost_tag_removal(spark, d):
    f = view(spark, d, "fx_fragments")
    return tags.drop_lost_tags(f, tags.resolve_tag_conflicts(f))


from loomsite import catalog_formats, catalog_stages  # noqa: E402, F401 (they register more queries)
