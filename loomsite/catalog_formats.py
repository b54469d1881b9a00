"""Queries on file formats, archives and streams: tables derived from the driver's are
written to the shared folder in a format and read back by the format's reader."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from loomsite.catalog import _AT, register
from loomsite.fixtures import view
from loomsite.operators import alignments, demux, fragments
from loomsite.sources import files
from loomsite.streaming import demultiplex as stream


def _folder(spark) -> str:
    """A new folder in the shared one; a temporary one where none is set on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="loomsite-files-")
    return f"{base.rstrip('/')}/files-{uuid.uuid4().hex}"


def _written(spark, lines, compression="none") -> str:
    path = _folder(spark)
    lines.write.text(path, compression=compression)
    return path


_QUAL = "substr(repeat(translate(md5(readID), '0123456789abcdef', '+++++5555555IIII'), 3), 1, length(anchorReadSeq))"
_FQ = f"SELECT readID, anchorReadSeq AS seq, {_QUAL} AS qual FROM fx_reads"


def _fastq(spark, d):
    return view(spark, d, "fx_reads").select("readID", F.col("anchorReadSeq").alias("seq"), F.expr(_QUAL).alias("qual"))


def _records(df):
    return df.select(F.concat_ws("\n", F.concat(F.lit("@"), "readID", F.lit(" 1:N:0")), "seq", F.lit("+"), "qual").alias("value"))


@register("fastq_scan", _FQ, "fx_reads")
def fastq_scan(spark, d):
    return files.read_fastq(spark, _written(spark, _records(_fastq(spark, d))))


@register("fastq_gzip_scan", _FQ, "fx_reads")
def fastq_gzip_scan(spark, d):
    return files.read_fastq(spark, _written(spark, _records(_fastq(spark, d)), "gzip"))


@register("fastq_export", f", q AS ({_FQ}) SELECT value, uniqueSample FROM (SELECT uniqueSample, unnest(['@' || q.readID, seq, '+', qual]) AS value FROM q JOIN fx_reads r ON r.readID = q.readID WHERE contains(adriftReadSeq, 'AAC'))", "fx_reads")
def fastq_export(spark, d):
    path = _folder(spark)
    kept = view(spark, d, "fx_reads").where("contains(adriftReadSeq, 'AAC')")
    files.export_fastq(_fastq(spark, d), kept, path)
    return spark.read.text(path).select("value", F.col("uniqueSample").cast("string").alias("uniqueSample"))


@register("read_triples", """
SELECT readID, i.index1Seq, a.adriftReadSeq, b.anchorReadSeq FROM fx_reads i JOIN fx_reads a USING (readID) JOIN fx_reads b USING (readID) WHERE NOT contains(a.adriftReadSeq, 'AAC') AND NOT contains(b.anchorReadSeq, 'GGG')""", "fx_reads")
def read_triples(spark, d):
    r = view(spark, d, "fx_reads").withColumn("qual", F.lit("I"))
    i, a, b = (r.select("readID", F.col(c).alias("seq"), "qual") for c in ("index1Seq", "adriftReadSeq", "anchorReadSeq"))
    found = demux.read_triples(i, a.where("not contains(seq, 'AAC')"), b.where("not contains(seq, 'GGG')"))
    return found.select("readID", "index1Seq", "adriftReadSeq", "anchorReadSeq")


_LOW = "concat(substr(tSeq, 1, 40), lower(substr(tSeq, 41, 30)), substr(tSeq, 71))"


def _fasta(spark, d):
    seq = F.expr(_LOW)
    parts = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.substr(seq, i * 60 + 1, F.lit(60)))
    return _written(spark, view(spark, d, "fx_contigs").select(F.concat_ws("\n", F.concat(F.lit(">"), "tName", F.lit(" contig")), parts).alias("value")))


@register("fasta_scan", "SELECT tName AS name, tSeq AS seq FROM fx_contigs", "fx_contigs")
def fasta_scan(spark, d):
    return files.read_fasta(spark, _fasta(spark, d))


@register("masked_vectors", "SELECT tName AS name, concat(substr(tSeq, 1, 40), repeat('N', 30), substr(tSeq, 71)) AS seq FROM fx_contigs", "fx_contigs")
def masked_vectors(spark, d):
    return files.read_fasta(spark, _fasta(spark, d), mask=True)


@register("fasta_chunks", "SELECT tName AS chromosome, CAST(i AS INTEGER) AS chunk, substr(concat(substr(tSeq, 1, 40), repeat('N', 30), substr(tSeq, 71)), CAST(i * 50 + 1 AS BIGINT), 50) AS seq FROM fx_contigs, range(0, 6) t(i)", "fx_contigs")
def fasta_chunks(spark, d):
    """The written FASTA read by ranges of bytes that cut through its records."""
    return files.read_fasta_chunks(spark, _fasta(spark, d), chunk=50, mask=True, split=1 << 16)


@register("reference_chunks", "SELECT tName AS chromosome, CAST(i AS INTEGER) AS chunk, substr(tSeq, CAST(i * 100 + 1 AS BIGINT), 100) AS seq FROM fx_contigs, range(0, 3) t(i)", "fx_contigs")
def reference_chunks(spark, d):
    return files.reference_chunks(files.read_fasta(spark, _fasta(spark, d)), 100)


@register("sample_sheet_scan", """
SELECT 'T' AS trial, concat('S', s_suppkey % 3) AS subject, concat('G', s_suppkey) AS sample, CAST(s_suppkey % 4 + 1 AS INTEGER) AS replicate, concat('T~S', s_suppkey % 3, '~G', s_suppkey, '~', s_suppkey % 4 + 1) AS uniqueSample FROM supplier""")
def sample_sheet_scan(spark, d):
    s = spark.read.parquet(f"{d}/supplier.parquet")
    rows = s.select(F.lit("T").alias("trial"), F.concat(F.lit("S"), F.col("s_suppkey") % 3).alias("subject"), F.concat(F.lit("G"), "s_suppkey").alias("sample"), (F.col("s_suppkey") % 4 + 1).alias("replicate"))
    text = rows.select(F.concat_ws("\n", F.lit("#comment"), F.concat_ws("\t", *rows.columns)).alias("value"))
    path = _folder(spark)
    text.write.text(path)
    header = spark.createDataFrame([("\t".join(rows.columns),)], "value string")
    whole = f"{path}-whole"
    header.unionByName(spark.read.text(path)).coalesce(1).write.text(whole)
    return files.read_samples(spark, whole).select("trial", "subject", "sample", F.col("replicate").cast("int").alias("replicate"), "uniqueSample")


@register("sample_sheet_problems", """
, s AS (SELECT *, CASE WHEN substr(index1Seq, 1, 1) = 'A' THEN 'bad~name' ELSE 'S' END AS subj, CASE WHEN substr(index1Seq, 2, 1) = 'C' THEN 'CTCC' ELSE adriftReadLinkerSeq END AS linker FROM fx_samples)
SELECT DISTINCT 'reserved character' AS problem, subj AS value FROM s WHERE contains(subj, '~') UNION ALL
SELECT 'linker without tag', concat_ws('~', 'T', subj, uniqueSample_, '1') FROM (SELECT *, replace(uniqueSample, '~', '') AS uniqueSample_ FROM s) WHERE NOT contains(linker, 'N') UNION ALL
SELECT 'repeated barcodes', concat_ws(' ', index1Seq, substr(linker, 1, 20)) FROM s GROUP BY index1Seq, substr(linker, 1, 20) HAVING count(*) > 1""", "fx_samples")
def sample_sheet_problems(spark, d):
    s = view(spark, d, "fx_samples").withColumn("subject", F.expr("case when substr(index1Seq, 1, 1) = 'A' then 'bad~name' else 'S' end")).withColumn("adriftReadLinkerSeq", F.expr("case when substr(index1Seq, 2, 1) = 'C' then 'CTCC' else adriftReadLinkerSeq end"))
    s = s.withColumn("sample", F.regexp_replace("uniqueSample", "~", "")).withColumn("trial", F.lit("T")).withColumn("replicate", F.lit(1)).withColumn("refGenome", F.lit("g")).withColumn("vectorFastaFile", F.lit("v"))
    return files.sample_problems(s)


@register("psl_scan", """
SELECT readID AS qName, strand, qStart, qEnd, tName, tStart, tEnd - 1 AS tEnd, misMatches, CAST(qEnd - qStart - misMatches - misMatches - tNumInsert AS BIGINT) AS score FROM fx_alignments""", "fx_alignments")
def psl_scan(spark, d):
    x = view(spark, d, "fx_alignments")
    own = {"matches": F.col("qEnd") - F.col("qStart") - F.col("misMatches"), "qName": F.col("readID")}
    names = [c.split() for c in files.PSL.split(", ")]
    cells = [own.get(n, F.col(n) if n in x.columns else F.lit("1," if t == "string" else "0")).cast("string").alias(n) for n, t in names]
    path = _written(spark, x.select(F.concat_ws("\t", *cells).alias("value")))
    found = alignments.psl_scores(alignments.shift_target(files.read_psl(spark, path)))
    return found.select("qName", "strand", "qStart", "qEnd", "tName", "tStart", "tEnd", "misMatches", "score")


@register("hit_table_scan", "SELECT readID AS qname, tName AS sseqid, CAST(100 - misMatches AS DOUBLE) AS pident, qStart + 1 AS qstart, qEnd AS qend, tStart AS sstart, tEnd AS send, qSize AS qlen, abs(qEnd - qStart - 1) + 1 AS aligned, CASE WHEN tStart <= tEnd THEN '+' ELSE '-' END AS hitStrand FROM fx_alignments", "fx_alignments")
def hit_table_scan(spark, d):
    from loomsite.functions.dna import aligned_length, hit_strand

    x = view(spark, d, "fx_alignments")
    cells = ["readID", "tName", F.expr("100 - misMatches"), F.expr("qEnd - qStart"), "misMatches", "tNumInsert", F.expr("qStart + 1"), "qEnd", "tStart", "tEnd", F.lit("1e-5"), F.lit("50")]
    path = _written(spark, x.select(F.concat_ws("\t", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cells]).alias("value")))
    hits = files.read_hits(spark, path, x.select(F.col("readID").alias("qname"), F.col("qSize").alias("qlen")).distinct())
    return hits.select("qname", "sseqid", "pident", "qstart", "qend", "sstart", "send", "qlen", aligned_length("qstart", "qend").alias("aligned"), hit_strand("sstart", "send").alias("hitStrand"))


_MODELS = """, m AS (SELECT readID AS targetName, concat('hmm', CAST(floor(l.tStart / 5000) AS INTEGER)) AS queryName, 40 - misMatches AS hmmEnd, qStart AS targetStart, qEnd AS targetEnd, CAST(15 + qEnd - misMatches * 4 AS DOUBLE) AS fullScore FROM fx_alignments l)"""


def _models(spark, d):
    x = view(spark, d, "fx_alignments")
    cells = ["readID", F.lit("-"), F.expr("concat('hmm', cast(floor(tStart / 5000) as int))"), F.lit("-"), F.lit("1"), F.expr("40 - misMatches"), "qStart", "qEnd", "qStart", "qEnd", "qSize", "strand", F.lit("1e-9"), F.expr("15 + qEnd - misMatches * 4"), F.lit("0.1"), F.lit("a b  c")]
    rows = x.select(F.concat_ws("   ", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cells]).alias("value"))
    path = _written(spark, rows.unionByName(spark.createDataFrame([("# a comment",), ("",)], "value string")))
    return files.read_models(spark, path)


@register("model_scan", _MODELS + "SELECT *, 'a b  c' AS \"desc\" FROM m", "fx_alignments")
def model_scan(spark, d):
    return _models(spark, d).select("targetName", "queryName", "hmmEnd", "targetStart", "targetEnd", "fullScore", "desc")


@register("model_acceptance", _MODELS + """
, b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY targetName ORDER BY fullScore DESC, targetStart, targetEnd) = 1)
SELECT targetName, targetStart, targetEnd, fullScore FROM b WHERE targetStart <= 5 AND fullScore >= 20 AND 40 - hmmEnd <= 2""", "fx_alignments")
def model_acceptance(spark, d):
    # Rows of a read that tie in score and place have equal figures; the profile's end is made one of them.
    hits = _models(spark, d).withColumn("hmmLength", F.lit(40))
    return alignments.accept_models(hits).select("targetName", "targetStart", "targetEnd", "fullScore")


@register("cluster_report_scan", "SELECT concat('r', o_orderkey, '_', i) AS readID, concat('r', o_orderkey, '_', o_orderkey % 3) AS rep FROM orders, range(0, 3) t(i)")
def cluster_report_scan(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    lines = [F.expr(f"concat('{i}\t84nt, >r', o_orderkey, '_{i}... ', if(o_orderkey % 3 = {i}, '*', 'at 98%'))") for i in range(3)]
    return files.read_clusters(spark, _written(spark, o.select(F.concat_ws("\n", F.concat(F.lit(">Cluster "), "o_orderkey"), *lines).alias("value"))))


@register("repeat_report_scan", "SELECT 463 AS SW_score, CAST(1.3 AS DOUBLE) AS percent_div, query_seq, query_start, query_end, strand, replace(repeat_name, ' ', '_') AS repeat_name, replace(repeat_class, ' ', '_') AS repeat_class, '7' AS ID FROM fx_repeats", "fx_repeats")
def repeat_report_scan(spark, d):
    r = view(spark, d, "fx_repeats")
    cells = [F.lit(" 463"), F.lit("1.3"), F.lit("0.6"), F.lit("1.7"), "query_seq", "query_start", "query_end", F.lit("(2487)"), "strand", F.regexp_replace("repeat_name", " ", "_"), F.regexp_replace("repeat_class", " ", "_"), F.lit("1"), F.lit("463"), F.lit("(0)"), F.lit("7")]
    rows = r.select(F.concat_ws("  ", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cells]).alias("value"))
    head = spark.createDataFrame([("   SW   perc perc perc  query",), ("score   div. del. ins.  sequence",), ("",)], "value string")
    return files.read_repeats(spark, _written(spark, head.unionByName(rows))).select("SW_score", "percent_div", "query_seq", "query_start", "query_end", "strand", "repeat_name", "repeat_class", "ID")


def _gene_files(spark, d):
    g = view(spark, d, "fx_genes").withColumn("mid", F.floor((F.col("txStart") + F.col("txEnd")) / 2).cast("int"))
    bar = F.concat_ws
    pred = bar("\t", "name2", "chromosome", "strand", "txStart", "txEnd", "txStart", "txEnd", F.lit("2"), bar("", "txStart", F.lit(","), "mid", F.lit(",")), bar("", F.expr("txStart + 1"), F.lit(","), "txEnd", F.lit(",")), F.lit("0"), "name2", F.lit("cmpl"), F.lit("cmpl"), F.lit("0,0,"))
    bed = bar("\t", "chromosome", "txStart", "txEnd", "name2", F.lit("0"), "strand", "txStart", "txEnd", F.lit("0"), F.lit("2"), bar("", F.lit("1,"), F.expr("txEnd - mid"), F.lit(",")), bar("", F.lit("0,"), F.expr("mid - txStart"), F.lit(",")), F.lit("x"), F.lit("cmpl"), F.lit("cmpl"), F.lit("0,0,"), F.lit("t"), "name2", F.lit("y"), F.lit("z"))
    wide = bar("\t", F.lit("585"), pred)
    plus = F.col("strand") == "+"
    kind = F.when(plus & (F.col("txStart") % 2 == 0), wide).when(plus, pred).otherwise(bed)
    return files.read_genes(spark, _written(spark, g.select(kind.alias("value")).unionByName(spark.createDataFrame([("#bin name",)], "value string"))))


@register("gene_model_scan", "SELECT name2 AS name, chromosome AS chrom, strand, txStart, txEnd, 2 AS exonCount, name2, 'cmpl' AS cdsStartStat FROM fx_genes", "fx_genes")
def gene_model_scan(spark, d):
    return _gene_files(spark, d).select("name", "chrom", "strand", "txStart", "txEnd", "exonCount", "name2", "cdsStartStat")


@register("exon_rows", """
, g AS (SELECT *, CAST(floor((txStart + txEnd) / 2.0) AS INTEGER) AS mid FROM fx_genes)
SELECT name2 AS name, chromosome, strand, name2, CAST(i AS INTEGER) AS exon, CASE i WHEN 1 THEN txStart + 1 ELSE mid + 1 END AS start, CASE i WHEN 1 THEN txStart + 1 ELSE txEnd END AS "end" FROM g, range(1, 3) t(i)""", "fx_genes")
def exon_rows(spark, d):
    return files.exons_of(_gene_files(spark, d))


@register("annotation_build", """
, g AS (SELECT *, CAST(floor((txStart + txEnd) / 2.0) AS INTEGER) AS mid FROM fx_genes WHERE chromosome IN ('chr1', 'chr2'))
SELECT DISTINCT 'gene' AS kind, chromosome, txStart + 1 AS start, txEnd AS "end", strand, name2 FROM g UNION ALL
SELECT 'exon', chromosome, CASE i WHEN 1 THEN txStart + 1 ELSE mid + 1 END, CASE i WHEN 1 THEN txStart + 1 ELSE txEnd END, strand, name2 FROM g, range(1, 3) t(i)""", "fx_genes")
def annotation_build(spark, d):
    from loomsite.plans import stages

    found = stages.build_annotations(_gene_files(spark, d), ["chr1", "chr2"])
    columns = ["chromosome", "start", "end", "strand", "name2"]
    return found["genes"].select(F.lit("gene").alias("kind"), *columns).unionByName(found["exons"].select(F.lit("exon").alias("kind"), *columns))


@register("gene_list_scan", "SELECT upper(name2) AS name2 FROM fx_genes", "fx_genes")
def gene_list_scan(spark, d):
    return files.read_gene_list(spark, _written(spark, view(spark, d, "fx_genes").select(F.concat(F.lit(" "), F.lower("name2")).alias("value"))))


@register("foreign_gene_filter", "SELECT chromosome, txStart, name2 FROM fx_genes WHERE txStart % 3 = 0", "fx_genes")
def foreign_gene_filter(spark, d):
    g = view(spark, d, "fx_genes")
    found = files.known_genes(g.withColumn("name", F.concat("name2", F.lit(".3"))), g.where("txStart % 3 = 0").select(F.concat("name2", F.lit(".1")).alias("name")))
    return found.select("chromosome", "txStart", "name2")


@register("standard_chromosomes", "SELECT * FROM fx_genes WHERE chromosome IN ('chr1', 'chr3')", "fx_genes")
def standard_chromosomes(spark, d):
    return files.standard_chromosomes(view(spark, d, "fx_genes"), ["chr1", "chr3", "chrX"])


@register("stage_table_roundtrip", "SELECT * FROM fx_fragments", "fx_fragments")
def stage_table_roundtrip(spark, d):
    folder = _folder(spark)
    files.save_stage(view(spark, d, "fx_fragments").limit(0), folder, "fragments")
    return files.save_stage(view(spark, d, "fx_fragments"), folder, "fragments")


_SITES = _AT + """, s AS (SELECT trial, subject, sample, posid, count(DISTINCT fragEnd - fragStart) AS sonicLengths FROM p GROUP BY ALL)"""


@register("tsv_sink", _SITES + "SELECT trial, subject, sample, posid, CAST(sonicLengths AS INTEGER) AS sonicLengths, CAST(row_number() OVER (ORDER BY sonicLengths DESC, trial, subject, sample, posid) AS INTEGER) AS place FROM s", "fx_fragments")
def tsv_sink(spark, d):
    sites = fragments.summarize_sites(view(spark, d, "fx_fragments")).select("trial", "subject", "sample", "posid", "sonicLengths")
    path = _folder(spark)
    files.write_tsv(sites.orderBy(F.desc("sonicLengths"), "trial", "subject", "sample", "posid").coalesce(1), path)
    back = spark.read.csv(path, sep="\t", header=True, schema="trial string, subject string, sample string, posid string, sonicLengths int")
    return back.withColumn("place", (F.monotonically_increasing_id() + 1).cast("int"))


@register("result_bundle", "SELECT readID, strand, CAST(NULL AS INTEGER) AS fragEnd FROM fx_fragments WHERE strand = '+' UNION ALL SELECT readID, NULL, fragEnd FROM fx_fragments WHERE strand = '-'", "fx_fragments")
def result_bundle(spark, d):
    f, path = view(spark, d, "fx_fragments"), _folder(spark)
    f.where("strand = '+'").select("readID", "strand").write.parquet(f"{path}/a")
    f.where("strand = '-'").select("readID", "fragEnd").write.parquet(f"{path}/b")
    return files.read_bundle(spark, f"{path}/a", f"{path}/b")


def _archive(spark, d):
    """Fragments as archived: two samples' rows are replaced by their plus strand."""
    f, path = view(spark, d, "fx_fragments").withColumn("refGenome", F.lit("hg38")), _folder(spark)
    files.write_archive(files.archive_rows(f, "fragments"), path)
    files.write_archive(files.archive_rows(f.where("sample in ('G1', 'G2') and subject = 'S1' and strand = '+'"), "fragments"), path)
    return path


_ARCHIVED = "SELECT trial, subject, sample, 'hg38' AS refGenome, replicate, readID, chromosome, strand, fragStart, fragEnd, leaderSeq, randomLinkerSeq, flags, nDuplicateReads FROM fx_fragments WHERE NOT (sample IN ('G1', 'G2') AND subject = 'S1' AND strand = '-')"


@register("archive_upsert", _ARCHIVED, "fx_fragments")
def archive_upsert(spark, d):
    return files.read_archive(spark, _archive(spark, d))


@register("archive_pull", f", a AS ({_ARCHIVED}) SELECT * FROM a WHERE (subject = 'S1' AND sample = 'G2') OR subject = 'S0'", "fx_fragments")
def archive_pull(spark, d):
    return files.read_archive(spark, _archive(spark, d), "T,S1,G2,hg38|T,S0")


@register("archived_samples", "SELECT uniqueSample, split_part(uniqueSample, '~', 3) IN (SELECT sample FROM fx_fragments) AND split_part(uniqueSample, '~', 2) IN (SELECT subject FROM fx_fragments) AS inDatabase FROM fx_samples", "fx_samples", "fx_fragments")
def archived_samples(spark, d):
    from loomsite.functions.dna import sample_parts

    parts = sample_parts("uniqueSample")
    s = view(spark, d, "fx_samples").select("uniqueSample", *[parts[c].alias(c) for c in ("trial", "subject", "sample")], F.lit("hg38").alias("refGenome"))
    return files.already_archived(s, files.read_archive(spark, _archive(spark, d))).select("uniqueSample", "inDatabase")


_ASSIGNED = """, m AS (SELECT r.readID, s.uniqueSample, r.anchorReadSeq, r.adriftReadSeq FROM fx_reads r JOIN fx_samples s ON hamming(r.index1Seq, s.index1Seq) <= 1 AND hamming(substr(r.adriftReadSeq, 1, 20), substr(s.adriftReadLinkerSeq, 1, 20)) <= 1)"""


def _shards(spark, d):
    r, path = view(spark, d, "fx_reads").select("readID", "index1Seq", "anchorReadSeq", "adriftReadSeq"), _folder(spark)
    r.repartition(4, "readID").write.parquet(path)
    return stream.assign_stream(stream.read_shards(spark, path, per_trigger=2), view(spark, d, "fx_samples"))


@register("stream_assign", _ASSIGNED + "SELECT readID, uniqueSample FROM m", "fx_reads", "fx_samples")
def stream_assign(spark, d):
    out = _folder(spark)
    stream.write_assigned(_shards(spark, d), out, f"{out}-c").awaitTermination()
    return spark.read.parquet(out).select("readID", "uniqueSample")


@register("stream_distinct", _ASSIGNED + "SELECT min(readID) AS readID, arg_min(uniqueSample, (readID, uniqueSample)) AS uniqueSample, anchorReadSeq, adriftReadSeq, count(*) - 1 AS nDuplicateReads FROM m GROUP BY anchorReadSeq, adriftReadSeq", "fx_reads", "fx_samples")
def stream_distinct(spark, d):
    out = _folder(spark)
    stream.write_distinct(_shards(spark, d), out).awaitTermination()
    return stream.read_distinct(spark, out)


@register("stream_counts", _ASSIGNED + "SELECT uniqueSample, count(*) AS reads FROM m GROUP BY ALL", "fx_reads", "fx_samples")
def stream_counts(spark, d):
    out = _folder(spark)
    stream.write_counts(_shards(spark, d), out).awaitTermination()
    return stream.read_counts(spark, out)
