"""Readers and writers of the file formats of sequencing pipelines."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: The columns of the file formats, in their order.
PSL = "matches int, misMatches int, repMatches int, nCount int, qNumInsert int, qBaseInsert int, tNumInsert int, tBaseInsert int, strand string, qName string, qSize int, qStart int, qEnd int, tName string, tSize int, tStart int, tEnd int, blockCount int, blockSizes string, qStarts string, tStarts string"
HITS = "qname string, sseqid string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double"
GENE_PRED = "bin int, name string, chrom string, strand string, txStart int, txEnd int, cdsStart int, cdsEnd int, exonCount int, exonStarts string, exonEnds string, score int, name2 string, cdsStartStat string, cdsEndStat string, exonFrames string"
_HMM = [("targetName", "string"), ("targetAcc", "string"), ("queryName", "string"), ("queryAcc", "string"), ("hmmStart", "int"), ("hmmEnd", "int"), ("targetStart", "int"), ("targetEnd", "int"), ("envStart", "int"), ("envEnd", "int"), ("seqLength", "int"), ("strand", "string"), ("fullEval", "double"), ("fullScore", "double"), ("bias", "double"), ("desc", "string")]
READ_SCHEMA = "readID string, seq string, qual string"


#: Bytes of a FASTQ file that one partition reads; a gzip file is one partition.
SPLIT = 64 << 20


def _file_system(path: str):
    """A file system for a path or URI that executors can open, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Piece(InputPartition):
    """The records of a file that begin from byte ``start`` on and before ``end``."""

    def __init__(self, path: str, start: int, end: int | None):
        self.path, self.start, self.end = path, start, end


class FastqReader(DataSourceReader):
    """Plain files are split at records; shard large gzip files."""

    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        found = []
        for given in self.paths:
            store, path = _file_system(given)
            info = store.get_file_info(path)
            files = [x for x in store.get_file_info(fs.FileSelector(path)) if ".f" in x.base_name or x.base_name.endswith((".txt", ".txt.gz"))] if info.type == fs.FileType.Directory else [info]
            prefix = given[: len(given) - len(path)] if given.endswith(path) else "file://" if given.startswith("file:") else ""
            for f in sorted(files, key=lambda x: x.path):
                ends = [None] if f.path.endswith(".gz") else range(SPLIT, f.size + SPLIT, SPLIT)
                found += [Piece(prefix + f.path, i * SPLIT, e) for i, e in enumerate(ends)]
        return found

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        store, path = _file_system(partition.path)
        if partition.end is None:
            with gzip.open(store.open_input_stream(path, compression=None), "rt") as f:
                while head := f.readline():
                    seq, _, qual = f.readline(), f.readline(), f.readline()
                    yield head[1:].split()[0], seq.rstrip("\n"), qual.rstrip("\n")
            return
        with store.open_input_file(path) as raw:
            import io

            raw.seek(max(0, partition.start - 1))
            f = io.BufferedReader(raw, 1 << 20)
            at = max(0, partition.start - 1)
            if partition.start:
                at += len(f.readline())
                # A record's first line has @, and the second line after it +.
                ahead = [f.readline() for _ in range(8)]
                skip = next((i for i in range(4) if ahead[i][:1] == b"@" and ahead[i + 2][:1] == b"+" and (ahead[i + 4][:1] in (b"@", b""))), 8)
                at += sum(map(len, ahead[:skip]))
                lines = iter([*ahead[skip:]])
            else:
                lines = iter(())

            def line() -> bytes:
                return next(lines, None) or f.readline()

            while at < partition.end and (head := line()):
                seq, plus, qual = line(), line(), line()
                at += len(head) + len(seq) + len(plus) + len(qual)
                yield head[1:].split()[0].decode(), seq.rstrip(b"\n").decode(), qual.rstrip(b"\n").decode()


class FastqSource(DataSource):
    """``spark.read.format("fastq").load("a.fastq.gz,b.fastq")``: files or folders, as
    paths of a shared file system or URIs of a store."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return FastqReader(self.options["path"].split(","))


def read_fastq(spark: SparkSession, *paths: str) -> DataFrame:
    """Reads ``(readID, seq, qual)``; ids end at the first white space."""
    spark.dataSource.register(FastqSource)
    return spark.read.format("fastq").load(",".join(paths))


def read_fastq_text(spark: SparkSession, path: str) -> DataFrame:
    """The same from plain text records that any store holds, split by Spark: needs every
    record to begin with ``@`` on a line of its own and quality lines not to."""
    rows = spark.read.option("lineSep", "\n@").text(path)
    parts = F.split(F.regexp_replace("value", "^@", ""), "\n")
    return rows.where(F.length("value") > 0).select(F.split(parts[0], r"\s")[0].alias("readID"), parts[1].alias("seq"), F.regexp_replace(parts[3], r"\s+$", "").alias("qual"))


def read_fasta(spark: SparkSession, path: str, mask: bool = False) -> DataFrame:
    """``(name, seq)``; with ``mask`` lower-case bases become N, else all are upper case."""
    rows = spark.read.option("lineSep", ">").text(path).where(F.length("value") > 0)
    name = F.split(F.split("value", "\n")[0], r"\s")[0]
    seq = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n", ""), r"\s", "")
    return rows.select(name.alias("name"), (F.translate(seq, "acgtn", "NNNNN") if mask else F.upper(seq)).alias("seq"))


#: Bytes before a range in which the line that it begins in is looked for.
LONGEST_HEADER = 1 << 16


def _fasta_parts(path: str, start: int, end: int, step: int = 1 << 20) -> Iterator[tuple[str | None, bytes]]:
    """The contents of a range of bytes in order: ``(name, b"")`` for each header that begins
    in it, and ``(None, bases)`` for what follows. Records may be cut anywhere; a header
    belongs to the range of its first byte."""
    store, inner = _file_system(path)
    with store.open_input_file(inner) as f:
        # Does the range begin inside a header?
        f.seek(max(0, start - LONGEST_HEADER))
        line = f.read(start - max(0, start - LONGEST_HEADER)).rsplit(b"\n", 1)[-1]
        inside, at, begins = line[:1] == b">", start, not line
        head = b""
        own = False
        while at < end or own:
            data = f.read(min(step, end - at) if at < end else 4096)
            if not data:
                break
            at += len(data)
            while data:
                if inside:
                    text, cut, data = data.partition(b"\n")
                    head += text
                    if cut:
                        if own:
                            yield head[1:].split()[0].decode() if head[1:].split() else "", b""
                        inside, own, head, begins = False, False, b"", True
                        if at > end:
                            data = b""
                    continue
                spot = 0 if begins and data[:1] == b">" else data.find(b"\n>") + 1
                if spot or (begins and data[:1] == b">"):
                    bases, data = data[:spot], data[spot:]
                    inside, own = True, True
                else:
                    bases, data = data, b""
                if bases:
                    begins = bases.endswith(b"\n")
                    yield None, bases.translate(None, b" \t\r\n")
    if own:
        yield head[1:].split()[0].decode() if head[1:].split() else "", b""


def read_fasta_chunks(spark: SparkSession, *paths: str, chunk: int = 10_000, mask: bool = False, split: int = SPLIT) -> DataFrame:
    """``(chromosome, chunk, seq)`` rows of ``chunk`` bases of FASTA files, which are read by
    ranges of ``split`` bytes whatever their lines: a chromosome is as many tasks as it has
    ranges, and no task holds more than a step of it.

    A first pass tells for each range how many bases it holds before its first and after its
    last header; with these few figures (one row for each range of the files) each range
    knows the record and the position at which it begins. Bases of chunks that two ranges
    share are put together by a grouping. ``mask``: lower-case bases become N."""
    from pyarrow import fs

    ranges = []
    for given in paths:
        store, path = _file_system(given)
        info = store.get_file_info(path)
        files_ = [x for x in store.get_file_info(fs.FileSelector(path)) if x.size and not x.base_name.startswith(("_", "."))] if info.type == fs.FileType.Directory else [info]
        prefix = given[: len(given) - len(path)] if given.endswith(path) else "file://" if given.startswith("file:") else ""
        ranges += [(prefix + f.path, i, min(i + split, f.size)) for f in sorted(files_, key=lambda x: x.path) for i in range(0, f.size, split)]
    empty = "chromosome string, chunk int, seq string"
    if not ranges:
        return spark.createDataFrame([], empty)
    dealt = spark.createDataFrame(ranges, "path string, start long, end long").repartition(len(ranges), "path", "start")

    def survey(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for r in pdf.itertuples():
                before, name, after = 0, None, 0
                for head, bases in _fasta_parts(r.path, r.start, r.end):
                    if head is not None:
                        name, after = head, 0
                    elif name is None:
                        before += len(bases)
                    else:
                        after += len(bases)
                yield pd.DataFrame([(r.path, r.start, r.end, before, name, after)], columns=["path", "start", "end", "before", "name", "after"])

    known = dealt.mapInPandas(survey, "path string, start long, end long, before long, name string, after long").collect()
    carried, name, at, path = [], None, 0, None
    for r in sorted(known, key=lambda r: (r.path, r.start)):
        if r.path != path:
            path, name, at = r.path, None, 0
        carried.append((r.path, r.start, r.end, name, at))
        name, at = (name, at + r.before) if r.name is None else (r.name, r.after)
    table = bytes.maketrans(b"acgtn", b"NNNNN") if mask else bytes.maketrans(bytes(range(97, 123)), bytes(range(65, 91)))

    def cut(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for r in pdf.itertuples():
                name, at = r.name, r.at
                for head, bases in _fasta_parts(r.path, r.start, r.end):
                    if head is not None:
                        name, at = head, 0
                        continue
                    if name is None:
                        continue
                    out, text = [], bases.translate(table).decode("latin-1")
                    while text:
                        n = chunk - at % chunk
                        out.append((name, at // chunk, at % chunk, text[:n]))
                        at, text = at + len(text[:n]), text[n:]
                    if out:
                        yield pd.DataFrame(out, columns=["chromosome", "chunk", "at", "seq"])

    rows = spark.createDataFrame(carried, "path string, start long, end long, name string, at long").repartition(len(carried), "path", "start")
    pieces = rows.mapInPandas(cut, "chromosome string, chunk int, at int, seq string")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "seq"))), lambda x: x["seq"]), "")
    return pieces.groupBy("chromosome", "chunk").agg(joined.alias("seq"))


def reference_chunks(fasta: DataFrame, chunk: int = 10_000) -> DataFrame:
    """A reference as ``(chromosome, chunk, seq)`` rows of ``chunk`` bases."""
    n = F.ceil(F.length("seq") / chunk).cast("int")
    rows = fasta.where(F.length("seq") > 0).select("name", "seq", F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk"))
    return rows.select(F.col("name").alias("chromosome"), "chunk", F.expr(f"substring(seq, chunk * {chunk} + 1, {chunk})").alias("seq"))


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, sep="\t", header=True, comment="#", inferSchema=True)
    return df.withColumn("uniqueSample", F.concat_ws("~", "trial", "subject", "sample", F.col("replicate").cast("string")))


REQUIRED = ("trial", "subject", "sample", "replicate", "adriftReadLinkerSeq", "index1Seq", "refGenome", "vectorFastaFile", "flags")


def sample_problems(samples: DataFrame) -> DataFrame:
    """What is wrong with a sample sheet, as ``(problem, value)`` rows; none if it is fine."""
    missing = [c for c in REQUIRED if c not in samples.columns]
    if missing:
        return samples.sparkSession.createDataFrame([("missing column", c) for c in missing], "problem string, value string")
    names = F.explode(F.array("trial", "subject", "sample"))
    odd = samples.select(names.alias("value")).where(F.col("value").rlike(r"[ ~|.]")).select(F.lit("reserved character").alias("problem"), "value")
    ids = F.concat_ws("~", "trial", "subject", "sample", F.col("replicate").cast("string"))
    twice = samples.groupBy(ids.alias("value")).count().where("count > 1").select(F.lit("repeated sample").alias("problem"), "value")
    codes = samples.groupBy(F.concat_ws(" ", "index1Seq", F.substring("adriftReadLinkerSeq", 1, 20)).alias("value")).count().where("count > 1").select(F.lit("repeated barcodes").alias("problem"), "value")
    tagless = samples.where(~F.col("adriftReadLinkerSeq").contains("N")).select(F.lit("linker without tag").alias("problem"), ids.alias("value"))
    return odd.unionByName(twice).unionByName(codes).unionByName(tagless).distinct()


def read_psl(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=PSL)


def read_hits(spark: SparkSession, path: str, lengths: DataFrame | None = None) -> DataFrame:
    """Local hits of 12 columns, with ``qlen`` joined from ``lengths (qname, qlen)``."""
    df = spark.read.csv(path, sep="\t", schema=HITS)
    return df if lengths is None else df.join(lengths, "qname")


def read_models(spark: SparkSession, path: str) -> DataFrame:
    """Profile hits: white space separates 16 columns, ``#`` begins comments."""
    parts = F.split(F.trim("value"), r"\s+", 16)
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return rows.select(*[F.get(parts, F.lit(i)).cast(t).alias(n) for i, (n, t) in enumerate(_HMM)])


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """A cluster report -> ``(readID, rep)``; the representative is the member marked *."""
    rows = spark.read.option("lineSep", ">Cluster").text(path).where(F.col("value").contains(">"))
    members = F.regexp_extract_all("value", F.lit(r">(\S+?)\.\.\."), 1)
    rep = F.regexp_extract("value", r">(\S+?)\.\.\. \*", 1)
    return rows.select(F.explode(members).alias("readID"), rep.alias("rep"))


#: The 15 columns of a repeat report.
REPEATS = [("SW_score", "int"), ("percent_div", "double"), ("percent_del", "double"), ("percent_ins", "double"), ("query_seq", "string"), ("query_start", "int"), ("query_end", "int"), ("query_after", "string"), ("strand", "string"), ("repeat_name", "string"), ("repeat_class", "string"), ("repeat_start", "string"), ("repeat_end", "string"), ("repeat_after", "string"), ("ID", "string")]


def read_repeats(spark: SparkSession, path: str) -> DataFrame:
    """A repeat report: rows whose first field is an integer, with all 15 columns."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(F.trim("value").rlike(r"^\d+\s"))
    return rows.select(*[F.get(parts, F.lit(i)).cast(t).alias(n) for i, (n, t) in enumerate(REPEATS)])


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    """Gene models as genePred with 15 or 16 columns, or as BED with 20 (the strand is
    their sixth column), in one schema."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.length("value") > 0))
    names = [x.split() for x in GENE_PRED.split(", ")]
    is_bed = F.get(parts, F.lit(5)).isin("+", "-")
    wide = rows.where(~is_bed & (F.size(parts) == 16)).select(*[parts[i].cast(t).alias(n) for i, (n, t) in enumerate(names)])
    short = rows.where(~is_bed & (F.size(parts) == 15)).select(F.lit(0).alias("bin"), *[parts[i].cast(t).alias(n) for i, (n, t) in enumerate(names[1:])])
    starts = F.split(F.regexp_replace(parts[11], ",$", ""), ",")
    sizes = F.split(F.regexp_replace(parts[10], ",$", ""), ",")
    at = F.transform(starts, lambda x: x.cast("int") + parts[1].cast("int"))
    ends = F.zip_with(at, sizes, lambda a, n: a + n.cast("int"))
    bed = {"bin": F.lit(0), "name": parts[3], "chrom": parts[0], "strand": parts[5], "txStart": parts[1], "txEnd": parts[2], "cdsStart": parts[6], "cdsEnd": parts[7], "exonCount": parts[9], "exonStarts": F.array_join(at, ","), "exonEnds": F.array_join(ends, ","), "score": parts[4], "name2": F.coalesce(F.get(parts, F.lit(17)), parts[3]), "cdsStartStat": F.get(parts, F.lit(13)), "cdsEndStat": F.get(parts, F.lit(14)), "exonFrames": F.get(parts, F.lit(15))}
    beds = rows.where(is_bed).select(*[bed[n].cast(t).alias(n) for n, t in names])
    return wide.unionByName(short).unionByName(beds)


def exons_of(genes: DataFrame) -> DataFrame:
    """One row per exon of gene models, numbered in its transcript; 1-based starts."""
    pair = F.arrays_zip(F.split(F.regexp_replace("exonStarts", ",$", ""), ",").alias("s"), F.split(F.regexp_replace("exonEnds", ",$", ""), ",").alias("e"))
    rows = genes.select("name", F.col("chrom").alias("chromosome"), "strand", "name2", F.posexplode(pair).alias("n", "x"))
    return rows.select("name", "chromosome", "strand", "name2", (F.col("n") + 1).alias("exon"), (F.col("x.s").cast("int") + 1).alias("start"), F.col("x.e").cast("int").alias("end"))


def known_genes(genes: DataFrame, ids: DataFrame) -> DataFrame:
    """Of another species' annotation the rows whose transcript ``name``, without its
    version, is one of ``ids (name)``."""
    listed = ids.select(F.regexp_replace("name", r"\.\d+$", "").alias("__id")).distinct()
    return genes.join(listed, F.regexp_replace(genes["name"], r"\.\d+$", "") == listed["__id"], "left_semi")


def read_gene_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.trim("value") != "").select(F.upper(F.trim("value")).alias("name2"))


def in_gene_list(df: DataFrame, genes: DataFrame) -> DataFrame:
    listed = genes.select(F.upper("name2").alias("__name")).distinct()
    return df.join(listed, F.upper(df["name2"]) == listed["__name"], "left_semi")


def standard_chromosomes(df: DataFrame, names: list[str], column: str = "chromosome") -> DataFrame:
    return df.where(F.col(column).isin(names))


def write_tsv(df: DataFrame, path: str, compress: bool = True) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True, compression="gzip" if compress else "none")


def export_fastq(raw: DataFrame, reads: DataFrame, path: str) -> None:
    """The raw records ``(readID, seq, qual)`` of the reads kept, in a folder per sample.

    Records are dealt by ranges of samples and reads, so that there are few more files than
    samples, and a large sample is many tasks."""
    kept = raw.join(reads.select("readID", "uniqueSample"), "readID")
    kept = kept.select("uniqueSample", "readID", F.concat_ws("\n", F.concat(F.lit("@"), "readID"), "seq", F.lit("+"), "qual").alias("value"))
    kept = kept.repartitionByRange("uniqueSample", "readID").sortWithinPartitions("uniqueSample")
    kept.select("uniqueSample", "value").write.mode("overwrite").partitionBy("uniqueSample").text(path, compression="gzip")


def save_stage(df: DataFrame, folder: str, stage: str) -> DataFrame:
    """Writes a stage's table to its folder, in place of what was there, and reads it back."""
    df.write.mode("overwrite").parquet(f"{folder}/{stage}")
    return load_stage(df.sparkSession, folder, stage)


def load_stage(spark: SparkSession, folder: str, stage: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{stage}")


#: The archived tables and their columns.
ARCHIVES = {
    "demultiplex": "trial string, subject string, sample string, replicate int, refGenome string, readID string, anchorReadSeq string, adriftReadSeq string, nDuplicateReads int",
    "fragments": "trial string, subject string, sample string, replicate int, refGenome string, readID string, chromosome string, strand string, fragStart int, fragEnd int, leaderSeq string, randomLinkerSeq string, flags string, nDuplicateReads int",
    "sites": "trial string, subject string, sample string, refGenome string, posid string, rUMIs bigint, sonicLengths bigint, reads bigint, nRepsObs bigint, percentSampleRelAbund double",
    "multihits": "trial string, subject string, sample string, refGenome string, clusterID string, nodes bigint, reads bigint, UMIs bigint, posids array<string>",
}


def archive_rows(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the archive's schema: its columns in their order and types, those that are
    missing null."""
    schema = T.StructType.fromDDL(ARCHIVES[table])
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


ARCHIVE_KEYS = ["trial", "subject", "sample", "refGenome"]


def write_archive(df: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Replaces the archive's partitions of the samples in ``df`` and leaves the others."""
    keys = keys or ARCHIVE_KEYS
    df.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def read_archive(spark: SparkSession, path: str, wanted: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Archived rows of ``a,b,c,g|a,b,c,g`` samples; fewer values match more samples. The
    conditions are on partition columns, so that other partitions aren't read."""
    keys = keys or ARCHIVE_KEYS
    df = spark.read.parquet(path)
    if wanted is None:
        return df
    any_of = F.lit(False)
    for one in wanted.split("|"):
        all_of = F.lit(True)
        for k, v in zip(keys, one.split(","), strict=False):
            all_of &= F.col(k) == v
        any_of |= all_of
    return df.where(any_of)


def already_archived(samples: DataFrame, archive: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``samples`` with ``inDatabase``."""
    keys = keys or ARCHIVE_KEYS
    return samples.join(archive.select(*keys).distinct().withColumn("__in", F.lit(True)), keys, "left").withColumn("inDatabase", F.coalesce("__in", F.lit(False))).drop("__in")


def read_bundle(spark: SparkSession, *paths: str) -> DataFrame:
    """Several result tables as one; columns that some lack are null there."""
    first, *rest = (spark.read.parquet(p) for p in paths)
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first
