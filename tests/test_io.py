"""File formats, archives and streams, in temporary folders."""

import gzip
import random

from pyspark.sql import functions as F

from loomsite.operators import demux
from loomsite.sources import files
from loomsite.streaming import demultiplex as stream


def test_fastq(spark, tmp_path):
    text = "".join(f"@r{i} extra\n{'ACGT'[i % 4] * 5}\n+\n?????\n" for i in range(5))
    (tmp_path / "a.fastq").write_text(text)
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as f:
        f.write(text)
    got = files.read_fastq(spark, str(tmp_path / "a.fastq"), str(tmp_path / "b.fastq.gz")).collect()
    assert len(got) == 10 and {r.readID for r in got} == {f"r{i}" for i in range(5)}
    plain = {(r.readID, r.seq, r.qual) for r in files.read_fastq_text(spark, str(tmp_path / "a.fastq")).collect()}
    assert plain == {(f"r{i}", "ACGT"[i % 4] * 5, "?????") for i in range(5)}


def test_fasta_and_tables(spark, tmp_path):
    (tmp_path / "v.fa").write_text(">one x\nACgt\nAC\n>two\nTTTT\n")
    assert {r.name: r.seq for r in files.read_fasta(spark, str(tmp_path / "v.fa"), mask=True).collect()} == {"one": "ACNNAC", "two": "TTTT"}
    chunks = files.reference_chunks(files.read_fasta(spark, str(tmp_path / "v.fa")), 4)
    assert {(r.chromosome, r.chunk): r.seq for r in chunks.collect()} == {("one", 0): "ACGT", ("one", 1): "AC", ("two", 0): "TTTT"}
    (tmp_path / "c.clstr").write_text(">Cluster 0\n0\t9nt, >r1... *\n1\t9nt, >r2... at 99%\n>Cluster 1\n0\t9nt, >r3... *\n")
    assert {r.readID: r.rep for r in files.read_clusters(spark, str(tmp_path / "c.clstr")).collect()} == {"r1": "r1", "r2": "r1", "r3": "r3"}
    (tmp_path / "h.tbl").write_text("# comment\nread1 - model - 1 50 1 49 1 49 100 + 1e-9 55.5 0.1 some words here\n")
    row = files.read_models(spark, str(tmp_path / "h.tbl")).first()
    assert (row.targetName, row.hmmEnd, row.fullScore, row.desc) == ("read1", 50, 55.5, "some words here")
    (tmp_path / "r.out").write_text("SW perc\nscore div\n\n 463 1.3 0.6 1.7 chr1 10001 10468 (2) + (TAACCC)n Simple_repeat 1 471 (0) 1\n")
    assert files.read_repeats(spark, str(tmp_path / "r.out")).first().repeat_class == "Simple_repeat"
    gp = ["1", "tx", "chr1", "+", "10", "100", "10", "100", "2", "10,50,", "20,100,", "0", "GENE", "cmpl", "cmpl", "0,1,"]
    (tmp_path / "g.txt").write_text("\t".join(gp) + "\n" + "\t".join(gp[1:]) + "\n")
    genes = files.read_genes(spark, str(tmp_path / "g.txt"))
    assert genes.count() == 2
    assert sorted((r.exon, r.start, r.end) for r in files.exons_of(genes.limit(1)).collect()) == [(1, 11, 20), (2, 51, 100)]


def test_fasta_by_ranges(spark, tmp_path):
    """Records over several ranges, on one line or on many, empty ones, long headers, ranges
    that begin in headers and at line ends."""
    rnd = random.Random(3)
    want, text = {}, ""
    for i in range(12):
        n = rnd.choice([0, 1, 7, 40, 333])
        seq = "".join(rnd.choice("ACGTacgtn") for _ in range(n))
        want[f"c{i}"] = seq
        width = rnd.choice([1000, 9, 10])
        text += f">c{i} {'x' * rnd.choice([0, 5, 60])}\n" + "".join(seq[j : j + width] + rnd.choice(["\n", "\r\n"]) for j in range(0, n, width))
    (tmp_path / "g.fa").write_bytes(text.encode())
    masked = str.maketrans("acgtn", "NNNNN")
    for split in (1, 7, 64, 1 << 20):
        if split == 1:
            parts = [p for start in range(len(text)) for p in files._fasta_parts(str(tmp_path / "g.fa"), start, start + 1)]
            assert [h for h, _ in parts if h is not None] == list(want) and b"".join(b for _, b in parts).decode() == "".join(want.values())
            continue
        got = files.read_fasta_chunks(spark, f"file://{tmp_path / 'g.fa'}", chunk=10, mask=True, split=split).collect()
        whole = {}
        for r in sorted(got, key=lambda r: (r.chromosome, r.chunk)):
            whole[r.chromosome] = whole.get(r.chromosome, "") + r.seq
        assert whole == {k: v.translate(masked) for k, v in want.items() if v}
        assert all(len(r.seq) == 10 for r in got if (r.chunk + 1) * 10 <= len(want[r.chromosome]))


def test_one_record_is_read_in_several_partitions(spark, tmp_path):
    (tmp_path / "big.fa").write_text(">one\n" + "ACGTTGCA" * 6_250_000)
    got = files.read_fasta_chunks(spark, str(tmp_path / "big.fa"), chunk=100_000, split=8 << 20)
    assert got.count() == 500 and got.where("length(seq) <> 100000 or seq not like 'ACGTTGCA%'").isEmpty()


def test_sample_sheet(spark, tmp_path):
    head = "\t".join(files.REQUIRED)
    good = "T\tS\tG1\t1\tACGTACGTACGTACGTACGTNNNNCC\tAAAAAAAAAAAA\thg\tv.fa\tIN_u5"
    (tmp_path / "s.tsv").write_text(f"# note\n{head}\n{good}\n{good}\nT\tS~x\tG2\t1\tACGT\tCCCCCCCCCCCC\thg\tv.fa\tnone\n")
    found = {r.problem for r in files.sample_problems(files.read_samples(spark, str(tmp_path / "s.tsv"))).collect()}
    assert found == {"repeated sample", "repeated barcodes", "reserved character", "linker without tag"}


def test_archive_replaces_only_its_samples(spark, tmp_path):
    path = str(tmp_path / "archive")
    rows = spark.createDataFrame([("T", "S", g, "hg", i) for g in ("a", "b") for i in range(3)], "trial string, subject string, sample string, refGenome string, x int")
    files.write_archive(rows, path)
    files.write_archive(rows.where("sample = 'a' and x = 0"), path)
    assert files.read_archive(spark, path, "T,S,a,hg").count() == 1 and files.read_archive(spark, path, "T,S").count() == 4
    assert files.read_archive(spark, path, "T,S,a,hg|T,S,b,hg").count() == 4
    flags = files.already_archived(spark.createDataFrame([("T", "S", "a", "hg"), ("T", "S", "z", "hg")], "trial string, subject string, sample string, refGenome string"), files.read_archive(spark, path))
    assert {r["sample"]: r.inDatabase for r in flags.collect()} == {"a": True, "z": False}


def test_streams(spark, tmp_path):
    samples = spark.createDataFrame([("T~S~G~1", "AAAAAAAAAAAA", "ACGTNNNNCC")], "uniqueSample string, index1Seq string, adriftReadLinkerSeq string")
    shards = str(tmp_path / "shards")
    rnd = random.Random(2)
    rows = [(f"r{i}", "AAAAAAAAAAAA", rnd.choice(["GA", "GC", "GT"]), "ACGTAAAACC") for i in range(30)]
    one, two = rows[:15], rows[15:]
    for part in (one, two):
        spark.createDataFrame(part, stream.READS).coalesce(1).write.mode("append").parquet(shards)
        moved = stream.assign_stream(stream.read_shards(spark, shards), samples)
        stream.write_assigned(moved, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
        stream.write_distinct(moved, str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 30
    kept = stream.read_distinct(spark, str(tmp_path / "c2"))
    want = {}
    for i, _, a, _ in rows:
        want.setdefault(a, []).append(i)
    assert {r.anchorReadSeq: (r.readID, r.nDuplicateReads) for r in kept.collect()} == {a: (min(x), len(x) - 1) for a, x in want.items()}
    assert kept.agg(F.sum("nDuplicateReads")).first()[0] == 30 - kept.count()
    assert kept.count() == len({r[2] for r in rows}) == kept.select("anchorReadSeq").distinct().count()
    counts = stream.running_counts(stream.assign_stream(stream.read_shards(spark, shards), samples))
    query = counts.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("counts").first()["reads"] == 30


def test_fastq_export(spark, tmp_path):
    raw = spark.createDataFrame([("r1", "ACGT", "????"), ("r2", "GGGG", "????")], files.READ_SCHEMA)
    files.export_fastq(raw, spark.createDataFrame([("r1", "T~S~G~1")], "readID string, uniqueSample string"), str(tmp_path / "fq"))
    assert [r.value for r in spark.read.text(str(tmp_path / "fq")).select("value").collect()] == ["@r1", "ACGT", "+", "????"]


def test_fastq_splits_at_records(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(f"r{i}", "".join(rnd.choice("ACGT") for _ in range(rnd.randint(1, 40)))) for i in range(300)]
    text = "".join(f"@{i} x\n{s}\n+\n{'@' + 'I' * (len(s) - 1)}\n" for i, s in rows)
    path = tmp_path / "a.fastq"
    path.write_text(text)
    for size in (64 << 20, 1000, 97):
        files.SPLIT = size
        reader = files.FastqReader([str(path)])
        got = [r for p in reader.partitions() for r in reader.read(p)]
        assert [r[:2] for r in got] == rows and all(r[2] == "@" + "I" * (len(r[1]) - 1) for r in got)
    files.SPLIT = 64 << 20
    uri = files.FastqReader([f"file://{path}"])
    assert sum(1 for p in uri.partitions() for _ in uri.read(p)) == 300


def test_quality_trim_and_triples(spark):
    reads = spark.createDataFrame([("r1", "A" * 60, "?" * 60), ("r2", "C" * 60, "?" * 20 + "+" * 40)], files.READ_SCHEMA)
    kept = demux.trim_quality(reads, "seq", "qual")
    assert [r.readID for r in kept.collect()] == ["r1"]
    assert demux.read_triples(reads, reads, kept).select(F.count("*")).first()[0] == 1
