"""The stages in a row, from raw reads with planted sites."""

import random

from pyspark.sql import functions as F

from loomsite.operators import sequences
from loomsite.operators.multihits import saved
from loomsite.plans import stages

RC = str.maketrans("ACGT", "TGCA")
LEADER = "TCTGCGCGCTCGCTCGCTCA"
TAIL = "CTCCGCTTAAGGGACT"


def dna(rnd, n):
    return "".join(rnd.choice("ACGT") for _ in range(n))


def planted(seed=11, sites=10):
    """Genome, sample sheet, raw reads and truth: sites of two samples of one vector end on
    both strands, fragments of several widths, duplicates, errors in barcodes, a fragment
    that ends inside the reads, junk, and one site in a stretch that two chromosomes share."""
    rnd = random.Random(seed)
    genome = {"chr1": dna(rnd, 9000), "chr2": dna(rnd, 9000)}
    shared = genome["chr1"][8000:8600]
    genome["chr2"] = genome["chr2"][:8000] + shared + genome["chr2"][8600:]
    codes = {f"T~S~G{i}~1": (dna(rnd, 12), dna(rnd, 20)) for i in (1, 2)}
    sheet = [(s, c, l + "N" * 12 + TAIL, "IN_u5") for s, (c, l) in codes.items()]
    raw, truth = [], []

    def read(sample, chrom, strand, at, width, umi, wrong=False):
        code, linker = codes[sample]
        left, right = (at, at + width) if strand == "+" else (at - width, at)
        piece = genome[chrom][left:right]
        piece = piece if strand == "+" else piece[::-1].translate(RC)
        anchor = (LEADER + piece + TAIL[::-1].translate(RC) + dna(rnd, 60))[:110]
        adrift = (linker + umi + TAIL + piece[::-1].translate(RC) + LEADER[::-1].translate(RC) + dna(rnd, 60))[:140]
        if wrong:
            code = code[:3] + ("A" if code[3] != "A" else "C") + code[4:]
        raw.append((f"r{len(raw)}", code, anchor, adrift))

    for sample in codes:
        for k in range(sites):
            chrom, strand, at = rnd.choice(["chr1", "chr2"]), "+-"[k % 2], 600 + 700 * k
            n = rnd.randint(3, 6)
            for i in range(n):
                umi = dna(rnd, 12)
                read(sample, chrom, strand, at, 110 + 9 * i, umi, wrong=i == 1)
                if i == 0:
                    read(sample, chrom, strand, at, 110, umi)
            # Its adrift mate runs into the leader and aligns too short: it counts for nothing.
            read(sample, chrom, strand, at, 70, dna(rnd, 12))
            position = at + 1 + 2 if strand == "+" else at - 2
            _, subject, name, _ = sample.split("~")
            truth.append(("T", subject, name, f"{chrom}{strand}{position}", n + 1, LEADER))
    for i in range(3):
        read("T~S~G1~1", "chr1", "+", 8100, 120 + 9 * i, dna(rnd, 12))
    truth.append(("T", "S", "G1", "chr1+8101", 3, LEADER))
    raw += [(f"j{i}", dna(rnd, 12), dna(rnd, 110), dna(rnd, 140)) for i in range(20)]
    return genome, sheet, raw, truth


def test_from_raw_reads_to_recovered_sites(spark):
    genome, sheet, raw, truth = planted()
    samples = spark.createDataFrame(sheet, "uniqueSample string, index1Seq string, adriftReadLinkerSeq string, flags string")
    reads = spark.createDataFrame(raw, "readID string, index1Seq string, anchorReadSeq string, adriftReadSeq string")
    o = stages.options("integrase")
    step = stages.demultiplex(reads, samples, o)
    assert step["missing"].isEmpty()
    kept = saved(step["reads"])
    assert kept.where("readID like 'j%'").isEmpty() and kept.agg(F.sum("nDuplicateReads")).first()[0] == step["dupReads"].count()
    prepared = stages.prep_reads(kept, None, None, o, profiles=[("u5", LEADER)])["reads"]
    assert prepared.where(f"leaderSeq <> '{LEADER}'").isEmpty() and prepared.count() == kept.count()
    # The fragment of 70 bases ends inside the anchor read: what follows it is cut off.
    assert prepared.agg(F.min(F.length("anchorReadSeq"))).first()[0] == 70
    reference = spark.createDataFrame(list(genome.items()), "tName string, tSeq string")
    mates = stages.align_reads(prepared, reference, o)
    fragments = saved(stages.build_fragments(mates["anchor"], mates["adrift"], prepared, o))
    std = stages.build_std_fragments(fragments, o)
    sites = stages.build_sites(std["reads"], o)["sites"]
    expected = spark.createDataFrame(truth, "trial string, subject string, sample string, posid string, nReads int, leaderSeq string")
    found = stages.evaluate_recovery(sites, expected, multi_hits=std["multiHits"])
    rows = {(r["sample"], r.posid): r for r in found["sites"].collect()}
    missed = [k for k, r in rows.items() if not r.found]
    summary = found["summary"].first()
    assert summary.percentTotalRecovery >= 95 and not missed
    assert rows["G1", "chr1+8101"].multiHit and summary.percentUniqueRecovery < 100
    assert sites.count() == len(truth) - 1
    assert [(k, r.posDiff, r.readDiff) for k, r in rows.items() if not r.multiHit and (r.posDiff or r.readDiff)] == []
    (cluster,) = std["multiHits"].collect()
    assert sorted(cluster.posids) == ["chr1+8101", "chr2+8101"] and cluster.reads == 3


def test_priming_artifacts_of_both_kinds(spark):
    """A leader that ends like the genome, and a vector that holds the bases after a site."""
    rnd = random.Random(5)
    genome = dna(rnd, 400)
    reference = spark.createDataFrame([("chr1", i, genome[50 * i : 50 * i + 50]) for i in range(8)], "chromosome string, chunk int, seq string")
    after = genome[199:219]
    hot = 2 * sum(c in "AT" for c in after) + 4 * sum(c in "CG" for c in after)
    vectors = spark.createDataFrame([("v", "N" * 30 + after + "N" * 30)], "tName string, tSeq string")
    sites = spark.createDataFrame([("chr1+100.1", "GG" + genome[79:99]), ("chr1+200.1", "C" * 22), ("chr1-300.1", "GG" + genome[300:320][::-1].translate(RC))], "posid string, repLeaderSeq string")
    got = {r.posid: (r.PCRartifact1, r.PCRartifact2) for r in stages.predict_pcr_artifacts(sites, reference, vectors, chunk=50).collect()}
    assert hot >= 50 and got == {"chr1+100.1": ("20nt | 10", None), "chr1+200.1": (None, "20nt | 10"), "chr1-300.1": ("20nt | 10", None)}


def test_structures_with_models(spark):
    """Only reads that begin and end as expected are modelled; one has a turned stretch."""
    rnd = random.Random(8)
    vector = dna(rnd, 600)
    straight, turned = vector[:160], vector[:90] + vector[300:370][::-1].translate(RC)
    rows = []
    for i in range(6):
        whole = straight if i < 4 else turned
        rows.append((f"r{i}", "U", whole[:100], whole[60:][::-1].translate(RC)))
    bad = dna(rnd, 160)
    rows.append(("bad", "U", bad[:100], bad[60:][::-1].translate(RC)))
    reads = spark.createDataFrame(rows, "readID string, uniqueSample string, anchorReadSeq string, adriftReadSeq string")
    vectors = spark.createDataFrame([("v", vector)], "tName string, tSeq string")
    expected = spark.createDataFrame([(vector,)], "expected string")
    out = stages.anchor_read_rearrangements(reads, expected, (150,), (0, 4), (1,), prefixes=[vector[:12]], vectors=vectors)
    models = {r.model: r.n for r in out["structures"].collect()}
    assert {m.split(";")[0].startswith("1..") for m in models} == {True} and sorted(models.values()) == [2, 4]
    assert any("-" in m for m in models) and "1..150[1+150]" in models
    stats = {(r.level, r.reads, r.expectedReads, r.altStructures) for r in out["stats"].collect() if r.level == 0}
    assert stats == {(0, 6, 4, 1)}
    assert sequences.rearrangement_inputs(spark.createDataFrame([("a", "ACGT")], "readID string, seq string"), ["ACGT"], vectors).count() == 0
