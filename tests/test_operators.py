"""Operators on small literal tables, with ties, nulls and both strands."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from loomsite.functions import dna
from loomsite.operators import alignments, clusters, demux, fragments, intervals, multihits, reports, sequences, standardize, tags
from loomsite.plans import stages
from tests.loops import align_marks, best_segment, inside, join_pair, levenshtein, osa, trim_at

FRAGMENT = "readID string, trial string, subject string, sample string, replicate int, chromosome string, strand string, fragStart int, fragEnd int, nDuplicateReads int, flags string, randomLinkerSeq string, leaderSeq string"


def frag(spark, rows):
    return spark.createDataFrame([(r[0], "T", "S", r[1], r[2], "chr1", r[3], r[4], r[5], r[6] if len(r) > 6 else 0, r[7] if len(r) > 7 else "IN_u5", r[8] if len(r) > 8 else "AAAA", r[9] if len(r) > 9 else "TTTT") for r in rows], FRAGMENT)


def one(spark, *columns, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return tuple(df.select(*columns).first())


def test_sequences_as_columns(spark):
    assert one(spark, dna.reverse_complement("s"), dna.mask_repeats("s"), s="ACGTNac") == ("gtNACGT", "ACGTNNN")
    assert one(spark, dna.mismatches("a", "b"), a="ACGT", b="ANGA") == (1,)
    assert one(spark, dna.match_count("s", F.lit("ACG"), 1), dna.match_count("s", F.lit("ACG"), 0), s="ACGTACT") == (2, 1)
    assert one(spark, *dna.linker_ranges("l"), l="ACGTNNNNTTT") == (4, 5, 8)
    assert one(spark, *dna.linker_ranges("l"), l="ACGT") == (0, None, None)
    assert one(spark, dna.quality_cut("q"), q="?" * 20 + "+" * 5) == (18,)
    assert one(spark, dna.quality_cut("q"), q="????") == (4,)
    assert one(spark, dna.wallace_temperature("s"), s="AACCGT") == (18,)
    assert one(spark, dna.match_report("m", 4), m="**--*-**") == ("5nt | 3",)
    p = dna.parse_posid("p")
    assert one(spark, *p.values(), p="chr1.2_alt-123.4") == ("chr1.2_alt", "-", 123, 4)
    assert one(spark, *p.values(), p="chrX+9") == ("chrX", "+", 9, None)
    assert one(spark, dna.without_replicate("u"), dna.base_name("f"), u="a~b~c~12", f="/x/y.fa") == ("a~b~c", "y.fa")


def test_edit_functions():
    assert osa("ACGT", "AGCT") == 1 and osa("ACGT", "ACG") == 1 and osa("", "AC") == 2
    assert trim_at("ACGTACGTTTGGCCAA", "TTGGCCAA", 0.15) == 8
    assert trim_at("ACGTACGTTTGGCA", "TTGGCCAATTGG", 0.15) == 8 or trim_at("ACGTACGTTTGGC", "TTGGCCAATTGG", 0.15) == 8
    assert trim_at("ACGTACGT", "TTTTTTTTTT", 0.1) == 8
    assert join_pair("AAACCCGGG", "CCCGGGTTT", 5, 0.0) == "AAACCCGGGTTT" and join_pair("AAAA", "TTTT", 3, 0.1) is None
    assert align_marks("ACGT", "ACGT") == "****" and align_marks("ACGT", "AGT").count("*") == 3


def test_overlaps_and_merge_against_loops(spark):
    rnd = random.Random(1)
    a = [("c%d" % rnd.randint(1, 2), s, s + rnd.randint(0, 60)) for s in (rnd.randint(1, 500) for _ in range(60))]
    b = [("c%d" % rnd.randint(1, 2), s, s + rnd.randint(0, 60)) for s in (rnd.randint(1, 500) for _ in range(60))]
    left = spark.createDataFrame([(i, *x) for i, x in enumerate(a)], "i int, c string, s int, e int")
    right = spark.createDataFrame([(i, *x) for i, x in enumerate(b)], "j int, d string, f int, g int")
    for gap, size in itertools.product((0, 7), (16, 1 << 14)):
        got = sorted((r.i, r.j) for r in intervals.overlaps(left, right, {"c": "d"}, ("s", "e"), ("f", "g"), gap, size).collect())
        assert got == sorted((i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[0] == y[0] and x[1] - gap <= y[2] and y[1] <= x[2] + gap)
    got = sorted((r.c, r.start, r.end) for r in intervals.merge(left, ["c"], "s", "e", 1).collect())
    want = []
    for c, s, e in sorted(a):
        if want and want[-1][0] == c and s <= want[-1][2]:
            want[-1][2] = max(want[-1][2], e)
        else:
            want.append([c, s, e])
    assert got == [tuple(x) for x in want]


def test_nearest_keeps_ties(spark):
    points = spark.createDataFrame([("c", 10), ("c", 100), ("c", 16), ("d", 5), ("e", 1)], "chromosome string, position int")
    features = spark.createDataFrame([("c", 20, 30, "a"), ("c", 1, 5, "b"), ("c", 12, 12, "x"), ("d", 5, 9, "y"), ("d", 1, 6, "z")], "fc string, fs int, fe int, name string")
    got = sorted((r.chromosome, r.position, r.name, r.distance) for r in intervals.nearest(points, features, ("chromosome", "position"), ("fc", "fs", "fe")).collect())
    assert got == [("c", 10, "x", 1), ("c", 16, "a", 3), ("c", 16, "x", 3), ("c", 100, "a", 69), ("d", 5, "y", 0), ("d", 5, "z", 0)]


def test_sites_and_bundles(spark):
    f = frag(spark, [("r1", "G", 1, "+", 10, 50, 2), ("r2", "G", 1, "+", 10, 60), ("r3", "G", 2, "-", 5, 90), ("r4", "G", 2, "-", 6, 90, 1, "IN_u3", "CCCC", "GGGG")])
    got = {r.posid: (r.rUMIs, r.sonicLengths, r.reads, r.nRepsObs, r.percentSampleRelAbund) for r in fragments.summarize_sites(f).collect()}
    assert got == {"chr1+10": (1, 2, 4, 1, 50.0), "chr1-90": (2, 2, 3, 1, 50.0)}
    bundle = {(r.fragStart, r.fragEnd): (r.reads, r.readIDs, r.repLeaderSeq) for r in fragments.bundle(f).collect()}
    assert bundle[(10, 50)] == (3, ["r1"], "TTTT") and len(bundle) == 4
    wide = {r.posid: r for r in fragments.replicate_pivot(f, [1, 2]).collect()}
    assert wide["chr1+10"]["rep1-reads"] == 4 and wide["chr1+10"]["rep2-reads"] is None


def test_multihits(spark):
    rows = [("r1", "G", 1, "+", 10, 50), ("r1", "G", 1, "+", 200, 250), ("r2", "G", 1, "+", 200, 260), ("r2", "G", 1, "+", 400, 450), ("r3", "G", 1, "+", 900, 950), ("r3", "G", 1, "+", 950, 990), ("r4", "G", 1, "+", 10, 70)]
    f = frag(spark, rows)
    found = {r.clusterID: (r.nodes, r.reads, r.posids) for r in multihits.multihit_clusters(f).collect()}
    assert found == {"MHC.1": (3, 2, ["chr1+10", "chr1+200", "chr1+400"]), "MHC.2": (2, 1, ["chr1+900", "chr1+950"])}
    saved = fragments.salvage_multihits(f.where("readID <> 'r4'"), f.where("readID = 'r4'")).collect()
    assert [(r.readID, r.fragStart) for r in saved] == [("r1", 10)]
    sizes = {r.clusterID: r.clusterSonicLengths for r in multihits.cluster_abundance(multihits.multihit_clusters(f), f).collect()}
    assert sizes == {"MHC.1": 4, "MHC.2": 2}


def test_multihit_query_clusters_every_subject(spark, tmp_path):
    from loomsite import catalog
    from loomsite.fixtures import view

    rnd = random.Random(7)
    rows = [(o, n, o % 4, rnd.randrange(60)) for o in range(40) for n in range(3) for _ in range(rnd.choice([1, 2, 3]))]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    reads = {}
    for r in view(spark, str(tmp_path), "fx_fragments").collect():
        at = f"{r.chromosome}{r.strand}{r.fragStart if r.strand == '+' else r.fragEnd}"
        reads.setdefault((r.trial, r.subject, r.sample), {}).setdefault((r.replicate, r.readID), set()).add(at)
    want = set()
    for sample, own in reads.items():
        groups = []
        for sites in (s for s in own.values() if len(s) > 1):
            touched = [g for g in groups if g & sites]
            groups = [g for g in groups if not g & sites] + [sites.union(*touched)]
        for i, g in enumerate(sorted(groups, key=min), 1):
            want.add((*sample, len(g), sum(len(s) > 1 and s <= g for s in own.values()), f"MHC.{i}", ",".join(sorted(g))))
    got = {(r.trial, r.subject, r.sample, r.nodes, r.reads, r.clusterID, r.posids) for r in catalog.queries()["multihit_components"](spark, str(tmp_path)).collect()}
    assert got == want and {x[1] for x in got} == {"S0", "S1"}


def test_components_of_a_long_path(spark):
    n = spark.createDataFrame([(1, i) for i in range(60)], "g int, node long")
    e = spark.createDataFrame([(1, i, i + 1) for i in range(59) if i != 29], "g int, a long, b long")
    got = {r.node: r.component for r in multihits.components(n, e, ["g"]).collect()}
    assert got == {i: 0 if i < 30 else 30 for i in range(60)}


def test_tags(spark):
    reads = [("AAAA", "s1", 4), ("AAAT", "s1", 1), ("AATA", "s2", 1), ("CCCC", "s1", 3), ("CCCG", "s1", 3), ("CCGC", "s1", 1), ("CCCT", "s1", 1), ("GTGT", "s1", 5), ("TGGT", "s1", 1), ("ACGT", "s1", 1)]
    rows = [(f"{t}{i}", t, s) for t, s, n in reads for i in range(n)]
    df = spark.createDataFrame(rows, "readID string, adriftReadRandomID string, uniqueSample string")
    got = {r.readID: r.adriftReadRandomID for r in tags.correct_tags(df).collect()}
    assert got["AAAT0"] == "AAAA" and got["AATA0"] == "AAAA" and got["TGGT0"] == "GTGT" and got["ACGT0"] == "ACGT"
    assert "CCCT0" not in got and "CCGC0" not in got
    m = {r.readID: r.uniqueSample for r in tags.majority_sample(spark.createDataFrame([("a", "T", "x"), ("b", "T", "x"), ("c", "T", "y"), ("d", "U", "x"), ("e", "U", "y")], "readID string, adriftReadRandomID string, uniqueSample string")).collect()}
    assert m == {"a": "x", "b": "x", "c": "x"}


def test_golay(spark):
    table = tags.golay_errors()
    assert len(table) == 2325
    checks, parity = tags.golay_checks(), tags.golay_parity()
    assert parity[1] == "111011100010" and parity[2] == "110111000101" and parity[11] == "101101110001"

    def encode(message):
        rows = [int(parity[j], 2) for j in range(12) if message >> (11 - j) & 1]
        word = 0
        for row in rows:
            word ^= row
        return word << 12 | message

    words = [encode(m) for m in range(4096)]
    assert not any((w & row).bit_count() % 2 for w in words for row in checks)
    assert min(w.bit_count() for w in words[1:]) == 8
    back = {v: k for k, v in tags.BASE_BITS.items()}

    def code(w):
        b = f"{w:024b}"
        return "".join(back[b[i : i + 2]] for i in range(0, 24, 2))

    rnd = random.Random(3)
    rows = [(code(w), code(w), 0) for w in words]
    for n in (1, 2, 3):
        rows += [(code(w ^ sum(1 << b for b in rnd.sample(range(24), n))), code(w), n) for w in rnd.sample(words, 200)]
    far = code(words[7] ^ 0b1111)
    df = spark.createDataFrame([*rows, ("ACGT", "ACGT", -1), (far, far, -1), ("N" * 12, "A" * 12, 0)], "index1Seq string, want string, n int")
    for r in tags.correct_barcodes(df).collect():
        assert (r.corrected == r.want and (r.bitErrors if r.n >= 0 else -1) == r.n) or (r.index1Seq == far and r.bitErrors in (None, 3))


def test_sites_of_both_ends_keep_their_widths(spark):
    """Five fragments of widths 101 to 141 at one u3 and at one u5 site, and a dual detection."""
    rows = []
    for i, w in enumerate(range(100, 141, 10)):
        rows.append((f"a{i}", "T", "S", "G", 1, "chr1", "+", 1000, 1000 + w, 0, "IN_u3", f"U{i}", "AAAA"))
        rows.append((f"b{i}", "T", "S", "G", 1, "chr2", "-", 5000 - w, 5000, 0, "IN_u5", f"V{i}", "CCCC"))
    rows += [("c0", "T", "S", "G", 2, "chr3", "+", 200, 300, 1, "IN_u3", "X", "GGGG"), ("d0", "T", "S", "G", 1, "chr3", "-", 100, 203, 0, "IN_u5", "Y", "TTTT"), ("d1", "T", "S", "G", 1, "chr3", "-", 90, 203, 0, "IN_u5", "Z", "TTTT")]
    f = spark.createDataFrame(rows, "readID string, trial string, subject string, sample string, replicate int, chromosome string, strand string, fragStart int, fragEnd int, nDuplicateReads int, flags string, randomLinkerSeq string, leaderSeq string")
    got = {r.posid: r for r in stages.build_sites(f)["sites"].collect()}
    assert set(got) == {"chr1-1002.1", "chr2-4998.1", "chr3-201.0"}
    assert got["chr1-1002.1"].sonicLengths == got["chr2-4998.1"].sonicLengths == 5
    dual = got["chr3-201.0"]
    assert (dual.sonicLengths, dual.reads, dual.flags, dual.repLeaderSeq, dual.nRepsObs) == (3, 4, "dual detect", "GGGG/TTTT", 2)
    assert dual["rep2-reads"] == 2 and dual["rep1-reads"] == 2 and dual.repLeaderSeqClusters == 2


def test_repeats_of_multihits_stay_with_their_sample(spark):
    clusters = spark.createDataFrame([("T", "S", "G1", "MHC.1", ["chr1+10", "chr1+900"]), ("T", "S", "G2", "MHC.1", ["chr1+500"])], "trial string, subject string, sample string, clusterID string, posids array<string>")
    repeats = spark.createDataFrame([("chr1", 5, 20, "+", "L1", "LINE")], "query_seq string, query_start int, query_end int, strand string, repeat_name string, repeat_class string")
    sites = spark.createDataFrame([("chr1+10",)], "posid string")
    got = {r["sample"]: (r.topRepeatClass, r.topRepeatPercent) for r in stages.annotate_repeats(sites, repeats, clusters)["multiHits"].collect()}
    assert got == {"G1": ("LINE", 50.0), "G2": (None, None)}


def test_the_best_profile_hit_decides(spark):
    hits = spark.createDataFrame([("a", 9, 30, 50.0, 20, 20), ("a", 1, 30, 30.0, 20, 20), ("b", 1, 30, 30.0, 20, 20)], "targetName string, targetStart int, targetEnd int, fullScore double, hmmEnd int, hmmLength int")
    assert [r.targetName for r in alignments.accept_models(hits).collect()] == ["b"]


def test_demultiplexing(spark):
    samples = spark.createDataFrame([("T~S~G1~1", "AAAAAAAAAAAA", "ACGTACGTACNNNNCCTT"), ("T~S~G2~1", "CCCCCCCCCCCC", "TTGGTTGGTTNNNNCCTT")], "uniqueSample string, index1Seq string, adriftReadLinkerSeq string")
    raw = spark.createDataFrame([("r1", "AAAAAAAAAAAA", "GATTACA", "ACGTACGTACGGGGCCTTAAA"), ("r2", "AAAAAAAAAAAT", "GATTACA", "ACGTACGTAGGGGGCCTTAAA"), ("r3", "AAAAAAAAAATT", "GATTACA", "ACGTACGTACGGGGCCTTAAA"), ("r4", "CCCCCCCCCCCC", "GATTACA", "ACGTACGTACGGGGCCTTAAA")], "readID string, index1Seq string, anchorReadSeq string, adriftReadSeq string")
    for k in (1, 2):
        got = sorted((r.readID, r.uniqueSample) for r in demux.assign(raw, samples, index_mismatches=k).collect())
        assert got == [("r1", "T~S~G1~1"), ("r2", "T~S~G1~1")] + ([("r3", "T~S~G1~1")] if k == 2 else [])
    kept, lost = demux.collapse_duplicates(raw)
    assert {r.readID: r.nDuplicateReads for r in kept.collect()} == {"r1": 2, "r2": 0} and lost.count() == 2
    tagged = demux.with_tags(demux.assign(raw, samples), samples).where("readID = 'r1'").first()
    assert (tagged.adriftReadRandomID, tagged.adriftReadSeq[10:14], tagged.adriftLinkerSeqEnd) == ("GGGG", "AAAA", 18)


def slow_standard(positions, weights, gap, merge, down):
    """The rules restated on explicit sets of nodes and edges."""
    n = len(positions)
    edges = set()
    for i in range(n - 1):
        if positions[i + 1] - positions[i] == 1:
            forward = weights[i] > weights[i + 1] or (weights[i] == weights[i + 1] and not down)
            edges.add((i, i + 1) if forward else (i + 1, i))

    def clusters():
        group = list(range(n))
        for _ in range(n):
            for a, b in edges:
                group[a] = group[b] = min(group[a], group[b])
        out = {}
        for i in range(n):
            out.setdefault(group[i], []).append(i)
        return [out[k] for k in sorted(out)]

    for width in range(2, gap + 1):
        new = []
        for a, b in itertools.pairwise(clusters()):
            if positions[b[0]] - positions[a[-1]] <= width:
                sa, sb = sum(weights[i] for i in a), sum(weights[i] for i in b)
                ma, mb = min(weights[i] for i in a), min(weights[i] for i in b)
                if sa > sb and ma >= mb:
                    new.append((a[-1], b[0]))
                if sb > sa and mb >= ma:
                    new.append((b[0], a[-1]))
        edges |= set(new)
    for s in range(n):
        into = sorted(a for a, b in edges if b == s)
        if len(into) == 2:
            lo, hi = into
            dl, dh = positions[s] - positions[lo], positions[hi] - positions[s]
            if dl != dh:
                cut = lo if dl > dh else hi
            elif weights[lo] != weights[hi]:
                cut = lo if weights[lo] < weights[hi] else hi
            else:
                cut = hi if down else lo
            edges.discard((cut, s))
    heads = [i for i in range(n) if not any(b == i for _, b in edges)]
    if merge:
        for a, b in itertools.combinations(heads, 2):
            if positions[b] - positions[a] <= gap:
                edges.add((a, b))
    out = [0] * n
    for c in clusters():
        own = [i for i in c if i in heads]
        best = max(own, key=lambda i: (weights[i], i if down else -i))
        for i in c:
            out[i] = best
    return out


@pytest.mark.parametrize("merge,down", [(True, False), (False, True), (False, False)])
def test_standardization_against_the_slow_restatement(merge, down):
    rnd = random.Random(7)
    for _ in range(3000):
        n = rnd.randint(1, 9)
        positions = sorted(rnd.sample(range(1, 22), n))
        weights = [rnd.randint(1, 4) for _ in range(n)]
        gap = rnd.choice([3, 5])
        assert standardize.standardize_line(positions, weights, gap, merge, down) == slow_standard(positions, weights, gap, merge, down), (positions, weights, gap)


def test_standardized_fragments(spark):
    rows = [(f"a{i}", "G", 1, "+", 100, 200 + i) for i in range(4)] + [("b", "G", 1, "+", 103, 220), ("c", "G", 1, "-", 300, 400), ("d", "G", 1, "-", 300, 401), ("e", "G", 1, "-", 310, 401), ("f", "G", 1, "+", 120, 230)]
    got = {r.readID: (r.fragStart, r.fragEnd) for r in standardize.standardize_integrations(frag(spark, rows)).collect()}
    assert got["b"] == (100, 220) and got["c"] == (300, 401) and got["f"] == (120, 230) and len(got) == len(rows)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    again = {r.readID: (r.fragStart, r.fragEnd) for r in standardize.standardize_integrations(frag(spark, rows[::-1])).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == again


def test_greedy_clusters_against_a_loop(spark):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("ACGT") for _ in range(30)) for _ in range(4)]
    seqs = []
    for _ in range(60):
        s = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 1, 2, 3])):
            s[rnd.randrange(len(s))] = rnd.choice("ACGT")
        seqs.append("".join(s)[: rnd.choice([28, 30])])
    df = spark.createDataFrame([("g", s) for s in seqs], "g string, seq string")

    reps, want = [], {}
    for s in sorted(set(seqs), key=lambda s: (-len(s), -seqs.count(s), s)):
        hit = next((r for r in reps if levenshtein(r, s) <= int(min(len(r), len(s)) * 0.1 + 1e-9)), None)
        want[s] = hit or s
        reps += [] if hit else [s]
    assert {r.seq: r.rep for r in clusters.cluster(df, ["g"], "seq", identity=0.9).collect()} == want


def mutated(rnd, s, n):
    s = list(s)
    for _ in range(n):
        i, way = rnd.randrange(len(s) or 1), rnd.random()
        if way < 0.4 and s:
            s[i] = rnd.choice("ACGT")
        elif way < 0.7 and len(s) > 1:
            del s[i]
        else:
            s.insert(i, rnd.choice("ACGT"))
    return "".join(s)


@pytest.mark.parametrize("steps", [(64, 2048), (2, 5)])
def test_clusters_of_groups_and_given_order(spark, steps, monkeypatch):
    """Several groups, an order by two figures, empty and repeated sequences, nulls, a shared
    start; a few first sequences at a time or all at once."""
    monkeypatch.setattr(clusters, "STEPS", steps)
    rnd = random.Random(8)
    rows = [("x", None, 1, 1), ("x", "", 1, 1)]
    for g in "xyz":
        base = ["GGGTTTCCCAAA" + "".join(rnd.choice("ACGT") for _ in range(rnd.choice([12, 20]))) for _ in range(5)]
        rows += [(g, mutated(rnd, rnd.choice(base), rnd.choice([0, 1, 2, 4])), rnd.randint(1, 3), rnd.randint(1, 3)) for _ in range(60)]
    df = spark.createDataFrame(rows, "g string, seq string, a int, r int")
    got = {(r.g, r.seq): r.rep for r in clusters.cluster(df, ["g"], "seq", 0.87, [F.max("a"), F.sum("r")]).collect()}
    want = {}
    for g in "xyz":
        own = {s: (max(a for h, t, a, _ in rows if (h, t) == (g, s)), sum(r for h, t, _, r in rows if (h, t) == (g, s))) for h, s, _, _ in rows if h == g and s is not None}
        reps = []
        for s in sorted(own, key=lambda s: (-len(s), -own[s][0], -own[s][1], s)):
            hit = next((r for r in reps if levenshtein(r, s) <= int(len(s) * 0.13 + 1e-9) and s), None)
            want[g, s] = hit or s
            reps += [] if hit else [s]
    assert got == want


@pytest.mark.parametrize("cover", [0.0, 0.6])
def test_clusters_inside_longer_sequences(spark, cover):
    rnd = random.Random(12)
    base = ["".join(rnd.choice("ACGT") for _ in range(300)) for _ in range(4)]
    seqs = set()
    for _ in range(70):
        b, n = rnd.choice(base), rnd.randint(50, 300)
        at = rnd.randint(0, 300 - n)
        seqs.add(mutated(rnd, b[at : at + n], int(n * rnd.choice([0, 0.05, 0.11]))))
    reps, want = [], {}
    for s in sorted(seqs, key=lambda s: (-len(s), s)):
        def like(r):
            edits, width = inside(r, s)
            return edits <= int(len(s) * 0.1 + 1e-9) and width >= cover * len(r) - 1e-9
        hit = next((r for r in reps if like(r)), None)
        want[s] = hit or s
        reps += [] if hit else [s]
    df = spark.createDataFrame([("g", s) for s in seqs], "g string, seq string")
    assert {r.seq: r.rep for r in clusters.cluster(df, ["g"], "seq", 0.9, inside=cover).collect()} == want
    assert len(set(want.values())) < len(want)


def test_batches_equal_loops():
    from loomsite.functions import batch

    rnd = random.Random(5)

    def some(lo, hi):
        return "".join(rnd.choice("ACGT") for _ in range(rnd.randint(lo, hi)))

    pairs = [(x := some(0, 30), mutated(rnd, x, rnd.randint(0, 5))) for _ in range(400)]
    a, b = [list(t) for t in zip(*pairs)]
    assert batch.osa(a, b) == [osa(*p) for p in pairs]
    assert batch.marks(a, b) == [align_marks(*p) for p in pairs]
    adapters = [some(5, 20) for _ in range(400)]
    reads = [some(10, 60) + (mutated(rnd, ad, rnd.randint(0, 2)) + some(0, 9) if rnd.random() < 0.6 else ad[: rnd.randint(0, len(ad))]) for ad in adapters]
    assert batch.trim_at(reads, adapters, 0.15) == [trim_at(x, y, 0.15) for x, y in zip(reads, adapters)]
    mates = [mutated(rnd, x[len(x) - rnd.randint(0, 20) :], rnd.randint(0, 1)) + some(5, 40) for x in reads]
    assert batch.joined(reads, mates, 5, 0.1) == [join_pair(x, y, 5, 0.1) for x, y in zip(reads, mates)]
    offsets = [rnd.randint(-5, 5) for _ in reads]
    targets = [some(max(0, o), max(0, o)) + mutated(rnd, x[max(0, -o) :], 1) + some(0, 8) for x, o in zip(reads, offsets)]
    assert [x[:3] for x in batch.segments(reads, targets, offsets, gap=10**9)] == [best_segment(*q) for q in zip(reads, targets, offsets)]
    laid = [(x, mutated(rnd, x[3:-3], 2)) for x in reads]
    assert [(c, e - s) for c, s, e in batch.edits_inside(*[list(t) for t in zip(*laid)])] == [inside(*p) for p in laid]


def test_alignment_over_one_insert(spark):
    """Reads with a base more or less than the genome, on both strands."""
    rnd = random.Random(21)
    genome = "".join(rnd.choice("ACGT") for _ in range(3000))
    rc = str.maketrans("ACGT", "TGCA")
    rows, want = [], {}
    for i, strand in enumerate("+-" * 6):
        at = 100 + 200 * i
        cut = rnd.randint(16, 44)
        piece = genome[at : at + 60]
        more = i % 4 < 2
        read = piece[:cut] + rnd.choice([c for c in "ACGT" if c not in piece[cut - 1 : cut + 1]]) + piece[cut:] if more else piece[:cut] + piece[cut + 1 :]
        rows.append((read if strand == "+" else read[::-1].translate(rc),))
        want[rows[-1][0]] = (strand, at, at + 60, int(more), int(not more), 0)
    q = spark.createDataFrame(rows, "seq string")
    t = spark.createDataFrame([("chr1", genome)], "tName string, tSeq string")
    found = sequences.align(q, t, min_length=50, chunk=128).collect()
    assert {r.seq: (r.strand, r.tStart, r.tEnd, r.qNumInsert, r.tNumInsert, r.misMatches) for r in found} == want and len(found) == len(want)
    assert all(r.matches == r.qEnd - r.qStart - r.qBaseInsert for r in found)


def test_leaders_by_consensus(spark):
    profiles = [("u5", "TCTAGCANNGTCA"), ("u3", "GGTCTTTCA")]
    rows = [("a", "TCTAGCATTGTCAGGGG"), ("b", "ATCTAGCAGGGTCACCC"), ("c", "GGTCTTTCATTTT"), ("d", "ACACACACACAC"), ("e", None), ("f", "GGTCTTAAAAAAA"), ("g", "TCTAG")]
    got = {r.readID: (r.name, r.qStart, r.qEnd, r.score) for r in sequences.capture_by_consensus(spark.createDataFrame(rows, "readID string, anchorReadSeq string"), profiles).collect()}
    assert got == {"a": ("u5", 0, 13, 22.0), "b": ("u5", 1, 14, 22.0), "c": ("u3", 0, 9, 18.0), "f": ("u3", 0, 6, 12.0), "g": ("u5", 0, 5, 10.0)}


def test_alignment_finds_planted_reads(spark):
    rnd = random.Random(9)
    genome = "".join(rnd.choice("ACGT") for _ in range(2000))
    plus, minus = genome[300:360], genome[700:760][::-1].translate(str.maketrans("ACGT", "TGCA"))
    changed = plus[:30] + ("A" if plus[30] != "A" else "C") + plus[31:]
    q = spark.createDataFrame([(plus,), (minus,), (changed,), ("ACGT" * 15,)], "seq string")
    t = spark.createDataFrame([("chr1", genome)], "tName string, tSeq string")
    got = {r.seq: (r.strand, r.tStart, r.tEnd, r.qStart, r.qEnd, r.misMatches) for r in sequences.align(q, t, min_length=50).collect()}
    assert got[plus] == ("+", 300, 360, 0, 60, 0) and got[minus] == ("-", 700, 760, 0, 60, 0) and got[changed] == ("+", 300, 360, 0, 60, 1) and len(got) == 3


def test_rearrangement_models(spark):
    hits = spark.createDataFrame([("q", "v", 1, 50, 11, 60, 1e-9, 90.0, 120), ("q", "v", 2, 30, 500, 528, 1e-3, 40.0, 120), ("q", "v", 70, 110, 240, 200, 1e-8, 80.0, 120)], "qname string, sseqid string, qstart int, qend int, sstart int, send int, evalue double, bitscore double, qlen int")
    model = sequences.rearrangements(hits).first().model
    assert model == "1..50[11+60];51..69[x];70..110[200-240];111..120[x]"
    rows = reports.segments(spark.createDataFrame([(model,)], "model string")).orderBy("segment").collect()
    assert [(r.qStart, r.qEnd, r.sStart, r.strand, r.sEnd) for r in rows] == [(1, 50, 11, "+", 60), (70, 110, 200, "-", 240)]
    assert {r.qname: r.qEnd for r in sequences.leader_ends(hits.drop("sseqid")).collect()} == {"q": 50}


def test_flanks(spark):
    genome = "".join(random.Random(4).choice("ACGT") for _ in range(95))
    ref = spark.createDataFrame([("c", i, genome[i * 20 : i * 20 + 20]) for i in range(5)], "chromosome string, chunk int, seq string")
    sites = spark.createDataFrame([("c", "+", 41), ("c", "-", 41), ("c", "+", 3)], "chromosome string, strand string, position int")
    rc = str.maketrans("ACGT", "TGCA")
    got = {(r.strand, r.position): r.flank for r in sequences.flank(sites, ref, 10, True, chunk=20).collect()}
    assert got[("+", 41)] == genome[30:40] and got[("-", 41)] == genome[41:51][::-1].translate(rc)
    after = {(r.strand, r.position): r.flank for r in sequences.flank(sites, ref, 10, False, chunk=20).collect()}
    assert after[("+", 41)] == genome[40:50] and after[("-", 41)] == genome[31:41][::-1].translate(rc)


def test_duals_are_exclusive(spark):
    rows = [("a", "G", 1, "+", 100, 200, 0, "IN_u3"), ("b", "G", 1, "-", 50, 103, 0, "IN_u5"), ("c", "G", 1, "-", 50, 105, 0, "IN_u5"), ("d", "G", 1, "-", 50, 300, 0, "IN_u5")]
    pairs = fragments.dual_candidates(frag(spark, rows))
    assert sorted(r.u5Position for r in pairs.collect()) == [103, 105]
    assert [(r.u3Position, r.u5Position) for r in fragments.exclusive_duals(pairs).collect()] == [(100, 103)]


def test_reports(spark):
    a = spark.createDataFrame([("s", "r1"), ("s", "r2"), ("t", "r3")], "uniqueSample string, readID string")
    wide = reports.attrition_wide(reports.attrition({"PRD1": a, "PRD2": a.where("readID <> 'r2'")}), ["PRD1", "PRD2"])
    assert {r.uniqueSample: (r.PRD1, r.PRD2) for r in wide.collect()} == {"s": (2, 1), "t": (1, 1)}
    assert {(r.uniqueSample, r.label): r.share for r in reports.attrition_shares(wide).collect()}[("s", "PRD2")] == 0.5
    capped = reports.cap_at_rank(spark.createDataFrame([("g", i) for i in range(1, 11)], "g string, v int"), ["g"], "v", 0.5)
    assert sorted(r.v for r in capped.collect()) == [1, 2, 3, 4, 5, 5, 5, 5, 5, 5]


def _placed_reads(rows):
    """(read, site start, width, anchor start) -> fragment rows of one leader."""
    return [(r, "T", "S", "G", 1, "chr1", "+", at, at + w - 1, 0, "IN_u5", f"U{r}", "TCTGCGCGCTCGCTCGCTCA", start, "ACGTTGCAAGGCTTAACCGGTTAACGTCGA") for r, at, w, start in rows]


STARTED = FRAGMENT + ", anchorStart string, adriftStart string"


def test_sites_of_one_leader_stay(spark):
    """Three sites of six reads each with the same leader: all stay; a read of the first one
    that is placed at the second one goes."""
    rnd = random.Random(2)
    starts = ["".join(rnd.choice("ACGT") for _ in range(30)) for _ in range(3)]
    rows = [(f"r{s}_{i}", 1000 + 500 * s, 100 + 7 * i, starts[s]) for s in range(3) for i in range(6)]
    rows.append(("stray", 1500, 90, starts[0][:-1] + ("A" if starts[0][-1] != "A" else "C")))
    f = spark.createDataFrame(_placed_reads(rows), STARTED)
    out = stages.build_std_fragments(f)
    kept = {r.readID for r in out["reads"].collect()}
    assert kept == {r[0] for r in rows} - {"stray"}
    assert out["stdFragments"].count() == 18
    chosen = {(r.posid, r.criteria, r.selected) for r in out["decisions"].collect()}
    assert chosen == {("chr1+1000", "frags", True), ("chr1+1500", "frags", False), ("chr1+1500", "single", True), ("chr1+2000", "single", True)}
    sites = {(r.posid, r.sonicLengths) for r in stages.build_sites(out["reads"])["sites"].collect()}
    assert sites == {("chr1+1002.1", 6), ("chr1+1502.1", 6), ("chr1+2002.1", 6)}
    bare = stages.build_std_fragments(f.drop("anchorStart", "adriftStart"))
    assert bare["reads"].count() == 19 and "decisions" not in bare


def test_multihit_abundance_by_clustered_starts(spark):
    """Two places shared by reads of three true starts; a start with one error counts once."""
    rnd = random.Random(4)
    starts = ["".join(rnd.choice("ACGT") for _ in range(30)) for _ in range(3)]
    wrong = starts[0][:10] + ("A" if starts[0][10] != "A" else "C") + starts[0][11:]
    rows = []
    for i, start in enumerate([starts[0], starts[0], wrong, starts[1], starts[2]]):
        for at in (1000, 9000):
            if i == 4 and at == 9000:
                at = 20000
            rows.append((f"r{i}", "T", "S", "G", 1, "chr1", "+", at, at + 100 + i, 0, "IN_u5", f"U{i}", "TTT", None, start))
    f = spark.createDataFrame(rows, STARTED)
    clusters_ = multihits.multihit_clusters(f)
    (r,) = multihits.cluster_abundance(clusters_, f, "adriftStart").collect()
    assert r.clusterSonicLengths == 3 and {(x.posid, x.sonicLengths) for x in r.nodeSonicLengths} == {("chr1+1000", 3), ("chr1+9000", 2), ("chr1+20000", 1)}
    (r,) = multihits.cluster_abundance(clusters_, f).collect()
    assert r.clusterSonicLengths == 9 or r.clusterSonicLengths > 3


@pytest.mark.parametrize("width", [4, 1 << 14])
def test_running_aggregates_against_loops(spark, width, monkeypatch):
    """Bins and runs of a few positions, ties, nulls, negative positions, both directions."""
    from loomsite.operators import scans

    monkeypatch.setattr(scans, "RUN", 3)
    rnd = random.Random(6)
    rows = [(rnd.choice("ab"), rnd.randint(-60, 300), rnd.choice([None, rnd.randint(0, 50)]), i) for i in range(150)]
    df = spark.createDataFrame(rows, "k string, p int, v int, i int")
    for back, earlier, ties in itertools.product((False, True), (False, True), (None, ["i"])):
        if earlier and ties is None:
            continue
        got = {r.i: (r.s, r.m, r.n) for r in scans.running(df, ["k"], "p", {"s": ("sum", "v"), "m": ("max", "v"), "n": ("min", F.col("v"))}, ties=ties, earlier=earlier, backwards=back, width=width).collect()}
        want = {}
        for k, p, v, i in rows:
            def before(q, j):
                d = (p - q) * (-1 if back else 1)
                return d > 0 or (d == 0 and (ties is None or j < i or (j == i and not earlier)))
            seen = [w for h, q, w, j in rows if h == k and w is not None and before(q, j)]
            want[i] = (sum(seen), max(seen), min(seen)) if seen else (None, None, None)
        assert got == want


def test_quality_cut_against_a_loop(spark):
    rnd = random.Random(7)
    quals = ["", "+", "++"] + ["".join(rnd.choice("!+5II") for _ in range(rnd.randint(1, 60))) for _ in range(200)]
    for events, half in ((2, 3), (1, 2), (3, 4)):
        rows = spark.createDataFrame([(q,) for q in quals], "q string").select("q", dna.quality_cut("q", half_width=half, events=events).alias("n")).collect()
        for r in rows:
            hit = next((i for i in range(len(r.q)) if sum(c <= "+" for c in r.q[max(0, i - half) : i + half + 1]) >= events), len(r.q))
            assert r.n == hit, (r.q, events, half)


def test_cluster_order_gives_places(spark):
    """Places of samples that lie in one range, in several, and side by side in a range; ties and null sequences."""
    rnd = random.Random(8)
    rows = []
    for i in range(600):
        sample = rnd.choice(["G1"] * 8 + ["G2", "G3", None])
        start = rnd.randint(1, 30) * 100
        rows.append((f"r{rnd.randint(0, 200)}", sample, 1, rnd.choice("+-"), start, start + 50 + rnd.randint(0, 2), 0, "IN_u5", "AAAA", rnd.choice([None, "", "A", "C", "AC", "CA", "ACG"])))
    sites, reads = {}, {}
    for read, sample, _, strand, start, end, *_, leader in rows:
        if sample is not None:
            site = f"chr1{strand}{start if strand == '+' else end}"
            sites.setdefault((sample, site), set()).add(end - start)
            reads.setdefault((sample, site, leader), set()).add(read)
    want = {}
    for sample in ("G1", "G2", "G3"):
        own = [(-len(sites[s, p]), -len(r), -len(q) if q is not None else 1, p, q or "", q) for (s, p, q), r in reads.items() if s == sample]
        want |= {(sample, x[3], x[5]): n for n, x in enumerate(sorted(own, key=lambda x: x[:5]), 1)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = fragments.cluster_order(frag(spark, rows)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(want) and {(r["sample"], r.posid, r.leaderSeq): r.place for r in got} == want
    assert fragments.cluster_order(frag(spark, rows).where("false")).collect() == []


def test_places_with_null_keys(spark):
    from loomsite.operators import scans

    df = spark.createDataFrame([(None, 3), ("a", 2), (None, 1), ("a", None), ("b", 5)], "k string, v int")
    got = scans.placed(df, ["k"], [F.desc("v")])
    assert {(r.k, r.v): r.place for r in got.collect()} == {(None, 3): 1, (None, 1): 2, ("a", 2): 1, ("a", None): 2, ("b", 5): 1}
