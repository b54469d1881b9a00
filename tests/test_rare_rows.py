"""Queries against their SQL on a few rows that only larger tables hold: chance matches and
codes that two samples share."""

import glob
import random
import time

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as entry


def tables(folder, lineitem=(), suppliers=(), parts=()):
    """Rows ``(l_orderkey, l_partkey, l_suppkey, l_linenumber)`` and keys as the driver's tables."""
    long, int_ = pa.int64(), pa.int32()
    rows = {
        "lineitem": {"l_orderkey": pa.array([r[0] for r in lineitem], long), "l_partkey": pa.array([r[1] for r in lineitem], long), "l_suppkey": pa.array([r[2] for r in lineitem], long), "l_linenumber": pa.array([r[3] for r in lineitem], int_)},
        "supplier": {"s_suppkey": pa.array(suppliers, long)},
        "part": {"p_partkey": pa.array(parts, long)},
    }
    for name, columns in rows.items():
        pq.write_table(pa.table(columns), f"{folder}/{name}.parquet")
    return str(folder)


def both(spark, folder, name):
    """The rows of a query and of its SQL, sorted as text."""
    got = entry.queries()[name](spark, folder)
    con = duckdb.connect()
    for t in ("lineitem", "supplier", "part"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    columns = ", ".join(f'"{c}"' for c in got.columns)
    want = con.execute(f"select {columns} from ({entry.oracle_sql()[name]})").fetchall()
    return sorted(map(repr, map(tuple, got.collect()))), sorted(map(repr, want))


def test_adapter_found_early_by_chance(spark, tmp_path):
    """A contig that holds the adapter: what is left of its reads is short, but a read still."""
    got, want = both(spark, tables(tmp_path, [(123, 19746, 235, 7), (73789, 19746, 132, 5), (5, 7, 9, 1)], parts=[19746, 7]), "adapter_trim")
    assert got == want and len(got) == 3


def test_barcode_of_two_samples(spark, tmp_path):
    """Suppliers 1917 and 4043 have one barcode and two linkers: a row for each."""
    got, want = both(spark, tables(tmp_path, [(1, 5, 1917, 1), (2, 6, 1917, 1), (3, 7, 4043, 2), (4, 8, 12, 1)], [1917, 4043, 12, 13]), "barcode_top_linker")
    assert got == want and len(got) == 3


def test_mates_with_a_short_overlap_by_chance(spark, tmp_path):
    """The ends of a contig's mates agree in a few bases; their overlap is the long one."""
    got, want = both(spark, tables(tmp_path, parts=[99838, 3]), "pair_merge_mismatch")
    assert got == want


def test_leaders_beside_a_flank_of_c(spark, tmp_path):
    """The genome before two of the sites holds 15 C among 20 bases."""
    got, want = both(spark, tables(tmp_path, [(556126, 68684, 3433, 5), (37759, 6443, 49, 6), (107431, 19175, 279, 1), (4, 8, 12, 1)], parts=[68684, 6443, 19175, 8]), "priming_artifacts")
    assert got == want


def broadcasts(df):
    """Lines of a plan in which a side of a join is sent to the driver and then to all."""
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastHashJoin" in x or "BroadcastNestedLoop" in x]


def test_grown_sides_of_joins_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Neighbours of barcodes and chunks of references are many more than the small files tell."""
    from loomsite.fixtures import view
    from loomsite.operators import demux, sequences

    d = tables(tmp_path, [(1, 5, 1917, 1), (2, 6, 12, 1)], [1917, 12], [5, 6])
    reads, samples = view(spark, d, "fx_reads"), view(spark, d, "fx_samples")
    sheet = samples.selectExpr("uniqueSample", "index1Seq as c")
    assert not broadcasts(demux.near_codes(reads.selectExpr("index1Seq as c"), sheet, 1))
    monkeypatch.setattr(demux, "SHEET_ROWS", 0)
    assert not broadcasts(demux.assign(reads, samples))
    assert demux.assign(reads, samples).count() == 2
    assert not [x for x in broadcasts(entry.queries()["reference_flank"](spark, d)) if "chunk#" in x]
    assert not broadcasts(sequences.align(view(spark, d, "fx_contig_reads").selectExpr("piece as seq"), view(spark, d, "fx_contigs")))


def test_counts_of_a_stream_are_read_from_its_state(spark, tmp_path):
    """Two runs over one checkpoint; the second one adds a shard."""
    from loomsite.fixtures import view
    from loomsite.streaming import demultiplex as stream

    d = tables(tmp_path, [(1, 5, 1917, 1), (2, 6, 12, 1), (3, 6, 12, 2)], [1917, 12], [5, 6])
    reads, samples = view(spark, d, "fx_reads").select("readID", "index1Seq", "anchorReadSeq", "adriftReadSeq"), view(spark, d, "fx_samples")
    shards, state = f"{tmp_path}/shards", f"{tmp_path}/state"
    for n in (1, 2):
        reads.write.mode("append").parquet(shards)
        stream.write_counts(stream.assign_stream(stream.read_shards(spark, shards), samples), state).awaitTermination()
        got = {tuple(r) for r in stream.read_counts(spark, state).collect()}
        assert got == {("T~S0~G1917~1", n), ("T~S0~G12~1", 2 * n)}


def test_saved_tables_leave_no_shuffle_files(spark):
    """What iterates saves a table in each round; their shuffle files would add up."""
    from loomsite.operators.multihits import saved

    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def files():
        return {x for f in folders for x in glob.glob(f"{f}/*/shuffle_*.data")}

    before = files()
    saved(spark.range(100_000).selectExpr("id % 1000 as k").distinct())
    for _ in range(20):
        if not files() - before:
            break
        time.sleep(0.5)
    assert not files() - before


def test_links_of_mutated_sequences(spark):
    """Short and long sequences with edits of all kinds, beside strangers: no link is lost,
    and neither side of the join of pieces is broadcast."""
    from loomsite.operators import clusters
    from loomsite.operators.multihits import saved
    from tests.loops import levenshtein

    rnd = random.Random(3)
    for low, high, identity in ((20, 34, 0.87), (70, 82, 0.9), (150, 156, 0.93)):
        texts = set()
        for _ in range(12):
            x = "".join(rnd.choice("ACGT") for _ in range(rnd.randint(low, high)))
            for _ in range(6):
                y = list(x)
                for _ in range(rnd.randint(0, int(len(x) * (1 - identity)) + 1)):
                    i, kind = rnd.randrange(len(y)), rnd.randrange(3)
                    y[i : i + 1] = [[rnd.choice("ACGT")], [], [y[i], rnd.choice("ACGT")]][kind]
                texts.add("".join(y))
        rows = saved(spark.createDataFrame([("T", t) for t in sorted(texts)], "k string, __s string").selectExpr("*", "struct(-length(__s) as l, __s as s) as __o"))
        found = clusters.links(rows, rows, ["k"], identity)
        assert not [x for x in broadcasts(found) if "__key" in x or "__gram" in x]
        want = {(a, b) for a in texts for b in texts if (-len(a), a) < (-len(b), b) and levenshtein(a, b) <= int(len(b) * (1 - identity) + 1e-9)}
        assert want and {(r["__a"], r["__b"]) for r in found.collect()} == want


def test_export_writes_few_files(spark, tmp_path):
    """A sample's records lie in few files, not in one for each task of the join."""
    from loomsite.sources import files

    raw = spark.range(4000).repartition(8).selectExpr("concat('r', id) as readID", "'ACGT' as seq", "'IIII' as qual", "concat('S', id % 40) as uniqueSample")
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merged, "false")
    try:
        files.export_fastq(raw.drop("uniqueSample"), raw.select("readID", "uniqueSample").hint("merge"), f"{tmp_path}/fq")
    finally:
        spark.conf.unset(merged)
    assert len(glob.glob(f"{tmp_path}/fq/*/*.gz")) <= 40 + 4
    back = spark.read.text(f"{tmp_path}/fq")
    assert back.count() == 16000 and back.where("value = '@r81' and uniqueSample = 'S1'").count() == 1


def test_groups_of_few_sequences_make_no_pieces(spark, monkeypatch):
    """Only a group of many sequences is cut into pieces."""
    from loomsite.operators import clusters

    seen = []
    run = clusters._joined
    monkeypatch.setattr(clusters, "_joined", lambda first, *x: seen.append(first.count()) or run(first, *x))
    rnd = random.Random(9)
    some = ["".join(rnd.choice("ACGT") for _ in range(32)) for _ in range(50)]
    rows = [(i, t) for i, t in enumerate(some)] + [(0, some[0][:31] + "N")] + [(50, t) for t in some[:10]]
    got = clusters.cluster(spark.createDataFrame(rows, "k int, s string"), ["k"], "s").collect()
    assert max(seen) <= 10 and len(got) == len(rows)
    assert {tuple(r) for r in got if r.k != 0} == {(k, t, t) for k, t in rows if k != 0} and len({r.rep for r in got if r.k == 0}) == 1
