"""Sequences against references and each other: alignment, leaders, rearrangements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomsite.functions.dna import mismatches, reverse_complement, wallace_temperature
from loomsite.functions.vectorized import best_segments, match_marks, merge_pairs, trim_adapter
from loomsite.operators.clusters import cluster, links, settle
from loomsite.operators.intervals import merge
from loomsite.operators.multihits import saved


def _kmers(seq, k: int):
    n = F.length(seq)
    starts = F.when(n >= k, F.sequence(F.lit(1), n - k + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(F.col(seq), i, F.lit(k)))


def align(queries: DataFrame, targets: DataFrame, k: int = 11, min_seeds: int = 2, min_length: int = 20, min_identity: float = 90.0, chunk: int = 4096, gap: int = 4) -> DataFrame:
    """Local alignments of distinct ``queries (seq)`` to ``targets (tName, tSeq)`` on both
    strands, with one insert of one base at most: k-mers of both sides are joined, hits
    counted by diagonal, and each diagonal with ``min_seeds`` verified together with its
    two neighbours, which an insert (at a cost of ``gap``) leads to. Targets are dealt in
    chunks, and only the bases beside a query travel with it.

    -> PSL-like ``(seq, tName, strand, qSize, qStart, qEnd, tStart, tEnd, matches,
    misMatches, qNumInsert, qBaseInsert, tNumInsert, tBaseInsert, queryPercentID)``,
    0-based and half-open on the query's own strand. Give it distinct sequences and join
    the result back to the reads that share them."""
    q = queries.select("seq").distinct()
    both = q.select("seq", F.lit("+").alias("strand"), F.col("seq").alias("s")).unionByName(q.select("seq", F.lit("-").alias("strand"), reverse_complement("seq").alias("s")))
    qk = both.select("seq", "strand", "s", F.posexplode(_kmers("s", k)).alias("qp", "kmer"))
    # A target goes in chunks that overlap by k - 1 bases: each k-mer is in one of them.
    chunks = F.sequence(F.lit(0), F.greatest(F.floor((F.length("tSeq") - k) / chunk), F.lit(0)).cast("int"))
    tc = targets.where(F.length("tSeq") >= k).select("tName", "tSeq", F.explode(chunks).alias("c")).select("tName", "c", F.expr(f"substring(tSeq, c * {chunk} + 1, {chunk + k - 1})").alias("part"))
    tk = tc.select("tName", "c", F.posexplode(_kmers("part", k)).alias("tp", "kmer")).select("tName", "kmer", (F.col("tp") + F.col("c") * chunk).alias("tp"))
    # Nothing tells Spark how many k-mers or bases a row of targets holds: neither is broadcast.
    seeds = qk.join(tk.hint("merge"), "kmer").groupBy("seq", "strand", "s", "tName", (F.col("tp") - F.col("qp")).alias("offset")).agg(F.count(F.lit(1)).alias("seeds")).where(F.col("seeds") >= min_seeds)
    # To a diagonal go the target's bases beside the query and one on either side only, from
    # the chunks they lie in.
    at, size = F.greatest(F.col("offset") - 1, F.lit(0)), F.length("s") + 2
    span = seeds.withColumn("__i", F.explode(F.sequence(F.floor(at / chunk).cast("int"), F.floor((at + size) / chunk).cast("int"))))
    text = targets.select("tName", "tSeq", F.explode(F.sequence(F.lit(0), F.floor(F.length("tSeq") / chunk).cast("int"))).alias("__i")).select("tName", "__i", F.expr(f"substring(tSeq, __i * {chunk} + 1, {chunk})").alias("__text"))
    key = ["seq", "strand", "s", "tName", "offset"]
    got = span.join(text.hint("merge"), ["tName", "__i"]).withColumn("__low", F.floor(at / chunk).cast("int") * chunk).groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__i", "__text"))), lambda x: x["__text"]), "").alias("__text"), F.min("__low").alias("__low"))
    got = got.withColumn("__text", F.substr("__text", (at - F.col("__low") + 1).cast("int"), size))
    hit = got.withColumn("__at", at).withColumn("x", best_segments(gap)("s", "__text", (F.col("offset") - F.col("__at")).cast("int")))
    n, length, insert = F.length("s"), F.col("x.end") - F.col("x.start"), F.col("x.insert")
    plus = F.col("strand") == "+"
    more, less = F.when(insert > 0, 1).otherwise(0), F.when(insert < 0, 1).otherwise(0)
    out = hit.select("seq", "tName", "strand", n.alias("qSize"), F.when(plus, F.col("x.start")).otherwise(n - F.col("x.end")).alias("qStart"), F.when(plus, F.col("x.end")).otherwise(n - F.col("x.start")).alias("qEnd"),
                     (F.col("x.tStart") + F.col("__at")).cast("int").alias("tStart"), (F.col("x.tEnd") + F.col("__at")).cast("int").alias("tEnd"), F.col("x.matches").alias("matches"), (length - less - F.col("x.matches")).alias("misMatches"),
                     less.alias("qNumInsert"), less.alias("qBaseInsert"), more.alias("tNumInsert"), more.alias("tBaseInsert"), (100.0 * F.col("x.matches") / length).alias("queryPercentID"))
    # Both diagonals of an insert lead to the same alignment.
    return out.where((F.col("qEnd") - F.col("qStart") >= min_length) & (F.col("queryPercentID") >= min_identity)).distinct()


def trim_reads(reads: DataFrame, seq: str, adapter: str, error: float = 0.15, min_length: int = 30) -> DataFrame:
    """Cuts adapters off the 3' ends; works on distinct (sequence, adapter) pairs."""
    pairs = reads.select(F.col(seq).alias("__seq"), F.col(adapter).alias("__adapter")).distinct()
    pairs = pairs.withColumn("__cut", trim_adapter(error)("__seq", "__adapter"))
    key = F.col(seq).eqNullSafe(F.col("__seq")) & F.col(adapter).eqNullSafe(F.col("__adapter"))
    out = reads.join(pairs, key).select(*[F.col("__cut").alias(c) if c == seq else F.col(c) for c in reads.columns])
    return out.where(F.length(seq) >= min_length)


def merge_reads(reads: DataFrame, min_overlap: int = 10, min_length: int = 50) -> DataFrame:
    """One long anchor read from both mates that overlap: ``(readID, seq)``."""
    out = reads.withColumn("seq", merge_pairs(min_overlap)("anchorReadSeq", reverse_complement("adriftReadSeq")))
    return out.where(F.length("seq") >= min_length)


def rearrangements(hits: DataFrame, min_length: int = 15, max_tail: int = 5, gap: int = 10, overlap: int = 5) -> DataFrame:
    """``(qname, model)`` from a hit table with ``qlen``: the chain of a read's local hits as
    ``qs..qe[s+e];...``. From the left, the next hit that begins at most ``overlap`` bases
    before the last one's end, by start, e-value and bit score; unexplained gaps and a long
    unexplained tail are ``[x]``. The chain is a fold over a read's sorted hits."""
    hit = F.struct("qstart", "evalue", (-F.col("bitscore")).alias("b"), "sseqid", "sstart", "qend", "send")
    rows = hits.groupBy("qname").agg(F.array_sort(F.collect_list(F.when(F.col("qend") - F.col("qstart") + 1 >= min_length, hit))).alias("h"), F.max("qlen").alias("qlen"))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(None).cast("long").alias("end"), F.lit(None).cast("long").alias("last"))

    def text(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    def chain(acc: Column, h: Column) -> Column:
        skip = acc["end"].isNotNull() & ((h["qstart"] < acc["end"] - overlap) | (F.floor(h["qstart"] / 5) == F.floor(acc["last"] / 5)))
        lost = F.when(acc["end"].isNotNull() & (h["qstart"] - acc["end"] >= gap), F.array(text((acc["end"] + 1).cast("string"), "..", (h["qstart"] - 1).cast("string"), "[x]"))).otherwise(F.array().cast("array<string>"))
        low, high = F.least(h["sstart"], h["send"]).cast("string"), F.greatest(h["sstart"], h["send"]).cast("string")
        own = text(h["qstart"].cast("string"), "..", h["qend"].cast("string"), "[", low, F.when(h["send"] >= h["sstart"], "+").otherwise("-"), high, "]")
        more = F.struct(F.concat(acc["out"], lost, F.array(own)).alias("out"), h["qend"].cast("long").alias("end"), h["qstart"].cast("long").alias("last"))
        return F.when(skip, acc).otherwise(more)

    def finish(acc: Column) -> Column:
        tail = F.when(F.col("qlen") - acc["end"] >= max_tail, F.array(text((acc["end"] + 1).cast("string"), "..", F.col("qlen").cast("string"), "[x]"))).otherwise(F.array().cast("array<string>"))
        return F.array_join(F.concat(acc["out"], tail), ";")

    return rows.select("qname", F.aggregate("h", start, chain, finish).alias("model"))


def capture_by_consensus(reads: DataFrame, profiles: list[tuple[str, str]], min_score: float = 10.0, max_start: int = 3, max_search: int = 100, match: float = 2.0, other: float = -3.0, seq: str = "anchorReadSeq") -> DataFrame:
    """Where the leader of each read ends, by ``profiles``, a list of (name, consensus) of the
    ends of vectors, for reads without a table of profile hits -> ``(readID, name, qStart, qEnd,
    score)``, the best profile and place of each read.

    A profile is laid without gaps on the first ``max_search`` bases: a base that agrees
    scores ``match``, another one ``other``, an N of the consensus 0, and the leader ends
    where the running score of the profile is highest (ties: the longest), so that a read
    may leave the profile early. Places up to ``max_start`` count, and ends of
    ``min_score`` at least (ties: the first start, then the first name).

    Reads share their starts: each distinct one is scored once, in the JVM, against the
    configured profiles at each place. Null reads, and reads that no profile fits, have no
    row."""
    start = F.substring(seq, 1, max_search)
    starts = reads.select(start.alias("__start")).where("__start is not null").distinct()
    places = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).alias("consensus"), F.lit(i).alias("qStart")) for n, c in profiles if c for i in range(max_start + 1)])
    sides = starts.select("__start", F.explode(places).alias("p")).select("__start", "p.*")
    steps = F.transform(F.sequence(F.lit(1), F.length("consensus")), lambda i: F.struct(F.substr("consensus", i, F.lit(1)).alias("c"), F.substr("__start", i + F.col("qStart"), F.lit(1)).alias("b")))
    zero = F.struct(F.lit(0.0).alias("run"), F.lit(0).alias("at"), F.lit(-1e9).alias("best"), F.lit(0).alias("end"))

    def step(acc: Column, x: Column) -> Column:
        run = acc["run"] + F.when(x["b"] == "", F.lit(-1e9)).when(x["c"] == "N", 0.0).when(x["c"] == x["b"], match).otherwise(other)
        return F.struct(run.alias("run"), (acc["at"] + 1).alias("at"), F.greatest(acc["best"], run).alias("best"), F.when(run >= acc["best"], acc["at"] + 1).otherwise(acc["end"]).alias("end"))

    laid = sides.withColumn("x", F.aggregate(steps, zero, step)).where(F.col("x.best") >= min_score)
    best = laid.groupBy("__start").agg(F.min(F.struct((-F.col("x.best")).alias("s"), "qStart", "name", F.col("x.end").alias("end"))).alias("m"))
    best = best.select("__start", F.col("m.name").alias("name"), F.col("m.qStart").alias("qStart"), (F.col("m.qStart") + F.col("m.end")).cast("int").alias("qEnd"), (-F.col("m.s")).alias("score"))
    return reads.select("readID", start.alias("__start")).join(best, "__start").drop("__start")


def leader_ends(hits: DataFrame, max_gap: int = 5, max_start: int = 5) -> DataFrame:
    """Where the leader of each read ends: hits with small gaps are merged, and the widest
    stretch that starts early counts (ties: the first)."""
    parts = merge(hits, ["qname"], "qstart", "qend", min_gap=max_gap).where(F.col("start") <= max_start)
    width = F.col("end") - F.col("start") + 1
    return parts.groupBy("qname").agg(F.min_by("end", F.struct((-width).alias("w"), "start")).alias("qEnd"))


def rarefy(reads: DataFrame, by: list[str], levels: tuple[int, ...], seeds: tuple[int, ...], windows: tuple[int, ...], seq: str) -> DataFrame:
    """The first bases of reads for each window, level and seed: level n keeps the n reads
    of a unit whose hashes with the seed are smallest (0: all)."""
    grid = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.lit(s).alias("seed")) for n in levels for s in (seeds if n else seeds[:1])])).alias("g")
    rows = reads.select(*by, "readID", seq, grid).select(*by, "readID", seq, "g.level", "g.seed")
    order = Window.partitionBy(*by, "level", "seed").orderBy(F.md5(F.concat_ws("~", "readID", F.col("seed").cast("string"))), "readID", seq)
    # Level 0 keeps its reads without a rank: its units may be large.
    some = rows.where("level > 0").withColumn("__n", F.row_number().over(order)).where("__n <= level").drop("__n")
    rows = rows.where("level = 0").unionByName(some) if 0 in levels else some
    rows = rows.withColumn("window", F.explode(F.array(*[F.lit(w) for w in windows]))).where(F.length(seq) >= F.col("window"))
    return rows.withColumn(seq, F.expr(f"substring({seq}, 1, window)"))


def structure_stats(rarefied: DataFrame, by: list[str], seq: str, expected: DataFrame, min_reads: int = 2, identity: float = 0.9) -> DataFrame:
    """Of each unit, window, level and seed: reads, those whose structure is ``expected``
    (column ``expected``), others, distinct other structures of ``min_reads`` at least, the
    share of others in percent and structures per kilobase.

    Structures are greedy clusters of windows of ``identity``, expected sequences first, so
    that they stand for the windows that are like them. What the expected sequences take
    is the same for all units, levels and seeds: their representatives are found once, and
    the distinct windows of the run are joined with them once. Among the windows that none
    of them takes, links are found once, too, and each unit's greedy pass reads the links
    between its own windows."""
    unit = [*by, "window", "level", "seed"]
    n = saved(rarefied.groupBy(*unit, seq).agg(F.count(F.lit(1)).alias("n")))
    all_ = saved(n.select("window", F.col(seq).alias("__s")).distinct())
    # The windows are a parameter of the run.
    wide = F.array(*[F.lit(r[0]) for r in n.select("window").distinct().collect()])
    known = expected.where("expected is not null").select("expected", F.explode(wide.cast("array<int>")).alias("window")).where(F.length("expected") >= F.col("window"))
    known = saved(known.select("window", F.expr("substring(expected, 1, window)").alias("expected")).distinct())
    heads = cluster(known, ["window"], "expected", identity, [F.max(F.lit(1))]).where("expected = rep").select("window", F.col("expected").alias("__s"))
    # An order that depends on the window alone: expected ones go before all others.
    first = saved(heads.select("window", "__s", F.struct(F.lit(0).alias("l"), F.col("__s").alias("s")).alias("__o")))
    asked = all_.select("window", "__s", F.struct(F.lit(1).alias("l"), F.col("__s").alias("s")).alias("__o"))
    taken = saved(links(first, asked, ["window"], identity).select("window", F.col("__b").alias("__s")).unionByName(first.select("window", "__s")).distinct())
    rest = saved(asked.join(taken, ["window", "__s"], "left_anti"))
    pairs = saved(links(rest, rest, ["window"], identity).select("window", "__a", "__b"))
    n = n.join(taken.select("window", F.col("__s").alias(seq), F.lit(True).alias("ok")), ["window", seq], "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    n = saved(n)
    open_ = n.where("not ok").select(*unit, F.col(seq).alias("__s"), F.struct((-F.col("n")).alias("n"), F.col(seq).alias("s")).alias("__o"))
    a = open_.select(*unit, F.col("__s").alias("__a"), F.col("__o").alias("__ao"))
    b = open_.select(*unit, F.col("__s").alias("__b"), F.col("__o").alias("__bo"))
    two = pairs.unionByName(pairs.select("window", F.col("__b").alias("__a"), F.col("__a").alias("__b")))
    own = a.join(two, ["window", "__a"]).join(b, [*unit, "__b"]).where(F.col("__ao") < F.col("__bo")).select(*unit, "__a", "__ao", "__b")
    reps = settle(open_, saved(own), unit).withColumnRenamed("__s", seq)
    sizes = n.join(reps, [*unit, seq], "left").groupBy(*unit, "ok", F.coalesce("rep", F.lit("")).alias("rep")).agg(F.sum("n").alias("n"))
    out = sizes.groupBy(*unit).agg(F.sum("n").alias("reads"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("n"))), F.lit(0)).alias("expectedReads"), F.count(F.when(~F.col("ok") & (F.col("n") >= min_reads), 1)).alias("altStructures"))
    out = out.withColumn("unexpectedReads", F.col("reads") - F.col("expectedReads"))
    return out.withColumn("percentUnexpected", 100.0 * F.col("unexpectedReads") / F.col("reads")).withColumn("altStructuresPerKB", 1000.0 * F.col("altStructures") / F.col("window"))


#: Bases of a chunk of a reference table ``(chromosome, chunk, seq)``.
CHUNK = 10_000


def flank(sites: DataFrame, reference: DataFrame, length: int, before: bool = True, chunk: int = CHUNK) -> DataFrame:
    """Adds ``flank``: the bases before (or after) each ``(chromosome, strand, position)``
    in the direction of its strand, cut at the ends of the chromosome. ``reference`` holds
    each chromosome in chunks; a flank touches two of them at most."""
    left = F.col("strand") == "+" if before else F.col("strand") == "-"
    # Before: up to the base before the position; after: from the position on.
    lo = F.when(left, F.col("position") - length).otherwise(F.col("position") + (1 if before else 0))
    if not before:
        lo = F.when(F.col("strand") == "-", F.col("position") - length + 1).otherwise(F.col("position"))
    spots = sites.select("chromosome", "strand", "position").distinct().withColumn("lo", F.greatest(lo, F.lit(1))).withColumn("hi", lo + length - 1)
    parts = spots.where("hi >= 1").withColumn("chunk", F.explode(F.sequence(F.floor((F.col("lo") - 1) / chunk), F.floor((F.col("hi") - 1) / chunk))))
    # The reference may come from a small table that grew: it is not one to broadcast.
    got = parts.join(reference.hint("merge"), ["chromosome", "chunk"])
    base = F.col("chunk") * chunk
    got = got.withColumn("a", F.greatest(F.col("lo") - base, F.lit(1)).cast("int")).withColumn("z", F.least(F.col("hi") - base, F.lit(chunk)).cast("int"))
    got = got.groupBy("chromosome", "strand", "position").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", F.expr("substring(seq, a, z - a + 1)").alias("s")))), lambda x: x["s"]), "").alias("flank"))
    got = got.withColumn("flank", F.when(F.col("strand") == "-", reverse_complement("flank")).otherwise(F.col("flank")))
    return sites.join(got, ["chromosome", "strand", "position"], "left")


def priming_by_leader(sites: DataFrame, reference: DataFrame, k: int = 20, min_matches: int = 15, min_half: int = 7, chunk: int = CHUNK) -> DataFrame:
    """Adds ``PCRartifact1``: the last ``k`` bases of the leader aligned to the ``k`` genomic
    bases before the site, reported when they are so alike that the genome itself may have
    primed the read: enough matches in all, and in the right half."""
    at = flank(sites, reference, k, before=True, chunk=chunk).withColumn("__tail", F.right("repLeaderSeq", F.lit(k)))
    pairs = at.select("__tail", "flank").distinct().withColumn("__marks", match_marks("__tail", "flank"))
    n, right = F.regexp_count("__marks", F.lit(r"\*")), F.regexp_count(F.right("__marks", F.lit(k // 2)), F.lit(r"\*"))
    pairs = pairs.withColumn("PCRartifact1", F.when((n >= min_matches) & (right >= min_half), F.concat(n.cast("string"), F.lit("nt | "), right.cast("string"))))
    return at.join(pairs.drop("__marks"), ["__tail", "flank"], "left").drop("__tail", "flank")


def priming_by_vector(sites: DataFrame, reference: DataFrame, vectors: DataFrame, k: int = 20, word: int = 5, min_temperature: int = 50, min_half: int = 7, chunk: int = CHUNK) -> DataFrame:
    """Adds ``PCRartifact2``: the ``k`` genomic bases after the site have a stretch in the
    vector that melts at ``min_temperature`` at least and matches in the right half."""
    at = flank(sites, reference, k, before=False, chunk=chunk)
    hits = align(at.select(F.col("flank").alias("seq")).where("flank is not null"), vectors, k=word, min_seeds=1, min_length=word)
    hits = hits.withColumn("__part", F.expr("substring(seq, qStart + 1, qEnd - qStart)")).withColumn("temperature", wallace_temperature("__part"))
    half = F.greatest(F.col("qEnd") - F.greatest("qStart", F.lit(k - k // 2)), F.lit(0))
    good = hits.withColumn("half", half).where((F.col("temperature") >= min_temperature) & (F.col("half") >= min_half))
    best = good.groupBy(F.col("seq").alias("flank")).agg(F.max(F.struct("temperature", "matches", "half")).alias("m"))
    label = F.concat(F.col("m.matches").cast("string"), F.lit("nt | "), F.col("m.half").cast("string"))
    return at.join(best.select("flank", label.alias("PCRartifact2")), "flank", "left").drop("flank")


def rearrangement_inputs(reads: DataFrame, prefixes: list[str], vectors: DataFrame, min_length: int = 50, max_mismatches: int = 1, end: int = 20, min_matches: int = 18, seq: str = "seq") -> DataFrame:
    """Reads worth a rearrangement model: long enough, without a run of three N, beginning
    like one of the expected ``prefixes``, and ending in a stretch of a vector."""
    begins = F.lit(False)
    for x in prefixes:
        begins |= mismatches(F.substring(seq, 1, len(x)), F.lit(x)) <= max_mismatches
    good = reads.where((F.length(seq) >= min_length) & ~F.col(seq).contains("NNN") & begins).withColumn("__end", F.right(seq, F.lit(end)))
    found = align(good.select(F.col("__end").alias("seq")), vectors, k=8, min_seeds=1, min_length=min_matches).where(F.col("matches") >= min_matches)
    return good.join(found.select(F.col("seq").alias("__end")).distinct(), "__end", "left_semi").drop("__end")
