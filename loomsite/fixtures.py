"""Views with the shapes of sequencing tables, derived from the driver's tables.

The text of each view runs in Spark and in DuckDB alike: it uses integers and md5 only.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_DNA = "translate(md5(cast({} as string)), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def _dna(x: str) -> str:
    return _DNA.format(x)


VIEWS = {
    "fx_samples": f"""
select concat('T~S', s_suppkey % 3, '~G', s_suppkey, '~1') as uniqueSample,
  substr({_dna("s_suppkey")}, 1, 12) as index1Seq,
  concat(substr({_dna("s_suppkey + 7")}, 1, 20), 'NNNNNNNNNNNN', 'CTCCGCTTAAGGGACT') as adriftReadLinkerSeq,
  case when s_suppkey % 2 = 0 then 'IN_u5' else 'IN_u3' end as flags
from supplier""",
    "fx_reads": f"""
select concat('r', l_orderkey, '_', l_linenumber) as readID,
  concat('T~S', l_suppkey % 3, '~G', l_suppkey, '~1') as uniqueSample,
  substr({_dna("l_suppkey")}, 1, 12) as index1Seq,
  case when l_orderkey % 97 = 0
    then concat(substr({_dna("l_suppkey")}, 1, l_orderkey % 12), translate(substr({_dna("l_suppkey")}, l_orderkey % 12 + 1, 1), 'ACGT', 'CGTA'), substr({_dna("l_suppkey")}, l_orderkey % 12 + 2, 11 - l_orderkey % 12))
    else substr({_dna("l_suppkey")}, 1, 12) end as adriftReadRandomID,
  concat('TCTGCGCGCTCGCTCGCTCA', {_dna("l_partkey")}, {_dna("l_partkey % 89")}) as anchorReadSeq,
  concat(substr({_dna("l_suppkey + 7")}, 1, 20), substr({_dna("l_suppkey")}, 1, 12), 'CTCCGCTTAAGGGACT', {_dna("l_partkey")}) as adriftReadSeq
from lineitem""",
    "fx_fragments": f"""
select concat('r', l_orderkey, '_', cast(floor(l_linenumber / 2) as int)) as readID, 'T' as trial, concat('S', l_suppkey % 2) as subject,
  concat('G', l_suppkey % 5) as sample, cast(l_orderkey % 4 + 1 as int) as replicate,
  concat('chr', cast(floor(l_partkey / 50) as int) % 3 + 1) as chromosome, case when l_orderkey % 2 = 0 then '+' else '-' end as strand,
  cast(1000 + l_partkey * 100 + l_linenumber % 4 as int) as fragStart,
  cast(1100 + l_partkey * 100 + l_linenumber % 4 + l_suppkey % 7 as int) as fragEnd,
  cast(l_orderkey % 3 as int) as nDuplicateReads,
  case when l_partkey % 2 = 0 then 'IN_u5' else 'IN_u3' end as flags,
  substr({_dna("l_orderkey")}, 1, 12) as randomLinkerSeq,
  concat('TCTGCGCGCT', substr({_dna("l_partkey % 40 + 1000 * cast(floor(l_partkey / 500) as int)")}, 1, 10)) as leaderSeq
from lineitem""",
    "fx_alignments": """
select concat('r', l_orderkey) as readID, case when l_linenumber % 2 = 0 then 'anchor' else 'adrift' end as mate,
  concat('chr', l_partkey % 3 + 1) as tName, case when (l_linenumber + l_orderkey) % 2 = 0 then '+' else '-' end as strand,
  cast(1000 + l_partkey * 13 as int) as tStart, cast(1040 + l_partkey * 13 as int) as tEnd,
  cast(l_suppkey % 6 as int) as qStart, cast(60 - l_partkey % 9 as int) as qEnd, 60 as qSize,
  cast(l_partkey % 2 as int) as tNumInsert, cast(l_suppkey % 7 as int) as misMatches
from lineitem""",
    "fx_genes": """
select concat('chr', p_partkey % 3 + 1) as chromosome, cast(1000 + p_partkey * 97 as int) as txStart,
  cast(1000 + p_partkey * 97 + p_size * 3 as int) as txEnd,
  case when p_partkey % 2 = 0 then '+' else '-' end as strand, concat('GENE', p_partkey) as name2
from part""",
    "fx_repeats": """
select concat('chr', p_partkey % 3 + 1) as query_seq, cast(1000 + p_partkey * 101 as int) as query_start,
  cast(1000 + p_partkey * 101 + p_size as int) as query_end,
  case when p_partkey % 3 = 0 then 'C' else '+' end as strand, p_brand as repeat_name, p_type as repeat_class
from part""",
    "fx_contigs": f"""
select concat('ctg', p_partkey) as tName, concat({", ".join(_dna(f"'c' || p_partkey || '.{i}'") for i in range(8))}) as tSeq
from part""",
    "fx_contig_reads": f"""
select concat('r', l_orderkey, '_', l_linenumber) as readID, concat('ctg', l_partkey) as tName, cast(l_suppkey * 7 % 180 as int) as tStart,
  case when l_linenumber % 2 = 0 then '+' else '-' end as strand,
  substr(concat({", ".join(_dna(f"'c' || l_partkey || '.{i}'") for i in range(8))}), cast(l_suppkey * 7 % 180 + 1 as int), 60) as piece
from lineitem""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view over the tables of a folder; the names of temporary views are not used."""
    sql = VIEWS[name]
    base = re.search(r"from (\w+)\s*$", sql)[1]
    return spark.sql(re.sub(r"from \w+\s*$", "from {base}", sql), base=spark.read.parquet(f"{sf_dir}/{base}.parquet"))


def with_views(*names: str, recursive: bool = False) -> str:
    """``WITH`` and the definitions of views, for oracle SQL that continues with more."""
    return ("WITH RECURSIVE " if recursive else "WITH ") + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
