"""URL filters with a tree of path templates for each host.

Method: a url's path becomes segments; a segment with a digit or of over 40 characters
becomes ``*`` at once, which leaves far fewer distinct paths than urls (their counts are
combined before the shuffle, so that a hot host costs no more than its templates). Going
down the tree level by level, a node's children become one wildcard branch when they are
many for the urls they hold (variable words), or when they are statistically similar to
their labelled siblings: both sides are large enough to tell, and two-proportion z-tests
find no difference in how their urls end (a file's extension, a slash) nor, for a branch
with labels of its own, in the share of bad ones. So labels spread to sibling branches
that look alike, and to no others. A leaf is a template. It is rejected if its share of bad
urls among the labelled ones, smoothed with its host's share, reaches a limit. The host's
share is the mean over its labelled branches, smoothed with a neutral prior: each branch
is one observation at most (``l / (l + smoothing)`` of one, for ``l`` labels), so that many
labels of one branch say little about a branch that is not like it, and several branches
that agree say much. The share over all urls is no
prior: labels are not a sample of urls (most rules block), so it tells how rules are
written, not what a url without evidence is.

Labels are what a caller knows about urls: a column of 1 (bad), 0 (good) and null, or,
without one, the verdicts of the rules, which the tree carries on to urls that no rule
fits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsite.llm.common import materialize, table

#: Of a branch: urls, labelled ones, bad ones, those that end in an extension, in a slash.
_SUMS = ("n", "l", "b", "e", "s")

#: The end of a path whose last segment has an extension.
_EXTENSION = r"[.][A-Za-z0-9]{1,8}/?\z"

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """A host, which stands for its subdomains too, and the start of a path."""

    host: str
    path: str
    block: bool

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    empty if the url is null or has no ``://``."""
    host = F.translate(F.regexp_extract(url, _PARTS, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty as the host is."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _first(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    return F.coalesce(*[F.when(r.fits(host, path), F.lit(value(r))) for r in ordered], F.lit(None))


def _template(path: Column, depth: int) -> Column:
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    parts = F.transform(parts, lambda s: F.when(s.rlike("[0-9]") | (F.length(s) > 40), F.lit("*")).otherwise(s))
    return F.when(F.size(parts) > depth, F.concat(F.slice(parts, 1, depth), F.array(F.lit("**")))).otherwise(parts)


def _close(x: str, n: str, z: float) -> Column:
    """Whether a child's share ``x / n`` and that of its labelled siblings (``p<x>`` and
    ``p<n>`` are the sums of both) don't differ significantly."""
    px, pn = F.col(f"p{x}"), F.col(f"p{n}")
    rest, share = pn - F.col(n), px / pn
    spread = F.sqrt(share * (1 - share) * (1 / F.col(n) + 1 / rest))
    return F.abs(F.col(x) / F.col(n) - (px - F.col(x)) / rest) <= z * spread


def _enough(n: str, least: int) -> Column:
    return (F.col(n) >= least) & (F.col(f"p{n}") - F.col(n) >= least)


def _merge_level(tree: DataFrame, d: int, max_children: int, min_urls: float, min_branch: int, min_labels: int, z: float) -> DataFrame:
    """Turns the d-th segments of variable or similar branches into ``*``."""
    own = tree.withColumn("up", F.slice("t", 1, d - 1)).withColumn("child", F.get("t", F.lit(d - 1)))
    child = own.where("child is not null").groupBy("host", "up", "child").agg(*[F.sum(x).alias(x) for x in _SUMS])
    known = F.col("l") >= min_labels
    of_known = [F.coalesce(F.sum(F.when(known, F.col(x))), F.lit(0)).alias(f"q{x}") for x in _SUMS]
    parent = child.groupBy("host", "up").agg(F.count(F.lit(1)).alias("kids"), F.sum("n").alias("urls"), *of_known)
    both = child.join(parent, ["host", "up"]).select("*", *[(F.col(f"q{x}") + F.when(known, 0).otherwise(F.col(x))).alias(f"p{x}") for x in _SUMS])
    alike = F.when(_enough("n", min_branch), _close("e", "n", z) & _close("s", "n", z)).otherwise(F.lit(False))
    agreed = F.when(_enough("l", min_labels), _close("b", "l", z)).otherwise(F.lit(True))
    similar = (F.col("kids") > 1) & ((known & (F.col("pn") == F.col("n"))) | (alike & agreed))
    variable = (F.col("kids") > max_children) & (F.col("urls") < F.col("kids") * min_urls)
    wild = both.where((similar | variable) & (F.col("child") != "*")).select("host", "up", "child", F.lit(True).alias("wild"))
    joined = own.join(wild, ["host", "up", "child"], "left")
    star = F.transform("t", lambda s, i: F.when(i == d - 1, F.lit("*")).otherwise(s))
    return joined.select("host", "shape", F.when(F.col("wild"), star).otherwise(F.col("t")).alias("t"), *_SUMS)


def judge_urls(
    df: DataFrame,
    rules: Sequence[Rule] = (),
    id_column: str = "page_id",
    url_column: str = "url",
    label_column: str | None = None,
    depth: int = 8,
    max_children: int = 20,
    min_urls: float = 10,
    min_branch: int = 5,
    min_labels: int = 5,
    z: float = 1.96,
    smoothing: float = 5.0,
    branch_smoothing: float = 2.0,
    prior: float = 0.5,
    limit: float = 0.7,
) -> DataFrame:
    """-> ``(<id_column>, host, path, rule, verdict, template, bad_share)`` for each row.

    ``rule`` is the longest rule that fits (ties: the smaller name) or null; ``verdict``
    is the rule's, else the template's. ``depth`` levels of a path make the tree, what
    lies deeper counts as one segment ``**``. Defined cases: a null url, an empty one and
    one without ``://`` have an empty host and path, are no web address to judge, and
    are allowed; without any label nothing is rejected; repeated rows each get a row; a table without rows gives none; other
    columns are dropped. ``min_branch`` urls and ``min_labels`` labels are what both sides
    of the tests for similar branches need, no condition of a rejection; a smaller branch
    is not similar to anything, and is judged by its own labels and its host.
    """
    url = F.col(url_column).cast("string")
    rows = df.select(F.col(id_column), url_host(url).alias("host"), url_path(url).alias("path"), (F.col(label_column).cast("int") if label_column else F.lit(None).cast("int")).alias("given"))
    host, path = F.col("host"), F.col("path")
    if rules:
        rows = rows.withColumn("rule", _first(rules, host, path, lambda r: r.name)).withColumn("ruled", _first(rules, host, path, lambda r: int(r.block)))
    else:
        rows = rows.withColumn("rule", F.lit(None).cast("string")).withColumn("ruled", F.lit(None).cast("int"))
    label = F.col("given") if label_column else F.col("ruled")
    rows = rows.withColumn("shape", _template(path, depth))
    ends = [F.sum(F.when(x, 1).otherwise(0)) for x in (path.rlike(_EXTENSION), path.endswith("/"))]
    sums = [F.count(F.lit(1)), F.count(label), F.coalesce(F.sum(label), F.lit(0)), *ends]
    tree = rows.groupBy("host", "shape").agg(*[x.alias(y) for x, y in zip(sums, _SUMS, strict=True)])
    tree = materialize(tree.select("host", "shape", F.col("shape").alias("t"), *_SUMS), "urltree")
    levels = tree.agg(F.max(F.size("t"))).first()[0] or 0
    branch = tree.groupBy("host", F.coalesce(F.get("shape", F.lit(0)), F.lit("")).alias("branch")).agg(F.sum("l").alias("l"), F.sum("b").alias("b"))
    counted = [F.sum(F.round(F.col(x) / (F.col("l") + smoothing), 9).cast("decimal(20,9)")).cast("double") for x in ("b", "l")]
    by_host = branch.groupBy("host").agg(counted[0].alias("bad"), counted[1].alias("all"))
    host_share = (F.col("bad") + branch_smoothing * prior) / (F.col("all") + branch_smoothing)
    for d in range(1, levels + 1):
        tree = materialize(_merge_level(tree, d, max_children, min_urls, min_branch, min_labels, z), "urltree")
    leaf = tree.groupBy("host", "t").agg(F.sum("l").alias("l"), F.sum("b").alias("b")).join(by_host, "host")
    leaf = leaf.select("host", "t", "l", ((F.col("b") + smoothing * host_share) / (F.col("l") + smoothing)).alias("bad_share"))
    leaf = leaf.withColumn("reject", F.col("bad_share") >= limit)
    judged = tree.select("host", "shape", "t").join(leaf, ["host", "t"])
    judged = judged.select("host", "shape", F.concat(F.lit("/"), F.array_join("t", "/")).alias("template"), "bad_share", "reject")
    found = rows.join(judged, ["host", "shape"], "left")
    block = F.coalesce(F.col("ruled") == 1, F.col("reject") & (F.col("host") != ""), F.lit(False))
    verdict = F.when(block, F.lit("block")).otherwise(F.lit("allow"))
    return found.select(id_column, "host", "path", "rule", verdict.alias("verdict"), "template", "bad_share")


#: The rules of the query.
RULES = (
    Rule("com", "/en/", True),
    Rule("example.com", "/en/7", False),
    Rule("net", "/de/", False),
    Rule("example.net", "/de/8", True),
    Rule("org", "/es/", True),
)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _close_sql(x: str, n: str) -> str:
    return f"abs({x} / {n} - (p{x} - {x}) / (p{n} - {n})) <= 1.96::DOUBLE * sqrt(p{x} / p{n} * (1 - p{x} / p{n}) * (1 / {n} + 1 / (p{n} - {n})))"


def _level_sql(d: int) -> str:
    """The d-th level of the tree: which children become wildcards."""
    sums = ", ".join(f"sum({x}) AS {x}" for x in _SUMS)
    of_known = ", ".join(f"coalesce(sum({x}) FILTER (l >= 5) OVER p, 0) + CASE WHEN l >= 5 THEN 0 ELSE {x} END AS p{x}" for x in _SUMS)
    return f"""c{d} AS (
  SELECT host, t[1:{d - 1}] AS up, t[{d}] AS child, {sums} FROM t{d - 1} WHERE len(t) >= {d} GROUP BY ALL
), w{d} AS (
  SELECT host, up, child FROM (SELECT *, count(*) OVER p AS kids, sum(n) OVER p AS urls, {of_known} FROM c{d} WINDOW p AS (PARTITION BY host, up))
  WHERE child <> '*' AND ((kids > 20 AND urls < kids * 10) OR (kids > 1 AND ((l >= 5 AND pn = n) OR (
    CASE WHEN n >= 5 AND pn - n >= 5 THEN {_close_sql("e", "n")} AND {_close_sql("s", "n")} ELSE false END
    AND CASE WHEN l >= 5 AND pl - l >= 5 THEN {_close_sql("b", "l")} ELSE true END))))
), t{d} AS (
  SELECT t.host, shape, CASE WHEN w.child IS NULL THEN t ELSE list_concat(list_append(t[1:{d - 1}], '*'), t[{d + 1}:]) END AS t, n, l, b, e, s
  FROM t{d - 1} t LEFT JOIN w{d} w ON w.host = t.host AND w.child = t.t[{d}] AND w.up = t.t[1:{d - 1}]
), """


OP10_SQL = r"""
WITH p AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), r(rhost, rpath, v) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
         ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), q AS (
  SELECT page_id, host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(v, length(rhost || rpath)) AS ruled,
    [CASE WHEN regexp_matches(x, '[0-9]') OR length(x) > 40 THEN '*' ELSE x END FOR x IN string_split(path, '/') IF x <> ''] AS s
  FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id, host, path
), s AS (
  SELECT *, CASE WHEN len(s) > 8 THEN list_append(s[1:8], '**') ELSE s END AS shape FROM q
), t0 AS (
  SELECT host, shape, shape AS t, count(*) AS n, count(ruled) AS l, count(*) FILTER (ruled = 'block') AS b,
    count(*) FILTER (regexp_matches(path, '[.][A-Za-z0-9]{1,8}/?\z')) AS e, count(*) FILTER (ends_with(path, '/')) AS s
  FROM s GROUP BY host, shape
), """ + "".join(_level_sql(d) for d in range(1, 10)) + r"""br AS (
  SELECT host, round(sum(b) / (sum(l) + 5::DOUBLE), 9)::DECIMAL(20, 9) AS bad, round(sum(l) / (sum(l) + 5::DOUBLE), 9)::DECIMAL(20, 9) AS known
  FROM t0 GROUP BY host, coalesce(shape[1], '')
), h AS (
  SELECT host, (sum(bad)::DOUBLE + 1) / (sum(known)::DOUBLE + 2) AS share FROM br GROUP BY host
), leaf AS (
  SELECT host, t, (sum(b) + 5 * any_value(share)) / (sum(l) + 5) AS bad_share FROM t9 JOIN h USING (host) GROUP BY host, t
)
SELECT page_id, s.host, path, rule, coalesce(ruled, CASE WHEN bad_share >= 0.7 AND s.host <> '' THEN 'block' ELSE 'allow' END) AS verdict
FROM s JOIN t9 ON t9.host = s.host AND t9.shape = s.shape JOIN leaf ON leaf.host = t9.host AND leaf.t = t9.t
"""

QUERIES = {"op10_url_filter": op10_url_filter}
ORACLES = {"op10_url_filter": OP10_SQL}
