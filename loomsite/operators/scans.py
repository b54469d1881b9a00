"""Running aggregates along positions, without a task that holds a whole chromosome.

Positions are cut into bins, and a bin's rows are scanned by themselves. What comes before a
bin is carried to it: bins are summed up, the sums are scanned within runs of ``RUN`` bins,
and the few totals of runs are folded as one array for each key. Bins and runs are keys of
their own, so a key with all rows is as many tasks as it has bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomsite.operators.multihits import saved

#: Positions of a bin, and bins of a run.
WIDTH, RUN = 1 << 14, 256

#: Kinds of aggregates: how a bin's rows and how two partial results are combined.
_OF = {"sum": F.sum, "max": F.max, "min": F.min}


def _both(kind: str, a: Column, b: Column) -> Column:
    if kind == "sum":
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
    return F.greatest(a, b) if kind == "max" else F.least(a, b)


def running(df: DataFrame, by: list[str], position: str, kinds: dict[str, tuple[str, Column | str]], ties: list[str] | None = None, earlier: bool = False, backwards: bool = False, width: int = WIDTH) -> DataFrame:
    """``df`` with a column for each of ``kinds``, ``name: (sum, max or min, column)``: the
    aggregate over the rows of its ``by`` up to its ``position``, rows at the same position
    included; with ``ties`` up to the row itself in their order, and with ``earlier`` up to
    the row before it (null for the first). ``backwards`` goes from the largest position."""
    sign = -1 if backwards else 1
    bins, runs = "__bin", "__run"
    at = F.col(position) * sign
    rows = df.withColumn(bins, F.floor(at / width)).withColumn(runs, F.floor(at / width / RUN))
    order = [at, *[F.col(t) for t in ties or []]]
    local = Window.partitionBy(*by, runs, bins).orderBy(*order)
    if ties is not None or earlier:
        local = local.rowsBetween(Window.unboundedPreceding, -1 if earlier else 0)
    values = {n: (k, F.col(v) if isinstance(v, str) else v) for n, (k, v) in kinds.items()}
    sums = rows.groupBy(*by, runs, bins).agg(*[_OF[k](v).alias(n) for n, (k, v) in values.items()])
    before = Window.partitionBy(*by, runs).orderBy(bins).rowsBetween(Window.unboundedPreceding, -1)
    in_run = sums.select(*by, runs, bins, *[_OF[k](n).over(before).alias(f"__r_{n}") for n, (k, _) in values.items()])
    # A run has few totals: positions over WIDTH times RUN for each key.
    total = sums.groupBy(*by, runs).agg(*[_OF[k](n).alias(n) for n, (k, _) in values.items()])
    total = total.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(runs, *values))).alias("__all")).select(*by, "__all", F.explode(F.transform("__all", lambda x: x[runs])).alias(runs))

    def up_to(name: str, kind: str) -> Column:
        return F.reduce(F.filter("__all", lambda x: x[runs] < F.col(runs)), F.lit(None).cast(sums.schema[name].dataType), lambda acc, x: _both(kind, acc, x[name]))

    carried = in_run.join(total.select(*by, runs, *[up_to(n, k).alias(f"__t_{n}") for n, (k, _) in values.items()]), [*by, runs])
    carried = carried.select(*by, runs, bins, *[_both(k, F.col(f"__t_{n}"), F.col(f"__r_{n}")).alias(f"__c_{n}") for n, (k, _) in values.items()])
    scanned = rows.select("*", *[_OF[k](v).over(local).alias(f"__l_{n}") for n, (k, v) in values.items()])
    out = scanned.join(carried, [*by, runs, bins])
    return out.select(*df.columns, *[_both(k, F.col(f"__c_{n}"), F.col(f"__l_{n}")).alias(n) for n, (k, _) in values.items()])


def numbered_runs(df: DataFrame, by: list[str], position: str, gap: int, name: str = "island") -> DataFrame:
    """``df`` with the number, from 0, of its run of positions that lie ``gap`` apart at most."""
    seen = running(df, by, position, {"__last": ("max", position)}, ties=[], earlier=True)
    cut = F.when(F.col(position) - F.col("__last") > gap, 1).otherwise(0)
    return running(seen.withColumn("__cut", cut).drop("__last"), by, position, {name: ("sum", "__cut")}).drop("__cut")


def placed(df: DataFrame, by: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """``df`` with each row's number, from 1, within its ``by`` in an order without ties.

    Rows are sorted over ranges of all keys, so that a key with all rows is as many tasks as
    there are ranges. They are written as sorted, since another run would cut other ranges;
    what a key has in earlier ranges is then added to a row's number in its own."""
    at, part = "__at", "__part"
    keys = [F.col(b).asc() for b in by]
    rows = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn(at, F.monotonically_increasing_id())
    # The upper bits of such an id are the partition's number, the lower 33 count its rows.
    rows = saved(rows.withColumn(part, F.shiftright(at, 33)))
    # One row for each key in a range: those of a key are as few as the ranges.
    own = rows.groupBy(*by, part).agg(F.min(at).alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    own = own.select(*[F.col(b).alias(f"__by{i}") for i, b in enumerate(by)], F.col(part).alias("__of"), (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__add"))
    same = [F.col(b).eqNullSafe(F.col(f"__by{i}")) for i, b in enumerate(by)]
    out = rows.join(own, [F.col(part) == F.col("__of"), *same])
    return out.select(*df.columns, (F.col(at) + F.col("__add")).cast("int").alias(name))
