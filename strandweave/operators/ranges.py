"""Sums and minima over many intervals of positions, in rows in proportion to positions and intervals.

Positions are cut in blocks, and each place of a block has what the block holds up to it and from it
on. An interval that is at least as long as a block, and less than twice, is the end of a block, perhaps
a whole one, and the beginning of the next (van Herk, 1992; Gil and Werman, 1993): three places,
however long it is. Block lengths are powers of two, one for each in which interval lengths lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "reference_start", "reference_end"


def level_of(length: Column) -> Column:
    """The power of two of the blocks that serve intervals of this length."""
    return (F.length(F.bin(length.cast("long"))) - 1).cast("int")


def interval_aggregates(
    intervals: DataFrame, points: DataFrame, place: str, sums: dict[str, Column], minima: dict[str, Column], levels: list[int] | None = None
) -> DataFrame:
    """Each of the distinct ``intervals`` (reference_start, reference_end) with sums and minima over its ``points``.

    Sums are 0 and minima null where an interval has no point; points without a place are left out. ``levels``,
    those of the intervals' lengths, are looked up where they aren't known; they are as many as the longest has bits.

    What intervals ask for stands among the points of a block, so points and questions are dealt and sorted once;
    the answers of an interval, three at most, then meet.
    """
    spans = intervals.withColumn("_level", level_of(F.col(END) - F.col(START) + 1))
    if levels is None:
        levels = [r[0] for r in spans.select("_level").distinct().collect()]
    kinds = {f.name: f.dataType for f in points.select(*(c.alias(n) for n, c in (sums | minima).items())).schema}
    if not levels:
        return intervals.select(START, END, *(F.lit(None).cast(t).alias(n) for n, t in kinds.items())).limit(0)
    at = "shiftright(cast({} as long), _level)"
    first, last = at.format(START), at.format(END)
    asked = spans.select(START, END, "_level", F.explode(F.expr(
        f"filter(array(named_struct('_block', {first}, '_p', cast({START} as long), '_ahead', true, '_due', {last} > {first}), "
        f"named_struct('_block', {first} + 1, '_p', shiftleft({first} + 2, _level) - 1, '_ahead', false, '_due', {last} - {first} = 2), "
        f"named_struct('_block', {last}, '_p', cast({END} as long), '_ahead', false, '_due', true)), x -> x._due)"
    )).alias("x")).select(START, END, "_level", "x._block", "x._p", "x._ahead")
    own = points.where(F.col(place).isNotNull()).select(F.col(place).cast("long").alias("_p"), *(c.alias(n) for n, c in (sums | minima).items()))
    own = own.withColumn("_level", F.explode(F.array(*map(F.lit, levels)))).withColumn("_block", F.expr("shiftright(_p, _level)"))
    rows = own.unionByName(asked, allowMissingColumns=True)
    block = Window.partitionBy("_level", "_block").rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def held(n: str) -> Column:
        value = F.sum if n in sums else F.min
        return F.when(F.col("_ahead"), value(n).over(block.orderBy(F.desc("_p")))).otherwise(value(n).over(block.orderBy("_p"))).alias(n)

    told = rows.select(START, END, "_ahead", *map(held, kinds)).where(F.col("_ahead").isNotNull())
    return told.groupBy(START, END).agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in sums), *(F.min(n).alias(n) for n in minima))
