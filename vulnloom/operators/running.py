"""Running totals and positions that need no single-task window.

Rows are taken in blocks, and blocks in larger blocks. Each block is totalled,
the totals are put in order only among the blocks of the same larger block, and
rows are numbered only within their own smallest block. What one task orders is
then the children of one block: the years of a lake, the directories on a page,
the ids of a number range, the lines of a file split.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(
    df: DataFrame,
    keys: list[str],
    blocks: list[list[str]],
    order: list[str],
    value: Column,
    name: str,
) -> DataFrame:
    """Add ``name``: the total of ``value`` up to and including the row.

    Totals run within ``keys``: over blocks in the order of the columns in
    ``blocks``, largest first, and over the rows of a block in that of
    ``order``.
    """
    if not keys:
        whole = df.withColumn("_whole", F.lit(0))
        return running_total(whole, ["_whole"], blocks, order, value, name).drop("_whole")
    if not blocks:
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.sum(value).over(upto))
    block, *smaller = blocks
    earlier = Window.partitionBy(*keys).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        df.groupBy(*keys, *block)
        .agg(F.sum(value).alias("_total"))
        .withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
        .drop("_total")
    )
    # Null keys are a block like any other.
    named = before.select(*(F.col(c).alias(f"_{i}_key") for i, c in enumerate([*keys, *block])), "_before")
    same = [F.col(c).eqNullSafe(F.col(f"_{i}_key")) for i, c in enumerate([*keys, *block])]
    return (
        running_total(df, [*keys, *block], smaller, order, value, name)
        .join(named, same)
        .withColumn(name, F.col("_before") + F.col(name))
        .drop(*named.columns)
    )
