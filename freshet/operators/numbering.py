"""Row numbers over a total order, of which no row is written.

The order's values are cut into buckets by limits from a sample.  A row's bucket
follows from its values alone, so rows need not be kept between counting
and numbering: the rows of each bucket are counted, each bucket is numbered on its own,
and the rows of earlier buckets are added.  A value that fills buckets by itself
gets finer ones by the next column of the order, so a hot value is spread as well.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .selection import By

#: Rows of the sample, about, and buckets of a column.
SAMPLE_ROWS, BUCKETS = 4096, 64


def _sorted_by(by: By) -> Column:
    col = F.col(by.name)
    if by.descending:
        return col.desc_nulls_first() if by.nulls_first else col.desc_nulls_last()
    return col.asc_nulls_first() if by.nulls_first else col.asc_nulls_last()


def _codes(sample: list[tuple], order: Sequence[By], kinds: Sequence[T.DataType], buckets: int) -> tuple[Column, int]:
    """Bucket of a row by these columns, in their order, and how many there may be."""
    by, kind, col = order[0], kinds[0], F.col(order[0].name)
    known = sorted(r[0] for r in sample if r[0] is not None and r[0] == r[0])
    limits = sorted({known[len(known) * i // buckets] for i in range(1, buckets)}) if known else []
    n = len(limits)
    if n:
        array = F.array(*[F.lit(x).cast(kind) for x in limits])
        passed = F.size(F.filter(array, lambda x: x <= col))
        same = F.coalesce(F.get(array, passed - 1) == col, F.lit(False))
    else:
        passed, same = F.lit(0), F.lit(False)
    # a limit itself stands before what lies between it and the next one
    code = (2 * (n - passed) + same.cast("int")) if by.descending else 2 * passed - same.cast("int") + 1
    code = F.when(col.isNull(), F.lit(0 if by.nulls_first else 2 * n + 3)).otherwise(code + 1)
    width = 2 * n + 4
    often = Counter(r[0] for r in sample)
    heavy = [v for v, c in often.items() if c > 2 * len(sample) / buckets and (v is None or v in limits)]
    if len(order) == 1 or not heavy:
        return code.cast("bigint"), width
    finer = [(v, *_codes([r[1:] for r in sample if r[0] == v], order[1:], kinds[1:], buckets)) for v in heavy]
    most = max(w for *_, w in finer)
    inner = F.lit(0).cast("bigint")
    for value, deeper, _ in finer:
        inner = F.when(col.eqNullSafe(F.lit(value).cast(kind)), deeper).otherwise(inner)
    return code.cast("bigint") * most + inner, width * most


def number_rows(
    df: DataFrame, order_by: Sequence[By | str], partition_by: Sequence[str] = (), name: str = "row_number",
    buckets: int = BUCKETS,
) -> DataFrame:
    """``row_number()`` for groups of any size, down to one group with all rows.

    ``order_by`` should end with a unique column: the numbers of rows that it does
    not tell apart are in no fixed order.  Null keys are a group.  A sample of
    about :data:`SAMPLE_ROWS` keys is taken when this is called; it only fixes the
    buckets, and any sample gives the same numbers.  The result is lazy, reads
    ``df`` twice, and shuffles its rows once.
    """
    order = [By(o) if isinstance(o, str) else o for o in order_by]
    keys = df.select(*[b.name for b in order])
    total = keys.count()
    sample = [tuple(r) for r in keys.sample(min(1.0, 1.2 * SAMPLE_ROWS / max(total, 1)), 17).collect()] if total else []
    code, _ = _codes(sample, order, [df.schema[b.name].dataType for b in order], buckets)
    rows = df.withColumn("_bucket", code)
    counts = rows.groupBy(*partition_by, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*partition_by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    own = F.row_number().over(Window.partitionBy(*partition_by, "_bucket").orderBy(*[_sorted_by(b) for b in order]))
    left, right = rows.withColumn("_own", own).alias("l"), counts.alias("r")
    same = reduce(
        lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in partition_by], F.col("l._bucket") == F.col("r._bucket")
    )
    number = (F.col("_own") + F.col("_before")).cast("bigint")
    return left.join(right, same).select(*[F.col(f"l.{c}") for c in df.columns], number.alias(name))
