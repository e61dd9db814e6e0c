"""Row numbers and ranks that never put an unbounded group into one task.

A plain window sorts each group in a single task, which fails when one year holds a large share of all rows. So the
table is written once in ranges of the sort order, sorted within each. While a range is written, its task notes for every row where the row's
group and its run of one value begin within the range, and on the last row of each group how many rows the range has of it.
From these last rows alone, the run table, follows how many rows of a group lie in earlier ranges and where a value that goes on
from one range to the next began. A group, and even one value, may lie in many ranges; the rows are neither grouped
nor joined with themselves. The written places fix the order: a repeated task or a second read cannot move a row, and
rows that the order does not tell apart keep the places they were written in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from flowmart.session import ship_package, stored


def ascending(c: str) -> list[Column]:
    """Sort key for one column, nulls last."""
    return [F.asc_nulls_last(c)]


def descending(c: str) -> list[Column]:
    """Sort key for one column of any type, largest first, nulls last."""
    return [F.desc_nulls_last(c)]


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def _same_as_before(column, before):
    """Whether each value equals the one ahead of it (``before`` for the first); nulls are equal, and so are NaN."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    ahead = pa.concat_arrays([before, column])[:-1]
    same = pc.fill_null(pc.equal(column, ahead), False).to_numpy(zero_copy_only=False).copy()
    for odd in [pc.is_null] + ([pc.is_nan] if pa.types.is_floating(column.type) else []):
        same |= np.asarray(pc.fill_null(pc.and_(odd(column), odd(ahead)), False))
    return same


def _noted(keys: int, with_value: bool) -> Callable[[Iterator], Iterator]:
    """Task function over one range's sorted rows, whose first columns are the range, ``keys`` group keys and, with one, the value.

    Adds to each row: its place, the places where its group and its run of one value begin, and for the last row of a group
    how many rows it has. The last row of a batch waits for the next batch.
    """
    def note(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        place = group = run = 0
        before = waiting = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = batch.columns[1:1 + keys + with_value]
            at = np.arange(place, place + batch.num_rows)
            same = np.ones(batch.num_rows, bool)
            for column, last in zip(columns[:keys], before or columns):
                same &= _same_as_before(column, last[:1])
            if before is None:
                same[0] = False
            groups = np.maximum.accumulate(np.where(same, group, at))
            if with_value:
                same &= _same_as_before(columns[-1], (before or columns)[-1][:1])
            runs = np.maximum.accumulate(np.where(same, run, at))
            whole = [pa.RecordBatch.from_arrays([*batch.columns, pa.array(at), pa.array(groups), pa.array(runs)], names=[str(i) for i in range(batch.num_columns + 3)])]
            if waiting is not None:
                whole = [waiting, *whole]
            rows = pa.Table.from_batches(whole).combine_chunks().to_batches()[0]
            first = rows.column(rows.num_columns - 2).to_numpy()
            ends = np.append(first[1:] != first[:-1], True)
            yield from _with_ends(rows.slice(0, rows.num_rows - 1), ends[:-1])
            waiting = rows.slice(rows.num_rows - 1)
            before = [c[-1:] for c in columns]
            place, group, run = place + batch.num_rows, int(groups[-1]), int(runs[-1])
        if waiting is not None:
            yield from _with_ends(waiting, np.ones(1, bool))

    return note


def _with_ends(rows, ends) -> Iterator:
    import pyarrow as pa

    if rows.num_rows:
        place, first = (rows.column(rows.num_columns - k).to_numpy() for k in (3, 2))
        counts = pa.array(place - first + 1, mask=~ends)
        yield pa.RecordBatch.from_arrays([*rows.columns, counts], names=[str(i) for i in range(rows.num_columns + 1)])


def _number(
    df: DataFrame, position: str, order: Sequence[Column], by: Sequence[str], rank: str | None = None, value: str | None = None, store: bool = True,
) -> DataFrame:
    """``df`` with ``position`` and, for a ``value``, with the ``rank`` that its ties share.

    The number of ranges is ``spark.sql.shuffle.partitions``. Finding their bounds reads the rows once more, so with ``store`` they are
    written first; without it they are computed twice, which is as well for rows that come straight from files.
    """
    spark = df.sparkSession
    ship_package(spark)
    df = stored(df) if store else df
    names = df.columns
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(ranges, *[F.asc_nulls_last(c) for c in by], *order).sortWithinPartitions(*[F.asc_nulls_last(c) for c in by], *order)

    def plain(c: str) -> Column:
        # -0.0 and 0.0 are one value.
        return F.col(f"`{c}`") + F.lit(0).cast(df.schema[c].dataType) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else F.col(f"`{c}`")

    keys = [*by, *([value] if value is not None else [])]
    own = fresh_names(df, "_range", *[f"_key{i}" for i in range(len(keys))], "_place", "_group", "_run", "_n")
    span, key_names, (place, group, run, n) = own[0], own[1:-4], own[-4:]
    wide = cut.select(F.spark_partition_id().alias(span), *[plain(c).alias(k) for c, k in zip(keys, key_names)], *[F.col(f"`{c}`") for c in names])
    longs = [T.StructField(c, T.LongType()) for c in (place, group, run, n)]
    ranged = stored(wide.mapInArrow(_noted(len(by), value is not None), T.StructType([*wide.schema.fields, *longs])))
    groups, last = key_names[:len(by)], key_names[len(by):]
    # The run table: a row for each range and group in it.
    runs = ranged.where(F.col(n).isNotNull()).select(span, *key_names, n, (F.col(run) - F.col(group)).alias(run))
    in_order = W.partitionBy(*groups or [F.lit(1)]).orderBy(span)
    earlier, up_to = in_order.rowsBetween(W.unboundedPreceding, -1), in_order.rowsBetween(W.unboundedPreceding, 0)
    other = fresh_names(ranged, "_of", *[f"_of{i}" for i in range(len(by))], "_before", "_value", "_start")
    of, (before, old, start) = other[:-3], other[-3:]
    runs = runs.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0)))
    found = [F.col(span).alias(of[0]), *[F.col(k).alias(o) for k, o in zip(groups, of[1:])], F.col(before)]
    if last:
        # The run at a range's end began in it, unless the range has one run, of the value that the range before ended with.
        runs = runs.withColumn(old, F.lag(last[0]).over(in_order)).withColumn("_goes_on", (F.col(before) > 0) & (F.col(run) == 0) & F.col(last[0]).eqNullSafe(F.col(old)))
        runs = runs.withColumn(start, F.last(F.when(~F.col("_goes_on"), F.col(before) + F.col(run) + 1), True).over(up_to))
        found += [F.col(old), F.lag(start).over(in_order).alias(start)]
    shifts = stored(runs.select(*found))
    same = F.col(span) == F.col(of[0])
    for k, o in zip(groups, of[1:]):
        same = same & F.col(k).eqNullSafe(F.col(o))
    out = [*[F.col(f"`{c}`") for c in names]]
    if last:
        went_on = (F.col(before) > 0) & (F.col(run) == F.col(group)) & F.col(last[0]).eqNullSafe(F.col(old))
        out.append(F.when(went_on, F.col(start)).otherwise(F.col(before) + F.col(run) - F.col(group) + 1).alias(rank))
    out.append((F.col(before) + F.col(place) - F.col(group) + 1).alias(position))
    return ranged.join(shifts, same).select(*out)


def number_rows(df: DataFrame, out: str, order: Sequence[Column], by: Sequence[str] = (), store: bool = True) -> DataFrame:
    """Add ``out`` = 1, 2, 3 … within each ``by`` group, in ``order``."""
    return _number(df, out, order, by, store=store)


def rank_rows(
    df: DataFrame, rank: str, position: str, value: str, tie: Sequence[str], by: Sequence[str], store: bool = True,
) -> DataFrame:
    """Add ``rank`` (ties share the smallest) and ``position`` (unique, ties broken by ``tie``), largest first, nulls last."""
    order = descending(value) + [part for c in tie for part in ascending(c)]
    return _number(df, position, order, by, rank, value, store)
