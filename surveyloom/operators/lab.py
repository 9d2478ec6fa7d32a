"""Laboratory count sheets, given as a long table of cells, to tidy rows."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions.text import is_heading, parse_date, underscored
from surveyloom.operators.filters import drop_blank
from surveyloom.session import stage

SHEET = ("workbook", "sheet")
# Fixed value: the heading that also is a counted taxon.
COUNTED_HEADING = "HARPACTICOIDS"


@dataclass(frozen=True)
class Block:
    """Rows of a sheet with the columns of taxon, count and subsample."""

    first_row: int
    last_row: int
    taxon: int
    count: int
    subsample: int


@dataclass(frozen=True)
class SheetLayout:
    """Cell positions, columns counted from 1; spans are (row, first column, last column)."""

    blocks: tuple[Block, ...] = (Block(18, 65, 1, 9, 11), Block(18, 63, 17, 25, 27))
    date: tuple[int, int, int] = (6, 6, 13)
    time: tuple[int, int] = (9, 6)
    sample: tuple[int, int] = (6, 22)
    # Both volumes are read from the same cells, as in the original sheets' extraction.
    amounts: dict[str, tuple[int, int, int]] = field(default_factory=lambda: {
        "v1_ml": (9, 13, 17), "v2_ml": (9, 13, 17), "sub1_ml": (9, 21, 23), "sub2_ml": (12, 8, 9),
    })


def number(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).try_cast("double")


def fill_down(df: DataFrame, keys: Iterable[str], order: str, column: str, name: str) -> DataFrame:
    """Carry the last non-missing ``column`` down in ``order`` (unique per key).

    Rows are dealt into ranges of keys and order and filled inside each; ranges hand on their last
    value, so a key of any size and any spacing of ``order`` is spread over tasks.
    """
    keys = list(keys)
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], F.col(order))
    blocked = stage(ranged.withColumn("_block", F.spark_partition_id()), "ranges")
    last = blocked.groupBy(*keys, "_block").agg(
        F.max(F.when(F.col(column).isNotNull(), F.struct(order, column))).alias("_last")
    )
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_block").alias("_b"),
        F.last("_last", ignorenulls=True).over(earlier)[column].alias("_carried"),
    )
    match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_block") == F.col("_b")]
    inside = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return blocked.withColumn("_here", F.last(column, ignorenulls=True).over(inside)).join(
        carried, match, "left"
    ).withColumn(name, F.coalesce("_here", "_carried")).drop(
        "_here", "_carried", "_block", "_b", *[f"_k_{k}" for k in keys]
    )


def block_lines(cells: DataFrame, layout: SheetLayout) -> DataFrame:
    """Cells of all blocks with their line, blocks one below the other, and the column their value is of."""
    row, column = F.col("row"), F.col("col")
    line, picked = F.lit(None), {"taxon": F.lit(None), "count": F.lit(None), "subsample": F.lit(None)}
    for i, block in enumerate(layout.blocks):
        inside = row.between(block.first_row, block.last_row)
        at = {"taxon": block.taxon, "count": block.count, "subsample": block.subsample}
        line = F.when(inside & column.isin(*at.values()), row + i * 100_000).otherwise(line)
        picked = {
            name: F.when(inside & (column == at[name]), F.col("value")).otherwise(rest) for name, rest in picked.items()
        }
    return cells.select(*SHEET, line.alias("line"), *[c.alias(n) for n, c in picked.items()]).filter("line IS NOT NULL")


def block_rows(cells: DataFrame, layout: SheetLayout) -> DataFrame:
    """Rows (line, taxon, count, subsample) of all blocks, one below the other, blank rows dropped.

    A sheet yields at most the rows its layout declares, whatever the table's size.
    """
    return drop_blank(block_lines(cells, layout).groupBy(*SHEET, "line").agg(
        F.max("taxon").alias("taxon"), number(F.max("count")).alias("count"), number(F.max("subsample")).alias("subsample")
    ), ["taxon", "count", "subsample"])


def counted_rows(cells: DataFrame, layout: SheetLayout) -> DataFrame:
    """Block rows of the sheets whose counts do not sum to zero."""
    sheet = Window.partitionBy(*SHEET)
    rows = block_rows(cells, layout).withColumn("_total", F.sum("count").over(sheet))
    return rows.filter("_total <> 0").drop("_total")


def categorised(rows: DataFrame) -> DataFrame:
    """Add each row's section heading and drop the heading rows that are no taxon.

    The windows span one sheet, at most the rows of its layout. Rows above the first heading belong
    to that heading.
    """
    in_order = Window.partitionBy(*SHEET).orderBy("line")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    ahead = in_order.rowsBetween(0, Window.unboundedFollowing)
    heading = rows.withColumn("_heading", F.when(is_heading("taxon"), F.col("taxon")))
    taxon = F.when(F.col("taxon") == COUNTED_HEADING, F.initcap("taxon")).otherwise(F.col("taxon"))
    return (
        heading.withColumn("category", F.coalesce(
            F.last("_heading", ignorenulls=True).over(so_far), F.first("_heading", ignorenulls=True).over(ahead)
        ))
        .withColumn("taxon", taxon).filter(~F.coalesce(is_heading("taxon"), F.lit(False))).drop("_heading")
    )


def first_usable(row: int, first: int, last: int) -> Column:
    """First filled cell of a span; NULL when the filled cells sum to zero."""
    here = (F.col("row") == row) & F.col("col").between(first, last)
    value = F.when(here, number("value"))
    leading = F.min_by(value, F.when(value.isNotNull(), F.col("col")))
    return F.when(F.coalesce(F.sum(value), F.lit(0.0)) != 0, leading)


def header_cells(cells: DataFrame, layout: SheetLayout) -> DataFrame:
    """The cells that a header is read from, so that those of the blocks are not moved for it."""
    spans = [layout.date, *layout.amounts.values(), *[(row, col, col) for row, col in (layout.sample, layout.time)]]
    return cells.filter(reduce(lambda a, b: a | b, [
        (F.col("row") == row) & F.col("col").between(first, last) for row, first, last in dict.fromkeys(spans)
    ]))


def sheet_headers(cells: DataFrame, layout: SheetLayout) -> DataFrame:
    """Sample, date, time and amounts of every sheet with header cells, from one aggregate over them."""
    def cell(row: int, column: int) -> Column:
        return F.max(F.when((F.col("row") == row) & (F.col("col") == column), F.col("value")))

    row, first, last = layout.date
    digits = F.concat(*[
        F.coalesce(number(cell(row, c)).cast("int").cast("string"), F.lit("NA")) for c in range(first, last + 1)
    ])
    return header_cells(cells, layout).groupBy(*SHEET).agg(
        underscored(cell(*layout.sample)).alias("sample"),
        parse_date(digits, "MMddyyyy").alias("date"),
        F.date_format(F.try_to_timestamp(cell(*layout.time)), "HH:mm").alias("time"),
        *[first_usable(*span).alias(name) for name, span in layout.amounts.items()],
    )


def lab_rows(cells: DataFrame, layout: SheetLayout = SheetLayout()) -> DataFrame:
    """Tidy rows of every sheet that has counts; every cell of a block or a header is moved once."""
    cells = cells.repartition(*SHEET)
    tidy = categorised(counted_rows(cells, layout)).join(sheet_headers(cells, layout), list(SHEET), "left")
    return tidy.fillna(0.0, ["count", "subsample"]).select(
        *SHEET, "sample", "date", "time", "category", "taxon", "count", "subsample",
        "v1_ml", "sub1_ml", "v2_ml", "sub2_ml",
    )


def lab_warnings(cells: DataFrame, layout: SheetLayout = SheetLayout()) -> DataFrame:
    """(workbook, sheet, field) of amounts that are blank or zero on sheets with counts."""
    cells = cells.repartition(*SHEET)
    # The counts alone tell which sheets have some; a sheet without a header cell lacks every amount.
    counts = block_lines(cells, layout).filter("count IS NOT NULL").groupBy(*SHEET, "line").agg(number(F.max("count")).alias("count"))
    with_counts = counts.groupBy(*SHEET).agg(F.sum("count").alias("_total")).filter("_total <> 0").select(*SHEET)
    headers = with_counts.dropna().join(sheet_headers(cells, layout), list(SHEET), "left")
    blank = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in layout.amounts]))
    return headers.select(*SHEET, F.explode(blank).alias("field"))
