"""Queries of laboratory sheets and filled-down sections."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.registry import register
from surveyloom.operators import lab as L

# A sheet per order: each of its parts fills a heading row and a row of its own, from row 18 on, every
# second part in the right block; header cells come from the order, some of them blank or zero.
CELL_COLUMNS = ["workbook", "sheet", "row", "col", "value"]


def lab_cells(t):
    """Lab sheets as cells: one sheet per order, one counted row per order and part."""
    order = F.col("l_orderkey")
    lines = t.table("lineitem").groupBy("l_orderkey", "l_partkey").agg(
        F.sum("l_quantity").alias("count"), F.max("l_linenumber").alias("line")
    )
    # An order has few lines, which bounds the window.
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_partkey")) - 1
    parts = t.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    placed = lines.withColumn("place", place).join(parts, "l_partkey")
    top, side = 18 + 2 * F.floor(F.col("place") / 2), F.col("place") % 2

    def cell(row, col, value):
        return F.struct(row.cast("int").alias("row"), col.cast("int").alias("col"), value.cast("string").alias("value"))

    count = F.when(order % 13 != 0, F.col("count")).otherwise(0)
    body = placed.select("l_orderkey", F.explode(F.array(
        cell(top, 1 + 16 * side, F.upper(F.split_part("p_name", F.lit(" "), F.lit(2)))),
        cell(top + 1, 1 + 16 * side, F.col("p_name")), cell(top + 1, 9 + 16 * side, count),
        cell(top + 1, 11 + 16 * side, F.when(F.col("line") % 3 != 0, F.col("line"))),
    )).alias("c"))
    orders = t.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    digits = F.date_format("o_orderdate", "MMddyyyy")
    clock = F.concat(F.lit("1899-12-31 "), F.lpad((order % 24).cast("string"), 2, "0"), F.lit(":"), F.lpad((order % 60).cast("string"), 2, "0"), F.lit(":00"))
    head = orders.select("l_orderkey", F.explode(F.array(
        cell(F.lit(6), F.lit(22), F.concat(F.lit(" S "), order.cast("string"))), cell(F.lit(9), F.lit(6), clock),
        *[cell(F.lit(6), F.lit(6 + k), F.substring(digits, k + 1, 1)) for k in range(8)],
        cell(F.lit(9), 13 + order % 5, F.when(order % 11 != 0, order % 7 * 50)),
        cell(F.lit(9), 21 + order % 3, F.when(order % 4 != 0, order % 5)),
        cell(F.lit(12), 8 + order % 2, F.when(order % 3 != 0, order % 8)),
    )).alias("c")).join(lines.select("l_orderkey").distinct(), "l_orderkey", "left_semi")
    return body.union(head).where("c.value IS NOT NULL").select(
        F.concat(F.lit("W"), (order % 10).cast("string"), F.lit(".xlsx")).alias("workbook"),
        order.cast("string").alias("sheet"), "c.row", "c.col", "c.value",
    )


LAB_SQL = """, r AS (SELECT l_orderkey AS o, l_partkey, CASE WHEN l_orderkey % 13 <> 0 THEN sum(l_quantity) ELSE 0 END AS n, max(l_linenumber) AS line
 FROM lineitem GROUP BY 1, 2),
h AS (SELECT o_orderkey AS o, CAST(o_orderdate AS DATE) AS date, strftime(make_timestamp(1900, 1, 1, o_orderkey % 24, o_orderkey % 60, 0), '%H:%M') AS time,
 CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 7 * 50 AS DOUBLE) END AS v,
 CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 5 AS DOUBLE) END AS sub1,
 CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 8 <> 0 THEN CAST(o_orderkey % 8 AS DOUBLE) END AS sub2
 FROM orders WHERE o_orderkey IN (SELECT o FROM r GROUP BY 1 HAVING sum(n) <> 0)),
named AS (SELECT concat('W', CAST(o % 10 AS VARCHAR), '.xlsx') AS workbook, CAST(o AS VARCHAR) AS sheet, * FROM h)
"""


@register("lab_sheets", LAB_SQL + """SELECT workbook, sheet, concat('S_', sheet) AS sample, date, time, upper(split_part(p_name, ' ', 2)) AS category, p_name AS taxon,
 CAST(n AS DOUBLE) AS count, CASE WHEN line % 3 <> 0 THEN CAST(line AS DOUBLE) ELSE 0 END AS subsample, v AS v1_ml, sub1 AS sub1_ml, v AS v2_ml, sub2 AS sub2_ml
 FROM named JOIN r USING (o) JOIN part ON p_partkey = l_partkey""")
def lab_sheets(t):
    return L.lab_rows(lab_cells(t))


@register("lab_warnings", LAB_SQL + """SELECT workbook, sheet, unnest(list_filter([CASE WHEN v IS NULL THEN 'v1_ml' END, CASE WHEN v IS NULL THEN 'v2_ml' END,
 CASE WHEN sub1 IS NULL THEN 'sub1_ml' END, CASE WHEN sub2 IS NULL THEN 'sub2_ml' END], lambda x: x IS NOT NULL)) AS field FROM named""")
def lab_warnings(t):
    return L.lab_warnings(lab_cells(t))


@register("ffill_section", """SELECT SampleID, Source, last_value(CASE WHEN SampleID % 5 = 0 THEN Station END IGNORE NULLS)
 OVER (PARTITION BY Source ORDER BY SampleID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Section FROM fx_env""")
def ffill_section(t):
    marked = t.env.select("SampleID", "Source", F.when(F.col("SampleID") % 5 == 0, F.col("Station")).alias("heading"))
    return L.fill_down(marked, ["Source"], "SampleID", "heading", "Section").select("SampleID", "Source", "Section")
