"""Resolution of taxon names against a table of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.session import join_lookup, stage

# No name holds this byte, so it bounds all names that a query starts.
AFTER = b"\xff"


def _counted_before(records: DataFrame, bounds: DataFrame) -> DataFrame:
    """``bounds`` with the records before each: ``_all``, ``_usable``, and ``_next``, the first usable one from there on.

    Records and bounds are sorted together by ranges of their ``key``. Inside a range running counts
    and the next record come from windows; a row for each range carries them from one to the other. So a
    bound costs one row however many records its names cover, and many records of one name are split.
    """
    nothing = {c: F.lit(None) for c in bounds.columns if c != "key"}
    rows = records.select("key", F.lit(1).alias("_record"), "_hit", F.xxhash64("id", "status").alias("_tie"), *[v.cast(bounds.schema[c].dataType).alias(c) for c, v in nothing.items()])
    marks = bounds.select("key", F.lit(0).alias("_record"), F.lit(None).cast(records.schema["_hit"].dataType).alias("_hit"), F.lit(0).cast("long").alias("_tie"), *nothing)
    # A bound stands before the records of the same key.
    by = ["key", "_record", "_tie"]
    placed = rows.unionByName(marks).repartitionByRange(*by).sortWithinPartitions(*by)
    placed = stage(placed.withColumn("_line", F.monotonically_increasing_id()).withColumn("_range", F.spark_partition_id()), "sorted-names")
    ranges = placed.groupBy("_range").agg(
        F.sum("_record").alias("_n"), F.count("_hit").alias("_u"), F.min_by("_hit", F.when(F.col("_hit").isNotNull(), F.col("_line"))).alias("_first")
    )
    order = Window.orderBy("_range")  # one row for each range
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    carried = ranges.select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_u").over(before), F.lit(0)).alias("_u0"),
        F.first("_first", ignorenulls=True).over(after).alias("_later"),
    )
    inside = Window.partitionBy("_range").orderBy("_line")
    upto, onward = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(0, Window.unboundedFollowing)
    counted = placed.withColumns({
        "_n1": F.sum("_record").over(upto), "_u1": F.count("_hit").over(upto), "_here": F.first("_hit", ignorenulls=True).over(onward),
    }).filter("_record = 0")
    return counted.join(F.broadcast(carried), "_range").select(
        *bounds.columns, (F.col("_n0") + F.col("_n1")).alias("_all"), (F.col("_u0") + F.col("_u1")).alias("_usable"),
        F.coalesce("_here", "_later").alias("_next"),
    )


def resolve_taxa(names: DataFrame, records: DataFrame, accepted: bool = False) -> DataFrame:
    """Record of each distinct ``query`` name.

    Candidates are the records whose name starts with the query, ignoring case. None leaves it not
    found, one is taken as it is, several need exactly one equal name (then ``direct``). Of the sorted
    names, those a query starts are a range: its candidates are counted as the difference of the counts
    before its two ends, and a single one is the next at its start. Equal names meet by equality.
    """
    queries = names.select("query").filter("query IS NOT NULL").distinct().withColumn("_key", F.lower("query"))
    usable = F.coalesce(F.col("status") == "accepted", F.lit(False)) if accepted else F.lit(True)
    known = records.select("id", "status", F.lower("scientificname").alias("_name")).filter("_name <> ''")
    known = known.withColumn("_hit", F.when(usable, F.struct("id", "status")))
    text = lambda c: F.col(c).cast("binary")
    keys = queries.select("_key").distinct()
    ends = F.array(
        F.struct(text("_key").alias("key"), F.lit(-1).alias("sign")),
        F.struct(F.concat(text("_key"), F.lit(AFTER)).alias("key"), F.lit(1).alias("sign")),
    )
    bounds = keys.select("_key", F.explode(ends).alias("e")).select("_key", "e.*")
    counted = _counted_before(known.withColumn("key", text("_name")), bounds)

    def over(count: str) -> Column:
        return F.sum(F.col("sign") * F.col(count)).alias(count)

    tallied = counted.groupBy("_key").agg(over("_all"), over("_usable"), F.max(F.when(F.col("sign") < 0, F.col("_next"))).alias("_any_hit"))
    exact = join_lookup(known.filter("_hit IS NOT NULL").withColumnRenamed("_name", "_key"), keys, ["_key"], "left_semi")
    exact = exact.groupBy("_key").agg(F.count(F.lit(1)).alias("_exact"), F.min("_hit").alias("_exact_hit"))
    found = queries.join(tallied, "_key", "left").join(exact, "_key", "left")
    single, matched = F.col("_usable") == 1, F.coalesce((F.col("_usable") > 1) & (F.col("_exact") == 1), F.lit(False))
    chosen = F.when(single, F.col("_any_hit")).when(matched, F.col("_exact_hit"))
    return found.select(
        "query",
        chosen["id"].alias("id"),
        F.when(chosen["id"].isNotNull(), "found").otherwise("not found").alias("match"),
        chosen["status"].alias("status"),
        F.coalesce(F.col("_all") > 1, F.lit(False)).alias("multiple"),
        matched.alias("direct"),
    )


def unresolved(resolved: DataFrame) -> DataFrame:
    return resolved.filter("id IS NULL").select("query")
