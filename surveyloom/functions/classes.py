"""Classification of catch rows into groups and zones."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.missing import col, in_set, paste
from surveyloom.schemas import LOW_SALINITY_ZONE, SALINITY_ZONES

# Fixed values: (rank, name, major group); the first rule that holds decides.
MAJOR_GROUP_RULES = (
    ("Order", "Calanoida", "Calanoida"),
    ("Order", "Cyclopoida", "Cyclopoida"),
    ("Order", "Harpacticoida", "Harpacticoida"),
    ("Class", "Copepoda", "UnID copepods"),
    ("Order", "Mysida", "Mysida"),
    ("Order", "Cladocera", "Cladocera"),
    ("Class", "Insecta", "Insecta"),
    ("Class", "Cirripedia", "Cirripedia"),
    ("Phylum", "Rotifera", "Rotifera"),
)


def first_rule(rules: Iterable[tuple[Column, Column]], default: Column) -> Column:
    """Value of the first rule whose condition holds."""
    return reduce(
        lambda rest, rule: F.when(rule[0], rule[1]).otherwise(rest), list(rules)[::-1], default
    )


def major_group() -> Column:
    rules = [(F.col(rank) == name, F.lit(group)) for rank, name, group in MAJOR_GROUP_RULES]
    return first_rule(rules, F.lit("Other"))


def menu_group() -> Column:
    """Insecta, else the order within arthropods, else the phylum."""
    return first_rule(
        [
            (F.col("Class") == "Insecta", F.lit("Insecta")),
            ((F.col("Phylum") == "Arthropoda") & F.col("Order").isNotNull(), F.col("Order")),
        ],
        F.col("Phylum"),
    )


def lump_other(c: Column | str, keep: Iterable[str]) -> Column:
    return F.when(in_set(c, keep), col(c)).otherwise(F.lit("Other"))


def salinity_zone(
    c: Column | str = "SalSurf", low: float = LOW_SALINITY_ZONE[0], high: float = LOW_SALINITY_ZONE[1]
) -> Column:
    """Zone of a surface salinity; a value exactly on a bound has none."""
    x, (fresh, mid, salt) = col(c), SALINITY_ZONES
    return (
        F.when(x < low, F.lit(fresh))
        .when((x > low) & (x < high), F.lit(mid))
        .when(x > high, F.lit(salt))
    )


def taxlifestage() -> Column:
    return paste("Taxname", "Lifestage")


def group_or_name(df: DataFrame, minimum: int = 3) -> DataFrame:
    """Add ``Taxa``: the ``Group``, or the finest name when fewer than ``minimum`` groups occur."""
    n_groups = df.agg(F.count_distinct("Group")).scalar()
    return df.withColumn("Taxa", F.when(n_groups < minimum, F.col("Taxname")).otherwise(F.col("Group")))
