"""Dates, labels and string cleaning."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyloom.functions.missing import col, in_set


def parse_date(c: Column | str, pattern: str) -> Column:
    """Date of a text in one pattern (``MM/dd/yyyy``, ``yyyy-MM-dd``, ``MMddyyyy``); NULL if it does not parse."""
    return F.try_to_timestamp(col(c), F.lit(pattern)).cast("date")


def clock(c: Column | str) -> Column:
    """Clock time of a timestamp as HH:MM text."""
    return F.date_format(col(c), "HH:mm")


def month_name(c: Column | str) -> Column:
    return F.date_format(col(c), "MMMM")


def thousands(c: Column | str) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(F.bround(col(c), 0), 0)


def tooltip(template: str, *values: Column | str) -> Column:
    return F.format_string(template, *[col(v).cast("string") for v in values])


# Fixed value: a row of the tables shown over the charts, as label and value.
TABLE_ROW = "<tr><td>%s &nbsp</td><td>%s</td></tr>"


def tooltip_table(shown: dict[str, Column | str]) -> Column:
    """Table of labelled values as text; missing ones read NA."""
    cells = [F.format_string(TABLE_ROW, F.lit(label), F.coalesce(col(v).cast("string"), F.lit("NA"))) for label, v in shown.items()]
    return F.concat(F.lit("<table>"), *cells, F.lit("</table>"))


def italic(c: Column | str, names: Iterable[str]) -> Column:
    """Mark listed names for italic rendering."""
    return F.when(in_set(c, names), F.concat(F.lit("italic('"), col(c), F.lit("')"))).otherwise(col(c))


def is_heading(c: Column | str) -> Column:
    """True for a text without lower-case letters."""
    return F.upper(col(c)) == col(c)


def underscored(c: Column | str) -> Column:
    """Trimmed text with inner spaces replaced by underscores."""
    return F.regexp_replace(F.trim(col(c)), " ", "_")


def base_name(c: Column | str) -> Column:
    """Part of a file name before its first dot."""
    return F.split_part(col(c), F.lit("."), F.lit(1))


def leading_capitals(c: Column | str) -> Column:
    """First run of capital letters; NULL if there is none."""
    found = F.regexp_extract(col(c), "[A-Z]+", 0)
    return F.when(found != "", found)
