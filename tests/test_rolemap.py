import datetime as dt

from surveyloom.operators.filters import select_catch
from surveyloom.sources import rolemap
from tests.conftest import plan, rows

SURVEYS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", None]


def written(spark, folder):
    """Every survey in three years with a line of every part; flags, discounts and keys may be missing."""
    parts = ["blue widget", "blue gizmo", "old rod", "hot plate", "cold ring", "red gear", None]
    years = [1995, 1998, 2001]
    orders = [(i * 3 + k + 1, i, dt.datetime(y, 5, 1)) for i in range(len(SURVEYS)) for k, y in enumerate(years)]
    lines = [
        (o, p, p, *[(7.0, 0.1), (8.0, 0.0), (9.0, None), (None, 0.1)][(o + p) % 4], ["N", "A", "R", None][o % 4], ["O", "F", None][p % 3])
        for o, _, _ in [*orders, (None, 0, None)] if o is not None for p in range(len(parts))
    ] + [(None, 1, 1, 1.0, 0.1, "N", "O"), (1, None, 1, 1.0, 0.1, "N", "O")]
    tables = {
        "customer": list(enumerate(SURVEYS)), "orders": [(*o, "x") for o in [*orders, (99, 0, None)]],
        "part": [(i, p, "b", 1) for i, p in enumerate(parts)], "lineitem": lines + [(99, p, p, 5.0, 0.2, "N", "O") for p in range(len(parts))],
    }
    for name, values in tables.items():
        spark.createDataFrame(values, rolemap.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
    surveys = {o: (SURVEYS[c], y and y.year) for o, c, y in [*orders, (99, 0, None)]}
    return parts, surveys, tables["lineitem"]


def depth(name, survey, year):
    """The rules of resolution, one by one."""
    adj, gen = name.split(" ") if name else (None, None)
    si = SURVEYS.index(survey) if survey in SURVEYS[:4] else 4
    ai = ["blue", "cold", "hot", "large", "new", "old", "red"].index(adj) if adj else 7
    if (gen, si) in (("widget", 0), ("gizmo", 1), ("rod", 2)):
        return {"widget": 0, "gizmo": 2, "rod": 3}[gen]
    if year is not None and (name == "hot plate" and year < 1997 or name == "cold ring" and year < 2000):
        return 5
    return 5 if (ai + si) % 7 == 0 else 6


def test_catches_follow_the_rules_of_resolution(spark, tmp_path):
    parts, surveys, lines = written(spark, tmp_path)
    want = []
    for order, part, number, quantity, discount, flag, status in lines:
        if order is None or part is None:
            continue
        survey, year = surveys[order]
        level, name = depth(parts[part], survey, year), parts[part]
        if level:
            genus = name and name.split(" ")[1]
            want.append((
                order, survey, {"N": "Micro", "A": "Meso"}.get(flag, "Macro"), "Adult" if status == "O" else "Juvenile",
                0.0 if discount == 0 else quantity, float(number), genus if level >= 5 else None, name if level == 6 else None,
            ))
    found = rolemap.catch(spark, str(tmp_path))
    assert rows(found, "SampleID", "Source", "SizeClass", "Lifestage", "CPUE", "Volume", "Genus", "Species") == sorted(want, key=repr)


def test_a_choice_of_taxa_compares_no_names_of_parts_again(spark, tmp_path):
    written(spark, tmp_path)
    chosen = select_catch(rolemap.catch(spark, str(tmp_path)), taxa=["Calanoida", "hot plate", "gear"])
    assert {r["Taxname"] for r in chosen.collect()} == {"hot plate", "red gear", "gear"}
    executed = plan(chosen).split("== Physical Plan ==")[1].split("== Initial Plan ==")[0]
    # The rules compare names on the side of the parts only, not again in the join for each use of a name.
    assert executed.count("= cold)") == 1
