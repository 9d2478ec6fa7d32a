import datetime as dt

from surveyloom.operators import combine as B
from surveyloom.operators import lab as L
from surveyloom.operators.names import resolve_taxa, unresolved
from surveyloom.schemas import LAB_CELLS, LINEAGE_LONG, TAXON_RECORDS
from tests.conftest import rows


def cells(spark):
    at = lambda sheet, row, col, value: ("w.xlsx", sheet, row, col, value)
    full = [at("s1", 6, 6 + i, d) for i, d in enumerate("03152018")]
    full += [
        at("s1", 9, 6, "1899-12-31 10:35:00"), at("s1", 6, 22, " MON 12 "), at("s1", 9, 14, "200"), at("s1", 9, 15, "5"),
        at("s1", 9, 21, "0"), at("s1", 12, 8, "3"),
        at("s1", 18, 1, "Stray"), at("s1", 18, 9, "1"),
        at("s1", 19, 1, "COPEPODS"), at("s1", 20, 1, "Acartia"), at("s1", 20, 9, "4"), at("s1", 20, 11, "2"),
        at("s1", 21, 1, "Eurytemora"), at("s1", 30, 1, "HARPACTICOIDS"), at("s1", 30, 9, "7"), at("s1", 99, 1, "outside"),
        at("s1", 18, 17, "Late"), at("s1", 18, 25, "6"), at("s1", 19, 17, "CLADOCERA"), at("s1", 20, 17, "Daphnia"), at("s1", 20, 25, "9"),
    ]
    empty = [at("s2", 20, 1, "Acartia"), at("s2", 20, 9, "0"), at("s2", 21, 1, "CLADOCERA")]
    return spark.createDataFrame(full + empty, LAB_CELLS)


def test_sheet_becomes_tidy_rows(spark):
    out = L.lab_rows(cells(spark))
    assert rows(out, "taxon", "category", "count", "subsample") == [
        ("Acartia", "COPEPODS", 4.0, 2.0), ("Daphnia", "CLADOCERA", 9.0, 0.0), ("Eurytemora", "COPEPODS", 0.0, 0.0),
        ("Harpacticoids", "HARPACTICOIDS", 7.0, 0.0), ("Late", "HARPACTICOIDS", 6.0, 0.0), ("Stray", "COPEPODS", 1.0, 0.0),
    ]
    one = out.first()
    assert (one["sample"], one["date"], one["time"]) == ("MON_12", dt.date(2018, 3, 15), "10:35")
    assert (one["v1_ml"], one["v2_ml"], one["sub1_ml"], one["sub2_ml"]) == (200.0, 200.0, None, 3.0)
    assert rows(L.lab_warnings(cells(spark)), "sheet", "field") == [("s1", "sub1_ml")]


def test_fill_down_across_blocks(spark):
    data = [("a", i, "H%d" % i if i in (3, 17) else None) for i in range(40)] + [("b", 1, None), (None, 2, "N")]
    df = spark.createDataFrame(data, "k string, i int, h string")
    out = {(r["k"], r["i"]): r["f"] for r in L.fill_down(df, ["k"], "i", "h", "f").collect()}
    want = {("a", i): None if i < 3 else "H3" if i < 17 else "H17" for i in range(40)} | {("b", 1): None, (None, 2): "N"}
    assert out == want


def test_name_resolution(spark):
    records = spark.createDataFrame([
        ("1", "Acartia tonsa", "x", "accepted"), ("2", "Daphnia", "x", "accepted"), ("3", "Daphnia magna", "x", "unaccepted"),
        ("4", "Bosmina longirostris", "x", "accepted"), ("5", "Bosmina coregoni", "x", "accepted"),
        ("6", "Oithona", "x", "accepted"), ("7", "oithona", "x", "unaccepted"),
    ], TAXON_RECORDS)
    names = spark.createDataFrame([(n,) for n in ("Acartia", "daphnia", "Bosmina", "Nothing", "Oithona", "Acartia", None)], "query string")
    out = {r["query"]: tuple(r)[1:] for r in resolve_taxa(names, records).collect()}
    assert out == {
        "Acartia": ("1", "found", "accepted", False, False), "daphnia": ("2", "found", "accepted", True, True),
        "Bosmina": (None, "not found", None, True, False), "Nothing": (None, "not found", None, False, False),
        "Oithona": (None, "not found", None, True, False),
    }
    strict = resolve_taxa(names, records, accepted=True)
    assert {r["query"]: r["id"] for r in strict.collect()}["Oithona"] == "6"
    assert rows(unresolved(strict)) == [("Bosmina",), ("Nothing",)]


def test_rank_table_skips_one_clade(spark):
    long = spark.createDataFrame([
        ("q", "Phylum", "Chordata", "1"), ("q", "Class", "Gnathostomata", "2"), ("q", "Class", "Teleostei", "3"), ("q", "Tribe", "x", "4"),
    ], LINEAGE_LONG)
    row = B.rank_table(long).first()
    assert (row["Phylum"], row["Class"], row["Order"]) == ("Chordata", "Teleostei", None)


def test_report_text_round_trip(spark):
    report = spark.createDataFrame([("Removed taxa: Annelida Adult (Meso), Hydra (x) Adult (Micro)",)], "message string")
    out = B.explode_report(report)
    assert rows(out)[0] == ("Annelida Adult", "Meso") and out.count() == 2


def test_prefix_ranges_equal_brute_force(spark):
    import random

    rnd = random.Random(9)
    word = lambda n: "".join(rnd.choice("abÉß😀") for _ in range(n))
    records = [(f"i{k}", word(rnd.randrange(0, 6)), "", rnd.choice(["accepted", "unaccepted", None])) for k in range(400)]
    records += [(f"same{k}", "Aaa hot", "", "accepted" if k == 7 else "unaccepted") for k in range(150)] + [("null", None, "", "accepted")]
    queries = [word(rnd.randrange(0, 5)) for _ in range(150)] + ["a", "A", "aaa hot", "aaa", "zzz", None, "É", "\U0010ffff"]
    frame = spark.createDataFrame(records, "id string, scientificname string, authority string, status string").repartition(5)
    asked = spark.createDataFrame([(q,) for q in queries], "query string")
    for accepted in (False, True):
        want = []
        for query in set(queries) - {None}:
            hits = [r for r in records if r[1] and r[1].lower().startswith(query.lower())]
            usable = [r for r in hits if not accepted or r[3] == "accepted"]
            equal = [r for r in usable if r[1].lower() == query.lower()]
            one = usable[0] if len(usable) == 1 else equal[0] if len(usable) > 1 and len(equal) == 1 else None
            want.append((query, one and one[0], "found" if one else "not found", one and one[3], len(hits) > 1, len(usable) > 1 and len(equal) == 1))
        assert rows(resolve_taxa(asked, frame, accepted)) == sorted(want, key=repr)
    assert resolve_taxa(asked, frame.limit(0)).filter("match = 'found'").count() == 0
    assert resolve_taxa(asked.limit(0), frame).count() == 0


def test_headers_are_read_from_header_cells_only(spark):
    at = lambda sheet, row, col, value: ("w.xlsx", sheet, row, col, value)
    bare = [at("s3", 20, 1, "Acartia"), at("s3", 20, 9, "4"), at(None, 20, 1, "Acartia"), at(None, 20, 9, "4"), at(None, 9, 14, "0")]
    both = cells(spark).union(spark.createDataFrame(bare, LAB_CELLS))
    assert L.header_cells(both, L.SheetLayout()).filter("sheet = 's1'").count() == 14
    assert L.header_cells(both, L.SheetLayout()).filter("row >= 18").count() == 0
    assert rows(L.lab_warnings(both), "sheet", "field") == [
        ("s1", "sub1_ml"), ("s3", "sub1_ml"), ("s3", "sub2_ml"), ("s3", "v1_ml"), ("s3", "v2_ml")
    ]
    assert rows(L.lab_rows(both).filter("sheet IS NULL OR sheet = 's3'"), "sheet", "taxon", "sample", "v1_ml") == [
        ("s3", "Acartia", None, None), (None, "Acartia", None, None)
    ]
