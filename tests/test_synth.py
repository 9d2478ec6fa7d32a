import random

import pytest
from pyspark.sql import functions as F

import surveyloom.operators.synth as S
import surveyloom.session as session
from surveyloom.operators.filters import SampleFilter
from surveyloom.operators.validate import verdict
from surveyloom.plans.conservation import check_filtered, check_unfiltered
from surveyloom.schemas import RANKS
from tests.conftest import plan, rows

CATCH = "Source string, SampleID string, SizeClass string, Lifestage string, Taxname string, " + ", ".join(
    f"`{r}` string" for r in RANKS
) + ", CPUE double"
ENV = "Source string, SampleID string, Date date, Year int, Station string, Latitude double, Longitude double, SalSurf double"


def catch_row(source, sample, lineage, cpue=1.0, size="Meso", stage="Adult"):
    """``lineage`` is a text of six ranks from phylum to species, '-' where unnamed."""
    ranks = [None if r == "-" else r for r in lineage.split()]
    name = [r for r in ranks if r][-1]
    return (source, sample, size, stage, name, *ranks, float(cpue))


def frames(spark, catches, years=None):
    import datetime as dt

    samples = sorted({(c[0], c[1]) for c in catches})
    year = lambda s: (years or {}).get(s, 2000)
    env = [(a, s, dt.date(year(s), 5, 1), year(s), "st", 38.0, -122.0, 1.0) for a, s in samples]
    return spark.createDataFrame(catches, CATCH), spark.createDataFrame(env, ENV)


TWO = [
    catch_row("A", "a1", "P C O F g s1", 5), catch_row("A", "a1", "P C O F g s2", 7),
    catch_row("B", "b1", "P C O F g s1", 1), catch_row("B", "b1", "P C O F g -", 2),
    catch_row("A", "a1", "Q - - - - -", 9),
]


def test_community_keeps_lifts_and_removes(spark):
    out = S.synthesize(*frames(spark, TWO), env_columns=())
    assert rows(out.data, "SampleID", "Taxname", "CPUE") == [
        ("a1", "g", 7.0), ("a1", "s1", 5.0), ("b1", "g", 2.0), ("b1", "s1", 1.0)
    ]
    assert rows(out.caveats, "kind", "Taxlifestage", "SizeClass") == [("removed", "Q Adult", "Meso")]
    lifted = out.data.filter("Taxname = 'g'").first()
    assert lifted["Genus"] == "g" and lifted["Species"] is None and lifted["Family"] == "F"


def test_unnamed_rank_is_skipped(spark):
    gap = [catch_row("A", "a1", "P C O - g1 -"), catch_row("B", "b1", "P C O - g2 -")]
    assert rows(S.synthesize(*frames(spark, gap), env_columns=()).data, "SampleID", "Taxname") == [("a1", "O"), ("b1", "O")]


def test_zero_catch_counts_as_counted(spark):
    zero = [catch_row("A", "a1", "P C O F g s", 3), catch_row("B", "b1", "P C O F g s", 0)]
    assert rows(S.synthesize(*frames(spark, zero), env_columns=()).data, "Taxname", "CPUE") == [("s", 0.0), ("s", 3.0)]


def test_size_classes_resolve_apart_and_missing_stage_groups(spark):
    mixed = [
        catch_row("A", "a1", "P C O F g s", 1, "Micro"), catch_row("B", "b1", "P C O F g s", 1, "Micro"),
        catch_row("A", "a1", "P C O F g s", 1, "Macro"), catch_row("B", "b1", "P C O F g t", 1, "Macro"),
        catch_row("A", "a1", "P C O F g s", 4, "Meso", None), catch_row("B", "b1", "P C O F g s", 5, "Meso", None),
    ]
    out = rows(S.synthesize(*frames(spark, mixed), env_columns=()).data, "SizeClass", "Taxname", "Taxlifestage")
    assert out == [("Macro", "g", "g Adult")] * 2 + [("Meso", "s", "s NA")] * 2 + [("Micro", "s", "s Adult")] * 2


def test_one_survey_changes_nothing(spark):
    one = [c for c in TWO if c[0] == "A"]
    assert S.synthesize(*frames(spark, one), env_columns=()).caveats.count() == 0


@pytest.mark.parametrize("lag, taxa", [(0, {"g"}), (1, {"g"}), (2, {"g", "s"})])
def test_introduced_taxon_lag(spark, lag, taxa):
    years = {f"{a}{y}": y for a in "AB" for y in range(2000, 2005)}
    catches = [catch_row(s[0], s, "P C O F g -") for s in years]
    catches += [catch_row(s[0], s, "P C O F g s") for s, y in years.items() if y >= 2002]
    intro = spark.createDataFrame([("s", 2000)], "Taxname string, Intro_year int")
    out = S.synthesize(
        *frames(spark, catches, years), time_consistency=True, introductions=intro, intro_lag=lag, env_columns=()
    )
    assert {r[0] for r in rows(out.data.distinct(), "Taxname")} == taxa
    assert (out.caveats.filter("kind = 'time'").count() > 0) == (lag < 2)


def test_late_survey_start_is_no_gap(spark):
    years = {"A2000": 2000, "A2001": 2001, "B2000": 2000, "B2001": 2001}
    catches = [catch_row(s[0], s, "P C O F g s") for s in years if s != "B2000"] + [catch_row("B", "B2000", "P C O F g -")]
    start = lambda y: spark.createDataFrame([("A", "2000-01-01"), ("B", f"{y}-01-01")], "Source string, d string").selectExpr("Source", "CAST(d AS DATE) AS Startdate")
    names = lambda y: {r[0] for r in rows(S.synthesize(
        *frames(spark, catches, years), time_consistency=True, start_dates=start(y), env_columns=()
    ).data, "Taxname")}
    assert names(2001) == {"s", "g"} and names(2000) == {"g"}


def random_catches(seed, n=250):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        source, g, s = rnd.choice("ABC"), rnd.choice("uvw"), rnd.choice("12345")
        lineage = f"P C O{g} F{g} g{g} s{g}{s}" if rnd.random() < 0.7 else f"P C O{g} F{g} g{g} -"
        if source == "A" and g == "w":
            lineage = "R D - - - -"
        out.append(catch_row(source, source + str(rnd.randrange(12)), lineage, rnd.randrange(5), rnd.choice(["Meso", "Micro"])))
    return out


def test_community_properties(spark):
    catch, env = frames(spark, random_catches(3))
    out = S.synthesize(catch, env, env_columns=()).data
    keys = ["Source", "SampleID", "SizeClass", "Taxlifestage"]
    assert out.count() == out.select(keys).distinct().count()
    again = S.synthesize(out.select(*catch.columns), env, env_columns=()).data
    shown = [*keys, "Taxname", "CPUE"]
    assert rows(again, *shown) == rows(out, *shown)
    assert verdict(check_unfiltered(catch, env)).first()["Conserved"] is False
    assert verdict(check_filtered(catch, env)).first()["Conserved"] is True


def test_lookup_beyond_the_bound_gives_the_same(spark, monkeypatch):
    catch, env = frames(spark, random_catches(5))
    under = spark.createDataFrame([("Meso", "su1", "Adult")], "SizeClass string, Taxname string, Lifestage string")
    run = lambda mode: rows(S.synthesize(catch, env, mode, undersampled=under).data.drop("Date"))
    within = {m: run(m) for m in ("Community", "Taxa")}
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    assert {m: run(m) for m in ("Community", "Taxa")} == within


def test_homonyms_stay_apart_and_gaps_do_not(spark):
    same = [
        catch_row(s, s.lower() + "1", lineage, n) for s in "AB"
        for lineage, n in (("Arthropoda Copepoda O1 F1 Homo -", 3), ("Mollusca Bivalvia O2 F2 Homo -", 5))
    ]
    out = S.synthesize(*frames(spark, same), env_columns=()).data
    assert rows(out, "SampleID", "Phylum", "Class", "Order", "Family", "Genus", "CPUE") == [
        (s, *lineage.split(), "Homo", n) for s in ("a1", "b1")
        for lineage, n in (("Arthropoda Copepoda O1 F1", 3.0), ("Mollusca Bivalvia O2 F2", 5.0))
    ]
    other = [catch_row("A", "a1", "P C1 O F g -"), catch_row("B", "b1", "P C2 O F g -")]
    assert rows(S.synthesize(*frames(spark, other), env_columns=()).data, "Taxname") == [("P",), ("P",)]
    gap = [catch_row("A", "a1", "P C O F g -"), catch_row("B", "b1", "P - O F g -")]
    assert rows(S.synthesize(*frames(spark, gap), env_columns=()).data, "Class", "Genus") == [("C", "g"), ("C", "g")]


def test_rows_without_names_are_kept_or_reported(spark):
    blank = [("A", "a1", "Meso", None, None, "P", *[None] * 5, 4.0), ("B", "b1", "Meso", None, None, "P", *[None] * 5, 6.0)]
    blank += [("A", "a1", None, "Adult", None, *[None] * 6, 9.0), ("A", "a1", "Meso", "Adult", "x", "P", *[None] * 5, None), ("B", "b1", "Meso", "Adult", "x", "P", *[None] * 5, 1.0)]
    catch, env = frames(spark, blank)
    out = S.synthesize(catch, env, env_columns=())
    assert rows(out.data, "SampleID", "Lifestage", "CPUE") == [("a1", "Adult", None), ("a1", None, 4.0), ("b1", "Adult", 1.0), ("b1", None, 6.0)]
    assert rows(out.caveats, "Taxlifestage", "SizeClass") == [("NA Adult", None)]
    whole, env = frames(spark, [b for b in blank if b[-1] is not None])
    assert verdict(check_filtered(whole, env)).first()["Conserved"] is True


def test_taxa_mode_groups(spark):
    out = S.synthesize(*frames(spark, TWO), mode="Taxa", env_columns=())
    groups = rows(out.data.filter("Taxatype = 'Summed group'"), "SampleID", "Taxlifestage", "CPUE")
    names = {g[1] for g in groups}
    assert names == {f"{v}_all Adult (Meso)" for v in ("P", "C", "O", "F", "g")}
    assert ("a1", "g_all Adult (Meso)", 12.0) in groups
    assert out.data.filter("Taxatype = 'Taxon'").count() == len(TWO)
    assert rows(out.caveats, "Taxlifestage") == [("Q Adult",), ("g Adult",), ("s2 Adult",)]


def test_taxa_filter_and_sample_filter(spark):
    catch, env = frames(spark, TWO)
    out = S.synthesize(catch, env, mode="Taxa", taxa=["s1"], samples=SampleFilter(dates=("2000-01-01", None)))
    assert {r["Taxname"] for r in out.data.filter("Taxatype = 'Taxon'").collect()} == {"s1"}
    assert S.synthesize(catch, env, samples=SampleFilter(dates=("2001-01-01", None))).data.count() == 0


def test_one_shuffle_of_the_catches(spark, tmp_path):
    catch, env = frames(spark, TWO)
    catch.write.parquet(str(tmp_path / "catch"))
    stored = spark.read.parquet(str(tmp_path / "catch"))
    out = S.synthesize(stored, env, env_columns=()).data
    executed = plan(out).split("== Physical Plan ==")[1]
    assert executed.count("Exchange hashpartitioning") == 1
    assert "NestedLoop" not in executed and "Cartesian" not in executed


def test_years_of_several_blocks_and_missing_size_classes(spark):
    span = (1890, 1919, 1920, 1983, 1984, 2050)
    years = {f"{a}{y}": y for a in "AB" for y in span}
    def names(gap, size, **options):
        catches = [catch_row(s[0], s, "P C O F g -", 1, size) for s in years]
        catches += [catch_row(s[0], s, "P C O F g s", 1, size) for s, y in years.items() if (s[0], y) != ("B", gap)]
        out = S.synthesize(*frames(spark, catches, years), time_consistency=True, env_columns=(), **options)
        return {r[0] for r in rows(out.data, "Taxname")}
    assert names(None, None) == {"g", "s"} and names(1890, None) == names(1984, "Meso") == names(2050, None) == {"g"}
    intro = spark.createDataFrame([("s", 1919)], "Taxname string, Intro_year int")
    assert names(1919, "Meso", introductions=intro, intro_lag=1) == {"g", "s"}
    assert names(1920, "Meso", introductions=intro, intro_lag=1) == {"g"}
    assert names(1983, "Meso", introductions=intro, intro_lag=65) == {"g", "s"}


def test_lists_made_from_lineages_and_missing_keys_flag_alike(spark):
    catches = [catch_row(s, s.lower(), "P C O F g s", 1, size, stage) for s in "AB" for size in ("Meso", None) for stage in ("Adult", None)]
    catch, env = frames(spark, catches)
    listed = catch.filter("SizeClass IS NULL").select("SizeClass", "Taxname", "Lifestage")
    for mode in ("Community", "Taxa"):
        run = lambda under: rows(S.synthesize(catch, env, mode, undersampled=under, env_columns=()).data, "SampleID", "SizeClass", "Taxlifestage", "Undersampled")
        flags = run(listed)
        assert flags == run(lambda lines: lines.filter("SizeClass IS NULL"))
        assert {(r[1] is None) for r in flags if r[3]} == {True} and all(r[3] == (r[1] is None) for r in flags if "_all" not in r[2])


def test_catches_are_read_once_before_the_sum(spark, tmp_path, monkeypatch):
    catch, env = frames(spark, random_catches(4))
    catch.write.parquet(str(tmp_path / "catch"))
    stored = spark.read.parquet(str(tmp_path / "catch"))
    plans = []
    real = session.stage
    monkeypatch.setattr(session, "stage", lambda df, label: plans.append(plan(df).split("== Physical Plan ==")[1]) or real(df, label))
    monkeypatch.setattr(S, "stage", session.stage)
    for mode in ("Community", "Taxa"):
        plans.clear()
        out = S.synthesize(stored, env, mode, env_columns=(), undersampled=lambda lines: lines, time_consistency=True).data
        scans = lambda text: text.count(str(tmp_path / "catch"))
        assert sum(map(scans, plans)) == 1 and scans(plan(out).split("== Physical Plan ==")[1]) == 1


def test_catches_move_once_for_sums_and_sample_columns(spark, monkeypatch):
    catch, env = frames(spark, TWO)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = S.synthesize(catch, env, "Taxa", env_columns=["Year", "CPUE", "Taxname"]).data
        # One exchange of the catches and one of the samples, neither with a name of a taxon.
        executed = plan(out).split("== Physical Plan ==")[1]
        assert executed.count("Exchange hashpartitioning") == 2
        assert rows(out, "SampleID", "Taxname", "CPUE", "Year")[:3] == [("a1", "C_all", 12.0, 2000), ("a1", "F_all", 12.0, 2000), ("a1", "O_all", 12.0, 2000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sums_are_spread_by_their_rows(spark, monkeypatch):
    catch, env = frames(spark, random_catches(6))
    assert S.stage_lineages(catch).catches == S.stage_lineages(catch, False).catches == 250
    want = {m: rows(S.synthesize(catch, env, m, env_columns=()).data) for m in ("Community", "Taxa")}
    monkeypatch.setattr(S, "SUM_ROWS", 10)
    for mode, tasks in (("Community", 25), ("Taxa", 150)):
        data = S.synthesize(catch, env, mode, env_columns=()).data
        # Few bytes move, yet the tasks of the sums are not merged.
        assert data.rdd.getNumPartitions() == tasks and rows(data) == want[mode]


def test_lineages_move_to_their_samples_as_one_column(spark):
    odd = [None, "", "-", "null", 'a "b" \\ c', "x\x1fy", "x\x1ey", "é\U0001f41f\n{}", "{}"]
    catches = [("A", f"a{i}", odd[i], odd[-i], odd[i // 2], *[odd[(i + k) % 9] for k in range(6)], 1.0) for i in range(9)]
    catches += [("A", "a0", *[None] * 9, None), ("A", None, *[None] * 9, 2.0)]
    catch, env = frames(spark, [c for c in catches if c[1]], {f"a{i}": 2000 + i for i in range(9)})
    catch = spark.createDataFrame(catches, CATCH)
    # Null, empty and odd names come back as they were, with the years of their samples; a missing sample has no year.
    moved = S.filtered_base(S.packed(catch), env, SampleFilter(), True)
    assert moved.columns == ["Source", "SampleID", "_lineage", "Year"]
    lines = S.stage_lineages(moved, True)
    bits = {tuple(r[:-2]): (r[-2], r[-1]) for r in lines.table.select("Source", *S.LINEAGE_KEY, "_block", "_years").collect() if r["_block"] is not None}
    want = {}
    for i, c in enumerate(catches[:-1]):
        year = 2000 + (i if i < 9 else 0)
        key = (c[0], *c[2:4], c[4], *c[5:11])
        block, years = want.get(key, (year // 64, 0))
        want[key] = (block, years | 1 << year % 64)
    assert bits == want and lines.catches == len(catches)
    assert lines.table.filter("_block IS NULL").count() == 1
