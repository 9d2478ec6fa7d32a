import random

from pyspark.sql import functions as F

from surveyloom.operators import combine as B
from surveyloom.operators import filters as R
from surveyloom.operators import summary as M
from surveyloom.operators import views as V
from surveyloom.operators.synth import synthesize
from surveyloom.operators.validate import totals_fit
from surveyloom.schemas import ENV
from tests.conftest import plan, rows

CATCH = "Source string, SampleID string, SizeClass string, Taxname string, Lifestage string, Phylum string, Class string, `Order` string, Family string, Genus string, Species string, CPUE double, Year int"


def catches(spark, n=400):
    draw, data = random.Random(3), []
    taxa = [("a b", "a", "a b"), ("a c", "a", "a c"), ("a", "a", None), ("d e", "d", "d e"), ("F", None, None), (None, None, None)]
    for k in range(n):
        name, genus, species = draw.choice(taxa)
        year = draw.choice([None, 1950, 1999, 2000, 2063, 2064])
        data.append((draw.choice(["EMP", "STN", None]), str(k), draw.choice(["Meso", None]), name, "Adult", "Arthropoda", "C", "F", genus and "fam", genus, species, draw.choice([0.0, 2.5, None]), year))
    return spark.createDataFrame(data, CATCH)


def test_batches_merge_to_the_whole(spark, tmp_path):
    catch, folder = catches(spark), str(tmp_path / "summary")
    early = F.coalesce(F.col("Year"), F.lit(0)) < 2000
    M.write_batches(catch.filter(early), folder, F.col("Year"))
    first = M.read_summary(spark, folder).agg(F.sum("N_rows")).first()[0]
    assert first == catch.filter(early).count()
    M.write_batches(catch.filter(~early), folder, F.col("Year"))
    whole = rows(M.summarize(catch))
    assert rows(M.read_summary(spark, folder)) == whole
    M.write_batches(catch.filter("Year = 2000"), folder, F.col("Year"))  # a repeated run
    assert rows(M.read_summary(spark, folder)) == whole
    assert sum(r[-2] for r in whole) == 400


def test_summary_of_nothing(spark, tmp_path):
    summary = M.merge(M.summarize(catches(spark).limit(0)))
    assert M.taxa_labels(summary).count() == 0 and M.community_caveats(summary).count() == 0
    assert M.detections(summary).count() == 0


def test_menu_counts_and_caveats_read_no_catch(spark, tmp_path):
    catch, folder = catches(spark).filter("Taxname IS NOT NULL"), str(tmp_path / "summary")
    catch.write.parquet(str(tmp_path / "catch"))
    stored = spark.read.parquet(str(tmp_path / "catch"))
    M.write_batches(stored, folder, F.col("Year"))
    summary = M.read_summary(spark, folder)
    samples = spark.createDataFrame([], ENV)
    data = synthesize(stored, samples, "Taxa", env_columns=()).data
    labels = M.taxa_labels(summary)
    assert str(tmp_path / "catch") not in plan(labels)
    assert rows(V.menu_tree(labels)) == rows(V.menu_tree(data))
    assert rows(V.n_taxa(labels)) == rows(V.n_taxa(data))
    community = synthesize(stored, samples, "Community", env_columns=())
    assert rows(M.community_caveats(summary)) == rows(community.caveats)
    wanted = ["a b Adult", "nothing Adult"]
    labelled = stored.withColumn("Taxlifestage", F.concat_ws(" ", "Taxname", "Lifestage"))
    for names in (wanted, wanted[:1]):
        one = R.select_or_all(labelled, "Taxlifestage", names, M.detections(summary))
        assert rows(one) == rows(R.select_or_all(labelled, "Taxlifestage", names))


def test_chunks_bound_lists_and_keep_their_order(spark):
    draw = random.Random(4)
    pairs = [(draw.choice(["x", "x", "x", "y", None]), draw.choice([None, *range(300)])) for _ in range(2000)]
    df = spark.createDataFrame(pairs, "g string, v int").repartition(7)
    got = {}
    for r in B.list_chunks(df, "g", ["v"], 32).collect():
        assert 0 < len(r["Items"]) <= 32
        got.setdefault(r["g"], {})[r["Chunk"]] = [i["v"] for i in r["Items"]]
    for g, chunks in got.items():
        want = sorted({v for k, v in pairs if k == g}, key=lambda v: (v is None, v or 0))
        assert sorted(chunks) == list(range(-(-len(want) // 32)))
        assert [v for c in sorted(chunks) for v in chunks[c]] == want
    assert set(got) == {g for g, _ in pairs}
    assert B.list_chunks(df.limit(0), "g", ["v"]).count() == 0


def test_tooltips_and_legends(spark):
    view = spark.createDataFrame([("b", 2000, 2.5), ("a", None, 3.5), (None, 1999, None)], "t string, y int, c double")
    out = V.with_tooltips(view, {"Year": "y", "CPUE": F.bround("c", 0).cast("long")}, ["t", "y"])
    cell = "<tr><td>{} &nbsp</td><td>{}</td></tr>".format
    table = lambda year, n: "<table>" + cell("Year", year) + cell("CPUE", n) + "</table>"
    assert rows(out, "t", "ID", "tooltip") == sorted([("a", "1", table("NA", 4)), ("b", "2", table(2000, 2)), (None, "3", table(1999, "NA"))], key=repr)
    breaks = spark.createDataFrame([(1200000.0, 22.0), (0.33, 7.0), (None, None)], "Break double, Radius double")
    assert rows(V.legend_labels(breaks), "Label") == sorted([("1,200,000",), ("0.33",), (None,)], key=repr)


def test_fit_of_totals(spark):
    totals = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (5.0, 5.0), (None, 3.0)], "CPUE_com double, CPUE_base double")
    fit = totals_fit(totals).first()
    assert (fit["N"], round(fit["Slope"], 9), abs(round(fit["Intercept"], 9)), round(fit["R2"], 9)) == (3, 1, 0, 1)
