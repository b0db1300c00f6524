"""Files in, files out, saved models and whole runs under the default names."""

import datetime
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from georisk import jobs
from georisk.operators import feeds, models
from georisk.operators.cleaning import year_or_latest
from georisk.operators.evaluation import overall_scores
from georisk.operators.risk import forecast_output
from georisk.plans.evaluation import run_evaluation
from georisk.plans.forecast import forecast, load_or_train
from georisk.plans.yearly_maps import build_yearly_maps, read_year
from georisk.roles import Roles
from georisk.sinks import write_feed, write_forecast, write_metrics
from georisk.sources import merged as merged_table
from georisk.sources import occurrences as O
from georisk.sources.bundles import bundle_exists, load_bundle
from georisk.sources.forecast import load_forecast_text, scan_forecast, scan_forecast_text
from georisk.workspace import drop_settled, settle, shared_folder

ROLES = Roles()
HEADER = [
    "DataHora", "Satelite", "Pais", "Estado", "Municipio", "Bioma", "DiaSemChuva",
    "Precipitacao", "RiscoFogo", "FRP", "Latitude", "Longitude",
]
SMALL = {"trees": 3, "depth": 4}


def line(rng, year, slashed):
    day = datetime.datetime(year, rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23), 30)
    region = rng.choice(["GOIAS", "BAHIA", "TOCANTINS"])
    town = f'{region[:2]} "{rng.randint(1, 6)}", rural'
    return {
        "DataHora": day.strftime("%Y/%m/%d %H:%M:%S" if slashed else "%Y-%m-%d %H:%M:%S"),
        "Satelite": "S", "Pais": "P", "Estado": region, "Municipio": town, "Bioma": "B",
        "DiaSemChuva": rng.choice([-999, *range(40)]), "Precipitacao": rng.randint(0, 90) / 10,
        "RiscoFogo": rng.choice(["", "NA", *[k / 100 for k in range(101)]]),
        "FRP": rng.randint(1, 999) / 10, "Latitude": -10 - rng.randint(0, 20) / 10,
        "Longitude": -50 - rng.randint(0, 20) / 10,
    }


def quoted(value):
    text = str(value)
    return '"' + text.replace('"', '""') + '"' if '"' in text or "," in text else text


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """Three years: other column order in the second, one column less in the third."""
    folder, rng = tmp_path_factory.mktemp("years"), random.Random(1)
    heads = {
        2023: HEADER, 2024: HEADER[::-1], 2025: [c for c in HEADER if c != "Municipio"],
    }
    for year, head in heads.items():
        rows = [line(rng, year, year == 2024) for _ in range(150)]
        text = [",".join(head)] + [",".join(quoted(r[c]) for c in head) for r in rows]
        (folder / f"base_{year}.csv").write_text("\n".join(text) + "\n", encoding="utf-8")
    return f"{folder}/*.csv"


@pytest.fixture(scope="module")
def history(spark, files):
    return settle(O.load_yearly(spark, files))


def test_layouts_and_scan(spark, files):
    found = O.layouts(spark, files)
    assert sorted(p[-8:-4] for paths in found.values() for p in paths) == ["2023", "2024", "2025"]
    assert len(found) == 3 and tuple(HEADER) in found
    raw = O.scan_yearly(spark, files)
    assert raw.count() == 450
    assert raw.filter("Latitude > -10 or Latitude < -12").isEmpty()
    assert raw.filter("Municipio is null").select("source_file").distinct().count() == 1
    assert raw.filter("Municipio like '%\", rural'").count() == 300


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, "counted")
    work()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_headers_take_as_many_jobs_for_many_files(spark, tmp_path):
    for count in (40, 120):  # beyond 32 paths Spark lists them in jobs of its own
        (tmp_path / str(count)).mkdir()
        for year in range(count):
            (tmp_path / str(count) / f"{year}.csv").write_text("a,b\n1,2\n")
    few = jobs_of(spark, "few", lambda: O.layouts(spark, f"{tmp_path}/40/*.csv"))
    many = jobs_of(spark, "many", lambda: O.layouts(spark, f"{tmp_path}/120/*.csv"))
    assert 0 < few == many


def test_headers_of_odd_files(spark, tmp_path):
    import gzip

    folder = tmp_path / "odd files"
    folder.mkdir()
    (folder / "empty.csv").write_text("")
    (folder / "marked.csv").write_text('\ufeff"a, ""b""",c\r\n1,2\r\n', encoding="utf-8")
    (folder / "packed.csv.gz").write_bytes(gzip.compress(b"c,d\n1,2\n"))
    found = O.layouts(spark, f"{folder}/*")
    assert set(found) == {('a, "b"', "c"), ("c", "d")}
    rows = O.scan_yearly(spark, f"{folder}/*")
    assert rows.count() == 2 and set(rows.columns) == {'a, "b"', "c", "d", "source_file"}


def test_numbers_that_do_not_parse_fail_and_are_counted(spark, tmp_path):
    good = dict(line(random.Random(2), 2024, False), DiaSemChuva=3, RiscoFogo=0.5)
    spoiled = [dict(good, FRP=text) for text in ("1d", "12,5", " 4", "abc", "0x10", "NA", "")]
    text = [",".join(HEADER)] + [",".join(quoted(r[c]) for c in HEADER) for r in [good, *spoiled]]
    (tmp_path / "a.csv").write_text("\n".join(text) + "\n")
    counts = O.unparsed_counts(spark, f"{tmp_path}/*.csv").first()
    assert (counts["rows"], counts["FRP"], counts["Latitude"]) == (8, 4, 0)
    with pytest.raises(Exception, match="not a number"):
        O.load_yearly(spark, f"{tmp_path}/*.csv").collect()


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        O.scan_yearly(spark, f"{tmp_path}/none/*.csv")


def test_load_yearly_is_clean_and_typed(spark, history):
    kinds = dict(history.dtypes)
    assert kinds["DataHora"] == "timestamp_ntz" and kinds["Data"] == "date"
    assert not set(ROLES.unused) & set(history.columns)
    assert history.filter("DataHora is null or RiscoFogo is null or DiaSemChuva = -999").isEmpty()
    assert 0 < history.count() < 450
    assert history.agg(F.max("RiscoFogo")).first()[0] > 1
    years = history.groupBy("source_file", F.year("Data")).count().count()
    assert years == 3


def test_merged_table_is_built_once(spark, files, history, tmp_path):
    merged = f"{tmp_path}/merged"
    assert not O.table_exists(spark, merged)
    first = merged_table.load_merged(spark, files, merged)
    assert O.table_exists(spark, merged)
    assert first.select(history.columns).exceptAll(history).isEmpty()
    again = merged_table.load_merged(spark, f"{tmp_path}/gone/*.csv", merged)
    assert again.count() == history.count()


def test_bundle_round_trip_and_scores(spark, history, tmp_path):
    path = f"{tmp_path}/model"
    assert not bundle_exists(spark, path)
    trained = load_or_train(spark, path, history, **SMALL)
    loaded = load_or_train(spark, path, history.filter(F.lit(False)))
    assert loaded.features == trained.features and len(loaded.features) == 21
    assert loaded.cluster_risk is None and set(loaded.labels.sizes) == set(ROLES.categories)
    one = models.score_history(history, trained)
    two = models.score_history(history, load_bundle(spark, path))
    assert one.exceptAll(two.select(one.columns)).isEmpty()
    assert one.count() == history.count()
    assert one.filter("Risco_pred < 0 or Risco_pred > 100").isEmpty()
    assert dict(one.dtypes)["Risco_pred"] == "int"


def test_empty_history_cannot_train(spark, history):
    with pytest.raises(ValueError, match="history is empty"):
        models.train_forest(history.filter(F.lit(False)), **SMALL)


def test_forest_learns(spark):
    rows = spark.range(2000).select(
        F.make_date(F.lit(2020), 1 + F.col("id") % 12, F.lit(3)).alias("Data"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("Estado"),
        F.concat(F.lit("t"), F.col("id") % 5).alias("Municipio"),
        *[(F.col("id") * k % 50).cast("double").alias(n) for k, n in
          ((1, "DiaSemChuva"), (3, "Precipitacao"), (7, "FRP"), (11, "Latitude"), (13, "Longitude"))],
    ).withColumn("RiscoFogo", F.col("DiaSemChuva") + F.when(F.col("Estado") == "a", 40.0).otherwise(0.0))
    bundle = models.train_forest(rows, trees=10, depth=8)
    scored = models.score_history(rows, bundle)
    error = scored.agg(F.avg(F.abs(F.col("RiscoFogo") - F.col("Risco_pred")))).first()[0]
    assert error < 3


def test_held_out_rows_are_those_training_leaves(spark, history):
    marked = models.mark_held_out(history)
    moved = models.mark_held_out(history.withColumn("source_file", F.lit("elsewhere")))
    assert 0 < marked.filter(models.HELD_OUT).count() < history.count() / 2
    assert marked.drop("source_file").exceptAll(moved.drop("source_file")).isEmpty()
    assert models.mark_held_out(history, train_share=1.0).filter(models.HELD_OUT).isEmpty()
    assert models.mark_held_out(history.filter(F.lit(False))).isEmpty()


def test_scores_of_no_rows(spark):
    empty = spark.createDataFrame([], "RiscoFogo double, Risco_pred int")
    row = overall_scores(empty).first()
    assert row["n"] == 0 and row["MAE"] is None


def test_forecast_file_round_trip(spark, history, tmp_path):
    bundle = models.train_forest(history, **SMALL)
    result = settle(forecast(history, bundle, total=400, seed=5))
    path = f"{tmp_path}/previsao_2026.csv"
    write_forecast(result, path)
    back = scan_forecast(spark, path)
    assert back.columns == list(ROLES.forecast) and back.count() == 400
    expected = forecast_output(result).withColumn("Data", F.to_date("Data"))
    assert back.exceptAll(expected).isEmpty()
    assert back.filter("RiscoFogo < 0 or RiscoFogo > 100").isEmpty()
    assert back.agg(F.max("RiscoFogo")).first()[0] == 100
    first_days = [r["Data"] for r in back.collect()]
    assert first_days == sorted(first_days)
    write_forecast(result, f"{tmp_path}/by_month", by_month=True)
    assert spark.read.option("header", True).csv(f"{tmp_path}/by_month").count() == 400


def test_cluster_bundle_forecast(spark, history):
    bundle = models.train_clusters(history, k=4)
    assert bundle.cluster_risk.count() <= 4
    result = forecast(history, bundle, total=200, seed=5)
    assert result.filter("RiscoFogo < 0 or RiscoFogo > 100").isEmpty()
    assert result.count() == 200


def test_dirty_forecast_file(spark, tmp_path):
    path = tmp_path / "dirty.csv"
    head = ",".join(ROLES.forecast)
    path.write_text(
        f"{head}\n2026-01-02,A,x,7,1,2.5,3.5,-10,-50\n\n{head}\n2026-01-01,A,x,?,1,2,3,-11,-51\n"
        "2026-99-01,A,x,7,1,2,3,-11,-51\n2026-01-03,A,x,7,1,2,3,NA,-51\n", encoding="utf-8"
    )
    assert scan_forecast_text(spark, str(path)).count() == 5
    rows = load_forecast_text(spark, str(path)).orderBy("Data").collect()
    assert [(r["Data"].day, r["RiscoFogo"]) for r in rows] == [(1, None), (2, 7.0)]


def test_wrong_header_fails(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text("a,b,c,d,e,f,g,h,i\n2026-01-02,A,x,7,1,2.5,3.5,-10,-50\n")
    with pytest.raises(Exception, match="header"):
        scan_forecast(spark, str(path)).collect()


def test_modal_year_ties_and_unknown(spark):
    day = lambda y: datetime.date(y, 1, 1)
    df = spark.createDataFrame(
        [("a", day(2015)), ("a", day(2014)), ("b", day(2016)), ("b", day(2016)), ("b", day(2014)),
         ("b", None), ("b", None), ("b", None), ("c", None)], "f string, d date",
    )
    got = {r["f"]: r["ano"] for r in feeds.modal_year(df, "f", "d").collect()}
    assert got == {"a": 2014, "b": 2016, "c": None}
    listed = feeds.years_in_order(feeds.modal_year(df, "f", "d")).collect()
    assert [r["ano"] for r in listed] == [None, 2014, 2016]


def test_yearly_maps(spark, files, history, tmp_path):
    out = f"{tmp_path}/maps"
    build_yearly_maps(spark, files, out)
    feed = spark.read.parquet(out)
    assert feed.count() == history.count()
    assert {r["ano"] for r in feed.select("ano").distinct().collect()} == {2023, 2024, 2025}
    assert {r["ano"] for r in read_year(spark, out).select("ano").distinct().collect()} == {2025}
    assert {r["ano"] for r in read_year(spark, out, 2023).select("ano").distinct().collect()} == {2023}
    assert {r["ano"] for r in read_year(spark, out, 1900).select("ano").distinct().collect()} == {2025}
    assert feed.filter(F.date_trunc("day", "DataHora") != F.col("DataHora")).isEmpty()


def test_chosen_year_reads_one_partition(spark, tmp_path):
    path = f"{tmp_path}/feed"
    write_feed(spark.range(3000).select("id", (2000 + F.col("id") % 3).cast("int").alias("ano")), path)
    chosen = year_or_latest(spark.read.parquet(path), "ano", 2001)
    assert chosen.count() == 1000
    scan = chosen.select("id")._jdf.queryExecution()
    text = scan.executedPlan().toString()
    assert "PartitionFilters" in text and "Subquery" in text.split("PartitionFilters")[1]


def test_evaluation_run(spark, history, tmp_path):
    bundle = models.train_forest(history, **SMALL)
    out = f"{tmp_path}/eval"
    scores = run_evaluation(history, bundle, out, year=2025)
    assert scores.count() == 3
    metrics = spark.read.option("header", True).csv(f"{out}/metrics_continuas_por_ano.csv")
    assert metrics.columns == ["Ano", "MAE", "RMSE", "R2", "n"]
    assert [r["Ano"] for r in metrics.collect()] == ["2023", "2024", "2025"]
    margins = spark.read.option("header", True).csv(f"{out}/metrics_margem_por_ano.csv")
    assert margins.columns == ["Ano", "accuracy_margin", "n"]
    assert spark.read.parquet(f"{out}/charts").count() == 12
    points = spark.read.parquet(f"{out}/error_map")
    assert points.count() == history.filter(F.year("Data") == 2025).count()
    assert spark.read.parquet(f"{out}/error_heat").count() == history.count()
    centre = spark.read.parquet(f"{out}/error_map_centre").first()
    assert -12 <= centre["Latitude"] <= -10


def test_kmeans_sweep_and_best_k(spark):
    rows = spark.range(300).select(
        (F.col("id") % 3 * 100 + F.col("id") % 7 / 10.0).alias("a"), (F.col("id") % 3 * 10.0).alias("b")
    )
    sweep = models.kmeans_sweep(rows, ["a", "b"], range(2, 6)).cache()
    assert [r["k"] for r in sweep.orderBy("k").collect()] == [2, 3, 4, 5]
    assert models.best_k(sweep, reported=4).first()["k"] == 3
    tie = spark.createDataFrame([(2, 1.0, 0.5), (3, 1.0, 0.5)], sweep.schema)
    assert models.best_k(tie).first()["k"] == 2


def test_jobs(spark, files, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(jobs, "build_session", lambda name: spark)
    monkeypatch.setattr(jobs, "drop_settled", lambda session: None)
    shared = ["--files", files, "--merged", f"{tmp_path}/m", "--model", f"{tmp_path}/model",
              "--trees", "2", "--depth", "3"]
    jobs.main(["forecast", *shared, "--out", f"{tmp_path}/f.csv", "--total", "300"])
    assert scan_forecast(spark, f"{tmp_path}/f.csv").count() == 300
    jobs.main(["evaluate", *shared, "--out", f"{tmp_path}/eval", "--sample", "5", "--key", "Latitude"])
    assert spark.read.parquet(f"{tmp_path}/eval/error_map").count() == 5
    assert 0 < spark.read.parquet(f"{tmp_path}/eval/holdout").first()["n"] < 250
    jobs.main(["maps", "--files", files, "--out", f"{tmp_path}/maps", "--forecast", f"{tmp_path}/f.csv"])
    assert spark.read.parquet(f"{tmp_path}/maps/forecast").count() == 300
    jobs.main(["year", "--feed", f"{tmp_path}/maps/years", "--out", f"{tmp_path}/y", "--year", "2023"])
    assert {r["ano"] for r in spark.read.parquet(f"{tmp_path}/y").select("ano").collect()} == {2023}
    jobs.main(["numbers", "--files", files, "--out", f"{tmp_path}/n"])
    counted = spark.read.parquet(f"{tmp_path}/n").agg(F.sum("rows"), F.sum("FRP")).first()
    assert tuple(counted) == (450, 0)
    monkeypatch.setattr(jobs, "kmeans_sweep", lambda rows, names: models.kmeans_sweep(rows, names, [2, 3]))
    jobs.main(["sweep", "--files", files, "--merged", f"{tmp_path}/m", "--out", f"{tmp_path}/s"])
    assert spark.read.parquet(f"{tmp_path}/s").count() == 2
    jobs.main(["check", "--forecast", f"{tmp_path}/f.csv"])
    assert "rows_before" in capsys.readouterr().out


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = configured or spark.sparkContext.getCheckpointDir()
    assert shared_folder(spark).startswith(root.rstrip("/"))


def test_drop_settled_removes_the_folder(spark, monkeypatch):
    from georisk import workspace

    folder = f"{shared_folder(spark)}-dropped"
    monkeypatch.setattr(workspace, "shared_folder", lambda session: folder)
    assert settle(spark.range(5)).count() == 5
    assert spark.read.parquet(f"{folder}/*").count() == 5
    drop_settled(spark)
    with pytest.raises(AnalysisException):
        spark.read.parquet(f"{folder}/*")
