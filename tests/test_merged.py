"""The merged table's manifest, and rows set apart for bad numbers."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from georisk.roles import Roles
from georisk.sources import merged as M
from georisk.sources import occurrences as O
from tests.test_io import HEADER, line, quoted

ROLES = Roles()


def write_year(folder, year, count=20, head=HEADER, **changes):
    rng = random.Random(year)
    rows = [dict(line(rng, year, False), **changes) for _ in range(count)]
    text = [",".join(head)] + [",".join(quoted(r[c]) for c in head) for r in rows]
    (folder / f"{year}.csv").write_text("\n".join(text) + "\n", encoding="utf-8")


def per_year(spark, merged):
    return dict(M.read_merged(spark, merged).groupBy(F.year("DataHora")).count().collect())


def test_only_new_files_are_parsed(spark, tmp_path, monkeypatch):
    files, merged = f"{tmp_path}/in/*.csv", f"{tmp_path}/merged"
    (tmp_path / "in").mkdir()
    parsed = []
    real = M.scan_yearly
    monkeypatch.setattr(M, "scan_yearly", lambda spark, paths, roles: parsed.append(len(paths)) or real(spark, paths, roles))
    write_year(tmp_path / "in", 2020)
    write_year(tmp_path / "in", 2021)
    assert M.merge_files(spark, files, merged) == 2
    write_year(tmp_path / "in", 2022, head=[c for c in HEADER if c != "Bioma"] + ["Bioma"])
    assert M.merge_files(spark, files, merged) == 1 and M.merge_files(spark, files, merged) == 0
    assert parsed == [2, 1]
    assert per_year(spark, merged) == {2020: 20, 2021: 20, 2022: 20}
    assert M.load_merged(spark, files, merged).select("source_file").distinct().count() <= 3


def test_a_failed_merge_leaves_the_table_and_is_done_again(spark, tmp_path):
    files, merged = f"{tmp_path}/in/*.csv", f"{tmp_path}/merged"
    (tmp_path / "in").mkdir()
    write_year(tmp_path / "in", 2020)
    M.merge_files(spark, files, merged)
    write_year(tmp_path / "in", 2021, FRP="1,5")
    with pytest.raises(Exception, match="not a number"):
        M.merge_files(spark, files, merged)
    assert per_year(spark, merged) == {2020: 20}
    write_year(tmp_path / "in", 2021)
    assert M.merge_files(spark, files, merged) == 1
    assert per_year(spark, merged) == {2020: 20, 2021: 20}


def test_rows_written_without_an_entry_are_not_read(spark, tmp_path, monkeypatch):
    files, merged = f"{tmp_path}/in/*.csv", f"{tmp_path}/merged"
    (tmp_path / "in").mkdir()
    write_year(tmp_path / "in", 2020)
    M.merge_files(spark, files, merged)
    write_year(tmp_path / "in", 2021)
    with monkeypatch.context() as patch:
        patch.setattr(M, "manifest_path", lambda merged: "nowhere://x")
        patch.setattr(M, "manifest", lambda spark, merged: known)
        known = spark.read.schema(M.MANIFEST_SCHEMA).parquet(f"{merged}_manifest")
        with pytest.raises(Exception):
            M.merge_files(spark, files, merged)
    assert per_year(spark, merged) == {2020: 20}
    assert M.drop_unnamed(spark, merged) == 1 and M.drop_unnamed(spark, merged) == 0
    assert M.merge_files(spark, files, merged) == 1 and per_year(spark, merged) == {2020: 20, 2021: 20}


def test_changed_files_are_refused_and_refreshed(spark, tmp_path):
    files, merged = f"{tmp_path}/in/*.csv", f"{tmp_path}/merged"
    (tmp_path / "in").mkdir()
    write_year(tmp_path / "in", 2020)
    write_year(tmp_path / "in", 2021)
    M.merge_files(spark, files, merged)
    write_year(tmp_path / "in", 2021, count=30)
    with pytest.raises(ValueError, match="2021.csv"):
        M.merge_files(spark, files, merged)
    assert M.merge_files(spark, files, merged, refresh=True) == 2
    assert per_year(spark, merged) == {2020: 20, 2021: 30}
    assert M.drop_unnamed(spark, merged) == 1 and per_year(spark, merged) == {2020: 20, 2021: 30}


def test_missing_columns_empty_files_and_no_table(spark, tmp_path):
    files, merged = f"{tmp_path}/in/*.csv", f"{tmp_path}/merged"
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError, match="nothing has been merged"):
        M.load_merged(spark, f"{tmp_path}/none/*.csv", merged)
    write_year(tmp_path / "in", 2020, head=[c for c in HEADER if c != "Municipio"])
    M.merge_files(spark, files, merged)
    (tmp_path / "in" / "0000.csv").write_text("\n\n")
    assert M.merge_files(spark, files, merged) == 1 and M.merge_files(spark, files, merged) == 0
    write_year(tmp_path / "in", 2021)
    M.merge_files(spark, files, merged)
    towns = M.read_merged(spark, merged).groupBy(F.year("DataHora")).agg(F.count("Municipio")).collect()
    assert dict(map(tuple, towns)) == {2020: 0, 2021: 20}


def test_good_and_quarantined_rows_are_all_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_year(tmp_path / "in", 2020)
    write_year(tmp_path / "in", 2021, count=5, FRP="1,5", Latitude="x")
    write_year(tmp_path / "in", 2022, count=7, FRP="", Longitude=" -50.5")
    files, apart = f"{tmp_path}/in/*.csv", f"{tmp_path}/apart"
    good, spoiled = O.split_spoiled(spark, files, f"{tmp_path}/parsed")
    assert (good.count(), spoiled.count()) == (27, 5)
    row = spoiled.first()
    assert row["spoiled"] == ["FRP", "Latitude"] and row["source_file"].endswith("2021.csv")
    assert row["row_text"] in (tmp_path / "in" / "2021.csv").read_text().splitlines()
    assert good.exceptAll(O.scan_yearly(spark, f"{tmp_path}/in/202[02].csv").select(good.columns)).isEmpty()
    loaded = O.load_yearly(spark, files, quarantine=apart)
    assert loaded.where(F.year("Data") == 2021).isEmpty() and not loaded.isEmpty()
    assert spark.read.parquet(apart).count() == 5


def test_merging_with_quarantine(spark, tmp_path):
    files, merged, apart = f"{tmp_path}/in/*.csv", f"{tmp_path}/merged", f"{tmp_path}/apart"
    (tmp_path / "in").mkdir()
    write_year(tmp_path / "in", 2020, count=4, FRP="abc")
    write_year(tmp_path / "in", 2021)
    assert M.merge_files(spark, files, merged, quarantine=apart) == 2
    write_year(tmp_path / "in", 2022, count=3, FRP="1d")
    assert M.merge_files(spark, files, merged, quarantine=apart) == 1
    assert per_year(spark, merged) == {2021: 20}
    found = spark.read.parquet(apart).groupBy("source_file").count().collect()
    assert sorted((r["source_file"][-8:-4], r["count"]) for r in found) == [("2020", 4), ("2022", 3)]
