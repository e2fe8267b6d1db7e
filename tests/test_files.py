import datetime
import os

import pytest
from pyspark.sql import functions as F

from feedloom.functions import names
from feedloom.sinks.writers import write_manifest
from feedloom.sources.files import list_files, manifest, single_data_file

PATHS = ["a/b/report.txt", "report", "a.d/noext", ".hidden", "x/.hidden.csv", "two.dots.gz", "end.", "..odd", "a/"]


def test_name_parts(spark):
    got = spark.createDataFrame([(p,) for p in PATHS], "p STRING").select(
        "p", names.stem(F.col("p")), names.extension(F.col("p"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == {p: os.path.splitext(os.path.basename(p)) for p in PATHS}


@pytest.mark.parametrize("mode, want", [
    ("drop", "f_T"), ("keep", "f_T.txt"), (" Keep ", "f_T.txt"), ("force:csv", "f_T.csv"),
    ("force:.CSV", "f_T.csv"), ("force: ", "f_T"), ("other", "f_T"), (None, "f_T"), ("", "f_T")])
def test_destination_names(spark, mode, want):
    df = spark.createDataFrame([("in/f.txt", mode)], "p STRING, m STRING")
    assert df.select(names.destination_name(F.col("p"), F.lit("T"), F.col("m"))).first()[0] == want


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stamps_do_not_depend_on_the_session(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = F.lit(datetime.datetime(2025, 1, 2, 3, 4, 5, tzinfo=datetime.timezone.utc))
        offsets = {"Z": "030405", "utc": "030405", "": "030405", "+05:30": "083405", "-0330": "233405",
                   "nonsense": "030405", "+5:00": "030405"}
        for offset, want in offsets.items():
            got = spark.range(1).select(names.stamp(at, F.lit(offset), "HHmmss")).first()[0]
            assert got == want, offset
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_folder_has_one_slash(spark):
    df = spark.createDataFrame([("a/b",), ("a/b//",), ("a/",)], "p STRING")
    assert [r[0] for r in df.select(names.folder(F.col("p"))).collect()] == ["a/b/", "a/b/", "a/"]


def test_listing_manifest_and_single_file(spark, tmp_path):
    out = tmp_path / "out"
    spark.range(3).coalesce(1).write.csv(str(out))
    files = list_files(spark, str(out))
    assert {os.path.basename(r.key)[:5] for r in files.collect()} == {"part-"}
    one = single_data_file(files).first()
    row = manifest(files).first()
    stem, ext = os.path.splitext(os.path.basename(one.key))
    assert row.new_name == f"{stem}__{one.size_bytes}B{ext}"
    write_manifest(manifest(files), str(tmp_path / "manifest"))
    assert spark.read.option("header", True).csv(str(tmp_path / "manifest")).count() == 1


def test_exactly_one_data_file(spark, tmp_path):
    for name in ("part-0", "part-1", "other", "_SUCCESS"):
        (tmp_path / name).write_text("x")
    with pytest.raises(RuntimeError):
        single_data_file(list_files(spark, str(tmp_path)))
    with pytest.raises(FileNotFoundError):
        single_data_file(list_files(spark, str(tmp_path)).where("size_bytes > 5"))
    one = single_data_file(list_files(spark, str(tmp_path)).where("key NOT LIKE '%part-1'"))
    assert one.first().key.endswith("part-0")


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "a.bin").write_text("x")
    text = list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in text.split("ReadSchema")[-1]
