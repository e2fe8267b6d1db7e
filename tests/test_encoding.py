"""Lines that are no text of the stated encoding: widths, quarantine with their bytes, and the identity of rows."""

from pyspark.sql import functions as F

from feedloom.plans import job
from feedloom.plans.queries import FILE_NAME, LEDGER, UNDECODABLE_EVERY, undecodable_source
from feedloom.session import scratch_folder
from feedloom.sources.lines import read_lines


def _write(spark, lines: list[bytes]) -> str:
    folder = scratch_folder(spark, "bytes")
    spark.createDataFrame([(b,) for b in lines], "b binary").select(F.col("b").cast("string").alias("value")) \
        .coalesce(1).write.text(folder)
    return folder


def test_widths_by_encoding(spark):
    lines = [b"plain ascii", "café ok".encode(), b"caf\xe9 latin", b"\xff\xfe", b""]
    folder = _write(spark, lines)
    def read(encoding):
        return {r.value: r for r in read_lines(spark, folder, encoding=encoding).select(
            "value", F.char_length("value").alias("chars"), "_BYTES").collect() if r.value is not None}, \
            sorted(r._BYTES for r in read_lines(spark, folder, encoding=encoding).collect() if r.value is None)
    utf8, bad = read("UTF-8")
    assert set(utf8) == {"plain ascii", "café ok", ""}
    assert bad == ["636166E9206C6174696E", "FFFE"]
    latin, bad = read("ISO-8859-1")
    assert bad == [] and latin["café latin"].chars == len(b"caf\xe9 latin") and "ÿþ" in latin
    ascii_, bad = read("US-ASCII")
    assert set(ascii_) == {"plain ascii", ""} and len(bad) == 3


def test_undecodable_run(spark, sf_dir):
    source, out = undecodable_source(spark, sf_dir), scratch_folder(spark, "job")
    job.run_feed(spark, LEDGER, source, out, file_name=FILE_NAME, encoding="UTF-8")
    raw = spark.read.text(source).select(F.hex(F.col("value").cast("binary")).alias("h"))
    bad = {r.h for r in raw.where(~F.is_valid_utf8(F.col("h").cast("string")) | F.col("h").contains("E9FC")).collect()}
    quarantined = spark.read.schema("_ROW_ID BIGINT, value STRING, _BYTES STRING").json(f"{out}/error")
    assert {r._BYTES for r in quarantined.collect()} == bad and len(bad) > 0
    target = spark.read.text(f"{out}/target").count()
    rejected = spark.read.option("header", True).option("sep", "|").option("lineSep", "\r\n").csv(f"{out}/rejected").count()
    assert raw.count() == target + rejected + quarantined.count()
    # the same bytes as Latin-1: nothing is quarantined, and the two letters keep the line's width
    latin = scratch_folder(spark, "job")
    job.run_feed(spark, LEDGER, source, latin, file_name=FILE_NAME, encoding="ISO-8859-1")
    lines = spark.read.text(f"{latin}/target").count() + spark.read.option("header", True).option("sep", "|") \
        .option("lineSep", "\r\n").csv(f"{latin}/rejected").count()
    assert lines == raw.count() and UNDECODABLE_EVERY > 1
