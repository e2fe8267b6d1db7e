"""Metadata bound by header name: other orders, missing columns, unknown and doubled names."""

import pytest

from feedloom.session import scratch_folder
from feedloom.sources.tables import FILE_METADATA, read_by_name


def _file(spark, text: str) -> str:
    folder = scratch_folder(spark, "meta")
    spark.createDataFrame([(line,) for line in text.splitlines()], "value string").coalesce(1).write.text(folder)
    return folder


def test_swapped_header_keeps_counts(spark):
    a = _file(spark, "ROW_TYPE_NO|ROW_TYPE|FIELDS_IN|FIELDS_OUT|TRANSFORMS\n1|ACCOUNT|9|10|2")
    b = _file(spark, "FIELDS_OUT|FIELDS_IN|ROW_TYPE|ROW_TYPE_NO\n12|11|HOLDER|2")
    rows = sorted(tuple(r) for r in read_by_name(spark, [a, b], FILE_METADATA).collect())
    assert rows == [(1, "ACCOUNT", 9, 10, 2), (2, "HOLDER", 11, 12, None)]


def test_unknown_or_doubled_names_fail(spark):
    with pytest.raises(ValueError, match="EXTRA"):
        read_by_name(spark, _file(spark, "ROW_TYPE_NO|EXTRA\n1|x"), FILE_METADATA).collect()
    with pytest.raises(ValueError, match="twice"):
        read_by_name(spark, _file(spark, "ROW_TYPE|row_type\nA|B"), FILE_METADATA).collect()
