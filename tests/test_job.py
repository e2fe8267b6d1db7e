import glob
import json

import pytest

import by_hand
from feedloom.layouts import FEEDS
from feedloom.operators.positions import line_numbers
from feedloom.operators.split_types import sheet_table, split_cells
from feedloom.plans.job import Inputs, run_feed
from feedloom.sinks import writers
from feedloom.sources.lines import read_lines, table_lines
from feedloom.sources.tables import read_lookup, read_pipe_csv, FILE_METADATA
from test_transform import as_lines


def raw(folder):
    files = sorted(glob.glob(f"{folder}/part-*") + glob.glob(f"{folder}/file=*/part-*"))
    return [open(f, newline="", encoding="utf-8").read() for f in files]


@pytest.fixture(scope="module")
def memo(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("memo")
    lines = by_hand.fixture(FEEDS["memo_position"]) * 40
    source = base / "MEMO.txt"
    source.write_text("\n".join(lines) + "\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")     # many partitions for one file
    run_feed(spark, "memo_position", str(source), str(base / "out"), diagnostic=True)
    yield lines, base / "out", [by_hand.apply(x, FEEDS["memo_position"]) for x in lines]
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_target_is_in_source_order_without_a_sort(memo):
    _, out, want = memo
    files = raw(out / "target")
    assert len(files) > 3
    text = "".join(files)
    assert text == "".join(w[3] + "\r\n" for w in want if w[1] == 0)


def test_rejected_is_ordered_by_type(memo):
    _, out, want = memo
    files = raw(out / "rejected")
    rows = [r for f in files for r in f.split("\r\n")[1:] if r]
    assert all(f.startswith("_ROW_ID|_ROW_TYPE|_ROW_STATUS|_ROW_DATA\r\n") for f in files)
    types = [r.split("|")[1] for r in rows]
    assert types == sorted(types) and len(rows) == sum(w[1] != 0 for w in want)


def test_exceptions_follow_the_rows(memo):
    _, out, want = memo
    rows = [r.split("|") for f in raw(out / "exceptions") for r in f.split("\r\n")[1:] if r]
    assert [r[2] for r in rows] == [x[0] for w in want for x in w[2]]
    assert [int(r[0]) for r in rows] == sorted(int(r[0]) for r in rows)


def test_reports_are_single_tab_files(memo):
    lines, out, want = memo
    long, tab = raw(out / "audit"), raw(out / "audit_tab")
    assert len(long) == len(tab) == 1
    rows = [r.split("\t") for r in long[0].split("\r\n")]
    assert rows[0] == ["REPORT_LINE_NO", "FILE_NAME", "ROW_TYPE", "REPORT_LINE_LABEL",
                       "REPORT_RESULT_LABEL", "REPORT_RESULT_VALUE"]
    assert rows[2][1:] == ["MEMO.txt", "<file>", "", "Rows In", str(len(lines))]
    head, file_row = (r.split("\t") for r in tab[0].split("\r\n")[:2])
    assert dict(zip(head, file_row))["Rows Out"] == str(sum(w[1] == 0 for w in want))


def test_diagnostic_keeps_blanks(memo):
    _, out, want = memo
    rows = [r for f in raw(out / "target_with_row_id") for r in f.split("\r\n")[1:] if r]
    kept = [r.split("|", 2)[2].strip('"') for r in rows]
    assert sorted(kept) == sorted(w[3] for w in want if w[1] == 0)


def test_a_second_run_appends(spark, tmp_path):
    source = tmp_path / "s.txt"
    source.write_text(by_hand.fixture(FEEDS["beneficiary"])[3] + "\n", encoding="utf-8")
    for _ in range(2):
        run_feed(spark, "beneficiary", str(source), str(tmp_path / "out"))
    assert len("".join(raw(tmp_path / "out" / "target")).split("\r\n")) == 3
    run_feed(spark, "beneficiary", str(source), str(tmp_path / "out"), mode="overwrite")
    assert len("".join(raw(tmp_path / "out" / "target")).split("\r\n")) == 2


def test_a_small_file_before_a_large_one(spark, tmp_path):
    good = next(x for x in by_hand.fixture(FEEDS["beneficiary"])
                if by_hand.apply(x, FEEDS["beneficiary"])[1] == 0)
    source = tmp_path / "in"
    source.mkdir()
    small, large = [good[:180] + f"{i:06d}" + good[186:] for i in range(5)], [
        good[:180] + f"{i:06d}" + good[186:] for i in range(5, 20_000)]
    (source / "a.txt").write_text("\n".join(small) + "\n", encoding="utf-8")
    (source / "b.txt").write_text("\n".join(large) + "\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    run_feed(spark, "beneficiary", str(source), str(tmp_path / "out"))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [by_hand.apply(x, FEEDS["beneficiary"])[3] for x in small + large]
    got = line_numbers(read_lines(spark, str(tmp_path / "out" / "target"), origin=True)).orderBy("_LINE_NO")
    assert [r.value for r in got.collect()] == [w for w, x in zip(want, small + large)
                                                 if by_hand.apply(x, FEEDS["beneficiary"])[1] == 0]
    assert sorted(p.name for p in (tmp_path / "out" / "target").iterdir() if p.is_dir()) == ["file=a.txt", "file=b.txt"]


def test_rejected_lines_are_untouched(memo):
    lines, out, want = memo
    rows = [r.split("|", 3)[3] for f in raw(out / "rejected") for r in f.split("\r\n")[1:] if r]
    kept = {r[1:-1].replace('\\"', '"') if r.startswith('"') else r for r in rows}
    assert kept == {x for x, w in zip(lines, want) if w[1] != 0}


def test_rows_in_are_out_rejected_and_missing(spark, tmp_path):
    lines = by_hand.fixture(FEEDS["beneficiary"])
    rows = [(i, x) for i, x in enumerate(lines)] + [(1000, None), (1001, None)]
    run_feed(spark, "beneficiary", spark.createDataFrame(rows, "_ROW_ID BIGINT, value STRING"), str(tmp_path / "out"))
    head, total = (r.split("\t") for r in raw(tmp_path / "out" / "audit_tab")[0].split("\r\n")[:2])
    total = dict(zip(head, total))
    assert int(total["Rows In"]) == len(rows) == int(total["Rows Out"]) + int(total["Rows Rejected"]) + 2


def test_part_numbers_beyond_five_digits(spark, tmp_path):
    for n in (99_999, 100_000, 7):
        (tmp_path / f"part-{n:05d}-x.txt").write_text(f"{n}\n", encoding="utf-8")
    got = line_numbers(read_lines(spark, str(tmp_path), origin=True)).orderBy("_LINE_NO").collect()
    assert [r.value for r in got] == ["7", "99999", "100000"]


def test_line_numbers_move_no_line(spark, tmp_path):
    (tmp_path / "s.txt").write_text("x\n" * 100, encoding="utf-8")
    plan = line_numbers(read_lines(spark, str(tmp_path), origin=True))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_no_description_is_built_for_a_tally(spark):
    from feedloom.operators.audit import tally
    from feedloom.plans.transform import outcomes
    plan = tally(outcomes(as_lines(spark, ["x"]), FEEDS["position_balance"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Filler containing data" not in plan and "No lookup value" not in plan


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from feedloom import session

    class Fake:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://somewhere:7077"
            getConf = staticmethod(lambda: Fake.conf)
    with pytest.raises(ValueError):
        session.scratch_folder(Fake, "x")


def test_empty_outputs_can_be_skipped(spark, tmp_path):
    source = tmp_path / "s.txt"
    source.write_text(by_hand.fixture(FEEDS["beneficiary"])[3] + "\n", encoding="utf-8")
    run_feed(spark, "beneficiary", str(source), str(tmp_path / "out"), skip_empty=True)
    assert not (tmp_path / "out" / "rejected").exists() and (tmp_path / "out" / "target").exists()


def test_table_source_quarantines_missing_lines(spark, tmp_path):
    line = by_hand.fixture(FEEDS["beneficiary"])[3]
    spark.createDataFrame([(line,), (None,)], "value STRING").createOrReplaceTempView("feed_lines")
    run_feed(spark, "beneficiary", table_lines(spark, "feed_lines"), str(tmp_path / "out"))
    errors = [json.loads(x) for f in raw(tmp_path / "out" / "error") for x in f.splitlines()]
    assert [e["value"] for e in errors] == [None]
    assert raw(tmp_path / "out" / "target")[-1].count("\r\n") == 1


def test_lookup_and_metadata_files(spark, tmp_path):
    (tmp_path / "acc.txt").write_text("_Key_AccType|_Value_AccType\n1|CC\n5|\n", encoding="utf-8")
    (tmp_path / "meta.txt").write_text(
        "ROW_TYPE_NO|ROW_TYPE|FIELDS_IN|FIELDS_OUT|TRANSFORMS\n1|Memo T record|5|6|7\n", encoding="utf-8")
    line = next(x for x in by_hand.fixture(FEEDS["memo_position"])
                if by_hand.apply(x, FEEDS["memo_position"])[:2] == ("Memo T record", 0))
    source = tmp_path / "s.txt"
    source.write_text("\n".join(line[:15] + c + line[16:] for c in "152"), encoding="utf-8")
    run_feed(spark, "memo_position", str(source), str(tmp_path / "out"), inputs=Inputs(
        lookups={"account_type": read_lookup(spark, str(tmp_path / "acc.txt"))},
        file_metadata=read_pipe_csv(spark, str(tmp_path / "meta.txt"), FILE_METADATA)))
    assert "".join(raw(tmp_path / "out" / "target")).split("|")[5] == "CC"
    report = raw(tmp_path / "out" / "audit")[0].split("\r\n")
    assert len(report) == 1 + 8 + 14 + 1
    assert any(r.endswith("Memo T record\t\tTransformations\t7") for r in report)


def test_order_survives_an_explicit_sort(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id AS _ROW_ID", "concat('r', id) AS _ROW_DATA") \
        .repartition(7)
    writers.write_target(rows, str(tmp_path / "t"), order=("_ROW_ID",))
    assert "".join(raw(tmp_path / "t")) == "".join(f"r{i}\r\n" for i in range(5000))
    numbered = line_numbers(read_lines(spark, str(tmp_path / "t"), origin=True))
    assert {(r._LINE_NO, r.value) for r in numbered.collect()} == {(i + 1, f"r{i}") for i in range(5000)}


def test_row_ids_beyond_32_bits(spark, tmp_path):
    rows = spark.createDataFrame([(2 ** 33 + 1, "b"), (5, "a")], "_ROW_ID BIGINT, _ROW_DATA STRING")
    writers.write_target(rows, str(tmp_path / "t"), order=("_ROW_ID",))
    assert "".join(raw(tmp_path / "t")) == "a\r\nb\r\n"


def test_split_into_sheets(spark, tmp_path):
    lines = [" 068" + " " * 20 + "1DATE=251201      ADP", " 068\t12 3" + " " * 15 + "1" + "x" * 119,
             " 068" + "9" * 20 + "Z", "short", " " * 24 + "7", "DATE="]
    cells = {r._ROW_ID: (r._SHEET, list(r._CELLS)) for r in split_cells(as_lines(spark, lines)).collect()}
    assert set(cells) == {0, 1, 2, 5}
    assert cells[0] == ("header", ["", "068", "", "1", "DATE=", "251201", "ADP", ""])
    assert cells[1][0] == "1" and cells[1][1][:4] == ["", "068", "12", "3"] and len(cells[1][1]) == 22
    assert cells[2] == ("Z", ["", "068", "9" * 20, "Z", "", "", ""])
    assert sheet_table(as_lines(spark, lines), "1").columns[-1] == "c22"
    writers.write_split(split_cells(as_lines(spark, lines)), str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == [
        "_SHEET=1", "_SHEET=Z", "_SHEET=header"]
