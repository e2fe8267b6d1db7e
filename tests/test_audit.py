from feedloom.layouts import FEEDS
from feedloom.operators import audit
from feedloom.operators.exceptions import exception_rows
from feedloom.operators.route import accepted, rejected
from feedloom.plans import job
from feedloom.plans.transform import transform

import by_hand
from test_transform import as_lines


def position_rows(spark):
    feed = FEEDS["position_balance"]
    return transform(as_lines(spark, by_hand.fixture(feed)), feed), job.Inputs().filled(spark, feed)


def test_report_sizes_and_numbers(spark):
    rows, inputs = position_rows(spark)
    filled = job.audit_report(rows, inputs, "F")
    long = audit.long_report(filled).collect()
    assert [r.REPORT_LINE_NO for r in long] == list(range(260))
    assert [r.REPORT_RESULT_LABEL for r in long[:8]] == [
        None, "Rows In", "Rows Out", "Rows Rejected", "Rows Transformed", "Rows Not Transformed",
        "Rows Not Output", None]
    tab = audit.tabular_report(filled).collect()
    assert [r.REPORT_LINE_NO for r in tab] == list(range(1, 20))
    assert tab[0].ROW_TYPE == "<file>" and tab[18].ROW_TYPE == "<Unrecognized>"


def test_report_reconciles_with_the_outputs(spark):
    rows, inputs = position_rows(spark)
    tab = {r.ROW_TYPE: r for r in audit.tabular_report(job.audit_report(rows, inputs, "F")).collect()}
    good, bad = accepted(rows).count(), rejected(rows).count()
    assert tab["<file>"]["Rows In"] == rows.count() == good + bad
    assert (tab["<file>"]["Rows Out"], tab["<file>"]["Rows Rejected"]) == (good, bad)
    assert tab["<file>"]["Rows Not Output"] is None
    types = [r for name, r in tab.items() if name != "<file>"]
    assert sum(r["Rows Rejected"] or 0 for r in types) == bad
    failures = exception_rows(rows).count()
    assert sum((r["Invalid structure"] or 0) + (r["Invalid transformation"] or 0)
               + (r["Invalid data"] or 0) for r in types) == failures
    loan = tab["Loan Account"]
    assert (loan["Fields In"], loan["Fields Out"], loan["Transformations"]) == tuple(
        loan["Rows Out"] * n for n in (19, 20, 2))


def test_complete_report_fills_the_open_lines(spark):
    rows, inputs = position_rows(spark)
    tab = {r.ROW_TYPE: r for r in audit.tabular_report(
        job.audit_report(rows, inputs, "F", complete=True)).collect()}
    bad = rejected(rows).count()
    assert tab["<file>"]["Rows Not Transformed"] == tab["<file>"]["Rows Not Output"] == bad
    assert sum(r["Rows In"] or 0 for n, r in tab.items() if n != "<file>") == rows.count()


def test_empty_input_still_reports(spark):
    feed = FEEDS["memo_position"]
    rows = transform(as_lines(spark, []), feed)
    tab = audit.tabular_report(job.audit_report(rows, job.Inputs().filled(spark, feed), "F")).collect()
    assert tab[0]["Rows In"] == 0 and tab[0]["Rows Out"] is None and len(tab) == 6


def test_counts_agree_with_plain_counting(spark):
    rows, inputs = position_rows(spark)
    counted = {(r.section, r._ROW_TYPE): r["count"] for r in audit.routed_counts(rows).collect()}
    for r in audit.type_counts(accepted(rows)).collect():
        assert counted["ROWS_OUT", r._ROW_TYPE] == r["count"]
    total = audit.total(audit.type_counts(rejected(rows))).first()["count"]
    assert counted["ROWS_REJECTED", "<file>"] == total
    assert audit.row_count(rows).first()["count"] == counted["ROWS_IN", "<file>"]


def test_totals_of_nothing_are_null(spark):
    rows = transform(as_lines(spark, []), FEEDS["memo_position"])
    assert audit.total(audit.type_counts(rows)).first()["count"] is None
    assert audit.row_count(rows).first()["count"] == 0


def test_layout_metadata_counts_fields(spark):
    rows = {r.ROW_TYPE: r for r in audit.layout_metadata(spark, FEEDS["memo_position"]).collect()}
    h = rows["Memo H record"]
    assert (h.FIELDS_IN, h.FIELDS_OUT, h.TRANSFORMS) == (22, 23, 2)


def test_the_data_is_read_once(spark, tmp_path):
    feed = FEEDS["memo_position"]
    as_lines(spark, by_hand.fixture(feed)).write.parquet(str(tmp_path / "lines"))
    rows = transform(spark.read.parquet(str(tmp_path / "lines")), feed)
    values = audit.audit_values(audit.tally(rows), *[getattr(job.Inputs().filled(spark, feed), n)
                                                     for n in ("file_metadata", "exception_metadata")])
    assert values._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
