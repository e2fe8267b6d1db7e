import pytest
from pyspark.sql import functions as F

import by_hand
from feedloom.layouts import FEEDS
from feedloom.operators.exceptions import exception_rows, split_failure_text
from feedloom.operators.lookups import attach_lookup, checked_lookup
from feedloom.operators.route import accepted, failure_text, rejected
from feedloom.plans.samples import LEDGER, ORDER_CODES
from feedloom.plans.transform import extract, transform, typed
from feedloom.sources.tables import constant_lookup, unique_lookup


def as_lines(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "_ROW_ID BIGINT, value STRING")


def answer(df):
    return {r._ROW_ID: (r._ROW_TYPE, r._ROW_STATUS, [tuple(x) for x in r._ROW_EXCEPTIONS], r._ROW_DATA)
            for r in df.collect()}


@pytest.mark.parametrize("feed", [*FEEDS.values(), LEDGER, ORDER_CODES], ids=lambda f: f.name)
def test_against_brute_force(spark, feed):
    lines = [line for seed in (1, 2) for line in by_hand.fixture(feed, seed)]
    got = answer(transform(as_lines(spark, lines), feed))
    seen = set()
    for i, line in enumerate(lines):
        want = by_hand.apply(line, feed)
        assert got[i] == want
        seen.add((want[0], want[1]))
    # an option record has text where its first filler must be blank: it never passes
    assert {t.name for t in feed.types} - {"Option Header"} <= {t for t, status in seen if status == 0}


def one(spark, feed, line):
    return answer(transform(as_lines(spark, [line]), FEEDS[feed]))[0]


def put(width, **at):
    line = [" "] * width
    for start, text in at.items():
        start = int(start[1:])
        line[start - 1:start - 1 + len(text)] = text
    return "".join(line)


def test_security_dividend_record(spark):
    line = put(102, p1="068", p4="-----", p9="MSD0001", p16="CUSIP000000001", p30="FIRST", p60="SECOND",
               p90=".....", p95="12345678")
    assert one(spark, "dividend_securities", line) == (
        "DRIPS RECORD", 0, [], "068|-----|MSD0001|CUSIP000000001|" + "FIRST".ljust(30) + "|"
        + "SECOND".ljust(30) + "|.....|12345678")
    head = put(102, p1="DATE=251201")
    assert one(spark, "dividend_securities", head) == ("Header record", 0, [], "DATE=251201| ")


def test_memo_record(spark):
    line = put(144, p2="068", p5="123", p8="45678", p13="CAD", p16="2", p17="7", p18="SEC0001", p25="2",
               p26="0" * 16 + "5", p43="-", p133="+")
    quantities = "0" * 16 + "5|-|" + (" " * 17 + "| |") * 4 + " " * 17 + "|+"
    assert one(spark, "memo_position", line) == (
        "Memo T record", 0, [],
        " |068|123|45678|CAD|M|7|123M7|SEC0001|2|" + quantities + "|" + " " * 11)
    bad = line[:15] + "?" + line[16:143] + "#"
    assert one(spark, "memo_position", bad) == ("Memo T record", -4, [
        ("INVALID_XREF", "ACCOUNT TYPE", "No lookup value for [?]"),
        ("INVALID_FILLER", "FILLER@[134:144] (9)", "Filler containing data [          #]")], bad)


def test_memo_header_and_trailer_are_told_by_their_filler(spark):
    assert one(spark, "memo_position", put(144, p2="068", p25="1DATE="))[0] == "Header record"
    assert one(spark, "memo_position", put(144, p2="068", p5="9" * 20, p25="Z"))[0] == "Trailer record"
    assert one(spark, "memo_position", put(144, p2="068", p5="8" * 20, p25="Z"))[:3] == (
        "<Unrecognized>", -2,
        [("INVALID_STRUCTURE", "ROW TYPE[@[25]=<Unrecognized>,FILLER@[5:24]=" + "8" * 20 + "]",
          "Invalid row type")])


def test_valuation_record_recodes(spark):
    line = put(143, p2="068", p5="12345678", p14="1", p15="9", p16="D", p24="Q", p50="00000000001",
               p74="12")
    kind, status, failed, data = one(spark, "plan_valuation", line)
    cells = data.split("|")
    assert (kind, status, failed) == ("KEY DATA RECORD", 0, [])
    assert cells[2:7] == ["12345678", "C", "9", "12345678C", "R"]
    assert cells[8:12] == ["4", "G", "   ", "N"]
    unknown = line[:15] + "?" + line[16:23] + "?" + line[24:]
    cells = one(spark, "plan_valuation", unknown)[3].split("|")
    assert (cells[6], cells[8]) == ("Unknown", "Unknown")


def test_option_record(spark):
    line = put(349, p1="068123", p15="1", p16="123456", p22="A", p23="X", p29="11", p67="X ", p69="C ",
               p71="B", p72="M", p228="2", p253="251201", p298="7")
    # a blank at 23 would make it a position header
    assert line[22] == "X"
    kind, status, failed, _ = one(spark, "position_balance", line)
    assert (kind, status) == ("Option Header", -4)
    assert failed == [("INVALID_FILLER", "FILLER@[23:28] (1)", "Filler containing data [X     ]")]


def test_position_header(spark):
    line = put(349, p1="068", p4="123", p7="45678", p12="USD", p15="3", p16="SECNO01", p29="11",
               p31="NAME", p71="C", p181="-", p182="1" * 17, p228="7BCDEFG", p235="+", p236="2" * 17,
               p297="2", p300="5")
    kind, status, failed, data = one(spark, "position_balance", line)
    cells = data.split("|")
    assert (kind, status, failed, len(cells)) == ("Customer Position Header", 0, [], 49)
    assert cells[:10] == ["068", "123", "45678", "USD", "D", "123D5", "SECNO01", " " * 6, "1", "1"]
    assert cells[13] == "4" and cells[27:29] == ["-", "1" * 17]
    assert cells[36:39] == ["FFFFFFF", "+", "2" * 17] and cells[45:] == ["S", "  ", "5", " " * 49]
    missing = line[:227] + "5" + line[228:]
    assert one(spark, "position_balance", missing)[1:3] == (
        -3, [("INVALID_XREF", "MSD CLASS CODE", "No lookup value for [5BCDEFG]")])
    undecided = line[:21] + " " + "Z" + line[23:]
    assert one(spark, "position_balance", undecided)[:3] == ("<Unrecognized>", -2, [
        ("INVALID_STRUCTURE", "ROW TYPE[TRID=1,SPIN=1,@[22]= ]", "Invalid row type")])


def test_registered_plan_reports_codes_before_structure(spark):
    line = put(133, p13="555")
    assert one(spark, "registered_plan", line)[:3] == ("<Unrecognized>", -2, [
        ("INVALID_MAP", "TRID−CODE", "No mapped value for [55]"),
        ("INVALID_MAP", "TRID−CODE", "No mapped value for [5]"),
        ("INVALID_STRUCTURE", "ROW TYPE", "Invalid row type")])


def test_last_failure_wins_and_order_is_kept(spark):
    line = put(60, p15="X", p16="1", p60="x")
    got = answer(transform(as_lines(spark, [line]), LEDGER))[0]
    assert got[1] == -4 and [x[0] for x in got[2]] == ["INVALID_XREF", "INVALID_FILLER"]


def test_separator_in_data_is_not_lost(spark):
    rows = transform(as_lines(spark, [put(60, p15="#", p16="1")]), LEDGER)
    assert [tuple(r)[2:] for r in exception_rows(rows).collect()] == [
        ("INVALID_XREF", "ACCOUNT TYPE", "No lookup value for [#]")]
    text = failure_text(rows).select("_ROW_ID", "_ROW_TYPE", F.col("_ROW_EXCEPTIONS").alias("_ROW_EXCEPTION"))
    assert [tuple(r)[2:] for r in split_failure_text(text).collect()] == [
        ("INVALID_XREF", "ACCOUNT TYPE", "No lookup value for [#]")]


def test_routes_are_a_partition(spark):
    lines = by_hand.fixture(FEEDS["memo_position"])
    rows = transform(as_lines(spark, lines), FEEDS["memo_position"])
    assert accepted(rows).count() + rejected(rows).count() == len(lines)


def test_characters_not_bytes_are_counted(spark):
    line = put(102, p1="068", p9="é−’😀x", p95="12345678")
    assert one(spark, "dividend_securities", line)[3].split("|")[2] == "é−’😀x  "


def test_round_trip_of_plain_records(spark):
    lines = [x for x in by_hand.fixture(FEEDS["beneficiary"]) if len(x) == 199]
    back = transform(as_lines(spark, lines), FEEDS["beneficiary"])
    for r in back.collect():
        if r._ROW_STATUS == 0 and r._ROW_TYPE != "RECORD LINE 3":      # that one skips a position
            assert r._ROW_DATA.replace("|", "") == lines[r._ROW_ID].replace("|", "")


def test_extract_and_typed_agree(spark):
    feed = FEEDS["memo_position"]
    lines = as_lines(spark, by_hand.fixture(feed))
    fields = extract(lines, feed, "Memo H record")
    structs = typed(lines, feed, record_types=("Memo H record",)).where("`Memo H record` IS NOT NULL")
    assert len(fields.columns) == 24
    assert sorted(fields.collect()) == sorted(
        structs.select("_ROW_ID", "`Memo H record`.*").collect())


def test_lookup_last_duplicate_wins_and_null_is_a_miss(spark):
    table = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c"), ("2", None), (None, "d")],
                                  "k STRING, v STRING").coalesce(1)
    lookup, small = checked_lookup(unique_lookup(table))
    assert small and {tuple(r) for r in lookup.collect()} == {("1", "b"), ("2", None)}
    rows = transform(as_lines(spark, [put(60, p15=c, p16="1") for c in "123"]), LEDGER,
                     {"account_type": lookup})
    assert [answer(rows)[i][1] for i in range(3)] == [0, -3, -3]


def test_large_lookup_is_not_broadcast_and_gives_the_same(spark):
    feed = FEEDS["memo_position"]
    lines = as_lines(spark, by_hand.fixture(feed))
    values = constant_lookup(spark, {str(i): str(i) for i in range(50)})
    big, small = checked_lookup(values, max_rows=10)
    assert not small and checked_lookup(values)[1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = transform(lines, feed, {"account_type": big})
        assert "BroadcastHashJoin" not in plan(joined)
        want = answer(transform(lines, feed, {"account_type": checked_lookup(values)[0]}))
        assert answer(joined) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_has_no_shuffle_and_no_python(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\n")
    from feedloom.sources.lines import read_lines
    for feed in FEEDS.values():
        text = plan(transform(read_lines(spark, str(tmp_path / "in")), feed))
        for bad in ("Exchange hash", "Exchange range", "SortMergeJoin", "Python", "CartesianProduct",
                    "BroadcastNestedLoopJoin"):
            assert bad not in text, (feed.name, bad)


def test_routing_does_not_repeat_the_rules(spark):
    text = plan(accepted(transform(as_lines(spark, ["x"]), LEDGER)))
    filters = [line for line in text.splitlines() if " Filter " in line and "_ROW_STATUS" in line]
    assert filters and all("substring" not in line for line in filters)


def test_attach_lookup_keeps_every_row(spark):
    rows = as_lines(spark, ["1", "x", "1"])
    out = attach_lookup(rows, "value", constant_lookup(spark, {"1": "one"}), "t")
    assert {(r._ROW_ID, r._LOOKUP_t) for r in out.collect()} == {(0, "one"), (1, None), (2, "one")}


def test_lookup_from_the_catalog(spark):
    from feedloom.sources.tables import read_table_lookup
    spark.createDataFrame([("1", "one"), ("2", "two")], "code STRING, text STRING") \
        .createOrReplaceTempView("feedloom_codes")
    rows = transform(as_lines(spark, [put(60, p15="2", p16="1")]), LEDGER,
                     {"account_type": read_table_lookup(spark, "feedloom_codes")})
    assert answer(rows)[0][3].split("|")[3] == "two"


def test_extract_with_status(spark):
    feed = FEEDS["memo_position"]
    lines = as_lines(spark, by_hand.fixture(feed))
    status = {r._ROW_ID: r._ROW_STATUS for r in transform(lines, feed).collect()}
    rows = extract(lines, feed, "Memo T record", with_status=True).collect()
    assert rows and all(r._ROW_STATUS == status[r._ROW_ID] for r in rows)


def test_a_hot_record_type_with_a_large_lookup(spark):
    """Nine lines in ten have the same code; without a broadcast all of them are still there."""
    lines = spark.range(20000).selectExpr(
        "id AS _ROW_ID", "rpad(concat('068', lpad(id, 8, '0'), '001', if(id % 10 = 0, '2', '1'), '1'), 60, ' ') AS value")
    values = constant_lookup(spark, {"1": "C", "2": "M"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = transform(lines, LEDGER, {"account_type": values})
        assert "SortMergeJoin" in plan(rows) or "ShuffledHashJoin" in plan(rows)
        counts = {r[0]: r[1] for r in rows.selectExpr("split(_ROW_DATA, '[|]')[3] AS t").groupBy("t").count().collect()}
        assert counts == {"C": 18000, "M": 2000}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
