"""The same results in plain SQL, for comparison with another engine."""

from __future__ import annotations

from ..functions.text import cut as _cut
from ..layouts import CODE_MAPS, CORRECTIONS, DEFAULTS, FEEDS, LOOKUPS, SPLIT_RANGES, STRICT_FEEDS
from ..layouts import reports
from ..layouts.model import BLANK, JOINED, LOOKUP, MAPPED, RECODE, UNRECOGNIZED, Feed, Field, RecordType
from .sample_lines import lines_sql
from .samples import ORDER_LINES_SQL, ledger_lines_sql, ledger_parts_sql

FILE_NAME = "SAMPLE"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def cut(start: int, end: int) -> str:
    return _cut(start, end, "value").replace("substring", "substr")


def case(key: str, values: dict, otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in values.items() if v is not None)
    return f"CASE {key} {whens} ELSE {otherwise} END"


# --- feeds: classify by CASE, one UNION branch per rule, last failure by row ---------------

def _tests(tests) -> str:
    return " AND ".join(f"{cut(t.start, t.end)} {'=' if t.equal else '<>'} {q(t.text)}"
                        for t in tests) or "TRUE"


def _translated(f: Field) -> str:
    if f.rule == LOOKUP:
        return case(cut(f.start, f.start if f.first_char else f.end), LOOKUPS[f.table])
    key = cut(f.start, f.end)
    return case(f"trim({key})" if f.trim_key else key, CODE_MAPS[f.table])


def _field(f: Field, t: RecordType) -> str:
    raw = cut(f.start, f.end)
    if f.rule in (LOOKUP, MAPPED):
        return f"coalesce({_translated(f)}, {raw})"
    if f.rule == RECODE:
        default = DEFAULTS[f.table]
        return f"coalesce({_translated(f)}, {raw if default is None else q(default)})"
    if f.rule == JOINED:
        parts = [cut(*p) if isinstance(p, tuple) else q(p[1:]) if p.startswith("=")
                 else _translated(t.field(p)) for p in f.parts]
        return f"coalesce({' || '.join(parts)}, '')"
    return raw


def _source(text: str) -> str:
    parts, rest = [], text
    while "{" in rest:
        before, rest = rest.split("{", 1)
        place, rest = rest.split("}", 1)
        a, _, b = place.partition("-")
        parts += [q(before), cut(int(a), int(b or a))]
    return " || ".join(parts + [q(rest)])


def _field_rules(feed: Feed, fields) -> list[tuple[str, int, str, str, str]]:
    out = []
    for f in fields:
        raw, source = cut(f.start, f.end), q(feed.exception_source(f))
        if f.rule == BLANK:
            out.append((f"trim({raw}) <> ''", -4, "INVALID_FILLER", source,
                        f"'Filler containing data [' || {raw} || ']'"))
        elif f.rule == LOOKUP:
            out.append((f"({_translated(f)}) IS NULL", -3, "INVALID_XREF", source,
                        f"'No lookup value for [' || {raw} || ']'"))
        elif f.rule == MAPPED:
            out.append((f"({_translated(f)}) IS NULL", -3, "INVALID_MAP", source,
                        f"'No mapped value for [' || {raw} || ']'"))
    return out


def feed_ctes(feed: Feed, lines: str) -> str:
    """CTEs ``typed`` (lines with type number), ``failed`` (a row per failure) and ``done``."""
    whens = " ".join(f"WHEN {_tests(t.when)} THEN {i}" for i, t in enumerate(feed.types))
    names = " ".join(f"WHEN {i} THEN {q(t.name)}" for i, t in enumerate(feed.types))
    structure = " ".join(f"WHEN {_tests(s.when)} THEN {_source(s.source)}" for s in feed.structure)
    rules = {-1: [("TRUE", -1, "INVALID_LENGHT", "'ROW'",
                   "'Invalid row length [' || CAST(length(value) AS VARCHAR) || ']'")],
             -2: _field_rules(feed, feed.common) + [
                 ("TRUE", -2, "INVALID_STRUCTURE", f"CASE {structure} END", "'Invalid row type'")]}
    rules |= {i: _field_rules(feed, t.fields) for i, t in enumerate(feed.types)}
    branches = [
        f"SELECT rn, _ROW_ID, {n} AS t, {o} AS ord, {st} AS st, {q(kind)} AS kind, {src} AS src,"
        f" {desc} AS descr FROM typed WHERE t = {n} AND {fails}"
        for n, group in rules.items() for o, (fails, st, kind, src, desc) in enumerate(group)]
    data = " ".join(
        f"WHEN {i} THEN " + (" || '|' || ".join(_field(f, t) for f in t.rendered) or "value")
        for i, t in enumerate(feed.types))
    return f"""WITH lines AS MATERIALIZED (SELECT *, row_number() OVER () AS rn FROM ({lines}) l0),
typed AS MATERIALIZED (SELECT *, CASE WHEN length(value) <> {feed.row_length} THEN -1 {whens} ELSE -2 END AS t
  FROM lines),
failed AS MATERIALIZED ({' UNION ALL '.join(branches)}),
last AS (SELECT rn, arg_max(st, ord) AS st FROM failed GROUP BY rn),
done AS MATERIALIZED (SELECT y.rn, y._ROW_ID, CASE y.t {names} ELSE {q(UNRECOGNIZED)} END AS _ROW_TYPE,
  CAST(coalesce(l.st, 0) AS INTEGER) AS _ROW_STATUS,
  CASE WHEN l.st IS NULL THEN CASE y.t {data} ELSE value END ELSE value END AS _ROW_DATA, y.value
  FROM typed y LEFT JOIN last l ON y.rn = l.rn)
"""


def feed_transform(feed: Feed, lines: str) -> str:
    return feed_ctes(feed, lines) + "SELECT _ROW_ID, _ROW_TYPE, _ROW_STATUS, _ROW_DATA FROM done"


def feed_exceptions(feed: Feed, lines: str) -> str:
    return feed_ctes(feed, lines) + (
        "SELECT f._ROW_ID, d._ROW_TYPE, f.kind AS _EXCEPTION_TYPE, f.src AS _EXCEPTION_SOURCE,"
        " f.descr AS _EXCEPTION_DESC FROM failed f JOIN done d ON f.rn = d.rn")


# --- reports ---------------------------------------------------------------------------------

def _rows(text: str) -> str:
    def cell(c: str) -> str:
        return "NULL" if c == "" else c if c.isdigit() else q(c)
    return ", ".join("(" + ", ".join(cell(c) for c in line.split("|")) + ")"
                     for line in text.splitlines()[1:])


def report_ctes(types: str) -> str:
    """Continues ``feed_ctes``: metadata, audit values and the filled report."""
    return f""", meta(no, name, fin, fout, tr) AS (VALUES {_rows(types)}),
cats(kind, cat) AS (VALUES {_rows(reports.EXCEPTION_TYPES)}),
template(line, sec, section, level, label, result) AS (VALUES {_rows(reports.REPORT_TEMPLATE)}),
good AS (SELECT _ROW_TYPE AS name, count(*) AS n FROM done WHERE _ROW_STATUS = 0 GROUP BY 1),
bad AS (SELECT _ROW_TYPE AS name, count(*) AS n FROM done WHERE _ROW_STATUS <> 0 GROUP BY 1),
vals(section, level, name, n) AS (
  SELECT 'ROWS_IN', 'FILE', '<file>', count(*) FROM done
  UNION ALL SELECT 'ROWS_OUT', 'FILE', '<file>', sum(n) FROM good
  UNION ALL SELECT 'ROWS_TRANSFORMED', 'FILE', '<file>', sum(n) FROM good
  UNION ALL SELECT 'ROWS_REJECTED', 'FILE', '<file>', sum(n) FROM bad
  UNION ALL SELECT 'ROWS_TRANSFORMED', 'ROW_TYPE', name, n FROM good JOIN meta USING (name)
  UNION ALL SELECT 'ROWS_OUT', 'ROW_TYPE', name, n FROM good JOIN meta USING (name)
  UNION ALL SELECT 'FIELDS_IN', 'ROW_TYPE', name, n * fin FROM good JOIN meta USING (name)
  UNION ALL SELECT 'FIELDS_OUT', 'ROW_TYPE', name, n * fout FROM good JOIN meta USING (name)
  UNION ALL SELECT 'TRANSFORMS', 'ROW_TYPE', name, n * tr FROM good JOIN meta USING (name)
  UNION ALL SELECT 'ROWS_REJECTED', 'ROW_TYPE', name, n FROM bad
  UNION ALL SELECT c.cat, 'ROW_TYPE', d._ROW_TYPE, count(*) FROM failed f JOIN done d ON f.rn = d.rn
    JOIN cats c ON c.kind = f.kind GROUP BY 1, 2, 3),
filled AS (SELECT t.line, t.sec, coalesce(m.no, 0) AS no, coalesce(m.name, '<file>') AS name, t.label,
    t.result, CAST(v.n AS BIGINT) AS n
  FROM template t LEFT JOIN meta m ON t.level = 'ROW_TYPE'
  LEFT JOIN vals v ON v.section = t.section AND v.level = t.level AND v.name = coalesce(m.name, '<file>'))
"""


LONG = (f"SELECT row_number() OVER (ORDER BY no, sec, line) - 1 AS REPORT_LINE_NO,"
        f" {q(FILE_NAME)} AS FILE_NAME, name AS ROW_TYPE, label AS REPORT_LINE_LABEL,"
        " result AS REPORT_RESULT_LABEL, n AS REPORT_RESULT_VALUE FROM filled")


def tabular() -> str:
    sums = ", ".join(
        f"CAST(sum(CASE WHEN result = {q(r)} THEN n END) AS BIGINT) AS {r.lower().replace(' ', '_')}"
        for r in reports.RESULT_LABELS)
    return (f"SELECT CAST(no + 1 AS INTEGER) AS report_line_no, {q(FILE_NAME)} AS file_name,"
            f" name AS row_type, {sums} FROM filled GROUP BY no, name")


# --- ledger lines: results from the columns of the table, not from the text --------------------

ACCOUNT_CASE = case("c_acct", LOOKUPS["account_type"])


def ledger(table: str) -> str:
    """The parts of every line with its type and status, decided on the source columns."""
    return f"""WITH parts AS (SELECT * FROM ({ledger_parts_sql(table)}) p0),
typed AS (SELECT *, CASE WHEN k % 17 = 0 THEN '<Unrecognized>' WHEN c_rec = '1' THEN 'ACCOUNT'
    WHEN c_rec = '2' THEN 'HOLDER' WHEN c_rec = '3' THEN 'BALANCE' ELSE '<Unrecognized>' END AS row_type,
  {ACCOUNT_CASE} AS acct FROM parts),
st AS (SELECT *, CASE WHEN k % 17 = 0 THEN -1 WHEN c_rec = '9' THEN -2 WHEN k % 13 = 0 THEN -4
    WHEN acct IS NULL THEN -3 ELSE 0 END AS status,
  '068' || c_key || c_nation || c_acct || c_rec || c_name || c_cents || c_sign ||
    CASE WHEN k % 17 = 0 THEN '' ELSE c_filler END AS line,
  '068|' || c_key || '|' || c_nation || '|' || acct || '|' || c_key || acct || '|' || c_rec || '|' ||
    c_name || '|' || c_cents || '|' || c_sign || '| ' AS rendered FROM typed),
failed AS (
  SELECT k, row_type, 1 AS ord, 'INVALID_LENGHT' AS kind, 'ROW' AS src, 'Invalid row length [59]' AS descr
    FROM st WHERE status = -1
  UNION ALL SELECT k, row_type, 1, 'INVALID_STRUCTURE', 'ROW TYPE[@[16]=9]', 'Invalid row type'
    FROM st WHERE status = -2
  UNION ALL SELECT k, row_type, 1, 'INVALID_XREF', 'ACCOUNT TYPE', 'No lookup value for [X]'
    FROM st WHERE status IN (-3, -4) AND acct IS NULL
  UNION ALL SELECT k, row_type, 2, 'INVALID_FILLER', 'FILLER@[60] (1)', 'Filler containing data [x]'
    FROM st WHERE status = -4)
"""


STATUS = "CAST(status AS INTEGER) AS _ROW_STATUS"
LEDGER_EXCEPTIONS = ("SELECT k AS _ROW_ID, row_type AS _ROW_TYPE, kind AS _EXCEPTION_TYPE,"
                     " src AS _EXCEPTION_SOURCE, descr AS _EXCEPTION_DESC FROM failed")
LEDGER_REJECTED = (f"SELECT k AS _ROW_ID, row_type AS _ROW_TYPE, {STATUS}, line AS _ROW_DATA"
                   " FROM st WHERE status <> 0")


def _ledger_report(table: str) -> str:
    from .queries import LEDGER_TYPES
    from .samples import LEDGER
    return feed_ctes(LEDGER, ledger_lines_sql(table)) + report_ctes(LEDGER_TYPES)


# Fields in, fields out and translated fields of the feeds without a metadata file.
TYPES = {
    "plan_valuation": "Header record|16|16|0\nKEY DATA RECORD|24|24|6\nTRAILER RECORD|15|14|0",
    "dividend_accounts": "Header record|2|2|0\nDRIPA RECORD|11|11|0",
    "dividend_securities": "Header record|2|2|0\nDRIPS RECORD|8|8|0",
    "beneficiary": "HEADER|9|9|0\nTRAILER|8|8|0\nRECORD LINE 1|23|23|0\nRECORD LINE 2|35|35|0\n"
                   "RECORD LINE 3|31|31|0\nRECORD LINE 4|18|18|0",
    "registered_plan": "HEADER|10|10|2\nREGISTERED PLAN RECORD|36|36|14\nPRINCIPAL RECORD 2|32|32|3\n"
                       "PRINCIPAL RECORD 3|8|8|2\nRRIF PAY INFO RECORD 1|44|44|8\nRRIF PAY INFO RECORD 2|22|22|3\n"
                       "RRIF PAY INFO RECORD 3|22|21|6\nDECEASED RECORD 1|10|10|2\nDECEASED RECORD 2|18|18|2\n"
                       "RRIF BANK B PAY INFO RECORD|32|32|6\nTRAILER|9|9|2",
}


def _types(name: str) -> str:
    if name in TYPES:
        lines = TYPES[name].split("\n") + [f"{UNRECOGNIZED}|0|0|0"]
        return "\n".join(["", *(f"{i}|{line}" for i, line in enumerate(lines, 1))])
    return {"position_balance": reports.POSITION_BALANCE_TYPES, "memo_position": reports.MEMO_POSITION_TYPES}[name]


def _with_missing(report: str) -> str:
    """The ledger report of a table whose rows with k % 23 = 0 have no line: they only came in."""
    from .queries import LEDGER_TYPES
    from .samples import LEDGER
    lines = f"SELECT _ROW_ID, value FROM ({ledger_lines_sql('customer')}) a0 WHERE _ROW_ID % 23 <> 0"
    ctes = report_ctes(LEDGER_TYPES).replace("SELECT 'ROWS_IN', 'FILE', '<file>', count(*) FROM done",
                                             "SELECT 'ROWS_IN', 'FILE', '<file>', count(*) FROM customer")
    return feed_ctes(LEDGER, lines) + ctes + report


def _split_columns() -> str:
    wanted = (1, 2, 3, 6, 8, 9, 10, 11, 21, 22)
    return ", ".join(f"trim({cut(a + 1, b)}) AS c{i}" for i, (a, b) in
                     enumerate(SPLIT_RANGES["1"], 1) if i in wanted)


def _split_cells() -> str:
    whens = " ".join(
        f"WHEN {q(s)} THEN " + " || '|' || ".join(f"trim({cut(a + 1, b)})" for a, b in ranges)
        for s, ranges in SPLIT_RANGES.items())
    sizes = " ".join(f"WHEN {q(s)} THEN {len(r)}" for s, r in SPLIT_RANGES.items())
    return f"""WITH s AS (SELECT value, CASE WHEN contains(value, 'DATE=') THEN 'header'
  WHEN substr(value, 25, 1) IN ('1', '2', '3', 'Z') THEN substr(value, 25, 1) END AS sheet
  FROM ({lines_sql(FEEDS['memo_position'])}) l)
SELECT sheet, CAST(CASE sheet {sizes} END AS INTEGER) AS cells, count(*) AS n,
  CAST(sum(length(CASE sheet {whens} END)) AS BIGINT) AS characters
FROM s WHERE sheet IS NOT NULL GROUP BY sheet"""


DESTINATIONS = """WITH o AS (SELECT o_orderkey, o_orderstatus AS s, o_orderkey % 3 = 0 AS bare,
  o_orderdate + CASE o_orderkey % 5 WHEN 1 THEN INTERVAL 330 MINUTE WHEN 2 THEN INTERVAL (-480) MINUTE
    ELSE INTERVAL 0 MINUTE END AS tm, o_orderkey % 4 AS m FROM orders)
SELECT o_orderkey,
  CASE WHEN bare THEN 'f' ELSE 'f.' || CAST(o_orderkey AS VARCHAR) END || '_' || strftime(tm, '%Y%m%d%H%M%S')
  || CASE m WHEN 1 THEN CASE WHEN bare THEN '.' || CAST(o_orderkey AS VARCHAR) ELSE '.txt' END
     WHEN 2 THEN '.csv' WHEN 3 THEN '.dat' ELSE '' END AS new_name,
  'in/' || s || '/' AS folder FROM o"""


def _job_counts() -> str:
    feed = FEEDS["memo_position"]
    lines = len(reports.MEMO_POSITION_TYPES.splitlines()) - 1
    template = [r.split("|")[3] for r in reports.REPORT_TEMPLATE.splitlines()[1:]]
    long = template.count("FILE") + template.count("ROW_TYPE") * lines
    return feed_ctes(feed, lines_sql(feed, "orders")) + (
        "SELECT 'target' AS output, count(*) AS rows FROM done WHERE _ROW_STATUS = 0"
        " UNION ALL SELECT 'rejected', count(*) FROM done WHERE _ROW_STATUS <> 0"
        " UNION ALL SELECT 'exceptions', count(*) FROM failed"
        f" UNION ALL SELECT 'audit', {long} UNION ALL SELECT 'audit_tab', {lines + 1}")


def all_oracles() -> dict[str, str]:
    weights = "VALUES ('ROWS_OUT', 1), ('FIELDS_IN', 9), ('FIELDS_OUT', 10), ('TRANSFORMS', 2)"
    header = "Customer Position Header"
    balance = FEEDS["position_balance"]
    fields = {f.name: _field(f, balance.type(header)) for f in balance.type(header).fields}
    header_no = [t.name for t in balance.types].index(header)
    nations = ("(SELECT arg_max('N' || CAST(n_nationkey AS VARCHAR), n_nationkey) FROM nation"
               " WHERE substr('1234567890X', CAST(n_nationkey % 11 + 1 AS INT), 1) = c_acct)")
    padded = ("(SELECT max('N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) FROM nation"
              " WHERE substr('1234567890X', CAST(n_nationkey % 11 + 1 AS INT), 1) = c_acct)")
    out = {
        "fw_extract": ledger("customer") + (
            "SELECT k AS _ROW_ID, '068' AS client, c_key AS key, c_nation AS nation,"
            " coalesce(acct, c_acct) AS account_type, coalesce(c_key || acct, '') AS new_account_type,"
            " c_name AS name, c_cents AS cents, c_sign AS sign FROM st WHERE row_type = 'ACCOUNT'"),
        "fw_typed_structs": ledger("lineitem") + (
            "SELECT k AS _ROW_ID, row_type AS _ROW_TYPE,"
            " CASE WHEN row_type = 'ACCOUNT' THEN c_cents END AS account_cents,"
            " CASE WHEN row_type = 'HOLDER' THEN c_name END AS holder_name,"
            " CASE WHEN row_type = 'BALANCE' THEN c_sign END AS balance_sign FROM st"),
        "fw_length_reject": ledger("customer") + (
            f"SELECT k AS _ROW_ID, row_type AS _ROW_TYPE, {STATUS},"
            " CAST(CASE WHEN status = -1 THEN 59 ELSE 60 END AS INTEGER) AS width"
            " FROM st WHERE status IN (-1, -2)"),
        "fw_classify": ledger("orders") + "SELECT k AS _ROW_ID, row_type AS _ROW_TYPE FROM st",
        "fw_xref_join": ledger("customer") + (
            "SELECT k AS _ROW_ID, row_type, coalesce(acct, c_acct) AS account_type FROM st"
            " WHERE row_type <> '<Unrecognized>'"),
        "fw_xref_exchange_class": feed_ctes(balance, lines_sql(balance)) + (
            f"SELECT _ROW_ID, {fields['EXCHANGE CODE']} AS exchange, {fields['MSD CLASS CODE']} AS class,"
            f" {fields['ACCOUNT RANGE INDICATOR']} AS side FROM typed WHERE t = {header_no}"),
        "fw_code_map": (
            "SELECT o_orderkey AS _ROW_ID, CASE o_orderstatus WHEN 'F' THEN 'RLIF' WHEN 'P' THEN 'PIPP'"
            " ELSE o_orderstatus END AS status, CASE o_orderstatus WHEN 'F' THEN 'A' ELSE 'Unknown' END AS action,"
            " CASE WHEN o_orderpriority LIKE '_-M%' THEN 'O' ELSE substr(o_orderpriority, 3, 1) END AS spin,"
            " CASE WHEN o_orderkey % 2 = 0 THEN 'G' ELSE 'N' END AS switch,"
            " CAST(CASE WHEN o_orderstatus NOT IN ('F', 'P') OR o_orderpriority NOT LIKE '_-M%' THEN -3 ELSE 0 END"
            " AS INTEGER) AS _ROW_STATUS FROM orders"),
        "fw_table_lookup": ledger("customer").replace(ACCOUNT_CASE, nations) + (
            f"SELECT k AS _ROW_ID, {STATUS},"
            " CASE WHEN status = 0 THEN rendered ELSE line END AS _ROW_DATA FROM st"),
        "fw_filler_check": ledger("customer") + (
            "SELECT k AS _ROW_ID, src AS _EXCEPTION_SOURCE, descr AS _EXCEPTION_DESC FROM failed"
            " WHERE kind = 'INVALID_FILLER'"),
        "fw_status_last_wins": ledger("customer") + f"SELECT k AS _ROW_ID, {STATUS} FROM st",
        "fw_route_accepted": ledger("lineitem") + (
            "SELECT k AS _ROW_ID, row_type AS _ROW_TYPE FROM st WHERE status = 0"),
        "fw_route_rejected": ledger("lineitem") + LEDGER_REJECTED,
        "fw_render_pipe": ledger("lineitem") + (
            "SELECT k AS _ROW_ID, rendered AS _ROW_DATA FROM st WHERE status = 0"),
        "fw_exceptions": ledger("customer") + LEDGER_EXCEPTIONS,
        "fw_failure_text": ledger("orders") + (
            "SELECT s.k AS _ROW_ID, CAST(s.status AS INTEGER) AS _ROW_STATUS,"
            " string_agg(f.kind || '#' || f.src || '#' || f.descr, ';' ORDER BY f.ord) AS _ROW_EXCEPTIONS"
            " FROM st s JOIN failed f ON s.k = f.k GROUP BY 1, 2"),
        "fw_split_failure_text": ledger("orders") + LEDGER_EXCEPTIONS,
        "fw_roundtrip_sorted": ledger("orders") + (
            "SELECT row_number() OVER (ORDER BY k) AS line_no, rendered AS value FROM st WHERE status = 0"),
        "fw_source_order": ledger("lineitem") + (
            "SELECT row_number() OVER (ORDER BY k, line) AS line_no, '068|' || c_key AS key"
            " FROM st WHERE status = 0"),
        "sink_rejected": ledger("orders") + LEDGER_REJECTED,
        "sink_exceptions": ledger("orders") + LEDGER_EXCEPTIONS,
        "sink_diagnostic": ledger("orders") + (
            "SELECT k AS _ROW_ID, row_type AS _ROW_TYPE, rendered AS _ROW_DATA FROM st WHERE status = 0"),
        "sink_quarantine": ledger("customer") + (
            "SELECT k AS _ROW_ID, CASE WHEN k % 23 = 0 THEN 'quarantined' WHEN status = 0 THEN 'accepted'"
            " ELSE 'rejected' END AS route FROM st"),
        "sink_job": _job_counts(),
        "job_target_order": ledger("orders") + (
            "SELECT row_number() OVER (ORDER BY k % 50 <> 0, k) AS line_no, rendered AS value FROM st WHERE status = 0"),
        "job_rejected": ledger("orders") + (
            f"SELECT row_type AS _ROW_TYPE, {STATUS}, line AS _ROW_DATA FROM st WHERE status <> 0"),
        "job_exceptions": ledger("orders") + LEDGER_EXCEPTIONS.replace("k AS _ROW_ID, ", ""),
        "job_audit": _with_missing(LONG),
        "job_audit_tab": _with_missing(tabular()),
        "job_quarantine": "SELECT c_custkey AS _ROW_ID, CAST(NULL AS VARCHAR) AS value FROM customer"
                          " WHERE c_custkey % 23 = 0",
        "meta_by_name": "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, CASE WHEN n_nationkey % 2 = 0"
                        " THEN n_name END AS n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation",
        "job_undecodable": ledger("customer") + (
            "SELECT 'in' AS output, count(*) AS rows FROM st"
            " UNION ALL SELECT 'target', count(*) FILTER (WHERE k % 29 <> 0 AND status = 0) FROM st"
            " UNION ALL SELECT 'rejected', count(*) FILTER (WHERE k % 29 <> 0 AND status <> 0) FROM st"
            " UNION ALL SELECT 'quarantined', count(*) FILTER (WHERE k % 29 = 0) FROM st"),
        "fw_lookup_duplicates": ledger("customer").replace(ACCOUNT_CASE, padded) + (
            f"SELECT k AS _ROW_ID, {STATUS}, CASE WHEN status = 0 THEN rendered ELSE line END AS _ROW_DATA FROM st"),
        "fw_lookup_large": ledger("customer").replace(ACCOUNT_CASE, padded) + (
            f"SELECT k AS _ROW_ID, {STATUS}, CASE WHEN status = 0 THEN rendered ELSE line END AS _ROW_DATA FROM st"),
        "source_table_lines": ledger("orders") + (
            f"SELECT row_type AS _ROW_TYPE, {STATUS}, count(*) AS n FROM st GROUP BY row_type, status"),
        "audit_counts": ledger("lineitem") + (
            ", c AS (SELECT row_type, status = 0 AS ok, count(*) AS n FROM st GROUP BY 1, 2)"
            " SELECT 'ROWS_IN' AS section, '<file>' AS row_type, CAST(sum(n) AS BIGINT) AS n FROM c"
            " UNION ALL SELECT 'ROWS_IN', row_type, CAST(sum(n) AS BIGINT) FROM c GROUP BY row_type"
            " UNION ALL SELECT 'ROWS_OUT', row_type, n FROM c WHERE ok"
            " UNION ALL SELECT 'ROWS_OUT', '<file>', CAST(sum(n) AS BIGINT) FROM c WHERE ok"
            " UNION ALL SELECT 'ROWS_REJECTED', row_type, n FROM c WHERE NOT ok"
            " UNION ALL SELECT 'ROWS_REJECTED', '<file>', CAST(sum(n) AS BIGINT) FROM c WHERE NOT ok"),
        "audit_totals": ("SELECT 'counted' AS how, count(*) AS n FROM orders"
                         " UNION ALL SELECT 'summed', count(*) FROM orders"),
        "audit_weighted_unpivot": ledger("lineitem") + (
            "SELECT row_type, w.section, CAST(count(*) * w.x AS BIGINT) AS n FROM st"
            f" CROSS JOIN ({weights}) w(section, x) WHERE status = 0 GROUP BY row_type, w.section, w.x"),
        "audit_exception_categories": ledger("customer") + (
            "SELECT row_type, CASE kind WHEN 'INVALID_FILLER' THEN 'EX_INV_DATA' WHEN 'INVALID_XREF'"
            " THEN 'EX_INV_TRANSFORM' ELSE 'EX_INV_SRUCT' END AS category, count(*) AS n"
            " FROM failed GROUP BY 1, 2"),
        "audit_values": _ledger_report("lineitem") + (
            "SELECT section, level, name AS row_type, CAST(n AS BIGINT) AS n FROM vals"
            " UNION ALL SELECT s, 'FILE', '<file>', CAST(sum(n) AS BIGINT) FROM bad,"
            " (VALUES ('ROWS_NOT_TRANSFORMED'), ('ROWS_NOT_OUT')) x(s) GROUP BY s"
            " UNION ALL SELECT 'ROWS_IN', 'ROW_TYPE', _ROW_TYPE, count(*) FROM done GROUP BY _ROW_TYPE"),
        "audit_report_long": _ledger_report("customer") + LONG,
        "audit_report_tabular": _ledger_report("customer") + tabular(),
        "type_split_trim": (
            f"SELECT _ROW_ID, {_split_columns()} FROM ({lines_sql(FEEDS['memo_position'], 'orders')}) l"
            " WHERE substr(value, 25, 1) = '1' AND NOT contains(value, 'DATE=')"),
        "type_split_cells": _split_cells(),
        "destination_names": DESTINATIONS,
    }
    for feed in FEEDS.values():
        out[f"{feed.name}_transform"] = feed_transform(feed, lines_sql(feed))
        out[f"{feed.name}_exceptions"] = feed_exceptions(feed, lines_sql(feed))
        out[f"{feed.name}_audit"] = feed_ctes(feed, lines_sql(feed)) + report_ctes(_types(feed.name)) + tabular()
    for name in CORRECTIONS:
        out[f"{name}_strict_transform"] = feed_transform(STRICT_FEEDS[name], lines_sql(STRICT_FEEDS[name]))
    return out
