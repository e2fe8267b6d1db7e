"""Two small feeds over the sample tables, and their lines.

The 60-character line carries a row of ``customer``, ``orders`` or ``lineitem``; the 20-character
line carries the codes of an order.
"""

from __future__ import annotations

from ..layouts.model import (Feed, Structure, blank, is_, joined, lookup, mapped, plain, recode,
                             record)


def _ledger(name: str, code: str):
    return record(name, is_(16, 16, code),
                  plain("CLIENT 1-3; KEY 4-11; NATION 12-14"),
                  lookup("ACCOUNT TYPE", 15, 15, "account_type"),
                  joined("NEW ACCOUNT TYPE", (4, 11), "ACCOUNT TYPE"),
                  plain("RECORD TYPE 16; NAME 17-46; CENTS 47-58; SIGN 59"),
                  blank("FILLER 1", 60, 60))


LEDGER = Feed("ledger", 60, (_ledger("ACCOUNT", "1"), _ledger("HOLDER", "2"),
                             _ledger("BALANCE", "3")),
              structure=(Structure("ROW TYPE[@[16]={16}]"),))

ORDER_CODES = Feed("order_codes", 20, (
    record("ORDER", (),
           mapped("STATUS", 1, 1, "plan_type"),
           recode("ACTION", 1, "action_code"),
           mapped("SPIN", 4, 4, "security_spin"),
           plain("PRIORITY 2-16"),
           recode("SWITCH", 17, "gross_net_switch"),
           blank("FILLER 1", 18, 20)),
), structure=(Structure("ROW TYPE"),))

# row key, nation, name and amount of a ledger line
LEDGER_COLUMNS = {
    "customer": ("c_custkey", "c_nationkey", "c_name", "c_acctbal"),
    "orders": ("o_orderkey", "o_custkey % 25", "o_orderstatus || ' ' || o_orderpriority",
               "o_totalprice"),
    "lineitem": ("l_orderkey * 10 + l_linenumber", "l_suppkey % 25",
                 "l_returnflag || l_linestatus || ' ' || CAST(l_partkey AS STRING)",
                 "l_extendedprice"),
}


def ledger_parts_sql(table: str) -> str:
    """The row as separate texts; ``ok_*`` tell what is wrong with the line."""
    key, nation, name, amount = LEDGER_COLUMNS[table]
    return (
        "SELECT k, lpad(CAST(k AS STRING), 8, '0') AS c_key, lpad(CAST(n AS STRING), 3, '0') AS c_nation,"
        " substr('1234567890X', CAST(k % 11 + 1 AS INT), 1) AS c_acct,"
        " CASE WHEN k % 19 = 0 THEN '9' ELSE CAST(k % 3 + 1 AS STRING) END AS c_rec,"
        " rpad(nm, 30, ' ') AS c_name,"
        " lpad(CAST(CAST(floor(abs(a) * 100) AS BIGINT) AS STRING), 12, '0') AS c_cents,"
        " CASE WHEN a < 0 THEN '-' ELSE '+' END AS c_sign,"
        " CASE WHEN k % 13 = 0 THEN 'x' ELSE ' ' END AS c_filler"
        f" FROM (SELECT {key} AS k, {nation} AS n, {name} AS nm, {amount} AS a FROM {table}) t0")


def ledger_lines_sql(table: str) -> str:
    return (
        "SELECT k AS _ROW_ID, CASE WHEN k % 17 = 0 THEN substr(v, 1, 59) ELSE v END AS value FROM ("
        "SELECT k, '068' || c_key || c_nation || c_acct || c_rec || c_name || c_cents || c_sign"
        f" || c_filler AS v FROM ({ledger_parts_sql(table)}) t1) t2")


ORDER_LINES_SQL = (
    "SELECT o_orderkey AS _ROW_ID, o_orderstatus || rpad(o_orderpriority, 15, ' ')"
    " || CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE 'N' END || '   ' AS value FROM orders")
