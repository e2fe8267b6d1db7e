"""Report metadata: pipe-delimited text with a header, as the jobs read it from files."""

# --- fixed values: record types of the position and balance feed ----------------
POSITION_BALANCE_TYPES = """\
ROW_TYPE_NO|ROW_TYPE|FIELDS_IN|FIELDS_OUT|TRANSFORMS
1|Header record|1|1|0
2|Customer Position Header|48|49|5
3|Option Header|30|31|7
4|Customer Position Trailer|17|18|2
5|When-Issue Customer Trailer|17|18|2
6|When-Issue Customer Header|28|29|3
7|When-Issue Trading Header|18|19|3
8|Trading Analysis Trade Date|39|40|4
9|Trading Analysis Settlement Date|34|35|2
10|When-Issue Trading Trailer|35|36|2
11|Customer Balance, F/Type|37|38|2
12|Loan Account|19|20|2
13|Customer Balance, Last in Account|50|51|3
14|Client Totals Header|1|1|0
15|Client Totals Trailer|1|1|0
16|Date Record|1|1|0
17|Trailer record|1|1|0
18|<Unrecognized>|0|0|0
"""

# --- fixed values: record types of the memo position feed ------------------------
MEMO_POSITION_TYPES = """\
ROW_TYPE_NO|ROW_TYPE|FIELDS_IN|FIELDS_OUT|TRANSFORMS
1|Header record|8|8|0
2|Memo H record|22|23|2
3|Memo T record|22|23|2
4|Memo M record|16|17|2
5|Trailer record|7|7|0
"""

# --- fixed values: exception categories -------------------------------------------
EXCEPTION_TYPES = """\
EXCEPTION_TYPE|EXCEPTION_CATEGORY
INVALID_LENGHT|EX_INV_SRUCT
INVALID_STRUCTURE|EX_INV_SRUCT
INVALID_XREF|EX_INV_TRANSFORM
INVALID_MAP|EX_INV_TRANSFORM
INVALID_FILLER|EX_INV_DATA
MISSING_DATA|EX_MISSING_DATA
"""

# --- fixed values: lines of the audit report ----------------------------------------
REPORT_TEMPLATE = """\
REPORT_LINE_NO|REPORT_SECTION_NO|REPORT_SECTION|REPORT_LEVEL|REPORT_LINE_LABEL|REPORT_RESULT_LABEL
0|0|SECTION|FILE|File:|
1|1|ROWS_IN|FILE||Rows In
2|1|ROWS_OUT|FILE||Rows Out
3|1|ROWS_REJECTED|FILE||Rows Rejected
4|1|ROWS_TRANSFORMED|FILE||Rows Transformed
5|1|ROWS_NOT_TRANSFORMED|FILE||Rows Not Transformed
6|1|ROWS_NOT_OUT|FILE||Rows Not Output
7|2|SECTION|FILE|Row Types:|
8|3|SECTION|ROW_TYPE|Rows:|
9|4|ROWS_IN|ROW_TYPE||Rows In
10|4|ROWS_OUT|ROW_TYPE||Rows Out
11|4|ROWS_REJECTED|ROW_TYPE||Rows Rejected
12|4|ROWS_TRANSFORMED|ROW_TYPE||Rows Transformed
13|5|SECTION|ROW_TYPE|Row details:|
14|6|FIELDS_IN|ROW_TYPE||Fields In
15|6|FIELDS_OUT|ROW_TYPE||Fields Out
16|6|TRANSFORMS|ROW_TYPE||Transformations
17|7|SECTION|ROW_TYPE|Exceptions categories:|
18|8|EX_INV_SRUCT|ROW_TYPE||Invalid structure
19|8|EX_INV_TRANSFORM|ROW_TYPE||Invalid transformation
20|8|EX_INV_DATA|ROW_TYPE||Invalid data
21|8|EX_MISSING_DATA|ROW_TYPE||Missing data
"""

# --- fixed values: result columns of the tabular audit report, in order ---------------
RESULT_LABELS = (
    "Rows In", "Rows Out", "Rows Rejected", "Rows Transformed", "Rows Not Transformed",
    "Rows Not Output", "Fields In", "Fields Out", "Transformations", "Invalid structure",
    "Invalid transformation", "Invalid data", "Missing data")
