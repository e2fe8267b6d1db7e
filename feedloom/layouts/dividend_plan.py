"""Dividend plan feeds: by account (132 characters) and by security (102 characters).

All tables below are fixed values: names and positions of the feeds' fields.
"""

from .model import Feed, Structure, is_blank, plain, record

DIVIDEND_ACCOUNTS = Feed("dividend_accounts", 132, (
    record("Header record", is_blank(12, 132),
        plain("DATE= 1-11; FILLER 1 12")),
    record("DRIPA RECORD", (),
        plain("""CLIENT NUMBER 1-3; FILLER 2 4-8; BRANCH/ACCOUNT 9-16; CURRENCY 17-18;
              RR CODE 19-21; FILLER 3 22-26; NAME 27-56; MSD CODE 57-63; CUSIP 64-72;
              DESCRIPTION LINE 1 73-102; DESCRIPTION LINE 2 103-132""")),
), structure=(Structure("ROW TYPE[@[25]=None]"),))

DIVIDEND_SECURITIES = Feed("dividend_securities", 102, (
    record("Header record", is_blank(12, 102),
        plain("DATE= 1-11; FILLER 1 12")),
    record("DRIPS RECORD", (),
        plain("""CLIENT NUMBER 1-3; FILLER 2 4-8; MSD CODE 9-15; CUSIP 16-29;
              DESCRIPTION LINE 1 30-59; DESCRIPTION LINE 2 60-89; FILLER 3 90-94;
              BR/ACCOUNT 95-102""")),
), structure=(Structure("ROW TYPE[@[25]=None]"),))
