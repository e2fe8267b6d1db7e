"""Plan valuation feed: 143 characters, 3 record types told apart by blank regions.

All tables below are fixed values: names and positions of the feed's fields.
"""

from .model import (Feed, Structure, blank, is_blank, joined, lookup, not_blank, plain, recode,
                    record)

PLAN_VALUATION = Feed("plan_valuation", 143, (
    record("Header record", is_blank(50, 51),
        plain("""CARRIAGE 1; HDR CLT 2-4; HDR KEY1 5-14; HDR PROC LIT DATE= 15-19; HDR MM 20-21;
              HDR DD 22-23; HDR YY 24-25; HDR DT LIT1 DATE= 26-30; HDR PR DATE 31-36;
              HDR SYS DATE 37-42; HDR TIME 43-48; HDR FILLER1 49-51; HDR DSN 52-68;
              HDR PGM 69-76; HDR CLT1 77-79"""),
        blank("FILLER 5", 80, 143, "FILLER@[80:144] (4)")),
    record("KEY DATA RECORD", (is_blank(93, 143), not_blank(74, 75)),
        plain("CARRIAGE 1; CLT 2-4; BRACCT 5-12"),
        lookup("TYPE", 14, 14, "account_type", "ACCOUNT TYPE"),
        plain("CHKDIG 15"),
        joined("NEW TYPE", (5, 12), "TYPE"),
        recode("ACTION-CODE:", 16, "action_code"),
        plain("FIRST-PAY 17-23"),
        recode("FREQ:", 24, "payment_frequency"),
        recode("GRNET-SW:", 25, "gross_net_switch"),
        plain("AGE 26-28"),
        recode("WITHHOLD:", 29, "withhold"),
        plain("""PAY-AMT 30-38; PAY-AMT-SIGN 39; ANN-PAY 40-48; ANN-PAY-SIGN 49; YE-VAL 50-60;
              YE-VAL-SIGN 61; MIN-PAY 62-70; MIN-PAY-SIGN 71; MAX-PAY 72-80; MAX-PAY-SIGN 81;
              YTD-TAXES 82-92; FILLER 1 93-143"""),
        blank("FILLER 5", 93, 143, "FILLER@[93:144] (4)", hidden=True)),
    record("TRAILER RECORD", is_blank(74, 75),
        plain("""CARRIAGE 1; TLR CLT 2-4; TLR KEY1 5-14; TLR LIT CNTR= 15-19; TLR TOT 20-30;
              TLR LIT1 CNT= 31-38; TLR REC TOT 39-49; TLR PRC DATE 50-55; TLR SYS DATE 56-61;
              TLE SYS TIME 62-67; TLR SYS PGM 68-74; TLR FILLER 75-76; TLR CLT1 77-79;
              TLE FILLER1 80-143"""),
        blank("FILLER 5", 80, 143, "FILLER@[80:144] (5)", hidden=True)),
), structure=(Structure("ROW TYPE[@[25]=None]"),))
