"""Position and balance feed: 349 characters, 15 record types.

All tables below are fixed values: names and positions of the feed's fields.
"""

from .model import (Feed, Structure, blank, is_, is_blank, joined, lookup, mapped, not_blank,
                    plain, record)


def account_key(check_digit):
    """Leading fields shared by every account record; the check digit sits elsewhere per type."""
    digit = check_digit if isinstance(check_digit, str) else (check_digit, check_digit)
    return (
        *plain("""CLIENT NUMBER 1-3; BRANCH NUMBER 4-6; ACCOUNT NUMBER 7-11;
                  FOREIGN CURRENCY CODE 12-14"""),
        lookup("ACCOUNT TYPE", 15, 15, "account_type"),
        joined("NEW ACCOUNT TYPE", (4, 6), "ACCOUNT TYPE", digit),
    )


POSITION_BALANCE = Feed("position_balance", 349, (
    record("Customer Position Header", (is_(29, 30, "11"), is_blank(23, 23)),
        account_key(300),
        plain("SECURITY NUMBER 16-22"),
        blank("FILLER 1", 23, 28),
        plain("""TRID 29; SPIN 30; SECURITY DESCRIPTION LINE 1 31-60; DATE LAST ACTIVE 61-66;
              MEMO FLAGS (0000) 67-70"""),
        lookup("EXCHANGE CODE", 71, 71, "exchange"),
        plain("""SECURITY SPIN 72; TRADE DATE QUANTITY SIGN 73; TRADE DATE QUANTITY 74-90;
              SETTLEMENT DATE QUANTITY SIGN 91; SETTLEMENT DATE QUANTITY 92-108;
              MEMO FIELD 1 SIGN 109; MEMO FIELD 1 110-126; MEMO FIELD 2 SIGN 127;
              MEMO FIELD 2 128-144; MEMO FIELD 3 SIGN 145; MEMO FIELD 3 146-162;
              MEMO FIELD 4 SIGN 163; MEMO FIELD 4 164-180; SHORT VS BOX SIGN 181;
              SHORT VS BOX 182-198; NUMBER OF SHORT DAYS SIGN 199; NUMBER OF SHORT DAYS 200;
              HOUSE REQUIREMENT % SIGN 201; HOUSE REQUIREMENT % 202-204;
              RECORD FLAGS 205-208; MARKET PRICE 209-223; IDA 224-227"""),
        lookup("MSD CLASS CODE", 228, 234, "security_class", first_char=True),
        plain("""MARKET VALUE SIGN 235; MARKET VALUE 236-252; MATURITY DATE 253-258;
              HOUSE REQUIREMENT AMOUNT SIGN 259; HOUSE REQUIREMENT AMOUNT 258-276;
              S/D REQUIREMENT AMOUNT SIGN 277; S/D REQUIREMENT AMOUNT 278-294;
              PREFERRED SEG SECURITY FLAG 295-296"""),
        mapped("ACCOUNT RANGE INDICATOR", 297, 297, "transaction_side"),
        blank("FILLER 8", 298, 299),
        plain("ACCOUNT CHECK DIGIT 300"),
        blank("FILLER 9", 301, 349)),
    record("Option Header", (is_(29, 30, "11"), not_blank(22, 22)),
        account_key(298),
        plain("UNDERLYING SECURITY NUMBER 16-21; OPTION BYTE 22"),
        blank("FILLER 1", 23, 28),
        plain("TRID 29; SPIN 30; SECURITY DESCRIPTION 31-60"),
        blank("FILLER 2", 61, 66),
        plain("OPTION SECURITY NUMBER 67-72"),
        mapped("EXPIRATION CODE", 67, 68, "expiration_code"),
        mapped("OPTION CODE", 69, 70, "option_code", trim_key=True),
        lookup("EXCHANGE CODE", 71, 71, "exchange"),
        mapped("SECURITY SPIN", 72, 72, "security_spin"),
        plain("""LONG QUANTITY SIGN 73; LONG QUANTITY 74-90; SHORT QUANTITY SIGN 91;
              SHORT QUANTITY 92-106; STRIKE PRICE 210-223; IDA 224-227"""),
        lookup("MSD CLASS CODE", 228, 234, "security_class", first_char=True),
        blank("FILLER 7", 235, 252),
        plain("EXPIRATION DATE 253-258"),
        blank("FILLER 8", 259, 297),
        plain("LAST DIGIT OF UNDERLYING SECURITY NUMBER 297; ACCOUNT CHECK DIGIT 298"),
        blank("FILLER 9", 299, 349, "FILLER@[259:297] (9)")),
    record("Customer Position Trailer", is_(29, 30, "12"),
        account_key(86),
        plain("SECURITY NUMBER 16-22"),
        blank("FILLER 1", 23, 28),
        plain("""TRID 29; SPIN 30; SECURITY DESCRIPTION LINE 2 31-60;
              MATURITY OR EXPIRATION DATE 61-69; BOND INTEREST RATE 69-79; FREQUENCY CODE 80;
              CALL CODE 81; DATED DATE 82-85; ACCOUNT CHECK DIGIT 86"""),
        blank("FILLER 9", 87, 349, "FILLER@[259:297] (9)")),
    record("When-Issue Customer Trailer", is_(29, 30, "22"),
        account_key(86),
        plain("SECURITY NUMBER 16-22"),
        blank("FILLER 1", 23, 28),
        plain("""TRID 29; SPIN 30; SECURITY DESC 31-60; MATURITY OR EXPIRATION DATE 61-69;
              BOND INTEREST RATE 69-79; FREQUENCY CODE 80; CALL CODE 81; DATED DATE 82-85;
              ACCOUNT CHECK DIGIT 86"""),
        blank("FILLER 9", 87, 349)),
    record("When-Issue Customer Header", is_(29, 30, "21"),
        account_key(267),
        plain("SECURITY NUMBER 16-22"),
        blank("FILLER 1", 23, 28),
        plain("TRID 29; SPIN 30; SECURITY DESC 31-60; DATE LAST ACTIVE 61-66"),
        blank("FILLER 2", 61, 68),
        lookup("EXCHANGE CODE", 69, 69, "exchange"),
        plain("""SECURITY SPIN 70; QUANTITY SIGN 71; QUANTITY 72-88;
              CONTRACT PRICE (INTEGER) 89-96; CONTRACT PRICE (FRACTION) 97-104;
              CONTRACT VALUE SIGN 105; CONTRACT VALUE 106-122; MARKET VALUE SIGN 123;
              MARKET VALUE 124-140"""),
        blank("FILLER 7", 141, 142),
        plain("RECORD FLAGS 143-144; MARKET PRICE 145-161"),
        blank("FILLER 8", 162, 266),
        plain("ACCOUNT CHECK DIGIT 267"),
        blank("FILLER 9", 268, 349)),
    record("When-Issue Trading Header", is_(29, 30, "2A"),
        account_key(267),
        plain("SECURITY NUMBER 16-22"),
        blank("FILLER 1", 23, 28),
        plain("TRID 29; SPIN 30; SECURITY DESCRIPTION 31-60; DATE LAST ACTIVE 61-66"),
        blank("FILLER 2", 61, 68),
        lookup("EXCHANGE CODE", 69, 69, "exchange"),
        plain("""SECURITY SPIN 70; QUANTITY SIGN 71; QUANTITY 72-88;
              CONTRACT PRICE (INTEGER) 89-96; CONTRACT PRICE (FRACTION) 97-104;
              CONTRACT VALUE SIGN 105; CONTRACT VALUE 106-122; MARKET VALUE SIGN 123;
              MARKET VALUE 124-140"""),
        blank("FILLER 7", 141, 142),
        plain("RECORD FLAGS 143-144; MARKET PRICE 145-161"),
        blank("FILLER 8", 162, 266),
        plain("ACCOUNT CHECK DIGIT 267"),
        blank("FILLER 9", 268, 349)),
    record("Trading Analysis Trade Date", is_(29, 30, "1A"),
        account_key(349),
        plain("SECURITY NUMBER 16-22"),
        blank("FILLER 1", 23, 28),
        plain("TRID 29; SPIN 30; SECURITY DESCRIPTION 31-60; BOOK DLA 61-66; MARGIN DLA 67-72"),
        blank("FILLER 2", 73, 76),
        lookup("EXCHANGE CODE", 77, 77, "exchange"),
        plain("""SECURITY SPIN 78; T/D QUANTITY 79-95; T/D QUANTITY SIGN 96; T/D COST 97-113;
              T/D COST SIGN 114; T/D UNREALIZED P/L 115-131; T/D UNREALIZED P/L SIGN 132;
              BOND FREQUENCY CODE 133-134; DATE LAST CALCULATED 135-140; HAIRCUT % 141-143;
              HAIRCUT % SIGN 144; CONCESSION 145-159; CONCESSION SIGN 160;
              HOUSE PRICE 161-175; HOUSE PRICE SIGN 176; T/D REALIZED P/L 177-193;
              T/D REALIZED P/L SIGN 194"""),
        blank("FILLER 8", 195, 202),
        plain("RECORD FLAGS 203-206; MARKET PRICE 207-221; IDA SIGN 222; IDA 223-226"),
        lookup("MSD CLASS CODE", 228, 234, "security_class", first_char=True),
        blank("FILLER 9", 234, 348),
        plain("ACCOUNT CHECK DIGIT 349")),
    record("Trading Analysis Settlement Date", is_(29, 30, "1B"),
        account_key(267),
        plain("SECURITY NUMBER 16-22"),
        blank("FILLER 1", 23, 28),
        plain("TRID 29; SPIN 30; SECURITY DESCRIPTION 31-60; OPTION EXPIRATION DATE 61-66"),
        blank("FILLER 2", 67, 69),
        plain("""INTEREST FREQUENCY 70; S/D QUANTITY 71-87; S/D QUANTITY SIGN 88;
              S/D COST 89-105; S/D COST SIGN 106; MEMO INTEREST CHARGE 107-117;
              MEMO INTEREST CHARGE SIGN 118; DIVIDEND/INTEREST 119-129;
              DIVIDEND/INTEREST SIGN 130; GROSS CREDIT 131-141; GROSS CREDIT SIGN 142;
              EARNED INTEREST 143-153; EARNED INTEREST SIGN 154; INTEREST RATE 155-165;
              INTEREST RATE SIGN 166; S/D REALIZED P/L 167-183; S/D REALIZED P/L SIGN 184"""),
        blank("FILLER 7", 185, 203),
        plain("IDA 204-207"),
        blank("FILLER 8", 208, 266),
        plain("ACCOUNT CHECK DIGIT 267"),
        blank("FILLER 9", 268, 349)),
    record("When-Issue Trading Trailer", is_(29, 30, "2B"),
        account_key(267),
        plain("SECURITY NUMBER 16-22"),
        blank("FILLER 1", 23, 28),
        plain("TRID 29; SPIN 30; SECURITY DESCRIPTION 31-60; OPTION EXPIRATION DATE 61-66"),
        blank("FILLER 2", 67, 69),
        plain("""INTEREST FREQUENCY 70; INTEREST FREQUENCY SIGN 71; S/D QUANTITY 72-88;
              S/D QUANTITY SIGN 89; S/D COST 90-106; S/D COST SIGN 107;
              MEMO INTEREST CHARGE 108-116; MEMO INTEREST CHARGE SIGN 117;
              DIVIDEND/INTEREST 118-126; DIVIDEND/INTEREST SIGN 127; GROSS CREDIT 128-136;
              GROSS CREDIT SIGN 137; EARNED INTEREST 138-146; EARNED INTEREST SIGN 147;
              INTEREST RATE 148-159; INTEREST RATE SIGN 160; S/D REALIZED P/L 161-175;
              S/D REALIZED P/L SIGN 176"""),
        blank("FILLER 7", 177, 203),
        plain("IDA 204"),
        blank("FILLER 8", 208, 266),
        plain("ACCOUNT CHECK DIGIT 267"),
        blank("FILLER 9", 268, 349)),
    record("Customer Balance, F/Type", (is_(29, 30, "7 "), not_blank(16, 16)),
        account_key(349),
        plain("HIGH−VALUE 16; DATE LAST ACTIVE (BKPG / MRGN) 17-22"),
        blank("FILLER 1", 23, 28),
        plain("""TRID 29; SPIN 30; CUSTOMER SHORT NAME 31-50; CUSTOMER INSTRUCTIONS 51-52;
              ACCOUNT CODE 53-55; RR CODE 56-58"""),
        blank("FILLER 2", 59, 59),
        plain("""S/D BALANCE SIGN 60; S/D BALANCE 61-77; T/D BALANCE/MARKET VALUE SIGN 78;
              T/D BALANCE/MARKET VALUE 79-95; OUTSTANDING CALL / DAY−2 CALL SIGN 96;
              OUTSTANDING CALL / DAY−2 CALL 97-113; SMA CALL/DAY−3 CALL SIGN 114;
              SMA CALL/DAY−3 CALL 115-131; BUYING POWER/DAY−5 CALL SIGN 132;
              BUYING POWER/DAY−5 CALL 133-149; MARGIN/CASH DEFICIENCY SIGN 150;
              MARGIN/CASH DEFICIENCY 151-167; MARGIN INTEREST ACCUMULATION SIGN 168;
              MARGIN INTEREST ACCUMULATION 169-185; HOUSE EXCESS SIGN 186;
              HOUSE EXCESS 187-203; ISIP INDEX COST SIGN 204; ISIP INDEX COST 205-221;
              TBD SIGN 222; TBD 223-240"""),
        blank("FILLER 9", 241, 348),
        plain("ACCOUNT CHECK DIGIT 349")),
    record("Loan Account", is_(29, 30, "7 "),
        account_key("=~"),
        blank("FILLER 1", 16, 16),
        plain("""DATE LAST ACTIVE (BKPG / MRGN) 17-28; TRID 29; SPIN 30; ACCOUNT NAME 31-50;
              ACCOUNT CODES 51-53"""),
        blank("FILLER 2", 54, 59),
        plain("""S/D BALANCE SIGN 60; S/D BALANCE 61-77; MARKET VALUE OF SECURITIES SIGN 78;
              MARKET VALUE OF SECURITIES 79-95; RATIO MV−TO−S/D BALANCE SIGN 96;
              RATIO MV−TO−S/D BALANCE 97-113"""),
        blank("FILLER 9", 114, 349)),
    record("Customer Balance, Last in Account", is_(29, 30, "71"),
        account_key(349),
        plain("""HIGH−VALUE (BPS Internal use only) 16; DATE LAST ACTIVE 17-22; DATE 23-28;
              TRID 29; SPIN 30; CUSTOMER SHORT NAME 31-50; CUSTOMER INSTRUCTIONS 51-52;
              ACCOUNT CODE 53-55; RR CODE 56-58"""),
        blank("FILLER 2", 59, 59),
        plain("""S/D BALANCE SIGN 60; S/D BALANCE 61-77; T/D BALANCE/MARKET VALUE SIGN 78;
              T/D BALANCE/MARKET VALUE 79-95; TODAYS CALL/DAY−1 CALL SIGN 96;
              TODAYS CALL/DAY−1 CALL 97-113; OUTSTANDING CALL / DAY−2 CALL SIGN 114;
              OUTSTANDING CALL / DAY−2 CALL 115-131; SMA CALL/DAY−3 CALL SIGN 132;
              SMA CALL/DAY−3 CALL 133-149; HOUSE CALL/DAY−4 CALL SIGN 150;
              HOUSE CALL/DAY−4 CALL 151-167; BUYING POWER/DAY−5 CALL SIGN 168;
              BUYING POWER/DAY−5 CALL 169-185; CASH AVAILABLE OR EQUITY PERCENT SIGN 186;
              CASH AVAILABLE OR EQUITY PERCENT 187-203; MARGIN/CASH DEFICIENCY SIGN 204;
              MARGIN/CASH DEFICIENCY 203-221; TYPE 5 BALANCE IN TYPE 2 A/C SIGN 222;
              TYPE 5 BALANCE IN TYPE 2 A/C 223-239"""),
        blank("FILLER 7", 240, 249),
        plain("""MARGIN INTEREST ACCUMULATION SIGN 250; MARGIN INTEREST ACCUMULATION 251-261;
              HOUSE EXCESS SIGN 262; HOUSE EXCESS 263-279; ISIP INDEX COST SIGN 280;
              ISIP INDEX COST 281-297"""),
        blank("FILLER 8", 297, 303),
        plain("LANGUAGE 304"),
        blank("FILLER 9", 305, 320),
        mapped("ACCOUNT RANGE INDICATOR", 321, 321, "transaction_side"),
        plain("""TELEPHONE NUMBER 322-330; ISIP NET P/S SIGN 331; ISIP NET P/S 332-348;
              ACCOUNT CHECK DIGIT 349""")),
    record("Client Totals Header", is_(29, 30, "91")),
    record("Client Totals Trailer", is_(29, 30, "92")),
    record("Date Record", is_(29, 30, "00")),
), structure=(
    Structure("ROW TYPE[TRID={29},SPIN={30},@[22]={22}]", (is_(29, 30, "11"),)),
    Structure("ROW TYPE[TRID={29},SPIN={30}]"),
))
