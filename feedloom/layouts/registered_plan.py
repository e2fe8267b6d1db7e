"""Registered plan feed: 133 characters, 11 record types.

All tables below are fixed values: names, positions and exception names of the feed's fields.
"""

from .model import (Feed, Field, Structure, blank, date_parts, is_, joined, mapped, plain, record)

_CARRIAGE = plain("CARRIAGE CONTROL 1; CLIENT−NUMBER 2-4")
_CODES = (
    mapped("TRID (= 00)", 13, 14, "trid", "TRID−CODE"),
    mapped("RECORD-1:ID (=1)", 15, 15, "record_id", "TRID−CODE"),
)
_KEY = (*_CARRIAGE, *plain("BRANCH 5-7; ACCOUNT 8-12"), *_CODES)

_MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")


def monthly(name, start, width):
    """One field per month, side by side; ``name`` has a place for the month."""
    return tuple(Field(name.format(m), start + i * width, start + (i + 1) * width - 1)
                 for i, m in enumerate(_MONTHS))


def unused_period(bank, start):
    """Start and end of an unused period: century, year and month, two characters each."""
    names = [f"DO NOT USE {edge} DATE {part} (BANK {bank})"
             for edge in ("START", "END") for part in ("CC", "YY", "MM")]
    return tuple(Field(n, start + 2 * i, start + 2 * i + 1) for i, n in enumerate(names))


REGISTERED_PLAN = Feed("registered_plan", 133, (
    record("HEADER", is_(13, 15, "000"),
        _CARRIAGE,
        plain("ACCOUNT−NUMBER (BBBAAAAA) 5-12"),
        _CODES,
        plain("""HEADER ID DATE= 16-20; HEADER DATE-1:MM 21-22; HEADER DATE-1:DD 23-24;
              HEADER DATE-1:YY 25-26; HEADER P2 DATA 27-133""")),
    record("REGISTERED PLAN RECORD", is_(13, 15, "001"),
        _KEY,
        plain("ACCOUNT−TYPE (SHOULD ALWAYS = 1) 16; ACCOUNT−CHECK−DIGIT 17"),
        joined("New Field: CONCATENATE (Branch+Account+Type+Check)",
               (5, 7), (8, 12), (16, 16), (17, 17), hidden=True),
        mapped("LITERATURE−CODE", 18, 18, "literature_code", "LITERATURE−CODE"),
        mapped("PLAN−TYPE", 19, 19, "plan_type"),
        mapped("ACCOUNT−STATUS", 20, 20, "account_status", "PLAN−TYPE "),
        mapped("RRIF−SUCCESSOR−CODE", 21, 21, "successor_code"),
        mapped("RSP−APPLICATION−CODE", 22, 22, "application_code"),
        plain("RSP−TYPE (FUTURE USE) 23-24; TAX−GEO−CODE 25-27"),
        mapped("LOCK−IN−PLAN−CODE", 28, 28, "lock_in_plan_code"),
        plain("""LOCK−IN−PLAN−DATE−CC 29-30; LOCK−IN−PLAN−DATE−YY 31-32;
              LOCK−IN−PLAN−DATE−MM 33-34"""),
        mapped("LOCK−IN−PLAN−DATE−DD", 35, 36, "lock_in_plan_date"),
        plain("’YT’ = YUKON 37-38"),
        mapped("CLOSE−REASON − CLIENT DEFINED", 39, 40, "close_reason"),
        mapped("FEE−PAID−CODE", 41, 41, "fee_paid_code"),
        blank("FILLER 1", 42, 42),
        plain("FEE−TYPE 43; SPOUSAL−NAME 44-73; SPOUSAL−SIN 74-82"),
        mapped("SPOUSAL−EVER", 83, 83, "yes_no"),
        date_parts("SPOUSAL−BIRTHDATE−", 84),
        mapped("SPOUSAL−ANNUITY", 92, 92, "yes_no_blank"),
        plain("BENEFICIARY−1−NAME 93-122; BENEFICIARY−1−SIN 123-131"),
        blank("FILLER 9", 132, 133)),
    record("PRINCIPAL RECORD 2", is_(13, 15, "002"),
        _KEY,
        plain("""BENEFICIARY−1−RELATION 16-25; BENEFICIARY−1−MISC 26-35;
              BENEFICIARY−2−NAME 36-65; BENEFICIARY−2−SIN−1 66-74;
              BENEFICIARY−2−RELATION 75-84; BENEFICIARY−2−MISC 85-94;
              PREVIOUS−GEO−CODE 95-97"""),
        date_parts("GEO-DATE-", 98),
        date_parts("OPEN−DATE−", 106),
        date_parts("CLOSE−DATE−", 114),
        date_parts("CHANGE−DATE−", 122),
        mapped("REGISTRATION−CODE", 130, 130, "registration_code"),
        plain("SIBLING−NUMBER 131-132"),
        blank("FILLER 9", 132, 133)),
    record("PRINCIPAL RECORD 3", is_(13, 15, "003"),
        _KEY,
        plain("GROUP−NO 16-21"),
        blank("FILLER 9", 22, 133)),
    record("RRIF PAY INFO RECORD 1", is_(13, 15, "101"),
        _KEY,
        plain("RIF-YE-VALUE 16-24; RR1-TERM 25-26"),
        blank("FILLER 1", 27, 28),
        mapped("PAY-FREQUENCY", 29, 29, "pay_frequency"),
        mapped("PAY-METHOD", 30, 34, "pay_method", trim_key=True),
        plain("RR-AGENT 35-38; RR-BANK-TRANSIT 39-43; RR-BANK-ACCOUNT 44-48"),
        blank("FILLER 2", 49, 58),
        mapped("GROSS-NET-IND", 59, 59, "gross_net"),
        mapped("WITHHOLD-TAX", 60, 60, "yes_no"),
        date_parts("FIRST PAYMENT-1:", 61),
        plain("""FIRST PAYMENT-1:AMOUNT 69-77; ELECTED PAY-1:AMOUNT 78-86;
              MINIMUM PAY-1:AMOUNT 87-95"""),
        date_parts("ALTERNATE DATE-1:", 96),
        mapped("ALTERNATE GROSS/NET INDICATOR", 104, 104, "gross_net"),
        mapped("SPOUSAL CONTRIBUTION CODE", 105, 105, "yes_no_blank"),
        plain("MAX PAY AMOUNT 106-114"),
        monthly("ALTERNATE PAY EVER-1:EVERY {}", 115, 1),
        blank("FILLER 9", 127, 133)),
    record("RRIF PAY INFO RECORD 2", is_(13, 15, "102"),
        _KEY,
        monthly("{} PAY-1:AMOUNT", 16, 9),
        mapped("ALTERNATE WITHHOLDING TAX-1:OPTION", 124, 124, "yes_no"),
        plain("""ALTERNATE FEDERAL TAX RATE (NN.NN) 125-128;
              ALTERNATE PROVINCIAL TAX RATE (NN.NN) 129-132"""),
        blank("FILLER 9", 133, 133)),
    record("RRIF PAY INFO RECORD 3", is_(13, 15, "103"),
        _KEY,
        mapped("INVESTMENT VARIETY", 16, 16, "investment_variety"),
        plain("""FED TAX RATE (NN.NN) 17-20; PROV TAX RATE (NN.NN) 21-24; FLAT TAX AMOUNT 25-29;
              PAY BRANCH 30-32; PAY ACCOUNT 33-37; TYPE 38; CHECK DIGIT 39"""),
        mapped("CALC CODE", 40, 40, "calculation_code", hidden=True),
        mapped("FUTURE PAYMENT CODE", 41, 41, "future_payment_code"),
        mapped("THIRD PARTY INSTRUCTION", 42, 42, "yes_no_blank"),
        date_parts("LAST PAYMENT DATE-1:", 43),
        blank("FILLER 9", 51, 133)),
    record("DECEASED RECORD 1", is_(13, 15, "711"),
        _KEY,
        plain("""ORIGINATOR NAME-1:ADDRESS-1:LINE 1 16-45;
              ORIGINATOR NAME-1:ADDRESS-1:LINE 2 46-75;
              ORIGINATOR NAME-1:ADDRESS-1:LINE 3 76-105"""),
        blank("FILLER 9", 106, 133)),
    record("DECEASED RECORD 2", is_(13, 15, "712"),
        _KEY,
        plain("""ORIGINATOR NAME-1:ADDRESS LINE 4 16-45; ORIGINATOR NAME-1:ADDRESS LINE 5 46-75;
              ORIGINATOR NAME-1:ADDRESS LINE 6 76-105"""),
        date_parts("SUCCESSOR OPEN DATE-1:", 106),
        date_parts("SUCESSOR DATE OF DEATH-1:", 114),
        blank("FILLER 9", 122, 133)),
    record("RRIF BANK B PAY INFO RECORD", is_(13, 15, "713"),
        _KEY,
        mapped("PAY FREQUENCY (BANK B)", 16, 16, "pay_frequency"),
        mapped("METHOD (BANK B)", 17, 21, "pay_method", "PAY-FREQUENCY ", trim_key=True),
        plain("""AGENT (BANK B) 22-25; TRANSIT (BANK B) 26-30; CLIENT ACCOUNT (BANK B) 31-45;
              FIRST PAYMENT DATE-CC (BANK B) 46-47; FIRST PAYMENT DATE-YY (BANK B) 48-49;
              FIRST PAYMENT DATE-MM (BANK B) 50-51; FIRST PAYMENT DATE-DD (BANK B) 52-53;
              FIRST PAYMENT AMOUNT (BANK B) 54-62; ELECTED PAY AMOUNT (BANK B) 63-71"""),
        mapped("SPOUSAL (BANK A)", 72, 72, "yes_no_blank"),
        mapped("SPOUSAL (BANK B)", 73, 73, "yes_no_blank"),
        unused_period("A", 74),
        unused_period("B", 86),
        blank("FILLER 9", 98, 133)),
    record("TRAILER", is_(13, 15, "999"),
        _KEY,
        plain("TLR ID CNTR 16-20; TLR COUNT 21-31; TRAILER P2 DATA 32-133")),
), structure=(Structure("ROW TYPE"),), common=_CODES, filler_from=0, map_suffix=" ")
