"""Code maps and default lookups."""

# --- fixed values: codes of the position feed ---------------------------------
TRANSACTION_SIDE = {"1": "C", "2": "S"}
OPTION_CODE = {"X": "1", "C": "2", "G": "3"}
EXPIRATION_CODE = {"X ": "T "}
SECURITY_SPIN = {"M": "O"}

# --- fixed values: codes of the registered plan feed ---------------------------
TRID = {"00": "XX", "10": "AX", "71": "GA", "99": "TT"}
RECORD_ID = {"0": "X", "1": "A", "2": "B", "3": "C", "9": "T"}
LITERATURE_CODE = {"1": "Y", " ": "Y", "0": "N"}
PLAN_TYPE = {"S": "RRSP", "I": "RRIF", "E": "RESP", "L": "LIRA", "F": "RLIF", "G": "GRSP",
             "P": "PIPP", "A": "LRIF", "D": "DPSP"}
ACCOUNT_STATUS = {"A": "LIVE", " ": "LIVE", "B": "PEND", "C": "CLSD", "D": "DEAD"}
SUCCESSOR_CODE = {"N": "0", " ": "0", "Y": "1"}
APPLICATION_CODE = {"0": "N", "1": "Y"}
LOCK_IN_PLAN_CODE = {" ": "OPEN", "L": "LOKD", "P": "PLGD", "R": "REST", "E": "ESTV", "S": "SUCC"}
LOCK_IN_PLAN_DATE = {" ": "FA", "AB": "AB", "BC": "BC", "FD": "FD", "FN": "NF", "MB": "MB",
                     "NA": "AA", "NB": "NB", "NL": "NL", "NO": "NN", "NR": "ND", "NS": "NS",
                     "NT": "NT", "ON": "ON", "PE": "PE", "PQ": "PQ", "SK": "SK", "UK": "NK",
                     "YT": "YT"}
CLOSE_REASON = {"AN": "ANP", "DR": "DER", "ET": "ETP", "HB": "HBP", "LP": "LLL", "MB": "MBD",
                "OE": "OIE", "RE": "WOE", "RO": "RTR", "RP": "ETT", "TF": "TFT", "T?": "TFI"}
FEE_PAID_CODE = {"D": "CIP", "M": "MGN", "E": "EXT", "B": "RSP", "R": "RRP"}
YES_NO = {"Y": "1", "N": "0"}
YES_NO_BLANK = {"Y": "1", "N": "0", " ": "0"}
REGISTRATION_CODE = {"Y": "1", " ": "0"}
PAY_FREQUENCY = {"W": "52", "M": "12", "B": "24", "Q": "4", "S": "2", "A": "1", "K": "60",
                 "H": "15", "=": "-"}
PAY_METHOD = {"ABB": "1", "AFT": "2", "BRH": "3", "CHQ": "4", "CH3": "5", "TFR": "6"}
GROSS_NET = {"G": "GR", " ": "GR", "N": "NT"}
INVESTMENT_VARIETY = {"A": "AIV", "M": "MBV", "N": "FPV"}
CALCULATION_CODE = {"O": "OLD", "N": "NEW", " ": "NEW"}
FUTURE_PAYMENT_CODE = {"D": "DEF", "R": "REC", "C": "CAN", "S": "SUP"}

# --- fixed values: codes of the plan valuation feed (with a default, see DEFAULTS) ---
ACTION_CODE = {"A": "N", "C": "M", "D": "R", "F": "A"}
PAYMENT_FREQUENCY = {"A": "1", "M": "12", "Q": "4", "B": "24", "S": "2", "W": "52", "N": "0",
                     " ": " "}
GROSS_NET_SWITCH = {" ": "G"}
WITHHOLD = {" ": "N"}

CODE_MAPS = {
    "transaction_side": TRANSACTION_SIDE,
    "option_code": OPTION_CODE,
    "expiration_code": EXPIRATION_CODE,
    "security_spin": SECURITY_SPIN,
    "trid": TRID,
    "record_id": RECORD_ID,
    "literature_code": LITERATURE_CODE,
    "plan_type": PLAN_TYPE,
    "account_status": ACCOUNT_STATUS,
    "successor_code": SUCCESSOR_CODE,
    "application_code": APPLICATION_CODE,
    "lock_in_plan_code": LOCK_IN_PLAN_CODE,
    "lock_in_plan_date": LOCK_IN_PLAN_DATE,
    "close_reason": CLOSE_REASON,
    "fee_paid_code": FEE_PAID_CODE,
    "yes_no": YES_NO,
    "yes_no_blank": YES_NO_BLANK,
    "registration_code": REGISTRATION_CODE,
    "pay_frequency": PAY_FREQUENCY,
    "pay_method": PAY_METHOD,
    "gross_net": GROSS_NET,
    "investment_variety": INVESTMENT_VARIETY,
    "calculation_code": CALCULATION_CODE,
    "future_payment_code": FUTURE_PAYMENT_CODE,
    "action_code": ACTION_CODE,
    "payment_frequency": PAYMENT_FREQUENCY,
    "gross_net_switch": GROSS_NET_SWITCH,
    "withhold": WITHHOLD,
}

# Recoding without rejection: the value of an unknown code; None keeps the code.
DEFAULTS = {
    "action_code": "Unknown",
    "payment_frequency": "Unknown",
    "gross_net_switch": None,
    "withhold": None,
}

# --- fixed values: default lookup tables ----------------------------------------
# A None value counts as a miss.
LOOKUPS = {
    "account_type": {"1": "C", "2": "M", "3": "D", "4": "Q", "5": "S", "6": "U", "7": "B",
                     "8": "Y", "9": "X", "0": "Z"},
    "exchange": {"^": "^", "A": "2", "B": "3", "C": "4", "D": "5", "E": "6", "F": "7", "G": "8",
                 "H": "9"},
    "security_class": {"1": "AAAAAAA", "2": "BBBBBBB", "3": "CCCCCCC", "4": "DDDDDDD", "5": None,
                       "6": "EEEEEEE", "7": "FFFFFFF"},
}
