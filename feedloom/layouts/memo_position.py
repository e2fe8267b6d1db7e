"""Memo position feed: 144 characters, 5 record types.

All tables below are fixed values: names and positions of the feed's fields.
"""

from .model import Feed, Structure, blank, is_, is_blank, joined, lookup, plain, record


def memo_key(client):
    return (
        blank("FILLER 0", 1, 1, "FILLER@[23:28] (0)"),
        *plain(f"{client} 2-4; BRANCH 5-7; ACCOUNT 8-12; CURRENCY 13-15"),
        lookup("TYPE", 16, 16, "account_type", "ACCOUNT TYPE"),
        *plain("CHKDIG 17"),
        joined("NEW TYPE", (5, 7), "TYPE", (17, 17)),
        *plain("ADP SECURITY CODE 18-24"),
    )


MEMO_POSITION = Feed("memo_position", 144, (
    record("Header record", (is_(25, 25, "1"), is_blank(5, 24)),
        blank("FILLER 0", 1, 1, "FILLER@[23:28] (0)"),
        plain("""CLIENT 2-4; FILLER 1 5-24; RECORD TYPE 25; DATE= 26-30;
              FILE CREATION DATE & TIME 31-42; ADP-SEC-POSITION 43-58"""),
        blank("FILLER 9", 59, 144)),
    record("Memo H record", is_(25, 25, "1"),
        memo_key("CLIENT"),
        plain("""RECORD TYPE 1 25; RR 26-28; TD QUANTITY 29-45; TD QUANTITY SGN 46;
              SD QUANTITY 47-63; SD QUANTITY SGN 64; MEMO COUNT 65-66; MEMO SB QUANTITY 67-83;
              MEMO SB QUANTITY SGN 84; MEMO SD QUANTITY 85-101; MEMO SD QUANTITY SGN 102;
              MEMO TM QUANTITY 103-119; MEMO TM QUANTITY SGN 120"""),
        blank("FILLER 9", 121, 144)),
    record("Memo T record", is_(25, 25, "2"),
        memo_key("CLIENT"),
        plain("""RECORD TYPE Z 25; MEMO TF QUANTITY 26-42; MEMO TF QUANTITY SIGN 43;
              MEMO TR QUANTITY 44-60; MEMO TR QUANTITY SIGN 61; MEMO TL QUANTITY 62-78;
              MEMO TL QUANTITY SIGN 79; MEMO SK QUANTITY 80-96; MEMO SK QUANTITY SIGN 97;
              MEMO SN QUANTITY 98-114; MEMO SN QUANTITY SIGN 115; MEMO OD QUANTITY 116-132;
              MEMO OD QUANTITY SIGN 133"""),
        blank("FILLER 9", 134, 144)),
    record("Memo M record", is_(25, 25, "3"),
        memo_key("CLIENT 068"),
        plain("""RECORD TYPE 3 25; MEMO OR QUANTITY 26-43; MEMO OR QUANTITY SIGN 44;
              MEMO TB QUANTITY 45-56; MEMO TB QUANTITY SIGN 57; MEMO TC QUANTITY 58-69;
              MEMO TC QUANTITY SIGN 70"""),
        blank("FILLER 9", 71, 144)),
    record("Trailer record", (is_(25, 25, "Z"), is_(5, 24, "9" * 20)),
        blank("FILLER 0", 1, 1, "FILLER@[23:28] (0)"),
        plain("""CLIENT 068 2-4; FILLER 1 5-24; RECORD TYPE 25; REC CTR 26-33;
              RECORD COUNT 34-41"""),
        blank("FILLER 9", 42, 144)),
), structure=(
    Structure("ROW TYPE[@[25]=<Unrecognized>,FILLER@[5:24]={5-24}]", (is_(25, 25, "Z"),)),
    Structure("ROW TYPE[@[25]=<Unrecognized>]"),
))

# Column ranges of the same feed when it is split into one trimmed table per record type:
# 0-based start, exclusive end (fixed values).
SPLIT_RANGES = {
    "header": ((0, 1), (1, 4), (4, 24), (24, 25), (25, 30), (30, 42), (42, 58), (58, 144)),
    "1": ((0, 1), (1, 4), (4, 7), (7, 12), (12, 15), (15, 16), (16, 17), (17, 24), (24, 25),
          (25, 28), (28, 45), (45, 46), (46, 63), (63, 64), (64, 66), (66, 83), (83, 84),
          (84, 101), (101, 102), (102, 119), (119, 120), (120, 144)),
    "2": ((0, 1), (1, 4), (4, 7), (7, 12), (12, 15), (15, 16), (16, 17), (17, 24), (24, 25),
          (25, 42), (42, 43), (43, 60), (60, 61), (61, 78), (78, 79), (79, 96), (96, 97),
          (97, 114), (114, 115), (115, 132), (132, 133), (133, 144)),
    "3": ((0, 1), (1, 4), (4, 7), (7, 12), (12, 15), (15, 16), (16, 17), (17, 24), (24, 25),
          (25, 43), (43, 44), (44, 56), (56, 57), (57, 69), (69, 70), (70, 144)),
    "Z": ((0, 1), (1, 4), (4, 24), (24, 25), (25, 26), (33, 34), (40, 144)),
}
