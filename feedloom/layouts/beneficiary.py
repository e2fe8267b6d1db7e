"""Beneficiary feed: 199 characters, 6 record types.

All tables below are fixed values: names and positions of the feed's fields.
"""

from .model import Feed, Structure, is_, plain, record

_KEY = plain("""ACTION 1; RECORD ID 2-3; CLIENT NUMBER 4-6; BRANCH NUMBER 7-9;
              ACCOUNT NUMBER 10-14; NUMBER OF BENE 15-16; ACCOUNT TYPE 17;
              ACCOUNT CHECK DIGIT 18""")

BENEFICIARY = Feed("beneficiary", 199, (
    record("HEADER", is_(1, 5, "DATE="),
        plain("""LITERAL (DATE=) 1-5; PROCESS DATE 6-11; SYSTEM DATE 12-17; SYSTEM TIME 18-23;
              FILLER 1 24-26; DSN 27-43; PGM 44-51; CLIENT NUMBER 52-54; FILLER 9 55-199""")),
    record("TRAILER", is_(1, 8, "REC-CNT="),
        plain("""LITERAL 1-8; RECORD COUNT 9-19; PROCESS DATE 20-25; SYS DATE 26-31;
              SYS TIME 32-37; PROGRAM 38-45; CLT NUMBER 46-48; FILLER 9 49-199""")),
    record("RECORD LINE 1", is_(2, 3, "01"),
        _KEY,
        plain("""TOTAL BENEFICIARY 19-22;
              NUMBER OF ACTIVE BENEFICIARY 23-26; FILLER 1 27-28; FIRST NAME 29-48;
              INITIAL 49; LAST NAME 50-69; STREET LINE 1 70-99; STREET LINE 2 100-129;
              APT/SUITE 130-134; CITY 135-164; PROVINCE/STATE 165-166; COUNTRY CODE 167-169;
              POSTAL CODE 170-179; SUBSCRIBER ADDRESS INDICATOR 180; FILLER 9 181-199""")),
    record("RECORD LINE 2", is_(2, 3, "02"),
        _KEY,
        plain("""FILLER 1 19-28; BIRTH DATE 29-36; LANGUAGE 37; SEX 38;
              RELATION 39-40; BENE GEO CODE 41-43; SIN 44-52; BENE START DATE 53-60;
              PLAN MATURITY DATE 61-68; FIRST CONTACT DATE 69-76; REQUESTED GRANT 77;
              BENE ADDED DATE 78-85; PAC 86-93; STATUS CODE 94-95; CUSTOMER PARENT 96-125;
              TELEPHONE NUMBER 126-137; POST SECONDARY EDUCATION -1: PROGRAM LENGTH 138;
              POST SECONDARY EDUCATION -1: PROGRAM TYPE 139-140;
              EDUCATIONAL INSTITUTION POSTAL CODE 141-150;
              EDUCATIONAL INSTITUTION COUNTRY CODE 151;
              POST SECONDARY EDUCATION -1: PROGRAM YEAR 152; ACADEMIC YEAR LENGTH 153-155;
              STATUS DATE 156-163; ORIGINATION DATE 164-171; RESP CODE 172; SIBLING ONLY 173;
              FILLER 9 174-199""")),
    record("RECORD LINE 3", is_(2, 3, "03"),
        _KEY,
        plain("""FILLER 1 19-28; FILLER 2 29-32;
              EDUCATION START DATE 33-40; FILLER 3 41-43; TRANSFER IN INITIATION DATE 45-52;
              TRANSFER IN COMPLETION DATE 53-60; TRANSFER OUT INITIATION DATE 61-68;
              TRANSFER OUT COMPLETION DATE 69-76; NUMBER OF PREV BENEFICIARIES 77-78;
              OLD CONTRACT 79-93; OLD SPECIMEN NUMBER 94-103; YEAR 16/17 INDICATOR 104;
              PRIMARY CAREGIVER LAST NAME 105-124; PRIMARY CAREGIVER FIRST NAME 125-144;
              PRIMARY CAREGIVER SIN 145-159; PRIMARY CAREGIVER ID CODE 160;
              REQUEST EDUCATION CESG CODE 161; REQUEST LEARNING BOND CODE 162;
              PROVINCIAL BOND CODE 163-164; REQUEST PROVINCIAL BOND CODE 165;
              REQUEST QESI CODE 166; REQUEST QESI START YEAR 167-170; FILLER 9 171-199""")),
    record("RECORD LINE 4", is_(2, 3, "04"),
        _KEY,
        plain("""GRANT TYPE 19-21; BATCH CODE 22-23;
              REQUEST TO CANCEL 24; TRANSACTION DATE 25-32; SUBSCRIBER NAME 33-62;
              BENE FIRST NAME 63-82; BENE LAST NAME 83-102;
              PROCESSED REJECTION INDICATOR 103; PROCESSES REJECTION MESSAGE 104-133;
              FILLER 9 134-199""")),
), structure=(Structure("ROW TYPE"),))
