"""Conversation structure repair: faults of every turn, and the cheapest edits to a legal role sequence.

Damage (a fixed rule that makes the faults to repair): each row, with null fields read as one space, meets
``crc32("<conv_id>:<turn>") % 20``: 0 drops it, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3
repeats it (same turn), 4 makes its role ``user``. After damage the rows of a conversation stand by turn, nulls
first, ties by role and text.

Faults, first one counts: ``blank`` (no character outside the six white-space characters), ``duplicate`` (role
and text equal to an earlier row), ``truncated`` (the last such character is none of ``.!?``). ``illegal`` counts
adjacent role initials other than ``su``, ``ua``, ``au``; ``gaps`` is max - min + 1 - distinct turns (nulls
ignored, 0 without turns).

Edits (fixed values): Keep 0, Rerole to user or assistant 2, Delete 3 (the only edit of a blank or duplicate row),
Insert an empty user or assistant row 2; a truncated row that stays costs 1 more. The result must read
``(s?(ua)+)?`` in role initials; of the cheapest edit lists the ASCII-least one (``D < I < K < R``) is taken.

Method: the rows of a conversation become a signature, one symbol a row (``X`` a row that must go, else its
initial class ``s u a o``, upper case when truncated). Cost-to-go depends only on the rest of a signature and
the state of the role automaton, so signatures are folded from the end into a suffix-shared DAWG: a node is a
symbol and the node of the rest, interned once, and for every node and automaton state the cost-to-go and the
best first edit are computed once and shared by all conversations that end alike. Distinct signatures are
range-partitioned by their reversal, so signatures that end alike meet in one task; a conversation's edits are
then read by following best edits from its first node. Rows, faults, counts and the repaired text are Spark
columns; only signatures pass through Python.

Defined cases: null ids form one conversation of their own; every original conversation is returned, one whose
rows are all dropped with zeros, an empty audit and the hash of the empty text; repeated rows count as
duplicates; very long conversations are one signature (one byte a row) and one repaired text; an empty table
gives an empty result; extra columns, also with clashing names, are not read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import python_ready

# Damage by remainder, edit costs, legal pairs and the grammar's automaton.
DROP, EMPTY, UNPUNCTUATE, REPEAT, TO_USER = 0, 1, 2, 3, 4
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 2, 3, 2, 1
LEGAL_PAIRS = ("su", "ua", "au")
SPACE = r"\x20\x09-\x0D"
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPT = (0, 3)
ASKED = {0: "u", 1: "u", 2: "a", 3: "u"}  # the one of user/assistant that a state takes
STATES = 4
ROLE_OF = {"u": "user", "a": "assistant"}


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, conv_id, turn, role, text) after damage; ``conv`` is a key that null ids have too."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fate = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("i"), F.col("conv_id").cast("string")), F.lit("n")).alias("conv"),
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(fate == TO_USER, F.lit("user")).otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(fate == EMPTY, F.lit("")).when(fate == UNPUNCTUATE, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        fate.alias("fate"))
    copies = F.explode(F.when(F.col("fate") == REPEAT, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.filter(F.col("fate") != DROP).select("conv", "conv_id", "turn", "role", "text", copies.alias("copy"))


def faults(rows: DataFrame) -> DataFrame:
    """Damaged rows with their place ``pos``, first fault, role initial and signature symbol."""
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "copy")
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    truncated = ~F.col("text").rlike(f"[.!?][{SPACE}]*$")
    rows = rows.withColumn("pos", F.row_number().over(order) - 1) \
        .withColumn("seen", F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy("pos")))
    fault = F.when(blank, "blank").when(F.col("seen") > 1, "duplicate").when(truncated, "truncated")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), F.lit("X")) \
        .when(F.col("fault") == "truncated", F.upper(kind)).otherwise(kind)
    return rows.withColumn("fault", fault).withColumn("initial", initial).withColumn("symbol", symbol) \
        .withColumn("before", F.lag("initial").over(Window.partitionBy("conv").orderBy("pos")))


def _solve(batches):
    """Per task: one DAWG of the signatures it holds; cost, audit and per-row plan of each."""
    child, symbol, cost, move = [0], [""], [[0, 4, 2, 0]], [[None, ("I", 0, 2), ("I", 0, 3), None]]
    nodes: dict[tuple[str, int], int] = {}

    def node(sym: str, rest: int) -> int:
        key = (sym, rest)
        found = nodes.get(key)
        if found is not None:
            return found
        here = len(child)
        must, unfinished = sym == "X", UNFINISHED if sym in "SUAO" else 0
        kind = sym.lower()
        best: list[tuple[int, str, int, int] | None] = []
        for q in range(STATES):
            options = [(DELETE + cost[rest][q], "D", rest, q)]
            if not must:
                if (q, kind) in MOVES:
                    nq = MOVES[(q, kind)]
                    options.append((KEEP + unfinished + cost[rest][nq], "K", rest, nq))
                nq = MOVES[(q, ASKED[q])]
                options.append((REROLE + unfinished + cost[rest][nq], "R", rest, nq))
            best.append(min(options))
        for _ in range(STATES):  # inserts stay on this node; costs are positive, so a few passes settle
            for q in range(STATES):
                nq = MOVES[(q, ASKED[q])]
                option = (INSERT + best[nq][0], "I", here, nq)
                if option[:2] < best[q][:2]:
                    best[q] = option
        child.append(rest)
        symbol.append(sym)
        cost.append([b[0] for b in best])
        move.append([(b[1], b[2], b[3]) for b in best])
        nodes[key] = here
        return here

    for frame in batches:
        costs, audits, plans = [], [], []
        for signature in frame["signature"]:
            at = 0
            for sym in reversed(signature):
                at = node(sym, at)
            total, q, letters, plan, pending = cost[at][0], 0, [], [], []
            while not (at == 0 and q in ACCEPT):
                letter, nxt, nq = move[at][q]
                letters.append(letter)
                if letter == "I":
                    pending.append(ASKED[q])
                else:
                    out = {"D": "", "K": symbol[at].lower(), "R": ASKED[q]}[letter]
                    plan.append("".join(pending) + "|" + letter + out)
                    pending = []
                at, q = nxt, nq
            plan.append("".join(pending) + "|")
            costs.append(total)
            audits.append("".join(letters))
            plans.append(plan)
        yield pd.DataFrame({"signature": frame["signature"], "cost": pd.array(costs, dtype="int64"),
                            "audit": audits, "plan": plans})


def repair(conversations: DataFrame) -> DataFrame:
    """Per original conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired.

    ``repaired`` is the repaired conversation as ``role:text`` lines joined by ``\\n``.
    """
    python_ready(conversations.sparkSession)
    rows = faults(damaged(conversations.select("conv_id", "turn", "role", "text")))
    pair = F.concat(F.col("before"), F.col("initial"))
    per_conv = rows.groupBy("conv").agg(
        F.first("conv_id").alias("conv_id"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
        F.count(F.when(F.col("fault") == "blank", 1)).alias("blank"),
        F.count(F.when(F.col("fault") == "duplicate", 1)).alias("duplicate"),
        F.count(F.when(F.col("fault") == "truncated", 1)).alias("truncated"),
        F.count(F.when(F.col("before").isNotNull() & ~pair.isin(*LEGAL_PAIRS), 1)).alias("illegal"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "symbol"))),
                                 lambda s: s["symbol"]), "").alias("signature"))
    per_conv = per_conv.withColumn("sig", F.unhex(F.md5("signature")))
    solved = per_conv.select("signature").distinct() \
        .repartitionByRange(F.reverse("signature")).sortWithinPartitions(F.reverse("signature")) \
        .mapInPandas(_solve, "signature string, cost long, audit string, plan array<string>") \
        .withColumn("sig", F.unhex(F.md5("signature"))).drop("signature")
    steps = solved.select("sig", F.posexplode("plan").alias("pos", "step"))
    inserted = F.transform(F.filter(F.split(F.substring_index("step", "|", 1), ""), lambda c: c != ""),
                           lambda c: F.concat(F.when(c == "u", "user").otherwise("assistant"), F.lit(":")))
    action = F.substring(F.substring_index("step", "|", -1), 1, 1)
    given = F.substring(F.substring_index("step", "|", -1), 2, 1)
    own = F.when(action == "K", F.array(F.concat("role", F.lit(":"), "text"))) \
        .when(action == "R", F.array(F.concat(F.when(given == "u", "user").otherwise("assistant"), F.lit(":"), "text"))) \
        .otherwise(F.array().cast("array<string>"))
    placed = per_conv.select("conv", "sig").join(steps, "sig") \
        .join(rows.select("conv", "pos", "role", "text"), ["conv", "pos"], "left")
    lines = placed.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(
        "pos", F.concat(inserted, F.coalesce(own, F.array().cast("array<string>"))).alias("lines")))).alias("parts"))
    text = lines.select("conv", F.array_join(F.flatten(F.transform("parts", lambda p: p["lines"])), "\n")
                        .alias("repaired"))
    done = per_conv.join(solved, "sig").join(text, "conv") \
        .select("conv", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired")
    originals = conversations.select(
        F.coalesce(F.concat(F.lit("i"), F.col("conv_id").cast("string")), F.lit("n")).alias("conv"),
        F.col("conv_id").cast("long").alias("conv_id")).distinct()
    zero = F.lit(0).cast("long")
    return originals.join(done.drop("conv_id"), "conv", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired", F.lit("")).alias("repaired"))
