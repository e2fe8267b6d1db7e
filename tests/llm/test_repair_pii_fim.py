"""Conversation repair, personal data and fill-in-the-middle against plain Python forms."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from feedloom.llm import pii
from feedloom.llm.conversation_repair import repair
from feedloom.llm.fill_in_middle import SkipList, fill_in_middle, restore

SPACE = " \t\n\x0b\x0c\r"
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ASKED = {0: "u", 1: "u", 2: "a", 3: "u"}


def brute_repair(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)} by exhaustive search."""
    by = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        by.setdefault(conv, [])
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        by[conv] += [(turn, role, text)] * (2 if fate == 3 else 1)
    out = {}
    for conv, got in by.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in got if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, kinds = set(), []
        for _, role, text in got:
            if not text.strip(SPACE):
                kinds.append("blank")
            elif (role, text) in seen:
                kinds.append("duplicate")
            elif text.rstrip(SPACE)[-1] not in ".!?":
                kinds.append("truncated")
            else:
                kinds.append(None)
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in got]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        best = {}

        def solve(i, q, inserts):
            if (i, q, inserts) in best:
                return best[(i, q, inserts)]
            options = []
            if i == len(got) and q in (0, 3):
                options.append((0, "", []))
            if inserts < 3:
                nq = MOVES[(q, ASKED[q])]
                c, a, lines = solve(i, nq, inserts + 1)
                options.append((2 + c, "I" + a, [("user" if ASKED[q] == "u" else "assistant") + ":"] + lines))
            if i < len(got):
                _, role, text = got[i]
                extra = 1 if kinds[i] == "truncated" else 0
                c, a, lines = solve(i + 1, q, 0)
                options.append((3 + c, "D" + a, lines))
                if kinds[i] not in ("blank", "duplicate"):
                    if (q, role[:1]) in MOVES:
                        c, a, lines = solve(i + 1, MOVES[(q, role[:1])], 0)
                        options.append((extra + c, "K" + a, [f"{role}:{text}"] + lines))
                    nq = MOVES[(q, ASKED[q])]
                    c, a, lines = solve(i + 1, nq, 0)
                    new = "user" if ASKED[q] == "u" else "assistant"
                    options.append((2 + extra + c, "R" + a, [f"{new}:{text}"] + lines))
            best[(i, q, inserts)] = min(options, key=lambda o: (o[0], o[1])) if options else (10 ** 9, "~", [])
            return best[(i, q, inserts)]

        cost, audit, lines = solve(0, 0, 0)
        out[conv] = (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost,
                     audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check_repair(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                       hashlib.sha256(r.repaired.encode()).hexdigest()) for r in repair(df).collect()}
    assert got == brute_repair(rows)


def test_repair_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    check_repair(spark, rows)


def test_repair_odd(spark):
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (7, 1, "system", "Be kind."), (7, 2, "user", "why"),
            (7, 2, "user", "why"), (7, 5, "assistant", "Because."), (7, None, "tool", "  \n"),
            (8, 1, "assistant", "x" * 50_000), (9, 3, "user", "a."), (9, 3, "user", "a."), (9, 4, "bot", "ok!")]
    rows += [(10 + k, t, ["user", "assistant", "system", "other"][(k * t) % 4], f"text {k} {t}{'.' * (t % 2)}")
             for k in range(40) for t in range(k % 7)]
    check_repair(spark, rows)


def test_repair_shares_suffixes(spark):
    rows = [(k, t, "user" if t % 2 == 0 else "assistant", f"same {t}.") for k in range(30) for t in range(4)]
    got = repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert got.count() == 30
    check_repair(spark, rows)


def test_repair_empty(spark):
    assert repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def brute_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, flags=re.S)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(pre), len(mid), "<S>" + suf + "<P>" + pre + "<M>" + mid
    return n, "psm", len(pre), len(mid), "<P>" + pre + "<S>" + suf + "<M>" + mid


def test_fill_in_middle(spark, odd):
    rows = odd.select("doc_id", "text").collect()
    extra = spark.createDataFrame([(k, t) for k, t in enumerate(["a<P>b", "<<S>", "x<", "ab<S", "Éé<ab>" * 9, "\n\n"] * 20)],
                                  "doc_id long, text string")
    for df, rs in ((odd, rows), (extra, extra.collect())):
        got = fill_in_middle(df).withColumn("restored", restore("output", "form")).collect()
        assert len(got) == len(rs)
        for r, g in zip(sorted(rs, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")),
                        sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or ""))):
            assert (g.n, g.form, g.prefix_chars, g.middle_chars, g.output) == brute_fim(r.doc_id, r.text)
            assert g.restored == (r.text or "")


def test_skip_list_ranks():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5, 17, 300, 5000):
        widths = rng.integers(1, 9, n)
        lanes = SkipList(widths)
        sums = np.concatenate(([0], np.cumsum(widths)))
        for rank in list(range(min(n + 1, 40))) + [n]:
            assert lanes.code_point(rank) == sums[rank]


def brute_base(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                          ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
                          ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c.isdigit()]
            if kind == "ip" and max(int(p) for p in m.group().split(".")) > 255:
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and sum(
                    d if k % 2 == 0 else (2 * d - 9 if 2 * d > 9 else 2 * d) for k, d in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_pii_base_and_field(spark, docs, odd):
    cases = ["mail a.b@x.example.com, ip 1.2.3.4 and 300.1.1.1, card 4465 7583 8288 9437 and 4465758382889438",
             "call +1 (743) 555-3824 or +12 3; é日 x.y@z.co", "", None, "1.2.3.4.5.6.7.8"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(cases)], "doc_id long, text string")
    model = pii.fit(docs)
    for frame in (df, odd, docs):
        texts = {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}
        found = pii.find_pii(frame, model).select("doc_id", pii.joined("base").alias("b"), "added").collect()
        for r in found:
            assert r.b == brute_base(texts[r.doc_id] or "")
            for s in r.added:
                assert s.kind in pii.KINDS and 0 <= s.start < s.end


def test_pii_field_learns_and_decodes():
    rng = np.random.default_rng(0)
    features = pii.Features()
    texts = [f"see {rng.integers(1, 255)}.{rng.integers(1, 255)}.{rng.integers(1, 255)}.{rng.integers(1, 255)} now "
             f"mail u{k}@mail{k % 7}.example.com or +1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)} ok"
             for k in range(200)]
    windows = []
    for t in texts:
        _, _, _, ids, labels = pii._labelled(t, features)
        windows.append((ids, labels))
    model = pii.train(windows[:150], rounds=30)
    paths = pii.viterbi(model, [w[0] for w in windows[150:]])
    right = sum(int((p == w[1]).sum()) for p, w in zip(paths, windows[150:]))
    assert right / sum(len(w[1]) for w in windows[150:]) > 0.95


def test_viterbi_is_exact():
    rng = np.random.default_rng(1)
    model = pii.Model([rng.normal(size=t.shape) for t in pii.Model().tables], rng.normal(size=(6, 5)))
    batch = [rng.integers(0, 2, size=(n, 9)) for n in (1, 2, 4, 3)]
    for ids, path in zip(batch, pii.viterbi(model, batch)):
        e = model.emissions(ids)
        t, start = model.transitions[:5], model.transitions[5]

        def score(p):
            return start[p[0]] + sum(e[j, p[j]] for j in range(len(p))) + sum(t[a, b] for a, b in zip(p, p[1:]))
        best = max(itertools.product(range(5), repeat=len(ids)), key=score)
        assert np.isclose(score(tuple(path)), score(best))


def test_empty_tables(spark, none):
    assert fill_in_middle(none).count() == 0
    assert pii.find_pii(none, pii.Model()).count() == 0


def test_settled_tokens_cut_the_path_exactly():
    rng = np.random.default_rng(5)
    model = pii.Model([rng.normal(size=t.shape) + [1.5, 0, 0, 0, 0] for t in pii.Model().tables], rng.normal(size=(6, 5)))
    batch = [rng.integers(0, 2, size=(n, 9)) for n in (7, 0, 6, 1, 7, 5, 7)]
    for ids, path in zip(batch, pii.viterbi(model, batch)):
        e = model.emissions(ids)
        t, start = model.transitions[:5], model.transitions[5]
        if len(ids):
            best = max(itertools.product(range(5), repeat=len(ids)), key=lambda p: start[p[0]] + sum(
                e[j, p[j]] for j in range(len(p))) + sum(t[a, b] for a, b in zip(p, p[1:])))
            assert tuple(path) == best
        else:
            assert len(path) == 0
    settled = pii._settled(model, model.emissions(np.concatenate(batch)))
    assert settled.any() and not settled.all()
    assert not pii._settled(pii.Model(), np.zeros((3, 5))).any()


def test_token_bounds_are_those_of_the_pattern():
    for text in ("", " ", "ab1-c\x1cd\x85e　f \ud800 x\U0001f600y", "a" * 99, "é1 2.3", "᠎​﻿-"):
        starts, ends = pii.token_bounds(text)
        assert list(zip(starts, ends)) == [m.span() for m in pii.TOKEN.finditer(text)]
        assert len(pii.Features().of(text)[2]) == len(starts)
