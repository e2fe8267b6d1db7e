"""A feed applied to one line in plain Python: the brute-force answer for small fixtures."""

import random

from feedloom.layouts import CODE_MAPS, DEFAULTS, LOOKUPS


def part(line, start, end):
    return line[start - 1:end]


def test_holds(line, t):
    return (part(line, t.start, t.end) == t.text) == t.equal


test_holds.__test__ = False


def lookup_value(line, f):
    if f.rule == "lookup":
        return LOOKUPS[f.table].get(part(line, f.start, f.start if f.first_char else f.end))
    key = part(line, f.start, f.end)
    return CODE_MAPS[f.table].get(key.strip(" ") if f.trim_key else key)


def field(line, f, of):
    raw = part(line, f.start, f.end)
    if f.rule in ("lookup", "mapped"):
        found = lookup_value(line, f)
        return raw if found is None else found
    if f.rule == "recode":
        default = DEFAULTS[f.table]
        return CODE_MAPS[f.table].get(raw, raw if default is None else default)
    if f.rule == "joined":
        out = ""
        for p in f.parts:
            value = part(line, *p) if isinstance(p, tuple) else \
                p[1:] if p.startswith("=") else lookup_value(line, of.field(p))
            if value is None:
                return ""
            out += value
        return out
    return raw


def check(line, feed, fields):
    status, failed = 0, []
    for f in fields:
        raw = part(line, f.start, f.end)
        source = feed.exception_source(f)
        if f.rule == "blank" and raw.strip(" "):
            status = -4
            failed.append(("INVALID_FILLER", source, f"Filler containing data [{raw}]"))
        if f.rule == "lookup" and lookup_value(line, f) is None:
            status = -3
            failed.append(("INVALID_XREF", source, f"No lookup value for [{raw}]"))
        if f.rule == "mapped" and lookup_value(line, f) is None:
            status = -3
            failed.append(("INVALID_MAP", source, f"No mapped value for [{raw}]"))
    return status, failed


def apply(line, feed):
    """``(type, status, failures, data)``."""
    if len(line) != feed.row_length:
        return ("<Unrecognized>", -1,
                [("INVALID_LENGHT", "ROW", f"Invalid row length [{len(line)}]")], line)
    for t in feed.types:
        if all(test_holds(line, x) for x in t.when):
            status, failed = check(line, feed, t.fields)
            if status or not t.fields:
                return t.name, status, failed, line
            return t.name, 0, [], "|".join(field(line, f, t) for f in t.rendered)
    _, failed = check(line, feed, feed.common)
    for s in feed.structure:
        if all(test_holds(line, x) for x in s.when):
            source = s.source
            for p in set(_places(source)):
                a, _, b = p.partition("-")
                source = source.replace("{" + p + "}", part(line, int(a), int(b or a)))
            break
    return "<Unrecognized>", -2, failed + [("INVALID_STRUCTURE", source, "Invalid row type")], line


def _places(text):
    return [x.split("}")[0] for x in text.split("{")[1:]]


def valid_line(feed, t, rnd):
    """A line of the type that passes every rule."""
    line = [rnd.choice("0123456789ABCxyz -é") for _ in range(feed.row_length)]

    def put(start, text):
        line[start - 1:start - 1 + len(text)] = text

    for f in t.fields:
        if f.rule in ("lookup", "mapped", "recode"):
            table = (LOOKUPS if f.rule == "lookup" else CODE_MAPS)[f.table]
            keys = [k for k, v in table.items() if v is not None
                    and (f.trim_key or f.first_char or len(k) == f.width)
                    and not (f.trim_key and not k.strip())]
            put(f.start, rnd.choice(keys).ljust(1 if f.first_char else f.width))
    for f in t.fields:
        if f.rule == "blank":
            put(f.start, " " * f.width)
    for x in t.when:
        put(x.start, x.text if x.equal else "Q")
    for other in feed.types:
        if other is t:
            break
        # not to be taken for an earlier type
        if all(test_holds("".join(line), x) for x in other.when) and not any(
                x.start == y.start for x in other.when for y in t.when):
            put(other.when[-1].start, "Q")
    return "".join(line)


def fixture(feed, seed=1):
    """Valid lines of every type, and the same with single characters changed."""
    rnd = random.Random(seed)
    lines = ["", "x" * (feed.row_length + 1), "?" * feed.row_length]
    for t in feed.types:
        good = valid_line(feed, t, rnd)
        lines += [good, good[:-1]]
        for f in t.fields:
            if f.rule != "joined":
                at = rnd.randint(f.start, f.end) - 1
                lines.append(good[:at] + "#" + good[at + 1:])
        for _ in range(5):
            changed = list(good)
            for _ in range(6):
                changed[rnd.randrange(len(changed))] = rnd.choice(" #X1")
            lines.append("".join(changed))
    return lines
