"""Fill-in-the-middle: every text cut into prefix, middle and suffix and put together in a training form.

A text is a sequence of units, ``[A-Za-z]+|[^A-Za-z]`` matched left to right over code points. The cut ranks
come from a digest of the id, so reruns agree: with ``h1`` to ``h4`` the first four 8-digit groups of the hex
sha256 of ``1:<doc_id>``, the prefix ends after ``min(h1, h2) % (n + 1)`` units and the middle after the larger
one. Units and code points differ in width, so the code-point offsets of both cut ranks are read off an
indexable skip list: every node is one unit, and each express lane carries the unit width and the code-point
width of the stretch it jumps; a search descends lane by lane, adding widths until the next jump would pass
the rank, and ends on the exact code-point offset of that rank. Lanes are built per text with numpy.

Forms (fixed values): ``plain`` (the text), ``psm`` (``<P>`` prefix ``<S>`` suffix ``<M>`` middle) and ``spm``
(``<S>`` suffix ``<P>`` prefix ``<M>`` middle). A text that is empty or holds one of the three markers stays
plain, as does every text with ``h3 % 100 >= 90``; of the rest ``h4 % 100 < 20`` gives spm. ``restore`` takes
output and form back to the exact text, with Spark's own string functions.

Defined cases: a null text is the empty text (``n`` 0, plain); a null id is digested as ``1:`` alone; equal
rows give equal rows; very long texts are cut whole (one lane per level, ``log2`` of the units many); an empty
table gives an empty result. Only the id and text columns are read, so extra columns, also with the names of
the result, neither pass nor clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import python_ready

# Fixed values of the contract: unit pattern, markers and form shares.
UNIT = regex.compile(r"[A-Za-z]+|[^A-Za-z]")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
LANE_STEP = 4  # a node of level k + 1 stands on every LANE_STEP-th node of level k

SCHEMA = ("doc_id long, text string, n long, form string, prefix_chars long, middle_chars long, output string")


class SkipList:
    """Indexable skip list over the units of one text; only widths are kept, never the units themselves.

    Level 0 links every unit to the next; a node rises to level k + 1 when it rises to level k and its
    level-k index is a multiple of ``LANE_STEP``. ``lanes[k]`` holds the positions of level-k nodes and the
    unit and code-point widths of the jump from each to the next (the head is position 0).
    """

    def __init__(self, widths: np.ndarray):
        self.n = len(widths)
        positions = np.arange(self.n + 1)
        points = np.concatenate(([0], np.cumsum(widths, dtype=np.int64)))
        self.lanes = []
        while True:
            unit_width = np.diff(positions)
            point_width = np.diff(points[positions])
            self.lanes.append((positions, unit_width, point_width))
            if len(positions) <= LANE_STEP + 1:
                break
            up = positions[::LANE_STEP]
            positions = up if up[-1] == self.n else np.concatenate((up, [self.n]))

    def code_point(self, rank: int) -> int:
        """Code points covered by the first ``rank`` units, found by descending the lanes."""
        units = points = 0
        index = 0
        for level in range(len(self.lanes) - 1, -1, -1):
            positions, unit_width, point_width = self.lanes[level]
            if level < len(self.lanes) - 1:
                index = int(np.searchsorted(positions, units))
            while index < len(unit_width) and units + unit_width[index] <= rank:
                units += int(unit_width[index])
                points += int(point_width[index])
                index += 1
        return points


def unit_widths(text: str) -> np.ndarray:
    return np.fromiter((m.end() - m.start() for m in UNIT.finditer(text)), dtype=np.int64)


def _cut(frame: pd.DataFrame) -> pd.DataFrame:
    n, prefix, middle, output = [], [], [], []
    for text, h1, h2, form in zip(frame["text"], frame["h1"], frame["h2"], frame["form"]):
        lanes = SkipList(unit_widths(text))
        n.append(lanes.n)
        if form == "plain":
            prefix.append(None)
            middle.append(None)
            output.append(text)
            continue
        first, second = sorted((int(h1) % (lanes.n + 1), int(h2) % (lanes.n + 1)))
        at, to = lanes.code_point(first), lanes.code_point(second)
        prefix.append(at)
        middle.append(to - at)
        head, mid, tail = text[:at], text[at:to], text[to:]
        output.append(PREFIX + head + SUFFIX + tail + MIDDLE + mid if form == "psm"
                      else SUFFIX + tail + PREFIX + head + MIDDLE + mid)
    return pd.DataFrame({"doc_id": frame["doc_id"], "text": frame["text"], "n": n, "form": frame["form"],
                         "prefix_chars": pd.array(prefix, dtype="Int64"), "middle_chars": pd.array(middle, dtype="Int64"),
                         "output": output})


def _cuts(batches):
    for frame in batches:
        yield _cut(frame)


def _digest_part(digest, k: int):
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text, n, form, prefix_chars, middle_chars, output) per row of ``docs``; see the module text."""
    python_ready(docs.sparkSession)
    text = F.coalesce(F.col(text_column), F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    marked = (text == "") | (F.instr(text, PREFIX) > 0) | (F.instr(text, SUFFIX) > 0) | (F.instr(text, MIDDLE) > 0)
    form = F.when(marked | (_digest_part(digest, 2) % 100 >= PLAIN_FROM), "plain") \
        .when(_digest_part(digest, 3) % 100 < SPM_BELOW, "spm").otherwise("psm")
    prepared = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"),
                           _digest_part(digest, 0).alias("h1"), _digest_part(digest, 1).alias("h2"), form.alias("form"))
    return prepared.mapInPandas(_cuts, SCHEMA)


def restore(output, form):
    """The exact text of an ``output`` of the given ``form``, by Spark's string functions alone."""
    def piece(start, end):
        return F.expr(f"substring({output}, {start}, ({end}) - ({start}))") if end else \
            F.expr(f"substring({output}, {start})")
    s_at = f"locate('{SUFFIX}', {output}, 4)"
    m_at = f"locate('{MIDDLE}', {output}, {s_at} + 3)"
    p_at = f"locate('{PREFIX}', {output}, 4)"
    m_spm = f"locate('{MIDDLE}', {output}, {p_at} + 3)"
    psm = F.concat(piece("4", s_at), piece(f"{m_at} + 3", None), piece(f"{s_at} + 3", m_at))
    spm = F.concat(piece(f"{p_at} + 3", m_spm), piece(f"{m_spm} + 3", None), piece("4", p_at))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
