"""Main text of web pages by wrappers that are inferred per host.

A page is a stream of block tags and text blocks. The streams of a host are aligned one after the
other into a union-free expression: children of an element keep their order, a child that some page
lacks becomes optional, a child that repeats becomes a repeated group, children whose order is not the
same everywhere fold into one repeated group of optional parts, and text becomes a slot (or stays a
constant while all pages agree on it). Aligning wrappers is the same operation as aligning pages, so
tasks align what they read and partial wrappers meet by host in two rounds; a host that holds most
pages is spread over all tasks of the first round. The slots of the finished wrapper that lie in the
article are then read from every page: they are chosen by tags, class words, links and constancy of their
paths. The expression only describes a host, pages are not matched against it.

Tags, roles and hidden elements are furniture for certain. Class words only say so as long as no article
or main element lies inside and the page has other text (``Page._settle``).

Null and empty pages have an empty text. Repeated rows are all returned. Elements nested deeper than
``MAX_DEPTH`` share the path of their ancestor there; their text is kept. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import python_ready, stored

MAX_DEPTH = 40
# Roles of HTML elements and the usual class words of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg iframe textarea object canvas math title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var".split())
FURNITURE_TAGS = frozenset("nav header footer aside form head menu button select dialog fieldset".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar aside cookie cookies consent gdpr notice alert popup modal "
    "overlay share sharing social related recommended comment comments reply replies disqus respond newsletter "
    "subscribe signup login search widget pagination pager toolbar disclaimer".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
STATES = frozenset("has no with without is hide show".split())  # "has-sidebar" names no sidebar
ARTICLE_TAGS = frozenset(("article", "main"))
ARTICLE_WORDS = frozenset("article post entry story content main".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSED_BY_LIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                  "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)"
    r"(?P<attrs>(?:(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*))(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORDS = re.compile(r"[A-Za-z]+")


# What a block stands in: text, an element that class words call furniture, certain furniture, or an
# article inside an element that class words call furniture.
PLAIN, DOUBTFUL, FURNITURE, WRAPPED = range(4)


def _label(name: str, attrs: str) -> tuple[str, int]:
    """Label of an open tag (name and class words) and whether it is page furniture."""
    furniture, doubtful = name in FURNITURE_TAGS, False
    found: list[str] = []
    if attrs and not attrs.isspace():
        for key, *values in ATTRIBUTE.findall(attrs):
            value, key = "".join(values), key.lower()
            if key == "role":
                furniture |= value.lower() in FURNITURE_ROLES
            elif key == "hidden" or key == "aria-hidden":
                furniture |= key == "hidden" or value.lower() == "true"
            else:
                names = [[w.lower() for w in WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", one))] for one in value.split()]
                names = [words for words in names if words and words[0] not in STATES]
                if name in ARTICLE_TAGS:
                    names = [words[:1] for words in names[:1]]  # what else such an element may hold is no matter
                doubtful |= name not in ("body", "html", "main") and any(not FURNITURE_WORDS.isdisjoint(words) for words in names)
                if key == "class":
                    found += [word for words in names for word in words]
    return ".".join([name, *dict.fromkeys(found)]), FURNITURE if furniture else DOUBTFUL if doubtful else PLAIN


class Page:
    """Blocks ``(path, text, link characters)`` in page order, and the child runs of every element path."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, str, int]] = []
        self.children: dict[str, list[list[str]]] = {}
        self._buffer: list[str] = []
        self._links = self._in_link = 0
        self._stack: list[tuple[str, str, str, int, list[str]]] = [("", "", "", PLAIN, [])]
        self._kinds: list[int] = []
        self._articles = self._wrapped = 0
        at, end = 0, len(source)
        while at < end:
            token = TOKEN.search(source, at)
            self._text(source[at:token.start() if token else end])
            if not token:
                break
            at = token.end()
            name = (token["name"] or "").lower()
            if not name:
                continue
            if token["end"]:
                self._close(name)
            elif name in RAW:
                close = re.compile(f"</{name}(?![a-zA-Z0-9])[^>]*(?:>|\\Z)", re.I).search(source, at)
                at = close.end() if close else end
            else:
                self._open(name, token["attrs"] or "")
        self._flush()
        while self._stack:
            self._pop()
        self._settle()

    def _settle(self) -> None:
        """Drops doubtful blocks. An article that stands in doubtful elements stays if it holds more text
        than the articles outside and is the only such one, or if outside there is none; a page without any
        article whose text is all doubtful keeps it."""
        def chars(kind, test=lambda path: True):
            return sum(len(text) for (path, text, _), k in zip(self.blocks, self._kinds) if k == kind and test(path))

        kept = {PLAIN}
        named = chars(PLAIN, lambda path: any(label.split(".")[0] == "article" for label in path.split("/")))
        if chars(WRAPPED) > chars(PLAIN, _in_article) and (self._wrapped == 1 or not named):
            kept.add(WRAPPED)
        if not self._articles and not kept.intersection(self._kinds):
            kept.add(DOUBTFUL)
        self.blocks = [block for block, kind in zip(self.blocks, self._kinds) if kind in kept]

    def _text(self, text: str) -> None:
        if text and self._stack[-1][3] != FURNITURE:
            self._buffer.append(text)
            self._links += len(text) if self._in_link else 0

    def _flush(self) -> None:
        if self._buffer:
            text = " ".join(html.unescape("".join(self._buffer)).split())
            if text:
                path = self._stack[-1][2] + "/#"
                if self._stack[-1][3] != DOUBTFUL:
                    self._stack[-1][4].append("#")
                self._kinds.append(self._stack[-1][3])
                self.blocks.append((path, text, min(self._links, len(text))))
            self._buffer, self._links = [], 0

    def _open(self, name: str, attrs: str) -> None:
        label, furniture = _label(name, attrs)
        if name in INLINE and not furniture:
            self._in_link += name == "a"
            return
        if name == "br":
            self._text(" ")
            return
        self._flush()
        if name in VOID:
            return
        if name in CLOSES_P:
            self._drop_open(("p",), ("table", "td", "th", "button"))
        if name in CLOSED_BY_LIKE and name != "p":
            self._drop_open(CLOSED_BY_LIKE[name], SCOPE.get(name, ()))
        above = self._stack[-1]
        above[4].append(label)
        path = above[2] if len(self._stack) > MAX_DEPTH else f"{above[2]}/{label}"
        self._stack.append((name, label, path, self._kind(name, above[3], furniture), []))

    def _kind(self, name: str, above: int, own: int) -> int:
        if FURNITURE in (above, own):
            return FURNITURE
        if own == DOUBTFUL:
            return DOUBTFUL
        self._articles += name in ARTICLE_TAGS
        if above == DOUBTFUL and name == "main":
            return PLAIN
        if above == DOUBTFUL and name == "article" and not any(
                entry[0] == "article" and entry[3] != DOUBTFUL for entry in self._stack):
            self._wrapped += 1
            return WRAPPED
        return above

    def _drop_open(self, names, scope) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            if self._stack[depth][0] in names:
                while len(self._stack) > depth:
                    self._pop()
                return
            if self._stack[depth][0] in scope:
                return

    def _close(self, name: str) -> None:
        if name in INLINE and not any(entry[0] == name for entry in self._stack[-2:]):
            if name == "a":
                self._in_link = max(0, self._in_link - 1)
            return
        self._flush()
        for depth in range(len(self._stack) - 1, 0, -1):
            if self._stack[depth][0] == name:
                while len(self._stack) > depth:
                    self._pop()
                return

    def _pop(self) -> None:
        _, _, path, _, labels = self._stack.pop()
        if labels:
            self.children.setdefault(path, []).append(labels)


# A wrapper: {"pages": n, "of": {path: {"groups": [[label, ...], ...], "rep": [label, ...],
#   "seen": {label: elements that hold it}, "n": elements}}, "slots": {path: [blocks, characters, link
#   characters, constant text or None, pages, digests of the first MANY of its different pages]}}

MANY = 3  # different pages that must agree before a text is the template's


def new_wrapper() -> dict:
    return {"pages": 0, "of": {}, "slots": {}}


def _fold(groups: list[list[str]], order: list[list[str]]) -> list[list[str]]:
    """Aligns the label groups of one element with those of another; contradictions of order fold."""
    place = {label: k for k, group in enumerate(groups) for label in group}
    at = -1
    for group in order:
        known = [place[label] for label in group if label in place]
        low, high = (min(known), max(known)) if known else (at + 1, at)
        if known and low < at:
            high, low = max(high, at), low
        if known:
            if high > low:
                groups[low:high + 1] = [[label for part in groups[low:high + 1] for label in part]]
            groups[low] += [label for label in group if label not in place]
            at = low
        else:
            at += 1
            groups.insert(at, list(group))
        place = {label: k for k, part in enumerate(groups) for label in part}
    return groups


def align_page(wrapper: dict, page: Page) -> None:
    wrapper["pages"] += 1
    for path, elements in page.children.items():
        known = wrapper["of"].setdefault(path, {"groups": [], "rep": [], "seen": {}, "n": 0})
        for labels in elements:
            runs = [label for k, label in enumerate(labels) if k == 0 or labels[k - 1] != label]
            counts: dict[str, int] = {}
            for label in labels:
                counts[label] = counts.get(label, 0) + 1
            known["n"] += 1
            known["groups"] = _fold(known["groups"], [[label] for label in runs])
            for label, count in counts.items():
                known["seen"][label] = known["seen"].get(label, 0) + 1
                if count > 1 and label not in known["rep"]:
                    known["rep"].append(label)
    here: set[str] = set()
    digest = hashlib.blake2b(repr([block[:2] for block in page.blocks]).encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
    for path, text, links in page.blocks:
        slot = wrapper["slots"].setdefault(path, [0, 0, 0, text, 0, []])
        slot[0] += 1
        slot[1] += len(text)
        slot[2] += links
        slot[3] = slot[3] if slot[3] == text else None
        if path not in here:
            slot[4] += 1
            slot[5] = sorted({*slot[5], digest})[:MANY]
            here.add(path)


def align_wrappers(wrapper: dict, other: dict) -> dict:
    wrapper["pages"] += other["pages"]
    for path, theirs in other["of"].items():
        known = wrapper["of"].setdefault(path, {"groups": [], "rep": [], "seen": {}, "n": 0})
        known["n"] += theirs["n"]
        known["groups"] = _fold(known["groups"], theirs["groups"])
        known["rep"] = list(dict.fromkeys(known["rep"] + theirs["rep"]))
        for label, count in theirs["seen"].items():
            known["seen"][label] = known["seen"].get(label, 0) + count
    for path, theirs in other["slots"].items():
        slot = wrapper["slots"].get(path)
        wrapper["slots"][path] = theirs if slot is None else [
            slot[0] + theirs[0], slot[1] + theirs[1], slot[2] + theirs[2],
            slot[3] if slot[3] == theirs[3] else None, slot[4] + theirs[4], sorted({*slot[5], *theirs[5]})[:MANY]]
    return wrapper


def expression(wrapper: dict, path: str = "") -> str:
    """The wrapper as a union-free regular expression."""
    known = wrapper["of"].get(path)
    if known is None:
        return ""
    parts = []
    for group in known["groups"]:
        inner = []
        for label in group:
            body = expression(wrapper, f"{path}/{label}") if label != "#" else ""
            optional, repeated = known["seen"][label] < known["n"], label in known["rep"]
            mark = ("?" if optional else "") if len(group) == 1 and not repeated else \
                "*" if optional or len(group) > 1 else "+"
            slot = wrapper["slots"].get(f"{path}/#") if label == "#" else None
            shown = label if slot is None or slot[3] is None or slot[4] < 2 else json.dumps(slot[3], ensure_ascii=False)
            inner.append((f"<{shown}>{body}</>" if label != "#" else shown) + mark)
        parts.append(inner[0] if len(inner) == 1 else "(" + " ".join(inner) + ")*")
    return " ".join(parts)


def _in_article(path: str) -> bool:
    return any(not ARTICLE_TAGS.isdisjoint(marks) or (marks[0] in ("div", "section") and not ARTICLE_WORDS.isdisjoint(marks[1:]))
               for marks in (label.split(".") for label in path.split("/")))


def article_slots(wrapper: dict) -> list[str]:
    """Paths of the text slots that belong to the article.

    Slots inside an article container, where the wrapper has one; otherwise those that are neither
    mostly links over all pages (titles may be) nor the same constant on several different pages; if
    these are none, all.
    """
    slots = wrapper["slots"]
    inside = [path for path in slots if _in_article(path)]
    if inside:
        return inside
    return [path for path, (blocks, chars, links, constant, pages, different) in slots.items()
            if (2 * links <= chars or _is_title(path))
            and not (constant is not None and len(different) >= MANY and len(slots) > 1)] or list(slots)


def _is_title(path: str) -> bool:
    return any(label.split(".")[0] == "h1" for label in path.split("/"))


def _partial(batches):
    """Aligns the pages of a task by host."""
    wrappers: dict[str, dict] = {}
    for batch in batches:
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html")):
            align_page(wrappers.setdefault(host, new_wrapper()), Page(source.as_py()))
        if len(wrappers) > 2_000:
            yield _rows(wrappers)
            wrappers = {}
    yield _rows(wrappers)


def _rows(wrappers: dict[str, dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(wrappers.keys(), pa.string()),
                                       pa.array([json.dumps(w) for w in wrappers.values()], pa.string())],
                                      names=["host", "wrapper"])


def _aligned(batches):
    wrappers: dict[str, dict] = {}
    for batch in batches:
        for host, text in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
            other = json.loads(text)
            wrappers[host] = align_wrappers(wrappers[host], other) if host in wrappers else other
    yield _rows(wrappers)


def _finished(batches):
    for batch in _aligned(batches):
        wrappers = [json.loads(text) for text in batch.column("wrapper").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), pa.array([w["pages"] for w in wrappers], pa.int64()),
             pa.array([expression(w) for w in wrappers], pa.string()),
             pa.array([article_slots(w) for w in wrappers], pa.list_(pa.string()))],
            names=["host", "pages", "expression", "slots"])


def host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1)), F.lit(""))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """One row per host: pages, the wrapper's expression, and the paths of its article slots."""
    python_ready(pages.sparkSession)
    shape = "host string, wrapper string"
    return pages.select(host(F.col("url")).alias("host"), F.col("html")).filter("html is not null") \
        .mapInArrow(_partial, shape) \
        .repartition("host", F.pmod(F.xxhash64("wrapper"), F.lit(32))).mapInArrow(_aligned, shape) \
        .repartition("host").mapInArrow(_finished, "host string, pages long, expression string, slots array<string>")


def page_text(source: str | None, slots) -> str:
    """Article blocks of one page; a page that fills no article slot gives the slots that are not mostly
    links, or all if these are none."""
    if not source:
        return ""
    blocks, wanted = Page(source).blocks, frozenset(slots or ())
    found = [text for path, text, _ in blocks if path in wanted]
    if not found:
        chars: dict[str, int] = {}
        for path, text, links in blocks:
            chars[path] = chars.get(path, 0) + len(text) - 2 * links
        found = [text for path, text, _ in blocks if chars[path] >= 0 or _is_title(path)] or [text for _, text, _ in blocks]
    return "\n".join(found)


def _extract(batches):
    for batch in batches:
        texts = [page_text(source.as_py(), slots.as_py())
                 for source, slots in zip(batch.column("html"), batch.column("slots"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"])


def extract_text(pages: DataFrame, wrappers: DataFrame | None = None) -> DataFrame:
    """(page_id, url, text) of every page. The wrappers are stored in the shared folder; Spark
    broadcasts them where their size on disk allows it and joins by host otherwise."""
    spark = pages.sparkSession
    known = stored(spark, wrappers if wrappers is not None else infer_wrappers(pages), "wrappers")
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host")) \
        .join(known.select("host", "slots"), "host", "left").select("page_id", "url", "html", "slots")
    kinds = {field.name: field.dataType.simpleString() for field in rows.schema}
    return rows.mapInArrow(_extract, f"page_id {kinds['page_id']}, url string, text string")
