"""Wrappers and page text."""

import html
import re

import pytest

from feedloom.llm import wrappers as w


def page(body, head="<title>t</title><script>var t='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


CASES = {
    "plain": (page("<nav><ul><li><a href='/x'>menu</a></ul></nav><article><h1>A &amp; B</h1><p>one\n two<p>three <b>bold</b>"
                   "</article><footer>&copy; me</footer>"), "A & B\none two\nthree bold"),
    "furniture": (page("<header>head</header><div class='cookie-notice'>accept</div><main><form>name</form><p>text</p>"
                       "<aside>side</aside><div class='ad'>buy</div><section class=comments><p>first!</p></section>"
                       "<p>end &#x1F600;</p></main>"), "text\nend \U0001F600"),
    "unclosed": ("<article><p><b>one<br><p>two</article><footer>no", "one\ntwo"),
    "line break": ("<article><p>one<br>two</p></article>", "one two"),
    "words are not ads": ("<article><div class='headline loading'>kept</div></article>", "kept"),
    "states are no furniture": ("<div class='content has-sidebar no-ads'><p>kept</p></div>", "kept"),
    "article with comments": ("<article class='post comments-open'><p>a</p><article class='comment-body'>b</article></article>", "a"),
    "no container": ("<div><p>some text that is long enough</p></div><nav>menu</nav>", "some text that is long enough"),
    "only text": ("just words", "just words"),
    "broken": ("<article><p title='a>b\">text<p x=\"1\">more", None),
    "null": (None, ""),
    "empty": ("", ""),
    "blank": (page("<article> \n </article>"), ""),
    "table": ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
    "comment": ("<article><!-- <p>no</p> --><p>yes</p><style>p{}</style></article>", "yes"),
    "deep": ("<article>" + "<div>" * 500 + "deep" + "</div>" * 500 + "</article>", "deep"),
}


def test_cases(spark):
    rows = [(k, f"https://h{k}.example/{k}", source) for k, (source, _) in enumerate(CASES.values())]
    got = {r.page_id: r.text for r in w.extract_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k, (name, (_, text)) in enumerate(CASES.items()):
        if text is None:
            assert isinstance(got[k], str)
        else:
            assert got[k] == text, name


def test_documents_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in w.extract_text(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?(?:b|br)>", "", part)).split())
                  for part in re.split(r"</?(?:p|h1)>", inside)]
        assert got[r.page_id] == "\n".join(filter(None, blocks))


def infer(sources):
    wrapper = w.new_wrapper()
    for source in sources:
        w.align_page(wrapper, w.Page(source))
    return wrapper


def test_mismatches_become_optional_repeated_groups_and_slots():
    wrapper = infer(["<div><h1>a</h1><p>x</p></div>", "<div><h1>b</h1><p>x</p><p>x</p><ul><li>q</li></ul></div>"])
    assert w.expression(wrapper) == '<div><h1>#</> <p>"x"</>+ <ul><li>"q"</></>?</>'.replace('"q"', "#")
    mixed = infer(["<div><h2>a</h2><p>b</p><h2>c</h2><p>d</p></div>"])
    assert w.expression(mixed) == "<div>(<h2>#</>* <p>#</>*)*</>"


def test_wrappers_merge_as_pages_do():
    sources = ["<div><h1>a</h1><p>x</p></div>", "<div><p>y</p><p>z</p></div>", "<div><h1>c</h1><ul><li>1<li>2</ul></div>"]
    whole = infer(sources)
    merged = w.align_wrappers(infer(sources[:1]), infer(sources[1:]))
    assert {p: sorted(map(sorted, k["groups"])) for p, k in whole["of"].items()} == {
        p: sorted(map(sorted, k["groups"])) for p, k in merged["of"].items()}
    assert {p: s[:3] + s[4:] for p, s in whole["slots"].items()} == {p: s[:3] + s[4:] for p, s in merged["slots"].items()}


def test_template_text_outside_containers_goes(spark):
    rows = [(k, "https://one.example/", f"<div><div class=top>Welcome to our site</div><div class=txt>story {k}</div></div>")
            for k in range(6)]
    got = w.extract_text(spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string")).collect()
    assert sorted(r.text for r in got) == sorted(f"story {k}" for k in [0, *range(6)])


def test_empty_and_extra_columns(spark):
    schema = "page_id long, url string, html string, host string, slots string, text string, wrapper string"
    assert w.extract_text(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, None, "<article>a</article>", "h", "s", "t", "w"), (None, "x", None, None, None, None, None)]
    got = w.extract_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == [(0, ""), (1, "a")]


@pytest.mark.parametrize("source", ["<" * 3000, "<p class='" * 500, "</p>" * 3000, "<a href=\"" + "x" * 50_000, "<!--" * 500])
def test_hostile_pages_end(source):
    w.page_text(source, [])


@pytest.mark.parametrize("name", ["class='layout-with-sidebar'", "class='page-with-sidebar'", "id='search-and-content'",
                                  "class='two-col-sidebar-right'"])
def test_class_words_do_not_hide_an_article(name):
    side = "<div class='sidebar'>side</div>"
    for body in (f"<div {name}>{side}<article><h1>t</h1><p>kept text</p></article></div>",
                 f"<main><h1>t</h1><div {name}>{side}<article><p>kept text</p></article></div></main>",
                 f"<div {name}>{side}<main><h1>t</h1><p>kept text</p></main></div>"):
        assert w.page_text(body, w.article_slots(infer([body]))) == "t\nkept text"
    assert w.page_text(f"<div {name}><p>kept text</p></div>", []) == "kept text"
    long = "a long comment " * 9
    for body in (f"<article>kept</article><section class=comments><article>{long}</article><article>{long}</article></section>",
                 f"<article>kept<section class=comments><article>{long}</article></section></article>",
                 f"<article>kept</article><article class='comment-body'>{long}</article>"):
        assert w.page_text(body, w.article_slots(infer([body]))) == "kept"


def test_links_and_copies_lose_no_text(spark):
    linked = "<div><h1><a href=/>title {k}</a></h1><p>some words {k}</p><p><a href=/>all of this is a link {k}</a></p><p>and more plain words {k}</p></div>"
    rows = [(k, "https://links.example/", linked.format(k=k)) for k in range(4)]
    rows += [(10 + k, "https://copies.example/", "<div><h1>head</h1><p>one</p><p>two</p></div>") for k in range(5)]
    rows += [(20, "https://alone.example/", "<div><p><a href=/>only a link</a></p></div>")]
    got = {r.page_id: r.text for r in w.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(4):
        assert got[k] == f"title {k}\nsome words {k}\nall of this is a link {k}\nand more plain words {k}"
    assert {got[10 + k] for k in range(5)} == {"head\none\ntwo"} and got[20] == "only a link"
