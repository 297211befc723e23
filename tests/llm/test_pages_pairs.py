"""Main text of pages, preference pairs, registration and the pipeline."""

import random
import re

import __spark_entry__
import corpus_pipeline
import pytest
from llm_fixture import documents, no_documents
from oracle_check import compare, duck
from riskframe.llm import entries, preference, tagpaths
from riskframe.llm.common import table

SF = "/root/testdata/sf0.001"

PAGES = {
    "<html><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>First,\n  one. More text, here.</p><p>Second <b>bold</b> word.</article></body>": "A & B\n\nFirst, one. More text, here.\n\nSecond bold word.",
    "<body><header>Site name and slogan, long enough to matter.</header><div class='main'><h2>Title</h2><p>Some text, with commas, and points.</p><p>Ok.</p></div><aside>Other reads, many, many.</aside><footer>Imprint, 2020.</footer>": "Title\n\nSome text, with commas, and points.\n\nOk.",
    "<article><p>Body text, long enough. Yes.</p><div class='ad-box'>Buy now, cheap, best.</div><section id=comments><p>I disagree, really, and at length.</p></section><form><label>Mail</label><input></form></article>": "Body text, long enough. Yes.",
    "<article><p>One<br>two&nbsp;three &lt;tag&gt; &#233;<p>Four.<script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --></article>": "One two three <tag> é\n\nFour.",
    "<nav><ul><li><a>x</a><article><p>Menu was never closed, sorry.</p></article>": "Menu was never closed, sorry.",
    "<div><p>No article tag here, but a sentence.</p><p>And another, longer sentence, too.</p></div><div><a href=1>link</a> <a href=2>link</a></div>": "No article tag here, but a sentence.\n\nAnd another, longer sentence, too.",
    "<article><p>Cut <!-- never closed": "Cut",
    "<article><p>a<script>never closed": "a",
    "just text, no markup.": "just text, no markup.",
    "<p>1 < 2 and 3 > 2, fine.</p>": "1 < 2 and 3 > 2, fine.",
    "<div class='cookie notice'>We use cookies, sorry.</div>": "",
    "": "",
    "<": "<",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert tagpaths.main_text(page) == PAGES[page]


LINK_PAGES = {
    "<body><div><p>Text of one, long enough, with <a href=1>linked words</a> inside.</p></div><div><p>Text of two, long enough, with <a href=2>more words</a> too.</p></div>": "Text of one, long enough, with linked words inside.\n\nText of two, long enough, with more words too.",
    "<body><p>Straight in the body, <a>a link</a>, and on.</p><ul><li>short item<li>other item</ul><blockquote>Quoted</blockquote><p>And the end, after <a>all</a>, of the text.</p>": "Straight in the body, a link, and on.\n\nshort item\n\nother item\n\nQuoted\n\nAnd the end, after all, of the text.",
    "<body><div><p>One text, long enough, to be the text.</p></div><ul><li><a>Home</a> | <a>About</a></ul><div><p>Other text, long enough, to be the text.</p><ul><li>last item</ul></div>": "One text, long enough, to be the text.\n\nOther text, long enough, to be the text.\n\nlast item",
    "<article>Bare text, with <a>linked words</a>, and more.<br>Second line, <a>again</a>.<p>Paragraph, at the end.</p><a>Share</a> <a>Print</a></article>": "Bare text, with linked words, and more. Second line, again.\n\nParagraph, at the end.",
    "<table><tr><td>Cell text, with <a>linked words</a>, and more.</td></tr></table>": "Cell text, with linked words, and more.",
}


@pytest.mark.parametrize("page", LINK_PAGES)
def test_links_inside_sentences_stay(page):
    assert tagpaths.main_text(page) == LINK_PAGES[page]


TEXT = "<h1>Title</h1><p>First text, long enough, to be kept.</p><p>Second text, long enough, to be kept.</p>"
KEPT = "Title\n\nFirst text, long enough, to be kept.\n\nSecond text, long enough, to be kept."


@pytest.mark.parametrize(
    "name", ["no-sidebar", "has-sidebar", "with-header", "content-form", "search-results", "content-sidebar-wrap", "widget", "page header"]
)
def test_marks_on_the_wrapper_of_a_page_leave_its_text(name):
    assert tagpaths.main_text(f"<body><div class='{name}'>{TEXT}</div><footer>Imprint, 2020.</footer>") == KEPT


@pytest.mark.parametrize("name", ["share-price", "notice-period"])
def test_parts_of_names_are_no_marks(name):
    assert tagpaths.main_text(f"<article>{TEXT}<section id='{name}'>Fell, by one.</section></article>") == f"{KEPT}\n\nFell, by one."


@pytest.mark.parametrize("name", ["ad", "ad-box", "comments", "site-footer", "share-buttons", "x sidebar", "related-posts"])
def test_marked_parts_of_an_article_go(name):
    other = f"<div class='{name}'><p>Other, words.</p><p>And more, words.</p></div>"
    assert tagpaths.main_text(f"<article>{TEXT}{other}</article>") == KEPT
    assert tagpaths.main_text(f"<body><div>{TEXT}</div>{other}") == KEPT


def test_every_article_paragraph_of_the_pages(spark):
    import html

    pages = table(spark, SF, "pages")
    got = {r.page_id: r for r in tagpaths.extracted(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(b for b in blocks if b)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


QUOTES = {
    "<article><p class=o'neil>First text, here.</p><p>It's second, text.</p></article>": "First text, here.\n\nIt's second, text.",
    "<article><p title=it's>One, text.</p><p>Two, it's.</p><p>Three, text.</p></article>": "One, text.\n\nTwo, it's.\n\nThree, text.",
    "<article><p title=\"a > b\" data-x = 'c > d'>One, text.</p><p a=b\"c>Two, \"quoted\".</p></article>": 'One, text.\n\nTwo, "quoted".',
    "<article><p title=\"never closed>One, text.</p><p>Two, text.</p></article>": "One, text.\n\nTwo, text.",
    "<article><p " + "a=\"1\" " * 3000 + ">Text, here.</p></article>": "Text, here.",
}


@pytest.mark.parametrize("page", QUOTES)
def test_quotes_in_tags_swallow_no_text(page):
    assert tagpaths.main_text(page) == QUOTES[page]


def test_an_unclosed_tag_with_many_values_ends():
    assert "Text" in tagpaths.main_text("<article><p>Text, here.</p><p " + "a=\"1\" " * 3000)


def without_names(page):
    """The page without semantic elements, classes, ids and roles."""
    page = re.sub(r"<(/?)(article|nav|header|footer|aside|main)\b", r"<\1div", page)
    return re.sub(r"\s(?:class|id|role)\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", "", page)


def test_ratios_find_the_article_without_semantic_elements(monkeypatch):
    pages = [r[0] for r in duck(SF.replace("0.001", "0.01")).execute("select html from pages order by page_id").fetchall()]
    want = [tagpaths.main_text(page) for page in pages]

    def right():
        return sum(tagpaths.main_text(without_names(page)) == text for page, text in zip(pages, want)) / len(pages)

    assert right() >= 0.95
    monkeypatch.setattr(tagpaths, "selected_paths", lambda nodes: {p for p, _ in nodes})
    assert right() < 0.2  # the selection decides


def test_awkward_pages(spark):
    df = spark.createDataFrame([(1, "u", None, 1), (1, "u", None, 1), (None, None, "<p>x, y.</p>" * 5000, 2)], "page_id long, url string, html string, text int")
    got = tagpaths.extracted(df).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, 5000 * 7 - 2]
    assert tagpaths.extracted(df.limit(0)).count() == 0


TURNS = [
    (0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (0, 2, "user", "more"), (0, 3, "assistant", "good"),
    (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "more"), (1, 3, "assistant", "bad"), (1, 4, "user", "?"),
    (2, 0, "user", "a"), (3, 0, "user", "a"), (4, 0, "user", None), (4, None, None, "x"), (6, 0, "user", "q"), (7, 0, "system", "q"),
    (None, 0, "user", "lost"), (0, 1, "assistant", "yes"),
]
CONVERSATION = "conv_id long, turn long, role string, text string"


def test_preference_pairs(spark):
    df = spark.createDataFrame(TURNS, CONVERSATION)
    got = {r.pair_id: r for r in preference.preference_pairs(df).collect()}
    assert set(got) == {0, 1, 2, 3}
    r = got[0]
    assert (r.status, r.prompt_turns) == ("pair", 3)
    assert r.prompt == "<|turn|>user\nhi<|end|>\n<|turn|>assistant\nyes<|end|>\n<|turn|>user\nmore<|end|>\n"
    assert r.chosen == "<|turn|>assistant\ngood<|end|>\n"
    assert [r.rejected[s.start : s.end] for s in r.rejected_mask] == ["bad<|end|>\n"]
    assert [r.chosen[s.start : s.end] for s in r.chosen_mask] == ["good<|end|>\n"]
    assert (got[1].status, got[1].chosen, got[1].rejected) == ("identical", "", "")
    assert got[2].status == "unpaired" and got[2].chosen == "<|turn|>\nx<|end|>\n<|turn|>user\n<|end|>\n"
    assert (got[3].status, got[3].prompt_turns, got[3].chosen_mask) == ("pair", 0, [])
    assert preference.preference_pairs(df.limit(0)).count() == 0


def planted_pairs():
    """(conv_id, turn, role, text) of pairs with common prefixes of every kind, and how many turns each shares."""
    rng = random.Random(8)
    out, shared = [], {}
    for pair in range(-6, 40):
        turns = [("system", "Be brief.")] * (pair % 3 == 0)
        turns += [("user" if k % 2 == 0 else "assistant", f"t{rng.randrange(99)} é\n{k}") for k in range(rng.randint(1, 9))]
        common = rng.choice([0, 1, len(turns) // 2, len(turns) - 1, len(turns)])
        other = [t if k < common else (t[0], t[1] + " differs") for k, t in enumerate(turns)]
        other += [("user", "one more")] * (common < len(turns) and pair % 4 == 0)
        shared[pair] = common
        for side, own in ((0, turns), (1, other)):
            out += [(2 * pair + side, k, role, text) for k, (role, text) in enumerate(own)]
    return out, shared


def test_planted_prefixes_against_the_twin(spark):
    rows, shared = planted_pairs()
    rows += [(-100, -5, "user", "early"), (-100, -1, "user", "late"), (-99, -5, "user", "early"), (-99, -1, "user", "other")]
    df = spark.createDataFrame(rows, CONVERSATION).repartition(3)
    got = preference.preference_pairs(df, 4)
    by_pair = {}
    for r in got.collect():
        by_pair[r.pair_id] = by_pair.get(r.pair_id, 0) + r.prompt_turns
    assert {p: by_pair[p] for p in shared} == shared and by_pair[-50] == 1
    assert sum(n > 0 for n in shared.values()) > 20
    con = duck("/nowhere")
    con.register("conversations", df.toPandas())
    assert compare(preference.digest(got), con, preference.oracle_sql(4)) is None


def test_long_pairs_continue_in_parts(spark):
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"t{t}" if t < 150 or c == 0 else f"r{t}") for c in (0, 1) for t in range(300)]
    df = spark.createDataFrame(turns, CONVERSATION)
    split, whole = preference.preference_pairs(df, 32), preference.preference_pairs(df, 1000)
    (one,) = whole.collect()
    parts = sorted(split.collect(), key=lambda r: r.part)
    assert len(parts) == 10
    for name in ("prompt", "chosen", "rejected"):
        assert "".join(r[name] for r in parts) == one[name]


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_twin(spark, name):
    assert compare(entries.queries()[name](spark, SF), duck(SF), entries.oracle_sql()[name]) is None


def test_all_are_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names


def test_pipeline_stages(spark):
    docs = documents(spark)
    labels = table(spark, SF, "labels")
    assert labels.count()
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns, name
        assert stage(spark, no_documents(spark), SF).count() == 0
    assert corpus_pipeline.run(spark, SF).count() > 0
