import pytest

from poolwright.llm import html_extract as m

LABELLED = [
    "<html><head><title>t t t</title></head><body><nav><ul>" + "<li><a href=x>menu entry</a></li>" * 5 + "</ul></nav><article><h1>Head line</h1>" + "<p>plain words of a text that goes on</p>" * 5
    + "</article><div class='ad'>buy this now</div><footer>all rights reserved</footer></body></html>"] * 4


@pytest.fixture(scope="module")
def weights(spark):
    return m.learn(spark.createDataFrame([(i, h) for i, h in enumerate(LABELLED)], "page_id long, html string"))


def test_words_are_positive_and_tags_negative(weights):
    assert weights[m.WORD] > 0 and all(v < 0 for k, v in weights.items() if k != m.WORD)


CASES = {
    "entities and white space": ("<article><p>a &amp; b &lt;c&gt;&nbsp;d\n\t e</p><p></p><p>f<br>g<b>h</b>i</p></article>", "a & b <c> d e\n\nf ghi"),
    "inner parts go": (
        "<article><div class=ad>buy</div><p>one two</p><aside>no</aside><div id='comments'><p>said I</p></div><form><p>mail</p></form><script>var t='</p><p>x';</script>"
        "<style>p{}</style><!-- c <p>x</p> --><p>three</p><footer>f</footer></article>", "one two\n\nthree"),
    "page parts go": (
        "<body><header><h1>Site</h1></header><div class='cookie-notice'><p>" + "we use cookies " * 20 + "</p></div><article><p>the text</p></article><section class=comments><article class=comment><p>"
        + "a reader says " * 30 + "</p></article></section></body>", "the text"),
    "no marks": (
        "<body><div class=menu>" + "<a href=x>go there</a>" * 8 + "</div><div><h2>Title</h2><p>" + "many words here " * 20 + "</p><ul><li>first of a list with some words in it</li></ul><p>"
        + "and more " * 30 + "</p></div><div class='sidebar'>" + "aside " * 50 + "</div></body>",
        "Title\n\n" + ("many words here " * 20).strip() + "\n\nfirst of a list with some words in it\n\n" + ("and more " * 30).strip()),
    "unclosed": ("<article><p><b>a b c<br><p>d e <i>f", "a b c\n\nd e f"),
    "quoted sign": ("<article><p title='x > y'>a</p><p>1 < 2 and 3 > 2</p></article>", "a\n\n1 < 2 and 3 > 2"),
    "text alone": ("just some words", "just some words"),
    "empty": ("", ""),
    "only tags": ("<html><body><br></body></html>", ""),
    "code points": ("<article><p>\U0001f642 ß</p></article>", "\U0001f642 ß"),
}


def test_the_scan_finds_the_text_without_marks(weights):
    for page in LABELLED + [f"<body><nav><a href=x>go</a></nav><article><h1>Title</h1><p>{'words of it ' * n}</p><p>end<br>of it</p></article><div class='ad'>buy</div></body>" for n in (5, 50, 500)]:
        bare = page.replace("<article>", "").replace("</article>", "")
        assert m.extract(page, weights) == m.extract(bare, weights) != ""


def test_the_scan_decides_within_marks(weights):
    """A menu in the marked part that nothing names is not in the best run."""
    page = "<main><p>" + "<a href=x>go there now</a>" * 9 + "</p><p>" + "words of the text " * 20 + "</p></main>"
    assert m.extract(page, weights) == ("words of the text " * 20).strip()


def test_a_part_word_beside_other_words_drops_nothing(weights):
    page = (
        '<article><p>A</p><div class="related-work"><p>said before</p></div><p>B</p><section class="social-history"><p>of a town</p></section>'
        '<blockquote class="comment">a quoted word</blockquote><div class="comment-list"><p>reader</p></div><div class="ad-slot-1">buy</div><p>C</p></article>')
    assert m.extract(page, weights) == "A\n\nsaid before\n\nB\n\nof a town\n\na quoted word\n\nC"


def test_unclosed_elements_take_linear_time():
    page = "<div>x" * 20_000 + "</section>" * 20_000
    assert len(list(m.tokens(page))) == 60_000


def test_all_marked_parts_are_joined(weights):
    page = "<article><p>one two</p></article>" + "<div><ul><li>x</li></ul></div>" * 40 + "<article><p>" + "many words " * 20 + "</p></article>"
    assert m.extract(page, weights) == "one two\n\n" + ("many words " * 20).strip()


@pytest.mark.parametrize("names", ["class='has-sidebar'", "class='content-sidebar-wrap'", "class='no-comments'", "id='main-menu-page'"])
def test_names_of_wrappers_drop_nothing(weights, names):
    text = "words of the page " * 20
    inner = "<nav><a href=x>menu</a></nav>{}<section class='comments'><article><p>a reader</p></article></section>"
    marked = f"<body><div {names}>" + inner.format(f"<article><p>{text}</p></article>") + "</div></body>"
    assert m.extract(marked, weights) == text.strip()
    plain = f"<body><div {names}><p>{text}</p><div class='ad'>buy</div></div><div class='sidebar'>aside</div></body>"
    assert m.extract(plain, weights) == text.strip()


@pytest.mark.parametrize("name", CASES)
def test_text_of_pages(weights, name):
    page, wanted = CASES[name]
    assert m.extract(page, weights) == wanted


def test_the_region_is_the_best_run(weights):
    """The linear scan against all runs of tokens."""
    page = "<div>a b</div><nav>c</nav><p>d e f g h i j k</p><ul><li>l</li></ul><p>m n o p q r s t u v w x y z</p><footer>end</footer>"
    found = list(m.tokens(page))
    values = [
        len(t.split()) * weights.get(m.PART if part else kind, 0.0) if kind in (m.WORD, m.LINKED, m.PART) else weights.get(m._class(kind, part), m.NEW_INLINE if kind.lstrip("/") in m.INLINE else m.NEW_BLOCK)
        for kind, t, _, part in found]
    best = max(sum(values[a:b]) for a in range(len(values)) for b in range(a, len(values) + 1))
    found = m.extract(page, weights)
    assert best > 0 and "m n o p" in found and "end" not in found


def test_hard_rows(spark):
    long_ = "<article>" + "<p>many words of a long page</p>" * 20_000 + "</article>"
    rows = [(1, None, None, "x", 1), (None, "u", "", "x", 1), (2, "u", long_, "x", 1), (2, "u", long_, "x", 1), (3, "u", LABELLED[0], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = {r.page_id: r for r in m.extract_pages(pages).collect()}
    assert got[1].text == "" and got[1].n_chars == 0 and got[None].text == ""
    assert got[2].text.count("\n\n") == 19_999 and got[2].n_chars == len(got[2].text)
    assert m.extract_pages(pages).count() == 5
    assert m.extract_pages(pages.filter("false")).collect() == []
