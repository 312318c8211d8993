import json
import random
import re
import time
from html import unescape

from lakeward.llm import op1_wrappers as op1
from llm_helpers import rows

FRAME = ("<!DOCTYPE html><html><head><title>{t}</title><style>p{{x}}</style><script>var t=\"</p>\";</script></head>"
         "<body class=\"no-sidebar page\"><header><h2>Site</h2></header><nav><ul><li><a href=/a>Home</a><li>About</ul></nav>"
         "<div class=cookie-notice>We use cookies</div><div class=\"ad\">Buy {t}</div>"
         "<article><header><h1>{t}</h1></header>{body}<div class=toolbox><span>Print this</span></div></article>"
         "<aside>Side {t}</aside><form><label>Search</label><textarea>x</textarea></form>"
         "<section id=\"comments\"><article class=\"comment\"><p>I like {t}</p></article></section>"
         "<footer>&copy; x</footer></body></html>")


def test_article_only(spark):
    pages, want = [], {}
    for k in range(12):
        paragraphs = [f"Para {k} {j} with  <b>bold</b> &amp; a\n\tbreak&nbsp;here" for j in range(1 + k % 4)]
        body = "".join(f"<p>{p}" + ("</p>" if k % 2 else "") for p in paragraphs)
        pages.append((k, f"http://h{k % 1}.example.org/{k}", FRAME.format(t=f"Title {k}", body=body), "extra"))
        clean = [" ".join(unescape(re.sub("<[^>]*>", "", p)).split()) for p in paragraphs]
        want[k] = "\n".join([f"Title {k}", *clean])
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, wrapper string")
    got = {r.page_id: r for r in op1.main_text(df).collect()}
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    wrapper = json.loads(op1.wrappers(df).first().wrapper)
    body = next(i for i in wrapper[op1.ITEMS][0][op1.ITEMS] if i[op1.KEY].startswith("body"))
    assert body[op1.PAGES] == 12


def test_whole_table_against_the_generator_pattern(spark):
    """The pages' article is known: everything between <article> and </article>."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in op1.main_text(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h\d)>", inner)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b), r.page_id


def test_edge_cases(spark):
    html = [None, "", "plain text &lt;x&gt; &am &amp", "<", "<p", "<p>a<p>b", "<div><p>x</div></p>y<br>z", "<!-- never closed",
            "<article>" + "<p>w &eacute; " * 20_000, "<main><p>in</p></main><p>out</p>", "<b><i>t</b>u</i>",
            "<div class=content><p>c</p></div><p><a href=x>menu link</a></p>", "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>",
            "<table><tr><td>1<td>2<tr><td>3</table>", "<script>never closed <p>x", "<p>" + "<div>" * 3000 + "deep"]
    want = ["", "", "plain text <x> &am &", "<", "<p", "a\nb", "x\ny z", "", "\n".join(["w é"] * 20_000), "in", "tu", "c",
            "a\nb\nc\nd", "1\n2\n3", "", "deep"]
    data = [(k, u, h, "x") for k, h in enumerate(html) for u in (None, "odd", f"http://h{k}/p")] + [(None, None, "<p>q", "x")]
    df = spark.createDataFrame(data + data[:3], "page_id bigint, url string, html string, host string")
    got = rows(op1.main_text(df), "page_id", "url", "text", "n_chars")
    text = dict(enumerate(want)) | {None: "q"}
    assert got == sorted(((k, u, text[k], len(text[k])) for k, u, _, _ in data + data[:3]), key=repr)
    assert op1.main_text(df.limit(0)).collect() == []


def test_labels_survive_odd_pages(spark):
    """Null, empty, error and differently built pages, and pages without the label, switch nothing off."""
    page = "<div class=box><h1>T {k}</h1><p>Text {k}</p><div class=tools><span>{label}</span></div></div>"
    html = [page.format(k=k, label="Print this") for k in range(30)]
    html += [None, "", "<h1>404</h1>", "<table><tr><td>x</table>", page.format(k=30, label="Other words"),
             "<div class=box><h1>T 31</h1><p>Text 31</p><div class=tools><span></span></div></div>"]
    want = [f"T {k}\nText {k}" for k in range(30)]
    want += ["", "", "404", "x", "T 30\nText 30\nOther words", "T 31\nText 31"]
    for parts in (1, 5):
        df = spark.createDataFrame([(k, f"http://h.org/{k}", h) for k, h in enumerate(html)],
                                   "page_id bigint, url string, html string").repartition(parts)
        got = {r.page_id: r.text for r in op1.main_text(df).collect()}
        assert [got[k] for k in range(len(html))] == want
    only = spark.createDataFrame([(1, "http://n.org/", None), (2, "http://n.org/", "")], df.schema)
    assert sorted((r.page_id, r.text) for r in op1.main_text(only).collect()) == [(1, ""), (2, "")]


def test_text_counts_of_a_slot():
    pages = [op1.expression(f"<div><span>{t}</span></div>") for t in ["Share"] * 90 + [f"x{k}" for k in range(10)]]
    for order in (pages, pages[::-1], pages[80:] + pages[:80]):
        whole = json.loads(json.dumps(op1.expression("")))
        for p in json.loads(json.dumps(order)):
            whole = op1.combined(whole, p)
        slot = whole[op1.ITEMS][0][op1.ITEMS][0][op1.ITEMS][0]
        assert whole[op1.PAGES] == 100 and slot[op1.CONSTANT] == op1.checksum("Share")


def test_frames_beyond_the_wrapper_keep_their_article(spark):
    """More different keys at a level than a wrapper keeps, and frames nested deeper than it goes."""
    slug = lambda k: "".join(chr(97 + int(c)) for c in f"{k:04d}")
    html = [f"<body><div class='sidebar-{slug(k)}'><article><p>Text {k}</p></article></div><div class=social>no</div></body>"
            for k in range(3 * op1.MOST_ITEMS)]
    html.append("<div>" * (op1.DEPTH + 9) + "<div class=sidebar><article><p>Deep</p></article></div>")
    df = spark.createDataFrame([(k, f"http://h.org/{k}", h) for k, h in enumerate(html)],
                               "page_id bigint, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in op1.main_text(df).collect()}
    assert got == {k: f"Text {k}" for k in range(len(html) - 1)} | {len(html) - 1: "Deep"}


def test_alignment_makes_optional_repeated_and_variable_items():
    a = op1.expression("<div><h1>A</h1><p>x</p><p>y</p><span>Share</span></div>")
    b = op1.expression("<div><h1>B</h1><em>new</em><p>z</p><span>Share</span></div>")
    op1.merge(a, b)
    items = {i[op1.KEY]: i for i in a[op1.ITEMS][0][op1.ITEMS]}
    assert items["p"][op1.REPEATED] and items["em"][op1.OPTIONAL] and not items["h1"][op1.OPTIONAL]
    slot = lambda k: items[k][op1.ITEMS][0][op1.CONSTANT]
    assert slot("h1") is None and slot("span") is not None and items["span"][op1.PAGES] == 2


def test_groups_fold():
    e = op1.expression("<dl><dt>1</dt><dd>a</dd><dt>2</dt><dd>b</dd><dt>3</dt><dd>c</dd></dl>")
    assert [(i[op1.KEY], i[op1.REPEATED]) for i in e[op1.ITEMS][0][op1.ITEMS]] == [("dt", 1), ("dd", 1)]


def test_names_are_read_as_a_whole():
    read = op1.Reader(None).text
    kept = ('<article><h2 id="related-work">Related work</h2><p class="notice-period">Notice</p><div class="social-studies">'
            'Social</div><section id="search-algorithms">Search</section>{}</article>')
    assert read(kept.format("")) == "Related work\nNotice\nSocial\nSearch"
    for name in ("related-posts", "share", "socialLinks", "comment-list", "x newsletter-signup", "ad-slot"):
        assert read(kept.format(f'<div class="{name}">no</div>')) == "Related work\nNotice\nSocial\nSearch"


def test_elements_that_are_never_closed():
    read = op1.Reader(None).text
    assert read("<article><p>One</p><button>x<p>Two</p></article>") == "One\nTwo"
    assert read("<head><title>x<meta charset=u></head><body><article><p>A</p></article>") == "A"
    assert read("<main><button>b</button> tail <button>c<p>end</p></main>") == "tail\nend"
    assert read("<article><p>One<select><option>1<option>2</select> two</p></article>") == "One two"


def test_header_of_an_article_keeps_its_headings():
    read = op1.Reader(None).text
    assert read("<article><header><h1>T</h1><p>By me</p><span>today</span></header><p>Body</p></article>") == "T\nBody"
    assert read("<header><h1>Site</h1></header><main><header><div><h1>T</h1> by</div></header><p>Body</p></main>") == "T\nBody"


def page_without_names(r, names):
    """A page whose markup names nothing: all class names are random strings of the host."""
    words = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    body = [words(r.randint(20, 60)) for _ in range(r.randint(2, 6))]
    html = (f'<body><div class="{names[0]}"><div class="{names[1]}">Our site</div><div class="{names[2]}">'
            + "".join(f'<a href="/{k}">{words(2)}</a>' for k in range(6)) + f'</div><div class="{names[3]}"><div class="{names[4]}">'
            + "".join(f"<p>{b}</p>" for b in body) + f'</div></div><div class="{names[5]}">{words(3)}</div>'
            f'<div class="{names[6]}">All about it</div></div></body>')
    return html, "\n".join(body)


def test_wrapper_finds_the_article_without_names(spark):
    r = random.Random(8)
    names = ["".join(r.choice("klmnopqrstuvwxyz") for _ in range(7)) for _ in range(7)]
    made = [page_without_names(r, names) for _ in range(20)]
    df = spark.createDataFrame([(k, f"http://h.example/{k}", h) for k, (h, _) in enumerate(made)],
                               "page_id bigint, url string, html string")
    got = {x.page_id: x.text for x in op1.main_text(df).collect()}
    assert got == {k: text for k, (_, text) in enumerate(made)}
    # by its own markup alone a page keeps what surrounds the article
    alone = op1.Reader(None).text
    assert all(alone(h) != text for h, text in made)


def test_long_irregular_pages_align_quickly():
    r = random.Random(9)

    def page(n):
        kinds = [r.choice(["section", "div", "h2", "ul"]) for _ in range(n)]
        return "<article>" + "".join(f'<{t} class="{"".join(r.choice("abcdefgh") for _ in range(3))}">x</{t}>' for t in kinds) + "</article>"

    one, two = op1.expression(page(10_000)), op1.expression(page(10_000))
    began = time.process_time()
    op1.combined(one, two)
    assert time.process_time() - began < 2


def test_matches_are_a_common_subsequence(monkeypatch):
    r = random.Random(10)
    for cells in (0, 30, 10_000):
        monkeypatch.setattr(op1, "CELLS", cells)
        for _ in range(200):
            x, y = ([r.choice("abcdefgh") for _ in range(r.randint(0, 30))] for _ in range(2))
            got = op1.matches(x, y)
            assert all(x[i] == y[j] for i, j in got)
            assert all(a < c and b < d for (a, b), (c, d) in zip(got, got[1:]))
            if cells == 10_000:
                assert len(got) == len(op1._common(x, y))


def test_a_level_keeps_every_item():
    """Labels beyond the items that a reader looks through are found like the others."""
    many = 3 * op1.MOST_ITEMS
    slug = lambda k: "".join(chr(97 + int(c)) for c in f"{k:04d}")
    page = lambda n, skip: "<body>" + "".join(
        f"<div class='z{slug(k)}'>Label {k}</div>" for k in range(many) if k != skip) + f"<p>Text {n}</p></body>"
    pages = [page(n, 10 * n) for n in range(2 * op1.LABEL_PAGES)]
    whole = op1.expression(pages[0])
    for html in pages[1:]:
        whole = op1.combined(whole, op1.expression(html))
    read = op1.Reader(json.loads(json.dumps(whole))).text
    assert [read(html) for html in pages] == [f"Text {n}" for n in range(len(pages))]
