from pulsegrid.llm.htmltext import Page, main_text

ARTICLE = "<article><h1>A &amp; B</h1><p>First\n  line <a href=x>of</a> it<br>goes on.<p>Second &eacute;&#x41;<ul><li>one<li>two</ul></article>"
WANT = "A & B\nFirst line of it goes on.\nSecond éA\none\ntwo"


def text(html):
    return "\n".join(t for _, t in Page(html).article())


def test_parts_that_html_marks():
    noise = ("<nav><ul><li>Home</ul></nav><header><h2>Site</h2></header><div class='ad-box'>Buy</div><aside>See also</aside><form><p>Name<input></form>"
             "<section id='comments'><article><p>Nice post</p></article></section><div class='cookieNotice'>Cookies</div><footer>&copy; 2020</footer>"
             "<script>var a='</p>';</script><style>p{}</style><!-- ad --><div hidden>no</div><div role=navigation>menu</div><div style='display: none'>x</div>")
    page = lambda body: f"<!DOCTYPE html><html><head><title>T</title></head><body>{noise}{body}{noise}</body></html>"
    assert text(page(ARTICLE)) == WANT
    assert text(page("<div id=content><h1>Top</h1>Loose words<p>Text</p> tail <span class=advert>buy</span></div>")) == "Top\nLoose words\nText\ntail"
    inner = ARTICLE.replace("<p>Second", "<div class='share-bar'>Share</div><div class=newsletter>Join</div><p>Second")
    assert text(page(inner)) == WANT


def test_broken_and_odd_pages():
    assert text("") == "" and text("<p>") == "" and text("plain < text & more") == "plain < text & more"
    assert text("<article><p><b>Bold<br><p>Next</p></article></div></p>") == "Bold\nNext"
    assert text("<article><p>&nbsp;a&nbsp;\t b &lt;i&gt;</article>") == "a b <i>"
    assert text("<main><p>x</main><p>out") == "x" and text("<![bad[ <p>y") in ("y",)
    assert len(text("<p>" + "word " * 300000)) == 5 * 300000 - 1


def test_style_tree_drops_repeated_branches(spark):
    rows = []
    for i in range(40):
        body = "".join(f"<p>Story {i} sentence {j} is its own.</p>" for j in range(3 + i % 4))
        rows.append((i, f"https://Site.example/{i}", f"<div class=x1>Welcome to our site</div><div class=story>{body}<p>The same last line.</p></div><div class=x2><p>All about {i % 2}</p></div>"))
    rows += [(100, "https://one.example/a", "<div class=x1>Welcome to our site</div>"), (101, None, None), (102, "nonsense", ""), (103, "https://Site.example/same", rows[0][2]), (103, "https://Site.example/same", rows[0][2])]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, text string, host int")
    got = main_text(df).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r["text"] for r in got}
    for i in range(40):
        assert by[i] == "\n".join([f"Story {i} sentence {j} is its own." for j in range(3 + i % 4)] + ["The same last line."])
    assert by[100] == "Welcome to our site" and by[101] == "" and by[102] == "" and by[103] == by[0]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert main_text(df.limit(0)).collect() == []


def test_style_tree_keeps_articles_of_copies_and_section_heads(spark):
    own = lambda i, n: "".join(f"<p>Own sentence {i} {j}.</p>" for j in range(n))
    site = "<div class=site>Welcome to our site</div>"
    rows = [(i, f"<body>{site}<article><h2>Introduction</h2>{own(i, 3)}<h2>References</h2></article></body>") for i in range(30)]
    copy = f"<article><h2>Introduction</h2>{own(99, 3)}<blockquote>Quoted</blockquote><ul><li>One<li>Two</ul></article>"
    rows += [(100 + i, f"<body>{site}{copy}</body>") for i in range(12)]
    # the same without marks: copies of one text with a block that no other page has
    loose = f"<div class=story>{own(77, 3)}<blockquote>Quoted</blockquote></div>"
    rows += [(200 + i, f"<body>{site}{loose}</body>") for i in range(12)]
    rows += [(300 + i, f"<body>{site}<div class=story>{own(i + 300, 2)}{'<blockquote>Rare words</blockquote>' if i < 9 else ''}</div></body>") for i in range(80)]
    df = spark.createDataFrame([(k, "https://copies.example/x", h) for k, h in rows], "page_id long, url string, html string")
    by = {r["page_id"]: r["text"] for r in main_text(df).collect()}
    for i in range(30):
        assert by[i].split("\n") == ["Introduction", *[f"Own sentence {i} {j}." for j in range(3)], "References"]
    for i in range(12):
        assert by[100 + i].split("\n") == ["Introduction", *[f"Own sentence 99 {j}." for j in range(3)], "Quoted", "One", "Two"]
        assert by[200 + i].split("\n") == [*[f"Own sentence 77 {j}." for j in range(3)], "Quoted"]
    for i in range(9):
        assert by[300 + i].split("\n") == [*[f"Own sentence {i + 300} {j}." for j in range(2)], "Rare words"]


def test_text_after_odd_declarations_stays():
    assert text("<![bad[ <p>y") == "y" and text("<p>x<![bad[ z ]]><p>y") == "x\ny"
    assert text("<p>x<![]><p>y") == "x\ny" and text("<p>x<![ 5>5]><p>y").endswith("\ny") and text("<p>x<![iffy]><p>y") == "x\ny"
    assert text("<p>x<![if !IE]>z<![endif]><p>y") == "xz\ny" and text("<p>x<![CDATA[ a > b ]]><p>y") == "x\ny"
    assert text("<p>x<![CDATA[ open <p>y") == "xy" and text("<p>x<!odd [ (a)><p>y") == "x\ny"
    assert text(f"<p>x&#{'9' * 5000};<p>y") == "x\ufffd\ny" and text(f"<p>x&#{'0' * 5000}65;<p>y") == "xA\ny"


def test_head_without_end_tag():
    assert text("<html><head><title>t</title><body><p>x") == "x" and text("<head><title>t<body><p>x") == "x"
    assert text("<html><head><meta charset=utf-8><link rel=x><style>p{}</style><script>1</script><noscript><img src=x>n</noscript><p>x<p>y") == "x\ny"
    assert text("<head><title>t</title>\n <a href=x>x</a> tail") == "x tail" and text("<head><title>t</title> loose <p>x") == "loose\nx"
    assert text("<head><title>t</title></head><body><p>x") == "x" and text("<head><title>t</title>") == ""


def test_names_do_not_cut_the_article():
    story = "<article><p>A story of some length.</p><p>And more.</p></article>"
    want = "A story of some length.\nAnd more."
    for name in ("content has-sidebar", "post no-comments", "with-ads", "overflow-hidden", "page-with-menu-left", "widget", "elementor-widget"):
        assert text(f"<body><div class='{name}'>{story}</div><div class=sidebar>Links</div></body>") == want, name
        assert text(f"<body><div class='{name}'><p>A story of some length.<p>And more.</div></body>") == want, name
    inner = "<section id=discussion><h2 id=search>Search</h2><p class=notice>Note<p class=reply>Reply <em class=alert>now</em></section>"
    assert text(f"<article><h1>T</h1>{inner}<p>Some more of the article.</article>") == "T\nSearch\nNote\nReply now\nSome more of the article."
    assert text("<div class=ad>An advertisement longer than the article.</div><article><p>Short.</article>") == "Short."
    # whole names, first and last words still cut
    for name in ("sidebar", "ad-box", "main-menu", "cookieNotice"):
        assert text(f"<div><p>A story of some length.</div><div class='{name}'>Less of it</div>") == "A story of some length.", name


def test_article_or_main():
    teaser, story = "<article><h3>Teaser</h3></article>", "<h1>Title</h1><p>The story itself is longer.</p>"
    assert text(f"<body>{teaser}<main>{story}</main></body>") == "Title\nThe story itself is longer."
    assert text(f"<main>{story}{teaser}</main>") == "Title\nThe story itself is longer.\nTeaser"
    assert text(f"<main><p>Crumbs</p><article>{story}</article></main>") == "Title\nThe story itself is longer."
    assert text(f"<div>{story}</div>{teaser}") == "Title\nThe story itself is longer.\nTeaser"
    assert text(f"<main><p>Wait</p></main><article>{story}</article>") == "Wait\nTitle\nThe story itself is longer."


def test_tree_confirms_cuts_by_name(spark):
    shared = "<div class=sidebar><p>" + "The same long list of links on every page. " * 9 + "</p></div>"
    rows = [(i, f"<body>{shared}<div class=story><p>Story {i}.</p></div></body>") for i in range(20)]
    rows += [(100 + i, f"<body><div class=promo><p>Own words of page {i}, and many of them.</p></div><div class=story><p>Story {i + 50}.</p></div></body>") for i in range(20)]
    df = spark.createDataFrame([(k, "https://names.example/x", h) for k, h in rows], "page_id long, url string, html string")
    by = {r["page_id"]: r["text"] for r in main_text(df).collect()}
    for i in range(20):
        assert by[i] == f"Story {i}." and by[100 + i] == f"Own words of page {i}, and many of them.\nStory {i + 50}."


def test_unmarked_blocks_that_repeat_over_a_host_go(spark):
    import math

    from pulsegrid.llm.htmltext import LOW_TEXT, MIN_PAGES

    rows, want = [], {}
    for h, n in (("a.org", 14), ("b.org", 5)):  # the second host has too few pages for a tree
        for i in range(n):
            shared = ["Home", "About us", "Copyright Example Press"] + (["Now on sale"] if i < 11 else []) + (["Read this twice"] if i % 2 else [])
            story = [f"Story {h} {i} tells of things {i * 7} and more.", f"It goes on for page {i} only."]
            body = "".join(f"<div>{t}</div>" for t in shared[:2] + story + shared[2:])
            rows.append((f"{h}{i}", f"http://{h}/{i}", f"<html><body><div>{body}</div></body></html>"))
            want[f"{h}{i}"] = shared[:2] + story + shared[2:]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()}
    for key, blocks in want.items():  # by hand: a text on n of the host's m pages
        host = [v for k, v in want.items() if k[:5] == key[:5]]
        on = {t: sum(t in v for v in host) for t in blocks}
        left = [t for t in blocks if not (on[t] >= MIN_PAGES and 1 - math.log(on[t]) / math.log(len(host)) < LOW_TEXT)]
        assert got[key] == "\n".join(left)
    assert "Home" not in got["a.org3"] and "Read this twice" in got["a.org3"] and "Home" in got["b.org1"]
    # an article is kept whole, whatever repeats in it
    marked = [(k, u, h.replace("<body><div>", "<body><article>").replace("</div></body>", "</article></body>")) for k, u, h in rows]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(marked, "page_id string, url string, html string")).collect()}
    assert all(got[k] == "\n".join(v) for k, v in want.items())
