from vaportrail.llm.html import best_containers, main_texts, parsed, text_of

ARTICLE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'
    '<nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- ad 3 --><div class="ad">Buy now, buy.</div>'
    "<article><h1>Title &amp; more</h1><p><b>First  paragraph,\n with text.<br><p>Second one &lt;here&gt;.</p>"
    '<div class="comments"><p>Nice, I say, very nice indeed, so nice.</p></div>'
    "<form><label>Mail</label><input></form></article>"
    '<aside><p>Sidebar, sidebar.</p></aside><footer>&copy; host</footer></body></html>'
)


def text(source, path=None):
    return text_of(parsed(source), path)


def test_article_without_the_rest():
    assert text(ARTICLE) == "Title & more\nFirst paragraph, with text.\nSecond one <here>."


def test_broken_markup():
    assert text("<p>a, b<p>c &amp d &#233; &am") == "a, b\nc & d é &am"
    assert text("plain text only") == "plain text only"
    assert text("<div><p>one <i>two</p> three</i> four</div>") == "one two\nthree four"
    assert text("<p>cut <a href='x") == "cut"
    assert text("<script>never closed <p>x</p>") == ""
    assert text("") == "" and text("<nav>x</nav>") == ""
    assert text('<p title="a > b">in quotes</p>') == "in quotes"
    assert len(text("<div>" * 5000 + "<p>deep</p>")) == 4


def test_empty_and_custom_elements_end_nothing():
    for tag in ('<svg class="icon"/>', "<canvas/>", '<object data="a>b" />', "<video src=x>", "<video-player>", "<button-group>"):
        assert text(f"<p>one {tag}two</p><p>three</p>").split() == ["one", "two", "three"], tag
    assert text("<p>one<svg><path/>no</svg >two</p>") == "one two"
    assert text("<p>one<svg/>two<SVG>no</SVG>three<svg>four</p>") == "one two three four"
    assert text("<p>one</p><style>never closed <p>x</p>") == "one"
    assert text("<p>x</p>" + "<video>" * 20000).strip() == "x"


def test_links_count_against_a_container():
    page = parsed(
        "<div class='list'>" + "<p><a href='#'>a link with many words, many words</a></p>" * 9 + "</div>"
        "<div class='b'><p>Some running text, with commas, and more of it.</p></div>"
    )
    assert page.path(best_containers(page)[0][0]) == "div.b"


def test_pages_of_a_host_agree(spark):
    page = "<html><body><div class='c1 x{0}'><p>{1}</p></div><div class='y'><p>{2}</p></div></body></html>"
    rows = [(i, "https://a.org/p", page.format(i, "Main text, quite long, really. " * 5, "short"), 1) for i in range(6)]
    # Alone, this page would choose its other container.
    rows.append((6, "HTTP://u@A.org:80/q", page.format(9, "Main.", "Other text, much longer, here. " * 5), 1))
    rows += [(7, "https://b.org", page.format(1, "Main.", "Other text, much longer, here. " * 5), 1)]
    rows += [(8, None, None, 1), (9, "x", "", 1), (None, "https://a.org", page.format(1, "Null id.", "z"), 1)]
    found = {r.page_id: r for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string, path int")).collect()}
    assert len(found) == 11 and found[6].text == "Main." and found[None].text == "Null id."
    assert found[7].text.startswith("Other") and found[8].text == found[9].text == ""
    assert all(r.n_chars == len(r.text) for r in found.values()) and found[6].url == "HTTP://u@A.org:80/q"


def test_shuffled_paths_give_the_same(spark, monkeypatch):
    from vaportrail.llm import html

    rows = [(i, f"https://h{i % 3}.org", ARTICLE) for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    expected = {r.text for r in main_texts(pages).collect()}
    monkeypatch.setattr(html, "BROADCAST_HOSTS", 0)
    assert {r.text for r in main_texts(pages).collect()} == expected


def test_empty_table(spark):
    assert main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_names_that_speak_of_noise_keep_the_article():
    inner = "<article><p>Running text, with commas.</p></article>"
    for name in ("no-sidebar", "content-with-sidebar", "page has-sidebar", "ad-free", "comments-open", "layout sidebar"):
        assert text(f'<body><div class="{name}">{inner}</div></body>') == "Running text, with commas.", name
    for name in ("sidebar", "site-footer", "ad-slot", "comment-list", "cookie-banner", "main-nav"):
        page = f'<body><div class="{name}"><p>Something else, of course.</p></div>{inner}</body>'
        assert text(page) == "Running text, with commas.", name
        assert text(f'<div class="{name}"><p>Something else, of course.</p></div>') == "", name


def test_comments_in_articles_stay_out():
    page = (
        '<main><p>Running text, with commas.</p></main>'
        '<div class="comments"><article class="comment-body"><p>Nice, I say.</p></article></div>'
    )
    assert text(page) == "Running text, with commas."


def test_broken_pages_take_linear_time():
    import time

    start = time.perf_counter()
    assert text("<p>begin</p>" + "<b>x</p>" * 130_000).startswith("begin")
    assert len(text("<i>" + "<div>" * 3000 + "x</i>" * 30_000)) == 30_000
    alike = "<div class='a'><p>one, two</p></div>" * 30_000
    assert text(alike, "div.a").count("\n") == 29_999
    assert time.perf_counter() - start < 15
