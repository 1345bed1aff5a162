from __future__ import annotations

from pyspark.sql import functions as F

from keyweave.llm.html_text import extract, main_text

LONG = "A long paragraph of the article that goes on for a while, as paragraphs do, with words."


def test_article_without_what_is_around_it():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style>
    <script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li>Home</ul></nav>
    <div class="ad">{LONG}</div><div id="cookie-notice">{LONG}</div>
    <article><h1>Title &amp; more</h1><p><b>{LONG}<br><p>{LONG} caf&eacute;&nbsp;x
       y</p><ul><li>one<li>two</ul><aside>{LONG}</aside><form>{LONG}</form>
    <div class="comments"><p>{LONG}</p></div></article>
    <section class="comments">{LONG}</section><footer>&copy; {LONG}</footer></body></html>"""
    assert main_text(page) == "\n\n".join(
        ["Title & more", LONG, LONG + " café x y", "one", "two"])


def test_page_without_article_element():
    page = f"""<body><div id="top"><a href=1>a</a> <a href=2>b</a> <a href=3>c</a></div>
    <div class="content"><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>
    <div><a href=1>x</a><a href=2>y</a><a href=3>z</a></div></body>"""
    assert main_text(page) == "\n\n".join(["Head", LONG, "Short.", LONG])


def test_comment_words_on_the_page_and_the_article():
    said = f'<article class="comment-body even"><p>{LONG} said.</p></article>'
    page = f"""<html class="js comments"><body class="single comments-open">
    <article class="post comment-status-closed"><p>{LONG}</p></article>{said}
    <section id="comments"><p>{LONG}</p></section></body></html>"""
    assert main_text(page) == LONG
    assert main_text(f'<body class="single comments-open"><div><p>{LONG}</p></div></body>') == LONG
    assert main_text(f'<main id="main" class="has-comments"><p>{LONG}</p></main>') == LONG


def test_paragraphs_wrapped_one_by_one():
    short, long = "A short paragraph of just forty-five letters.", "Long words. " * 62
    lines = [*[f"{short} {i}" for i in range(5)], long.strip(), *[f"{short} {i}" for i in range(5, 10)]]
    wrapped = "".join(f"<div><p>{x}</p></div>" for x in lines)
    links = "<div><a href=1>one</a> <a href=2>two</a></div>"
    for page in (f"<body>{links}{wrapped}{links}</body>",
                 f'<body>{links}<div id="text">{wrapped}{links}</div></body>',
                 "<body>" + wrapped.replace("<div", '<section class="b"')
                 .replace("</div", "</section") + "</body>"):
        assert main_text(page) == "\n\n".join(lines)


MORE = "Another paragraph, of other words, that says some more about it and then comes to an end."


def test_layouts_that_look_like_something_else():
    body = f"<article><h1>Title</h1><p>{LONG}</p><p>{MORE}</p></article>"
    plain = f"<div><h1>Title</h1><p>{LONG}</p><p>{MORE}</p></div>"
    want = "\n\n".join(["Title", LONG, MORE])
    menu = '<ul><li><a href="1">Home page</a></li><li><a href="2">About us</a></li></ul>'
    for inner in (body, plain):
        pages = {
            "head without end": f"<html><head><title>T</title><body>{inner}</body></html>",
            "form around": f"<body><form action=x>{inner}<input name=q></form></body>",
            "unclosed nav": f"<body><nav>{menu}<main>{inner}</main></body>",
            "commentary": f'<body><div class="match-commentary">{inner}</div></body>',
            "open comments": f'<body><div class="post hentry comments-open">{inner}</div></body>',
            "has sidebar": f'<body><div class="has-sidebar">{inner}</div><div>{menu}</div></body>',
            "with sidebar": f'<body><main><div class="content with-sidebar">{inner}</div></main></body>',
            "misleading": f'<body><div class="widget-area">{inner}</div><footer>x</footer></body>',
        }
        for name, page in pages.items():
            assert main_text(page) == want, name
    said = f'<div class="user-comments"><div class="comment-12">{LONG} said.</div></div>'
    assert main_text(f"<body>{body}{said}</body>") == want
    assert main_text(f"<body>{said}{said}{said}</body>") == ""  # nothing but comments


def test_weakly_marked_paragraphs_of_an_article_are_judged_by_their_ratio():
    lines = "".join(f"<p>{LONG}</p>" for _ in range(4))
    legal = f'<p class="legal">{MORE}</p>'
    links = '<p class="legal"><a href=1>a</a><a href=2>b</a><a href=3>c</a><a href=4>d</a></p>'
    got = main_text(f"<article>{lines}{legal}{lines}{links}{links}{links}</article>")
    assert got == "\n\n".join([*[LONG] * 4, MORE, *[LONG] * 4])
    assert MORE not in main_text(f'<article>{lines}<p class="ad">{MORE}</p></article>')


def test_parts_that_hold_less_stay_out():
    page = f"""<body><header><p>{MORE}</p></header><article><p>{LONG}</p></article>
    <aside><p>{MORE}</p><p>{MORE}</p><p>{MORE}</p></aside><div class="related"><p>{MORE}</p></div>
    <form><p>{LONG}</p></form><footer><p>{MORE}</p></footer></body>"""
    assert main_text(page) == LONG


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<p></p>") == main_text("<!-- x -->") == ""
    assert main_text("no markup &lt;at all") == "no markup <at all"
    assert main_text("<article><p>a</div></p></b>b<script>x") == "a\n\nb"
    assert len(main_text("<article>" + f"<p>{LONG}</p>" * 5000 + "</article>").split("\n\n")) == 5000
    assert main_text("<div>" * 3000 + "deep") == "deep"


def test_extract_keeps_rows_and_other_columns(spark):
    rows = [(1, "u", "<article><p>é x</p></article>", "k"), (2, None, None, "k"), (2, None, None, "k"),
            (None, "v", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")
    out = extract(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in out.collect())
    assert got == [(0, "", 0), (1, "é x", 3), (2, "", 0), (2, "", 0)]
    assert extract(pages.where(F.lit(False))).count() == 0
