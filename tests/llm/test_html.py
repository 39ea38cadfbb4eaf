"""Pages that the operator for main texts once got wrong."""

import pytest

from millrace.llm import html


def words(n, name="word"):
    return " ".join(f"{name}{k}" for k in range(n))


def test_comments_go_however_long_they_are():
    for kind in ("comment-list", "comments", "user-comments area", "disqus_thread", "replies"):
        page = f"<body><div class='post'><h1>Title</h1><p>{words(300)}</p></div><div class='{kind}'><p>{words(900, 'talk')}</p></div></body>"
        assert html.main_text(page) == f"Title\n{words(300)}"
    page = f"<article><p>{words(80)}</p><div id='comment-section'><article class='comment-body'><p>{words(200, 'talk')}</p></article></div></article>"
    assert html.main_text(page) == words(80)
    # what wraps the whole page is no comment
    assert html.main_text(f"<div class='comments-enabled'><h1>T</h1><p>{words(90)}</p></div>") == f"T\n{words(90)}"


def test_values_of_attributes_are_no_attributes():
    for attributes in ("data-x='class=ad'", "title=\"hidden class='ad'\"", "data-note='x hidden'", "alt=\"role='dialog'\"", "data-class=ad"):
        assert html.main_text(f"<article><p {attributes}>{words(60)}</p></article>") == words(60)
    for attributes in ("class=ad", "CLASS='ad'", "x=1 class = \"big ad\"", "hidden", "aria-hidden='true'", "role=dialog", "class='ad' class='post'"):
        assert html.main_text(f"<article><p>{words(60)}</p><div {attributes}>gone</div></article>") == words(60)


def test_classes_of_paragraphs_in_an_article_remove_nothing():
    page = f"<article><p>{words(60)}</p><p class='related'>one</p><p class='social'>two</p><p class='ad-hoc note'>three</p><div class='ad'>gone</div></article>"
    assert html.main_text(page) == f"{words(60)}\none\ntwo\nthree"
    assert html.main_text(f"<div class='post'><header><h1>Title</h1></header><p>{words(60)}</p></div>") == f"Title\n{words(60)}"


def test_forms():
    assert html.main_text(f"<body><form action='x'><div><p>{words(200)}</p></div></form></body>") == words(200)
    assert html.main_text(f"<body><div><p>{words(200)}</p></div><form><label>Your name</label><input></form></body>") == words(200)


def densities(page):
    """The densities and scores of the docstring, by recursion over the tree."""
    import math

    root = html.parse(page)
    html.settle(root)

    def count(n):
        own = [sum(len(" ".join(x.split())) for x in n.items if isinstance(x, str)), 0, 0, 0]
        for x in n.items:
            if isinstance(x, html.Node) and not x.gone:
                c = count(x)
                own = [own[0] + c[0], own[1] + c[1] + 1, own[2] + c[2], own[3] + c[3]]
        if n.name == "a":
            own[2], own[3] = own[0], own[3] + 1
        return own

    def every(n):
        yield n
        for x in n.items:
            if isinstance(x, html.Node) and not x.gone:
                yield from every(x)

    body = next((n for n in every(root) if n.name == "body"), root)
    b = count(body)
    out = []
    for n in every(root):
        c, t, lc, lt = count(n)
        t, lc1, lt1 = max(1, t), max(1, lc), max(1, lt)
        base = math.log(c / max(1, c - lc) * lc + b[2] / max(1, b[0]) * c + math.e)
        out.append(c / t * max(0.0, math.log(max(1.0, c * t / (lc1 * lt1)))) / base if c else 0.0)
    return sorted(out)


def test_densities_over_all_pages():
    import pyarrow.parquet as pq

    pages = pq.read_table("/root/testdata/sf0.001/pages.parquet", columns=["html"])["html"].to_pylist()
    for page in pages:
        root = html.parse(page or "")
        html.settle(root)
        assert sorted(n.density for n in html.measure(root)) == pytest.approx(densities(page or ""))
