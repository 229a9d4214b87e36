"""Main text: what is not rendered, borders of blocks, bad markup, foreign names, odd tables."""

import time

import pytest

from starmart.llm import html_text as H

LINE = "This is a sentence of some length that goes on for a while and then ends."


@pytest.fixture(scope="module")
def written():
    return H.Model.fit([(p, H.by_attribute(p)) for p in map(H.parse, H.written_pages())])


@pytest.fixture(scope="module")
def empty():
    """A model that learned nothing."""
    return H.Model.fit([])


def test_not_rendered_is_never_content(written):
    page = f"""<body><div class="content"><p>{LINE}</p><script>var a=1;</script><p>{LINE}<style>p{{}}</style></p>
    <noscript>no script</noscript><template><p>{LINE}!</p></template><svg><text>drawn</text></svg>
    <p>{LINE} <button>Click <b>here</b></button></p></div></body>"""
    assert H.extract(page, written) == "\n\n".join([LINE] * 3)
    inside = H.extract(page.replace('div class="content"', "article").replace("</div>", "</article>"), written)
    assert inside == "\n\n".join([LINE] * 3)


def test_not_rendered_whatever_was_learned(empty):
    page = H.parse(f"<article><p>{LINE}</p><noscript><p>{LINE}</p></noscript><select><option>x</select></article>")
    content = empty.marginals(page)
    hidden = [k for k, tag in enumerate(page.tags) if tag in H.UNSEEN]
    hidden += [k for k in range(len(page.tags)) if page.parents[k] in hidden]
    assert len(hidden) > 3 and max(content[k] for k in hidden) < 1e-9
    # They tell nothing about what they stand in.
    without = H.parse(f"<article><p>{LINE}</p></article>")
    assert content[:4] == pytest.approx(empty.marginals(without))


def test_blocks_are_set_apart_by_what_is_left_out(written):
    page = f'<body><div class="content"><div>{LINE}<div class="ad">Buy</div>{LINE}</div></div></body>'
    assert H.extract(page, written) == f"{LINE}\n\n{LINE}"
    page = f"<body><article><p>{LINE}</p><div>aa<b>bb</b>c<script>x</script>c {LINE}<hr>dd {LINE}<br>ee</div></article></body>"
    assert H.extract(page, written) == f"{LINE}\n\naabbcc {LINE}\n\ndd {LINE} ee"


@pytest.mark.parametrize("aside", ['div id="disqus_thread"', 'section class="kommentare"', 'div id="gdpr-bar"', 'div class="publicidad"'])
@pytest.mark.parametrize("main", ["article", 'div class="content"', 'div class="post"'])
def test_comments_and_notices_by_other_names(written, aside, main):
    tag, ends = main.split()[0], aside.split()[0]
    for inside in (True, False):
        part = f"<{aside}><p>{LINE}</p><p>{LINE}</p></{ends}>"
        page = f"<body><{main}><h1>Title</h1><p>{LINE}</p>{part if inside else ''}</{tag}>{'' if inside else part}</body>"
        assert H.extract(page, written) == f"Title\n\n{LINE}"


def test_bad_markup_takes_linear_time():
    for start, end in (("<div>", "</p>"), ("<b>", "</li>"), ("<ul><li>", "</td>"), ("<span>", "<li>")):
        began = time.perf_counter()
        page = H.parse(start * 40_000 + "x" + end * 40_000)
        assert time.perf_counter() - began < 8
        assert len(page.tags) >= 40_001


def test_stray_ends_change_nothing():
    assert H.parse("<div></p><p>a</b></div></div>b<p>c").tags == H.parse("<div><p>a</div>b<p>c").tags
    page = H.parse("<ul><li>a<li>b</ul><p>c<div>d</div>")
    assert [page.tags[k] for k in page.parents[1:]] == ["#root", "ul", "li", "ul", "li", "#root", "p", "#root", "div"]


def test_odd_tables(spark, written):
    pages = spark.createDataFrame([(1, None, "x", 7, "u"), (2, "", "x", 7, "u"), (3, f"<article><p>{LINE}</p></article>", "x", 7, "u")],
                                  "page_id long, html string, text string, n_chars int, url string")
    found = H.main_text(pages, written)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert [tuple(r) for r in found.orderBy("page_id").collect()] == [(1, "u", "", 0), (2, "u", "", 0), (3, "u", LINE, len(LINE))]
    none = pages.where("false")
    assert H.main_text(none, H.learn(none.select("page_id", "html").toDF("id", "html"))).count() == 0
