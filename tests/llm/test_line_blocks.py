import random
import re

import pyarrow.parquet as pq
import pytest

from weeklens.llm import line_blocks as lb

PARA = "This paragraph is long enough to count as text, with a good number of words in it."
PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t=\"</p><article>\";</script></head>"
        "<body><header><h1>Site</h1></header><nav><ul><li><a href='/a'>Home</a></li></ul></nav><!-- <p>no</p> -->"
        "<div class=\"ad\">Buy this now</div><article><h1>Title &amp; more</h1><p><b>First</b> part&nbsp;of\n it. {p}<br>x "
        "<p>Of.</article><section id=comments><p>{p}</p></section><aside><p>{p}</p></aside><footer>&copy; 2024</footer></body></html>")


def test_article():
    assert lb.main_text(PAGE.replace("{p}", PARA)) == f"Title & more First part of it. {PARA} x Of."


def test_pages_without_a_marked_article():
    body = "".join(f"<p>{PARA} {i}</p>" for i in range(4))
    page = (f"<div><a href=/>one</a> <a href=/>two</a></div><div id=content>{body}</div><form><p>{PARA}</p></form>"
            f"<div class='cookie-notice'>{PARA}</div><ul><li><a href=/>{PARA}</a></li></ul>")
    assert lb.main_text(page) == " ".join(f"{PARA} {i}" for i in range(4))


@pytest.mark.parametrize("html,text", [
    ("", ""), ("plain", ""), ("<p>short</p>", ""), ("<article>short</article>", "short"), ("a < b", ""),
    ("<article><p>1 &lt; 2 and a<b</p></article>", "1 < 2 and a<b"),
    ("<main><p>un<i>bro</i>ken", "unbroken"),
    ("<nav><article>menu</article></nav>", ""),
    ("<div class='page header-fixed'><article>kept</article></div>", "kept"),
    ("<article><div class=share>Share</div><p>kept</p><div hidden>gone</div></article>", "kept"),
    ("<script>" + "x" * 100, ""), ("<article>a<!-- open", "a"), ("<article>x</article", "x"),
])
def test_cases(html, text):
    assert lb.main_text(html) == text


def test_table(spark):
    data = [(1, "u", PAGE.replace("{p}", PARA), 9), (1, "u", PAGE.replace("{p}", PARA), 9), (None, None, None, None), (2, "v", "", 1),
            (3, "w", "<article>" + f"<p>{PARA} é\U0001F600</p>" * 5000 + "</article>", 1)]
    got = lb.extract(spark.createDataFrame(data, "page_id long, url string, html string, n_chars long"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = got.collect()
    assert [r.page_id for r in out] == [1, 1, None, 2, 3] and out[2].text == out[3].text == ""
    assert all(r.n_chars == len(r.text) for r in out) and out[4].n_chars == 5000 * (len(PARA) + 4) - 1 - 1 + 0 + 1
    assert lb.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_articles_of_the_test_pages(spark):
    """The extracted text is the article's and nothing else."""
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = {r.page_id: r.text for r in lb.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        inner = re.sub(r"</?(?:h1|p|br)>", " ", inner)
        assert texts[r.page_id] == " ".join(html.unescape(re.sub(r"</?b>", "", inner)).split())


BODY = "".join(f"<p>{PARA} {i}</p>" for i in range(4))
TEXT = " ".join(f"{PARA} {i}" for i in range(4))


@pytest.mark.parametrize("noise", [
    f'<p class="ad">{PARA}</p>', f"<p hidden>{PARA}", f'<p class="cookie-notice">{PARA}<p class=x></p>',
    f'<ol class="commentlist"><li class="comment">{PARA}<li class="comment"><p>{PARA}</p></ol>',
    f'<div><span style="display:none">{PARA} <span>{PARA}</span> x</span></div>', f'<span class="ad">{PARA}</span>',
    f'<div class="comment-list"><p>{PARA}</p>{BODY}</div>', f'<div class="left-sidebar"><p>{PARA}</p></div>',
])
def test_noise_without_an_article(noise):
    assert lb.main_text(BODY + noise) == TEXT
    assert lb.main_text(noise + BODY) == TEXT
    assert lb.main_text(f"<article>{BODY}{noise}</article>") == TEXT


@pytest.mark.parametrize("wrapper", [
    '<div class="layout with-sidebar">{}</div>', '<div id="page" class="header-fixed">{}</div>',
    "<form method=post action=x.aspx>{}</form>", '<div class="has-comments"><ul><li>{}</ul></div>',
])
def test_wrappers_of_the_page_stay(wrapper):
    for body in (BODY, f"<article>{BODY}</article>"):
        assert lb.main_text(f"<nav>{PARA}</nav>" + wrapper.format(body + f'<p class="ad">{PARA}</p>')) == TEXT


def test_every_marked_article_stays():
    page = f"<article>{BODY}</article><article><p>short news</article><aside><article>{PARA}</article></aside>"
    assert lb.main_text(page + "<article><a href=/>More of this</a></article>") == TEXT + " short news"


def brute(sizes, window, surge, dive, bounded):
    """The kept lines, every block summed anew and every stretch from its surge to its dive."""
    block = lambda i: sum(sizes[i:i + window])
    kept, i, free = set(), 0, 0
    while i < len(sizes):
        if not (sizes[i] > 0 and block(i) > surge and block(i) > dive):
            i += 1
            continue
        end = next((j for j in range(i, len(sizes)) if block(j) <= dive), len(sizes))
        run_up = i
        while run_up > max(free, i - window + 1) and (bounded or sizes[run_up - 1]):
            run_up -= 1
        kept |= {j for j in range(run_up, end) if bounded or sizes[j] or j < run_up}
        i = free = end
    return [j in kept for j in range(len(sizes))]


def test_surges_and_dives_equal_brute_force():
    r = random.Random(4)
    for _ in range(3000):
        sizes = [r.choice([0, 0, 5, 20, 60, 90, 300]) for _ in range(r.randrange(25))]
        window, surge, bounded = r.randrange(1, 5), r.choice([0, 40, 80]), r.random() < 0.5
        assert lb.text_lines(sizes, window, surge, 0, bounded) == brute(sizes, window, surge, 0, bounded)


def test_article_tags_change_nothing_on_the_test_pages():
    for row in pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist():
        plain = re.sub(r"<(/?)(?:article|main)\b", r"<\1div", row["html"])
        assert plain != row["html"] and lb.main_text(plain) == lb.main_text(row["html"])


def test_links_inside_an_article():
    links = "".join(f"<p><a href=/{i}>Other page number {i}</a></p>" for i in range(4))
    title = "<h1><a href=/>A linked title</a></h1>"
    middle = f"<article>{title}{BODY}<p><a href=/x>A source</a></p><p>{PARA}</p>{links}</article>"
    assert lb.main_text(middle) == f"A linked title {TEXT} A source {PARA}"


def test_title_and_date_before_a_surge():
    page = f"<div><a href=/>Home</a></div><h1>Title</h1><p>1 May</p><p>By B.</p>{BODY}"
    assert lb.main_text(page) == f"Title 1 May By B. {TEXT}"
