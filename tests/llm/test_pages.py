"""Main text of pages: the given pages, odd markup, and site evidence without helpful names."""

import html
import random
import re

import pytest

from ledgerloom.llm import pages
from ledgerloom.llm import queries as q

SF = "/root/testdata/sf0.01"


def text_of(page):
    return " ".join(b.text for b in pages._main(pages.parse(page)))


def test_given_pages(spark):
    got = {r.page_id: (r.text, r.n_chars) for r in q.op8_pages(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"(?s)<article>(.*?)(</article>|\Z)", r.html)[1]
        plain = re.sub(r"</?(?:p|h1|br)>", " ", article).replace("<b>", "").replace("</b>", "")
        expected = " ".join(html.unescape(plain).split())
        assert got[r.page_id] == (expected, len(expected))


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (None, ""),
        ("", ""),
        ("plain &lt;b&gt; text &amp;amp;  x\n y", "plain <b> text &amp; x y"),
        ("<p>one<p>two<br>three<ul><li>a<li>b</ul>four", "one two three a b four"),
        ("<p>in<b>li</b>ne <i>x</p>", "inline x"),
        ("<nav>menu</nav><header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>Body</article><footer>f</footer>", "Title Body"),
        ("<main><div class='ad-banner'>buy</div><p>text</p><div id=userComments><p>reader</p></div></main>", "text"),
        ("<body><div>a</div><aside>s</aside><form>f<input></form><div hidden>h</div><div role=navigation>n</div>b</body>", "a b"),
        ("<script>var a='</p><p>x';</script><style>p{}</style><p>ok</p><!-- <p>no</p> --><script>never closed", "ok"),
        ("<p>caf&eacute; &#233; &#x4e2d; &unknown; &am", "café é 中 &unknown; &am"),
        ("<p title=\"a>b\">quoted</p></div></p>end", "quoted end"),
        ("<article>cut off <b", "cut off"),
        ("<div><nav><p>m</div><p>after", "after"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<div class='headline'>kept</div><div class='page-header'>gone</div>", "kept"),
        ("<body class='single no-sidebar'><article><p>whole</p></article></body>", "whole"),
        ("<body><article class='post has-sidebar'><p>whole</p></article></body>", "whole"),
        ("<main id='page-comments-off'><p>whole</p></main>", "whole"),
        ("<form id='aspnetForm'><div><p>whole</p></div></form>", "whole"),
        ("<form id='aspnetForm'><nav>menu</nav><article><p>whole</p><form>sign up</form></article></form>", "whole"),
        ("<article><p class='social-history'>one</p><div class='related-work'>two</div></article>", "one two"),
        ("<article><p>Press <button>OK</button> to go on</p><button>Share</button></article>", "Press OK to go on"),
        ("<article><p>before</p><audio src=x><p>after</p></article>", "before after"),
        ("<article><p>a <video>no video here</video> b</p></article>", "a b"),
        ("<div class='left-sidebar'>x</div><div class='sidebar-inner'>y</div><div class='sidebarless'>z</div>", "z"),
        ("<div role=main><p>text</p></div><body role=navigation><p>more</p></body>", "text more"),
    ],
)
def test_markup(page, expected):
    assert text_of(page) == expected


def test_site_evidence(spark):
    """Furniture without telling names or tags goes where the site repeats it; near copies of an article stay."""
    rows = []
    for i in range(40):
        body = f"<p>Story {i} has its own words {i * 7}.</p><p>More of {i}.</p>"
        rows.append((i, f"https://a.example/{i}", f"<div class=x1>Home Shop About</div><div class=x2>{body}</div><div class=x3>All rights</div>", 1))
    for i in range(40, 60):
        rows.append((i, f"http://B.example:80/{i}", f"<article><h1>Same title</h1><p>Copy with change {i % 3}</p><p>{i}</p></article>" if i < 48 else f"<article><h1>T{i}</h1><p>{i}</p></article>", 1))
    rows += [(100, None, "<p>no url</p>", 1), (101, "not a url", "<p>odd</p>", 1), (102, "https://a.example/n", None, 1), (None, "https://c.example", "<p>c", 1), (0, *rows[0][1:])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = {(r.page_id, r.url): r.text for r in pages.extract(df).collect()}
    assert all(got[(i, f"https://a.example/{i}")] == f"Story {i} has its own words {i * 7}. More of {i}." for i in range(40))
    assert all(got[(i, f"http://B.example:80/{i}")] == f"Same title Copy with change {i % 3} {i}" for i in range(40, 48))
    assert got[(100, None)] == "no url" and got[(101, "not a url")] == "odd" and got[(102, "https://a.example/n")] == "" and got[(None, "https://c.example")] == "c"
    assert pages.extract(df).count() == len(rows) and pages.extract(df.limit(0)).count() == 0


def test_very_long_page(spark):
    page = "<article>" + "<p>word &amp; more</p>" * 20000 + "<div>" * 3000 + "deep" + "</article>"
    df = spark.createDataFrame([(1, "https://l.example/", page)], "page_id long, url string, html string")
    assert pages.extract(df).first().text == "word & more " * 20000 + "deep"


@pytest.mark.parametrize("copies", [60, 95])
def test_near_copies_of_an_article_stay_whole(spark, copies):
    """A group of near copies that makes up most of a host: what they share stays, a notice in every article goes."""
    rng = random.Random(copies)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    shared = [" ".join(word() for _ in range(n)) for n in (6, 5, 60, 4, 30)]

    def page(host, parts, notice):
        h1, h2, p, li, quote = parts
        article = f"<h1>{h1}</h1><p>{p}</p><h2>{h2}</h2><ul><li>{li}</ul><blockquote>{quote}</blockquote>"
        end = "<section>Read more in our shop</section>" if notice else ""
        return f"https://{host}/{len(rows)}", f"<div>Home Shop</div><article>{article}{end}</article>", " ".join((h1, p, h2, li, quote))

    rows = []
    for i in range(100):
        if i < copies:
            words = shared[2].split()
            words[rng.randrange(60)] = word()
            words[rng.randrange(60)] = word()
            rows.append(page("near.example", [*shared[:2], " ".join(words), *shared[3:]], False))
        else:
            rows.append(page("near.example", [" ".join(word() for _ in range(n)) for n in (6, 5, 60, 4, 30)], False))
    for i in range(30):
        rows.append(page("notice.example", [" ".join(word() for _ in range(n)) for n in (6, 5, 60, 4, 30)], True))
    df = spark.createDataFrame([(i, url, text) for i, (url, text, _) in enumerate(rows)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert [got[i] for i in range(len(rows))] == [r[2] for r in rows]


def plain_tree(rows):
    """The style tree over lists: importance of every (host, node, text), pages with one main text counted once."""
    import math
    from collections import defaultdict

    shown, texts = defaultdict(set), {}
    for page_id, url, page in rows:
        blocks, host = pages.parse(page), pages.host_of(url)
        main = tuple(b.text for b in pages._main(blocks))
        texts[page_id] = (host, blocks)
        for path, (content, style, marked) in pages._shown(blocks).items():
            shown[host, path].add((main, content, style, marked))
    low = set()
    for (host, path), found in shown.items():
        m = len({x[0] for x in found})
        marked = any(x[3] for x in found)
        if m < (pages.MIN_PAGES_MARKED if marked else pages.MIN_PAGES):
            continue
        styles = defaultdict(int)
        for x in found:
            styles[x[2]] += 1
        total = sum(styles.values())
        presentation = sum(-k / total * math.log(k / total) / math.log(max(2, total)) for k in styles.values())
        for content in {x[1] for x in found}:
            k = len({x[0] for x in found if x[1] == content})
            value = pages.CONTENT_SHARE * (1 - math.log(k) / math.log(m)) + (1 - pages.CONTENT_SHARE) * presentation
            if k > 1 and value < pages.LEAST and (not marked or k * 2 > m):
                low.add((host, content))
    out = {}
    for page_id, (host, blocks) in texts.items():
        gone = {path for path, (content, _, _) in pages._shown(blocks).items() if (host, content) in low}
        out[page_id] = " ".join(b.text for b in pages._main([b for b in blocks if b.node.path not in gone]))
    return out


def test_tree_against_plain_version_without_helpful_tags(spark):
    """The given pages without their article, menu and advert tags: the tree alone finds the text, as its plain version does."""
    given = spark.read.parquet(f"{SF}/pages.parquet").collect()
    bare = lambda page: re.sub(r"</?article>", "", re.sub(r"<(/?)(?:nav|footer)\b[^>]*>", r"<\1div>", page.replace(' class="ad"', "")))
    rows = [(r.page_id, f"https://one.example/{r.page_id}", bare(r.html)) for r in given]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    expected = plain_tree(rows)
    assert got == expected
    kept = 0
    for r in given:
        article = re.search(r"(?s)<article>(.*?)(</article>|\Z)", r.html)[1]
        paragraphs = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", p))).split()) for p in re.findall(r"(?s)<p>(.*?)</p>", article)]
        kept += all(p in " ".join(got[r.page_id].split()) for p in paragraphs)
    assert kept >= 0.9 * len(given)
