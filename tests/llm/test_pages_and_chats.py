"""URL filter, HTML wrappers and chat repair."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connect
from girolens.llm import catalog, chat, html_wrappers, url_filter

URLS = [
    None, "", "no scheme/en/", "http://", "HTTPS://WWW.Example.COM/en/a?x=/fr/#y", "http://example.com/en/", "http://m.example.com/en", "x://a.b.net/fr/",
    "http://net/es/?", "http://example.com?u=http://other.net/es/", "http://a.net#/es/", "a://b://c.com/", "http://host.com:80/", "http://éX.com/ü", "http://com",
    "http://x.com.\n/en/", "http://" + "a." * 60 + "com/" + "p/" * 3000,
]


def brute(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    rest = re.split("[?#]", rest)[0]
    host, slash, path = rest.partition("/")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in catalog.URL_RULES if (host == r[0] or host.endswith("." + r[0])) and (slash + path).startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, slash + path, best and best[0] + best[1], best[2] if best else "allow"


@pytest.mark.parametrize("few", [True, False])
def test_url_filter(spark, few):
    pages = spark.createDataFrame([(i // 2, u, "mine") for i, u in enumerate(u for u in URLS for _ in range(2))], "page_id long, url string, best string")
    rules = spark.createDataFrame([*catalog.URL_RULES, (None, "/", "block"), ("com", "/", "allow")], "host string, path string, verdict string")
    got = url_filter.judge(pages, rules, broadcast_rules=100 if few else 0)
    assert sorted(map(str, (tuple(r) for r in got.select("url", "host", "path", "rule", "verdict", ).collect()))) == sorted(str((u, *brute(u))) for u in URLS for _ in range(2))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert url_filter.judge(pages.limit(0), rules).count() == 0 and url_filter.judge(pages, rules.limit(0)).where("verdict = 'block'").count() == 0


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_sql(spark, folder, name):
    con = connect(folder)
    import __spark_entry__ as entry

    assert name in entry.queries() and compare(spark, con, folder, name) is None


def page(body: str, n: int) -> str:
    return (f"<!DOCTYPE html><html><head><title>T{n}</title><style>p{{}}</style><script>var t='<p>no</p>';</script></head><body><header>Site</header>"
            f"<nav><ul><li><a href='/{n}'>Menu {n}</a></li><li>More</li></ul></nav><div class='cookie-notice'>We use cookies</div><p>Welcome to our site</p>"
            f"{body}<aside>Side {n}</aside><section class='comments'><p>Reader says {n}</p></section><form>Name <input></form><footer>&copy; us</footer></body></html>")


def test_main_text(spark):
    articles = [f"<article><h1>Title &amp; {n}</h1><p>First\n  <b>block</b> {n}<br>line<p>Second &#8364; {n}</p><ul><li>one</ul></article>" for n in range(4)]
    rows = [(n, f"http://A.example.com/{n}", page(a, n)) for n, a in enumerate(articles)]
    plain = [f"<div id='wrap'><p>Long story {n} goes on and on.</p><p>And it ends {n} here.</p></div>" for n in range(4)]
    rows += [(10 + n, f"http://b.example.com/{n}", page(a, n)) for n, a in enumerate(plain)]
    rows += [(20, None, None), (21, "http://a.example.com/cut", page(articles[0], 9)[:-160]), (22, "x", ""), (0, "http://A.example.com/0", rows[0][2])]
    pages = spark.createDataFrame([(*r, "mine") for r in rows], "page_id long, url string, html string, wrapper string")
    got = [tuple(r) for r in html_wrappers.main_text(pages).select("page_id", "text", "n_chars").collect()]
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    texts = {}
    for i, text, _ in got:
        assert texts.setdefault(i, text) == text
    for n in range(4):
        assert texts[n] == f"Title & {n}\nFirst block {n} line\nSecond € {n}\none"
        assert texts[10 + n] == f"Long story {n} goes on and on.\nAnd it ends {n} here."
    assert texts[20] == texts[22] == "" and texts[21].startswith("Title & 0\n")
    assert html_wrappers.main_text(pages.limit(0)).count() == 0


def test_wrappers_repeat_and_align():
    a = html_wrappers.wrapper("<ul><li>x</li><li>y</li><li>z</li></ul><p>A</p>")
    b = html_wrappers.wrapper("<ul><li>x</li></ul><hr><p>B</p>")
    assert [html_wrappers._shape(n) for n in a][1].startswith("(li")
    both = html_wrappers.align(a, b)
    slots = list(html_wrappers._slots(both))
    assert any(t is None for p, t, *_ in slots if p == "p") and any(n[0] == "hr" and n[1] for n in both)


def test_template_slots_are_whole_texts_of_different_pages(spark):
    """Slots that begin alike and go on differently stay; copies of one page do not make its texts template text."""
    lead = "The same long lead stands in front of every text of this host. " * 5
    rows = [(n, f"http://lead.example/{n}", f"<body><div><h2>Site</h2><span>{lead}Then comes story {n}.</span></div></body>") for n in range(4)]
    rows += [(10 + n, f"http://copies.example/{n}", f"<body><nav>{n}</nav><h1>Only one</h1><p>page</p></body>") for n in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html_wrappers.main_text(pages).collect()}
    assert all(f"Then comes story {n}." in texts[n] and "Site" not in texts[n] for n in range(4))
    assert all(texts[10 + n] for n in range(5)), texts


def test_wrapper_decides_inside_of_articles(spark):
    """Template text inside of an article goes; a variable slot stays though a key word stands there."""
    def body(n):
        return (f"<body><nav>{n}</nav><article><h1>Title {n}</h1><div class='lead'>By our staff</div><div class='notice'>Note {n} on it</div>"
                f"<p>Story {n}</p><div class='share'>Tell others</div><div class='comments'>Reader {n}</div></article></body>")

    rows = [(n, f"http://many.example/{n}", body(n)) for n in range(9)] + [(20 + n, f"http://few.example/{n}", body(n)) for n in range(2)]
    rows += [(30 + n, f"http://same.example/{n}", body(1)) for n in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html_wrappers.main_text(pages).collect()}
    assert all(texts[n] == f"Title {n}\nNote {n} on it\nStory {n}" for n in range(9)), texts
    assert all(texts[k + n] == f"Title {m}\nBy our staff\nStory {m}" for k, n, m in [(20, 0, 0), (20, 1, 1), *((30, n, 1) for n in range(9))]), texts


@pytest.mark.parametrize("part", ["<h2 id='related-work'>Subject</h2>", "<h2 id='comment-on-results'>Subject</h2>", "<h2 id='comments'>Subject</h2>",
                                  "<p class='ad-hoc'>Subject</p>", "<section class='search-trees'>Subject</section>", "<div id='search'>Subject</div>"])
def test_subjects_are_no_parts_of_a_page(part):
    """Ids and classes that may tell a subject drop nothing inside of an article, names of parts do."""
    nothing = {"fixed": [], "kept": []}
    page = "<body><article><h1>Title</h1>{}<p>Story</p></article></body>"
    assert html_wrappers.extract(page.format(part), nothing) == "Title\nSubject\nStory"
    for attribute in ("id='comments'", "class='comment-list'", "class='ad-300x250 box'", "class='related-links'", "class='cookie-notice'", "role='search'"):
        assert html_wrappers.extract(page.format(f"<div {attribute}>Dropped</div>"), nothing) == "Title\nStory", attribute


def test_title_outside_of_the_text(spark):
    rows = [(n, f"http://plain.example/{n}", f"<body><p>Welcome</p><div class='top'><h1>Title {n}</h1></div><div class='text'><section><p>Long story {n}"
             f" goes on.</p><p>It ends {n} here.</p></section></div><div class='sidebar'><h1>Other {n}</h1></div></body>") for n in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html_wrappers.main_text(pages).collect()}
    assert texts == {n: f"Title {n}\nLong story {n} goes on.\nIt ends {n} here." for n in range(5)}


def test_partitions_and_long_pages(spark, folder):
    """The result does not depend on how pages are dealt; a very long page is read whole."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", F.lit("http://one.example/x").alias("url"), "html")
    body = "".join(f"<p>Line {k} of a long page</p>" for k in range(30_000))
    pages = pages.unionByName(spark.createDataFrame([(-1, "http://one.example/y", f"<body><article>{body}</article></body>")], pages.schema))
    found = [sorted(map(tuple, html_wrappers.main_text(pages.repartition(n)).collect())) for n in (1, 7, 53)]
    assert found[0] == found[1] == found[2]
    assert found[0][0][2] == "\n".join(f"Line {k} of a long page" for k in range(30_000))


@pytest.mark.parametrize("odd", [
    "<svg width='9'/>", "<math />", "<svg><style/><path d='x'/><title>Icon</title><g><text>no</text></g></svg>", "<video src='x'>", "<audio src='x'>",
    "<canvas>", "<object data='x'>", "<noscript>", "<noscript><p>no</p></noscript>", "<select><option>no<option>no", "<select><option>no</option></select>",
    "<object><object></div>no</object><p>no</p></object>", "<template></article><p>no</p></template>", "<div><video><p>no</div><video></video>",
])
def test_skipped_elements_end(odd):
    """What is left out ends with its element; without an end tag it does not take the rest of the page along."""
    nothing = {"fixed": [], "kept": []}
    before = html_wrappers.extract(f"<body>{odd}<article><h1>Title</h1><p>Story</p></article></body>", nothing)
    within = html_wrappers.extract(f"<body><article><h1>Title</h1>{odd}<p>Story</p></article></body>", nothing)
    assert before == within == "Title\nStory"
    assert html_wrappers.extract("<body><p>One <svg><path/></svg>two</p></body>", nothing) == "One two"


def test_pages_of_the_test_tables(spark, folder):
    """Every page of the small tables: the blocks of its article."""
    import html

    got = {r.page_id: r.text for r in catalog.op3_html_wrappers(spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)
        blocks = re.split(r"</?(?:p|h1)>", inner.group(1)) if inner else []
        want = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks]
        assert got[r.page_id] == "\n".join(w for w in want if w), r.page_id


def test_repair_costs_are_minimal():
    rnd = random.Random(1)
    for _ in range(150):
        roles = [rnd.choice(["system", "user", "assistant", " USER", "tool", None]) for _ in range(rnd.randint(1, 6))]
        known = {r: k + 1 for k, r in enumerate(chat.ROLES)}
        codes = np.array([known.get((r or "").strip().lower(), 0) for r in roles])
        assert int((chat.total(codes)[0] + chat._END).min()) == chat.cheapest(roles)


def test_repaired_conversations_are_legal(spark):
    long = [(7, i, ["user", "assistant", "system", "?"][i * i % 7 % 4], f"t{i}") for i in range(1500)]
    rows = [*long, (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 1, "user", "b"), (2, 0, "assistant", "x"), (3, 0, "system", None), (None, None, None, None),
            (4, 0, "system", "s"), (4, 1, "user", "<|im_end|>"), (4, 2, "assistant", "")]
    frame = spark.createDataFrame([(*r, "mine") for r in rows], "conv_id long, turn long, role string, text string, position string")
    got = chat.repair(frame).toPandas()
    assert len(got) == len(rows)
    total = 0
    for key, group in got.groupby("conv_id", dropna=False):
        group = group.sort_values("position")
        text = "".join(group["rendered"])
        turns = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", text, re.S)
        assert "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in turns) == text
        roles = [a for a, _ in turns if a != "system"]
        assert [a for a, _ in turns].count("system") <= 1 and roles and all(r == ("user", "assistant")[k % 2] for k, r in enumerate(roles))
        if key == 7:
            cost = {"keep": 0, "merge": 1, "relabel": 2, "relabel+merge": 3}
            total = sum(cost[a] - (r == "?" and "relabel" in a) + 3 * i for a, r, i in zip(group["action"], group["role"], group["inserted"], strict=True))
    codes = np.array([{"system": 1, "user": 2, "assistant": 3}.get(r[2], 0) for r in long])
    assert total == int((chat.total(codes)[0] + chat._END).min())
    assert chat.repair(frame.limit(0)).count() == 0


def test_every_query_reads_its_table(spark, folder):
    counts = {"op1_chat": "conversations", "op3_html_wrappers": "pages", "op8_url_filter": "pages"}
    for name, query in catalog.QUERIES.items():
        table = spark.read.parquet(f"{folder}/{counts.get(name, 'documents')}.parquet")
        assert query(spark, folder).agg(F.count("*")).first()[0] == table.count(), name
