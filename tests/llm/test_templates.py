import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import templates
from panelkit.llm.markup import Page
from panelkit.llm.templates import candidate_classes, check_order, count_vectors, main_text, page_tokens
from panelkit.llm.textops import Hasher
from tests.llm.conftest import prose

SCHEMA = "page_id long, url string, html string"


def page(host, k, article, notice="", extra=""):
    """A page of a host with menus, adverts, forms, comments and a footer around its article."""
    links = "".join(f'<li><a href="/{k}/{i}">item {k} {i}</a></li>' for i in range(3 + k % 3))
    body = "".join(f"<p>{p}</p>" for p in article)
    return (k, f"https://{host}/p/{k}", f"""<!DOCTYPE html><html><head><title>t {k}</title><style>p{{}}</style>
        <script>var x = "</p>" < 1;</script></head><body class="single-post sidebar-right"><header><h1>Site</h1></header>
        <nav><ul>{links}</ul></nav><div class="ad-box ad">buy {k}</div><article><h1>Title {k}</h1>{body}{notice}
        <section id="comments"><p>reader {k} says</p></section></article><aside><p>see also {k}</p></aside>
        <form><label>Name</label><input name=a></form>{extra}<footer>&copy; {host} {k}</footer></body></html>""")


def texts(df, **kw):
    return {r.page_id: r.text for r in main_text(df, **kw).collect()}


def table(spark, rows, extra=""):
    return spark.createDataFrame(rows, SCHEMA + extra).repartition(3)


def test_article_of_every_page(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for k in range(60):
        host = rng.choice(["a.example", "a.example", "b.example", "c.example"])
        article = [prose(rng, rng.randrange(1, 40)) for _ in range(rng.randrange(1, 6))]
        rows.append(page(host, k, article, "<p>Please <b>share</b> this article with friends</p>"))
        want[k] = "\n".join([f"Title {k}", *article, "Please share this article with friends"])
    got = texts(table(spark, rows))
    size = {h: sum(r[1].split("/")[2] == h for r in rows) for h in ("a.example", "b.example", "c.example")}
    for k, r in enumerate(rows):
        with_notice = want[k]
        without = with_notice.rsplit("\n", 1)[0]
        assert size[r[1].split("/")[2]] >= 4
        # the notice is the same on all pages of the host: template text; it goes where it is small beside the article
        assert got[k] in (with_notice, without)
        if len(without.split()) - 1 >= 4 * 6:
            assert got[k] == without, k
        if len(without.split()) < 4 * 6:
            assert got[k] == with_notice, k


def test_copies_of_an_article_stay(spark):
    article = ["one two three four five six", "seven eight nine ten", "eleven"]
    rows = [page("copies.example", k, article) for k in range(12)]
    got = texts(table(spark, rows))
    assert all(got[k] == "\n".join([f"Title {k}", *article]) for k in range(12))


def test_pages_without_article_lose_template_and_link_lists(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for k in range(9):
        body = [prose(rng, 12) for _ in range(3)]
        links = "".join(f"<li><a href=/{i}>other story {rng.random()}</a>" for i in range(4))
        rows.append((k, f"http://d.example/{k}", f"<body><div class=x1>We set small files on your disk</div><div><h2>Head {k}</h2>"
                     f"{''.join(f'<p>{b}' for b in body)}</div><div class=x2><ul>{links}</ul></div><div>Call us now</div>"))
        want[k] = "\n".join([f"Head {k}", *body])
    assert texts(table(spark, rows)) == want


def test_small_hosts_and_broken_pages(spark):
    rows = [(1, "http://one.example/", "<p>a &amp; b&#33;<p>c<br>d  \n e<div>f</div>g<b>h</b>i"), (2, None, None), (3, "", ""),
            (4, "no url", "plain < text > here"), (5, "http://x.example", "<script>only code"), (6, "http://x.example/2", "<article><p>cut of"),
            (7, "http://x.example/3", "<table><tr><td>1<td>2<tr><td>3</table><ul><li>x<li>y</ul>"),
            (8, "http://x.example/4", "<article><header><h1>T</h1></header><p>one<span class=share>s</span>two<p>1 &lt; 2 &amp"),
            (9, "http://x.example/5", "<p title=it's>q</p><a title=\"a>b\">r</a> <!-- no --> s <!-->t"),
            (None, None, "<p>w"), (10, "http://y.example", "<main><p>m</p></main><p>out"), (11, "http://y.example", "<nav>only menu</nav>")]
    got = texts(table(spark, rows))
    assert got == {1: "a & b!\nc d e\nf\nghi", 2: "", 3: "", 4: "plain < text > here", 5: "", 6: "cut of", 7: "1\n2\n3\nx\ny",
                   8: "T\none two\n1 < 2 &", 9: "q\nr s t", None: "w", 10: "m", 11: ""}
    n = {r.page_id: r.n_chars for r in main_text(table(spark, [(1, "u", "<p>é😀 x")])).collect()}
    assert n == {1: 4}


def test_large_hosts_in_parts_repeated_rows_and_clashing_columns(spark):
    rng = random.Random(3)
    rows = [(*page(rng.choice(["hot.example"] * 5 + ["z.example"]), k, [prose(rng, 30) for _ in range(3)], "<p>Sign up today</p>"), 1, "x")
            for k in range(40)]
    rows += rows[:5]
    df = table(spark, rows, ", host long, salt string")
    whole = sorted(tuple(r) for r in main_text(df).collect())
    assert len(whole) == 45 and sorted(tuple(r) for r in main_text(df, split=9).collect()) == whole
    # templates shuffled instead of sent to every task
    assert sorted(tuple(r) for r in main_text(df, split=9, broadcast_entries=0).collect()) == whole
    assert all("Sign up" not in r[2] and r[2].startswith(f"Title {r[0]}\n") for r in whole)
    assert main_text(df).columns == ["page_id", "url", "text", "n_chars"]
    assert main_text(df.limit(0)).count() == 0


def test_a_very_long_page(spark):
    long = "<article>" + "".join(f"<p>{k} &amp; words</p>" for k in range(60_000)) + "<div>" * 5000 + "end"
    r = main_text(table(spark, [(1, "http://l.example", long), (2, "http://l.example", "<p>s")])).collect()
    got = {x.page_id: x.text for x in r}
    assert got[1].count("\n") == 60_000 and got[1].endswith("\nend") and got[2] == "s"


@pytest.mark.parametrize("salts", [1, 3])
def test_classes_are_those_of_occurrence_vectors(spark, salts):
    rng = random.Random(4)
    rows = [page(f"{h}.example", 10 * i + k, [prose(rng, 20, 30) for _ in range(2)]) for i, h in enumerate("pq") for k in range(9)]
    vectors, pages = defaultdict(dict), defaultdict(set)
    for k, url, html in rows:
        host = url.split("/")[2]
        pages[host, k % salts].add(k)
        tokens = page_tokens([Page(html, {}).items], Hasher(False))[0][0]
        for t, c in zip(*(x.tolist() for x in np.unique(tokens, return_counts=True))):
            vectors[host, t][k] = c
    want = defaultdict(set)
    for (host, t), v in vectors.items():
        if len(v) >= 4 and all(2 * len(own & set(v)) >= len(own) for (h, _), own in pages.items() if h == host):
            want[host, tuple(sorted(v.items()))].add(t)
    want = sorted((h, tuple(sorted(t))) for (h, _), t in want.items() if len(t) >= 3)
    df = table(spark, rows).select(F.regexp_extract("url", "//([^/]*)", 1).alias("host"), (F.col("page_id") % salts).alias("salt"),
                                   F.xxhash64("html").alias("key"), "html")
    df = df.repartition("host", "salt").sortWithinPartitions("host", "salt")
    got = defaultdict(set)
    for r in candidate_classes(count_vectors(df, 4), 4, 3).collect():
        for x in r.template:
            got[r.host, x["class"]].add(x.token)
    assert sorted((h, tuple(sorted(t))) for (h, _), t in got.items()) == want and len(want) >= 2


@pytest.mark.parametrize("seq, valid", [
    ("abcabc", {"A": True}), ("abcacb", {"A": False}), ("axyzbc", {"A": True, "X": True}), ("axbyzc", {"A": True, "X": False}),
    ("xyzabc", {"A": True, "X": True}), ("axyzbcaxyzbc", {"A": True, "X": True})])
def test_ordered_and_nested(seq, valid):
    cls = {**dict.fromkeys("abc", 0), **dict.fromkeys("xyz", 1)}
    got = check_order(np.array([cls[c] for c in seq]), np.array([ord(c) for c in seq]), {0: 3, 1: 3})
    assert {"AX"[c]: ok for c, _, ok in got} == valid


def test_given_pages_keep_their_articles(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = texts(rows)
    for r in rows.collect():
        items = [i for i in Page(r.html, {}).items if i[1] and i[2] == 2]
        assert got[r.page_id] == "\n".join(i[1] for i in items) and items
    assert templates.SPLIT_HOSTS == 100_000
