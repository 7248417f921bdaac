"""Registered corpus queries against SQL, URL groups, and the pipeline stage by stage."""

import re
from collections import Counter

import duckdb
import pytest
from compare import connect, differences

import corpus_pipeline
from __spark_entry__ import queries
from thermolens.llm import lines, urls
from thermolens.llm.checks import CHECKS
from thermolens.llm.queries import QUERIES, URL_RULES


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, folder, name):
    ours = QUERIES[name](spark, folder).toPandas()
    assert differences(ours, connect(folder).execute(CHECKS[name]).df()) is None


def canonical(url):
    return f'<LINK rel="canonical" href="{url}">'


PAGES = [
    (1, "http://a.example.net/es/x", canonical("http://b.org/home")),      # blocked by rule
    (2, "http://b.org/home", None),                                        # alias of 1
    (3, "http://c.org/?q=1#top", '<meta http-equiv="refresh" content="0; url=http://b.org/home">'),
    (4, "http://d.org/dir/page", canonical("../odd")),
    (5, "http://e.org", canonical("//blocked.net/fr/1")),                  # target is no page
    (6, "http://f.com/x", canonical("http://g.org/")),                     # allowed by rule
    (7, "http://g.org", canonical("http://h.net/es/")),                    # alias of both
    (8, "http://h.net/es/", ""),
    (9, "HTTP://WWW.Example.COM/en/1", "<p>"),
    (10, "http://example.com/en/1?x", "<p>"),
    (11, "http://net/es/a", None), (12, "http://internet/es/a", None),
    (13, None, canonical("http://b.org/home")), (14, "no scheme/en/", canonical("/x")),
    (15, "http://x.example.com#/en/", None), (16, "", ""), (2, "http://b.org/home", None),
    (17, "http://i.org/s/", canonical("t")), (18, "http://i.org/s/t", canonical("http://j.net/fr/")),
]


def test_aliases_share_decisions_but_an_allow_comes_first(spark, tmp_path):
    pages = spark.createDataFrame(
        [(*p, "n", "v", "r") for p in PAGES],
        "page_id long, url string, html string, node string, verdict string, rule string")
    path = str(tmp_path / "pages.parquet")
    pages.write.parquet(path)
    found = urls.judge(spark.read.parquet(path), URL_RULES).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    assert differences(found, con.execute(CHECKS["op5_url_filters"]).df()) is None
    verdict = dict(zip(found.page_id, found.verdict))
    assert {i for i, v in verdict.items() if v == "block"} == {1, 2, 3, 5, 8, 10, 11, 17, 18}
    assert urls.judge(pages.limit(0), URL_RULES).count() == 0


def refresh(content):
    return f"<meta http-equiv='refresh' content={content}>"


#: url and html of a page; True if its link leads to a blocked url, told by hand.
FORMS = [
    ("http://a1.org/", refresh("\"0; url='http://b.net/es/1'\""), True),
    ("http://a2.org/", refresh("'0;URL=\"http://b.net/es/2\"'"), True),
    ("http://a3.org/", refresh("0;url='http://b.net/es/3'"), True),
    ("http://a4.org/", refresh('"0; url=&quot;http://b.net/es/4&quot;"'), True),
    ("http://a5.org/", refresh('"0; url=http://b.net/es/5"'), True),
    ("http://a6.org/", refresh('"30"'), False),
    # an alias of a page that is blocked through its own link
    ("http://c1.org/?a=1&b=2", canonical("http://b.net/fr/1"), True),
    ("http://c2.org/", canonical("http://c1.org/?a=1&amp;b=2"), True),
    ("http://c3.org/", canonical("http://c1.org/?a=1&#38;b=2"), True),
    ("http://c4.org/", canonical("http:&#x2F;&#x2f;c1.org/?a=1&b=2"), True),
    ("http://c5.org/?a=1&copy=2&reg=3", canonical("http://b.net/fr/2"), True),
    ("http://c6.org/", canonical("http://c5.org/?a=1&copy=2&amp;reg=3"), True),
    ("http://c7.org/", canonical("http://c1.org/?a=1&amp;amp;b=2"), False),
    ("http://d.net/a/b/page", canonical("../../es/1"), True),
    ("http://d.org/a/b/page", canonical("http://b.net/fr/3"), True),
    ("http://d.org/a/c/page", canonical(".././b/page"), True),
    ("http://d.org/x", canonical("/a/q/./../b/page"), True),
    ("http://d.org/y", canonical("../../a/b/page"), True),
    ("http://d.org/a/b/z", canonical("../b/"), False),
    ("http://d1.org/a/b/", canonical("http://b.net/fr/4"), True),
    ("http://d1.org/a/b/z", canonical("."), True),
    ("http://d1.org/a/b/c/z", canonical(".."), True),
    ("http://d2.org/a/../b", canonical("http://b.net/fr/5"), True),
    ("http://d3.org/", canonical("http://d2.org/a/../b"), True),
    ("http://d4.org/", canonical("//d2.org/b"), True),
    ("http://e.org/list.html?x=1", canonical("http://b.net/fr/6"), True),
    ("http://e.org/list.html?x=2", canonical("?x=1"), True),
    ("http://e.org/list.html?x=3", canonical("?u=http://b.net/fr/"), False),
    ("http://e.org/other.html", canonical("?x=1"), False),
    ("http://e1.org/p?x=1", canonical("http://b.net/fr/7") + canonical("#top"), True),
    ("http://e1.org/p", canonical("#top"), False),
    ("http://f.org/o'x", canonical("http://b.net/fr/8"), True),
    ("http://f1.org/", canonical("http://f.org/o'x"), True),
    ("http://f2.org/", canonical("mailto:a@b.net"), False),
    ("http://g1.org/", "<link rel='shortlink canonical' href='http://b.net/es/g1'>", True),
    ("http://g2.org/", refresh('"0; http://b.net/es/g2"'), True),
    ("http://g3.org/", refresh("'5,http://b.net/es/g3'"), True),
    ("http://g4.org/", '<link title="a > b" rel=canonical href="http://b.net/es/g4">', True),
    ("http://g5.org/", "<!-- " + canonical("http://b.net/es/g5") + " -->", False),
    ("http://g6.org/", "<script>x = '" + canonical("http://b.net/es/g6") + "';</script>", False),
    ("http://g7.org/", "<link data-rel='canonical' href='http://b.net/es/g7'>", False),
    ("http://g8.org/", "<base href='http://b.net/es/'>" + canonical("g8"), True),
    ("http://g9.org/x/y", canonical("../es/g9") + "<base href='http://b.net/a/b'>", True),
    ("http://h1.org:80/p", canonical("http://b.net/fr/h1"), True),
    ("http://h2.org/", canonical("http://h1.org/p"), True),
    ("https://h3.org:443/", canonical("http://b.net/fr/h3"), True),
    ("http://h4.org/", canonical("https://h3.org"), True),
    ("http://h5.org/", canonical("http://h1.org:8080/p"), False),
    ("http://h7.org/", "<linker rel=canonical href='http://b.net/es/h7'>", False),
    ("http://h8.org/", "<!-- a --><LINK\nREL=Canonical\nHREF=http://b.net/es/h8 />", True),
    ("http://h9.org/", "<meta name=refresh content='0; url=http://b.net/es/h9'>", False),
]

#: A star and a long chain of pages, all of which lead to a blocked page in the end.
STAR = [(f"http://star{i}.org/", canonical("http://hub.org/"), True) for i in range(300)]
CHAIN = [(f"http://chain.org/{i}", canonical(f"http://chain.org/{i + 1}"), True)
         for i in range(200)]
FORMS += STAR + CHAIN + [("http://hub.org/", canonical("http://chain.org/7"), True),
                         ("http://chain.org/200", canonical("http://b.net/es/end"), True)]


def test_every_form_of_link_makes_an_alias(spark):
    pages = spark.createDataFrame([(i, url, html) for i, (url, html, _) in enumerate(FORMS)],
                                  "page_id long, url string, html string")
    told = {r.page_id: r.verdict for r in urls.judge(pages, URL_RULES).collect()}
    assert {FORMS[i][0]: v for i, v in told.items()} == {
        url: "block" if blocked else "allow" for url, _, blocked in FORMS}


def test_lines_common_to_a_host_go(spark, tmp_path):
    rows = [(i, f"http://A.org/{i}", f"<p>Menu</p><style>x</style><p>own {i}</p><b> Menu </b>"
             + ("<i>some</i>" if i < 3 else ""), "h", "l") for i in range(10)]
    rows += [(20 + i, f"http://b.org/{i}", "<p>Menu</p>", "h", "l") for i in range(4)]
    rows += [(30, None, "<p>Menu", "h", "l"), (31, "http://a.org/x", None, "h", "l"),
             (32, "http://a.org/y", "", "h", "l"), (0, *rows[0][1:])]
    path = str(tmp_path / "pages.parquet")
    spark.createDataFrame(rows, "page_id long, url string, html string, host string, lines string") \
        .write.parquet(path)
    pages = spark.read.parquet(path)
    found = Counter(tuple(r) for r in lines.drop_boilerplate(pages).collect())
    expected = Counter()
    for i, url, html, *_ in rows:
        host = (url or "://").split("://")[1].split("/")[0].lower()
        own = [x.strip() for x in re.split("<style>.*?</style>|<[^>]*>", html or "") if x.strip()]
        # 13 pages of a.org: 11 hold the menu, 4 the line "some" (over 0.3 of 13)
        left = [x for x in own if not (host == "a.org" and x in ("Menu", "some"))]
        expected[i, host, len(own), len(own) - len(left), "\n".join(left)] += 1
    assert found == expected
    assert lines.drop_boilerplate(pages.limit(0)).count() == 0


def test_lines_are_trimmed_of_tabs_and_carriage_returns(spark):
    ends = ("Menu\n", "\tMenu\r\n", "Menu\r\n\t\r\n", " \t Menu\x0b\x0c\n")
    pages = spark.createDataFrame(
        [(i, f"http://a.org/{i}", f"<p>{ends[i] if i < 4 else ''}own {i}\r\n") for i in range(10)],
        "page_id long, url string, html string")
    found = {tuple(r) for r in lines.drop_boilerplate(pages).collect()}
    assert found == {(i, "a.org", 1 + (i < 4), int(i < 4), f"own {i}") for i in range(10)}


def test_all_queries_are_registered():
    numbers = Counter(re.match(r"op(\d+)_", n)[1] for n in QUERIES)
    assert numbers == Counter(map(str, range(1, 14)))
    assert set(queries()) >= {*QUERIES, "pipeline"}


def test_pipeline_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settle(stage(spark, docs, folder), "stage")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4] > 0.5 * sizes[0]
    texts = [r.text for r in docs.collect()]
    seen = Counter(w for t in texts for w in {t[i:i + 250] for i in range(len(t) - 249)})
    assert max(seen.values()) == 1
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(whole.drop("sequence_id", "offset").collect(), key=str) == sorted(
        pieces.drop("sequence_id", "offset").collect(), key=str)


def test_pipeline_bears_odd_documents(spark, docs, rows, folder):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, folder)
        assert left.columns == docs.columns and 0 < left.count() <= len(rows)
        assert stage(spark, corpus_pipeline.settle(docs.limit(0), "none"), folder).count() == 0
