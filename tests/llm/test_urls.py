import time

import duckdb
import pytest
from rankfold.llm import url_redirects

RULES = url_redirects.RULES


def head(kind, target):
    return {"canonical": f'<link rel="canonical" href="{target}">', "og": f"<meta property='og:url' content='{target}'>",
            "refresh": f'<META HTTP-EQUIV="refresh" content="0; url={target}">'}[kind]


ROWS = [
    (1, "https://www.shop.net/item/", None), (2, "http://shop.net/item?utm_source=x#top", ""), (3, "http://m.shop.net/item?page=2&ref=y", "<p>"),
    (4, "https://Sub.Example.ORG/es/a", ""), (5, "https://example.org/en/12?q", ""), (6, "https://example.org/en/2", ""), (7, "https://notexample.org/es/", ""),
    (8, "http://x.com/de/1", ""), (9, "http://x.com/fr/1", ""), (10, "https://x.com/it/1", ""), (11, "https://alias.io/a", head("canonical", "http://x.com/de/1")),
    (12, "https://alias.io/b", head("og", "//x.com/de/9")), (13, "https://alias.io/c", head("refresh", "https://alias.io/b")),
    (14, "https://both.io/a", head("canonical", "http://x.com/de/7") + head("og", "http://x.com/fr/7")),
    (15, "https://rel.io/a", head("canonical", "/b")), (16, "https://rel.io/b/", ""), (17, None, head("canonical", "http://x.com/de/1")), (18, "no scheme", None),
    (30, "https://www.rel.io/dir/a?x=1", head("canonical", "next.html")), (31, "http://rel.io/dir/next.html", ""),
    (32, "https://rel.io/dir/sub/b", head("og", "../c/./d?q#f")), (33, "https://rel.io/dir/c/d?q", ""),
    (34, "https://rel.io/e", head("refresh", "?p=2&amp;k=1")), (35, "https://rel.io/e?p=2&k=1", ""),
    (36, "https://rel.io/f", '<base href="/deep/er/"><link href=g rel="x canonical">'), (37, "https://rel.io/deep/er/g", ""),
    (38, "https://hid.io/a", "<!-- " + head("canonical", "http://x.com/de/1") + " -->"),
    (39, "https://hid.io/b", "<script>var s = '" + head("og", "http://x.com/de/1").replace("'", '"') + "';</script>"),
    (40, "https://hid.io/c", "<!-- open <!-- " + head("canonical", "http://x.com/de/1")),
    (41, "https://two.io/a", head("canonical", "/b") + head("canonical", "/c")), (42, "https://two.io/b", ""), (43, "https://two.io/c", ""),
    (44, "https://mail.io/a", head("canonical", "mailto:x@y.z") + head("og", "#top") + head("refresh", "")),
    (45, "https://inner.io/a", head("canonical", "/r?u=http://x.com/de/1")), (46, "https://inner.io/r?u=http://x.com/de/1", ""),
    (47, "https://num.io/a", head("canonical", "/n?a=1&#38;b=2")), (48, "https://num.io/n?a=1&#x26;b=2", ""), (49, "https://num.io/n?a=1&b=2", ""),
    (50, "https://up.io/a/b/", head("canonical", "..")), (51, "https://up.io/a/", ""),
    (19, "http://org", ""), (20, "a://b://c/d", ""), (21, "https://x.com/de", ""), (9, "http://x.com/fr/1", ""), (None, "http://x.com?x/de/", ""),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("rule", __import__("pyspark").sql.functions.lit("clash"))


def verdicts(spark, df):
    return url_redirects.url_filter(df, url_redirects.rules_from(spark, RULES)).collect()


def test_rules_hosts_and_aliases(spark, pages):
    rows = verdicts(spark, pages)
    assert len(rows) == len(ROWS)
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert by[4] == ("sub.example.org", "/es/a", "example.org/es/", "block") and by[5] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert by[6] == ("example.org", "/en/2", "org/", "allow") and by[7][2:] == ("org/", "allow")
    assert by[8][2:] == ("com/de/", "block") and by[9][2:] == ("com/fr/", "allow") and by[10][2:] == (None, "allow")
    assert by[11][2:] == by[12][2:] == by[13][2:] == (None, "block")  # aliases of blocked pages
    assert by[14][2:] == (None, "allow")  # an allowed alias outweighs a blocked one
    assert by[17] == by[18] == ("", "", None, "allow") and by[19] == ("org", "", None, "allow")
    assert by[20] == ("b:", "//c/d", None, "allow") and by[21][2:] == (None, "allow") and by[None][:2] == ("x.com", "")
    group = {r.page_id: r.alias_group for r in rows}
    assert group[1] == group[2] and group[3] not in (None, group[1]) or group[3] is None
    assert group[15] == group[16] and group[10] is None


def test_declared_addresses(spark, pages):
    group = {r.page_id: r.alias_group for r in verdicts(spark, pages)}
    for a, b in ((30, 31), (32, 33), (34, 35), (36, 37), (41, 42), (41, 43), (45, 46), (47, 49), (50, 51)):
        assert group[a] is not None and group[a] == group[b], (a, b)
    assert [group[i] for i in (38, 39, 40, 44)] == [None] * 4 and group[48] != group[47]


@pytest.mark.parametrize("part", ["<link rel=canonical ", "<meta property=og:url ", "<!-- canonical ", "<script>canonical", "<base href=", "href= "])
def test_a_megabyte_of_open_tags_is_quick(spark, part):
    html = "canonical" + part * (1_000_000 // len(part))
    df = spark.createDataFrame([("https://big.io/a", html + ">")], "url string, html string")
    started = time.time()
    url_redirects.declared(df).collect()
    assert time.time() - started < 10  # with the time of a Spark job; quadratic work would take minutes


def test_oracle_sql_agrees(spark, pages):
    con = duckdb.connect()
    frame = pages.drop("rule").toPandas().astype({"page_id": "Int64"})
    con.register("pages", frame)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    want = sorted(con.execute(url_redirects.ORACLE_SQL).fetchall(), key=key)
    got = sorted((tuple(r) for r in verdicts(spark, pages)), key=key)
    assert [tuple(map(str, r)) for r in got] == [tuple(map(str, r)) for r in want]


def test_shuffle_join_and_empty_tables(spark, pages, monkeypatch):
    a = sorted(map(str, verdicts(spark, pages)))
    monkeypatch.setattr(url_redirects, "BROADCAST_RULES", 0)
    assert a == sorted(map(str, verdicts(spark, pages)))
    assert verdicts(spark, pages.limit(0)) == []
    none = url_redirects.rules_from(spark, RULES).limit(0)
    assert {r.verdict for r in url_redirects.url_filter(pages, none).collect()} == {"allow"}
