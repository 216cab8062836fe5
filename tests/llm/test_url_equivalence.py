"""URL decisions: rules, links that pass a block on, allow precedence, odd urls."""
from pasture.llm import url_equivalence as U

PAGES = [
    (1, "HTTP://Sub.Example.ORG/es/a", None, "org block"),
    (2, "https://example.org/en/1?x#y", None, None),
    (3, "https://other.org/en/1", None, None),
    (4, "https://a.com/fr/x", None, None),
    (5, "https://a.com/de/x", None, None),
    (6, "https://b.net/one", '<link href="https://a.com/de/x/" rel="canonical">', None),      # alias of a blocked page
    (7, "http://b.net/one/?utm_source=f#top", None, None),                                     # the same page as 6
    (8, "https://b.net/two", "<META http-equiv='refresh' content='0; URL=/one'>", None),       # alias of 6
    (9, "https://c.net/free", '<link rel=canonical href=https://a.com/de/z>', None),
    (10, "https://a.com/de/z", None, None),
    (11, "https://c.net/free?page=2", '<link rel="canonical" href="//c.net/free">', None),
    (12, "https://d.net/", '<link rel="canonical" href="https://a.com/de/q"><meta http-equiv="refresh" content="1;url=https://a.com/fr/ok">', None),
    (13, None, '<link rel="canonical" href="https://a.com/de/q">', None),
    (14, "no scheme", None, None), (15, "", None, None), (16, "https://xorg", None, None), (17, "https://org", None, None),
    (18, "https://org/", None, None), (5, "https://a.com/de/x", None, None), (None, "https://a.com/de/x", "", None),
    (19, "https://Ünï.com/de/ß", None, None), (20, "http://e.net/" + "p" * 100_000, "<p>" * 50_000, None),
    # relative references
    (21, "https://f.net/s/t", '<link rel="canonical" href="p">', None), (22, "https://f.net/s/p", '<link rel="canonical" href="https://a.com/de/1">', None),
    (23, "https://g.net/s/t", "<link rel=canonical href='../u/./v/..'>", None), (24, "https://g.net/u/", '<link rel="canonical" href="https://a.com/de/2">', None),
    (25, "https://h.net/s?q=2", '<meta http-equiv="refresh" content="0;url=?q=1">', None), (26, "https://h.net/s?q=1", '<link rel="canonical" href="https://a.com/de/3">', None),
    (27, "https://i.net", '<link rel="canonical" href="w">', None), (28, "https://i.net/w", '<link rel="canonical" href="https://a.com/de/4">', None),
    (29, "https://j.net/1", '<link rel="canonical" href="https://j.net/2"><link rel="canonical" href="https://a.com/de/5">', None),   # every link counts
    (30, "https://k.net/1", '<link rel="canonical" href="mailto:x@a.com"><link rel="canonical" href="#top">', None),
    (31, "https://k.net/2", '<meta http-equiv=refresh content="1; url=r?u=https://a.com/de/6">', None),                               # not absolute
    (32, "https://l.net/b/c", '<link rel="canonical" href="../../../de/x">', None), (33, "https://m.com/b/c", '<link rel="canonical" href="../../../de/x?a#b">', None),
    (34, "bare", '<link rel="canonical" href="w">', None),
]
WANT = {1: ("example.org/es/", "block"), 2: ("example.org/en/1", "block"), 3: ("org/", "allow"), 4: ("com/fr/", "allow"),
        5: ("com/de/", "block"), 6: (None, "block"), 7: (None, "block"), 8: (None, "block"), 9: (None, "block"),
        10: ("com/de/", "block"), 11: (None, "block"), 12: (None, "allow"), 13: (None, "allow"), 14: (None, "allow"),
        15: (None, "allow"), 16: (None, "allow"), 17: (None, "allow"), 18: ("org/", "allow"), 19: ("com/de/", "block"),
        20: (None, "allow"), **dict.fromkeys(range(21, 30), (None, "block")), **dict.fromkeys((30, 31, 32, 34), (None, "allow")),
        33: (None, "block"), None: ("com/de/", "block")}


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, x, "n") for i, u, h, x in rows], "page_id long, url string, html string, verdict string, node string")


def test_decisions(spark):
    got = U.decisions(frame(spark, PAGES)).collect()
    assert len(got) == len(PAGES)
    assert {r.page_id: (r.rule, r.verdict) for r in got} == WANT
    hosts = {r.page_id: (r.host, r.path) for r in got}
    assert hosts[1] == ("sub.example.org", "/es/a") and hosts[13] == hosts[14] == ("", "") and hosts[17] == ("org", "")
    assert hosts[19][0] == "Ünï.com"        # only A-Z is lower-cased


def test_sql_agrees(spark):
    import duckdb
    con = duckdb.connect()
    con.register("pages", frame(spark, PAGES).toPandas())
    want = con.execute(U.oracle_sql()).fetchall()
    key = lambda r: str(tuple(r))
    got = U.decisions(frame(spark, PAGES)).select("page_id", "host", "path", "rule", "verdict").collect()
    norm = lambda rows: sorted(((None if r[0] is None or r[0] != r[0] else int(r[0]), *r[1:]) for r in rows), key=key)
    assert norm(got) == norm(want)


def test_empty(spark):
    assert U.decisions(frame(spark, PAGES).limit(0)).collect() == []
    assert {r.verdict for r in U.decisions(frame(spark, PAGES[:6]), rules=()).collect()} == {"allow"}
