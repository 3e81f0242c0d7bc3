"""Rules and the template tree against a plain reading of the rules."""

import re

from ledgerline.llm import url_filter as U

SCHEMA = "page_id bigint, url string, html string, host string, path string, n bigint"


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "", "x", "y", 1) for i, u in enumerate(urls)], SCHEMA)


def parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return "".join(c.lower() if c.isascii() else c for c in m[1]), m[2]


def ruled(host, path):
    best = None
    for what, h, p in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, what)
    return best or (None, None)


ODD = [None, "", "no scheme", "http://", "HTTP://Www.Example.ORG/es/1", "https://example.org/es",
       "http://example.org/en/1", "http://example.org/en/12?x#y", "http://notexample.org/es/x",
       "http://a.com/fr/x", "http://a.com/de/x", "http://com/de/", "http://a.com?q=/de/", "x://y#://b.org/",
       "http://ÀB.org/", "http://a.org", "http://a.net/" + "a/" * 3000, "http://a.net/1/2/3/4/5",
       "a\nb://c.org/x", "http://a.net/1/2/3/4/5"]


def test_rules_and_parts(spark):
    got = {r.page_id: r for r in U.url_filter(frame(spark, ODD)).collect()}
    assert len(got) == len(ODD)
    for i, url in enumerate(ODD):
        host, path = parts(url)
        rule, what = ruled(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == what if what else got[i].verdict in ("allow", "block")


def test_pages_rules(spark):
    from conftest import SF001
    rows = U.op1_url_filter(spark, SF001).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        host, path = parts(pages[r.page_id])
        rule, what = ruled(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if what:
            assert r.verdict == what


def test_tree_learns_templates(spark):
    """Blocked branches stay apart, alike ones merge, and unlabelled hosts lean on others."""
    urls = [f"http://h{h}.com/{lang}/{n}" for h in range(4) for lang in ("fr", "de") for n in range(30)]
    urls += [f"http://h.net/de/{n}" for n in range(5)] + [f"http://h.net/fr/{n}" for n in range(5)]
    urls += [f"http://z.net/{c * 3}/{n}" for c in "pqrst" for n in range(9)]
    got = {(r.host, r.path): r for r in U.url_filter(frame(spark, urls)).collect()}
    assert got["h.net", "/de/1"].verdict == "block" and got["h.net", "/fr/1"].verdict == "allow"
    assert got["h0.com", "/de/1"].template == "/de/<num>"
    assert {got["z.net", f"/{c * 3}/1"].template for c in "pqrst"} == {"/*/<num>"}


def test_empty_table_and_no_labels(spark):
    assert U.url_filter(frame(spark, [])).count() == 0
    rows = U.url_filter(frame(spark, ["http://a.net/x", None]), rules=[]).collect()
    assert {r.verdict for r in rows} == {"allow"} and {r.rule for r in rows} == {None}
