"""Paths deeper than three segments."""

from ledgerline.llm import url_filter as U

DEEP = [("block", "h.com", "/2024/05/en/casino/"), ("allow", "h.com", "/2024/05/en/news/")]


def judge(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rows = U.url_filter(pages, rules=rules).collect()
    assert sorted(r.page_id for r in rows) == list(range(len(urls)))
    return {(r.host, r.path): r for r in rows}


def test_branches_at_level_four(spark):
    urls = [f"http://{h}/2024/05/en/{kind}/{n}" for h in ("h.com", "z.net")
            for kind in ("casino", "news") for n in range(30)]
    got = judge(spark, urls, DEEP)
    for h in ("h.com", "z.net"):
        assert got[h, "/2024/05/en/casino/7"].verdict == "block"
        assert got[h, "/2024/05/en/news/7"].verdict == "allow"
        assert got[h, "/2024/05/en/news/7"].template == "/<num>/<num>/en/news/<num>"


def test_children_count_below_level_three(spark):
    """Alike branches of level three and six merge, one with other children does not."""
    for stem in ("/a/b", "/a/b/c/d/e"):
        urls = [f"http://k.com{stem}/{c * 3}/{n}" for c in "pqrst" for n in range(9)]
        urls += [f"http://k.com{stem}/zzz/{c * 2}" for c in "uvwxy"]
        got = judge(spark, urls, [])
        assert {got["k.com", f"{stem}/{c * 3}/1"].template for c in "pqrst"} == {f"{stem}/*/<num>"}
        assert got["k.com", f"{stem}/zzz/uu"].template == f"{stem}/zzz/*"


def test_very_long_shared_paths(spark):
    stem = "/s" * 500
    urls = [f"http://k.com{stem}/{c}" for c in "pqr"] + [f"http://k.com{stem}"] + ["http://l.com/p" + stem]
    got = judge(spark, urls, [])
    assert got["k.com", f"{stem}/p"].template == f"{stem}/*" and got["k.com", stem].template == stem
    assert got["l.com", "/p" + stem].template == "/p" + stem
