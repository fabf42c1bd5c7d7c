"""Path templates: parts and rules against plain versions, the tree against its SQL on odd pages."""
import random
import re
from collections import Counter

import duckdb
import pandas as pd

from tidewater.llm import queries, url_templates as ut
from tidewater.plans.verify import rows_of


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def plain_rule(host, path):
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path)) if fits else None


def odd_pages():
    rng = random.Random(2)
    hosts = ["A.example.org", "b.example.ORG", "example.org", "x.com", "www.x.com", "shop.net", "orgy", "é.net", "x.com:80"]
    urls = [None, "", "no scheme", "http://", "http://org", "https://org/", "://?q", "a://b://c/d", "http://h/%7b|{}*/a",
            "http://h.net//a///b/", "http://h.net/" + "/".join(f"s{i}" for i in range(60)), "http://h.net/" + "x" * 3000]
    for _ in range(700):
        h = rng.choice(hosts)
        path = rng.choice(["/en/{}", "/es/{}", "/de/{}/", "/fr/{}.html", "/en/1{}", "/user/{w}", "/user/{w}/posts", "/tag/{w}/{}", ""])
        urls.append(f"http://{h}" + path.replace("{}", str(rng.randint(0, 900))).replace("{w}", "".join(
            rng.choice("abcdef") for _ in range(5))) + rng.choice(["", "", "?a=1", "#top"]))
    return [(i if i % 50 else None, u) for i, u in enumerate(urls)] + [(1, urls[40])] * 3


def test_tree_and_sql(spark):
    rows = odd_pages()
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows],
                               "page_id bigint, url string, host string, segs string, page string").repartition(4)
    out = ut.filter_urls(df, queries.URL_RULES)
    assert out.columns == ["page_id", "url", "segs", "page", "host", "path", "rule", "template", "share", "verdict"]
    got = [(r.page_id, r.host, r.path, r.rule, r.template, r.verdict) for r in out.collect()]
    con = duckdb.connect()
    con.register("pages", pd.DataFrame({"page_id": pd.array([r[0] for r in rows], dtype="Int64"), "url": [r[1] for r in rows]}))
    cur = con.execute(queries.URL_SQL)
    cols = [d[0] for d in cur.description]
    assert rows_of(["page_id", "host", "path", "rule", "template", "verdict"], got) == rows_of(cols, cur.fetchall())
    want = Counter()
    for i, u in rows:
        host, path = plain_parts(u)
        r = plain_rule(host, path)
        want[i, host, path, r and r.host + r.path, r and r.verdict] += 1
    assert Counter((i, h, p, r, v if r else None) for i, h, p, r, _, v in got) == want
    templates = {t for *_, t, _ in got}
    assert "/user/*/$" in templates and any(t.startswith("/{") for t in templates)
    assert {v for *_, r, _, v in got if r is None} == {"allow", "block"}


def test_purity(spark):
    """A template goes where its labels say so, also on hosts without labels; unlabelled siblings stay apart."""
    rows = [(f"h{h}.net", f"/{kind}/{k}", kind == "spam" if h < 5 else None) for h in range(6) for kind in ("spam", "news")
            for k in range(20)]
    known = ut.learn(spark.createDataFrame(rows, "host string, path string, blocked boolean"))
    got = {(r.host, r.template): r.share for r in known.collect()}
    assert set(t for _, t in got) == {"/spam/#/$", "/news/#/$", "/{news|spam}/#/$"}
    assert got["h1.net", "/spam/#/$"] > 0.9 and got["h1.net", "/news/#/$"] < 0.1
    assert abs(got["h5.net", "/{news|spam}/#/$"] - 0.5) < 0.01


def test_no_pages_no_labels(spark):
    df = spark.createDataFrame(odd_pages(), "page_id bigint, url string")
    assert ut.filter_urls(df.limit(0), queries.URL_RULES).count() == 0
    assert {r.verdict for r in ut.filter_urls(df, []).select("verdict").distinct().collect()} == {"allow"}


def test_native(spark):
    df = spark.createDataFrame(odd_pages(), "page_id bigint, url string")
    plan = ut.filter_urls(df, queries.URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
