"""URL filters against plain Python, and against the DuckDB SQL on a web with links between hosts."""

import collections
import random
import re

import duckdb
import pytest

from quarry.llm import urls
from quarry.llm.oracles import ORACLES

LOWER = {c: c + 32 for c in range(65, 91)}


def split(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return host.translate(LOWER), path


def links_of(html):
    html = re.sub(urls.NO_LINKS, " ", html or "")
    out = set()
    for m in re.finditer(urls.LINK, html):
        target = re.match(urls.LINK_HOST, m.group(1))
        if target:
            out.add(target.group(1).translate(LOWER))
    return out - {""}


def brute(pages, rules=urls.RULES, rounds=urls.ROUNDS):
    rows = []
    for i, url, html in pages:
        host, path = split(url)
        fits = [(len(r), r.index("/"), -k, r, v) for k, (v, r) in enumerate(rules) if (h := r.split("/")[0]) and (host == h or host.endswith(f".{h}")) and path.startswith(r[len(h) :])]
        _, _, _, rule, verdict = max(fits, default=(0, 0, 0, None, None))
        rows.append((i, host, path, rule, verdict, html))
    count = collections.defaultdict(collections.Counter)
    edges = collections.Counter()
    for _, host, _, _, verdict, html in rows:
        if host:
            count[host][verdict] += 1
            edges.update((host, to) for to in links_of(html) - {host})
    score = []
    for verdict, along in (("allow", edges.items()), ("block", [((b, a), n) for (a, b), n in edges.items()])):
        seeds = [h for h, c in count.items() if 2 * c[verdict] > sum(c.values())]
        out = collections.Counter()
        for (a, _), n in along:
            out[a] += n
        now = {h: urls.UNITS // len(seeds) for h in seeds}
        total = collections.Counter(now)
        for _ in range(rounds):
            moved = collections.Counter()
            for (a, b), n in along:
                moved[b] += now.get(a, 0) * urls.DAMPING // 100 * n // out[a]
            now = {h: x for h, x in moved.items() if x}
            total.update(now)
        score.append(total)
    all_ = [max(1, sum(s.values())) for s in score]
    out = []
    for i, host, path, rule, verdict, _ in rows:
        trust, distrust = (s[host] if host else 0 for s in score)
        blocked = distrust * len(count) >= urls.LIFT * all_[1] and distrust * all_[0] > trust * all_[1]
        out.append((i, host, path, rule, verdict or ("block" if blocked else "allow"), trust, distrust))
    return out


def web():
    r = random.Random(4)
    hosts = [f"{a}.example.{z}" for a in ("a", "b", "c", "d", "e") for z in ("com", "net", "org")] + ["hub.test", "farm.test", "lone.test"]
    pages = []
    for i in range(400):
        own = "hub.test" if i % 3 == 0 else r.choice(hosts)
        to = [r.choice(hosts) for _ in range(r.randint(0, 4))] + (["B.example.net"] * 3 if own == "farm.test" else [])
        a = "".join(r.choice(['<a class="x" href="https://{}/p">t</a>', "<A HREF='//{}?q'>t</a>", "<a\thref = http://{}>t</a>", '<!-- <a href="http://{}">--> <script>"<a href=http://{}>"</script>']).format(t, t) for t in to)
        pages.append((i, f"http{'s' * (i % 2)}://{own.upper() if i % 5 == 0 else own}/{r.choice(['en', 'de', 'fr'])}/{i}{r.choice(['', '#x', '?u=http://y/z'])}", f'<a href="/en/">home</a><link href="http://z.test">{a}'))
    return pages + [
        (900, None, '<a href="http://a.example.com">'), (901, "", None), (902, "no scheme/net/", "<a href="), (903, "x://net", ""), (904, "x://NET/", "<a href=''>"), (905, "x://a.net?/", "<a href='http:///'>"),
        (906, "x://ex.net/a\nb", "<a title='>' href='http://a.example.com'>"), (907, "x:///en/", None), (908, "x://xexample.net/en/", None), (909, "x://example.net/en", None), (910, "x://İ.ORG/fr/", None),
        (None, "x://org/fr/1", None), (None, "x://org/fr/1", None), (7, "a://b://c.net/", "<a " * 20_000), (911, "x://" + "a." * 30_000 + "org/fr/", None),
    ]


def table(spark, pages):
    return spark.createDataFrame([(*p, "x", 1, None) for p in pages], "page_id long, url string, html string, host string, rule int, trust string").repartition(3)


def bag(rows):
    return collections.Counter(map(tuple, rows))


def test_judge(spark):
    pages = web()
    got = urls.judge(table(spark, pages), rounds=6)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "trust", "distrust"]
    want = brute(pages, rounds=6)
    assert bag(got.collect()) == bag(want)
    assert {x[4] for x in want if x[3] is None and x[5] and x[6]} == {"allow", "block"}


def test_the_sql_says_the_same_of_a_web_with_links(spark, tmp_path):
    pages = [p for p in web() if p[0] is None or p[0] != 911]
    table(spark, pages).select("page_id", "url", "html").write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages/*.parquet'")
    found = con.execute(ORACLES["op11_url_filter"]).fetchall()
    assert bag(found) == bag(urls.judge(spark.read.parquet(str(tmp_path / "pages"))).collect())


def test_trust_goes_along_the_links_and_distrust_against_them(spark):
    edges = spark.createDataFrame([("s", "a", 3), ("s", "b", 1), ("a", "c", 1)], "src string, dst string, pages long")
    seeds = spark.createDataFrame([(0, "s", 4000), (1, "c", 1000)], "side int, host string, amount long")
    got = {x.host: (x.trust, x.distrust) for x in urls.spread(edges, seeds).collect()}
    assert got == {"s": (4000, 722), "a": (2550, 850), "b": (850, 0), "c": (2167, 1000)}


def test_longest_rule_wins_and_bad_rules_are_refused(spark):
    pages = [(1, "x://a.b.c/d/e", None), (2, "x://b.c/d/", None), (3, "x://c/d/e/f", None)]
    rules = [("block", "c/"), ("allow", "b.c/d/"), ("block", "b.c/d/e"), ("allow", "c/d/e/f")]
    got = urls.judge(table(spark, pages), rules, rounds=2).collect()
    assert bag(got) == bag(brute(pages, rules, 2))
    assert {x.page_id: x.rule for x in got} == {1: "b.c/d/e", 2: "b.c/d/", 3: "c/d/e/f"}
    for bad in (("deny", "c/"), ("allow", "c"), ("allow", "/d/")):
        with pytest.raises(ValueError, match="no rule"):
            urls.judge(table(spark, pages), [bad])


def test_empty(spark):
    assert urls.judge(table(spark, [(1, "x://a/", "")]).limit(0)).count() == 0
    assert [x.verdict for x in urls.judge(table(spark, [(1, None, None)])).collect()] == ["allow"]
