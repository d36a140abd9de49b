import duckdb
import numpy as np
from hard_tables import SMALL

from lagline.llm import links
from lagline.llm.queries import QUERIES, URL_RULES, URL_SQL


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lowered, rest[:end]


def slow_rule(host, path):
    fits = [
        (len(h + p), h + p, verdict)
        for verdict, h, p in URL_RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "http://", "https://COM/x", "http://Example.com/en/1?u=http://a.net/es/",
    "http://www.example.com/en/", "http://www.example.com/en", "http://a.www.example.com/en/x#/fr/",
    "x://net/es/", "http://badnet/es/", "http://a.net/fr/?", "http://a.net?/fr/", "http://a.net#/fr/",
    "http://a.org:80/es/", "ftp://u@b.net/fr/x://y", "http://ÄB.com/\n/x", "http://example.com",
]


def test_urls_and_rules(spark):
    rows = [(i, u, None, "h") for i, u in enumerate(URLS)] + [(None, URLS[4], "<a>", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    found = links.judge(pages, "page_id", "url", "html", URL_RULES).collect()
    assert len(found) == len(rows)
    for row in found:
        host, path = slow_parts(URLS[row.page_id] if row.page_id is not None else URLS[4])
        rule, verdict = slow_rule(host, path)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if rule else row.verdict in ("allow", "block")


def slow_spread(edges, seeds):
    """Ranks from linear equations; what reaches a host without links goes back to the seeds."""
    hosts = sorted({h for a, b, _ in edges for h in (a, b)} | set(seeds))
    at = {h: i for i, h in enumerate(hosts)}
    moves = np.zeros((len(hosts), len(hosts)))
    for source, target, n in edges:
        moves[at[target], at[source]] += n
    start = np.array([seeds.get(h, 0.0) for h in hosts])
    start /= start.sum()
    sums = moves.sum(axis=0)
    moves = np.where(sums > 0, moves / np.maximum(sums, 1), start[:, None])
    ranks = np.linalg.solve(np.eye(len(hosts)) - links.DAMPING * moves, (1 - links.DAMPING) * start)
    return dict(zip(hosts, ranks.tolist(), strict=True))


def test_trust_and_distrust_follow_links(spark):
    def page(i, host, *targets):
        html = " ".join(f"<A HREF='//{t}/x'>" for t in targets) + "<a href=/local>"
        return (i, f"http://{host}/", html)

    pages = [
        page(1, "good.com", "friend.org", "friend.org", "other.org"),
        page(2, "friend.org", "HTTPS.org"),
        page(3, "farm.org", "spam.net", "spam.net"),
        (4, "http://spam.net/es/1", '<a href="https://farm.org/?q">x</a><a href="http:">'),
        page(5, "feeder.org", "farm.org", "feeder.org"),
        page(6, "alone.org"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r for r in links.judge(frame, "page_id", "url", "html", URL_RULES).collect()}
    verdicts = {i: r.verdict for i, r in found.items()}
    assert verdicts == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "block", 6: "allow"}
    edges = [
        ("good.com", "friend.org", 2), ("good.com", "other.org", 1), ("friend.org", "https.org", 1),
        ("farm.org", "spam.net", 2), ("spam.net", "farm.org", 1), ("feeder.org", "farm.org", 1),
    ]
    table = spark.createDataFrame(edges, "source string, target string, links long")
    seeds = [("good.com", 1.0, 0.0), ("spam.net", 0.0, 1.0)]
    ranks = links.spread(table, spark.createDataFrame(seeds, "host string, trust double, distrust double"))
    made = {r.host: (r.trust, r.distrust) for r in ranks.collect()}
    trust = slow_spread(edges, {"good.com": 1.0})
    distrust = slow_spread([(b, a, n) for a, b, n in edges], {"spam.net": 1.0})
    for host in set(trust) | set(distrust):
        assert abs(made[host][0] - trust.get(host, 0)) < 1e-8
        assert abs(made[host][1] - distrust.get(host, 0)) < 1e-8


def linked_pages(seed, hosts=40, count=300):
    """Pages of hosts under all kinds of rules that link to each other at random."""
    draw = np.random.default_rng(seed)
    names = [f"h{i}.{('com', 'net', 'org', 'org')[i % 4]}" for i in range(hosts)]
    pages = []
    for i in range(count):
        own, linked = draw.choice(names), draw.choice(names, draw.integers(0, 3))
        url = f"http://{own}{draw.choice(['/', '/en/', '/es/1', '/fr/2', '/es/'])}"
        pages.append((i, url, " ".join(f'<a href="//{t}/">' for t in linked)))
    return pages


def test_linked_pages_against_sums_over_walks(spark):
    frame = spark.createDataFrame(linked_pages(7), "page_id long, url string, html string")
    found = links.judge(frame, "page_id", "url", "html", URL_RULES)
    with duckdb.connect() as db:
        db.register("pages", frame.toPandas())
        expected = db.sql(URL_SQL).fetchall()
    key = lambda row: row[0]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)
    without = [row for row in expected if row[3] is None]
    assert {row[4] for row in without} == {"allow", "block"}


def test_distrust_reaches_far_hosts(spark):
    """A chain of 40 hosts that leads to a blocked one."""
    rows = [(i, f"http://h{i}.org/", f'<a href="//h{i + 1}.org/">') for i in range(40)]
    rows.append((40, "http://h40.org/", '<a href="//bad.net/">'))
    rows.append((41, "http://bad.net/es/", ""))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = links.judge(frame, "page_id", "url", "html", URL_RULES).collect()
    assert {r.verdict for r in found} == {"block"}


def test_a_few_blocked_pages_distrust_those_that_link_but_not_the_host(spark):
    rows = [(i, f"http://mixed.net/{'es' if i == 0 else 'ok'}/{i}", "") for i in range(10)]
    rows.append((10, "http://feeder.org/", '<a href="//mixed.net/es/">'))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    rows = links.judge(frame, "page_id", "url", "html", URL_RULES).collect()
    found = {r.page_id: r.verdict for r in rows}
    assert found == {0: "block", 10: "block"} | dict.fromkeys(range(1, 10), "allow")


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert links.judge(pages, "page_id", "url", "html", URL_RULES).collect() == []


def test_query(spark):
    rows = QUERIES["op10_url_trust"](spark, SMALL).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(rows) == len(urls)
    for row in rows:
        host, path = slow_parts(urls[row.page_id])
        rule, verdict = slow_rule(host, path)
        # No page of these links to another host, so nothing else is blocked.
        assert tuple(row) == (row.page_id, host, path, rule, verdict or "allow")


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op10_url_trust"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
