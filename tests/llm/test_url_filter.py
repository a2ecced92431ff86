import math

from pyspark.sql import functions as F
from samples import make  # noqa: F401 (fixtures)

from conform.llm.url_filter import RULES, Reputation, domain_of, filter_urls, page_outcomes, site_of, suffix_of

PAGES = "page_id long, url string, html string"
URLS = ["http://example.net/en/1", "http://www.Example.NET/en", "https://a.net", "https://a.net/", "https://a.net?x/", "http://example.com/de/x", "http://xexample.com/de/x",
        "http://m.example.com/de/", "http://b.org/fr/#x", "http://org/fr/", "http://b.org/fr", "http://c.org/x?y#z", None, "", "nothing", "://", "a://b://c/d", "http://u:p@H.com:80/P#?",
        "http://ÉA.com/Ü", "http://x.net\n/en/", "x" * 10_000 + "://long.net/" + "y" * 10_000]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[n:]
    m = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n]), path[:m]


def rule_of(host, path, rules=RULES):
    fit = [(len(r), len(r.split("/")[0]), r, says) for says, r in rules
           if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[len(r.split("/")[0]):])]
    return max(fit)[2:] if fit else (None, None)


def test_parts_and_rules(make):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(None, URLS[0], None), (0, URLS[0], None)]
    got = filter_urls(make(rows, PAGES), make([], "host string, bad int")).collect()
    want = []
    for i, u, _ in rows:
        host, path = parse(u)
        rule, says = rule_of(host, path)
        want.append((i, host, path, rule, says or "allow"))
    assert sorted(map(str, ((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got))) == sorted(map(str, want))


def brute(counts, conf=Reputation()):
    """bound of every host from {host: (n, bad)}."""
    def merge(of, units):
        out = {}
        for u, (n, b) in units.items():
            m, c = out.get(of(u), (0, 0))
            out[of(u)] = m + n, c + b
        return out

    domain = lambda h: ".".join(h.split(".")[-2:])
    suffix = lambda d: d.split(".")[-1]             # noqa: E731
    ds = merge(domain, counts)
    ss = merge(suffix, ds)

    def strength(units):
        x = [(n, b) for n, b in units.values() if n]
        n, b = sum(a for a, _ in x), sum(c for _, c in x)
        p, k = b / n, len(x)
        room = n - sum(a * a for a, _ in x) / n - (k - 1)
        if p * (1 - p) <= 0 or room <= 0:
            return conf.max_strength
        rho = (sum(a * (c / a - p) ** 2 for a, c in x) - p * (1 - p) * (k - 1)) / (p * (1 - p) * room)
        return min(max((1 - rho) / rho, conf.min_strength), conf.max_strength) if rho > 0 else conf.max_strength

    total = sum(b for _, b in ss.values()) / sum(n for n, _ in ss.values())
    mh, md, ms = strength(counts), strength(ds), strength(ss)
    rs = {s: (ms * total + b) / (ms + n) for s, (n, b) in ss.items()}
    rd = {d: (md * rs[suffix(d)] + b) / (md + n) for d, (n, b) in ds.items()}
    rh = {h: (mh * rd[domain(h)] + b) / (mh + n) for h, (n, b) in counts.items()}
    return {h: r - conf.bound_z * math.sqrt(r * (1 - r) / (mh + counts[h][0] + 1)) for h, r in rh.items()}


def test_reputation(make):
    counts = {"spam.bad.com": (200, 190), "x.bad.com": (50, 45), "new.bad.com": (0, 0), "few.org": (1, 1), "a.good.org": (300, 6), "b.good.org": (40, 0), "c.org": (10, 5), "": (3, 0)}
    outcomes = [(h, int(i < b)) for h, (n, b) in counts.items() for i in range(n)] + [("c.org", None), (None, 1)]
    pages = [(i, None if not h else f"http://{h}/p", None) for i, h in enumerate(counts)]
    got = {r.host: r for r in filter_urls(make(pages, PAGES), make([o for o in outcomes if o[0] is not None], "host string, bad int")).collect()}
    bound = brute(counts)
    for h, (n, b) in counts.items():
        assert (got[h].host_labelled, got[h].host_bad) == (n, b)
        assert abs(got[h].bad_bound - bound[h]) < 1e-4
        assert got[h].verdict == ("block" if bound[h] >= 0.5 else "allow")
    assert got["spam.bad.com"].verdict == "block" and got["few.org"].verdict == "allow" and got["a.good.org"].verdict == "allow"


def test_outcomes_and_empty_tables(make):
    pages = make([(1, "http://a.com/en/12?x", None), (2, "http://b.com/de/13.html", None), (3, "http://b.com/x", None), (4, None, None), (5, "http://b.com/en/14/", None),
                  (6, "http://b.com/" + "9" * 40, None)], PAGES)
    labels = make([(12, 0, 0), (13, 1, 0), (13, 1, 1), (14, None, None), (None, 0, 0), (14, 1, None)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, page_outcomes(pages, labels).collect())) == [("a.com", 1), ("b.com", 0), ("b.com", 1)]
    assert filter_urls(make([], PAGES), make([], "host string, bad int")).collect() == []


def test_host_levels(spark):
    r = spark.createDataFrame([("a.b.c.com",), ("com",), ("",)], "h string").select(domain_of(F.col("h")).alias("d"), suffix_of(F.col("h")).alias("s")).collect()
    assert [tuple(x) for x in r] == [("c.com", "com"), ("com", "com"), ("", "")]


def test_domains_of_ports_addresses_and_long_suffixes(spark):
    hosts = {"a.example.co.uk": ("example.co.uk", "co.uk"), "b.co.uk:8080": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.com:8080": ("x.com", "com"),
             "10.1.2.3": ("10.1.2.3", "address"), "10.9.2.3:80": ("10.9.2.3", "address"), "[2001:db8::1]:443": ("[2001:db8::1]", "address"),
             "a.b.example.com.au": ("example.com.au", "com.au"), "com.example.org": ("example.org", "org"), "1.2.3.4.org": ("4.org", "org"), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in hosts], "h string").select("h", domain_of(site_of(F.col("h"))).alias("d"))
    assert {r.h: (r.d, r.s) for r in df.select("h", "d", suffix_of(F.col("d")).alias("s")).collect()} == hosts
