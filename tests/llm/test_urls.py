import math
import zlib
from collections import Counter, defaultdict

from quayside.llm import urls
from tests.conftest import plan_of
from tests.llm import cases

ODD = [
    None,
    "",
    "no scheme.com/",
    "http://",
    "HTTP://WWW.Example.COM/en/x?y#z",
    "https://example.com/en/",
    "https://example.com/en",
    "https://notexample.com/en/1",
    "https://a.b.net/es/1",
    "x://net/fr/://y",
    "ftp://com",
    "ftp://com/",
    "http://ex\u00e4mple.org/\U0001f600/\n#a",
    "http://user@host.org:80?q",
    "http://www.example.com/en/" + "a" * 20_000,
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [(n + p, v) for v, n, p in urls.RULES if (host == n or host.endswith("." + n)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


def triples(url):
    codes = [0, 0] + [urls.ALPHABET.find(c) + 2 if c in urls.ALPHABET else 1 for c in (url or "").lower()]
    return [tuple(codes[i : i + 3]) for i in range(len(codes) - 2)]


class Brute:
    """The two models, by counting."""

    def __init__(self, decided):
        self.sides = {}
        for side in ("allow", "block"):
            n = Counter(t for url, verdict in decided if verdict == side for t in triples(url))
            self.sides[side] = n

    def p(self, side, triple):
        n, (a, b, c) = self.sides[side], triple
        p = (sum(k for t, k in n.items() if t[2] == c) + 1) / (sum(n.values()) + urls.SIZE)
        for fits, exact in ((lambda t: t[1] == b, lambda t: t[1:] == (b, c)), (lambda t: t[:2] == (a, b), lambda t: t == triple)):
            total = sum(k for t, k in n.items() if fits(t))
            kinds = len({t[2] for t in n if fits(t)})
            if total:
                p = (sum(k for t, k in n.items() if exact(t)) + kinds * p) / (total + kinds)
        return p

    def score(self, url):
        found = triples(url)
        return sum(math.log(self.p("allow", t) / self.p("block", t)) for t in found) / max(1, len(found))


def threshold(scored):
    yes = [s for s, v in scored if v == "allow"]
    no = [s for s, v in scored if v == "block"]
    if not yes or not no:
        return None
    step = lambda s: round(max(-urls.FARTHEST, min(urls.FARTHEST, s)) / urls.STEP)
    best = max(
        {step(s) for s, _ in scored},
        key=lambda k: (round(sum(step(s) < k for s in no) / len(no) - sum(step(s) < k for s in yes) / len(yes), 12), -k),
    )
    return (best - 0.5) * urls.STEP


def test_against_brute_force(spark):
    rows = spark.read.parquet(f"{cases.TABLES}/pages.parquet").select("page_id", "url").collect()
    rows = [(r.page_id, r.url) for r in rows] + [(10_000 + i, u) for i, u in enumerate(ODD[:-1])]
    frame = spark.createDataFrame([(i, u, "h", 1, "v") for i, u in rows], "page_id long, url string, host string, rule int, verdict string")
    found = {r.page_id: r for r in urls.judged(frame).collect()}
    assert len(found) == len(rows)
    decided = defaultdict(list)
    for i, url in rows:
        host, path = parts(url)
        assert (found[i].host, found[i].path) == (host, path)
        assert found[i].rule == rule(host, path)[0]
        if found[i].rule:
            decided[zlib.crc32(url.encode()) % 2].append((url, rule(host, path)[1]))
    half, brute = Brute(decided[0]), Brute(decided[0] + decided[1])
    known = {url: brute.score(url) for _, url in rows}
    edge = threshold([(half.score(u), v) for u, v in decided[1]])
    for i, url in rows:
        assert abs(found[i].score - known[url]) < 1e-5
        expected = rule(*parts(url))[1] or ("block" if edge is not None and known[url] < edge else "allow")
        assert found[i].verdict == expected or abs(known[url] - edge) < 1e-5


def test_edges(spark):
    schema = "page_id long, url string"
    assert urls.judged(spark.createDataFrame([], schema)).count() == 0
    rows = urls.judged(spark.createDataFrame([(1, u) for u in ODD] + [(None, None)], schema)).collect()
    assert len(rows) == len(ODD) + 1 and {r.verdict for r in rows} == {"allow", "block"}
    undecided = spark.createDataFrame([(1, "http://x.org/"), (1, "http://x.org/"), (2, None)], schema)
    assert {(r.rule, r.verdict) for r in urls.judged(undecided).collect()} == {(None, "allow")}


def test_no_python_in_the_plan(spark):
    plan = plan_of(urls.op2_url_filters(spark, cases.TABLES))
    assert "Python" not in plan and "Arrow" not in plan
