import itertools
import math
import re

from fieldgauge.llm import queries, url_filter
from fieldgauge.llm.common import table

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/1", "http://example.net/en", "x://example.com/de/?q#f",
    "http://sub.example.com/de/x", "http://notexample.com/de/", "http://a.org/fr/", "http://net/", "http://a.net",
    "a://b://c/d", "http://É.org/FR/", "https://cheappills.example.com/en/1", "http://h?x://y/z", "http://a\nb.net/\nq",
    "http://" + "verylong" * 3000 + ".org/en",
]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1])[0]
    host, slash, path = rest.partition("/")
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), slash + path


def plain_rule(host, path):
    best = None
    for text, verdict in (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")):
        name, at = text[: text.index("/")], text[text.index("/") :]
        if (host == name or host.endswith("." + name)) and path.startswith(at) and (best is None or len(text) > len(best[0])):
            best = text, verdict
    return best or (None, None)


def check(rows, urls):
    assert len(rows) == len(urls)
    for row in rows:
        assert (row.host, row.path) == plain_parts(urls[row.page_id])
        rule, verdict = plain_rule(row.host, row.path)
        assert row.rule == rule
        assert row.verdict == (verdict or ("block" if row.log_odds > 0 else "allow"))


def test_query(spark):
    urls = {r.page_id: r.url for r in table(spark, SF, "pages").collect()}
    rows = queries.op6_url_filter(spark, SF).collect()
    check(rows, urls)
    # The classifier's sums, done again by hand.
    bad = lambda r: any(f"host:{w}" in r.tokens for w in url_filter.SURE)
    sides = [[t for r in rows if bad(r) == side for t in r.tokens] for side in (True, False)]
    size = len(set(sides[0] + sides[1]))
    prior = math.log((sum(map(bad, rows)) + 1) / (sum(not bad(r) for r in rows) + 1))
    for r in rows[:40]:
        odds = prior + sum(
            math.log((sides[0].count(t) + 1) / (len(sides[0]) + size) * (len(sides[1]) + size) / (sides[1].count(t) + 1))
            for t in r.tokens
        )
        assert abs(odds - r.log_odds) < 1e-6
    for r in rows:
        if r.rule is None and re.search("spam|casino|pills", r.host):
            assert r.verdict == "block"


def test_odd_urls(spark):
    df = spark.createDataFrame([(n, u, None, "x") for n, u in enumerate(ODD)], "page_id long, url string, html string, host string")
    check(url_filter.judge(df, queries.URL_RULES).collect(), dict(enumerate(ODD)))
    assert url_filter.judge(df.limit(0), queries.URL_RULES).count() == 0


def test_segments_are_the_cheapest_of_all():
    own = url_filter.Segmenter({"the": 50, "there": 5, "rein": 2, "in": 30, "cheap": 3, "pills": 2, "a": 9})
    for name in ("therein", "cheappills", "athe", "xqz", "inthere", "thxin"):
        cuts = []
        for places in itertools.product([0, 1], repeat=len(name) - 1):
            parts, start = [], 0
            for n, cut in enumerate(places, 1):
                if cut:
                    parts.append(name[start:n])
                    start = n
            cuts.append([*parts, name[start:]])
        least = min(sum(map(own.word_cost, c)) for c in cuts)
        found = own.words(name)
        assert "".join(found) == name
        assert abs(sum(map(own.word_cost, found)) - least) < 1e-9
    assert own.words("cheappills") == ["cheap", "pills"]
    assert own.words("") == []


def test_no_count_is_cut_and_what_is_held_changes_nothing(spark, monkeypatch):
    rare = [a + b + c + "zzq" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"]
    rows = [(n, f"http://{w}{rare[n - 1]}.com/{w}/x", f"<p>{w} {w} common common {rare[n - 1]}</p>") for n, w in enumerate(rare)]
    rows += [(5000, "http://freewarez.com/x", ""), (5001, rows[3][1], "")]
    # More words of greater count than were once kept.
    filler = ["qq" + "".join(chr(97 + n // 16**k % 16) for k in range(4)) for n in range(51_000)]
    rows += [(5002, None, " ".join(filler * 4))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = None
    for held in (None, 10, 1):
        if held:
            monkeypatch.setattr(url_filter, "HELD", held)
        found = {r.page_id: r for r in url_filter.judge(df, ()).collect()}
        assert len(found) == len(rows)
        # Every rare word is known, so each host falls into its two words.
        assert all(found[n].tokens[:2] == [f"host:{w}", f"host:{rare[n - 1]}"] for n, w in enumerate(rare))
        assert "host:warez" in found[5000].tokens
        got = {n: (r.tokens, r.verdict, r.log_odds) for n, r in found.items()}
        assert want in (None, got)
        want = got
