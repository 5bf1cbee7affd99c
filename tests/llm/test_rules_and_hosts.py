"""Rule list and URL filter against plain Python."""

import collections
import re

import numpy as np
import pytest

from clickflow.llm import hosts, rule_list

WORD = re.compile("[^\x20\x09-\x0d]+")

TEXTS = [
    None, "", "   \n \t", "one", "a b c", "a b c a b c", "x x x x x x", "a b\n\na b\n c \n c \na b",
    "Über | straße # 5% <b> & co\x0b\x0cend", "a b c d a b c e b c d " * 40,
    "w1 w2 w3 w4 w5 " * 3 + "tail", "long " + " ".join(f"t{i % 977}" for i in range(30_000)),
    "ab\x85cd\u00a0ef gh\u2003ij", "a b c\x0da b c",
]


def base_stats(t):
    t = t or ""
    w = WORD.findall(t)
    at = collections.defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t),
            len(lines) - len(set(lines)), len(covered))


def test_base_statistics_match_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in rule_list.BASE)
           for r in rule_list.text_stats(docs).collect()}
    assert got == {i: base_stats(t) for i, t in enumerate(TEXTS)}


def test_apply_rules_keeps_every_row_and_orders_rules(spark):
    docs = spark.createDataFrame(
        [(None, "w " * 60, "n"), (1, " ".join(f"w{i}" for i in range(60)), "n"),
         (1, " ".join(f"w{i}" for i in range(60)), "n"), (2, None, "n")],
        "doc_id long, text string, n_words string")
    rules = [rule_list.Rule((("n_words", ">", 100.0),)), rule_list.Rule((("n_words", ">", 10.0),))]
    out = sorted(map(tuple, rule_list.apply_rules(docs, rules)
                     .select("doc_id", "base_failed", "rule", "kept").collect()), key=repr)
    assert out == [(1, False, 2, False), (1, False, 2, False), (2, True, 0, False),
                   (None, True, 2, False)]
    assert rule_list.apply_rules(docs.limit(0), []).count() == 0


def test_learned_list_separates_a_planted_conjunction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(rule_list.FEATURES)))
    bad = (x[:, 2] > 0.8) & (x[:, 4] <= 0.5)
    rules = rule_list.learn_rules(x, bad)
    hit = np.zeros(len(x), bool)
    for r in rules:
        hit |= r.covers(x)
    assert (hit == bad).mean() > 0.97
    assert rule_list.learn_rules(x[:0], bad[:0]) == []
    assert rule_list.learn_rules(x, np.ones(len(x), bool)) == []


def split_url(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule_of(h, p):
    fit = [(len(rh + rp), rh + rp, what) for what, rh, rp in hosts.RULES
           if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
    return max(fit)[1:] if fit else (None, None)


URLS = [None, "", "nohost", "http://", "http://a.com", "http://A.COM/x", "http://x.example.com/en/1?q",
        "https://www.example.com/en/1#f", "https://m.www.example.com/en/", "http://net/es/1",
        "http://q.net/fr/", "http://q.net/de/#/fr/", "http://notexample.com/en/", "HTTP://ÉX.NET/es/?",
        "http://a.com?/en/", "x://y://z.com/en/", "http://user@b.example.com:80/en/"]


def test_urls_and_rules_match_brute_force(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(3, URLS[3], "x"), (None, URLS[6], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    labels = spark.createDataFrame([(0, 1), (0, None), (4, 0), (None, 1)], "page_id long, good int")
    out = hosts.judge_urls(pages, labels).collect()
    assert len(out) == len(rows)
    want = collections.Counter()
    for i, u, _ in rows:
        h, p = split_url(u)
        rule, verdict = rule_of(h, p)
        want[(i, h, p, rule, verdict or "allow")] += 1
    assert collections.Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out) == want
    assert hosts.judge_urls(pages.limit(0), labels.limit(0)).count() == 0


def test_bad_hosts_are_blocked_and_small_ones_follow_their_domain(spark):
    rows, labels = [], []
    for d in range(40):
        bad = d < 10
        for k in range(30):
            i = len(rows)
            rows.append((i, f"http://h{k % 3}.d{d}.org/p"))
            labels.append((i, int(not bad) if k % 10 else int(bad)))
        rows.append((len(rows), f"http://new.d{d}.org/"))  # no label of its own
    out = hosts.judge_urls(spark.createDataFrame(rows, "page_id long, url string"),
                           spark.createDataFrame(labels, "page_id long, good int")).collect()
    verdicts = collections.defaultdict(set)
    for r in out:
        verdicts[int(r.host.split(".")[1][1:]) < 10].add(r.verdict)
    assert verdicts == {True: {"block"}, False: {"allow"}}
    rate = {r.host: r.rate for r in out}
    assert rate["new.d0.org"] < 0.5 < rate["new.d20.org"]


@pytest.mark.parametrize("host,want", [
    ("a.b.co.uk", ("b.co.uk", "co.uk")), ("b.org", ("b.org", "org")), ("x.y.b.org", ("b.org", "org")),
    ("local", ("local", "local")), ("", ("", ""))])
def test_domain_parts(spark, host, want):
    from pyspark.sql import functions as F
    d, s = hosts.domain_parts(F.col("h"))
    assert tuple(spark.createDataFrame([(host,)], "h string").select(d, s).first()) == want


def test_addresses_ports_and_a_given_suffix_list(spark):
    from pyspark.sql import functions as F
    want = {"10.1.2.3": ("10.1.2.3",) * 2, "10.1.2.3:80": ("10.1.2.3",) * 2,
            "[2001:db8::1]:80": ("[2001:db8::1]",) * 2, "[2001:db8::1]": ("[2001:db8::1]",) * 2,
            "u@a.b.org:8080": ("b.org", "org"), "b.co.uk:80": ("b.co.uk", "co.uk")}
    df = spark.createDataFrame([(h, 1) for h in want], "host string, n int")
    assert {r.host: (r.domain, r.suffix) for r in hosts.with_domains(df).collect()} == want
    listed = spark.createDataFrame([(s,) for s in (
        "com", "com.cn", "Gov.UK", "*.ck", "!www.ck", "k12.ma.us", "com.cn", None, "")],
        "suffix string")
    want = {"a.b.com.cn": ("b.com.cn", "com.cn"), "x.gov.uk:80": ("x.gov.uk", "gov.uk"),
            "a.b.c.ck": ("b.c.ck", "c.ck"), "a.www.ck": ("www.ck", "ck"), "c.ck": ("c.ck", "c.ck"),
            "p.q.k12.ma.us": ("q.k12.ma.us", "k12.ma.us"), "a.b.co.uk": ("co.uk", "uk"),
            "com.cn": ("com.cn", "com.cn"), "x.com": ("x.com", "com"), "": ("", ""),
            "local": ("local", "local"), "10.1.2.3": ("10.1.2.3",) * 2}
    df = spark.createDataFrame([(h, 1) for h in want], "host string, n int")
    out = hosts.with_domains(df, listed)
    assert out.columns == ["host", "n", "domain", "suffix"] and out.count() == len(want)
    assert {r.host: (r.domain, r.suffix) for r in out.collect()} == want
    assert hosts.with_domains(df, listed.limit(0)).where(F.col("domain").isNull()).count() == 0


def test_a_new_host_follows_its_own_site_under_a_listed_suffix(spark):
    rows, labels = [], []
    for d in range(20):
        for k in range(20):
            rows.append((len(rows), f"http://h{k % 2}.d{d}.com.cn/p"))
            labels.append((rows[-1][0], int(d >= 10)))
        rows.append((len(rows), f"http://new.d{d}.com.cn/"))
    out = hosts.judge_urls(spark.createDataFrame(rows, "page_id long, url string"),
                           spark.createDataFrame(labels, "page_id long, good int"),
                           suffixes=spark.createDataFrame([("com.cn",)], "suffix string")).collect()
    rate = {r.host: r.rate for r in out}
    assert rate["new.d0.com.cn"] < 0.2 and rate["new.d19.com.cn"] > 0.8
