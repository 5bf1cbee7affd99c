"""URL filter: rules first, then an empirical-Bayes reputation of the host.

Labelled outcomes of pages (1 good, 0 bad) are counted per host, registered
domain and suffix. Each level's success rate is shrunk towards its parent's
by a beta prior whose strength is estimated from the data (beta-binomial
method of moments), so a host with few labelled pages is judged mostly by
its domain, and an unseen one by its suffix. A host is blocked when the upper
bound of its posterior rate lies below ``min_rate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.sqltext import ascii_lower, save_shared

# (verdict, host, path) -- the rules the query is given.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
# Suffixes of two labels; every other suffix is the last label, unless a list
# is given.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in")

MAX_BROADCAST_SUFFIXES = 100_000   # the public list has about a tenth of it
IPV4 = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"

MIN_RATE = 0.5     # a good host has at least this share of good pages
Z_BOUND = 1.645    # one-sided 95 % posterior bound
RHO_RANGE = (1e-4, 0.99)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) after the first ``://``; both empty without one or for NULL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule that fits, else NULLs."""
    name = verdict = None
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))
    for what, h, p in ranked:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def host_name(host: Column) -> Column:
    """``host`` without user and port."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r"(?<=[^:]):[0-9]*$", "")


def _is_address(name: Column) -> Column:
    return name.rlike(IPV4) | name.startswith("[")


def _split_domain(name: Column, n: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) where the suffix has ``n`` labels."""
    labels = F.split(name, r"\.")

    def last(k: Column) -> Column:
        return F.array_join(F.slice(labels, F.greatest(F.size(labels) - k, F.lit(0)) + 1, k), ".")

    whole = _is_address(name)
    return F.when(whole, name).otherwise(last(n + 1)), F.when(whole, name).otherwise(last(n))


def domain_parts(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; user and port do not count. An
    address or a bare label is its own domain and suffix."""
    name = host_name(host)
    two = F.substring_index(name, ".", -2)
    return _split_domain(name, F.when(two.isin(*TWO_LABEL_SUFFIXES), 2).otherwise(1))


def with_domains(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """``hosts`` (host, ...) with domain and suffix; by ``TWO_LABEL_SUFFIXES`` or
    a table ``suffixes`` with a column suffix, in the public list's form:
    ``co.uk``, ``*.ck`` (any label before), ``!www.ck`` (not under that one).

    The list has one small lookup per number of labels; the longest suffix
    counts, an exception before all.
    """
    if suffixes is None:
        domain, suffix = domain_parts(F.col("host"))
        return hosts.withColumns({"domain": domain, "suffix": suffix})
    rule = ascii_lower(F.trim("suffix"))
    key = F.regexp_replace(rule, r"^(\*\.|!)", "")
    k = F.size(F.split(key, r"\."))
    keys = suffixes.where(F.col("suffix").isNotNull()).select(
        key.alias("_key"), k.alias("_k"),
        F.when(rule.startswith("!"), k - 1).alias("_not"),
        F.when(rule.startswith("*."), k + 1).alias("_any"),
        F.when(~rule.startswith("!") & ~rule.startswith("*."), k).alias("_plain"))
    keys = keys.where("_key <> ''").groupBy("_key", "_k").agg(
        *[F.max(c).alias(c) for c in ("_not", "_any", "_plain")])
    keys = save_shared(keys, "suffix-list", few_files=True)
    size = keys.agg(F.count(F.lit(1)).alias("n"), F.max("_k").alias("k")).first()
    out = hosts.withColumn("_name", host_name(F.col("host")))
    labels = F.size(F.split("_name", r"\."))
    fits, excepted = [F.lit(1)], []
    for k in range(1, (size["k"] or 0) + 1):
        these = keys.where(F.col("_k") == k).select(
            F.col("_key").alias(f"_key{k}"), *[F.col(c).alias(f"{c}{k}") for c in (
                "_not", "_any", "_plain")])
        if size["n"] <= MAX_BROADCAST_SUFFIXES:
            these = F.broadcast(these)
        out = out.join(these, F.substring_index("_name", ".", -k) == F.col(f"_key{k}"), "left")
        fits += [F.when(labels >= k, F.col(f"_plain{k}")),
                 F.when(labels > k, F.col(f"_any{k}"))]
        excepted.append(F.when(labels >= k, F.col(f"_not{k}")))
    longest = F.array_max(F.array(*fits))
    n = F.coalesce(*reversed(excepted), longest) if excepted else longest
    domain, suffix = _split_domain(F.col("_name"), n)
    return out.select(*[F.col(f"`{c}`") for c in hosts.columns], domain.alias("domain"),
                      suffix.alias("suffix"))


def _strength(units: DataFrame, parent: str) -> float:
    """Prior strength (pseudo-pages) of one level: the over-dispersion of the
    units' counts ``good`` of ``n`` around the parent rate."""
    mu = F.col(parent)
    v = mu * (1 - mu)
    row = units.agg(
        F.sum((F.col("good") - F.col("n") * mu) ** 2 - F.col("n") * v).alias("over"),
        F.sum(F.col("n") * (F.col("n") - 1) * v).alias("room")).first()
    rho = (row["over"] or 0.0) / row["room"] if row["room"] else RHO_RANGE[0]
    rho = min(max(rho, RHO_RANGE[0]), RHO_RANGE[1])
    return 1.0 / rho - 1.0


def host_reputation(outcomes: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """One row per host of ``outcomes`` (host, good; a NULL ``good`` is an
    unlabelled page): host, domain, suffix, n, good, rate, rate_sd.

    Raw pages are combined map-side into one row per host; everything after
    that works on host rows. Only three prior strengths and the overall rate
    come to the driver. Empty input gives no hosts.
    """
    hosts = (outcomes.groupBy("host")
             .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")))
    hosts = save_shared(with_domains(hosts, suffixes), "host-counts")
    total = hosts.agg(F.sum("good").alias("g"), F.sum("n").alias("n")).first()
    overall = ((total["g"] or 0) + 1.0) / ((total["n"] or 0) + 2.0)

    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums).withColumn("parent", F.lit(overall))
    k = _strength(suffixes, "parent")
    suffixes = save_shared(suffixes.select("suffix", (
        (F.col("good") + k * F.col("parent")) / (F.col("n") + k)).alias("suffix_rate")),
        "suffix-rates")
    domains = domains.join(suffixes, "suffix")
    k = _strength(domains, "suffix_rate")
    domains = save_shared(domains.select("domain", (
        (F.col("good") + k * F.col("suffix_rate")) / (F.col("n") + k)).alias("domain_rate")),
        "domain-rates")
    hosts = hosts.join(domains, "domain")
    k = _strength(hosts, "domain_rate")
    rate = (F.col("good") + k * F.col("domain_rate")) / (F.col("n") + k)
    return hosts.select("host", "domain", "suffix", "n", "good", rate.alias("rate"),
                        F.sqrt(rate * (1 - rate) / (F.col("n") + k + 1)).alias("rate_sd"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES,
               min_rate: float = MIN_RATE, z: float = Z_BOUND,
               suffixes: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule,
    verdict, rate, rate_upper.

    ``outcomes`` (page_id, good) holds labelled pages; several labels of a
    page are averaged and rounded up at one half. A page without a URL has
    the empty host, judged like any other; repeated page rows each give a
    row; other columns of ``pages`` are not looked at. ``suffixes`` is a list of
    domain suffixes for ``with_domains``.
    """
    host, path = split_url(F.col("url"))
    p = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    labelled = outcomes.where(F.col("page_id").isNotNull() & F.col("good").isNotNull()) \
        .groupBy("page_id").agg((F.avg("good") >= 0.5).cast("int").alias("good"))
    seen = p.select("page_id", "host").join(labelled, "page_id", "left")
    rep = save_shared(host_reputation(seen, suffixes).select(
        "host", "rate", (F.col("rate") + z * F.col("rate_sd")).alias("rate_upper")), "host-rates")
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("rate_upper") < min_rate, "block").otherwise("allow")
    return p.join(rep, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(by_rule, by_host).alias("verdict"), "rate", "rate_upper")
