"""URL filter: host rules, then empirical-Bayes host reputation.

Rules decide the pages they fit. The rest is decided by the reputation of the
host: its share of bad page outcomes, shrunk by beta-binomial priors from host
to registered domain to suffix. Each level's prior mean is the posterior mean
of the level above, its strength is fitted by the method of moments over all
groups of the level, and a host is blocked when the lower posterior bound of
its bad share is above one half.

A page's outcome is its own, whether a rule fits it or not: a label where the
caller has one, else ``page_outcome``, which looks at the text in the html
(marks in place of words, few different words) and at the words of the host.
The pages are read twice: with their html for the counts by host, which are
written once, and without it for the verdicts.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and is judged like any other host (the empty one); outcomes
that are null are not counted; a host without outcomes is judged by its prior;
an empty table gives an empty result; other columns pass by unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, keep

ROOT_PRIOR = (0.5, 0.5)         # of the bad share over all outcomes
RHO_RANGE = (1 / 1001, 1 / 2)   # intra-class correlation; a strength of 1000 down to 1
BOUND_Z = 1.645                 # one-sided 95 % posterior bound
LEVELS = ("suffix", "domain", "host")

# Public suffixes of two labels (a parameter: pass a longer list
# where there is one), and words in host names of unwanted sites.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "com.br", "com.cn",
            "co.in", "co.kr", "co.nz", "co.za", "com.mx", "com.tr")
UNWANTED = ("adult", "ads", "bet", "bets", "casino", "pills", "poker", "porn", "spam", "viagra", "xxx")

NOT_TEXT = r"(?is)<script.*?</script>|<style.*?</style>|<nav.*?</nav>|<!--.*?-->|<[^>]*>"
WORD = r"[^\x20\x09-\x0D]+"
MARKS = r"[%#*$!|&]{2,}|[\x20\x09-\x0D][|]"


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule (``host/path``) that fits, else null. ``rules`` is a
    configured list, not data."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at, _, prefix = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + prefix)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _groups(host: Column, suffixes: tuple[str, ...]) -> list[Column]:
    """Public suffix (the last label, or the last two if listed) and registered
    domain (a label more), both without a port. An address of numbers is its
    own domain and has no suffix."""
    name = F.regexp_replace(host, ":[0-9]*$", "")
    two, number = F.substring_index(name, ".", -2).isin(*suffixes), name.rlike("^[0-9.]+$")
    part = lambda labels: F.substring_index(name, ".", -labels)
    return [F.when(number, F.lit("")).when(two, part(2)).otherwise(part(1)).alias("suffix"),
            F.when(number, name).when(two, part(3)).otherwise(part(2)).alias("domain")]


def page_outcome(html: Column, host: Column, unwanted: tuple[str, ...] = UNWANTED) -> Column:
    """1 for a page whose text has three marks in ten words or more, or of 20
    words or more at most a quarter different ones, or whose host name has an
    unwanted word; else 0."""
    text = F.regexp_replace(F.replace(F.coalesce(html, F.lit("")), F.lit("&amp;"), F.lit("&")), NOT_TEXT, " ")
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, marks, different = F.size(words), F.regexp_count(text, F.lit(MARKS)), F.size(F.array_distinct(words))
    named = host.rlike(f"(^|[^a-z])({'|'.join(unwanted)})([^a-z]|$)") if unwanted else F.lit(False)
    return (named | ((n > 0) & (marks * 10 >= n * 3)) | ((n >= 20) & (different * 4 <= n))).cast("int")


def host_reputation(outcomes: DataFrame, z: float = BOUND_Z, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """``outcomes`` has host and bad (1, 0 or null). Returns a row per host:
    host, n, bad, share (posterior mean), lower (posterior bound)."""
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("k"))
    hosts = keep(hosts.select("host", *_groups(F.col("host"), suffixes), F.col("n").cast("double").alias("n"), "k"), "host-counts")
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()  # one row
    a, b = ROOT_PRIOR
    n, k = total["n"] or 0.0, total["k"] or 0.0
    above = None
    for level, groups in zip(LEVELS, (suffixes, domains, hosts)):
        if above is None:
            groups = groups.withColumn("m", F.lit((k + a) / (n + a + b)))
        else:
            key = LEVELS[LEVELS.index(level) - 1]
            groups = groups.join(above.select(key, F.col("share").alias("m")), key, "left")
        strength = _strength(groups)
        above = groups.withColumn("share", (F.col("k") + strength * F.col("m")) / (F.col("n") + strength))
    size = F.col("n") + strength
    spread = F.sqrt(F.col("share") * (1 - F.col("share")) / (size + 1))
    return above.select("host", F.col("n").cast("long").alias("n"), F.col("k").cast("long").alias("bad"), "share",
                        F.greatest(F.lit(0.0), F.col("share") - z * spread).alias("lower"))


def _strength(groups: DataFrame) -> float:
    """Method of moments: sum n (k/n - m)^2 is about sum m(1-m)(1 + (n-1) rho)
    over a level's groups; the prior's strength is 1/rho - 1. One row comes
    to the driver. Sums are rounded so that their order doesn't matter."""
    n, m, share = F.col("n"), F.col("m"), F.col("k") / F.col("n")
    row = groups.where(n > 0).agg(
        F.sum(n * (share - m) * (share - m)).alias("seen"), F.sum(m * (1 - m)).alias("within"),
        F.sum(m * (1 - m) * (n - 1)).alias("more")).first()
    lo, hi = RHO_RANGE
    rho = (row["seen"] - row["within"]) / row["more"] if row["more"] else hi
    return round(1 / min(max(rho, lo), hi) - 1, 6)


def filter_urls(pages: DataFrame, allow: list[str], block: list[str], z: float = BOUND_Z,
                outcome: Column | None = None, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's posterior share and
    bound. ``outcome`` (over the columns of ``pages``) is a page's labelled
    outcome, 1 for bad; by default ``page_outcome`` of its html and host."""
    rules = [("block", r) for r in block] + [("allow", r) for r in allow]
    kinds = F.create_map(*[F.lit(x) for kind, r in rules for x in (r, kind)])
    judged = (pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
              .withColumn("rule", matched_rule(F.col("host"), F.col("path"), rules))
              .withColumn("by_rule", F.when(F.col("rule").isNotNull(), kinds[F.col("rule")])))
    host = url_host(F.col("url"))
    html = F.col("html") if "html" in pages.columns else F.lit(None).cast("string")
    bad = page_outcome(html, host) if outcome is None else outcome
    reputation = keep(host_reputation(pages.select(host.alias("host"), bad.alias("bad")), z, suffixes).select(
        "host", "share", "lower"), "reputation")
    return judged.join(reputation.select("host", "share", "lower"), "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("lower") > 0.5, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "share", "lower")
