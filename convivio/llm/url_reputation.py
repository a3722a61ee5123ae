"""URL filter: empirical-Bayes reputation of hosts.

Labelled page outcomes are counted per host. The strength of the beta prior is fitted to all hosts by moments
(the spread of the hosts' good shares beyond what binomial draws explain). The share of all pages shrinks each
suffix, the suffix its registered domains, and the domain its hosts. A registered domain is the last two names of a host,
or the last three if the last two are a known public suffix such as `co.uk`; that is then the suffix. An IP address is a
domain of its own, and all addresses share one suffix. A port takes no part.
A host is blocked when the lower posterior bound of its good share (mean minus `z` deviations) is too low.
Explicit rules come first: the rule with the longest host and path that fits decides.

Only DataFrame functions. A hot host is pre-aggregated before any shuffle, and pages join a stored table with
one row per host, so that Spark can split the hot join partition.

Defined results: a null url, or one without `://`, has empty host and path, and the reputation of the empty
host. Hosts without labelled pages inherit from their domain, suffix or the whole. Null labels are ignored;
without any label nothing is blocked by reputation. Labels name pages by their id (`labels.doc_id` is a page_id). Repeated pages are judged alike; of several labels for one id
the lowest counts. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .common import LOWER, UPPER

# (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
# Range of the fitted prior strength in pages and its value if it cannot be fitted; deviations of the bound; the
# lowest bound that passes.
WEAKEST, STRONGEST, UNKNOWN = 2.0, 200.0, 20.0
Z, LEAST_GOOD = 1.0, 0.6


# Public suffixes of two names, under which sites have different owners.
SHARED_SUFFIXES = [f"{kind}.{land}" for land in ("uk", "au", "nz", "za", "jp", "kr", "in", "br", "mx", "tr", "cn", "tw", "hk", "sg", "il")
                   for kind in ("co", "com", "org", "net", "ac", "edu", "gov", "ne", "or")] + [
    "github.io", "gitlab.io", "blogspot.com", "wordpress.com", "tumblr.com", "herokuapp.com", "netlify.app", "vercel.app",
    "pages.dev", "web.app", "appspot.com", "cloudfront.net", "amazonaws.com", "azurewebsites.net"]
IP_HOST, IP_SUFFIX = r"^([0-9]+(\.[0-9]+){3}|\[.*\])$", "(address)"


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """The registered domain and the public suffix of a host."""
    name = F.regexp_replace(host, ":[0-9]*$", "")
    last_two = F.substring_index(name, ".", -2)
    shared, address = last_two.isin(SHARED_SUFFIXES), name.rlike(IP_HOST)
    domain = F.when(address, name).when(shared, F.substring_index(name, ".", -3)).otherwise(last_two)
    return domain, F.when(address, IP_SUFFIX).when(shared, last_two).otherwise(F.substring_index(name, ".", -1))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    rest = F.substring_index(F.substring_index(F.substring_index(_rest(url), "/", 1), "?", 1), "#", 1)
    return F.translate(rest, UPPER, LOWER)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(F.coalesce(at, F.lit(0)) > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    rest = F.substring_index(F.substring_index(_rest(url), "?", 1), "#", 1)
    at = F.locate("/", rest)
    return F.when(at > 0, rest.substr(at, F.length(rest))).otherwise(F.lit(""))


def best_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits; null when none fits."""
    text, verdict = None, None
    for kind, name, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        text = F.when(fits, name + start) if text is None else text.when(fits, name + start)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    null = F.lit(None).cast("string")
    return (null, null) if text is None else (text, verdict)


def prior(outcomes: DataFrame) -> DataFrame:
    """One row: the good share of all pages and the moment estimate of the prior's strength."""
    seen = outcomes.filter("n > 0").withColumn("p", F.col("good") / F.col("n"))
    sums = seen.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("good").alias("g"),
                    F.sum(F.col("n") * F.col("p") * F.col("p")).alias("npp"), F.sum(1.0 / F.col("n")).alias("inverse"))
    p = F.col("g") / F.col("n")
    spread = F.col("k") * (F.col("npp") - F.col("n") * p * p) / ((F.col("k") - 1) * F.col("n"))
    beyond = spread - p * (1.0 - p) * F.col("inverse") / F.col("k")
    fitted = F.when((F.col("k") > 1) & (beyond > 0), (p * (1.0 - p) - spread) / beyond).otherwise(F.lit(UNKNOWN))
    return sums.select(((F.coalesce("g", F.lit(0)) + 1.0) / (F.coalesce("n", F.lit(0)) + 1.0)).alias("share"),
                       F.least(F.greatest(fitted, F.lit(WEAKEST)), F.lit(STRONGEST)).alias("strength"))


def reputation(hosts: DataFrame, z: float = Z) -> DataFrame:
    """Posterior of each host: (host, n, good, rate, bound); `hosts` has (host, n, good), one row per host."""
    base = prior(hosts)
    domain, suffix = domain_and_suffix(F.col("host"))
    seen = hosts.select("host", "n", "good", domain.alias("domain"), suffix.alias("suffix"))
    strength = base.select("strength").scalar()
    shrink = lambda g, n, mean: (F.col(g) + strength * mean) / (F.col(n) + strength)
    counted = lambda key: seen.groupBy(*key).agg(F.sum("n").alias("_n"), F.sum("good").alias("_g"))
    suffixes = counted(["suffix"]).select("suffix", shrink("_g", "_n", base.select("share").scalar()).alias("_above"))
    domains = counted(["domain", "suffix"]).join(suffixes, "suffix").select(
        "domain", shrink("_g", "_n", F.col("_above")).alias("_domain"))
    rated = seen.join(domains, "domain").withColumn("rate", shrink("good", "n", F.col("_domain")))
    deviation = F.sqrt(F.col("rate") * (1.0 - F.col("rate")) / (F.col("n") + strength + 1.0))
    return rated.select("host", "n", "good", "rate", (F.col("rate") - z * deviation).alias("bound"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, z: float = Z,
               least_good: float = LEAST_GOOD) -> DataFrame:
    """Every page with host, path, the rule that fits, its host's posterior, and the verdict.

    `labels` has (doc_id, quality) with the ids of pages; a page is good when its quality is above 0.
    """
    own = {"host", "path", "rule", "verdict", "reputation", "bound"}
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in own]
    placed = pages.select(*kept, F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
                          F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"))
    marked = (labels.filter(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("page_id"))
              .agg((F.min("quality") > 0).cast("long").alias("_good")))
    named = placed.select("page_id", "host").join(marked, "page_id", "left")
    counted = durable(named.groupBy("host").agg(F.count("_good").alias("n"), F.coalesce(F.sum("_good"), F.lit(0)).alias("good")))
    rated = durable(reputation(counted, z).select(
        "host", F.col("rate").alias("reputation"), "bound"))
    text, verdict = best_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("bound") < least_good, "block").otherwise("allow")
    return placed.join(rated, "host", "left").withColumn("rule", text).withColumn("verdict", F.coalesce(verdict, learned))
