"""URL filtering: explicit rules first, then host reputation by empirical Bayes.

Pages have an outcome (1 bad, 0 good). Outcomes are counted for each host, and pooled twice: hosts of a registered
domain, domains of a suffix. Each level is a beta-binomial whose prior is the level above: its mean, with a strength
that the spread between the groups of the table gives (method of moments). A host's posterior is its counts plus that
prior; a host is blocked if the posterior probability of a bad page, at its lower bound (mean less ``z`` standard
deviations), exceeds ``block_above``: few pages prove little, many pages outweigh the prior.

Everything is counted with map-side combining, so a host with a third of all pages is one row after it; the tables of
hosts, domains and suffixes meet by shuffled joins. Rules fit by suffix look-up in a small literal list.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule and is judged by the prior
of all pages; repeated rows get equal verdicts; without outcomes nothing is blocked but by rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import ascii_lower
from parcelmart.shared import written

Z, BLOCK_ABOVE, SALTS = 1.64, 0.5, 64
#: Suffixes of two labels under which domains are registered; any other last label is a suffix by itself.
DOUBLE_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.za", "com.cn", "co.in")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: behind the first ``://`` up to ``/``, ``?``, ``#``, A-Z in lower case. Path: from there up to ``?``, ``#``."""
    after = F.substring(url, F.instr(url, "://") + 3, F.char_length(url))
    rest = F.when(F.instr(url, "://") > 0, after).otherwise(F.lit(""))
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    host = F.substring_index(rest, "/", 1)
    return ascii_lower(host), F.substring(rest, F.char_length(host) + 1, F.char_length(rest))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule (``host/path...``) that fits, and its verdict; null without one."""
    rule = verdict = F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix; a host of one label is its own domain and suffix."""
    labels = F.when(F.substring_index(host, ".", -2).isin(*DOUBLE_SUFFIXES), 2).otherwise(1)
    suffix = F.when(labels == 2, F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -1))
    domain = F.when(labels == 2, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))
    return domain, suffix


def _strength(groups: DataFrame, mean: Column) -> DataFrame:
    """Prior strength (pseudo-pages) by the spread of the groups' rates around their prior means; one row."""
    n, rate = F.col("n"), F.col("bad") / F.col("n")
    spread = F.sum(n * (rate - mean) ** 2)
    noise = F.sum(mean * (1 - mean))
    room = F.sum((n - 1) * mean * (1 - mean))
    rho = (spread - noise) / room  # share of the variance that lies between groups
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(0.5)), F.lit(0.01)), F.lit(0.9))
    return groups.agg((1 / rho - 1).alias("strength"))


def reputations(outcomes: DataFrame, z: float = Z, block_above: float = BLOCK_ABOVE) -> DataFrame:
    """``outcomes``: ``host, bad`` (0 or 1) per page. Per host ``n, bad, mean, lower, blocked``."""
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = outcomes.where("bad IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")
    )
    hosts = written(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")

    def pooled(frame: DataFrame, *keys: str) -> DataFrame:
        return frame.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def shrunk(groups: DataFrame, prior: Column) -> DataFrame:
        """``groups`` with a column ``prior``: add the posterior's ``a`` and ``b``."""
        placed = groups.withColumn("prior", prior)
        strength = _strength(placed, F.col("prior"))
        k = strength.scalar()
        return placed.withColumn("a", F.col("bad") + F.col("prior") * k).withColumn("b", F.col("n") - F.col("bad") + (1 - F.col("prior")) * k)

    def mean(a: str = "a", b: str = "b") -> Column:
        return F.col(a) / (F.col(a) + F.col(b))

    overall = hosts.agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("p")).scalar()
    suffixes = shrunk(pooled(hosts, "suffix"), overall).select("suffix", mean().alias("suffix_mean"))
    domains = shrunk(pooled(hosts, "suffix", "domain").join(suffixes, "suffix"), F.col("suffix_mean"))
    domains = domains.select("domain", mean().alias("domain_mean"))
    judged = shrunk(hosts.join(domains, "domain"), F.col("domain_mean"))
    deviation = F.sqrt(F.col("a") * F.col("b") / ((F.col("a") + F.col("b")) ** 2 * (F.col("a") + F.col("b") + 1)))
    lower = mean() - F.lit(z) * deviation
    return judged.select("host", "n", "bad", mean().alias("mean"), lower.alias("lower"), (lower > block_above).alias("blocked"))


def symbol_heavy(html: Column, share: float = 0.03) -> Column:
    """A page outcome without hand-made labels: 1 if over ``share`` of the text outside tags are ``! # $ % & *``."""
    shown = F.regexp_replace(html, "<[^>]*>", " ")
    symbols = F.char_length(shown) - F.char_length(F.translate(shown, "!#$%&*", ""))
    return (symbols > share * F.char_length(shown)).cast("int")


def url_verdicts(pages: DataFrame, outcome: Column, rules: list[tuple[str, str]], z: float = Z, block_above: float = BLOCK_ABOVE) -> DataFrame:
    """Per page ``page_id, host, path, rule, verdict`` and the reputation's ``mean`` and ``lower`` bound."""
    host, path = host_and_path(F.coalesce("url", F.lit("")))
    placed = pages.select("page_id", host.alias("host"), path.alias("path"), outcome.cast("int").alias("bad"))
    known = reputations(placed.select("host", "bad"), z, block_above).select("host", "mean", "lower", "blocked")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.coalesce("blocked", F.lit(False)), "block").otherwise("allow")
    # A host may hold a third of all pages: its one row of reputation goes to SALTS places, its pages are spread over them.
    known = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = placed.withColumn("_salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int"))
    return placed.join(known, ["host", "_salt"], "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "mean", "lower"
    )
