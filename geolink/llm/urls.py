"""URL filter by empirical-Bayes host reputation, with fixed rules before it.

Labelled page outcomes (bad or not) are counted per host. Few of them say little about a host; its rate
is therefore shrunk towards its registered domain's, that towards its suffix's, and that towards the rate
of all pages, through beta-binomial priors. How strongly is estimated from the spread of the children
around their parents (method of moments), once for each level. A host is blocked when the lower bound of
its posterior bad rate exceeds that of all pages by ``FACTOR``; hosts without labels have their domain's
prior and hence a wide posterior.

Everything is DataFrame expressions. Counts are partial aggregates, so that a host with a third of all
pages is a few rows; verdicts return to the pages by a join with one row per host, in which such a host's
pages can be split. The strengths and the overall rate, four numbers, are all that the driver sees.

A url that is null or has no ``://`` has an empty host and path. Repeated pages count each; of repeated
labels the worst counts; labels of unknown pages are ignored. Without labels nothing but rules blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolink.operators.staging import stage_table


class Rule(NamedTuple):
    """A verdict for a host with its subdomains, and paths that start with the rule's."""

    name: str
    verdict: str

    @property
    def host(self) -> str:
        return self.name.partition("/")[0]

    @property
    def path(self) -> str:
        return self.name[len(self.host) :]


RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)

#: Second-level labels under which countries register domains (fixed values).
SHARED_LABELS = ("ac", "co", "com", "edu", "gov", "net", "org")

#: A host is blocked from this multiple of the overall bad rate, at so many standard deviations.
FACTOR = 1.5
DEVIATIONS = 1.645
#: Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 1000.0

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """The registered domain: the suffix and one label. An address of digits is its own domain."""
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    shared = "|".join(SHARED_LABELS)
    country = F.regexp_extract(name, rf"([^.]+\.(?:{shared})\.[a-z][a-z])$", 1)
    plain = F.regexp_extract(name, r"([^.]+\.[^.]+)$", 1)
    return (
        F.when(name.rlike(r"^[0-9.]+$"), name)
        .when(country != "", country)
        .when(plain != "", plain)
        .otherwise(name)
    )


def suffix_of(domain: Column) -> Column:
    return F.regexp_extract(domain, r"^[^.]*\.(.*)$", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule], field: str) -> Column:
    """The name or verdict of the longest rule that fits; null if none does."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        chosen = F.when(fits, F.lit(getattr(rule, field))).otherwise(chosen)
    return chosen


def _strength(children: DataFrame, n: str, bad: str, mean: str) -> float:
    """The prior's strength at which the children spread around their parents' means as they do."""
    m = F.col(mean)
    spread = F.sum((F.col(bad) - F.col(n) * m) ** 2 - F.col(n) * m * (1 - m))
    room = F.sum(F.col(n) * (F.col(n) - 1) * m * (1 - m))
    found = children.agg(spread.alias("spread"), room.alias("room")).first()
    if not found["room"] or found["spread"] is None or found["spread"] <= 0:
        return STRONGEST
    return min(max(found["room"] / found["spread"] - 1, WEAKEST), STRONGEST)


def _shrunk(bad: str, n: str, mean: str, strength: float) -> Column:
    return (F.col(bad) + strength * F.col(mean)) / (F.col(n) + strength)


def host_reputation(
    outcomes: DataFrame, factor: float = FACTOR, deviations: float = DEVIATIONS
) -> DataFrame:
    """``host, pages, bad_pages, bad_rate, lower_bound, blocked`` for each host.

    ``outcomes`` has one row per page: ``host``, and ``bad`` as 0, 1, or null where not labelled.
    """
    domain = domain_of(F.col("host"))
    hosts = outcomes.groupBy("host").agg(
        F.count("bad").alias("pages"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_pages")
    )
    hosts = hosts.withColumn("domain", domain).withColumn("suffix", suffix_of(F.col("domain")))
    hosts = stage_table(hosts, "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(
        F.sum("pages").alias("d_pages"), F.sum("bad_pages").alias("d_bad")
    )
    suffixes = domains.groupBy("suffix").agg(
        F.sum("d_pages").alias("s_pages"), F.sum("d_bad").alias("s_bad")
    )
    total = hosts.agg(F.sum("pages").alias("pages"), F.sum("bad_pages").alias("bad")).first()
    overall = (total["bad"] / total["pages"]) if total["pages"] else 0.0
    suffixes = stage_table(suffixes.withColumn("overall", F.lit(overall)), "suffixes")
    s_strength = _strength(suffixes, "s_pages", "s_bad", "overall")
    s_mean = _shrunk("s_bad", "s_pages", "overall", s_strength)
    domains = stage_table(domains.join(suffixes.withColumn("s_mean", s_mean), "suffix"), "domains")
    d_strength = _strength(domains, "d_pages", "d_bad", "s_mean")
    d_mean = _shrunk("d_bad", "d_pages", "s_mean", d_strength)
    means = domains.select("domain", d_mean.alias("d_mean"))
    hosts = stage_table(hosts.join(means, "domain"), "hosts")
    h_strength = _strength(hosts, "pages", "bad_pages", "d_mean")
    rate = _shrunk("bad_pages", "pages", "d_mean", h_strength)
    weight = F.col("pages") + h_strength
    deviation = F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (weight + 1))
    found = hosts.withColumn("bad_rate", rate).withColumn(
        "lower_bound", F.col("bad_rate") - deviations * deviation
    )
    return found.select(
        "host",
        "pages",
        "bad_pages",
        "bad_rate",
        "lower_bound",
        (F.col("lower_bound") > factor * overall).alias("blocked"),
    )


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    label_col: str = "page_id",
    bad_col: str = "bad",
) -> DataFrame:
    """Per row: the id, ``host``, ``path``, the ``rule`` that decides, and the ``verdict``.

    ``labels`` has outcomes ``bad`` (0 or 1) by page. Pages are read without their text.
    """
    url = F.col(f"`{url_col}`")
    parts = pages.select(
        F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    outcome = (
        labels.select(F.col(f"`{label_col}`").alias("id"), F.col(bad_col).cast("long").alias("bad"))
        .groupBy("id")
        .agg(F.max("bad").alias("bad"))
    )
    reputation = host_reputation(parts.select("id", "host").join(outcome, "id", "left"))
    judged = parts.join(stage_table(reputation.select("host", "blocked"), "reputation"), "host", "left")
    host, path = F.col("host"), F.col("path")
    method = F.when(F.col("blocked"), "block").otherwise("allow")
    return judged.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        rule_of(host, path, rules, "name").alias("rule"),
        F.coalesce(rule_of(host, path, rules, "verdict"), method).alias("verdict"),
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Outcomes from the table of labels: bad is toxic or of low quality, by the id they share."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(
        F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0
    )
    return labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))


def url_filter_sql() -> str:
    """The same for the tables of pages and labels, as SQL."""
    ordered = sorted(RULES, key=lambda r: (-len(r.name), r.name))

    def cases(field: str) -> str:
        return " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
            f"THEN '{getattr(r, field)}'"
            for r in ordered
        )

    shared = "|".join(SHARED_LABELS)

    def strength(name: str, source: str, n: str, bad: str, mean: str) -> str:
        return f"""{name} AS (
            SELECT CASE WHEN coalesce(room, 0) = 0 OR coalesce(spread, 0) <= 0 THEN {STRONGEST}
                        ELSE least(greatest(room / spread - 1, {WEAKEST}), {STRONGEST}) END AS strength
            FROM (SELECT sum(({bad} - {n} * {mean}) * ({bad} - {n} * {mean})
                             - {n} * {mean} * (1 - {mean}))::DOUBLE AS spread,
                         sum({n} * ({n} - 1) * {mean} * (1 - {mean}))::DOUBLE AS room
                  FROM {source}))"""

    return f"""
        WITH parts AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                             '{_UPPER}', '{_UPPER.lower()}') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        outcome AS (
            SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1
                                    WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END) AS bad
            FROM labels GROUP BY doc_id),
        counted AS (
            SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS bad,
                   regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name
            FROM parts LEFT JOIN outcome ON page_id = doc_id GROUP BY host),
        placed AS (
            SELECT host, n, bad,
                   CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name
                        WHEN regexp_extract(name, '([^.]+\\.(?:{shared})\\.[a-z][a-z])$', 1) <> ''
                            THEN regexp_extract(name, '([^.]+\\.(?:{shared})\\.[a-z][a-z])$', 1)
                        WHEN regexp_extract(name, '([^.]+\\.[^.]+)$', 1) <> ''
                            THEN regexp_extract(name, '([^.]+\\.[^.]+)$', 1)
                        ELSE name END AS domain
            FROM counted),
        hosts AS (SELECT *, regexp_extract(domain, '^[^.]*\\.(.*)$', 1) AS suffix FROM placed),
        total AS (SELECT CASE WHEN sum(n) > 0 THEN sum(bad)::DOUBLE / sum(n) ELSE 0 END AS overall FROM hosts),
        suffixes AS (
            SELECT suffix, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, any_value(overall) AS mean
            FROM hosts, total GROUP BY suffix),
        {strength("s", "suffixes", "n", "bad", "mean")},
        domains AS (
            SELECT domain, suffix, sum(h.n)::DOUBLE AS n, sum(h.bad)::DOUBLE AS bad,
                   any_value((x.bad + strength * x.mean) / (x.n + strength)) AS mean
            FROM hosts h JOIN suffixes x USING (suffix), s GROUP BY domain, suffix),
        {strength("d", "domains", "n", "bad", "mean")},
        means AS (
            SELECT h.host, h.n, h.bad, (x.bad + strength * x.mean) / (x.n + strength) AS mean
            FROM hosts h JOIN domains x USING (domain), d),
        {strength("t", "means", "n", "bad", "mean")},
        rates AS (
            SELECT host, n + strength AS weight, (bad + strength * mean) / (n + strength) AS rate
            FROM means, t),
        judged AS (
            SELECT host, rate - {DEVIATIONS} * sqrt(rate * (1 - rate) / (weight + 1)) > {FACTOR} * overall AS blocked
            FROM rates, total)
        SELECT page_id, host, path, CASE {cases("name")} END AS rule,
               CASE {cases("verdict")} ELSE CASE WHEN blocked THEN 'block' ELSE 'allow' END END AS verdict
        FROM parts JOIN judged USING (host)
    """
