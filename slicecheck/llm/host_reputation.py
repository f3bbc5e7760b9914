"""Host reputation by empirical Bayes, after fixed rules on hosts and paths.

Labelled outcomes of pages are shrunk level by level: suffix, registered domain, host.
At each level the prior is a beta distribution around the mean of the level above, its
strength estimated from how much the level's groups differ (method of moments over all
groups of the level); good and bad outcomes then give the posterior, whose mean is the
prior mean of the next level. A host is blocked if the lower bound of its posterior
share of bad pages is above what is allowed. Hosts without labels have their domain's.

Everything is counted per host first, inside the map tasks, so that a host with most of
the pages is one row afterwards; pages get their host's bound by a join on the host that
adaptive execution may split.

Defined cases: a null url, or one without ``://``, has an empty host and path; the empty
host is its own domain and suffix. Pages that repeat count each; a null page_id has no label.
Hosts of any length are judged whole. An empty table gives an empty one. Without labels the
share of bad pages is ``NO_LABELS_BAD`` and nothing but the rules blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicecheck.settings import written

# The rules of the contract, as (verdict, host, path).
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
# Parameters: bad share a host may have; normal quantile of the bound; limits of the
# strength of a prior; what holds without any label.
MOST_BAD = 0.3
QUANTILE = 1.2815515655446004  # one-sided, 90 %
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1000.0
NO_LABELS_BAD = 0.0
# What stands around the name in a host, numeric addresses, and names under a
# suffix of two labels.
USER, PORT = "^.*@", r":[0-9]*\z"
NUMERIC = r"^[0-9]+(\.[0-9]+){3}\z"
TWO_LABELS = r"(^|\.)(ac|co|com|edu|gob|gov|net|ne|or|org)\.[a-z]{2}\z"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null. Of rules of equal
    length that with the longer host wins, then block. The list is the caller's and short."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, on, start in reversed(ranked):
        fits = ((host == on) | F.endswith(host, F.lit(f".{on}"))) & F.startswith(path, F.lit(start))
        one = F.struct(F.lit(on + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, one).otherwise(found)
    return found


def levels_of(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix. A user before ``@`` and a port are left out; a numeric
    address is its own domain and suffix; under a country, a label like ``co`` belongs to
    the suffix."""
    name = F.regexp_replace(F.regexp_replace(host, USER, ""), PORT, "")
    long = F.rlike(name, F.lit(TWO_LABELS))
    numeric = F.rlike(name, F.lit(NUMERIC))
    domain = F.when(long, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))
    suffix = F.when(long, F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1))
    return F.when(numeric, name).otherwise(domain), F.when(numeric, name).otherwise(suffix)


def beta_bound(a: Column, b: Column, z: float) -> Column:
    """Quantile of a beta distribution at the normal quantile ``-z`` (closed form of the
    usual approximation by a normal quantile; right within a few thousandths for a, b > 1)."""
    lam = F.lit((z * z - 3) / 6)
    h = 2 / (1 / (2 * a - 1) + 1 / (2 * b - 1))
    w = F.lit(z) * F.sqrt(h + lam) / h
    w = w - (1 / (2 * b - 1) - 1 / (2 * a - 1)) * (lam + F.lit(5.0 / 6) - 2 / (3 * h))
    return a / (a + b * F.exp(2 * w))


def strength(groups: DataFrame) -> Column:
    """Aggregate: a + b of the beta prior, by moments over groups with n outcomes, k of
    them bad, and the prior mean m. Variance beyond what chance alone gives is weighed
    against it: sum (k - n m)^2 = sum n m (1 - m) (1 + (n - 1) / (strength + 1))."""
    n, k, m = F.col("n"), F.col("k"), F.col("m")
    chance = n * m * (1 - m)
    over = F.sum((k - n * m) * (k - n * m)) - F.sum(chance)
    spread = F.sum(chance * (n - 1))
    rho = F.when((spread > 0) & (over > 0), over / spread).otherwise(0.0)
    raw = F.when(rho > 0, 1 / rho - 1).otherwise(MOST_STRENGTH)
    return F.least(F.greatest(raw, F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH))


def host_bounds(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host, n, k, bad_mean, bad_bound. ``pages``: page_id, host; ``labels``: page_id, bad."""
    domain, suffix = levels_of(F.col("host"))
    counts = written(
        pages.join(labels, "page_id", "left")
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("k"))
        .select("*", domain.alias("domain"), suffix.alias("suffix"))
    )
    domains = counts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    everything = suffixes.agg(F.sum("n").alias("tn"), F.sum("k").alias("tk"))
    base = everything.select(
        F.when(F.col("tn") > 0, F.col("tk") / F.col("tn")).otherwise(NO_LABELS_BAD).alias("m")
    )
    level = suffixes.join(F.broadcast(base))  # one row
    level = written(_shrunk(level).select("suffix", F.col("mean").alias("m")))
    level = domains.join(level, "suffix")
    level = written(_shrunk(level).select("domain", F.col("mean").alias("m")))
    level = _shrunk(counts.join(level, "domain"))
    a, b = F.col("s") * F.col("m") + F.col("k"), F.col("s") * (1 - F.col("m")) + F.col("n") - F.col("k")
    # The closed form wants both above one half; a floor of one keeps the bound cautious.
    bound = beta_bound(F.greatest(a, F.lit(1.0)), F.greatest(b, F.lit(1.0)), QUANTILE)
    bound = F.when(F.col("m") > 0, bound).otherwise(F.when(F.col("k") > 0, bound).otherwise(0.0))
    return level.select("host", "n", "k", F.round("mean", 6).alias("bad_mean"), F.round(bound, 6).alias("bad_bound"))


def _shrunk(level: DataFrame) -> DataFrame:
    """With the level's strength s (one row, joined to all) and posterior mean."""
    s = level.agg(strength(level).alias("s"))
    mean = (F.col("s") * F.col("m") + F.col("k")) / (F.col("s") + F.col("n"))
    return level.join(F.broadcast(s)).withColumn("mean", mean)


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    most_bad: float = MOST_BAD,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_bound of every page. ``labels``: page_id, bad (0/1)."""
    host, path = url_parts(pages[url])
    parted = pages.select(pages[page_id].alias("page_id"), host.alias("host"), path.alias("path"))
    bounds = written(host_bounds(parted, labels))
    hit = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_bound") > most_bad, "block").otherwise("allow")
    return (
        parted.join(bounds, "host")
        .withColumn("hit", hit)
        .select(
            "page_id", "host", "path", F.col("hit.rule").alias("rule"),
            F.coalesce(F.col("hit.verdict"), own).alias("verdict"), "bad_bound",
        )
    )


def page_labels(labels: DataFrame) -> DataFrame:
    """page_id, bad: a page is bad if the row of ``labels`` with its id has quality 0."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    return known.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("bad")
    )


def query(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """op1: the verdict on every page."""
    return judge(pages, page_labels(labels))


def _level_sql(name: str, source: str, group: str) -> str:
    """SQL of a level: strength over the rows of ``source`` (n, k, m), and posterior means."""
    return f"""
{name}_s AS (
  SELECT least(greatest(CASE WHEN rho > 0 THEN 1 / rho - 1 ELSE {MOST_STRENGTH} END,
    {LEAST_STRENGTH}::DOUBLE), {MOST_STRENGTH}::DOUBLE) AS s
  FROM (SELECT CASE WHEN spread > 0 AND over_ > 0 THEN over_ / spread ELSE 0 END AS rho FROM (
    SELECT sum((k - n * m) * (k - n * m)) - sum(n * m * (1 - m)) AS over_,
           sum(n * m * (1 - m) * (n - 1)) AS spread FROM {source}))
), {name} AS (
  SELECT {group}, n, k, m, s, (s * m + k) / (s + n) AS mean FROM {source}, {name}_s
)"""


_LAM = (QUANTILE * QUANTILE - 3) / 6
SQL = f"""
WITH r AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM r
), b AS (
  SELECT doc_id AS page_id, max(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1
), c AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS k,
         CASE WHEN regexp_matches(name, '{NUMERIC}') THEN name
              ELSE array_to_string(list_slice(string_split(name, '.'), -labels - 1, -1), '.') END AS domain,
         CASE WHEN regexp_matches(name, '{NUMERIC}') THEN name
              ELSE array_to_string(list_slice(string_split(name, '.'), -labels, -1), '.') END AS suffix
  FROM (SELECT *, CASE WHEN regexp_matches(name, '{TWO_LABELS}') THEN 2 ELSE 1 END AS labels FROM (
          SELECT *, regexp_replace(regexp_replace(host, '{USER}', ''), '{PORT}', '') AS name FROM p))
  LEFT JOIN b USING (page_id) GROUP BY host, name, labels
), d AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM c GROUP BY 1, 2
), x AS (SELECT suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM d GROUP BY 1
), base AS (SELECT CASE WHEN sum(n) > 0 THEN sum(k)::DOUBLE / sum(n)::DOUBLE ELSE 0.0 END AS m FROM x
), x0 AS (SELECT x.*, m FROM x, base
), {_level_sql("x1", "x0", "suffix")}
, d0 AS (SELECT d.*, x1.mean AS m FROM d JOIN x1 USING (suffix)
), {_level_sql("d1", "d0", "domain, suffix")}
, h0 AS (SELECT c.*, d1.mean AS m FROM c JOIN d1 USING (domain, suffix)
), {_level_sql("h1", "h0", "host")}
, q AS (
  SELECT host, m, k, greatest(s * m + k, 1.0) AS a, greatest(s * (1 - m) + n - k, 1.0) AS b FROM h1
), w AS (
  SELECT *, 2 / (1 / (2 * a - 1) + 1 / (2 * b - 1)) AS h FROM q
), v AS (
  SELECT host, CASE WHEN m > 0 OR k > 0 THEN round(a / (a + b * exp(2 * (
    {QUANTILE}::DOUBLE * sqrt(h + {_LAM}::DOUBLE) / h
    - (1 / (2 * b - 1) - 1 / (2 * a - 1)) * ({_LAM}::DOUBLE + {5.0 / 6}::DOUBLE - 2 / (3 * h))))), 6)
    ELSE 0.0 END AS bad_bound
  FROM w
), u AS (
  SELECT page_id, host, path, bad_bound,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p JOIN v USING (host)
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN bad_bound > {MOST_BAD} THEN 'block' ELSE 'allow' END AS verdict, bad_bound
FROM u
"""
