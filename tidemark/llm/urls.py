"""URL filters as a temporal join (DataFrame and SQL functions only).

List entries are dated: at ``listed_at`` a pattern gets an action (``block``,
``allow`` or ``remove``). The entries of a pattern, by date, become validity
intervals [listed_at, next listed_at); ``remove`` ends the previous interval and
opens none. A capture is judged by the intervals that hold at its fetch time.

Patterns are a host suffix (``example.org``, matching the host and its
subdomains) or a host with a path prefix ending in a slash
(``www.example.org/shop/``). A capture's URL is turned into the patterns that
could match it, no deeper than the deepest listed pattern, so the as-of
condition rides on an equi-join: pattern = pattern and listed_at <= fetched_at <
until. Intervals of a pattern do not overlap, so a pattern gives a capture at
most one match. The longest matching pattern decides; ``allow`` wins over
``block`` at equal length, which only two lists with one pattern can cause.

Distinct (host, path, fetch time) triples are judged, not rows, and only the
patterns that some entry names are joined; a host with a third of all captures
is spread by its paths, and the final join back by URL is left to the engine's
skew handling. Verdicts of captures without a match are ``none``.

Defined results: a null or unparsable URL, or a null fetch time, is judged
``none``; scheme, user, port, query and fragment are ignored, hosts compare in
lower case without a trailing dot, a bracketed address is one label, paths in lower case; entries with a null pattern or date are
ignored; two entries of a pattern at one time: ``allow``, then ``block``, then
``remove`` takes effect; repeated captures each get the verdict; no entries, no
matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import nest, table, unnest

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^/?#@\]]*\]|[^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    """Lower-case host without a trailing dot; empty where there is none."""
    return F.regexp_replace(F.lower(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit(""))), r"\.$", "")


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def validity(entries: DataFrame) -> DataFrame:
    """(pattern, action, since, until) from dated entries (pattern, action, listed_at)."""
    rank = F.when(F.col("action") == "allow", 0).when(F.col("action") == "block", 1).otherwise(2)
    one = (entries.filter("pattern IS NOT NULL AND listed_at IS NOT NULL")
           .groupBy(F.lower("pattern").alias("pattern"), F.col("listed_at").alias("since"))
           .agg(F.min_by("action", rank).alias("action")))
    by_date = Window.partitionBy("pattern").orderBy("since")
    return one.withColumn("until", F.lead("since").over(by_date)).filter(F.col("action").isin("allow", "block"))


def patterns(host_col: str, path_col: str, labels: int, depth: int) -> Column:
    """Host suffixes of at most ``labels`` labels and path prefixes of at most ``depth`` folders."""
    return F.expr(f"""
      transform(array(named_struct('h', split({host_col}, '[.]'), 'p', split({path_col}, '/'))), s ->
        concat(
          transform(sequence(1, greatest(1, least(size(s.h), {labels}))),
                    i -> array_join(slice(s.h, size(s.h) - i + 1, i), '.')),
          IF({depth} = 0 OR size(s.p) < 2, array(), transform(sequence(1, greatest(1, least(size(s.p) - 1, {depth}))),
                    i -> concat({host_col}, array_join(slice(s.p, 1, i), '/'), '/')))))[0]""")


def judge(captures: DataFrame, entries: DataFrame, *, url_col: str = "url", time_col: str = "fetched_at",
          keep: list[str] | None = None) -> DataFrame:
    """Add verdict (allow, block or none) and rule (the deciding pattern) to the ``keep`` columns (default: all)."""
    keep = captures.columns if keep is None else keep
    spans = validity(entries)
    suffix = F.size(F.split(F.split("pattern", "/")[0], "[.]"))
    depth = F.size(F.split("pattern", "/")) - 1
    # The listed patterns' depths bound what is generated for a URL, however long it is.
    most = spans.agg(F.coalesce(F.max(suffix), F.lit(1)).alias("labels"),
                     F.coalesce(F.max(depth), F.lit(0)).alias("depth")).first()
    rows = nest(captures, keep, _host=host(F.col(url_col)), _path=path(F.col(url_col)), _time=F.col(time_col))
    # Only the folders that a pattern could name matter: cut the path there.
    parts = F.split(F.lower("_path"), "/")
    rows = rows.withColumn("_path", F.when(F.lit(most.depth == 0) | (F.size(parts) < 2), "").otherwise(F.concat(
        F.array_join(F.slice(parts, 1, F.least(F.size(parts) - 1, F.lit(most.depth))), "/"), F.lit("/"))))
    places = rows.select("_host", "_path", "_time").filter("_host <> '' AND _time IS NOT NULL").distinct()
    asked = places.withColumn("pattern", F.explode(F.array_distinct(patterns("_host", "_path", most.labels, most.depth))))
    matched = (asked.join(spans, "pattern").filter("since <= _time AND (until IS NULL OR _time < until)")
               .groupBy("_host", "_path", "_time")
               .agg(F.min(F.struct((-F.length("pattern")).alias("l"), F.col("action"), F.col("pattern"))).alias("m"))
               .select("_host", "_path", "_time", F.col("m.action").alias("_action"), F.col("m.pattern").alias("_rule")))
    out = rows.join(matched, ["_host", "_path", "_time"], "left")
    return unnest(out, keep, verdict=F.coalesce(F.col("_action"), F.lit("none")), rule=F.col("_rule"))


def op10_url_filters(spark, sf_dir):
    """Captures and lists both derive from ``pages``: a page is fetched on the day that its id gives, and a
    hash of each host dates the entries for the host, its language folders and its parent domain."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = spark.sql("SELECT page_id, url, date_add(DATE '2024-01-01', CAST(page_id % 366 AS INT)) AS fetched_at "
                         "FROM {pages}", pages=pages)
    h = (pages.select(host(F.col("url")).alias("host")).filter("host <> ''").distinct()
         .withColumn("k", F.conv(F.substring(F.md5("host"), 1, 7), 16, 10).cast("long")))
    entries = spark.sql("""
        SELECT host AS pattern, inline(array(
            struct(k % 3 = 0 AS used, '' AS folder, 'block' AS action, date_add(DATE '2024-01-01', CAST(k % 200 AS INT)) AS listed_at),
            struct(k % 6 = 0 AS used, '' AS folder, 'remove' AS action, date_add(DATE '2024-01-01', CAST(k % 200 + 60 AS INT)) AS listed_at),
            struct(k % 12 = 0 AS used, '' AS folder, 'block' AS action, date_add(DATE '2024-01-01', CAST(k % 200 + 120 AS INT)) AS listed_at),
            struct(k % 2 = 0 AS used, '/en/' AS folder, 'allow' AS action, date_add(DATE '2024-01-01', CAST(k % 90 AS INT)) AS listed_at),
            struct(k % 5 = 0 AS used, '/de/' AS folder, 'block' AS action, date_add(DATE '2024-01-01', CAST(k % 150 AS INT)) AS listed_at))) FROM {h}""", h=h)
    parents = (h.filter("k % 7 = 0 AND host LIKE '%.%.%.%'")
               .select(F.regexp_replace("host", "^[^.]*[.]", "").alias("pattern"), F.lit("block").alias("action"),
                       F.to_date(F.lit("2024-10-01")).alias("listed_at")).distinct())
    listed = entries.filter("used").select(F.concat("pattern", "folder").alias("pattern"), "action", "listed_at")
    return judge(captures, listed.unionByName(parents), keep=["page_id", "url", "fetched_at"]).select(
        "page_id", host(F.col("url")).alias("host"), "fetched_at", "verdict", "rule",
        (F.col("verdict") != "block").alias("kept"))


ORACLE = r"""
WITH c AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INT) AS fetched_at,
         regexp_replace(lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:@]+)', 1), '')), '\.$', '') AS host,
         lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '')) AS path FROM pages),
h AS (SELECT host, CAST('0x' || substr(md5(host), 1, 7) AS BIGINT) AS k FROM (SELECT DISTINCT host FROM c WHERE host <> '')),
e AS (
  SELECT host AS pattern, 'block' AS action, DATE '2024-01-01' + CAST(k % 200 AS INT) AS listed_at FROM h WHERE k % 3 = 0
  UNION ALL SELECT host, 'remove', DATE '2024-01-01' + CAST(k % 200 + 60 AS INT) FROM h WHERE k % 6 = 0
  UNION ALL SELECT host, 'block', DATE '2024-01-01' + CAST(k % 200 + 120 AS INT) FROM h WHERE k % 12 = 0
  UNION ALL SELECT host || '/en/', 'allow', DATE '2024-01-01' + CAST(k % 90 AS INT) FROM h WHERE k % 2 = 0
  UNION ALL SELECT host || '/de/', 'block', DATE '2024-01-01' + CAST(k % 150 AS INT) FROM h WHERE k % 5 = 0
  UNION ALL SELECT DISTINCT regexp_replace(host, '^[^.]*[.]', ''), 'block', DATE '2024-10-01' FROM h
    WHERE k % 7 = 0 AND host LIKE '%.%.%.%'),
one AS (SELECT pattern, listed_at AS since, min_by(action, CASE action WHEN 'allow' THEN 0 WHEN 'block' THEN 1 ELSE 2 END) AS action
        FROM e GROUP BY ALL),
v AS (SELECT * FROM (SELECT *, lead(since) OVER (PARTITION BY pattern ORDER BY since) AS until FROM one) WHERE action <> 'remove'),
m AS (SELECT c.page_id, c.url, c.fetched_at, v.action, v.pattern,
             row_number() OVER (PARTITION BY c.page_id, c.url ORDER BY length(v.pattern) DESC, v.action, v.pattern) AS r
      FROM c JOIN v ON (c.host = v.pattern OR ends_with(c.host, '.' || v.pattern)
                        OR (contains(v.pattern, '/') AND starts_with(c.host || c.path, v.pattern)))
       AND v.since <= c.fetched_at AND (v.until IS NULL OR c.fetched_at < v.until))
SELECT c.page_id, c.host, c.fetched_at, coalesce(m.action, 'none') AS verdict, m.pattern AS rule,
       coalesce(m.action, 'none') <> 'block' AS kept
FROM c LEFT JOIN m ON m.r = 1 AND c.page_id = m.page_id AND c.url IS NOT DISTINCT FROM m.url
"""
