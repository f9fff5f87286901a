"""Temporal URL filtering: dated list entries become validity intervals, and captures are joined as of their fetch date.

An entry names a list, a pattern and a date on which it was put on the list or taken off. A pattern is a domain (it
covers the domain and all below it), a host with leading path segments, or a URL without query and fragment. A capture
is looked up under every pattern that could cover it, with path prefixes of those lengths that any entry has: a join on
the pattern with the fetch date inside the interval.
There are at most a few intervals per pattern, so a hot host is a skewed join of rows that stay one per capture and
pattern, which Spark splits. Nothing is forced to broadcast.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host(url: str = "url") -> Column:
    """Lower-cased host; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), HOST, 1)), F.lit(""))


def segments(url: str = "url") -> Column:
    """Path segments that aren't empty."""
    path = F.coalesce(F.regexp_extract(F.col(url), PATH, 1), F.lit(""))
    return F.filter(F.split(path, "/"), lambda s: s != "")


def depths(entries: DataFrame) -> list[int]:
    """The numbers of path segments that the patterns of ``entries`` have, but for none."""
    number = F.size(F.split("pattern", "/")) - 1
    found = entries.filter(F.col("pattern").isNotNull()).select(number.alias("depth")).distinct().collect()
    return sorted(r["depth"] for r in found if r["depth"] > 0)


def patterns(host: Column, segments: Column, depths: list[int]) -> Column:
    """All patterns that could cover a URL of this host and these segments, with paths of ``depths`` segments."""
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    paths = F.transform(
        F.filter(F.lit(depths).cast("array<int>"), lambda k: k <= F.size(segments)),
        lambda k: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, k), "/")),
    )
    whole = F.array(F.concat(host, F.lit("/"), F.array_join(segments, "/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(F.array(host), domains, paths, whole))
    )


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) from ``entries`` (list, pattern, added, on): when a pattern is on a list.

    ``valid_to`` is the first day it is off again, null while it is on. On a day with both, the entry is off. Repeated
    entries change nothing. There is at most one row per list, pattern and day, whatever the number of entries, so a
    pattern's window is bounded by the days. Entries with a null in any column take no part."""
    days = entries.select("list", "pattern", "added", "on").na.drop().groupBy("list", "pattern", "on")
    days = days.agg(F.min("added").alias("added"))
    order = Window.partitionBy("list", "pattern").orderBy("on")
    turns = days.withColumn("before", F.lag("added", 1, False).over(order)).filter("added <> before")
    turns = turns.withColumn("valid_to", F.lead("on").over(order)).filter("added")
    return turns.select("list", "pattern", F.col("on").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Per row of ``captures`` (page_id, url, fetched_on): page_id, fetched_on, host, n_block, n_allow, verdict,
    pattern, listed_on.

    n_block and n_allow count the patterns active on the fetch date that cover the URL. The longest decides, ``allow``
    among equals; ``pattern`` and ``listed_on`` (the start of its interval) are null where none does, and the verdict
    then is ``keep``. It is ``drop`` if the list is ``block``, else ``keep``. URLs without a host, and null URLs, have
    an empty host and the verdict ``invalid``; a null date meets no entry. Rows that repeat page_id, URL and date come
    back as often as they are there."""
    rows = captures.select("page_id", "url", "fetched_on").withColumn("host", host())
    keys = patterns(F.col("host"), F.col("segments"), depths(entries))
    # Equal captures are looked up once.
    wanted = rows.groupBy("page_id", "url", "fetched_on", "host").agg(F.count("*").alias("copies"))
    looked = wanted.filter("host <> '' AND fetched_on IS NOT NULL").withColumn("segments", segments())
    looked = looked.select("page_id", "url", "fetched_on", F.explode(keys).alias("pattern"))
    active = intervals(entries)
    on = (
        (looked["pattern"] == active["pattern"])
        & (looked["fetched_on"] >= active["valid_from"])
        & (active["valid_to"].isNull() | (looked["fetched_on"] < active["valid_to"]))
    )
    hits = looked.join(active, on).select("page_id", "url", "fetched_on", "list", active["pattern"], "valid_from")
    nothing = {"list": "string", "pattern": "string", "valid_from": "date", "copies": "long", "host": "string"}
    both = wanted.withColumns({c: F.lit(None).cast(nothing[c]) for c in ("list", "pattern", "valid_from")})
    both = both.unionByName(hits.withColumns({c: F.lit(None).cast(nothing[c]) for c in ("copies", "host")}))
    best = F.struct(
        F.length("pattern").alias("length"), (F.col("list") == "allow").alias("allow"), "list", "pattern", "valid_from"
    )
    found = both.groupBy("page_id", "url", "fetched_on").agg(
        F.max("host").alias("host"),
        F.max("copies").alias("copies"),
        F.count_if(F.col("list") == "block").alias("n_block"),
        F.count_if(F.col("list") == "allow").alias("n_allow"),
        F.max(F.when(F.col("pattern").isNotNull(), best)).alias("best"),
    )
    verdict = F.when(F.col("host") == "", "invalid").when(F.col("best.list") == "block", "drop").otherwise("keep")
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "page_id",
        "fetched_on",
        "host",
        "n_block",
        "n_allow",
        verdict.alias("verdict"),
        F.col("best.pattern").alias("pattern"),
        F.col("best.valid_from").alias("listed_on"),
    )


# The query: the table has neither fetch dates nor lists, so both are derived from it.

FIRST_DAY = "2024-01-01"


def _day(times: int, days: int) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(F.col("page_id") * times, F.lit(days)).cast("int"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures, fetched on days spread over a year."""
    return pages.select("page_id", "url", _day(7919, 366).alias("fetched_on"))


def entries_of(pages: DataFrame) -> DataFrame:
    """A block list and an allow list of the pages' hosts, domains, first segments, whole paths and these less their last
    segment, on and off on several days."""
    named = pages.select("page_id", host().alias("host"), segments().alias("segments")).filter("host <> ''")
    domain = F.when(F.size(F.split("host", r"\.")) > 3, F.expr("substr(host, instr(host, '.') + 1)")).otherwise(F.col("host"))
    first = F.concat("host", F.lit("/"), F.coalesce(F.get("segments", F.lit(0)), F.lit("")))
    above = F.slice("segments", F.lit(1), F.greatest(F.size("segments") - 1, F.lit(1)))
    above, whole = (F.concat("host", F.lit("/"), F.array_join(s, "/")) for s in (above, F.col("segments")))

    def some(every: int, kind: str, pattern: Column, added: bool, day: Column) -> Column:
        entry = F.struct(
            F.lit(kind).alias("list"), pattern.alias("pattern"), F.lit(added).alias("added"), day.alias("on")
        )
        return F.when(F.pmod("page_id", F.lit(every)) == 0, entry)

    entries = F.array(
        some(5, "block", F.col("host"), True, _day(31, 300)),
        some(7, "block", F.col("host"), False, _day(17, 366)),
        some(11, "block", domain, True, _day(13, 366)),
        some(13, "allow", first, True, _day(29, 300)),
        some(17, "allow", first, False, _day(37, 366)),
        some(19, "block", whole, True, _day(23, 300)),
        some(23, "allow", above, True, _day(41, 300)),
        some(29, "allow", above, False, _day(43, 366)),
    )
    return named.select(F.explode(F.array_compact(entries)).alias("e")).select("e.*")


def op3(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return evaluate(captures_of(pages), entries_of(pages))


SQL = r"""
WITH named AS (
  SELECT page_id, url, coalesce(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '') AS host,
    [x FOR x IN string_split(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), ''), '/') IF x <> ''] AS segs,
    DATE '2024-01-01' + CAST(page_id * 7919 % 366 AS INTEGER) AS fetched_on
  FROM pages),
parts AS (
  SELECT *, string_split(host, '.') AS labels,
    CASE WHEN len(string_split(host, '.')) > 3 THEN substr(host, instr(host, '.') + 1) ELSE host END AS domain,
    host || '/' || coalesce(segs[1], '') AS first, host || '/' || array_to_string(segs, '/') AS whole,
    host || '/' || array_to_string(segs[1:greatest(len(segs) - 1, 1)], '/') AS above
  FROM named),
entries AS (
  SELECT 'block' AS list, host AS pattern, true AS added, DATE '2024-01-01' + CAST(page_id * 31 % 300 AS INTEGER) AS day FROM parts WHERE host <> '' AND page_id % 5 = 0
  UNION ALL SELECT 'block', host, false, DATE '2024-01-01' + CAST(page_id * 17 % 366 AS INTEGER) FROM parts WHERE host <> '' AND page_id % 7 = 0
  UNION ALL SELECT 'block', domain, true, DATE '2024-01-01' + CAST(page_id * 13 % 366 AS INTEGER) FROM parts WHERE host <> '' AND page_id % 11 = 0
  UNION ALL SELECT 'allow', first, true, DATE '2024-01-01' + CAST(page_id * 29 % 300 AS INTEGER) FROM parts WHERE host <> '' AND page_id % 13 = 0
  UNION ALL SELECT 'allow', first, false, DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) FROM parts WHERE host <> '' AND page_id % 17 = 0
  UNION ALL SELECT 'block', whole, true, DATE '2024-01-01' + CAST(page_id * 23 % 300 AS INTEGER) FROM parts WHERE host <> '' AND page_id % 19 = 0
  UNION ALL SELECT 'allow', above, true, DATE '2024-01-01' + CAST(page_id * 41 % 300 AS INTEGER) FROM parts WHERE host <> '' AND page_id % 23 = 0
  UNION ALL SELECT 'allow', above, false, DATE '2024-01-01' + CAST(page_id * 43 % 366 AS INTEGER) FROM parts WHERE host <> '' AND page_id % 29 = 0),
days AS (SELECT list, pattern, day, bool_and(added) AS added FROM entries GROUP BY ALL),
state AS (
  SELECT c.page_id, c.list, c.pattern, arg_max(d.added, d.day) AS is_on
  FROM (SELECT DISTINCT p.page_id, p.fetched_on, e.list, e.pattern
        FROM (SELECT page_id, fetched_on, unnest(list_distinct(list_concat(
                [host], [array_to_string(labels[i:], '.') FOR i IN range(1, greatest(len(labels), 2))],
                [host || '/' || array_to_string(segs[1:k], '/') FOR k IN range(1, len(segs) + 1)],
                [host || '/' || array_to_string(segs, '/')]))) AS pattern
              FROM parts WHERE host <> '') p
        JOIN (SELECT DISTINCT list, pattern FROM days) e ON e.pattern = p.pattern) c
  JOIN days d ON d.list = c.list AND d.pattern = c.pattern AND d.day <= c.fetched_on
  GROUP BY ALL),
active AS (
  SELECT s.page_id, s.list, s.pattern,
    (SELECT min(a.day) FROM days a WHERE a.list = s.list AND a.pattern = s.pattern AND a.added AND a.day <= c.fetched_on
       AND a.day > coalesce((SELECT max(o.day) FROM days o WHERE o.list = s.list AND o.pattern = s.pattern AND NOT o.added AND o.day <= c.fetched_on), DATE '1900-01-01')) AS listed_on
  FROM state s JOIN parts c ON c.page_id = s.page_id WHERE s.is_on),
best AS (
  SELECT page_id, count(*) FILTER (list = 'block') AS n_block, count(*) FILTER (list = 'allow') AS n_allow,
    arg_max({'list': list, 'pattern': pattern, 'listed_on': listed_on}, {'n': length(pattern), 'a': list = 'allow', 'p': pattern}) AS b
  FROM active GROUP BY page_id)
SELECT p.page_id, p.fetched_on, p.host, coalesce(n_block, 0) AS n_block, coalesce(n_allow, 0) AS n_allow,
  CASE WHEN p.host = '' THEN 'invalid' WHEN b.list = 'block' THEN 'drop' ELSE 'keep' END AS verdict,
  b.pattern AS pattern, b.listed_on AS listed_on
FROM parts p LEFT JOIN best USING (page_id)
"""
