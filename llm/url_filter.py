"""URL filtering by explicit rules and, for the rest, a path-template tree.

Per host, paths are split into segments, all of them. A segment that is variable,
by its form or because its parent has very many different children, becomes a
wildcard, from the root down. Then, from the deepest level up, sibling branches
with the same rest whose labelled rates do not differ significantly from their
common rate are merged. A template is rejected if its labelled purity, smoothed by
the same path shape on other hosts and then by all labelled urls, is on the bad
side. Labels are the verdicts of the rules.

Everything is counted by distinct (host, path), so repeated urls change nothing. All
levels are looked at, however deep: one pass tells the levels where anything can be
decided, and only these get a round of their own. Prefixes and surroundings are
known by two 64-bit hashes, so rows that meet are narrow however long paths are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm._common import forget, hot_join, lower_ascii, materialise

#: verdict, host, path. The longest rule that fits holds.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: A parent with this many different children, and so many per distinct path, has a wildcard below it.
WIDE, WIDE_SHARE = 20, 0.2
#: Weight of the smoothing rates, in urls.
PRIOR = 5.0
#: Branches whose rate differs from the pooled one by less than so many standard errors are merged.
Z = 2.0
#: Levels whose wide parents are looked for in one pass. It only bounds the pass.
AT_ONCE = 16


def parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path of every url. Null urls and urls without :// have both empty."""
    at = F.locate("://", F.col("url"))
    rest = F.when(at > 0, F.substring("url", at + 3, F.length("url"))).otherwise(F.lit(""))
    x = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("_rest"))
    host = F.regexp_extract("_rest", r"^[^/?#]*", 0)
    return x.select("page_id", lower_ascii(host).alias("host"), F.regexp_extract(F.substring("_rest", F.length(host) + 1, F.length("_rest")), r"^[^?#]*", 0).alias("path"))


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """The rule (host and path as one string) and the verdict of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _segments() -> Column:
    """Path segments with variable forms replaced: digits, hex, dates and the like by {n}, the rest as it is."""
    form = F.regexp_replace(F.regexp_replace("path", r"[0-9a-fA-F]{8,}(?:-[0-9a-fA-F]{4,}){0,4}", "{x}"), r"[0-9]+", "{n}")
    return F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(form, "^/", ""), "/"))


def _with(level: int, value: Column) -> Column:
    """segments with another value at a level (from 1)."""
    return F.transform("segments", lambda s, i: F.when(i == level - 1, value).otherwise(s))


def _two(name: str, *of: Column) -> list[Column]:
    """Two hashes of the columns, as name1 and name2."""
    return [F.xxhash64(*of).alias(f"{name}1"), F.xxhash64(F.lit(name), *of).alias(f"{name}2")]


def _up(level: Column) -> list[Column]:
    return _two("up", F.col("host"), F.slice("segments", 1, level - 1))


def _crowds(x: DataFrame, first: int, scratch: list[str]) -> DataFrame:
    """level, up1, up2, k (different children), paths, of the parents of AT_ONCE levels from `first` on that have as many rows as a wide one needs."""
    levels = F.sequence(F.lit(first), F.least(F.size("segments"), F.lit(first + AT_ONCE - 1)))
    deep = x.where(F.size("segments") >= first).select("host", "segments", "paths", F.explode(levels).alias("level"))
    kids = deep.select("level", *_up(F.col("level")), F.xxhash64(F.get("segments", F.col("level") - 1)).alias("here"), "paths")
    kids = kids.groupBy("level", "up1", "up2", "here").agg(F.sum("paths").alias("paths"), F.count("*").alias("n"))
    crowd = kids.groupBy("level", "up1", "up2").agg(F.count("*").alias("k"), F.sum("paths").alias("paths"), F.sum("n").alias("n")).where(F.col("n") >= WIDE)
    return materialise(crowd, "url-crowds", scratch)


def _wildcards(x: DataFrame, rows: int, scratch: list[str]) -> DataFrame:
    """x with * wherever the parent has very many different children, by distinct paths, from the root down.

    A wide parent's child changes what lies below, so levels after it are looked at
    again. Where no parent has rows enough to be wide, none below has.
    """
    wide = (F.col("k") >= WIDE) & (F.col("k") >= WIDE_SHARE * F.col("paths"))
    first = 1
    while True:
        crowds = _crowds(x, first, scratch)
        deepest, level = crowds.agg(F.max("level"), F.min(F.when(wide, F.col("level")))).first()
        if level is not None:
            found = hot_join(x.select("*", *_up(F.lit(level))), crowds.where(wide & (F.col("level") == level)).select("up1", "up2", F.col("n").alias("size"), F.lit(True).alias("wide")), ["up1", "up2"], "size", "left", total=rows)
            star = F.when(F.col("wide") & (F.size("segments") >= level), _with(level, F.lit("*"))).otherwise(F.col("segments"))
            first = level + 1
            x = materialise(found.withColumn("segments", star).select(*x.columns), "url-wild", scratch)
        elif deepest is None or deepest < first + AT_ONCE - 1:
            return x
        else:
            first += AT_ONCE


def _around(level: Column, here: Column, n: int) -> Column:
    """A hash of the segments of other levels: all segments' hashes by exclusive or, without this one's."""
    one = lambda s, i: F.xxhash64(F.lit(n), i, s)
    every = F.aggregate(F.transform("segments", lambda s, i: one(s, i + 1)), F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))
    return every.bitwiseXOR(one(here, level))


def _siblings(x: DataFrame) -> list[Column]:
    """level, around1, around2, here: of x with `level` and `segment`; siblings share level and around."""
    level, segment = F.col("level"), F.col("segment")
    around = [F.xxhash64("host", F.size("segments"), _around(level, segment, n)).alias(f"around{n}") for n in (1, 2)]
    return [level, *around, F.xxhash64(segment).alias("here")]


def _pools(x: DataFrame, below: int | None, scratch: list[str]) -> DataFrame:
    """level, around1, around2, kids, pool_bad, pool_seen: siblings of more than one kind, of the levels before `below`."""
    each = x.select("*", F.posexplode("segments").alias("_i", "segment")).withColumn("level", F.col("_i") + 1)
    each = each.where(F.col("level") < below) if below is not None else each
    kinds = each.select(*_siblings(each), "bad", "good").groupBy("level", "around1", "around2", "here").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    pool = kinds.groupBy("level", "around1", "around2").agg(F.count("*").alias("kids"), F.sum("bad").alias("pool_bad"), F.sum(F.col("bad") + F.col("good")).alias("pool_seen")).where("kids > 1")
    return materialise(pool, "url-pools", scratch)


def _merged(x: DataFrame, rows: int, scratch: list[str]) -> DataFrame:
    """x with * for siblings whose rate is not far from their common one, from the deepest level up; a lone branch stays, and so does one that is far."""
    seen = F.col("bad") + F.col("good")
    rate = F.try_divide(F.col("pool_bad"), F.col("pool_seen"))
    apart = F.pow(F.try_divide(F.col("bad"), seen) - rate, F.lit(2)) > F.try_divide(F.lit(Z * Z) * rate * (1 - rate), seen)
    on, level, pools = ["around1", "around2"], None, None
    while True:
        pools = _pools(x, level, scratch) if pools is None else pools
        level = pools.where(F.col("level") < level if level is not None else F.lit(True)).agg(F.max("level")).first()[0]
        if level is None:
            return x
        deep = x.where(F.size("segments") >= level).withColumns({"level": F.lit(level), "segment": F.get("segments", F.lit(level - 1))})
        branch = deep.select(*_siblings(deep), "bad", "good").groupBy(*on, "here").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("size"))
        alike = hot_join(branch, pools.where(F.col("level") == level).drop("level"), on, "kids", total=rows).where(~F.coalesce(apart, F.lit(False)))
        alike = materialise(alike.select(*on, "here", "size", F.lit(True).alias("alike")), "url-alike", scratch)
        if alike.isEmpty():
            continue
        keyed = x.withColumns({"level": F.lit(level), "segment": F.get("segments", F.lit(level - 1))})
        found = hot_join(keyed.select(*x.columns, *_siblings(keyed)[1:]), alike, [*on, "here"], "size", "left", total=rows)
        star = F.when(F.col("alike") & (F.size("segments") >= level), _with(level, F.lit("*"))).otherwise(F.col("segments"))
        pools = None
        x = materialise(found.withColumn("segments", star).select(*x.columns), "url-merged", scratch)


def templates(counts: DataFrame, scratch: list[str]) -> DataFrame:
    """source1, source2, template, p (smoothed share of blocked paths), rows. counts: source1, source2, host, segments (as they are), paths, bad, good, rows."""
    rows, bad, good = counts.agg(F.count("*"), F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    x = _wildcards(counts, rows, scratch)
    x = x.select("*", *_two("shape", F.col("segments")))
    x = _merged(x, rows, scratch)
    x = x.select("*", *_two("node", F.col("host"), F.col("segments")))
    node = materialise(x.groupBy("node1", "node2").agg(F.sum("bad").alias("node_bad"), F.sum("good").alias("node_good"), F.count("*").alias("size")), "url-nodes", scratch)
    shape = materialise(x.groupBy("shape1", "shape2").agg(F.sum("bad").alias("shape_bad"), F.sum("good").alias("shape_good"), F.count("*").alias("size")), "url-shapes", scratch)
    p0 = F.lit((bad + 1) / (bad + good + 2))
    p1 = (F.col("shape_bad") + PRIOR * p0) / (F.col("shape_bad") + F.col("shape_good") + PRIOR)
    p2 = (F.col("node_bad") + PRIOR * p1) / (F.col("node_bad") + F.col("node_good") + PRIOR)
    x = hot_join(hot_join(x, node, ["node1", "node2"], "size", total=rows).drop("size"), shape, ["shape1", "shape2"], "size", total=rows).drop("size")
    return x.select("source1", "source2", F.concat(F.lit("/"), F.array_join("segments", "/")).alias("template"), p2.alias("p"), "rows")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, p_block for every row of pages.

    Null urls and urls without a host fit no rule and are judged by their (empty)
    template. Repeated rows get equal verdicts; of rules of one length the later one
    by name holds; an empty table gives no rows; where no url is labelled, all are
    allowed; other columns are ignored.
    """
    scratch: list[str] = []
    name, verdict = rule_of(rules)
    x = parts(pages).select("*", name.alias("rule"), verdict.alias("_verdict"), _segments().alias("segments"))
    x = materialise(x.select("*", *_two("source", F.col("host"), F.col("segments"))).drop("segments"), "url-parts")
    paths = x.groupBy("source1", "source2", "host", "path", "_verdict").agg(F.count("*").alias("rows"))
    counts = paths.groupBy("source1", "source2").agg(F.first("host").alias("host"), F.first("path").alias("path"), F.count("*").alias("paths"), F.count(F.when(F.col("_verdict") == "block", 1)).alias("bad"), F.count(F.when(F.col("_verdict") == "allow", 1)).alias("good"), F.sum("rows").alias("rows"))
    counts = materialise(counts.withColumn("segments", _segments()).drop("path"), "url-counts", scratch)
    found = materialise(templates(counts, scratch), "url-templates")
    forget(pages.sparkSession, scratch)
    by_method = F.when(F.col("p") > 0.5, "block").otherwise("allow")
    return hot_join(x, found, ["source1", "source2"], "rows").select("page_id", "host", "path", "rule", F.coalesce("_verdict", by_method).alias("verdict"), "template", F.col("p").alias("p_block"))


def _sql(levels: int) -> str:
    """The same in SQL: a pair of steps for each level."""
    out = [r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(substr(rest, length(raw) + 1), ''), '^[^?#]*') AS path FROM h),
r AS (SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM p),
x AS (SELECT *, CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 1 ELSE 0 END AS bad,
             CASE WHEN rule IN ('org/', 'com/fr/') THEN 1 ELSE 0 END AS good,
             regexp_replace(regexp_replace(path, '[0-9a-fA-F]{8,}(?:-[0-9a-fA-F]{4,}){0,4}', '{x}', 'g'), '[0-9]+', '{n}', 'g') AS form FROM r),
s AS (SELECT * EXCLUDE form, CASE WHEN path = '' THEN []::VARCHAR[] ELSE string_split(regexp_replace(form, '^/', ''), '/') END AS src FROM x),
w0 AS MATERIALIZED (SELECT host, src, src AS seg, count(*) AS paths, sum(bad) AS bad, sum(good) AS good FROM (SELECT DISTINCT host, src, path, bad, good FROM s) GROUP BY ALL)"""]
    for k in range(1, levels + 1):
        star = f"list_concat(seg[1:{k - 1}], ['*'], seg[{k + 1}:])"
        out.append(f"""
k{k} AS MATERIALIZED (SELECT host, up FROM (SELECT host, seg[1:{k - 1}] AS up, seg[{k}] AS c, sum(paths) AS n FROM w{k - 1} WHERE len(seg) >= {k} GROUP BY ALL) GROUP BY ALL HAVING count(*) >= {WIDE} AND count(*) >= {WIDE_SHARE} * sum(n)),
w{k} AS MATERIALIZED (SELECT w.* EXCLUDE seg, CASE WHEN len(seg) >= {k} AND k.host IS NOT NULL THEN {star} ELSE seg END AS seg FROM w{k - 1} w LEFT JOIN k{k} k ON w.host = k.host AND w.seg[1:{k - 1}] = k.up)""")
    out.append(f"""
m{levels + 1} AS MATERIALIZED (SELECT *, seg AS shape FROM w{levels})""")
    for k in range(levels, 0, -1):
        star = f"list_concat(seg[1:{k - 1}], ['*'], seg[{k + 1}:])"
        out.append(f"""
b{k} AS MATERIALIZED (SELECT host, seg[1:{k - 1}] AS up, seg[{k + 1}:] AS below, seg[{k}] AS c, sum(bad) AS b, sum(bad) + sum(good) AS n FROM m{k + 1} WHERE len(seg) >= {k} GROUP BY ALL),
q{k} AS MATERIALIZED (SELECT host, up, below, c FROM (SELECT *, count(*) OVER w AS kids, sum(b) OVER w AS pb, sum(n) OVER w AS pn FROM b{k} WINDOW w AS (PARTITION BY host, up, below))
  WHERE kids > 1 AND NOT coalesce(power(b / nullif(n, 0) - pb / nullif(pn, 0), 2) > {Z * Z} * (pb / nullif(pn, 0)) * (1 - pb / nullif(pn, 0)) / nullif(n, 0), false)),
m{k} AS MATERIALIZED (SELECT m.* EXCLUDE seg, CASE WHEN q.host IS NOT NULL THEN {star} ELSE seg END AS seg FROM m{k + 1} m LEFT JOIN q{k} q ON m.host = q.host AND m.seg[1:{k - 1}] = q.up AND m.seg[{k + 1}:] = q.below AND m.seg[{k}] = q.c AND len(m.seg) >= {k})""")
    out.append(f"""
c AS (SELECT *, sum(bad) OVER nd AS nb, sum(good) OVER nd AS ng, sum(bad) OVER sh AS sb, sum(good) OVER sh AS sg, sum(bad) OVER () AS ab, sum(good) OVER () AS ag
      FROM m1 WINDOW nd AS (PARTITION BY host, seg), sh AS (PARTITION BY shape)),
pf AS (SELECT host, src, '/' || array_to_string(seg, '/') AS template,
        (nb + {PRIOR}::DOUBLE * ((sb + {PRIOR}::DOUBLE * ((ab + 1)::DOUBLE / (ab + ag + 2))) / (sb + sg + {PRIOR}::DOUBLE))) / (nb + ng + {PRIOR}::DOUBLE) AS p FROM c)
SELECT page_id, s.host, path, rule,
  CASE WHEN bad = 1 THEN 'block' WHEN good = 1 THEN 'allow' WHEN p > 0.5 THEN 'block' ELSE 'allow' END AS verdict, coalesce(template, '/') AS template, p AS p_block
FROM s JOIN pf ON s.host = pf.host AND s.src = pf.src
""")
    return ",".join(out)


#: The given urls have at most four segments, so more levels would only be empty steps.
SQL = _sql(6)
