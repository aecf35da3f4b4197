"""URL filters (operator 11): allow and block rules, and a logistic regression for the rest.

A rule is ``host/path``; it fits its host and all subdomains where the url's path
starts with the rule's, and the longest that fits decides.  What no rule decides is
judged by logistic regression on hashed character 3- and 4-grams of host and path.
The model is trained on a small table of labelled urls, in the dual: one weight for
each labelled url over the products of their features, all steps within one row.
From there every bucket gets its weight, so that scoring is one pass of column
functions over the urls: no shuffle, no Python, and only ``BUCKETS`` numbers pass
the driver.

Edge cases: a null url, or one without ``://``, has an empty host and path, which no
rule fits; such rows are judged by the model's bias.  Urls of any length count
whole.  Repeated rows each have their result, extra columns are ignored, an empty
table gives an empty one.  A labelled table that is empty blocks nothing, and null or
other labels in it take no part.  Of rules of equal length the one with the longer
host decides, then the block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hash buckets (a prime), lengths of the grams, and a factor for each of their characters.
BUCKETS = 4093
GRAMS = (3, 4)
FACTORS = (7919, 104_729, 1_299_709, 15_485_863)
#: Training: steps, their size, and the share that a weight loses in each.
STEPS, RATE, DECAY = 100, 0.5, 0.002
#: Rules and labelled urls at most: both are small tables by contract, larger ones are an error.
MOST_RULES, MOST_LABELLED = 256, 512

#: The rules that the query applies.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

#: Labelled urls that the query's model is trained on.
LABELLED = (
    ("https://www.riverside-library.net/en/1204", "allow"),
    ("https://blog.mountainview.net/de/77.html", "allow"),
    ("http://m.gardenweekly.com/en/5120/", "allow"),
    ("https://therivers.com/en/3021?page=2", "allow"),
    ("https://www.thatrain.net/fr/918", "allow"),
    ("http://tionary.example.net/en/6021.html", "allow"),
    ("https://history.museum-guide.com/es/2210", "allow"),
    ("https://www.townhall.net/de/4416/", "allow"),
    ("http://blog.teacherroom.com/en/808.html", "allow"),
    ("https://m.weatherstation.net/es/3345", "allow"),
    ("https://recipes.kitchenbook.com/en/1900#top", "allow"),
    ("https://science.starcharts.net/en/7421", "allow"),
    ("http://www.thestory.com/es/5105/", "allow"),
    ("https://docs.handbook.net/en/650.html", "allow"),
    ("https://thistle.example.com/en/8118", "allow"),
    ("http://forum.birdwatch.net/de/9002", "allow"),
    ("https://m.sthethin.com/en/2718.html", "allow"),
    ("https://blog.thering.example.net/fr/612", "allow"),
    ("https://www.casino-royal.com/en/1204", "block"),
    ("http://m.best-casino.net/de/77.html", "block"),
    ("https://casino-jackpot.example.net/en/5120/", "block"),
    ("https://win-big-casino.com/es/3021", "block"),
    ("http://www.online-bets.net/en/918", "block"),
    ("https://bets-today.com/en/6021.html", "block"),
    ("https://m.free-spins.net/es/2210", "block"),
    ("http://free-money.example.com/en/4416/", "block"),
    ("https://www.diet-pills.com/en/808.html", "block"),
    ("https://pills-shop.net/de/3345", "block"),
    ("http://cheap-meds.com/en/1900", "block"),
    ("https://blog.cheap-watches.net/fr/7421", "block"),
    ("https://ads-click.example.com/en/5105/", "block"),
    ("http://m.ads-banner.net/en/650.html", "block"),
    ("https://track-pixel.com/es/8118", "block"),
    ("https://www.click-track.net/en/9002", "block"),
    ("http://win-prize.com/en/2718.html", "block"),
    ("https://lucky-win.net/fr/612", "block"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "^([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where it is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, _PARTS, 1), _UPPER, _LOWER), F.regexp_extract(rest, _PARTS, 2)


def decide(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} are tested row by row")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The shortest comes first, so that every longer one is asked before it.
    for text, says in sorted(set(rules), key=lambda r: (len(r[0]), len(r[0].partition("/")[0]), r[1] == "block")):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def buckets(host: Column, path: Column) -> Column:
    """The distinct hash buckets of all grams of ``^host path$``."""
    points = F.transform(F.split(F.concat(F.lit("^"), host, path, F.lit("$")), ""), lambda c: F.ascii(c).cast("long"))

    def grams(p: Column, n: int) -> Column:
        hashed = lambda i: sum((F.get(p, i + k) * FACTORS[k] for k in range(1, n)), F.get(p, i) * FACTORS[0]) + n
        return F.when(F.size(p) >= n, F.transform(F.sequence(F.lit(0), F.size(p) - n), lambda i: (hashed(i) % BUCKETS).cast("int"))).otherwise(F.array().cast("array<int>"))

    # One element, so that the points are computed once for all grams.
    return F.transform(F.array(points), lambda p: F.array_distinct(F.concat(*[grams(p, n) for n in GRAMS])))[0]


def train(labelled: DataFrame) -> list[float]:
    """The bias and the weight of every bucket, from (url, verdict) rows; positive means block."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.where("verdict in ('allow', 'block')").groupBy("url", "verdict").count()
    n = rows.count()
    if n > MOST_LABELLED:
        raise ValueError(f"{n} labelled urls; at most {MOST_LABELLED} are trained on")
    one = F.struct("url", "verdict", buckets(host, path).alias("b"))
    x = rows.groupBy().agg(F.sort_array(F.collect_list(one)).alias("all"))
    dot = lambda u, v: 1.0 + F.size(F.array_intersect(u["b"], v["b"])) / F.sqrt(F.greatest(F.lit(1), F.size(u["b"])).cast("double") * F.greatest(F.lit(1), F.size(v["b"])))
    # An aggregate of one row, so that the products are made once and not within every step.
    x = x.groupBy().agg(F.first("all").alias("x"), F.first(F.transform("all", lambda u: F.transform("all", lambda v: dot(u, v)))).alias("g"))

    def step(a: Column, _: Column) -> Column:
        def moved(row: Column, i: Column) -> Column:
            margin = F.aggregate(F.zip_with(row, a, lambda k, w: k * w), F.lit(0.0), lambda s, p: s + p)
            y = F.when(F.get(F.col("x"), i)["verdict"] == "block", 1.0).otherwise(0.0)
            return F.get(a, i) * (1 - DECAY) + RATE * (y - 1.0 / (1.0 + F.exp(-margin)))

        return F.transform("g", moved)

    fitted = x.select("x", F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.transform("x", lambda _: F.lit(0.0)), step).alias("a"))
    each = fitted.select(F.explode(F.arrays_zip("x", "a")).alias("r"))
    share = each.select(F.col("r.a").alias("w"), F.explode(F.concat(F.array(F.lit(-1)), F.col("r.x.b"))).alias("b"), F.size("r.x.b").alias("n"))
    weights = [0.0] * (BUCKETS + 1)
    for r in share.groupBy("b").agg(F.sum(F.when(F.col("b") < 0, F.col("w")).otherwise(F.col("w") / F.sqrt("n"))).alias("w")).collect():  # BUCKETS + 1 rows at most
        weights[r["b"] + 1] = r["w"]
    return weights


def score(found: Column, weights: list[float]) -> Column:
    """The probability of block for the buckets ``found``."""
    table = F.expr(f"array({','.join(f'{w!r}D' for w in weights[1:])})")
    total = F.aggregate(found, F.lit(0.0), lambda s, b: s + F.get(table, b))
    return 1.0 / (1.0 + F.exp(-(F.lit(weights[0]) + total / F.sqrt(F.greatest(F.size(found), F.lit(1))))))


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict and score (of urls that no rule decides) for every row."""
    weights = train(labelled)
    host, path = host_and_path(F.col("url"))
    rule, says = decide(F.col("host"), F.col("path"), rules)
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    ruled = parts.select("*", rule.alias("rule"), says.alias("says"))
    judged = ruled.withColumn("score", F.when(F.col("says").isNull(), score(buckets(F.col("host"), F.col("path")), weights)))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("says", F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"), "score")


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.sql(f"VALUES {', '.join(str(row) for row in LABELLED)} AS t(url, verdict)")


def oracle_sql() -> str:
    """The same in DuckDB's SQL: rules, training by the same steps, and verdicts."""
    values = lambda rows: ", ".join(f"('{a}', '{b}')" for a, b in rows)
    gram = lambda n: f"list_transform(range(1, len(p) - {n} + 2), lambda i: ({' + '.join(f'p[i + {k}] * {FACTORS[k]}' for k in range(n))} + {n}) % {BUCKETS})"
    split = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    return f"""
WITH RECURSIVE urls AS (
  SELECT 0 AS kind, page_id, url, NULL::VARCHAR AS verdict FROM pages
  UNION ALL SELECT DISTINCT 1, NULL, url, verdict FROM (VALUES {values(LABELLED)}) l(url, verdict)),
parts AS (
  SELECT *, translate(regexp_extract({split}, '{_PARTS}', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract({split}, '{_PARTS}', 2) AS path FROM urls),
points AS (
  SELECT *, list_transform(range(1, length('^' || host || path || '$') + 1), lambda i: unicode(substr('^' || host || path || '$', i, 1))::BIGINT) AS p FROM parts),
grams AS MATERIALIZED (
  SELECT kind, page_id, url, verdict, host, path, list_distinct(list_concat({gram(3)}, {gram(4)})) AS b FROM points),
known AS (SELECT row_number() OVER (ORDER BY url, verdict) AS i, (verdict = 'block')::INT AS y, b FROM grams WHERE kind = 1),
products AS (
  SELECT u.i, u.y, list(1.0 + len(list_intersect(u.b, v.b)) / sqrt(greatest(1, len(u.b))::DOUBLE * greatest(1, len(v.b))) ORDER BY v.i) AS k
  FROM known u, known v GROUP BY u.i, u.y),
gram_matrix AS (SELECT list(k ORDER BY i) AS g, list(y ORDER BY i) AS y FROM products),
steps AS (
  SELECT 0 AS t, list_transform(y, lambda v: 0.0::DOUBLE) AS a FROM gram_matrix
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(y) + 1), lambda i: a[i] * {1 - DECAY!r} + {RATE!r} * (y[i] - 1.0 / (1.0 + exp(-list_dot_product(g[i], a)))))
  FROM steps, gram_matrix WHERE t < {STEPS}),
fitted AS (SELECT unnest(range(1, len(a) + 1)) AS i, unnest(a) AS a FROM steps WHERE t = {STEPS}),
weights AS (
  SELECT b, sum(a / sqrt(n)) AS w FROM (SELECT a, len(b) AS n, unnest(b) AS b FROM fitted JOIN known USING (i)) GROUP BY b),
distinct_parts AS (SELECT DISTINCT host, path, b FROM grams WHERE kind = 0),
margins AS (
  SELECT host, path, (SELECT sum(a) FROM fitted) + coalesce(sum(w), 0) / sqrt(greatest(any_value(n), 1)) AS margin
  FROM (SELECT host, path, len(b) AS n, unnest(CASE WHEN len(b) > 0 THEN b ELSE [-1] END) AS b FROM distinct_parts) LEFT JOIN weights USING (b) GROUP BY host, path),
rules AS (SELECT rule, verdict, split_part(rule, '/', 1) AS own, substr(rule, strpos(rule, '/')) AS start FROM (VALUES {values(RULES)}) r(rule, verdict)),
ruled AS (
  SELECT d.host, d.path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM distinct_parts d JOIN rules r ON (d.host = r.own OR ends_with(d.host, '.' || r.own)) AND starts_with(d.path, r.start) GROUP BY d.host, d.path)
SELECT p.page_id, p.host, p.path, r.rule, coalesce(r.verdict, CASE WHEN m.margin > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p JOIN margins m USING (host, path) LEFT JOIN ruled r USING (host, path) WHERE p.kind = 0"""
