"""Operator 9 [native]: URL filters as a sort-merge range join.

A rule is a host and a path prefix. Its canonical key is the reversed host, a
slash and the path, so that all urls it fits on its own host lie in one interval
of keys that begins at the rule. A url has a key for each suffix of its host
(as many as it has labels), which is how a rule reaches subdomains.

Rules are dealt out in key order and swept in blocks of `BLOCK` with a stack of
those still open; a block begins with the rules that are prefixes of its first
key (as many as that key has characters at most), so no host's rules are
gathered in one place. Each rule keeps the stack at its start, that is itself
and all rules it is nested in.

Rules and url keys are then dealt out together by ranges of their key, a rule
before the urls of the same key. In each range one sorted sweep carries the last
rule passed; a range begins with the last rule of those before it, one row a
range. Any rule whose interval holds a key is on that rule's stack; the longest
that fits wins.

Only distinct (host, path) are swept, so a url in a third of all rows is one
row; its verdict is sent to several tasks when it is joined back to the pages.

Defined cases: a null url, or one without ://, has empty host and path; an
unfitted url has rule null and the default verdict; equal rules are one, and
block beats allow; repeated rows are judged alike; columns named host, path, rule
or verdict are replaced, any other is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lathe.llm.common import lower_ascii, spread_join, staged, table

# The rules of the query.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
DEFAULT = "allow"
#: Rules swept at once.
BLOCK = 64


def _rest(url: Column) -> Column:
    """What follows the first ://, else the empty text."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_rest(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _key(labels: Column, path: Column) -> Column:
    """Labels of a host from the last to the first, and a path."""
    return F.concat(F.array_join(labels, "."), F.lit("/"), path)


def swept(rules: DataFrame) -> DataFrame:
    """Rules (rule, verdict) as (key, stack); stack holds the open rules (key, rule, verdict) at the rule's start, itself last."""
    r = rules.select(F.col("rule"), "verdict", F.instr("rule", "/").alias("at"))
    r = r.select(lower_ascii(F.expr("substring(rule, 1, at - 1)")).alias("host"), F.expr("substring(rule, at, length(rule))").alias("path"), "rule", "verdict")
    r = r.groupBy("host", "path").agg(F.max(F.struct("verdict", "rule")).alias("x"))
    r = r.select(_key(F.reverse(F.split("host", r"\.")), F.col("path")).alias("key"), F.col("x.rule").alias("rule"), F.col("x.verdict").alias("verdict"))
    dealt = staged(r.repartitionByRange("key").withColumn("range", F.spark_partition_id()))
    place = F.row_number().over(Window.partitionBy("range").orderBy("key"))
    entry = F.struct("key", "rule", "verdict")
    blocks = dealt.withColumn("block", F.floor((place - 1) / BLOCK)).groupBy("range", "block").agg(F.sort_array(F.collect_list(entry)).alias("rules"))

    first = F.element_at("rules", 1)["key"]
    lengths = F.sequence(F.instr(first, "/"), F.length(first) - 1)
    prefixes = blocks.filter(F.length(first) > F.instr(first, "/")).select("range", "block", F.explode(F.transform(lengths, lambda n: F.substring(first, F.lit(1), n))).alias("key"))
    open_ = prefixes.join(dealt.drop("range"), "key").groupBy("range", "block").agg(F.sort_array(F.collect_list(entry)).alias("open"))

    kind = blocks.schema["rules"].dataType.simpleString()
    begin = F.struct(F.coalesce("open", F.array().cast(kind)).alias("open"), F.array().cast(f"array<{kind}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        still = F.concat(F.filter(acc["open"], lambda o: F.startswith(x["key"], o["key"])), F.array(x))
        return F.struct(still.alias("open"), F.concat(acc["out"], F.array(still)).alias("out"))

    stacks = blocks.join(open_, ["range", "block"], "left").select(F.explode(F.aggregate("rules", begin, step, lambda acc: acc["out"])).alias("stack"))
    return stacks.select(F.element_at("stack", -1)["key"].alias("key"), "stack")


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, url: str = "url") -> DataFrame:
    """Append host, path, rule and verdict to every row of pages."""
    pages = pages.withColumn("__url", F.col(url)).drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col("__url")), "path": path_of(F.col("__url"))}).drop("__url")
    distinct = staged(pages.groupBy("host", "path").agg(F.count("*").alias("__n")))
    labels = F.reverse(F.split("host", r"\."))
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.slice(labels, 1, n))
    keys = distinct.withColumn("suffix", F.explode(suffixes)).select(_key(F.col("suffix"), F.col("path")).alias("key"), "host", "path")

    starts = swept(rules)
    kind = starts.schema["stack"].dataType
    none = lambda of: F.lit(None).cast(of)
    both = starts.select("key", "stack", none("string").alias("host"), none("string").alias("path")).unionByName(keys.select("key", none(kind).alias("stack"), "host", "path"))
    dealt = staged(both.repartitionByRange("key", "host").withColumn("range", F.spark_partition_id()))
    lasts = dealt.groupBy("range").agg(F.max_by("stack", F.when(F.col("stack").isNotNull(), F.col("key"))).alias("stack"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    carried = lasts.select("range", none("string").alias("key"), F.last("stack", True).over(before).alias("stack"), none("string").alias("host"), none("string").alias("path"))
    running = Window.partitionBy("range").orderBy("key", "host").rowsBetween(Window.unboundedPreceding, 0)
    passed = dealt.select("range", "key", "stack", "host", "path").unionByName(carried).withColumn("stack", F.last("stack", True).over(running)).filter("host is not null and stack is not null")
    # A key begins with its reversed host and a slash, so a rule of another host is never a prefix of it.
    best = F.try_element_at(F.filter("stack", lambda s: F.startswith(F.col("key"), s["key"])), F.lit(-1))
    found = passed.select("host", "path", best.alias("b")).filter("b is not null").select("host", "path", F.struct(F.length("b.rule").alias("n"), "b.rule", "b.verdict").alias("best"))
    verdicts = found.groupBy("host", "path").agg(F.max("best").alias("best"))
    every = distinct.join(verdicts, ["host", "path"], "left").select(F.xxhash64("host", "path").alias("__of"), F.col("host").alias("__host"), F.col("path").alias("__path"), "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict"), "__n")
    rest = [c for c in pages.columns if c not in ("host", "path")]
    row = [f.name for f in pages.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    joined = spread_join(pages.withColumn("__of", F.xxhash64("host", "path")), every, ["__of"], "__n", row)
    return joined.filter((F.col("host") == F.col("__host")) & (F.col("path") == F.col("__path"))).select(*rest, "host", "path", "rule", "verdict")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    rules = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for v, r in RULES))).alias("x")).select("x.*")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = f"""
WITH rules(verdict, rule) AS (VALUES {", ".join(f"('{v}', '{r}')" for v, r in RULES)}),
r AS (SELECT verdict, rule, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS p FROM rules),
rest AS (SELECT row_number() OVER () AS row_no, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS x FROM pages),
u AS (SELECT row_no, page_id, translate(regexp_extract(x, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(x, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
f AS (SELECT row_no, rule, verdict, row_number() OVER (PARTITION BY row_no ORDER BY length(rule) DESC, rule DESC) AS place
  FROM u, r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict FROM u LEFT JOIN (SELECT * FROM f WHERE place = 1) USING (row_no)
"""
