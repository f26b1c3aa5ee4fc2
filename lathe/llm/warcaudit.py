"""Operator 3: fixity audit of WARC replicas by Merkle trees.

A manifest has a row for each distinct record: key, length, SHA-256, how often.
In order of (key, digest, length) they make up the archive, and each has its
offset: rows are dealt out by ranges, so the offset is the bytes of the ranges
before it, one row a range, and of the rows before it in its own; a key that
holds a third of all records is several ranges.

The tree's leaves are the records. Its nodes are consecutive ordered ranges that
begin at records chosen by their hash, one of `FANOUT` for the first level, one of
those for the next, and so on; a record that is lost or added therefore changes
the ranges around it and leaves all others as they are, though their offsets
move. A node's hash is the SHA-256 of its children's hashes in order, each with
the offset at which it begins in the node, so order and place are bound; a node
has `FANOUT` children on average.

Two replicas are compared from the roots down: only children of nodes that
differ are looked at, and in the end only records of the ranges that differ. The
number of levels is the logarithm of the number of records; only that number and
the two roots reach the driver.

Defined cases: equal records of one key count as often as they are, one behind
the other; unmatched records of a key are paired by order of (digest, length), a
row for each, and what is left over is missing or extra; null keys come first; a
null record is empty; equal or empty replicas give no rows; columns that clash
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathe.llm.common import staged, table, text_of

FANOUT = 64


def warc_record(key: Column, url: Column, payload: Column, declared: Column | None = None) -> Column:
    """A resource record in WARC 1.0; declared is the Content-Length where it is not the payload's."""
    line = "\r\n"
    length = F.octet_length(payload) if declared is None else declared
    head = F.concat(F.lit(f"WARC/1.0{line}WARC-Type: resource{line}WARC-Record-ID: <urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(f">{line}WARC-Target-URI: "), url, F.lit(f"{line}Content-Type: text/html{line}Content-Length: "), length.cast("string"), F.lit(line * 2))
    return F.concat(head, payload, F.lit(line * 2))


def manifest(records: DataFrame, key: str = "key", record: str = "record") -> DataFrame:
    """(key, length, digest, n) of each distinct record, written once."""
    body = F.coalesce(F.col(record), F.lit("").cast(records.schema[record].dataType))
    rows = records.select(F.col(key).cast("long").alias("key"), F.octet_length(body).cast("long").alias("length"), F.sha2(body.cast("binary"), 256).alias("digest"))
    return staged(rows.groupBy("key", "length", "digest").agg(F.count("*").alias("n")))


ORDER = ["key", "digest", "length"]
SCHEMA = "key long, status string, offset long, found_offset long, expected_length long, found_length long, expected_digest string, found_digest string, expected_copies long, found_copies long"


def _placed(m: DataFrame, levels: int) -> DataFrame:
    """The records with their offsets and, as n1, n2, ..., the first record of their node at each level."""
    name = F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("null")), "digest", "length")
    dealt = m.select(*ORDER, "n", (F.col("length") * F.col("n")).alias("bytes"), name.alias("name"))
    dealt = staged(dealt.repartitionByRange(*ORDER).withColumn("part", F.spark_partition_id()))
    chosen = F.xxhash64("name")
    opens = [F.when(F.pmod(chosen, F.lit(FANOUT**k)) == 0, F.col("name")) for k in range(1, levels + 1)]
    upto = Window.partitionBy("part").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    inside = dealt.select("*", (F.sum("bytes").over(upto) - F.col("bytes")).alias("at"), *(F.last(x, True).over(upto).alias(f"n{k}") for k, x in enumerate(opens, 1)))
    inside = staged(inside)
    names = [f"n{k}" for k in range(1, levels + 1)]
    parts = inside.groupBy("part").agg(F.sum("bytes").alias("all"), *(F.max_by(x, F.struct("at", *ORDER)).alias(x) for x in names))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    before = parts.select("part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before"), *(F.last(x, True).over(earlier).alias(f"{x}_before") for x in names))
    joined = inside.join(before, "part")
    hashed = F.sha2(F.concat_ws(":", "name", "n").cast("binary"), 256)
    return joined.select(*ORDER, "n", "bytes", (F.col("before") + F.col("at")).cast("long").alias("offset"), hashed.alias("hash"), *(F.coalesce(x, f"{x}_before", F.lit("")).alias(x) for x in names))


def _nodes(children: DataFrame, k: int, levels: int) -> DataFrame:
    """The nodes of level k: id, hash, offset, bytes, records, and the names of the nodes above."""
    above = [f"n{j}" for j in range(k + 1, levels + 1)]
    inorder = F.sort_array(F.collect_list(F.struct("offset", "hash")))
    nodes = children.groupBy(F.col(f"n{k}").alias("id")).agg(inorder.alias("of"), F.min("offset").alias("offset"), F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), *(F.any_value(x).alias(x) for x in above))
    content = F.array_join(F.transform("of", lambda x: F.concat((x["offset"] - F.col("offset")).cast("string"), F.lit("="), x["hash"])), ";")
    return nodes.select("id", F.sha2(F.concat_ws("|", content, "bytes").cast("binary"), 256).alias("hash"), "offset", "bytes", "n", *above)


def tree(m: DataFrame, levels: int) -> list[DataFrame]:
    """The levels of a manifest's tree: its records in their places, then the nodes of each level."""
    out = [staged(_placed(m, levels))]
    for k in range(1, levels + 1):
        out.append(staged(_nodes(out[-1], k, levels).withColumn(f"n{k}", F.col("id"))))
    return out


def root(level: DataFrame) -> tuple[str, int, int] | None:
    """Hash, records and bytes of a whole tree, from its top level of a few nodes."""
    inorder = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("offset", "hash"))), lambda x: F.concat(x["offset"].cast("string"), F.lit("="), x["hash"])), ";")
    r = level.agg(F.sha2(inorder.cast("binary"), 256).alias("hash"), F.sum("n").alias("records"), F.sum("bytes").alias("bytes")).first()
    return None if r["records"] is None else (r["hash"], r["records"], r["bytes"])


def _levels(*manifests: DataFrame) -> int:
    """Levels until about FANOUT nodes are left at the top."""
    rows, n = max(m.count() for m in manifests) // FANOUT, 1
    while rows > FANOUT:
        rows, n = rows // FANOUT, n + 1
    return n


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """The ids of nodes that only one side has, or that differ."""
    other = b.select(F.col("id").alias("id_b"), F.col("hash").alias("hash_b"))
    both = a.select("id", "hash").join(other, F.col("id") == F.col("id_b"), "full")
    return staged(both.filter(~F.col("hash").eqNullSafe(F.col("hash_b"))).select(F.coalesce("id", "id_b").alias("bad")))


def audit(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Records in which two manifests differ: key, status (corrupt, missing, extra), and of both sides offset, length, digest and how many copies the other lacks."""
    n = _levels(expected, found)
    a, b = tree(expected, n), tree(found, n)
    if root(a[-1]) == root(b[-1]):
        return expected.sparkSession.createDataFrame([], SCHEMA)
    bad = _differing(a[n], b[n])
    for k in range(n - 1, 0, -1):
        below = [x[k].join(bad, F.col(f"n{k + 1}") == F.col("bad"), "left_semi") for x in (a, b)]
        bad = _differing(*below)

    def of(records: DataFrame, mine: str, other: str) -> DataFrame:
        return records.join(bad, F.col("n1") == F.col("bad"), "left_semi").select(*ORDER, F.col("n").alias(mine), F.lit(0).cast("long").alias(other), *(F.when(F.lit(x == mine), F.col("offset")).alias(f"at_{x}") for x in ("e", "f")))

    sides = of(a[0], "e", "f").unionByName(of(b[0], "f", "e"))
    unmatched = sides.groupBy(*ORDER).agg(*(F.sum(x).alias(x) for x in ("e", "f")), *(F.min(f"at_{x}").alias(f"at_{x}") for x in ("e", "f"))).filter("e <> f")
    lacking = F.col("e") > F.col("f")
    place = F.row_number().over(Window.partitionBy("key", lacking).orderBy("digest", "length"))
    ranked = unmatched.withColumn("place", place)
    row = lambda where, at, copies: F.max(F.when(where, F.struct("digest", "length", F.col(at).alias("offset"), (copies).alias("copies"))))
    pairs = ranked.groupBy("key", "place").agg(row(lacking, "at_e", F.col("e") - F.col("f")).alias("e"), row(~lacking, "at_f", F.col("f") - F.col("e")).alias("f"))
    status = F.when(F.col("e").isNull(), "extra").when(F.col("f").isNull(), "missing").otherwise("corrupt")
    sided = [F.col(f"{s}.{x}").alias(f"{n}{x}") for x in ("length", "digest") for s, n in (("e", "expected_"), ("f", "found_"))]
    copies = [F.coalesce(f"{s}.copies", F.lit(0)).cast("long").alias(f"{n}copies") for s, n in (("e", "expected_"), ("f", "found_"))]
    return pairs.select("key", status.alias("status"), F.col("e.offset").alias("offset"), F.col("f.offset").alias("found_offset"), *sided, *copies)


# The damage of the query's second replica, as (divisor, remainder, kind) of page_id.
DAMAGE = [(97, 3, "flipped"), (193, 5, "cut"), (389, 7, "lost")]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits the WARC of all pages against a replica in which some records have a changed byte, are cut short, or are lost."""
    pages = table(spark, sf_dir, "pages").select("page_id", text_of("url").alias("url"), text_of("html").alias("html"))
    key, url, html = F.col("page_id"), F.col("url"), F.col("html")
    hit = {kind: F.coalesce(F.pmod(key, F.lit(d)) == r, F.lit(False)) for d, r, kind in DAMAGE}
    payload = F.when(hit["flipped"], F.concat(F.lit("X"), F.substring(html, 2, F.length(html)))).when(hit["cut"], F.left(html, F.floor(F.length(html) / 2).cast("int"))).otherwise(html)
    original = pages.select(key.alias("key"), warc_record(key, url, html).alias("record"))
    replica = pages.filter(~hit["lost"] | hit["flipped"] | hit["cut"]).select(key.alias("key"), warc_record(key, url, payload, F.octet_length(html)).alias("record"))
    return audit(manifest(original), manifest(replica))


_SQL_RECORD = "'WARC/1.0' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:page:' || page_id || '>' || e || 'WARC-Target-URI: ' || url || e || 'Content-Type: text/html' || e || 'Content-Length: ' || strlen(html) || e || e || {} || e || e"
_SQL_HIT = {kind: f"page_id % {d} = {r}" for d, r, kind in DAMAGE}
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, chr(13) || chr(10) AS e,
  CASE WHEN {_SQL_HIT["flipped"]} THEN 'flipped' WHEN {_SQL_HIT["cut"]} THEN 'cut' WHEN {_SQL_HIT["lost"]} THEN 'lost' END AS damage FROM pages),
r AS (SELECT page_id, damage, {_SQL_RECORD.format("html")} AS a,
  CASE WHEN damage <> 'lost' THEN {_SQL_RECORD.format("CASE damage WHEN 'flipped' THEN 'X' || substr(html, 2) WHEN 'cut' THEN left(html, length(html) // 2) END")} END AS b FROM p),
o AS (SELECT *, sum(strlen(a)) OVER (ORDER BY page_id) - strlen(a) AS before, sum(coalesce(strlen(b), 0)) OVER (ORDER BY page_id) - strlen(b) AS before_b FROM (SELECT page_id, damage, a, CASE WHEN damage IS NULL THEN a ELSE b END AS b FROM r))
SELECT page_id AS key, CASE damage WHEN 'lost' THEN 'missing' ELSE 'corrupt' END AS status, before::BIGINT AS "offset", before_b::BIGINT AS found_offset, strlen(a)::BIGINT AS expected_length,
  strlen(b)::BIGINT AS found_length, sha256(a) AS expected_digest, sha256(b) AS found_digest, 1::BIGINT AS expected_copies, (b IS NOT NULL)::BIGINT AS found_copies
FROM o WHERE damage IS NOT NULL AND b IS DISTINCT FROM a
"""
