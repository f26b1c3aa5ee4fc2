"""Operator 2: line dedup by a log-template tree.

A line is split at white space; tokens with a digit are variable fields
(``<*>``). The tree begins with a fixed depth: a line goes down by its number of
tokens and its `LEADING` first tokens. A node generalises further fields from
what its lines have in common: at each position a token is constant if at least
max(2, `SUPPORT` of the node's distinct lines) carry it there, else variable. A
line of which at least `CONSTANT` is constant has the template of its constant
tokens. Where a node of more than `WIDE` lines leaves some without a template,
they go down once more, each by that of its tokens which most, but not all,
lines of the node have (the first of equals), so that a family of lines is found
among others that share its beginning; there are `DEPTH` such levels. A line
that ends without a template is its own, as is, digits and all, a line of up to
`LEADING` tokens; blank lines stay. A template that recurs in at least two
documents keeps its first line (least document id, hash of text, line number)
and loses all others.

Lines are parsed in Arrow batches and only hashes travel: a row (document, line
number, leaf, template) per line is written once, and templates are aggregated
before anything is shuffled, so a line that all documents share is one row per
task. Tokens are looked up only for leaves with several distinct lines, one line
for each; a node's constant tokens are at most a few times its line's length and
are joined to its lines, which are never gathered. Joins in which one template
may hold a large part of all rows are spread (`common.spread_join`).

Defined cases: a null text stays null, the empty text empty; rows of equal id and
text are one document and are treated alike; a line that recurs only within one
document stays; null ids are ids like any other, the least; other columns pass
through, columns named n_lines or n_dropped are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.arrow import slices
from lathe.llm.common import session, spread_join, staged, table, text_of

LEADING, SUPPORT, CONSTANT, WIDE, DEPTH = 4, 0.1, 0.6, 20, 3
FIELD = "<*>"
DIGIT, MASKED = re.compile(rb"[0-9]"), re.compile(rb"[^\s0-9]*[0-9]\S*")
_FIELD = FIELD.encode()


def tokens_of(line: bytes) -> list[bytes]:
    """The tokens of a line, fields masked where the line is longer than a leaf's beginning."""
    tokens = line.split()
    if len(tokens) > LEADING and DIGIT.search(line):
        return MASKED.sub(_FIELD, line).split()
    return tokens


def _lines(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (id, h, at, leaf, template): all lines that are not blank."""
    session(df)
    kind = df.schema[doc_id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in slices(batches, "text", 1 << 20):
            row, at, leaf, template = [], [], [], []
            for k, x in enumerate(batch.column("text")):
                for i, line in enumerate(x.as_buffer().to_pybytes().split(b"\n")):
                    tokens = tokens_of(line)
                    if tokens:
                        whole = b" ".join(tokens)
                        row.append(k)
                        at.append(i)
                        leaf.append(xxh64_intdigest(b" ".join(tokens[:LEADING]), len(tokens)))
                        template.append(xxh64_intdigest(whole, 1))
            of = pa.array(row, pa.int64())
            marks = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (leaf, template)]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(of), batch.column("h").take(of), pa.array(at, pa.int32()), *marks], ["id", "h", "at", "leaf", "template"])

    rows = df.select(F.col(doc_id).alias("id"), F.xxhash64(text_of(text)).alias("h"), text_of(text).alias("text"))
    return rows.mapInArrow(run, f"id {kind.simpleString()}, h long, at int, leaf long, template long")


def _first() -> Column:
    return F.struct("id", "h", "at")


def _with_tokens(several: DataFrame, df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Append to lines (leaf, template, id, h, at, ...) their number of tokens, of constant ones among the leading, and hashes of the others, null for fields."""
    wanted = several.groupBy("id", "h").agg(F.collect_list(F.struct("at", "leaf", "template")).alias("wanted"))
    source = df.select(F.col(doc_id).alias("sid"), F.xxhash64(text_of(text)).alias("sh"), text_of(text).alias("text"))
    held = source.join(wanted.hint("shuffle_hash"), source.sid.eqNullSafe(wanted.id) & (source.sh == wanted.h)).select("wanted", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in slices(batches, "text", 1 << 20):
            leaf, template, n, lead, sizes, tokens, field = [], [], [], [], [0], [], []
            for wanted, x in zip(batch.column("wanted").to_pylist(), batch.column("text")):
                lines = x.as_buffer().to_pybytes().split(b"\n")
                for w in wanted:
                    words = tokens_of(lines[w["at"]])
                    leaf.append(w["leaf"])
                    template.append(w["template"])
                    n.append(len(words))
                    lead.append(LEADING - words[:LEADING].count(_FIELD))
                    for p, t in enumerate(words[LEADING:]):
                        tokens.append(xxh64_intdigest(t, p))
                        field.append(t == _FIELD)
                    sizes.append(len(tokens))
            marks = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.array(tokens, np.uint64).view(np.int64), mask=np.array(field, bool)))
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), pa.array(template, pa.int64()), pa.array(n, pa.int32()), pa.array(lead, pa.int32()), marks], ["leaf", "template", "n", "lead", "tokens"])

    found = held.mapInArrow(run, "leaf long, template long, n int, lead int, tokens array<long>")
    # Equal rows of one document are one line.
    return found.groupBy("leaf", "template").agg(*(F.any_value(x).alias(x) for x in ("n", "lead", "tokens")))


def _general(lines: DataFrame) -> DataFrame:
    """(leaf, template, general) of those lines (leaf, template, n, lead, tokens) that share a template with others of a node."""
    found, level = None, lines.withColumn("node", F.col("leaf"))
    for depth in range(DEPTH + 1):
        sizes = level.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
        level = staged(spread_join(level, sizes.withColumn("__n", F.col("size")), ["node"], "__n", ["template"]))
        support = level.select("node", "size", F.explode("tokens").alias("t")).filter("t is not null").groupBy("node", "size", "t").agg(F.count("*").alias("support"))
        support = staged(support.filter("support > 1"))
        constant = support.filter(F.col("support") >= SUPPORT * F.col("size")).groupBy("node").agg(F.collect_list("t").alias("constant"), F.max("size").alias("__n"))
        none = F.array().cast("array<long>")
        bare = sizes.join(constant, "node", "left").select("node", F.coalesce("constant", none).alias("constant"), F.col("size").alias("__n"))
        judged = spread_join(level, bare, ["node"], "__n", ["template"]).withColumn("common", F.array_sort(F.array_intersect("tokens", "constant")))
        settled = F.col("lead") + F.size("common") >= CONSTANT * F.col("n")
        judged = staged(judged.select("leaf", "template", "n", "lead", "tokens", "node", "size", F.when(settled, F.xxhash64("node", "common")).alias("general")))
        part = judged.filter("general is not null").select("leaf", "template", "general")
        found = part if found is None else found.union(part)
        if depth == DEPTH:
            break
        open_ = judged.filter(F.col("general").isNull() & (F.col("size") > WIDE))
        if open_.isEmpty():
            break
        shared = open_.select("leaf", "template", "node", F.posexplode("tokens").alias("p", "t")).filter("t is not null").join(support.filter("support < size").select("node", "t", "support"), ["node", "t"])
        best = shared.groupBy("leaf", "template").agg(F.max(F.struct("support", -F.col("p"), "t"))["t"].alias("t"))
        level = open_.join(best, ["leaf", "template"]).select("leaf", "template", "n", "lead", "tokens", F.xxhash64("node", "t").alias("node"))
    return found


def recurring(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The table of lines (id, h, at, leaf, template), and of those in recurring templates (leaf, template, first, n)."""
    lines = staged(_lines(df, doc_id, text))
    last = F.max(F.struct("id", "h"))
    templates = lines.groupBy("leaf", "template").agg(F.min(_first()).alias("first"), last.alias("last"), F.count("*").alias("n"))
    same = F.col("first.id").eqNullSafe(F.col("last.id")) & (F.col("first.h") == F.col("last.h"))
    templates = staged(templates.select("leaf", "template", "first", "n", (~same).alias("several")))

    sizes = templates.groupBy("leaf").agg(F.count("*").alias("of_leaf")).filter("of_leaf > 1")
    shared = templates.join(sizes, "leaf").select("leaf", "template", "first.id", "first.h", "first.at")
    general = staged(_general(staged(_with_tokens(shared, df, doc_id, text))))
    placed = staged(templates.join(general, ["leaf", "template"]))
    groups = placed.groupBy("general").agg(F.min("first").alias("first"), F.max(F.struct("first.id", "first.h")).alias("last"), F.max("several").alias("several"), F.count("*").alias("of"))
    again = groups.filter(F.col("several") | ~same).select("general", "first", "of")
    of_group = spread_join(placed.select("leaf", "template", "general", "n"), again, ["general"], "of", ["template"]).select("leaf", "template", "first", "n")
    alone = templates.filter("several").join(general, ["leaf", "template"], "left_anti").select("leaf", "template", "first", "n")
    return lines, alone.union(of_group)


def drop_recurring(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The table with recurring lines gone from its texts, and n_lines and n_dropped appended."""
    df = df.drop("n_lines", "n_dropped")
    lines, again = recurring(df, doc_id, text)
    gone = spread_join(lines, again, ["leaf", "template"], "n", ["id", "h", "at"]).filter(~_first().eqNullSafe(F.col("first")))
    by_doc = gone.groupBy(F.col("id").alias("__id"), F.col("h").alias("__h")).agg(F.array_sort(F.collect_set("at")).alias("__gone"))
    body = F.col(text)
    keyed = df.withColumn("__hash", F.xxhash64(text_of(text)))
    joined = keyed.join(by_doc.hint("shuffle_hash"), keyed[doc_id].eqNullSafe(by_doc["__id"]) & (keyed["__hash"] == by_doc["__h"]), "left")
    n_lines = F.length(text_of(text)) - F.length(F.replace(text_of(text), F.lit("\n"), F.lit(""))) + 1
    # The lines between one that goes and the next, and so on: linear in the text.
    before = lambda k: F.coalesce(F.get("__gone", k - 1), F.lit(-1))
    runs = F.transform(F.concat("__gone", F.array(n_lines)), lambda x, k: F.slice("__parts", before(k) + 2, x - before(k) - 1))
    rest = F.array_join(F.flatten(runs), "\n")
    return joined.withColumn("__parts", F.when(F.col("__gone").isNotNull(), F.split(body, "\n"))).select(
        *(F.when(F.col("__gone").isNull(), body).otherwise(rest).alias(c) if c == text else F.col(c) for c in df.columns),
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its recurring lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring(docs).select("doc_id", "n_lines", "n_dropped", "text")


def _levels() -> str:
    """The tree below the leaves, level by level; t0, t1, ... are the lines that share a template of a node."""
    parts = [f"u0 AS (SELECT DISTINCT tokens, n, n || ':' || tokens[1:{LEADING}]::VARCHAR AS node FROM used WHERE n > {LEADING})"]
    for k in range(DEPTH + 1):
        parts += [
            f"z{k} AS (SELECT node, count(*) AS size FROM u{k} GROUP BY node HAVING size > 1)",
            f"w{k} AS (SELECT node, tokens, n, size, unnest(range(n)) AS p, unnest(tokens) AS token FROM u{k} JOIN z{k} USING (node))",
            f"s{k} AS (SELECT node, p, token, count(*) AS c FROM w{k} WHERE token <> '{FIELD}' GROUP BY ALL HAVING c > 1)",
            f"m{k} AS (SELECT node, tokens, n, size, list(CASE WHEN c >= {SUPPORT}::DOUBLE * size THEN token END ORDER BY p) AS g, count(*) FILTER (c >= {SUPPORT}::DOUBLE * size) AS fixed, arg_max(p || '=' || token, c * 1000000 - p) FILTER (c < size) AS best FROM w{k} LEFT JOIN s{k} USING (node, p, token) GROUP BY ALL)",
            f"t{k} AS (SELECT tokens, node || chr(2) || g::VARCHAR AS general FROM m{k} WHERE fixed >= {CONSTANT}::DOUBLE * n)",
            f"u{k + 1} AS (SELECT tokens, n, node || chr(1) || best AS node FROM m{k} WHERE fixed < {CONSTANT}::DOUBLE * n AND size > {WIDE} AND best IS NOT NULL)",
        ]
    return ",\n".join(parts)


_BLANK, _BLANKS = "[ \\t\\n\\x0b\\f\\r]", "[^ \\t\\n\\x0b\\f\\r"
_SPLIT = f"string_split_regex(regexp_replace({{}}, '^{_BLANK}+|{_BLANK}+$', '', 'g'), '{_BLANK}+')"
ORACLE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
raw AS (SELECT row_no, doc_id, text, unnest(range(len(parts))) AS i, unnest(parts) AS line FROM docs),
split AS (SELECT row_no, doc_id, i, {_SPLIT.format("line")} AS plain, {_SPLIT.format(f"regexp_replace(line, '{_BLANKS}0-9]*[0-9]{_BLANKS}]*', '{FIELD}', 'g')")} AS masked FROM raw),
used AS (SELECT row_no, doc_id, i, CASE WHEN len(plain) > {LEADING} THEN masked ELSE plain END AS tokens, len(plain) AS n FROM split WHERE plain[1] <> ''),
{_levels()},
general AS ({" UNION ALL ".join(f"SELECT * FROM t{k}" for k in range(DEPTH + 1))}),
placed AS (SELECT row_no, doc_id, i, general IS NOT NULL AS kind, coalesce(general, tokens::VARCHAR) AS template FROM used LEFT JOIN general USING (tokens)),
groups AS (SELECT kind, template, count(DISTINCT doc_id) AS docs, min(doc_id) AS first_doc FROM placed GROUP BY ALL),
firsts AS (SELECT kind, template, first_doc, min(i) AS first_i FROM placed JOIN groups USING (kind, template) WHERE docs > 1 AND doc_id = first_doc GROUP BY ALL),
gone AS (SELECT row_no, i FROM placed JOIN firsts USING (kind, template) WHERE NOT (doc_id = first_doc AND i = first_i)),
kept AS (SELECT r.row_no, string_agg(r.line, chr(10) ORDER BY r.i) AS text FROM raw r ANTI JOIN gone g ON r.row_no = g.row_no AND r.i = g.i GROUP BY r.row_no),
counted AS (SELECT row_no, count(*) AS n_dropped FROM gone GROUP BY row_no)
SELECT d.doc_id, len(d.parts)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, coalesce(kept.text, '') AS text
FROM docs d LEFT JOIN kept USING (row_no) LEFT JOIN counted USING (row_no)
"""
