"""Operator 5 [native]: licence notices by a positional rare-token index.

Each notice is a template: a few words in order, of which a key phrase is
mandatory. The index has a posting (template, position) for every word of every
key phrase. One scan splits all texts into words and keeps, in a staged table,
which licence words each holds, and the words themselves only of those that hold
all words of some key phrase. From it the document frequency of every licence
word is counted over all documents (a row per word of the fixed template
vocabulary, the only rows that reach the driver).

A file is then looked up by its highest-IDF licence words: of each template whose
key phrase it can hold, the two rarest. Their places, less their postings'
positions, are where the phrase would begin; only beginnings that both words
propose are left, and there the key phrase is verified word by word and the other
template words are counted for the score. A phrase always holds all of its words,
so no place is missed, whatever the frequencies.

All of it is column expressions over one row: no Python on the executors, no
shuffle but the word counts.

Defined cases: a null or empty text has no words, no labels and score 0; repeated
rows are judged alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import lower_ascii, staged, table, text_of

# Notice templates as (label, words, first word of the key phrase, words in the key phrase, base).
TEMPLATES = [
    ("cc-by", "licensed under cc by", 2, 2, True),
    ("gpl", "licensed under the gnu general public license version", 4, 3, True),
    ("reserved", "all rights reserved", 0, 3, True),
    ("agpl", "gnu affero general public license", 1, 4, False),
    ("apache", "licensed under the apache license version 2 0", 3, 3, False),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 0, 8, False),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", 0, 9, False),
    ("lgpl", "gnu lesser general public license", 1, 4, False),
    ("mit", "released under the mit license", 3, 2, False),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 0, 7, False),
    ("mpl", "subject to the terms of the mozilla public license", 6, 3, False),
    ("unlicense", "this is free and unencumbered software released into the public domain", 4, 2, False),
]
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _key(t: tuple) -> list[str]:
    return t[1].split()[t[2] : t[2] + t[3]]


VOCABULARY = sorted({w for t in TEMPLATES for w in t[1].split()})


def _words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), BREAK), "")


def _strings(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def _templates() -> Column:
    return F.array(*(F.struct(F.lit(label).alias("label"), _strings(words.split()).alias("words"), F.lit(at).alias("at"), _strings(_key((label, words, at, n))).alias("key"), F.lit(base).alias("base")) for label, words, at, n, base in TEMPLATES))


def _postings() -> Column:
    """The index: for each word of a key phrase, (template, position in the phrase) wherever it stands in one."""
    found: dict[str, list[Column]] = {}
    for k, t in enumerate(TEMPLATES):
        for j, w in enumerate(_key(t)):
            found.setdefault(w, []).append(F.struct(F.lit(k).alias("k"), F.lit(j).alias("at")))
    return F.create_map(*(x for w, p in sorted(found.items()) for x in (F.lit(w), F.array(*p))))


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, places), places an array of label, start, share, base."""
    keys = F.array(*(F.struct(F.lit(k).alias("k"), _strings(_key(t)).alias("key")) for k, t in enumerate(TEMPLATES)))
    words = df.select(F.col(doc_id).alias("doc_id"), _words(text_of(text)).alias("w"))
    present = words.select("doc_id", "w", F.array_intersect(_strings(VOCABULARY), "w").alias("present"))
    possible = F.filter(keys, lambda t: F.size(F.array_except(t["key"], F.col("present"))) == 0)
    judged = present.select("doc_id", F.size("w").cast("long").alias("n_words"), "w", "present", F.transform(possible, lambda t: t["k"]).alias("possible"))
    held = staged(judged.withColumn("w", F.when(F.size("possible") > 0, F.col("w"))))

    counts = held.select(F.explode("present").alias("word")).groupBy("word").count()
    seen = {r["word"]: r["count"] for r in counts.collect()}  # a row per word of the fixed vocabulary
    by_idf = _strings(sorted(VOCABULARY, key=lambda w: (seen.get(w, 0), w)))

    w, key_of = F.col("w"), lambda k: F.element_at(_templates(), k + 1)["key"]
    # The file's licence words, rarest first, and of each template it can hold the two rarest.
    rare = held.withColumn("rare", F.array_intersect(by_idf, "present"))
    two = lambda k: F.slice(F.array_intersect(F.col("rare"), key_of(k)), 1, 2)
    looked = rare.withColumn("wanted", F.transform("possible", lambda k: F.struct(k.alias("k"), two(k).alias("two"))))
    any_of = F.array_distinct(F.flatten(F.transform("wanted", lambda x: x["two"])))
    hits = looked.withColumn("any", any_of).withColumn("hits", F.filter(F.transform(w, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda h: F.array_contains("any", h["x"])))

    def begins(k: Column, word: Column) -> Column:
        """Where a template's key phrase would begin, by the places of one of its words."""
        at = F.transform(F.filter(F.element_at(_postings(), word), lambda p: p["k"] == k), lambda p: p["at"])
        return F.flatten(F.transform(F.filter("hits", lambda h: h["x"] == word), lambda h: F.transform(at, lambda j: h["i"] - j)))

    def common(x: Column) -> Column:
        both = F.array_intersect(begins(x["k"], F.element_at(x["two"], 1)), begins(x["k"], F.element_at(x["two"], -1)))
        return F.transform(both, lambda s: F.struct(x["k"].alias("k"), s.alias("start")))

    proposed = hits.withColumn("proposed", F.when(w.isNotNull(), F.flatten(F.transform("wanted", common))))

    def verified(p: Column) -> Column:
        key = key_of(p["k"])
        return (p["start"] >= 0) & (F.slice(w, F.greatest(p["start"], F.lit(0)) + 1, F.size(key)) == key)

    def place(p: Column) -> Column:
        t = F.element_at(_templates(), p["k"] + 1)
        n = F.size(t["words"])
        same = F.size(F.filter(F.sequence(F.lit(0), n - 1), lambda j: F.coalesce(F.get(w, p["start"] - t["at"] + j) == F.get(t["words"], j), F.lit(False))))
        return F.struct(t["label"].alias("label"), p["start"].cast("long").alias("start"), (same / n).alias("share"), t["base"].alias("base"))

    none = F.array().cast("array<struct<label:string,start:bigint,share:double,base:boolean>>")
    return proposed.select("doc_id", "n_words", F.coalesce(F.transform(F.filter("proposed", verified), place), none).alias("places"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, places of base phrases, labels and score."""
    p = F.col("places")
    base = F.filter(p, lambda x: x["base"])
    starts = F.transform(base, lambda x: x["start"])
    labels = lambda x: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(x, lambda y: y["label"]))))
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(p).alias("labels"),
        F.coalesce(F.array_max(F.transform(p, lambda x: x["share"])), F.lit(0.0)).alias("score"),
    )


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


ORACLE_SQL = f"""
WITH templates(label, words, lead_in, phrase, base) AS (VALUES {", ".join(f"('{t[0]}', {_sql_list(t[1].split())}, {t[2]}, {_sql_list(_key(t))}, {str(t[4]).lower()})" for t in TEMPLATES)}),
docs AS (SELECT row_number() OVER () AS row_no, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
found AS (SELECT row_no, w, label, words, lead_in, base, unnest(list_filter(range(len(w)), lambda i: w[i + 1 : i + len(phrase)] = phrase)) AS start FROM docs, templates WHERE list_contains(w, phrase[1]) AND list_contains(w, phrase[2])),
places AS (SELECT row_no, label, start, base,
  len(list_filter(range(len(words)), lambda j: start - lead_in + j >= 0 AND start - lead_in + j < len(w) AND w[start - lead_in + j + 1] = words[j + 1])) / len(words)::DOUBLE AS share FROM found),
by_doc AS (SELECT row_no, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT DISTINCT * FROM places) GROUP BY row_no)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN by_doc USING (row_no)
"""
