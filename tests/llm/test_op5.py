import re

from oracle import same

from lathe.llm import licenses as L

TEXTS = [
    "Licensed under CC BY-NC 4.0.", "cc by cc by CC\nBY", "x cc by", "ccby cc bye", "accc by", None, "", "All rights reserved. all RIGHTS\treserved", "All rıghts reserved",
    "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License.", "license mit", "mit dem license", "É CC BY é", "K general public license",
    "Licensed under the Apache License, Version 2.0.", "Redistribution and use in source and binary forms, with or without", "gnu lesser general public license",
    "redistribution and use in source and binary forms redistribution and use in source and binary", "and and redistribution and use in source and binary forms", "reserved rights all reserved all rights", "cc x by cc by by cc",
    "gnu general public license " * 40 + "all rights all rights reserved", "filler words " * 3000 + "all rights reserved", "permission is hereby granted, free of charge", "by cc", "...", "all rights reserved", "all rights reserved",
]
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def test_query_like_sql_and_contract(spark, tmp_path):
    spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, w string").write.parquet(f"{tmp_path}/documents.parquet")
    df = L.query(spark, str(tmp_path))
    same(df, L.ORACLE_SQL, str(tmp_path))
    for r in df.collect():
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in TEXTS[r.doc_id] or ""))
        at = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
        places = {k: [i for i in range(len(w)) if w[i : i + len(p.split())] == p.split()] for k, p in at.items()}
        starts = [i for v in places.values() for i in v]
        assert (r.n_words, r.n_base) == (len(w), len(starts))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted(k for k, v in places.items() if v))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_empty_table(spark):
    assert L.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
