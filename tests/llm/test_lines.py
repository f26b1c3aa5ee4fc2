import corpus_pipeline as C


def test_line_stage_drops_short_lines_that_recur(spark):
    texts = ["All rights reserved.\nfirst", "  All rights  reserved.\n\n1999", "2000\n\nAll rights reserved", "東京都は日本の首都です。", "x\n東京都は日本の首都です。", "twice here\ntwice here", None]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in C.line_stage(spark, docs, "").collect()}
    assert got == {0: texts[0], 1: "\n1999", 2: texts[2], 3: texts[3], 4: "x", 5: texts[5], 6: None}
