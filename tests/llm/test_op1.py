import hashlib

import numpy as np
import sentencepiece

from lathe.llm import sentencepieces as S

TEXTS = ["", None, "a", " ", "\n", "  two  spaces ", "\n\n  x", "a\x00b", "▁mark", "😀 é́ x", "<s> </s> <unk>", "\t\r\n x", "a \n", "word " * 3000, "ab" * 4000, "same", "same"]


def test_like_the_library(spark):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string, n_tokens int")
    got = {r.doc_id: r for r in S.decode(S.encode(df, S.model_path()), S.model_path()).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=S.model_path())
    for i, t in enumerate(TEXTS):
        want = sp.encode(t or "", add_bos=True, add_eos=True)
        assert np.frombuffer(got[i].ids, "<u4").tolist() == want
        assert got[i].n_tokens == len(want)
        assert got[i].decoded == sp.decode(want)


def test_query_on_a_table(spark, tmp_path):
    spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sp = sentencepiece.SentencePieceProcessor(model_file=S.model_path())
    for r in S.query(spark, str(tmp_path)).collect():
        want = sp.encode(TEXTS[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(want).encode()).hexdigest()


def test_decoding_other_ids_and_arrays(spark):
    ids = [[1, 200, 201, 2], [2], [1, 28705, 28705, 264], []]
    df = spark.createDataFrame([(bytearray(np.array(x, "<u4").tobytes()),) for x in ids] + [(None,)], "ids binary")
    sp = sentencepiece.SentencePieceProcessor(model_file=S.model_path())
    rows = S.decode(df, S.model_path()).withColumn("a", S.id_array()).collect()
    assert [r.decoded for r in rows] == [sp.decode(x) for x in ids] + [""]
    assert [r.a for r in rows[:4]] == ids


def test_empty_table(spark):
    assert S.encode(spark.createDataFrame([], "doc_id long, text string"), S.model_path()).count() == 0
