import os

import pytest
from oracle_check import compare

from lathe.plans import catalogue
from lathe.streaming import encode as E
from lathe.operators import bpe
from lathe.sources import corpus

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", [x for x in catalogue.QUERIES if x in catalogue.ORACLES])
def test_query_like_sql(spark, name):
    assert compare(catalogue.QUERIES[name](spark, SF), catalogue.ORACLES[name], SF) is None


def test_streams(spark, tmp_path):
    docs = corpus.literal(spark, "aaabb aaabb", "aaabb", "xyxyxy")
    for k in range(3):
        docs.filter(f"doc_id = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    t, _ = bpe.train(docs, 262)
    q = E.encoded(E.documents_stream(spark, f"{tmp_path}/in"), t).writeStream.format("memory").queryName("enc").option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("SELECT * FROM enc").count() == 3
    trainer = E.FoldingTrainer(262)
    trainer.start(E.documents_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/c2").awaitTermination(120)
    assert 256 < trainer.tokenizer.vocab_size <= 262
