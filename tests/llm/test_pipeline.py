"""The corpus pipeline, stage by stage, against plain versions."""

import random
import zlib

import pytest

import corpus_pipeline
from quillmill.llm import bpe, quality
from quillmill.llm.common import saved

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Real documents with copies, near copies and nulls added, and their labels."""
    at = str(tmp_path_factory.mktemp("corpus"))
    src = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{src}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rnd = random.Random(1)
    long_ = [d for d in docs if len(d[1].split()) > 150][:8]
    more = [(10_000 + k, d[1], "en", "src0", d[4]) for k, d in enumerate(long_)]
    for k, d in enumerate(long_):
        words = d[1].split(" ")
        words[rnd.randrange(len(words))] = "changed"
        more.append((20_000 + k, " ".join(words), "en", None, d[4]))
    more += [(30_000, None, None, None, None), (30_001, "", "en", "src1", 0)]
    spark.createDataFrame(docs + more, SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.read.parquet(f"{src}/labels.parquet").write.parquet(f"{at}/labels.parquet")
    return at


def test_stages_take_effect(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(saved(stage(spark, seen[-1], corpus), "test"))
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    assert all(d.columns == docs.columns for d in seen[1:-1])
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{corpus}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    bad = {r.doc_id for r in quality.scores(docs, spark.read.parquet(f"{corpus}/labels.parquet")).collect() if r.predicted == 0}
    assert ids[1] == ids[0] - bad and sum((i in ids[1]) == bool(q) for i, q in truth.items()) >= 0.95 * len(truth)
    # exact: one document of each text
    texts = {}
    for r in seen[1].collect():
        key = " ".join((r.text or "").split()) if (r.text or "").isascii() else r.text
        texts.setdefault(key, []).append(r.doc_id)
    assert len(ids[2]) <= len(texts) and not any(i in ids[2] for i in range(10_000, 10_008))
    # near: the planted near copies go, and everything that stays is unlike everything else
    assert not any(i in ids[3] for i in range(20_000, 20_008))
    # mix: no document is invented, and each appears at most three times
    rows = seen[4].groupBy("doc_id").count().collect()
    assert ids[4] <= ids[3] and max(r["count"] for r in rows) <= 3
    # tokens of the stream
    assert seen[5].count() == seen[4].count()
    again = {r.doc_id: r.ids for r in bpe.encode(seen[4]).collect()}
    assert all(r.ids == again[r.doc_id] and r.n_tokens == len(r.ids) for r in seen[5].collect())


def test_run_is_the_stages(spark, corpus):
    assert corpus_pipeline.ORACLE_SQL is None
    out = corpus_pipeline.run(spark, corpus)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and out.count() > 0


def test_pipeline_of_nothing(spark, corpus, tmp_path):
    at = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.read.parquet(f"{corpus}/labels.parquet").write.parquet(f"{at}/labels.parquet")
    assert corpus_pipeline.run(spark, at).count() == 0
