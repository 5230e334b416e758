"""The table store, files, whole layers, streams, and the query catalogue."""

import json

import pytest
from pyspark.sql import functions as F

from quillmill.operators import gates, recognise
from quillmill.plans import catalogue, runtime
from quillmill.plans.layers import Layers
from quillmill.sources import files, keys
from quillmill.sources.store import TableStore
from quillmill.streaming import increment


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"file:{tmp_path}/tables")


def test_store_dml(spark, store):
    t = spark.createDataFrame([("a", 1, "d"), ("b", 2, "d"), ("c", 3, "e")], "k string, v int, dataset_id string")
    assert not store.exists("t")
    store.upsert("t", t, ["k"])
    store.write("t", spark.createDataFrame([("a", 9, "d", "n")], "k string, v int, dataset_id string, note string"), "merge", ["k"], history="h")
    assert sorted((r.k, r.v, r.note) for r in store.read("t").collect()) == [("a", 9, "n"), ("b", 2, None), ("c", 3, None)]
    assert [(r.k, r.v, r.archive_reason) for r in store.read("h").collect()] == [("a", 1, "pre_merge")]
    store.delete("t", "v = 2 or note = 'zzz'")
    assert store.read("t").count() == 2
    store.replace_dataset("t", spark.createDataFrame([("z", 7)], "k string, v int"), "e")
    assert {(r.k, r.dataset_id) for r in store.read("t").collect()} == {("a", "d"), ("z", "e")}
    store.replace_dataset("t", spark.createDataFrame([], "k string, v int"), "e")
    assert store.read("t").count() == 2
    store.append("t", t)
    assert store.dedupe("t", ["k"], [F.col("v")], dry_run=True)["dropped"] == 1 and store.read("t").count() == 5
    assert store.dedupe("t", ["k"], [F.col("v")], dry_run=False)["after"] == 4 and store.read("t").count() == 4
    store.add_columns("t", {"extra": "double"})
    assert "extra" in store.read("t").columns and store.verify("t", "k = 'a'") == 1
    with pytest.raises(RuntimeError):
        store.verify("t", "k = 'none'")
    with pytest.raises(ValueError):
        store.write("t", t, "merge")
    with pytest.raises(FileNotFoundError):
        store.read("nothing")
    assert store.vacuum("t") and store.read("t").count() == 4 and not store.vacuum("t")


def test_files_and_metrics(spark, tmp_path):
    root = tmp_path / "raw" / "images" / "drinks"
    root.mkdir(parents=True)
    for name, content in (("a.png", b"\x89PNG\r\n\x1a\n1"), ("b.JPG", b"no"), ("c.txt", b"t")):
        (root / name).write_bytes(content)
    at = f"file:{tmp_path}/raw"
    images = files.images(spark, at)
    assert images.count() == 2 and files.real_images(images).count() == 1 and files.count_images(spark, at, 1) == 1 and files.count_images(spark, at + "/no") == 0
    assert [(r.dataset_id, r.images) for r in files.datasets(files.image_listing(spark, at)).collect()] == [("drinks", 2)]
    assert [r.size for r in files.first_images(spark, at, 5).collect()] == [9, 2]
    assert files.batches([" a", "", "b", "c"], 2, 9) == [[" a".strip(), "b"], ["c"]]
    m = f"file:{tmp_path}/metrics"
    for k, name in enumerate(("x", "y", "x")):
        files.append_metric(spark, m, {"etl_name": name, "dataset_id": "d", "status": "ok", "recorded_at": f"2026-01-0{k + 1}"})
    (tmp_path / "metrics" / "bad.json").write_text("{nonsense\n")
    assert [r.recorded_at[-1] for r in files.read_metrics(spark, m, name="x").collect()] == ["3", "1"] and files.read_metrics(spark, m, 2).count() == 2
    files.write_json(spark, f"{m}.doc", {"a": "好"})
    assert files.read_json(spark, f"{m}.doc") == {"a": "好"} and files.read_json(spark, f"{m}.none") == {}
    (tmp_path / "list.json").write_text(json.dumps([1]))
    with pytest.raises(ValueError):
        files.read_json(spark, f"file:{tmp_path}/list.json")


def test_keys_and_records(spark):
    from datetime import datetime

    at = datetime(2026, 1, 2, 3, 4, 5)
    assert keys.file_name("C:\\x\\_my  photo(1).PNG") == "my_photo_1.PNG"
    assert keys.file_name(".png", at) == "image_20260102_030405.png" and keys.object_key("a.png", "drinks", "../s ub/") == "raw/images/drinks/sub/a.png"
    for bad in ("", "..", "/"):
        with pytest.raises(ValueError):
            keys.file_name(bad)
    taken = {"d/a.png", "d/a_20260102_030405.png"}
    assert keys.free_key("d/a.png", taken.__contains__, now=at) == ("d/a_20260102_030405_1.png", True)
    assert keys.free_key("d/a.png", taken.__contains__, overwrite=True) == ("d/a.png", False) and keys.free_key("d/b.png", taken.__contains__) == ("d/b.png", False)
    assert sorted(files.records(spark, [{"a": 1}, {"a": 2, "b": "x"}]).collect()) == [(1, None), (2, "x")]
    with pytest.raises(ValueError):
        files.records(spark, [])


def test_runtime(spark, tmp_path):
    import time

    from quillmill.operators import audit

    slots = runtime.Slots()
    with slots.slot({"percent": 10, "available_mb": 9000}):
        with pytest.raises(runtime.LimitError):
            with slots.slot({}):
                pass
    for now in ({"percent": 90, "available_mb": 9000}, {"percent": 10, "available_mb": 100}):
        with pytest.raises(runtime.LimitError):
            runtime.check_memory(runtime.Limits(), now)
    with pytest.raises(runtime.LimitError):
        runtime.check_count(101, 100, "images")
    with runtime.time_limit(spark, 60):
        assert spark.range(5).count() == 5
    with pytest.raises(runtime.LimitError):
        with runtime.time_limit(spark, 2):
            spark.range(4).repartition(4).selectExpr("java_method('java.lang.Thread', 'sleep', 8000L + id) as x").collect()
    jobs = runtime.Jobs(keep=2)
    done = jobs.start("a", lambda report: report(step=1) or 7)
    assert jobs.wait(done, 10).result == 7 and jobs.get(done).progress == {"step": 1}
    bad = jobs.wait(jobs.start("b", lambda _: 1 / 0), 10)
    assert bad.status == "failed" and "zero" in bad.error and jobs.wait(jobs.start("c", lambda _: time.sleep(0)), 10).status == "done" and jobs.get(done) is None
    up = runtime.ready(spark, f"file:{tmp_path}")
    assert up["status"] == "ok" and runtime.ready(spark, f"file:{tmp_path}/none")["status"] == "down"
    told = []
    out = runtime.probe("d", up, [audit.Finding("x", "WARN", "m")], [{"alert": "upstream_stale", "since": "t"}], notify=lambda d, i: told.append((d, len(i))))
    assert not out["ok"] and told == [("d", 2)] and runtime.probe("d", up, [audit.Finding("x", "WARN", "m")], [], strict=False)["ok"]
    assert runtime.release({"release_id": " r ", "gold": {"processed_image_count": "5"}})["processed_image_count"] == 5
    assert "珍珠" in recognise.user_words(lines=["# x", "new"]) and "new" in recognise.user_words(lines=["# x", "new"])


TEXTS = ["珍珠奶茶 難喝 店員 態度 不耐煩"] * 4 + ["珍珠 好喝 推薦"] * 3 + ["好慢 等太久 出餐 速度 很慢"] * 3


def _engine():
    """A nested function, so that workers get its code and need not import this file."""

    def engine(content, config):
        return content.decode(), recognise.signature(config)

    return engine


engine = _engine()


def images(spark, texts, start=0):
    rows = [(f"/raw/images/drinks/{start + k:03d}.png", t.encode()) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "image_path string, image_content binary")


def test_one_click(spark, store, tmp_path):
    layers = Layers(store, metrics=f"file:{tmp_path}/metrics")
    first = layers.to_gold(images(spark, TEXTS), "drinks", recognise.Config(), "b", engine, cjk=True)
    assert first["bronze"]["written"] == 10 and first["silver"]["inserted"] == 10 and first["gold"]["topics"] >= 2
    again = layers.to_gold(images(spark, TEXTS), "drinks", recognise.Config(), "b", engine, cjk=True)
    assert again["skipped"] and store.read("bronze").count() == 10
    more = layers.to_gold(images(spark, TEXTS + ["OCR_ERROR_X", "ab"]), "drinks", recognise.Config(), "b", engine, cjk=True)
    assert more["bronze"] == {"seen": 2, "errors": 1, "written": 1} and more["silver"]["updated"] == 0 and store.read("bronze_quarantine").count() == 1
    assert layers.silver("drinks", cjk=True)["inserted"] == 0
    assert store.read("topic_snapshot").select("snapshot_at").distinct().count() == 2
    topics = {r.topic: r.frequency for r in store.read("topic_snapshot").collect()}
    assert topics["等待時間"] == 3 and topics["服務態度"] == 4
    done = files.read_metrics(spark, f"file:{tmp_path}/metrics").collect()
    assert {r.etl_name for r in done} == {"bronze_ocr", "silver_ocr_etl", "gold", "pipeline_to_gold"}


def test_hard_melt_publishes_nothing(spark, store, tmp_path):
    layers = Layers(store, metrics=f"file:{tmp_path}/metrics")
    layers.bronze(images(spark, ["ab"] * 5 + TEXTS[:5]), recognise.Config(), "b", engine=engine)
    with pytest.raises(gates.GateError):
        layers.silver("drinks")
    assert not store.exists("silver")
    last = files.read_metrics(spark, f"file:{tmp_path}/metrics", name="silver_ocr_etl").first()
    assert last.status == "failed" and last.blocked


def test_streams(spark, store, tmp_path):
    src = f"{tmp_path}/in"
    events = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    events.write.parquet(src)
    stream = spark.readStream.schema(events.schema).parquet(src)
    for _ in range(2):  # the second run finds nothing new
        increment.upsert_stream(stream, store, "s", ["k"], ["t"], f"{tmp_path}/ck").start().awaitTermination()
        assert sorted((r.k, r.v) for r in store.read("s").collect()) == [("a", "y"), ("b", "z")]
    spark.createDataFrame([("b", 5, "new")], events.schema).write.mode("append").parquet(src)
    increment.upsert_stream(stream, store, "s", ["k"], ["t"], f"{tmp_path}/ck").start().awaitTermination()
    assert sorted((r.k, r.v) for r in store.read("s").collect()) == [("a", "y"), ("b", "new")]
    spark.sql("select timestamp'2026-01-01 00:10:00' ts, 1.0D value, 'c' event_type union all select timestamp'2026-01-01 00:50:00', 2.0D, 'c' union all select timestamp'2026-01-01 05:00:00', 4.0D, 'c'").write.parquet(f"{tmp_path}/clicks")
    clicks = spark.readStream.schema("ts timestamp, value double, event_type string").parquet(f"{tmp_path}/clicks")
    q = increment.tumbling(clicks, "ts", ["event_type"]).writeStream.format("memory").queryName("windows").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/ck2").start()
    q.awaitTermination()
    assert [(r.n, r.total) for r in spark.table("windows").collect()] == [(2, 3.0)]
    q = increment.distinct_within(clicks, "ts", ["event_type"]).writeStream.format("memory").queryName("once").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/ck3").start()
    q.awaitTermination()
    assert spark.table("once").count() == 1


def test_catalogue_has_sql_for_all_but_the_fuzzy():
    assert set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL) == {"topic_frequency_fuzzy", "review_sentiment", "fuzzy_ratio"}


def test_entry(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.columns == ["keyword", "total_tf", "doc_frequency", "corpus_doc_count", "idf", "tfidf_score"] and not out.isEmpty()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert all(isinstance(sql, str) and "SELECT" in sql for sql in __spark_entry__.oracle_sql().values())


def test_entry_without_a_library():
    """A library that only the training-data operators need is missing: the other queries are there all the same."""
    import os
    import subprocess
    import sys

    code = "import sys; sys.modules['tokenizers'] = None; import __spark_entry__ as e; from quillmill.plans import catalogue as c; assert set(e.queries()) == set(c.QUERIES) and e.oracle_sql() == c.ORACLE_SQL"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert subprocess.run([sys.executable, "-c", code], cwd=root, check=False).returncode == 0


def test_topics_alone_and_audit(spark, store):
    layers = Layers(store)
    rows_ = [(f"/raw/images/drinks/{i}.png", f"服務態度 很差 text{i} words", "drinks", "b", "sig", "h") for i in range(4)]
    bronze = spark.createDataFrame(rows_, "image_path string, extracted_text string, dataset_id string, source_bucket string, ocr_signature string, file_hash string")
    store.overwrite("bronze", bronze.withColumn("ingestion_timestamp", F.current_timestamp()))
    assert layers.silver("drinks", images=[rows_[0][0], rows_[1][0]])["inserted"] == 2 and layers.silver("drinks")["inserted"] == 2
    assert layers.topics("drinks", verify=True)["topics"] == layers.topics("drinks")["topics"] >= 1
    assert store.read("topic_snapshot").select("snapshot_at").distinct().count() == 2 and not store.exists("tfidf_keywords")
    manifest = {"bronze": {"allowed_ocr_signatures": ["sig"]}, "gold": {"approved_snapshot_at": "1999-01-01 00:00:00"}}
    levels = {f.check_id: f.level for f in layers.audit("drinks", manifest)}
    assert levels["bronze.signatures_ok"] == levels["silver.version_ok"] == levels["gold.snapshot_ok"] == "PASS" and levels["gold.approved_missing"] == "FAIL"
    assert not any(f.check_id.startswith(("bronze", "silver")) for f in layers.audit("drinks", manifest, offline=True))


def test_binarisation():
    import numpy as np

    grey = np.full((40, 40), 200, np.uint8)
    grey[10:14, 10:30] = 60
    grey[:, 30:] = 90  # a darker part, in which a stroke is darker still
    grey[20:22, 33:38] = 30
    binary = recognise.adaptive(grey)
    assert (binary[11, 12:20] == 0).all() and (binary[20:22, 34:37] == 0).all() and (binary[30, 2:12] == 255).all()
    at = np.arange(-15, 16)
    weight = np.exp(-(at[:, None] ** 2 + at[None, :] ** 2) / 50)  # a deviation of 5 for 31 x 31
    wide = np.pad(grey.astype(float), 15, mode="edge")
    plain = [[255 if grey[i, j] > (wide[i : i + 31, j : j + 31] * weight).sum() / weight.sum() - 10 else 0 for j in range(40)] for i in range(40)]
    assert np.array_equal(binary, plain)
    specks = np.zeros((9, 9), np.uint8)
    specks[4, 4] = specks[0, 5] = specks[2, 0] = specks[0, 0] = 255
    specks[6:8, 6:9] = 255
    opened = recognise.opened(specks)
    assert opened[4, 4] == 0 and (opened[6:8, 6:9] == 255).all()
    least = lambda i, j: min(specks[a, b] for a in (i - 1, i) for b in (j - 1, j) if a >= 0 and b >= 0)
    eroded = np.array([[least(i, j) for j in range(9)] for i in range(9)])
    assert np.array_equal(opened, [[eroded[i : i + 2, j : j + 2].max() for j in range(9)] for i in range(9)])


NEW = """phrase_top gold_preview lexicon_columns stopword_lines bronze_preview images_named store_merge etl_silver etl_gold quarantine_rejects row_metrics
    review_analysis_exact release_latest audit_findings path_parts object_paths paths_batched image_files upload_verdicts cjk_collapsed ocr_rows psm_ab topic_frequency_exact""".split()


@pytest.mark.parametrize("name", ["phrase_pmi", "silver_quality_metrics", "change_detect", "topic_labels_exact", "snapshot_latest", "ingest_status", *NEW])
def test_queries_agree_with_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in "documents pages labels events nation customer part benchmark conversations".split():
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    rel = con.sql(catalogue.ORACLE_SQL[name])
    df = catalogue.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    norm = lambda v: round(v, 5) if isinstance(v, float) else v
    mine = sorted(tuple(str(norm(r[c])) for c in cols) for r in df.collect())
    at = [rel.columns.index(c) for c in cols]
    assert mine == sorted(tuple(str(norm(r[i])) for i in at) for r in rel.fetchall())
