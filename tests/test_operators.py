"""Statistics, gates, rows, funnel, snapshots, audits, recognition."""

import math
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quillmill.operators import audit, corpus, funnel, gates, lexicon, recognise, rows, snapshots, values


def test_tfidf_values(spark):
    docs = spark.createDataFrame([(str(i), ["珍珠"] + (["異物"] if i < 3 else []) + (["b"] if i < 2 else [])) for i in range(10)] + [("x", [])], "d string, t array<string>")
    got = {r.keyword: r for r in corpus.tfidf(docs, "d", "t").collect()}
    assert got["珍珠"].tfidf_score == 0 and got["珍珠"].corpus_doc_count == 10
    assert math.isclose(got["異物"].tfidf_score, 3 * math.log(11 / 4)) and got["異物"].doc_frequency == 3
    twice = spark.createDataFrame([("1", ["a", "a", "b"]), ("2", ["a", None, ""])], "d string, t array<string>")
    assert {(r.keyword, r.total_tf, r.doc_frequency) for r in corpus.tfidf(twice, "d", "t", repeats=True).collect()} == {("a", 3, 2), ("b", 1, 1)}


def test_pmi_values(spark):
    docs = spark.createDataFrame([(["珍珠", "奶茶"],)] * 15 + [(["很", "好喝"],)] * 2 + [(["x"],), (None,)], "t array<string>")
    got = {r.phrase: r for r in corpus.phrase_pmi(docs, "t").collect()}
    assert abs(got["珍珠 奶茶"].pmi_score - 0.125163) < 1e-6 and abs(got["很 好喝"].pmi_score - 2.140066) < 1e-6 and got["很 好喝"].total_bigrams == 17
    assert corpus.phrase_pmi(docs, "t", 3).count() == 1


def test_lexicon_algebra(spark, tmp_path):
    assert lexicon.parse_lines(["# c", "", " A ", "b # x", "a"]) == ["a", "b"]
    stop = lexicon.effective(["好喝", "珍珠", "奶茶", "覺得"], lexicon.protected_terms(values.DRINKS))
    assert "珍珠" not in stop and "好喝" in stop
    explore = set(lexicon.exploration(["珍珠"], "drinks"))
    assert {"珍珠", "店員", "自己"} <= explore
    df = spark.createDataFrame([(["珍珠", "店員", "難喝", "自己", "不耐煩", "難喝"],), (None,)], "t array<string>")
    assert [r.o for r in df.select(lexicon.filter_tokens(F.col("t"), explore).alias("o")).collect()] == [["難喝", "不耐煩"], []]
    assert lexicon.content_hash(["b", "a", "A "]) == lexicon.content_hash(["a", "b"]) and len(lexicon.content_hash([])) == 64
    words = spark.createDataFrame([("b",), ("A ",), ("a",), ("é",), ("𝒳",), ("ﬀ",)], "w string")
    assert lexicon.content_hash_of(words, "w").first()[0] == lexicon.content_hash(["a", "b", "é", "𝒳", "ﬀ"])
    (tmp_path / "w.txt").write_text("x\n# y\nz # q\n")
    assert lexicon.read_words(spark, f"file:{tmp_path}/w.txt") == ["x", "z"] and lexicon.read_words(spark, f"file:{tmp_path}/none") == []
    assert lexicon.candidates(["p/{dataset_id}/{version}", "p/{dataset_id}", "p"], "d", None) == ["p/d", "p"]
    lex = lexicon.collect("drinks", values.DRINKS, ["extra"])
    assert "extra" in lex.release and "珍珠" not in lex.release and "珍珠" in lex.exploration and lex.release_hash != lex.exploration_hash


def test_melt_boundaries():
    level = lambda n, bad, **k: gates.melt_decision(n, bad, **k)["level"]
    assert [level(50, 5), level(50, 6), level(50, 15), level(0, 0), level(50, 6, mode="hard")] == ["pass", "soft", "hard", "pass", "hard"]
    assert gates.melt_decision(50, 6, "hard")["reason"] == "manual_hard_mode"


def test_quarantine(spark):
    df = spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(["good text"] * 8 + ["", "OCR_ERROR_X"])], "image_path string, extracted_text string")
    kept = []
    ok, decision = gates.quarantine(df, kept.append, "bronze")
    assert ok.count() == 8 and decision["level"] == "soft" and sorted(r.ocr_status for r in kept[0].collect()) == ["empty", "ocr_error"]
    with pytest.raises(gates.GateError):
        gates.quarantine(df, None, "bronze", "hard")
    assert gates.quarantine(df.limit(0))[1]["level"] == "pass"
    runs = [{"etl_name": "silver_ocr_etl", "dataset_id": "d", "recorded_at": "1", "melted": True}, {"etl_name": "silver_ocr_etl", "dataset_id": "d", "recorded_at": "2", "melted": False}]
    gates.snapshot_allowed(runs, "d")
    with pytest.raises(gates.GateError):
        gates.snapshot_allowed(runs[:1], "d")


def test_quality(spark):
    schema = "image_path string, extracted_text string, cleaned_text string, tokens array<string>"
    good = [(f"i{k}", "珍珠奶茶 很好喝", "珍珠奶茶 很好喝", ["珍珠奶茶", "很好喝"]) for k in range(10)]
    assert gates.quality_gate(spark.createDataFrame(good, schema)).passed
    m = gates.quality_metrics(spark.createDataFrame(good[:9] + good[:1], schema)).first()
    assert m.duplicate_image_path_rows == 2 and not gates.quality_verdict(m.asDict()).passed
    bad = [("a", None, None, None), (None, "x 2222 y", "x 2222 y", ["x", "abcdefghijkl"])]
    m = gates.quality_metrics(spark.createDataFrame(bad, schema)).first()
    assert (m.null_image_path_rows, m.null_cleaned_text_rows, m.noise_cleaned_text_rows, m.pure_digit_token_in_cleaned_rows) == (1, 1, 1, 1)
    assert (m.total_token_instances, m.len1_token_instances, m.long_token_instances, m.nonempty_tokens_ratio) == (2, 1, 1, 0.5)
    empty = gates.quality_gate(spark.createDataFrame([], schema))
    assert empty.passed and empty.warnings == ["no_rows"] and gates.quality_gate(None, enabled=False) is None
    assert gates.gold_warnings(["珍珠", "外送"], {"珍珠", "自己"}, 6, 0) == ["stopword_leak:珍珠", "no_topics"] and gates.gold_warnings([], [], 1, 0) == ["tfidf_empty"]


REVIEWS = [
    (["店員", "態度", "不錯", "親切"], "positive", []), (["店員", "態度", "不耐煩"], "negative", ["服務態度"]), (["好慢"], "negative", ["等待時間"]), (["電子發票", "好喝", "推薦"], None, []),
    (["載具", "發票", "沒綁"], "negative", ["載具發票"]), (["載具", "珍珠", "奶茶", "難喝"], "negative", ["品質口感"]), ([], "neutral", []), (None, "neutral", []),
]


def test_funnel(spark):
    f = funnel.Funnel()
    for words, sentiment, topics in REVIEWS:
        got = f.analyse(words)
        assert got[1] == topics and (sentiment is None or got[0] == sentiment), (words, got)
    assert "服務態度" in f.analyse(["店員", "態度", "不錯", "親切"])[3]
    waiting = f.analyse(["排隊", "人很多"])
    assert waiting[1] == [] and "等待時間" in waiting[2]
    assert "品質口感" not in f.analyse(["其實", "不難喝"])[1]
    assert "等待時間" in f.analyse(["出餐漫"])[1] and "等待時間" not in funnel.Funnel(fuzzy=False).analyse(["出餐漫"])[1]


def test_exact_funnel_is_the_funnel_without_fuzzy(spark):
    import random

    rnd = random.Random(4)
    pool = [w for t in values.DRINKS.topics for w in (*t.phrases, *t.anchors, *t.negatives)] + list(values.DRINKS.negations) * 8 + "今天 很 人 客".split() * 6
    docs = [r[0] for r in REVIEWS] + [[rnd.choice(pool) for _ in range(rnd.randrange(1, 7))] for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, t array<string>")
    exact = {r.i: r.o for r in df.select("i", funnel.exact_topics(F.col("t")).alias("o")).collect()}
    plain = funnel.Funnel(fuzzy=False)
    assert exact == {i: plain.analyse(t)[1] for i, t in enumerate(docs)}
    arrow = {r.i: list(r.o) for r in df.select("i", funnel.analysis(F.col("t"), fuzzy=False)["pain_topics"].alias("o")).collect()}
    assert arrow == exact


def test_latest_and_duplicates(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z"), ("b", 0, "w"), (None, 5, "n")], "k string, t int, v string")
    assert sorted((r.k or "", r.v) for r in rows.latest_per_key(df, ["k"], [F.col("t"), F.col("v")]).collect()) == [("", "n"), ("a", "y"), ("b", "w")]
    assert rows.duplicate_groups(df, ["k"]).first() == (2, 2, 4)
    old = spark.createDataFrame([("a", "d1")], "image_path string, s string")
    new = spark.createDataFrame([("a", "d1"), ("a", "d2"), ("c", "d1")], "image_path string, s string")
    assert rows.skip_known(new, old, ["image_path", "s"]).count() == 2 and rows.skip_known(new, old, ["image_path"]).count() == 1


def test_newer_null_does_not_hide_text(spark):
    df = spark.createDataFrame([("/raw/images/d/a", " t ", 1, "h"), ("/raw/images/d/a", None, 2, "h")], "image_path string, extracted_text string, ingestion_timestamp int, file_hash string")
    r = rows.prepare_for_silver(df).first()
    assert (r.extracted_text, r.dataset_id, r.latest_ingestion_timestamp) == ("t", "d", 1) and rows.prepare_for_silver(df, "given").first().dataset_id == "given"


def test_change_detection_and_nulls(spark):
    u = spark.createDataFrame([("a", "t", "c", None, 1, "D"), ("b", "t", "c", "s", 1, "d"), ("c", "t", "c", "s", 1, "d")], "image_path string, extracted_text string, cleaned_text string, source_bucket string, latest_ingestion_timestamp int, dataset_id string")
    t = spark.createDataFrame([("a", "t", "c", "s", 1, "d", ["x"], "v"), ("b", "t", "c", "s", 1, " D", ["x"], " v ")], "image_path string, extracted_text string, cleaned_text string, source_bucket string, ingestion_timestamp int, dataset_id string, tokens array<string>, silver_transform_version string")
    assert {(r.image_path, r.is_new) for r in rows.changed_rows(u, t, "v").collect()} == {("a", False), ("c", True)}
    assert {r.image_path for r in rows.changed_rows(u, t, "v", null_safe=False).collect()} == {"c"}
    assert rows.changed_rows(u, t, "w").count() == 3


def test_snapshots(spark):
    at = datetime(2026, 1, 1, 12)
    data = [("x", 3, "d", at), ("y", 1, "d", at), ("x", 5, "d", at + timedelta(days=1)), ("x", 9, "e", at)]
    s = spark.createDataFrame(data, "topic string, frequency long, dataset_id string, snapshot_at timestamp")
    assert {(r.dataset_id, r.frequency) for r in snapshots.latest(s).collect()} == {("d", 5), ("e", 9)}
    assert snapshots.listed(s).count() == 2
    assert snapshots.at_time(s, F.lit(at + timedelta(milliseconds=400))).count() == 3 and snapshots.at_time(s, F.lit(at + timedelta(seconds=5))).count() == 0
    assert [r.frequency for r in snapshots.compared(s.filter("dataset_id = 'd'"), [F.lit(at)]).collect()] == [3, 1]
    assert snapshots.deletion(s, "d", F.lit(at))[:2] == ("dry_run", 2) and snapshots.deletion(s, "q", F.lit(at))[:2] == ("not_found", 0)
    assert snapshots.deletion(s, "d", F.lit(at), dry_run=False)[2].count() == 2 and snapshots.deletion(s.limit(0), "d", F.lit(at))[0] == "noop"


def test_audits():
    f = audit.lexicon_drift("lexicon", "v1", "h", "v1", "g")
    assert (f.check_id, f.level) == ("gold.lexicon_silent_drift", audit.FAIL)
    assert [audit.lexicon_drift("l", *a).level for a in (("v", None, "v", "h"), ("v", "h", "v", "h"), ("v", "h", "w", "g"), ("v", "h", "w", "h"))] == ["WARN", "PASS", "WARN", "PASS"]
    assert audit.silver_versions(["v2.0.0", "v2.1.0"], "v2.1.0").level == "FAIL" and audit.silver_versions(["v2.1.0"], "v2.1.0").level == "PASS"
    full = "tesseract|lang=a|psm=6|pre=v1"
    assert audit.signatures([full], 3, ["lang=a|psm=6"]).level == "PASS" and audit.signatures(["x"], 1, ["y"]).level == "FAIL"
    assert [audit.signatures([], 0, ["y"]).level, audit.signatures(["x"], 1, []).level, audit.signatures(["y1", "y2"], 2, ["y"]).level] == ["WARN"] * 3
    assert [audit.exit_code([audit.Finding("a", lv, "")], s) for lv, s in (("PASS", False), ("WARN", False), ("WARN", True), ("FAIL", False))] == [0, 2, 1, 1]
    m = audit.approved({"gold": {"x": 1}}, "2026-01-01", "me", 5)
    assert m["gold"]["processed_image_count"] == 5 and audit.approved_snapshot(m, True).level == "PASS" and audit.approved_snapshot(audit.revoked(m), True).level == "WARN"
    assert [f.level for f in audit.runtime({"runtime": {"silver_transform_version": "a"}, "gold": {"topic_rule_version": "b"}}, "x", "y")] == ["FAIL", "WARN"]


def test_freshness():
    now = datetime(2026, 1, 2, tzinfo=UTC)
    since = {"upstream_lag_since": (now - timedelta(hours=13)).isoformat()}
    counts = {"dataset_id": "d", "raw_image_count": 10, "silver_image_count": 5, "release_image_count": 5}
    state, alerts = audit.freshness(counts, since, now)
    assert [a["alert"] for a in alerts] == ["upstream_stale"] and state["upstream_lag_since"] == since["upstream_lag_since"]
    state, alerts = audit.freshness(counts | {"raw_image_count": 5}, since, now)
    assert not alerts and state["upstream_lag_since"] is None
    assert audit.freshness(counts, {}, now)[1] == [] and audit.freshness(counts | {"silver_image_count": None}, since, now)[1] == []
    assert [a["alert"] for a in audit.freshness(counts | {"raw_image_count": 5, "release_image_count": 3}, {"release_lag_since": (now - timedelta(hours=15)).isoformat()}, now)[1]] == ["release_stale"]


def test_recognition(spark):
    assert recognise.page_mode(None) == "6" and recognise.page_mode(" 11 ") == "11"
    with pytest.raises(ValueError):
        recognise.page_mode("14")
    c = recognise.Config.of({"OCR_MODE": "11", "OCR_ROUTER": "false", "OCR_SCALE": "900"})
    assert (c.mode, c.router, c.scale) == ("11", False, 900) and recognise.image_profile(c, 10, 10, 200).profile == "dark_ui"
    c = recognise.Config()
    assert [recognise.image_profile(c, *a).profile for a in ((700, 2000, 10), (1000, 2000, 200), (1000, 2000, 10))] == ["low_res", "light_doc", "dark_ui"]
    assert recognise.signature(c).startswith("tesseract|lang=chi_tra+eng|psm=6|pre=v1.1|profile=dark_ui|scale=1500") and recognise.signature(recognise.Config(signature_override="s")) == "s"
    assert recognise.otsu_level([5, 5] + [0] * 252 + [5, 5]) in range(1, 254)

    def engine(content, config):
        return f"{content.decode()} 好 喝 {config.mode}", recognise.signature(config)

    df = spark.createDataFrame([("/raw/images/d/a.png", b"x"), ("/raw/images/d/b.png", None)], "image_path string, image_content binary")
    got = {r.image_path: r for r in recognise.recognised(df, c, engine).collect()}
    assert got["/raw/images/d/a.png"].extracted_text == "x 好 喝 6" and got["/raw/images/d/a.png"].dataset_id == "d" and got["/raw/images/d/b.png"].extracted_text.startswith("OCR_ERROR_")
    sides = {r.psm: r for r in recognise.compare_modes(df, c, ("6", "11"), ["好", "11"], engine).collect()}
    assert (sides["6"].n_rows, sides["6"].error_rows, sides["11"].total_hits, sides["11"].avg_cjk_gaps) == (2, 1, 2, 0.5)
    text, signature = recognise.tesseract(b"no image", c)
    assert text.startswith("OCR_ERROR_") and signature


def test_tfidf_counts_documents_and_words_in_one_pass(spark, tmp_path):
    rows = [("a", ["x", "y", "x"]), ("a", ["x", None, ""]), ("b", ["y"]), ("c", []), ("d", None), (None, ["x"]), ("e", ["", None])]
    spark.createDataFrame(rows, "doc string, tokens array<string>").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for repeats, wanted in ((False, {"x": (4, 4), "y": (2, 2)}), (True, {"x": (4, 2), "y": (2, 2)})):
        out = corpus.tfidf(docs, "doc", "tokens", repeats)
        found = {r.keyword: (r.total_tf, r.doc_frequency) for r in out.collect()}
        assert found == wanted and {r.corpus_doc_count for r in out.collect()} == {2}
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("Scan parquet") == 1
    assert corpus.tfidf(docs.limit(0), "doc", "tokens").count() == 0
