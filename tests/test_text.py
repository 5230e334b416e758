"""Cleaning, tokens, status and the other column functions."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmill.functions import fuzzy, text
from quillmill.operators import segment


def values(spark, rows, f, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_text(spark):
    cases = {
        "  珍珠奶茶，很好喝！  ": "珍珠奶茶很好喝", "12 30 2222 拜託": "拜託", "耶 2222 2222 第二次": "耶第二次", "Line Pay 很好": "line pay 很好", "12點前 沒來": "12點前沒來",
        "以上了 bare 台請三": "以上了台請三", "a😀b ☀ c": "a b c", "THE Ok see it_x": "it_x", None: "", " \n\t": "", "珍珠　燕麥": "珍珠燕麥", "x٣٤ ٣٤ y": "x٣٤ y",
    }
    assert values(spark, list(cases), text.clean_text) == list(cases.values())


def test_parts_of_cleaning(spark):
    assert values(spark, ["珍珠 燕麥都整個硬", "Line Pay 很好", None], text.collapse_cjk) == ["珍珠燕麥都整個硬", "Line Pay 很好", ""]
    assert values(spark, ["以上了 bare 台請三", "用 line pay 結帳", "see html it"], text.strip_scraps) == ["以上了 台請三", "用 line pay 結帳", "it"]
    assert values(spark, ["12點前 沒來", "2222 a 30"], text.strip_numbers) == ["12點前 沒來", "a"]


def test_tokens(spark):
    words = ["珍珠", "奶茶", "很", "好喝", "了", "是", "這", "ab", "123", "ABC", "abc", "a", ""]
    kept, loose, extra, repeats = (
        values(spark, [words, None], lambda c, k=k: text.keep_tokens(c, **k), "array<string>")
        for k in ({}, {"noise_filter": False}, {"stop": ["珍珠", "ABC"]}, {"noise_filter": False, "dedupe": False})
    )
    assert kept == [["珍珠", "奶茶", "好喝", "abc"], []] and extra[0] == ["奶茶", "好喝"]
    assert "a" in loose[0] and loose[0].count("abc") == 1 and repeats[0].count("abc") == 2


def test_bigrams(spark):
    got = values(spark, [["a", "b", "c"], ["a"], [], None], text.bigrams, "array<string>")
    assert [[(p.word1, p.word2) for p in g] for g in got] == [[("a", "b"), ("b", "c")], [], [], []]


def test_status(spark):
    rows = ["", "   ", "\n\n", None, "ab", "OCR_ERROR_REAL: boom", "something BARE here", "LINE Pay 外送", "OCR_EMPTY_RESULT"]
    assert values(spark, rows, text.text_status) == ["empty"] * 4 + ["too_short", "ocr_error", "noise", "ok", "ok"]
    assert values(spark, rows, lambda c: text.text_status(c, empty_markers=["OCR_EMPTY_RESULT"]))[-1] == "empty"
    assert values(spark, ["到了耶 2222 第二次", "what ???? really", "x <HTML y", "a &amp; b", "珍珠奶茶 很好喝", None], text.is_noise) == [True] * 4 + [False] * 2


def test_media(spark):
    heads = [b"\x89PNG\r\n\x1a\n1234", b"\xff\xd8\xff\xe0", b"GIF89a", b"RIFF1234WEBPVP8 ", b"BM12", b"II*\x00", b"1234ftypisom", b"hello", b""]
    assert values(spark, heads, text.image_kind, "binary") == ["png", "jpeg", "gif", "webp", "bmp", "tiff", None, None, None]
    assert values(spark, heads, text.video_kind, "binary")[6] == "mp4"
    files = [("a.png", "image/png", heads[0]), ("", None, heads[0]), ("a.mp4", None, heads[6]), ("a.png", "video/mp4", heads[0]), ("a.txt", None, heads[0]), ("a.png", None, heads[6]), ("a.png", None, heads[7])]
    df = spark.createDataFrame([(i, *f) for i, f in enumerate(files)], "i int, n string, m string, c binary")
    got = [r.v for r in df.select("i", text.upload_verdict(F.col("n"), F.col("m"), F.col("c")).alias("v")).orderBy("i").collect()]
    assert got == ["ok", "no_name", "video", "video", "extension", "video", "not_an_image"]


def test_paths_and_datasets(spark):
    assert values(spark, ["s3a://b/raw/images/drinks/x.png", "x.png"], text.dataset_of_path) == ["drinks", ""]
    assert values(spark, ["s3a://q/x", "raw/images/d/1.png", "d/2.png", "3.png"], lambda c: text.object_path(c, "b")) == [
        "s3a://q/x", "s3a://b/raw/images/d/1.png", "s3a://b/raw/images/d/2.png", "s3a://b/raw/images/3.png",
    ]
    assert text.dataset_key(" Drinks! ") == "drinks" and text.dataset_key("!!") is None
    with pytest.raises(ValueError):
        text.dataset_key("a b", strict=True)
    df = spark.createDataFrame([(" Drinks", 1), ("other", 2), (None, 3)], "dataset_id string, i int")
    assert [r.i for r in text.in_dataset(df, "drinks").collect()] == [1] and text.in_dataset(df, None).count() == 3
    by_path = spark.createDataFrame([("/raw/images/drinks/a",), ("/raw/images/o/a",)], "image_path string")
    assert text.in_dataset(by_path, "drinks").count() == 1


def test_display_time(spark):
    got = values(spark, ["2026-06-30T14:16:12", None], lambda c: text.display_time(c.cast("timestamp")))
    assert got == ["2026-06-30 22:16:12 （台北）", "—"]


def test_small_measures(spark):
    assert values(spark, ["珍 珠 奶", "a b", None], text.cjk_gaps) == [2, 0, 0]
    assert values(spark, ["Line pay OK", None], lambda c: text.keyword_hits(c, ["ok", "LINE", "ok", "no"])) == [["ok", "LINE"], []]
    assert values(spark, ["tesseract|lang=a|psm=6", "x", None], lambda c: text.signature_allowed(c, ["lang=a|psm=6"])) == [True, False, False]


# fuzzy --------------------------------------------------------------------------------------------------------------


def test_fuzzy_ratios():
    assert fuzzy.ratio("a", "") == 0 and fuzzy.ratio("Ab", "aB ") == 1 and abs(fuzzy.ratio("abcd", "abxd") - 0.75) < 1e-9
    assert fuzzy.word_hit("服務態渡", "服務態度", 0.78) and fuzzy.partial_ratio("xxabcyy", "abc") == 1
    assert abs(fuzzy.partial_ratio("出餐漫", "出餐慢") - 0.8) < 1e-9 and fuzzy.phrase_hit("出餐漫", "出餐慢", 0.78)
    assert not fuzzy.phrase_hit("ab", "ab", min_chars=3) and not fuzzy.word_hit("ab", "ac")


@settings(max_examples=150, deadline=None)
@given(st.text("abcd", max_size=12), st.text("abcd", max_size=8))
def test_common_length_is_the_lcs(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    assert fuzzy.common_length(a, b) == rows[-1][-1]


@settings(max_examples=150, deadline=None)
@given(st.text("abcde", min_size=1, max_size=90), st.text("abcde", min_size=1, max_size=6), st.sampled_from([0.6, 0.78, 0.88]))
def test_reaches_is_the_partial_ratio(hay, needle, least):
    assert fuzzy.reaches(hay, needle, least) == (fuzzy.partial_ratio(hay, needle) >= least - 1e-12)


def test_segmenter(spark):
    cut = segment.Segmenter(segment.dictionary())
    assert cut("珍珠奶茶很好喝") == ["珍珠奶茶", "很好喝"] and cut("店員態度差 ok") == ["店員態度", "差", "ok"] and cut(None) == [] and cut("龘") == ["龘"]
    assert values(spark, ["珍珠奶茶很好喝 latte", None], lambda c: segment.segmented(c)) == [["珍珠奶茶", "很好喝", "latte"], []]
    assert segment.dictionary("drinks", ["新詞 7 n", "# x"])["新詞"] == 7
