"""Text functions as column expressions: cleaning, tokens, row status, noise, media kinds, display time."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.values import FUNCTION_WORDS, KEPT_PHRASES, MIN_TEXT, SCRAPS

# CJK characters, emoji, noise in cleaned text, and the names of images and videos.
CJK = r"\x{4e00}-\x{9fff}"
EMOJI = r"[\x{1F300}-\x{1F9FF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}]+"
NOISE = r"(?i)\d{4,}|\?{3,}|<\s*html|&[a-z]+;"
IMAGE_NAME = r".*\.(png|jpg|jpeg|bmp|gif|webp|tif|tiff)$"
VIDEO_NAME = r".*\.(mp4|mov|avi|mkv|webm|m4v|wmv|flv|3gp|mpg|mpeg)$"


def strings(values: Iterable[str]) -> Column:
    values = list(values)
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def tidy(text: Column) -> Column:
    """Trimmed of Unicode white space, each run inside being one space; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def collapse_cjk(text: Column) -> Column:
    """No white space between two CJK characters."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?U)(?<=[{CJK}])\s+(?=[{CJK}])", "")


def parts(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda p: p != "")


def strip_scraps(text: Column) -> Column:
    """Drops scraps of recognition that stand alone; kept phrases are safe."""
    for i, phrase in enumerate(KEPT_PHRASES):
        text = F.regexp_replace(text, f"(?i){phrase}", f"__wl{i}__")
    text = F.array_join(F.filter(parts(text), lambda p: ~F.lower(p).isin(*SCRAPS)), " ")
    for i, phrase in enumerate(KEPT_PHRASES):
        text = F.replace(text, F.lit(f"__wl{i}__"), F.lit(phrase))
    return text


def strip_numbers(text: Column) -> Column:
    """Drops parts that are digits only; digits within a part stay."""
    return F.array_join(F.filter(parts(text), lambda p: ~p.rlike(r"^\p{Nd}+$")), " ")


def clean_text(text: Column) -> Column:
    """No emoji, no punctuation, lower case, no scraps, no numbers, then no spaces inside CJK; in this order."""
    text = F.regexp_replace(F.coalesce(text, F.lit("")), EMOJI, " ")
    text = tidy(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}\s_]", " ")))
    return collapse_cjk(strip_numbers(strip_scraps(text)))


def keep_tokens(tokens: Column, stop: Iterable[str] = (), noise_filter: bool = True, dedupe: bool = True, least: int = 2) -> Column:
    """Lower-cased tokens, each once (the first counts); with the noise filter no short ones, numbers, stop words."""
    tokens = F.filter(F.transform(F.coalesce(tokens, strings([])), lambda t: F.lower(F.trim(t))), lambda t: t != "")
    if noise_filter:
        stop = sorted({w.lower() for w in FUNCTION_WORDS} | {w.strip().lower() for w in stop if w.strip()})
        tokens = F.filter(tokens, lambda t: (F.length(t) >= least) & ~t.rlike(r"^\p{Nd}+$|^[a-z]{1,2}$") & ~t.isin(*stop))
    return F.array_distinct(tokens) if dedupe else tokens


def split_tokens(cleaned: Column, **options) -> Column:
    """Tokens of cleaned text without CJK: its parts."""
    return keep_tokens(parts(cleaned), **options)


def bigrams(tokens: Column) -> Column:
    """Neighbouring tokens as STRUCT<word1, word2>; fewer than two give an empty array."""
    pair = lambda i: F.struct(F.get(tokens, i - 1).alias("word1"), F.get(tokens, i).alias("word2"))
    # a descending sequence would come of size 1, hence the guard
    size = F.size(tokens)
    return F.when(size > 1, F.transform(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), pair)).otherwise(
        F.array().cast("array<struct<word1:string,word2:string>>")
    )


def text_status(text: Column, least: int = MIN_TEXT, empty_markers: Iterable[str] = ()) -> Column:
    """empty, ocr_error, too_short, noise or ok: the first that holds. ``empty_markers`` are texts that count as empty."""
    t = tidy(text)
    empty = text.isNull() | (t == "")
    for marker in empty_markers:
        empty |= t == marker
    return (
        F.when(empty, "empty")
        .when(t.startswith("OCR_ERROR_"), "ocr_error")
        .when(F.length(t) < least, "too_short")
        .when(t.rlike(r"(?i)\bBARE\b"), "noise")
        .otherwise("ok")
    )


def is_noise(text: Column) -> Column:
    return F.coalesce(text.rlike(NOISE), F.lit(False))


def dataset_of_path(path: Column) -> Column:
    return F.regexp_extract(path, "/raw/images/([^/]+)/", 1)


def dataset_key(value: str | None, strict: bool = False) -> str | None:
    """A dataset id: lower case, only a-z, 0-9, _ and -; empty is None. Strict: raises instead of mending."""
    key = (value or "").strip().lower()
    clean = "".join(c for c in key if c in "abcdefghijklmnopqrstuvwxyz0123456789_-")
    if strict and (clean != key or not clean or len(clean) > 64):
        raise ValueError(f"dataset id {value!r}: 1 to 64 of a-z, 0-9, _ and -")
    return clean or None


def in_dataset(df, dataset: str | None):
    """The rows of a dataset: by ``dataset_id``, else by the path, else all; None: all."""
    key = dataset_key(dataset)
    if key is None:
        return df
    if "dataset_id" in df.columns:
        return df.filter(F.trim(F.lower("dataset_id")) == key)
    if "image_path" in df.columns:
        return df.filter(F.replace(F.col("image_path"), F.lit("\\\\"), F.lit("/")).contains(f"/{key}/"))
    return df


def image_kind(content: Column) -> Column:
    """png, jpeg, gif, bmp, webp or tiff by a file's first bytes; null otherwise."""
    head = F.hex(F.substring(content, 1, 16))
    return (
        F.when(head.startswith("89504E470D0A1A0A"), "png")
        .when(head.startswith("FFD8FF"), "jpeg")
        .when(head.rlike("^47494638(37|39)61"), "gif")
        .when(head.startswith("424D"), "bmp")
        .when(head.rlike("^52494646.{8}57454250"), "webp")
        .when(head.rlike("^(49492A00|4D4D002A)"), "tiff")
    )


def video_kind(content: Column) -> Column:
    """mp4, webm, avi or flv by a file's first bytes; null otherwise."""
    head = F.hex(F.substring(content, 1, 16))
    return (
        F.when(head.rlike("^.{8}66747970"), "mp4").when(head.startswith("1A45DFA3"), "webm").when(head.rlike("^52494646.{8}41564920"), "avi").when(head.startswith("464C56"), "flv")
    )


def upload_verdict(name: Column, mime: Column, content: Column) -> Column:
    """Why a file is refused, or ok: name, video by name or MIME type, extension, video by content, image by content."""
    lower = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    return (
        F.when(lower == "", "no_name")
        .when(lower.rlike(VIDEO_NAME) | F.coalesce(F.lower(mime).startswith("video/"), F.lit(False)), "video")
        .when(~lower.rlike(IMAGE_NAME), "extension")
        .when(video_kind(content).isNotNull(), "video")
        .when(image_kind(content).isNull(), "not_an_image")
        .otherwise("ok")
    )


def object_path(name: Column, bucket: str, base: str = "raw/images") -> Column:
    """A full path of a name given in short: s3a stays; raw/... in the bucket; a/b under the base; else the base."""
    name = F.ltrim(F.trim(name))
    return (
        F.when(name.startswith("s3a://"), name)
        .when(name.startswith("raw/"), F.concat(F.lit(f"s3a://{bucket}/"), name))
        .otherwise(F.concat(F.lit(f"s3a://{bucket}/{base}/"), name))
    )


def bucket_and_key(path: Column) -> Column:
    """STRUCT<bucket, key> of an s3a path; null where there is no bucket."""
    parts_ = lambda i: F.regexp_extract(F.trim(path), r"^s3a://([^/]+)/*(.*)$", i)
    return F.when(parts_(1) != "", F.struct(parts_(1).alias("bucket"), parts_(2).alias("key")))


def display_time(ts: Column, zone: str = "Asia/Taipei", suffix: str = "（台北）") -> Column:
    """A UTC time as local text; null is a dash."""
    return F.coalesce(F.concat(F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM-dd HH:mm:ss"), F.lit(f" {suffix}")), F.lit("—"))


def cjk_gaps(text: Column) -> Column:
    """How often white space stands between two CJK characters."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"(?<=[{CJK}])\s+(?=[{CJK}])")), F.lit(0))


def keyword_hits(text: Column, keywords: Iterable[str]) -> Column:
    """The keywords, in their order and each once, that a text holds."""
    words = list(dict.fromkeys(k.strip() for k in keywords if k.strip()))
    return F.filter(strings(words), lambda k: F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lower(k)))


def signature_allowed(signature: Column, allowed: Iterable[str]) -> Column:
    """Equal to an allowed signature, or every |-part of one is contained."""
    out = F.lit(False)
    for one in allowed:
        parts_ = [p.strip() for p in one.split("|") if p.strip()]
        short = F.lit(bool(parts_))
        for p in parts_:
            short &= F.contains(signature, F.lit(p))
        out |= (signature == one) | short
    return F.coalesce(out, F.lit(False))
