"""Text recognition as a stage: configuration, signatures, image profiles, and a pluggable engine over Arrow batches."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cjk_gaps, dataset_of_path, keyword_hits, tidy
from .values import RECOGNISER_WORDS

EMPTY, TIMEOUT = "OCR_EMPTY_RESULT", "OCR_ERROR_TIMEOUT"


def page_mode(value: object, default: str = "6") -> str:
    """A page segmentation mode, 0 to 13 as text."""
    text = str(value if value not in (None, "") else default).strip()
    if not text.isdigit() or int(text) > 13:
        raise ValueError(f"page segmentation mode {value!r}: 0 to 13")
    return str(int(text))


@dataclass(frozen=True)
class Config:
    language: str = "chi_tra+eng"
    mode: str = "6"
    preprocess: bool = True
    version: str = "v1.1"
    profile: str = "dark_ui"
    router: bool = True
    scale: int = 1500
    contrast: float = 2.0
    sharpness: float = 1.5
    binarise: str = "adaptive"
    invert: str = "auto"
    morph: bool = False
    timeout_s: int = 30
    signature_override: str = ""
    user_words: tuple[str, ...] = ()

    @classmethod
    def of(cls, env: Mapping[str, str] | None = None, **given) -> Config:
        """Settings by OCR_* variables, then by arguments."""
        env = os.environ if env is None else env
        kinds = {n: type(getattr(cls(), n)) for n in cls.__dataclass_fields__}
        found = {}
        for name, kind in kinds.items():
            raw = env.get(f"OCR_{name.upper()}")
            if raw is not None and kind is not tuple:
                found[name] = raw.strip().lower() in ("1", "true", "yes", "on") if kind is bool else kind(raw)
        out = cls(**found | given)
        return replace(out, mode=page_mode(out.mode))


def image_profile(config: Config, width: int, height: int, luma: float) -> Config:
    """The settings for one image: small ones are enlarged, bright ones binarised globally; dark screens as configured."""
    if not config.router:
        return replace(config, profile="dark_ui")
    if min(width, height) < 720:
        return replace(config, profile="low_res", scale=1080)
    if luma > 180:
        return replace(config, profile="light_doc", contrast=min(config.contrast, 1.2), binarise="otsu")
    return replace(config, profile="dark_ui")


def signature(config: Config, profile: str | None = None) -> str:
    if config.signature_override:
        return config.signature_override
    parts = {
        "lang": config.language, "psm": config.mode, "pre": config.version if config.preprocess else "off", "profile": profile or config.profile,
        "scale": config.scale, "ctr": config.contrast, "shp": config.sharpness, "bin": config.binarise,
    }
    return "|".join(["tesseract", *[f"{k}={v}" for k, v in parts.items()]])


def prepare_image(content: bytes, config: Config):
    """(image for the engine, settings used); needs Pillow."""
    from PIL import Image, ImageEnhance, ImageOps, ImageStat

    image = Image.open(io.BytesIO(content)).convert("RGB")
    grey = image.convert("L")
    used = image_profile(config, *image.size, ImageStat.Stat(grey).mean[0])
    if not used.preprocess:
        return image, used
    short = min(grey.size)
    if short < used.scale:
        grey = grey.resize(tuple(max(1, round(x * used.scale / short)) for x in grey.size), Image.LANCZOS)
    grey = ImageEnhance.Sharpness(ImageEnhance.Contrast(grey).enhance(used.contrast)).enhance(used.sharpness)
    if used.invert == "always" or (used.invert == "auto" and ImageStat.Stat(grey).mean[0] < 127):
        grey = ImageOps.invert(grey)
    if used.binarise == "adaptive":
        grey = Image.fromarray(adaptive(np.asarray(grey)))
    elif used.binarise == "otsu":
        level = otsu_level(grey.histogram())
        grey = grey.point(lambda v: 255 if v > level else 0)
    if used.morph and used.binarise in ("adaptive", "otsu"):
        grey = Image.fromarray(opened(np.asarray(grey)))
    return grey, used


def adaptive(grey: np.ndarray, block: int = 31, offset: int = 10) -> np.ndarray:
    """White where a pixel is above the Gaussian mean of its block x block surroundings less ``offset``, else black."""
    half = block // 2
    at = np.arange(-half, half + 1)
    weight = np.exp(-(at**2) / (2 * (0.3 * (half - 1) + 0.8) ** 2))
    mean = grey.astype(float)
    for axis in (0, 1):
        wide = np.pad(mean, [(half, half) if a == axis else (0, 0) for a in (0, 1)], mode="edge")
        mean = sum(w * np.take(wide, np.arange(i, i + mean.shape[axis]), axis) for i, w in enumerate(weight / weight.sum()))
    return np.where(grey > mean - offset, 255, 0).astype(np.uint8)


def opened(binary: np.ndarray) -> np.ndarray:
    """White specks below 2 x 2 pixels go: the least of each 2 x 2 square, then the most. Outside counts as white, then as black."""
    for best, fill in ((np.minimum, 255), (np.maximum, 0)):
        before = best is np.minimum
        wide = np.pad(binary, ((1, 0), (1, 0)) if before else ((0, 1), (0, 1)), constant_values=fill)
        binary = best(best(wide[1:, 1:], wide[:-1, 1:]), best(wide[1:, :-1], wide[:-1, :-1]))
    return binary


def otsu_level(histogram: list[int]) -> int:
    """The grey level that parts a histogram with the largest variance between its sides."""
    total, weighted = sum(histogram), sum(i * n for i, n in enumerate(histogram))
    best, level, below, sum_below = -1.0, 0, 0, 0.0
    for i, n in enumerate(histogram):
        below += n
        sum_below += i * n
        if below and total - below:
            gap = sum_below / below - (weighted - sum_below) / (total - below)
            if below * (total - below) * gap * gap > best:
                best, level = below * (total - below) * gap * gap, i
    return level


def user_words(datasets: Iterable[str] = RECOGNISER_WORDS, lines: Iterable[str] = ()) -> tuple[str, ...]:
    """The words recognition is told of: the built-in ones of the datasets and a file's lines, sorted, each once."""
    own = (w for d in datasets for w in RECOGNISER_WORDS.get(d, ()))
    return tuple(sorted({w for w in (x.strip() for x in (*own, *lines)) if w and not w.startswith("#")}))


def _options(config: Config) -> str:
    """The engine's options; user words go to a file of the worker that runs, since options name one."""
    if not config.user_words:
        return f"--psm {config.mode}"
    name = hashlib.sha256("\n".join(config.user_words).encode()).hexdigest()[:16]
    path = os.path.join(tempfile.gettempdir(), f"quillmill-words-{os.getpid()}-{name}.txt")
    if not os.path.exists(path):
        with open(path, "w", encoding="utf-8") as f:
            f.write("\n".join(config.user_words) + "\n")
    return f'--psm {config.mode} --user-words "{path}"'


def tesseract(content: bytes, config: Config) -> tuple[str, str]:
    """(text or a sentinel, signature) by pytesseract, where it and Pillow are installed."""
    try:
        import pytesseract

        image, used = prepare_image(content, config)
    except ImportError as e:
        return f"OCR_ERROR_IMPORT: {e}", signature(config)
    try:
        text = pytesseract.image_to_string(image, lang=used.language, config=_options(used), timeout=used.timeout_s)
    except RuntimeError as e:
        return (TIMEOUT if "timeout" in str(e).lower() else f"OCR_ERROR_REAL: {e}"), signature(used)
    except Exception as e:  # noqa: BLE001  an image that cannot be read becomes a row, not a failed job
        return f"OCR_ERROR_REAL: {e}", signature(used)
    return text.strip() or EMPTY, signature(used)


Engine = Callable[[bytes, Config], tuple[str, str]]


def recognised(df: DataFrame, config: Config, engine: Engine = tesseract) -> DataFrame:
    """image_path and image_content -> image_path, file_hash, dataset_id, extracted_text, ocr_signature; one pass."""
    rows = df.select("image_path", F.sha2("image_content", 256).alias("file_hash"), dataset_of_path(F.col("image_path")).alias("dataset_id"), "image_content")

    def run(batches: Iterable[pd.DataFrame]):
        for pdf in batches:
            out = [engine(bytes(c), config) if c is not None else ("OCR_ERROR_REAL: no content", signature(config)) for c in pdf["image_content"]]
            yield pdf.drop(columns="image_content").assign(extracted_text=[t for t, _ in out], ocr_signature=[s for _, s in out])

    return rows.mapInPandas(run, "image_path string, file_hash string, dataset_id string, extracted_text string, ocr_signature string")


def text_metrics(df: DataFrame, text: str, keywords: Iterable[str]) -> DataFrame:
    """chars, lines, cjk_gaps, hits, is_error, is_empty of each text."""
    t = F.coalesce(F.col(text), F.lit(""))
    return df.withColumns(
        {
            "chars": F.length(t).cast("long"),
            "lines": F.size(F.filter(F.split(t, "\n"), lambda x: F.trim(x) != "")).cast("long"),
            "cjk_gaps": cjk_gaps(t).cast("long"),
            "hits": F.size(keyword_hits(t, keywords)).cast("long"),
            "is_error": t.startswith("OCR_ERROR_"),
            "is_empty": (tidy(t) == "") | (t == EMPTY),
        }
    )


def side_summary(metrics: DataFrame, side: str) -> DataFrame:
    """Per side: rows, error and empty rows, average length (1 decimal) and gaps (2 decimals), total hits."""
    return metrics.groupBy(side).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("is_error"), 1)).alias("error_rows"),
        F.count(F.when(F.col("is_empty"), 1)).alias("empty_rows"),
        F.round(F.avg("chars"), 1).alias("avg_chars"),
        F.round(F.avg("cjk_gaps"), 2).alias("avg_cjk_gaps"),
        F.sum("hits").alias("total_hits"),
    )


def compare_modes(df: DataFrame, config: Config, modes: tuple[str, str], keywords: Iterable[str], engine: Engine = tesseract) -> DataFrame:
    """Both modes over the same images, on the executors: ``side_summary`` by psm."""
    sides = [recognised(df, replace(config, mode=page_mode(m)), engine).withColumn("psm", F.lit(page_mode(m))) for m in modes]
    return side_summary(text_metrics(sides[0].unionByName(sides[1]), "extracted_text", list(keywords)), "psm")
