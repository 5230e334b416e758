"""Object keys: safe names that Spark's file scans do not pass over, and names that do not collide."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterable
from datetime import UTC, datetime

from ..functions.text import dataset_key

_PLAIN = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def _only(name: str, more: str, stand_in: str) -> str:
    return "".join(c if c in _PLAIN or c in more else stand_in for c in name)


def file_name(name: str, now: datetime | None = None) -> str:
    """A base name of letters, digits, ``.``, ``_`` and ``-``, not led by ``_`` or ``.``: file scans skip such names."""
    base = "_".join(p for p in _only(posixpath.basename(name.replace("\\", "/")).strip(), "._-", "_").split("_") if p)
    if not base or set(base) == {"."}:
        raise ValueError(f"no file name in {name!r}")
    stem, dot, ext = base.rpartition(".")
    if not dot:
        stem, ext = base, ""
    stem = stem.lstrip("._").rstrip("_") or f"image_{(now or datetime.now(UTC)):%Y%m%d_%H%M%S}"
    return f"{stem}.{ext}" if ext else stem


def object_key(name: str, dataset: str, folder: str | None = None, prefix: str = "raw/images") -> str:
    """prefix/dataset/[folder/]name, each part made safe; the dataset must be a valid id."""
    inner = posixpath.normpath("/" + _only((folder or "").replace("\\", "/"), "/_-", "")).strip("/")
    return "/".join(p for p in (prefix.strip("/"), dataset_key(dataset, strict=True), inner, file_name(name)) if p)


def full_paths(names: Iterable[str | None], bucket: str, base: str = "raw/images") -> list[str]:
    """Full paths of names given in short (see ``text.object_path``), without blanks, each once, in order."""
    out = []
    for name in (str(n or "").strip().replace("\\", "/") for n in names):
        if name.startswith("s3a://"):
            out.append(name)
        elif name.startswith("raw/"):
            out.append(f"s3a://{bucket}/{name}")
        elif name:
            out.append(f"s3a://{bucket}/{base if '/' not in name else 'raw/images'}/{name.lstrip('/')}")
    return list(dict.fromkeys(out))


def free_key(key: str, taken: Callable[[str], bool], overwrite: bool = False, now: datetime | None = None) -> tuple[str, bool]:
    """(key to write, whether it was renamed): a taken key gets a time, and then a number, before its extension."""
    if overwrite or not taken(key):
        return key, False
    stem, ext = posixpath.splitext(key)
    stamp = f"{(now or datetime.now(UTC)):%Y%m%d_%H%M%S}"
    for n in range(1 << 20):
        other = f"{stem}_{stamp}{f'_{n}' if n else ''}{ext}"
        if not taken(other):
            return other, True
    raise RuntimeError(f"no free name for {key}")
