"""Running jobs: one slot, memory and batch limits, time limits by job tags, background jobs, readiness and the probe."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from ..operators import audit
from ..sources import files


class LimitError(RuntimeError):
    """A run that a limit keeps from starting or going on."""


@dataclass(frozen=True)
class Limits:
    # The limits that deployments start from.
    slots: int = 1
    memory_percent: float = 85.0
    free_mb: int = 1536
    images: int = 100
    files: int = 20
    seconds: float = 300.0


def memory() -> dict:
    """percent used and available_mb of this machine; empty where psutil is not installed."""
    try:
        import psutil
    except ImportError:
        return {}
    m = psutil.virtual_memory()
    return {"percent": m.percent, "available_mb": m.available >> 20}


def check_memory(limits: Limits, now: Mapping | None = None) -> None:
    now = memory() if now is None else now
    if now and (now["percent"] >= limits.memory_percent or now["available_mb"] < limits.free_mb):
        raise LimitError(f"memory: {now['percent']:.0f} % used, {now['available_mb']} MB free")


def check_count(n: int, most: int, what: str) -> None:
    if n > most:
        raise LimitError(f"{n} {what}, {most} at most")


class Slots:
    """At most so many runs at once in this process; another one is refused, not queued."""

    def __init__(self, limits: Limits | None = None):
        self.limits = limits or Limits()
        self._free = threading.BoundedSemaphore(self.limits.slots)

    @contextmanager
    def slot(self, now: Mapping | None = None):
        check_memory(self.limits, now)
        if not self._free.acquire(blocking=False):
            raise LimitError(f"{self.limits.slots} runs at once at most")
        try:
            yield
        finally:
            self._free.release()


@contextmanager
def time_limit(spark: SparkSession, seconds: float):
    """Interrupts the jobs of this block, and only those, after so many seconds; then LimitError, whatever they raised."""
    tag, late = f"quillmill-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        spark.interruptTag(tag)

    timer = threading.Timer(seconds, stop)
    timer.daemon = True
    spark.addTag(tag)
    timer.start()
    try:
        yield
    except Exception as e:
        if late.is_set():
            raise LimitError(f"stopped after {seconds:g} s") from e
        raise
    finally:
        timer.cancel()
        spark.removeTag(tag)
    if late.is_set():
        raise LimitError(f"stopped after {seconds:g} s")


@dataclass
class Job:
    id: str
    name: str
    status: str = "queued"
    progress: dict = field(default_factory=dict)
    result: object = None
    error: str | None = None
    started_at: str | None = None
    finished_at: str | None = None


class Jobs:
    """Background runs of this process, with progress. ``run`` gets a function that reports it."""

    def __init__(self, keep: int = 200):
        self._jobs: dict[str, Job] = {}
        self._threads: dict[str, threading.Thread] = {}
        self._lock, self.keep = threading.Lock(), keep

    def start(self, name: str, run: Callable[[Callable[..., None]], object]) -> str:
        job = Job(uuid.uuid4().hex, name)

        def work() -> None:
            job.status, job.started_at = "running", datetime.now(UTC).isoformat()
            try:
                job.result = run(lambda **p: job.progress.update(p))
                job.status = "done"
            except Exception as e:  # noqa: BLE001  the job's outcome is its error
                job.status, job.error = "failed", str(e)
            finally:
                job.finished_at = datetime.now(UTC).isoformat()

        with self._lock:
            over = [i for i, j in self._jobs.items() if j.finished_at][: max(0, len(self._jobs) + 1 - self.keep)]
            for i in over:
                self._jobs.pop(i), self._threads.pop(i)
            self._jobs[job.id] = job
            self._threads[job.id] = threading.Thread(target=work, daemon=True)
        self._threads[job.id].start()
        return job.id

    def get(self, id_: str) -> Job | None:
        return self._jobs.get(id_)

    def wait(self, id_: str, seconds: float | None = None) -> Job:
        self._threads[id_].join(seconds)
        return self._jobs[id_]


def ready(spark: SparkSession | None, store_path: str | None = None) -> dict:
    """Whether the session answers and the store can be reached."""
    checks = {}
    for name, check in (
        ("spark", lambda: spark is None or spark.range(1).count() == 1),
        ("store", lambda: spark is None or store_path is None or files.exists(spark, store_path)),
    ):
        try:
            checks[name] = "ok" if check() else "down"
        except Exception as e:  # noqa: BLE001  any error means not ready
            checks[name] = f"down: {e}"
    ok = all(v == "ok" for v in checks.values())
    return {"status": "ok" if ok else "down", "checks": checks, "checked_at": datetime.now(UTC).isoformat()}


def release(manifest: Mapping) -> dict:
    """The release fields of a manifest, None where it has none."""
    gold = manifest.get("gold") or {}
    text = lambda v: str(v).strip() or None if v is not None else None
    count = gold.get("processed_image_count")
    return {
        "dataset_id": text(manifest.get("dataset_id")), "release_id": text(manifest.get("release_id")), "approved_snapshot_at": text(gold.get("approved_snapshot_at")),
        "processed_image_count": int(count) if count is not None else None, "release_lexicon_version": text(gold.get("release_lexicon_version") or gold.get("lexicon_version")),
        "topic_rule_version": text(gold.get("topic_rule_version")),
    }


def probe(dataset: str, readiness: Mapping, findings: Iterable[audit.Finding], alerts: Iterable[Mapping], strict: bool = True, notify: Callable[[str, list], None] | None = None) -> dict:
    """All that is wrong, from readiness, audit and freshness; ``notify`` is told if there is anything."""
    issues = [] if readiness.get("status") == "ok" else [{"source": "ready", "level": audit.FAIL, "check_id": "ready.down", "message": str(readiness.get("checks"))}]
    bad = (audit.FAIL, audit.WARN) if strict else (audit.FAIL,)
    issues += [{"source": "audit", "level": f.level, "check_id": f.check_id, "message": f.message} for f in findings if f.level in bad]
    issues += [{"source": "freshness", "level": audit.FAIL, "check_id": a["alert"], "message": f"since {a['since']}"} for a in alerts]
    if issues and notify:
        notify(dataset, issues)
    return {"dataset_id": dataset, "ok": not issues, "strict": strict, "issues": issues, "checked_at": datetime.now(UTC).isoformat()}
