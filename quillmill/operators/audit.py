"""Audits of versions, signatures and releases, freshness with lag state, approval, and their exit code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"


@dataclass
class Finding:
    check_id: str
    level: str
    message: str
    detail: dict = field(default_factory=dict)


def lexicon_drift(name: str, old_version: str | None, old_hash: str | None, version: str, content_hash: str) -> Finding:
    """A list must not change under an unchanged version."""
    detail = {"manifest_version": old_version, "manifest_hash": old_hash, "version": version, "hash": content_hash}
    if not old_hash:
        return Finding(f"gold.{name}_hash_missing", WARN, "the manifest holds no hash", detail)
    same_hash, same_version = old_hash == content_hash, old_version == version
    if not same_hash and same_version:
        return Finding(f"gold.{name}_silent_drift", FAIL, "the list changed but its version did not", detail)
    if not same_hash:
        return Finding(f"gold.{name}_bump", WARN, "list and version changed", detail)
    return Finding(f"gold.{name}_ok", PASS, "the list is the manifest's", detail)


def runtime(manifest: Mapping, silver_version: str, rule_version: str) -> list[Finding]:
    want_silver, want_rules = manifest.get("runtime", {}).get("silver_transform_version"), manifest.get("gold", {}).get("topic_rule_version")
    return [
        Finding("runtime.silver_version", FAIL if want_silver and want_silver != silver_version else PASS, f"silver version {silver_version}", {"expected": want_silver}),
        Finding("runtime.rule_version", WARN if want_rules and want_rules != rule_version else PASS, f"rule version {rule_version}", {"expected": want_rules}),
    ]


def signatures(found: Iterable[str], rows: int, allowed: Iterable[str]) -> Finding:
    found, allowed = sorted(set(found)), list(allowed)
    fits = lambda s: any(s == a or all(p.strip() in s for p in a.split("|") if p.strip()) for a in allowed)
    odd = [s for s in found if not fits(s)]
    if not rows:
        return Finding("bronze.empty", WARN, "no rows")
    if not allowed:
        return Finding("bronze.no_allow_list", WARN, "the manifest allows no signature", {"found": found})
    if odd:
        return Finding("bronze.unexpected_signature", FAIL, "signatures that are not allowed", {"unexpected": odd})
    if len(found) > 1:
        return Finding("bronze.mixed_signatures", WARN, "several signatures", {"found": found})
    return Finding("bronze.signatures_ok", PASS, "the signature is allowed", {"found": found})


def silver_versions(found: Iterable[str], expected: str) -> Finding:
    found = sorted(set(found))
    if expected not in found:
        return Finding("silver.version_missing", FAIL, f"no row has version {expected}", {"found": found})
    if found != [expected]:
        return Finding("silver.stale_version", FAIL, "rows of other versions", {"found": found})
    return Finding("silver.version_ok", PASS, f"all rows have version {expected}")


def topic_snapshot(rows: int, versions: Iterable[str], expected: str) -> Finding:
    versions = sorted(set(versions))
    if not rows:
        return Finding("gold.no_snapshot", WARN, "no snapshot")
    if expected not in versions:
        return Finding("gold.rule_version", WARN, "no snapshot by the present rules", {"found": versions})
    return Finding("gold.snapshot_ok", PASS, "snapshot by the present rules")


def approved_snapshot(manifest: Mapping, found: bool | None) -> Finding:
    at = manifest.get("gold", {}).get("approved_snapshot_at")
    if not at:
        return Finding("gold.not_approved", WARN, "no snapshot is approved")
    if found is None:
        return Finding("gold.approval_unknown", WARN, "the approved snapshot was not looked for", {"at": at})
    return Finding("gold.approved_ok", PASS, "the approved snapshot is there", {"at": at}) if found else Finding("gold.approved_missing", FAIL, "the approved snapshot is gone", {"at": at})


def bronze_facts(bronze: DataFrame) -> dict:
    """Row count and signatures."""
    return {"rows": bronze.count(), "signatures": distinct_few(bronze, "ocr_signature")}


def distinct_few(df: DataFrame, column: str, most: int = 1000) -> list[str]:
    """The trimmed, non-empty values of a column that holds versions or signatures; more than ``most`` of them raise."""
    if column not in df.columns:
        return []
    rows = df.select(F.trim(column).alias("v")).filter("v <> ''").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column}: more than {most} values, which are no versions")
    return sorted(r.v for r in rows)


def table_facts(bronze: DataFrame | None, silver: DataFrame | None, gold: DataFrame | None) -> dict:
    """What the audit asks of a dataset's tables; a missing table has no rows. Of snapshots the latest one's rules count."""
    count = lambda t: 0 if t is None else t.count()
    newest = None if gold is None else gold.join(F.broadcast(gold.agg(F.max("snapshot_at").alias("_qm_at"))), F.col("snapshot_at") == F.col("_qm_at"))
    return {
        "bronze_rows": count(bronze), "signatures": [] if bronze is None else distinct_few(bronze, "ocr_signature"),
        "silver_rows": count(silver), "versions": [] if silver is None else distinct_few(silver, "silver_transform_version"),
        "gold_rows": count(gold), "rule_versions": [] if newest is None else distinct_few(newest, "rule_version"),
    }


def exploration_note(lexicon) -> Finding:
    """For the record: the exploration list has a version of its own and may differ from the release's."""
    differ = lexicon.release_hash != lexicon.exploration_hash
    return Finding("gold.exploration_note", PASS, "exploration list differs from the release's" if differ else "both lists are the same", {"version": lexicon.exploration_version})


def run_audit(manifest: Mapping, lexicon, silver_version: str, rule_version: str, facts: Mapping | None = None, approved_found: bool | None = None) -> list[Finding]:
    """All findings of a dataset; without ``facts`` (offline) those about settings and word lists alone."""
    want, gold = manifest.get("runtime") or {}, manifest.get("gold") or {}
    out = runtime(manifest, silver_version, rule_version)
    if facts is not None:
        allowed = (manifest.get("bronze") or {}).get("allowed_ocr_signatures") or ()
        out.append(signatures(facts["signatures"], facts["bronze_rows"], allowed))
        out.append(silver_versions(facts["versions"], want.get("silver_transform_version") or silver_version))
        out.append(topic_snapshot(facts["gold_rows"], facts["rule_versions"], gold.get("topic_rule_version") or rule_version))
        out.append(approved_snapshot(manifest, approved_found))
    out.append(exploration_note(lexicon))
    out.append(lexicon_drift("release_lexicon", gold.get("release_lexicon_version"), gold.get("lexicon_content_hash"), lexicon.release_version, lexicon.release_hash))
    return out


def exit_code(findings: Iterable[Finding], strict: bool = False) -> int:
    levels = {f.level for f in findings}
    if FAIL in levels or (strict and WARN in levels):
        return 1
    return 2 if WARN in levels else 0


def report(findings: Iterable[Finding]) -> list[dict]:
    return [asdict(f) for f in findings]


def approved(manifest: Mapping, at: str, by: str = "", images: int | None = None) -> dict:
    """The manifest with a snapshot approved."""
    gold = dict(manifest.get("gold", {})) | {"approved_snapshot_at": at, "approved_by": by}
    if images is not None:
        gold["processed_image_count"] = images
    return dict(manifest) | {"gold": gold}


def revoked(manifest: Mapping) -> dict:
    gold = {k: v for k, v in manifest.get("gold", {}).items() if k not in ("approved_snapshot_at", "approved_by")}
    return dict(manifest) | {"gold": gold}


def with_hashes(manifest: Mapping, lexicon) -> dict:
    """The manifest with the present versions and hashes of both lists."""
    gold = dict(manifest.get("gold", {})) | {
        "release_lexicon_version": lexicon.release_version, "lexicon_content_hash": lexicon.release_hash,
        "exploration_lexicon_version": lexicon.exploration_version, "exploration_lexicon_content_hash": lexicon.exploration_hash,
    }
    return dict(manifest) | {"gold": gold}


def _since(active: bool, before: str | None, now: datetime) -> str | None:
    return (before or now.isoformat()) if active else None


def freshness(counts: Mapping, state: Mapping, now: datetime | None = None, limit_hours: float = 12) -> tuple[dict, list[dict]]:
    """(new state, alerts) of one dataset: a lag counts from when it was first seen, and is forgotten once made up."""
    now = now or datetime.now(UTC)
    raw, silver, release = (counts.get(k) for k in ("raw_image_count", "silver_image_count", "release_image_count"))
    new = {
        "upstream_lag_since": _since(raw is not None and silver is not None and raw > silver, state.get("upstream_lag_since"), now),
        "release_lag_since": _since(silver is not None and release is not None and silver > release, state.get("release_lag_since"), now),
        "last_checked_at": now.isoformat(),
    }
    alerts = []
    for key, name in (("upstream_lag_since", "upstream_stale"), ("release_lag_since", "release_stale")):
        if new[key] and now - datetime.fromisoformat(new[key]) >= timedelta(hours=limit_hours):
            alerts.append({"alert": name, "dataset_id": counts.get("dataset_id"), "since": new[key]})
    return new, alerts


def lag_table(raw: DataFrame, silver: DataFrame, release: DataFrame) -> DataFrame:
    """Per dataset the distinct images of each layer and both lags; inputs are (dataset_id, image_path)."""
    parts = [d.select("dataset_id", "image_path", F.lit(i).alias("layer")) for i, d in enumerate((raw, silver, release))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct().groupBy("dataset_id")
    n = [F.count(F.when(F.col("layer") == i, 1)).alias(c) for i, c in enumerate(("raw_images", "silver_images", "release_images"))]
    out = rows.agg(*n)
    return out.withColumns({"upstream_lag": F.greatest(F.col("raw_images") - F.col("silver_images"), F.lit(0)), "release_lag": F.greatest(F.col("silver_images") - F.col("release_images"), F.lit(0))})
