"""The layers as plans: recognised images -> bronze -> silver -> gold, each a staged write with its gates."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, in_dataset, split_tokens
from ..operators import audit, corpus, funnel, gates, lexicon, recognise, rows, segment, snapshots
from ..operators.values import DRINKS, TopicRules
from ..sources import files
from ..sources.store import TableStore

SILVER_VERSION = "v2.1.0"


class Layers:
    """The tables of a deployment and the plans over them. ``metrics`` is a folder for run records, or None."""

    def __init__(self, store: TableStore, rules: TopicRules = DRINKS, metrics: str | None = None, version: str = SILVER_VERSION):
        self.store, self.spark, self.rules, self.metrics, self.version = store, store.spark, rules, metrics, version

    def _recorded(self, name: str, dataset: str | None, run):
        began, status, out = time.time(), "ok", {}
        try:
            out = run()
            return out
        except Exception as e:
            status = "failed"
            detail = e.detail if isinstance(e, gates.GateError) and isinstance(e.detail, Mapping) else {}
            out = {k: detail[k] for k in ("melted", "blocked") if k in detail}
            raise
        finally:
            if self.metrics:
                flags = {k: out[k] for k in ("melted", "blocked") if k in out}
                files.append_metric(self.spark, self.metrics, {"etl_name": name, "dataset_id": dataset, "status": status, "duration_ms": (time.time() - began) * 1000} | flags)

    # bronze -----------------------------------------------------------------------------------------------------------

    def gap(self, raw: DataFrame) -> DataFrame:
        """The raw images that bronze does not hold."""
        return rows.skip_known(raw, self.store.read("bronze"), ["image_path"]) if self.store.exists("bronze") else raw

    def bronze(self, images: DataFrame, config: recognise.Config, bucket: str, mode: str = "append", engine=recognise.tesseract, history: str | None = "bronze_history") -> dict:
        """Recognises images once, into a staging table; error rows are counted and dropped. The signature an image
        would get is known beforehand where the settings do not depend on it, so appends skip what is there."""

        def run():
            todo = self.gap(images) if mode == "append" else images
            staged = recognise.recognised(todo, config, engine).withColumn("ingestion_timestamp", F.current_timestamp()).withColumn("source_bucket", F.lit(bucket))
            self.store.overwrite("bronze_staging", staged)
            done = self.store.read("bronze_staging")
            good = done.filter(~F.col("extracted_text").startswith("OCR_ERROR_"))
            counts = done.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("extracted_text").startswith("OCR_ERROR_"), 1)).alias("bad")).first()
            if counts.n > counts.bad or mode == "overwrite":
                self.store.write("bronze", good, mode, ["image_path"], history)
            return {"seen": counts.n, "errors": counts.bad, "written": counts.n - counts.bad}

        return self._recorded("bronze_ocr", None, run)

    # silver -----------------------------------------------------------------------------------------------------------

    def silver_rows(self, bronze: DataFrame, cjk: bool = False) -> DataFrame:
        clean = bronze.withColumn("cleaned_text", clean_text(F.col("extracted_text")))
        tokens = segment.segmented(F.col("cleaned_text")) if cjk else split_tokens(F.col("cleaned_text"))
        return clean.withColumn("tokens", tokens).withColumn("silver_transform_version", F.lit(self.version))

    def silver(self, dataset: str | None = None, cjk: bool = False, mode: str = "soft", images: Sequence[str] | None = None) -> dict:
        """Latest rows, quarantine, cleaning, tokens; what changed is merged; the quality gate passes before publishing.
        ``images`` limits a run to the images named."""

        def run():
            bronze = in_dataset(self.store.read("bronze"), dataset)
            ready = rows.prepare_for_silver(bronze if images is None else rows.of_images(bronze, images), dataset)
            ok, decision = gates.quarantine(ready, lambda r: self.store.append("bronze_quarantine", r), "bronze", mode)
            source = self.silver_rows(ok.select("image_path", "extracted_text", "source_bucket", "latest_ingestion_timestamp", "dataset_id"), cjk)
            if self.store.exists("silver"):
                self.store.add_columns("silver", {"silver_transform_version": "string", "tokens": "array<string>"})
                changed = rows.changed_rows(source, self.store.read("silver"), self.version)
            else:
                changed = source.withColumn("is_new", F.lit(True))
            self.store.overwrite("silver_staging", changed.withColumn("etl_update_timestamp", F.current_timestamp()))
            staged = self.store.read("silver_staging")
            counts = staged.agg(F.count(F.when(F.col("is_new"), 1)).alias("new"), F.count(F.when(~F.col("is_new"), 1)).alias("old")).first()
            merge = staged.drop("is_new").withColumnRenamed("latest_ingestion_timestamp", "ingestion_timestamp")
            after = rows.upserted(self.store.read("silver"), merge, ["image_path"]) if self.store.exists("silver") else merge
            verdict = gates.quality_gate(in_dataset(after, dataset))
            if counts.new + counts.old or not self.store.exists("silver"):
                self.store.overwrite("silver", after)
            return {"inserted": counts.new, "updated": counts.old, "warnings": verdict.warnings} | decision

        return self._recorded("silver_ocr_etl", dataset, run)

    # gold -------------------------------------------------------------------------------------------------------------

    def gold(self, dataset: str, lex: lexicon.Lexicon | None = None, least: int = 2, coalesce: int = 1) -> dict:
        """Topics as an appended snapshot; keywords and phrases replacing the dataset's; warnings about the results."""

        def run():
            lex_ = lex or lexicon.collect(dataset, self.rules)
            silver = lexicon.with_lexicon_tokens(in_dataset(self.store.read("silver"), dataset), lex_)
            self._topics(silver, dataset, lex_, coalesce)
            words = corpus.tfidf(silver, "image_path", "tfidf_exploration_tokens")
            self.store.replace_dataset("tfidf_keywords", words, dataset)
            self.store.replace_dataset("phrase_candidates", corpus.phrase_pmi(silver, "analytics_tokens", least), dataset)
            first = self.keywords(dataset, 10) if self.store.exists("tfidf_keywords") else []
            last = snapshots.latest(in_dataset(self.store.read("topic_snapshot"), dataset)).count()
            docs = silver.count()
            return {"documents": docs, "topics": last, "warnings": gates.gold_warnings(first, lex_.exploration, docs, last)}

        return self._recorded("gold", dataset, run)

    def _topics(self, silver: DataFrame, dataset: str, lex: lexicon.Lexicon, coalesce: int = 1, verify: bool = False) -> None:
        labelled = silver.filter(F.size("analytics_tokens") > 0).select(funnel.analysis(F.col("analytics_tokens"), rules=self.rules)["pain_topics"].alias("topics"))
        topics = snapshots.stamped(funnel.topic_frequency(labelled, "topics"), dataset, self.rules.version, lex.release_version, lex.release_hash)
        self.store.append("topic_snapshot", topics.coalesce(coalesce))
        if verify:
            self.store.verify("topic_snapshot", f"dataset_id = '{dataset}'")

    def topics(self, dataset: str, lex: lexicon.Lexicon | None = None, verify: bool = False) -> dict:
        """The topics alone, as a new snapshot: after a change of rules or word lists. ``verify`` reads it back strictly."""

        def run():
            lex_ = lex or lexicon.collect(dataset, self.rules)
            self._topics(lexicon.with_lexicon_tokens(in_dataset(self.store.read("silver"), dataset), lex_), dataset, lex_, verify=verify)
            return {"topics": snapshots.latest(in_dataset(self.store.read("topic_snapshot"), dataset)).count()}

        return self._recorded("gold_topics", dataset, run)

    def audit(self, dataset: str, manifest: Mapping, lex: lexicon.Lexicon | None = None, offline: bool = False) -> list[audit.Finding]:
        """The dataset's findings, from its tables, or from settings and word lists alone if ``offline``."""
        lex_ = lex or lexicon.collect(dataset, self.rules)
        if offline:
            return audit.run_audit(manifest, lex_, self.version, self.rules.version)
        bronze, silver, gold = (in_dataset(self.store.read(t), dataset) if self.store.exists(t) else None for t in ("bronze", "silver", "topic_snapshot"))
        at = (manifest.get("gold") or {}).get("approved_snapshot_at")
        found = None if gold is None or not at else snapshots.verified(gold, dataset, F.to_timestamp(F.lit(at)))
        return audit.run_audit(manifest, lex_, self.version, self.rules.version, audit.table_facts(bronze, silver, gold), found)

    def keywords(self, dataset: str, k: int) -> list[str]:
        table = in_dataset(self.store.read("tfidf_keywords"), dataset)
        return [r.keyword for r in corpus.top(table, "tfidf_score", k, "keyword").collect()]

    def to_gold(self, images: DataFrame, dataset: str, config: recognise.Config, bucket: str, engine=recognise.tesseract, cjk: bool = False) -> dict:
        """One go: the images not ingested yet, then silver and gold; nothing new stops after the first step."""

        def run():
            out = {"bronze": self.bronze(images, config, bucket, "append", engine)}
            if not out["bronze"]["written"] and self.store.exists("topic_snapshot"):
                return out | {"skipped": True}
            out["silver"] = self.silver(dataset, cjk)
            out["gold"] = self.gold(dataset)
            return out | {k: out["silver"][k] for k in ("melted", "blocked")}

        return self._recorded("pipeline_to_gold", dataset, run)
