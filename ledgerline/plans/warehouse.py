"""The star schema over landed ledgers: typed staging, current rows, history, conformance, facts and dimensions.

A ``Models`` object builds each frame once, on demand, from the raw tables; nothing runs until a result is used. ``marts``
are what ``sources.landing.Warehouse`` publishes; ``checks`` are frames that must be empty.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..functions.typing import DECIMAL, difference_if_vetted, has_key, maybe_decimal, part_at, percent_fraction, surrogate_key, text_at
from ..operators import checks as C
from ..operators import history as H
from ..operators.conform import UNTRUSTED, conform, marks, trust_status, vetted
from ..operators.select import first_row, last_status, latest_complete, latest_live, newest_row, rows_of_current_run

#: Fields of each record with their types; "tri" is a decimal, a source error or nothing. Fixed by the files that are landed.
MANIFEST = {"manifest_schema_version": "int", "run_id": "string", "retrieved_at": "string", "state": "string", "filing_id": "string", "document_role": "string", "carrier_label_raw": "string", "plan_year": "int", "market": "string", "avg_rate_request_posted": "string", "source_url": "string", "source_item_key": "string", "http_status": "int", "etag": "string", "last_modified": "string", "sharepoint_version": "int", "content_type": "string", "content_length": "bigint", "content_hash": "string", "prior_content_hash": "string", "unchanged": "boolean", "stored_path": "string", "attempt_count": "int", "error": "string"}
OUTCOMES = {"run_id": "string", "filing_id": "string", "state": "string", "document_role": "string", "status": "string", "reason": "string", "stored_path": "string", "content_type": "string", "content_hash": "string", "filing_rows_emitted": "int", "plan_rows_emitted": "int", "justification_rows_emitted": "int", "fields_targeted": "int", "fields_populated": "int", "fields_missed": "int", "plan_count_stated": "int", "error_class": "string", "error_detail": "string", "llm_call_ids": "array<string>", "duration_ms": "int", "normalized_field_hash": "string", "normalized_hash_version": "int", "normalized_field_count": "int", "dry_run": "boolean", "ledger_version": "int"}
PLANS = {"filing_id": "string", "state": "string", "plan_year": "int", "run_id": "string", "schema_version": "int", "plan_id_hios": "string", "product_id": "string", "product_name": "string", "plan_name": "string", "metal": "string", "av_metal_value": "tri", "plan_category": "string", "plan_type": "string", "on_exchange": "boolean", "effective_date": "date", "cumulative_rate_change_pct": "tri", "approved_rate_change_pct": "tri", "current_enrollment": "int", "current_premium_pmpm": "tri", "loss_ratio": "tri", "adj_factor_av_cs": "tri", "adj_factor_csr_load": "tri", "adj_factor_provider_network": "tri", "adj_factor_non_ehb": "tri", "adj_factor_admin_expense": "tri", "adj_factor_taxes_fees": "tri", "adj_factor_profit_risk": "tri", "adj_factor_catastrophic": "tri", "plan_adjusted_index_rate": "tri", "calib_age": "tri", "calib_geo": "tri", "calib_tobacco": "tri", "calibrated_plan_adjusted_index_rate": "tri", "provenance": "variant"}
FILINGS = {"filing_id": "string", "state": "string", "plan_year": "int", "market": "string", "run_id": "string", "schema_version": "int", "company_legal_name": "string", "hios_issuer_id": "string", "naic_number": "string", "serff_tracking_number": "string", "binder_id": "string", "toi_code": "string", "effective_date": "date", "date_submitted": "date", "avg_rate_change_requested": "tri", "rate_change_min": "tri", "rate_change_max": "tri", "avg_rate_change_approved": "tri", "total_additional_revenue": "tri", "covered_lives": "int", "policyholders": "int", "plan_count_stated": "int", "rating_areas": "array<string>", "product_types": "array<string>", "provenance": "variant"}
JUSTIFICATIONS = {"filing_id": "string", "state": "string", "plan_year": "int", "run_id": "string", "schema_version": "int", "driver_category": "string", "driver_label": "string", "narrative": "string", "quantified_impact_pct": DECIMAL, "direction": "string", "source_document_role": "string", "source_page_start": "int", "source_page_end": "int", "evidence_quote": "string", "confidence": DECIMAL, "provenance": "variant"}
MISSES = {"run_id": "string", "filing_id": "string", "document_role": "string", "model_name": "string", "field_name": "string", "reason": "string", "detail": "string", "ledger_version": "int"}
CALLS = {"call_id": "string", "run_id": "string", "filing_id": "string", "document_role": "string", "target_section": "string", "model": "string", "effort": "string", "estimated_input_tokens": "bigint", "input_tokens": "bigint", "output_tokens": "bigint", "cache_creation_tokens": "bigint", "cache_read_tokens": "bigint", "stop_reason": "string", "latency_ms": "int", "attempt": "int", "cost_usd": DECIMAL, "prompt_sha256": "string", "request_id": "string", "error": "string", "cost_log_version": "int"}
QUARANTINE = {"run_id": "string", "quarantined_at": "string", "rule_id": "string", "severity": "string", "kind": "string", "grain": "string", "state": "string", "filing_id": "string", "subject_key": "string", "field_name": "string", "observed": "string", "expected": "string", "message": "string", "origin": "string", "extraction_method": "string", "source_document_role": "string", "source_locator": "string", "provenance_absent_reason": "string", "extract_run_id": "string", "extract_path": "string", "reprocess_status": "string", "dq_schema_version": "int"}
RESULTS = {"run_id": "string", "rule_id": "string", "kind": "string", "grain": "string", "severity": "string", "check": "string", "evaluated": "int", "passed": "int", "violated": "int", "inapplicable": "int", "not_evaluated": "int", "adopted": "int", "resolved": "int", "scope": "string", "states": "array<string>", "dq_schema_version": "int"}
SEED = "state string, hios_issuer_id string, submission_identifier string, issuer_name_federal string, avg_rate_prelim_pct decimal(38,18), avg_rate_final_pct decimal(38,18), review_status_code string, current_status_date string, retrieved_at date"
LINEAGE = ("source_file", "source_line", "loaded_at", "load_id")


def typed(raw: DataFrame, fields: Mapping[str, str], renames: Mapping[str, str] | None = None, **more) -> DataFrame:
    """A raw table with its fields typed, its lineage, and derived columns of the payload."""
    p, out = F.col("payload"), []
    for name, kind in fields.items():
        alias = (renames or {}).get(name, name)
        if kind == "tri":
            out += maybe_decimal(p, name, alias)
        else:
            out.append((part_at(p, name) if kind == "variant" else text_at(p, name, kind)).alias(alias))
    return raw.select(*out, *[c.alias(n) for n, c in more.items()], *LINEAGE)


class Models:
    """Every frame of the warehouse by name."""

    def __init__(self, raw: Mapping[str, DataFrame], seed: DataFrame | None = None) -> None:
        self.raw = raw
        spark = next(iter(raw.values())).sparkSession
        self.seed = seed if seed is not None else spark.createDataFrame([], SEED)

    # staging: every run, typed

    @cached_property
    def manifest(self) -> DataFrame:
        p = F.col("payload")
        return typed(self.raw["ingest_manifest"], MANIFEST, has_posted_avg_rate=has_key(p, "avg_rate_request_posted"), avg_rate_request_posted_fraction=percent_fraction(text_at(p, "avg_rate_request_posted")))

    @cached_property
    def outcomes(self) -> DataFrame:
        p = F.col("payload")
        return typed(self.raw["extraction_outcomes"], OUTCOMES, has_normalized_hash=has_key(p, "normalized_field_hash"), has_dry_run_flag=has_key(p, "dry_run"))

    @cached_property
    def plans(self) -> DataFrame:
        return typed(self.raw["plan_extracts"], PLANS)

    @cached_property
    def filings(self) -> DataFrame:
        entries = text_at(F.col("payload"), "provenance", "map<string, struct<source_document_role string>>")
        role = F.array_min(F.transform(F.map_values(entries), lambda v: v["source_document_role"]))
        return typed(self.raw["filing_extracts"], FILINGS, source_document_role=role)

    @cached_property
    def justifications(self) -> DataFrame:
        rows = typed(self.raw["justification_extracts"], JUSTIFICATIONS)
        return rows.select("*", F.col("source_line").alias("justification_ordinal"), surrogate_key("filing_id", "run_id", "source_file", "source_line").alias("justification_key"))

    @cached_property
    def misses(self) -> DataFrame:
        return typed(self.raw["field_misses"], MISSES)

    @cached_property
    def calls(self) -> DataFrame:
        return typed(self.raw["llm_calls"], CALLS)

    @cached_property
    def quarantine(self) -> DataFrame:
        return typed(self.raw["quarantine"], QUARANTINE)

    @cached_property
    def results(self) -> DataFrame:
        return typed(self.raw["dq_results"], RESULTS, {"check": "check_name"}, has_scope=has_key(F.col("payload"), "scope"))

    # current rows

    @cached_property
    def current_runs(self) -> DataFrame:
        return latest_live(self.outcomes, ["filing_id"], "run_id", "dry_run")

    def _current(self, rows: DataFrame) -> DataFrame:
        return rows_of_current_run(rows, self.current_runs, ["filing_id", "run_id"])

    @cached_property
    def plans_current(self) -> DataFrame:
        return self._current(self.plans)

    @cached_property
    def filings_current(self) -> DataFrame:
        return self._current(self.filings)

    @cached_property
    def justifications_current(self) -> DataFrame:
        return self._current(self.justifications)

    @cached_property
    def quarantine_current(self) -> DataFrame:
        """The findings of the latest complete validation, each as it last stood; none at all without such a run."""
        rows = self.quarantine.join(F.broadcast(latest_complete(self.results)), "run_id")
        return last_status(rows, ["rule_id", "filing_id", "subject_key", "field_name", "extract_run_id"], "quarantined_at", "source_line")

    # history

    @cached_property
    def document_versions(self) -> DataFrame:
        """One row per run of equal content of a document, with what changed since the one before by three signals."""
        key, seq = ["filing_id", "document_role"], "content_version_seq"
        seen = ["etag", "last_modified", "sharepoint_version", "http_status", "source_url", "source_item_key", "carrier_label_raw", "stored_path"]
        good = self.manifest.where(F.col("error").isNull() & F.col("content_hash").isNotNull())
        numbered = H.with_episode(good, key, ["retrieved_at", "source_line"], "content_hash", seq)
        first = F.min_by(F.struct(*seen), F.struct("retrieved_at", "source_line"))
        versions = numbered.groupBy(*key, seq).agg(
            *[f(c).alias(n) for f, c, n in ((F.min, "content_hash", "content_hash"), (F.min, "state", "state"), (F.min, "retrieved_at", "first_seen_at"), (F.max, "retrieved_at", "last_seen_at"), (F.min, "run_id", "first_run_id"), (F.max, "run_id", "last_run_id"))],
            F.count("*").alias("sighting_count"),
            first.alias("first"),
        ).select("*", "first.*").drop("first").withColumnRenamed("http_status", "http_status_at_first_sight")
        live_first = [F.coalesce("dry_run", F.lit(False)).asc(), F.col("run_id").desc_nulls_last(), F.col("source_line").desc()]
        by_bytes = first_row(self.outcomes.where("content_hash is not null"), [*key, "content_hash"], live_first)
        extraction = by_bytes.select(*key, "content_hash", F.col("run_id").alias("extract_run_id"), F.col("status").alias("extract_status"), "normalized_field_hash", "normalized_hash_version", "normalized_field_count", "has_normalized_hash")
        joined = versions.join(extraction, [*key, "content_hash"], "left").withColumn("has_normalized_hash", F.coalesce("has_normalized_hash", F.lit(False)))
        compared = ["content_hash", "etag", "last_modified", "sharepoint_version", "normalized_field_hash", "normalized_hash_version"]
        v = H.with_previous(joined, key, seq, compared)
        now, then = (lambda c: F.col(c)), (lambda c: F.col(f"prior_{c}"))
        later = F.col(seq) > 1
        validator = H.moved(now("etag"), then("etag")) | H.moved(now("last_modified"), then("last_modified")) | H.moved(now("sharepoint_version"), then("sharepoint_version"))
        same_kind = ~H.moved(now("normalized_hash_version"), then("normalized_hash_version"))
        return v.withColumns({
            "is_current": F.col(seq) == F.max(seq).over(Window.partitionBy(*key)),
            "validator_moved": F.when(later, validator),
            "bytes_moved": F.when(later, F.lit(True)),
            "fields_moved": F.when(later & same_kind, H.moved_if_known(now("normalized_field_hash"), then("normalized_field_hash"))),
        })

    @cached_property
    def version_transitions(self) -> DataFrame:
        return self.document_versions.where("content_version_seq > 1").withColumn("reading", H.transition_reading(F.col("validator_moved"), F.col("fields_moved")))

    @cached_property
    def rechecks(self) -> DataFrame:
        m = self.manifest
        kind = H.change_class(m["error"], m["prior_content_hash"], F.coalesce(m["http_status"] == 304, F.lit(False)), F.coalesce(m["unchanged"], F.lit(False)))
        return m.groupBy("run_id", kind.alias("change_class")).agg(F.count("*").alias("documents"), F.count_if(F.col("state") == "PA").alias("pa_documents"), F.count_if(F.col("state") == "OR").alias("or_documents"))

    @cached_property
    def extractor_drift(self) -> DataFrame:
        hashed = self.outcomes.where(F.col("has_normalized_hash") & F.col("content_hash").isNotNull())
        pairs = H.drift_pairs(hashed, ["filing_id", "document_role", "content_hash"], "run_id", "dry_run", ["normalized_field_hash", "normalized_hash_version", "normalized_field_count"])
        return pairs.withColumn("reading", H.drift_reading(*[F.col(f"normalized_{c}_{s}") for c in ("field_hash", "hash_version") for s in "ab"]))

    @cached_property
    def document_currency(self) -> DataFrame:
        """What each document's last sighting found, and whether what was extracted of it is what was last seen."""
        key = ["filing_id", "document_role"]
        ok = F.col("error").isNull() & F.col("content_hash").isNotNull()
        seen = H.sightings_with_prior(self.manifest, key, ["retrieved_at", "source_line"], ok, ["content_hash", "source_url", "source_item_key"])
        before = F.lag(F.struct("carrier_label_raw")).over(H.ordered(key, ["retrieved_at", "source_line"]))  # of any sighting
        seen = seen.withColumn("relabeled", F.coalesce(before.isNotNull() & ~F.col("carrier_label_raw").eqNullSafe(before["carrier_label_raw"]), F.lit(False)))
        last = newest_row(seen, key, "retrieved_at", "source_line")
        known = F.when(ok, F.col("content_hash")).otherwise(F.col("prior_ok_content_hash"))
        done = newest_row(self.outcomes.withColumn("__live", ~F.coalesce("dry_run", F.lit(False))), key, "__live", "run_id", "source_line").select(*key, F.col("content_hash").alias("extracted_hash"), F.lit(True).alias("has_row"))
        out = last.join(done, key, "left")
        return out.select(
            *key,
            "run_id",
            H.change_class(F.col("error"), F.col("prior_ok_content_hash"), F.coalesce(F.col("http_status") == 304, F.lit(False)), F.coalesce(F.col("unchanged"), F.lit(False)) | (F.col("content_hash") == F.col("prior_ok_content_hash"))).alias("change_class"),
            (F.coalesce(F.col("content_hash") == F.col("prior_ok_content_hash"), F.lit(False)) & (H.moved(F.col("source_url"), F.col("prior_ok_source_url")) | H.moved(F.col("source_item_key"), F.col("prior_ok_source_item_key")))).alias("moved"),
            "relabeled",
            H.currency(known, F.col("extracted_hash"), F.col("has_row"), ~ok).alias("currency"),
        )

    @cached_property
    def stale_filings(self) -> DataFrame:
        """Filings with a stale document: what to extract again."""
        return self.document_currency.where(F.col("currency") == "stale").select("filing_id").distinct()

    @cached_property
    def company_history(self) -> DataFrame:
        known = self.crosswalk.select("filing_id", "hios_issuer_id")
        labels = self.manifest.where("error is null").join(known, "filing_id").groupBy("hios_issuer_id", "run_id").agg(F.min("retrieved_at").alias("observed_at"), F.min("carrier_label_raw").alias("carrier_label_raw"))
        return H.type2(labels, "hios_issuer_id", "run_id", "observed_at", "carrier_label_raw", H.FLOOR)

    # conformance

    @cached_property
    def conformed(self) -> DataFrame:
        workbook = "urrt"
        first = {c: (workbook, True) for c in ("serff_tracking_number", "hios_issuer_id", "toi_code", "effective_date", "date_submitted")}
        plain = {"state": F.min, "plan_year": F.min, "market": F.min} | {c: F.max for c in ("run_id", "naic_number", "binder_id", "company_legal_name", "avg_rate_change_approved", "rate_change_min", "rate_change_max", "total_additional_revenue", "covered_lives", "policyholders", "plan_count_stated")}
        out = conform(self.filings_current, ["filing_id"], "source_document_role", first | {"avg_rate_change_requested": (workbook, False)}, plain, ["avg_rate_change_requested", "avg_rate_change_approved"])
        posted = newest_row(self.manifest.where("has_posted_avg_rate"), ["filing_id"], "retrieved_at", "source_line")
        return out.join(posted.select("filing_id", "avg_rate_request_posted", "avg_rate_request_posted_fraction"), "filing_id", "left")

    @cached_property
    def crosswalk(self) -> DataFrame:
        s = self.seed.select("state", "hios_issuer_id", F.col("submission_identifier").alias("federal_submission_id"), "issuer_name_federal", F.col("avg_rate_prelim_pct").alias("federal_avg_rate_prelim_pct"), F.col("avg_rate_final_pct").alias("federal_avg_rate_final_pct"), F.col("review_status_code").alias("federal_review_status_code"))
        f = self.conformed.select("filing_id", "state", "hios_issuer_id", "serff_tracking_number", "binder_id", "naic_number", "toi_code", F.lit(None).cast("string").alias("sub_trk_num"))
        return f.join(s, ["state", "hios_issuer_id"], "left").withColumn("match_method", F.when(F.col("federal_submission_id").isNotNull(), "hios_issuer_id"))

    # marts

    @cached_property
    def dim_company(self) -> DataFrame:
        who = self.conformed.groupBy("hios_issuer_id").agg(F.min("state").alias("state"), F.max("company_legal_name").alias("company_legal_name"), F.max("naic_number").alias("naic_number"))
        h = self.company_history.join(who, "hios_issuer_id", "left")
        return h.select(surrogate_key("hios_issuer_id", "valid_from").alias("company_key"), "hios_issuer_id", "carrier_label_raw", "company_legal_name", F.coalesce("company_legal_name", "carrier_label_raw").alias("display_name"), "naic_number", "state", "version_seq", "valid_from", "valid_to", "is_current", "first_observed_at", T.stamp_to_timestamp(F.col("valid_from"), H.FLOOR).alias("valid_from_at"), T.stamp_to_timestamp(F.col("valid_to")).alias("valid_to_at"))

    @cached_property
    def dim_filing(self) -> DataFrame:
        flags = self.quarantine_current.where("grain = 'filing'").groupBy("filing_id").agg(F.bool_or((F.col("severity") == "error") & (F.col("reprocess_status") == "open")).alias("flag"))
        later = F.col("content_version_seq") > 1
        versions = self.document_versions.groupBy("filing_id").agg(F.max("content_version_seq").alias("content_version_count"), F.max(F.when(later, F.col("first_seen_at"))).alias("last_content_change_at"), F.max(F.when(later & F.col("fields_moved"), F.col("first_seen_at"))).alias("last_substantive_change_at"))
        extra = self.crosswalk.select("filing_id", "sub_trk_num", "federal_submission_id", "issuer_name_federal", "match_method")
        out = self.conformed.join(extra, "filing_id").join(flags, "filing_id", "left").join(versions, "filing_id", "left")
        return out.select(surrogate_key("filing_id").alias("filing_key"), *[c for c in out.columns if c not in ("run_id", "flag", "source_row_count")], F.coalesce("flag", F.lit(False)).alias("has_open_error_violation"), F.col("run_id").alias("extract_run_id"))

    def _open(self, *conditions) -> DataFrame:
        rows = self.quarantine_current.where("grain = 'plan' and reprocess_status = 'open'")
        for c in conditions:
            rows = rows.where(c)
        return rows.withColumnRenamed("subject_key", "plan_id_hios")

    @cached_property
    def dim_plan(self) -> DataFrame:
        disputed = self._open("severity = 'error'", "field_name is not null and field_name <> 'cumulative_rate_change_pct'").groupBy("filing_id", "plan_id_hios").agg(F.array_sort(F.collect_set("field_name")).alias("dq_disputed_fields"))
        p = self.plans_current.join(disputed, ["filing_id", "plan_id_hios"], "left")
        return p.select(surrogate_key("filing_id", "plan_id_hios").alias("plan_key"), "plan_id_hios", "filing_id", "state", "plan_year", "product_id", "product_name", "plan_name", "metal", "av_metal_value", "av_metal_value_is_cell_error", "plan_category", "plan_type", "on_exchange", "effective_date", "dq_disputed_fields", F.coalesce(F.array_contains("dq_disputed_fields", "av_metal_value"), F.lit(False)).alias("metal_disputed"), F.col("run_id").alias("extract_run_id"))

    @cached_property
    def dim_justification(self) -> DataFrame:
        j = self.justifications_current
        return j.select("justification_key", surrogate_key("filing_id").alias("filing_key"), "filing_id", "state", "plan_year", "driver_category", "driver_label", "direction", "narrative", "quantified_impact_pct", "evidence_quote", "confidence", "source_document_role", "source_page_start", "source_page_end", text_at(F.col("provenance"), "quantified_impact_pct.call_id").alias("llm_call_id"), "justification_ordinal", F.col("run_id").alias("extract_run_id"))

    @cached_property
    def fct_plan_rate(self) -> DataFrame:
        """One row per filing and plan; each measure as parsed, vetted, and with its trust status."""
        key = ["filing_id", "plan_id_hios"]
        error = "severity = 'error'"
        any_open = self._open()
        p = self.plans_current.join(self.conformed.select("filing_id", "market", "hios_issuer_id", "rate_change_min", "rate_change_max"), "filing_id")
        p = p.join(marks(self._open(error, "field_name = 'cumulative_rate_change_pct'"), key, "rate_change_quarantine_rule_ids"), key, "left")
        p = p.join(marks(self._open(error, "field_name = 'approved_rate_change_pct'"), key, "approved_quarantine_rule_ids"), key, "left")
        p = p.join(any_open.groupBy(*key).agg(F.bool_or(F.col("severity") == "error").alias("has_open"), F.array_sort(F.collect_set("rule_id")).alias("open_rule_ids")), key, "left")
        structural, single = F.col("plan_category").isin("New", "Terminated"), (F.col("state") == "OR", "single_source_deterministic")
        ranged = (F.col("rate_change_min").isNotNull() & F.col("rate_change_max").isNotNull(), "carrier_range_validated")

        def status(name: str, marked: str, *validated):
            return trust_status(F.col(marked).isNotNull(), F.col(f"{name}_is_cell_error"), F.col(name), structural, *validated)

        p = p.withColumns({"rate_change_status": status("cumulative_rate_change_pct", "rate_change_quarantine_rule_ids", ranged, single), "approved_rate_change_status": status("approved_rate_change_pct", "approved_quarantine_rule_ids", single)})
        p = H.point_in_time(p, self.dim_company, "hios_issuer_id", "run_id", ["company_key"])
        asked, granted = F.col("cumulative_rate_change_pct"), F.col("approved_rate_change_pct")
        s1, s2 = F.col("rate_change_status"), F.col("approved_rate_change_status")
        kept = [c for name in ("current_premium_pmpm", "loss_ratio", "plan_adjusted_index_rate", "calibrated_plan_adjusted_index_rate") for c in (name, f"{name}_is_cell_error")]
        return p.select(
            surrogate_key(*key).alias("plan_rate_key"),
            "company_key",
            surrogate_key("filing_id").alias("filing_key"),
            surrogate_key(*key).alias("plan_key"),
            *["state", "plan_year", "market", *key],
            F.col("run_id").alias("extract_run_id"),
            vetted(asked, s1).alias("rate_change_requested"),
            asked.alias("rate_change_requested_as_parsed"),
            *["rate_change_status", "rate_change_quarantine_rule_ids"],
            F.coalesce("has_open", F.lit(False)).alias("has_open_error_violation"),
            "open_rule_ids",
            vetted(granted, s2).alias("approved_rate_change_pct"),
            granted.alias("approved_rate_change_pct_as_parsed"),
            *["approved_rate_change_pct_is_cell_error", "approved_rate_change_status", "approved_quarantine_rule_ids"],
            difference_if_vetted(granted, asked, s1, s2, untrusted=UNTRUSTED).alias("approved_minus_requested"),
            "current_enrollment",
            *kept,
        )

    MARTS = ("fct_plan_rate", "dim_filing", "dim_plan", "dim_company", "dim_justification")

    def marts(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in self.MARTS}

    def register(self, prefix: str = "") -> list[str]:
        """Staging, history and conformance as temporary views, which cost nothing until they are read; marts are written."""
        names = [n for n, p in vars(type(self)).items() if isinstance(p, cached_property) and n not in self.MARTS]
        for n in names:
            getattr(self, n).createOrReplaceTempView(prefix + n)
        return names

    # assertions

    def checks(self, known_gaps: Mapping[str, list[str]] | None = None) -> dict[str, Callable[[], DataFrame]]:
        """Frames that must be empty. known_gaps: the filings that may lack a tracking number or a federal match."""
        gaps = known_gaps or {}
        fact, plan = (lambda: self.fct_plan_rate), (lambda: self.dim_plan)
        return {
            "fact keys are unique": lambda: C.repeated_keys(fact(), "filing_id", "plan_id_hios"),
            "fact keys are there": lambda: C.not_null(fact(), "plan_rate_key", "filing_key", "plan_key", "rate_change_status"),
            "facts have filings": lambda: C.orphans(fact(), "filing_key", self.dim_filing, "filing_key"),
            "facts have plans": lambda: C.orphans(fact(), "plan_key", plan(), "plan_key"),
            "facts have companies": lambda: C.orphans(fact(), "company_key", self.dim_company, "company_key"),
            "vetted request matches its status": lambda: C.vetted_matches_status(fact(), "rate_change_requested", "rate_change_status", UNTRUSTED),
            "vetted approval matches its status": lambda: C.vetted_matches_status(fact(), "approved_rate_change_pct", "approved_rate_change_status", UNTRUSTED),
            "difference needs both": lambda: C.breaches(fact(), F.col("approved_minus_requested").isNotNull() != (F.col("approved_rate_change_pct").isNotNull() & F.col("rate_change_requested").isNotNull())),
            "company windows are sane": lambda: C.windows_sane(self.dim_company, "hios_issuer_id"),
            "verdicts add up": lambda: self.results.where("evaluated <> passed + violated + inapplicable + not_evaluated"),
            "old ledger rows lack new keys": lambda: self.outcomes.where(F.col("ledger_version") == 1).where("has_normalized_hash or has_dry_run_flag"),
            "old manifest rows lack the posting": lambda: self.manifest.where((F.col("manifest_schema_version") == 1) & F.col("has_posted_avg_rate")),
            "every rule reported": lambda: C.never_reported(self.quarantine_current, self.results, ["run_id", "rule_id"]),
            "validation covers the facts": lambda: self.fct_plan_rate.select("extract_run_id").distinct().join(F.broadcast(self.quarantine_current.where("origin = 'evaluated'").agg(F.max("extract_run_id").alias("ceiling"))), F.col("extract_run_id") > F.col("ceiling")),
            "current runs are live": self._dry_current_runs,
            "no unknown gaps": lambda: C.union_failures({
                "tracking number": self.crosswalk.where(F.col("serff_tracking_number").isNull() & ~F.col("filing_id").isin(*gaps.get("serff", [""]))).select("filing_id"),
                "federal match": self.crosswalk.where(F.col("federal_submission_id").isNull() & ~F.col("filing_id").isin(*gaps.get("federal", [""]))).select("filing_id"),
                "submission number": self.crosswalk.where("sub_trk_num is not null").select("filing_id"),
            }),
        }

    def _dry_current_runs(self) -> DataFrame:
        calls = self.calls.groupBy("filing_id", "run_id").agg(F.count("*").alias("calls"), F.count_if(F.col("stop_reason") == "dry_run").alias("dry_calls"))
        live = calls.where("dry_calls < calls").select("filing_id").distinct()
        return self.current_runs.join(calls, ["filing_id", "run_id"]).join(live, "filing_id", "left_semi").where("dry_calls = calls")
