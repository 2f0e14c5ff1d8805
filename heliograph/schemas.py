"""Canonical schemas of the engine's entities, and tolerant reading into them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

_DDL = {
    "institution": "institution_id string, name string, aliases array<string>, country string, region string, ror_id string, homepage_url string, official_domains array<string>, qs_rank int, qs_year int, source string, status string",
    "raw_source": "source_url string, source_type string, institution_id string, fetched_at timestamp, http_status int, content_hash string, parser_used string, crawl_method string, error_reason string, run_id string, final_url string, content_type string, encoding string, etag string, last_modified string, archive_key string, body_sha256 string, uncompressed_bytes long, compressed_bytes long, network_bytes long, not_modified boolean",
    "person_evidence": "evidence_id string, person_temp_id string, institution_id string, field_name string, field_value string, source_url string, source_type string, extraction_method string, extracted_at timestamp, confidence double, evidence_text string, content_hash string, run_id string",
    "person": "person_id string, display_name string, given_name string, family_name string, aliases array<string>, institution_id string, institution_name string, ror_id string, department string, title string, profile_url string, lab_url string, emails array<string>, research_areas array<string>, publications_summary map<string,string>, external_ids map<string,array<string>>, source_evidence_ids array<string>, last_checked_at timestamp, contact_confidence string, topic_match_confidence string, current_affiliation_confidence string, first_seen_at timestamp, last_seen_at timestamp, last_seen_run_id string, membership_status string, missing_streak int, pool_scope string, schema_version int, departments array<string>, profile_urls array<string>, field_sources map<string,string>, email_association string",
    "email_evidence": "email string, source_url string, source_type string, domain_aligned boolean, official_source boolean, extracted_at timestamp, confidence double, verdict string, person_id string, association string, run_id string",
    "contact_verdict": "person_id string, verdict string, reasons array<string>, recommended_action string, last_live_checked_at timestamp, contact_confidence string, topic_match_confidence string, current_affiliation_confidence string, run_id string",
    "publication_fingerprint": "fingerprint_id string, person_id string, institution_id string, title string, citation_text string, source_url string, run_id string, first_seen_at timestamp, last_seen_at timestamp, last_seen_run_id string, publication_year int, doi string, publication_url string, confidence double",
    "work": "work_id string, doi string, title string, abstract_text string, publication_year int, publication_date date, updated_date timestamp, work_type string, language string, topics array<string>, vector_text string, vector_text_hash string",
    "person_work": "person_id string, work_id string, institution_id string, author_id string, relationship_status string, missing_streak int, first_seen_at timestamp, last_seen_at timestamp, tombstoned_at timestamp",
    "vector": "id string, representation string, encoder_id string, feature_limit int, term string, weight double",
    "claim": "fingerprint_id string, person_id string, institution_id string, source_kind string, source_url string, claim_status string, missing_streak int, first_seen_at timestamp, last_seen_at timestamp, last_seen_run_id string, last_checked_at timestamp, tombstoned_at timestamp",
    "job": "queue_id long, entity_kind string, entity_id string, person_id string, reason string, status string, claim_token string, lease_expires_at timestamp, attempts int, created_at timestamp, payload map<string,string>",
    "alias": "alias_person_id string, canonical_person_id string, institution_id string, reason string, run_id string, created_at timestamp",
    "identity_key": "institution_id string, person_id string, kind string, value string",
    "run": "run_id string, institution_id string, started_at timestamp, finished_at timestamp, status string, crawl_complete boolean, metrics map<string,double>",
}


def schema(entity: str) -> StructType:
    return _parse_datatype_string(_DDL[entity])


def entities() -> list[str]:
    return list(_DDL)


def conform(df: DataFrame, entity: str) -> DataFrame:
    """df with the entity's columns: missing ones null, unknown ones dropped, types cast where that is safe."""
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema(entity)
    ])
