"""Declared schemas: nothing is inferred from data."""

from __future__ import annotations

EVENT = """event_id string, operation string, status string,
source struct<document_id: string, record_id: string, instrument_number: string, publication_date: string, source_text_sha256: string>,
legal_time struct<commencement_date: string, applicability_start: string, applicability_end: string, retrospective: boolean, date_basis: string>,
target struct<work_id: string, component_id: string, anchor_component_id: string, anchor_text: string, anchor_occurrence: int>,
payload variant,
evidence struct<source_span: struct<start: int, end: int, text_hash: string>, excerpt: string>,
validation struct<target_resolved: boolean, anchor_resolved: boolean, date_resolved: boolean, source_span_verified: boolean, materializable: boolean>,
review struct<required: boolean, review_reasons: array<string>>"""

VERSION = """version_id string, work_id string, component_id string, valid_from string, valid_to string,
applicability_start string, applicability_end string, text string, text_sha256 string,
created_by_event_id string, event_chain array<string>"""

GAP = "event_id string, operation string, status string, date string, skip_reason string, review_reasons array<string>"

CHUNK = "chunk_id string, canonical_id string, chunk_index int, text string, token_estimate int"

RATE_EVENT = """event_id string, operation string, target_notification string, target_schedule string, payload variant,
effective_date string, publication_date string, source_notification string, clause_ref string, status string, review_reasons array<string>"""

PROVISION = """canonical_id string, document_id string, role string, document_type string, element_tag string, eid string, number string, title string,
text string, path string, children array<string>, refs array<struct<target: string, type: string, label: string, eid: string>>"""
