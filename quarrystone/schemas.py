"""Explicit schemas of the artifacts, as DDL; sparse fields are nullable columns."""

from __future__ import annotations

PDF_INVENTORY = (
    "pdf_id string, rel_path string, abs_path string, filename string, stem string, bucket string, excluded boolean, "
    "size_bytes bigint, mtime_ns bigint, page_count int, page_count_error string, sha256 string, chunk_id string"
)
PDF_MANIFEST = "pdf_id string, chunk_id string, rel_path string, abs_path string, filename string, bucket string, page_count int, sha256 string"
RAW_PAGE = "page_number int, image_sha256 string, text string, timing_ms map<string,bigint>, usage map<string,string>, throughput map<string,string>"
RAW_RESPONSE = (
    "id string, model string, model_id string, backend string, endpoint_version string, "
    "source struct<filename:string,sha256:string,page_count:int,selected_pages:array<int>>, "
    "settings map<string,string>, timing_ms map<string,bigint>, warnings array<string>, "
    "pages array<struct<page_number:int,image_sha256:string,text:string,timing_ms:map<string,bigint>,usage:map<string,string>,throughput:map<string,string>>>"
)
PROGRESS_EVENT = (
    "pdf_id string, chunk_id string, rel_path string, abs_path string, bucket string, output_dir string, page_count int, "
    "status string, page_start int, page_end int, raw_path string, error string, text_length bigint, client_elapsed_ms bigint"
)
SCRAPED_ITEM = (
    "url string, title string, content string, markdown string, pdf_links array<string>, raw_html_path string, source string, "
    "category string, listing_title string, downloaded_pdfs array<string>, error string"
)
CLONE_RESULT = "name string, url string, local_path string, category string, priority string, status string, error string"
SOURCE = (
    "name string, data_types array<string>, source_type string, priority string, enabled boolean, category string, url string, subdirs array<string>, "
    "base_url string, endpoints array<string>, requires_js boolean, pagination boolean, max_pages int, dataset_id string, description string, implemented boolean"
)
FILE_RECORD = "path string, size_bytes bigint, source_root string"
BUDGET_PHASE = "name string, category string, gpu_count int, hours double"
CHAT_MESSAGE = "array<struct<role:string,content:string,content_ref:string>>"
# Metadata fields carried from provenance records into training rows.
SFT_METADATA = ("record_id", "task_id", "audit_id", "source", "split", "provenance_ref", "review_state")
DPO_METADATA = ("record_id", "task_id", "audit_id", "split", "chosen_score", "rejected_score", "preference_reason", "judge_results_ref")
