"""DuckDB SQL for the queries of files: what was written, from the tables."""

from __future__ import annotations

from .file_queries import FEW
from .oracles import ORACLES as BATCH
from .packet_oracles import WITH_MADE

ORACLES = {
    "cached_pages": "SELECT conv_id, turn::BIGINT AS turn, role, md5(coalesce(text, '')) AS text_md5 FROM conversations",
    "label_file": "SELECT doc_id::VARCHAR AS case_id, quality::VARCHAR AS quality, toxic::VARCHAR AS toxic FROM labels",
    "label_subset": f"""
SELECT lpad(doc_id::VARCHAR, 12, '0') AS case_id, quality::VARCHAR AS quality FROM labels
WHERE doc_id IN (SELECT doc_id FROM documents ORDER BY doc_id LIMIT {FEW})""",
    "prediction_file": f"""{WITH_MADE},
p AS (
  SELECT *, array_to_string(list_filter([CASE WHEN k % 13 = 0 THEN 'bad adjudication' END, CASE WHEN k % 17 = 0 THEN 'bad fee_status' END,
    CASE WHEN k % 23 = 0 THEN 'confidence out of range' END, CASE WHEN k % 19 = 0 THEN 'risk_flags empty' END], lambda x: x IS NOT NULL), '; ') AS problems FROM made)
SELECT case_id, problems, CASE WHEN problems = '' THEN concat_ws('|', applicant_name, species_code, home_world, visa_class, sponsor_id, arrival_date, declared_purpose, 'none', 'paid', 'DENIED') END AS stated,
  CASE WHEN problems = '' THEN k % 1000 / 1000.0::DOUBLE END AS confidence FROM p""",
    "saved_calibration": BATCH["calibration_fit"],
}
