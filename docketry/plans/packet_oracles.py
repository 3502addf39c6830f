"""DuckDB SQL for the queries of the packet plan: what was written on the made pages, without reading them."""

from __future__ import annotations

from ..functions import fixed
from .packet_queries import FIELDS, FINDINGS, PANEL_FLAGS, RECEIVED, VOTED


def _list(options) -> str:
    return "[" + ", ".join(f"'{o}'" for o in options) + "]"


def _flagged(flags: str, names: tuple[str, ...], prefix: str) -> str:
    return f"[concat('{prefix}', f) FOR f IN {flags} IF f IN {names}]"


_PARTS = f"""
made AS (
  SELECT c_custkey AS k, 'MIB-' || lpad(c_custkey::VARCHAR, 6, '0') AS case_id,
    {_list(fixed.NAMES)}[c_custkey % 144 + 1] || ' ' || {_list(fixed.NAMES)}[(c_custkey * 7 + 3) % 144 + 1] AS applicant_name,
    {_list(fixed.SPECIES)}[c_custkey % 12 + 1] AS species_code,
    CASE WHEN c_custkey % 29 <> 0 THEN {_list(fixed.WORLDS)}[c_custkey % 13 + 1] END AS home_world,
    {_list(fixed.VISAS)}[c_custkey % 5 + 1] AS visa_class, {_list(fixed.PURPOSES)}[c_custkey % 10 + 1] AS declared_purpose,
    CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN '{fixed.REVOKED_SPONSORS[0]}'
         ELSE 'SPN-' || lpad((c_custkey * 31 % 10000)::VARCHAR, 4, '0') END AS sponsor_id,
    CASE WHEN c_custkey % 23 <> 0 THEN (DATE '2025-01-01' + (c_custkey * 13 % 420)::INTEGER)::VARCHAR END AS arrival_date,
    c_custkey % 3 <> 0 AS slip,
    CASE WHEN c_custkey % 3 = 0 OR c_custkey % 7 > 1 THEN []::VARCHAR[]
         WHEN c_custkey % 7 = 0 THEN [{_list(fixed.FLAGS)}[c_custkey % 8 + 1]]
         ELSE list_sort(list_distinct([{_list(fixed.FLAGS)}[c_custkey % 8 + 1], {_list(fixed.FLAGS)}[c_custkey // 8 % 8 + 1]])) END AS flags,
    c_custkey % 13 = 5 AS embargo,
    CASE WHEN c_custkey % 10 = 4 THEN ['DENIED', 'NEEDS_REVIEW', 'APPROVED'][c_custkey // 10 % 3 + 1] WHEN c_custkey % 20 = 18 THEN 'APPROVED' END AS note
  FROM customer)"""

_STATES = """
hazards AS (
  SELECT case_id, CASE WHEN list_contains(flags, 'biohazard_red') OR k % 11 = 0 THEN 'adverse' WHEN k % 11 = 1 THEN 'clean' END AS biohazard
  FROM made WHERE slip)"""

WITH_MADE = f"WITH {_PARTS}"

_PAGES = """
pages_of AS (
  SELECT case_id, k, p.kind, p.number FROM made, unnest([
    {'kind': 'intake_form', 'number': 1, 'has': true}, {'kind': 'biometric_slip', 'number': 2, 'has': slip}, {'kind': 'fee_receipt', 'number': 3, 'has': k % 4 <> 3},
    {'kind': 'registry_extract', 'number': 4, 'has': k % 13 IN (5, 6, 7)}, {'kind': 'sponsor_letter', 'number': 5, 'has': k % 6 = 1},
    {'kind': 'adjudicator_note', 'number': 6, 'has': k % 10 IN (4, 8)}]) AS u(p) WHERE p.has)"""

_DECIDED = f"""
{_STATES},
ref AS (
  SELECT CASE WHEN count(*) >= 20 THEN list_sort(list(arrival_date))[(floor(count(*) * 0.95::DOUBLE))::BIGINT + 1]::DATE END AS day FROM made WHERE arrival_date IS NOT NULL),
read_ AS (
  SELECT m.* REPLACE (
      CASE WHEN k % 15 = 2 THEN 'TRANSIT-7' ELSE visa_class END AS visa_class,
      CASE WHEN embargo THEN list_sort(list_distinct(list_append(flags, 'planetary_embargo'))) ELSE flags END AS flags),
    CASE k % 4 WHEN 0 THEN 'paid' WHEN 1 THEN CASE WHEN k % 8 = 5 THEN 'waived' ELSE 'unknown' END WHEN 2 THEN 'unpaid' ELSE 'paid' END AS fee,
    k % 8 = 1 AS contested, k % 4 <> 3 AS known, k % 8 = 5 AS code, slip OR embargo AS risk_known, h.biohazard,
    coalesce(datediff('day', arrival_date::DATE, (SELECT day FROM ref)) > {fixed.STALE_DAYS}, false) AS stale
  FROM made m LEFT JOIN hazards h USING (case_id)),
buckets AS (
  SELECT *,
    list_concat({_flagged("flags", fixed.DISQUALIFYING, "disqualifying_flag:")}, list_filter([
      CASE WHEN visa_class = 'TRANSIT-7' THEN 'transit_visa' END, CASE WHEN home_world IN {fixed.EMBARGOED} THEN 'embargoed_home_world' END,
      CASE WHEN home_world = '{fixed.EMBARGOED_UNLESS_DIPLOMATIC[0]}' AND visa_class <> 'DIP-1' THEN 'embargoed_home_world_nondip' END,
      CASE WHEN sponsor_id IN {fixed.REVOKED_SPONSORS} THEN 'revoked_sponsor' END,
      CASE WHEN visa_class = 'MED-3' AND biohazard = 'adverse' THEN 'med3_biohazard_adverse' END,
      CASE WHEN known AND NOT contested AND fee = 'unpaid' THEN 'unpaid_fee' END,
      CASE WHEN sponsor_id IS NULL AND visa_class <> 'DIP-1' THEN 'missing_sponsor' END,
      CASE WHEN stale AND visa_class <> 'DIP-1' THEN 'stale_application' END], lambda x: x IS NOT NULL)) AS denials,
    list_concat(list_filter([
      CASE WHEN contested THEN 'fee_contested' END, CASE WHEN NOT contested AND NOT known THEN 'fee_unknown' END,
      CASE WHEN known AND NOT contested AND fee = 'waived' AND visa_class <> 'DIP-1' AND NOT code THEN 'waiver_unverified' END,
      CASE WHEN arrival_date IS NULL THEN 'arrival_date_missing' END], lambda x: x IS NOT NULL),
      {_flagged("flags", fixed.REVIEWING, "review_flag:")}, list_filter([
      CASE WHEN NOT risk_known THEN 'risk_unobserved' END, CASE WHEN home_world IS NULL THEN 'missing:home_world' END], lambda x: x IS NOT NULL)) AS reviews
  FROM read_)"""

_ARMS = f"""
WITH arms AS (
  SELECT c_custkey AS k, ['XW-1', 'XW-2', 'DIP-1', 'MED-3', 'TRANSIT-7', ''][c_custkey % 6 + 1] AS visa, {_list(fixed.FEES)}[c_custkey // 6 % 4 + 1] AS fee,
    ['{fixed.EMBARGOED[0]}', '{fixed.EMBARGOED_UNLESS_DIPLOMATIC[0]}', 'Kepler-186f', ''][c_custkey // 5 % 4 + 1] AS world,
    CASE WHEN c_custkey % 11 < 2 THEN '' WHEN c_custkey % 11 = 2 THEN '{fixed.REVOKED_SPONSORS[2]}' ELSE 'SPN-1234' END AS sponsor,
    CASE WHEN c_custkey % 13 <> 0 THEN DATE '2025-09-01' + (c_custkey % 300)::INTEGER END AS arrival,
    CASE WHEN c_custkey % 3 = 0 THEN [{_list(fixed.FLAGS)}[c_custkey % 8 + 1]] WHEN c_custkey % 5 = 0
         THEN [{_list(fixed.FLAGS)}[c_custkey % 8 + 1], {_list(fixed.FLAGS)}[(c_custkey + 3) % 8 + 1]] ELSE []::VARCHAR[] END AS flags,
    c_custkey % 4 <> 1 AS risk_known, c_custkey // 24 % 3 <> 0 AS known, c_custkey // 72 % 5 = 0 AS contested, c_custkey % 4 = 0 AS claims,
    c_custkey % 19 = 0 AS settled, c_custkey % 3 = 0 AS adverse
  FROM customer),
facts AS (
  SELECT *, visa = 'DIP-1' AS dip, known AND NOT contested AS readable, sponsor = '{fixed.REVOKED_SPONSORS[2]}' AS revoked,
    visa = 'DIP-1' OR k % 7 = 0 AS verified, coalesce(datediff('day', arrival, DATE '{RECEIVED}') > {fixed.STALE_DAYS}, false) AS stale FROM arms),
buckets AS (
  SELECT *,
    list_concat({_flagged("flags", fixed.DISQUALIFYING, "disqualifying_flag:")}, list_filter([
      CASE WHEN visa = 'TRANSIT-7' THEN 'transit_visa' END, CASE WHEN world IN {fixed.EMBARGOED} THEN 'embargoed_home_world' END,
      CASE WHEN world = '{fixed.EMBARGOED_UNLESS_DIPLOMATIC[0]}' AND visa <> '' AND NOT dip THEN 'embargoed_home_world_nondip' END,
      CASE WHEN revoked THEN 'revoked_sponsor' END, CASE WHEN visa = 'MED-3' AND adverse THEN 'med3_biohazard_adverse' END,
      CASE WHEN readable AND fee = 'unpaid' AND NOT claims THEN 'unpaid_fee' END, CASE WHEN sponsor = '' AND NOT dip THEN 'missing_sponsor' END,
      CASE WHEN stale AND NOT dip THEN 'stale_application' END], lambda x: x IS NOT NULL)) AS d,
    list_concat(list_filter([
      CASE WHEN contested THEN 'fee_contested' END, CASE WHEN NOT contested AND NOT known THEN 'fee_unknown' END,
      CASE WHEN readable AND fee = 'unpaid' AND claims THEN 'unpaid_fee_with_waiver_claim' END,
      CASE WHEN readable AND fee = 'waived' AND NOT verified THEN 'waiver_unverified' END, CASE WHEN readable AND fee = 'unknown' THEN 'fee_unknown' END,
      CASE WHEN arrival IS NULL THEN 'arrival_date_missing' END], lambda x: x IS NOT NULL), {_flagged("flags", fixed.REVIEWING, "review_flag:")}, list_filter([
      CASE WHEN NOT risk_known THEN 'risk_unobserved' END, CASE WHEN k % 37 = 0 THEN 'missing:applicant_name' END,
      CASE WHEN k % 17 = 0 THEN 'missing:species_code' END, CASE WHEN world = '' THEN 'missing:home_world' END,
      CASE WHEN visa = '' THEN 'missing:visa_class' END, CASE WHEN k % 18 = 0 THEN 'missing:declared_purpose' END], lambda x: x IS NOT NULL)) AS r,
    list_filter([
      CASE WHEN NOT revoked AND sponsor <> '' THEN 'sponsor_present' END, CASE WHEN readable AND fee = 'paid' THEN 'fee_paid' END,
      CASE WHEN readable AND fee = 'waived' AND verified THEN 'valid_fee_waiver' END, CASE WHEN dip THEN 'diplomatic_sponsor_exemption' END,
      CASE WHEN arrival IS NOT NULL AND stale AND dip THEN 'stale_diplomatic_exemption' END,
      CASE WHEN arrival IS NOT NULL AND NOT stale THEN 'application_current' END,
      CASE WHEN risk_known AND len(flags) = 0 THEN 'no_visible_risk' END], lambda x: x IS NOT NULL) AS a
  FROM facts)
SELECT k, CASE WHEN settled THEN 'DENIED' WHEN len(d) > 0 THEN 'DENIED' WHEN len(r) > 0 THEN 'NEEDS_REVIEW' ELSE 'APPROVED' END AS decision,
  CASE WHEN settled THEN 'adjudicator_note' WHEN len(d) > 0 THEN d[1] WHEN len(r) > 0 THEN r[1] ELSE 'clean' END AS reason,
  CASE WHEN settled THEN '' ELSE array_to_string(d, '|') END AS denials, CASE WHEN settled THEN '' ELSE array_to_string(r, '|') END AS reviews,
  CASE WHEN settled THEN 'adjudicator_note' ELSE array_to_string(a, '|') END AS approvals
FROM buckets"""

_READ_FIELDS = "\n  UNION ALL ".join(f"SELECT case_id, k, '{f}' AS field, {f} AS truth FROM made" for f in FIELDS)
_FORM_FIELDS = "\n  UNION ALL ".join(f"SELECT case_id, '{f}' AS field, {f} AS raw FROM made WHERE {f} IS NOT NULL" for f in FIELDS)
_CANONICAL = "\n  UNION ALL ".join(
    [f"SELECT k, '{f}' AS field, {f} AS value FROM made" for f in (*FIELDS, "case_id")]
    + ["SELECT k, 'barcode_payload', case_id FROM made"]
    + ["SELECT k, 'risk_flags', CASE WHEN slip THEN CASE WHEN len(flags) = 0 THEN 'none' ELSE array_to_string(flags, '|') END END FROM made"]
)

ORACLES = {
    "packet_decisions": f"""{WITH_MADE}, {_DECIDED}
SELECT case_id, applicant_name, species_code, coalesce(home_world, '') AS home_world, visa_class, coalesce(sponsor_id, '{fixed.SENTINEL_SPONSOR}') AS sponsor_id,
  coalesce(arrival_date, '{fixed.SENTINEL_DATE}') AS arrival_date, declared_purpose, CASE WHEN len(flags) = 0 THEN 'none' ELSE array_to_string(flags, '|') END AS risk_flags,
  fee AS fee_status, CASE WHEN note IS NOT NULL THEN note WHEN len(denials) > 0 THEN 'DENIED' WHEN len(reviews) > 0 THEN 'NEEDS_REVIEW' ELSE 'APPROVED' END AS adjudication,
  CASE WHEN note IS NOT NULL THEN 'adjudicator_note' WHEN len(denials) > 0 THEN denials[1] WHEN len(reviews) > 0 THEN reviews[1] ELSE 'clean' END AS reason
FROM buckets""",
    "injected_lines": f"""{WITH_MADE}
SELECT case_id, CASE WHEN k % 20 <> 15 THEN 2::INTEGER END AS number, concat_ws('|', 'FORM B-13 Biometric Scan Slip', 'Applicant: ' || applicant_name,
  'Observed flags: ' || CASE k % 7 WHEN 0 THEN flags[1] WHEN 1 THEN {_list(fixed.FLAGS)}[k % 8 + 1] || ', ' || {_list(fixed.FLAGS)}[k // 8 % 8 + 1] ELSE 'none' END,
  CASE k % 11 WHEN 0 THEN 'Biohazard screen: positive' WHEN 1 THEN 'Biohazard screen: clear' END) AS "left"
FROM made WHERE slip AND k % 5 = 0
UNION ALL SELECT case_id, 2, 'A second page of one number' FROM made WHERE slip AND k % 20 = 10""",
    "blind_report": f"""{WITH_MADE}, {_PAGES},
retyped AS (
  SELECT kind AS truth, CASE WHEN kind = 'registry_extract' AND k % 13 = 7 OR kind = 'adjudicator_note' AND k % 10 = 8 OR kind = 'fee_receipt' AND k % 4 = 0 THEN 'unknown' ELSE kind END AS blind
  FROM pages_of WHERE NOT (kind = 'biometric_slip' AND k % 5 = 0))
SELECT truth, count(*) AS pages, count(*) FILTER (WHERE blind <> 'unknown') AS typed, count(*) FILTER (WHERE blind = truth) AS correct,
  round(count(*) FILTER (WHERE blind <> 'unknown') / count(*), 4) AS coverage,
  round(count(*) FILTER (WHERE blind = truth) / nullif(count(*) FILTER (WHERE blind <> 'unknown'), 0), 4) AS "precision"
FROM retyped GROUP BY truth""",
    "recoverable_fields": f"""{WITH_MADE}, truths AS ({_READ_FIELDS}),
cued AS (
  SELECT t.field, t.k, CASE t.field
    WHEN 'home_world' THEN m.home_world IS NOT NULL OR m.k % 13 IN (5, 6, 7)
    WHEN 'sponsor_id' THEN m.sponsor_id IS NOT NULL OR m.k % 6 = 1
    WHEN 'arrival_date' THEN m.arrival_date IS NOT NULL
    ELSE true END AS shown
  FROM truths t JOIN made m USING (case_id))
SELECT field, count(*) FILTER (WHERE k % 7 <> 3) AS "right", count(*) AS cued, round(count(*) FILTER (WHERE k % 7 <> 3) / count(*), 4) AS share
FROM cued WHERE shown GROUP BY field""",
    "ranked_candidates": f"""{WITH_MADE}, rows_ AS (
  SELECT case_id, 'applicant_name' AS field, applicant_name AS value, 3 AS rank, 1 AS page, 'intake_form' AS doc_type FROM made
  UNION ALL SELECT case_id, 'applicant_name', applicant_name, 1, 2, 'biometric_slip' FROM made WHERE slip
  UNION ALL SELECT case_id, 'applicant_name', applicant_name, 4, 4, 'registry_extract' FROM made WHERE k % 13 IN (5, 6)
  UNION ALL SELECT case_id, 'applicant_name', applicant_name, 2, 5, 'sponsor_letter' FROM made WHERE k % 6 = 1
  UNION ALL SELECT case_id, 'visa_class', visa_class, 2, 1, 'intake_form' FROM made
  UNION ALL SELECT case_id, 'visa_class', 'TRANSIT-7', 0, 1, 'manual_correction' FROM made WHERE k % 15 = 2)
SELECT case_id, field, value, rank::INTEGER AS rank, page::INTEGER AS page, doc_type FROM rows_""",
    "second_readings": f"""{WITH_MADE}
SELECT case_id, 'home_world' AS field, home_world AS value, 3::INTEGER AS rank, false AS exact, 1::INTEGER AS page FROM made WHERE k % 12 = 3 AND home_world IS NOT NULL""",
    "worn_types": f"""{WITH_MADE}, {_PAGES}
SELECT kind AS made_type, kind AS doc_type, count(*) AS n FROM pages_of GROUP BY kind""",
    "labelled_lines": f"{WITH_MADE}\n{_FORM_FIELDS}",
    "normalized_fields": f"{WITH_MADE}\n{_CANONICAL}",
    "coerced_values": """
SELECT c_custkey, CASE WHEN c_custkey % 4 < 3 THEN 'SPN-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') END AS sponsor, 'MIB-' || lpad(c_custkey::VARCHAR, 6, '0') AS case_no,
  ['APPROVED', 'DENIED', 'NEEDS_REVIEW', 'NEEDS_REVIEW', 'NEEDS_REVIEW', NULL][c_custkey % 6 + 1] AS decision,
  ['', 'active_warrant|sponsor_mismatch', 'biohazard_red'][c_custkey % 3 + 1] AS flags
FROM customer""",
    "stated_fees": f"""{WITH_MADE}
SELECT case_id, CASE WHEN k % 4 = 2 THEN 'unpaid' END AS stated, false AS unpaid_note, CASE k % 4 WHEN 0 THEN 1250.0::DOUBLE WHEN 1 THEN 0.0::DOUBLE END AS amount,
  CASE WHEN k % 8 = 5 THEN 'W-' || k END AS code
FROM made""",
    "biohazard_states": f"{WITH_MADE}, {_STATES} SELECT * FROM hazards WHERE biohazard IS NOT NULL",
    "registry_signals": f"{WITH_MADE} SELECT case_id, embargo FROM made",
    "note_decisions": f"{WITH_MADE} SELECT case_id, note AS note_decision FROM made WHERE note IS NOT NULL",
    "rule_arms": _ARMS,
    "flag_panels": f"""
WITH p AS (SELECT c_custkey, {_list(PANEL_FLAGS)}[c_custkey % 7 + 1] AS a, {_list(PANEL_FLAGS)}[c_custkey // 7 % 7 + 1] AS b FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 6 IN (0, 4) THEN '' WHEN c_custkey % 4 = 0 THEN array_to_string(list_sort(list_distinct([a, b])), '|') ELSE a END AS flags FROM p""",
    "label_votes": f"SELECT c_custkey, CASE WHEN c_custkey % 7 >= 3 THEN {_list(VOTED)}[c_custkey // 7 % 6 + 1] END AS kind FROM customer",
    "damaged_findings": f"SELECT c_custkey, nullif({_list(said or '' for _, said in FINDINGS)}[c_custkey % 6 + 1], '') AS decision FROM customer",
}
