"""DuckDB SQL for the registered queries."""

from __future__ import annotations

from .queries import ADJECTIVES, CUES, DOC_ANCHORS, NOUNS



def _element(value: str, of: str) -> str:
    return f"(SELECT list_sort(list({value}))[(floor(count(*) * 0.95::DOUBLE))::BIGINT + 1] FROM {of} WHERE {value} IS NOT NULL)"


_CASES = """
lines AS (
  SELECT l_orderkey, min(l_suppkey) AS supplier,
         max(CASE WHEN l_returnflag = 'R' AND l_quantity >= 48 THEN 1 ELSE 0 END) AS returned,
         max(CASE WHEN l_returnflag = 'A' AND l_quantity >= 48 THEN 1 ELSE 0 END) AS accepted,
         count(*) FILTER (WHERE l_tax > 0.04::DOUBLE) AS taxed
  FROM lineitem GROUP BY l_orderkey),
ref AS (
  SELECT CASE WHEN count(*) >= 20 THEN list_sort(list(o_orderdate::DATE))[(floor(count(*) * 0.95::DOUBLE))::BIGINT + 1] END AS reference_date
  FROM orders WHERE year(o_orderdate) >= 2000),
cases AS (
  SELECT o.*, l.supplier, l.taxed, c.c_mktsegment, c.c_nationkey,
         CASE o_orderpriority WHEN '5-LOW' THEN 'TRANSIT-7' WHEN '1-URGENT' THEN 'DIP-1' ELSE 'XW-1' END AS visa,
         coalesce(l.returned = 1, false) AS warrant, coalesce(l.accepted = 1, false) OR coalesce(c.c_acctbal < 500, false) AS mismatch,
         datediff('day', o_orderdate::DATE, (SELECT reference_date FROM ref)) > 1800 AS stale
  FROM orders o LEFT JOIN lines l ON o.o_orderkey = l.l_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
buckets AS (
  SELECT *,
    list_filter([CASE WHEN warrant THEN 'disqualifying_flag:active_warrant' END, CASE WHEN visa = 'TRANSIT-7' THEN 'transit_visa' END,
      CASE WHEN supplier % 97 = 0 THEN 'revoked_sponsor' END, CASE WHEN supplier IS NULL AND visa <> 'DIP-1' THEN 'missing_sponsor' END,
      CASE WHEN stale AND visa <> 'DIP-1' THEN 'stale_application' END], lambda x: x IS NOT NULL) AS denials,
    list_filter([CASE WHEN mismatch THEN 'review_flag:sponsor_mismatch' END], lambda x: x IS NOT NULL) AS reviews,
    list_filter([CASE WHEN supplier IS NOT NULL AND supplier % 97 <> 0 THEN 'sponsor_present' END, 'fee_paid',
      CASE WHEN visa = 'DIP-1' THEN 'diplomatic_sponsor_exemption' END, CASE WHEN stale AND visa = 'DIP-1' THEN 'stale_diplomatic_exemption' END,
      CASE WHEN NOT stale THEN 'application_current' END, CASE WHEN NOT warrant AND NOT mismatch THEN 'no_visible_risk' END], lambda x: x IS NOT NULL) AS approvals
  FROM cases),
decided AS (
  SELECT *, CASE WHEN len(denials) > 0 THEN 'DENIED' WHEN len(reviews) > 0 THEN 'NEEDS_REVIEW' ELSE 'APPROVED' END AS decision,
         CASE WHEN len(denials) > 0 THEN denials[1] WHEN len(reviews) > 0 THEN reviews[1] ELSE 'clean' END AS reason
  FROM buckets)"""

_KEYED = (
    _CASES
    + """,
routed AS (
  SELECT *, split_part(reason, ':', 1) AS route, CASE WHEN warrant OR mismatch THEN 'flagged' ELSE 'clear' END AS risk,
         '|support=' || least(len(approvals), 4) || '|doubts=' || least(len(reviews), 3) AS counts,
         CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'DENIED' ELSE 'NEEDS_REVIEW' END AS truth
  FROM decided),
keyed AS (
  SELECT *, [route || '|fee=paid|visa=' || visa || '|risk=' || risk, route || '|fee=paid' || counts, route || '|visa=' || visa || '|risk=' || risk,
             route || counts, route || '|risk=' || risk, route] AS keys
  FROM routed),
fitted AS (SELECT bucket, truth, count(*)::BIGINT AS n FROM (SELECT unnest(keys) AS bucket, truth FROM keyed) GROUP BY bucket, truth)"""
)

_OUTCOME = """CASE WHEN truth = decision THEN 'correct' WHEN decision = 'NEEDS_REVIEW' THEN 'to_review' WHEN truth = 'NEEDS_REVIEW' THEN 'missed_review'
       WHEN decision = 'APPROVED' AND truth = 'DENIED' THEN 'false_approval' ELSE 'wrong' END"""
_POINTS = "CASE outcome WHEN 'correct' THEN 8 WHEN 'to_review' THEN 2 WHEN 'missed_review' THEN 1 WHEN 'wrong' THEN 0 ELSE -4 END"

_LABELLED = """
labelled AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, contains(d.text, '@') AS mail, l.toxic,
         CASE WHEN toxic = 1 THEN 'NEEDS_REVIEW' WHEN quality = 1 THEN 'APPROVED' ELSE 'DENIED' END AS truth,
         CASE WHEN n_chars >= 2000 THEN 'APPROVED' WHEN n_chars >= 800 THEN 'NEEDS_REVIEW' ELSE 'DENIED' END AS decision,
         least(n_chars / 4000.0::DOUBLE, 1.0::DOUBLE) AS confidence
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

_SQUASH = "regexp_replace(upper(regexp_replace(coalesce({0}, ''), '[^\\x00-\\x7F]', '', 'g')), '[^A-Z0-9]', '', 'g')"
_BOILER = r"(?i)packet\s*MIB-?\d{6}\s*/?\s*page\s*\d+|synthetic\s*hiring\s*challenge"
_CLEANED = rf"""
split AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw FROM documents),
stripped AS (SELECT doc_id, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS line FROM split),
marked AS (SELECT doc_id, line, line <> '' AND NOT regexp_matches(line, '{_BOILER}') AS ok FROM stripped)"""

_READINGS = """
readings AS (
  SELECT l_orderkey AS case_id, ({0})::VARCHAR AS value, CASE l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS rank,
         l_linestatus = 'F' AS exact, l_linenumber AS page, l_linenumber AS s1, l_suppkey AS s2, l_partkey AS s3, l_returnflag AS s4, l_linestatus AS s5
  FROM lineitem)"""
_BEST = "row_number() OVER (PARTITION BY case_id ORDER BY rank, exact DESC, page, s1, s2, s3, s4, s5)"

_SETS = """
sets AS (
  SELECT l_orderkey, coalesce(list_sort(list(DISTINCT (l_suppkey % 10)::VARCHAR) FILTER (WHERE l_returnflag = 'R')), []) AS first,
         coalesce(list_sort(list(DISTINCT (l_suppkey % 10)::VARCHAR) FILTER (WHERE l_returnflag = 'A')), []) AS second,
         coalesce(list_sort(list(DISTINCT (l_suppkey % 10)::VARCHAR) FILTER (WHERE l_returnflag = 'N')), []) AS truth
  FROM lineitem GROUP BY l_orderkey)"""


def _texts(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_LOOSE = "translate(upper({0}), ' ''', '')"
_HIDDEN = r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->"
_ANCHORED = ", ".join(
    f"{{'kind': '{kind}', 'weight': " + " + ".join(f"CASE WHEN contains(body, '{t}') THEN {w}::DOUBLE ELSE 0 END" for t, w in tokens) + "}" for kind, tokens in DOC_ANCHORS.items()
)

ORACLES = {
    "case_decision": f"WITH {_CASES} SELECT o_orderkey, decision, reason, array_to_string(denials, '|') AS denials, array_to_string(reviews, '|') AS reviews, array_to_string(approvals, '|') AS approvals FROM decided",
    "reference_date": f"WITH {_CASES} SELECT reference_date FROM ref",
    "rule_reasons": f"WITH {_CASES} SELECT split_part(reason, ':', 1) AS route, decision, count(*)::BIGINT AS n FROM decided GROUP BY ALL",
    "fee_ladder": f"""
WITH {_CASES}, facts AS (
  SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'paid' WHEN '2-HIGH' THEN 'waived' END AS stated, o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AS unpaid,
         taxed AS owed, c_mktsegment = 'BUILDING' AS coded, CASE WHEN o_orderstatus = 'O' THEN 'unknown' END AS literal FROM cases),
steps AS (
  SELECT o_orderkey, owed, CASE WHEN stated = 'waived' AND owed = 0 AND NOT coalesce(coded, false) THEN 1 WHEN stated IS NOT NULL THEN 2 WHEN unpaid THEN 3 WHEN owed > 0 THEN 4
         WHEN owed IS NOT NULL AND coalesce(coded, false) THEN 5 WHEN owed IS NOT NULL THEN 6 WHEN literal IS NOT NULL THEN 7 ELSE 8 END AS step, stated, literal FROM facts)
SELECT o_orderkey, CASE step WHEN 1 THEN 'unknown' WHEN 2 THEN stated WHEN 3 THEN 'unpaid' WHEN 4 THEN 'paid' WHEN 5 THEN 'waived' WHEN 6 THEN 'unknown' WHEN 7 THEN literal ELSE 'paid' END AS status,
       step < 8 AS known, step IN (1, 6) AS contested FROM steps""",
    "document_lines": f"WITH {_CLEANED} SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE ok)::BIGINT AS n_clean, coalesce(sum(length(line)) FILTER (WHERE ok), 0)::BIGINT AS clean_chars FROM marked GROUP BY doc_id",
    "squash_lines": r"""
WITH a AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[^\x00-\x7F]', '', 'g') AS t FROM documents)
SELECT doc_id, length(regexp_replace(upper(t), '[^A-Z0-9]', '', 'g'))::BIGINT AS alnum, length(regexp_replace(upper(t), '[^A-Z]', '', 'g'))::BIGINT AS letters,
       length(regexp_replace(upper(t), '[^A-Z_,\[\]]', '', 'g'))::BIGINT AS panel, md5(regexp_replace(lower(t), '[^a-z0-9]', '', 'g')) AS squashed FROM a""",
    "visible_hidden_split": rf"""
WITH v AS (SELECT page_id, html, trim(regexp_replace(regexp_replace(regexp_replace(html, '{_HIDDEN}', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS visible FROM pages)
SELECT page_id, md5(visible) AS visible_md5, length(visible)::BIGINT AS visible_chars, length(array_to_string(regexp_extract_all(html, '{_HIDDEN}'), ''))::BIGINT AS hidden_chars FROM v""",
    "contamination_filter": f"""
WITH d AS (SELECT doc_id, {_SQUASH.format('text')} AS body FROM documents), b AS (SELECT item_id, {_SQUASH.format('text')} AS passage FROM benchmark)
SELECT doc_id, item_id FROM d JOIN b ON length(passage) >= 40 AND contains(body, passage)""",
    "doc_type_cascade": rf"""
WITH l AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: NOT regexp_matches({_SQUASH.format('x')}, '^(SAMPLEDENIAL|COPYARTIFACT|CASEWORK|FILED|ARCHIVE|REDACTED|SCANTAB|MIBEYESONLY)$')
             AND NOT regexp_matches(x, '(?i)^\s*manual\s*correction')) AS kept FROM documents),
t AS (SELECT doc_id, {_LOOSE.format("array_to_string(kept[1:3], '')")} AS head, {_LOOSE.format("array_to_string(kept, '')")} AS body FROM l)
SELECT doc_id, CASE WHEN regexp_matches(head, 'LICENSEDUNDER|RELEASEDUNDER|COPYRIGHT|ALLRIGHTSRESERVED') THEN 'licence' WHEN regexp_matches(head, '^[A-Z]+!!') THEN 'shout'
  WHEN regexp_matches(body, 'LICENSEDUNDER|RELEASEDUNDER') THEN 'licence' WHEN regexp_matches(body, '@[A-Z0-9]+\.[A-Z]+') THEN 'mail' WHEN regexp_matches(body, '[A-Z]\|[A-Z]') THEN 'table'
  WHEN regexp_matches(body, '\*\*\*|%%%|&&&') THEN 'mark' WHEN regexp_matches(body, 'PASSPORTIMAGE|SCANIMAGE|REGISTRYIMAGE') THEN 'passport_image' ELSE 'unknown' END AS doc_type FROM t""",
    "anchor_vote": f"""
WITH d AS (SELECT doc_id, {_SQUASH.format('text')} AS body FROM documents),
w AS (SELECT doc_id, unnest([{_ANCHORED}]) AS a FROM d),
r AS (SELECT doc_id, a.kind AS kind, a.weight AS weight, row_number() OVER (PARTITION BY doc_id ORDER BY a.weight DESC, a.kind) AS pos, lead(a.weight) OVER (PARTITION BY doc_id ORDER BY a.weight DESC, a.kind) AS next FROM w)
SELECT doc_id, CASE WHEN weight >= 2.5::DOUBLE AND weight - next >= 1.0::DOUBLE THEN kind END AS kind, weight, weight - next AS margin FROM r WHERE pos = 1""",
    "boilerplate_lines": f"WITH {_CLEANED} SELECT line, count(DISTINCT doc_id)::BIGINT AS n_docs FROM marked WHERE ok GROUP BY line HAVING count(DISTINCT doc_id) >= 5",
    "packet_by_authority": "SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY CASE role WHEN 'system' THEN 1 WHEN 'assistant' THEN 2 ELSE 3 END, turn))::INTEGER AS place FROM conversations",
    "note_first": r"""
WITH p AS (SELECT conv_id, CASE role WHEN 'system' THEN 1 WHEN 'assistant' THEN 2 ELSE 3 END AS authority, turn,
             coalesce(nullif(regexp_extract(text, '([A-Z][a-z]+)\.\n', 1), ''), nullif(regexp_extract(text, '^([A-Z][a-z]+)', 1), '')) AS stated FROM conversations)
SELECT c.conv_id, f.stated FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN (SELECT conv_id, stated FROM p WHERE stated IS NOT NULL QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY authority, turn) = 1) f USING (conv_id)""",
    "authority_resolution": f"WITH {_READINGS.format('l_partkey')} SELECT case_id, value, rank, exact, page FROM readings QUALIFY {_BEST} = 1",
    "consensus_vote": f"""
WITH {_READINGS.format('l_suppkey % 5')},
tally AS (SELECT case_id, value, count(*) AS votes, max(exact::INTEGER) AS any_exact, min(rank) AS low, arg_min({{'rank': rank, 'exact': exact, 'page': page}}, (s1, s2, s3, s4, s5)) AS reading, min((s1, s2, s3, s4, s5)) AS first FROM readings GROUP BY case_id, value),
won AS (SELECT *, sum(votes) OVER (PARTITION BY case_id) AS total, row_number() OVER (PARTITION BY case_id ORDER BY votes DESC, any_exact DESC, low, first) AS pos FROM tally)
SELECT case_id, total::BIGINT AS votes, value, reading.rank AS rank, reading.exact AS exact, reading.page AS page FROM won WHERE pos = 1 AND total > 1""",
    "prefer_clean": f"""
WITH {_READINGS.format('l_suppkey % 3')}, best AS (SELECT * FROM readings QUALIFY {_BEST} = 1),
clean AS (SELECT r.* FROM readings r JOIN best b ON r.case_id = b.case_id AND r.value = b.value WHERE r.exact AND NOT b.exact QUALIFY row_number() OVER (PARTITION BY r.case_id ORDER BY r.s1, r.s2, r.s3, r.s4, r.s5) = 1)
SELECT b.case_id, coalesce(c.value, b.value) AS value, coalesce(c.rank, b.rank) AS rank, coalesce(c.exact, b.exact) AS exact, coalesce(c.page, b.page) AS page FROM best b LEFT JOIN clean c ON b.case_id = c.case_id""",
    "lexicon_support": f"SELECT p_partkey, len(list_filter(string_split(p_name, ' '), lambda t: list_contains({_texts(ADJECTIVES + NOUNS)}, t)))::BIGINT AS support FROM part",
    "snap_exact": f"SELECT p_partkey, list_filter({_texts(NOUNS)}, lambda o: contains(regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]', '', 'g'), o))[1] AS noun FROM part",
    "sweep_values": r"""
WITH n AS (SELECT list(struct_pack(k := n_nationkey, key := regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g')) ORDER BY n_nationkey) AS nations FROM nation),
d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(lower(regexp_replace(coalesce(text, ''), '[^\x00-\x7F]', '', 'g')), '[^a-z0-9]', '', 'g') AS key FROM documents),
p AS (SELECT *, regexp_extract(t, '\b(\d{4})[\-/\.](\d{1,2})[\-/\.](\d{1,2})\b', ['y', 'm', 'd']) AS x FROM d)
SELECT doc_id, list_filter((SELECT nations FROM n), lambda z: contains(key, z.key))[1].k AS nation,
       CASE WHEN try_cast(x.y AS INTEGER) BETWEEN 1900 AND 2100 THEN strftime(try_cast(x.y || '-' || lpad(x.m, 2, '0') || '-' || lpad(x.d, 2, '0') AS DATE), '%Y-%m-%d') END AS date,
       nullif(regexp_extract(t, '\b(\d{4})\b', 1), '') AS number FROM p""",
    "flag_mining": rf"""
WITH f AS (SELECT doc_id, list_sort(list_filter({_texts(CUES)}, lambda c: contains(replace(lower(regexp_replace(coalesce(text, ''), '[^\x00-\x7F]', '', 'g')), ' ', '_'), c))) AS flags FROM documents)
SELECT doc_id, array_to_string(flags, '|') AS flags, len(flags)::BIGINT AS n FROM f""",
    "json_props": """
WITH e AS (SELECT event_type, (json_extract_string(props, '$.k'))::BIGINT AS k FROM events)
SELECT event_type, sum(coalesce(k, 0))::BIGINT AS sum_k, count(*) FILTER (WHERE k IS NULL)::BIGINT AS missing, count(*)::BIGINT AS n FROM e GROUP BY event_type""",
    "calibration_fit": f"WITH {_KEYED} SELECT bucket, truth, n FROM fitted",
    "calibration_ladder": f"""
WITH {_KEYED}, totals AS (SELECT bucket, sum(n) AS total FROM fitted GROUP BY bucket HAVING sum(n) >= 20),
tried AS (SELECT o_orderkey, decision, route, unnest(keys) AS bucket, generate_subscripts(keys, 1) AS pos FROM keyed),
hit AS (SELECT t.o_orderkey, coalesce(f.n, 0) / s.total::DOUBLE AS share FROM tried t JOIN totals s USING (bucket) LEFT JOIN fitted f ON f.bucket = t.bucket AND f.truth = t.decision QUALIFY row_number() OVER (PARTITION BY t.o_orderkey ORDER BY pos) = 1)
SELECT k.o_orderkey, round(coalesce(h.share, CASE k.route WHEN 'disqualifying_flag' THEN 0.97 WHEN 'transit_visa' THEN 0.89 WHEN 'stale_application' THEN 0.88 WHEN 'review_flag' THEN 0.86 WHEN 'clean' THEN 0.84
  WHEN 'revoked_sponsor' THEN 0.70 WHEN 'missing_sponsor' THEN 0.37 ELSE 0.5 END::DOUBLE), 4) AS confidence FROM keyed k LEFT JOIN hit h USING (o_orderkey)""",
    "expected_score": f"""
WITH {_KEYED}, d AS (SELECT bucket, truth, n, unnest(['APPROVED', 'DENIED', 'NEEDS_REVIEW']) AS decision FROM fitted), o AS (SELECT *, {_OUTCOME} AS outcome FROM d)
SELECT bucket, decision, round(sum(({_POINTS}) * n) / sum(n)::DOUBLE, 4) AS expected FROM o GROUP BY bucket, decision""",
    "score_report": f"""
WITH {_LABELLED}, o AS (SELECT *, {_OUTCOME} AS outcome, CASE WHEN lang = 'en' THEN 5 ELSE 0 END + CASE WHEN source = 'src0' THEN 6 ELSE 0 END AS raw, CASE WHEN row_number() OVER (ORDER BY doc_id) <= 200 THEN 'fit' ELSE 'holdout' END AS cohort FROM labelled),
g AS (SELECT *, unnest(['all', cohort]) AS "group", ({_POINTS}) AS points, pow(confidence - CASE WHEN outcome = 'correct' THEN 1 ELSE 0 END, 2) AS brier FROM o)
SELECT "group", count(*)::BIGINT AS n, round(50.0::DOUBLE * sum(raw) / (11 * count(*)), 4) AS extraction, round(80.0::DOUBLE * sum(points) / (8 * count(*)), 4) AS classification,
       round(20.0::DOUBLE * greatest(0.0::DOUBLE, 1 - 2 * avg(brier)), 4) AS calibration, count(*) FILTER (WHERE outcome = 'false_approval')::BIGINT AS catastrophic FROM g GROUP BY "group" """,
    "route_accuracy": f"""
WITH {_KEYED} SELECT route, count(*)::BIGINT AS n, count(*) FILTER (WHERE truth = decision)::BIGINT AS correct, round((count(*) FILTER (WHERE truth = decision) + 2) / (count(*) + 4)::DOUBLE, 4) AS smoothed FROM keyed GROUP BY route""",
    "field_accuracy": f"""
WITH {_LABELLED}, f AS (
  SELECT 'lang' AS field, lang AS truth, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN upper(lang) || ' ' ELSE lang END AS read, 5 AS weight FROM labelled
  UNION ALL SELECT 'source', source, CASE WHEN doc_id % 3 = 0 THEN 'src0' ELSE source END, 6 FROM labelled UNION ALL SELECT 'decision', truth, decision, 8 FROM labelled),
s AS (SELECT *, coalesce(lower(trim(truth)) = lower(trim(read)), false) AS same, coalesce(read, '') = '' AS blank FROM f)
SELECT field, count(*) FILTER (WHERE same)::BIGINT AS ok, count(*) FILTER (WHERE NOT same AND NOT blank)::BIGINT AS wrong, count(*) FILTER (WHERE NOT same AND blank)::BIGINT AS blank,
       round(count(*) FILTER (WHERE same) / count(*)::DOUBLE, 4) AS accuracy, coalesce(sum(weight) FILTER (WHERE NOT same), 0)::BIGINT AS lost FROM s GROUP BY field""",
    "confusion": f"WITH {_LABELLED} SELECT truth, decision AS read, count(*)::BIGINT AS n FROM labelled GROUP BY ALL",
    "ablation": f"""
WITH {_LABELLED}, s AS (
  SELECT truth, unnest(['as_is', 'true_reviews', 'true_denials', 'truth']) AS scenario, unnest([decision, CASE WHEN truth = 'NEEDS_REVIEW' THEN truth ELSE decision END, CASE WHEN truth = 'DENIED' THEN truth ELSE decision END, truth]) AS decision FROM labelled),
o AS (SELECT *, {_OUTCOME} AS outcome FROM s)
SELECT scenario, sum({_POINTS})::BIGINT AS points, count(*)::BIGINT AS n FROM o GROUP BY scenario""",
    "population_rates": f"""
WITH {_LABELLED} SELECT lang, mail, count(*)::BIGINT AS n, count(*) FILTER (WHERE toxic = 1)::BIGINT AS flagged, round(avg(toxic::DOUBLE), 4) AS rate, round((count(*) FILTER (WHERE toxic = 1) + 2) / (count(*) + 4)::DOUBLE, 4) AS smoothed FROM labelled GROUP BY lang, mail""",
    "recoverable_share": f"""
WITH {_LABELLED}, p AS (SELECT 'decision' AS field, truth, decision AS read FROM labelled WHERE mail OR n_chars > 1000 UNION ALL SELECT 'lang', lang, 'en' FROM labelled WHERE mail OR n_chars > 1000)
SELECT field, count(*) FILTER (WHERE truth = read)::BIGINT AS "right", count(*)::BIGINT AS cued, round(count(*) FILTER (WHERE truth = read) / count(*)::DOUBLE, 4) AS share FROM p GROUP BY field""",
    "set_differences": f"""
WITH {_SETS} SELECT l_orderkey, array_to_string(list_filter(first, lambda x: list_contains(second, x)), '|') AS both, array_to_string(list_filter(first, lambda x: NOT list_contains(second, x)), '|') AS only_first,
       array_to_string(list_sort(list_distinct(list_concat(first, second))), '|') AS either FROM sets""",
    "recovered_and_invented": f"""
WITH {_SETS}, a AS (SELECT truth, unnest(list_filter(second, lambda x: NOT list_contains(first, x))) AS flag FROM sets)
SELECT flag, count(*) FILTER (WHERE list_contains(truth, flag))::BIGINT AS recovered, count(*) FILTER (WHERE NOT list_contains(truth, flag))::BIGINT AS invented FROM a GROUP BY flag""",
    "flag_coverage": f"""
WITH {_SETS}, f AS (SELECT truth, first AS read, second AS printed, unnest(list_distinct(list_concat(truth, first))) AS flag FROM sets),
h AS (SELECT flag, list_contains(truth, flag) AS t, list_contains(read, flag) AS r, list_contains(printed, flag) AS p FROM f)
SELECT flag, count(*) FILTER (WHERE t)::BIGINT AS truth, count(*) FILTER (WHERE t AND r)::BIGINT AS emitted, count(*) FILTER (WHERE t AND NOT r AND p)::BIGINT AS printed_missed,
       count(*) FILTER (WHERE t AND NOT r AND NOT p)::BIGINT AS absent_missed, count(*) FILTER (WHERE r AND NOT t)::BIGINT AS false_positive FROM h GROUP BY flag""",
    "resume_anti_join": """
SELECT lang, count(*)::BIGINT AS n, 'open' AS state FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY lang
UNION ALL SELECT lang, count(*)::BIGINT, 'done' FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY lang""",
    "finalize_validate": """
WITH m AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 97 = 0 THEN '' ELSE c_custkey::VARCHAR END AS case_id,
         CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'SPN-' || c_custkey ELSE 'SPN-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') END AS sponsor,
         '2026-' || lpad((c_custkey % 14)::VARCHAR, 2, '0') || '-' || lpad((c_custkey % 33)::VARCHAR, 2, '0') AS day, c_acctbal / 10000.0::DOUBLE AS confidence FROM customer)
SELECT k AS c_custkey, CASE WHEN regexp_matches(coalesce(sponsor, ''), '^SPN-[0-9]{4}$') THEN sponsor ELSE 'SPN-0000' END AS sponsor_id, CASE WHEN try_cast(day AS DATE) IS NOT NULL THEN day ELSE '1900-01-01' END AS arrival_date,
       array_to_string(list_filter([CASE WHEN case_id = '' THEN 'empty case_id' END, CASE WHEN k % 13 = 0 THEN 'bad adjudication' END, CASE WHEN k % 17 = 0 THEN 'bad fee_status' END,
         CASE WHEN NOT confidence BETWEEN 0 AND 1 THEN 'confidence out of range' END, CASE WHEN k % 19 = 0 THEN 'risk_flags empty' END], lambda x: x IS NOT NULL), '; ') AS problems FROM m""",
    "profile_totals": """
WITH c AS (SELECT conv_id, count(*) AS pages, count(*) FILTER (WHERE role = 'user') AS ocr, max(CASE WHEN contains(text, '?') THEN 1 ELSE 0 END) AS hidden FROM conversations GROUP BY conv_id),
t AS (SELECT count(*)::DOUBLE AS packets, sum(pages)::DOUBLE AS pages, sum(ocr)::DOUBLE AS ocr, sum(hidden)::DOUBLE AS hidden FROM c),
r AS (SELECT unnest(['pages_per_packet', 'ocr_share', 'injected_share']) AS name, unnest([pages / packets, ocr / pages, hidden / packets]) AS value, unnest([4.16::DOUBLE, 0.48::DOUBLE, 0.216::DOUBLE]) AS reference FROM t)
SELECT name, round(value, 4) AS value, round((value - reference) / reference, 4) AS gap, abs((value - reference) / reference) > 0.20::DOUBLE AS alert FROM r""",
    "type_histogram": """
WITH t AS (SELECT role AS doc_type, count(*)::BIGINT AS pages, count(*) FILTER (WHERE role = 'user')::BIGINT AS ocr_pages, 0::BIGINT AS empty_pages FROM conversations GROUP BY role)
SELECT *, repeat('#', round(pages / greatest(max(pages) OVER (), 1)::DOUBLE * 20)::INTEGER) AS bar FROM t""",
    "sliding_rate": """
WITH c AS (SELECT event_id, event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events),
s AS (SELECT event_id, (epoch_us(ts) - epoch_us(first_value(ts) OVER w)) / 1000000.0::DOUBLE AS seconds, n - first_value(n) OVER w AS grown FROM c WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))
SELECT event_id, round(CASE WHEN seconds > 0 THEN grown / seconds * 60 END, 4) AS per_minute FROM s""",
    "stream_profile": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL",
    "top_values": "SELECT user_id, count(*)::BIGINT AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 20",
    "modal_value": """
WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*)::BIGINT AS n FROM orders GROUP BY ALL)
SELECT o_orderstatus, o_orderpriority AS modal, n FROM c QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY n DESC, o_orderpriority) = 1""",
    "first_samples": "SELECT o_orderpriority, o_orderkey, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey))::INTEGER AS place FROM orders QUALIFY place <= 4",
    "hidden_characters": """
WITH v AS (SELECT vec_id, embedding AS e, CASE WHEN vec_id % 5 = 0 THEN NULL WHEN vec_id % 3 = 0 THEN embedding[1:1] WHEN vec_id % 3 = 1 THEN embedding[1:3] ELSE embedding[1:4] END AS c FROM embeddings),
w AS (SELECT *, CASE WHEN c IS NULL OR len(c) = 4 THEN false ELSE len(list_filter(c, lambda x: x > 0)) = len(c) END AS white FROM v)
SELECT vec_id, white, white OR e[6]::DOUBLE + 1 < 0 OR e[6]::DOUBLE > 1 OR e[7]::DOUBLE + 1 < 0 OR e[7]::DOUBLE > 1 OR (e[8] + 1.6::DOUBLE) < 1.5::DOUBLE AS hidden FROM w""",
    "hidden_key_rows": r"""
WITH r AS (SELECT p_partkey, nullif(regexp_extract('key: ' || p_type || ',' || p_size || ',' || p_brand || ' end', '([A-Z]+,\d+,\S+)', 1), '') AS x FROM part)
SELECT p_partkey, string_split(x, ',')[1] AS type, string_split(x, ',')[2]::BIGINT AS size, NULL::VARCHAR AS absent FROM r""",
    "damage_classes": """
WITH r AS (SELECT p_size / 1000.0::DOUBLE AS ink, (p_retailprice % 100) / 1000.0::DOUBLE AS grey FROM part)
SELECT CASE WHEN ink < 0.002::DOUBLE AND grey < 0.01::DOUBLE THEN 'blank' WHEN grey > ink * 2.5::DOUBLE THEN 'blurred' ELSE 'crisp' END AS state, count(*)::BIGINT AS n FROM r GROUP BY state""",
    "run_durations": """
WITH s AS (SELECT user_id, max(event_id) - min(event_id) AS s FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN s >= 3600 THEN (s // 3600) || 'h' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || 'm' WHEN s >= 60 THEN (s // 60) || 'm' || lpad((s % 60)::VARCHAR, 2, '0') || 's' ELSE s || 's' END AS span FROM s""",
    "vocabulary_score": r"""
WITH d AS (SELECT doc_id, source, length(array_to_string(regexp_extract_all(regexp_replace(coalesce(text, ''), '[^\x00-\x7F]', '', 'g'), '\b(the|and|les|des|und|der|los|que)\b', 1), ''))::BIGINT AS score FROM documents)
SELECT source, doc_id AS best, score FROM d QUALIFY row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) = 1""",
    "whole_rate": """
WITH c AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS n FROM events),
s AS (SELECT event_id, (epoch_us(ts) - epoch_us(first_value(ts) OVER w)) / 1000000.0::DOUBLE AS seconds, n - first_value(n) OVER w AS grown FROM c WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))
SELECT event_id, round(CASE WHEN seconds > 0 THEN grown / seconds * 60 END, 4) AS per_minute FROM s""",
    "order_statistics": f"""
SELECT {_element("l_extendedprice", "lineitem")} AS price, {_element("o_orderdate::DATE", "orders")} AS day, {_element("c_name", "customer")} AS name,
  {_element("event_id", "events")} AS event, {_element("n_nationkey", "nation")}::BIGINT AS nation, NULL::VARCHAR AS region""",
    "case_lookup": "SELECT lpad(conv_id::VARCHAR, 9, '0') AS case_id, turn, role, md5(text) AS text_md5 FROM conversations WHERE conv_id = (SELECT max(conv_id) FROM conversations)",
}
