"""DuckDB SQL for the queries of the streams: the same figures from the whole tables at once."""

from __future__ import annotations

from .oracles import ORACLES as BATCH
from .stream_queries import USUAL

ORACLES = {
    "tailed_profile": BATCH["profile_totals"],
    "tailed_pages": """
SELECT role AS doc_type, count(*) AS pages, count(*) FILTER (WHERE role = 'user') AS ocr_pages, 0::BIGINT AS empty_pages, count(DISTINCT (conv_id, turn)) AS places
FROM conversations GROUP BY role""",
    "streamed_rates": f"""
WITH c AS (SELECT event_id, event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events),
s AS (
  SELECT event_id, event_type, ts, n, (epoch_us(ts) - epoch_us(first_value(ts) OVER w)) / 1000000.0::DOUBLE AS seconds, n - first_value(n) OVER w AS grown
  FROM c WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)),
r AS (SELECT *, CASE WHEN seconds > 0 THEN grown / seconds * 60 END AS rate FROM s),
a AS (SELECT *, abs(rate - {USUAL}::DOUBLE) / {USUAL}::DOUBLE > 0.2::DOUBLE AS alert FROM r)
SELECT event_id, n, round(rate, 4) AS per_minute, alert,
  alert IS NOT NULL AND alert <> coalesce(lag(alert IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id), false) AS changed, false AS late
FROM a""",
}
