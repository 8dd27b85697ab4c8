"""Queries on overlapping and gapped intervals."""

from __future__ import annotations

from voxloom.operators.intervals import periods_and_gaps
from voxloom.plans.registry import query
from voxloom.session import read_table

PERIODS_SQL = r"""
  WITH s AS (
    SELECT file_name, lower(trim(spk_id)) AS spk_id,
           round(start_time * 1000)::BIGINT AS s, round(end_time * 1000)::BIGINT AS e
    FROM diar_segments
    WHERE NOT isnan(start_time) AND NOT isnan(end_time) AND end_time > start_time AND trim(coalesce(spk_id, '')) <> ''),
  m AS (
    SELECT *, max(e) OVER (PARTITION BY file_name, spk_id ORDER BY s, e
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM s WHERE e > s),
  i AS (
    SELECT *, sum(CASE WHEN far IS NULL OR s > far THEN 1 ELSE 0 END)
              OVER (PARTITION BY file_name, spk_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m),
  p AS (SELECT file_name, spk_id, min(s) AS start_ms, max(e) AS end_ms FROM i GROUP BY file_name, spk_id, island),
  n AS (SELECT *, lead(start_ms) OVER (PARTITION BY file_name, spk_id ORDER BY start_ms) AS later FROM p)
  SELECT file_name, spk_id, 'period' AS kind, start_ms, end_ms FROM p
  UNION ALL
  SELECT file_name, spk_id, 'gap', end_ms, later FROM n WHERE later - end_ms <= 600000"""


@query(PERIODS_SQL)
def p2_found(spark, sf):
    return periods_and_gaps(read_table(spark, sf, "diar_segments"))
