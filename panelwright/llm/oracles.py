"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from panelwright.llm.common import WORD
from panelwright.llm.mixing import GOLDEN, POINTS, UNITS

MIX = f"""WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
         md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffle, md5(coalesce(text, '')) AS tie
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) AS src
  FROM sized GROUP BY source
), capped AS (
  SELECT *, (src - 1) % 3 + 1 AS weight, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / ((src - 1) % 3 + 1) AS ratio
  FROM sources
), filled AS (
  SELECT *, sum(cap) OVER upto AS caps, sum(weight) OVER upto AS weights,
         (SELECT sum(source_size) FROM capped) AS words, (SELECT sum(weight) FROM capped) AS all_weights
  FROM capped WINDOW upto AS (ORDER BY ratio, src ROWS UNBOUNDED PRECEDING)
), marked AS (SELECT *, caps + ratio * (all_weights - weights) <= words AS is_full FROM filled),
level AS (
  SELECT CAST(max(words) - coalesce(max(caps) FILTER (is_full), 0) AS DOUBLE)
         / nullif(CAST(max(all_weights) - coalesce(max(weights) FILTER (is_full), 0) AS DOUBLE), 0) AS height
  FROM marked
), targets AS (
  SELECT src, source, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE coalesce(height, 0) * weight END AS target
  FROM marked, level
), blocks AS (
  SELECT *, CAST(greatest(1, least(1024, floor(target / 512))) AS BIGINT) AS block FROM targets
), counted AS (
  SELECT *, CAST(ceil(CAST(source_size AS DOUBLE) / block) AS BIGINT) AS n_blocks FROM blocks
), united AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(ceil(target * n_blocks / source_size * {UNITS}) AS BIGINT) ELSE 0 END AS units
  FROM counted
), placed AS (
  SELECT src, n_blocks, CAST(sum(units) OVER (ORDER BY src ROWS UNBOUNDED PRECEDING) AS BIGINT) AS high, units
  FROM united WHERE units > 0
), slots AS (
  SELECT slot, CAST(floor(CAST(slot % {POINTS} * {GOLDEN} % {POINTS} AS DOUBLE) / {POINTS} * whole) AS BIGINT) AS point
  FROM (SELECT whole, unnest(range(CAST(round(CAST(whole AS DOUBLE) / {UNITS}) AS BIGINT))) AS slot
        FROM (SELECT CAST(sum(units) AS BIGINT) AS whole FROM placed))
), schedule AS (
  SELECT src, n_blocks, row_number() OVER (PARTITION BY src ORDER BY slot) - 1 AS k
  FROM slots JOIN placed ON point >= high - units AND point < high
), takes AS (
  SELECT src, k % n_blocks AS block_no, count(*) AS times FROM schedule WHERE k < 3 * n_blocks GROUP BY ALL
), laid AS (
  SELECT doc_id, size, src, block, CAST(sum(size) OVER (
           PARTITION BY src ORDER BY shuffle, doc_id NULLS FIRST, tie ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM sized JOIN united ON sized.source IS NOT DISTINCT FROM united.source WHERE size > 0
), pieces AS (
  SELECT *, upto - size AS first_word, unnest(range((upto - size) // block, (upto - 1) // block + 1)) AS block_no FROM laid
), taken AS (
  SELECT src, first_word, doc_id, size,
         sum((least((block_no + 1) * block, upto) - greatest(block_no * block, first_word)) * coalesce(times, 0)) AS taken
  FROM pieces LEFT JOIN takes USING (src, block_no) GROUP BY ALL
)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken FROM taken JOIN targets USING (src)
UNION ALL
SELECT doc_id, size, source_size, target, CAST(0 AS BIGINT) FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
WHERE size = 0"""

ORACLES: dict[str, str] = {"op2_source_mixing": MIX}
