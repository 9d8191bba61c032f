"""SQL of the training-data queries that SQL can state."""

from __future__ import annotations

SQL = {
    "p2_found": r"""WITH sp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY speech_id ORDER BY retrieved_at DESC) AS rn FROM speeches) WHERE rn = 1 AND meeting_id IN (SELECT meeting_id FROM meetings)),
t AS (SELECT meeting_id, regexp_replace(string_agg(text, '' ORDER BY speech_order), '[\s\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]', '', 'g') AS x FROM sp GROUP BY 1),
g AS (SELECT DISTINCT meeting_id, substr(x, CAST(i AS INTEGER), 5) AS r FROM (SELECT meeting_id, x, unnest(range(1, length(x) - 3)) AS i FROM t WHERE length(x) >= 5)),
n AS (SELECT meeting_id, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT a.meeting_id AS meeting_a, b.meeting_id AS meeting_b, count(*) AS k FROM g a JOIN g b ON a.r = b.r AND a.meeting_id < b.meeting_id GROUP BY 1, 2)
SELECT meeting_a, meeting_b FROM c JOIN n x ON x.meeting_id = meeting_a JOIN n y ON y.meeting_id = meeting_b WHERE 2 * k >= x.n + y.n - k""",
}
