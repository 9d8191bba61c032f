"""The SQL of the named queries, for another engine on the same tables."""

from __future__ import annotations

from minutesmith.functions.text import NEW_FORMS, OLD_FORMS

#: White space of any kind, as a pattern class.
SPACE = r"[\s\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
ONCE = """sp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY speech_id ORDER BY retrieved_at DESC) AS rn FROM speeches) WHERE rn = 1),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY meeting_id ORDER BY retrieved_at DESC) AS rn FROM meetings) WHERE rn = 1)"""

SQL: dict[str, str] = {
    "corpus_stats": f"""WITH {ONCE}, p AS (SELECT meeting_id, count(*) AS n, count(*) FILTER (kind = 'verbatim') AS v, sum(CASE WHEN kind = 'verbatim' THEN length(text) ELSE 0 END) AS c,
        count(*) FILTER (kind = 'summary') AS s, sum(CASE WHEN kind = 'summary' THEN length(text) ELSE 0 END) AS sc FROM sp GROUP BY 1)
        SELECT prefecture, count(*) FILTER (NOT (coalesce(n, 0) > 0 AND s = n)) AS meetings, count(*) FILTER (coalesce(n, 0) > 0 AND s = n) AS summary_records,
        CAST(sum(coalesce(v, 0)) AS BIGINT) AS speeches, CAST(sum(coalesce(c, 0)) AS BIGINT) AS characters, CAST(sum(coalesce(s, 0)) AS BIGINT) AS summary_passages,
        CAST(sum(coalesce(sc, 0)) AS BIGINT) AS summary_characters, CAST(min(meeting_date) AS VARCHAR) AS first_date, CAST(max(meeting_date) AS VARCHAR) AS last_date, count(*) FILTER (coalesce(n, 0) = 0) AS without_speeches
        FROM m LEFT JOIN p USING (meeting_id) GROUP BY 1""",
    "latest_speeches": f"WITH {ONCE} SELECT speech_id, meeting_id, speech_order, speaker, role, kind, sha256(text) AS digest FROM sp",
    "build_meetings": f"""WITH {ONCE}, j AS (SELECT meeting_id, count(*) AS n, string_agg(text, chr(10) || chr(10) ORDER BY speech_order, speaker, role, text) AS t, bool_and(kind = 'summary') AS s FROM sp GROUP BY 1)
        SELECT meeting_id, prefecture, coalesce(n, 0) AS n, sha256(coalesce(t, '')) AS digest, CAST(length(coalesce(t, '')) AS BIGINT) AS characters, CASE WHEN s THEN 'summary' ELSE 'verbatim' END AS kind
        FROM m LEFT JOIN j USING (meeting_id)""",
    "flatten_outer": f"WITH {ONCE} SELECT meeting_id, m.title, sp.speech_order, sp.speaker, sp.role, sp.kind FROM m LEFT JOIN sp USING (meeting_id)",
    "kind_rollup": f"WITH {ONCE}, k AS (SELECT bool_and(kind = 'summary') AS s FROM sp GROUP BY meeting_id) SELECT CASE WHEN s THEN 'summary' ELSE 'verbatim' END AS kind, count(*) AS n FROM k GROUP BY 1",
    "record_keys": f"WITH {ONCE} SELECT meeting_id, coalesce(url, 'file:' || source_file) AS record_key FROM m",
    "routed_counts": f"WITH {ONCE} SELECT CASE WHEN kind = 'summary' THEN 'summary/' ELSE '' END || prefecture || '.jsonl' AS path, count(*) AS n FROM sp GROUP BY 1",
    "csv_export": f"WITH {ONCE} SELECT speech_id, coalesce(speaker, '') AS speaker, coalesce(role, '') AS role, coalesce(CAST(meeting_date AS VARCHAR), '') AS date FROM sp",
    "dated_range": f"WITH {ONCE} SELECT meeting_id, CAST(meeting_date AS VARCHAR) AS date FROM m WHERE meeting_date IS NULL OR meeting_date BETWEEN DATE '2023-01-01' AND DATE '2024-06-30'",
    "wanted_links": """SELECT DISTINCT url, title FROM listing WHERE (coalesce(regexp_matches(title, '委員会|minutes'), false) OR coalesce(regexp_matches(url, '委員会|minutes'), false))
        AND NOT (coalesce(regexp_matches(title, '速報|第1号'), false) OR coalesce(regexp_matches(url, '速報|第1号'), false))""",
    "resume_anti": "SELECT DISTINCT url, site FROM listing l WHERE NOT EXISTS (SELECT 1 FROM meetings m WHERE m.url = l.url)",
    "audit_missing": """SELECT url, site, prefecture FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY listed_at DESC) AS rn FROM listing WHERE url IS NOT NULL) l WHERE rn = 1
        AND NOT EXISTS (SELECT 1 FROM meetings m WHERE m.url = l.url)""",
    "audit_by_site": """WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY listed_at DESC) AS rn FROM listing WHERE url IS NOT NULL) WHERE rn = 1),
        x AS (SELECT site, count(*) AS missing FROM l WHERE NOT EXISTS (SELECT 1 FROM meetings m WHERE m.url = l.url) GROUP BY 1)
        SELECT site, count(DISTINCT url) AS listed, coalesce(max(missing), 0) AS missing FROM listing LEFT JOIN x USING (site) GROUP BY 1""",
    "presence_counts": """WITH a AS (SELECT DISTINCT url FROM listing WHERE url IS NOT NULL), b AS (SELECT DISTINCT url FROM meetings WHERE url IS NOT NULL)
        SELECT CASE WHEN a.url IS NULL THEN 'right only' WHEN b.url IS NULL THEN 'left only' ELSE 'both' END AS found, count(*) AS n FROM a FULL JOIN b ON a.url = b.url GROUP BY 1""",
    "prefix_route": f"""WITH {ONCE}, r AS (SELECT meeting_id, site, row_number() OVER (PARTITION BY meeting_id ORDER BY length(start_url) DESC, start_url DESC) AS k FROM m JOIN sites ON starts_with(m.url, start_url))
        SELECT m.meeting_id, r.site FROM m LEFT JOIN r ON m.meeting_id = r.meeting_id AND k = 1""",
    "listing_lookup": f"""WITH {ONCE}, l AS (SELECT url, title, meeting_date FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY listed_at DESC) AS k FROM listing WHERE url IS NOT NULL) WHERE k = 1)
        SELECT meeting_id, CAST(coalesce(m.meeting_date, l.meeting_date) AS VARCHAR) AS date, coalesce(m.title, l.title) AS title, coalesce(m.meeting_date <> l.meeting_date, false) AS disagrees FROM m LEFT JOIN l ON m.url = l.url""",
    "edition_preference": f"""WITH {ONCE}, e AS (SELECT meeting_id, council_id, CASE WHEN title IS NULL THEN NULL WHEN contains(title, '確定版') THEN '確定版' WHEN contains(title, '速報版') THEN '速報版' ELSE '' END AS edition,
        regexp_replace(regexp_replace(title, '[（【]?(確定版|速報版)[）】]?', '', 'g'), '[ 　]', '', 'g') AS label FROM m)
        SELECT meeting_id, edition FROM e WHERE edition IS DISTINCT FROM '速報版' OR NOT EXISTS (SELECT 1 FROM e f WHERE f.edition = '確定版' AND f.council_id = e.council_id AND f.label = e.label)""",
    "speaker_diff": """SELECT DISTINCT prefecture, regexp_replace(speaker, '[ 　]', '', 'g') AS speaker FROM speaker_index WHERE speaker <> '' AND regexp_replace(speaker, '[ 　]', '', 'g') <> ''
        EXCEPT SELECT prefecture, regexp_replace(speaker, '[ 　]', '', 'g') FROM speeches""",
    "page_concat": f"""WITH {ONCE}, j AS (SELECT meeting_id, string_agg(text, chr(10) ORDER BY speech_order, speech_id) AS body FROM sp GROUP BY 1)
        SELECT meeting_id, CAST(length(body) AS BIGINT) AS characters, sha256(body) AS digest FROM j""",
    "speaker_counts": f"""WITH {ONCE} SELECT prefecture, count(DISTINCT speaker) AS spellings, count(DISTINCT regexp_replace(speaker, '[ 　]', '', 'g')) AS without_spaces, count(*) FILTER (speaker = '') AS unattributed
        FROM sp GROUP BY 1""",
    "role_counts": f"WITH {ONCE} SELECT role, count(*) AS n FROM sp WHERE role IS NOT NULL GROUP BY 1",
    "top_roles": f"WITH {ONCE} SELECT role, count(*) AS n FROM sp WHERE role IS NOT NULL GROUP BY 1 ORDER BY n DESC, role LIMIT 10",
    "grouped_names": f"WITH {ONCE} SELECT meeting_id, string_agg(speaker, '|' ORDER BY speaker) AS names FROM (SELECT DISTINCT meeting_id, speaker FROM sp WHERE speaker <> '') GROUP BY 1",
    "pooled_offices": f"WITH {ONCE} SELECT DISTINCT role FROM sp WHERE length(role) >= 2",
    "stated_counts": """SELECT meeting_id, max(CAST(n_speeches AS BIGINT)) AS stated, count(DISTINCT speech_id) AS found FROM meetings LEFT JOIN speeches USING (meeting_id) GROUP BY 1
        HAVING max(n_speeches) <> count(DISTINCT speech_id)""",
    "gap_check": f"""WITH {ONCE} SELECT meeting_id, CAST(max(speech_order) + 1 - count(DISTINCT speech_order) AS BIGINT) AS missing, CAST(count(speech_order) - count(DISTINCT speech_order) AS BIGINT) AS repeated FROM sp GROUP BY 1
        HAVING max(speech_order) + 1 - count(DISTINCT speech_order) > 0 OR count(speech_order) - count(DISTINCT speech_order) > 0""",
    "order_breaks": f"""WITH {ONCE}, x AS (SELECT meeting_id, speech_order, lead(speech_order) OVER (PARTITION BY meeting_id ORDER BY speech_order, speech_id) AS nx FROM sp)
        SELECT meeting_id, count(*) AS breaks FROM x WHERE nx IS NOT NULL AND speech_order + 1 <> nx GROUP BY 1""",
    "reparse_diff": f"WITH {ONCE} SELECT CASE WHEN regexp_replace(speaker, '[ 　]', '', 'g') = speaker OR speaker IS NULL THEN 'same' ELSE 'changed' END AS change, count(*) AS n FROM sp GROUP BY 1",
    "line_width_mode": f"""WITH {ONCE}, l AS (SELECT meeting_id, length(unnest(string_split(text, chr(10)))) AS w FROM sp), c AS (SELECT meeting_id, w, count(*) AS n FROM l GROUP BY 1, 2)
        SELECT meeting_id, CAST(w AS BIGINT) AS width FROM (SELECT *, row_number() OVER (PARTITION BY meeting_id ORDER BY n DESC, w DESC) AS k FROM c) WHERE k = 1""",
    "first_per_group": """SELECT council_id, CAST(meeting_date AS VARCHAR) AS date, meeting_id FROM (SELECT *, row_number() OVER (PARTITION BY council_id, meeting_date ORDER BY url IS NULL, coalesce(url, '~'), meeting_id, retrieved_at) AS k FROM meetings) WHERE k = 1""",
    "repeated_deliveries": """SELECT same_text, count(*) AS n FROM (SELECT coalesce(title, '') = coalesce(first_value(title) OVER w, '') AS same_text, row_number() OVER w AS k FROM meetings WINDOW w AS (PARTITION BY meeting_id ORDER BY retrieved_at))
        WHERE k > 1 GROUP BY 1""",
    "fill_forward": f"WITH {ONCE} SELECT speech_id, last_value(role IGNORE NULLS) OVER (PARTITION BY meeting_id ORDER BY speech_order, speech_id ROWS UNBOUNDED PRECEDING) AS last_role FROM sp",
    "ordered_sample": f"""WITH {ONCE}, r AS (SELECT prefecture, meeting_id, row_number() OVER (PARTITION BY prefecture ORDER BY meeting_id) - 1 AS i, count(*) OVER (PARTITION BY prefecture) AS n FROM m)
        SELECT prefecture, meeting_id FROM r WHERE n <= 6 OR i IN (SELECT CAST(round_even(j * (n - 1) / 5.0, 0) AS BIGINT) FROM range(6) t(j))""",
    "ordered_unique": "SELECT url, CAST(floor(epoch(min(listed_at))) AS BIGINT) AS first_listed, arg_max(title, listed_at) AS title FROM (SELECT url, listed_at, coalesce(title, NULL) AS title FROM listing) WHERE url IS NOT NULL GROUP BY 1",
    "speech_turns": f"""WITH {ONCE}, x AS (SELECT meeting_id, speaker IS DISTINCT FROM lag(speaker) OVER w OR lag(speech_id) OVER w IS NULL AS o FROM sp WINDOW w AS (PARTITION BY meeting_id ORDER BY speech_order, speech_id))
        SELECT meeting_id, count(*) FILTER (o) AS turns FROM x GROUP BY 1""",
    "limited": f"WITH {ONCE} SELECT meeting_id FROM m WHERE meeting_date IS NULL OR meeting_date >= DATE '2022-01-01' ORDER BY meeting_id LIMIT 25",
    "councils_latest": f"WITH {ONCE} SELECT council_id, CAST(max(meeting_date) AS VARCHAR) AS last_date, count(*) AS n FROM m GROUP BY 1",
    "set_ops": """WITH a AS (SELECT DISTINCT prefecture FROM meetings), b AS (SELECT DISTINCT prefecture FROM sites)
        SELECT 'both' AS what, (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS n UNION ALL SELECT 'first only', (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b))
        UNION ALL SELECT 'second only', (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) UNION ALL SELECT 'either', (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b))""",
    "dedupe_text": "SELECT sha256(text) AS digest, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1",
    "session_months": f"""WITH {ONCE}, x AS (SELECT meeting_id, meeting_date, TRY_CAST(nullif(regexp_extract(session, '年([0-9]{{1,2}})月', 1), '') AS INTEGER) AS s FROM m)
        SELECT meeting_id, ((month(meeting_date) - s) % 12 + 12) % 12 <= 2 AS "within", CAST(year(meeting_date) + CASE WHEN month(meeting_date) < s THEN 1 ELSE 0 END AS BIGINT) AS year FROM x WHERE s IS NOT NULL AND meeting_date IS NOT NULL""",
    "swallowed_markers": f"WITH {ONCE} SELECT speech_id FROM sp WHERE regexp_matches(text, '(^|\\n)[○◯〇◎◆●]')",
    "odd_speakers": f"""WITH {ONCE} SELECT CAST(length(speaker) AS BIGINT) AS characters, count(*) AS n, count(*) FILTER (regexp_matches(speaker, '[0-9０-９]')) AS with_digits, count(*) FILTER (regexp_matches(speaker, '[A-Za-z]')) AS with_letters
        FROM sp WHERE speaker <> '' GROUP BY 1""",
    "office_suffixes": """WITH n AS (SELECT DISTINCT speaker AS name FROM speaker_index WHERE length(speaker) > 1), o AS (SELECT name AS office FROM canon_values WHERE field = 'role')
        SELECT b.name AS bare, t.name AS titled, office FROM n t JOIN o ON suffix(t.name, office) AND length(t.name) > length(office) JOIN n b ON b.name = left(t.name, length(t.name) - length(office))""",
    "committee_lengths": f"WITH {ONCE} SELECT CAST(length(committee) AS BIGINT) AS characters, count(*) AS n FROM m GROUP BY 1",
    "quality_counts": f"""WITH {ONCE} SELECT prefecture, count(*) AS meetings, count(*) FILTER (url IS NULL) AS without_url, count(*) FILTER (meeting_date IS NULL) AS undated, count(*) FILTER (committee IS NULL) AS plenary,
        count(*) FILTER (n_speeches = 0) AS empty, count(*) FILTER (source_html_sha256 IS NULL) AS without_digest FROM m GROUP BY 1""",
    "duplicate_urls": f"WITH {ONCE} SELECT url, count(*) AS n FROM m WHERE url IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "url_shapes": "SELECT regexp_replace(url, '[0-9]+', 'N', 'g') AS shape, count(*) AS n FROM listing WHERE url IS NOT NULL GROUP BY 1",
    "url_hosts": "SELECT regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS host, count(DISTINCT url) AS urls FROM listing WHERE url IS NOT NULL GROUP BY 1",
    "slugs": "SELECT site, coalesce(nullif(prefecture || site, ''), 'unknown') AS slug FROM sites",
    "fetch_window": """SELECT CASE WHEN isodow(l) IN (6, 7) AND k >= 1200 THEN true WHEN isodow(l) IN (7, 1) AND k < 420 THEN true ELSE false END AS open, count(*) AS n
        FROM (SELECT ts + INTERVAL 9 HOUR AS l, hour(ts + INTERVAL 9 HOUR) * 60 + minute(ts + INTERVAL 9 HOUR) AS k FROM events) GROUP BY 1""",
    "throttle": """WITH e AS (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS a FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY a, event_id) - 1 AS i FROM e)
        SELECT event_id, CAST(i * 3600 + max(a - i * 3600) OVER (PARTITION BY user_id ORDER BY a, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS start_at FROM r""",
    "retries": """SELECT CASE WHEN s < 400 THEN 'ok' WHEN s IN (408, 429, 500, 502, 503, 504) AND a < 3 THEN 'retry' ELSE 'fail' END AS action, count(*) AS n
        FROM (SELECT 200 + event_id % 400 AS s, event_id % 5 AS a FROM events) GROUP BY 1""",
    "hourly_events": "SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "event_sessions": """WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events),
        g AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM o) SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS start, count(*) AS n FROM g GROUP BY user_id, k""",
    "incremental_append": "SELECT DISTINCT meeting_id, prefecture, kind FROM meetings",
    "list_pages": "SELECT site, unnest(range(2, CAST(ceil(n / 10.0) AS BIGINT) + 1)) AS page FROM (SELECT site, count(*) AS n FROM listing GROUP BY 1)",
    "url_walk": f"""WITH RECURSIVE {ONCE}, c AS (SELECT DISTINCT council_id, meeting_date FROM m WHERE meeting_date IS NOT NULL), l AS (SELECT DISTINCT a.council_id AS x, b.council_id AS y FROM c a JOIN c b USING (meeting_date)),
        w AS (SELECT CAST(1 AS BIGINT) AS u, 0 AS d UNION SELECT y, d + 1 FROM w JOIN l ON x = u WHERE d < 3) SELECT CAST(u AS VARCHAR) AS url, CAST(min(d) AS BIGINT) AS depth FROM w GROUP BY 1""",
    "resolved_dates": f"""WITH {ONCE}, l AS (SELECT url, meeting_date AS d FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY listed_at DESC) AS k FROM listing WHERE url IS NOT NULL) WHERE k = 1)
        SELECT CASE WHEN l.d IS NOT NULL THEN 'listing' WHEN m.meeting_date IS NOT NULL THEN 'printed' ELSE 'missing' END AS source, coalesce(l.d <> m.meeting_date, false) AS disagrees, count(*) AS n FROM m LEFT JOIN l ON m.url = l.url GROUP BY 1, 2""",
    "catalogue": "SELECT scraper, count(*) AS sites, count(start_url) AS with_start FROM sites GROUP BY 1",
    "new_on_second_page": "SELECT DISTINCT url FROM listing WHERE url IS NOT NULL AND url NOT IN (SELECT url FROM meetings WHERE url IS NOT NULL)",
    "hinted_links": """SELECT url, arg_max(coalesce(title, ''), listed_at) AS title FROM listing WHERE url IS NOT NULL AND (regexp_matches(coalesce(title, ''), '委員会') OR regexp_matches(url, '委員会'))
        AND NOT (regexp_matches(coalesce(title, ''), '特別') OR regexp_matches(url, '特別')) GROUP BY 1""",
    "next_openings": """SELECT CAST(CAST(CASE WHEN isodow(l) >= 6 THEN l ELSE l + INTERVAL 1 DAY * (6 - isodow(l)) END AS DATE) AS VARCHAR) AS opens_on, count(*) AS n FROM (SELECT ts + INTERVAL 9 HOUR AS l FROM events) GROUP BY 1""",
    "notices": f"WITH {ONCE} SELECT coalesce(kind = 'verbatim' AND meeting_date BETWEEN DATE '2023-01-01' AND DATE '2023-12-31', false) AS covered, count(*) AS n FROM m GROUP BY 1",
    "exemptions": """SELECT coalesce(starts_with(url, 'https://gijiroku.kasumi.example/view/') OR starts_with(url, 'https://gijiroku.azusa.example/'), false) AS exempt, count(*) AS n FROM listing GROUP BY 1""",
    "daily_rollup": "SELECT event_type, day, count(*) AS n, round(sum(value), 3) AS total FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, value FROM events) GROUP BY ROLLUP (event_type, day)",
    "ranked_customers": "SELECT c_mktsegment, place, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer) WHERE place <= 3",
    "listed_kinds": """SELECT CASE WHEN regexp_matches(title, '会議録|確定版|速報版|議事録') THEN 'minute' WHEN regexp_matches(title, '視察|調査') THEN 'visit' ELSE 'other' END AS kind,
        regexp_matches(title, '^[\\s　]*[0-9０-９]{1,2}月[\\s　]*[0-9０-９]{1,2}日.*号[\\s　]*$') AS sitting, count(*) AS n FROM listing WHERE title IS NOT NULL GROUP BY 1, 2""",
    "order_revenue": """SELECT c_mktsegment, year(o_orderdate) AS year, count(*) AS orders, round(sum(r), 2) AS revenue FROM (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS r FROM lineitem GROUP BY 1)
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    "transcript_sections": r"""WITH l AS (SELECT raw_id, unnest(string_split(body, chr(10))) AS raw, generate_subscripts(string_split(body, chr(10)), 1) AS pos FROM raw_transcripts),
b AS (SELECT raw_id, pos, regexp_replace(raw, '\s+$', '') AS line FROM l),
c AS (SELECT *, regexp_matches(line, '^[○◯〇◎●]') AS m, regexp_matches(line, '^[\s　]*[─━―ー\-－=＝_]{3,}[\s　]*$') AND length(regexp_replace(line, '^[ 　\t\x1a]+|[ 　\t\x1a]+$', '', 'g')) < 30 AS r FROM b),
d AS (SELECT *, max(m::INT) OVER w AS begun FROM c WINDOW w AS (PARTITION BY raw_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
e AS (SELECT *, sum((m OR r)::INT) OVER w AS section FROM d WHERE begun = 1 WINDOW w AS (PARTITION BY raw_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
f AS (SELECT raw_id, section, pos, m, line, CASE WHEN m OR NOT r THEN regexp_replace(CASE WHEN m THEN regexp_replace(line, '^[○◯〇◎●]([^　（(]+)(?:[　（(]\s*([^）)　]*)[）)]?)?', '') ELSE line END, '^[ 　\t\x1a]+|[ 　\t\x1a]+$', '', 'g') ELSE '' END AS w FROM e),
g AS (SELECT raw_id, section, bool_or(m) AS m, arg_min(line, pos) AS line, list(w ORDER BY pos) AS ws FROM f GROUP BY 1, 2),
h AS (SELECT raw_id, section, m, line, list_filter(ws, lambda x: x <> '' AND (m OR NOT regexp_matches(x, '^午[前後][0-9０-９]{1,2}時[0-9０-９]{1,2}分(?:\S{2})?$'))) AS said FROM g),
i AS (SELECT *, CASE WHEN m THEN CASE WHEN len(said) > 0 THEN 'speech' ELSE 'silent' END WHEN len(said) = 0 THEN 'empty' WHEN regexp_matches(said[1], '^[〔［]|氏名$') THEN 'aside' END AS own FROM h),
j AS (SELECT *, lag(own) OVER (PARTITION BY raw_id ORDER BY section) AS before FROM i),
k AS (SELECT *, coalesce(own, CASE WHEN before = 'aside' THEN 'resumed' ELSE 'unattributed' END) AS what, regexp_replace(regexp_extract(line, '^[○◯〇◎●]([^　（(]+)', 1), '^[ 　\t\x1a]+|[ 　\t\x1a]+$', '', 'g') AS speaker FROM j)
SELECT t.raw_id, count(*) FILTER (what IN ('speech', 'unattributed')) AS speeches, count(*) FILTER (what = 'silent') AS silent, coalesce(sum(CASE WHEN what = 'aside' THEN length(array_to_string(said, '')) END), 0)::BIGINT AS cut,
count(*) FILTER (what = 'resumed') AS resumed, count(*) FILTER (what = 'unattributed' OR (m AND speaker = '')) AS unattributed, count(*) FILTER (what IN ('empty', 'aside', 'resumed', 'unattributed')) AS rules
FROM raw_transcripts t LEFT JOIN k USING (raw_id) GROUP BY 1""",
    "plain_speakers": f"WITH {ONCE} SELECT speech_id, regexp_replace(translate(speaker, '{OLD_FORMS}', '{NEW_FORMS}'), '[ 　]', '', 'g') AS speaker FROM sp",
    "numbered_blocks": rf"""WITH {ONCE}, n AS (SELECT DISTINCT meeting_id, speaker FROM sp WHERE speaker IS NOT NULL)
        SELECT meeting_id, CAST(row_number() OVER (PARTITION BY meeting_id ORDER BY speaker) AS INTEGER) AS number, regexp_replace(speaker, '^{SPACE}+|{SPACE}+$', '', 'g') AS body FROM n""",
    "echoes_removed": rf"""WITH {ONCE} SELECT speech_id, sha256(regexp_replace(regexp_replace(coalesce(text, ''), '</?pre>', '', 'gi'), '^{SPACE}+|{SPACE}+$', '', 'g')) AS digest FROM sp""",
}
