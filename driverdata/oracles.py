"""DuckDB SQL that computes each query of ``queries`` from the base tables."""

from driverdata.domain import LABEL_CATEGORIES, LABELS
from mediamart.operators.text import RETRY_ANSWER, RETRY_ERROR, RETRY_REQUEST
from mediamart.plans import reporting
from mediamart.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, UNIQUE
from mediamart.sources.taxonomy import CATEGORY_ROWS, SUBCATEGORY_ROWS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(map(_text, values)) + "]"


def _escaped(value: str) -> str:
    return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def two(x: str) -> str:
    """Two places, exact binary value half to even."""
    return f"CAST(format('{{:.2f}}', {x}) AS DOUBLE)"


def half_up(x: str, places: int) -> str:
    """Fifteen significant digits, then half away from zero."""
    return f"CAST(round(CAST(format('{{:.15g}}', {x}) AS DECIMAL(38,18)), {places}) AS DOUBLE)"


def share(part: str, whole: str) -> str:
    return half_up(f"(CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100)", 1)


CATS = "cats AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {_text(n)})" for i, n in CATEGORY_ROWS) + (
    ") AS t(category_id, main_category))"
)
SUBS = "subs AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {c}, {_text(n)})" for i, c, n in SUBCATEGORY_ROWS) + (
    ") AS t(subcategory_id, category_id, subcategory))"
)

CALENDAR = """CAST(strftime(d, '%Y%m%d') AS INT) AS date_id, d AS date, year(d) AS year, quarter(d) AS quarter,
    month(d) AS month, monthname(d) AS month_name, week(d) AS week_of_year, isodow(d) AS day_of_week,
    dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend"""
DAYS = (
    f"days AS (SELECT {CALENDAR} FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2015-01-01', "
    "TIMESTAMP '2024-12-31', INTERVAL 1 DAY)) AS DATE) AS d))"
)
DAY_COLUMNS = ", ".join("d." + c for c in reporting.DAY_COLUMNS)

WORDS = """w AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS video_id, source, lang, n_chars,
    string_split(text, ' ') AS words, len(string_split(text, ' ')) AS n,
    (len(string_split(text, ' ')) + 9) // 10 AS segments,
    CAST(DATE '2015-01-01' + CAST(doc_id % 3600 AS INT) AS DATE) AS upload_date,
    len(list_filter(string_split(text, ' '), lambda x: length(x) >= 2 AND length(x) <> 4)) > 0 AS finished
    FROM documents)"""
ALL_SEGMENTS = """seg0 AS (SELECT doc_id, video_id, source, lang, n, finished, i AS segment_id,
    words[i * 10 + 1 : i * 10 + 10] AS part FROM w, unnest(range(segments)) AS u(i)),
    seg AS (SELECT doc_id, video_id, source, lang, n, finished, segment_id,
    array_to_string(part, ' ') AS segment_text, CAST(segment_id AS DOUBLE) AS raw_start,
    CAST(segment_id AS DOUBLE) + len(part) * CAST(0.1 AS DOUBLE) AS raw_end FROM seg0)"""
CHAPTERS = f"""chap0 AS (SELECT w.doc_id, w.video_id, w.finished, w.segments, k, k * 5 AS id,
    CASE WHEN w.doc_id % 10 = 3 THEN -k ELSE k END AS place,
    CASE WHEN k % 3 <> 2 THEN ' Part ' || k END AS theme, s.segment_text AS first_text
    FROM w, unnest(range((segments + 4) // 5)) AS u(k)
    JOIN seg s ON s.doc_id = w.doc_id AND s.segment_id = k * 5),
    chap AS (SELECT *, CASE WHEN k % 2 = 0 THEN first_text END AS summary,
    coalesce(lead(id) OVER (PARTITION BY doc_id ORDER BY place) - 1, segments - 1) AS end_id,
    row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS list_place,
    length(first_text) % {len(LABELS)} + 1 AS pick FROM chap0)"""
POINTS = """pts AS (SELECT video_id, CAST(pos - 1 AS DOUBLE) / CAST(10 AS DOUBLE) AS t,
    CAST(least(length(word), 10) AS DOUBLE) / CAST(10 AS DOUBLE) AS c
    FROM (SELECT video_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w WHERE {where})
    WHERE length(word) >= 2 AND length(word) <> 4)"""
EVENT_POINTS = """pts AS (SELECT user_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / CAST(1e6 AS DOUBLE) AS t,
    event_type, event_id AS seq, round(value / 600 * 100) / 100 AS c FROM events)"""


def clusters(key: str, gap: str) -> str:
    return f"""runs AS (SELECT *, sum(is_new) OVER (PARTITION BY {key} ORDER BY t) AS run FROM (
        SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY {key} ORDER BY t) > {gap} THEN 1 ELSE 0 END AS is_new
        FROM pts)),
    cl AS (SELECT {key}, min(t) AS s, max(t) AS e, max(t) - min(t) AS dur, count(*) AS points,
        CAST(sum(CAST(c AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS av, max(c) AS mx FROM runs GROUP BY {key}, run)"""


def events(key: str, gap: str, duration: str, mean: str) -> str:
    return f"""{clusters(key, gap)},
    ev AS (SELECT {key}, CAST(row_number() OVER (PARTITION BY {key} ORDER BY s) AS INT) AS sequence,
        CAST(points AS INT) AS points, {two('dur')} AS duration_seconds, {two('s')} AS start_seconds,
        {two('e')} AS end_seconds, {two('av')} AS avg_confidence, {two('mx')} AS max_confidence
        FROM cl WHERE dur >= {duration} AND av >= {mean})"""


GAP, DURATION, MEAN = "CAST(0.2 AS DOUBLE)", "CAST(0.4 AS DOUBLE)", "CAST(0.3 AS DOUBLE)"
WORD_EVENTS = POINTS.format(where="finished") + ", " + events("video_id", GAP, DURATION, MEAN)
ALL_WORD_EVENTS = POINTS.format(where="true") + ", " + events("video_id", GAP, DURATION, MEAN)
USER_EVENTS = EVENT_POINTS + ", " + events("user_id", "21600", "3600", "CAST(0.1 AS DOUBLE)")
VIDEOS = f"""{WORDS}, videos AS (SELECT video_id, source AS channel_id, lang AS playlist_id,
    trim('  ' || lang || ' ' || doc_id || ' ') AS video_title, trim(' ' || upper(source) || ' ') AS channel_name,
    trim('All ' || lang) AS playlist_title, n // 10 + 1 AS duration, n_chars // 10 AS like_count,
    n_chars AS view_count, n // 20 AS comment_count, upload_date,
    upload_date + 7 AS snapshot_date, doc_id FROM w WHERE finished)"""
CORE_SEGMENTS = f"""{ALL_SEGMENTS}, stg_seg AS (SELECT video_id, segment_id, raw_start AS start_s,
    {two('raw_end')} AS end_s, trim(segment_text) AS segment_text,
    segment_text <> '' AND {two('raw_end')} > raw_start AS is_valid FROM seg WHERE finished),
    core_seg AS (SELECT * FROM stg_seg WHERE is_valid)"""
CORE_CHAPTERS = f"""{CHAPTERS}, {CATS}, {SUBS},
    stg_class AS (SELECT video_id, id AS start_segment_id, 'Label ' || pick AS reason,
        {_list(LABELS)}[pick] AS subcategory, {_list(LABEL_CATEGORIES)}[pick] AS main_category
        FROM chap WHERE finished),
    core_chap AS (SELECT c.video_id, c.id AS start_segment_id, c.end_id AS end_segment_id,
        trim(c.summary) AS chapter_summary, s.subcategory_id
        FROM chap c JOIN stg_class k ON k.video_id = c.video_id AND k.start_segment_id = c.id
        JOIN subs s ON s.subcategory = k.subcategory WHERE c.finished)"""
FACT_CHAPTERS = f"""{CORE_SEGMENTS}, {CORE_CHAPTERS}, {WORD_EVENTS}, {DAYS},
    times AS (SELECT c.video_id, c.subcategory_id, s.category_id, a.start_s, b.end_s,
        {half_up('(b.end_s - a.start_s)', 2)} AS duration
        FROM core_chap c JOIN subs s USING (subcategory_id)
        JOIN core_seg a ON a.video_id = c.video_id AND a.segment_id = c.start_segment_id
        JOIN core_seg b ON b.video_id = c.video_id AND b.segment_id = c.end_segment_id),
    inside AS (SELECT t.video_id, t.subcategory_id, t.category_id, t.start_s, t.end_s, t.duration,
        sum(CAST(e.duration_seconds AS DECIMAL(18,2))) AS laughter FROM times t
        LEFT JOIN ev e ON e.video_id = t.video_id AND e.start_seconds BETWEEN t.start_s AND t.end_s
        GROUP BY ALL),
    fact_chapters AS (SELECT i.video_id, d.date_id, v.channel_id, v.playlist_id, i.subcategory_id,
        i.category_id, i.start_s, i.end_s, i.duration,
        CASE WHEN laughter IS NULL THEN 0.0 ELSE {share('laughter', 'i.duration')} END AS laughter_percent
        FROM inside i JOIN videos v USING (video_id) JOIN days d ON d.date = v.upload_date)"""
LAUGHTER = """laughter AS (SELECT video_id, sum(CAST(duration_seconds AS DECIMAL(18,2))) AS laughter
    FROM ev WHERE duration_seconds > 1 GROUP BY video_id)"""
FACT_METRICS = f"""{LAUGHTER}, fact_metrics AS (SELECT v.video_id, v.playlist_id, v.channel_id, d.date_id,
    v.view_count, v.like_count, v.comment_count, v.duration, {share('l.laughter', 'v.duration')} AS laughter_percent
    FROM videos v JOIN laughter l USING (video_id) JOIN days d ON d.date = v.upload_date)"""
SNAPSHOTS = """snap AS (SELECT CAST(user_id AS VARCHAR) AS video_id, CAST(ts AS DATE) AS snapshot_date,
    count(*) FILTER (event_type = 'click') AS like_count, count(*) AS view_count,
    count(*) FILTER (event_type = 'purchase') AS comment_count FROM events GROUP BY 1, 2)"""
DELTAS = """deltas AS (SELECT video_id, snapshot_date, view_count - lag(view_count) OVER q AS views,
    like_count - lag(like_count) OVER q AS likes, comment_count - lag(comment_count) OVER q AS comments
    FROM snap WINDOW q AS (PARTITION BY video_id ORDER BY snapshot_date))"""
FACT_DAILY = f"""{SNAPSHOTS}, {DELTAS}, fact_daily AS (SELECT x.video_id, d.date_id, v.channel_id, v.playlist_id,
    x.views AS prev_day_view, x.likes AS prev_day_like, x.comments AS prev_day_comment
    FROM deltas x JOIN videos v USING (video_id) JOIN days d ON d.date = x.snapshot_date)"""
PEOPLE = """chan AS (SELECT DISTINCT channel_id, channel_name FROM videos),
    lists AS (SELECT DISTINCT playlist_id, playlist_title FROM videos)"""
EVENT_JSON = """'{"events":[' || coalesce(string_agg('{"sequence":' || sequence || ',"start_seconds":' || start_seconds
    || ',"end_seconds":' || end_seconds || ',"duration_seconds":' || duration_seconds || ',"points":' || points
    || ',"avg_confidence":' || avg_confidence || ',"max_confidence":' || max_confidence || '}', ',' ORDER BY sequence), '')
    || ']}'"""
LINE_PRIORITY = """new AS (SELECT l_orderkey AS o_orderkey,
    max(CASE WHEN l_linestatus <> 'O' THEN l_returnflag END) AS p FROM lineitem GROUP BY 1)"""
HALF_DONE = """(doc_id % 7 = 1) AS no_tr, (doc_id % 7 = 2) AS empty_tr, (doc_id % 5 = 1) AS no_ch,
    (doc_id % 5 = 2) AS empty_ch, (doc_id % 3 = 1) AS no_cl, (doc_id % 11 = 1) AS no_pt,
    (doc_id % 11 = 2 OR NOT finished) AS empty_pt, (doc_id % 13 = 1) AS no_ev, (doc_id % 17 <> 0) AS has_url"""
HALF = f"""{WORDS}, h AS (SELECT video_id, upload_date, {HALF_DONE} FROM w),
    st AS (SELECT video_id, CASE WHEN no_tr OR empty_tr OR no_ch OR empty_ch OR no_cl OR no_pt OR empty_pt OR no_ev
    THEN 'new' ELSE 'finished' END AS process_status FROM h)"""
ERROR_HOURS = f"""{EVENT_POINTS}, hours AS (SELECT user_id, t AS a, t + CAST(3600 AS DOUBLE) AS b, seq AS error_id
    FROM pts WHERE event_type = 'error')"""
ASKED = """SELECT conv_id || '-' || turn AS key, length(text) AS n FROM conversations"""


def full(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


ORACLES = {
    "s1_raw_scan": full(WORDS)
    + """SELECT source AS channel_id, ' ' || upper(source) || ' ' AS channel_name, lang AS playlist_id,
        'All ' || lang AS playlist_title, video_id, '  ' || lang || ' ' || doc_id || ' ' AS video_title,
        'https://media.example/' || doc_id AS video_url,
        '{"duration":' || (n // 10 + 1) || ',"like_count":' || (n_chars // 10) || ',"view_count":' || n_chars
        || ',"comment_count":' || (n // 20) || ',"upload_date":"' || strftime(upload_date, '%Y%m%d') || '"}'
        AS video_meta_json, CASE WHEN finished THEN 'finished' ELSE 'new' END AS process_status,
        upload_date AS created_on, upload_date + 7 AS meta_updated_on FROM w""",
    "s2_taxonomy_parts": full(CATS, SUBS)
    + """SELECT subcategory_id, category_id, main_category, subcategory, count(*) AS parts FROM part
        JOIN subs ON subcategory_id = p_size % 50 + 1 JOIN cats USING (category_id) GROUP BY ALL""",
    "s3_calendar": f"""WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1),
        b AS (SELECT min(day) AS a, max(day) AS z FROM o),
        c AS (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
        AS d FROM b) SELECT {CALENDAR}, coalesce(orders, 0) AS orders FROM c LEFT JOIN o ON day = d""",
    "s5_view": """SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
    "s7_upsert": """WITH u AS (SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders
        WHERE o_orderstatus = 'O' UNION ALL SELECT -o_orderkey - 1, o_orderstatus, o_totalprice FROM orders)
        SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'O'
        UNION ALL SELECT * FROM u""",
    "s8_schema_evolution": """SELECT o_orderkey, o_orderstatus, o_totalprice, NULL::BIGINT AS lines FROM orders
        UNION ALL SELECT -l_orderkey - 1, max(l_linestatus), NULL, count(*) FROM lineitem GROUP BY l_orderkey""",
    "s9_conform": """SELECT l_linenumber, count(*) AS lines, CAST(sum(trunc(l_quantity)) AS BIGINT) AS quantity,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
        max(length(CAST(l_orderkey AS VARCHAR))) AS longest_key FROM lineitem GROUP BY 1""",
    "s9_rejected_batch": """SELECT CAST(s_suppkey AS VARCHAR) AS channel_id, s_name AS channel_name, 1 AS refused,
        (SELECT count(*) FROM supplier WHERE s_suppkey % 2 <> 0) AS stored_before FROM supplier""",
    "s11_incremental_switch": """SELECT DISTINCT c_nationkey AS nation, 'first' AS run FROM customer UNION ALL
        SELECT DISTINCT c_nationkey, 'second' FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier)""",
    "s12_artefact_json": """SELECT o_orderkey, '{"customer":' || o_custkey || ',"priority":"' || o_orderpriority || '"'
        || CASE WHEN o_orderstatus = 'O' THEN ',"open_price":' || o_totalprice ELSE '' END || '}' AS artefact FROM orders""",
    "r1_flatten_playlists": full(WORDS, ALL_SEGMENTS)
    + """SELECT source AS channel_id, upper(source) AS channel_name, video_id AS playlist_id,
        'List ' || video_id AS playlist_title, video_id || '-' || segment_id AS video_id,
        segment_text AS video_title, 'https://media.example/' || segment_id AS video_url,
        segment_id AS position FROM seg WHERE n > 10""",
    "r2_project_meta": """SELECT o_orderkey, '{"duration":' || (o_orderkey % 3000 + 600)
        || ',"like_count":' || CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) ELSE 'null' END
        || ',"view_count":' || CAST(floor(o_totalprice) AS BIGINT) || ',"upload_date":"'
        || strftime(o_orderdate, '%Y%m%d') || '"}' AS video_meta_json FROM orders""",
    "r3_dedupe_first": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_discount, l_extendedprice, l_linestatus, l_partkey, l_quantity, l_returnflag, l_shipdate, l_suppkey,
        l_tax) AS rn FROM lineitem) WHERE rn = 1""",
    "r4_insert_absent": """SELECT l_orderkey, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1 AND l_orderkey NOT IN
        (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "r5_playlist_ids": "SELECT DISTINCT lang AS playlist_id FROM documents",
    "r6_lookup": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
        WHERE o_orderkey IN (SELECT user_id FROM events)""",
    "r7_update_column": f"""WITH {LINE_PRIORITY} SELECT o.o_orderkey, o.o_custkey,
        CASE WHEN new.o_orderkey IS NOT NULL THEN p ELSE o.o_orderpriority END AS o_orderpriority
        FROM orders o LEFT JOIN new USING (o_orderkey)""",
    "r8_change_stamp": """SELECT CAST(o_orderkey AS VARCHAR) AS video_id,
        CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 8 IN (0, 3) THEN DATE '2030-01-01'
        WHEN o_orderkey % 8 IN (1, 2) THEN CAST(o_orderdate AS DATE) WHEN o_orderstatus = 'O' THEN DATE '2030-01-01'
        ELSE CAST(o_orderdate AS DATE) END AS stamped_on FROM orders""",
    "r9_default_created": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE)
        ELSE DATE '2030-01-01' END AS created_on FROM orders""",
    "r10_fill_missing": f"""WITH {LINE_PRIORITY} SELECT o.o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F'
        THEN o_orderpriority END, p) AS o_orderpriority FROM orders o LEFT JOIN new USING (o_orderkey)""",
    "r10_fill_forced": f"""WITH {LINE_PRIORITY} SELECT o.o_orderkey, coalesce(p, CASE WHEN o_orderstatus = 'F'
        THEN o_orderpriority END) AS o_orderpriority FROM orders o LEFT JOIN new USING (o_orderkey)""",
    "r11_work_flags": full(HALF)
    + """SELECT video_id, has_url AND upload_date + 7 < DATE '2020-01-01' AS needs_meta,
        has_url AND (no_tr OR no_pt) AS needs_audio, has_url AND no_tr AS needs_transcript,
        has_url AND no_pt AS needs_points, has_url AND no_ev AS needs_events,
        NOT (no_tr OR empty_tr) AND no_ch AS needs_chapters,
        NOT (no_tr OR empty_tr) AND NOT (no_ch OR empty_ch) AND no_cl AS needs_classes FROM h""",
    "r14_status": full(HALF) + "SELECT * FROM st",
    "r15_changed_rows": full(HALF) + "SELECT count(*) AS changed FROM st WHERE process_status = 'finished'",
    "ingest_run": f"""SELECT CAST(doc_id AS VARCHAR) AS video_id,
        CASE WHEN doc_id % 13 <> 0 AND doc_id % 5 <> 0 THEN 'finished' END AS process_status, doc_id % 13 <> 0 AS chapters,
        CASE WHEN doc_id % 13 <> 0 AND doc_id % 5 <> 0 THEN doc_id END AS view_count,
        CASE WHEN doc_id % 13 <> 0 AND doc_id % 5 <> 0 THEN {share('1.9', '(doc_id % 50 + 60)')} END AS laughter_percent,
        CASE WHEN doc_id % 13 = 0 THEN 3 END AS skipped, (SELECT count(*) FROM documents WHERE doc_id % 13 <> 0) AS first,
        0 AS second, FALSE AS built_again FROM documents""",
    "r16_playlist_urls": """SELECT DISTINCT source || '-' || lang AS playlist_id,
        'https://www.youtube.com/playlist?list=' || source || '-' || lang AS url FROM documents WHERE source <> 'src3'""",
    "r17_audio_keys": "SELECT doc_id, 'data/audio/' || doc_id || '.opus' AS object_name FROM documents",
    "r18_missing_objects": """SELECT 'data/audio/' || doc_id || '.opus' AS object_name, doc_id FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "r20_enrich": f"""SELECT key, CASE WHEN n % 7 <> 0 AND n % 5 <> 0 AND n % 11 <> 0
        THEN '{{"n": ' || n || '}}' END AS result,
        CASE WHEN n % 7 = 0 THEN 1 WHEN n % 5 = 0 OR n % 3 = 0 OR n % 11 = 0 THEN 2 ELSE 1 END AS attempts,
        CASE WHEN n % 7 = 0 THEN 'Unavailable' WHEN n % 5 = 0 THEN 'NoValidAnswer' WHEN n % 11 = 0 THEN 'Unavailable' END
        AS error FROM ({ASKED})""",
    "r19_skipped_items": f"""SELECT CASE WHEN n % 7 = 0 OR n % 5 <> 0 THEN 'Unavailable' ELSE 'NoValidAnswer' END AS error,
        count(*) AS items FROM ({ASKED}) WHERE n % 7 = 0 OR n % 5 = 0 OR n % 11 = 0 GROUP BY 1""",
    "t1_segment_map": full(WORDS, ALL_SEGMENTS)
    + f"""SELECT doc_id, CAST(segment_id AS VARCHAR) AS segment, md5(segment_text) AS text_md5,
        {two('raw_start / CAST(7 AS DOUBLE)')} AS start, {two('raw_end / CAST(7 AS DOUBLE)')} AS "end" FROM seg""",
    "t2_strip_fences": "SELECT conv_id, turn, text AS body FROM conversations",
    "t3_split_valid_json": """SELECT event_id, CASE WHEN event_type = 'error' THEN props[1 : length(props) - 1]
        WHEN event_type = 'signup' THEN NULL ELSE CASE event_id % 10 WHEN 1 THEN props || ' and so on'
        WHEN 2 THEN props || props WHEN 3 THEN '{"k":NaN}' WHEN 4 THEN '{''k'':1}'
        WHEN 5 THEN props || ',"b":{"c":1}' ELSE props END END AS answer,
        CASE WHEN event_type = 'signup' THEN 'no answer'
        WHEN event_type = 'error' OR event_id % 10 BETWEEN 1 AND 5 THEN 'not valid JSON' ELSE 'valid' END AS reason
        FROM events""",
    "t4_summary_prompt": full(WORDS, ALL_SEGMENTS)
    + """SELECT video_id, md5('Find the topics:' || chr(10) || '{' || string_agg('"' || segment_id || '":{"text":'
        || CAST(to_json(segment_text) AS VARCHAR) || '}', ',' ORDER BY segment_id) || '}') AS prompt_md5
        FROM seg GROUP BY video_id""",
    "t5_classifier_prompt": full(WORDS, ALL_SEGMENTS, CHAPTERS)
    + """SELECT video_id, md5('Classify:' || chr(10) || '{"chapters":[' || string_agg('{"id":' || id
        || coalesce(',"theme":"' || theme || '"', '')
        || coalesce(',"summary":' || CAST(to_json(summary) AS VARCHAR), '') || '}', ',' ORDER BY place) || ']}')
        AS prompt_md5 FROM chap GROUP BY video_id""",
    "t6_retry_prompt": f"""SELECT conv_id, turn, 'Ask. ' || {_escaped(RETRY_ERROR)} || role || {_escaped(RETRY_ANSWER)}
        || text || {_escaped(RETRY_REQUEST)} AS prompt FROM conversations""",
    "t7_chapter_ends": full(WORDS, ALL_SEGMENTS, CHAPTERS)
    + "SELECT video_id, list_place AS place, id, end_id FROM chap",
    "t8_nested_labels": """SELECT p_brand, '{"p_brand":"' || p_brand || '","types":["' || string_agg(p_type, '","'
        ORDER BY p_type) || '"]}' AS json FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY 1""",
    "a1_select_points": full(EVENT_POINTS)
    + """SELECT user_id, t, arg_max(c, seq) AS confidence FROM pts WHERE event_type = 'click' AND seq IN
        (SELECT event_id FROM events WHERE value / 600 >= CAST(0.02 AS DOUBLE)) GROUP BY ALL""",
    "a2_explode_points": full(WORDS, POINTS.format(where="true"))
    + "SELECT video_id, t, c AS confidence FROM pts",
    "a3_gap_clusters": full(EVENT_POINTS, clusters("user_id", "21600"))
    + """SELECT user_id, s AS start, e AS "end", dur AS duration, points, round(av, 10) AS avg_confidence,
        mx AS max_confidence FROM cl""",
    "a5_kept_events": full(EVENT_POINTS, clusters("user_id", "21600"))
    + """SELECT user_id, s AS start, e AS "end", points FROM cl WHERE dur >= 3600 AND av >= CAST(0.1 AS DOUBLE)""",
    "a6_numbered_events": full(USER_EVENTS) + "SELECT * FROM ev",
    "a6_word_events": full(WORDS, ALL_WORD_EVENTS) + "SELECT * FROM ev",
    "a7_events_payload": full(WORDS, ALL_WORD_EVENTS)
    + f"""SELECT w.video_id, {EVENT_JSON} AS laugh_events_json
        FROM w LEFT JOIN ev ON ev.video_id = w.video_id GROUP BY w.video_id""",
    "p1_stg_videos_base": full(VIDEOS)
    + """SELECT video_id, channel_id, playlist_id, video_title, channel_name, playlist_title, duration, like_count,
        view_count, comment_count, upload_date, 'finished' AS process_status, snapshot_date AS meta_updated_at,
        true AS is_valid FROM videos""",
    "p2_stg_transcripts": full(VIDEOS, CORE_SEGMENTS) + "SELECT * FROM stg_seg",
    "p3_stg_chapters": full(WORDS, ALL_SEGMENTS, CHAPTERS)
    + """SELECT video_id, id AS start_segment_id, end_id AS end_segment_id, trim(theme) AS chapter_theme,
        trim(summary) AS chapter_summary, coalesce(theme, summary) IS NOT NULL AND end_id >= id AS is_valid
        FROM chap WHERE finished""",
    "p4_stg_classifications": full(VIDEOS, CORE_SEGMENTS, CORE_CHAPTERS) + "SELECT *, true AS is_valid FROM stg_class",
    "p5_stg_sound_features": full(VIDEOS, WORD_EVENTS) + "SELECT *, true AS is_valid FROM ev",
    "p7_valid_video": """SELECT CAST(o_orderkey AS VARCHAR) AS video_id, o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
        AND o_orderstatus = 'F' AS is_valid FROM orders""",
    "p8_valid_segment": """SELECT l_returnflag <> 'A' AND NOT coalesce(CASE WHEN l_tax > CAST(0.01 AS DOUBLE)
        THEN l_quantity END <= l_discount * 500, false) AS is_valid, count(*) AS segments FROM lineitem GROUP BY 1""",
    "p9_valid_chapter": """SELECT (l_returnflag = 'A' OR l_linestatus = 'O') AND NOT coalesce(CASE WHEN l_linenumber > 1
        THEN l_suppkey * 20 END < l_partkey, false) AS is_valid, count(*) AS chapters FROM lineitem GROUP BY 1""",
    "p10_valid_classification": """SELECT l_returnflag = 'A' OR l_linestatus = 'O' OR l_linenumber = 2 AS is_valid,
        count(*) AS classes FROM lineitem GROUP BY 1""",
    "p11_valid_event": """SELECT CASE WHEN l_linenumber >= 7 AND l_returnflag <> 'A' THEN false
        WHEN l_linenumber < 6 AND l_quantity - 1 <= 0 THEN false
        WHEN l_linenumber < 7 AND (l_discount * 11 <= 0 OR l_discount * 11 > 1) THEN false ELSE true END AS is_valid,
        count(*) AS events FROM lineitem GROUP BY 1""",
    "c1_core_channels": full(VIDEOS, PEOPLE) + "SELECT *, DATE '2030-01-01' AS created_at FROM chan",
    "c1_new_channels": full(VIDEOS, PEOPLE)
    + """SELECT *, DATE '2030-01-01' AS created_at FROM chan WHERE channel_id NOT IN
        (SELECT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)""",
    "c2_core_playlists": full(VIDEOS, PEOPLE) + "SELECT *, DATE '2030-01-01' AS created_at FROM lists",
    "c3_core_videos": full(VIDEOS)
    + """SELECT video_id, channel_id, playlist_id, video_title, duration, upload_date,
        DATE '2030-01-01' AS created_at FROM videos WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "c4_core_videos_meta": full(VIDEOS)
    + """SELECT video_id, snapshot_date, like_count, view_count, comment_count FROM videos
        WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "c5_core_transcript_segments": full(VIDEOS, CORE_SEGMENTS)
    + """SELECT video_id, segment_id, segment_text, start_s, end_s FROM core_seg
        WHERE video_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)""",
    "c6_core_sound_features": full(VIDEOS, WORD_EVENTS)
    + "SELECT * FROM ev WHERE video_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)",
    "c7_core_chapters": full(VIDEOS, CORE_SEGMENTS, CORE_CHAPTERS) + "SELECT * FROM core_chap",
    "c7_new_chapters": full(VIDEOS, CORE_SEGMENTS, CORE_CHAPTERS)
    + "SELECT * FROM core_chap WHERE video_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)",
    "c8_chapters_per_category": full(VIDEOS, CORE_SEGMENTS, CORE_CHAPTERS)
    + """, used AS (SELECT subcategory_id, count(*) AS n FROM core_chap GROUP BY 1)
        SELECT category_id, main_category, count(*) AS subcategories, CAST(coalesce(sum(n), 0) AS BIGINT) AS chapters
        FROM subs JOIN cats USING (category_id) LEFT JOIN used USING (subcategory_id) GROUP BY ALL""",
    "m1_dim_channels": full(VIDEOS, PEOPLE) + "SELECT * FROM chan",
    "m2_dim_playlists": full(VIDEOS, PEOPLE) + "SELECT * FROM lists",
    "m3_dim_videos": full(VIDEOS) + "SELECT video_id, video_title FROM videos",
    "m4_topic_dims": full(CATS, SUBS)
    + """SELECT main_category, subcategory, count(*) AS parts FROM part
        JOIN subs ON subcategory_id = p_size % 50 + 1 JOIN cats USING (category_id) GROUP BY ALL""",
    "m6_fact_video_chapters": full(VIDEOS, FACT_CHAPTERS) + "SELECT * FROM fact_chapters",
    "m7_fact_video_daily_snapshot": full(VIDEOS, DAYS, FACT_DAILY) + "SELECT * FROM fact_daily",
    "m8_fact_video_metrics": full(VIDEOS, DAYS, WORD_EVENTS, FACT_METRICS) + "SELECT * FROM fact_metrics",
    "v1_chapters_metrics": full(VIDEOS, FACT_CHAPTERS, PEOPLE)
    + f"""SELECT cats.main_category, subs.subcategory, v.video_title, chan.channel_name, lists.playlist_title,
        f.duration, f.laughter_percent, {DAY_COLUMNS} FROM fact_chapters f JOIN cats ON cats.category_id = f.category_id
        JOIN subs ON subs.subcategory_id = f.subcategory_id JOIN days d USING (date_id) JOIN videos v USING (video_id)
        JOIN chan ON chan.channel_id = f.channel_id JOIN lists ON lists.playlist_id = f.playlist_id""",
    "v2_video_metrics": full(VIDEOS, FACT_CHAPTERS, FACT_METRICS, PEOPLE)
    + f"""SELECT chan.channel_name, lists.playlist_title, v.video_title, subs.subcategory, cats.main_category,
        m.view_count, m.laughter_percent, m.like_count, m.comment_count, m.duration, {DAY_COLUMNS},
        printf('%02d:%02d:%02d', m.duration // 3600, m.duration % 3600 // 60, m.duration % 60) AS duration_hms
        FROM fact_metrics m JOIN fact_chapters f USING (video_id) JOIN cats ON cats.category_id = f.category_id
        JOIN subs ON subs.subcategory_id = f.subcategory_id JOIN days d ON d.date_id = m.date_id
        JOIN videos v ON v.video_id = m.video_id
        JOIN chan ON chan.channel_id = m.channel_id JOIN lists ON lists.playlist_id = m.playlist_id""",
    "v3_video_daily_snapshot": full(VIDEOS, DAYS, FACT_DAILY, PEOPLE)
    + """SELECT d.*, v.video_title, chan.channel_name, lists.playlist_title, f.prev_day_view, f.prev_day_like,
        f.prev_day_comment FROM fact_daily f JOIN days d USING (date_id) JOIN videos v USING (video_id)
        JOIN chan ON chan.channel_id = f.channel_id JOIN lists ON lists.playlist_id = f.playlist_id""",
    "v4_dwh_statistics": full(VIDEOS, DAYS, WORD_EVENTS, FACT_METRICS, PEOPLE)
    + f"""SELECT {_text(reporting.TOTAL_CHANNELS)} AS label, count(*) AS total FROM chan
        UNION SELECT {_text(reporting.TOTAL_PLAYLISTS)}, count(*) FROM lists
        UNION SELECT {_text(reporting.TOTAL_VIDEOS)}, count(*) FROM videos
        UNION SELECT {_text(reporting.TOTAL_HOURS)}, CAST(sum(duration) // 3600 AS BIGINT) FROM fact_metrics""",
    "j1_inner_join": "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey",
    "j2_composite_join": """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2)
        SELECT copies, count(*) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
        FROM lineitem JOIN k USING (l_orderkey, l_linenumber) GROUP BY 1""",
    "j3_bound_lookup": """WITH s AS (SELECT l_suppkey, min(l_partkey) AS first_part, max(l_partkey) AS last_part
        FROM lineitem GROUP BY 1) SELECT l_suppkey, first_part, last_part, a.p_retailprice, b.p_size
        FROM s JOIN part a ON a.p_partkey = first_part JOIN part b ON b.p_partkey = last_part""",
    "j4_points_in_ranges": full(ERROR_HOURS)
    + """SELECT h.user_id, error_id, p.seq FROM hours h LEFT JOIN pts p ON p.user_id = h.user_id
        AND p.event_type <> 'error' AND p.t BETWEEN a AND b""",
    "j4_sum_in_ranges": full(ERROR_HOURS)
    + """SELECT error_id, CAST(sum(p.seq) AS BIGINT) AS total FROM hours h LEFT JOIN pts p ON p.user_id = h.user_id
        AND p.t BETWEEN a AND b GROUP BY error_id""",
    "j5_anti_join": """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
        (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')""",
    "j6_newer_than_stored": full(SNAPSHOTS)
    + """SELECT * FROM snap s WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = 'error' AND e.value > 60
        AND CAST(e.user_id AS VARCHAR) = s.video_id AND CAST(e.ts AS DATE) >= s.snapshot_date)""",
    "j8_star_join": """SELECT r_name, n_name, o_orderstatus, count(*) AS orders,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    "j10_date_key_join": full(DAYS.replace("2015-01-01", "1992-01-01"))
    + """, b AS (SELECT CAST(ts AS DATE) AS date, user_id FROM events
        UNION ALL SELECT CAST(o_orderdate AS DATE), o_custkey FROM orders)
        SELECT date_id, is_weekend, count(*) AS n, max(user_id) AS highest FROM b JOIN days USING (date) GROUP BY ALL""",
    "g2_laughter_seconds": full(VIDEOS, WORD_EVENTS, LAUGHTER)
    + "SELECT video_id, CAST(laughter AS DOUBLE) AS laughter FROM laughter",
    "g3_null_sums": """SELECT l_returnflag, l_linenumber,
        CAST(sum(CASE WHEN l_returnflag <> 'N' THEN l_linenumber END) AS BIGINT) AS total,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price FROM lineitem GROUP BY 1, 2""",
    "g5_totals": """SELECT count(l_orderkey) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) // 3600 AS BIGINT) AS hours
        FROM lineitem""",
    "g6_distinct": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
    "w1_deltas": full(SNAPSHOTS, DELTAS) + "SELECT * FROM deltas",
    "w2_latest": full(SNAPSHOTS)
    + """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY snapshot_date DESC) AS rn
        FROM snap) WHERE rn = 1""",
    "w2_latest_null_first": full(SNAPSHOTS)
    + """, u AS (SELECT video_id, CASE WHEN view_count <> 1 THEN snapshot_date END AS snapshot_date,
        max(like_count) AS like_count FROM snap GROUP BY 1, 2) SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY video_id ORDER BY snapshot_date DESC NULLS FIRST) AS rn FROM u) WHERE rn = 1""",
    "w4_number_rows": full(EVENT_POINTS)
    + """SELECT user_id, t, seq, CAST(row_number() OVER (PARTITION BY user_id ORDER BY t) AS INT) AS sequence FROM pts""",
    "w4_number_rows_null": full(EVENT_POINTS)
    + """, q AS (SELECT CASE WHEN user_id % 7 > 0 THEN user_id END AS user_id, CASE WHEN seq % 500 > 0 THEN t END AS t, seq
        FROM pts) SELECT user_id, t, CASE WHEN t IS NOT NULL THEN seq END AS seq,
        CAST(row_number() OVER (PARTITION BY user_id ORDER BY t NULLS FIRST) AS INT) AS sequence FROM q""",
    "u1_labelled_totals": """SELECT count(o_orderkey) AS total, 'orders' AS label FROM orders
        UNION SELECT count(*), 'orders' FROM orders UNION SELECT count(c_custkey), 'customers' FROM customer""",
    "f1_text_functions": """SELECT c_custkey, c_name || chr(9) AS name,
        CASE WHEN c_nationkey > 4 THEN c_nationkey ELSE c_acctbal END AS value,
        CASE WHEN c_nationkey <= 4 THEN 'none' WHEN c_nationkey < 10 THEN 'low' ELSE 'high' END AS kind,
        c_nationkey > 4 AS known, c_nationkey <= 4 AS differs FROM customer""",
    "f6_json_members": """SELECT event_id, CAST(props->>'$.k' AS INT) AS k, props->>'$.missing' AS missing FROM events""",
    "f10_casts": """SELECT o_orderkey, CAST(o_custkey AS INT) AS customer, o_totalprice AS price,
        CAST(o_orderdate AS DATE) AS day FROM orders""",
    "f13_round_half_even": f"""SELECT l_returnflag, l_linenumber, {two('l_extendedprice / 8')} AS rounded,
        count(*) AS lines FROM lineitem GROUP BY ALL""",
    "f14_round_half_up": f"""SELECT l_returnflag, {half_up('(l_extendedprice / l_quantity / 3)', 1)} AS tenths,
        {half_up('(l_extendedprice / l_quantity / 3 / 10)', 2)} AS hundredths, count(*) AS lines
        FROM lineitem GROUP BY ALL""",
    "f15_percent": f"""WITH l AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS part FROM lineitem
        GROUP BY 1) SELECT o_orderkey, {share('part', 'o_totalprice')} AS share FROM orders JOIN l
        ON l_orderkey = o_orderkey""",
    "f16_clock": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN printf('%02d:%02d:%02d', s // 3600,
        s % 3600 // 60, s % 60) END AS duration_hms
        FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS s FROM orders)""",
    "f25_non_empty_json": "SELECT event_id, event_type IN ('error', 'purchase') AS filled FROM events",
    "f26_round_hundredths": """SELECT round(l_extendedprice / 7000 * 100) / 100 AS rounded, count(*) AS lines
        FROM lineitem GROUP BY 1""",
    "q1_not_null": """SELECT 'not_null(checked)' AS "check", 'orders' AS "table",
        count(*) FILTER (o_orderstatus = 'P') AS failures FROM orders
        UNION ALL SELECT 'not_null(o_orderkey)', 'orders', count(*) FILTER (o_orderkey IS NULL) FROM orders""",
    "q2_unique": """SELECT 'unique(l_orderkey, l_linenumber)' AS "check", 'lineitem' AS "table", count(*) AS failures
        FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
    "q3_equal_rowcount": full(VIDEOS, CORE_SEGMENTS, CORE_CHAPTERS)
    + """SELECT 'equal_rowcount(stg_chapters)' AS "check", 'core_chapters' AS "table",
        abs((SELECT count(*) FROM core_chap) - (SELECT count(*) FROM chap WHERE finished)) AS failures""",
    "q4_primary_key": """SELECT 'primary_key(l_orderkey, number)' AS "check", 'lineitem' AS "table",
        CAST(sum(CASE WHEN number IS NULL THEN n WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS failures FROM (
        SELECT l_orderkey, CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS number, count(*) AS n
        FROM lineitem GROUP BY 1, 2)""",
    "q5_foreign_key": """SELECT 'foreign_key(l_orderkey -> orders)' AS "check", 'lineitem' AS "table",
        count(*) AS failures FROM lineitem WHERE l_orderkey NOT IN
        (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "q6_composite_foreign_key": """SELECT 'foreign_key(l_orderkey, l_suppkey -> returned)' AS "check",
        'lineitem' AS "table", count(*) AS failures FROM lineitem c WHERE NOT EXISTS (SELECT 1 FROM lineitem p
        WHERE p.l_returnflag = 'R' AND p.l_orderkey = c.l_orderkey AND p.l_suppkey = c.l_suppkey)""",
    "q7_contract": full(VIDEOS) + "SELECT count(*) AS \"rows\", 10 AS differences FROM videos",
}

ORACLES["o1_sorted_chapters"] = ORACLES["m6_fact_video_chapters"]
ORACLES["s11_incremental_build"] = ORACLES["m6_fact_video_chapters"]
# in a build the snapshots come from the raw rows, one per video, seven days after its upload
_DAILY = full(VIDEOS, DAYS) + "SELECT date_id, video_id FROM videos JOIN days ON days.date = videos.upload_date + 7"
ORACLES["s11_calendar_extended"] = (
    "SELECT fact, date_id, count(*) AS n, max(video_id) AS last_video FROM ("
    + " UNION ALL ".join(
        f"SELECT '{fact}' AS fact, date_id, video_id FROM ({sql})"
        for fact, sql in (
            ("fact_video_chapters", ORACLES["m6_fact_video_chapters"]),
            ("fact_video_daily_snapshot", _DAILY),
            ("fact_video_metrics", ORACLES["m8_fact_video_metrics"]),
        )
    )
    + ") GROUP BY ALL"
)
ORACLES["a7_events_in_row"] = ORACLES["a7_events_payload"]


def _report() -> str:
    """Every declared check of four core tables, counted in SQL."""
    shapes = {
        "core_channels": "(SELECT *, 1 AS created_at FROM chan)",
        "core_videos": "(SELECT *, 1 AS created_at FROM videos)",
        "core_transcript_segments": "core_seg",
        "core_chapters": "core_chap",
    }
    row = "SELECT '{}' AS \"check\", '{}' AS \"table\", {} AS failures".format
    checks = []
    for table, shape in shapes.items():
        keys = PRIMARY_KEYS[table]
        null_key = " OR ".join(f"{k} IS NULL" for k in keys)
        checks.append(row("contract", table, 0))
        groups = f"SELECT {null_key} AS bad, count(*) AS n FROM {shape} GROUP BY {', '.join(keys)}"
        bad = f"(SELECT CAST(coalesce(sum(CASE WHEN bad THEN n WHEN n > 1 THEN 1 ELSE 0 END), 0) AS BIGINT) FROM ({groups}))"
        checks.append(row(f"primary_key({', '.join(keys)})", table, bad))
        for column in NOT_NULL[table]:
            checks.append(row(f"not_null({column})", table, f"(SELECT count(*) FROM {shape} WHERE {column} IS NULL)"))
        for columns, parent, parent_columns in FOREIGN_KEYS.get(table, []):
            if parent in shapes:
                same = " AND ".join(f"p.{p} = c.{c}" for c, p in zip(columns, parent_columns))
                known = " AND ".join(f"c.{c} IS NOT NULL" for c in columns)
                orphans = f"SELECT count(*) FROM {shape} c WHERE {known} AND NOT EXISTS (SELECT 1 FROM {shapes[parent]} p WHERE {same})"
                checks.append(row(f"foreign_key({', '.join(columns)} -> {parent})", table, f"({orphans})"))
    unique = UNIQUE["stg_chapters"]
    repeated = "SELECT 1 FROM chap WHERE finished GROUP BY video_id, id, end_id HAVING count(*) > 1"
    checks.append(row(f"unique({', '.join(unique)})", "stg_chapters", f"(SELECT count(*) FROM ({repeated}))"))
    counts = "abs((SELECT count(*) FROM core_chap) - (SELECT count(*) FROM chap WHERE finished))"
    checks.append(row("equal_rowcount(stg_chapters)", "core_chapters", counts))
    return full(VIDEOS, PEOPLE, CORE_SEGMENTS, CORE_CHAPTERS) + " UNION ALL ".join(checks)


ORACLES["q8_report"] = _report()
ORACLES["w1_late_snapshots"] = ORACLES["w1_deltas"]
ORACLES["c4_marks"] = full(SNAPSHOTS) + """SELECT *, CASE WHEN day(snapshot_date) <= 12 THEN 1 WHEN day(snapshot_date) <= 20 THEN 2
    ELSE 3 END AS load, max(snapshot_date) OVER (PARTITION BY video_id) AS newest FROM snap"""
ORACLES["q4_stored_keys"] = """SELECT l_orderkey AS o_orderkey, l_linestatus AS o_orderstatus, l_partkey, 1 AS refused,
    (SELECT count(*) FROM orders) AS stored FROM lineitem WHERE l_linenumber = 7 AND l_orderkey IN (SELECT o_orderkey FROM orders)"""
ORACLES["v1_chapters_of_a_quarter"] = f"SELECT * FROM ({ORACLES['v1_chapters_metrics']}) WHERE year = 2015 AND quarter = 2"
ORACLES["m8_metrics_of_buckets"] = full(VIDEOS, FACT_CHAPTERS, FACT_METRICS) + """SELECT m.video_id, m.date_id, m.view_count, m.laughter_percent,
    count(*) AS chapters, max(f.laughter_percent) AS most_laughter FROM fact_metrics m JOIN fact_chapters f USING (video_id) GROUP BY ALL"""
ORACLES["v4_totals_of_states"] = """SELECT count(*) AS n, CAST(sum(CAST(round(CASE WHEN o_orderkey % 50 = 7 THEN floor(o_totalprice)
    ELSE o_totalprice END * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders"""
ORACLES["r20_enrich_stored"] = f"SELECT *, true AS within_budget, true AS some_waited FROM ({ORACLES['r20_enrich']})"
ORACLES["x1_rows_of_a_function"] = """WITH t AS (SELECT conv_id || '-' || turn AS key, text FROM conversations WHERE text IS NOT NULL)
    SELECT key, CAST(i - 1 AS INT) AS place, parts[i] AS text, CAST(NULL AS VARCHAR) AS error
    FROM (SELECT key, string_split(text, '. ') AS parts FROM t WHERE length(text) % 9 <> 0), unnest(range(1, len(parts) + 1)) AS u(i)
    UNION ALL SELECT key, NULL, NULL, 'Unavailable' FROM t WHERE length(text) % 9 = 0"""
