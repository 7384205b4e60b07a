"""The registered queries as plain SQL over the driver tables."""

# Each step names the steps it needs; `sql` below puts a WITH clause together.
STEPS: dict[str, tuple[str, str]] = {
    "facts": ("", """
        SELECT e.event_id AS src_id, e.ts, 'user' || CAST(e.user_id AS VARCHAR) AS usr, e.event_type AS src_type,
               CAST(json_extract_string(e.props, '$.k') AS INT) AS k,
               CAST(json_extract_string(e.props, '$.k') AS INT) + 1 AS item,
               CAST(round(e.value * 100) AS BIGINT) AS cents,
               CAST(round(e.value * 100) AS BIGINT) // 100 AS bucket,
               'anime_' || CAST(CAST(json_extract_string(e.props, '$.k') AS INT) + 1 AS VARCHAR) AS agg
        FROM events e"""),
    "sent": ("facts", """
        SELECT f.*, a.attempt, 'evt-' || lpad(CAST(src_id AS VARCHAR), 12, '0') AS id,
               CASE src_type WHEN 'click' THEN 'ClickRegistered' WHEN 'view' THEN 'ViewRegistered'
                             WHEN 'purchase' THEN 'RatingGiven' ELSE src_type END AS kind,
               CAST(bucket - CASE attempt WHEN 0 THEN 3 ELSE 1 END AS INT) AS secs,
               cents // CASE attempt WHEN 0 THEN 10 ELSE 8 END AS rc,
               src_id * 2 + attempt AS ofs, k % 8 AS part,
               bucket = 40 AND attempt = 0 AS unsigned_, bucket = 50 AND attempt = 0 AS null_item,
               src_type = 'error' AND bucket = 60 AS cut_off,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS moment
        FROM facts f CROSS JOIN (VALUES (0), (1)) a(attempt)"""),
    "checked": ("sent", """
        SELECT *,
               '{' || concat_ws(',',
                 '"event_id":"' || id || '"', '"event_type":"' || kind || '"',
                 CASE WHEN bucket <> 33 THEN '"aggregate_id":"' || agg || '"' END,
                 '"anime_id":' || CASE WHEN null_item THEN 'null' ELSE CAST(item AS VARCHAR) END,
                 CASE WHEN NOT unsigned_ THEN '"user_id":"' || usr || '"' END,
                 CASE WHEN kind = 'ViewRegistered' AND bucket <> 7 THEN '"duration_seconds":' || CAST(secs AS VARCHAR) END,
                 CASE WHEN kind = 'RatingGiven' AND NOT (bucket = 15 AND attempt = 0)
                      THEN '"rating":' || CAST(rc // 100 AS VARCHAR) || '.' || lpad(CAST(rc % 100 AS VARCHAR), 2, '0') END,
                 CASE WHEN NOT unsigned_ THEN '"occurred_at":"' || moment || '"' END)
               || CASE WHEN cut_off THEN '' ELSE '}' END AS body,
               CASE WHEN cut_off OR kind NOT IN ('ClickRegistered', 'ViewRegistered', 'RatingGiven') THEN NULL
                    WHEN unsigned_ THEN '[''user_id'', ''occurred_at'']'
                    WHEN kind = 'ViewRegistered' AND bucket = 7 THEN '[''duration_seconds'']'
                    WHEN kind = 'RatingGiven' AND bucket = 15 AND attempt = 0 THEN '[''rating'']' END AS missing,
               CASE WHEN kind = 'ViewRegistered' AND secs < 0
                         THEN 'duration_seconds debe ser positivo, recibido: ' || CAST(secs AS VARCHAR)
                    WHEN kind = 'RatingGiven' AND rc NOT BETWEEN 100 AND 1000
                         THEN 'Rating debe estar entre 1.0 y 10.0, recibido: ' || CAST(rc / 100.0 AS VARCHAR)
                    WHEN null_item THEN 'Valor nulo o de tipo incorrecto en: [''anime_id'']' END AS problem
        FROM sent"""),
    "judged": ("checked", """
        SELECT *, CASE WHEN cut_off THEN 'invalid'
                       WHEN kind NOT IN ('ClickRegistered', 'ViewRegistered', 'RatingGiven') THEN 'unknown'
                       WHEN missing IS NOT NULL THEN 'invalid'
                       WHEN problem IS NOT NULL THEN 'error' ELSE 'ok' END AS verdict
        FROM checked"""),
    "messages": ("judged", """
        SELECT *, CASE WHEN cut_off THEN 'JSONDecodeError'
                       WHEN verdict IN ('invalid', 'error') THEN 'EventProcessingError' END AS error_type,
               CASE WHEN cut_off THEN 'El mensaje no es un objeto JSON'
                    WHEN verdict = 'invalid' THEN 'Evento inválido: faltan campos requeridos: ' || missing
                    WHEN verdict = 'error' THEN CASE kind
                         WHEN 'ClickRegistered' THEN 'Error procesando evento de click: '
                         WHEN 'ViewRegistered' THEN 'Error procesando evento de visualización: '
                         ELSE 'Error procesando evento de calificación: ' END || problem END AS error_message
        FROM judged"""),
    "first_ok": ("judged", "SELECT id, min(ofs) AS first FROM judged WHERE verdict = 'ok' GROUP BY id"),
    "resolved": ("messages first_ok", """
        SELECT m.*, CASE WHEN verdict IN ('invalid', 'unknown') THEN verdict
                         WHEN ofs = first THEN 'success' WHEN ofs > first THEN 'duplicate' ELSE 'error' END AS outcome
        FROM messages m LEFT JOIN first_ok USING (id)"""),
    "won": ("resolved", "SELECT * FROM resolved WHERE outcome = 'success'"),
    "clicks": ("won", """
        SELECT item AS anime_id, usr AS user_id, count(*) AS click_count, arg_max(ts, ofs) AS last_click_at
        FROM won WHERE kind = 'ClickRegistered' GROUP BY ALL"""),
    "views": ("won", """
        SELECT item AS anime_id, usr AS user_id, count(*) AS view_count,
               CAST(sum(secs) AS BIGINT) AS total_duration_seconds, arg_max(ts, ofs) AS last_view_at
        FROM won WHERE kind = 'ViewRegistered' GROUP BY ALL"""),
    "ratings": ("won", """
        SELECT item AS anime_id, usr AS user_id, arg_max(rc, ofs) AS rc, arg_max(ts, ofs) AS rated_at
        FROM won WHERE kind = 'RatingGiven' GROUP BY ALL"""),
    "stats": ("clicks views ratings", """
        SELECT anime_id, CAST(sum(c) AS BIGINT) AS total_clicks, CAST(sum(v) AS BIGINT) AS total_views,
               CAST(sum(r) AS BIGINT) AS total_ratings,
               CASE WHEN sum(r) > 0 THEN CAST((2 * sum(rc) + sum(r)) // (2 * sum(r)) AS DOUBLE) / 100.0
                    ELSE 0.0 END AS average_rating,
               CAST(sum(d) AS BIGINT) AS total_duration_seconds
        FROM (SELECT anime_id, click_count AS c, 0 AS v, 0 AS r, 0 AS rc, 0 AS d FROM clicks
              UNION ALL SELECT anime_id, 0, view_count, 0, 0, total_duration_seconds FROM views
              UNION ALL SELECT anime_id, 0, 0, 1, rc, 0 FROM ratings) GROUP BY anime_id"""),
    "shaped": ("stats", """
        SELECT anime_id, total_clicks, total_views, total_ratings, nullif(average_rating, 0.0) AS average_rating,
               total_duration_seconds FROM stats"""),
    "top_views": ("stats", "SELECT * FROM stats WHERE total_views > 0 ORDER BY total_views DESC, anime_id LIMIT 10"),
    "top_rating": ("stats", """
        SELECT * FROM stats WHERE average_rating > 0 AND total_ratings >= 5
        ORDER BY average_rating DESC, total_ratings DESC, anime_id LIMIT 10"""),
    # Failed deliveries and the ledger.
    "dead": ("resolved", """
        SELECT sha256(concat_ws(':', 'anime-events', CAST(part AS VARCHAR), CAST(ofs AS VARCHAR), sha256(body), error_message)) AS dlq_id,
               CASE WHEN cut_off THEN 'unknown' ELSE id END AS event_id,
               CASE WHEN cut_off THEN 'unknown' ELSE kind END AS event_type,
               CASE WHEN cut_off OR bucket = 33 THEN NULL ELSE agg END AS aggregate_id, body AS event_data,
               error_type, error_message, 'anime-events' AS kafka_topic, CAST(part AS INT) AS kafka_partition,
               ofs AS kafka_offset, ts AS failed_at, 0 AS retry_count, CAST(NULL AS TIMESTAMP) AS last_retry_at,
               'failed' AS status, CAST(NULL AS TIMESTAMP) AS resolved_at, CAST(NULL AS VARCHAR) AS notes
        FROM resolved WHERE outcome IN ('invalid', 'error')"""),
    "entries": ("resolved", """
        SELECT id AS event_id, arg_min(kind, ofs) AS event_type, arg_min(agg, ofs) AS aggregate_id,
               arg_max(outcome, ofs) AS status,
               CASE WHEN arg_max(outcome, ofs) = 'error' THEN arg_max(problem, ofs) END AS error_message
        FROM resolved
        WHERE outcome IN ('success', 'error') AND NOT (null_item AND bucket = 33) GROUP BY id"""),
    # Commands, catalog, log.
    "catalog": ("", """
        SELECT CAST(p_partkey + 1 AS INT) AS myanimelist_id, p_name AS title, p_brand || ' ' || p_type AS description,
               CAST(NULL AS VARCHAR) AS image, p_type AS type, p_size AS episodes,
               round(p_retailprice % 10, 1) AS score, CAST(p_size * 1000 AS INT) AS popularity
        FROM part WHERE p_size > 5"""),
    "shaped_items": ("catalog", "SELECT * REPLACE (nullif(score, 0.0) AS score) FROM catalog"),
    "commands": ("facts", """
        SELECT 'cmd-' || CAST(src_id AS VARCHAR) AS command_id,
               CASE src_type WHEN 'purchase' THEN 'rating' ELSE src_type END AS command_type,
               CASE WHEN bucket <> 50 THEN item END AS anime_id, CASE WHEN bucket <> 40 THEN usr END AS user_id,
               CASE WHEN src_type = 'view' THEN CAST(bucket - 3 AS INT) END AS duration_seconds,
               CASE WHEN src_type = 'purchase' THEN (cents // 10) / 100.0 END AS rating, ts AS issued_at
        FROM facts"""),
    "ruled": ("commands", """
        SELECT *, CASE WHEN command_type NOT IN ('click', 'view', 'rating') THEN 'command_type'
                       WHEN anime_id IS NULL THEN 'anime_id' WHEN user_id IS NULL THEN 'user_id'
                       WHEN command_type = 'view' AND duration_seconds < 0 THEN 'duration_seconds'
                       WHEN command_type = 'rating' AND NOT rating BETWEEN 0 AND 10 THEN 'rating' END AS reject_field
        FROM commands"""),
    "screened": ("ruled catalog", """
        SELECT r.*, c.myanimelist_id IS NOT NULL AS item_exists,
               CASE WHEN reject_field IS NOT NULL THEN 'validation'
                    WHEN c.myanimelist_id IS NULL THEN 'AnimeNotFoundError'
                    WHEN command_type = 'rating' AND rating < 1 THEN 'InvalidRatingError' END AS reject_reason
        FROM ruled r LEFT JOIN catalog c ON r.anime_id = c.myanimelist_id"""),
    "accepted": ("screened", """
        SELECT sha256(command_id) AS event_id,
               CASE command_type WHEN 'click' THEN 'ClickRegistered' WHEN 'view' THEN 'ViewRegistered'
                                 ELSE 'RatingGiven' END AS event_type,
               'anime_' || CAST(anime_id AS VARCHAR) AS aggregate_id, issued_at AS occurred_at, anime_id, user_id,
               duration_seconds, rating
        FROM screened WHERE reject_reason IS NULL"""),
    "numbered": ("accepted", """
        SELECT *, CAST(row_number() OVER (PARTITION BY aggregate_id ORDER BY occurred_at, event_id) AS INT) AS version
        FROM accepted"""),
    "log": ("numbered", """
        SELECT *, '{"event_id":"' || event_id || '","event_type":"' || event_type || '","aggregate_id":"' || aggregate_id
               || '","occurred_at":"' || strftime(occurred_at, '%Y-%m-%dT%H:%M:%S.%f') || '","version":'
               || CAST(version AS VARCHAR) || ',"metadata":{},"anime_id":' || CAST(anime_id AS VARCHAR)
               || ',"user_id":"' || user_id || '"'
               || coalesce(',"duration_seconds":' || CAST(duration_seconds AS VARCHAR), '')
               || coalesce(',"rating":' || CAST(rating AS VARCHAR), '')
               || ',"timestamp":"' || strftime(occurred_at, '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS event_data
        FROM numbered"""),
    "cleaned": ("", r"""
        SELECT CAST(p_partkey + 1 AS INT) AS myanimelist_id, CASE WHEN p_size <> 50 THEN p_name END AS title,
               p_brand || chr(10) || 'says "' || p_type || '"' AS description,
               CASE WHEN p_size <= 40 THEN p_type END AS type, nullif(CAST(p_size - 10 AS INT), 0) AS episodes,
               CASE WHEN p_size <= 30 THEN CAST(p_size + 1990 AS DOUBLE) END AS released_year,
               CASE WHEN p_type <> 'SMALL' THEN p_retailprice END AS score, CAST(NULL AS INT) AS ranked,
               CASE WHEN p_partkey * 1000 + 7 <= 2147483647 THEN CAST(p_partkey * 1000 + 7 AS INT) END AS members,
               CASE WHEN p_type NOT IN ('SMALL', 'ECONOMY')
                    THEN '{"brand":"' || p_brand || '","size":' || CAST(p_size AS VARCHAR) || '}' END AS characters,
               CAST(NULL AS VARCHAR) AS image
        FROM part"""),
}


def _needed(names: str, seen: list[str]) -> list[str]:
    for name in names.split():
        if name not in seen:
            _needed(STEPS[name][0], seen)
            if name not in seen:
                seen.append(name)
    return seen


def sql(needs: str, body: str) -> str:
    steps = ", ".join(f"{name} AS ({STEPS[name][1]})" for name in _needed(needs, []))
    return f"WITH {steps} {body}"


STATS = "anime_id, total_clicks, total_views, total_ratings, average_rating, total_duration_seconds"

# es-ES grouping; counts here stay far below a million.
NUMBER = """CASE WHEN {0} < 10000 THEN CAST({0} AS VARCHAR)
    ELSE CAST({0} // 1000 AS VARCHAR) || '.' || lpad(CAST({0} % 1000 AS VARCHAR), 3, '0') END"""
DURATION = """CASE WHEN {0} >= 3600 THEN concat({0} // 3600, 'h ', {0} % 3600 // 60, 'm ', {0} % 60, 's')
    WHEN {0} >= 60 THEN concat({0} // 60, 'm ', {0} % 60, 's') ELSE concat({0}, 's') END"""

_RETRIED = """SELECT kafka_offset, event_type, aggregate_id,
    CASE WHEN event_type = 'ViewRegistered' THEN 'retrying' ELSE 'failed' END AS status,
    CASE WHEN event_type = 'ViewRegistered' THEN 1 ELSE 0 END AS retry_count,
    CASE WHEN event_type = 'ViewRegistered' THEN TIMESTAMP '2024-02-01' END AS last_retry_at,
    event_type = 'ViewRegistered' AS changed FROM dead"""

SUMMARY = sql("resolved", """
    SELECT CASE WHEN cut_off THEN 'unknown' ELSE kind END AS event_type, outcome, count(*) AS deliveries,
           CASE WHEN outcome IN ('error', 'invalid') THEN 'error' ELSE 'processed' END AS counter
    FROM resolved GROUP BY ALL""")

ORACLE: dict[str, str] = {
    "clicks_by_item_user": sql("clicks", "SELECT * FROM clicks"),
    "views_by_item_user": sql("views", "SELECT * FROM views"),
    "latest_ratings": sql("ratings", "SELECT anime_id, user_id, rc / 100.0 AS rating, rated_at FROM ratings"),
    "activity": sql("clicks views ratings", """
        SELECT anime_id, user_id, coalesce(click_count, 0) AS click_count, last_click_at,
               coalesce(view_count, 0) AS view_count, coalesce(total_duration_seconds, 0) AS total_duration_seconds,
               last_view_at, rc / 100.0 AS rating, rated_at
        FROM clicks FULL JOIN views USING (anime_id, user_id) FULL JOIN ratings USING (anime_id, user_id)"""),
    "item_stats": sql("stats", f"SELECT {STATS} FROM stats"),
    "incremental_item_stats": sql("stats", f"SELECT {STATS} FROM stats"),
    "stream_projection": sql("stats", f"SELECT {STATS} FROM stats"),
    "stream_ledger": sql("entries", "SELECT * FROM entries"),
    "stream_dead_letters": sql("dead", "SELECT * EXCLUDE (failed_at) FROM dead"),
    "classify_events": sql("resolved", """
        SELECT 'anime-events' AS topic, CAST(part AS INT) AS partition, ofs AS "offset",
               CASE WHEN NOT cut_off THEN id END AS event_id, CASE WHEN NOT cut_off THEN kind END AS event_type, outcome
        FROM resolved"""),
    "missing_fields": sql("messages", """
        SELECT ofs AS "offset", CASE WHEN NOT cut_off THEN kind END AS event_type, error_type, error_message
        FROM messages WHERE verdict = 'invalid'"""),
    "drop_processed": sql("judged", """
        SELECT ofs AS "offset", CASE WHEN NOT cut_off THEN id END AS event_id, verdict FROM judged
        WHERE cut_off OR id NOT IN (SELECT id FROM judged WHERE verdict = 'ok' AND ts < TIMESTAMP '2024-01-16')"""),
    "ledger": sql("entries", "SELECT * FROM entries"),
    "incremental_ledger": sql("entries", "SELECT * FROM entries"),
    "processing_summary": SUMMARY,
    "stream_counters": SUMMARY,
    "top_by_views": sql("top_views", f"SELECT {STATS} FROM top_views"),
    "top_by_rating": sql("top_rating", f"SELECT {STATS} FROM top_rating"),
    "shape_stats": sql("shaped", "SELECT * FROM shaped"),
    "shape_item": sql("shaped_items", "SELECT * FROM shaped_items"),
    "stats_for_ids": sql("stats", f"SELECT {STATS} FROM stats WHERE anime_id IN (SELECT p_partkey + 1 FROM part)"),
    "item_for_ids": sql("shaped_items", """
        SELECT * FROM shaped_items WHERE myanimelist_id IN (SELECT l_partkey + 1 FROM lineitem)"""),
    "item_detail": sql("shaped shaped_items", """
        SELECT * FROM (SELECT myanimelist_id AS anime_id, * EXCLUDE (myanimelist_id) FROM shaped_items)
        FULL JOIN shaped USING (anime_id)"""),
    "top_items": sql("top_views shaped_items", """
        SELECT t.* REPLACE (nullif(average_rating, 0.0) AS average_rating), i.* EXCLUDE (myanimelist_id)
        FROM top_views t LEFT JOIN shaped_items i ON t.anime_id = i.myanimelist_id"""),
    "search_items": sql("stats", f"""
        SELECT * FROM (SELECT {STATS} FROM stats WHERE total_views > 0 ORDER BY total_views DESC, anime_id LIMIT 100)
        WHERE contains(CAST(anime_id AS VARCHAR), '7')"""),
    "stats_chart_data": sql("stats", "SELECT anime_id, total_views FROM stats"),
    "dashboard_totals": sql("top_views", f"""
        SELECT *, {DURATION.format('duration')} AS duration_text FROM (
          SELECT CAST(coalesce(sum(total_clicks), 0) AS BIGINT) AS clicks, CAST(coalesce(sum(total_views), 0) AS BIGINT) AS views,
                 CAST(coalesce(sum(total_ratings), 0) AS BIGINT) AS ratings,
                 CAST(coalesce(sum(total_duration_seconds), 0) AS BIGINT) AS duration FROM top_views)"""),
    "dashboard_table": sql("top_rating", f"""
        SELECT anime_id, {NUMBER.format('total_clicks')} AS clicks, {NUMBER.format('total_views')} AS views,
               {NUMBER.format('total_ratings')} AS ratings, printf('%.2f', average_rating) AS average,
               {DURATION.format('total_duration_seconds')} AS duration FROM top_rating"""),
    "dead_letters": sql("dead", "SELECT * FROM dead"),
    "incremental_dead_letters": sql("dead", """
        SELECT * REPLACE (
          CASE WHEN failed_at < TIMESTAMP '2024-01-16' THEN 'resolved' ELSE status END AS status,
          CASE WHEN failed_at < TIMESTAMP '2024-01-16' THEN TIMESTAMP '2024-02-01' END AS resolved_at,
          CASE WHEN failed_at < TIMESTAMP '2024-01-16' THEN 'revisado' END AS notes) FROM dead"""),
    "dlq_list": sql("dead", """
        SELECT event_id, event_type, error_message, kafka_partition, kafka_offset, failed_at, status FROM dead
        ORDER BY failed_at DESC, dlq_id LIMIT 100"""),
    "dlq_mark_retry": sql("dead", f"""
        SELECT kafka_offset, status, retry_count, last_retry_at, CAST(NULL AS TIMESTAMP) AS resolved_at,
               CAST(NULL AS VARCHAR) AS notes, changed FROM ({_RETRIED})"""),
    "dlq_mark_resolved": sql("dead", f"""
        SELECT kafka_offset, CASE WHEN aggregate_id IS NOT NULL THEN 'resolved' ELSE status END AS status, retry_count,
               last_retry_at, CASE WHEN aggregate_id IS NOT NULL THEN TIMESTAMP '2024-02-01' END AS resolved_at,
               CASE WHEN aggregate_id IS NOT NULL THEN 'revisado' END AS notes, aggregate_id IS NOT NULL AS changed
        FROM ({_RETRIED})"""),
    "stream_letters_marked": sql("dead", f"""
        SELECT kafka_offset, CASE WHEN aggregate_id IS NOT NULL THEN 'resolved' ELSE status END AS status, retry_count,
               last_retry_at, CASE WHEN aggregate_id IS NOT NULL THEN TIMESTAMP '2024-02-02' END AS resolved_at,
               CASE WHEN aggregate_id IS NOT NULL THEN 'revisado' END AS notes
        FROM ({_RETRIED})"""),
    "validate_commands": sql("ruled", """
        SELECT command_id, reject_field, CASE WHEN reject_field IS NOT NULL THEN 'validation' END AS reject_reason FROM ruled"""),
    "check_item_exists": sql("screened", "SELECT command_id, anime_id, item_exists FROM screened"),
    "screen_commands": sql("screened", """
        SELECT command_id, reject_reason, CASE reject_reason
                 WHEN 'validation' THEN reject_field
                 WHEN 'AnimeNotFoundError' THEN 'Anime con ID ' || CAST(anime_id AS VARCHAR) || ' no existe'
                 WHEN 'InvalidRatingError' THEN 'Calificación ' || CAST(rating AS VARCHAR)
                      || ' no es válida. Debe estar entre 1.0 y 10.0' END AS reject_message FROM screened"""),
    "commands_to_events": sql("accepted", """
        SELECT *, 1 AS version, '{}' AS metadata, occurred_at AS timestamp FROM accepted"""),
    "append_events": sql("accepted", """
        SELECT event_id, event_type, aggregate_id, occurred_at FROM accepted WHERE occurred_at >= TIMESTAMP '2024-01-16'"""),
    "assign_versions": sql("numbered", "SELECT event_id, aggregate_id, occurred_at, version FROM numbered"),
    "ingest_commands": sql("log", """
        SELECT event_id, event_type, aggregate_id, event_data, occurred_at, version, '{}' AS metadata FROM log"""),
    "events_for_aggregate": sql("log", """
        SELECT aggregate_id, version, event_data FROM log
        JOIN (SELECT aggregate_id, max(version) // 2 AS since FROM log GROUP BY 1) USING (aggregate_id)
        WHERE version > since"""),
    "publish_events": sql("log", "SELECT aggregate_id AS key, event_data AS value FROM log"),
    "rebuild_read_model": sql("accepted numbered", """
        , rated AS (SELECT anime_id, user_id, arg_max(CAST(round(rating * 100) AS BIGINT), version) AS rc
                    FROM numbered WHERE event_type = 'RatingGiven' GROUP BY ALL),
        avgs AS (SELECT anime_id, count(*) AS n, sum(rc) AS s FROM rated GROUP BY 1),
        sums AS (SELECT anime_id, count(*) FILTER (WHERE event_type = 'ClickRegistered') AS total_clicks,
                        count(*) FILTER (WHERE event_type = 'ViewRegistered') AS total_views,
                        CAST(coalesce(sum(duration_seconds), 0) AS BIGINT) AS total_duration_seconds FROM numbered GROUP BY 1)
        SELECT anime_id, total_clicks, total_views, coalesce(n, 0) AS total_ratings,
               CASE WHEN n > 0 THEN CAST((2 * s + n) // (2 * n) AS DOUBLE) / 100.0 ELSE 0.0 END AS average_rating,
               total_duration_seconds FROM sums LEFT JOIN avgs USING (anime_id)"""),
    "clean_catalog": sql("cleaned", "SELECT * FROM cleaned"),
    "load_catalog": sql("cleaned catalog", """
        SELECT * FROM cleaned WHERE title IS NOT NULL
        UNION ALL BY NAME
        SELECT myanimelist_id, title, description, type, episodes, CAST(NULL AS DOUBLE) AS released_year, score,
               CAST(NULL AS INT) AS ranked, CAST(NULL AS INT) AS members, CAST(NULL AS VARCHAR) AS characters, image
        FROM catalog WHERE myanimelist_id NOT IN (SELECT myanimelist_id FROM cleaned WHERE title IS NOT NULL)"""),
    "upsert_catalog": sql("catalog", """
        , latest AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC,
                       l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem)
        SELECT CAST(l_partkey + 1 AS INT) AS myanimelist_id, 'update ' || CAST(l_orderkey AS VARCHAR) AS title,
               CAST(NULL AS VARCHAR) AS description, l_returnflag AS type, l_linestatus AS status,
               CASE WHEN l_quantity > 10 THEN CAST(l_quantity AS INT) END AS episodes, l_discount AS score,
               CAST(NULL AS INT) AS popularity, CAST(l_suppkey AS INT) AS members FROM latest WHERE rn = 1
        UNION ALL
        SELECT myanimelist_id, title, description, type, NULL, episodes, score, popularity, NULL FROM catalog
        WHERE myanimelist_id NOT IN (SELECT l_partkey + 1 FROM lineitem)"""),
}

# Integers that may be NULL, as doubles on both sides.
_NULLABLE = {
    "item_detail": "episodes popularity total_clicks total_views total_ratings total_duration_seconds",
    "top_items": "episodes popularity",
    "check_item_exists": "anime_id",
    "commands_to_events": "duration_seconds",
    "clean_catalog": "episodes ranked members",
    "load_catalog": "episodes ranked members",
    "upsert_catalog": "episodes popularity members",
}
for _name, _columns in _NULLABLE.items():
    _casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _columns.split())
    ORACLE[_name] = f"SELECT * REPLACE ({_casts}) FROM ({ORACLE[_name]})"

# Versions follow (occurred_at, event_id), and so does a replay without them.
ORACLE["rebuild_unversioned"] = ORACLE["rebuild_read_model"]
# Stored and merged step by step, the tables are the same.
ORACLE |= {name: ORACLE[same] for name, same in {
    "bucketed_item_stats": "item_stats", "bucketed_ledger": "ledger", "bucketed_dead_letters": "dead_letters",
    "ingest_to_log": "ingest_commands", "bucketed_catalog": "upsert_catalog",
    "catch_up_model": "rebuild_read_model", "stored_top_by_views": "top_by_views", "stored_top_by_rating": "top_by_rating",
}.items()}
