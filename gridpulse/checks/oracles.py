"""SQL for DuckDB over the same tables, one text per query."""

from gridpulse.checks.forest import sql_chance

# Spark rounds the decimal text of a double half up; so does this.
_ROUND = "CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {n}) AS DOUBLE)"


def _rounded(x: str, n: int) -> str:
    return _ROUND.format(x=x, n=n)


_MS = "CAST(epoch_us(ts) // 1000 AS BIGINT)"
_S = "CAST(epoch_us(ts) // 1000000 AS BIGINT)"
_K = "CAST(props->>'k' AS INTEGER)"
_TELEMETRY = f"""
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS game_id, strftime(ts, '%H') AS play_id,
           CAST(user_id AS VARCHAR) AS player_id, event_type AS position,
           value AS x_coord, CAST({_K} AS DOUBLE) AS y_coord,
           floor(value * 4) / 4 AS speed_mph, value AS acceleration_m_s2,
           {_K} AS heart_rate_bpm, {_MS} AS ms, {_S} AS s
    FROM events
"""
_VALID = "speed_mph >= 0 AND speed_mph <= 30 AND heart_rate_bpm IS NOT NULL"
_SILVER = f"SELECT * FROM ({_TELEMETRY}) WHERE {_VALID}"
_FIRST_COPY = f"""
    SELECT * FROM ({_TELEMETRY})
    QUALIFY row_number() OVER (PARTITION BY game_id, play_id, player_id, ms ORDER BY event_id) = 1
"""
_DISTANCE = "sqrt((l.{x} - r.{x}) * (l.{x} - r.{x}) + (l.{y} - r.{y}) * (l.{y} - r.{y}))"


def _fact(same_game: str) -> str:
    d = _DISTANCE.format(x="x_coord", y="y_coord")
    return f"""
    WITH e AS (SELECT *, s - s % 3600 AS hour_s FROM ({_TELEMETRY})),
    pairs AS (
        SELECT l.game_id, l.play_id, l.hour_s, l.player_id AS lid, r.player_id AS rid, {d} AS d
        FROM e l JOIN e r ON {same_game}
        WHERE l.position = 'click' AND r.position = 'view'
    ),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY game_id, play_id, hour_s, lid ORDER BY d, rid) AS n FROM pairs
    )
    SELECT game_id, play_id, hour_s AS "timestamp", d AS separation_yards,
           md5(game_id) AS game_sk, md5(concat_ws('||', game_id, play_id)) AS play_sk,
           md5(lid) AS offensive_player_sk, md5(rid) AS defensive_player_sk
    FROM ranked WHERE n = 1
    """


_LINES = "SELECT * FROM lineitem"

# Measurements by player and second: what a streaming silver keeps of them.
_BY_SECOND = """
    SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS game_id, strftime(ts, '%H') AS play_id, CAST(user_id AS VARCHAR) AS player_id,
           s, CAST((user_id * 31 + s) % 140 AS DOUBLE) / 4 AS speed_mph,
           CASE WHEN (user_id * 7 + s) % 11 > 0 THEN CAST((user_id * 5 + s) % 100 + 60 AS INTEGER) END AS heart_rate_bpm,
           CAST((user_id * 13 + s) % 50 AS DOUBLE) / 4 AS acceleration_m_s2
    FROM (SELECT *, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS s FROM events)
"""
_SILVER_BY_SECOND = f"SELECT * FROM ({_BY_SECOND}) WHERE speed_mph <= 30 AND heart_rate_bpm IS NOT NULL"


def _count(rule: str, action: str, holds: str, table: str) -> str:
    return f"""
        SELECT '{rule}' AS rule, '{action}' AS action, count(*) FILTER ({holds}) AS passed,
               count(*) - count(*) FILTER ({holds}) AS failed FROM {table}
    """

ORACLES: dict[str, str] = {
    "event_decode": f"""
        SELECT event_id AS "offset", 'props' AS topic, 0 AS "partition", {_MS} AS kafka_ms, {_K} AS k FROM events
    """,
    "rescued_fields": f"""
        SELECT event_id, event_type, CAST(NULL AS DOUBLE) AS typed_value,
               '{{"k":"' || {_K} || '","value":"' || event_type || '"}}' AS rescued
        FROM events
    """,
    "encode_roundtrip": f"""
        SELECT game_id, play_id, player_id, position, speed_mph, acceleration_m_s2, heart_rate_bpm, ms AS epoch_ms
        FROM ({_TELEMETRY})
    """,
    "file_stream_bronze": f"""
        SELECT game_id, play_id, player_id, speed_mph, heart_rate_bpm, ms AS epoch_ms,
               '{{"team":"T","stamina_pct":"50.0"}}' AS rescued, true AS has_source, true AS has_arrival
        FROM ({_TELEMETRY})
    """,
    "record_stream_bronze": f"""
        SELECT game_id, play_id, player_id, position, x_coord, y_coord, 'tracking' AS topic,
               ms AS epoch_ms, ms AS kafka_ms, true AS has_arrival
        FROM ({_TELEMETRY})
    """,
    "dimension_csv": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               c_mktsegment, c_acctbal
        FROM customer
    """,
    "event_time_second": f"SELECT event_id, {_S} AS epoch_s, {_MS} AS epoch_ms FROM events",
    "surrogate_keys": """
        SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS order_sk,
               md5(concat_ws('||', CAST(o_custkey AS VARCHAR), o_orderstatus)) AS pair_sk
        FROM orders
    """,
    "score_bands": """
        SELECT event_id, CASE WHEN value >= 65.0 THEN 'Alta Confianza'
                              WHEN value >= 40.0 THEN '50/50 Incertidumbre' ELSE 'Baja Confianza' END AS band
        FROM events
    """,
    "array_features": """
        SELECT vec_id, list_sum(CAST(embedding AS DOUBLE[])) / len(embedding) AS mean_vec,
               CAST(list_max(embedding) AS DOUBLE) AS max_vec, CAST(list_min(embedding) AS DOUBLE) AS min_vec
        FROM embeddings
    """,
    "quality_drop": "SELECT event_id, value FROM events WHERE value >= 0 AND value <= 30 AND props IS NOT NULL",
    "quality_metrics": """
        SELECT 'value_valid' AS rule, 'drop' AS action, count(*) FILTER (value >= 0 AND value <= 30) AS passed,
               count(*) - count(*) FILTER (value >= 0 AND value <= 30) AS failed FROM events
        UNION ALL
        SELECT 'props_present', 'drop', count(props), count(*) - count(props) FROM events
        UNION ALL
        SELECT 'value_high', 'count', count(*) FILTER (value BETWEEN 20 AND 120),
               count(*) - count(*) FILTER (value BETWEEN 20 AND 120) FROM events
    """,
    "quality_metrics_by_type": """
        SELECT event_type, 'value_valid' AS rule, 'drop' AS action,
               count(*) FILTER (value >= 0 AND value <= 30) AS passed,
               count(*) - count(*) FILTER (value >= 0 AND value <= 30) AS failed FROM events GROUP BY event_type
        UNION ALL
        SELECT event_type, 'props_present', 'drop', count(props), count(*) - count(props) FROM events GROUP BY event_type
        UNION ALL
        SELECT event_type, 'value_high', 'count', count(*) FILTER (value BETWEEN 20 AND 120),
               count(*) - count(*) FILTER (value BETWEEN 20 AND 120) FROM events GROUP BY event_type
    """,
    "dedup_batch": "SELECT DISTINCT user_id, event_type, ts FROM events",
    "dedup_keep_first": """
        SELECT user_id, event_type, event_id, value
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events)
        WHERE n = 1
    """,
    "first_in_group": """
        SELECT l_partkey, l_extendedprice, l_orderkey, l_linenumber, l_quantity
        FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
                     ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_quantity) AS n FROM lineitem)
        WHERE n = 1
    """,
    "dedup_stream": f"SELECT DISTINCT event_type, user_id, {_S} - {_S} % 86400 AS day_s FROM events",
    "silver_from_batch": f"""
        SELECT game_id, play_id, player_id, speed_mph, heart_rate_bpm, s AS epoch_s FROM ({_FIRST_COPY}) WHERE {_VALID}
    """,
    "silver_rule_metrics": f"""
        WITH t AS ({_FIRST_COPY})
        SELECT 'velocidad_valida' AS rule, 'drop' AS action,
               count(*) FILTER (speed_mph >= 0 AND speed_mph <= 30) AS passed,
               count(*) - count(*) FILTER (speed_mph >= 0 AND speed_mph <= 30) AS failed FROM t
        UNION ALL
        SELECT 'ritmo_cardiaco_valido', 'drop', count(heart_rate_bpm), count(*) - count(heart_rate_bpm) FROM t
    """,
    "silver_from_stream": f"""
        SELECT game_id, play_id, player_id, speed_mph, heart_rate_bpm, acceleration_m_s2, s AS epoch_s, true AS has_stamp
        FROM ({_SILVER_BY_SECOND})
    """,
    "silver_from_junk": f"""
        WITH timed AS (SELECT game_id, play_id, count(*) AS n FROM ({_SILVER_BY_SECOND}) GROUP BY ALL),
        every AS (
            SELECT strftime(ts, '%Y-%m-%d') AS game_id, strftime(ts, '%H') AS play_id, count(*) AS n
            FROM (SELECT *, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS s FROM events)
            WHERE (user_id * 31 + s) % 140 <= 120 AND (user_id * 7 + s) % 11 > 0 GROUP BY ALL
        )
        SELECT game_id, play_id, timed.n AS timed, every.n AS untimed FROM timed JOIN every USING (game_id, play_id)
    """,
    "player_features": f"""
        SELECT game_id, player_id, {_rounded("avg(speed_mph)", 2)} AS avg_speed_mph, max(speed_mph) AS max_speed_today,
               round(avg(heart_rate_bpm), 0) AS avg_heart_rate, max(heart_rate_bpm) AS peak_heart_rate,
               list(acceleration_m_s2 ORDER BY s, acceleration_m_s2) AS acceleration_history_array, 1 AS history_parts
        FROM ({_SILVER}) GROUP BY game_id, player_id
    """,
    "play_trajectory": f"""
        SELECT game_id, play_id, max(speed_mph) AS max_speed_in_play, count(DISTINCT player_id) AS players_tracked,
               1 AS history_parts,
               string_agg(player_id, ',' ORDER BY s, player_id, speed_mph, acceleration_m_s2) AS players_in_order,
               list(acceleration_m_s2 ORDER BY s, player_id, speed_mph, acceleration_m_s2) AS accelerations,
               list(speed_mph ORDER BY s, player_id, speed_mph, acceleration_m_s2) AS speeds,
               list(s ORDER BY s, player_id, speed_mph, acceleration_m_s2) AS times_s,
               count(*) AS samples
        FROM ({_SILVER}) GROUP BY game_id, play_id
    """,
    "medallion_run": f"""
        SELECT game_id, play_id, count(DISTINCT player_id) AS players_tracked, max(speed_mph) AS max_speed_in_play,
               count(*) AS samples, true AS has_stamp
        FROM ({_SILVER_BY_SECOND}) GROUP BY game_id, play_id
    """,
    "medallion_refreshed": f"""
        SELECT game_id, player_id, {_rounded("avg(speed_mph)", 2)} AS avg_speed_mph, max(speed_mph) AS max_speed_today,
               round(avg(heart_rate_bpm), 0) AS avg_heart_rate, max(heart_rate_bpm) AS peak_heart_rate,
               list(acceleration_m_s2 ORDER BY s, acceleration_m_s2) AS acceleration_history_array, 1 AS history_parts
        FROM ({_SILVER_BY_SECOND}) GROUP BY game_id, player_id
    """,
    "medallion_incremental_players": f"""
        SELECT game_id, player_id, {_rounded("avg(speed_mph)", 2)} AS avg_speed_mph, max(speed_mph) AS max_speed_today,
               round(avg(heart_rate_bpm), 0) AS avg_heart_rate, max(heart_rate_bpm) AS peak_heart_rate,
               list(acceleration_m_s2 ORDER BY s, acceleration_m_s2) AS acceleration_history_array, 1 AS history_parts
        FROM ({_SILVER_BY_SECOND}) GROUP BY game_id, player_id
    """,
    "medallion_incremental": f"""
        SELECT game_id, play_id, count(DISTINCT player_id) AS players_tracked, max(speed_mph) AS max_speed_in_play,
               1 AS history_parts, list(s ORDER BY s, player_id) AS times_s,
               string_agg(player_id, ',' ORDER BY s, player_id) AS players_in_order, true AS has_stamp
        FROM ({_SILVER_BY_SECOND}) GROUP BY game_id, play_id
    """,
    "late_rows": f"""
        WITH e AS (
            SELECT event_id, strftime(ts, '%Y-%m-%d') AS game_id, strftime(ts, '%H') AS play_id,
                   CAST(user_id AS VARCHAR) AS player_id, user_id, {_S} AS s, {_MS} AS ms
            FROM events
        ), arrived AS (
            SELECT *, ms < (SELECT CAST(min(ms) * 0.3::DOUBLE + max(ms) * 0.7::DOUBLE - 0.5 AS BIGINT) FROM e) AND event_id % 10 <> 0 AS first
            FROM e
        ), marked AS (
            SELECT *, NOT first AND s <= (SELECT max(s) - 60 FROM arrived WHERE first) AS is_late,
                   CAST((user_id * 31 + s) % 140 AS DOUBLE) / 4 AS speed_mph,
                   CASE WHEN (user_id * 7 + s) % 11 > 0 THEN CAST((user_id * 5 + s) % 100 + 60 AS INTEGER) END AS heart_rate_bpm
            FROM arrived
        )
        SELECT DISTINCT game_id, play_id, player_id, speed_mph, heart_rate_bpm, s AS epoch_s, is_late FROM marked
        WHERE NOT is_late AND speed_mph <= 30 AND heart_rate_bpm IS NOT NULL
        UNION ALL
        SELECT game_id, play_id, player_id, speed_mph, heart_rate_bpm, s, is_late FROM marked WHERE is_late
    """,
    "schema_evolution": f"""
        SELECT event_id, event_type, CASE WHEN event_id % 3 = 0 THEN floor(value) ELSE value END AS score,
               CASE WHEN event_id % 3 > 0 THEN CAST({_K} AS BIGINT) END AS k,
               CASE WHEN event_id % 3 = 2 THEN 'user ' || user_id END AS note, CAST(NULL AS VARCHAR) AS rescued, 3 AS versions
        FROM events
    """,
    "zone_map_lookup": """
        SELECT * FROM lineitem WHERE l_partkey BETWEEN 100 AND 400
        UNION ALL
        SELECT * FROM lineitem
        WHERE l_orderkey IN (1, (SELECT max(l_orderkey) FROM lineitem), (SELECT max(l_orderkey) // 2 FROM lineitem))
    """,
    "game_rule_metrics": f"""
        WITH t AS (
            SELECT o_orderkey % 13 > 0 AS has_id, o_orderstatus <> 'P' AS has_teams, o_orderkey % 200 - 40 AS temperature,
                   CASE WHEN o_orderkey % 5 > 0 THEN year(o_orderdate) ELSE year(o_orderdate) - 100 END AS season
            FROM orders
        )
        {_count("game_id_valido", "drop", "has_id", "t")} UNION ALL
        {_count("equipos_validos", "drop", "has_teams", "t")} UNION ALL
        {_count("temporada_coherente", "count", "season BETWEEN 2000 AND 2026", "t")} UNION ALL
        {_count("temperatura_logica", "count", "temperature BETWEEN -20 AND 120", "t")}
    """,
    "play_rule_metrics": f"""
        {_count("llaves_jugada_validas", "drop", "l_linenumber <> 7", "lineitem")} UNION ALL
        {_count("down_valido", "count", "l_linenumber BETWEEN 1 AND 4", "lineitem")} UNION ALL
        {_count("quarter_valido", "count", "l_linenumber + 1 BETWEEN 1 AND 5", "lineitem")} UNION ALL
        {_count("distancia_positiva", "count", "CAST(l_quantity AS INTEGER) - 10 >= 0", "lineitem")}
    """,
    "separation_one_game": f"""
        SELECT * FROM ({_fact("l.play_id = r.play_id AND l.hour_s = r.hour_s")})
        WHERE game_id = (SELECT min(strftime(ts, '%Y-%m-%d')) FROM events)
    """,
    "forest_scores": """
        SELECT vec_id, CASE WHEN list_max(embedding) >= 0.3125 THEN 100.0 ELSE 0.0 END::DOUBLE AS ml_win_probability_pct,
               CASE WHEN list_max(embedding) >= 0.3125 THEN 'Alta Confianza' ELSE 'Baja Confianza' END AS estrategia
        FROM embeddings
    """,
    "forest_table_scores": f"""
        WITH f AS (
            SELECT vec_id, CAST(list_max(embedding) AS DOUBLE) AS most, CAST(list_min(embedding) AS DOUBLE) AS least FROM embeddings
        ), scored AS (
            SELECT vec_id, {_rounded(f"({sql_chance(('most', 'least'))} * 100)", 2)} AS pct FROM f
        )
        SELECT vec_id, pct AS ml_win_probability_pct,
               CASE WHEN pct >= 65 THEN 'Alta Confianza' WHEN pct >= 40 THEN '50/50 Incertidumbre' ELSE 'Baja Confianza' END AS estrategia
        FROM scored
    """,
    "rule_history": f"""
        WITH e AS ({_TELEMETRY}), runs AS (SELECT 1 AS run UNION ALL SELECT 2),
        arrived AS (SELECT * FROM e, runs WHERE run = 2 OR event_id % 2 = 0),
        single AS (
            SELECT * FROM arrived
            QUALIFY row_number() OVER (PARTITION BY run, game_id, play_id, player_id, ms ORDER BY event_id) = 1
        ), totals AS (
            SELECT count(*) FILTER ({_VALID}) AS kept, count(*) - count(*) FILTER ({_VALID}) AS dropped FROM single WHERE run = 2
        )
        SELECT r.*, totals.* FROM (
            SELECT run, 'velocidad_valida' AS rule, 'drop' AS action, count(*) FILTER (speed_mph >= 0 AND speed_mph <= 30) AS passed,
                   count(*) - count(*) FILTER (speed_mph >= 0 AND speed_mph <= 30) AS failed FROM single GROUP BY run
            UNION ALL
            SELECT run, 'ritmo_cardiaco_valido', 'drop', count(heart_rate_bpm), count(*) - count(heart_rate_bpm) FROM single GROUP BY run
        ) AS r, totals
    """,
    "game_dimension": """
        SELECT md5(CAST(o_orderkey AS VARCHAR)) AS game_sk, CAST(o_orderkey AS VARCHAR) AS game_id,
               CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS week,
               o_orderstatus AS home_team, o_orderpriority AS away_team, 's' AS stadium, 't' AS turf_type,
               'w' AS weather_conditions, CAST(NULL AS INTEGER) AS temperature_f
        FROM orders WHERE o_orderstatus <> 'P'
    """,
    "play_dimension": """
        SELECT md5(concat_ws('||', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))) AS play_sk,
               CAST(l_linenumber AS VARCHAR) AS play_id, CAST(l_orderkey AS VARCHAR) AS game_id,
               l_linestatus AS quarter, l_linenumber AS down, CAST(l_quantity AS INTEGER) AS distance_to_first,
               l_returnflag AS expected_coverage, l_linestatus AS play_result
        FROM lineitem
    """,
    "player_dimension": """
        SELECT md5(CAST(c_custkey AS VARCHAR)) AS player_sk, c_name AS full_name, c_mktsegment AS team,
               'WR' AS position, c_nationkey AS height_in, CAST(NULL AS INTEGER) AS weight_lbs,
               'c' AS college, '2020' AS draft_year
        FROM customer WHERE c_mktsegment <> 'BUILDING'
    """,
    "dimension_rule_metrics": """
        SELECT 'player_id_valido' AS rule, 'drop' AS action, count(*) AS passed, 0 AS failed FROM part
        UNION ALL
        SELECT 'nombre_valido', 'drop', count(*) FILTER (p_size > 5), count(*) FILTER (p_size <= 5) FROM part
        UNION ALL
        SELECT 'peso_coherente', 'count', count(*) FILTER (p_size * 10 BETWEEN 140 AND 400),
               count(*) FILTER (NOT p_size * 10 BETWEEN 140 AND 400) FROM part
        UNION ALL
        SELECT 'estatura_coherente', 'count', count(*) FILTER (p_size + 50 BETWEEN 60 AND 90),
               count(*) FILTER (NOT p_size + 50 BETWEEN 60 AND 90) FROM part
    """,
    "nearest_pair": f"""
        WITH e AS (SELECT event_id, event_type, value, CAST({_K} AS DOUBLE) AS k, {_S} - {_S} % 3600 AS hour_s FROM events),
        ranked AS (
            SELECT l.hour_s, l.event_id, r.event_id AS nearest_event_id, {_DISTANCE.format(x="value", y="k")} AS separation,
                   row_number() OVER (PARTITION BY l.hour_s, l.event_id
                                      ORDER BY {_DISTANCE.format(x="value", y="k")}, r.event_id) AS n
            FROM e l JOIN e r ON l.hour_s = r.hour_s
            WHERE l.event_type = 'click' AND r.event_type = 'view'
        )
        SELECT hour_s, event_id, nearest_event_id, separation FROM ranked WHERE n = 1
    """,
    "separation_facts": _fact("l.play_id = r.play_id AND l.hour_s = r.hour_s"),
    "separation_facts_by_game": _fact("l.game_id = r.game_id AND l.play_id = r.play_id"),
    "matchup_report": f"""
        SELECT po.n_name AS receptor_ofensivo, po.n_regionkey AS equipo, pd.n_name AS esquinero_defensor,
               {_rounded("avg(l_quantity)", 2)} AS promedio_separacion_yardas,
               max(l_quantity) AS maxima_separacion_yardas, count(DISTINCT o_orderkey) AS total_jugadas_analizadas
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation po ON c_nationkey = po.n_nationkey JOIN nation pd ON s_nationkey = pd.n_nationkey
        WHERE o_orderpriority LIKE '3%'
        GROUP BY po.n_name, po.n_regionkey, pd.n_name
        HAVING count(DISTINCT o_orderkey) >= 3
        ORDER BY promedio_separacion_yardas DESC, receptor_ofensivo, equipo, esquinero_defensor
        LIMIT 10
    """,
    "play_statistics": f"""
        SELECT game_id, play_id, avg(speed_mph) AS mean_vel, max(speed_mph) AS max_vel, min(speed_mph) AS min_vel,
               avg(floor(acceleration_m_s2 * 4) / 4) AS mean_acc, max(floor(acceleration_m_s2 * 4) / 4) AS max_acc,
               min(floor(acceleration_m_s2 * 4) / 4) AS min_acc
        FROM ({_SILVER}) GROUP BY game_id, play_id
    """,
    "feature_table": f"""
        SELECT game_id, play_id, avg(speed_mph) AS mean_vel, max(speed_mph) AS max_vel, min(speed_mph) AS min_vel,
               avg(floor(acceleration_m_s2 * 4) / 4) AS mean_acc, max(floor(acceleration_m_s2 * 4) / 4) AS max_acc,
               min(floor(acceleration_m_s2 * 4) / 4) AS min_acc
        FROM ({_SILVER}) GROUP BY game_id, play_id
    """,
    "random_label_shares": """
        SELECT count(*) AS n_rows, count(*) AS n_labelled, true AS near_half, true AS same_again FROM events
    """,
    "single_row_balance": """
        WITH w AS (SELECT count(*) AS n, max(value) AS max_value FROM events)
        SELECT n, max_value, 0 AS label FROM w UNION ALL SELECT n, max_value, 1 FROM w
    """,
    "layout_partitioned": _LINES,
    "layout_rewrite": _LINES,
    "layout_zorder": _LINES,
    "table_stats": "SELECT count(*) AS n_rows, 'gold' AS quality, 'order lines' AS comment FROM lineitem",
    "table_optimized": """
        SELECT l_returnflag, count(*) AS n_rows, CAST(sum(l_orderkey) AS BIGINT) AS keys, true AS is_partitioned,
               true AS is_gold, 'order lines' AS comment
        FROM lineitem GROUP BY l_returnflag
    """,
}
