"""The quality rules of every layer. Names and bounds are fixed values."""

from gridpulse.operators.quality import Expectations, Rule

TELEMETRY_RULES = Expectations(
    (
        Rule("velocidad_valida", "speed_mph >= 0.0 AND speed_mph <= 30.0", drop=True),
        Rule("ritmo_cardiaco_valido", "heart_rate_bpm IS NOT NULL", drop=True),
    )
)

GAME_RULES = Expectations(
    (
        Rule("game_id_valido", "game_id IS NOT NULL AND game_id != ''", drop=True),
        Rule("equipos_validos", "home_team IS NOT NULL AND away_team IS NOT NULL", drop=True),
        Rule("temporada_coherente", "season >= 2000 AND season <= 2026"),
        Rule("temperatura_logica", "temperature_f BETWEEN -20 AND 120"),
    )
)

PLAY_RULES = Expectations(
    (
        Rule("llaves_jugada_validas", "play_id IS NOT NULL AND game_id IS NOT NULL", drop=True),
        Rule("down_valido", "down BETWEEN 1 AND 4"),
        # quarter stays text in the table, so the rule reads it as a number
        Rule("quarter_valido", "try_cast(quarter AS INT) BETWEEN 1 AND 5"),
        Rule("distancia_positiva", "distance_to_first >= 0"),
    )
)

PLAYER_RULES = Expectations(
    (
        Rule("player_id_valido", "player_sk IS NOT NULL AND player_sk != ''", drop=True),
        Rule("nombre_valido", "full_name IS NOT NULL", drop=True),
        Rule("peso_coherente", "weight_lbs BETWEEN 140 AND 400"),
        Rule("estatura_coherente", "height_in BETWEEN 60 AND 90"),
    )
)
