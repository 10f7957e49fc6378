"""DuckDB oracle SQL for every registered query.

The same semantics stated as plain SQL over the driver tables.  The adapter
sources (as CTEs) are shared with the code under test; bounds, labels and
word lists are stated here once more.  Orders that Spark applies with NULL
first are spelled ``NULLS FIRST`` since DuckDB sorts NULL last by default.
"""

from __future__ import annotations

from courtside.sources.adapter import oracle_with


def _nf(*cols: str) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in cols)


def _first(src: str, keys: list[str], order: list[str]) -> str:
    """SELECT the first row per keys by order; in each column values come before '' and NULL unless spelled."""
    ords = ", ".join(o if " " in o else f"{o} IS NULL, CAST({o} AS VARCHAR) = '', {o}" for o in order) or "1"
    return (f"SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {ords}) AS rn_ FROM {src}) WHERE rn_ = 1")


# -- play stream, participants, flags ------------------------------------------

STREAM = """SELECT game_id, eventnum, lower(trim(player1_name)) AS player1_name, lower(trim(player2_name)) AS player2_name,
       lower(trim(player3_name)) AS player3_name, lower(descripcion) AS descripcion
FROM (SELECT game_id, eventnum, player1_name, player2_name, player3_name, homedescription AS descripcion FROM plays
      UNION ALL
      SELECT game_id, eventnum, player1_name, player2_name, player3_name, visitordescription FROM plays)
WHERE descripcion IS NOT NULL"""

PARTS = """SELECT game_id, eventnum, descripcion, role, jugador FROM (
  SELECT game_id, eventnum, descripcion, 1 AS role, player1_name AS jugador FROM stream
  UNION ALL SELECT game_id, eventnum, descripcion, 2, player2_name FROM stream
  UNION ALL SELECT game_id, eventnum, descripcion, 3, player3_name FROM stream)
WHERE jugador IS NOT NULL
  AND (jugador <> '' OR contains(descripcion, 'jump ball') OR contains(descripcion, 'block')
       OR contains(descripcion, 'steal'))"""


def _flag(cond: str, general: bool = True) -> str:
    if general:
        cond = f"jugador <> '' AND ({cond})"
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


_TWO = "regexp_matches(descripcion, 'layup|dunk|shot|roll') AND NOT contains(descripcion, '3pt') AND NOT contains(descripcion, 'turnover')"
FLAG_SQL = [
    ("Tiros_Dobles_Exitosos", _flag(f"{_TWO} AND NOT contains(descripcion, 'miss')")),
    ("Tiros_Dobles_Fallidos", _flag(f"{_TWO} AND contains(descripcion, 'miss')")),
    ("Tiros_Triples_Exitosos", _flag("contains(descripcion, '3pt') AND NOT contains(descripcion, 'miss')")),
    ("Tiros_Triples_Fallidos", _flag("contains(descripcion, '3pt') AND contains(descripcion, 'miss')")),
    ("Tiros_Libres_Exitosos", _flag("contains(descripcion, 'free throw') AND NOT contains(descripcion, 'miss')")),
    ("Tiros_Libres_Fallidos", _flag("contains(descripcion, 'free throw') AND contains(descripcion, 'miss')")),
    ("Rebotes_Obtenidos", _flag("contains(descripcion, 'rebound')")),
    ("Rebotes_Defensivos_Obtenidos", _flag("contains(descripcion, 'rebound') AND contains(descripcion, 'defensive')")),
    ("Rebotes_Ofensivos_Obtenidos", _flag("contains(descripcion, 'rebound') AND contains(descripcion, 'offensive')")),
    ("Perdidas_Balon", _flag("contains(descripcion, 'turnover') AND NOT contains(descripcion, 'foul')")),
    ("Cambios_Jugadores", _flag("contains(descripcion, 'sub') AND contains(descripcion, 'for')")),
    ("Tiempos_Muertos", _flag("contains(descripcion, 'timeout')")),
    ("Faltas_Personales", _flag("contains(descripcion, 'p.foul') OR (contains(descripcion, 'foul') AND contains(descripcion, 'personal'))")),
    ("Faltas_Balon_Suelto", _flag("contains(descripcion, 'l.b.foul')")),
    ("Faltas_Disparo", _flag("contains(descripcion, 's.foul')")),
    ("Faltas_Rebote", _flag("contains(descripcion, 'foul turnover')")),
    ("Faltas_Ofensivas", _flag("contains(descripcion, 'offensive') AND contains(descripcion, 'foul')")),
    ("Cantidad_Ataques_Fallidos_General", _flag("contains(descripcion, 'miss')")),
    ("Numero_Jugadas_Totales", _flag("descripcion IS NOT NULL AND length(trim(descripcion)) > 0")),
    ("Saques_Exitosos", _flag("contains(descripcion, 'jump ball') AND role IN (1, 3)", False)),
    ("Saques_Fallidos", _flag("contains(descripcion, 'jump ball') AND role = 2", False)),
    ("Tiros_Bloqueados", _flag("contains(descripcion, 'block') AND role = 3", False)),
    ("Robos_Exitosos", _flag("contains(descripcion, 'steal') AND role = 2", False)),
]
STAT_NAMES = [n for n, _ in FLAG_SQL]

FLAGS = "SELECT game_id, eventnum, descripcion, role, jugador, " + ", ".join(
    f"{e} AS {n}" for n, e in FLAG_SQL) + " FROM parts"
STATS = "SELECT game_id, jugador, " + ", ".join(
    f"CAST(sum({n}) AS BIGINT) AS {n}" for n in STAT_NAMES) + " FROM flags GROUP BY game_id, jugador"
MEASURES = """SELECT *,
  Cantidad_Ataques_Fallidos_General + Saques_Fallidos AS Cantidad_Ataques_Fallidos,
  Tiros_Triples_Exitosos + Tiros_Dobles_Exitosos + Tiros_Libres_Exitosos + Saques_Exitosos AS Cantidad_Ataques_Exitosos,
  CASE WHEN Numero_Jugadas_Totales > 0
       THEN round((Tiros_Triples_Exitosos + Tiros_Dobles_Exitosos + Tiros_Libres_Exitosos + Saques_Exitosos)
                  / Numero_Jugadas_Totales, 3)
       ELSE 0.0 END AS Proporcion_Exito_Ataques,
  Tiros_Triples_Exitosos * 3 + Tiros_Dobles_Exitosos * 2 + Tiros_Libres_Exitosos AS Puntos_Totales
FROM stats"""

PLAY_CTES = [("stream", STREAM), ("parts", PARTS), ("flags", FLAGS), ("stats", STATS), ("measures", MEASURES)]


def _plays(upto: str, body: str, extra=()) -> str:
    ctes = []
    for n, t in PLAY_CTES:
        ctes.append((n, t))
        if n == upto:
            break
    return oracle_with(["plays"], body, ctes + list(extra))


# -- dimensions ------------------------------------------------------------------

REFEREE = [
    ("ref_one", _first("officials", ["official_id"], ["first_name", "last_name"])),
    ("referee", "SELECT row_number() OVER (ORDER BY official_id NULLS FIRST) AS idArbitro, "
                "concat_ws(' ', first_name, last_name) AS nombre FROM ref_one"),
]
LEAGUE = [
    ("league", "SELECT row_number() OVER (ORDER BY nombre NULLS FIRST) AS idLiga, nombre FROM ("
               "SELECT DISTINCT CASE WHEN season_type = 'All Star' THEN 'All-Star' ELSE season_type END AS nombre "
               "FROM games)"),
]
CALENDAR = [
    ("cal_days", "SELECT range AS i, CAST(DATE '1946-01-01' + CAST(range AS INTEGER) AS DATE) AS f "
                 "FROM range(0, DATE '2023-12-31' - DATE '1946-01-01' + 1)"),
    ("calendar", """SELECT i + 1 AS idFecha,
  concat_ws('-', CAST(CASE WHEN month(f) >= 10 THEN year(f) ELSE year(f) - 1 END AS VARCHAR),
                 CAST(CASE WHEN month(f) >= 10 THEN year(f) ELSE year(f) - 1 END + 1 AS VARCHAR)) AS temporada,
  CAST(day(f) AS INTEGER) AS dia, CAST(month(f) AS INTEGER) AS mes, CAST(year(f) AS INTEGER) AS ano
FROM cal_days"""),
]
_CAP = "TRY_CAST(capacidad_numero AS DOUBLE)"
VENUE = [
    ("venue_src", """SELECT d.arena, t.city AS ciudad, t.state AS estado, d.arenacapacity AS capacidad_numero, 0 AS src
FROM teams t RIGHT JOIN team_details d ON t.id = d.team_id
UNION ALL
SELECT Arena, Ciudad, Estado, Capacidad, 1 FROM team_list"""),
    ("venue_b", f"SELECT *, CASE WHEN {_CAP} < 10000 THEN 'pequeno' "
                f"WHEN {_CAP} >= 10000 AND {_CAP} < 20000 THEN 'mediano' ELSE 'grande' END AS capacidad FROM venue_src"),
    ("venue_one", _first("venue_b", ["arena", "ciudad", "estado"], ["src", "capacidad_numero", "capacidad"])),
    ("venue", f"""SELECT row_number() OVER (ORDER BY {_nf('arena', 'ciudad', 'estado')}) AS idUbicacion,
  coalesce(capacidad, 'Desconocido') AS capacidad, coalesce(arena, 'Desconocido') AS arena,
  coalesce(ciudad, 'Desconocido') AS ciudad, coalesce(estado, 'Desconocido') AS estado
FROM venue_one"""),
]
TEAM = [
    ("team_arena", _first("team_details", ["team_id"], ["arena"])),
    ("team_latest", "SELECT team_id, year FROM (SELECT team_id, TRY_CAST(year_active_till AS DOUBLE) AS year, "
                    "row_number() OVER (PARTITION BY team_id ORDER BY TRY_CAST(year_active_till AS DOUBLE) DESC NULLS LAST) AS rn_ "
                    "FROM team_history) WHERE rn_ = 1"),
    ("team_src", """SELECT concat_ws(' ', t.city, t.nickname) AS nombre, t.city AS ciudad, t.state AS estado, a.arena,
       CASE WHEN l.year = 2019 THEN 1 ELSE 0 END AS estado_actual, 0 AS src
FROM teams t LEFT JOIN team_arena a ON a.team_id = t.id LEFT JOIN team_latest l ON l.team_id = t.id
UNION ALL
SELECT Equipo, Ciudad, Estado, Arena, TRY_CAST(Activo AS INTEGER), 1 FROM team_list"""),
    ("team_one", _first("team_src", ["nombre", "ciudad"], ["src", "estado", "arena", "estado_actual"])),
    ("team", f"""SELECT row_number() OVER (ORDER BY {_nf('nombre', 'ciudad')}) AS idEquipo,
  CAST(estado_actual AS INTEGER) AS estado_actual, coalesce(nombre, 'Desconocido') AS nombre,
  coalesce(arena, 'Desconocido') AS arena, coalesce(ciudad, 'Desconocido') AS ciudad,
  coalesce(estado, 'Desconocido') AS estado
FROM team_one"""),
]
# Bucket bounds and position labels.
_PESO = """CASE WHEN peso_kg > 0 AND peso_kg <= 74.99 THEN 'Muy liviano' WHEN peso_kg >= 75 AND peso_kg <= 94.99 THEN 'Liviano'
  WHEN peso_kg >= 95 AND peso_kg <= 119.99 THEN 'Medio' WHEN peso_kg >= 120 AND peso_kg <= 139.99 THEN 'Pesado'
  WHEN peso_kg >= 140 THEN 'Muy Pesado' ELSE 'Desconocido' END"""
_ALTURA = """CASE WHEN altura_m > 0 AND altura_m <= 1.79 THEN 'Muy bajo' WHEN altura_m >= 1.80 AND altura_m <= 1.89 THEN 'Bajo'
  WHEN altura_m >= 1.90 AND altura_m <= 2.04 THEN 'Medio' WHEN altura_m >= 2.05 AND altura_m <= 2.14 THEN 'Alto'
  WHEN altura_m >= 2.15 THEN 'Muy alto' ELSE 'Desconocido' END"""
_ENVERGADURA = """CASE WHEN envergadura_m > 0 AND envergadura_m <= 1.89 THEN 'Muy corta'
  WHEN envergadura_m >= 1.90 AND envergadura_m <= 2.04 THEN 'Corta' WHEN envergadura_m >= 2.05 AND envergadura_m <= 2.19 THEN 'Media'
  WHEN envergadura_m >= 2.20 AND envergadura_m <= 2.34 THEN 'Larga' WHEN envergadura_m >= 2.35 THEN 'Muy larga'
  ELSE 'Desconocido' END"""
_ALCANCE = """CASE WHEN alcance_pie_m > 0 AND alcance_pie_m <= 2.34 THEN 'Muy bajo'
  WHEN alcance_pie_m >= 2.35 AND alcance_pie_m <= 2.54 THEN 'Bajo' WHEN alcance_pie_m >= 2.55 AND alcance_pie_m <= 2.84 THEN 'Medio'
  WHEN alcance_pie_m >= 2.85 AND alcance_pie_m <= 2.99 THEN 'Alto' WHEN alcance_pie_m >= 3.0 THEN 'Muy alto'
  ELSE 'Desconocido' END"""
_CARRERA = """CASE WHEN carrera_anos >= 0 AND carrera_anos <= 9 THEN 'Novato' WHEN carrera_anos >= 10 AND carrera_anos <= 19 THEN 'Consolidado'
  WHEN carrera_anos >= 20 AND carrera_anos <= 29 THEN 'Veterano' WHEN carrera_anos >= 30 THEN 'Longevo' ELSE 'Desconocido' END"""
_LABELS = """WHEN 'PG' THEN 'Base' WHEN 'SG' THEN 'Escolta' WHEN 'SF' THEN 'Alero' WHEN 'PF' THEN 'Ala-pívot' WHEN 'C' THEN 'Pívot'
  WHEN 'PG-SG' THEN 'Base/Escolta' WHEN 'SG-PG' THEN 'Escolta/Base' WHEN 'SG-SF' THEN 'Escolta/Alero' WHEN 'SF-SG' THEN 'Alero/Escolta'
  WHEN 'SF-PF' THEN 'Alero/Ala-pívot' WHEN 'PF-SF' THEN 'Ala-pívot/Alero' WHEN 'PF-C' THEN 'Ala-pívot/Pívot'
  WHEN 'C-PF' THEN 'Pívot/Ala-pívot' WHEN 'Guard' THEN 'Escolta' WHEN 'Forward' THEN 'Alero' WHEN 'Center' THEN 'Pívot'
  WHEN 'Guard-Forward' THEN 'Escolta/Alero' WHEN 'Forward-Guard' THEN 'Alero/Escolta'
  WHEN 'Center-Forward' THEN 'Pívot/Ala-pívot' WHEN 'Forward-Center' THEN 'Alero/Pívot' ELSE 'Desconocido' END"""
_POS = f"CASE coalesce(position_1, position_2) {_LABELS}"
PLAYER = [
    ("slots", """SELECT player1_id AS player_id, player1_name AS nombre,
       concat_ws(' ', player1_team_city, player1_team_nickname) AS equipo FROM plays
UNION ALL SELECT player2_id, player2_name, concat_ws(' ', player2_team_city, player2_team_nickname) FROM plays
UNION ALL SELECT player3_id, player3_name, concat_ws(' ', player3_team_city, player3_team_nickname) FROM plays"""),
    ("p_ids", _first("slots", ["player_id"], ["nombre", "equipo"])),
    ("p_info", _first("(SELECT id AS player_id, full_name AS nombre_1, is_active AS is_active_1 FROM player_info)",
                      ["player_id"], ["nombre_1", "is_active_1"])),
    ("p_gone", _first("(SELECT player_id, concat_ws(' ', first_name, last_name) AS nombre_3, 0 AS is_active_2 "
                      "FROM inactive_players)", ["player_id"], ["nombre_3", "is_active_2"])),
    ("p_prof", _first("(SELECT person_id AS player_id, display_first_last AS nombre_2, school AS escuela, "
                      "country AS pais, weight AS weight_1, position AS position_1, from_year, to_year "
                      "FROM player_profile)", ["player_id"],
                      ["nombre_2", "escuela", "pais", "weight_1", "position_1", "from_year", "to_year"])),
    ("p_comb", _first("(SELECT player_id, player_name AS nombre_4, position AS position_2, height_wo_shoes, "
                      "wingspan, weight AS weight_2, standing_reach FROM draft_combine)", ["player_id"],
                      ["nombre_4", "position_2", "height_wo_shoes", "wingspan", "weight_2", "standing_reach"])),
    ("p_join", """SELECT * FROM p_ids LEFT JOIN p_info USING (player_id) LEFT JOIN p_gone USING (player_id)
LEFT JOIN p_prof USING (player_id) LEFT JOIN p_comb USING (player_id)"""),
    ("p_num", f"""SELECT player_id, nombre, nombre_1, nombre_2, nombre_3, nombre_4, escuela, pais, equipo,
  is_active_1, is_active_2, {_POS} AS posicion,
  TRY_CAST(coalesce(weight_1, weight_2) AS DOUBLE) * 0.45359237 AS peso_kg,
  TRY_CAST(height_wo_shoes AS DOUBLE) * 0.0254 AS altura_m,
  TRY_CAST(wingspan AS DOUBLE) * 0.0254 AS envergadura_m,
  TRY_CAST(standing_reach AS DOUBLE) * 0.0254 AS alcance_pie_m,
  TRY_CAST(to_year AS DOUBLE) - TRY_CAST(from_year AS DOUBLE) AS carrera_anos
FROM p_join"""),
    ("player", f"""SELECT row_number() OVER (ORDER BY player_id NULLS FIRST) AS idJugador,
  {_ALTURA} AS altura,
  {_PESO} AS peso,
  coalesce(nombre, nombre_1, nombre_2, nombre_3, nombre_4, 'Desconocido') AS nombre,
  {_ENVERGADURA} AS envergadura,
  {_ALCANCE} AS alcance_pie,
  posicion, coalesce(escuela, 'Desconocido') AS escuela, coalesce(pais, 'Desconocido') AS pais,
  coalesce(equipo, 'Desconocido') AS equipo,
  CAST(coalesce(TRY_CAST(is_active_1 AS INTEGER), is_active_2) AS INTEGER) AS estado_actual,
  {_CARRERA} AS carrera_profesional
FROM p_num"""),
]

# -- fact --------------------------------------------------------------------------

_TS = "try_strptime(g.game_date, '%Y-%m-%d %H:%M:%S')"
HEADER = [
    ("g_one", _first("(SELECT game_id, team_name_home, team_name_away, game_date, season_type FROM games)",
                     ["game_id"], ["team_name_home", "team_name_away", "game_date", "season_type"])),
    ("h_ref", f"""SELECT g.game_id, r.idArbitro, l.idLiga, c.idFecha
FROM g_one g
LEFT JOIN (SELECT game_id, concat_ws(' ', first_name, last_name) AS nombre_arbitro FROM officials) o ON o.game_id = g.game_id
LEFT JOIN referee r ON r.nombre = o.nombre_arbitro
LEFT JOIN league l ON l.nombre = CASE WHEN g.season_type = 'All Star' THEN 'All-Star' ELSE g.season_type END
LEFT JOIN calendar c ON c.dia = day({_TS}) AND c.mes = month({_TS}) AND c.ano = year({_TS})"""),
    ("h_team", """SELECT g.game_id, hl.idEquipo AS idEquipo_Local, av.idEquipo AS idEquipo_Visitante, v.idUbicacion
FROM g_one g
LEFT JOIN team av ON av.nombre = g.team_name_away
LEFT JOIN team hl ON hl.nombre = g.team_name_home
LEFT JOIN venue v ON lower(trim(v.arena)) = lower(trim(hl.arena)) AND lower(trim(v.ciudad)) = lower(trim(hl.ciudad))
                 AND lower(trim(v.estado)) = lower(trim(hl.estado))"""),
    ("header", """SELECT h.game_id, h.idArbitro, t.idEquipo_Local, t.idEquipo_Visitante, h.idLiga, h.idFecha, t.idUbicacion
FROM h_ref h LEFT JOIN h_team t ON t.game_id = h.game_id"""),
    ("game_keys", _first("header", ["game_id"], [f"{k} NULLS LAST" for k in
                                                 ("idArbitro", "idEquipo_Local", "idEquipo_Visitante", "idLiga",
                                                  "idFecha", "idUbicacion")])),
]
FACT_KEYS = ["idPartido", "idEquipo_Local", "idEquipo_Visitante", "idArbitro", "idLiga", "idFecha", "idUbicacion",
             "idJugador"]
FACT_MEASURES = ["Puntos_Totales", "Saques_Exitosos", "Saques_Fallidos", "Tiros_Dobles_Exitosos",
                 "Tiros_Dobles_Fallidos", "Tiros_Triples_Exitosos", "Tiros_Triples_Fallidos", "Tiros_Libres_Exitosos",
                 "Tiros_Libres_Fallidos", "Robos_Exitosos", "Rebotes_Defensivos_Obtenidos",
                 "Rebotes_Ofensivos_Obtenidos", "Rebotes_Obtenidos", "Tiros_Bloqueados", "Perdidas_Balon",
                 "Cambios_Jugadores", "Tiempos_Muertos", "Faltas_Personales", "Faltas_Balon_Suelto", "Faltas_Disparo",
                 "Faltas_Rebote", "Faltas_Ofensivas", "Numero_Jugadas_Totales", "Cantidad_Ataques_Exitosos",
                 "Cantidad_Ataques_Fallidos"]
FACT = [
    ("m_id", """SELECT m.*, p.idJugador FROM measures m
JOIN (SELECT idJugador, lower(trim(nombre)) AS nombre_n FROM player) p ON p.nombre_n = m.jugador"""),
    ("pre", "SELECT * FROM m_id JOIN game_keys USING (game_id)"),
    ("game_ids", "SELECT game_id, row_number() OVER (ORDER BY game_id) AS idPartido FROM (SELECT DISTINCT game_id FROM pre)"),
]
FACT_SELECT = ("SELECT " + ", ".join(f"CAST({k} AS BIGINT) AS {k}" for k in FACT_KEYS) + ", "
               + ", ".join(f"CAST(coalesce({m}, 0) AS INTEGER) AS {m}" for m in FACT_MEASURES)
               + ", CAST(Proporcion_Exito_Ataques AS DOUBLE) AS Proporcion_Exito_Ataques "
               + "FROM pre JOIN game_ids USING (game_id)")

DIM_CTES = REFEREE + LEAGUE + CALENDAR + VENUE + TEAM + PLAYER
DIM_SOURCES = ["plays", "officials", "games", "teams", "team_details", "team_history", "team_list", "player_info",
               "player_profile", "inactive_players", "draft_combine"]


def _dims(body: str, ctes=(), sources=()) -> str:
    return oracle_with(DIM_SOURCES + list(sources), body, DIM_CTES + list(ctes))


def fact_sql() -> str:
    return _dims(FACT_SELECT, PLAY_CTES + HEADER + FACT)


ORACLE: dict[str, str] = {
    "play_stream": _plays("stream", "SELECT * FROM stream"),
    "participants": _plays("parts", "SELECT * FROM parts"),
    "play_flags": _plays("flags", "SELECT * FROM flags"),
    "player_game_stats": _plays("stats", "SELECT * FROM stats"),
    "derived_metrics": _plays("measures", "SELECT * FROM measures"),
    "referee_dim": _dims("SELECT * FROM referee"),
    "league_dim": _dims("SELECT * FROM league"),
    "calendar_dim": _dims("SELECT * FROM calendar"),
    "venue_dim": _dims("SELECT * FROM venue"),
    "team_dim": _dims("SELECT * FROM team"),
    "player_dim": _dims("SELECT * FROM player"),
    "game_header": _dims("SELECT * FROM header", HEADER),
    "fact_partido": fact_sql(),
}


# -- sources / sinks -------------------------------------------------------------

ORACLE["csv_roundtrip"] = ("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
ORACLE["table_roundtrip"] = _dims("SELECT 'arbitro' AS tabla, idArbitro AS id, nombre FROM referee "
                                  "UNION ALL SELECT 'liga', idLiga, nombre FROM league")

# -- dimension pieces ---------------------------------------------------------------

UNITS = [
    ("u_prof", _first("(SELECT person_id AS player_id, weight AS weight_1, from_year, to_year FROM player_profile)",
                      ["player_id"], ["weight_1", "from_year", "to_year"])),
    ("u_comb", _first("(SELECT player_id, height_wo_shoes, wingspan, weight AS weight_2, standing_reach "
                      "FROM draft_combine)", ["player_id"],
                      ["height_wo_shoes", "wingspan", "weight_2", "standing_reach"])),
    ("units", """SELECT coalesce(p.player_id, c.player_id) AS player_id,
  TRY_CAST(coalesce(weight_1, weight_2) AS DOUBLE) * 0.45359237 AS peso_kg,
  TRY_CAST(height_wo_shoes AS DOUBLE) * 0.0254 AS altura_m,
  TRY_CAST(wingspan AS DOUBLE) * 0.0254 AS envergadura_m,
  TRY_CAST(standing_reach AS DOUBLE) * 0.0254 AS alcance_pie_m,
  TRY_CAST(to_year AS DOUBLE) - TRY_CAST(from_year AS DOUBLE) AS carrera_anos
FROM u_prof p FULL OUTER JOIN u_comb c ON p.player_id = c.player_id"""),
]
_UNIT_SRC = ["player_profile", "draft_combine"]
ORACLE["unit_convert"] = oracle_with(_UNIT_SRC, "SELECT * FROM units", UNITS)
for _name, _case, _out in [("bucket_weight", _PESO, "peso"), ("bucket_height", _ALTURA, "altura"),
                           ("bucket_wingspan", _ENVERGADURA, "envergadura"), ("bucket_reach", _ALCANCE, "alcance_pie"),
                           ("bucket_career", _CARRERA, "carrera_profesional")]:
    ORACLE[_name] = oracle_with(_UNIT_SRC, f"SELECT player_id, {_case} AS {_out} FROM units", UNITS)
ORACLE["position_map"] = oracle_with(["player_profile"], f"SELECT person_id AS player_id, position, CASE position {_LABELS} AS posicion "
                                     "FROM player_profile")
_CAPB = ("CASE WHEN TRY_CAST(c AS DOUBLE) < 10000 THEN 'pequeno' WHEN TRY_CAST(c AS DOUBLE) >= 10000 "
         "AND TRY_CAST(c AS DOUBLE) < 20000 THEN 'mediano' ELSE 'grande' END")
ORACLE["capacity_bucket"] = oracle_with(
    ["team_details", "team_list"],
    "SELECT arena, c AS capacidad_numero, " + _CAPB + " AS capacidad FROM ("
    "SELECT arena, arenacapacity AS c FROM team_details UNION ALL SELECT Arena, Capacidad FROM team_list)")

# -- fact pieces ----------------------------------------------------------------------

ROSTER = [
    ("roster_rows", " UNION ALL ".join(
        f"SELECT game_id, lower(trim(player{i}_name)) AS jugador, "
        f"concat_ws(' ', player{i}_team_city, player{i}_team_nickname) AS nombre_equipo FROM plays" for i in (1, 2, 3))),
    ("roster_one", _first("roster_rows", ["game_id", "jugador"], ["nombre_equipo"])),
]
ORACLE["roster"] = oracle_with(["plays"], "SELECT game_id, jugador, nombre_equipo FROM roster_one", ROSTER)
ORACLE["roster_measures"] = _plays("measures", "SELECT m.*, r.nombre_equipo FROM measures m JOIN roster_one r "
                                   "ON m.game_id = r.game_id AND m.jugador = r.jugador", ROSTER)
_TSG = "try_strptime(g.game_date, '%Y-%m-%d %H:%M:%S')"
ORACLE["date_key"] = _dims(f"""SELECT g.game_id, c.idFecha FROM games g
LEFT JOIN calendar c ON c.dia = day({_TSG}) AND c.mes = month({_TSG}) AND c.ano = year({_TSG})""")
ORACLE["venue_key"] = _dims("""SELECT g.game_id, hl.idEquipo AS idEquipo_Local, av.idEquipo AS idEquipo_Visitante, v.idUbicacion
FROM games g
LEFT JOIN team av ON av.nombre = g.team_name_away
LEFT JOIN team hl ON hl.nombre = g.team_name_home
LEFT JOIN venue v ON lower(trim(v.arena)) = lower(trim(hl.arena)) AND lower(trim(v.ciudad)) = lower(trim(hl.ciudad))
                 AND lower(trim(v.estado)) = lower(trim(hl.estado))""")
ORACLE["season_alias_join"] = _dims("""SELECT g.game_id, g.season_type, l1.idLiga AS idLiga_origen, l2.idLiga
FROM games g LEFT JOIN league l1 ON l1.nombre = g.season_type
LEFT JOIN league l2 ON l2.nombre = CASE WHEN g.season_type = 'All Star' THEN 'All-Star' ELSE g.season_type END""")
ORACLE["jump_balls"] = _plays("parts", """SELECT game_id, jugador,
  count(*) FILTER (WHERE role IN (1, 3)) AS Saques_Exitosos,
  count(*) FILTER (WHERE role IN (1, 3)) AS cantidad_ataques_exitosos,
  count(*) FILTER (WHERE role = 2) AS Saques_Fallidos,
  count(*) FILTER (WHERE role = 2) AS cantidad_ataques_fallidos
FROM parts WHERE contains(descripcion, 'jump ball') GROUP BY game_id, jugador""")
ORACLE["blocks"] = _plays("parts", "SELECT game_id, jugador, count(*) AS Tiros_Bloqueados FROM parts "
                                   "WHERE contains(descripcion, 'block') AND role = 3 GROUP BY game_id, jugador")
ORACLE["steals"] = _plays("parts", "SELECT game_id, jugador, count(*) AS Robos_Exitosos FROM parts "
                                   "WHERE contains(descripcion, 'steal') AND role = 2 GROUP BY game_id, jugador")
ORACLE["stats_outer_merge"] = _dims("SELECT * EXCLUDE (jugador) FROM m_id", PLAY_CTES + [FACT[0]])

# -- vocabularies ------------------------------------------------------------------------

ORACLE["name_vocabulary"] = oracle_with(["games"], "SELECT DISTINCT nombre FROM (SELECT team_name_home AS nombre "
                                                   "FROM games UNION ALL SELECT team_name_away FROM games)")
ORACLE["position_vocabulary"] = oracle_with(
    ["draft_combine", "player_profile"],
    "SELECT position FROM (SELECT DISTINCT position FROM draft_combine) "
    "UNION ALL SELECT position FROM (SELECT DISTINCT position FROM player_profile)")
_SLOT_NAMES = " UNION ALL ".join(
    f"SELECT player{i}_name AS nombre, player{i}_team_nickname AS equipo FROM plays" for i in (1, 2, 3))
ORACLE["entity_dictionary"] = oracle_with(["plays"], """SELECT DISTINCT tipo, valor FROM (
  SELECT 'jugador' AS tipo, nombre AS valor FROM slot_names UNION ALL SELECT 'equipo', equipo FROM slot_names)
WHERE valor IS NOT NULL""", [("slot_names", _SLOT_NAMES)])


def _rx(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# Words dropped from play texts.
_ALIASES = ["N'Dong", "Yuezhuo", "zhi", "Tompkins", "McClellan", "Renfroe", "Kanter", "Lima", "Seung", "Jin",
            "Pendergraph", "McKinney", "Yue", "Arna", "Hersek", "McLean", "N'Diaye", "Maciulis", "McRay",
            "Yurtseven", "Llull"]
_STYLE = ["Running", "Driving", "Pullup", "Step Back", "Fadeaway", "Floating", "Putback", "Reverse", "Cutting",
          "Follow Up", "Bank", "Alley Oop", "Turnaround", "Hook", "Tip", "Jumper"]


def _clean_sql(x: str) -> str:
    steps = [(r'[",]+', ""), (r"\s*[-–—]+\s*", " "), (r"^\W+|\W+$", ""), (r"\b\d+' ?", ""),
             (r"\s*[\.,:;]+\s*", " "), (r"\s+", " ")]
    for pat, rep in steps:
        x = f"regexp_replace({x}, {_rx(pat)}, '{rep}', 'g')"
    x = f"trim({x})"
    for w in _ALIASES + _STYLE:
        x = f"regexp_replace({x}, {_rx(chr(92) + 'b' + w + chr(92) + 'b')}, '', 'g')"
    return f"trim(regexp_replace({x}, ' +', ' ', 'g'))"


_ESC = r"regexp_replace(entry, '([\\.^$|?*+()\[\]{}])', '\\\1', 'g')"
ORACLE["play_types"] = oracle_with(["plays"], """SELECT row_number() OVER (ORDER BY descripcion_limpia NULLS FIRST) AS idJugada,
  descripcion_limpia, descripcion
FROM (SELECT descripcion_limpia, min(descripcion) AS descripcion FROM pt_clean GROUP BY descripcion_limpia)""", [
    ("slot_names", _SLOT_NAMES),
    ("pt_frags", "SELECT DISTINCT entry FROM (SELECT unnest(string_split_regex(trim(nombre), '\\s+')) AS entry "
                 "FROM slot_names WHERE nombre IS NOT NULL) WHERE entry <> ''"),
    ("pt_nicks", "SELECT DISTINCT equipo AS entry FROM slot_names WHERE equipo IS NOT NULL"),
    ("pt_dict", "SELECT entry FROM pt_frags UNION SELECT entry FROM pt_nicks UNION SELECT upper(entry) FROM pt_nicks"),
    ("pt_pattern", "SELECT '\\b(?:' || string_agg(" + _ESC + ", '|' ORDER BY length(entry) DESC, entry) || ')\\b|"
                   "\\([^)]*\\)|\\b\\d{1,3}''|\\b[A-Z]\\.|\\b[A-Za-z]{2,5}\\.|\\b\\d+ of \\d+\\b' AS p FROM pt_dict"),
    ("pt_descs", "SELECT DISTINCT descripcion FROM (SELECT homedescription AS descripcion FROM plays "
                 "WHERE player1_name IS NOT NULL UNION ALL SELECT visitordescription FROM plays "
                 "WHERE player1_name IS NOT NULL) WHERE descripcion IS NOT NULL"),
    ("pt_named", "SELECT DISTINCT descripcion FROM (SELECT descripcion, unnest(regexp_extract_all(lower(descripcion), "
                 "'\\w+')) AS tok FROM pt_descs) WHERE tok IN (SELECT lower(entry) FROM pt_frags)"),
    ("pt_clean", "SELECT descripcion, " + _clean_sql("regexp_replace(descripcion, (SELECT p FROM pt_pattern), '', 'g')")
                 + " AS descripcion_limpia FROM pt_named"),
])

# -- data quality --------------------------------------------------------------------------

ORACLE["dq_pk"] = ("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
                   "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
ORACLE["dq_fk"] = oracle_with(["plays", "player_info"], """SELECT game_id, eventnum, player1_id FROM plays p
WHERE player1_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM player_info i WHERE i.id = p.player1_id)""")
ORACLE["dq_not_null"] = oracle_with(["plays"], "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS nulls_{c}"
    for c in ("player1_name", "player2_name", "player3_name", "homedescription", "visitordescription"))
    + " FROM plays")
ORACLE["dq_length"] = oracle_with(["plays"], " UNION ALL ".join(
    f"SELECT '{c}' AS columna, {n} AS limite, count(*) FILTER (WHERE length({c}) > {n}) AS excedidos FROM plays"
    for c, n in (("homedescription", 45), ("visitordescription", 45), ("player1_team_city", 20),
                 ("player1_name", 20))))
ORACLE["preview"] = _dims("SELECT * FROM referee ORDER BY idArbitro LIMIT 20")


# -- design-note extensions ----------------------------------------------------------------

def _points(d: str) -> str:
    two = (f"regexp_matches({d}, 'layup|dunk|shot|roll') AND NOT contains({d}, '3pt') "
           f"AND NOT contains({d}, 'turnover') AND NOT contains({d}, 'miss')")
    return (f"CASE WHEN contains({d}, '3pt') AND NOT contains({d}, 'miss') THEN 3 WHEN {two} THEN 2 "
            f"WHEN contains({d}, 'free throw') AND NOT contains({d}, 'miss') THEN 1 ELSE 0 END")


ORACLE["running_score"] = oracle_with(["plays"], """SELECT game_id, eventnum, puntos_local, puntos_visitante,
  marcador_local, marcador_visitante, marcador_local - marcador_visitante AS diferencia
FROM (SELECT game_id, eventnum, local AS puntos_local, visitante AS puntos_visitante,
        CAST(sum(local) OVER (PARTITION BY game_id ORDER BY eventnum ROWS UNBOUNDED PRECEDING) AS BIGINT) AS marcador_local,
        CAST(sum(visitante) OVER (PARTITION BY game_id ORDER BY eventnum ROWS UNBOUNDED PRECEDING) AS BIGINT)
          AS marcador_visitante
      FROM rs_pts)""", [
    ("rs_pts", f"""SELECT game_id, eventnum, CAST(sum({_points('lower(homedescription)')}) AS BIGINT) AS local,
  CAST(sum({_points('lower(visitordescription)')}) AS BIGINT) AS visitante FROM plays GROUP BY game_id, eventnum"""),
])
ORACLE["rebound_split"] = _plays("stream", """SELECT game_id, player1_name AS jugador, count(*) AS rebotes,
  coalesce(max(TRY_CAST(regexp_extract(descripcion, 'off:(\\d+)', 1) AS INTEGER)), 0) AS rebotes_ofensivos,
  coalesce(max(TRY_CAST(regexp_extract(descripcion, 'def:(\\d+)', 1) AS INTEGER)), 0) AS rebotes_defensivos
FROM stream WHERE contains(descripcion, 'rebound') AND player1_name <> '' GROUP BY game_id, player1_name""")
ORACLE["team_game"] = oracle_with(["plays"], f"""SELECT game_id, equipo, count(*) AS jugadas,
  CAST(sum({_points('d')}) AS BIGINT) AS puntos,
  CAST(sum(CASE WHEN contains(d, 'miss') THEN 1 ELSE 0 END) AS BIGINT) AS tiros_fallidos
FROM (SELECT game_id, equipo, lower(d) AS d FROM (
        SELECT game_id, equipo, homedescription AS d FROM tg_first
        UNION ALL SELECT game_id, equipo, visitordescription FROM tg_first)
      WHERE d IS NOT NULL)
GROUP BY game_id, equipo""", [
    ("tg_first", "SELECT game_id, concat_ws(' ', player1_team_city, player1_team_nickname) AS equipo, homedescription, "
                 "visitordescription FROM plays WHERE lower(trim(player1_name)) <> ''"),
])
ORACLE["extra_fouls"] = _plays("parts", """SELECT game_id, jugador,
  CAST(sum(CASE WHEN contains(descripcion, 't.foul') OR contains(descripcion, 'technical') THEN 1 ELSE 0 END) AS BIGINT)
    AS Faltas_Tecnicas,
  CAST(sum(CASE WHEN contains(descripcion, 'flagrant') THEN 1 ELSE 0 END) AS BIGINT) AS Faltas_Flagrantes,
  CAST(sum(CASE WHEN contains(descripcion, 'off.foul') THEN 1 ELSE 0 END) AS BIGINT) AS Faltas_Ofensivas_Off,
  CAST(sum(CASE WHEN descripcion LIKE '%miss%steal%' THEN 1 ELSE 0 END)
    AS BIGINT) AS Robos_Fallidos
FROM parts WHERE jugador <> '' GROUP BY game_id, jugador""")
ORACLE["play_type_counts"] = _plays("stream", """SELECT CASE
  WHEN contains(descripcion, 'jump ball') THEN 'salto' WHEN contains(descripcion, 'free throw') THEN 'tiro_libre'
  WHEN contains(descripcion, '3pt') OR contains(descripcion, 'shot') OR contains(descripcion, 'layup')
       OR contains(descripcion, 'dunk') THEN 'tiro'
  WHEN contains(descripcion, 'rebound') THEN 'rebote' WHEN contains(descripcion, 'steal') THEN 'robo'
  WHEN contains(descripcion, 'block') THEN 'bloqueo' WHEN contains(descripcion, 'turnover') THEN 'perdida'
  WHEN contains(descripcion, 'foul') THEN 'falta' WHEN contains(descripcion, 'sub:') THEN 'cambio'
  WHEN contains(descripcion, 'timeout') THEN 'tiempo_muerto' ELSE 'otra' END AS tipo, count(*) AS jugadas
FROM stream GROUP BY 1""")


# -- options --------------------------------------------------------------------------

_ROLE = {n for n, _ in FLAG_SQL[-4:]}
ORACLE["player_game_stats_primary"] = _plays("flags", "SELECT game_id, jugador, " + ", ".join(
    f"CAST(sum({n if n in _ROLE else f'CASE WHEN role = 1 THEN {n} ELSE 0 END'}) AS BIGINT) AS {n}" for n in STAT_NAMES)
    + " FROM flags GROUP BY game_id, jugador")
_WHOLE = "'(^|[^a-z0-9_])(layup|dunk|shot|roll)([^a-z0-9_]|$)'"
ORACLE["play_flags_whole_words"] = _plays("parts", FLAGS.replace("'layup|dunk|shot|roll'", _WHOLE))
ORACLE["bucket_height_half_open"] = oracle_with(_UNIT_SRC, """SELECT player_id, CASE WHEN altura_m > 0 AND altura_m < 1.80 THEN 'Muy bajo'
  WHEN altura_m >= 1.80 AND altura_m < 1.90 THEN 'Bajo' WHEN altura_m >= 1.90 AND altura_m < 2.05 THEN 'Medio'
  WHEN altura_m >= 2.05 AND altura_m < 2.15 THEN 'Alto' WHEN altura_m >= 2.15 THEN 'Muy alto' ELSE 'Desconocido' END AS altura
FROM units""", UNITS)
ORACLE["ambiguous_names"] = _dims("""SELECT 'jugador' AS tabla, lower(trim(nombre)) AS nombre, count(*) AS n FROM player
GROUP BY lower(trim(nombre)) HAVING count(*) > 1
UNION ALL SELECT 'equipo', lower(trim(nombre)), count(*) FROM team GROUP BY lower(trim(nombre)) HAVING count(*) > 1""")
ORACLE["fact_by_referee"] = _dims(
    FACT_SELECT.replace("FROM pre JOIN", "FROM pre_all JOIN"),
    PLAY_CTES + HEADER + FACT + [("pre_all", "SELECT * FROM m_id JOIN (SELECT DISTINCT * FROM header) USING (game_id)")])


# -- loads: CSV without loss, keys that last, checks of the contract tables ----------

ORACLE["csv_lossless"] = """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' || text || ' '
  WHEN 3 THEN '"' || text || '",' ELSE text END AS text, lang FROM documents"""
ORACLE["csv_quarantine"] = """SELECT 'ok' AS estado, CAST(c_custkey AS VARCHAR) AS c_custkey,
  CASE WHEN c_custkey % 8 = 5 THEN c_name || ', "Jr"' ELSE c_name END AS c_name, CASE WHEN c_custkey % 8 <> 5 THEN c_mktsegment END AS c_mktsegment,
  CAST(NULL AS VARCHAR) AS text FROM customer WHERE c_custkey % 8 IN (0, 5, 6, 7)
UNION ALL SELECT CASE WHEN c_custkey % 8 IN (1, 2) THEN 'fields' ELSE 'quotes' END, NULL, NULL, NULL, CASE c_custkey % 8
  WHEN 1 THEN c_custkey || ',' || c_name WHEN 2 THEN c_custkey || ',' || c_name || ',' || c_mktsegment || ',more'
  WHEN 3 THEN c_custkey || ',"' || c_name || ',' || c_mktsegment ELSE c_custkey || ',"' || c_name || '"x,' || c_mktsegment END
FROM customer WHERE c_custkey % 8 IN (1, 2, 3, 4)"""


def _two_loads(table: str, key: str, source: str, name: str, early: str) -> list[tuple[str, str]]:
    """CTE ``<table>_ids``: ids of the keys of the early rows in their order, then of the others from the largest on."""
    return [(f"{table}_ids", f"""SELECT {key}, {name} AS nombre, early, CASE WHEN early THEN row_number() OVER (PARTITION BY early ORDER BY {key} NULLS FIRST)
  ELSE row_number() OVER (PARTITION BY early ORDER BY {key} NULLS FIRST) + (SELECT count(*) FROM {source} WHERE {early}) END AS id
FROM (SELECT *, {early} AS early FROM {source}) x""")]


ORACLE["stable_keys"] = oracle_with(["games", "officials"], """
SELECT 'preparada' AS momento, 'arbitro' AS tabla, id, nombre FROM arbitro_ids WHERE early
UNION ALL SELECT 'preparada', 'liga', id, nombre FROM liga_ids WHERE early
UNION ALL SELECT 'confirmada', 'arbitro', id, nombre FROM arbitro_ids
UNION ALL SELECT 'confirmada', 'liga', id, nombre FROM liga_ids""", [
    REFEREE[0],
    ("early_games", "SELECT game_id FROM games WHERE game_date < '1996'"),
    ("early_refs", "SELECT DISTINCT official_id FROM officials WHERE game_id IN (SELECT game_id FROM early_games)"),
    ("leagues", "SELECT nombre, bool_or(game_date < '1996') AS is_early FROM (SELECT game_date, CASE WHEN season_type = 'All Star' "
                "THEN 'All-Star' ELSE season_type END AS nombre FROM games) x GROUP BY nombre"),
    *_two_loads("arbitro", "official_id", "ref_one", "concat_ws(' ', first_name, last_name)",
                "official_id IN (SELECT official_id FROM early_refs)"),
    *_two_loads("liga", "nombre", "leagues", "nombre", "coalesce(is_early, false)"),
])
ORACLE["rebound_events"] = _plays("stream", """SELECT game_id, jugador, eventnum, ofensivos, defensivos,
  CASE WHEN up_o AND NOT up_d THEN 'ofensivo' WHEN up_d AND NOT up_o THEN 'defensivo' ELSE 'sin_clase' END AS tipo
FROM (SELECT *, coalesce(ofensivos - coalesce(lag(ofensivos) OVER w, 0) = 1, false) AS up_o,
        coalesce(defensivos - coalesce(lag(defensivos) OVER w, 0) = 1, false) AS up_d
      FROM re_events WINDOW w AS (PARTITION BY game_id, jugador ORDER BY eventnum)) x""", [
    ("re_events", """SELECT game_id, player1_name AS jugador, eventnum,
  max(TRY_CAST(regexp_extract(descripcion, 'off:(\\d+)', 1) AS INTEGER)) AS ofensivos,
  max(TRY_CAST(regexp_extract(descripcion, 'def:(\\d+)', 1) AS INTEGER)) AS defensivos
FROM stream WHERE contains(descripcion, 'rebound') AND player1_name <> '' GROUP BY game_id, player1_name, eventnum""")])

_TABLES = {"equipo": ("team", "idEquipo", ("nombre", "arena", "ciudad", "estado")), "arbitro": ("referee", "idArbitro", ("nombre",)),
           "liga": ("league", "idLiga", ("nombre",)), "fecha": ("calendar", "idFecha", ("temporada",)),
           "ubicacion": ("venue", "idUbicacion", ("capacidad", "arena", "ciudad", "estado")),
           "jugador": ("player", "idJugador", ("altura", "peso", "nombre", "envergadura", "alcance_pie", "posicion", "escuela", "pais", "equipo",
                                               "carrera_profesional"))}
_LIMITS = {("fecha", "temporada"): 20, ("jugador", "equipo"): 90}
_REFS = {"idEquipo_Local": "equipo", "idEquipo_Visitante": "equipo", "idArbitro": "arbitro", "idLiga": "liga", "idFecha": "fecha",
         "idUbicacion": "ubicacion", "idJugador": "jugador"}
_CHECKS = [f"SELECT 'pk_{t}' AS control, count(*) AS violaciones FROM (SELECT {k} FROM {c} GROUP BY {k} HAVING count(*) > 1) x" for t, (c, k, _) in _TABLES.items()]
_CHECKS.append("SELECT 'pk_partido', count(*) FROM (SELECT idPartido FROM fact GROUP BY idPartido, idJugador HAVING count(*) > 1) x")
_CHECKS += [f"SELECT 'fk_{c}', count(*) FROM fact f WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_TABLES[t][0]} d WHERE d.{_TABLES[t][1]} = f.{c})"
            for c, t in _REFS.items()]
_CHECKS += [f"SELECT 'nn_{t}_{k}', count(*) FROM {c} WHERE {k} IS NULL" for t, (c, k, _) in _TABLES.items()]
_CHECKS += [f"SELECT 'nn_partido_{k}', count(*) FROM fact WHERE {k} IS NULL" for k in ("idPartido", *_REFS)]
_CHECKS += [f"SELECT 'len_{t}_{x}', count(*) FROM {c} WHERE length({x}) > {_LIMITS.get((t, x), 45)}" for t, (c, _, texts) in _TABLES.items() for x in texts]
ORACLE["dq_contracts"] = _dims(" UNION ALL ".join(_CHECKS), PLAY_CTES + HEADER + FACT + [("fact", FACT_SELECT)])
ORACLE["dq_fact_by_referee"] = _dims(
    "SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS filas, count(*) AS claves, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS repetidas "
    f"FROM (SELECT count(*) AS n FROM by_ref GROUP BY {', '.join(FACT_KEYS)}) x",
    PLAY_CTES + HEADER + FACT + [("pre_all", "SELECT * FROM m_id JOIN (SELECT DISTINCT * FROM header) USING (game_id)"),
                                 ("by_ref", FACT_SELECT.replace("FROM pre JOIN", "FROM pre_all JOIN"))])


# -- names that several players hold ---------------------------------------------------

def _cut(c: str) -> str:
    return f"regexp_replace({c}, '[0-9]( *)$', '\\1') AS {c}"


#: The chains of the measures, the roster and the players over plays with cut names.
_SHARED = [("cut_plays", f"SELECT * REPLACE ({', '.join(_cut(f'player{i}_name') for i in (1, 2, 3))}) FROM plays")] + [
    (n, t.replace("FROM plays", "FROM cut_plays")) for n, t in PLAY_CTES + ROSTER + PLAYER]
_HELD = ("held", "SELECT lower(trim(nombre)) AS nombre, count(*) AS n FROM player GROUP BY lower(trim(nombre))")
ORACLE["shared_names"] = oracle_with(DIM_SOURCES, "SELECT 'jugador' AS tabla, nombre, n FROM held WHERE n > 1", _SHARED + [_HELD])
ORACLE["shared_name_points"] = oracle_with(DIM_SOURCES, """SELECT game_id, jugador, idJugador, n AS candidatos, Puntos_Totales, Numero_Jugadas_Totales
FROM (SELECT m.game_id, m.jugador, p.idJugador, h.n, m.Puntos_Totales, m.Numero_Jugadas_Totales, row_number() OVER (PARTITION BY m.game_id, m.jugador
        ORDER BY coalesce(p.equipo = r.nombre_equipo, false) DESC, p.idJugador) AS place
      FROM measures m JOIN held h ON h.nombre = m.jugador JOIN player p ON lower(trim(p.nombre)) = m.jugador
      LEFT JOIN roster_one r ON r.game_id = m.game_id AND r.jugador = m.jugador) x WHERE place = 1""", _SHARED + [_HELD])
