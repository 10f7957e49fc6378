"""Schemas: driver tables, raw CSV exports and the seven output contracts.

Declared schemas let scans skip inference (no footer-reading job, no
surprise types) and pin the contract each builder must produce.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Driver tables as read by Spark 4.1 (timestamps without time zone).
DRIVER_DDL = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

# Raw CSV exports: every column is text when read with a header and no
# inference; only the columns the jobs use are listed (in file order is not
# required: CSV columns are matched by header name via ``enforceSchema=false``).
RAW_CSV_COLUMNS = {
    "play_by_play": ["game_id", "eventnum", "player1_id", "player1_name", "player1_team_city",
                     "player1_team_nickname", "player2_id", "player2_name", "player2_team_city",
                     "player2_team_nickname", "player3_id", "player3_name", "player3_team_city",
                     "player3_team_nickname", "homedescription", "visitordescription"],
    "game": ["game_id", "season_type", "game_date", "team_name_home", "team_name_away"],
    "officials": ["game_id", "official_id", "first_name", "last_name"],
    "team": ["id", "nickname", "city", "state"],
    "team_details": ["team_id", "arena", "arenacapacity"],
    "team_history": ["team_id", "year_active_till"],
    "player": ["id", "full_name", "is_active"],
    "common_player_info": ["person_id", "display_first_last", "school", "country", "weight", "position",
                           "from_year", "to_year"],
    "inactive_players": ["player_id", "first_name", "last_name", "team_city", "team_name"],
    "draft_combine_stats": ["player_id", "player_name", "position", "height_wo_shoes", "wingspan", "weight",
                            "standing_reach"],
    "Datos_equipos": ["Equipo", "Ciudad", "Estado", "Arena", "Activo", "Capacidad"],
}

# Export file -> builder source name.
RAW_TO_SOURCE = {
    "play_by_play": "plays", "game": "games", "officials": "officials", "team": "teams",
    "team_details": "team_details", "team_history": "team_history", "player": "player_info",
    "common_player_info": "player_profile", "inactive_players": "inactive_players",
    "draft_combine_stats": "draft_combine", "Datos_equipos": "team_list",
}

# Output contracts, in contract column order.
CONTRACT_DDL = {
    "equipo": "idEquipo BIGINT, estado_actual INT, nombre STRING, arena STRING, ciudad STRING, estado STRING",
    "arbitro": "idArbitro BIGINT, nombre STRING",
    "liga": "idLiga BIGINT, nombre STRING",
    "fecha": "idFecha BIGINT, temporada STRING, dia INT, mes INT, ano INT",
    "ubicacion": "idUbicacion BIGINT, capacidad STRING, arena STRING, ciudad STRING, estado STRING",
    "jugador": "idJugador BIGINT, altura STRING, peso STRING, nombre STRING, envergadura STRING, "
               "alcance_pie STRING, posicion STRING, escuela STRING, pais STRING, equipo STRING, "
               "estado_actual INT, carrera_profesional STRING",
    "partido": "idPartido BIGINT, idEquipo_Local BIGINT, idEquipo_Visitante BIGINT, idArbitro BIGINT, "
               "idLiga BIGINT, idFecha BIGINT, idUbicacion BIGINT, idJugador BIGINT, Puntos_Totales INT, "
               "Saques_Exitosos INT, Saques_Fallidos INT, Tiros_Dobles_Exitosos INT, Tiros_Dobles_Fallidos INT, "
               "Tiros_Triples_Exitosos INT, Tiros_Triples_Fallidos INT, Tiros_Libres_Exitosos INT, "
               "Tiros_Libres_Fallidos INT, Robos_Exitosos INT, Rebotes_Defensivos_Obtenidos INT, "
               "Rebotes_Ofensivos_Obtenidos INT, Rebotes_Obtenidos INT, Tiros_Bloqueados INT, Perdidas_Balon INT, "
               "Cambios_Jugadores INT, Tiempos_Muertos INT, Faltas_Personales INT, Faltas_Balon_Suelto INT, "
               "Faltas_Disparo INT, Faltas_Rebote INT, Faltas_Ofensivas INT, Numero_Jugadas_Totales INT, "
               "Cantidad_Ataques_Exitosos INT, Cantidad_Ataques_Fallidos INT, Proporcion_Exito_Ataques FLOAT",
}


def contract(name: str) -> StructType:
    return StructType.fromDDL(CONTRACT_DDL[name])


def driver_schema(name: str) -> StructType:
    return StructType.fromDDL(DRIVER_DDL[name])
