"""Fact table: one row per game and player with 26 measures and 8 keys.

Plan (one scan of the plays):

1. ``game_player_measures``: explode slots, classify, aggregate by
   (game_id, normalised player name) with partial aggregation.
2. Player key by name (lookup; a name held by two players yields one row
   per player, as a per-id grouping would).  These rows are written as
   Parquet in the checkpoint folder, so the plays are read once.
3. Game header reduced to one row per game (referee, league, date, teams,
   venue keys), kept for the games of step 2 and numbered: ``idPartido`` is
   the dense rank of game_id among them.
4. One join of step 2 with these rows on game_id.

The roster join of the source job is a no-op here: every (game, player)
with statistics comes from a player slot of a play of that game, so the
roster already contains it; ``roster_measures`` runs that join by itself, and
``stats_outer_merge`` keeps the source job's shape as a cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.functions.classify import GENERAL_STATS
from courtside.functions.text import full_name, norm_key, season_type
from courtside.operators.keys import dedupe, nulls_last, number_rows
from courtside.operators.lookup import lookup
from courtside.operators.materialize import materialize
from courtside.operators.unpivot import unpivot_groups
from courtside.plans.plays import (blocks, derived_metrics, game_player_counts, game_player_measures, jump_balls, measures_of,
                                   packed_sums, participants, play_flags, play_stream, steals, unpacked)

# The contract's columns in order.
KEYS = ["idPartido", "idEquipo_Local", "idEquipo_Visitante", "idArbitro", "idLiga", "idFecha", "idUbicacion",
        "idJugador"]
MEASURES = ["Puntos_Totales", "Saques_Exitosos", "Saques_Fallidos", "Tiros_Dobles_Exitosos", "Tiros_Dobles_Fallidos",
            "Tiros_Triples_Exitosos", "Tiros_Triples_Fallidos", "Tiros_Libres_Exitosos", "Tiros_Libres_Fallidos",
            "Robos_Exitosos", "Rebotes_Defensivos_Obtenidos", "Rebotes_Ofensivos_Obtenidos", "Rebotes_Obtenidos",
            "Tiros_Bloqueados", "Perdidas_Balon", "Cambios_Jugadores", "Tiempos_Muertos", "Faltas_Personales",
            "Faltas_Balon_Suelto", "Faltas_Disparo", "Faltas_Rebote", "Faltas_Ofensivas", "Numero_Jugadas_Totales",
            "Cantidad_Ataques_Exitosos", "Cantidad_Ataques_Fallidos"]
RATIO = "Proporcion_Exito_Ataques"
HEADER_KEYS = ["idArbitro", "idEquipo_Local", "idEquipo_Visitante", "idLiga", "idFecha", "idUbicacion"]
GAME_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"


# -- roster -------------------------------------------------------------------

def roster(plays: DataFrame) -> DataFrame:
    """(game_id, jugador, nombre_equipo): players of each game, names normalised, once each."""
    groups = [{"jugador": f"player{i}_name", "city": f"player{i}_team_city", "nick": f"player{i}_team_nickname"}
              for i in (1, 2, 3)]
    rows = unpivot_groups(plays, ["game_id"], groups)
    rows = rows.select("game_id", norm_key("jugador").alias("jugador"),
                       full_name("city", "nick").alias("nombre_equipo"))
    return dedupe(rows, ["game_id", "jugador"])


def roster_measures(plays: DataFrame) -> DataFrame:
    """The measures with the player's team: inner join with the roster on (game_id, jugador)."""
    return game_player_measures(plays).join(roster(plays), ["game_id", "jugador"])


# -- game header ----------------------------------------------------------------

def parse_game_date(c) -> F.Column:
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c, F.lit(GAME_DATE_FORMAT))


def date_key(games: DataFrame, calendar: DataFrame) -> DataFrame:
    """(game_id, idFecha): parse the game timestamp, look the day up in the calendar."""
    ts = parse_game_date("game_date")
    g = games.select("game_id", F.dayofmonth(ts).alias("dia"), F.month(ts).alias("mes"), F.year(ts).alias("ano"))
    return lookup(g, calendar, ["dia", "mes", "ano"], ["dia", "mes", "ano"], ["idFecha"]).select("game_id", "idFecha")


def home_team_venue(games: DataFrame, team: DataFrame, venue: DataFrame) -> DataFrame:
    """(game_id, idEquipo_Local, idEquipo_Visitante, idUbicacion).

    The venue is the home team's arena/city/state matched case- and
    space-insensitively.
    """
    g = with_teams_and_venue(games.select("game_id", "team_name_home", "team_name_away"), team, venue)
    return g.select("game_id", "idEquipo_Local", "idEquipo_Visitante", "idUbicacion")


def with_teams_and_venue(g: DataFrame, team: DataFrame, venue: DataFrame) -> DataFrame:
    """``g`` with the keys of both teams and of the home team's venue."""
    kept = [c for c in g.columns if c not in ("team_name_home", "team_name_away")]
    g = lookup(g, team, ["team_name_away"], ["nombre"], ["idEquipo"], rename={"idEquipo": "idEquipo_Visitante"})
    g = lookup(g, team, ["team_name_home"], ["nombre"], ["idEquipo", "arena", "ciudad", "estado"],
               rename={"idEquipo": "idEquipo_Local", "arena": "h_arena", "ciudad": "h_ciudad", "estado": "h_estado"})
    g = g.select(*kept, "idEquipo_Local", "idEquipo_Visitante",
                 *[norm_key(f"h_{c}").alias(f"v_{c}") for c in ("arena", "ciudad", "estado")])
    v = venue.select("idUbicacion", *[norm_key(c).alias(f"n_{c}") for c in ("arena", "ciudad", "estado")])
    g = lookup(g, v, ["v_arena", "v_ciudad", "v_estado"], ["n_arena", "n_ciudad", "n_estado"], ["idUbicacion"])
    return g.select(*kept, "idEquipo_Local", "idEquipo_Visitante", "idUbicacion")


def game_header(games: DataFrame, officials: DataFrame, referee: DataFrame, league: DataFrame,
                calendar: DataFrame, team: DataFrame, venue: DataFrame, fold_game_alias: bool = True) -> DataFrame:
    """One row per (game, official): game_id + the six dimension keys.

    ``fold_game_alias`` also folds the all-star alias on the game side, so
    both spellings find the league row (the source job only folded it on the
    dimension side and left such games without a league).
    """
    g = dedupe(games.select("game_id", "team_name_home", "team_name_away", "game_date", "season_type"),
               ["game_id"])
    season = season_type("season_type") if fold_game_alias else F.col("season_type")
    h = lookup(g.withColumn("liga", season), league, ["liga"], ["nombre"], ["idLiga"])
    ts = parse_game_date("game_date")
    h = h.withColumns({"dia": F.dayofmonth(ts), "mes": F.month(ts), "ano": F.year(ts)})
    h = lookup(h, calendar, ["dia", "mes", "ano"], ["dia", "mes", "ano"], ["idFecha"])
    h = with_teams_and_venue(h.select("game_id", "idLiga", "idFecha", "team_name_home", "team_name_away"), team, venue)
    # The referee's key first: beyond a broadcast this join shuffles by name, and the rows then stay dealt by game.
    refs = officials.select("game_id", full_name("first_name", "last_name").alias("nombre_arbitro"))
    refs = lookup(refs, referee, ["nombre_arbitro"], ["nombre"], ["idArbitro"]).select("game_id", "idArbitro")
    return h.join(refs, "game_id", "left").select("game_id", *HEADER_KEYS)


def game_keys(header: DataFrame) -> DataFrame:
    """One row per game: the smallest key tuple (NULL last) among its officials."""
    order = [x for k in HEADER_KEYS for x in nulls_last(k)]
    return dedupe(header, ["game_id"], order=order)


# -- fact -----------------------------------------------------------------------

def _contract(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(k).cast("bigint").alias(k) for k in KEYS],
                     *[F.coalesce(F.col(m), F.lit(0)).cast("int").alias(m) for m in MEASURES],
                     F.coalesce(F.col(RATIO), F.lit(0.0)).cast("double").alias(RATIO))


def player_counts(plays: DataFrame, player: DataFrame) -> DataFrame:
    """The packed sums per game and player name with the player key."""
    names = player.select("idJugador", norm_key("nombre").alias("nombre_n"))
    return lookup(game_player_counts(plays), names, ["jugador"], ["nombre_n"], ["idJugador"], how="inner")


def player_measures(plays: DataFrame, player: DataFrame) -> DataFrame:
    """Measures with the player key, before the game keys."""
    counts = player_counts(plays, player)
    measures = measures_of(counts)
    return measures.select(*[c for c in measures.columns if c != "idJugador"], "idJugador")


def resolved_measures(plays: DataFrame, player: DataFrame) -> DataFrame:
    """``player_measures`` with one player per game and name, and ``candidatos``, the players of that name.

    ``player_measures`` gives every player of a name a full copy of the
    measures.  Here a shared name goes to the player whose team is the one
    the game's roster has for the name, else to the smallest key, so no
    point counts twice.  Only rows of shared names meet the roster.
    """
    measures = measures_of(materialize(game_player_counts(plays), "counts"))
    names = player.select("idJugador", norm_key("nombre").alias("nombre_n"), "equipo").where("nombre_n IS NOT NULL")
    held = names.groupBy("nombre_n").agg(F.count(F.lit(1)).alias("candidatos"), F.min("idJugador").alias("idJugador"))
    alone = lookup(measures, held.where("candidatos = 1"), ["jugador"], ["nombre_n"], ["idJugador", "candidatos"], how="inner")
    shared = held.where("candidatos > 1")
    several = lookup(measures, shared, ["jugador"], ["nombre_n"], ["candidatos", "idJugador"], how="inner", rename={"idJugador": "_first"})
    # The candidate depends on the name and the team alone: the smallest key of that team, else of the name.
    of_team = names.groupBy("nombre_n", "equipo").agg(F.min("idJugador").alias("idJugador"))
    teams = lookup(roster(plays), shared, ["jugador"], ["nombre_n"], [], how="left_semi")
    chosen = lookup(teams, of_team, ["jugador", "nombre_equipo"], ["nombre_n", "equipo"], ["idJugador"]).drop("nombre_equipo")
    kept = [c for c in several.columns if c != "_first"]
    several = several.join(chosen, ["game_id", "jugador"]).select(*kept, F.coalesce("idJugador", "_first").alias("idJugador"))
    return alone.unionByName(several)


def numbered_games(header: DataFrame, measures: DataFrame, number=number_rows) -> DataFrame:
    """One row per game with measures: game_id, its header keys, ``idPartido``."""
    return number(seen_games(game_keys(header), measures), ["game_id"], "idPartido")


def seen_games(games: DataFrame, measures: DataFrame) -> DataFrame:
    """The games with measures, written before they are numbered, since the numbering finds its ranges by a pass of its own."""
    return materialize(games.join(measures.select("game_id").distinct(), "game_id", "left_semi"), "games")


def fact_partido(plays: DataFrame, header: DataFrame, player: DataFrame, grain: str = "game", number=number_rows) -> DataFrame:
    """The fact table in contract order (ratio as DOUBLE; FLOAT at the table sink).  ``number``: see ``dims``.

    ``grain="referee"`` keeps a row per official of the game instead of the
    smallest key alone.
    """
    if grain not in ("game", "referee"):
        raise ValueError(f"grain {grain!r}")
    counts = materialize(player_counts(plays, player).drop("jugador"), "player-counts")
    if grain == "referee":
        header = materialize(header.distinct(), "header")  # read for the games and for the rows
        ids = number(seen_games(header.select("game_id").distinct(), counts), ["game_id"], "idPartido")
        games = header.join(ids, "game_id")
    else:
        games = numbered_games(header, counts, number)
    # Few narrow rows a game are hashed, so the rows with measures need no sort.
    return _contract(measures_of(counts.join(games.hint("shuffle_hash"), "game_id")))


def stats_outer_merge(plays: DataFrame, player: DataFrame) -> DataFrame:
    """The source job's shape: general, jump-ball, block and steal statistics
    aggregated separately per (game, idJugador) and merged by full outer
    joins, then zero-filled.  Must equal the one-pass measures."""
    stream = play_stream(plays)
    names = player.select("idJugador", norm_key("nombre").alias("nombre_n"))

    def total(df):
        """Sums per (game, idJugador)."""
        found = lookup(df, names, ["jugador"], ["nombre_n"], ["idJugador"], how="inner")
        return found.groupBy("game_id", "idJugador").agg(*[F.sum(c).alias(c) for c in df.columns if c not in ("game_id", "jugador")])

    # The general sums stay packed until all are merged.
    flags = play_flags(participants(stream).where(F.col("jugador") != ""))
    general = total(flags.groupBy("game_id", "jugador").agg(*packed_sums({c: F.col(c) for c in GENERAL_STATS})))
    # The three slot statistics have few rows: merged first, they meet the general ones in one join.
    slots, *others = [total(part) for part in (jump_balls(stream), blocks(stream), steals(stream))]
    for part in others:
        slots = slots.join(part, ["game_id", "idJugador"], "full")
    slots = slots.drop("cantidad_ataques_exitosos", "cantidad_ataques_fallidos")
    merged = unpacked(general.join(slots, ["game_id", "idJugador"], "full").fillna(0), GENERAL_STATS)
    own = [c for c in slots.columns if c not in ("game_id", "idJugador")]
    return derived_metrics(merged.select("game_id", "idJugador", *GENERAL_STATS, *own))
