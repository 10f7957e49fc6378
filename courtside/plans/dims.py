"""Dimension builders: referee, league, calendar, venue, team, player.

Each builder is a pure function of DataFrames (no I/O) and returns the
table contract's columns in contract order.  Surrogate keys are dense and
deterministic (1..n in natural-key order, see ``operators.keys``) instead
of partition-dependent ids; ``number`` may be ``releases.KeyStore.number``,
which keeps the ids of earlier loads.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions import buckets as B
from courtside.functions.text import full_name, norm_key, season_type, to_number, UNKNOWN
from courtside.operators.keys import dedupe, desc_nulls_last, number_rows
from courtside.operators.unpivot import unpivot_groups

Numbering = Callable[[DataFrame, Sequence[str], str], DataFrame]

# Calendar span and the last season year that marks a team active.
CALENDAR_START = "1946-01-01"
CALENDAR_END = "2023-12-31"
ACTIVE_YEAR = 2019


# -- referee ------------------------------------------------------------------

def referee_dim(officials: DataFrame, number: Numbering = number_rows) -> DataFrame:
    """(idArbitro, nombre): one row per official_id, name = 'first last'."""
    one = dedupe(officials.select("official_id", "first_name", "last_name"), ["official_id"], collapse=True)
    named = one.select("official_id", full_name("first_name", "last_name").alias("nombre"))
    return number(named, ["official_id"], "idArbitro").select("idArbitro", "nombre")


# -- league -------------------------------------------------------------------

def league_dim(games: DataFrame, number: Numbering = number_rows) -> DataFrame:
    """(idLiga, nombre): distinct season types with the all-star alias folded."""
    names = games.select(season_type("season_type").alias("nombre")).distinct()
    return number(names, ["nombre"], "idLiga").select("idLiga", "nombre")


# -- calendar -----------------------------------------------------------------

def season_label(year: F.Column, month: F.Column) -> F.Column:
    """Season of a date: starts in October; label 'y-(y+1)'."""
    start = F.when(month >= 10, year).otherwise(year - 1)
    return F.concat_ws("-", start.cast("string"), (start + 1).cast("string"))


def calendar_dim(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END,
                 games: DataFrame | None = None, date_col: str = "game_date",
                 date_format: str = "yyyy-MM-dd HH:mm:ss", max_extra_days: int = 36525) -> DataFrame:
    """(idFecha, temporada, dia, mes, ano): one row per day of [start, end].

    ``idFecha`` is the day's distance from ``start`` plus one, whatever the
    span.  With ``games`` the span is widened to their parseable dates, by at
    most ``max_extra_days`` on each side (dates beyond, as from a bad row,
    get no key); later days go on counting and earlier ones get ids from 0
    down, so no day's id ever changes.
    """
    d0, d1 = (_dt.date.fromisoformat(x) for x in (start, end))
    first, last = 0, (d1 - d0).days
    if games is not None:
        day = F.datediff(F.to_date(F.try_to_timestamp(F.col(date_col), F.lit(date_format))), F.lit(d0))
        near = day.between(first - max_extra_days, last + max_extra_days)
        lo, hi = games.agg(F.min(F.when(near, day)), F.max(F.when(near, day))).first()
        first, last = (first, last) if lo is None else (min(first, lo), max(last, hi))
    days = spark.range(first, last + 1)
    fecha = F.date_add(F.lit(d0), F.col("id").cast("int"))
    dated = days.select((F.col("id") + 1).alias("idFecha"), fecha.alias("fecha"))
    y, m = F.year("fecha"), F.month("fecha")
    return dated.select("idFecha", season_label(y, m).alias("temporada"),
                        F.dayofmonth("fecha").alias("dia"), m.alias("mes"), y.alias("ano"))


# -- venue --------------------------------------------------------------------

def venue_dim(teams: DataFrame, details: DataFrame, team_list: DataFrame, number: Numbering = number_rows) -> DataFrame:
    """(idUbicacion, capacidad, arena, ciudad, estado).

    Arenas of the team details (with the team's city/state; details without
    a team are kept) plus the hand-kept list; one row per (arena, city,
    state), team-details rows preferred; capacity bucketed from its text.
    """
    t = teams.select(F.col("id").alias("team_id"), F.col("city").alias("ciudad"), F.col("state").alias("estado"))
    d = details.select("team_id", "arena", F.col("arenacapacity").alias("capacidad_numero"))
    from_teams = t.join(d, "team_id", "right").select(
        "arena", "ciudad", "estado", "capacidad_numero", F.lit(0).alias("src"))
    listed = team_list.select(F.col("Arena").alias("arena"), F.col("Ciudad").alias("ciudad"),
                              F.col("Estado").alias("estado"), F.col("Capacidad").alias("capacidad_numero"),
                              F.lit(1).alias("src"))
    both = from_teams.unionByName(listed).withColumn(
        "capacidad", B.capacity_bucket(to_number("capacidad_numero")))
    one = dedupe(both, ["arena", "ciudad", "estado"], order=["src"])
    ided = number(one.select("arena", "ciudad", "estado", "capacidad"), ["arena", "ciudad", "estado"], "idUbicacion")
    return ided.fillna(UNKNOWN, subset=["capacidad", "arena", "ciudad", "estado"]).select(
        "idUbicacion", "capacidad", "arena", "ciudad", "estado")


# -- team ---------------------------------------------------------------------

def latest_year(history: DataFrame) -> DataFrame:
    """Top-1 per team: the latest (numeric) year_active_till, as an aggregation."""
    h = history.select("team_id", to_number("year_active_till").alias("year"))
    return dedupe(h, ["team_id"], order=desc_nulls_last("year"), collapse=True)


def team_dim(teams: DataFrame, details: DataFrame, history: DataFrame, team_list: DataFrame,
             number: Numbering = number_rows) -> DataFrame:
    """(idEquipo, estado_actual, nombre, arena, ciudad, estado).

    Franchises named 'city nickname', active when their latest season year
    is 2019, plus the hand-kept list; one row per (name, city), franchise
    rows preferred.
    """
    t = teams.select(F.col("id").alias("team_id"), "nickname", F.col("city").alias("ciudad"),
                     F.col("state").alias("estado"))
    arenas = dedupe(details.select("team_id", "arena"), ["team_id"])
    joined = (t.join(arenas, "team_id", "left")
              .join(latest_year(history), "team_id", "left"))
    franchise = joined.select(
        full_name("ciudad", "nickname").alias("nombre"), "ciudad", "estado", "arena",
        F.when(F.col("year") == ACTIVE_YEAR, 1).otherwise(0).alias("estado_actual"), F.lit(0).alias("src"))
    listed = team_list.select(
        F.col("Equipo").alias("nombre"), F.col("Ciudad").alias("ciudad"), F.col("Estado").alias("estado"),
        F.col("Arena").alias("arena"), F.col("Activo").try_cast("double").try_cast("int").alias("estado_actual"),
        F.lit(1).alias("src"))
    one = dedupe(franchise.unionByName(listed), ["nombre", "ciudad"], order=["src"])
    ided = number(one.drop("src"), ["nombre", "ciudad"], "idEquipo")
    return ided.fillna(UNKNOWN, subset=["nombre", "ciudad", "estado", "arena"]).select(
        "idEquipo", F.col("estado_actual").cast("int").alias("estado_actual"), "nombre", "arena", "ciudad", "estado")


# -- player -------------------------------------------------------------------

def player_slots(plays: DataFrame) -> DataFrame:
    """(player_id, nombre, equipo) for every player slot of every play."""
    groups = [{"player_id": f"player{i}_id", "nombre": f"player{i}_name",
               "city": f"player{i}_team_city", "nick": f"player{i}_team_nickname"} for i in (1, 2, 3)]
    rows = unpivot_groups(plays, [], groups)
    return rows.select("player_id", "nombre", full_name("city", "nick").alias("equipo"))


#: Attribute -> the sources that may have it, most trusted first, as (source, column of the source).
SURVIVORS = {
    "name": (("slot", "nombre"), ("directory", "full_name"), ("profile", "display_first_last"), ("inactive", "full_name"), ("combine", "player_name")),
    "pounds": (("profile", "weight"), ("combine", "weight")),
    "position": (("profile", "position"), ("combine", "position")),
    "state": (("directory", "is_active"), ("inactive", "is_active")),
}


def one_per_player(**sources: DataFrame) -> list[DataFrame]:
    """Each source reduced to one row per player: (player_id, a struct named after the source)."""
    return [dedupe(df, ["player_id"], collapse=name == "slot").select("player_id", F.struct(*[c for c in df.columns if c != "player_id"]).alias(name))
            for name, df in sources.items()]


def survivor(attribute: str, present: set[str]) -> F.Column:
    """The attribute from the first of the ``present`` sources that has it."""
    return F.coalesce(*[F.col(f"{source}.{column}") for source, column in SURVIVORS[attribute] if source in present])


def _profile(profile: DataFrame) -> DataFrame:
    return profile.select(F.col("person_id").alias("player_id"), "display_first_last", "school", "country", "weight", "position", "from_year", "to_year")


def _metric(present: set[str]) -> dict[str, F.Column]:
    """Kilograms, metres and career years of the joined sources."""
    inch = F.lit(B.INCH_M)
    return {"peso_kg": to_number(survivor("pounds", present)) * F.lit(B.POUND_KG),
            "altura_m": to_number("combine.height_wo_shoes") * inch,
            "envergadura_m": to_number("combine.wingspan") * inch,
            "alcance_pie_m": to_number("combine.standing_reach") * inch,
            "carrera_anos": to_number("profile.to_year") - to_number("profile.from_year")}


def player_dim(plays: DataFrame, player_info: DataFrame, profile: DataFrame, inactive: DataFrame,
               draft: DataFrame, number: Numbering = number_rows) -> DataFrame:
    """(idJugador, altura, peso, nombre, envergadura, alcance_pie, posicion, escuela, pais,
    equipo, estado_actual, carrera_profesional).

    Players seen in any play slot; every other source is reduced to one row
    per player before its left join; name, weight, position and state come
    from the first source that has them (``SURVIVORS``); metric conversions
    and buckets; position label.
    """
    sides = one_per_player(
        slot=player_slots(plays),
        directory=player_info.select(F.col("id").alias("player_id"), "full_name", "is_active"),
        inactive=inactive.select("player_id", full_name("first_name", "last_name").alias("full_name"), F.lit("0").alias("is_active")),
        profile=_profile(profile),
        combine=draft.select("player_id", "player_name", "position", "height_wo_shoes", "wingspan", "weight", "standing_reach"))
    joined = sides[0]
    for side in sides[1:]:
        joined = joined.join(side, "player_id", "left")
    present = {"slot", "directory", "inactive", "profile", "combine"}
    metric = _metric(present)
    # A state that is no number falls through to the next source, so each is read as one before the choice.
    state = F.coalesce(*[F.col(f"{source}.{column}").try_cast("double").try_cast("int") for source, column in SURVIVORS["state"]])
    out = joined.select(
        "player_id",
        B.bucketize(metric["altura_m"], B.HEIGHT_M).alias("altura"),
        B.bucketize(metric["peso_kg"], B.WEIGHT_KG).alias("peso"),
        survivor("name", present).alias("nombre"),
        B.bucketize(metric["envergadura_m"], B.WINGSPAN_M).alias("envergadura"),
        B.bucketize(metric["alcance_pie_m"], B.REACH_M).alias("alcance_pie"),
        B.position_label(survivor("position", present)).alias("posicion"),
        F.col("profile.school").alias("escuela"), F.col("profile.country").alias("pais"), F.col("slot.equipo").alias("equipo"),
        state.alias("estado_actual"),
        B.bucketize(metric["carrera_anos"], B.CAREER_YEARS).alias("carrera_profesional"),
    )
    ided = number(out, ["player_id"], "idJugador")
    return ided.fillna(UNKNOWN, subset=["nombre", "escuela", "pais", "equipo"]).select(
        "idJugador", "altura", "peso", "nombre", "envergadura", "alcance_pie", "posicion", "escuela", "pais",
        "equipo", "estado_actual", "carrera_profesional")


def unit_conversions(profile: DataFrame, draft: DataFrame) -> DataFrame:
    """Metric values before bucketing: kg, m and career years per player."""
    left, right = one_per_player(
        profile=_profile(profile).select("player_id", "weight", "from_year", "to_year"),
        combine=draft.select("player_id", "height_wo_shoes", "wingspan", "weight", "standing_reach"))
    values = _metric({"profile", "combine"})
    return left.join(right, "player_id", "full").select("player_id", *[v.alias(n) for n, v in values.items()])


def ambiguous_names(player: DataFrame, team: DataFrame) -> DataFrame:
    """(tabla, nombre, n): normalised names that several players or teams hold, so lookups by name fan out."""
    def held(df, table):
        return (df.groupBy(norm_key("nombre").alias("nombre")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                .select(F.lit(table).alias("tabla"), "nombre", "n"))

    return held(player, "jugador").unionByName(held(team, "equipo"))
