"""Statistics wanted by the design notes but absent from the source jobs.

* ``running_score`` (running score per game and side, and the score
  difference): a two-level prefix sum, so a game with a huge number of
  plays never lands in one window partition.
* ``rebound_split``: offensive / defensive rebounds from the "(Off:n Def:m)"
  counters the text carries (the counters are running totals per player
  and game, so the split is their maximum).
* ``rebound_events``: every rebound labelled offensive or defensive by the
  counter that rose by one since the player's rebound before in the game.
* ``team_game``: one row per game and team.
* ``extra_fouls``: technical and flagrant fouls, offensive fouls spelled
  "OFF.Foul", failed passes.
* ``play_type_counts``: plays grouped by play type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtside.functions.classify import extra_predicates, flag, general_predicates
from courtside.functions.text import full_name, norm_key
from courtside.plans.plays import participants, play_stream

# Rows per chunk of the ordered plays of one game in ``running_sum``.
CHUNK = 1024


def play_points(d) -> F.Column:
    p = general_predicates(d)
    return (F.when(p["Tiros_Triples_Exitosos"], 3).when(p["Tiros_Dobles_Exitosos"], 2)
            .when(p["Tiros_Libres_Exitosos"], 1).otherwise(0))


def running_sum(df: DataFrame, part: str, order: str, values: list[str], chunk: int = CHUNK) -> DataFrame:
    """Cumulative sums of ``values`` along integer ``order`` within ``part``.

    ``order`` must be unique within ``part``.  Rows are cut into chunks of
    ``chunk`` consecutive order values; each chunk is summed locally and
    offset by the totals of the earlier chunks of its partition.
    """
    c = df.withColumn("_chunk", F.floor(F.col(order) / chunk))
    local_w = Window.partitionBy(part, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = c.select(*df.columns, "_chunk", *[F.sum(v).over(local_w).alias(f"_l_{v}") for v in values])
    totals = c.groupBy(part, "_chunk").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    before = Window.partitionBy(part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(part, "_chunk", *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}")
                                              for v in values])
    out = local.join(offsets, [part, "_chunk"])
    return out.select(*df.columns, *[(F.col(f"_o_{v}") + F.col(f"_l_{v}")).alias(f"acum_{v}") for v in values])


def previous_values(df: DataFrame, part: list[str], order: str, values: list[str], chunk: int = CHUNK) -> DataFrame:
    """``prev_<value>``: each of ``values`` in the row before along integer ``order`` within ``part`` (null in the first).

    ``order`` must be unique within ``part``.  Rows are cut into chunks of
    ``chunk`` consecutive order values; the first row of a chunk gets the last
    values of the nearest chunk before it, so no window holds a whole part.
    """
    c = df.withColumn("_chunk", F.floor(F.col(order) / chunk))
    row = F.struct(*values)
    local = c.withColumn("_prev", F.lag(row).over(Window.partitionBy(*part, "_chunk").orderBy(order)))
    last = c.groupBy(*part, "_chunk").agg(F.max_by(row, order).alias("_last"))
    carried = last.select(*part, "_chunk", F.lag("_last").over(Window.partitionBy(*part).orderBy("_chunk")).alias("_carried"))
    same = [local[p].eqNullSafe(carried[p]) for p in (*part, "_chunk")]
    joined = local.join(carried, same).select(*[local[c] for c in (*df.columns, "_prev")], "_carried")
    before = F.coalesce("_prev", "_carried")
    return joined.select(*df.columns, *[before[v].alias(f"prev_{v}") for v in values])


def rebound_events(plays: DataFrame) -> DataFrame:
    """(game_id, jugador, eventnum, ofensivos, defensivos, tipo): each rebound of the first slot's player, labelled.

    ``tipo`` is the counter of the text that is one above the player's last
    rebound in the game (0 before the first); ``sin_clase`` if none or both
    are, or the text has no counters.
    """
    s = play_stream(plays).where(F.col("descripcion").contains("rebound") & (F.col("player1_name") != "") & F.col("eventnum").isNotNull())
    counter = {n: F.regexp_extract("descripcion", rf"{key}:(\d+)", 1).try_cast("int") for n, key in (("ofensivos", "off"), ("defensivos", "def"))}
    if dict(s.dtypes)["eventnum"] == "string":
        s = s.withColumn("eventnum", F.col("eventnum").try_cast("double").try_cast("bigint")).where(F.col("eventnum").isNotNull())
    events = s.groupBy("game_id", F.col("player1_name").alias("jugador"), "eventnum").agg(*[F.max(c).alias(n) for n, c in counter.items()])
    told = previous_values(events, ["game_id", "jugador"], "eventnum", ["ofensivos", "defensivos"])

    def rose(n):
        return F.coalesce(F.col(n) - F.coalesce(f"prev_{n}", F.lit(0)) == 1, F.lit(False))

    tipo = (F.when(rose("ofensivos") & ~rose("defensivos"), "ofensivo").when(rose("defensivos") & ~rose("ofensivos"), "defensivo")
            .otherwise("sin_clase"))
    return told.select("game_id", "jugador", "eventnum", "ofensivos", "defensivos", tipo.alias("tipo"))


def running_score(plays: DataFrame) -> DataFrame:
    """(game_id, eventnum, puntos_local, puntos_visitante, marcador_local, marcador_visitante, diferencia).

    Event numbers read as text (CSV exports) are ordered as numbers; plays
    without one have no place in the order and are left out.
    """
    if dict(plays.dtypes)["eventnum"] == "string":
        plays = plays.withColumn("eventnum", F.col("eventnum").try_cast("double").try_cast("bigint"))
    plays = plays.where(F.col("eventnum").isNotNull())
    home = play_points(F.lower("homedescription"))
    away = play_points(F.lower("visitordescription"))
    pts = plays.groupBy("game_id", "eventnum").agg(
        F.sum(F.coalesce(home, F.lit(0))).alias("local"), F.sum(F.coalesce(away, F.lit(0))).alias("visitante"))
    acc = running_sum(pts, "game_id", "eventnum", ["local", "visitante"])
    return acc.select("game_id", "eventnum", F.col("local").alias("puntos_local"),
                      F.col("visitante").alias("puntos_visitante"),
                      F.col("acum_local").alias("marcador_local"), F.col("acum_visitante").alias("marcador_visitante"),
                      (F.col("acum_local") - F.col("acum_visitante")).alias("diferencia"))


def rebound_split(plays: DataFrame) -> DataFrame:
    """(game_id, jugador, rebotes, rebotes_ofensivos, rebotes_defensivos) for the rebounder (slot 1)."""
    s = play_stream(plays).where(F.col("descripcion").contains("rebound") & (F.col("player1_name") != ""))
    off = F.regexp_extract("descripcion", r"off:(\d+)", 1)
    dfn = F.regexp_extract("descripcion", r"def:(\d+)", 1)
    return s.groupBy("game_id", F.col("player1_name").alias("jugador")).agg(
        F.count(F.lit(1)).alias("rebotes"),
        F.coalesce(F.max(F.nullif(off, F.lit("")).cast("int")), F.lit(0)).alias("rebotes_ofensivos"),
        F.coalesce(F.max(F.nullif(dfn, F.lit("")).cast("int")), F.lit(0)).alias("rebotes_defensivos"))


def team_game(plays: DataFrame) -> DataFrame:
    """(game_id, equipo, jugadas, puntos, tiros_fallidos): one row per game and team.

    A play's text counts once, for the team of its first player: an assisted
    shot is worth its points, and an opponent named in a text gets neither
    the points nor the miss.  Texts without a first player count for no team.
    """
    base = plays.where(norm_key("player1_name") != "").select(
        "game_id", full_name("player1_team_city", "player1_team_nickname").alias("equipo"),
        F.inline(F.array(F.struct(F.col("homedescription").alias("d")),
                         F.struct(F.col("visitordescription").alias("d")))))
    base = base.where(F.col("d").isNotNull()).withColumn("d", F.lower("d"))
    p = general_predicates(F.col("d"))
    return base.groupBy("game_id", "equipo").agg(
        F.count(F.lit(1)).alias("jugadas"),
        F.sum(play_points(F.col("d"))).cast("bigint").alias("puntos"),
        F.sum(flag(p["Cantidad_Ataques_Fallidos_General"])).cast("bigint").alias("tiros_fallidos"))


def extra_fouls(plays: DataFrame) -> DataFrame:
    """(game_id, jugador, extra counts) per participant with a name."""
    parts = participants(play_stream(plays)).where(F.col("jugador") != "")
    preds = extra_predicates(F.col("descripcion"))
    return parts.groupBy("game_id", "jugador").agg(
        *[F.sum(flag(p)).cast("bigint").alias(n) for n, p in preds.items()])


# Play type labels, first matching rule wins.
PLAY_TYPES = [
    ("salto", "jump ball"), ("tiro_libre", "free throw"), ("tiro", "3pt"), ("tiro", "shot"), ("tiro", "layup"),
    ("tiro", "dunk"), ("rebote", "rebound"), ("robo", "steal"), ("bloqueo", "block"), ("perdida", "turnover"),
    ("falta", "foul"), ("cambio", "sub:"), ("tiempo_muerto", "timeout"),
]


def play_type(d) -> F.Column:
    out = None
    for label, needle in PLAY_TYPES:
        out = F.when(d.contains(needle), label) if out is None else out.when(d.contains(needle), label)
    return out.otherwise("otra")


def play_type_counts(plays: DataFrame) -> DataFrame:
    """(tipo, jugadas): plays (home and visitor texts) per type."""
    s = play_stream(plays)
    return s.groupBy(play_type(F.col("descripcion")).alias("tipo")).agg(F.count(F.lit(1)).alias("jugadas"))
