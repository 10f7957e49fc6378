"""Play stream, participant explode, classification and per player-game statistics.

One scan of the plays feeds everything: descriptions are unpivoted
(home/visitor), every text is classified once into a bit mask, and only the
mask goes with each player slot through the explode.  A single
``groupBy(game_id, jugador)`` (partial + final aggregation) sums the bits to
all measures, including the slot-dependent jump-ball, block and steal counts
that would otherwise need separate branches and outer joins.  ``play_flags``
gives the same indicators per participant row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions.classify import (BLOCK, GENERAL_STATS, JUMP_BALL, ROLE_STATS, STEAL, bit_test, flag, general_predicates, general_rules,
                                          needle_bits, role_predicates)
from courtside.functions.text import norm_key
from courtside.operators.unpivot import unpivot_groups

SLOTS = (1, 2, 3)
STAT_COLUMNS = GENERAL_STATS + ROLE_STATS
ROLE_TEXTS = (JUMP_BALL, BLOCK, STEAL)


def play_stream(plays: DataFrame) -> DataFrame:
    """(game_id, eventnum, player1..3 normalised, descripcion lower-cased); NULL texts dropped.

    Home and visitor descriptions become rows; a neutral description, if any,
    is not read.
    """
    keep = ["game_id"] + (["eventnum"] if "eventnum" in plays.columns else [])
    slots = [norm_key(f"player{i}_name").alias(f"player{i}_name") for i in SLOTS]
    base = plays.select(*keep, *slots, "homedescription", "visitordescription")
    out = unpivot_groups(base, keep + [f"player{i}_name" for i in SLOTS],
                         [{"descripcion": "homedescription"}, {"descripcion": "visitordescription"}])
    return out.where(F.col("descripcion").isNotNull()).withColumn("descripcion", F.lower("descripcion"))


def participants(stream: DataFrame) -> DataFrame:
    """One row per (play, slot) with a player: (game_id, [eventnum,] descripcion, role, jugador).

    Empty names only matter for the slot-dependent statistics, so they are
    kept solely on plays that carry one; NULL names never match a player.
    """
    keep = [c for c in ("game_id", "eventnum") if c in stream.columns] + ["descripcion"]
    exploded = stream.select(*keep, F.posexplode(F.array(*[F.col(f"player{i}_name") for i in SLOTS]))
                             .alias("pos", "jugador"))
    d = F.col("descripcion")
    special = d.contains("jump ball") | d.contains("block") | d.contains("steal")
    return (exploded.where(F.col("jugador").isNotNull() & ((F.col("jugador") != "") | special))
            .select(*keep, (F.col("pos") + 1).alias("role"), "jugador"))


def play_flags(parts: DataFrame, attribution: str = "all", whole_words: bool = False) -> DataFrame:
    """All indicator columns (0/1) per participant row.

    ``attribution="primary"`` gives the general statistics of a play to its
    first player only (an assister gets no points); ``"all"`` to everyone
    named.  ``whole_words``: see ``general_predicates``.
    """
    if attribution not in ("all", "primary"):
        raise ValueError(f"attribution {attribution!r}")
    d, role = F.col("descripcion"), F.col("role")
    general = F.col("jugador") != ""
    if attribution == "primary":
        general = general & (role == 1)
    cols = [flag(general & p).alias(n) for n, p in general_predicates(d, whole_words).items()]
    cols += [flag(p).alias(n) for n, p in role_predicates(d, role).items()]
    return parts.select(*parts.columns, *cols)


def player_game_stats(flags: DataFrame) -> DataFrame:
    """Sum every indicator per (game_id, jugador); sums are BIGINT."""
    return flags.groupBy("game_id", "jugador").agg(
        *[F.sum(n).cast("bigint").alias(n) for n in STAT_COLUMNS])


def derived_metrics(stats: DataFrame) -> DataFrame:
    """Failed / successful attacks, success ratio and points from the sums."""
    c = F.col
    ok = c("Tiros_Triples_Exitosos") + c("Tiros_Dobles_Exitosos") + c("Tiros_Libres_Exitosos") + c("Saques_Exitosos")
    return stats.select(
        *stats.columns,
        (c("Cantidad_Ataques_Fallidos_General") + c("Saques_Fallidos")).alias("Cantidad_Ataques_Fallidos"),
        ok.alias("Cantidad_Ataques_Exitosos"),
        F.when(c("Numero_Jugadas_Totales") > 0,
               F.round(ok / c("Numero_Jugadas_Totales"), 3)).otherwise(F.lit(0.0)).alias("Proporcion_Exito_Ataques"),
        (c("Tiros_Triples_Exitosos") * 3 + c("Tiros_Dobles_Exitosos") * 2 + c("Tiros_Libres_Exitosos"))
        .alias("Puntos_Totales"),
    )


def play_masks(stream: DataFrame) -> DataFrame:
    """(game_id, player1..3, mask): bit i of ``mask`` is the i-th of ``GENERAL_STATS``, then the texts of ``ROLE_TEXTS``.

    The text is searched once per substring (first projection); the second
    one reads the rules from the bits found.
    """
    names = [f"player{i}_name" for i in SLOTS]
    found = stream.select("game_id", *names, needle_bits(F.col("descripcion")).alias("found"))
    has = bit_test(F.col("found"))
    mask = F.lit(0)
    for i, p in enumerate([*general_rules(has).values(), *[has(t) for t in ROLE_TEXTS]]):
        mask = mask.bitwiseOR(F.when(p, F.lit(1 << i)).otherwise(F.lit(0)))
    return found.select("game_id", *names, mask.alias("mask"))


def packed_sums(flags: dict[str, Column]) -> list[Column]:
    """Sums of 0/1 columns, two in a long (``c0``, ``c1``, ...): the later half of the columns stands 32 bits above the first.

    Half as many sums are half the aggregation's memory and shuffle.  No
    sum is mixed into another below 2^32 rows a group; a group with 2^31 rows
    counted by one of the later half is an error (BIGINT overflow).
    """
    columns = [c.cast("bigint") for c in flags.values()]
    half = (len(columns) + 1) // 2
    pairs = [low if k + half >= len(columns) else low + F.shiftleft(columns[k + half], 32) for k, low in enumerate(columns[:half])]
    return [F.sum(c).alias(f"c{k}") for k, c in enumerate(pairs)]


def unpacked(packed: DataFrame, names: Sequence[str]) -> DataFrame:
    """The sums of ``packed_sums`` as BIGINT columns ``names``, after the other columns."""
    half = (len(names) + 1) // 2
    kept = [c for c in packed.columns if c not in {f"c{k}" for k in range(half)}]
    low = [F.col(f"c{k}").bitwiseAND(F.lit((1 << 32) - 1)).alias(n) for k, n in enumerate(names[:half])]
    return packed.select(*kept, *low, *[F.shiftright(f"c{k}", 32).alias(n) for k, n in enumerate(names[half:])])


def mask_counts(masks: DataFrame) -> DataFrame:
    """The packed sums of ``STAT_COLUMNS`` per (game_id, jugador) of every text's participants, from its mask."""
    slots = masks.select("game_id", "mask", F.posexplode(F.array(*[F.col(f"player{i}_name") for i in SLOTS])).alias("pos", "jugador"))
    n, mask, role = len(GENERAL_STATS), F.col("mask"), F.col("pos") + 1
    # A slot's own bits: the general ones if it has a name, then one per role statistic (jump ball, block, steal texts).
    rules = ((n, role.isin(1, 3)), (n, role == 2), (n + 1, role == 3), (n + 2, role == 2))
    own = F.when(F.col("jugador") != "", mask.bitwiseAND((1 << n) - 1)).otherwise(F.lit(0))
    for i, (text, holds) in enumerate(rules):
        own = own.bitwiseOR(F.when(holds & (mask.bitwiseAND(1 << text) != 0), F.lit(1 << (n + i))).otherwise(F.lit(0)))
    special = sum(1 << (n + i) for i in range(len(ROLE_TEXTS)))
    named = slots.where(F.col("jugador").isNotNull() & ((F.col("jugador") != "") | (mask.bitwiseAND(special) != 0)))
    bits = named.select("game_id", "jugador", own.alias("own"))
    return bits.groupBy("game_id", "jugador").agg(*packed_sums({c: F.shiftright("own", i).bitwiseAND(1) for i, c in enumerate(STAT_COLUMNS)}))


def game_player_counts(plays: DataFrame) -> DataFrame:
    """plays -> (game_id, jugador, packed sums) in one pass; ``measures_of`` reads them."""
    return mask_counts(play_masks(play_stream(plays)))


def measures_of(counts: DataFrame) -> DataFrame:
    """All measures from the packed sums of ``STAT_COLUMNS``."""
    return derived_metrics(unpacked(counts, STAT_COLUMNS))


def game_player_measures(plays: DataFrame) -> DataFrame:
    """plays -> (game_id, jugador, all measures) in one pass."""
    return measures_of(game_player_counts(plays))


# -- the three slot-specific views, as separate reports -----------------------

def jump_balls(stream: DataFrame) -> DataFrame:
    """Per (game, player): jump balls won / lost and the attacks they count as."""
    parts = participants(stream).where(F.col("descripcion").contains("jump ball"))
    won = F.col("role").isin(1, 3)
    return parts.groupBy("game_id", "jugador").agg(
        F.count_if(won).alias("Saques_Exitosos"),
        F.count_if(won).alias("cantidad_ataques_exitosos"),
        F.count_if(~won).alias("Saques_Fallidos"),
        F.count_if(~won).alias("cantidad_ataques_fallidos"))


def blocks(stream: DataFrame) -> DataFrame:
    parts = participants(stream).where(F.col("descripcion").contains("block") & (F.col("role") == 3))
    return parts.groupBy("game_id", "jugador").agg(F.count(F.lit(1)).alias("Tiros_Bloqueados"))


def steals(stream: DataFrame) -> DataFrame:
    parts = participants(stream).where(F.col("descripcion").contains("steal") & (F.col("role") == 2))
    return parts.groupBy("game_id", "jugador").agg(F.count(F.lit(1)).alias("Robos_Exitosos"))
