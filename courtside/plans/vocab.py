"""Vocabulary jobs: team names, positions, entity dictionary, play types.

All distributed: values are unpivoted, deduplicated and written by Spark
(``sources.files.write_csv``); nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.functions import cleaning as C
from courtside.operators.keys import number_rows
from courtside.operators.lookup import checked_broadcast
from courtside.operators.materialize import materialize
from courtside.operators.unpivot import stack_columns, unpivot_groups


def name_vocabulary(games: DataFrame) -> DataFrame:
    """Distinct team names over home and away (NULL kept once)."""
    return stack_columns(games, ["team_name_home", "team_name_away"], "nombre").distinct()


def position_vocabulary(draft: DataFrame, profile: DataFrame) -> DataFrame:
    """Distinct positions of each source, concatenated (UNION ALL)."""
    return (draft.select("position").distinct()
            .unionByName(profile.select("position").distinct()))


def entity_dictionary(plays: DataFrame) -> DataFrame:
    """(tipo, valor): distinct non-NULL player names ('jugador') and team nicknames ('equipo')."""
    cells = [F.struct(F.lit(tipo).alias("tipo"), F.col(f"player{i}_{c}").alias("valor"))
             for i in (1, 2, 3) for tipo, c in (("jugador", "name"), ("equipo", "team_nickname"))]
    return plays.select(F.inline(F.array(*cells))).where(F.col("valor").isNotNull()).distinct()


def play_types(plays: DataFrame) -> DataFrame:
    """(idJugada, descripcion_limpia, descripcion): distinct play types.

    Descriptions of plays with a first player; names, nicknames (as written
    and upper-cased), parenthesised notes, distances, initials,
    abbreviations and "N of M" removed; only descriptions that mention a
    name fragment (case-insensitive whole token) are kept; alias and
    style words removed; one row per cleaned text with its smallest
    original; ids in cleaned-text order.
    """
    # Distinct name fragments and nicknames from one scan of the plays: small, read several times.
    player = F.col("tipo") == "jugador"
    entries = F.when(player, C.name_parts(F.col("valor"))).otherwise(F.array("valor"))
    vocab = materialize(entity_dictionary(plays).select("tipo", F.explode(entries).alias("entry")).distinct(), "vocabulary")
    frags = vocab.where(player).select("entry")
    nicks = vocab.where(~player).select("entry")
    dictionary = frags.unionByName(nicks).unionByName(nicks.select(F.upper("entry").alias("entry"))).distinct()

    descs = unpivot_groups(plays.where(F.col("player1_name").isNotNull()), [],
                           [{"descripcion": "homedescription"}, {"descripcion": "visitordescription"}])
    descs = descs.where(F.col("descripcion").isNotNull()).distinct()

    # Keep descriptions mentioning a fragment (lower-case \w+ tokens).
    lower_frags = frags.select(F.lower("entry").alias("tok")).distinct()
    toks = descs.select("descripcion", F.explode(F.regexp_extract_all(F.lower("descripcion"), F.lit(r"(?U)\w+"), 0))
                        .alias("tok"))
    named = toks.join(checked_broadcast(lower_frags), "tok", "left_semi").select("descripcion").distinct()

    stripped = C.remove_entries(named, "descripcion", dictionary, "_s")
    cleaned = stripped.select(
        "descripcion",
        C.final_tidy(C.drop_words(C.drop_words(C.tidy(F.col("_s")), C.ALIAS_WORDS), C.STYLE_WORDS))
        .alias("descripcion_limpia"))
    best = cleaned.groupBy("descripcion_limpia").agg(F.min("descripcion").alias("descripcion"))
    return number_rows(best, ["descripcion_limpia"], "idJugada").select("idJugada", "descripcion_limpia",
                                                                      "descripcion")
