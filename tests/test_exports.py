"""End to end from raw CSV exports (every column text) with edge rows."""

import csv
import os
import tempfile

import pytest

from courtside.plans.warehouse import Warehouse
from courtside.sources.files import read_exports
from courtside.sources.schemas import RAW_CSV_COLUMNS

ROWS = {
    "play_by_play": [
        # game, event, p1 id/name/city/nick, p2 ..., p3 ..., home, visitor
        ["0029600012", "1", "1", "Carroll", "Boston", "Celtics", "2", "Mark Morris", "Phoenix", "Suns",
         "3", " frye ", "Phoenix", "Suns", "Jump Ball Carroll vs. Mark Morris: Tip to Frye", ""],
        ["0029600012", "2", "1", "Carroll", "Boston", "Celtics", "", "", "", "", "", "", "", "",
         "Carroll REBOUND (Off:0 Def:1)", ""],
        ["0029600012", "3", "2", "Mark Morris", "Phoenix", "Suns", "1", "Carroll", "Boston", "Celtics",
         "", "", "", "", "", "Mark Morris 24' 3PT Jump Shot (3 PTS) (Carroll 1 AST)"],
        ["0029600012", "4", "3", "Frye", "Phoenix", "Suns", "", "", "", "", "1", "CARROLL ", "Boston", "Celtics",
         "", "MISS Frye 5' Dunk Carroll BLOCK (1 BLK)"],
        ["0029600013", "1", "", "", "", "", "", "", "", "", "", "", "", "", "Celtics Timeout: Regular", ""],
    ],
    "game": [["0029600012", "All Star", "1997-01-15 00:00:00", "Boston Celtics", "Phoenix Suns"],
             ["0029600013", "Regular Season", "not a date", "Phoenix Suns", "Boston Celtics"]],
    "officials": [["0029600012", "10", "Joey", "Crawford"], ["0029600012", "11", "Dick", "Bavetta"],
                  ["0029600013", "10", "Joey", "Crawford"]],
    "team": [["100", "Celtics", "Boston", "Massachusetts"], ["101", "Suns", "Phoenix", "Arizona"]],
    "team_details": [["100", "TD Garden", "18624.0"], ["101", "Footprint Center", ""]],
    "team_history": [["100", "2019"], ["100", "1990"], ["101", "2019.0"]],
    "player": [["1", "Carroll", "1"], ["2", "Mark Morris", "0"]],
    "common_player_info": [["1", "Joe Carroll", "Purdue", "USA", "215", "C-PF", "1980", "1991"],
                           ["3", "Channing Frye", "Arizona", "USA", "255", "", "2005", "2019"]],
    "inactive_players": [["2", "Mark", "Morris", "Phoenix", "Suns"]],
    "draft_combine_stats": [["3", "Channing Frye", "PF", "82.5", "86.0", "248", "108"],
                            ["2", "Mark Morris", "PF", "74.5", "", "Desconocido", "90"]],
    "Datos_equipos": [["Boston Celtics", "Boston", "Massachusetts", "TD Garden", "1", "18624.0"],
                      ["Phoenix Suns", "Phoenix", "Arizona", "Footprint Center", "1", "Desconocido"],
                      ["St. Louis Bombers", "St. Louis", "Missouri", "St. Louis Arena", "0", "9500.0"]],
}


@pytest.fixture(scope="module")
def exports():
    d = tempfile.mkdtemp(prefix="courtside-exports-")
    for name, rows in ROWS.items():
        with open(os.path.join(d, f"{name}.csv"), "w", newline="") as f:
            w = csv.writer(f)
            w.writerow(RAW_CSV_COLUMNS[name])
            w.writerows(rows)
    return d


def test_build_from_exports(spark, exports):
    wh = Warehouse.from_frames(spark, **read_exports(spark, exports))
    team = {r["nombre"]: r for r in wh.team.collect()}
    assert team["Boston Celtics"]["estado_actual"] == 1 and team["Phoenix Suns"]["estado_actual"] == 1
    assert team["St. Louis Bombers"]["arena"] == "St. Louis Arena"
    venue = {r["arena"]: r["capacidad"] for r in wh.venue.collect()}
    assert venue["TD Garden"] == "mediano" and venue["Footprint Center"] == "grande"
    assert venue["St. Louis Arena"] == "pequeno"
    assert sorted(r["nombre"] for r in wh.league.collect()) == ["All-Star", "Regular Season"]
    refs = sorted((r["idArbitro"], r["nombre"]) for r in wh.referee.collect())
    assert refs == [(1, "Joey Crawford"), (2, "Dick Bavetta")]
    players = {r["nombre"].strip().lower(): r for r in wh.player.collect()}
    # one id seen as 'Carroll' and 'CARROLL ': the first spelling in byte order is kept
    assert {r["nombre"] for r in wh.player.collect()} >= {"CARROLL ", "Mark Morris", " frye "}
    assert players["carroll"]["posicion"] == "Pívot/Ala-pívot"
    assert players["mark morris"]["altura"] == "Desconocido"      # 74.5 in = 1.8923 m falls in the gap
    assert players["mark morris"]["estado_actual"] == 0
    fact = wh.partido.collect()
    assert {r["idPartido"] for r in fact} == {1}                   # the second game has no named players
    by_player = {r["idJugador"]: r for r in fact}
    carroll = by_player[players["carroll"]["idJugador"]]
    assert carroll["Saques_Exitosos"] == 1 and carroll["Tiros_Bloqueados"] == 1
    assert carroll["idLiga"] is not None and carroll["idFecha"] is not None
    assert carroll["idArbitro"] == 1                               # smallest of the two officials
    morris = by_player[players["mark morris"]["idJugador"]]
    # 3 for the triple + 2 because the jump-ball text names "Carroll" and 'roll'
    # counts as a made two for every participant (source behaviour, kept)
    assert morris["Puntos_Totales"] == 5 and morris["Saques_Fallidos"] == 1


def test_league_alias_source_behaviour(spark, exports):
    frames = read_exports(spark, exports)
    folded = Warehouse.from_frames(spark, **frames).partido.select("idLiga").distinct().collect()
    source = Warehouse.from_frames(spark, False, **frames).partido.select("idLiga").distinct().collect()
    assert [r[0] for r in folded] != [None]          # 'All Star' game finds 'All-Star'
    assert [r[0] for r in source] == [None]          # source behaviour: no league key
