"""Wire sources to builders: every dimension and the fact, built lazily once.

``Warehouse(spark, sf_dir)`` reads the driver tables through the adapter;
``Warehouse.from_frames`` accepts any DataFrames with the source shapes
(e.g. the real CSV exports read by ``sources.csv``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from courtside.operators.keys import number_rows
from courtside.plans import dims, fact
from courtside.sources.adapter import Sources


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None, frames: dict | None = None,
                 fold_game_alias: bool = True, widen_calendar: bool = False, keys=None):
        """``fold_game_alias=False`` keeps the source jobs' behaviour of folding the
        all-star alias on the league side only (such games get no league key).
        ``widen_calendar=True`` adds the games' own dates to the fixed calendar span.
        ``keys``: a ``releases.KeyStore`` whose ids go on; without it every build numbers anew."""
        self.spark = spark
        self.widen_calendar = widen_calendar
        self.fold_game_alias = fold_game_alias
        self.number = keys.number if keys else number_rows
        self._src = Sources(spark, sf_dir) if sf_dir else None
        self._frames = dict(frames or {})

    @classmethod
    def from_frames(cls, spark: SparkSession, fold_game_alias: bool = True, keys=None, **frames: DataFrame) -> "Warehouse":
        return cls(spark, None, frames, fold_game_alias, keys=keys)

    def src(self, name: str) -> DataFrame:
        if name in self._frames:
            return self._frames[name]
        if self._src is None:
            raise KeyError(f"source {name!r} not given")
        return getattr(self._src, name)

    # dimensions --------------------------------------------------------------
    @cached_property
    def referee(self) -> DataFrame:
        return dims.referee_dim(self.src("officials"), self.number)

    @cached_property
    def league(self) -> DataFrame:
        return dims.league_dim(self.src("games"), self.number)

    @cached_property
    def calendar(self) -> DataFrame:
        return dims.calendar_dim(self.spark, games=self.src("games") if self.widen_calendar else None)

    @cached_property
    def venue(self) -> DataFrame:
        return dims.venue_dim(self.src("teams"), self.src("team_details"), self.src("team_list"), self.number)

    @cached_property
    def team(self) -> DataFrame:
        return dims.team_dim(self.src("teams"), self.src("team_details"), self.src("team_history"),
                             self.src("team_list"), self.number)

    @cached_property
    def player(self) -> DataFrame:
        return dims.player_dim(self.src("plays"), self.src("player_info"), self.src("player_profile"),
                               self.src("inactive_players"), self.src("draft_combine"), self.number)

    def prepare(self, names=("referee", "league", "team", "venue", "player"), threads: int = 5) -> None:
        """Build independent dimensions concurrently (their jobs overlap on the cluster)."""
        todo = [n for n in names if n not in self.__dict__]
        if len(todo) <= 1 or threads <= 1:
            for n in todo:
                getattr(self, n)
            return
        with ThreadPoolExecutor(max_workers=min(threads, len(todo))) as pool:
            for f in [pool.submit(getattr, self, n) for n in todo]:
                f.result()

    # fact --------------------------------------------------------------------
    @cached_property
    def header(self) -> DataFrame:
        self.prepare(("referee", "league", "team", "venue"))
        return fact.game_header(self.src("games"), self.src("officials"), self.referee, self.league,
                                self.calendar, self.team, self.venue, fold_game_alias=self.fold_game_alias)

    @cached_property
    def partido(self) -> DataFrame:
        self.prepare()
        return fact.fact_partido(self.src("plays"), self.header, self.player, number=self.number)

    def tables(self) -> dict[str, DataFrame]:
        """All output tables by contract name."""
        self.prepare()
        return {"equipo": self.team, "arbitro": self.referee, "liga": self.league, "fecha": self.calendar,
                "ubicacion": self.venue, "jugador": self.player, "partido": self.partido}
