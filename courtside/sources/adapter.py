"""Shape the driver's TPC-H-like tables into the sports sources the builders read.

The basketball exports (play_by_play, game, officials, team, ...) are not
available, so every source is *derived* from the driver tables and grows
with them: plays from ``lineitem`` (one play per line item), games from
``orders``, officials and team history from ``customer``, the player
directory from ``supplier`` and player attributes from ``part``.

Each source is one SELECT in the common subset of Spark SQL and DuckDB, so
the very same text feeds the Spark builders (``spark.sql`` with DataFrame
parameters, no global views) and the DuckDB oracle (as CTEs).  The
adapter only shapes inputs; every operator under test is written with the
DataFrame API in ``courtside.plans`` and checked against independent SQL.

Numeric attributes that arrive as text in the original CSV exports are
produced as strings here, including non-numeric markers, so the builders'
ANSI-safe parsing is exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from courtside.operators.lookup import broadcast_bound, fits_broadcast
from courtside.sources.schemas import driver_schema

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Play description templates by play code (l_partkey modulo
# their number); every classifier has a template it fires on.  @1 @2 @3 stand
# for the names in player slots 1..3, @o and @d for counters that rise with
# the line number.
PLAY_TEMPLATES = {
    0: "Jump Ball @1 vs. @2: Tip to @3",
    1: "@1 Driving Layup (2 PTS)",
    2: "@1 24' 3PT Jump Shot (3 PTS) (@2 1 AST)",
    3: "@2 STEAL (1 STL)",
    4: "MISS @1 5' Dunk @3 BLOCK (1 BLK)",
    5: "MISS @1 27' 3PT Jump Shot",
    6: "@1 Free Throw 1 of 2 (5 PTS)",
    7: "MISS @1 Free Throw 2 of 2",
    8: "@1 REBOUND (Off:@o Def:@d)",
    9: "SUB: @2 FOR @1",
    10: "@1 Offensive Foul Turnover (P1.T1)",
    11: "@1 S.FOUL (P1.PN)",
    12: "@1 Bad Pass, Lost Ball Turnover (P1.T1)",
    13: "@1 Timeout: Regular (Full 1 Short 0)",
    14: "@1 P.FOUL (P2.T3)",
    15: "@1 L.B.FOUL (P1.PN)",
    16: "@1 T.FOUL (P0.T1)",
    17: "@1 FLAGRANT.FOUL.TYPE1 (P3.PN)",
    18: "@1 OFF.Foul (P2)",
    19: "MISS @1 Layup @2 STEAL (2 STL)",
    20: "@1 Defensive Rebound - Team",
    21: "@1 Offensive Rebound – Team",
    22: "@1 \"Alley Oop\" Dunk, Putback (2 PTS)",
}
# Play codes whose plays carry a second / third participant.
SLOT2_CODES = (0, 1, 2, 3, 9, 19)
SLOT3_CODES = (0, 4)

# Season types by order priority; both spellings of the
# all-star label occur on purpose.
SEASON_BY_PRIORITY = {
    "1-URGENT": "Regular Season",
    "2-HIGH": "Playoffs",
    "3-MEDIUM": "All Star",
    "4-NOT SPECIFIED": "All-Star",
    "5-LOW": "Pre Season",
}

# Position codes (as found in the player exports) handed out by part key,
# plus the empty string and NULL.
POSITION_CODES = ("PG", "SG", "SF", "PF", "C", "PG-SG", "SG-PG", "SG-SF", "SF-SG", "SF-PF", "PF-SF",
                  "PF-C", "C-PF", "Guard", "Forward", "Center", "Guard-Forward", "Forward-Guard",
                  "Center-Forward", "Forward-Center")


def sql_literal(text: str) -> str:
    """A string literal both dialects read alike (quotes via chr(39))."""
    parts = [f"'{p}'" for p in text.split("'")]
    return parts[0] if len(parts) == 1 else "concat(" + ", chr(39), ".join(parts) + ")"


def _case(expr: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {sql_literal(k) if isinstance(k, str) else k} THEN {sql_literal(v)}"
                     for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {default} END"


def _description_sql() -> str:
    text = _case(f"l.l_partkey % {len(PLAY_TEMPLATES)}", PLAY_TEMPLATES)
    text = f"replace({text}, '@o', cast(l.l_linenumber - 1 AS STRING))"
    text = f"replace({text}, '@d', cast(2 * l.l_linenumber - 1 AS STRING))"
    text = f"replace({text}, '@1', coalesce(p1.player_name, ''))"
    text = f"replace({text}, '@2', coalesce(p2.player_name, ''))"
    return f"replace({text}, '@3', coalesce(p3.player_name, ''))"


def _position_sql(key: str) -> str:
    mapping = {i: code for i, code in enumerate(POSITION_CODES)}
    mapping[len(POSITION_CODES)] = ""
    return _case(f"{key} % {len(POSITION_CODES) + 2}", mapping)


def _slot(n: int, codes: tuple | None) -> str:
    cols = []
    for src, dst in (("player_id", "id"), ("player_name", "name"), ("team_city", "team_city"),
                     ("team_nickname", "team_nickname")):
        ref = f"p{n}.{src}"
        if codes is not None:
            ref = f"CASE WHEN l.l_partkey % {len(PLAY_TEMPLATES)} IN ({', '.join(map(str, codes))}) THEN {ref} END"
        cols.append(f"{ref} AS player{n}_{dst}")
    return ", ".join(cols)


# Source name -> (SELECT text, tables/sources it reads).
SOURCES: dict[str, tuple[str, tuple[str, ...]]] = {
    # Player directory: one player per supplier, named 'Supplier 000000042'
    # (two name fragments); negative balances get a padded upper-case
    # spelling so name normalisation matters.
    "player_directory": (
        """SELECT s.s_suppkey AS player_id,
       CASE WHEN s.s_acctbal < 0 THEN concat('  ', upper(replace(s.s_name, '#', ' ')), ' ')
            ELSE replace(s.s_name, '#', ' ') END AS player_name,
       n.n_name AS team_city,
       CASE WHEN s.s_acctbal < 500 THEN NULL ELSE r.r_name END AS team_nickname
FROM {supplier} s
JOIN {nation} n ON n.n_nationkey = s.s_nationkey
JOIN {region} r ON r.r_regionkey = n.n_regionkey""",
        ("supplier", "nation", "region")),
    # play_by_play: one play per line item.
    "plays": (
        f"""SELECT l.l_orderkey AS game_id, l.l_linenumber AS eventnum,
       {_slot(1, None)},
       {_slot(2, SLOT2_CODES)},
       {_slot(3, SLOT3_CODES)},
       CASE WHEN l.l_linestatus = 'O' THEN {_description_sql()} END AS homedescription,
       CASE WHEN l.l_linestatus <> 'O' THEN {_description_sql()} END AS visitordescription
FROM {{lineitem}} l
LEFT JOIN {{player_directory}} p1 ON p1.player_id = l.l_suppkey
LEFT JOIN {{player_directory}} p2 ON p2.player_id = l.l_suppkey + 7
LEFT JOIN {{player_directory}} p3 ON p3.player_id = l.l_suppkey + 13""",
        ("lineitem", "player_directory")),
    # team.csv: one franchise per nation.
    "teams": (
        """SELECT n.n_nationkey AS id, r.r_name AS nickname, n.n_name AS city,
       concat('State ', cast(n.n_regionkey AS STRING)) AS state
FROM {nation} n JOIN {region} r ON r.r_regionkey = n.n_regionkey""",
        ("nation", "region")),
    # team_details.csv: arena and capacity text (some unknown).
    "team_details": (
        """SELECT n.n_nationkey AS team_id, concat('Arena ', n.n_name) AS arena,
       CASE WHEN n.n_nationkey % 6 = 5 THEN 'Desconocido'
            ELSE concat(cast(4000 + n.n_nationkey * 900 AS STRING), '.0') END AS arenacapacity
FROM {nation} n""",
        ("nation",)),
    # team_history.csv: many rows per team, one per customer.
    "team_history": (
        """SELECT c.c_nationkey AS team_id, cast(2000 + c.c_custkey % 20 AS STRING) AS year_active_till
FROM {customer} c""",
        ("customer",)),
    # Datos_equipos.csv: hand-kept team/venue list; overlaps the franchise
    # list for two market segments.
    "team_list": (
        """SELECT concat(n.n_name, ' ', CASE WHEN c.c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN r.r_name
                                     ELSE c.c_mktsegment END) AS Equipo,
       n.n_name AS Ciudad, concat('State ', cast(n.n_regionkey AS STRING)) AS Estado,
       CASE WHEN c.c_mktsegment = 'MACHINERY' THEN concat('Hall ', n.n_name) ELSE concat('Arena ', n.n_name) END AS Arena,
       CASE WHEN max(c.c_acctbal) > 9900 THEN '1' ELSE '0' END AS Activo,
       CASE WHEN c.c_mktsegment = 'FURNITURE' THEN 'Desconocido'
            ELSE concat(cast(count(*) * 40 AS STRING), '.0') END AS Capacidad
FROM {customer} c
JOIN {nation} n ON n.n_nationkey = c.c_nationkey
JOIN {region} r ON r.r_regionkey = n.n_regionkey
GROUP BY n.n_name, n.n_regionkey, r.r_name, c.c_mktsegment""",
        ("customer", "nation", "region")),
    # game.csv: one game per order; home team = customer's nation, away
    # team = another nation; a few dates are unparseable.
    "games": (
        f"""SELECT o.o_orderkey AS game_id,
       {_case('o.o_orderpriority', SEASON_BY_PRIORITY)} AS season_type,
       CASE WHEN o.o_totalprice < 1000 THEN 'not a date' ELSE cast(o.o_orderdate AS STRING) END AS game_date,
       concat(hn.n_name, ' ', hr.r_name) AS team_name_home,
       concat(an.n_name, ' ', ar.r_name) AS team_name_away
FROM {{orders}} o
LEFT JOIN {{customer}} c ON c.c_custkey = o.o_custkey
LEFT JOIN {{nation}} hn ON hn.n_nationkey = c.c_nationkey
LEFT JOIN {{region}} hr ON hr.r_regionkey = hn.n_regionkey
LEFT JOIN {{nation}} an ON an.n_nationkey = (c.c_nationkey + 1 + o.o_orderkey % 23) % 25
LEFT JOIN {{region}} ar ON ar.r_regionkey = an.n_regionkey""",
        ("orders", "customer", "nation", "region")),
    # officials.csv: two officials per game, drawn from customers.
    "officials": (
        """SELECT o.o_orderkey AS game_id, c.c_custkey AS official_id,
       c.c_mktsegment AS first_name, c.c_name AS last_name
FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey
UNION ALL
SELECT o.o_orderkey AS game_id, c.c_custkey AS official_id,
       c.c_mktsegment AS first_name, c.c_name AS last_name
FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey + 1""",
        ("orders", "customer")),
    # player.csv
    "player_info": (
        """SELECT CASE WHEN s.s_acctbal > 500 THEN s.s_suppkey ELSE -s.s_suppkey END AS id, s.s_name AS full_name,
       CASE WHEN s.s_acctbal > 5000 THEN '1' ELSE '0' END AS is_active
FROM {supplier} s""",
        ("supplier",)),
    # inactive_players.csv
    "inactive_players": (
        """SELECT CASE WHEN s.s_acctbal < 0 THEN s.s_suppkey ELSE -s.s_suppkey END AS player_id, 'Ex' AS first_name, s.s_name AS last_name,
       'Old Town' AS team_city, 'Veterans' AS team_name
FROM {supplier} s""",
        ("supplier",)),
    # common_player_info.csv
    "player_profile": (
        f"""SELECT CASE WHEN p.p_retailprice < 990 THEN p.p_partkey ELSE -p.p_partkey END AS person_id, p.p_name AS display_first_last, p.p_brand AS school,
       p.p_type AS country, cast(150 + p.p_size * 3 AS STRING) AS weight,
       {_position_sql('p.p_partkey')} AS position,
       cast(1950 + p.p_size AS STRING) AS from_year,
       CASE WHEN p.p_size = 7 THEN NULL ELSE cast(1950 + p.p_size + p.p_partkey % 41 AS STRING) END AS to_year
FROM {{part}} p""",
        ("part",)),
    # draft_combine_stats.csv
    "draft_combine": (
        f"""SELECT CASE WHEN p.p_size > 10 THEN p.p_partkey ELSE -p.p_partkey END AS player_id, upper(p.p_name) AS player_name,
       {_position_sql('p.p_partkey + 5')} AS position,
       CASE WHEN p.p_partkey % 2 = 0 THEN concat(cast(66 + p.p_size % 20 AS STRING), '.5')
            ELSE cast(66 + p.p_size % 20 AS STRING) END AS height_wo_shoes,
       cast(70 + p.p_size % 25 AS STRING) AS wingspan,
       CASE WHEN p.p_size = 13 THEN 'n/a' ELSE cast(120 + p.p_size * 4 AS STRING) END AS weight,
       cast(85 + p.p_size % 35 AS STRING) AS standing_reach
FROM {{part}} p""",
        ("part",)),
}


# Sources joined by key into larger ones -> the table bounding their row
# count (joins to unique keys only); broadcast only below a proven bound.
LOOKUP_SOURCES = {"player_directory": "supplier"}


def _order(names) -> list[str]:
    """Dependencies first, each source once."""
    out: list[str] = []

    def visit(n):
        if n in out or n in DRIVER_TABLES:
            return
        for dep in SOURCES[n][1]:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(driver_schema(name)).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str, name: str, _memo: dict | None = None) -> DataFrame:
    """Build adapter source ``name`` (or read driver table ``name``) as a DataFrame."""
    memo = {} if _memo is None else _memo
    if name in memo:
        return memo[name]
    if name in DRIVER_TABLES:
        df = read_table(spark, sf_dir, name)
    else:
        text, deps = SOURCES[name]
        args = {d: source(spark, sf_dir, d, memo) for d in deps}
        for d in deps:
            if d in LOOKUP_SOURCES:
                # The joined source is measured; the table that bounds it gates that job.
                bound_by = source(spark, sf_dir, LOOKUP_SOURCES[d], memo)
                if fits_broadcast(args[d], broadcast_bound(bound_by), bound_by):
                    args[d] = F.broadcast(args[d])
        df = spark.sql(text, **args)
    memo[name] = df
    return df


class Sources:
    """Lazy accessor: ``Sources(spark, sf_dir).plays`` etc.; each built once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._memo = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in SOURCES and name not in DRIVER_TABLES):
            raise AttributeError(name)
        return source(self.spark, self.sf_dir, name, self._memo)


def oracle_with(names, body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """DuckDB text: the named adapter sources as CTEs, then ``extra`` CTEs, then ``body``."""
    ctes = []
    for n in _order(names):
        text, deps = SOURCES[n]
        ctes.append(f"{n} AS (\n{text.format(**{d: d for d in deps})}\n)")
    for n, text in extra or []:
        ctes.append(f"{n} AS (\n{text}\n)")
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
