"""Build every table once and store it under the contracts.

    python -m courtside.plans.runner --sf-dir /root/testdata/sf0.01 --database stats
    python -m courtside.plans.runner --exports /data/exports --database stats --location /shared/warehouse
    python -m courtside.plans.runner --exports /data/exports --releases /shared/stats --quarantine /shared/rejects

Reads the sources (driver tables through the adapter, or the raw CSV
exports), builds dimensions first and the fact from them, checks keys
(primary keys unique, fact keys present in their dimensions), counts missing
keys and too long texts, and writes each table once: dimensions overwrite existing contract tables by
position, the fact replaces its table (partitioned by nothing; set
``--partition-fact`` to partition it by league).

With ``--releases`` the tables become one load of a ``Releases`` folder instead:
staged, checked, and committed only without violations; ids go on from the
load before.  ``--quarantine`` stores the lines of the exports that are no
records; their numbers are reported either way.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.operators.quality import dq_not_null, dq_primary_key
from courtside.plans.releases import KeyStore, Releases
from courtside.plans.warehouse import Warehouse
from courtside.sources.files import create_contract_tables, insert_overwrite, land_exports, quarantine, replace_table
from courtside.sources.schemas import CONTRACT_DDL

DIM_KEYS = {"equipo": "idEquipo", "arbitro": "idArbitro", "liga": "idLiga", "fecha": "idFecha",
            "ubicacion": "idUbicacion", "jugador": "idJugador"}
FACT_REFS = {"idEquipo_Local": "equipo", "idEquipo_Visitante": "equipo", "idArbitro": "arbitro", "idLiga": "liga",
             "idFecha": "fecha", "idUbicacion": "ubicacion", "idJugador": "jugador"}
# Text limits of the contract; every other text has 45 characters.
TEXT_LIMIT = 45
OTHER_LIMITS = {("fecha", "temporada"): 20, ("jugador", "equipo"): 90}


def reference_uses(fact: DataFrame, tables: dict) -> DataFrame:
    """(ref, nulls, lost): rows of the fact per reference without a key, and with one its dimension lacks; one scan of the fact.

    The keys of all references are unpivoted and counted per distinct key
    (combined map-side), so what meets the dimensions is bounded by them.
    """
    pairs = [F.struct(F.lit(c).alias("ref"), F.lit(d).alias("dim"), F.col(c).alias("key")) for c, d in FACT_REFS.items()]
    used = fact.select(F.inline(F.array(*pairs))).groupBy("ref", "dim", "key").agg(F.count(F.lit(1)).alias("n"))
    known = None
    for d, k in DIM_KEYS.items():
        one = tables[d].select(F.lit(d).alias("dim"), F.col(k).alias("key"))
        known = one if known is None else known.unionByName(one)
    met = used.join(known.distinct().withColumn("known", F.lit(True)), ["dim", "key"], "left")
    null = F.col("key").isNull()
    return met.groupBy("ref").agg(F.sum(F.when(null, F.col("n")).otherwise(F.lit(0))).alias("nulls"),
                                  F.sum(F.when(~null & F.col("known").isNull(), F.col("n")).otherwise(F.lit(0))).alias("lost"))


def dangling_keys(fact: DataFrame, tables: dict) -> dict[str, int]:
    """Fact rows per reference whose key its dimension lacks."""
    found = {r["ref"]: r["lost"] for r in reference_uses(fact, tables).collect()}  # at most one row per reference
    return {c: found.get(c, 0) for c in FACT_REFS}


def contract_report(tables: dict) -> dict[str, int]:
    """Missing mandatory keys and texts over their limit, one aggregation per table."""
    out = {}
    for t, df in tables.items():
        keys = [DIM_KEYS[t]] if t in DIM_KEYS else ["idPartido", *FACT_REFS]
        out |= {f"nn_{t}_{k}": v for k, v in zip(keys, dq_not_null(df, keys).first())}
        texts = [c for c, kind in df.dtypes if kind == "string"]
        if texts:
            over = [F.count_if(F.length(c) > OTHER_LIMITS.get((t, c), TEXT_LIMIT)) for c in texts]
            out |= {f"len_{t}_{c}": v for c, v in zip(texts, df.agg(*over).first())}
    return out


def quality_report(tables: dict) -> dict[str, int]:
    """Violation counts: duplicate keys per table and dangling fact keys."""
    out = {}
    for t, k in DIM_KEYS.items():
        out[f"pk_{t}"] = dq_primary_key(tables[t], [k]).count()
    out["pk_partido"] = dq_primary_key(tables["partido"], ["idPartido", "idJugador"]).count()
    return out | {f"fk_{c}": n for c, n in dangling_keys(tables["partido"], tables).items()}


def contract_checks(tables: dict) -> DataFrame:
    """(control, violaciones): every check of ``quality_report`` and ``contract_report`` as one frame, nothing run yet."""
    def total(df, name):
        return df.agg(F.count(F.lit(1)).alias("violaciones")).select(F.lit(name).alias("control"), "violaciones")

    def each(df, columns):
        return df.select(F.inline(F.array(*[F.struct(F.lit(n).alias("control"), F.col(c).alias("violaciones")) for n, c in columns.items()])))

    parts = [total(dq_primary_key(tables[t], [k]), f"pk_{t}") for t, k in DIM_KEYS.items()]
    # The fact is read twice: its key groups, and its references counted per key.
    groups = tables["partido"].groupBy("idPartido", "idJugador").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count_if(F.col("n") > 1).alias("twice"), F.coalesce(F.sum(F.when(F.col("idPartido").isNull(), F.col("n"))), F.lit(0)).alias("none"))
    parts.append(each(groups, {"pk_partido": "twice", "nn_partido_idPartido": "none"}))
    uses = reference_uses(tables["partido"], tables).agg(*[
        F.coalesce(F.sum(F.when(F.col("ref") == c, F.col(n))), F.lit(0)).alias(f"{n}_{c}") for c in FACT_REFS for n in ("lost", "nulls")])
    parts.append(each(uses, {f"{check}_{c}": f"{n}_{c}" for check, n in (("fk", "lost"), ("nn_partido", "nulls")) for c in FACT_REFS}))
    for t, df in tables.items():
        if t in DIM_KEYS:
            k = DIM_KEYS[t]
            parts.append(each(df.agg(F.coalesce(F.sum(F.col(k).isNull().cast("long")), F.lit(0)).alias(k)), {f"nn_{t}_{k}": k}))
        texts = [c for c, kind in df.dtypes if kind == "string"]
        if texts:
            over = df.agg(*[F.count_if(F.length(c) > OTHER_LIMITS.get((t, c), TEXT_LIMIT)).alias(c) for c in texts])
            parts.append(each(over, {f"len_{t}_{c}": c for c in texts}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_and_store(spark: SparkSession, wh: Warehouse, database: str, location: str | None = None,
                    partition_fact: bool = False, check: bool = True) -> dict[str, int]:
    tables = wh.tables()
    create_contract_tables(spark, database, location, [t for t in tables if t != "partido"])
    for name, df in tables.items():
        if name == "partido":
            replace_table(df, f"{database}.partido", partition_by=["idLiga"] if partition_fact else ())
        else:
            insert_overwrite(df, f"{database}.{name}")
    if not check:
        return {}
    stored = {t: spark.table(f"{database}.{t}") for t in tables}
    return quality_report(stored)


def load_release(spark: SparkSession, location: str, warehouse: Callable[[KeyStore], Warehouse], partition_fact: bool = False) -> dict[str, int]:
    """Build with the keys of the current load, stage, check, commit; the report.

    Raises before the commit when a check fails, so the current load stays.
    """
    releases = Releases(spark, location)
    keys = releases.keys()
    tables = warehouse(keys).tables()
    load = releases.stage(tables, keys, {"partido": ["idLiga"]} if partition_fact else None)
    report = quality_report({t: releases.table(t, load) for t in tables})
    bad = {k: v for k, v in report.items() if v}
    if bad:
        raise ValueError(f"load {load} is not committed: {bad}")
    releases.commit(load)
    return report


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir")
    src.add_argument("--exports")
    ap.add_argument("--database", default="mydb")
    ap.add_argument("--location")
    ap.add_argument("--partition-fact", action="store_true")
    ap.add_argument("--league-alias-dimension-only", action="store_true",
                    help="fold the all-star alias on the league side only, as the source jobs did")
    ap.add_argument("--releases", help="folder of loads that become visible whole, with lasting keys")
    ap.add_argument("--quarantine", help="where the exports' lines that are no records go")
    ap.add_argument("--multi-line", action="store_true", help="values of the exports may have quoted line ends")
    args = ap.parse_args(argv)

    from courtside.session import get_spark

    spark = get_spark()
    fold = not args.league_alias_dimension_only
    landed = {} if args.sf_dir else land_exports(spark, args.exports, args.multi_line)

    def warehouse(keys: KeyStore | None = None) -> Warehouse:
        if args.sf_dir:
            return Warehouse(spark, args.sf_dir, fold_game_alias=fold, keys=keys)
        return Warehouse.from_frames(spark, fold, keys, **{n: landing.rows for n, landing in landed.items()})

    if args.quarantine and landed:
        rejected = quarantine(landed, args.quarantine)
    else:
        rejected = {n: landing.rejects.count() for n, landing in landed.items()}
    for n, k in rejected.items():
        print(f"rejected_{n}\t{k}")
    if args.releases:
        report = load_release(spark, args.releases, warehouse, args.partition_fact)
        releases = Releases(spark, args.releases)
        stored = {t: releases.table(t) for t in CONTRACT_DDL}
    else:
        report = build_and_store(spark, warehouse(), args.database, args.location, args.partition_fact)
        stored = {t: spark.table(f"{args.database}.{t}") for t in CONTRACT_DDL}
    # Missing keys and long texts are reported only: the sources have games without a parseable date.
    for k, v in (report | contract_report(stored)).items():
        print(f"{k}\t{v}")
    bad = {k: v for k, v in report.items() if v}
    spark.createDataFrame([(k, v) for k, v in report.items()], "check string, violations long") \
        .where(F.col("violations") > 0).show(truncate=False)
    if bad:
        raise SystemExit(1)


if __name__ == "__main__":
    main()
