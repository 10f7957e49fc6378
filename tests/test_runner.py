"""The build-and-store job: seven contract tables written, read back and checked."""

import uuid

import pytest

from courtside.plans.runner import build_and_store, contract_report, dangling_keys
from courtside.plans.warehouse import Warehouse
from courtside.sources.schemas import CONTRACT_DDL, contract


@pytest.mark.parametrize("partitioned", [False, True])
def test_all_tables_stored_under_their_contracts(spark, sf_small, partitioned):
    db = f"store_{uuid.uuid4().hex[:8]}"
    wh = Warehouse(spark, sf_small)
    report = build_and_store(spark, wh, db, partition_fact=partitioned)
    try:
        assert report and not any(report.values()), report
        stored = {t: spark.table(f"{db}.{t}") for t in CONTRACT_DDL}
        for t, df in stored.items():
            want = {f.name: f.dataType for f in contract(t).fields}
            assert {f.name: f.dataType for f in df.schema.fields} == want, t
            assert df.count() == wh.tables()[t].count() > 0, t
        if partitioned:
            assert [c.name for c in spark.catalog.listColumns("partido", db) if c.isPartition] == ["idLiga"]
        more = contract_report(stored)
        assert len([k for k in more if k.startswith("nn_partido")]) == 8
        assert not any(v for k, v in more.items() if k.startswith("len_")), more
        assert not any(v for k, v in more.items() if k.startswith("nn_") and not k.startswith("nn_partido")), more
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_dangling_keys_are_counted_per_reference(spark):
    refs = ["idEquipo_Local", "idEquipo_Visitante", "idArbitro", "idLiga", "idFecha", "idUbicacion", "idJugador"]
    fact = spark.createDataFrame([(1, 2, 1, 1, 1, 1, 9), (1, 1, None, 1, 1, 1, 9)], ", ".join(f"{r} long" for r in refs))
    dims = {d: spark.createDataFrame([(1,)], f"{k} long") for d, k in (
        ("equipo", "idEquipo"), ("arbitro", "idArbitro"), ("liga", "idLiga"), ("fecha", "idFecha"), ("ubicacion", "idUbicacion"),
        ("jugador", "idJugador"))}
    assert dangling_keys(fact, dims) == dict.fromkeys(refs, 0) | {"idEquipo_Visitante": 1, "idJugador": 2}
