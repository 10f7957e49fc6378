"""Invariants of the built tables (keys, references, measure identities)."""

from pyspark.sql import functions as F

from courtside.plans.runner import quality_report
from courtside.plans.warehouse import Warehouse


def test_keys_and_measure_identities(spark, sf_small):
    wh = Warehouse(spark, sf_small)
    tables = wh.tables()
    report = quality_report(tables)
    assert all(v == 0 for v in report.values()), report
    f = tables["partido"]
    c = F.col
    bad = f.where(
        (c("Rebotes_Obtenidos") < c("Rebotes_Defensivos_Obtenidos"))
        | (c("Rebotes_Obtenidos") < c("Rebotes_Ofensivos_Obtenidos"))
        | (c("Puntos_Totales") != c("Tiros_Triples_Exitosos") * 3 + c("Tiros_Dobles_Exitosos") * 2
           + c("Tiros_Libres_Exitosos"))
        | (c("Cantidad_Ataques_Exitosos") != c("Tiros_Triples_Exitosos") + c("Tiros_Dobles_Exitosos")
           + c("Tiros_Libres_Exitosos") + c("Saques_Exitosos"))
        | (c("Proporcion_Exito_Ataques") < 0)
        | (c("Numero_Jugadas_Totales") <= 0)
        | c("idPartido").isNull() | c("idJugador").isNull())
    assert bad.count() == 0
    ids = f.agg(F.min("idPartido").alias("lo"), F.max("idPartido").alias("hi"),
                F.countDistinct("idPartido").alias("n")).first()
    assert ids["lo"] == 1 and ids["hi"] == ids["n"]          # dense game numbering
    cal = tables["fecha"].agg(F.min("idFecha"), F.max("idFecha"), F.count(F.lit(1))).first()
    assert cal[0] == 1 and cal[1] == cal[2] == 28489
