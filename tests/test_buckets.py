"""Bucket rules incl. edges and gaps, capacity text, position labels."""

from pyspark.sql import functions as F

from courtside.functions import buckets as B
from courtside.functions.text import to_number


def _label(spark, values, rules, default=B.UNKNOWN):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [r[0] for r in df.select(B.bucketize("x", rules, default)).collect()]


def test_height_edges_and_gap(spark):
    assert _label(spark, [1.79, 1.80, 1.89, 1.8923, 1.90, 2.15, 0.0, None],
                  B.HEIGHT_M) == ["Muy bajo", "Bajo", "Bajo", "Desconocido", "Medio", "Muy alto", "Desconocido",
                                  "Desconocido"]


def test_weight_edges_and_gap(spark):
    assert _label(spark, [74.99, 74.995, 75.0, 139.99, 140.0, -1.0],
                  B.WEIGHT_KG) == ["Muy liviano", "Desconocido", "Liviano", "Pesado", "Muy Pesado", "Desconocido"]


def test_career(spark):
    assert _label(spark, [0.0, 9.0, 9.5, 10.0, 30.0, -1.0],
                  B.CAREER_YEARS) == ["Novato", "Novato", "Desconocido", "Consolidado", "Longevo", "Desconocido"]


def test_capacity_text(spark):
    df = spark.createDataFrame([("9500.0",), ("18422.0",), ("20000",), ("Desconocido",), ("",), (None,)], "c string")
    got = [r[0] for r in df.select(B.capacity_bucket(to_number("c"))).collect()]
    assert got == ["pequeno", "mediano", "grande", "grande", "grande", "grande"]


def test_positions(spark):
    df = spark.createDataFrame([("PG",), ("C-PF",), ("Forward-Center",), ("",), (None,), ("XX",)], "p string")
    got = [r[0] for r in df.select(B.position_label("p")).collect()]
    assert got == ["Base", "Pívot/Ala-pívot", "Alero/Pívot", "Desconocido", "Desconocido", "Desconocido"]
