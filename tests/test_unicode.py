import pytest

from courtside.functions import cleaning as C
from courtside.plans.extensions import running_score
from courtside.session import ensure_checkpoint_dir


def test_names_beyond_ascii_are_removed_whole(spark):
    plays = ["Dončić REBOUND", "Smith STEAL", "MISS Jokić Layup", "Turnover by Schröder", "N'Dong PUTS Šarić IN"]
    texts = spark.createDataFrame([(t,) for t in plays], "d string")
    words = spark.createDataFrame([(w,) for w in ("Dončić", "Smith", "Jokić", "Schröder", "Šarić", "Don")], "entry string")
    got = C.remove_entries(texts, "d", words, "out").select("d", C.final_tidy(C.tidy(C.drop_words(C.F.col("out"), C.ALIAS_WORDS))).alias("out"))
    assert {r.d: r.out for r in got.collect()} == dict(zip(plays, ["REBOUND", "STEAL", "MISS Layup", "Turnover by", "PUTS IN"]))


def test_text_event_numbers_are_ordered_as_numbers(spark):
    plays = spark.createDataFrame([("g", str(i), "Smith 26' 3PT Jump Shot (3 PTS)", None) for i in range(1, 13)] + [("g", None, "x", None)],
                                  "game_id string, eventnum string, homedescription string, visitordescription string")
    got = sorted((r.eventnum, r.marcador_local) for r in running_score(plays).collect())
    assert got == [(i, 3 * i) for i in range(1, 13)]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
