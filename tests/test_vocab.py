"""A caller's own vocabulary (A8), digest-keyed first-wins with nulls (H1), parts of one image (L2)."""
import pytest

from pressforge import vocab as V
from pressforge.operators import similarity as S
from pressforge.operators.captions import with_captions
from pressforge.operators.dedup import first_wins
from pressforge.operators.scenes import with_prompt, with_validity
from pressforge.plans.pipeline import caption_records
from pressforge.plans.views import v_job

SF = "/root/testdata/sf0.001"
MINE = V.with_lists(
    ROLES=["una panadera", "un guardia"], EVENTS=["abre una escuela", "visita un hospital"], BACKDROPS=["en la plaza"], ABSURD_BACKDROPS=["en la luna"],
    ACTIONS_BASE=["probar"], WHEN_FRAG=["hoy"], IRREL_SUBJECTS=["Alfarero"], IRREL_ACTIONS_BASE=["pintar barro"], IRREL_PLACES=["en casa"], IRREL_TAILS=["", " ayer"],
    OBJECTS_BY_TAG={"community": ["el plan"], "salud": ["la sala"]}, ROLE_RULES={"salud": ["enfermera"]}, EVENT_TAGS={"salud": ["hospital"]},
    AFFECT_PAIRS=[("sonríe", "llora")], LIGHTING=["sol"], PROPS_ABSURD=[("un globo", 1.0)], PROPS_NORMAL=[("un pan", 1.0), ("un mapa", 1.0)], BACKDROP_TAGS={"salud": ["plaza"]})


def test_captions_use_only_the_given_lists(spark):
    jobs = v_job(spark, SF, 3, vocab=MINE)
    rows = with_captions(jobs, 3, vocab=MINE).collect()
    assert {r.role for r in rows} == set(MINE.ROLES) and {r.back_raw for r in rows} == {"en la plaza", "en la luna"}
    assert {t for r in rows for t in r.tags} == {"salud", "community"}
    for r in rows:
        if r.bucket == "irr":
            assert r.text.startswith("Alfarero") and "barro en casa" in r.text
        else:
            assert any(x in r.text for x in ("el plan", "la sala", "escuela", "hospital"))
        assert r.bucket != "inv" or r.text.rstrip(".").endswith(("sonríe", "llora"))
    foreign = {x for k in ("ROLES", "EVENTS", "IRREL_SUBJECTS", "WHEN_FRAG") for x in getattr(V, k)}
    assert not any(x in r.text for r in rows for x in foreign)


def test_scenes_and_records_take_it_too(spark):
    p = with_prompt(with_validity(v_job(spark, SF, 3, vocab=MINE), MINE), 3, MINE).collect()
    assert all("sol" in r.prompt and (("un globo" in r.prompt) if r.mismatch else ("un pan; un mapa" in r.prompt)) for r in p)
    assert caption_records(spark, SF, vocab=MINE).filter("text like '%mayor%'").count() == 0


def test_with_lists_refuses_what_it_does_not_know():
    with pytest.raises(ValueError):
        V.with_lists(ROLLS=["x"])
    with pytest.raises(ValueError):
        V.with_lists(ROLES=[])
    assert V.with_lists().ROLES is V.ROLES


def test_first_wins_keeps_nulls_apart(spark):
    rows = [(5, None, "a"), (1, "a", None), (2, None, "a"), (3, None, None), (4, "", "a"), (6, "a", None), (7, None, None), (8, "a", "")]
    got = first_wins(spark.createDataFrame(rows, "accept_order long, x string, y string"), ["x", "y"])
    assert got.columns == ["accept_order", "x", "y"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a", None), (2, None, "a"), (3, None, None), (4, "", "a"), (8, "a", "")]


def test_parts_distance(spark):
    rows = [(1, True, [1.0, 0.0]), (1, True, [0.0, 1.0]), (1, False, [1.0, 1.0]), (2, True, [1.0, 0.0]), (3, True, [1.0, 0.0]), (3, False, [-2.0, 0.0]),
            (4, True, [0.0, 0.0]), (4, False, [1.0, 0.0]), (5, None, [1.0, 0.0]), (5, True, None)]
    got = {r.img: r for r in S.parts_distance(spark.createDataFrame(rows, "img long, fg boolean, v array<double>"), "img", spark_col("fg"), "v").collect()}
    assert got[1].distance == pytest.approx(0) and got[3].distance == pytest.approx(2) and got[2].distance is None and got[4].distance is None and got[5].distance is None
    assert (got[1].n_foreground, got[1].n_background, got[2].n_background) == (2, 1, 0)


def spark_col(name):
    from pyspark.sql import functions as F
    return F.col(name)
