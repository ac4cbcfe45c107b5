"""Runs committed whole (J2, F10) and counted by sketches (G7); unreadable sources (A3); tiles (F7); quotas that are met."""
import random

import pytest
from pyspark.sql import functions as F

from pressforge.operators import geometry as G
from pressforge.operators import quota as QU
from pressforge.operators import sketch as SK
from pressforge.operators import tiles as TL
from pressforge.sources import commit as C
from pressforge.sources import readers as RD


class Dies(RuntimeError):
    pass


def run_of(spark, run, n=20):
    rec = spark.createDataFrame([(i, f"run{run}/{i}.jpg") for i in range(n)], "id long, path string")
    return rec, rec.select("path", F.lit(5).cast("long").alias("bytes"))


@pytest.mark.parametrize("step", ["files", "records", "checked"])
def test_attempt_that_dies_leaves_nothing_to_read(spark, tmp_path, step):
    root = f"file://{tmp_path}/root"
    assert C.read_records(spark, root) is None and C.commit(*run_of(spark, 1), root, 1)

    def die(now):
        if now == step:
            raise Dies
    with pytest.raises(Dies):
        C.commit(*run_of(spark, 2), root, 2, attempt="lost", between=die)
    assert C.read_records(spark, root).count() == C.read_files(spark, root).count() == 20
    left = {(r.kind, r.run, r.attempt): r["rows"] for r in C.audit(spark, root).collect()}
    assert left == {("files", 2, "lost"): 20} | ({("records", 2, "lost"): 20} if step != "files" else {})
    assert C.commit(*run_of(spark, 2), root, 2)  # the resumed run
    rec, fil = C.read_records(spark, root), C.read_files(spark, root)
    assert rec.count() == fil.count() == 40 and rec.join(fil, "path", "full").filter("id is null or bytes is null").count() == 0
    assert not C.commit(*run_of(spark, 2, 7), root, 2) and C.read_records(spark, root).count() == 40  # committed: nothing happens


def test_dying_after_the_manifest_is_a_commit(spark, tmp_path):
    def die(now):
        if now == "manifest":
            raise Dies
    with pytest.raises(Dies):
        C.commit(*run_of(spark, 1), str(tmp_path), 1, between=die)
    assert C.read_records(spark, str(tmp_path)).count() == 20 and not C.commit(*run_of(spark, 1), str(tmp_path), 1)


def test_two_attempts_at_once(spark, tmp_path):
    """A second attempt commits while the first is between its steps: readers agree on one."""
    def other(now):
        if now == "checked":
            C.commit(*run_of(spark, 1, 7), str(tmp_path), 1, attempt="a")
    C.commit(*run_of(spark, 1, 9), str(tmp_path), 1, attempt="b", between=other)
    assert C.read_records(spark, str(tmp_path)).count() == C.read_files(spark, str(tmp_path)).count() == 7


def test_records_and_files_must_agree(spark, tmp_path):
    rec, files = run_of(spark, 1)
    with pytest.raises(ValueError):
        C.commit(rec, files.limit(19), str(tmp_path), 1)
    with pytest.raises(ValueError):
        C.commit(rec, files.union(files.limit(1)), str(tmp_path), 1)
    assert C.read_records(spark, str(tmp_path)) is None


def test_sketches_are_united_and_bounded(spark, tmp_path):
    path = str(tmp_path / "s")
    for run in range(4):  # every run repeats half of the one before
        d = spark.range(run * 5000, run * 5000 + 10_000).select((F.col("id") % 3).alias("g"), F.concat(F.lit("caption "), "id").alias("text"))
        SK.store(SK.sketch(d, ["g"], "text"), path, run)
    SK.store(SK.sketch(d, ["g"], "text"), path, 3)  # a repeated run counts once
    for r in SK.united(spark, path, ["g"]).collect():
        assert abs(r.n_distinct - 25_000 / 3) <= SK.BOUND * 25_000 / 3 and 13_000 < r["rows"] < 13_400
    assert abs(SK.united(spark, path, []).first().n_distinct - 25_000) <= SK.BOUND * 25_000
    odd = spark.createDataFrame([(1, None), (1, ""), (1, ""), (2, None)], "g long, text string")
    SK.store(SK.sketch(odd, ["g"], "text"), str(tmp_path / "o"), 0)
    assert {r.g: (r["rows"], r.n_distinct) for r in SK.united(spark, str(tmp_path / "o"), ["g"]).collect()} == {1: (2, 1), 2: (0, 0)}


def test_source_fallback_skips_only_what_cannot_be_read(spark, tmp_path, monkeypatch):
    good = tmp_path / "good.csv"
    good.write_text("city\nOslo\n")
    bad = tmp_path / "bad.csv"
    bad.mkdir()  # nothing in it: no schema
    assert [r.name for r in RD.datelines(spark, [str(tmp_path / "none.csv"), str(bad), str(good)]).collect()] == ["Oslo"]

    def broken(*a, **k):
        raise RuntimeError("an executor was lost")
    monkeypatch.setattr(RD, "city_names_csv", broken)
    with pytest.raises(RuntimeError, match="executor"):
        RD.datelines(spark, [str(good)])


def test_tiles_equal_the_plain_join(spark):
    """One image holds most of the boxes, some lie on tile borders, some are empty or outside."""
    rng = random.Random(6)

    def box():
        x, y = rng.randint(-20, 400), rng.randint(-20, 260)
        return x, y, x + rng.choice([0, 1, 5, 63, 64, 65, 200]), y + rng.choice([1, 12, 64, 90])
    words = [(f"w{i}", 1 if i % 4 else i % 7, *box()) for i in range(300)]
    boxes = [(1 if i % 4 else i % 7, *box()) for i in range(200)]
    w = spark.createDataFrame(words, "word string, img long, wx1 long, wy1 long, wx2 long, wy2 long")
    b = spark.createDataFrame(boxes, "img long, bx1 long, by1 long, bx2 long, by2 long").withColumn("box", F.monotonically_increasing_id())
    wb, bb = ["wx1", "wy1", "wx2", "wy2"], ["bx1", "by1", "bx2", "by2"]
    plain = w.join(b, "img").filter(G.iou([F.col(c) for c in wb], [F.col(c) for c in bb]) > 0.15)
    for size in (64, 17):
        got = TL.overlapping(w, b, "img", wb, bb, 0.15, size)
        assert sorted((r.word, r.box) for r in got.collect()) == sorted((r.word, r.box) for r in plain.collect())


def test_no_slots_when_every_quota_is_met(spark):
    jobs = spark.createDataFrame([(1, 1), (2, 2)], "id long, accept_order long")
    out = QU.bucket_assign(jobs, {"lit": 0, "inv": -3}, 7)
    assert out.collect() == [] and {"id", "bucket", "job_rank"} <= set(out.columns)
    assert sorted(r.bucket for r in QU.bucket_assign(jobs, {"lit": 1, "inv": 5}, 7).collect()) != []
