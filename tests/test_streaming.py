"""Streaming accept loop = batch plan; resume adds nothing (M1, M3)."""
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def test_stream_equals_batch_and_resume(spark):
    q = E.queries()
    batch = _rows(q["caption_records"](spark, SF))
    assert batch
    assert _rows(q["stream_accept"](spark, SF)) == batch
    assert _rows(q["stream_resume"](spark, SF)) == batch


def test_stream_dedup_distinct_keys(spark):
    q = E.queries()
    s = q["stream_dedup"](spark, SF)
    assert s.count() == s.distinct().count() > 0


def _plain_candidates(spark, n, first=0):
    """n candidates in arrival order: classes in turn, some repeated captions, some near images."""
    from pyspark.sql import functions as F
    i = F.col("id")
    mix = F.xxhash64(F.when(i % 7 == 3, i - 2).otherwise(i))
    return spark.range(first, first + n).select(
        i, i.alias("accept_order"), F.element_at(F.array(F.lit("lit"), F.lit("inv"), F.lit("irr")), (i % 3 + 1).cast("int")).alias("bucket"),
        F.concat(F.lit("caption "), F.when(i % 5 == 4, i - 3).otherwise(i)).alias("text"), mix.bitwiseXOR(i % 4).alias("h"))


def _greedy(rows, goals, max_distance=3):
    """The accept loop in plain Python."""
    texts, hashes, n, out = set(), [], dict.fromkeys(goals, 0), []
    for r in sorted(rows, key=lambda r: r.accept_order):
        if r.text in texts or any(bin((r.h ^ h) & (2**64 - 1)).count("1") <= max_distance for h in hashes):
            continue
        texts.add(r.text)
        hashes.append(r.h)
        if n[r.bucket] < goals[r.bucket]:
            n[r.bucket] += 1
            out.append(r.id)
    return out


def test_every_snapshot_is_its_first_rows(spark):
    """Versions cut inside batches, at batch borders, and several in one batch."""
    import os
    from pressforge.session import scratch_dir
    from pressforge.streaming import incremental as INC
    work = scratch_dir(spark, "snaptest")
    c = _plain_candidates(spark, 330).drop("h")
    src = os.path.join(work, "src")
    INC.stage_in_order(c, src, "accept_order", 4)
    INC.run_accept(spark, src, c.schema, work, {"lit": 60, "inv": 70, "irr": 80}, snap_every=15)
    rows = sorted(INC.accepted(spark, work).collect(), key=lambda r: r.accept_order)
    log = INC.versions(spark, work).orderBy("version").collect()
    assert [r.version for r in log] == list(range(1, len(rows) // 15 + 1))
    for r in log:
        assert (r.rows, r.first_arrival, r.last_arrival) == (15 * r.version, 15 * r.version - 14, 15 * r.version)
        assert sorted(x.id for x in INC.snapshot(spark, work, r.version).collect()) == sorted(x.id for x in rows[:r.rows])
    assert INC.snapshot(spark, work).count() == len(rows)  # the one written on finish
    totals = {r.version: (r["rows"], r.total) for r in INC.snapshot_totals(spark, work, "id").collect()}
    assert totals == {r.version: (r.rows, sum(x.id for x in rows[:r.rows])) for r in log}


def test_a_replayed_batch_rewrites_its_own_files_only(spark, tmp_path):
    """The last batch is run once more from the checkpoint of the one before it, after a crash that
    left everything but the commit of the batch."""
    import glob
    import os
    from pressforge.streaming import incremental as INC
    work = str(tmp_path / "w")
    c = _plain_candidates(spark, 200)
    src = os.path.join(work, "src")
    goals = {"lit": 40, "inv": 40, "irr": 40}
    INC.stage_in_order(c, src, "accept_order", 4)

    def run():
        INC.run_accept(spark, src, c.schema, work, goals, snap_every=10, hash_col="h", target=100)
    run()
    want = _rows(INC.accepted(spark, work)), _rows(INC.versions(spark, work)), _rows(spark.read.parquet(f"{work}/state").drop("batch"))
    times = {f: os.path.getmtime(f) for f in glob.glob(f"{work}/snapshots/batch=*/part*")}
    last = max(int(os.path.basename(f)) for f in glob.glob(f"{work}/checkpoint/commits/[0-9]*"))
    for f in os.listdir(f"{work}/checkpoint/commits"):
        if f.lstrip(".").split(".")[0] == str(last):  # the file and its checksum
            os.unlink(f"{work}/checkpoint/commits/{f}")
    run()
    got = _rows(INC.accepted(spark, work)), _rows(INC.versions(spark, work)), _rows(spark.read.parquet(f"{work}/state").drop("batch"))
    assert got[0] == want[0] and got[1] == want[1]
    for f, t in times.items():
        if f"batch={last}" not in f:
            assert os.path.getmtime(f) == t


def test_joint_loop_equals_greedy(spark, tmp_path):
    """Near images and captions against all earlier batches, the index growing as it goes."""
    import os
    from pressforge.streaming import incremental as INC
    work = f"file://{tmp_path}/w"
    c = _plain_candidates(spark, 400)
    goals = {"lit": 90, "inv": 30, "irr": 200}
    src = os.path.join(work, "src")
    INC.stage_in_order(c, src, "accept_order", 5, only=range(3))
    INC.run_accept(spark, src, c.schema, work, goals, hash_col="h", target=300)
    INC.stage_in_order(c, src, "accept_order", 5, only=range(3, 5))
    INC.run_accept(spark, src, c.schema, work, goals, hash_col="h", target=300)
    assert sorted(r.id for r in INC.accepted(spark, work).collect()) == sorted(_greedy(c.collect(), goals))


def test_bytes_read_by_a_late_batch_stay_flat(spark, tmp_path):
    """Thirty batches of the same size: what the index hands to one of the last is no more than
    what it hands to one of the first that met a full folder."""
    from pyspark.sql import functions as F
    from pressforge.streaming.keyindex import KeyIndex, State
    index, state, read = KeyIndex(spark, str(tmp_path / "i"), target=500), State(), []
    for b in range(30):
        keys = spark.range(b * 400, (b + 1) * 400).select(F.xxhash64("id").alias("k"), F.col("id").alias("v"))
        state = index.open(state, b)
        asked = keys.limit(3).union(spark.range(0, 2).select(F.xxhash64("id").alias("k"), F.col("id").alias("v")))
        found, state = index.lookup(asked, state, b)
        if b:
            hit = found.join(asked.select("k"), "k")
            assert sorted(r.v for r in hit.collect()) == [0, 1]  # what the first batch wrote
        read.append(state.bytes_read)
        state = index.add(keys, state, b)
    assert state.pairs == 12_000 and state.gen >= 2 and state.bits >= 4
    assert max(read[20:]) < 2 * max(read[:10]) and read[-1] < 0.5 * 12_000 * 16


def test_key_index_forgets_nothing_and_ignores_later_batches(spark, tmp_path):
    from pyspark.sql import functions as F
    from pressforge.streaming.keyindex import KeyIndex, State
    index = KeyIndex(spark, str(tmp_path / "i"), target=10)
    keys = spark.range(0, 60).select(F.xxhash64("id").alias("k"), F.col("id").alias("v"))
    s1 = index.add(keys.filter("v < 30"), index.open(State(), 0), 0)
    lost = index.add(keys.filter("v >= 30"), index.open(s1, 1), 1)  # an attempt whose state was never written
    assert lost.pairs == 60
    again = index.open(s1, 1)
    found, again = index.lookup(keys, again, 1)
    assert sorted(r.v for r in found.collect()) == list(range(30))
    again = index.add(keys.filter("v >= 50"), again, 1)
    found, _ = index.lookup(keys, index.open(again, 2), 2)
    assert sorted(r.v for r in found.collect()) == [*range(30), *range(50, 60)]
    none, _ = index.lookup(keys.limit(0), again, 2)
    assert none.collect() == []


def test_dedup_state_survives_a_restart(spark, tmp_path):
    """Keys of an earlier run are still known after the query starts again, from state on disk."""
    import os
    from pressforge.streaming import incremental as INC
    src, work = str(tmp_path / "src"), str(tmp_path / "w")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    df = spark.range(0, 300).selectExpr("id", "id % 40 as k")
    INC.stage_in_order(df, src, "id", 3, only=range(2))
    first = INC.stream_dedup(spark, src, df.schema, ["k"], work).count()
    INC.stage_in_order(df, src, "id", 3, only=[2])
    assert first == 40 == INC.stream_dedup(spark, src, df.schema, ["k"], work).count()
    files = [f for _, _, names in os.walk(f"{work}/checkpoint/state") for f in names]
    assert any(f.endswith((".changelog", ".zip")) for f in files)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_gated_stream_equals_the_batch_plan(spark):
    q = E.queries()
    want = _rows(q["accept_batch"](spark, SF))
    assert want and _rows(q["stream_accept_gated"](spark, SF)) == want


def test_funnel_passes_what_the_loop_keeps(spark):
    from pressforge.plans.queries_accept import accept_funnel
    reasons = {r.id: r.reason for r in accept_funnel(spark, SF).collect()}
    kept = [r.id for r in E.queries()["accept_batch"](spark, SF).collect()]
    assert kept and all(reasons[i] == "passed" for i in kept) and "near_image" in reasons.values()


def test_accept_on_a_file_uri_equals_the_batch_plan(spark, tmp_path):
    import os
    from pressforge.operators.captions import with_captions
    from pressforge.operators.dedup import first_wins
    from pressforge.operators.quota import quota_fill
    from pressforge.plans.views import SEED, v_job
    from pressforge.streaming import incremental as INC
    goals = {"lit": 100, "inv": 100, "irr": 100}
    c = with_captions(v_job(spark, SF), SEED).select("id", "accept_order", "bucket", "text", "fake_text_pos", "fake_cls")
    work = f"file://{tmp_path}/work"
    src = os.path.join(work, "src")
    INC.stage_in_order(c, src, "accept_order", 4, only=range(2))
    INC.run_accept(spark, src, c.schema, work, goals)
    INC.stage_in_order(c, src, "accept_order", 4, only=range(2, 4))
    INC.run_accept(spark, src, c.schema, work, goals)
    want = quota_fill(first_wins(c, ["text"]), goals)
    got = INC.accepted(spark, work)
    assert _rows(got.select("id", "text")) == _rows(want.select("id", "text")) and got.count() == 300


def test_files_of_a_chunk_follow_its_rows(spark, tmp_path, monkeypatch):
    """A batch has as many files as its rows ask for; chunks with few or no rows don't shift the ranges of later batches."""
    import glob
    import os
    from pyspark.sql import functions as F
    from pressforge.streaming import incremental as INC
    monkeypatch.setattr(INC, "ROWS_A_FILE", 10)
    c = _plain_candidates(spark, 240).drop("h")
    for name, d, want in (("even", c, 6), ("sparse", c.filter((F.col("id") < 60) | F.col("id").isin(121, 122, 123) | (F.col("id") > 200)), 3)):
        work = str(tmp_path / name)
        src = os.path.join(work, "src")
        files = INC.stage_in_order(d, src, "accept_order", 4)
        assert files == want and {len(glob.glob(f"{x}/*.parquet")) for x in glob.glob(f"{src}/chunk=*")} == {files}
        assert INC.staged(spark, src).count() == d.count()
        INC.run_accept(spark, src, d.schema, work, dict.fromkeys(("lit", "inv", "irr"), 70), files=files, target=20)
        borders = [(r.lo, r.hi) for r in spark.read.parquet(f"{work}/accepted").groupBy("batch").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("batch").collect()]
        assert all(a[1] < b[0] for a, b in zip(borders, borders[1:]))
        texts, keep = set(), []
        for r in d.orderBy("accept_order").collect():
            if r.text not in texts:
                texts.add(r.text)
                keep.append(r.id)
        assert sorted(r.id for r in INC.accepted(spark, work).collect()) == sorted(keep)


def test_first_pairs_of_an_index_are_dealt_out(spark, tmp_path):
    import os
    from pyspark.sql import functions as F
    from pressforge.streaming.keyindex import KeyIndex, State
    index = KeyIndex(spark, str(tmp_path), target=50)
    pairs = spark.range(1000).select(F.xxhash64("id").alias("k"), F.col("id").alias("v"))
    state = index.add(pairs, State(), 0)
    assert (state.gen, state.bits, state.pairs) == (0, 6, 1000) and index.open(state, 1).gen == 0
    assert len([x for x in os.listdir(tmp_path / "gen=0") if x.startswith("p=")]) > 50
    found, _ = index.lookup(pairs.filter("v < 3").select("k"), state, 1)
    assert found.join(pairs, ["k", "v"]).filter("v < 3").count() == 3


def test_candidates_lie_on_disk_one_chunk_at_a_time(spark, monkeypatch):
    """The gated stream writes a chunk of candidates when the one before it is done and removed, also in more
    chunks than four, and the chunks are the candidates of all orders. The loop itself is left out."""
    import glob
    import os
    from urllib.parse import urlparse
    import pytest
    from pressforge.plans import queries_accept as A
    from pressforge.streaming import incremental as INC
    orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    monkeypatch.setattr(A, "ROWS_A_CHUNK", -(-orders // 6), raising=False)
    work, seen = [], []
    monkeypatch.setattr(A, "scratch_dir", lambda s, name, make=A.scratch_dir: work.append(make(s, name)) or work[0])

    def found(folder):
        return glob.glob(f"{urlparse(folder).path}/**/*.parquet", recursive=True)

    def looked_at(s, src, schema, *args, **how):
        seen.append((len({os.path.dirname(f) for f in found(work[0])}), [r.id for r in s.read.schema(schema).parquet(*found(src)).select("id").collect()]))

    def end(*args):
        raise InterruptedError
    monkeypatch.setattr(INC, "run_accept", looked_at)
    monkeypatch.setattr(INC, "accepted", end)
    with pytest.raises(InterruptedError):
        E.queries()["stream_accept_gated"](spark, SF)
    assert [n for n, _ in seen] == [1] * 6 and all(max(a) < min(b) for (_, a), (_, b) in zip(seen, seen[1:]))
    assert sorted(i for _, ids in seen for i in ids) == sorted(r.id for r in A.v_candidates(spark, SF).select("id").collect())
    assert len([i for _, ids in seen for i in ids]) == orders and not found(work[0])


def test_arriving_chunks_equal_greedy_and_empty_ones_are_passed_over(spark, tmp_path):
    from pyspark.sql import functions as F
    from pressforge.streaming import incremental as INC
    c = _plain_candidates(spark, 300)
    goals = {"lit": 60, "inv": 30, "irr": 200}
    chunks = [c.filter(F.col("id").between(lo, hi)) for lo, hi in ((0, 99), (100, 99), (100, 219), (220, 299), (300, 400))]
    INC.accept_arriving(spark, chunks, f"file://{tmp_path}/w", goals, hash_col="h", target=300)
    got = spark.read.parquet(f"{tmp_path}/w/accepted")
    assert sorted(r.id for r in got.collect()) == sorted(_greedy(c.collect(), goals))
    assert sorted(r.batch for r in got.select("batch").distinct().collect()) == [0, 1, 2]


def test_detections_are_shuffled_before_they_are_made(spark):
    """The exchanges of the candidates carry order lines; faces and words are made where they are joined."""
    from pressforge.plans.queries_accept import v_candidates
    plan = v_candidates(spark, SF)._jdf.queryExecution().executedPlan().toString()
    made = [i for i, x in enumerate(plan.split("\n")) if "collect_list" in x]
    assert made
    for i in made:  # what stands below a list up to the next exchange deals out lines by number, not lists by image
        below = [x for x in plan.split("\n")[i + 1:] if "Exchange" in x][0]
        assert "l_orderkey" in below and "REPARTITION_BY_NUM" in below, below
