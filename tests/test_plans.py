"""Plan-shape guards: pushdown and pruning reach the scan; dedup combines map-side."""
import contextlib
import io

from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_and_columns_reach_the_scan(spark):
    p = _plan(E.queries()["normalize_boxes"](spark, SF).filter(F.col("img") < 100))
    assert "LessThan(l_orderkey,100)" in p
    schema = [l for l in p.splitlines() if l.startswith("ReadSchema")][0]
    assert "l_orderkey" in schema and "l_tax" not in schema and "l_shipdate" not in schema


def test_first_wins_combines_before_the_shuffle(spark):
    p = _plan(E.queries()["caption_dedup"](spark, SF))
    tree = p.split("\n\n")[0]
    # partial aggregate below the exchange, final above it
    assert tree.count("Aggregate") >= 2 and "Exchange" in tree


def test_scene_pool_of_too_few_scenes(spark, tmp_path):
    """The pool is what there is when jobs outnumber the distinct scenes twice; this was an error."""
    from pressforge.plans.queries_scene import q_scene_pool
    from pyspark.sql import functions as F

    for t in ("orders", "customer", "nation"):
        d = spark.read.parquet(f"{SF}/{t}.parquet")
        if t == "orders":  # all jobs draw alike: one scene
            d = d.limit(1).withColumn("n", F.explode(F.array_repeat(F.lit(1), 20))).drop("n")
        d.write.parquet(f"{tmp_path}/{t}.parquet")
    rows = q_scene_pool(spark, str(tmp_path)).collect()
    assert len(rows) <= 1
    assert len(q_scene_pool(spark, SF).collect()) > 0


def test_jobs_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    """A core gets one task of a scan, however many jobs; the work after it is a task a ROWS_A_TASK."""
    from pressforge.plans import views

    monkeypatch.setattr(views, "ROWS_A_TASK", 100)
    n = spark.read.parquet(f"{SF}/orders.parquet").count()
    jobs = views.v_job(spark, SF)
    assert jobs.rdd.getNumPartitions() == -(-n // 100)
    assert jobs.count() == n


def test_some_jobs_are_as_in_the_view(spark, tmp_path, monkeypatch):
    """Jobs made of their keys are the rows of the view, dealt out by their own number, with other columns kept."""
    from pressforge.plans import views

    keys = views.v_job_key(spark, SF).filter("id % 3 = 0").withColumn("extra", F.col("id") * 2)
    keys.write.parquet(f"{tmp_path}/keys")
    keys = spark.read.parquet(f"{tmp_path}/keys")
    n = keys.count()
    monkeypatch.setattr(views, "ROWS_A_TASK", 20)
    some = views.jobs_of(keys)
    assert n > 100 and some.rdd.getNumPartitions() == -(-n // 20)
    want = views.v_job(spark, SF).filter("id % 3 = 0").withColumn("extra", F.col("id") * 2)
    assert some.columns == [*want.columns[:-2], "extra", want.columns[-2]]
    assert sorted(map(tuple, some.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_edges_join_the_pairs_once(spark):
    from pressforge.operators.neardup import near_pairs, neighbour_edges

    df = spark.createDataFrame([(0b0,), (0b111,), (0b1111,), (2 ** 40,), (None,)], "h bigint")
    edges = neighbour_edges(near_pairs(df))
    tree = _plan(edges).split("\n\n")[0]
    assert tree.count("Join") == 1 and "Union" not in tree
    near = {(a, b) for a in (0, 7, 15, 2 ** 40) for b in (0, 7, 15, 2 ** 40) if a != b and bin(a ^ b).count("1") <= 3}
    got = [(r.a, r.b) for r in edges.select("a", "b").collect()]
    assert len(got) == len(near) and set(got) == near


def test_funnel_captions_what_passes_the_gates(spark, monkeypatch):
    """The captions are made of the jobs that reach the text, a task a ROWS_A_TASK of them."""
    from pressforge.plans import queries_accept as A
    from pressforge.plans import views

    monkeypatch.setattr(views, "ROWS_A_TASK", 40)
    seen, made = [], A.with_captions

    def with_captions(jobs, *args, **kw):
        seen.append((jobs.rdd.getNumPartitions(), jobs.count()))
        return made(jobs, *args, **kw)

    monkeypatch.setattr(A, "with_captions", with_captions)
    rows = A.accept_funnel(spark, SF).collect()
    n = sum(r.reason in ("passed", "near_image", "same_caption") for r in rows)
    assert len(rows) == spark.read.parquet(f"{SF}/orders.parquet").count() > n > 160
    assert seen == [(-(-n // 40), n)]


def test_records_of_all_captions_are_dealt_by_the_number_of_jobs(spark, monkeypatch):
    """What the class folders are written from: no task has more jobs than ROWS_A_TASK asks for, at any size."""
    from pressforge.plans import views
    from pressforge.plans.pipeline import all_records

    monkeypatch.setattr(views, "ROWS_A_TASK", 100)
    n = spark.read.parquet(f"{SF}/orders.parquet").count()
    tasks = -(-n // 100)
    assert tasks > spark.sparkContext.defaultParallelism
    dealt = [l for l in _plan(all_records(spark, SF)).splitlines() if "REPARTITION_BY_NUM" in l]
    assert dealt and all(f", {tasks})" in l for l in dealt)
