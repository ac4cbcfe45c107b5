"""Source precedence and round trips."""
import os

from pyspark.sql import functions as F

from pressforge.session import scratch_dir
from pressforge.sources import readers as RD
from pressforge.sources import sinks as SK


def _records(spark, ids):
    df = spark.createDataFrame([(i, f"img/{i}.jpg", f"caption {i}", "origin") for i in ids],
                               "id long, image string, text string, fake_cls string")
    return SK.make_records(df)


def test_jsonl_wins_over_snapshot(spark):
    d = scratch_dir(spark, "prec")
    SK.append_jsonl(_records(spark, [1, 2]), os.path.join(d, "metadata.jsonl"))
    snap = SK.write_snapshot(_records(spark, [7, 8, 9]), os.path.join(d, "snap"))
    got = sorted(r.id for r in RD.read_metadata(spark, os.path.join(d, "metadata.jsonl"), snap).collect())
    assert got == [1, 2]
    got2 = sorted(r.id for r in RD.read_metadata(spark, os.path.join(d, "missing.jsonl"), snap).collect())
    assert got2 == [7, 8, 9]


def test_empty_lists_round_trip(spark):
    d = scratch_dir(spark, "rt")
    SK.append_jsonl(_records(spark, [3]), os.path.join(d, "m.jsonl"))
    r = RD.read_jsonl(spark, os.path.join(d, "m.jsonl")).first()
    assert list(r.fake_text_pos) == [] and list(r.mtcnn_boxes) == [] and r.image == "img/3.jpg"


def test_gazetteer_csv_quotes_and_blanks(spark, tmp_path):
    (tmp_path / "c.csv").write_text('city_ascii,city,name\n"Say ""Hi"" Town",x,y\n   ,Second,y\n,,"   "\n,,Third\nSecond,,\n', encoding="utf-8")
    got = sorted((r.first_pos, r.name) for r in RD.city_names_csv(spark, f"file://{tmp_path}/c.csv").collect())
    assert got == [(1, 'Say "Hi" Town'), (2, "Second"), (3, "Third")]


def test_file_order_over_several_files(spark, tmp_path):
    d = tmp_path / "tsv"
    d.mkdir()
    n = 0
    for name, size in (("a.txt", 2), ("b.txt", 200), ("c.txt", 50)):
        (d / name).write_text("".join(f"{i}\tname{n + i}\n" for i in range(size)))
        n += size
    got = [r.name for r in RD.city_names_tsv(spark, str(d)).orderBy("first_pos").collect()]
    assert got == [f"name{i}" for i in range(252)]
    got = [r.name for r in RD.city_names_tsv(spark, str(d), max_items=100).orderBy("first_pos").collect()]
    assert got == [f"name{i}" for i in range(100)]


def test_snapshot_as_json_array(spark, tmp_path):
    (tmp_path / "s.json").write_text('[{"id": 1, "image": "a.jpg", "text": "x"},\n {"id": 2, "image": "b.jpg", "text": "y", "fake_text_pos": [3]}]')
    got = sorted((r.id, r.text, r.fake_text_pos) for r in RD.read_snapshot(spark, str(tmp_path / "s.json"), multiline=True).collect())
    assert got == [(1, "x", None), (2, "y", [3])]


def test_explanations_by_line(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"a": {"tokens": [1, 2], "regions": [[0.1, 0.2, 0.3, 0.4]]}}\n{"b": {"tokens": [], "regions": []}}\n')
    got = {r.id: (r.tokens, r.regions) for r in RD.read_explanations(spark, str(tmp_path / "e.jsonl")).collect()}
    assert got == {"a": ([1, 2], [[0.1, 0.2, 0.3, 0.4]]), "b": ([], [])}
