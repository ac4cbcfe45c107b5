"""Single-document JSON files (A6, A10, A11): structure found over split borders."""
import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pressforge.sources import jsonfile as J
from pressforge.sources.sinks import RECORD_SCHEMA


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set(key, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def put(tmp_path, text, name="d.json"):
    p = tmp_path / name
    p.write_text(text, encoding="utf8")
    return str(p)


def members(spark, path):
    return [json.loads(r.member) for r in J.members(spark, path).orderBy("ix").collect()]


HARD = ['a,b', '\\', '"', '\\",', '[{', '}]', ',,,', '{"x":[1,2]}', 'é中,', '\n,\t', '', '\\\\",[']


def test_array_over_many_splits(spark, tmp_path, small_splits):
    rng = random.Random(3)
    docs = [rng.choice([rng.choice(HARD), {"t": rng.choice(HARD), "l": [rng.choice(HARD), [1, 2, {"k": rng.choice(HARD)}]]}, 1.5, None, True, [], {}]) for _ in range(400)]
    for indent in (None, 1):
        p = put(tmp_path, json.dumps(docs, ensure_ascii=False, indent=indent), f"a{indent}.json")
        assert spark.read.text(p, lineSep=",").rdd.getNumPartitions() > 20
        assert members(spark, p) == docs


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.recursive(st.none() | st.integers() | st.text(alphabet='",\\[]{} a\n', max_size=12), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(alphabet='",\\[{', max_size=3), x, max_size=3), max_leaves=9), max_size=40))
def test_any_array(spark, tmp_path, docs):
    assert members(spark, put(tmp_path, json.dumps(docs))) == docs


def test_an_escaped_quote_at_every_place_of_a_border(spark, tmp_path, small_splits):
    docs = [x for shift in range(200) for x in ("x" * (1 + shift % 97), 'q"\\",[{' * 5)]  # borders fall on every kind of place
    assert members(spark, put(tmp_path, json.dumps(docs), "s.json")) == docs


def test_not_an_array(spark, tmp_path):
    for i, text in enumerate(['{"a": 1}', '"text, [1]"', " [ ] \n", ""]):
        assert J.read_snapshot_array(spark, put(tmp_path, text, f"n{i}.json")).collect() == []
    for i, text in enumerate(["[1, 2", '["a]']):
        with pytest.raises(ValueError):
            J.members(spark, put(tmp_path, text, f"bad{i}.json")).collect()


def test_snapshot_entries(spark, tmp_path, small_splits):
    rec = {"id": 1, "image": "a/b.jpg", "text": 'He said: "x, [y]"', "fake_cls": "origin", "fake_image_box": [], "fake_text_pos": [1, 2], "mtcnn_boxes": [[1, 2, 3, 4]]}
    docs = [rec, 5, "text, no record", [rec], None] + [rec | {"id": i} for i in range(2, 60)]
    got = J.read_snapshot_array(spark, put(tmp_path, json.dumps(docs, indent=2))).collect()
    assert len(got) == len(docs)  # entries that are no objects stay, without a caption
    assert sum(r.text is None for r in got) == 4 and sorted(r.id for r in got if r.id) == [1, *range(2, 60)]
    one = [r for r in got if r.id == 1][0]
    assert one.text == rec["text"] and one.mtcnn_boxes == [[1, 2, 3, 4]] and one.fake_text_pos == [1, 2]


def test_objects(spark, tmp_path, small_splits):
    tokens = {f"{i:04d}": list(range(i % 5)) for i in range(300)} | {'odd ",[ id': [7]}
    p = put(tmp_path, json.dumps(tokens, indent=2))
    got = {}
    for r in J.read_grounding_object(spark, p).collect():
        got.setdefault(r.id, []).extend([] if r.token is None else [r.token])
    assert {k: sorted(v) for k, v in got.items()} == tokens
    twice = put(tmp_path, '{"a": [1], "b": [2], "a": [3, 4]}', "twice.json")
    assert sorted((r.id, r.token) for r in J.read_grounding_object(spark, twice).collect()) == [("a", 3), ("a", 4), ("b", 2)]
    assert J.read_grounding_object(spark, twice, last_wins=False).count() == 4
    ex = put(tmp_path, json.dumps({"1": {"tokens": [3, 4], "regions": [[0.1, 0.2, 0.3, 0.4]]}, "2": {"tokens": [], "regions": []}}), "ex.json")
    assert {r.id: (r.tokens, r.regions) for r in J.read_explanations_object(spark, ex).collect()} == {"1": ([3, 4], [[0.1, 0.2, 0.3, 0.4]]), "2": ([], [])}


def test_parallel_write_is_one_document(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several parts, small as they are
    rows = [(i, "p", HARD[i % len(HARD)], "origin", [], [i], [[1, 2, 3, 4]]) for i in range(97)]
    path = J.write_snapshot_array(spark.createDataFrame(rows, RECORD_SCHEMA).repartition(5), str(tmp_path / "out"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert len(parts) > 1 and [r["id"] for r in json.loads("".join(p.read_text(encoding="utf8") for p in parts))] == list(range(97))
    assert sorted((r.id, r.text) for r in J.read_snapshot_array(spark, path).collect()) == [(r[0], r[2]) for r in rows]
    J.write_snapshot_array(spark.createDataFrame([], RECORD_SCHEMA), str(tmp_path / "none"))
    assert J.read_snapshot_array(spark, str(tmp_path / "none")).collect() == []
    J.write_grounding_object(spark.createDataFrame([("x", [1, 2]), ("y", [])], "id string, tokens array<int>"), str(tmp_path / "g"))
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "g").glob("part-*")))) == {"x": [1, 2], "y": []}
