"""Driver contract smoke checks."""
import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "image", "text", "fake_cls", "fake_image_box", "fake_text_pos", "mtcnn_boxes"]


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 80
