import sys
import types

import pytest

from detlake import config
from detlake.plans import sql_functions
from detlake.sources import lmdb_source, seams, stores


def test_layers_and_options():
    got = config.load([{"a": {"x": 1, "y": 2}, "b": 1}, {"a": {"y": 3}}, {"c": {"_delete_": True, "z": 1}}], {"a.w": "0.5", "b": "true", "d": "text"})
    assert got == {"a": {"x": 1, "y": 3, "w": 0.5}, "b": True, "c": {"z": 1}, "d": "text"}
    assert config.merge({"c": {"k": 1}}, {"c": {"_delete_": True, "z": 1}}) == {"c": {"z": 1}} and config.parse("[1, 2]") == [1, 2]
    r = config.Registry()
    r.add("m")(int)
    assert r.get("m") is int
    with pytest.raises(KeyError):
        r.add("m")(str)


def test_sql_names(spark):
    assert "iou" in sql_functions.register(spark)
    row = spark.sql("SELECT iou(0, 0, 0.4, 0.4, 0.2, 0.2, 0.6, 0.6) AS i, giou(0, 0, 1, 1, 0, 0, 1, 1) AS g, rle_area('14 10 3') AS a, event_label('a:b:c') AS l, event_label('craft:x') AS n, part_number('part-9') AS p, caption_text(' A ') AS c").first()
    assert row["i"] == pytest.approx(.04 / .28) and tuple(row)[1:] == (1.0, 10, "b:c", None, 9, "a.")


def test_store_source(spark, tmp_path, monkeypatch):
    (tmp_path / "fake_store.py").write_text(
        "class Env:\n    def begin(self): return self\n    def __enter__(self): return self\n    def __exit__(self, *a): pass\n    def cursor(self): return iter([(b'(0, 32)', b'v'), (b'__m__', b'w')])\n    def close(self): pass\n"
        "def open(path, **kw): return Env()\n"
    )
    monkeypatch.syspath_prepend(str(tmp_path))
    mod = types.ModuleType("fake_store")
    exec((tmp_path / "fake_store.py").read_text(), mod.__dict__)
    monkeypatch.setitem(sys.modules, "fake_store", mod)
    reader = lmdb_source.EpisodeStore({"parts": "/s/part-1,/s/part-2", "opener": "fake_store"}).reader(None)
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert len(rows) == 4 and rows[0] == ("store", "part-1", bytearray(b"(0, 32)"), bytearray(b"v"))
    df = spark.createDataFrame(rows, lmdb_source.schema.KV)
    assert stores.scan_kv(df).count() == 2
    lmdb_source.register(spark)


def test_video_lengths_and_images(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"img")
    assert stores.image_files(spark, str(tmp_path)).first()["content"] == bytearray(b"img")
    v = spark.createDataFrame([("a", "/x/a"), ("b", "/x/bb")], "stem string, path string")
    assert sorted(r["n_frames"] for r in seams.video_lengths(v, lambda: lambda p: len(p) - 5).collect()) == [0, 0]
