import json

import numpy as np
from pyspark.sql import functions as F

from detlake import schema
from detlake.operators import align, keys
from detlake.sources import seams, sinks, stores
from detlake.streaming import events as streaming


def kv(spark):
    info = json.dumps([{"episode": "P-1", "episode_idx": 0, "num_frames": 50}, {"episode": "P-2", "idx": 1, "num_frames": 3}, {"episode": "", "episode_idx": 2}])
    data = [("seg", "part-1", b"__chunk_infos__", info.encode())] + [("seg", "part-1", f"({i % 2}, {i // 2 * 32})".encode(), json.dumps({"i": i}).encode()) for i in range(20)]
    return spark.createDataFrame([(a, b, bytearray(c), bytearray(d)) for a, b, c, d in data], schema.KV)


def test_key_value_store(spark, tmp_path):
    store = kv(spark)
    scan = stores.scan_kv(store)
    assert scan.count() == 20 and {(r["ep_idx"], r["frame_offset"]) for r in scan.collect()} == {(e, 32 * k) for e in (0, 1) for k in range(10)}
    assert sorted((r["ep_idx"], r["episode"]) for r in stores.episode_dim(store).collect()) == [(0, "P-1"), (1, "P-2")]
    look = stores.inspect(store, 2).first()
    assert look["entries"] == 21 and look["first_keys"] == ["(0, 0)", "(0, 128)"]
    assert stores.sample_store(store, 5).count() == 5 and stores.sample_store(store, 100, "uniform").count() == 21
    some = spark.createDataFrame([("part-1", 0, 64)], "part string, ep_idx int, frame_offset int")
    assert stores.copy_keys(store, some).count() == 2
    sinks.write_subset(stores.copy_keys(store, some), str(tmp_path / "kv"))
    assert spark.read.parquet(str(tmp_path / "kv")).count() == 2
    assert stores.value_types(store).count() >= 2
    assert align.image_index(scan).where("ep_idx = 0").first()["parts"] == ["part-1"]


def test_listings(spark, tmp_path):
    for p in ("v/a-1.mp4", "v/deep/a-1.mp4", "v/b-2.mp4", "seg/part-1/data.mdb", "seg/part-2/data.mdb", "seg/part-2/x/data.mdb"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_bytes(b"x")
    idx = align.video_index(stores.file_listing(spark, str(tmp_path / "v"), "*.mp4"))
    assert sorted((r["stem"], r["path"].split("/v/")[1]) for r in idx.collect()) == [("a-1", "a-1.mp4"), ("b-2", "b-2.mp4")]
    ep = spark.createDataFrame([("a-1",), ("zz",)], "episode string")
    assert {r["episode"]: r["path"] is not None for r in align.find_video(idx, ep).collect()} == {"a-1": True, "zz": False}
    listing = stores.file_listing(spark, str(tmp_path / "seg"), "*.mdb")
    root = listing.first()["path"].split("/seg/")[0] + "/seg"
    assert [r["part"] for r in stores.parts(listing, root).collect()] == ["part-1", "part-2"] and stores.store_folders(listing).count() == 3
    assert stores.random_images(listing, 2).count() == 2


def test_documents(spark, tmp_path):
    df = spark.range(3)
    for kind in ("json", "parquet", "csv"):
        stores.dump(df, str(tmp_path / f"x.{kind}"))
    assert stores.load(spark, str(tmp_path / "x.parquet")).count() == 3
    (tmp_path / "c.yaml").write_text("a: {b: 1}")
    assert stores.load(spark, str(tmp_path / "c.yaml")) == {"a": {"b": 1}}
    for bad in ("x.pkl", "x.bin"):
        try:
            stores.load(spark, str(tmp_path / bad))
            raise AssertionError(bad)
        except ValueError:
            pass
    (tmp_path / "log.jsonl").write_text("\n".join(json.dumps({"frame": i, "inventory": [{"type": "coal", "quantity": q}]}) for i, q in enumerate((0, 0, 2, 1))))
    from detlake.operators import timeline

    q = timeline.item_quantities(stores.inventory_log(spark, str(tmp_path / "log.jsonl")), "coal").withColumn("e", F.lit(1))
    assert timeline.first_increase(q, ["e"]).first()["first_frame"] == 2


def test_cached_tables(spark, tmp_path):
    made = []
    make = lambda: made.append(1) or spark.range(4)
    for _ in range(2):
        assert sinks.cached(spark, str(tmp_path), make, a=1, b="x").count() == 4
    sinks.cached(spark, str(tmp_path), make, a=2, b="x")
    assert len(made) == 2


def test_nested_chunks(spark):
    df = spark.sql("""SELECT 'p' AS part, 0 AS ep_idx, 320 AS frame_offset, array(map(named_struct('frame', 330, 'event', 'mine_block:stone'), named_struct('event', 'mine_block:stone', 'rle_mask', '100 50',
      'point', named_struct('row', 180, 'col', 320), 'frame_range', named_struct('s', 300, 'e', 330), 'ori_frame_range', CAST(NULL AS STRUCT<s: INT, e: INT>)))) AS chunk""")
    r = keys.flatten_chunks(df).first()
    assert (r["slot"], r["key_frame"], r["event"], r["rle"], r["fr_e"], r["ofr_s"]) == (0, 330, "mine_block:stone", "100 50", 330, None)
    a = spark.sql("SELECT 'p' AS part, 0 AS ep_idx, 32 AS frame_offset, named_struct('attack', array(0, 1), 'use', array(1, 1)) AS chunk")
    assert sorted(tuple(x) for x in keys.flatten_actions(a).collect()) == [("p", 0, 32, 0, 1), ("p", 0, 33, 1, 1)]


def test_seams(spark, tmp_path):
    dark, gui = np.full((360, 640, 3), 30, "u1"), np.full((360, 640, 3), 20, "u1")
    gui[40:250, 130:510] = 190
    noise = np.random.default_rng(42).integers(10, 80, (360, 640, 3)).astype("u1")
    df = spark.createDataFrame([(i, 360, 640, bytearray(x.tobytes()) if x is not None else None) for i, x in enumerate((dark, gui, noise, None))], "frame int, height int, width int, pixels binary")
    assert {r["frame"]: r["flagged"] for r in seams.flag_gui(df).collect()} == {0: False, 1: True, 2: False, 3: False}
    chunks = spark.createDataFrame([("p", 0, 32, bytearray(b"abc"), 1)], "part string, ep_idx int, frame_offset int, value binary, local int")
    make = lambda: lambda data: [(1, 1, bytes([b])) for b in data]
    assert [r["frame"] for r in seams.decode_chunks(chunks, make).collect()] == [32, 33, 34] and [r["frame"] for r in seams.decode_chunks(chunks, make, True).collect()] == [33]
    req = spark.createDataFrame([("/a", 5), ("/a", 2), ("/b", 9)], "path string, local int")
    opened = lambda: lambda path: lambda i: (1, 1, path.encode()) if i < 9 else None
    assert sorted((r["path"], r["local"]) for r in seams.seek_frames(req, opened).collect()) == [("/a", 2), ("/a", 5)]
    ask = spark.createDataFrame([(1, b"x", "cow ."), (1, b"x", "dog .")], "image_id long, image binary, caption string")
    predictor = lambda: lambda image, caps: [([(.5, .5, .1, .1)], [[.9, .1]]) for _ in caps]
    assert seams.detect(ask, predictor).count() == 2
    out = str(tmp_path)
    write = lambda f, h, w, px: open(f"{out}/{f}", "wb").write(px) > 0
    assert seams.export_frames(df.where("pixels IS NOT NULL").withColumn("file", F.concat("frame", F.lit(".bin"))), write).where("written").count() == 3


def test_schema_rules(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "id int, w int")
    assert schema.violations(df, positive=F.col("w") > 0).first()["positive"] == 1
    assert schema.foreign_key_violations(df, "id", spark.range(2).withColumnRenamed("id", "k"), "k").count() == 1


def test_streams_agree_with_batches(spark, tmp_path):
    data = [(i, f"2024-01-0{1 + i % 3} 0{i % 10}:00:00", i % 4, float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(data, "event_id long, t string, user_id long, value double").withColumn("ts", F.to_timestamp("t")).drop("t")
    df.write.parquet(str(tmp_path / "in"))
    src = lambda: streaming.read_events(spark, str(tmp_path / "in"), df.schema)
    first = streaming.drain(streaming.keep_first(src(), ["user_id", "ts"]), str(tmp_path / "o1"), str(tmp_path / "c1"))
    assert first.count() == df.select("user_id", "ts").distinct().count()
    got = streaming.drain(streaming.windowed_counts(src(), ["user_id"], late="0 seconds"), str(tmp_path / "o2"), str(tmp_path / "c2"))
    want = df.groupBy(F.window("ts", "1 hour").start.alias("start"), "user_id").agg(F.count("*").alias("n"))
    assert got.join(want, ["start", "user_id", "n"], "left_anti").count() == 0 and got.count() > 0
    up = streaming.drain(streaming.running_increase(src(), "user_id"), str(tmp_path / "o3"), str(tmp_path / "c3"))
    assert {r["user_id"] for r in up.collect()} == {0, 1, 2, 3}
    seen = []
    streaming.commit_batches(src(), lambda b, i: seen.append((i, b.count())), str(tmp_path / "c4")).awaitTermination()
    assert sum(n for _, n in seen) == 60
    s = streaming.drain(streaming.sessions(src(), ["user_id"], late="0 seconds"), str(tmp_path / "o4"), str(tmp_path / "c5"))
    assert s.count() > 0
