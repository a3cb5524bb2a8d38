import pytest
from pyspark.sql import functions as F

from detlake.functions import captions, frames, labels, vectors


@pytest.mark.parametrize("event, first, last", [
    ("mine_block:coal_ore", "coal_ore", "coal_ore"), ("minecraft.mine_block:minecraft.coal_ore", "coal_ore", "coal_ore"), ("right_click", None, None), ("landmark", None, None),
    ("custom:open_chest", None, None), ("craft:crafting_table", None, None), ("", None, None), (None, None, None), ("a:b:c", "b:c", "c"), ("a:", None, ""), (" cow ", "cow", "cow"),
])
def test_event_labels(one, event, first, last):
    e = F.lit(event).cast("string")
    assert one(a=labels.event_label(e), b=labels.event_label(e, "last")) == {"a": first, "b": last}


def test_extra_exclusions(one):
    assert one(a=labels.event_label(F.lit("use:door"), "last", ("use",)))["a"] is None


@pytest.mark.parametrize("name, prefix, ts", [("Player122-f153ac423f61-20211217-140509", "Player122-f153ac423f61-20211217", "140509"), ("Player122-abc", "Player122-abc", ""), ("episode", "episode", "")])
def test_episode_prefix(one, name, prefix, ts):
    assert one(p=labels.episode_prefix(F.lit(name)))["p"] == {"prefix": prefix, "ts": ts}


def test_small_functions(one):
    got = one(
        part=F.array(labels.part_number(F.lit("part-950")), labels.part_number(F.lit("x"))), cap=labels.caption_text(F.lit(" A Cow ")), file=labels.frame_file(F.lit("d"), F.lit("p-1"), F.lit(3), F.lit(42)),
        align=F.array(labels.align_label(F.lit("ground")), labels.align_label(F.lit("cow"))), cls=labels.phrase_class(F.lit("a red cow"), F.array(F.lit("dog"), F.lit("cow"))), none=labels.phrase_class(F.lit("x"), F.array(F.lit("dog"))),
        half=F.array(labels.python_round(F.lit(2.5)), labels.python_round(F.lit(3.5))), key=labels.parse_key(F.lit("(3, 64)")), bad=labels.parse_key(F.lit("__meta__")), raw=labels.decode_key(F.unhex(F.lit("ff00"))),
        show=labels.display_phrase(F.lit("a cow."), F.lit(0.8765)), strip=labels.strip_prefix(F.create_map(F.lit("module.w"), F.lit(1), F.lit("b"), F.lit(2))), compact=labels.sparse_to_compact(F.array(F.lit(9), F.lit(3), F.lit(9))),
        pre=labels.has_prefix(F.lit("backbone.x"), F.array(F.lit("bert"), F.lit("back"))),
    )
    assert got["part"] == [950, 0] and got["cap"] == "a cow." and got["file"] == "d_p-1_ep3_f000042.png" and got["align"] == ["dirt", "cow"] and got["cls"] == 1 and got["none"] is None
    assert got["half"] == [2, 4] and got["key"] == {"ep_idx": 3, "frame_offset": 64} and got["bad"] == {"ep_idx": None, "frame_offset": None} and got["raw"] == "ff00"
    assert got["show"] == "a cow(0.87)" and got["strip"] == {"w": 1, "b": 2} and got["compact"] == {3: 0, 9: 1} and got["pre"] is True


def test_caption_spans(one):
    cats = F.array(*[F.struct(F.lit(i).cast("long").alias("id"), F.lit(n).alias("name")) for i, n in ((1, "stone"), (2, "coal_ore"), (3, "granite"))])
    got = one(m=captions.caption_and_spans(cats))["m"]
    assert got["caption"] == "stone . coal ore . granite ."
    words = {s["id"]: [got["caption"][x["beg"] : x["end"]] for x in s["spans"]] for s in got["spans"]}
    assert words == {1: ["stone"], 2: ["coal", "ore"], 3: ["granite"]}
    named = one(m=captions.captions_by_name(F.array(F.lit("Stone"), F.lit(" "), F.lit("Coal Ore"))))["m"]
    assert named["caption"] == "stone . coal ore ." and [named["caption"][x["beg"] : x["end"]] for x in named["spans"]["coal ore"]] == ["coal", "ore"]


def test_positive_map_and_segments(one):
    offsets = F.array(*[F.struct(F.lit(a).alias("beg"), F.lit(b).alias("end")) for a, b in ((0, 5), (6, 7), (8, 12))])
    span = F.array(F.struct(F.lit(0).alias("beg"), F.lit(5).alias("end")), F.struct(F.lit(8).alias("beg"), F.lit(12).alias("end")))
    ids = F.array(*map(F.lit, (101, 7, 8, 1012, 9, 1012, 102)))
    got = one(p=captions.positive_map(span, offsets, 4), seg=captions.segment_of(ids, F.lit(2)), tok=captions.token_segments(ids, (1012,)), mask=captions.segment_mask(captions.token_segments(F.array(F.lit(1), F.lit(1012), F.lit(2)), (1012,))))
    assert got["p"] == pytest.approx([.5, 0, .5, 0], abs=1e-5) and got["seg"] == {"left": 0, "right": 3}
    assert [(t["segment"], t["position"]) for t in got["tok"]] == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 0), (1, 1), (2, 0)]
    assert got["mask"] == [[True, True, False], [True, True, False], [False, False, True]]


@pytest.mark.parametrize("expr, want", [
    (lambda: frames.before(F.lit(100), 8), list(range(92, 100))), (lambda: frames.before(F.lit(3), 8), [0, 1, 2]), (lambda: frames.before(F.lit(0), 8), []),
    (lambda: frames.early(F.lit(100), F.lit(130)), list(range(100, 108))), (lambda: frames.early(F.lit(100), F.lit(103)), [100, 101, 102]), (lambda: frames.early(F.lit(100), F.lit(101)), [100]),
    (lambda: frames.backtrack(F.lit(534), F.lit(613), 4, 8), [601, 602, 603, 604]), (lambda: frames.backtrack(F.lit(534), F.lit(613), 4, 0), [609, 610, 611, 612]), (lambda: frames.backtrack(F.lit(534), F.lit(613), 4, 12), [597, 598, 599, 600]),
    (lambda: frames.backtrack(F.lit(600), F.lit(613), 10, 8), [600, 601, 602, 603, 604]), (lambda: frames.backtrack(F.lit(608), F.lit(613), 4, 8), []), (lambda: frames.training(F.lit(10), F.lit(12), 4, 0), [10, 11, 12]),
    (lambda: frames.training(F.lit(100), F.lit(120), 4, 4), [100, 105, 111, 116]), (lambda: frames.trailing(F.lit(5), F.lit(9), 3), [7, 8, 9]),
])
def test_frame_selection(one, expr, want):
    assert one(f=expr())["f"] == want


def test_vectors(one):
    a = F.array(*map(F.lit, (1.0, 3.0, 2.0)))
    got = one(s=vectors.softmax(a), m=vectors.argmax(a), up=vectors.above(a, 1.5), inv=vectors.inverse_sigmoid(vectors.sigmoid(F.lit(1.25))), e=vectors.expectation(F.array(F.lit(0.0), F.lit(10.0)), F.array(F.lit(1.0), F.lit(3.0))),
              px=vectors.restore_pixels(vectors.normalise_pixels(a, (.1, .2, .3), (.5, .5, .5)), (.1, .2, .3), (.5, .5, .5)), emb=vectors.sine_embeddings(F.array(F.lit(.25), F.lit(.5)), 4), mf=vectors.multi_frequency(F.lit(0.0), 2))
    assert sum(got["s"]) == pytest.approx(1) and got["m"] == 1 and got["up"] == [1, 2] and got["inv"] == pytest.approx(1.25) and got["e"] == 7.5
    assert got["px"] == pytest.approx([1, 3, 2]) and len(got["emb"]) == 8 and got["emb"][4] == pytest.approx(1.0) and got["mf"] == [0, 0, 1, 0, 1]


def test_two_places_as_the_binary_value_has_it(spark):
    import random

    from pyspark.sql import functions as F

    from detlake.functions import labels

    rng = random.Random(5)
    values = [k * 0.005 for k in range(-3000, 3000)] + [2.675, 1.005, 0.125, 0.375, -0.125, 1e12 + 0.125, 3e13 + 0.25, 0.0] + [round(rng.uniform(-700, 700), 3) for _ in range(3000)] + [rng.uniform(-1e5, 1e5) for _ in range(2000)]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", labels.export_round(F.col("v")).alias("r")).collect()
    wrong = [(values[r["i"]], r["r"]) for r in got if abs(values[r["i"]]) < 1e13 and r["r"] != round(values[r["i"]], 2)]
    assert not wrong, wrong[:5]
    assert spark.range(1).select(labels.export_round(F.lit(None).cast("double")).alias("r")).first()["r"] is None
