"""Joins between episode stores: by name, by key, by nearest number, by offset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.labels import chunk_of, episode_prefix, part_number
from .keys import first_wins, last_wins


def align_episodes(seg: DataFrame, img: DataFrame) -> DataFrame:
    """Episodes of both stores by name; where a name repeats among images, the last (part, ep_idx) counts.

    Columns episode, seg_part, seg_ep, img_part, img_ep.  Inputs: part, ep_idx, episode.
    """
    image = last_wins(img.select("episode", "part", "ep_idx"), ["episode"], ["part", "ep_idx"])
    return seg.select("episode", F.col("part").alias("seg_part"), F.col("ep_idx").alias("seg_ep")).join(
        image.select("episode", F.col("part").alias("img_part"), F.col("ep_idx").alias("img_ep")), "episode"
    )


def matched_only(observations: DataFrame, matched: DataFrame, on: Sequence[str] = ("part", "ep_idx")) -> DataFrame:
    """Semi-join reduction before anything is decoded."""
    return observations.join(matched.select(*on).distinct(), list(on), "left_semi")


def with_episode(observations: DataFrame, episodes: DataFrame) -> DataFrame:
    """Episode name by (part, ep_idx)."""
    named = episodes.where(F.col("ep_idx").isNotNull() & (F.coalesce(F.col("episode"), F.lit("")) != ""))
    return observations.join(named.select("part", "ep_idx", "episode"), ["part", "ep_idx"])


def with_actions(events: DataFrame, actions: DataFrame) -> DataFrame:
    """Action store of each event by episode name; ``reason`` says where there is none."""
    index = last_wins(actions.select("episode", F.col("part").alias("act_part"), F.col("ep_idx").alias("act_ep")), ["episode"], ["act_part", "act_ep"])
    joined = events.join(index, "episode", "left")
    return joined.withColumn("reason", F.when(F.col("act_part").isNull(), "no_action_data"))


def nearest_partition(seg: DataFrame, src: DataFrame) -> DataFrame:
    """For each segmentation part the source part with the nearest number; ties to the earlier source, equal numbers to the later name.

    Inputs and output hold names (part; part); a number without a neighbour is
    found from the ordered union of both, so nothing is multiplied out.
    """
    source = src.select(F.col("part").alias("src_part"), part_number(F.col("part")).alias("n"))
    source = last_wins(source, ["n"], ["src_part"])
    mine = seg.select(F.col("part").alias("seg_part"), part_number(F.col("part")).alias("n")).distinct()
    both = mine.select("n", "seg_part", F.lit(None).cast("string").alias("src_part")).unionByName(source.select("n", F.lit(None).cast("string").alias("seg_part"), "src_part"))
    w = Window.orderBy("n")  # names of partitions: a small dimension
    at = F.when(F.col("src_part").isNotNull(), F.struct("n", "src_part"))
    lo = F.last(at, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    hi = F.first(at, ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing))
    found = both.withColumn("lo", lo).withColumn("hi", hi).where(F.col("seg_part").isNotNull())
    low_gap, high_gap = F.col("n") - F.col("lo.n"), F.col("hi.n") - F.col("n")
    lower = F.col("hi").isNull() | (low_gap < high_gap) | ((low_gap == high_gap) & (F.col("lo.src_part") <= F.col("hi.src_part")))
    pick = F.when(F.col("lo").isNotNull() & lower, F.col("lo")).otherwise(F.col("hi"))
    return found.select("seg_part", pick["src_part"].alias("src_part"), F.abs(F.col("n") - pick["n"]).alias("gap"))


def point_lookup(requests: DataFrame, chunks: DataFrame, frame: str = "frame") -> DataFrame:
    """Chunk of every requested frame by an equality join on (part, ep_idx, frame_offset); ``local`` is the place in it."""
    offset, local = chunk_of(F.col(frame))
    return requests.withColumn("frame_offset", offset).withColumn("local", local).join(chunks, ["part", "ep_idx", "frame_offset"], "left")


def frames_with_masks(frames: DataFrame, observations: DataFrame, order: Sequence[str] = ("key_frame",)) -> DataFrame:
    """Masks of selected frames, same event; the last matching observation of a frame counts."""
    keys = ["part", "ep_idx", "event", "frame"]
    return frames.join(last_wins(observations, keys, list(order)), keys)


def mask_by_event(requests: DataFrame, observations: DataFrame) -> DataFrame:
    """First observation at (part, ep_idx, frame) whose event is, or whose key contains, the one asked for."""
    o = observations.select("part", "ep_idx", "frame", F.col("event").alias("seen"), F.col("key_frame").alias("seen_key"), "rle", "point_row", "point_col")
    hits = requests.join(o, ["part", "ep_idx", "frame"]).where((F.col("seen") == F.col("event")) | F.contains(F.concat_ws(",", "seen_key", "seen"), F.col("event")))
    return first_wins(hits, ["part", "ep_idx", "frame", "event"], ["seen_key", "seen"])


def decoded(frames: DataFrame, images: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(frames with their image, one-row count of frames without)."""
    keys = images.select(*on).distinct()
    return frames.join(images, list(on)), frames.join(keys, list(on), "left_anti").agg(F.count("*").alias("missing"))


def without_flagged(annotations: DataFrame, flags: DataFrame, on: Sequence[str] = ("part", "ep_idx", "frame")) -> DataFrame:
    """Annotations whose frame isn't flagged; a frame that was never looked at stays."""
    return annotations.join(flags.where("flagged").select(*on).distinct(), list(on), "left_anti")


def by_file(requests: DataFrame, path: str = "path", order: Sequence[str] = ("local",)) -> DataFrame:
    """Requests of one file in one task, in reading order."""
    return requests.repartition(path).sortWithinPartitions(path, *order)


def video_index(files: DataFrame) -> DataFrame:
    """(stem, path): the first path of each file name without its ending."""
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    return files.select(stem.alias("stem"), "path").groupBy("stem").agg(F.min("path").alias("path"))


def find_video(index: DataFrame, episodes: DataFrame) -> DataFrame:
    """Path of each episode's own file, null if it has none."""
    return episodes.join(index.withColumnRenamed("stem", "episode"), "episode", "left")


def offset_table(videos: DataFrame, episodes: DataFrame) -> DataFrame:
    """(episode, path, start, end): where each chunk of an episode's session lies on its frame axis.

    Chunks share the episode's prefix and start no earlier (compared as text);
    empty ones are left out; lengths add up in the order of their names.
    """
    v = videos.where("n_frames > 0").select(episode_prefix(F.col("stem")).alias("p"), "stem", "path", "n_frames")
    v = v.select(F.col("p.prefix").alias("prefix"), F.col("p.ts").alias("ts"), "stem", "path", "n_frames")
    e = episodes.select("episode").distinct().withColumn("p", episode_prefix(F.col("episode"))).select("episode", F.col("p.prefix").alias("prefix"), F.col("p.ts").alias("from_ts"))
    own = e.join(v, "prefix").where(F.col("ts") >= F.col("from_ts"))
    upto = F.sum("n_frames").over(Window.partitionBy("episode").orderBy("ts", "stem", "path").rowsBetween(Window.unboundedPreceding, 0))
    return own.withColumn("end", upto).select("episode", "path", (F.col("end") - F.col("n_frames")).alias("start"), "end")


def locate(requests: DataFrame, offsets: DataFrame, bucket: int | None = None) -> DataFrame:
    """(path, local) of global frames (episode, frame); null outside all chunks.

    ``bucket`` adds frame div bucket to the equality keys, for episodes of very many chunks.
    """
    if bucket is None:
        cond = (requests["episode"] == offsets["episode"]) & (requests["frame"] >= offsets["start"]) & (requests["frame"] < offsets["end"])
        o = offsets
    else:
        o = offsets.withColumn("_b", F.explode(F.sequence(F.floor(F.col("start") / bucket), F.floor((F.col("end") - 1) / bucket))))
        cond = (requests["episode"] == o["episode"]) & (F.floor(requests["frame"] / bucket) == o["_b"]) & (requests["frame"] >= o["start"]) & (requests["frame"] < o["end"])
    return requests.join(o, cond, "left").select(*[requests[c] for c in requests.columns], o["path"], (requests["frame"] - o["start"]).alias("local"))


def image_index(keys: DataFrame) -> DataFrame:
    """Parts that hold each (ep_idx, frame_offset), in order."""
    return keys.groupBy("ep_idx", "frame_offset").agg(F.array_sort(F.collect_set("part")).alias("parts"))
