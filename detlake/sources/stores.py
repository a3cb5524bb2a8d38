"""Episode stores, file listings, logs and generic documents."""

from __future__ import annotations

import pathlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.labels import decode_key, parse_key, part_number
from ..operators.sample import cap_per_group, take_first, take_uniform


def parts(listing: DataFrame, base: str, marker: str = "data.mdb") -> DataFrame:
    """(part, path) of the store folders in a file listing: ``base`` itself if it holds the marker, and its children.

    Works on a listing (column path), so it needs no access of the driver to the store.
    """
    folder = F.regexp_replace(F.regexp_extract("path", r"^(.*)/[^/]*$", 1), "/+$", "")
    root = base.rstrip("/")
    found = listing.where(F.element_at(F.split("path", "/"), -1) == marker).select(folder.alias("path")).distinct()
    inside = found.where((F.col("path") == root) | (F.regexp_extract("path", r"^(.*)/[^/]*$", 1) == root))
    return inside.select(F.element_at(F.split("path", "/"), -1).alias("part"), "path").orderBy("path")


def store_folders(listing: DataFrame, marker: str = "data.mdb") -> DataFrame:
    """Every folder, at any depth, that holds a marker file."""
    return listing.where(F.element_at(F.split("path", "/"), -1) == marker).select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("path")).distinct().orderBy("path")


def file_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length) of files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length")


def scan_kv(kv: DataFrame) -> DataFrame:
    """Data entries of a key-value store: key text parsed, reserved keys (``__``) left out."""
    rows = kv.withColumn("key", decode_key(F.col("key").cast("binary"))).where(~F.col("key").startswith("__"))
    return rows.withColumn("_k", parse_key(F.col("key"))).select(*[c for c in kv.columns if c != "value"], F.col("_k.ep_idx").alias("ep_idx"), F.col("_k.frame_offset").alias("frame_offset"), "value")


def reserved(kv: DataFrame) -> DataFrame:
    """Metadata entries of a key-value store."""
    rows = kv.withColumn("key", decode_key(F.col("key").cast("binary")))
    return rows.where(F.col("key").startswith("__"))


def episode_dim(kv: DataFrame, key: str = "__chunk_infos__") -> DataFrame:
    """Episodes from JSON metadata entries: the index may be called episode_idx or idx; unnamed ones are left out."""
    info = "ARRAY<STRUCT<episode: STRING, episode_idx: INT, idx: INT, num_frames: INT>>"
    rows = reserved(kv).where(F.col("key") == key).select("store", "part", F.inline(F.from_json(F.col("value").cast("string"), info)))
    out = rows.select(F.col("store").alias("kind"), "part", F.coalesce("episode_idx", "idx").alias("ep_idx"), "episode", "num_frames")
    return out.where(F.col("ep_idx").isNotNull() & (F.coalesce(F.col("episode"), F.lit("")) != ""))


def decode_value(value: Column) -> Column:
    """Struct (json, raw): the value as JSON text if it is, else a note of its size. Pickles are never opened."""
    text = F.try_validate_utf8(value.cast("string"))
    json = F.when(F.try_parse_json(text).isNotNull(), text)
    return F.struct(json.alias("json"), F.when(json.isNull(), F.concat(F.lit("<raw "), F.octet_length(value).cast("string"), F.lit(" bytes>"))).alias("raw"))


def inspect(kv: DataFrame, keys: int = 5) -> DataFrame:
    """(store, part, entries, bytes, first_keys) of every store."""
    named = kv.withColumn("key", decode_key(F.col("key").cast("binary")))
    size = named.groupBy("store", "part").agg(F.count("*").alias("entries"), F.sum(F.octet_length("value")).alias("bytes"))
    first = cap_per_group(named.select("store", "part", "key"), ["store", "part"], keys, ["key"]).groupBy("store", "part").agg(F.array_sort(F.collect_list("key")).alias("first_keys"))
    return size.join(first, ["store", "part"], "left")


def value_types(kv: DataFrame) -> DataFrame:
    """Types of the JSON values of every store, each with how often it occurs."""
    text = decode_value(F.col("value").cast("binary"))["json"]
    shape = F.coalesce(F.schema_of_variant(F.try_parse_json(text)), F.lit("BINARY"))
    return kv.groupBy("store", "part", shape.alias("type")).agg(F.count("*").alias("n"))


def sample_store(kv: DataFrame, n: int, how: str = "first") -> DataFrame:
    """``n`` entries by key: the first, or evenly spread."""
    return (take_first if how == "first" else take_uniform)(kv, n, ["key"])


def copy_keys(kv: DataFrame, keys: DataFrame) -> DataFrame:
    """Metadata and the listed entries (part, ep_idx, frame_offset) of a store."""
    listed = keys.select("part", F.format_string("(%d, %d)", "ep_idx", "frame_offset").alias("_key")).distinct()
    named = kv.withColumn("_key", decode_key(F.col("key").cast("binary")))
    meta = named.where(F.col("_key").startswith("__"))
    return meta.unionByName(named.join(listed, ["part", "_key"], "left_semi").select(*named.columns)).drop("_key")


def ordered_parts(dim: DataFrame) -> DataFrame:
    """Parts by their number, then name."""
    return dim.withColumn("n", part_number(F.col("part"))).orderBy("n", "part")


def video_source(video_parts: DataFrame, image_parts: DataFrame) -> tuple[str, DataFrame]:
    """Videos if there are any, else images."""
    return ("video", video_parts) if not video_parts.isEmpty() else ("image", image_parts)


def inventory_log(spark: SparkSession, path: str) -> DataFrame:
    """Inventory log, one JSON object a line; lines carry their frame."""
    return spark.read.schema(schema.INVENTORY).json(path)


def frame_numbered(lines: DataFrame, order: str) -> DataFrame:
    """Log lines of one recording with their line number as frame, for logs that lack it."""
    from ..operators.keys import dense_numbers

    return dense_numbers(lines, [F.col(order)], "frame", 0)


def load(spark: SparkSession, path: str, **options):
    """A document by its ending: JSON, CSV, Parquet, ORC and text as DataFrames; YAML as an object; pickles are refused."""
    kind = pathlib.PurePosixPath(path).suffix.lower().lstrip(".")
    if kind in ("json", "jsonl", "csv", "parquet", "orc", "txt"):
        reader = spark.read.options(**options)
        if kind == "json":
            reader = reader.option("multiLine", True)
        return reader.format({"jsonl": "json", "txt": "text"}.get(kind, kind)).load(path)
    if kind in ("yaml", "yml"):
        import yaml

        rows = spark.read.option("wholetext", True).text(path).first()  # a configuration file
        return yaml.safe_load(rows[0])
    raise ValueError(f"files of kind {kind!r} are not opened")


def dump(df: DataFrame, path: str) -> None:
    """A DataFrame by its ending, replacing what is there."""
    kind = pathlib.PurePosixPath(path).suffix.lower().lstrip(".")
    if kind not in ("json", "jsonl", "csv", "parquet", "orc"):
        raise ValueError(f"files of kind {kind!r} are not written")
    df.write.mode("overwrite").format({"jsonl": "json"}.get(kind, kind)).save(path)


def random_images(listing: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` files by a seeded hash of their path."""
    return listing.orderBy(F.xxhash64("path", F.lit(seed)), "path").limit(n)


def image_files(spark: SparkSession, path: str, pattern: str = "*.png") -> DataFrame:
    """(file_name, content) of images below a folder, for a decoding seam."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "content")
