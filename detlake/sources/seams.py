"""The only places where rows leave the JVM for pixels or a model.

Decoders and predictors are injected: the engine ships none.  Each is made once
per worker process and fed Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@lru_cache(maxsize=8)
def _once(make: Callable):
    return make()



def decode_chunks(chunks: DataFrame, make_decoder: Callable, wanted: bool = False) -> DataFrame:
    """Frames of video chunks (part, ep_idx, frame_offset, value[, local]): at most 32 rows a chunk.

    ``make_decoder()`` returns a function bytes -> list of (height, width, pixel
    bytes).  With ``wanted`` only frame ``local`` of each chunk is emitted.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = _once(make_decoder)
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                for i, (h, w, px) in enumerate(decode(r.value)):
                    if not wanted or i == r.local:
                        out.append((r.part, r.ep_idx, r.frame_offset + i, h, w, px))
            yield pd.DataFrame(out, columns=["part", "ep_idx", "frame", "height", "width", "pixels"])

    part, ep = chunks.schema["part"].dataType, chunks.schema["ep_idx"].dataType
    return chunks.mapInPandas(run, T.StructType().add("part", part).add("ep_idx", ep).add("frame", T.LongType()).add("height", T.IntegerType()).add("width", T.IntegerType()).add("pixels", T.BinaryType()))


def seek_frames(requests: DataFrame, make_reader: Callable) -> DataFrame:
    """Frames (path, local) of raw videos; a file is opened once for its run of requests.

    ``make_reader()`` returns open(path) -> reader(local) -> (height, width, pixels) or None.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opener, last, reader = _once(make_reader), None, None
        for pdf in frames:
            out = []
            for path, local in zip(pdf["path"], pdf["local"], strict=True):
                if path != last:
                    last, reader = path, opener(path)
                got = reader(int(local))
                if got is not None:
                    out.append((path, int(local), *got))
            yield pd.DataFrame(out, columns=["path", "local", "height", "width", "pixels"])

    from ..operators.align import by_file

    return by_file(requests.select("path", F.col("local").cast("long").alias("local"))).mapInPandas(run, "path string, local long, height int, width int, pixels binary")


# Fixed values of the overlay test: the part of a frame that is looked at (rows, columns), the channels of a grey pixel lie
# closer than SPREAD, a light pixel's mean lies between the two of LIGHT, and a frame with SHARE of such pixels is flagged.
ROWS, COLUMNS = (0.10, 0.70), (0.20, 0.80)
SPREAD, LIGHT, SHARE = 20, (130, 220), 0.20


def gui_share(frame: np.ndarray) -> float:
    """Share of grey, light pixels in the middle of a frame; whole numbers decide, since a mean is a sum over its channels."""
    (top, bottom), (left, right) = ([int(n * part) for part in ends] for n, ends in zip(frame.shape, (ROWS, COLUMNS), strict=False))
    channels = [frame[top:bottom, left:right, k].astype("i2") for k in range(frame.shape[2])]
    light = sum(channels)
    hits = (light > LIGHT[0] * len(channels)) & (light < LIGHT[1] * len(channels))
    for k, one in enumerate(channels):
        for other in channels[k + 1 :]:
            hits &= np.abs(one - other) < SPREAD
    return float(hits.mean())


def flag_gui(frames: DataFrame, threshold: float = SHARE) -> DataFrame:
    """``flagged``: an overlay covers the frame (height, width, pixels as bytes, three channels); missing pixels: not."""

    @F.pandas_udf(T.BooleanType())
    def flag(h: pd.Series, w: pd.Series, px: pd.Series) -> pd.Series:
        def one(a, b, c):
            return c is not None and len(c) > 0 and gui_share(np.frombuffer(c, "u1").reshape(int(a), int(b), 3)) >= threshold

        return pd.Series([one(*x) for x in zip(h, w, px, strict=True)])

    return frames.withColumn("flagged", flag("height", "width", "pixels"))


DETECTIONS = "cx double, cy double, w double, h double, probs array<double>"


def detect(df: DataFrame, make_predictor: Callable, image: str = "image", caption: str = "caption", key: str = "image_id") -> DataFrame:
    """(key, query, cx, cy, w, h, probs) from an injected predictor(image, captions) -> list of (boxes, token scores).

    Rows of one image stand together, so the predictor may keep its features across captions.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = _once(make_predictor)
        for pdf in frames:
            out = []
            for _, g in pdf.groupby(key, sort=False):
                for k, (bx, sc) in zip(g[key], predict(g[image].iloc[0], g[caption].tolist()), strict=True):
                    out += [(k, q, *map(float, b), [float(x) for x in s]) for q, (b, s) in enumerate(zip(bx, sc, strict=True))]
            yield pd.DataFrame(out, columns=[key, "query", "cx", "cy", "w", "h", "probs"])

    kind = df.schema[key].dataType.simpleString()
    return df.repartition(key).sortWithinPartitions(key).mapInPandas(run, f"{key} {kind}, query int, {DETECTIONS}")


def export_frames(frames: DataFrame, write: Callable, path: str = "file") -> DataFrame:
    """(file, written) after handing every frame to ``write(file, height, width, pixels) -> bool``.

    ``write`` returns False for a file that exists already, so a retried task writes nothing twice.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"file": pdf[path], "written": [bool(write(*r)) for r in zip(pdf[path], pdf["height"], pdf["width"], pdf["pixels"], strict=True)]})

    return frames.mapInPandas(run, "file string, written boolean")


def video_lengths(index: DataFrame, make_counter: Callable) -> DataFrame:
    """(stem, path, n_frames) with an injected counter(path) -> frames; never below zero. Store the result: it is a dimension."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = _once(make_counter)
        for pdf in batches:
            yield pdf.assign(n_frames=[max(0, int(count(p))) for p in pdf["path"]])[["stem", "path", "n_frames"]]

    return index.select("stem", "path").mapInPandas(run, "stem string, path string, n_frames int")
