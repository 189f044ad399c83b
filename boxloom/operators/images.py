"""Pixel work: cutting boxes out of decoded images."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom.operators import groups
from boxloom.operators.rollup import gathered

# Bytes of crops that a task hands on at once.
CROP_BYTES = 16 << 20


def pixel_crops(
    images: DataFrame, rectangles: DataFrame, image: str = "im_id", limit: int = 64, pixels: Column | None = None
) -> DataFrame:
    """Pixels of each rectangle cx1..cy2; empty rectangles give no row.

    Rectangles travel to the image, not pixels to every rectangle: they are
    gathered per image in parts of at most ``limit``, joined once, and sliced.
    ``pixels`` decodes them from other columns of ``images``, after the join, so that no pixels are shuffled or sorted;
    an image of more than ``limit`` rectangles is decoded once for each part.  Without it ``images`` has a column of that name.
    """
    wanted = rectangles.filter((F.col("cx2") > F.col("cx1")) & (F.col("cy2") > F.col("cy1")))
    element = F.struct(F.col("pos").alias("box_no"), "name", "cx1", "cy1", "cx2", "cy2")
    listed = gathered(wanted, [image], "pos", element)
    starts = F.sequence(F.lit(1), F.size("items"), F.lit(limit))
    listed = listed.withColumn("items", F.explode(F.transform(starts, lambda at: F.slice("items", at, limit))))
    # Pixel columns are far larger than size estimates say: never broadcast them.
    columns = [image, "image_h", "image_w", "channels"]
    sources = images if pixels is not None else images.select(*columns, "pixels")
    joined = groups.join_on(sources, listed.hint("merge"), [image])
    if pixels is not None:
        joined = joined.withColumn("pixels", pixels)
    schema = T.StructType(
        [
            images.schema[image],
            T.StructField("box_no", T.LongType()),
            T.StructField("name", T.StringType()),
            T.StructField("crop_h", T.IntegerType()),
            T.StructField("crop_w", T.IntegerType()),
            T.StructField("channels", T.IntegerType()),
            T.StructField("crop", T.BinaryType()),
        ]
    )

    def parts(frame: pa.RecordBatch, rows: np.ndarray, boxes: pa.StructArray) -> Iterator[tuple[int, list[np.ndarray]]]:
        """Crops of consecutive rectangles and the place of the first one."""
        height, width, depth = [frame.column(c).to_numpy() for c in ("image_h", "image_w", "channels")]
        x1, y1, x2, y2 = [boxes.field(c).to_pylist() for c in ("cx1", "cy1", "cx2", "cy2")]
        out, begin, held, last, grid = [], 0, 0, -1, None
        for n, row in enumerate(rows.tolist()):
            if row != last:
                pixels_of = np.frombuffer(frame.column("pixels")[row].as_buffer(), dtype=np.uint8)
                last, grid = row, pixels_of.reshape(height[row], width[row], depth[row])
            out.append(grid[y1[n] : y2[n], x1[n] : x2[n]])
            held += out[-1].size
            if held >= CROP_BYTES:
                yield begin, out
                out, begin, held = [], n + 1, 0
        if out:
            yield begin, out

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches:
            items = frame.column("items")
            rows, boxes = np.repeat(np.arange(len(items)), np.diff(items.offsets.to_numpy())), items.flatten()
            for begin, crops in parts(frame, rows, boxes):
                at, own = rows[begin : begin + len(crops)], boxes.slice(begin, len(crops))
                yield pa.RecordBatch.from_arrays(
                    [
                        frame.column(image).take(pa.array(at)),
                        own.field("box_no").cast(pa.int64()),
                        own.field("name"),
                        pa.array([c.shape[0] for c in crops], pa.int32()),
                        pa.array([c.shape[1] for c in crops], pa.int32()),
                        frame.column("channels").take(pa.array(at)).cast(pa.int32()),
                        pa.array([c.tobytes() for c in crops], pa.binary()),
                    ],
                    names=[f.name for f in schema],
                )

    return joined.select(*columns, "pixels", "items").mapInArrow(cut, schema)
