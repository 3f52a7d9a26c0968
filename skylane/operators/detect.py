"""Object detection over image bytes with a pluggable predictor."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane import schemas
from skylane.functions import measures, records, timeparts

# Called once per task; gives a function from a batch of image bytes to as many results:
# ((height, width), [(class_id, score, (x1, y1, x2, y2)), …]), or None for bytes
# that cannot be decoded.
PredictorFactory = Callable[[], Callable[[list[bytes]], "list[tuple[Sequence[int], list] | None]"]]

_RAW_OBJECT = "struct<class_id: int, confidence: double, coordinates: array<double>>"


def detect(
    images: DataFrame,
    make_predictor: PredictorFactory,
    keys: Sequence[str],
    content: str = "content",
    class_ids: Iterable[int] = tuple(records.TRAFFIC_CLASSES),
    class_names: dict[int, str] = records.TRAFFIC_CLASSES,
) -> DataFrame:
    """Detections of every image: ``keys``, ``image_shape``, ``total``, ``objects``.

    Python only runs the model. Class filter, names, rounding and counting are column
    expressions on its output. An undecodable image keeps its row with NULL shape,
    total and objects. Images arrive in Arrow batches bounded by
    ``spark.sql.execution.arrow.maxBytesPerBatch``.
    """
    keys = list(keys)
    narrow = images.select(*keys, F.col(content).alias("_content"))
    out = T.StructType([
        *[narrow.schema[k] for k in keys],
        T.StructField("image_shape", T.ArrayType(T.IntegerType())),
        T.StructField("raw", T.ArrayType(T.DataType.fromDDL(_RAW_OBJECT))),
    ])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = make_predictor()
        for batch in batches:
            blobs = list(batch.pop("_content"))
            results = iter(predict([blob for blob in blobs if blob is not None]))
            found = [None if blob is None else next(results) for blob in blobs]
            batch["image_shape"] = [None if f is None else [int(n) for n in f[0]] for f in found]
            batch["raw"] = [
                None if f is None else [
                    {"class_id": int(c), "confidence": float(s), "coordinates": [float(v) for v in box]}
                    for c, s, box in f[1]
                ]
                for f in found
            ]
            yield batch

    raw = narrow.mapInPandas(run, out)
    objects = F.transform(
        records.keep_classes("raw", class_ids),
        lambda o: F.struct(
            o["class_id"].alias("class_id"),
            records.class_name(o["class_id"], class_names).alias("class_object"),
            records.class_name(o["class_id"], class_names).alias("classname"),
            measures.round_score(o["confidence"]).alias("confidence"),
            o["coordinates"].alias("coordinates"),
        ),
    ).cast(schemas.DETECTION["objects"].dataType)
    return raw.select(*keys, "image_shape", objects.alias("objects")).select(
        *keys,
        "image_shape",
        F.array_size("objects").alias("total"),
        "objects",
    )


def traffic_events(
    detections: DataFrame, bucket: str, cam_id: str = "cam_id", district: str = "district",
    taken_at: str = "taken_at", zone: str | None = None,
) -> DataFrame:
    """Detection rows as raw traffic events, ready to publish."""
    return detections.select(
        F.col(cam_id).alias("cam_id"),
        timeparts.image_path(bucket, cam_id, taken_at, zone).alias("img"),
        F.col(district).alias("district"),
        timeparts.iso_text(taken_at, zone).alias("timestamp"),
        "image_shape", "total", "objects",
    )
