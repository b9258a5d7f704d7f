"""Image files as rows, and batch inference with a model the caller supplies."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Model = Callable[[bytes], Sequence[float] | None]
BatchModel = Callable[[list[bytes]], Sequence[Sequence[float] | None]]


def read_images(spark: SparkSession, path: str, glob: str = "*.{jpg,jpeg,png}") -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(path)
            .select("path", "length", "modificationTime", "content"))


def bulk_infer(images: DataFrame, model_factory: Callable[[], Model], keys: Sequence[str],
               content: str = "content") -> DataFrame:
    """One embedding per image, null where the model fails or finds nothing.

    The model is made once per task. Rows keep their keys, so the input order can be
    restored from them whatever the partitioning.
    """
    keep = list(keys)
    fields = [images.schema[k] for k in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def infer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_factory()

        def one(data: bytes | None) -> list[float] | None:
            if data is None:
                return None
            try:
                vector = model(bytes(data))
            except Exception:  # a broken image must not stop the others
                return None
            return None if vector is None else [float(x) for x in vector]

        for pdf in batches:
            out = pdf[keep].copy()
            out["embedding"] = pd.Series([one(b) for b in pdf[content]], index=pdf.index,
                                         dtype=object)
            yield out

    return images.select(*keep, F.col(content)).mapInPandas(
        infer, f"{schema}, embedding array<float>")


def runs_of(contents: Sequence[bytes | None], batch_size: int, batch_bytes: int) -> Iterator[list[int]]:
    """Places of the images that are there, in runs of bounded number and size; a larger image is a run of its own."""
    held, size = [], 0
    for i, data in enumerate(contents):
        if data is None:
            continue
        if held and (len(held) >= batch_size or size + len(data) > batch_bytes):
            yield held
            held, size = [], 0
        held.append(i)
        size += len(data)
    if held:
        yield held


def batch_infer(images: DataFrame, model_factory: Callable[[], BatchModel], keys: Sequence[str],
                content: str = "content", batch_size: int = 8, batch_bytes: int = 64 << 20) -> DataFrame:
    """One embedding per image from a model that takes lists of images; null where it fails or finds nothing.

    The model is made once per task and gets at most ``batch_size`` images and ``batch_bytes`` bytes at once.
    Where it fails on a list, that list's images are given to it one by one, so that a broken image
    costs only its own result.
    """
    keep = list(keys)
    schema = ", ".join(f"`{k}` {images.schema[k].dataType.simpleString()}" for k in keep)

    def infer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_factory()

        def vectors(data: list[bytes]) -> list:
            try:
                found = list(model(data))
                if len(found) != len(data):
                    raise ValueError(f"{len(found)} results for {len(data)} images")
                return [None if v is None else [float(x) for x in v] for v in found]
            except Exception:  # a broken image must not stop the others
                return [None] if len(data) == 1 else [vectors([d])[0] for d in data]

        for pdf in batches:
            contents = list(pdf[content])
            found = [None] * len(contents)
            for places in runs_of(contents, batch_size, batch_bytes):
                for i, v in zip(places, vectors([bytes(contents[i]) for i in places]), strict=True):
                    found[i] = v
            out = pdf[keep].copy()
            out["embedding"] = pd.Series(found, index=pdf.index, dtype=object)
            yield out

    return images.select(*keep, F.col(content)).mapInPandas(infer, f"{schema}, embedding array<float>")
