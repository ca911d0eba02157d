"""Saved models that are made of plain values, other models, and for neighbours a table.

They are written and read like any stage, so a ``Pipeline`` may hold them.
"""

from __future__ import annotations

from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import SparkSession


class PartsWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        model, spark = self.instance, SparkSession.getActiveSession()
        plain = {name: getattr(model, name) for name in model.PLAIN}
        sizes = {}
        for name in model.PARTS:
            value = getattr(model, name)
            parts = list(value.values()) if isinstance(value, dict) else value if isinstance(value, list) else [value]
            keys = list(value) if isinstance(value, dict) else None
            sizes[name] = {"n": len(parts), "keys": keys, "one": not isinstance(value, (dict, list))}
            for i, part in enumerate(parts):
                part.write().save(f"{path}/parts/{name}/{i}")
        DefaultParamsWriter.saveMetadata(model, path, spark, extraMetadata={"plain": plain, "sizes": sizes})


class PartsReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        spark = SparkSession.getActiveSession()
        meta = DefaultParamsReader.loadMetadata(path, spark)
        given = dict(meta["plain"])
        for name, size in meta["sizes"].items():
            parts = [DefaultParamsReader.loadParamsInstance(f"{path}/parts/{name}/{i}", spark) for i in range(size["n"])]
            given[name] = parts[0] if size["one"] else dict(zip(size["keys"], parts)) if size["keys"] is not None else parts
        model = self.cls(**given)
        model._resetUid(meta["uid"])
        return model


class SavedInParts(MLWritable, MLReadable):
    """For models whose constructor takes the attributes in PLAIN (values for JSON) and PARTS (models, lists or dicts)."""

    PLAIN: tuple[str, ...] = ()
    PARTS: tuple[str, ...] = ()

    def write(self) -> PartsWriter:
        return PartsWriter(self)

    @classmethod
    def read(cls) -> PartsReader:
        return PartsReader(cls)


class TableWriter(DefaultParamsWriter):
    """Parameters as usual, and the attribute ``train`` as Parquet beside them."""

    def __init__(self, instance):
        super().__init__(instance)
        self.model = instance

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.model.train.write.parquet(f"{path}/train")


class TableReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.train = SparkSession.getActiveSession().read.parquet(f"{path}/train")
        return model
