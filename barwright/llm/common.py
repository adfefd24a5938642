"""Words, names, durable intermediates and per-worker caches shared by the operators."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B))
#: Lower-cases A-Z and turns every other ASCII character that is no letter or digit into a space.
_PLAIN = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or c in _KEPT else 0x20 for c in range(256)
)


def plain_words(text: bytes) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_PLAIN).split()


def space_words(text: bytes) -> list[bytes]:
    """Runs of anything but ASCII white space; bytes.split() splits at exactly 0x20 and 0x09 to 0x0D."""
    return text.split()


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def worker_cache(name: str, make: Callable[[], object], most: int = 4) -> object:
    """An object built once per Python worker and kept between its tasks.

    Workers outlive jobs, so what they keep is bounded: names have the form `family-rest`, a call for another family drops all
    that is there, and a family keeps its `most` latest objects."""
    home = sys.modules.setdefault("_barwright_worker", types.ModuleType("_barwright_worker")).__dict__
    family = name.partition("-")[0]
    if home.get("family") != family:
        home["family"], home["kept"] = family, {}
    kept = home["kept"]
    if name in kept:
        kept[name] = kept.pop(name)  # the latest is last
        return kept[name]
    while len(kept) >= most:
        del kept[next(iter(kept))]
    kept[name] = made = make()
    return made


def fresh(frame: DataFrame, *bases: str) -> list[str]:
    """Column names that the frame does not have, in any case."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for base in bases:
        while base.lower() in taken:
            base += "_"
        taken.add(base.lower())
        out.append(base)
    return out


def named(frame: DataFrame, name: str) -> Column:
    """A top-level column whose name may hold dots."""
    return frame["`" + name.replace("`", "``") + "`"]


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one below the warehouse where that is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def durable(frame: DataFrame) -> DataFrame:
    """The frame computed once and kept in the shared folder: later reads survive lost executors."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def written(frame: DataFrame, what: str) -> DataFrame:
    """Like durable, but as Parquet: smaller, and later reads prune columns."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column) -> Column:
    """Names a text; equal texts share it. Null is a text of its own."""
    return F.coalesce(F.sha2(text, 256), F.lit("null"))


def per_batch(function: Callable[..., pa.Array], kind: pa.DataType):
    """A column function over Arrow arrays. It counts as not deterministic, so that Spark evaluates it once per row even
    where a filter and a projection both use its result."""
    return F.arrow_udf(function, from_arrow_type(kind)).asNondeterministic()
