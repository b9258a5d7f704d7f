"""Helpers shared by the corpus operators: row numbers, stored stages, Arrow row streams, graphs."""

from __future__ import annotations

import gc
import uuid
import warnings
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar, copy_context

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doorledger.session import scratch_dir

#: no column of a user's table should be called so
RID = "__rid"

#: folders of the tables stored on the way to a result that ``decided`` makes
_on_the_way: ContextVar[list[str] | None] = ContextVar("on_the_way", default=None)

#: bytes of rows that a Python task is handed at a time: a batch stands several times in it, and once in the JVM
BATCH_BYTES = 4 << 20

#: what a Python worker keeps from one task of an operator to the next
kept: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counted(df: DataFrame) -> DataFrame:
    """Rows with a number of their own, which holds for one pass only: it depends on how the scan is split."""
    return df.withColumn(RID, F.monotonically_increasing_id())


def numbered(df: DataFrame) -> DataFrame:
    """Rows with a number of their own, written once, so that it is the same in every pass over them."""
    return stored(counted(df))


def _folder(spark: SparkSession) -> str:
    path = scratch_dir(spark, "stage")
    if (folders := _on_the_way.get()) is not None:
        folders.append(path)
    return path


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """The rows written once to the cluster's shared folder and read back."""
    path = _folder(df.sparkSession)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def decided(make: Callable[[], DataFrame]) -> DataFrame:
    """The rows of ``make()`` stored; the tables that it stored on the way to them are deleted, so nothing else may read those."""
    folders: list[str] = []

    def making() -> DataFrame:
        _on_the_way.set(folders)
        return make()

    try:
        return stored(copy_context().run(making))
    finally:
        for path in folders:
            _delete(path)


def _delete(path: str) -> None:
    sc = SparkSession.getActiveSession().sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    try:
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
    except Py4JJavaError as failed:
        warnings.warn(f"{path} stays: {failed.java_exception}", stacklevel=3)


def bucketed(df: DataFrame, key: str, codec: str = "zstd") -> DataFrame:
    """The rows written once to the shared folder, dealt and sorted by ``key``: joins by it do not shuffle them again."""
    spark, n = df.sparkSession, shuffle_parts(df)
    name = f"stage_{uuid.uuid4().hex}"
    (df.repartition(n, key).write.option("compression", codec).option("path", _folder(spark))
     .bucketBy(n, key).sortBy(key).saveAsTable(name))
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only; files outside the warehouse stay, and so does what reads them
    return out


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; ids that are null fall into fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def spread(text: Column, pieces: int, chars: int) -> Column:
    """The text, or of one longer than ``pieces`` x ``chars`` characters so many pieces, evenly spread from its start to its end."""
    step = (F.length(text) - chars) / (pieces - 1)
    cuts = [text.substr(F.floor(step * k).cast("int") + 1, F.lit(chars)) for k in range(pieces)]
    return F.when(F.length(text) > pieces * chars, F.concat_ws(" ", *cuts)).otherwise(text)


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of about ``BATCH_BYTES`` at most, unless the session has a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def _taken_over(operator: str) -> None:
    """What a Python worker kept for another operator is freed: a worker outlives the stages of many."""
    if kept.get("operator") != operator:
        kept.clear()
        kept["operator"] = operator
        gc.collect()


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict[str, pa.Array]]], Iterable[dict]],
             ddl: str) -> DataFrame:
    """mapInArrow where ``fn`` turns dicts of columns into dicts of columns of the result."""
    schema = arrow_schema(df.sparkSession, ddl)
    small_batches(df.sparkSession)
    operator = fn.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _taken_over(operator)
        columns = ({n: b.column(n) for n in b.schema.names} for b in batches if b.num_rows)
        for out in fn(columns):
            yield pa.RecordBatch.from_arrays(
                [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)
                 for f in schema], schema=schema)
        pa.default_memory_pool().release_unused()  # the worker lives on

    return df.mapInArrow(run, ddl)


def groups(batches: Iterator[dict[str, pa.Array]], key: str) -> Iterator[dict[str, list]]:
    """Consecutive rows of equal ``key`` of a sorted stream, as lists; null keys are one group."""
    held: dict[str, list] | None = None
    for b in batches:
        cols = {n: c.to_pylist() for n, c in b.items()}
        keys, start = cols[key], 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            part = {n: c[start:i] for n, c in cols.items()}
            if held is not None and held[key][0] == keys[start]:
                for n, c in part.items():
                    held[n].extend(c)
            else:
                if held is not None:
                    yield held
                held = part
            start = i
    if held is not None:
        yield held


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: edges that a task joins at a time
AT_ONCE = 1 << 18


def _joined(edges: DataFrame) -> DataFrame:
    """Edges (src, dst) with the same components: every task replaces its own by one from each node to its smallest."""
    def run(batches):
        up: dict[int, int] = {}
        seen = 0

        def root(x: int) -> int:
            path = []
            while up[x] != x:
                path.append(x)
                x = up[x]
            for p in path:
                up[p] = x
            return x

        def flush() -> dict:
            rows = [(x, root(x)) for x in up]
            return {"src": [x for x, r in rows if x != r], "dst": [r for x, r in rows if x != r]}

        for b in batches:
            for x, y in zip(b["src"].to_pylist(), b["dst"].to_pylist(), strict=True):
                up.setdefault(x, x)
                up.setdefault(y, y)
                a, c = root(x), root(y)
                if a != c:
                    up[max(a, c)] = min(a, c)
            seen += len(b["src"])
            if seen > AT_ONCE:
                yield flush()
                up.clear()
                seen = 0
        if up:
            yield flush()

    return map_rows(edges, run, "src long, dst long")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over undirected ``edges`` (src, dst: long).

    Tasks of at most about ``AT_ONCE`` edges replace their own by one from each node to its smallest, which is all where
    one task holds them. Otherwise large-star and small-star steps alternate until no edge changes or one such task can hold
    what is left; every step is an aggregate with map-side reduction and an equi join, and is written to the shared folder, so
    neither a large component nor a node of very many edges meets in one task. Rows with a null end are
    ignored; no edges give no rows.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = (e.select("src", "dst").union(e.select(F.col("dst"), F.col("src"))) if large
                else e.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
        joined = both.join(low, "src")
        if large:
            out = joined.where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        else:
            out = joined.select(F.col("dst").alias("src"), F.col("low").alias("dst")).union(
                low.select("src", F.col("low").alias("dst")))
        return out.where("src <> dst").distinct()

    now = stored(_joined(edges.where("src <> dst").select("src", "dst")).distinct())
    sign = None
    while True:
        if now.count() <= AT_ONCE:
            now = stored(_joined(now.coalesce(1)))
            break
        now = stored(star(star(now, True), False))
        new = now.agg(F.count("*"), F.sum(F.col("dst").cast("decimal(38,0)")),
                      F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if new == sign:
            break
        sign = new
    nodes = now.groupBy("src").agg(F.min("dst").alias("component"))
    roots = nodes.select(F.col("component").alias("node"), "component").distinct()
    return nodes.select(F.col("src").alias("node"), "component").union(roots)
