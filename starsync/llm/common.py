"""Helpers shared by the operators of this subpackage."""

import hashlib
import os
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from starsync.session import stage

#: Bytes of text that a task works on at a time (a single longer text is one slice).
SLICE_CHARS = 2_000_000

_shipped = set()


def ship(spark: SparkSession):
    """Send this package to the executors once per application, wherever the driver runs from."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    target = os.path.join(tempfile.mkdtemp(prefix="starsync-code-"), "starsync.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted((root / "starsync").rglob("*.py")):
            archive.write(path, path.relative_to(root))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, text_column):
    """Row ranges of a batch with about SLICE_CHARS bytes of text each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > SLICE_CHARS:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def map_texts(df: DataFrame, make, schema: str, text_column="text") -> DataFrame:
    """Apply a function to slices of the rows, inside the tasks, without a shuffle.

    ``make()`` is called once per task and returns ``fn(columns) -> columns``: dicts of lists by
    column name.  The lists that come back have the columns of ``schema``; they may have another
    length than the input.
    """
    ship(df.sparkSession)
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches):
        fn = make()
        for batch in batches:
            for part in slices(batch, text_column):
                out = fn(part.to_pydict())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
                out = part = None  # not held while the next rows are read
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, kind)


def utf8(text) -> bytes:
    """The bytes of a text; a null text is empty."""
    return (text or "").encode("utf-8", "surrogatepass")


def joined_sha256(df: DataFrame, key: str, order: list, line: str, between="\n") -> DataFrame:
    """(key, sha256): the hex digest of the ``line`` values of each key, in order, joined by ``between``.

    Rows are sorted inside the tasks and streamed, so a key of any length takes the memory of one batch.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = list(dict.fromkeys([key, *order, line]))

    def run(batches):
        held, now, gap = None, None, between.encode()
        for batch in batches:
            done = []
            for k, text in zip(batch.column(key).to_pylist(), batch.column(line).to_pylist()):
                if now is not None and k == held:
                    now.update(gap)
                else:
                    if now is not None:
                        done.append((held, now.hexdigest()))
                    held, now = k, hashlib.sha256()
                now.update(utf8(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], batch.schema.field(key).type),
                 pa.array([d[1] for d in done], pa.string())], [key, "sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([held], batch.schema.field(key).type), pa.array([now.hexdigest()])], [key, "sha256"])

    ship(spark)
    kind = df.schema[key].dataType.simpleString()
    return df.select(*names).repartition(parts, key).sortWithinPartitions(key, *order).mapInArrow(
        run, f"`{key}` {kind}, sha256 string")


def in_training_fold(doc_id: str = "doc_id"):
    """Rows whose labels may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 != 1, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents of the training fold.

    The rows with the smallest id hashes are taken, so the sample is the same on every run and
    does not depend on partitions.  A label table with several rows for an id gives its largest
    label.  The bound is what keeps model fitting on the driver small at every size, and it is the
    size bound of the broadcast.
    """
    known = (
        labels.where(in_training_fold() & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    # The ids are chosen before any text is moved; the chosen ones are at most ``rows``.  Of the rows
    # of an id, that with the least hash of its text is taken, so rows are no more than ids.
    named = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_t"))
    ids = (
        named.join(known, "doc_id").groupBy("doc_id").agg(F.first("label").alias("label"), F.min("_t").alias("_t"))
        .withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id").limit(rows).drop("_h")
    )
    texts = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_t"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.join(F.broadcast(ids), ["doc_id", "_t"]).repartition(parts, "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.first("label").alias("label"))


def aside(docs: DataFrame):
    """``docs`` with other names for all columns but doc_id and text, and a function that gives a frame
    with these columns those of ``docs`` again: no column of the caller meets one of an operator."""
    inner = [c if c in ("doc_id", "text") else f"extra_{i}" for i, c in enumerate(docs.columns)]
    pairs = list(zip(inner, docs.columns))
    return docs.toDF(*inner), lambda df: df.select(*[F.col(a).alias(b) for a, b in pairs])


def one_of_each(keyed: DataFrame, rooted: DataFrame) -> DataFrame:
    """The row of ``keyed`` (with ``_uid``) with the least doc_id (null ids last) of each root of
    ``rooted`` (doc_id, _uid, root); of repeated rows one."""
    best = (
        rooted.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_uid")).alias("best"))
        .select(F.col("best.doc_id").alias("_doc"), F.col("best._uid").alias("_best"))
    )
    best = stage(best, "least-of-class", keep=True)
    kept = keyed.join(
        best, (keyed["_uid"] == best["_best"]) & keyed["doc_id"].eqNullSafe(best["_doc"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "_uid"]).drop("_uid")
