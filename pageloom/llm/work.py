"""Shared ground of the corpus operators: tables written to the shared folder, words, streamed groups."""

from __future__ import annotations

import atexit
import functools
import re
import tempfile
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

_TYPES = {
    "double": (DoubleType(), pa.float64()), "bigint": (LongType(), pa.int64()), "array<double>": (ArrayType(DoubleType()), pa.list_(pa.float64())),
    "array<bigint>": (ArrayType(LongType()), pa.list_(pa.int64())), "array<binary>": (ArrayType(BinaryType()), pa.list_(pa.binary())),
}

#: Seconds between two calls of the driver's garbage collection, on which Spark's cleaner waits.
CLEAN_S = 5.0
#: Java and Python forms of the word rule: runs of anything but space and \t..\r.
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW = bytes.maketrans(UPPER.encode(), LOWER.encode())


@functools.cache
def _own_folder(master: str) -> str:
    """For sessions without a shared folder, as in tests: on one machine only."""
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return "file://" + tempfile.mkdtemp(prefix="pageloom-")


class Scratch:
    """Intermediate tables of one operator run, as Parquet in the folder that the cluster shares.

    Writing a table cuts the lineage: a lost executor costs the tasks of the running step alone.
    The folder is that of spark.checkpoint.dir; only a session without it (tests) gets one of its own.
    What is left goes when the driver ends, since a returned DataFrame may still read it.
    """

    _cleaned = 0.0

    def __init__(self, spark: SparkSession, name: str):
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        root = root or _own_folder(spark.sparkContext.master)
        self.spark, self.root = spark, f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
        atexit.register(self._remove, self.root)

    def _remove(self, path: str) -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session may be gone by then; the folder belongs to the cluster's cleaner
            pass

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        self._clean()
        return self.spark.read.schema(df.schema).parquet(path)

    def _clean(self) -> None:
        """Lets Spark's cleaner drop the shuffle files of what is now written, at most once in CLEAN_S seconds."""
        if time.monotonic() - Scratch._cleaned >= CLEAN_S:
            Scratch._cleaned = time.monotonic()
            self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        for n in names:
            self._remove(f"{self.root}/{n}")


def let(value: Column, f) -> Column:
    """f(value) with value computed once a row, even where f uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), f), 1)


def words_of(text: Column) -> Column:
    """The words of a text as an array; a text without words gives an empty array, NULL too."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))


def has_words(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r")) != ""


def crc_mod(doc_id: str, n: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % n


def byte_words(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, as UTF-8; bytes.split() cuts at exactly the six characters of the rule."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOW).split()


#: Rows of an Arrow batch whose texts are Python objects at one time.
SLICE = 512


def fresh(df: DataFrame, name: str) -> str:
    """The name, with as many marks before it as it takes to be none of df's."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_texts(df: DataFrame, keep: list[str], inputs: list[str], make, added: list[tuple[str, str]]) -> DataFrame:
    """df's columns `keep` as they are, and columns `added` (name, type) that make()(lists of the inputs) gives, a list each.

    Arrow in and out: kept columns pass through unread, so ids keep all their digits beside NULLs and texts aren't copied.
    make is called once a task; SLICE rows at a time are Python objects.
    """
    columns = [*keep, *[c for c in inputs if c not in keep]]
    place = [columns.index(c) for c in inputs]
    schema = StructType([df.schema[c] for c in keep] + [StructField(n, _TYPES[t][0]) for n, t in added])
    names, kinds = schema.names, [_TYPES[t][1] for _, t in added]

    def run(batches):
        f = make()
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                part = b.slice(lo, SLICE)
                got = f(*[part.column(i).to_pylist() for i in place])
                cols = [part.column(i) for i in range(len(keep))] + [pa.array(g, k) for g, k in zip(got, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, schema)


class Memo(dict):
    """Values of a function by key; emptied when it holds too many, so that a worker's memory is bounded."""

    def __init__(self, f, most: int = 250_000):
        self.f, self.most = f, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        v = self[key] = self.f(key)
        return v


def pieces(batches, keys: list[str]):
    """Runs of equal keys in sorted Arrow batches, one table at a time; a run may span batches."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        change = np.zeros(b.num_rows, bool)
        for k in keys:
            col = b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            change[1:] |= col[1:] != col[:-1]
            if held:
                last = held[-1].column(held[-1].schema.get_field_index(k))
                change[0] |= last[len(last) - 1].as_py() != b.column(b.schema.get_field_index(k))[0].as_py()
        cuts = [*np.flatnonzero(change).tolist(), b.num_rows]
        at = 0
        for c in cuts[:-1]:
            if c > at:
                held.append(b.slice(at, c - at))
            if held:
                yield pa.Table.from_batches(held)
            held, at = [], c
        held.append(b.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def by_group(df: DataFrame, keys: list[str], f, schema: str) -> DataFrame:
    """f(table) -> table for each run of equal keys; one Python call a partition, not one a group.

    Only for groups whose size the caller has bounded.
    """
    def run(batches):
        for t in pieces(batches, keys):
            out = f(t)
            if out is not None and out.num_rows:
                yield from out.to_batches()

    parts = df.repartition(*keys).sortWithinPartitions(*keys)
    return parts.mapInArrow(run, schema)


@functools.cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


#: Bits of mark()'s bitmap: sixteen a key between these bounds, so that at most 32 MiB are broadcast.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27


def mark(scratch: Scratch, df: DataFrame, key: str, wanted: DataFrame, name: str, to: str = "_maybe") -> DataFrame:
    """df with `to`: False where the key is certainly not among the column `key` of wanted, a written table.

    Saves shuffling rows that a join would drop. A bitmap sized by wanted's rows and bounded, summed up on the executors in
    parts of 32768 bits; with more keys than the bound is meant for it is only less selective.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * wanted.count()).bit_length()))
    at = F.xxhash64(F.col(key)).bitwiseAND(F.lit(bits - 1))
    parts = wanted.select(F.shiftright(at, 15).alias("p"), at.bitwiseAND(F.lit(32767)).alias("b")).groupBy("p").agg(F.bitmap_construct_agg(F.col("b")).alias("bits"))
    # as whole numbers of 32 bits, which a row finds by its place
    words = F.transform(F.sequence(F.lit(0), F.lit(1023)), lambda i: F.conv(F.hex(F.substring(F.col("bits"), i * 4 + 1, F.lit(4))), 16, 10).cast("bigint"))
    part, held = fresh(df, "_part"), fresh(df, "_held")
    parts = scratch.save(parts.select(F.col("p").alias(part), words.alias(held)), name)
    byte = F.shiftright(at, 3).bitwiseAND(F.lit(3))
    shift = ((F.lit(3) - byte) * 8 + at.bitwiseAND(F.lit(7))).cast("int")
    word = F.get(F.col(held), F.shiftright(at, 5).bitwiseAND(F.lit(1023)).cast("int"))
    hit = F.call_function("shiftright", word, shift).bitwiseAND(F.lit(1)) == 1
    return df.withColumn(part, F.shiftright(at, 15)).join(F.broadcast(parts), part, "left").withColumn(to, F.coalesce(hit, F.lit(False))).drop(part, held)


def components(scratch: Scratch, edges: DataFrame, name: str = "cc") -> DataFrame:
    """(v, c) for each vertex of the edges (a, b): c is the smallest vertex that v is joined to.

    Contraction: each round every vertex takes its smallest neighbour's label, labels are followed twice, and
    the edges are rewritten between labels; loops and repeated edges go. A round ends in written tables. Rows a
    round shuffles are those of the edges that are left; a star of any size is summed before its shuffle.
    """
    both = lambda e: e.select(F.col("a").alias("v"), F.col("b").alias("u")).union(e.select(F.col("b"), F.col("a")))
    edges = scratch.save(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-e0")
    labels = None
    k = 0
    while not edges.isEmpty():
        k += 1
        low = scratch.save(both(edges).groupBy("v").agg(F.least("v", F.min("u")).alias("c")), f"{name}-l{k}")
        for step in range(2):
            nxt = low.select(F.col("v").alias("c"), F.col("c").alias("cc"))
            low = scratch.save(low.join(nxt, "c").select("v", F.col("cc").alias("c")), f"{name}-l{k}{'ab'[step]}")
        if labels is None:
            labels = low
        else:
            to = low.select(F.col("v").alias("c"), F.col("c").alias("cc"))
            labels = scratch.save(labels.join(to, "c", "left").select("v", F.coalesce("cc", "c").alias("c")), f"{name}-all{k}")
        ra, rb = low.select(F.col("v").alias("a"), F.col("c").alias("ca")), low.select(F.col("v").alias("b"), F.col("c").alias("cb"))
        moved = edges.join(ra, "a").join(rb, "b").where("ca != cb")
        edges = scratch.save(moved.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), f"{name}-e{k}")
    if labels is None:
        return scratch.save(both(edges).select("v", F.col("u").alias("c")), f"{name}-none")
    return labels
