"""Shared helpers: checkpoints, byte-level word splitting, vectorised hashing, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes of A-Z to a-z.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: As LOWER, with every ASCII byte that is neither a digit nor a letter turned into a blank.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *extra: str) -> DataFrame:
    """doc_id, text (null: empty) and the extra columns; any other column is dropped here."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *extra)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, a new temporary folder, in local mode alone."""
    said = spark.conf.get("spark.checkpoint.dir", None)
    if not said:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        said = _OWN.setdefault("dir", tempfile.mkdtemp(prefix="kinlink-"))
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(said)
    return said


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


#: Bits of the map that likely() uses, whatever the size of its input.
MAP_BITS = 1 << 24


def likely(df: DataFrame, key: Column, among: DataFrame, name: str) -> DataFrame:
    """df with the boolean column `name`: false only where the key (long) is none of the keys in `among` (column key).

    The keys of `among` set bits in a map of a fixed size (at most MAP_BITS / 64 rows), which is broadcast; so rows that can't
    meet a key need not be dealt.
    """
    place = lambda k: F.pmod(F.xxhash64(k), F.lit(MAP_BITS))
    word, bit = (lambda k: F.shiftright(place(k), 6)), (lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), (place(k) % 64).cast("int")))
    w, b = fresh(df, "word"), fresh(df, "bits")
    words = among.select(word(F.col("key")).alias(w), bit(F.col("key")).alias("bit")).groupBy(w).agg(F.bit_or("bit").alias(b))
    found = df.withColumn(w, word(key)).join(F.broadcast(words), w, "left")
    return found.withColumn(name, F.coalesce(F.col(b).bitwiseAND(bit(key)) != 0, F.lit(False))).drop(w, b)


#: Makes Spark delete a query's shuffle files when the query is over and not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The tables of the innermost scratch().
_HELD: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("held", default=None)


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a frame as Parquet (in the shared folder if no path is given) and read it back."""
    spark, own = df.sparkSession, path is None
    path = path or f"{shared_folder(spark)}/kinlink-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").mode("overwrite").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    read = spark.read.schema(df.schema).parquet(path)
    if own and (held := _HELD.get()) is not None:
        held.append((spark, path))
    return read


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that stored() writes in the block are deleted at its end, but for those written by the function that it gives.

    Those belong to the block around this one, if there is one. So nothing that is read after the block may be lazy.
    """
    outer, held = _HELD.get(), []
    token = _HELD.set(held)

    def keep(df: DataFrame) -> DataFrame:
        out = stored(df)
        here = held.pop()
        if outer is not None:
            outer.append(here)
        return out

    try:
        yield keep
    finally:
        _HELD.reset(token)
        for spark, path in held:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(df: DataFrame) -> None:
    """Delete a frame's files, written by stored(), once all that reads them is written itself."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if path.startswith(shared_folder(spark)) or "/kinlink-" in path:
            delete(spark, path)


def lower_words(text: str) -> list[bytes]:
    """Words between blanks (0x20, 0x09-0x0D), A-Z lower-cased."""
    return text.encode().translate(LOWER).split()


def plain_words(text: str) -> list[bytes]:
    """Words between blanks, unchanged."""
    return text.encode().split()


def alnum_words(text: str) -> list[bytes]:
    """Runs of letters and digits (any non-ASCII character counts), A-Z lower-cased."""
    return text.encode().translate(ALNUM).split()


class WordHash(dict):
    """word -> 64-bit hash, remembered; forgotten when it holds too many words."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word shingles in order; fewer than n words are one shingle, none give none."""
    if len(h) == 0:
        return h
    n = min(n, len(h))
    out = np.full(len(h) - n + 1, np.uint64(n), np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i])
    return out


def map_texts(df: DataFrame, make: Callable[[], Callable[[dict], Iterator[dict]]], schema: str, chars: int = 4_000_000, rows: int = 4096) -> DataFrame:
    """Apply a function to blocks of rows through Arrow batches.

    make() runs once in each task and returns the function; that gets {column: list} of a block with at most so many
    characters of text (one row at least) and yields {column: list or array} for the schema. Nulls stay None. If the
    function has an attribute finish, that is called once after the task's last block and yields likewise.
    """
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()

        def made(out: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([v.cast(f.type) if isinstance(v := out[f.name], pa.Array) else pa.array(v, f.type) for f in arrow], schema=arrow)

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False) if "text" in batch.schema.names else np.zeros(batch.num_rows, int)
            start = total = 0
            ends = []
            for i, n in enumerate(sizes.tolist()):
                if i > start and (total + n > chars or i - start >= rows):
                    ends.append((start, i))
                    start, total = i, 0
                total += n
            if batch.num_rows:
                ends.append((start, batch.num_rows))
            for i, j in ends:
                for out in fn({k: v.to_pylist() for k, v in zip(batch.schema.names, batch.slice(i, j - i).columns, strict=True)}):
                    yield made(out)
        for out in getattr(fn, "finish", tuple)():
            yield made(out)

    return df.mapInArrow(run, kind)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of the edges: one row (node, component) per node, component being its smallest node.

    Alternates large-star and small-star steps; all keys are nodes, a hot node's rows are combined before the shuffle,
    and each round is written to the shared folder. Nodes that have no edge are not returned.
    """
    with scratch() as keep:
        e, before = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()), None
        n = e.count()
        while True:
            both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            large = with_least(both, 2 * n).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
            e, last = stored(with_least(large, n).select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()), e
            discard(last)
            now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if now == before:
                break
            before, n = now, now[0]
        # each edge of a star leads to its least node
        return keep(e.unionByName(e.select(F.col("v").alias("u"), "v")).groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")))


#: A key with more than one in so many of all rows is hot, so there are fewer hot keys than this.
HOT_SHARE = 1024


def with_least(e: DataFrame, most: int) -> DataFrame:
    """u, v and m, the least v of u's rows; e has at most so many rows.

    Hot u get their m by a broadcast, of fewer than HOT_SHARE rows whatever the size of e, and their rows are dealt by v.
    The other u have at most most / HOT_SHARE rows each and are dealt by themselves.
    """
    low = e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("rows"))
    hot = low.filter(F.col("rows") * HOT_SHARE > most).select("u", F.col("m").alias("hot_m"))
    dealt = e.join(F.broadcast(hot), "u", "left").withColumn("is_hot", F.col("hot_m").isNotNull()).withColumn("by", F.when(F.col("is_hot"), F.xxhash64("v")).otherwise(F.col("u")))
    others = low.select(F.col("u").alias("by"), F.lit(False).alias("is_hot"), "m")
    return dealt.join(others, ["by", "is_hot"], "left").select("u", "v", F.coalesce("hot_m", "m").alias("m"))
