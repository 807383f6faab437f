"""Document fingerprints by a randomised edit embedding.

All texts are read by the same random walk: at step j the pointer stands on a character c and moves on by the shared random
bit R[j, c]. What the pointer sees at each step is an embedding in which a few edits change few places, so edit distance
becomes Hamming distance. A fingerprint samples that embedding: 32 places among the first 32 steps, and 32 in each further
doubling of the steps, one byte (of the four characters from the pointer on) a place, until the text ends. Likeness is the
share of equal bytes, each doubling weighted by its width, which estimates the Hamming likeness of the whole embeddings.
Bands of four sampled bytes are the keys under which near texts meet; likeness verifies them.

Edge cases: a null text is empty, and the fingerprint of an empty text is empty; two empty texts are alike (1), an empty
and another are not (0). Repeated doc_ids are ordered by text. A null doc_id comes after all others. An empty table gives
no rows; a single row is its own next document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import documents, map_texts

SEED, PERIOD, SAMPLES, GROUPS, PAD = 20_240_607, 4096, 32, 34, 72
BAND = 4
#: Classes in a block of a band.
BLOCK = 96


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """The shared random bits, and the sampled steps of each group."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    bits = rng.integers(0, 2, (PERIOD, 256), np.uint8)
    steps = [np.arange(SAMPLES)]
    for g in range(1, GROUPS):
        low = SAMPLES << (g - 1)
        # one step in each of 32 equal parts of the doubling
        steps.append(low + np.arange(SAMPLES) * (low // SAMPLES) + rng.integers(0, low // SAMPLES, SAMPLES))
    return bits, steps


class Embedder:
    """Fingerprints of lists of texts; the walks of a list run side by side."""

    def __init__(self):
        self.bits, self.steps = _tables()

    def __call__(self, texts: list[str]) -> list[bytes]:
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        starts = np.cumsum(sizes + PAD) - sizes - PAD
        codes = np.zeros(int((sizes + PAD).sum()) + PAD, np.uint8)
        for k, start in zip(order.tolist(), starts.tolist(), strict=True):
            c = np.frombuffer(texts[k].encode("utf-32-le", "surrogatepass"), "<u4")
            c = c ^ (c >> 8) ^ (c >> 16)
            codes[start : start + len(c)] = np.maximum(c & 0xFF, 1)
        out = np.zeros((len(texts), GROUPS, SAMPLES), np.uint8)
        at, end, who = starts.copy(), starts + sizes, np.arange(len(texts))
        sampled = [(int(s), g, i) for g, x in enumerate(self.steps) for i, s in enumerate(x)]
        nth, j = 0, 0
        while len(at):
            alive = at < end
            if not alive.all():
                at, end, who = at[alive], end[alive], who[alive]
                if not len(at):
                    break
            # a pointer can pass the end by at most 64 here, which stays within the padding
            for _ in range(64):
                if sampled[nth][0] == j:
                    _, g, i = sampled[nth]
                    c = codes[at].astype(np.uint32)
                    h = c * 0x9E3779B1 + codes[at + 1] * np.uint32(0x85EBCA6B) + codes[at + 2] * np.uint32(0xC2B2AE35) + codes[at + 3] * np.uint32(0x27D4EB2F)
                    h ^= h >> 15
                    h *= np.uint32(0x2C1B3C6D)
                    out[who, g, i] = np.where(c > 0, (h >> 24) % 255 + 1, 0)
                    nth += 1
                at += self.bits[j % PERIOD].take(codes.take(at))
                j += 1
        found: list[bytes] = [b""] * len(texts)
        for k, x in zip(order.tolist(), out, strict=True):
            used = np.flatnonzero(x.any(1))
            found[k] = x[: used[-1] + 1].tobytes() if len(used) else b""
        return found


def likeness(a: bytes, b: bytes) -> float:
    """Estimated share of equal places of two embeddings; places beyond both texts' ends don't count."""
    if a == b:
        return 1.0
    n = max(len(a), len(b))
    x = np.frombuffer(a.ljust(n, b"\0"), np.uint8).reshape(-1, SAMPLES)
    y = np.frombuffer(b.ljust(n, b"\0"), np.uint8).reshape(-1, SAMPLES)
    width = np.array([1.0, *(2.0 ** max(0, g - 1) for g in range(1, len(x)))])
    used = (x > 0) | (y > 0)
    return float(((x == y) & used).sum(1) @ width / (used.sum(1) @ width))


def share_band(a: bytes, b: bytes) -> bool:
    """Whether two fingerprints meet in some band (bands with unused bytes don't count)."""
    n = min(len(a), len(b))
    x, y = (np.frombuffer(v[:n], np.uint8).reshape(-1, BAND) for v in (a, b))
    return bool(((x == y) & (x > 0)).all(1).any())


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint (hexadecimal) of every whole text."""

    def make():
        embed = Embedder()

        def prints(block: dict) -> Iterator[dict]:
            yield {"doc_id": block["doc_id"], "n_chars": [len(t) for t in block["text"]], "fingerprint": [f.hex() for f in embed(block["text"])]}

        return prints

    return map_texts(documents(docs), make, "doc_id long, n_chars long, fingerprint string", chars=16_000_000, rows=20_000)


def near_pairs(prints: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Links between fingerprints that share a band, and membership.

    Equal fingerprints are one class, named by its smallest doc_id. Returns (links, members): links has a, b, likeness with
    a < b, verified; members has doc_id, class_id. Whatever classes share a band and are near are connected by links. The
    classes of a band are dealt into blocks of about BLOCK, and each pair of blocks is a task group of its own, of whose
    links a spanning forest is returned; so no group is larger than two blocks, and no pair rows are made.
    """
    reps = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id"))
    members = prints.join(reps, "fingerprint").select("doc_id", "class_id")
    width = 2 * BAND
    bands = F.sequence(F.lit(0), F.floor(F.length("fingerprint") / width).cast("int") - 1)
    keyed = (
        reps.filter("fingerprint <> ''")
        .select("class_id", "fingerprint", F.explode(bands).alias("band"))
        .select("class_id", "band", F.expr(f"substring(fingerprint, band * {width} + 1, {width})").alias("bits"))
        .filter(~F.col("bits").rlike("^([0-9a-f]{2})*?00([0-9a-f]{2})*$"))
    )
    sizes = keyed.groupBy("band", "bits").agg(F.count("*").alias("n")).filter("n > 1").select("band", "bits", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = keyed.join(sizes, ["band", "bits"]).withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    spread = placed.select("class_id", "band", "bits", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    groups = spread.select("class_id", "band", "bits", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))

    def linked(pdf):
        import pandas as pd

        pdf = pdf.sort_values("class_id")
        found = near_forest([bytes.fromhex(x) for x in pdf["fingerprint"]], least)
        ids = pdf["class_id"].to_numpy()
        return pd.DataFrame({"a": [ids[x] for x, _, _ in found], "b": [ids[y] for _, y, _ in found], "likeness": [v for _, _, v in found]}).astype({"a": "int64", "b": "int64", "likeness": "float64"})

    rows = groups.join(reps.filter("class_id is not null"), "class_id")
    return rows.groupBy("band", "bits", "i", "j").applyInPandas(linked, "a long, b long, likeness double").distinct(), members


def near_forest(prints: list[bytes], least: float) -> list[tuple[int, int, float]]:
    """A spanning forest of the near pairs among some fingerprints, by their places, with likeness."""
    parent = list(range(len(prints)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for x, y in combinations(range(len(prints)), 2):
        p, q = top(x), top(y)
        if p != q and (v := likeness(prints[x], prints[y])) >= least:
            parent[max(p, q)] = min(p, q)
            out.append((x, y, v))
    return out


def _ranges(docs: DataFrame, n: int) -> tuple[Callable[[Column], Column], list[int], list[int]]:
    """A column function from the order key to the number of its range, each range's first key, each range's predecessor.

    Only keys are read; the driver gets one key a range.
    """
    cuts = docs.agg(F.percentile_approx("o", [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    # two levels, so that finding a range costs its square root
    step = max(1, int(len(cuts) ** 0.5))
    fine = [cuts[i : i + step] for i in range(0, len(cuts), step)] or [[]]
    heads = [x[0] for x in fine[1:]]
    longs = lambda xs: F.array(*map(F.lit, xs)).cast("array<long>")

    def number(o: Column) -> Column:
        coarse = F.size(F.filter(longs(heads), lambda x: x <= o))
        return coarse * step + F.size(F.filter(F.element_at(F.array(*map(longs, fine)), coarse + 1), lambda x: x <= o))

    first = dict(docs.groupBy(number(F.col("o")).alias("k")).agg(F.min("o")).collect())
    used = sorted(first)
    before = dict(zip(used, [used[-1], *used[:-1]], strict=True)) if used else {}
    every = range(len(cuts) + 1)
    return number, [first.get(k) for k in every], [before.get(k, 0) for k in every]


def edited(docs: DataFrame) -> DataFrame:
    """Each document beside its edited text: the last half replaced by the first characters of the next document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, meets (a band is shared with
    the edited text). The texts are dealt once, by ranges of doc_id; the first row of a range is also sent to the range
    before it, so no task needs more than its own range.
    """
    spark = docs.sparkSession
    own = documents(docs).withColumn("o", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    number, firsts, before = _ranges(own.select("o"), n)
    k = number(F.col("o"))
    keyed = own.withColumn("k", k)
    longs = lambda xs: F.array(*map(F.lit, xs)).cast("array<long>")
    is_first = F.col("o") == F.element_at(longs(firsts), F.col("k") + 1)
    sent = keyed.withColumn("to", F.explode(F.when(is_first, F.array(F.struct(F.col("k").alias("k"), F.lit(0).alias("tail")), F.struct(F.element_at(longs(before), F.col("k") + 1).cast("int").alias("k"), F.lit(1).alias("tail")))).otherwise(F.array(F.struct(F.col("k").alias("k"), F.lit(0).alias("tail"))))))
    dealt = sent.select("doc_id", "text", "o", "to.k", "to.tail").repartitionById(len(firsts), F.col("k")).sortWithinPartitions("k", "tail", "o", "text")
    kind = StructType.fromDDL("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, meets boolean")
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embed = Embedder()

        def made(rows: list[tuple]) -> pa.RecordBatch:
            """Rows of the pairs (row, the one after it), but for tails."""
            pairs = [(x, y) for x, y in pairwise(rows) if not x[3]]
            changed = [x[1][: len(x[1]) - len(x[1]) // 2] + y[1][: len(x[1]) // 2] for x, y in pairs]
            prints = embed([r[1] for r in rows] + changed)
            plain, new = prints[: len(rows)], prints[len(rows) :]
            which = [i for i in range(len(rows) - 1) if not rows[i][3]]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(v, f.type)
                    for v, f in zip(
                        (
                            [x[0] for x, _ in pairs],
                            [len(x[1]) for x, _ in pairs],
                            [hashlib.sha256(t.encode()).hexdigest() for t in changed],
                            [plain[i].hex() for i in which],
                            [f.hex() for f in new],
                            [likeness(plain[i], f) for i, f in zip(which, new, strict=True)],
                            [likeness(plain[i], plain[i + 1]) for i in which],
                            [share_band(plain[i], f) for i, f in zip(which, new, strict=True)],
                        ),
                        arrow,
                        strict=True,
                    )
                ],
                schema=arrow,
            )

        rows: list[tuple] = []
        chars = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "k", "tail")), strict=True):
                rows.append(row)
                chars += len(row[1])
                if chars > 12_000_000 or len(rows) > 8000:
                    yield made(rows)
                    rows, chars = rows[-1:], len(row[1])
        if len(rows) > 1:
            yield made(rows)

    return dealt.mapInArrow(run, kind)
