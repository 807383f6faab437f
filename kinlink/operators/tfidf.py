"""TF-IDF retrieval: sublinear term frequency, smoothed idf of the candidates, unit length, cosine, top k.

Records of one country with the same text have the same vector. So vectors are made, compared and ranked once a text, and of
a candidate text only its first k ids travel. Texts are compared in blocks, each S1 block with each block of candidates of
its country and source. Terms travel as 64-bit hashes and are weighted in the task, which gets the group's vocabulary too.

A task finds an S1 text's k best above the floor without reading the postings of its frequent terms: what those can add to a
candidate is bounded by the length of both vectors over them (Cauchy-Schwarz), and once that is below the k-th best so far, a
candidate must share a rarer term. Those whose sum over the rarer terms and that bound reach the k-th best are compared in
full. The result is that of all pairs. Similarities are rounded to nine places, so that sums in another order rank alike.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlink.functions import text as T

GROUP = ["country_normalized", "source"]
#: Most S1 texts and candidate texts in a block. Each S1 text is copied to every block of candidates and the other way round.
OURS, THEIRS = 131072, 393216
#: S1 texts from which a group is cut in so many blocks at least, for tasks.
LEAST, CUT = 8192, 4
#: Candidates that share a rare term and are compared first, so that a k-th best is known early.
SEED = 256
#: What sums in another order may differ by.
SLACK = 1e-8


def char_text() -> Column:
    return F.col("name_core")


def char_terms(text: Column) -> Column:
    """Character trigrams of the core name."""
    return T._grams(text, 3)


def word_text() -> Column:
    return F.trim(F.concat_ws(" ", "name_core", "address_normalized"))


def word_terms(text: Column) -> Column:
    """Words of two letters or more of core name and address, and their pairs."""
    words = F.regexp_extract_all(text, F.lit(r"\b\w\w+\b"), 0)
    pairs = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))
    return F.concat(words, pairs)


class _Vectors:
    """Unit vectors of texts over a vocabulary (sorted hashes, idf), row by row: codes of terms and weights."""

    def __init__(self, terms: pa.ListArray, vocabulary: np.ndarray, idf: np.ndarray) -> None:
        self.n = len(terms)
        flat = terms.flatten().to_numpy()
        row = np.repeat(np.arange(self.n), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
        at = np.minimum(np.searchsorted(vocabulary, flat), len(vocabulary) - 1)
        known = vocabulary[at] == flat
        pair, tf = np.unique(row[known] * len(vocabulary) + at[known], return_counts=True)
        self.row, self.code = np.divmod(pair, len(vocabulary))
        v = (1 + np.log(tf)) * idf[self.code]
        self.w = v / np.sqrt(np.bincount(self.row, v * v, self.n))[self.row]
        self.start = np.searchsorted(self.row, np.arange(self.n + 1))

    def recoded(self, rank: np.ndarray) -> None:
        """Codes become ranks, in which the terms of a row are in order."""
        code = rank[self.code]
        order = np.lexsort((code, self.row))
        self.code, self.w = code[order], self.w[order]

    def beyond(self, cuts: np.ndarray) -> np.ndarray:
        """For each cut and row the length of the vector over the codes from the cut on."""
        sums = [np.bincount(self.row[m], self.w[m] ** 2, self.n) for m in (self.code >= c for c in cuts)]
        return np.sqrt(np.array(sums))


def _nearest_texts(ours: _Vectors, theirs: _Vectors, size: int, k: int, floor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(S1 text, candidate text, similarity): of each S1 text the candidates above the floor that are among its k best, or tie
    with the k-th and are of the first k rows that do. size: of the vocabulary."""
    df = np.bincount(theirs.code, minlength=size)
    rank = np.empty(size, np.int64)
    rank[np.argsort(df, kind="stable")] = np.arange(size)
    ours.recoded(rank)
    theirs.recoded(rank)
    df = np.sort(df, kind="stable")
    order = np.argsort(theirs.code, kind="stable")
    rows, weights = theirs.row[order].astype(np.int32), theirs.w[order]
    ends = np.concatenate([[0], np.cumsum(df)])
    # at a cut the terms are parted in rarer and more frequent ones; behind the last there are none
    cuts = np.append(np.unique(np.searchsorted(df, theirs.n / 2.0 ** np.arange(14, 0, -1), "right")), size)
    far, own_far = theirs.beyond(cuts), ours.beyond(cuts).T
    bound = own_far * far.max(axis=1)
    before = np.array([np.searchsorted(ours.code[a:b], cuts) for a, b in zip(ours.start[:-1], ours.start[1:], strict=True)]).reshape(-1, len(cuts))
    asked, acc = np.zeros(size), np.zeros(theirs.n)
    length = np.diff(theirs.start)

    def full(at: np.ndarray) -> np.ndarray:
        n = length[at]
        to = np.cumsum(n)
        each = np.arange(to[-1]) + np.repeat(theirs.start[at] - to + n, n)
        return np.round(np.add.reduceat(asked[theirs.code[each]] * theirs.w[each], to - n), 9)

    found = []
    for i in range(ours.n):
        a, b = ours.start[i], ours.start[i + 1]
        codes, w = ours.code[a:b], ours.w[a:b]
        first, last = ends[codes], ends[codes + 1]
        some = np.cumsum(last - first)
        if not len(some) or not some[-1]:
            continue
        asked[codes] = w
        least, j = floor, int(np.searchsorted(some, k))
        seeds = np.unique(np.concatenate([rows[x : min(y, x + SEED)] for x, y in zip(first[: j + 1], last[: j + 1], strict=True)]))
        if len(seeds) >= k:
            least = max(least, np.partition(full(seeds), -k)[-k])
        level = int(np.argmax(bound[i] < least - SLACK))
        p = before[i, level]
        parts = [rows[x:y] for x, y in zip(first[:p], last[:p], strict=True)]
        if parts:
            for at, x, y, v in zip(parts, first[:p], last[:p], w[:p], strict=True):
                acc[at] += weights[x:y] * v
            touched = np.concatenate(parts)
            hit = np.unique(touched[acc[touched] + own_far[i, level] * far[level][touched] >= least - SLACK])
            acc[touched] = 0
            if len(hit):
                sim = full(hit)
                if len(hit) > k:
                    least = max(least, np.partition(sim, -k)[-k])
                good = np.flatnonzero(sim >= least)
                if len(good) > k:  # rows are in the order of their first ids, so the first of those that tie are enough
                    ties = np.flatnonzero(sim[good] == least)[k:]
                    good = np.delete(good, ties)
                found.append((np.full(len(good), i), hit[good], sim[good]))
        asked[codes] = 0
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _compared(k: int, floor: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Function of a block of S1 texts and one of candidate texts (with idf: rows of the vocabulary): the k best of each S1
    text above the floor."""

    def run(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        ours, theirs = ours.combine_chunks(), theirs.combine_chunks()
        told = pc.is_valid(theirs["idf"])
        said, theirs = theirs.filter(told), theirs.filter(pc.invert(told))
        ids = theirs["ids"].combine_chunks()
        at, cand, sim = [], [], []
        if len(ours) and len(theirs) and len(said):
            lists = ids.flatten().take(pa.array(np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))])[:-1]))
            theirs = theirs.take(pc.sort_indices(lists))  # by the first id
            ids = theirs["ids"].combine_chunks()
            hashes, idf = said["terms"].combine_chunks().flatten().to_numpy(), said["idf"].combine_chunks().flatten().to_numpy()
            order = np.argsort(hashes)
            vectors = [_Vectors(x["terms"].combine_chunks(), hashes[order], idf[order]) for x in (ours, theirs)]
            own, near, likeness = _nearest_texts(*vectors, len(order), k, floor)
            n = pc.list_value_length(ids).to_numpy(zero_copy_only=False)[near]
            every = pa.table({"at": np.repeat(own, n), "far": np.repeat(-likeness, n), "cand_id": ids.take(pa.array(near)).flatten()})
            every = every.take(pc.sort_indices(every, [("at", "ascending"), ("far", "ascending"), ("cand_id", "ascending")]))
            who = every["at"].to_numpy()
            every = every.filter(pa.array(np.arange(len(who)) - np.searchsorted(who, who) < k))
            at, cand, sim = every["at"].combine_chunks(), every["cand_id"].combine_chunks(), -every["far"].to_numpy()
        at = pa.array(at, pa.int64())
        return pa.table({"country_normalized": ours["country_normalized"].take(at), "source": ours["source"].take(at), "text": ours["text"].take(at), "cand_id": pa.array(cand, pa.string()), "sim": pa.array(sim, pa.float64())})

    return run


def nearest(s1: DataFrame, pool: DataFrame, text: Column, terms: Callable[[Column], Column], k: int, floor: float, max_df: float | None, min_df: int = 2) -> DataFrame:
    """country_normalized, source, text, cand_id, sim: the k most similar candidates of each S1 text in each source, above the floor."""
    posts = pool.select(*GROUP, F.col("entity_id").alias("cand_id"), text.alias("text"))
    counted = posts.groupBy(*GROUP, "text").agg(F.count("*").alias("n"))
    size = counted.groupBy(*GROUP).agg(F.sum("n").alias("n"), F.count("*").alias("texts"))
    df = counted.select(*GROUP, "n", F.explode(F.array_distinct(terms(F.col("text")))).alias("term")).groupBy(*GROUP, "term").agg(F.sum("n").alias("df")).filter(F.col("df") >= min_df)
    idf = df.join(F.broadcast(size), GROUP)  # a row for each country and source
    if max_df is not None:
        idf = idf.filter(F.col("df") <= max_df * F.col("n"))
    idf = idf.select(*GROUP, "term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))

    hashed = F.transform(terms(F.col("text")), lambda t: F.xxhash64(t))
    w = Window.partitionBy(*GROUP, "text").orderBy("cand_id")
    first = posts.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).groupBy(*GROUP, "text").agg(F.sort_array(F.collect_list("cand_id")).alias("ids"))
    names = s1.select("country_normalized", text.alias("text")).distinct()
    own = names.groupBy("country_normalized").agg(F.count("*").alias("ours"))
    least = F.least(F.lit(CUT), F.ceil(F.col("ours") / LEAST))
    blocks = F.broadcast(size.join(own, "country_normalized").select(*GROUP, F.ceil(F.col("texts") / THEIRS).alias("their_n"), F.greatest(F.ceil(F.col("ours") / OURS), least).alias("our_n")))
    block = lambda n: F.pmod(F.xxhash64("text"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = names.withColumn("terms", hashed).join(blocks, "country_normalized").withColumn("our", block("our_n")).withColumn("their", every("their_n"))
    right = first.withColumn("terms", hashed).join(blocks, GROUP).withColumn("their", block("their_n")).withColumn("our", every("our_n"))
    said = idf.groupBy(*GROUP, F.pmod(F.xxhash64("term"), F.lit(256))).agg(F.collect_list(F.xxhash64("term")).alias("terms"), F.collect_list("idf").alias("idf"))
    said = said.join(blocks, GROUP).withColumn("their", every("their_n")).withColumn("our", every("our_n"))
    none = lambda kind: F.lit(None).cast(kind)
    key = [*GROUP, "our", "their"]
    right = right.select(*key, "terms", none("array<double>").alias("idf"), "ids").unionByName(said.select(*key, "terms", "idf", none("array<string>").alias("ids")))
    left = left.select(*key, "text", "terms")
    dealt = lambda df: df.toDF(*df.columns).groupBy(*key)
    near = dealt(left).cogroup(dealt(right)).applyInArrow(_compared(k, floor), "country_normalized string, source string, text string, cand_id string, sim double")
    # dealt as the records are that come next
    near = near.repartition(int(s1.sparkSession.conf.get("spark.sql.shuffle.partitions")), "country_normalized", "text")
    best = Window.partitionBy(*GROUP, "text").orderBy(F.col("sim").desc(), "cand_id")
    return near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k).drop("place")
