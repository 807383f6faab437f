"""Substring deduplication with suffix automata of reference shards.

A window is LEAST consecutive words. A word goes if a window that covers it also starts in a document with a smaller
doc_id. Each window has an anchor, the least hash of its GRAM-word runs, so equal windows have equal anchors; a document is
its runs of windows that share an anchor ("contexts", of bounded length). Contexts whose anchor stands in one document
alone repeat nothing. Equal contexts are one; an anchor with a single context is a shard of one string, each of whose windows
first stands in that string's smallest document, so no automaton need be built to read this off.
The other contexts of an anchor are a reference shard: their suffix automaton is built in the order of doc_id, and each
context is streamed through it. The state that holds the last LEAST words tells where these first occurred, which is the
smallest document with that window; spans of such windows are removed.

A shard has at most SHARD contexts. Those of an anchor that has more are cut again, by the least hash of a window's other
runs, into runs with two anchors, which are shards in the same way. Only what still has more than SHARD contexts goes by the
windows' own hashes, combined before the shuffle, which gives the same smallest documents for any number of copies.
Rows are judged by a hash of doc_id and text, windows of such anchors and contexts by 64-bit hashes: n of them hold a false
pair with odds of n * n / 2 ** 65 (below 1e-5 up to 10 ** 7 windows of one anchor; a context meets those of its anchor alone).

Edge cases: null texts have no words; a null doc_id counts as the largest; rows that share a doc_id are judged alone and
don't repeat each other; fewer than LEAST words are no window; an empty table gives no rows. Words are told apart by 64-bit
hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import WordHash, documents, map_texts, mix, plain_words, stored

LEAST, GRAM = 50, 16
#: Most contexts of a reference shard: some 20,000 words, an automaton of about 10 MB.
SHARD = 256
LAST = (1 << 63) - 1
RUN = "anchor:long,ctx:long,start:int,n:int"


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences; each state knows the first sequence that holds its words."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.first = [-1], [0], [-1]
        self.last = 0

    def add(self, words: list[int], owner: int) -> None:
        """Add a sequence; owners are added in ascending order."""
        self.last = 0
        for w in words:
            self._extend(w, owner)

    def _extend(self, w: int, owner: int) -> None:
        p, nxt, link, size = self.last, self.next, self.link, self.size
        q = nxt[p].get(w)
        if q is not None:
            if size[q] == size[p] + 1:
                self.last = q
                return
            self.last = self._clone(p, w, q)
            return
        cur = self._state({}, size[p] + 1, owner)
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = nxt[p][w]
            link[cur] = q if size[q] == size[p] + 1 else self._clone(p, w, q)
        self.last = cur

    def _state(self, moves: dict[int, int], size: int, owner: int) -> int:
        self.next.append(moves)
        self.link.append(-1)
        self.size.append(size)
        self.first.append(owner)
        return len(self.size) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        c = self._state(dict(self.next[q]), self.size[p] + 1, self.first[q])
        self.link[c] = self.link[q]
        self.link[q] = c
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def statistics(self, words: list[int], least: int) -> Iterator[tuple[int, int]]:
        """For each end of a match of at least so many words: (start of its last `least` words, their first owner)."""
        s = held = 0
        nxt, link, size = self.next, self.link, self.size
        for i, w in enumerate(words):
            while s and w not in nxt[s]:
                s = link[s]
                held = size[s]
            if w in nxt[s]:
                s = nxt[s][w]
                held += 1
            if held >= least:
                while size[link[s]] >= least:
                    s = link[s]
                    held = size[s]
                yield i - least + 1, self.first[s]


def contexts(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """anchor, content hash, first window, number of windows of the runs of a text's word hashes."""
    n = len(h) - LEAST + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 4
    grams = mix(rolling(h, GRAM))
    at = sliding_argmin(grams, LEAST - GRAM + 1)
    start = np.flatnonzero(np.append(True, np.diff(at) != 0))
    size = np.diff(np.append(start, n))
    # hash of a run's content: of a prefix sum of mixed words, relative to its start
    content = span_hashes(h, start, start + size + LEAST - 1)
    return grams[at[start]].view(np.int64), content.view(np.int64), start, size


def split_runs(h: np.ndarray, start: int, n: int) -> list[tuple[int, int, int, int]]:
    """The n windows from `start` on, which share an anchor: (second anchor, content hash, first window, number) of their runs
    by the least other hash."""
    words = h[start : start + n + LEAST - 1]
    grams = mix(rolling(words, GRAM))
    first = int(sliding_argmin(grams, LEAST - GRAM + 1)[0])
    other = np.where(grams == grams[first], np.uint64((1 << 64) - 1), grams)
    at = sliding_argmin(other, LEAST - GRAM + 1)
    begin = np.flatnonzero(np.append(True, np.diff(at) != 0))
    size = np.diff(np.append(begin, n))
    content = span_hashes(words, begin, begin + size + LEAST - 1)
    second = mix(other[at[begin]] ^ grams[first])
    return list(zip(second.view(np.int64).tolist(), content.view(np.int64).tolist(), begin.tolist(), size.tolist(), strict=True))


BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first n + 1 powers at least; kept, and made anew only for a longer text."""
    held = _POWERS.get(int(base))
    if held is None or len(held) <= n:
        held = _POWERS[int(base)] = np.cumprod(np.append(np.uint64(1), np.full(max(n, 1 << 16), base, np.uint64)), dtype=np.uint64)
    return held


def span_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes, modulo 2 ** 64, of spans of words, mixed with their lengths."""
    sums = np.append(np.uint64(0), np.cumsum(h * _powers(BASE, len(h))[: len(h)], dtype=np.uint64))
    return mix((sums[end] - sums[start]) * _powers(INVERSE, len(h))[start] + (end - start).astype(np.uint64))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    start = np.arange(len(h) - k + 1)
    return span_hashes(h, start, start + k)


#: Low bits that give way to the place in a text, so that of equal values the first is the least (2 ** 26 words a text).
PLACE = np.uint64((1 << 26) - 1)


def sliding_argmin(v: np.ndarray, w: int) -> np.ndarray:
    """Place of the least value (by its high bits; the first of equal ones) in each window of w values."""
    n = len(v) - w + 1
    ranked = v & ~PLACE | np.arange(len(v), dtype=np.uint64)
    x = np.append(ranked, np.full(-len(v) % w, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, w)
    left = np.minimum.accumulate(x, 1).ravel()
    right = np.minimum.accumulate(x[:, ::-1], 1)[:, ::-1].ravel()
    return (np.minimum(right[:n], left[w - 1 : w - 1 + n]) & PLACE).astype(np.int64)


def runs_of(docs: DataFrame) -> DataFrame:
    """Of each numbered row: doc_id, o (its order), n_words, sha256 of all words, its contexts."""

    def make():
        hashed = WordHash()

        def runs(block: dict) -> Iterator[dict]:
            n_words, sha, parts = [], [], []
            for text in block["text"]:
                words = plain_words(text)
                n_words.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                parts.append(contexts(hashed.of(words) if len(words) >= LEAST else np.zeros(0, np.uint64)))
            ends = np.cumsum([0, *(len(p[0]) for p in parts)]).astype(np.int32)
            columns = [pa.array(np.concatenate([p[i] for p in parts]), t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, ["anchor", "ctx", "start", "n"]))
            yield {"row": block["row"], "doc_id": block["doc_id"], "n_words": n_words, "sha": sha, "runs": lists}

        return runs

    return map_texts(docs, make, f"row long, doc_id long, n_words long, sha string, runs array<struct<{RUN}>>")


def shard_owners(words: list[list[int]], owners: list[int]) -> list[list[int]]:
    """The contexts of one anchor, in the order of their owners: for each window of each, the first owner of that window."""
    automaton = SuffixAutomaton()
    for w, o in zip(words, owners, strict=True):
        automaton.add(w, o)
    out = []
    for w in words:
        low = [LAST] * (len(w) - LEAST + 1)
        for start, owner in automaton.statistics(w, LEAST):
            low[start] = owner
        out.append(low)
    return out


def all_owners(mixed: DataFrame) -> DataFrame:
    """anchor, ctx, low of every context in shards: rows are dealt and ordered by anchor, and read shard by shard."""
    kind = StructType.fromDDL("anchor long, ctx long, low array<long>")
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        done: dict[str, list] = {"anchor": [], "ctx": [], "low": []}

        def judge() -> None:
            if held:
                done["anchor"] += [r[0] for r in held]
                done["ctx"] += [r[1] for r in held]
                done["low"] += shard_owners([np.frombuffer(r[3], np.uint64).tolist() for r in held], [r[2] for r in held])
                held.clear()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict(done, schema=arrow)
            for v in done.values():
                v.clear()
            return batch

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "ctx", "o", "words")), strict=True):
                if held and held[0][0] != row[0]:
                    judge()
                held.append(row)
            if len(done["ctx"]) > 20_000:
                yield out()
        judge()
        yield out()

    rows = mixed.select("anchor", "ctx", "o", "words").repartition("anchor").sortWithinPartitions("anchor", "o", "ctx")
    return rows.mapInArrow(run, kind)


def by_windows(rows: DataFrame) -> DataFrame:
    """anchor, ctx, low as all_owners has them, by the hashes of the windows."""

    def make():
        def windows(block: dict) -> Iterator[dict]:
            yield {k: block[k] for k in ("anchor", "ctx", "o")} | {"windows": [rolling(np.frombuffer(w, np.uint64), LEAST).view(np.int64) for w in block["words"]]}

        return windows

    dealt = stored(map_texts(rows, make, "anchor long, ctx long, o long, windows array<long>").select("anchor", "ctx", "o", F.posexplode("windows").alias("i", "w")))
    first = stored(dealt.groupBy("w").agg(F.min("o").alias("low")))
    lows = stored(dealt.join(first, "w").select("anchor", "ctx", "i", "low"))
    return lows.groupBy("anchor", "ctx").agg(F.array_sort(F.collect_list(F.struct("i", "low"))).alias("x")).select("anchor", "ctx", F.col("x.low").alias("low"))


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (text of the kept words where some are removed, else null)."""
    # equal rows share a number, are judged once, and each gets the result
    numbered = documents(docs).withColumn("row", F.xxhash64("doc_id", "text"))
    order = F.coalesce("doc_id", F.lit(LAST)).alias("o")
    whole = stored(runs_of(numbered))
    each = whole.select("row", order, F.inline("runs"))
    # keys that many documents share are joined between two stored tables, whose large partitions Spark can split
    repeated = stored(each.groupBy("anchor").agg(F.min("o").alias("low"), F.max("o").alias("high")).filter("low < high").select("anchor"))
    hits = stored(each.join(repeated, "anchor"))

    same = stored(hits.groupBy("anchor", "ctx").agg(F.min(F.struct("o", "row", "start", "n")).alias("rep")))
    ways = stored(same.groupBy("anchor").agg(F.count("*").alias("ways")))
    reps = stored(same.join(ways, "anchor").select("anchor", "ctx", "rep.*", "ways"))

    asked = reps.filter("ways > 1").groupBy("row").agg(F.collect_list(F.struct("anchor", "ctx", "start", "n", F.col("o").alias("own"), "ways")).alias("reps"))
    suspects = stored(hits.select("row").distinct().join(asked, "row", "left"))
    texts = stored(numbered.select("row", "text").join(suspects, "row").dropDuplicates(["row"]))

    def make():
        hashed = WordHash()

        def contents(block: dict) -> Iterator[dict]:
            out: dict[str, list] = {k: [] for k in ("anchor", "ctx", "o", "part", "of_anchor", "of_ctx", "words")}
            for text, reps in zip(block["text"], block["reps"], strict=True):
                h = hashed.of(plain_words(text))
                for r in reps:
                    whole = [(r["anchor"], r["ctx"], 0, r["n"])]
                    for anchor, ctx, i, n in split_runs(h, r["start"], r["n"]) if r["ways"] > SHARD else whole:
                        hot, at = r["ways"] > SHARD, r["start"] + i
                        for k, v in zip(out, (anchor, ctx, r["own"], i if hot else None, r["anchor"], r["ctx"], h[at : at + n + LEAST - 1].tobytes()), strict=True):
                            out[k].append(v)
            yield out

        return contents

    mixed = stored(map_texts(texts.filter("reps is not null"), make, "anchor long, ctx long, o long, part int, of_anchor long, of_ctx long, words binary"))
    shards = all_owners(mixed.filter("part is null"))
    parts = mixed.filter("part is not null")
    again = stored(parts.groupBy("anchor", "ctx").agg(F.min("o").alias("o"), F.min("words").alias("words")))
    ways = stored(again.groupBy("anchor").agg(F.count("*").alias("ways")))
    again = stored(again.join(ways, "anchor"))
    lows = stored(all_owners(again.filter(F.col("ways") <= SHARD)).unionByName(by_windows(again.filter(F.col("ways") > SHARD))))
    found = stored(parts.select("anchor", "ctx", "part", "of_anchor", "of_ctx").join(lows, ["anchor", "ctx"]))
    others = found.groupBy("of_anchor", "of_ctx").agg(F.array_sort(F.collect_list(F.struct("part", "low"))).alias("x")).select(F.col("of_anchor").alias("anchor"), F.col("of_ctx").alias("ctx"), F.flatten("x.low").alias("low"))
    owners = stored(shards.unionByName(others))
    judged = stored(reps.select("anchor", "ctx", "ways", F.col("o").alias("own")).join(owners, ["anchor", "ctx"], "left"))

    found = hits.join(judged, ["anchor", "ctx"])
    low = F.when(F.col("ways") > 1, F.col("low")).otherwise(F.array_repeat("own", F.col("n")))
    bad = F.filter(F.transform(low, lambda x, i: F.when(x < F.col("o"), F.col("start") + i)), lambda x: x.isNotNull())
    starts = found.select("row", bad.alias("bad")).filter(F.size("bad") > 0).groupBy("row").agg(F.flatten(F.collect_set("bad")).alias("bad"))

    def make_kept():
        def kept(block: dict) -> Iterator[dict]:
            out: dict[str, list] = {k: [] for k in ("n_removed", "kept_sha", "kept")}
            for text, bad in zip(block["text"], block["bad"], strict=True):
                words = plain_words(text)
                marks = np.zeros(len(words) + 1, np.int64)
                bad = np.array(bad)
                np.add.at(marks, bad, 1)
                np.add.at(marks, bad + LEAST, -1)
                gone = np.cumsum(marks[:-1]) > 0
                left = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                out["n_removed"].append(int(gone.sum()))
                out["kept_sha"].append(hashlib.sha256(left).hexdigest())
                out["kept"].append(left.decode())
            yield out | {"row": block["row"]}

        return kept

    changed = map_texts(texts.select("row", "text").join(starts, "row"), make_kept, "row long, n_removed long, kept_sha string, kept string")
    return whole.select("row", "doc_id", "n_words", "sha").join(changed, "row", "left").select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha", "sha").alias("kept_sha256"), "kept")
