"""Language-model scores by prediction by partial matching over bytes.

Pretrained: the counts of all byte n-grams up to ORDER + 1 over all training texts are a trie of contexts. A byte is coded
in the longest known context; if it has not followed there, an escape is coded (its share estimated from the number of
distinct followers, method C) and the next shorter context is tried without the bytes that the longer one has already
ruled out (exclusion). The followers of a context also follow its suffix, so what exclusion takes from a context depends on
the context escaped from alone, and every step is a constant of a trie node: a byte's cost follows from its n-gram alone.
Adaptive: ``Adaptive`` codes one text with a trie that starts empty and learns as it goes.

The counts cover every training text and grow with them, and every score comes from all of them. A table of the costs of
the longest n-grams whose count reaches the least threshold at which at most NODES are left is sent to the tasks; a text's
other n-grams are joined with the stored counts, and where these lack them too, with those of their suffixes and contexts.

Edge cases: a null text is empty (its end alone is coded); an empty training set leaves the uniform model; repeated rows
count and are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, lower_words, map_texts, stored

ORDER = 5
#: Bytes that UTF-8 never has: before a text, after it.
START, END = 0xFE, 0xFF
#: Most n-grams whose costs are sent to the tasks; the others are joined with their counts.
NODES = 1 << 20
#: Of an n-gram `gram` of `size` bytes: the byte before the last, and all but the first.
BEFORE, SUFFIX = "(shiftright(gram, 8) & 255)", "(gram & (shiftleft(1L, 8 * (size - 1)) - 1))"
#: Words whose counts are sent to the tasks; the counts of the others are joined.
COMMON_WORDS = 1 << 18


def grams(texts: list[str]) -> np.ndarray:
    """The (ORDER + 1)-grams, as numbers, that end at each byte and at the end of each text."""
    pad, end = bytes([START] * ORDER), bytes([END])
    b = np.frombuffer(b"".join(pad + t.encode() + end for t in texts), np.uint8)
    key = np.zeros(len(b) - ORDER, np.uint64)
    for i in range(ORDER + 1):
        key = key << np.uint64(8) | b[i : len(b) - ORDER + i]
    # a gram that ends at padding is none of a text
    return key[b[ORDER:] != START]


def count_grams(docs: DataFrame) -> DataFrame:
    """gram, n: counts of the longest n-grams over all whole texts; equal ones are added up in each task first."""

    def make():
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            n = np.zeros(len(keys), np.int64)
            np.add.at(n, at, np.concatenate([c for _, c in held]))
            return keys, n

        def out() -> Iterator[dict]:
            if held:
                keys, n = merged()
                held.clear()
                for i in range(0, len(keys), 200_000):
                    yield {"gram": keys[i : i + 200_000].astype(np.int64), "n": n[i : i + 200_000]}

        def count(block: dict) -> Iterator[dict]:
            held.append(np.unique(grams(block["text"]), return_counts=True))
            if sum(len(k) for k, _ in held) > 2_000_000:
                held[:] = [merged()]
                if len(held[0][0]) > 1_000_000:
                    yield from out()

        count.finish = out
        return count

    return map_texts(documents(docs), make, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def all_orders(counted: DataFrame) -> DataFrame:
    """size, gram, n for every n-gram length, from the counts of the longest."""
    levels = [F.struct(F.lit(s).alias("size"), F.col("gram").bitwiseAND((1 << 8 * s) - 1).alias("gram")) for s in range(1, ORDER + 2)]
    return counted.select(F.explode(F.array(*levels)).alias("x"), "n").groupBy("x.size", "x.gram").agg(F.sum("n").alias("n"))


def most_frequent(counted: DataFrame, column: str, most: int) -> DataFrame:
    """The rows whose count reaches the least threshold (on a grid of eighths of a doubling) that at most so many reach.

    The driver gets a histogram of a few hundred rows; no task sorts.
    """
    step = F.ceil(F.log2(F.col(column)) * 8).cast("int")
    total, least = 0, None
    for k, c in sorted(((r["k"], r["c"]) for r in counted.groupBy(step.alias("k")).agg(F.count("*").alias("c")).collect()), reverse=True):
        if total + c > most:
            break
        total, least = total + c, k
    return counted.filter(step >= least) if least is not None else counted.filter(F.lit(False))


def train(docs: DataFrame, nodes: int = NODES) -> Model:
    """The model of all whole texts, of which so many n-grams at most travel."""
    return Model(stored(all_orders(count_grams(docs))), nodes)


def contexts(levels: DataFrame) -> DataFrame:
    """size, gram, total, followers, rest of every context.

    total and followers count what follows it; its escape is the number of its followers. rest is the denominator in the next
    shorter context without these followers. A context is joined with at most 256 followers, so no key is hot.
    """
    shorter = levels.select((F.col("size") + 1).alias("size"), F.col("gram").alias("suffix"), F.col("n").alias("m"))
    known = levels.filter(f"size = 1 or {BEFORE} <> {START}").withColumn("suffix", F.expr(SUFFIX))  # after padding alone a byte is coded without context
    each = known.join(shorter, ["size", "suffix"], "left").groupBy((F.col("size") - 1).alias("size"), F.expr("shiftright(gram, 8)").alias("gram"))
    stats = stored(each.agg(F.sum("n").alias("total"), F.count("*").alias("followers"), F.sum("m").alias("gone")))
    below = stats.select((F.col("size") + 1).alias("size"), F.col("gram").alias("suffix"), (F.col("total") + F.col("followers")).alias("whole"))
    found = stats.withColumn("suffix", F.when(F.col("size") > 0, F.expr(SUFFIX))).join(below, ["size", "suffix"], "left")
    return found.select("size", "gram", "total", "followers", (F.col("whole") - F.col("gone")).alias("rest"))


class Model:
    """Costs (log10 probability of the last byte) of (ORDER + 1)-grams: a table of those of the most frequent ones, which is
    sent to the tasks, and all stored counts, which the others are joined with."""

    def __init__(self, levels: DataFrame, nodes: int):
        self.levels, self.contexts = levels, stored(contexts(levels))
        n = np.zeros(256)
        for r in levels.filter("size = 1").collect():  # 256 rows at most
            n[r["gram"]] = r["n"]
        self.escape = float(max(1, (n > 0).sum()))
        self.whole = float(n.sum()) + self.escape
        #: costs without context
        self.plain = np.log10(np.where(n > 0, n, self.escape / 256)) - math.log10(self.whole)
        follows = levels.filter(f"size = {ORDER + 1} and {BEFORE} <> {START}").select("gram", "n", F.expr("shiftright(gram, 8)").alias("context"))
        whole = self.contexts.filter(F.col("size") == ORDER).select(F.col("gram").alias("context"), (F.col("total") + F.col("followers")).alias("whole"))
        self.known = stored(follows.join(whole, "context").select("gram", "n", (F.log10("n") - F.log10("whole")).alias("cost")))
        top = most_frequent(self.known, "n", nodes).select("gram", "cost").toArrow()  # at most `nodes` rows
        self._table(top["gram"].to_numpy().astype(np.uint64), top["cost"].to_numpy())

    def __getstate__(self) -> dict:
        """What is sent to the tasks."""
        return {k: v for k, v in self.__dict__.items() if not isinstance(v, DataFrame)}

    def _table(self, key: np.ndarray, cost: np.ndarray) -> None:
        """Open addressing with linear probing, at most half full."""
        self.bits = max(8, (2 * len(key)).bit_length())
        slots = np.zeros(1 << self.bits, np.uint64)
        place = np.full(len(key), -1, np.int64)
        at, left, mask = self._hash(key), np.arange(len(key)), (1 << self.bits) - 1
        while len(left):
            free = slots[at] == 0
            _, first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            take = np.zeros(len(at), bool)
            take[first] = True
            take &= free
            slots[at[take]] = key[left[take]]
            place[left[take]] = at[take]
            at, left = (at[~take] + 1) & mask, left[~take]
        self.slots, self.cost = slots, np.zeros(1 << self.bits)
        self.cost[place] = cost

    def _hash(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look(self, key: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1."""
        at = self._hash(key)
        seen = self.slots[at]
        out = np.where(seen == key, at, -1)
        left = np.flatnonzero((seen != key) & (seen != 0))
        mask = (1 << self.bits) - 1
        while len(left):
            at[left] = (at[left] + 1) & mask
            seen = self.slots[at[left]]
            hit = seen == key[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit & (seen != 0)]
        return out

    def text_costs(self, texts: list[str]) -> dict[str, list]:
        """score of each whole text and its end, without its grams that are not in the table; these, and how often each stands there."""
        gram = grams(texts)
        slot = self.look(gram)
        costs = self.cost[slot]
        costs[slot < 0] = 0
        bare = np.flatnonzero(gram >> np.uint64(8) & np.uint64(255) == START)
        costs[bare] = self.plain[(gram[bare] & np.uint64(255)).astype(np.int64)]
        slot[bare] = 0
        starts = np.cumsum([0, *(len(t.encode()) + 1 for t in texts)])
        far = np.flatnonzero(slot < 0)
        cuts = np.searchsorted(far, starts)
        own = [np.unique(gram[far[i:j]].astype(np.int64), return_counts=True) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        return {"score": np.add.reduceat(costs, starts[:-1]), "grams": [g for g, _ in own], "times": [k for _, k in own]}

    def missing(self, parts: DataFrame) -> DataFrame:
        """row, far: the sum of the costs of the grams of each row of parts that are not in the table."""
        asked = stored(parts.select("row", F.explode(F.arrays_zip("grams", "times")).alias("x")).select("row", "x.grams", "x.times").withColumnRenamed("grams", "gram"))
        found = stored(asked.select("gram").distinct().join(self.known.select("gram", "cost"), "gram", "left"))
        costs = found.filter("cost is not null").unionByName(self.unseen(found.filter("cost is null").select("gram")))
        return asked.join(costs, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("cost")).alias("far"))

    def unseen(self, new: DataFrame) -> DataFrame:
        """gram, cost of grams that no training text has, by escapes to shorter contexts.

        Each asks for the counts of its suffixes (follower) and for their contexts. n-grams of up to two bytes are a fixed
        number and travel; the others are joined.
        """
        key = lambda size, of: F.struct(F.lit(of == "gram").alias("follower"), F.lit(size).alias("size"), F.expr(f"{of} & {(1 << 8 * size) - 1}L").alias("part"))
        wanted = new.select("gram", F.explode(F.array(*(key(s, of) for s in range(1, ORDER + 1) for of in ("gram", "shiftright(gram, 8)")))).alias("x")).select("gram", "x.*")
        have = self.levels.select(F.lit(True).alias("follower"), "size", F.col("gram").alias("part"), "n", *(F.lit(None).cast("double").alias(c) for c in ("step", "whole")))
        step = F.log10("followers") - F.log10("rest")
        have = have.unionByName(self.contexts.filter("size > 0").select(F.lit(False).alias("follower"), "size", F.col("gram").alias("part"), F.lit(None).cast("long").alias("n"), step.alias("step"), F.log10(F.col("total") + F.col("followers")).alias("whole")))
        on = ["follower", "size", "part"]
        near = wanted.filter("size <= 2").join(F.broadcast(have.filter("size <= 2")), on, "left")
        each = near.unionByName(wanted.filter("size > 2").join(have.filter("size > 2"), on, "left")).groupBy("gram")
        # the longest suffix that is known ends the escapes, which began in the longest known context
        found = each.agg(
            F.coalesce(F.max(F.when(F.col("n").isNotNull(), F.col("size") - 1)), F.lit(-1)).alias("hit"),
            F.max_by("n", F.when(F.col("n").isNotNull(), F.col("size"))).alias("n"),
            F.max_by("whole", F.when(F.col("whole").isNotNull(), F.col("size"))).alias("whole"),
            F.array_sort(F.collect_list(F.when(F.col("step").isNotNull(), F.struct("size", "step")))).alias("steps"),
        )
        escapes = F.aggregate("steps", F.lit(0.0), lambda sum_, x: sum_ + F.when(x["size"] > F.col("hit"), x["step"]).otherwise(0.0))
        last = F.coalesce(F.log10("n"), F.lit(math.log10(self.escape / 256)))
        return found.select("gram", (escapes + last - F.coalesce("whole", F.lit(math.log10(self.whole)))).alias("cost"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (log10 probability of the whole text and its end)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # NODES n-grams at most

    def make():
        held = shared.value

        def scored(block: dict) -> Iterator[dict]:
            yield held.text_costs(block["text"]) | {"row": block["row"], "doc_id": block["doc_id"]}

        return scored

    numbered = documents(docs).withColumn("row", F.monotonically_increasing_id())
    parts = stored(map_texts(numbered, make, "row long, doc_id long, score double, grams array<long>, times array<long>", chars=1_000_000))
    return parts.join(model.missing(parts), "row", "left").select("doc_id", (F.col("score") + F.coalesce("far", F.lit(0.0))).alias("score"))


class Adaptive:
    """PPM of one text at a time, with exclusion, from an empty trie; also the plain form of the pretrained model."""

    def __init__(self, order: int = ORDER):
        self.order, self.next = order, {}

    def cost(self, before: bytes, byte: int, learn: bool = True) -> float:
        out, gone = 0.0, set()
        done = False
        for k in self._lengths(before)[::-1]:
            have = self.next.get(before[len(before) - k :] if k else b"")
            if not have or done:
                continue
            left = {b: n for b, n in have.items() if b not in gone}
            whole = sum(left.values()) + len(have)
            if byte in left:
                out += math.log10(left[byte] / whole)
                done = True
                continue
            out += math.log10(len(have) / whole)
            gone |= set(have)
        if not done:
            out -= math.log10(256)
        if learn:
            self.learn(before, byte)
        return out

    def _lengths(self, before: bytes) -> range:
        """Contexts begin with the padding at most, but are not padding alone."""
        return range(1 if before[-1:] == bytes([START]) else min(self.order, len(before)) + 1)

    def learn(self, before: bytes, byte: int) -> None:
        for k in self._lengths(before):
            have = self.next.setdefault(before[len(before) - k :] if k else b"", {})
            have[byte] = have.get(byte, 0) + 1

    def text(self, text: str, learn: bool = True) -> float:
        b = bytes([START] * self.order) + text.encode() + bytes([END])
        return sum(self.cost(b[i - self.order : i], b[i], learn) for i in range(self.order, len(b)))


def score_adaptive(docs: DataFrame, order: int = 4) -> DataFrame:
    """doc_id, score of each whole text by a model that starts empty for each of them."""

    def make():
        def scored(block: dict) -> Iterator[dict]:
            yield {"doc_id": block["doc_id"], "score": [Adaptive(order).text(t) for t in block["text"]]}

        return scored

    return map_texts(documents(docs), make, "doc_id long, score double")


# ---- the base: words


def word_counts(docs: DataFrame, training: Column) -> DataFrame:
    """word (lower-cased; null: the end of a text), c over the training texts; equal words are added up in each task first."""

    def make():
        held: Counter = Counter()

        def out() -> Iterator[dict]:
            if held:
                yield {"word": list(held), "c": list(held.values())}
                held.clear()

        def count(block: dict) -> Iterator[dict]:
            for text in block["text"]:
                held.update(lower_words(text))
            held[None] += len(block["text"])
            if len(held) > 300_000:
                yield from out()

        count.finish = out
        return count

    return map_texts(documents(docs.filter(training)), make, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def score_with_base(docs: DataFrame, training: Column, model: Model, common: int = COMMON_WORDS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score (unigrams with add-one smoothing) and score of every document.

    The counts of the commonest words, a fixed number, go to the tasks; a document's other words are joined with their
    counts, added up by document row and word before, so that no word or document can crowd a task. Likewise n-grams.
    """
    counts = stored(word_counts(docs, training))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = most_frequent(counts.filter("word is not null"), "c", common).toArrow()
    ends = counts.filter("word is null").agg(F.coalesce(F.max("c"), F.lit(0))).first()[0]
    bottom = math.log10(total + distinct + 1)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((top["word"].to_pylist(), top["c"].to_numpy()))
    held = spark.sparkContext.broadcast(model)

    def make():
        words, c = shared.value
        logs = np.append(np.log10(c + 1.0) - bottom, 0.0)
        get = {w: i for i, w in enumerate(words)}.get
        ppm, end = held.value, math.log10(ends + 1) - bottom

        def parts(block: dict) -> Iterator[dict]:
            out: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "base", "rare")}
            for text in block["text"]:
                own = lower_words(text)
                place = np.fromiter(map(get, own, repeat(-1)), np.int64, len(own))
                out["n_tokens"].append(len(own) + 1)
                out["n_known"].append(int((place >= 0).sum()) + (ends > 0))
                out["base"].append(float(logs[place].sum()) + end)
                out["rare"].append([own[i] for i in np.flatnonzero(place < 0).tolist()])
            yield out | ppm.text_costs(block["text"]) | {"row": block["row"], "doc_id": block["doc_id"]}

        return parts

    numbered = documents(docs).withColumn("row", F.monotonically_increasing_id())
    parts = stored(map_texts(numbered, make, "row long, doc_id long, n_tokens long, n_known long, base double, score double, rare array<binary>, grams array<long>, times array<long>", chars=1_000_000))
    rare = parts.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("k"))
    found = rare.join(counts, "word", "left").select("row", "k", F.coalesce("c", F.lit(0)).alias("c"))
    extra = found.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("more"), F.sum(F.col("k") * (F.log10(F.col("c") + 1.0) - bottom)).alias("add"))
    return parts.drop("rare", "grams", "times").join(extra, "row", "left").join(model.missing(parts), "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("add", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("far", F.lit(0.0))).alias("score"),
    )
