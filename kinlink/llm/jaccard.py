"""Exact n-gram Jaccard join by token-combination prefixes.

Tokens are the hashed word shingles of a text; documents of equal sets are one node. All sets are put in one global order
(by hash). A set of n tokens lacks at most D = n - ceil(t n) of its tokens in any set that it links with.

* Extended prefixes. Of two linked sets, the one whose prefix of D + T tokens ends first in the order shares T of these at
  least, and all of them stand in the other's prefix. A token that stands in one prefix alone is shared with no one there,
  so a node with fewer than T others (T of the least size that it can link with) has no link. Most documents end here, after
  one aggregation that combines equal tokens before the shuffle.
* Token classes. Among the nodes left, a token of more than FREQUENT prefixes is frequent, any other is rare. Rare tokens
  are index keys singly, frequent ones in combinations: runs of K that are neighbours in the order. A set's key prefix is
  extended until it has D + 1 rare tokens, of which a linked set has one, or so many tokens that unshared ones (each spoils
  K runs) and foreign ones (each spoils K - 1) can't spoil all keys. In the first case the set wants no runs; it offers them
  to sets that do, and a run that no set wants is no key.
* Verification. Nodes that share a key are candidates. Where more than BLOCK nodes share one, each is first compared with
  one representative, that which it shares most of its prefix with; keys whose nodes are not all in one component yet stay
  open, and this is repeated while it closes much. So a dense family takes a number of comparisons that is linear in its
  size. The nodes of a key of up to FEW are paired where sizes and extended prefixes allow a link, those of a larger open key make a
  chain; what pairs and chains connect is a family, within which every two nodes of different components are compared, in
  pairs of blocks of bounded size. All comparisons count the intersection exactly; components follow from the links.

Edge cases: texts without words (null, empty) have no shingle and link with nothing; a null doc_id takes part, but names no
component unless all its members are null; repeated rows are returned each; an empty table gives no rows; other columns of
any name are dropped (``keep_one`` keeps them); a very long text is one set, of which only prefixes are indexed. Sets and
tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, components, documents, fresh, likely, lower_words, map_texts, scratch, shingles, stored

#: Nodes in a block of a comparison.
BLOCK = 256
#: A token of more prefixes than this is frequent.
FREQUENT = 4
#: A key of more nodes than this makes no pair rows.
FEW = 8
#: Longest run of frequent tokens that is a key.
LONGEST_RUN = 4
#: Representatives are chosen anew while a round closes at least this share of the open nodes.
WORTH = 0.25


def unshared(n: int, percent: int) -> int:
    """Most tokens of a set of n that a linked set can lack."""
    return n - -(-percent * n // 100)


def shared_least(n: int, percent: int) -> int:
    """T: how many tokens of its extended prefix a set of n shares with a linked one whose prefix ends later."""
    d = unshared(n, percent)
    return min(9 + d // 2, n - d)


def prefix_length(n: int, percent: int) -> int:
    return unshared(n, percent) + shared_least(n, percent)


def may_lack(n: int, percent: int) -> int:
    """Most tokens of a linked set's extended prefix that stand in no other prefix."""
    return prefix_length(n, percent) - shared_least(-(-percent * n // 100), percent) if n else 0


@lru_cache(100_000)
def run_lengths(n: int, percent: int) -> tuple[int, ...]:
    """The run lengths of a set of n: one for small sets, a longer one for others; sets near the border have both.

    K runs are enough for sets of which K (D + 1) tokens can be had.
    """
    high = max(1, min(LONGEST_RUN, 100 // max(1, 100 - percent) - 1))
    border = -(-100 * high // (100 - high * (100 - percent)))
    return tuple(sorted({k for k, has in ((min(2, high), -(-percent * n // 100) < border), (high, n >= border)) if has}))


@lru_cache(100_000)
def long_prefix(n: int, k: int, percent: int) -> int:
    """Length of a key prefix of a set of n in which all runs of k and all rare tokens can't be spoilt."""
    m = np.arange(-(-percent * n // 100), 100 * n // percent + 1)
    s = -(-percent * (n + m) // (100 + percent))
    return min(n, int((k * (n - s) + (k - 1) * (m - s)).max()) + k)


def head_length(n: int, percent: int) -> int:
    """The tokens among which key prefixes and extended prefixes end."""
    return max([prefix_length(n, percent), *(long_prefix(n, k, percent) for k in run_lengths(n, percent))])


def keys_of(head: np.ndarray, frequent: np.ndarray, n: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rare tokens, runs that the set wants, runs that it offers): the keys of an ordered set of n, from its head."""
    rare, runs = 0, {True: [], False: []}
    enough = int(np.searchsorted(np.cumsum(~frequent), unshared(n, percent) + 1)) + 1
    for k in run_lengths(n, percent):
        most = long_prefix(n, k, percent)
        p = min(enough, most)
        rare = max(rare, p)
        whole = np.lib.stride_tricks.sliding_window_view(frequent[:p], k).all(1) if p >= k else np.zeros(0, bool)
        if whole.any():
            runs[enough > most].append(shingles(head[:p], k)[whole] ^ np.uint64(k))
    none = np.zeros(0, np.uint64)
    return head[:rare][~frequent[:rare]], np.concatenate([none, *runs[True]]), np.concatenate([none, *runs[False]])


def token_set(words: list[bytes], hashed: WordHash, size: int) -> np.ndarray:
    """The distinct shingles of a text in the global order."""
    return np.unique(shingles(hashed.of(words), size))


def set_hash(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def nodes_of(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """row (hash of doc_id and text), doc_id, n, node (hash of the set; null without shingles), may_lack, prefix."""

    def make():
        hashed = WordHash()

        def sets(block: dict) -> Iterator[dict]:
            out: dict[str, list] = {k: [] for k in ("n", "node", "may_lack", "prefix")}
            for text in block["text"]:
                s = token_set(lower_words(text), hashed, size)
                out["n"].append(len(s))
                out["node"].append(set_hash(s) if len(s) else None)
                out["may_lack"].append(may_lack(len(s), percent))
                out["prefix"].append(s[: prefix_length(len(s), percent)].view(np.int64))
            yield out | {"row": block["row"], "doc_id": block["doc_id"]}

        return sets

    return map_texts(documents(docs).withColumn("row", F.xxhash64("doc_id", "text")), make, "row long, doc_id long, n long, node long, may_lack long, prefix array<long>")


def grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """row, doc_id, n, node, component (a node) of every row; node and component are null without shingles."""
    with scratch() as keep:
        with scratch() as keep_:
            made = stored(nodes_of(docs, size, percent))
            full = made.filter("node is not null")
            nodes = full.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.max("may_lack").alias("may_lack"))

            tokens = full.select("node", F.explode("prefix").alias("token"))
            alone = tokens.groupBy("token").agg(F.min("node").alias("node"), F.max("node").alias("other")).filter("node = other").groupBy("node").agg(F.count("*").alias("lacks"))
            left = keep_(nodes.join(alone, "node", "left").filter(F.coalesce("lacks", F.lit(0)) <= F.col("may_lack")).select("node", "first_id"))
            rows = keep_(made.select("row", "doc_id", "n", "node"))
        # the prefixes have done their work and are gone
        with scratch() as keep_:
            sets = stored(survivors(docs, left, size, percent))
            found = keep_(links(sets, percent))
        joined = rows.filter("node is not null").join(components(found), "node", "left").withColumn("component", F.coalesce("component", "node"))
        return keep(joined.unionByName(rows.filter("node is null").withColumn("component", F.lit(None).cast("long"))))


def link(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row."""
    rows = grouped(docs, size, percent)
    full = rows.filter("component is not null")
    least = stored(full.groupBy("component").agg(F.min("doc_id").alias("component_id")))
    named = full.join(least, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return named.unionByName(rows.filter("component is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def survivors(docs: DataFrame, left: DataFrame, size: int, percent: int) -> DataFrame:
    """node, n, lead (length of the extended prefix), head and rest of the ordered set: of one document of each node left.

    Rows that share a doc_id can bring a node twice or a node that is not left; links are verified, so these do no harm.
    """
    named = stored(left.filter("first_id is not null").select(F.col("first_id").alias("doc_id")).distinct())
    # few texts are dealt: those whose id the map doesn't rule out
    chosen = likely(documents(docs), F.col("doc_id"), named.select(F.col("doc_id").alias("key")), "can").filter("can").drop("can").join(named, "doc_id", "left_semi")
    unnamed = documents(docs).filter("doc_id is null")  # rows without an id can't be found by it

    def make():
        hashed = WordHash()

        def sets(block: dict) -> Iterator[dict]:
            found = [s for s in (token_set(lower_words(t), hashed, size) for t in block["text"]) if len(s)]
            sizes = list(map(len, found))
            cuts = [head_length(n, percent) for n in sizes]
            yield {"node": list(map(set_hash, found)), "n": sizes, "lead": [prefix_length(n, percent) for n in sizes], "head": [s[:k].view(np.int64) for s, k in zip(found, cuts, strict=True)], "rest": [s[k:].tobytes() for s, k in zip(found, cuts, strict=True)]}

        return sets

    return map_texts(chosen.unionByName(unnamed), make, "node long, n long, lead int, head array<long>, rest binary")


def keyed(sets: DataFrame, percent: int) -> DataFrame:
    """key, node, n, size, low of every node and key that it shares with another node; size and least node of the key."""

    def make():
        def keys(block: dict) -> Iterator[dict]:
            out: dict[str, list] = {k: [] for k in ("rare", "wants", "offers")}
            for head, often, n in zip(block["head"], block["often"], block["n"], strict=True):
                frequent = np.zeros(len(head), bool)
                frequent[np.array(often or [], np.int64)] = True
                for name, x in zip(out, keys_of(np.array(head, np.int64).view(np.uint64), frequent, n, percent), strict=True):
                    out[name].append(x.view(np.int64))
            yield out | {"node": block["node"], "n": block["n"]}

        return keys

    with scratch() as keep:
        tokens = sets.select("node", F.posexplode("head").alias("pos", "token"))
        often = stored(tokens.groupBy("token").agg(F.count("*").alias("c")).filter(F.col("c") > FREQUENT).select("token"))
        places = likely(tokens, F.col("token"), often.select(F.col("token").alias("key")), "can").filter("can").join(often, "token").groupBy("node").agg(F.collect_set("pos").alias("often"))
        found = stored(map_texts(sets.select("node", "n", "head").join(places, "node", "left"), make, "node long, n long, rare array<long>, wants array<long>, offers array<long>"))
        each = reduce(DataFrame.unionByName, (found.select("node", "n", F.explode(c).alias("key"), F.lit(c != "offers").alias("wanted")) for c in ("rare", "wants", "offers")))
        least, most = F.min("node").alias("low"), F.max("node").alias("high")
        shared = stored(each.groupBy("key").agg(least, most, F.max("wanted").alias("wanted"), F.count("*").alias("size")).filter("low < high and wanted").select("key", "size", "low"))
        return keep(each.select("node", "n", "key").join(shared, "key"))


def links(sets: DataFrame, percent: int) -> DataFrame:
    """a, b: links that connect all linked nodes."""
    with scratch() as keep:
        with scratch() as keep_:
            keys = keyed(sets, percent)
            found, known = dense(keys.filter(F.col("size") > BLOCK).select("node", "key"), sets, percent, keep_)
            now = stored(placed(keys, known))
            mixed = now.filter(F.col("size") > FEW).groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d")).filter("c < d").select("key")
            open_ = keys.join(mixed, "key")
            few = now.filter(F.col("size") <= FEW)
            alike = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
            pairs = few.select("key", F.col("node").alias("rep"), F.col("n").alias("m"), F.col("component").alias("c")).join(few.select("key", "node", "n", "component"), "key").filter(F.expr("rep < node and c <> component") & alike).select("rep", "node").distinct()
            near = promising(pairs, sets, percent)
            edges = keep_(near.select(F.col("rep").alias("a"), F.col("node").alias("b")).unionByName(open_.select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()))
        with scratch() as keep_:
            family = components(edges).withColumnRenamed("component", "family")
            nodes = keep_(family.join(known, "node", "left").withColumn("component", F.coalesce("component", "node")))
        found.append(compare(sets, crossings(nodes), percent))
        return keep(reduce(DataFrame.unionByName, found))


def placed(keys: DataFrame, known: DataFrame) -> DataFrame:
    """The keys with the components of their nodes; only rows whose node can be known are dealt."""
    marked = likely(keys, F.col("node"), known.select(F.col("node").alias("key")), "can")
    told = marked.filter("can").drop("can").join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return told.unionByName(marked.filter("not can").drop("can").withColumn("component", F.col("node")))


def dense(keys: DataFrame, sets: DataFrame, percent: int, keep: Callable[[DataFrame], DataFrame]) -> tuple[list[DataFrame], DataFrame]:
    """Links of the nodes of large keys with representatives, and the components (node, component) that they make.

    Both are written by `keep`.
    """
    found, before, turn = [], None, 0
    known = keys.sparkSession.createDataFrame([], "node long, component long")
    while True:
        turn += 1
        now = placed(keys, known)
        choice = F.min_by(F.struct("node", "component"), F.xxhash64("node", F.lit(turn))).alias("rep")
        reps = stored(now.groupBy("key").agg(choice, F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key", F.col("rep.node").alias("rep"), F.col("rep.component").alias("rep_component")))
        now = stored(now.join(reps, "key"))
        n = now.select("node").distinct().count()
        if not n or before is not None and n > (1 - WORTH) * before:
            return found, known
        before = n
        with scratch() as keep_:
            asks = promising(now.filter("component <> rep_component").select("rep", "node").distinct(), sets, percent)
            groups = keep_(stars(stored(asks.groupBy("node").agg(F.max_by("rep", F.struct("shared", "rep")).alias("rep")))))
        found.append(keep(compare(sets, groups, percent)))
        known = keep(components(reduce(DataFrame.unionByName, found)))
        keys = now.select("node", "key")


def promising(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """rep, node, shared (tokens of both extended prefixes): the pairs whose sizes and prefixes allow a link.

    What a set shares with another beyond the prefix that ends first in the order is at most the rest of that set.
    """
    with scratch() as keep:
        pairs = stored(pairs)

        def of(name: str, p: str) -> DataFrame:
            can = likely(sets, F.col("node"), pairs.select(F.col(name).alias("key")), "can").filter("can")
            # half of each token is enough to tell; where halves meet in a set, more may be shared than are seen
            return can.select(F.col("node").alias(name), F.col("n").alias(f"n_{p}"), F.transform(F.slice("head", F.lit(1), F.col("lead")), lambda t: t.bitwiseAND(0x7FFFFFFF).cast("int")).alias(f"head_{p}"))

        both = pairs.join(of("rep", "x"), "rep").join(of("node", "y"), "node")
        both = both.withColumn("shared", F.size(F.array_intersect("head_x", "head_y")) + F.size("head_x") - F.size(F.array_distinct("head_x")))
        rest = F.greatest(F.col("n_x") - F.size("head_x"), F.col("n_y") - F.size("head_y"))
        sizes = F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * percent
        return keep(both.filter(sizes & ((F.col("shared") + rest) * (100 + percent) >= (F.col("n_x") + F.col("n_y")) * percent)).select("rep", "node", "shared").distinct())


def stars(asks: DataFrame) -> DataFrame:
    """Group (rep, block), side, node: each node on the right side of its representative, about BLOCK of them in a group."""
    sizes = stored(asks.groupBy("rep").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    right = asks.join(sizes, "rep").select("rep", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("side"), "node")
    left = sizes.select("rep", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("side"), F.col("rep").alias("node"))
    return right.unionByName(left)


def crossings(nodes: DataFrame) -> DataFrame:
    """Group (seven columns), side, node: every two nodes (node, family, component) of a family and of different components
    meet in a group.

    Components of BLOCK nodes or more are units of their own, whose nodes needn't meet each other; smaller ones share units of
    about BLOCK nodes. Each pair of blocks of two units is a group.
    """
    with scratch() as keep:
        sizes = stored(nodes.groupBy("family", "component").agg(F.count("*").alias("size")))
        small = F.col("size") < BLOCK
        shared = sizes.filter(small).groupBy("family").agg(F.ceil(F.sum("size") / BLOCK).cast("int").alias("units"))
        units = sizes.join(shared, "family", "left").select("family", "component", (~small).alias("pure"), F.when(small, F.pmod(F.xxhash64("component"), F.col("units"))).otherwise(F.col("component")).cast("long").alias("unit"), F.when(small, 1).otherwise(F.ceil(F.col("size") / BLOCK)).cast("int").alias("blocks"))
        units = stored(units)
        placed = stored(nodes.join(units, ["family", "component"]).select("node", "family", "pure", "unit", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")))
        one = units.groupBy("family", "pure", "unit").agg(F.max("blocks").alias("blocks"))
        x, y = one.select("family", *(F.col(c).alias(f"{c}_x") for c in ("pure", "unit", "blocks"))), one.select("family", *(F.col(c).alias(f"{c}_y") for c in ("pure", "unit", "blocks")))
        before, same = F.struct("pure_x", "unit_x") < F.struct("pure_y", "unit_y"), (F.col("pure_x") == F.col("pure_y")) & (F.col("unit_x") == F.col("unit_y"))
        pairs = x.join(y, "family").filter(before | same & ~F.col("pure_x"))
        pairs = stored(pairs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks_x") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks_y") - 1))))
        group = ["family", "pure_x", "unit_x", "i", "pure_y", "unit_y", "j"]
        ends = lambda c, i: [F.col(f"pure_{c}").alias("pure"), F.col(f"unit_{c}").alias("unit"), F.col(i).alias("block")]
        wanted = pairs.select(*group, F.lit(0).alias("side"), *ends("x", "i")).unionByName(pairs.filter(~same).select(*group, F.lit(1).alias("side"), *ends("y", "j")))
        return keep(placed.join(wanted, ["family", "pure", "unit", "block"]).select(*group, "side", "node"))


def compare(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """a, b: for each group (a stored table) a spanning forest of the links between its sides (or within its only side)."""
    rows = likely(sets.select("node", "head", "rest"), F.col("node"), groups.select(F.col("node").alias("key")), "can").filter("can").drop("can").join(groups, "node")
    group = [c for c in groups.columns if c not in ("node", "side")]

    def linked(pdf):
        import pandas as pd

        nodes, side = pdf["node"].to_numpy(), pdf["side"].to_numpy()
        parts = [np.concatenate([np.array(h, np.int64).view(np.uint64), np.frombuffer(r, np.uint64)]) for h, r in zip(pdf["head"], pdf["rest"], strict=True)]
        pairs = link_sets(parts, percent, side)
        return pd.DataFrame({"a": [nodes[a] for a, _ in pairs], "b": [nodes[b] for _, b in pairs]}, dtype="int64")

    return rows.groupBy(*group).applyInPandas(linked, "a long, b long")


def link_sets(parts: list[np.ndarray], percent: int, side: np.ndarray | None = None, columns: int = 4096) -> list[tuple[int, int]]:
    """A spanning forest of the linked pairs of two sides (of all pairs if there is one side), by exact intersection counts."""
    n = np.array([len(p) for p in parts], np.int64)
    side = np.zeros(len(parts), np.int64) if side is None else side
    two = bool(side.any()) and not side.all()
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if two else (np.arange(len(parts)),) * 2
    _, token, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(parts)), n)
    # only tokens of two sets or more count
    column = np.cumsum(times > 1) - 1
    keep = times[token] > 1
    row, token = row[keep], column[token[keep]]
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    inter = np.zeros((len(left), len(right)))
    for start in range(0, int(token[-1]) + 1 if len(token) else 0, columns):
        i, j = np.searchsorted(token, [start, start + columns])
        held = np.zeros((len(parts), columns), np.float32)
        held[row[i:j], token[i:j] - start] = 1
        inter += held[left] @ held[right].T
    ok = 100 * inter >= percent * (n[left][:, None] + n[right][None, :] - inter)
    parent = list(range(len(parts)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for a, b in np.argwhere(ok if two else np.triu(ok, 1)).tolist():
        a, b = int(left[a]), int(right[b])
        x, y = top(a), top(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, of which one of each group of linked texts stays: that of the smallest doc_id.

    Rows that agree in doc_id and text are one document, and one of them stays; different texts under one doc_id are different
    documents. Null ids come last. Texts without words all stay.
    """
    last, text = F.lit((1 << 63) - 1), F.coalesce("text", F.lit(""))
    found = grouped(docs, size, percent).filter("component is not null")
    rows = stored(found.groupBy("component", F.coalesce("doc_id", last).alias("id"), "row").agg(F.count("*").alias("times")))
    first = stored(rows.groupBy("component").agg(F.min(F.struct("id", "row")).alias("first")))
    stays = F.col("first") == F.struct("id", "row")
    # most documents are alone in their group: they stay without being dealt
    others = stored(rows.join(first, "component").withColumn("stays", stays).filter(~F.col("stays") | (F.col("times") > 1)).select("id", "row", "stays"))
    a, b, c, d = (fresh(docs, name) for name in ("id", "row", "stays", "can"))
    worded = text.rlike(r"[^\x20\x09-\x0D]")
    named = docs.withColumns({a: F.coalesce(F.col("doc_id").cast("long"), last), b: F.xxhash64(F.col("doc_id").cast("long"), text)})
    named = likely(named, F.col(b), others.select(F.col("row").alias("key")), d).withColumn(d, F.col(d) & worded)
    judged = named.filter(d).join(others.select(F.col("id").alias(a), F.col("row").alias(b), F.col("stays").alias(c)), [a, b], "left")
    kept = judged.filter(F.coalesce(c, F.lit(True))).dropDuplicates([a, b])
    columns = [F.col(f"`{x}`") for x in docs.columns]
    return kept.select(*columns).unionByName(named.filter(~F.col(d)).select(*columns))
