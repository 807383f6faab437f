"""Benchmark decontamination with a positional inverted index of the training documents.

The index is dealt by document: each row is the index of one block of documents, with the block's terms and, for each
term, its ascending positions (a gap parts the documents). The test items, a stated query set, go to every block: a
window's posting lists are taken from the rarest term in the block on, shifted by the term's place in the window and
intersected, which gives the exact phrase matches. Proximity matches come from the same lists. Items above the size bound
are searched in several blocks of items, and the spans of a document are united. Nothing is dealt by a key, so hot terms,
hot sources and groups of copies cannot load one task.

Edge cases: null texts and texts without words have n_words 0 and no spans; items without words, or with a null id, have
no window; repeated rows are indexed each; an empty table gives no rows, an empty benchmark no spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, documents, fresh, map_texts, stored

INDEX = "doc_ids array<long>, n_words array<int>, terms array<binary>, counts array<int>, positions binary"
SPANS = "doc_id long, n_words long, spans array<struct<start:int,end:int>>, items array<long>"


def build_index(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Store the postings of all words of all documents; later benchmarks can search the same index."""

    def make():
        def index(block: dict) -> Iterator[dict]:
            number: dict[bytes, int] = {}
            get, parts, sizes = (lambda w: number.setdefault(w, len(number))), [], []
            for text in block["text"]:
                words = alnum_words(text)
                parts.append(np.fromiter(map(get, words), np.int32, len(words)))
                sizes.append(len(words))
            flat = np.concatenate(parts)
            # a word's position in the block: words before it, and one gap for each document before
            at = np.arange(len(flat), dtype=np.uint32) + np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
            order = np.argsort(flat, kind="stable")
            yield {"doc_ids": [block["doc_id"]], "n_words": [sizes], "terms": [list(number)], "counts": [np.bincount(flat, minlength=len(number)).astype(np.int32)], "positions": [at[order].astype("<u4").tobytes()]}

        return index

    return stored(map_texts(documents(docs), make, INDEX), path)


def item_blocks(items: DataFrame, window: int, most_words: int) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """(item id, words) of each window, in blocks of at most so many words of items (one item at least)."""
    ids: list[int] = []
    windows: list[list[bytes]] = []
    total = 0
    for row in items.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        words = alnum_words(row[1] or "")
        if row[0] is None or not words:
            continue
        if ids and total + len(words) > most_words:
            yield ids, windows
            ids, windows, total = [], [], 0
        total += len(words)
        for i in range(max(1, len(words) - window + 1)):
            ids.append(row[0])
            windows.append(words[i : i + window])
    yield ids, windows


class Windows:
    """A block of windows, ready to be searched in an index block."""

    def __init__(self, ids: list[int], windows: list[list[bytes]]):
        self.ids = np.array(ids, np.int64)
        self.number = {t: i for i, t in enumerate(dict.fromkeys(w for x in windows for w in x))}
        self.sizes = np.array([len(x) for x in windows], np.int64)
        self.terms = np.full((len(windows), max([1, *self.sizes.tolist()])), -1, np.int64)
        for i, x in enumerate(windows):
            self.terms[i, : len(x)] = [self.number[w] for w in x]

    def postings(self, terms: list[bytes], counts: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The block's postings of these terms: sorted keys term * span + position, each term's count, the span."""
        starts = np.cumsum(counts, dtype=np.int64) - counts
        span = int(positions.max(initial=0)) + 64
        n = np.zeros(len(self.number) + 1, np.int64)  # the last is that of the padding
        parts: list[tuple[int, np.ndarray]] = []
        get = self.number.get
        for j, t in enumerate(map(get, terms)):
            if t is not None:
                n[t] = counts[j]
                parts.append((t, positions[starts[j] : starts[j] + counts[j]]))
        parts.sort(key=lambda p: p[0])
        keys = np.concatenate([t * span + p.astype(np.int64) for t, p in parts]) if parts else np.zeros(0, np.int64)
        return keys, n, span

    def matches(self, keys: np.ndarray, n: np.ndarray, span: int, most: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window number, start position) of all exact matches, in pieces."""
        if not len(keys) or not len(self.ids):
            return
        first = np.cumsum(n[:-1]) - n[:-1]
        df = np.where(self.terms >= 0, n[self.terms], np.iinfo(np.int64).max)
        order = np.argsort(df, axis=1, kind="stable")  # places from the rarest term on; padding last
        alive = np.flatnonzero(np.take_along_axis(df, order[:, :1], 1)[:, 0] > 0)
        rare = np.take_along_axis(self.terms, order, 1)
        lists = n[rare[alive, 0]]
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(lists) // most)) + 1).tolist(), len(alive)]
        for i, j in pairwise(cuts):
            w, size = alive[i:j], lists[i:j]
            which = np.repeat(np.arange(len(w)), size)
            place = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
            start = keys[first[rare[w, 0]][which] + place] - (rare[w, 0] * span)[which] - order[w, 0][which]
            win = w[which]
            keep = start >= 0
            win, start = win[keep], start[keep]
            for r in range(1, self.terms.shape[1]):
                left = r < self.sizes[win]
                key = rare[win, r] * span + start + order[win, r]
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                keep = ~left | (keys[at] == key)
                win, start = win[keep], start[keep]
                if not len(win):
                    break
            if len(win):
                yield win, start


def search(index: DataFrame, items: DataFrame, window: int = 10, most_words: int = 500_000) -> DataFrame:
    """Exact matches of all windows of the items: per document doc_id, n_words, spans of hit words, items that occur.

    most_words: the items go to the tasks in blocks of at most so many words, each block in a pass of its own.
    """
    passes = [_search(index, Windows(*b)) for b in item_blocks(items, window, most_words)]
    if len(passes) == 1:
        return passes[0]
    # the same rows come from each pass: unite the spans of each document row
    merged = None
    for p in passes:
        merged = p if merged is None else merged.unionByName(p)
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    joined = F.aggregate(
        spans,
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(x))),
    )
    return merged.groupBy("row", "doc_id", "n_words").agg(joined.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def _search(index: DataFrame, windows: Windows) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(windows)  # at most most_words words

    def make():
        def found(block: dict) -> Iterator[dict]:
            ws = shared.value
            for doc_ids, sizes, terms, counts, positions in zip(*(block[k] for k in ("doc_ids", "n_words", "terms", "counts", "positions")), strict=True):
                sizes = np.array(sizes, np.int64)
                at = np.cumsum(sizes + 1) - sizes - 1
                keys, n, span = ws.postings(terms, np.array(counts, np.int64), np.frombuffer(positions, "<u4"))
                marks = np.zeros(int(sizes.sum()) + len(sizes) + 1, np.int32)
                pairs: set[tuple[int, int]] = set()
                for win, start in ws.matches(keys, n, span):
                    np.add.at(marks, start, 1)
                    np.add.at(marks, start + ws.sizes[win], -1)
                    doc = np.searchsorted(at, start, "right") - 1
                    pairs.update(map(tuple, np.unique(np.stack([doc, ws.ids[win]], 1), axis=0).tolist()))
                hit = np.concatenate([[False], np.cumsum(marks) > 0])
                edge = np.flatnonzero(hit[1:] != hit[:-1])
                spans: list[list[dict]] = [[] for _ in doc_ids]
                for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    d = int(np.searchsorted(at, a, "right")) - 1
                    spans[d].append({"start": a - int(at[d]), "end": b - int(at[d])})
                items: list[list[int]] = [[] for _ in doc_ids]
                for d, item in sorted(pairs):
                    items[d].append(item)
                yield {"doc_id": doc_ids, "n_words": sizes, "spans": spans, "items": items}

        return found

    return map_texts(index, make, SPANS).withColumn("row", F.monotonically_increasing_id())


def keep_uncontaminated(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The documents, all columns, without a hit. Of rows that share a doc_id all go if one is hit; rows without an id are
    searched by themselves and joined by their text.
    """
    hit = F.size("spans") > 0
    by = fresh(docs, "hit_id")
    named = search(build_index(docs.filter("doc_id is not null")), items, window).filter(hit).select(F.col("doc_id").alias(by)).distinct()
    kept = docs.filter("doc_id is not null").join(named, F.col("doc_id").cast("long") == F.col(by), "left_anti")
    lost = docs.filter("doc_id is null")
    by_text = lost.select(F.xxhash64("text").alias("doc_id"), "text")
    bad = search(build_index(by_text), items, window).filter(hit).select(F.col("doc_id").alias(by)).distinct()
    return kept.unionByName(lost.join(bad, F.xxhash64("text") == F.col(by), "left_anti")).select(*(F.col(f"`{c}`") for c in docs.columns))


def proximity(index: DataFrame, phrases: dict[int, str], slop: int = 5) -> DataFrame:
    """Documents in which all words of a phrase stand within slop positions of its rarest word: doc_id, phrase_id, position.

    phrases: a small stated set, sent to every block.
    """
    windows = Windows(list(phrases), [alnum_words(t) for t in phrases.values()])

    def make():
        def near(block: dict) -> Iterator[dict]:
            for doc_ids, sizes, terms, counts, positions in zip(*(block[k] for k in ("doc_ids", "n_words", "terms", "counts", "positions")), strict=True):
                sizes = np.array(sizes, np.int64)
                at = np.cumsum(sizes + 1) - sizes - 1
                keys, n, span = windows.postings(terms, np.array(counts, np.int64), np.frombuffer(positions, "<u4"))
                out: dict[str, list] = {"doc_id": [], "phrase_id": [], "position": []}
                first = np.cumsum(n[:-1]) - n[:-1]
                for i, phrase in enumerate(windows.ids.tolist()):
                    own = np.unique(windows.terms[i, : windows.sizes[i]])
                    if not len(own) or (n[own] == 0).any():
                        continue
                    own = own[np.argsort(n[own], kind="stable")]
                    spots = keys[first[own[0]] : first[own[0]] + n[own[0]]] - own[0] * span
                    doc = np.searchsorted(at, spots, "right") - 1
                    for t in own[1:]:
                        low = np.maximum(spots - slop, at[doc])
                        high = np.minimum(spots + slop, at[doc] + sizes[doc] - 1)
                        ok = np.searchsorted(keys, t * span + high, "right") > np.searchsorted(keys, t * span + low, "left")
                        spots, doc = spots[ok], doc[ok]
                    out["doc_id"] += [doc_ids[d] for d in doc]
                    out["phrase_id"] += [phrase] * len(doc)
                    out["position"] += (spots - at[doc]).tolist()
                yield out

        return near

    return map_texts(index, make, "doc_id long, phrase_id long, position long")
