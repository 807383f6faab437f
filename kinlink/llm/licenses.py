"""License scan by an exact set-similarity join with license templates, in DataFrame functions alone.

Every line of every text is a block; a template matches a block that holds at least THRESHOLD of the template's distinct
words. The templates' words are put in the order of their frequency in all documents, rarest first. Then a block can reach
the threshold only if it holds one of the template's first |t| - need + 1 words (prefix), has at least need words itself
(length), and the words from the first shared one on suffice (position). What passes is verified by the intersection. The
templates are a short constant list and travel as literals, so the join needs no shuffle, and a block is never paired with
all templates that share some common word.

With ``wrapped``, every run of words as long as the template (repeated words counted) is a block too, wherever lines end.
Only runs around one of its prefix words can match, and only texts with a line break have runs that no line holds.

Edge cases: a null text is empty; texts without words have n_words 0, no labels and score 0; repeated rows are scanned
each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents

#: Phrases of the base scan and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Wordings by which works state their license, and labels.
TEMPLATES = {
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-text",
    "licensed under the apache license version 2.0": "apache-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-notice",
    "distributed under the terms of the gnu general public license": "gpl-short-notice",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd-text",
    "this work is licensed under the gnu general public license version 3": "gpl-3-notice",
    "licensed under cc by 4.0": "cc-by-notice",
    "licensed under cc by nc 4.0": "cc-by-nc-notice",
    "licensed under a creative commons attribution license": "cc-notice",
    "this source code form is subject to the terms of the mozilla public license": "mpl-notice",
}
THRESHOLD = 0.8
#: Characters between words, in text whose A-Z may not be lower-cased yet.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text, as they stand."""
    return F.array_remove(F.split(text, GAP), "")


def lower_words(text: Column) -> Column:
    return words(F.translate(text, UPPER, LOWER))


def _words(template: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in template.lower()).split()


def _plain(template: str) -> list[str]:
    return list(dict.fromkeys(_words(template)))


def frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each word of a short list stands in all documents; one row a word reaches the driver."""
    known = docs.sparkSession.createDataFrame([(w,) for w in vocabulary], "word string")
    found = documents(docs).select(F.explode(words(F.col("text"))).alias("w")).select(F.lower("w").alias("word"))
    return dict(found.join(F.broadcast(known), "word").groupBy("word").count().collect())


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, wrapped: bool = False) -> DataFrame:
    """doc_id, n_words, places (label, start of each phrase), found (label, line, containment of each match; line null: of a run)."""
    sets = {label: _plain(t) for t, label in templates.items()}
    lengths = {label: len(_words(t)) for t, label in templates.items()}
    count = frequencies(docs, sorted({w for s in sets.values() for w in s}))
    shapes, rare = [], set()
    for label, s in sets.items():
        s = sorted(s, key=lambda w: (count.get(w, 0), w))
        need = max(1, -int(-threshold * len(s) // 1))
        prefix = s[: len(s) - need + 1]
        rare |= set(prefix)
        shapes.append(F.struct(F.lit(label).alias("label"), _strings(s).alias("tokens"), _strings(prefix).alias("prefix"), F.lit(need).alias("need"), F.lit(len(s)).alias("size"), F.lit(lengths[label]).alias("length")))
    shape_list = F.array(*shapes)

    text = F.col("text")
    any_rare = "(?i)" + "|".join(sorted(rare))
    # a line is worth splitting only if the letters of some prefix word stand in it
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("text"))), lambda x: x["text"].rlike(any_rare))
    blocks = F.transform(lines, lambda x: F.struct(x["line"].alias("line"), F.array_distinct(lower_words(x["text"])).alias("tokens")))
    found = F.flatten(F.transform(blocks, lambda b: F.transform(F.filter(shape_list, lambda t: _passes(b["tokens"], t)), lambda t: F.struct(t["label"].alias("label"), b["line"].alias("line"), (F.size(F.array_intersect(t["tokens"], b["tokens"])) / t["size"]).alias("containment")))))
    none = F.array().cast("array<struct<label:string,line:int,containment:double>>")

    heads = {p: p.split() for p in phrases}
    gap = GAP[:-1] + "+"
    worth = "(?i)" + "|".join(sorted({gap.join(h) for h in heads.values()}))
    own = lower_words(text)
    at = F.array().cast("array<struct<label:string,start:int>>")
    # the words are bound to a variable, or else each step of the search below would split the text again
    places = F.element_at(F.transform(F.array(own), lambda w: F.flatten(F.array(*(_labelled(_starts(w, h), phrases[p]) for p, h in heads.items())))), 1)
    if wrapped:
        runs = F.element_at(F.transform(F.array(own), lambda w: _runs(w, shape_list, sorted(rare))), 1)
        found = F.concat(found, F.when(text.contains("\n"), runs).otherwise(none))
    return documents(docs).select(
        "doc_id",
        F.size(words(text)).cast("long").alias("n_words"),
        F.when(text.rlike(worth), places).otherwise(at).alias("places"),
        F.when(text.rlike(any_rare), found).otherwise(none).alias("found"),
    )


def _labelled(starts: Column, label: str) -> Column:
    return F.transform(starts, lambda i: F.struct(F.lit(label).alias("label"), i.alias("start")))


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def _passes(tokens: Column, t: Column) -> Column:
    """Prefix, length and position filters, then the exact test."""
    first = F.array_position(F.transform(t["tokens"], lambda w: F.array_contains(tokens, w)), True)  # 1 on: place of the rarest shared word
    return F.arrays_overlap(tokens, t["prefix"]) & (F.size(tokens) >= t["need"]) & (first > 0) & (t["size"] - first + 1 >= t["need"]) & (F.size(F.array_intersect(t["tokens"], tokens)) >= t["need"])


def _runs(own: Column, shapes: Column, rare: list[str]) -> Column:
    """The templates that match a run of their length, with their best containment; around prefix words, as _passes has them."""
    every = F.when(F.size(own) > 0, F.sequence(F.lit(0), F.size(own) - 1)).otherwise(F.array().cast("array<int>"))
    spots = F.filter(every, lambda i: F.get(own, i).isin(rare))
    low = lambda i, t: F.greatest(i - t["length"] + 1, F.lit(0))
    shared = lambda t, start, length: F.size(F.array_intersect(t["tokens"], F.slice(own, start + 1, length)))

    def best(at: Column, t: Column) -> Column:
        near = F.filter(at, lambda i: F.array_contains(t["prefix"], F.get(own, i)) & (shared(t, low(i, t), 2 * t["length"] - 1) >= t["need"]))
        return F.array_max(F.transform(near, lambda i: F.array_max(F.transform(F.sequence(low(i, t), i), lambda j: shared(t, j, t["length"])))))

    # the spots are bound to a variable, or else each template would look for them again
    each = F.element_at(F.transform(F.array(spots), lambda at: F.transform(shapes, lambda t: F.struct(t["label"].alias("label"), t["need"].alias("need"), t["size"].alias("size"), best(at, t).alias("best")))), 1)
    return F.transform(F.filter(each, lambda x: x["best"] >= x["need"]), lambda x: F.struct(x["label"].alias("label"), F.lit(None).cast("int").alias("line"), (x["best"] / x["size"]).alias("containment")))


def _starts(own: Column, phrase: list[str]) -> Column:
    """Places (from 0) at which the phrase's words stand one after the other."""
    k = len(phrase)
    every = F.when(F.size(own) >= k, F.sequence(F.lit(0), F.size(own) - k)).otherwise(F.array().cast("array<int>"))
    return F.filter(every, lambda i: (F.get(own, i) == phrase[0]) & (F.slice(own, i + 1, F.lit(k)) == _strings(phrase)))
