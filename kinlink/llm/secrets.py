"""Secret scan with a trigram index.

Each rule's regular expression is parsed into a Boolean query over trigrams that any match must contain. In blocks of
documents an inverted index holds the postings of every trigram that some rule's query mentions (no query can ask for
another one); a rule's postings are intersected and united as its query says, and the expression runs over the whole text
of the candidates alone. A rule from which no mandatory trigram follows runs over every text. An index block is made, used
and dropped within a task, so nothing is shuffled and a lost executor costs its tasks alone.

Edge cases: null and empty texts have no spans; repeated rows are scanned each; an empty table gives no rows.
"""

from __future__ import annotations

import re
import re._constants as C
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame

from .common import LOWER, documents, map_texts

#: Most strings that a part of an expression is expanded into.
MOST = 64


@dataclass(frozen=True)
class Rule:
    """kind, expression (ASCII semantics) and the least length of a group; shorter matches are dropped."""

    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    least: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),  # as long runs match from their start on, the same as [0-9a-f]+ of 16 or more
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"bearer [A-Za-z0-9._~+/-]{20,}", True),
    Rule("url_login", r"[a-z]{3,12}://[A-Za-z0-9._-]+:[^\s/@:]{6,}@[A-Za-z0-9.-]+"),
)


def trigrams_of(strings: set[str]) -> object:
    """Query for "one of the strings occurs": True (no condition), a trigram, or a tuple that begins with "and" or "or"."""
    if any(len(s) < 3 for s in strings):
        return True
    return both("or", [both("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def both(how: str, parts: list) -> object:
    if how == "and":
        parts = [p for p in parts if p is not True]
    elif any(p is True for p in parts):
        return True
    parts = list(dict.fromkeys(parts))
    return True if not parts else parts[0] if len(parts) == 1 else (how, *parts)


def query(pattern: str) -> object:
    """The trigram query of an expression, in lower case."""
    strings, found = _sequence(parser.parse(pattern, re.ASCII))
    return both("and", [found, trigrams_of(strings) if strings is not None else True])


def _sequence(items) -> tuple[set[str] | None, object]:
    """The strings that the items stand for (None: too many), and a query that holds besides."""
    run: set[str] = {""}
    whole, found = True, []
    for op, arg in items:
        strings, more = _item(op, arg)
        found.append(more)
        if strings is not None and len(strings) * len(run) <= MOST:
            run = {a + b for a in run for b in strings}
            continue
        whole = False
        found.append(trigrams_of(run))
        run = strings if strings is not None else {""}
    if whole:
        return run, both("and", found)
    return None, both("and", [*found, trigrams_of(run)])


def _item(op, arg) -> tuple[set[str] | None, object]:
    if op is C.LITERAL:
        return {chr(arg).lower()}, True
    if op is C.IN:
        chars: set[str] = set()
        for kind, x in arg:
            if kind is C.LITERAL:
                chars.add(chr(x).lower())
            elif kind is C.RANGE and x[1] - x[0] < 8:
                chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None, True
        return (chars, True) if len(chars) <= 8 else (None, True)
    if op is C.SUBPATTERN:
        return _sequence(arg[3])
    if op is C.BRANCH:
        parts = [_sequence(x) for x in arg[1]]
        if all(s is not None for s, _ in parts):
            strings = reduce(set.union, (s for s, _ in parts))
            if len(strings) <= MOST:
                return strings, both("or", [q for _, q in parts])
        return None, both("or", [both("and", [q, trigrams_of(s) if s is not None else True]) for s, q in parts])
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        least, most, what = arg
        strings, more = _sequence(what)
        if least == 0:
            return (strings | {""}, True) if most == 1 and strings is not None else (None, True)
        if strings is not None and len(strings) == 1 and least == most <= 8:
            return {next(iter(strings)) * least}, more
        return None, both("and", [more, trigrams_of(strings) if strings is not None else True])
    if op in (C.AT, C.ASSERT_NOT):
        return {""}, True
    return None, True


def leaves(q: object) -> set[str]:
    return set() if q is True else {q} if isinstance(q, str) else set().union(*map(leaves, q[1:]))


class Index:
    """Postings (ascending document numbers) of the given trigrams in a block of texts."""

    def __init__(self, texts: list[str], slots: np.ndarray, names: list[str]):
        parts = [t.encode().translate(LOWER) for t in texts]
        flat = np.frombuffer(b"\0\0\0".join(parts) + b"\0\0\0", np.uint8)
        starts = np.cumsum([0, *(len(p) + 3 for p in parts[:-1])])
        codes = flat[:-2].astype(np.uint32)
        codes <<= 8
        codes |= flat[1:-1]
        codes <<= 8
        codes |= flat[2:]
        slot = slots[codes]
        at = np.flatnonzero(slot)
        pairs = np.unique(slot[at].astype(np.int64) << 32 | (np.searchsorted(starts, at, "right") - 1))
        edges = np.searchsorted(pairs, np.arange(1, len(names) + 2, dtype=np.int64) << 32)
        self.n = len(texts)
        self.postings = {t: pairs[edges[i] : edges[i + 1]] & 0xFFFFFFFF for i, t in enumerate(names)}

    def candidates(self, q: object) -> np.ndarray:
        if q is True:
            return np.arange(self.n)
        if isinstance(q, str):
            return self.postings[q]
        parts = [self.candidates(x) for x in q[1:]]
        if q[0] == "and":  # from the rarest on
            return reduce(lambda a, b: np.intersect1d(a, b, True), sorted(parts, key=len))
        return reduce(np.union1d, parts)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id and spans: array of (kind, start, end) in code points, by start, then the rules' order."""
    queries = [query(r.pattern) for r in rules]
    names = sorted(set().union(*map(leaves, queries)))
    if len(names) > 65_000:
        raise ValueError("too many trigrams in one set of rules")

    def make():
        slots = np.zeros(1 << 24, np.uint8 if len(names) < 255 else np.uint16)
        for i, t in enumerate(names):
            slots[int.from_bytes(t.encode("latin-1"), "big")] = i + 1
        ready = [(k, r, r.compiled(), q) for k, (r, q) in enumerate(zip(rules, queries, strict=True))]

        def spans(block: dict) -> Iterator[dict]:
            texts = block["text"]
            index = Index(texts, slots, names)
            found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for k, r, p, q in ready:
                for d in index.candidates(q).tolist():
                    found[d] += [(m.start(), k, m.end()) for m in p.finditer(texts[d]) if m.end(r.group) - m.start(r.group) >= r.least]
            yield {"doc_id": block["doc_id"], "spans": [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(x)] for x in found]}

        return spans

    return map_texts(documents(docs), make, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, mark: str = "[secret]") -> DataFrame:
    """The documents with every span replaced (overlapping spans by one mark), n_chars counted anew; all other columns stay."""
    queries = [query(r.pattern) for r in rules]
    names = sorted(set().union(*map(leaves, queries)))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def make():
        slots = np.zeros(1 << 24, np.uint8 if len(names) < 255 else np.uint16)
        for i, t in enumerate(names):
            slots[int.from_bytes(t.encode("latin-1"), "big")] = i + 1
        ready = [(r, r.compiled(), q) for r, q in zip(rules, queries, strict=True)]

        def clean(block: dict) -> Iterator[dict]:
            texts = list(block["text"])
            index = Index([t or "" for t in texts], slots, names)
            found: dict[int, list[tuple[int, int]]] = {}
            for r, p, q in ready:
                for d in index.candidates(q).tolist():
                    if texts[d]:
                        found.setdefault(d, []).extend((m.start(), m.end()) for m in p.finditer(texts[d]) if m.end(r.group) - m.start(r.group) >= r.least)
            for d, spans in found.items():
                out, end = [], 0
                for a, b in sorted(spans):
                    if a >= end:
                        out += [texts[d][end:a], mark]
                    end = max(end, b)
                texts[d] = "".join(out) + texts[d][end:]
            more = {"n_chars": [len(t) if d in found else n for d, (t, n) in enumerate(zip(texts, block["n_chars"], strict=True))]} if "n_chars" in block else {}
            yield block | {"text": texts} | more

        return clean

    return map_texts(docs, make, kinds)
