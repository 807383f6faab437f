"""Plain-Python versions that the operators are held against."""

import hashlib
import re

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BLANK = re.compile("[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def alnum_words(text):
    return ALNUM.findall((text or "").translate(LOWER))


def blank_words(text, lower=True):
    text = text or ""
    return BLANK.findall(text.translate(LOWER) if lower else text)


def contamination(docs, items, n=10):
    windows = {}
    for item, text in items:
        words = alnum_words(text)
        for i in range(max(1, len(words) - n + 1)) if words else ():
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        words = alnum_words(text)
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(words) - k + 1):
                if (w := tuple(words[i : i + k])) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[w]
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out


def base_spans(text):
    text = text or ""
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found)]
