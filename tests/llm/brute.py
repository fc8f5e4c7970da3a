"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

BASE_SECRETS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                          r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 6, 2),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 20, 0),
    ("hex", re.compile(r"[0-9a-f]+"), 24, 0),
]


def held_out(doc_id) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def secret_spans(text: str | None) -> list[tuple[int, int, str, int]]:
    """(start, kind's number, kind, end), sorted."""
    out = []
    for k, (kind, pattern, least, group) in enumerate(BASE_SECRETS):
        out += [(m.start(), k, kind, m.end()) for m in pattern.finditer(text or "")
                if len(m.group(group)) >= least]
    return sorted(out)


def span_text(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text: str | None) -> frozenset:
    w = words(lower(text or ""))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def near_components(docs: list[tuple], percent: int = 85) -> dict:
    """doc_id -> smallest doc_id of its component, by comparing all pairs."""
    up = {i: i for i, _ in docs if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [(i, shingles(t)) for i, t in docs if i is not None]
    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            both = len(s & t)
            if s and t and 100 * both >= percent * (len(s) + len(t) - both):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in up}


def quality(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def license_places(text: str | None, phrases: dict[str, str]) -> tuple[int, list[tuple[int, str]]]:
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    places = [(i, label) for label, p in phrases.items() for p in [p.split()]
              for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return len(w), sorted(places)


def phrases_of(symbols: list[int], sample: list[int]) -> int:
    """Cross-parsing: longest phrases of ``symbols`` that occur in ``sample``; a
    symbol that the sample lacks is a phrase of its own."""
    text, n, i = "".join(map(chr, sample)), 0, 0
    whole = "".join(map(chr, symbols))
    while i < len(whole):
        k = 1
        while i + k <= len(whole) and whole[i:i + k] in text:
            k += 1
        i += max(1, k - 1)
        n += 1
    return n
