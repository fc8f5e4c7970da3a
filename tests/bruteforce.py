"""Serial reference implementations used only by the tests (small inputs)."""

from __future__ import annotations

import itertools


def edges_to_prefs(edges):
    """rows (d, h, dr, hr) -> doctor lists and hospital rank maps."""
    doc = {}
    hosp = {}
    for d, h, dr, hr in edges:
        doc.setdefault(d, []).append((dr, h))
        hosp.setdefault(h, {})[d] = hr
    return {d: [h for _, h in sorted(v)] for d, v in doc.items()}, hosp


def doctor_proposing(edges, quota):
    """Serial deferred acceptance, doctors propose.  Returns {doctor: hospital}."""
    prefs, hrank = edges_to_prefs(edges)
    nxt = {d: 0 for d in prefs}
    held = {h: [] for h in hrank}
    free = sorted(prefs)
    while free:
        d = free.pop()
        if nxt[d] >= len(prefs[d]):
            continue
        h = prefs[d][nxt[d]]
        nxt[d] += 1
        held[h].append(d)
        held[h].sort(key=lambda x: hrank[h][x])
        if len(held[h]) > quota:
            free.append(held[h].pop())
    return {d: h for h, ds in held.items() for d in ds}


def hospital_proposing(edges, quota):
    """Serial deferred acceptance, hospitals propose.  Returns {doctor: hospital}."""
    prefs, hrank = edges_to_prefs(edges)
    drank = {d: {h: i for i, h in enumerate(hs)} for d, hs in prefs.items()}
    hlist = {h: sorted(m, key=m.get) for h, m in hrank.items()}
    nxt = {h: 0 for h in hlist}
    holds = {h: set() for h in hlist}
    match = {}
    changed = True
    while changed:
        changed = False
        for h in sorted(hlist):
            while len(holds[h]) < quota and nxt[h] < len(hlist[h]):
                d = hlist[h][nxt[h]]
                nxt[h] += 1
                cur = match.get(d)
                if cur is None or drank[d][h] < drank[d][cur]:
                    if cur is not None:
                        holds[cur].discard(d)
                    match[d] = h
                    holds[h].add(d)
                    changed = True
    return match


def blocking(edges, match, quota):
    _, hrank = edges_to_prefs(edges)
    prefs, _ = edges_to_prefs(edges)
    drank = {d: {h: i for i, h in enumerate(hs)} for d, hs in prefs.items()}
    fill = {}
    for d, h in match.items():
        fill.setdefault(h, []).append(d)
    out = []
    for d, h, _, _ in edges:
        m = match.get(d)
        if m is not None and drank[d][h] >= drank[d][m]:
            continue
        held = fill.get(h, [])
        if len(held) < quota or hrank[h][d] < max(hrank[h][x] for x in held):
            out.append((d, h))
    return out


def knapsack_value(items, cap):
    """Brute force: (max utility, min spend) with spend <= cap - 1."""
    best = (0, 0)
    for r in range(len(items) + 1):
        for sub in itertools.combinations(items, r):
            spend = sum(p for _, p in sub)
            if spend <= cap - 1:
                val = sum(v for v, _ in sub)
                if val > best[0] or (val == best[0] and spend < best[1]):
                    best = (val, spend)
    return best
