"""The prefix trie against a plain dictionary of all prefixes."""

import hashlib
import random
import zlib

import pytest

from duetto.llm import prefixtrie
from duetto.operators import ranking

CONV = "conv_id long, turn int, role string, text string, d int, c string, ref long, depth long"


def plain(rows):
    own = {}
    for i, t, role, text in rows:
        if i is not None:
            own.setdefault(i, []).append(((t is not None, t or 0), role or "", text or ""))
    own = {i: [(r, x) for _, r, x in sorted(v)] for i, v in own.items()}
    trunc = lambda i: i - (abs(i) % 100) * (1 if i >= 0 else -1)
    nodes = {}
    for i in own:
        h = zlib.crc32(str(i).encode()) % 6
        path = own.get(trunc(i), [])[:h] + own[i][h:]
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(i)
        nodes.setdefault(("end", tuple(path)), []).append(i)
    ends = {k[1]: v for k, v in nodes.items() if k[:1] == ("end",)}
    nodes = {k: v for k, v in nodes.items() if k[:1] != ("end",)}
    kids, out = {}, []
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    def below(k):
        todo, seen = [k], []
        while todo:
            x = todo.pop()
            seen.append(x)
            todo += kids.get(x, [])
        return seen
    for k, v in nodes.items():
        sub = below(k)
        out.append((min(v), len(k), min(nodes[k[:-1]]) if k else None, len(v), len(kids.get(k, [])),
                    sum(x not in kids for x in sub), sum((len(nodes[x]) - 1) * len(x[-1][1]) for x in sub if x),
                    hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()))
    return sorted(out, key=repr)


def cases(seed, ids=160, deep=9):
    rng = random.Random(seed)
    rows = []
    for i in range(ids):
        c = i * 7 if i % 3 else i * 100 if i < 60 else -i
        shape = rng.choice(["same", "same", "branch", "random", "long"])
        n = {"same": 6, "branch": rng.randint(1, deep), "random": rng.randint(0, deep) + 1, "long": 3 * deep}[shape]
        for t in range(n):
            word = ("x" if shape != "random" else rng.choice("xyz")) if t + 1 < n or shape == "same" else f"{rng.randint(0, 3)}é"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", word * (t + 1)))
    rows += [(5000, None, None, None), (5000, None, "a", ""), (5000, 1, "b", "tie"), (5000, 1, "b", "eit"),
             (5000, 1, "b", "eit"), (5001, 0, "user", "x"), (None, 1, "user", "lost"), (None, None, None, None),
             (99_901, 0, "user", "borrows from nobody"), (5002, 0, "a", "b"), (5003, 0, "ab", ""), (-7, 3, "user", "x")]
    rng.shuffle(rows)
    return rows


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "c", 2, 3) for r in rows], CONV).repartition(5)
    got = prefixtrie.prefix_trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                           "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("hot", [False, True])
def test_equals_a_dictionary_of_prefixes(spark, monkeypatch, hot):
    if hot:     # every size that splits something is tiny
        monkeypatch.setattr(prefixtrie, "BLOCK", 4)
        monkeypatch.setattr(prefixtrie, "HOT_ROWS", 5)
        monkeypatch.setattr(prefixtrie, "IDS", 3)
        monkeypatch.setattr(ranking, "MAX_GROUP_ROWS", 10)
        monkeypatch.setattr(prefixtrie, "fits_broadcast", lambda *_: False)
    rows = cases(1, 40 if hot else 120)
    assert run(spark, rows) == plain(rows)


def test_without_conversations_or_turns(spark):
    assert run(spark, [(None, 1, "user", "x")]) == []
    bare = next(i for i in range(100_001, 101_000) if zlib.crc32(str(i).encode()) % 6 > 2)
    rows = [(bare, 0, "user", "x"), (bare, 1, "user", "y")]       # both turns are borrowed from nobody
    assert run(spark, rows) == plain(rows) and len(plain(rows)) == 1
    rows = [(0, 0, "user", None)]
    assert run(spark, rows) == plain(rows)


def test_probes_are_two_fattest(spark):
    got = spark.createDataFrame([(a, b) for a in range(40) for b in range(a + 1, 70)], "a long, b long")
    for r in got.withColumn("f", prefixtrie.fattest("a", "b")).collect():
        assert r["f"] == max(range(r["a"] + 1, r["b"] + 1), key=lambda x: x & -x)
