"""Benchmark decontamination against a plain search, on edge cases and at random."""

import random
import re

import pytest

from duetto.llm import decontam
from llm import brute

DOC = "doc_id long, text string, n_hit long, th string, key int, window string"
ITEM = "item_id long, text string, words string, window int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text or ""))


def plain(docs, items):
    cuts = []
    for item_id, text in items:
        ws = words(text)
        n = min(10, len(ws))
        cuts += [(item_id, tuple(ws[s:s + n])) for s in range(len(ws) - n + 1) if n]
    out = []
    for doc_id, text in docs:
        ws, hit, ids = words(text), set(), set()
        for item_id, w in set(cuts):
            for s in range(len(ws) - len(w) + 1):
                if tuple(ws[s:s + len(w)]) == w:
                    hit |= set(range(s, s + len(w)))
                    ids.add(item_id)
        ids -= {None}
        out.append((doc_id, len(ws), len(hit), len(ids), brute.sha(",".join(sorted(map(str, ids)))), bool(hit)))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice("aa bb cc dd é 日本 x9".split()) for _ in range(n))     # noqa: E731
    items = [(k, say(n)) for k, n in enumerate([1, 2, 3, 4, 5, 6, 9, 10, 11, 14, 30])]
    items += [(20, None), (21, ""), (22, " .,! "), (None, say(12)), (3, say(7)), (None, None),
              (23, items[10][1]), (24, items[9][1].upper()), (9, items[9][1]), (25, "Kelvin K İ É word one two")]
    docs = [(k, say(n)) for k, n in enumerate([0, 1, 2, 4, 5, 9, 10, 11, 40, 300, 3000])]
    docs += [(50 + k, f"start {say(3)}. {t or ''}, {say(4)}") for k, (_, t) in enumerate(items)]
    docs += [(90, None), (91, ""), (92, "..."), (None, items[10][1]), (None, None), (50, "another text, same id"),
             (93, "kelvin k i̇ é word one two"), (94, items[8][1] + " " + items[8][1]), (95, items[10][1][:-3])]
    docs += [(96, items[9][1])] * 5
    return docs, items


@pytest.mark.parametrize("most", [decontam.MAX_BROADCAST, 0])
def test_equals_a_plain_search(spark, monkeypatch, most):
    monkeypatch.setattr(decontam, "MAX_BROADCAST", most)
    docs, items = cases()
    d = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in docs], DOC).repartition(4)
    i = spark.createDataFrame([(*r, "x", 1) for r in items], ITEM)
    got = decontam.find_leaks(d, i)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = plain(docs, items)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    # Long items only: one width of shingles.
    long = [r for r in items if len(words(r[1])) >= 10]
    got = decontam.find_leaks(d, i.filter("size(split(text, ' ')) >= 10"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, long)


def test_empty_tables(spark):
    docs, items = cases()
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert decontam.find_leaks(d.limit(0), i).count() == 0
    got = decontam.find_leaks(d, i.limit(0)).collect()
    assert len(got) == len(docs) and not any(r["contaminated"] or r["n_items"] for r in got)


def test_only_the_rarest_shingle_is_joined(spark):
    """A shingle that every document has makes no candidate where a window has a rarer one."""
    common, rare = "a b c d e", "v w x y z"
    d = spark.createDataFrame([(k, f"{common} {'f g h i ' + rare if k == 0 else 'q'}") for k in range(50)],
                              "doc_id long, text string")
    i = spark.createDataFrame([(1, f"{common} {rare}"), (2, f"{common} f g h i v")], "item_id long, text string")
    windows = decontam.windows_of(i)
    shingles = decontam.shingles_of(windows, [5])
    places = decontam.shingle_places(d, shingles.select("key").distinct(), [5])
    assert places.filter("key is not null").count() >= 50
    hits = decontam.window_hits(places, shingles).collect()
    assert [(r["doc_id"], r["start"], " ".join(r["window"])) for r in hits] == [(0, 0, "a b c d e f g h i v")]
