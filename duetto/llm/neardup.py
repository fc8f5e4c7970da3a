"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

A document is the set of its word shingles.  Sets are reduced to minima under
random multipliers; bands of minima give candidates, and the two low bits of
each minimum, packed, give an estimate of the similarity by counting equal
pairs of bits, corrected for chance collisions.  What the estimate does not rule
out is confirmed on the full sets.

No pairs are emitted within a group of copies:

* equal sets are one class, found by a fingerprint; one row a class goes on;
* band buckets link their members to the smallest, and the connected components
  of these links are clusters of classes that may be near;
* a cluster is compared inside tasks, block by block, and only links that join
  two parts of it leave the task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duetto.llm.common import cut, fresh
from duetto.llm.components import components

SHINGLE = 5
SIMILAR_PERCENT = 85        # of the union, unless a caller names another threshold
#: Minima of a set, and the most of them that one band joins.
MINIMA, ROWS = 192, 6
#: A pair at the threshold shares no band with this probability at most.
MISSED = 3e-7
BITS = 2
#: Estimates lie within this many standard deviations (beyond: 3e-7).
DEVIATIONS = 5.0
#: Classes and shingles that one block of a cluster holds, about.
BLOCK_CLASSES, BLOCK_SHINGLES = 1024, 1_000_000

_SEED = np.random.default_rng(20240229)
_MULTIPLIERS = (_SEED.integers(0, 2**32, MINIMA, dtype=np.uint64) | 1).astype(np.uint32)
_ORDERED = _SEED.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ROW = _SEED.integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PAIRS = np.uint64(0x5555555555555555)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words (bytes), each computed once."""

    LIMIT = 1_000_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; words end at space and the
    characters 9 to 13, A-Z are lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter((hashes[x] for x in words), dtype=np.uint64, count=n)
    if n < SHINGLE:     # the whole sequence; its length keeps it apart from longer ones
        return _mix((w * _ORDERED[:n]).sum(keepdims=True) + np.uint64(n))
    total = np.zeros(n - SHINGLE + 1, dtype=np.uint64)
    for j in range(SHINGLE):
        total += w[j:n - SHINGLE + 1 + j] * _ORDERED[j]
    return np.unique(_mix(total))


def minima_of(shingles: np.ndarray) -> np.ndarray:
    """The ``MINIMA`` minima of a set that is not empty."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(MINIMA, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(out, (short[None, at:at + 2048] * _MULTIPLIERS[:, None]).min(axis=1), out=out)
    return out


def bands_for(percent: int) -> tuple[int, int]:
    """Bands and rows of a band: the longest bands that miss few enough pairs at
    the threshold (85: 32 of 6; 80: 38 of 5)."""
    for rows in range(ROWS, 0, -1):
        if (1 - (percent / 100) ** rows) ** (MINIMA // rows) <= MISSED:
            return MINIMA // rows, rows
    raise ValueError(f"{MINIMA} minima don't find pairs that share {percent} % of the union")


def band_keys(minima: np.ndarray, percent: int = SIMILAR_PERCENT) -> np.ndarray:
    bands, n = bands_for(percent)
    rows = (minima[:bands * n].reshape(bands, n).astype(np.uint64) + np.uint64(1)) * _ROW[:n]
    return _mix(rows.sum(axis=1) + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def pack(minima: np.ndarray) -> bytes:
    """The low ``BITS`` bits of the minima."""
    low = (minima & np.uint32(3)).astype(np.uint8).reshape(-1, 4)
    return (low[:, 0] | low[:, 1] << 2 | low[:, 2] << 4 | low[:, 3] << 6).astype(np.uint8).tobytes()


def least_estimate(percent: int = SIMILAR_PERCENT) -> float:
    """Pairs at the threshold are estimated above this, but for chance."""
    chance = 0.5 ** BITS
    p = chance + (1 - chance) * percent / 100
    return percent / 100 - DEVIATIONS * np.sqrt(p * (1 - p) / MINIMA) / (1 - chance)


def estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Collision-corrected similarities of a packed signature to others."""
    x = many ^ one
    differ = np.bitwise_count((x | (x >> np.uint64(1))) & _PAIRS).sum(axis=1)
    chance = 0.5 ** BITS
    return (1 - differ / MINIMA - chance) / (1 - chance)


def signatures(docs: DataFrame, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """``doc_id, th, n, s1, s2, bands, packed`` for every row: size and
    fingerprint of its set, band keys and packed bits (empty without words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            n, s1, s2, bands, packed = [], [], [], [], []
            for text in b.column("text").to_pylist():
                s = shingle_set(text, hashes)
                n.append(len(s))
                s1.append(int(s.sum().astype(np.int64)))
                s2.append(int(_mix(s + np.uint64(1)).sum().astype(np.int64)))
                if len(s):
                    m = minima_of(s)
                    bands.append(band_keys(m, percent).view(np.int64))
                    packed.append(pack(m))
                else:
                    bands.append(np.zeros(0, np.int64))
                    packed.append(b"")
            ends = np.cumsum([0, *map(len, bands)])
            flat = np.concatenate([*bands, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64())),
                 pa.array(packed, pa.binary())],
                names=["doc_id", "th", "n", "s1", "s2", "bands", "packed"])

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(
        run, "doc_id bigint, th bigint, n bigint, s1 bigint, s2 bigint, bands array<bigint>, packed binary")


class _Parts:
    """Which members of a block are joined already."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[a] = b
        return a != b


def links_within(members: pd.DataFrame, percent: int = SIMILAR_PERCENT) -> list[tuple[int, int]]:
    """Confirmed links that join the members of one unit: ``rep, th, n, block,
    packed, text``.  With two blocks, only pairs across them are compared.

    Likely pairs are confirmed first; a pair whose ends are joined already needs
    no confirmation, since the component is the same.
    """
    n = members["n"].to_numpy(dtype=np.int64)
    block = members["block"].to_numpy()
    packed = np.frombuffer(b"".join(members["packed"]), dtype=np.uint64).reshape(len(n), -1)
    across, least = len(set(block)) > 1, least_estimate(percent)
    first, second, near = [], [], []
    for a in range(len(n) - 1):
        rest = n[a + 1:]
        fits = (100 * np.minimum(rest, n[a]) >= percent * np.maximum(rest, n[a]))
        if across:
            fits &= block[a + 1:] != block[a]
        at = np.flatnonzero(fits)
        if not len(at):
            continue
        e = estimates(packed[a], packed[a + 1 + at])
        good = e >= least
        second.append(a + 1 + at[good])
        first.append(np.full(int(good.sum()), a))
        near.append(e[good])
    if not first:
        return []
    first, second, near = (np.concatenate(x) for x in (first, second, near))
    texts, rep = members["text"].tolist(), members["rep"].tolist()
    hashes, sets, parts, out = WordHashes(), {}, _Parts(len(n)), []
    for i in np.argsort(-near, kind="stable"):
        a, b = int(first[i]), int(second[i])
        if parts.root(a) == parts.root(b):
            continue
        for x in (a, b):
            if x not in sets:
                sets[x] = shingle_set(texts[x], hashes)
        both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parts.join(a, b)
            out.append((rep[a], rep[b]))
    return out


def _classes(sigs: DataFrame) -> DataFrame:
    """One row for each distinct set: its smallest document stands for it."""
    return (sigs.filter("n > 0 and doc_id is not null").groupBy("n", "s1", "s2")
            .agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.first("bands").alias("bands"),
                 F.first("packed").alias("packed"))
            .select("n", "s1", "s2", F.col("rep.doc_id").alias("rep"), F.col("rep.th").alias("th"),
                    "bands", "packed"))


def _clusters(classes: DataFrame) -> DataFrame:
    """``node, component``: classes that share band buckets, directly or not."""
    entries = classes.select("rep", F.explode("bands").alias("key"))
    hubs = (entries.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("top"))
            .filter("hub < top").select("key", "hub"))
    return components(entries.join(hubs, "key").filter("rep <> hub")
                      .select(F.col("rep").alias("u"), F.col("hub").alias("v")))


def confirmed_links(docs: DataFrame, classes: DataFrame,
                    percent: int = SIMILAR_PERCENT) -> DataFrame:
    """``u, v``: links between classes' representatives; within every cluster
    they join exactly what the links of all its pairs would join."""
    def unit(members: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(links_within(members, percent), columns=["u", "v"], dtype="int64")

    cluster = (_clusters(classes).join(classes.withColumnRenamed("rep", "node").drop("bands"), "node")
               .select("component", F.col("node").alias("rep"), "th", "n", "packed",
                       F.xxhash64("s1", "s2").alias("deal")))
    sizes = cluster.groupBy("component").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES),
        F.lit(1)).cast("int").alias("blocks"))
    texts = docs.select(F.col("doc_id").alias("rep"), F.xxhash64("text").alias("th"), "text")
    members = (cluster.join(sizes, "component").join(texts, ["rep", "th"])
               .dropDuplicates(["rep", "th"])
               .withColumn("block", F.pmod("deal", F.col("blocks").cast("bigint")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    pair = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    return (members.select("component", *pair, "rep", "th", "n", "packed", "text", "block")
            .groupBy("component", "i", "j").applyInPandas(unit, "u bigint, v bigint"))


def near_duplicates(docs: DataFrame, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """``doc_id, th, n_shingles, component_id, kept`` for every row of ``docs``
    (``doc_id, text``; further columns are ignored); ``th`` is xxhash64 of the text.

    Documents are linked if their sets share ``percent`` of the union or more;
    a component is named by its smallest doc_id.  A text without words is linked
    with nothing, nor is a row without doc_id, whose component is null and which
    is kept.  Rows that share a doc_id are one document with several texts.  An
    empty table gives an empty result.
    """
    sigs = cut(signatures(docs, percent))
    classes = cut(_classes(sigs))
    own = (sigs.select("doc_id", "th", F.col("n").alias("n_shingles"), "n", "s1", "s2")
           .join(classes.select("n", "s1", "s2", "rep"), ["n", "s1", "s2"], "left")
           .withColumn("rep", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id"))))
    several = (own.filter("doc_id is not null").groupBy("doc_id")
               .agg(F.min("rep").alias("v"), F.max("rep").alias("top")).filter("v < top").select("doc_id", "v"))
    same = (own.select("doc_id", F.col("rep").alias("u")).join(several, "doc_id").filter("u <> v")
            .select("u", "v").distinct())
    cc = components(confirmed_links(docs, classes, percent).unionByName(same))
    component = F.coalesce("component", "rep")
    return (own.join(cc, own["rep"] == cc["node"], "left")
            .select("doc_id", "th", "n_shingles", component.alias("component_id"),
                    F.col("doc_id").eqNullSafe(component).alias("kept")))


def keep_one_of_each(docs: DataFrame, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, all columns as
    they are; of rows that repeat id and text one stays."""
    h = fresh(docs, "th")
    gone = (near_duplicates(docs, percent).filter("not kept")
            .select("doc_id", F.col("th").alias(h)).distinct())
    return (docs.withColumn(h, F.xxhash64("text")).join(gone, ["doc_id", h], "left_anti")
            .dropDuplicates(["doc_id", h]).select(*docs.columns))
