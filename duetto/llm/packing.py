"""Best-fit packing into sequences of several permitted lengths.

Documents, cut where they are longer than the longest sequence, are dealt evenly
to shards; every shard packs its pieces, longest first, into the open bin that
they fill best.  Where none has room, the bin size is opened whose cost for each
word that it can be expected to hold is least; at the end each bin shrinks to
the smallest size that holds its contents.

Only lengths are moved.  A shard's size is bounded, and what sharding loses is
at most the last, partly filled bins of each shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.llm.common import cut

#: Permitted sequence lengths, in words.
SIZES = (256, 512, 1024, 2048, 4096)
#: Cost of a sequence: a fixed part, its length, and a part that grows with the
#: square of its length, as attention does.
FIXED_COST, SQUARE_COST = 16.0, 1.0 / 16_384
#: Pieces that one shard packs, about.
SHARD_PIECES = 50_000


def cost(size: int) -> float:
    return FIXED_COST + size + SQUARE_COST * size * size


def pack(lengths: np.ndarray, sizes: tuple[int, ...] = SIZES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every piece, and the final size of every bin.

    Pieces must not be longer than the largest size; those of equal length are
    packed in their order.  Empty pieces get a place in the first open bin.
    """
    sizes = tuple(sorted(sizes))
    top = sizes[-1]
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened: list[int] = []                              # sizes of the bins
    used: list[int] = []
    free: list[list[int]] = [[] for _ in range(top + 1)]    # bins by free room
    rooms = 0                                           # bit r: some bin has room r
    left = int(lengths.sum())
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                rooms &= ~(1 << room)
        else:
            # What is left can fill a bin up, if there is enough of it.
            size = min((s for s in sizes if s >= n), key=lambda s: (cost(s) / max(1, min(s, left)), s))
            room, b = size, len(opened)
            opened.append(size)
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        left -= n
        free[room - n].append(b)
        rooms |= 1 << (room - n)
    ends = np.searchsorted(np.array(sizes), np.array(used, dtype=np.int64))
    return bins, offsets, np.array(sizes, dtype=np.int64)[ends] if opened else np.zeros(0, np.int64)


def pieces_of(docs: DataFrame, top: int) -> DataFrame:
    """``doc_id, th, piece, start, length``: every row's words, cut at ``top``.

    A text without words is one piece of length 0.
    """
    words = F.coalesce(F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")), F.lit(0))
    n = F.greatest(words, F.lit(0)).cast("bigint")
    count = F.greatest(F.ceil(F.col("n") / top), F.lit(1)).cast("bigint")
    own = docs.select("doc_id", F.xxhash64("text").alias("th"), n.alias("n"))
    return (own.select("doc_id", "th", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1))
                       .alias("piece"))
            .select("doc_id", "th", F.col("piece").cast("int").alias("piece"),
                    (F.col("piece") * top).alias("start"),
                    F.least(F.lit(top).cast("bigint"), F.col("n") - F.col("piece") * top).alias("length")))


def pack_documents(docs: DataFrame, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """``doc_id, piece, start, length, bin_id, offset, capacity``: every piece of
    every row of ``docs`` (``doc_id, text``; further columns are ignored).

    ``start`` and ``length`` are words of the text, ``offset`` the place in the
    bin, ``capacity`` the bin's final size.  Bins are numbered across shards.  A
    null or empty text is a piece of length 0; repeated rows are each packed; an
    empty table gives an empty result.
    """
    sizes = tuple(sorted(sizes))
    pieces = cut(pieces_of(docs, sizes[-1]))
    shards = max(1, -(-pieces.count() // SHARD_PIECES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("th", "ascending"),
             ("piece", "ascending")]).combine_chunks()
        bins, offsets, final = pack(t.column("length").to_numpy(), sizes)
        shard = TaskContext.get().partitionId()
        out = pa.table({
            "doc_id": t.column("doc_id"), "piece": t.column("piece"), "start": t.column("start"),
            "length": t.column("length"), "bin_id": pa.array((shard << 40) + bins, pa.int64()),
            "offset": pa.array(offsets, pa.int64()), "capacity": pa.array(final[bins], pa.int64())})
        yield from out.to_batches(max_chunksize=10_000)

    kind = pieces.schema["doc_id"].dataType.simpleString()
    # Dealt round robin: even whatever the keys are, and sorted first, so that a
    # task that runs again deals the same.
    return pieces.repartition(shards).mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, bin_id bigint, "
             "offset bigint, capacity bigint")
