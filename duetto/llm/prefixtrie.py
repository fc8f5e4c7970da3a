"""A z-fast trie of conversations that share their first turns.

A conversation is a string whose letters are its turns.  The compacted trie of all
distinct conversations has a node wherever they branch or one ends; its *extent* is
the string down to it, and its *edge* the depths ``(s, e]`` below its parent.  A node
is filed in a table under its handle: the hash of the prefix at the 2-fattest depth
of its edge, the depth in ``(s, e]`` divisible by the largest power of two.

A conversation is located by fat binary search: it probes the table at the
2-fattest depth of the interval that is left, goes on below a node that it finds
and above the probe where there is none.  That leads in about log2(length) probes
to its exit node, whose extent is compared with it once.  All conversations of a
batch are located together by joins; of those that leave the trie by the same turn,
one (by a hash of its id) is inserted and the others come with the next batch, where
they go on from that depth.  A batch halves, in expectation, what each conversation
still shares with the pending ones, so the number of batches grows with the logarithm
of the conversations and never exceeds the branchings of one path.

Every edge lies on the path of one conversation, its ``ref``.  Prefixes are told by
128 bits of hashes of the turns and their depths, combined by exclusive or; these are
running values, computed in blocks, so that a long conversation is many rows and
never one.  Figures of subtrees are summed by pointer doubling, and the edges are
expanded again at last, one row for each prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duetto.llm.common import Tables
from duetto.operators.ranking import largest_groups, rank_within
from duetto.session import counted_broadcast, cut_lineage, few_partitions, fits_broadcast

SHARED, GROUP = 6, 100      # a conversation takes up to 5 first turns of its hundred's first one
BLOCK = 1024                # turns whose running values one task computes at a time
HOT_ROWS = 200_000          # a join key with more rows is dealt over several tasks
IDS = 4096                  # ids of one piece of a list to be hashed
ROWS_PER_PARTITION = 1_000_000      # turns of one partition
ROW_BYTES = 64              # of a row of the tables that are joined, about


def spread_join(left: DataFrame, right: DataFrame, on: list[str], spread: str, how: str, most: int,
                tables: Tables) -> DataFrame:
    """``left.join(right, on, how)`` for an inner or left join; keys with more than
    ``HOT_ROWS`` rows of ``left`` are dealt over several tasks by a hash of the column
    ``spread``, and their rows of ``right`` repeated for each.  ``left`` has ``most``
    rows at most."""
    if most <= HOT_ROWS:        # no key can be hot
        return left.join(right, on, how)
    left = tables.put("spread", left)
    # At most one hot key for each HOT_ROWS rows: small by construction.
    hot = F.broadcast(left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HOT_ROWS)
                      .withColumn("_n", F.ceil(F.col("_n") / HOT_ROWS).cast("int")))
    salt = F.when(F.col("_n").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread), F.col("_n")).cast("int"))
    dealt = left.join(hot, on, "left").withColumn("_salt", salt).drop("_n")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1))
    again = right.join(hot, on, "left").withColumn("_salt", copies).drop("_n")
    return dealt.join(again, [*on, "_salt"], how).drop("_salt")


def near(df: DataFrame, most: int) -> DataFrame:
    """``df``, which has ``most`` rows at most, to be broadcast if these fit."""
    return F.broadcast(few_partitions(df, most)) if fits_broadcast(df.sparkSession, most, ROW_BYTES) else df


# --- conversations as strings ------------------------------------------------


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, p, s1, s2, chars``: every turn's place from 1, hashes of its role
    and text, and the code points of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    from duetto.operators import ranking
    split = largest_groups(turns, ["conv_id"])["conv_id"] > ranking.MAX_GROUP_ROWS
    placed = rank_within(turns, "conv_id", [F.asc_nulls_first("turn"), "role", "text"], "p", split=split)
    return placed.select("conv_id", F.col("p").cast("bigint").alias("p"), F.xxhash64("role", "text").alias("s1"),
                         F.xxhash64(F.lit(7), "text", "role").alias("s2"),
                         F.char_length("text").cast("bigint").alias("chars"))


def rebuilt(turns: DataFrame, convs: DataFrame, tables: Tables) -> DataFrame:
    """``c, d, s1, s2, chars``: the turns of the rebuilt conversations.

    Conversation c gets the first h turns of c - c % 100 and its own after its
    first h; h is the CRC-32 of its id, as text, mod 6.  ``convs`` has ``conv_id, n``.
    """
    h = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % SHARED      # noqa: E731
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = (convs.select(F.col("conv_id").alias("c"), base.alias("conv_id"), h("conv_id").alias("h"))
             .join(turns.filter(F.col("p") < SHARED), "conv_id").filter("p <= h")
             .select("c", F.col("p").alias("d"), "s1", "s2", "chars"))
    # Only where the lender is missing or short are fewer than h turns lent.
    lender = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("lent"))
    short = (convs.select("conv_id", base.alias("base"), h("conv_id").alias("h")).join(lender, "base", "left")
             .select("conv_id", F.least("h", F.coalesce("lent", F.lit(0).cast("bigint"))).alias("lent"), "h")
             .filter("lent < h").select("conv_id", "lent"))
    tails = (turns.withColumn("h", h("conv_id")).filter("p > h")
             .join(counted_broadcast(tables.put("short", short), row_bytes=24), "conv_id", "left")
             .select(F.col("conv_id").alias("c"), (F.coalesce("lent", "h") + F.col("p") - F.col("h")).alias("d"),
                     "s1", "s2", "chars"))
    return heads.unionByName(tails)


def prefixes(turns: DataFrame, deepest: int) -> DataFrame:
    """``c, d, h1, h2, k``: hashes of the first d turns and the code points in them."""
    tagged = turns.select("c", "d", F.xxhash64("d", "s1", "s2").alias("x1"),
                          F.xxhash64("s2", "d", "s1").alias("x2"), "chars",
                          F.expr(f"(d - 1) div {BLOCK}").alias("block"))
    order = Window.partitionBy("c", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    run = tagged.select("c", "d", "block", F.bit_xor("x1").over(order).alias("h1"),
                        F.bit_xor("x2").over(order).alias("h2"), F.sum("chars").over(order).alias("k"))
    if deepest <= BLOCK:
        return run.drop("block")
    before = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row a block.
    start = (tagged.groupBy("c", "block").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"),
                                              F.sum("chars").alias("chars"))
             .select("c", "block", F.coalesce(F.bit_xor("x1").over(before), F.lit(0).cast("bigint")).alias("b1"),
                     F.coalesce(F.bit_xor("x2").over(before), F.lit(0).cast("bigint")).alias("b2"),
                     F.coalesce(F.sum("chars").over(before), F.lit(0).cast("bigint")).alias("bk")))
    return run.join(start, ["c", "block"]).select(
        "c", "d", F.col("h1").bitwiseXOR(F.col("b1")).alias("h1"),
        F.col("h2").bitwiseXOR(F.col("b2")).alias("h2"), (F.col("k") + F.col("bk")).alias("k"))


# --- the trie ----------------------------------------------------------------


def fattest(a: str, b: str) -> Column:
    """The number in ``(a, b]`` that the largest power of two divides."""
    return F.expr(f"shiftleft(-1L, length(bin({a} ^ {b})) - 1) & {b}")


def _at(rows: DataFrame, depth: str, paths: DataFrame) -> DataFrame:
    """``rows`` with the hashes ``h1, h2`` of conversation ``c`` at ``depth``; a depth
    of -1 has none, and keys that match nothing.  ``paths`` may be broadcast."""
    got = rows.join(paths.select("c", F.col("d").alias(depth), "h1", "h2"), ["c", depth], "left")
    return got.withColumn("h1", F.coalesce("h1", "c")).withColumn("h2", F.coalesce("h2", F.lit(0).cast("bigint")))


def file_nodes(edges: DataFrame, paths: DataFrame) -> DataFrame:
    """``handle, d, h1, h2, ref, e``: every edge under its handle (true), by which it
    is found, and under its first turn (false), by which its parent reaches it."""
    keys = F.array(F.struct(F.lit(True).alias("handle"), fattest("s", "e").alias("d")),
                   F.struct(F.lit(False).alias("handle"), (F.col("s") + 1).alias("d")))
    return (edges.select(F.col("ref").alias("c"), "e", F.explode(keys).alias("x"))
            .select("c", "x.handle", "x.d", "e").join(paths.select("c", "d", "h1", "h2"), ["c", "d"])
            .select("handle", "d", "h1", "h2", F.col("c").alias("ref"), "e"))


def locate(pending: DataFrame, n: int, filed: DataFrame, paths: DataFrame, deepest: int, tables: Tables) -> DataFrame:
    """``c, length, ref, lcp`` of each of the ``n`` rows of ``pending(c, length, a)``, known
    to share its first ``a`` turns with the trie: the conversation of the exit edge
    (null: the root), and how many turns they share."""
    filed = near(filed, filed.count())
    handles = filed.filter("handle").select(F.col("d").alias("f"), "h1", "h2", F.col("ref").alias("found"), "e")
    now = pending.select("c", "length", "a", F.col("a").alias("low"), F.col("length").alias("b"),
                         F.lit(None).cast("bigint").alias("ref"))
    # Every probe takes the highest bit away in which the interval's ends differ.
    for _ in range(int(deepest).bit_length()):
        now = now.withColumn("f", F.when(F.col("low") < F.col("b"), fattest("low", "b")).otherwise(F.lit(-1).cast("bigint")))
        hit = spread_join(_at(now, "f", paths), handles, ["f", "h1", "h2"], "c", "left", n, tables)
        now = hit.select("c", "length", "a", F.coalesce("e", "low").alias("low"),
                         F.when((F.col("f") > 0) & F.col("e").isNull(), F.col("f") - 1).otherwise(F.col("b")).alias("b"),
                         F.coalesce("found", "ref").alias("ref"))
    # The last node found is the exit node, unless the conversation goes on into an edge below it.
    first = filed.filter("not handle").select(F.col("d").alias("f"), "h1", "h2", F.col("ref").alias("child"))
    below = now.withColumn("f", F.when(F.col("low") < F.col("length"), F.col("low") + 1).otherwise(F.lit(-1).cast("bigint")))
    left = tables.put("left", spread_join(_at(below, "f", paths), first, ["f", "h1", "h2"], "c", "left", n, tables)
               .select("c", "length", "a", F.coalesce("child", "ref").alias("ref")), n)
    other = paths.select(F.col("c").alias("ref"), "d", F.col("h1").alias("o1"), F.col("h2").alias("o2"))
    own = left.filter("ref is not null").join(paths, "c").filter("d > a").select("c", "ref", "d", "h1", "h2")
    same = (spread_join(own, other, ["ref", "d"], "c", "inner", n * deepest, tables).filter("h1 = o1 and h2 = o2")
            .groupBy("c").agg(F.max("d").alias("lcp")))
    same = near(same, n)
    return left.join(same, "c", "left").select("c", "length", "ref", F.coalesce("lcp", "a").alias("lcp"))


def build(strings: DataFrame, paths: DataFrame, deepest: int, tables: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The trie of ``strings(c, length)``, all different and not empty: its edges
    ``ref, s, e``; ``ref, up, s``, where the path of each ref leaves that of ``up``
    (null: the root); and ``c, ref, e``, the node at which each string ends."""
    long, zero = "bigint", F.lit(0).cast("bigint")
    n = left = strings.count()
    pending = strings.select("c", "length", zero.alias("a"))
    bounds = tops = ends = filed = None
    also = lambda all_, more: more if all_ is None else all_.unionByName(more)      # noqa: E731
    batch = 0
    while True:
        batch += 1
        if filed is None:       # the root alone
            found = pending.select("c", "length", F.lit(None).cast(long).alias("ref"), zero.alias("lcp"))
        else:
            found = locate(pending, left, filed, paths, deepest, tables)
        turn = F.when(F.col("lcp") < F.col("length"), F.col("lcp") + 1).otherwise(F.lit(-1).cast(long))
        found = tables.put(f"found{batch}", _at(found.withColumn("f", turn), "f", paths), left)
        new = tables.put(f"new{batch}", found.filter("f > 0").groupBy("f", "h1", "h2")
                         .agg(F.min(F.struct(F.xxhash64("c").alias("by"), "c", "ref", "lcp", "length")).alias("x"))
                         .select("x.c", "x.ref", "x.lcp", "x.length"), left)
        done = found.filter("f < 0").select("c", "ref", F.col("lcp").alias("e"))
        bounds = also(bounds, new.filter("ref is not null").select("ref", F.col("lcp").alias("d"))
                      .unionByName(done.select("ref", F.col("e").alias("d")))
                      .unionByName(new.select(F.col("c").alias("ref"), F.explode(F.array("lcp", "length")).alias("d"))))
        tops = also(tops, new.select(F.col("c").alias("ref"), F.col("ref").alias("up"), F.col("lcp").alias("s")))
        ends = also(ends, done.unionByName(new.select("c", F.col("c").alias("ref"), F.col("length").alias("e"))))
        s = F.lag("d").over(Window.partitionBy("ref").orderBy("d"))
        edges = bounds.repartition("ref").distinct().select("ref", s.alias("s"), F.col("d").alias("e")).filter("s is not null")
        inserted = new.count()
        left = found.filter("f > 0").count() - inserted
        if not left:
            return tables.put("edges", edges, 2 * n), tables.put("tops", tops, n), tables.put("ends", ends, n)
        pending = (found.filter("f > 0").join(near(new.select("c"), inserted), "c", "left_anti")
                   .select("c", "length", F.col("lcp").alias("a")))
        filed = tables.put("filed", file_nodes(edges, paths), 4 * n)     # twice each edge


def parents(edges: DataFrame, tops: DataFrame) -> DataFrame:
    """``ref, s, e, up, at``: every node and its parent, the node of ``up`` at depth
    ``at``; nodes of the root's edges have the parent (0, 0)."""
    top = near(tops.select("ref", "up", "s"), tops.count())
    got = edges.join(top, ["ref", "s"], "left").join(top.select("ref", F.lit(1).alias("one"), "s"), ["ref", "s"], "left")
    up = F.when(F.col("s") == 0, F.lit(0).cast("bigint")).when(F.col("one").isNull(), F.col("ref")).otherwise(F.col("up"))
    return got.select("ref", "s", "e", up.alias("up"), F.col("s").alias("at"))


def summed(nodes: DataFrame, sums: list[str], least: list[str], tables: Tables) -> DataFrame:
    """``nodes(ref, e, up, at, ...)`` with the columns ``sums`` added up and of ``least``
    the smallest over each node's subtree, by pointer doubling: every node hands what
    it has from fewer than 2^k generations to its ancestor 2^k above."""
    figures = [*sums, *least]
    n = nodes.count()
    now = tables.put("sums", nodes.select("ref", "e", "up", "at", *figures), n)
    while not now.filter("up is not null").isEmpty():
        given = near(now.filter("up is not null").groupBy(F.col("up").alias("ref"), F.col("at").alias("e"))
                     .agg(*[F.sum(c).alias(f"_{c}") for c in sums], *[F.min(c).alias(f"_{c}") for c in least]), n)
        above = near(now.select(F.col("ref").alias("up"), F.col("e").alias("at"),
                                F.col("up").alias("up2"), F.col("at").alias("at2")).filter("up2 is not null"), n)
        # Nodes whose ancestor is the root are done; all others look their ancestor's up.
        moving = now.filter("at > 0").select("ref", "e", "up", "at")
        moved = near(spread_join(moving, above, ["up", "at"], "ref", "inner", n, tables)
                 .select("ref", "e", F.col("up2").alias("up"), F.col("at2").alias("at")), n)
        now = tables.put("sums", now.drop("up", "at").join(given, ["ref", "e"], "left").join(moved, ["ref", "e"], "left")
                  .select("ref", "e", "up", "at",
                          *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).cast("bigint").alias(c) for c in sums],
                          *[F.least(c, f"_{c}").alias(c) for c in least]), n)
    return now.select("ref", "e", *figures)


# --- lists of ids ------------------------------------------------------------


def id_digests(members: DataFrame) -> DataFrame:
    """``length, h1, h2, digest``: the SHA-256 of the ids ``c`` of every string, in
    ascending order and joined by commas.

    Sorted ranges of all ids are joined to pieces, and the pieces of a string are
    hashed one after another, so that no list is held; only the hash itself, which
    can't be divided, follows a string's pieces through one task.
    """
    key = ["length", "h1", "h2"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(zip(*(b.column(i).to_pylist() for i in range(4))))
            out, at = [], 0
            while at < len(rows):
                to = at + 1
                while to < len(rows) and to - at < IDS and rows[to][:3] == rows[at][:3]:
                    to += 1
                out.append((*rows[at], ",".join(str(r[3]) for r in rows[at:to])))
                at = to
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 5, [pa.int64()] * 4 + [pa.string()])],
                names=[*key, "c", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()])], names=[*key, "digest"])
        last, state = None, None
        for b in batches:
            out = []
            for *own, _, ids in zip(*(b.column(i).to_pylist() for i in range(5))):
                if own != last:
                    if last is not None:
                        out.append((*last, state.hexdigest()))
                    last, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if out:
                yield batch(out)
        if last is not None:
            yield batch([(*last, state.hexdigest())])

    rows = members.select(*key, "c").repartitionByRange(*key, "c").sortWithinPartitions(*key, "c")
    return (rows.mapInArrow(pieces, "length bigint, h1 bigint, h2 bigint, c bigint, ids string")
            .repartition(*key).sortWithinPartitions(*key, "c")
            .mapInArrow(hashed, "length bigint, h1 bigint, h2 bigint, digest string"))


# --- the operator ------------------------------------------------------------


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns of the rebuilt conversations:
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``.

    ``conversations`` has ``conv_id, turn, role, text``; further columns are ignored.
    Rows without conv_id belong to no conversation.  Turns stand in order of ``turn``,
    null first; those that share a number in order of role, then text, and rows that
    repeat are turns of their own.  A null role or text is empty.  A conversation
    without turns after rebuilding is a member of the root alone.  Copies are one
    string with several members.  Conversations of any length and texts of any size
    are whole.  An empty table has no conversation and gives no row.
    """
    none = hashlib.sha256(b"").hexdigest()
    tables = Tables(conversations.sparkSession, "trie")
    rows = conversations.count()
    turns = tables.put("turns", numbered_turns(conversations), rows)
    convs = tables.put("convs", turns.groupBy("conv_id").agg(F.max("p").alias("n")), rows)
    n = convs.count()
    strings = tables.put("strings", rebuilt(turns, convs, tables), rows + (SHARED - 1) * n)
    deepest = strings.agg(F.max("d")).first()[0] or 0
    every = tables.put("every", prefixes(strings, deepest), rows + (SHARED - 1) * n)
    last = every.groupBy("c").agg(F.max(F.struct("d", "h1", "h2", "k")).alias("x")).select("c", "x.*")
    zero = F.lit(0).cast("bigint")
    members = tables.put("members", convs.select(F.col("conv_id").alias("c"))
                         .join(near(last, n), "c", "left")
                         .select("c", F.coalesce("d", zero).alias("length"), F.coalesce("h1", zero).alias("h1"),
                                 F.coalesce("h2", zero).alias("h2"), F.coalesce("k", zero).alias("k")), n)
    kinds = tables.put("kinds", members.groupBy("length", "h1", "h2")
                       .agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("n"), F.first("k").alias("k")), n)
    digests = tables.put("digests", kinds.join(near(id_digests(members), n), ["length", "h1", "h2"])
                         .select("c", "length", "n", "k", "digest"), n)
    own = tables.put("strings", kinds.filter("length > 0").select("c", "length"), n)
    paths, n = every.join(near(own.select("c"), n), "c"), every.count()
    if fits_broadcast(conversations.sparkSession, n, ROW_BYTES):
        paths = near(tables.put("paths", paths, n), n)
    else:       # too large to be sent around: laid out once, where every probe finds it
        parts = max(conversations.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS_PER_PARTITION))
        paths = cut_lineage(paths.repartition(parts, "c", "d").sortWithinPartitions("c", "d"), keep_layout=True)
    edges, tops, ends = build(own, paths, deepest, tables)

    # Figures of each node itself, then of its subtree.
    known = parents(edges, tops)
    depth = paths.select(F.col("c").alias("ref"), F.col("d").alias("e"), "k")
    known = (known.join(depth, ["ref", "e"])
             .join(depth.select("ref", F.col("e").alias("s"), F.col("k").alias("ks")), ["ref", "s"], "left")
             .withColumn("ks", F.coalesce("ks", zero)))
    n = digests.count()
    there = ends.join(near(digests, n), "c").select("ref", "e", "c", "n", "k", "digest")
    root = digests.filter("length = 0")
    there = there.select("ref", "e", "c", "n", (F.col("n") * F.col("k")).alias("nk"), "digest").unionByName(
        root.select(zero.alias("ref"), zero.alias("e"), "c", "n", zero.alias("nk"), "digest"))
    spark = conversations.sparkSession
    top = (convs.limit(1).select(zero.alias("ref"), zero.alias("s"), zero.alias("e"), F.lit(None).cast("bigint").alias("up"),
                                 F.lit(None).cast("bigint").alias("at"), zero.alias("k"), zero.alias("ks")))
    children = known.groupBy(F.col("up").alias("ref"), F.col("at").alias("e")).agg(F.count(F.lit(1)).alias("n_children"))
    most = 2 * n + 1        # nodes: no inner one has a single way on unless a string ends there
    own_nodes = tables.put("own", known.unionByName(top).join(near(children, most), ["ref", "e"], "left")
                           .join(near(there, n), ["ref", "e"], "left")
                .select("ref", "s", "e", "up", "at", "k", "ks", F.coalesce("n_children", zero).alias("n_children"),
                        F.coalesce("n", zero).alias("n_convs"), F.col("c").alias("conv_id"),
                        F.coalesce("nk", zero).alias("nk"), (F.col("k") - F.col("ks")).alias("kept"),
                        F.when(F.col("n_children") > 0, zero).otherwise(zero + 1).alias("n_leaves"),
                        F.coalesce("digest", F.lit(none)).alias("digest")), most)
    whole = summed(own_nodes, ["n_convs", "nk", "kept", "n_leaves"], ["conv_id"], tables)
    nodes = own_nodes.select("ref", "s", "e", "up", "at", "ks", "n_children", "digest").join(near(whole, most), ["ref", "e"])
    above = whole.select(F.col("ref").alias("up"), F.col("e").alias("at"), F.col("conv_id").alias("parent_conv_id"))
    nodes = tables.put("nodes", spread_join(nodes, near(above, most), ["up", "at"], "ref", "left", most, tables), most)

    # Only the nodes and the paths are read from here on.
    tables.drop(*[name for name in tables.paths if name not in ("nodes", "paths")])

    # Edges expanded: one row for each depth, from the path of the edge's conversation.
    block = lambda d: F.expr(f"({d}) div {BLOCK}")      # noqa: E731
    blocks = (nodes.filter("e > 0").withColumn("block", F.explode(F.sequence(block("s + 1"), block("e")))))
    blocks = near(blocks, most + n * (1 + deepest // BLOCK))
    steps = paths.select(F.col("c").alias("ref"), "d", block("d").alias("block"))
    before = depth.select("ref", (F.col("e") + 1).alias("d"), F.col("k").alias("before"))
    steps = steps.join(before, ["ref", "d"], "left").withColumn("before", F.coalesce("before", zero))
    rows = steps.join(blocks, ["ref", "block"]).filter("s < d and d <= e")
    # Of all of a subtree's turns, each member's count and each node's once less; the edge above d is not below it.
    saved = F.col("nk") - F.col("n_convs") * F.col("before") - (F.col("kept") - (F.col("before") - F.col("ks")))
    out = rows.select(
        "conv_id", F.col("d").alias("depth"),
        F.when(F.col("d") == F.col("s") + 1, F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(F.col("d") < F.col("e"), zero + 1).otherwise(F.col("n_children")).alias("n_children"),
        "n_leaves", saved.alias("saved_tokens"),
        F.when(F.col("d") < F.col("e"), F.lit(none)).otherwise(F.col("digest")).alias("ends_sha256"))
    return out.unionByName(nodes.filter("e = 0").select(
        "conv_id", F.col("e").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("nk") - F.col("kept")).alias("saved_tokens"), F.col("digest").alias("ends_sha256")))
