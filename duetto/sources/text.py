"""Preference text files (A1, A3).

Format: one line per entity, the line number (from 0) is the entity id, the
line holds the ids it ranks, best first, separated by whitespace.  Lines may be
padded, blank (an entity that ranks nobody) and end in ``\\r\\n``.

Reading numbers lines without a driver-side pass: every (file, split) is read
by one task in order, so ``monotonically_increasing_id`` is consecutive inside
it; a small table of line counts per (file, split), cumulated in file order,
turns those into global line numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK
from duetto.operators.filters import one_sided_pairs
from duetto.operators.joins import mutual_edges
from duetto.operators.reshape import collapse_preferences, explode_preferences, list_text
from duetto.session import counted_broadcast, cut_lineage


def parse_id_list(line) -> F.Column:
    """Whitespace-separated ids -> array<bigint>; blank -> empty array (H4)."""
    t = F.trim(F.regexp_replace(line, r"\s+", " "))
    return F.when(t == "", F.array().cast("array<bigint>")).otherwise(
        F.split(t, " ").cast("array<bigint>"))


def bad_token(line) -> F.Column:
    """The first token of a line that is no 64-bit integer, or null."""
    tokens = F.filter(F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " "),
                      lambda t: (t != "") & t.try_cast("bigint").isNull())
    return F.get(tokens, 0)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``number, file, line, value`` of every line of a file (or folder of part files,
    in name order): its number from 0 over all files, and from 1 in its own."""
    raw = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_mid"))
    splits = raw.groupBy("_f", "_b").agg(F.min("_mid").alias("_first"),
                                         F.count(F.lit(1)).alias("_n"))
    # One row per file split: the running total is tiny.
    w = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # Written once: counting it for the broadcast must not read the lines again.
    splits = cut_lineage(splits.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
                         .withColumn("_own", F.coalesce(F.sum("_n").over(own), F.lit(0))))
    at = F.col("_mid") - F.col("_first")
    return (raw.join(counted_broadcast(splits.select("_f", "_b", "_first", "_off", "_own"),
                                       row_bytes=200), ["_f", "_b"])
            .select((F.col("_off") + at).alias("number"), F.col("_f").alias("file"),
                    (F.col("_own") + at + 1).alias("line"), "value"))


def read_preferences_text(spark: SparkSession, path: str, id_col: str,
                          prefs_col: str = "prefs") -> DataFrame:
    """Read a preference file (or folder of part files, in name order).

    A token that is no 64-bit integer is an error, see :func:`read_preferences_rescued`.
    """
    return numbered_lines(spark, path).select(
        F.col("number").alias(id_col), parse_id_list(F.col("value")).alias(prefs_col))


def read_preferences_rescued(spark: SparkSession, path: str, id_col: str,
                             prefs_col: str = "prefs") -> DataFrame:
    """Like :func:`read_preferences_text`, but bad lines are rows of their own: the
    columns are the id, the list, and ``file, line, text, reason``.

    Of a good line the last four are null.  A line with a token that is no 64-bit
    integer keeps its id, has no list (null), and tells where it stands, what it says
    and which token is the first bad one.  One pass reads both kinds.
    """
    bad = bad_token(F.col("value"))
    of_bad = lambda c: F.when(F.col("_bad").isNotNull(), F.col(c))      # noqa: E731
    reason = F.concat(F.when(F.col("_bad").rlike("^[+-]?[0-9]+$"), F.lit("beyond 64 bits: "))
                      .otherwise(F.lit("not an integer: ")), F.col("_bad"))
    return (numbered_lines(spark, path).withColumn("_bad", bad)
            .select(F.col("number").alias(id_col),
                    F.when(F.col("_bad").isNull(), parse_id_list(F.col("value"))).alias(prefs_col),
                    of_bad("file").alias("file"), of_bad("line").alias("line"),
                    of_bad("value").alias("text"), reason.alias("reason")))


def write_preferences_text(lists: DataFrame, id_col: str, path: str,
                           prefs_col: str = "prefs",
                           entities: DataFrame | None = None,
                           pad: int | None = None) -> None:
    """Write one line per id in id order (A3).

    Ids must be 0..n-1; pass ``entities`` (a table of all ids) to emit blank
    lines for entities without a list.  ``pad`` writes every id right-aligned
    in a field of that width (the padded doctor-file style).  The global sort
    range-partitions the lines, so part files are written in parallel and in
    id order.
    """
    if entities is not None:
        lists = entities.select(id_col).join(lists, id_col, "left")
    lines = lists.select(id_col, F.coalesce(list_text(prefs_col, pad), F.lit("")).alias("value"))
    lines.orderBy(id_col).select("value").write.mode("overwrite").text(path)


def write_market_text(edges: DataFrame, doctors: DataFrame, hospitals: DataFrame,
                      doctor_path: str, hospital_path: str,
                      doctor_pad: int | None = 5) -> None:
    """Write a market as the two preference files: doctors' lists (padded)
    and hospitals' lists (ragged, blank line for a hospital nobody applied
    to).  ``doctors`` / ``hospitals`` hold every id (0..n-1)."""
    dl = collapse_preferences(edges, DOCTOR, HOSPITAL, DOCTOR_RANK)
    hl = collapse_preferences(edges, HOSPITAL, DOCTOR, HOSPITAL_RANK)
    write_preferences_text(dl, DOCTOR, doctor_path, entities=doctors, pad=doctor_pad)
    write_preferences_text(hl, HOSPITAL, hospital_path, entities=hospitals)


def rescue_market_text(spark: SparkSession, doctor_path: str,
                       hospital_path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Like :func:`read_market_text`, with a third result: the bad lines of both files
    (``side, id, file, line, text, reason``), whose entities list nobody.  Both files
    are read once and written to the checkpoint folder."""
    lists, bad = [], []
    for side, path in ((DOCTOR, doctor_path), (HOSPITAL, hospital_path)):
        rows = cut_lineage(read_preferences_rescued(spark, path, side))
        lists.append(rows.where("reason is null").select(side, "prefs"))
        bad.append(rows.where("reason is not null").select(
            F.lit(side).alias("side"), F.col(side).alias("id"), "file", "line", "text", "reason"))
    return (*_market(*lists), bad[0].unionByName(bad[1]))


def read_market_text(spark: SparkSession, doctor_path: str,
                     hospital_path: str) -> tuple[DataFrame, DataFrame]:
    """Read the two preference files into (edges, one-sided pairs).

    Ranks are first 0-based positions (lists may repeat ids).  Pairs listed
    by one side only are not edges; they are returned separately so they can
    be reported instead of failing the run.
    """
    return _market(read_preferences_text(spark, doctor_path, DOCTOR),
                   read_preferences_text(spark, hospital_path, HOSPITAL))


def _market(dl: DataFrame, hl: DataFrame) -> tuple[DataFrame, DataFrame]:
    de = explode_preferences(dl, DOCTOR, "prefs", HOSPITAL, DOCTOR_RANK)
    he = explode_preferences(hl, HOSPITAL, "prefs", DOCTOR, HOSPITAL_RANK)
    edges = mutual_edges(de, he).select(DOCTOR, HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK)
    return edges, one_sided_pairs(de, he)
