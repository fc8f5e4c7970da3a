"""Text exchange (A1/A3), skew-safe ranking and contract terms."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from duetto.functions.terms import budget, min_price, utility
from duetto.names import DOCTOR, HOSPITAL
from duetto.operators.ranking import rank_within
from duetto.session import scratch_path
from duetto.sources.text import read_preferences_text, write_preferences_text


def test_roundtrip_multi_file_with_blank_lines(spark):
    lists = spark.range(0, 500).select(
        F.col("id").alias(HOSPITAL),
        F.when(F.col("id") % 7 == 0, F.array().cast("array<bigint>"))
        .otherwise(F.array(F.col("id") * 3, F.col("id") + 1, F.col("id") * 3)).alias("prefs"))
    ids = spark.range(0, 500).select(F.col("id").alias(HOSPITAL))
    path = scratch_path(spark, "roundtrip")
    write_preferences_text(lists.repartition(9), HOSPITAL, path, entities=ids)
    back = read_preferences_text(spark, path, HOSPITAL)
    got = {r[HOSPITAL]: list(r["prefs"]) for r in back.collect()}
    want = {r[HOSPITAL]: list(r["prefs"]) for r in lists.collect()}
    assert got == want


def test_rank_within_equals_row_number_on_skewed_groups(spark):
    # group 0 holds a third of the rows
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 101).alias("g"),
        (F.col("id") * 7919 % 1000).alias("v"), F.col("id"))
    want = df.withColumn("r", F.row_number().over(
        Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("id"))))
    b = sorted((r["id"], r["r"]) for r in want.select("id", "r").collect())
    for split in (True, False, None):
        got = rank_within(df, "g", [F.col("v").desc(), F.col("id")], "r",
                          num_partitions=16, split=split)
        a = sorted((r["id"], r["r"]) for r in got.select("id", "r").collect())
        assert a == b


def test_largest_groups(spark):
    from duetto.operators.ranking import largest_groups
    df = spark.range(0, 900).select((F.col("id") % 3).alias("a"), (F.col("id") % 300).alias("b"))
    assert largest_groups(df, ["a", "b"]) == {"a": 300, "b": 3}


def test_terms_do_not_overflow_on_large_ids(spark):
    big = 400_000_000_000
    df = spark.createDataFrame([(big, big // 7)], "d long, h long")
    r = df.select(utility(F.col("d"), F.col("h")).alias("u"),
                  min_price(F.col("d"), F.col("h")).alias("p"),
                  budget(F.col("h")).alias("b")).first()
    d, h = big, big // 7
    assert r["u"] == ((d + 17) * (h + 79) * 393342739) % 200
    assert r["p"] == ((d + 7) * (h + 3) * 413158511) % 500
    assert r["b"] == ((h * 67867967) % 700) + 300


def test_write_matching_text_and_parquet(spark):
    from duetto.sources.sinks import write_matching
    m = spark.createDataFrame([(0, 5), (2, 7)], "doctor_id long, hospital_id long")
    docs = spark.range(4).select(F.col("id").alias(DOCTOR))
    p = scratch_path(spark, "matching-text")
    write_matching(m, p, doctors=docs, fmt="text")
    lines = sorted(r["value"] for r in spark.read.text(p).collect())
    assert lines == ["0 5", "1 -1", "2 7", "3 -1"]
    q = scratch_path(spark, "matching-parquet")
    write_matching(m, q, doctors=docs)
    got = {r[DOCTOR]: r[HOSPITAL] for r in spark.read.parquet(q).collect()}
    assert got == {0: 5, 1: None, 2: 7, 3: None}


def test_market_text_files_padded_and_blank_lines(spark):
    from duetto.sources.text import read_market_text, write_market_text
    from duetto.names import DOCTOR_RANK, HOSPITAL_RANK
    edges = spark.createDataFrame(
        [(0, 1, 1, 1), (0, 0, 2, 1), (1, 0, 1, 2), (2, 1, 1, 2)],
        "doctor_id long, hospital_id long, doctor_rank int, hospital_rank int")
    docs = spark.range(3).select(F.col("id").alias(DOCTOR))
    hosp = spark.range(3).select(F.col("id").alias(HOSPITAL))      # hospital 2: nobody
    base = scratch_path(spark, "market")
    write_market_text(edges, docs, hosp, base + "/d", base + "/h")
    d_lines = [r["value"] for r in spark.read.text(base + "/d").collect()]
    assert sorted(d_lines) == sorted(["    1     0", "    0", "    1"])
    h_lines = [r["value"] for r in spark.read.text(base + "/h").collect()]
    assert "" in h_lines and "0 1" in h_lines
    back, one_sided = read_market_text(spark, base + "/d", base + "/h")
    got = sorted((r[DOCTOR], r[HOSPITAL], r[DOCTOR_RANK], r[HOSPITAL_RANK]) for r in back.collect())
    assert got == [(0, 0, 1, 0), (0, 1, 0, 0), (1, 0, 0, 1), (2, 1, 0, 1)]
    assert one_sided.count() == 0


def test_line_numbers_survive_many_splits_per_file(spark, tmp_path):
    # One file cut into many small splits (and tasks): ids must still be the
    # line numbers, blank lines included.
    lines = ["" if i % 11 == 0 else " ".join(str((i * 7 + j) % 97) for j in range(1 + i % 5))
             for i in range(3000)]
    path = tmp_path / "prefs.txt"
    path.write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = read_preferences_text(spark, str(path), HOSPITAL)
        assert df.rdd.getNumPartitions() > 5
        got = {r[HOSPITAL]: list(r["prefs"]) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {i: [int(x) for x in line.split()] for i, line in enumerate(lines)}
    assert got == want
