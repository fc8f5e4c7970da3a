"""Secret scan: fixed patterns, and a randomness test battery for other tokens.

Patterns give the base spans.  The battery looks at every further run of token
characters, infers its encoding and asks two questions:

* Does it look like a uniform random string?  Chi-squared uniformity of the
  alphabet, the runs test about the alphabet's middle and the lag-1 serial
  correlation are combined into one statistic (chi-squared, 3 degrees of
  freedom); a token whose p-value is below ``ALPHA`` is not random.
* Could ordinary text look so?  Under text, a pair of its characters coincides
  with the index of coincidence of written language, a character lies in the
  inferred alphabet with a known share, and digits and inner capitals are rare.
  The p-value falls with the token's length, so short tokens need more.

The text p-values of all distinct tokens of the input go through the
Benjamini-Hochberg step-up rule at rate ``FDR``, on a fixed grid of their
logarithms, so that no global sort is needed.

Everything is DataFrame operations.  Offsets are code points, end exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duetto.llm.common import cut, fresh

#: The base patterns, as (kind, expression, length that must be reached, group).
PATTERNS = [
    ("assign", r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
               r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?"
               r"([A-Za-z0-9+/_.=-]+)", 6, 2),
    ("access", r"AKIA[A-Z0-9]+", 20, 0),
    ("hex", r"[0-9a-f]{24,}", 24, 0),   # the runs of 24 and more are the runs that pass
]
KINDS = [p[0] for p in PATTERNS] + ["random"]

#: Runs that the battery judges: base64 or base64url characters, with padding.
#: The lookbehind only stops later starts inside a run that was too short.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"

#: Encodings in the order in which they are tried: name, expression, alphabet.
_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = [
    ("decimal", r"^[0-9]+$", _DIGITS),
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef"),
    ("lower", r"^[a-z]+$", _LOW),
    ("upper", r"^[A-Z]+$", _LOW),
    ("base32", r"^([A-Z2-7]+|[a-z2-7]+)$", _LOW + "234567"),
    ("base36", r"^([A-Z0-9]+|[a-z0-9]+)$", _LOW + _DIGITS),
    ("base62", r"^[A-Za-z0-9]+$", _UP + _LOW + _DIGITS),
    ("base64", r"^.+$", _UP + _LOW + _DIGITS + "+/_-"),
]

ALPHA = 0.001           # a random token is taken for text as often as this
FDR = 0.01              # share of ordinary tokens among the reported ones
COINCIDENCE = 0.0667    # two letters of written language are equal
TRIPLE_EXCESS = 0.001   # three letters are equal more often than two independent pairs
HEX_LETTERS = 0.317     # a letter of written language is one of a-f
ODD_SHARE = 0.02        # a character of a written word is a digit, a sign or an inner capital
GRID = 0.01             # step of the grid of -log10 p
GRID_END = 4000


def _normal_tail(z: Column) -> Column:
    """P(Z > z), Lin's closed form; relative error under a tenth."""
    a = F.abs(z)
    tail = F.lit(0.5) * F.exp(-0.717 * a - 0.416 * a * a)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _normal_log10_tail(z: Column) -> Column:
    """log10 P(Z > z), which does not underflow."""
    a = F.greatest(z, F.lit(0.0))
    far = (math.log(0.5) - 0.717 * a - 0.416 * a * a) / math.log(10)
    return F.when(z > 0, far).otherwise(F.log10(_normal_tail(z)))


def _reaches(least: int) -> Callable[[Column], Column]:
    return lambda match: F.length(match) >= least


def _pattern_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, th, kind, i, gap, match, ok``: all matches of a document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = []
    for kind, pattern, least, group in [*PATTERNS, ("random", TOKEN, 20, 0)]:
        got = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else got
        kinds.append(F.when(text.rlike(pattern), F.struct(
            F.lit(kind).alias("kind"),
            F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(got)).alias("gap"),
                         got.alias("match"),
                         F.transform(judged, _reaches(least)).alias("ok")).alias("m"))))
    return (docs.select("doc_id", F.xxhash64("text").alias("th"),
                        F.explode(F.array(*kinds)).alias("k")).filter("k is not null")
            .select("doc_id", "th", F.col("k.kind").alias("kind"), F.posexplode("k.m").alias("i", "m"))
            .select("doc_id", "th", "kind", "i", F.length("m.gap").alias("gap"),
                    F.length("m.match").alias("len"),
                    F.when(F.col("kind") == "random", F.col("m.match")).alias("token"),
                    F.col("m.ok").alias("ok")))


def matches(docs: DataFrame) -> DataFrame:
    """``doc_id, th, kind, start, end, token``: base spans, and the tokens that
    the battery is to judge; rows that repeat id and text count once."""
    rows = _pattern_rows(docs).dropDuplicates(["doc_id", "th", "kind", "i"])
    run = (Window.partitionBy("doc_id", "th", "kind").orderBy("i")
           .rowsBetween(Window.unboundedPreceding, 0))
    end = F.sum(F.col("gap") + F.col("len")).over(run)
    return (rows.withColumn("end", end.cast("bigint")).filter("ok")
            .select("doc_id", "th", "kind", (F.col("end") - F.col("len")).alias("start"),
                    "end", "token"))


def battery(tokens: DataFrame) -> DataFrame:
    """``token, encoding, n, p_random, log_p_text`` for the distinct ``token``s.

    ``p_random`` is the combined p-value of the three tests; ``log_p_text`` the
    decimal logarithm of the p-value that ordinary text looks so random.
    """
    bare = F.regexp_replace("token", "=+$", "")
    encoding, alphabet = F.lit(None).cast("string"), F.lit("")
    for name, pattern, symbols in reversed(ENCODINGS):
        encoding = F.when(F.col("bare").rlike(pattern), F.lit(name)).otherwise(encoding)
        alphabet = F.when(F.col("encoding") == name, F.lit(symbols)).otherwise(alphabet)
    one_case = F.col("encoding").isin("hex", "upper", "base32", "base36")
    t = (tokens.select("token").distinct().withColumn("bare", bare)
         .withColumn("encoding", encoding).withColumn("alphabet", alphabet))
    # Base32 and base36 are tried after lower and upper case, in either case of letters.
    chars = F.split(F.when(one_case, F.lower("bare")).otherwise(F.col("bare")), "")
    t = (t.withColumn("x", F.transform(chars, lambda c: F.position(c, F.col("alphabet")).cast("double")))
         .withColumn("n", F.size("x").cast("double")).withColumn("k", F.length("alphabet").cast("double")))
    n, k = F.col("n"), F.col("k")
    tail = lambda a: F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0)))
    head = lambda a: F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)            # noqa: E731
    t = (t.withColumn("squares", total(F.transform(
            F.array_distinct("x"),
            lambda c: F.pow(F.size(F.filter("x", lambda y: y == c)).cast("double"), F.lit(2.0)))))
         .withColumn("mean", total(F.col("x")) / n)
         .withColumn("high", F.transform("x", lambda y: y > (k + 1) / 2)))
    t = (t.withColumn("n1", F.size(F.filter("high", lambda b: b)).cast("double"))
         .withColumn("runs", 1.0 + F.size(F.filter(
             F.zip_with(head(F.col("high")), tail(F.col("high")), lambda a, b: a != b),
             lambda d: d)))
         .withColumn("spread", total(F.transform("x", lambda y: F.pow(y - F.col("mean"), F.lit(2.0)))))
         .withColumn("lagged", total(F.zip_with(
             head(F.col("x")), tail(F.col("x")),
             lambda a, b: (a - F.col("mean")) * (b - F.col("mean"))))))
    chi2 = (F.col("squares") * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    expected = 2 * F.col("n1") * (n - F.col("n1")) / n + 1
    runs_var = (expected - 1) * (expected - 2) / (n - 1)
    runs = F.when(runs_var > 0, (F.col("runs") - expected) / F.sqrt(F.greatest(runs_var, F.lit(1e-9))))
    serial = F.when(F.col("spread") > 0,
                    (F.col("lagged") / F.greatest(F.col("spread"), F.lit(1e-9)) + 1 / n) * F.sqrt(n))
    worst = F.lit(10.0)     # all characters on one side, or equal
    t = t.withColumn("s", F.pow(F.greatest(chi2, F.lit(0.0)), F.lit(2.0))
                     + F.pow(F.coalesce(runs, worst), F.lit(2.0))
                     + F.pow(F.coalesce(serial, worst), F.lit(2.0)))
    s = F.least(F.col("s"), F.lit(1000.0))
    p_random = 2 * _normal_tail(F.sqrt(s)) + F.sqrt(2 * s / math.pi) * F.exp(-s / 2)
    # Text: pairs of equal characters, the share of odd characters, letters in a-f only.
    pairs = n * (n - 1) / 2
    var = pairs * COINCIDENCE * (1 - COINCIDENCE) + n * (n - 1) * (n - 2) * TRIPLE_EXCESS
    few = (pairs * COINCIDENCE - (F.col("squares") - n) / 2) / F.sqrt(var)
    odd = (F.size(F.regexp_extract_all("bare", F.lit("[^A-Za-z]"), F.lit(0)))
           + F.size(F.regexp_extract_all("bare", F.lit("(?<=[a-z])[A-Z]"), F.lit(0)))) / n
    kl = F.when(odd > ODD_SHARE, odd * F.log(odd / ODD_SHARE) + F.when(
        odd < 1, (1 - odd) * F.log((1 - odd) / (1 - ODD_SHARE))).otherwise(0.0)).otherwise(0.0)
    letters = F.when(F.col("encoding") == "hex",
                     F.size(F.regexp_extract_all("bare", F.lit("[A-Fa-f]"), F.lit(0)))).otherwise(0)
    log_p = (_normal_log10_tail(few) - n * kl / math.log(10)
             + letters * math.log10(HEX_LETTERS))
    return t.select("token", "encoding", n.cast("bigint").alias("n"), p_random.alias("p_random"),
                    F.when(F.col("encoding") == "decimal", 0.0)
                    .otherwise(F.least(log_p, F.lit(0.0))).alias("log_p_text"))


def discovery_limit(judged: DataFrame) -> float | None:
    """The largest log10 p that Benjamini-Hochberg at ``FDR`` accepts, else None.

    The p-values are rounded up to a grid of at most ``GRID_END + 1`` values, so
    the step-up runs over that many counts whatever the number of tokens.
    """
    step = F.least(F.floor(-F.col("log_p_text") / GRID), F.lit(GRID_END))
    count = judged.groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("c"))
    down = Window.orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding,
                                                 Window.unboundedFollowing)
    step_up = count.select("b", F.sum("c").over(down).alias("rank"), F.sum("c").over(every).alias("m"))
    least = (step_up.filter(-F.col("b") * GRID <= F.log10(FDR * F.col("rank") / F.col("m")))
             .agg(F.min("b").alias("b")).first()["b"])
    return None if least is None else -least * GRID


def secret_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, th, kind, start, end``: base spans and the random tokens that
    no base span of the same document covers.  ``th`` is xxhash64 of the text."""
    found = cut(matches(docs))
    base = found.filter("kind <> 'random'").drop("token")
    judged = cut(battery(found.filter("kind = 'random'")))
    limit = discovery_limit(judged)
    if limit is None:
        return base
    good = judged.filter((F.col("p_random") >= ALPHA)
                         & (F.col("log_p_text") <= limit + GRID / 2)
                         & (F.col("encoding") != "decimal")).select("token")
    more = found.join(good, "token", "left_semi")
    # Ranges of the base spans of a document up to a start tell whether one covers it.
    order = (Window.partitionBy("doc_id", "th").orderBy("start", F.col("kind") == "random")
             .rowsBetween(Window.unboundedPreceding, 0))
    both = base.unionByName(more.select(*base.columns))
    reach = F.max(F.when(F.col("kind") != "random", F.col("end"))).over(order)
    return (both.withColumn("reach", reach)
            .filter("kind <> 'random' or reach is null or reach < end").drop("reach"))


def _span_list(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_assign, n_access, n_hex,
    base_sha256, spans, n_random``.

    ``docs`` has ``doc_id`` and ``text``; further columns are ignored.  Spans
    are ``kind:start:end`` by start, then kind in the order of ``KINDS``.  A
    null or empty text has none; repeated rows are each returned; an empty
    table gives an empty result.
    """
    rank = F.lit(0)
    for i, kind in enumerate(KINDS):
        rank = F.when(F.col("kind") == kind, F.lit(i)).otherwise(rank)
    per_doc = (secret_spans(docs).groupBy(F.col("doc_id").alias("d"), F.col("th").alias("t"))
               .agg(F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind")))
                    .alias("list"),
                    *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS]))
    own = docs.select("doc_id", F.xxhash64("text").alias("th"))
    out = own.join(per_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left")
    spans = F.coalesce("list", F.array().cast(
        "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"))
    basic = F.filter(spans, lambda s: s["kind"] != "random")
    return out.select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("bigint")).alias(f"n_{k}") for k in KINDS],
        F.sha2(_span_list(basic).cast("binary"), 256).alias("base_sha256"),
        _span_list(spans).alias("spans"))


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of :func:`secret_spans` replaced by ``mark``.

    All rows and columns stay; ``n_chars``, if there is one, follows the text.
    Spans that overlap or touch are replaced once.
    """
    order = Window.partitionBy("doc_id", "th").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    merged = (secret_spans(docs)
              .withColumn("new", F.when(before >= F.col("start"), 0).otherwise(1))
              .withColumn("isle", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("doc_id", "th", "isle")
              .agg(F.min("start").alias("start"), F.max("end").alias("end")))
    d, t, cuts, h = (fresh(docs, x) for x in ("d", "t", "cuts", "h"))
    per_doc = (merged.groupBy(F.col("doc_id").alias(d), F.col("th").alias(t))
               .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cuts)))
    rows = docs.withColumn(h, F.xxhash64("text"))
    both = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(h) == F.col(t)), "left")
    kept = F.zip_with(
        F.concat(F.array(F.lit(0).cast("bigint")), F.col(cuts)["end"]),
        F.concat(F.col(cuts)["start"], F.array(F.length("text").cast("bigint"))),
        lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int")))
    text = F.when(F.col(cuts).isNull(), F.col("text")).otherwise(F.array_join(kept, mark))
    new = fresh(docs, "new")
    both = both.withColumn(new, text)       # a column of its own: later ones read it
    out = {"text": F.col(new)}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col(cuts).isNull(), F.col("n_chars")).otherwise(
            F.length(new).cast(docs.schema["n_chars"].dataType))
    return both.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])
