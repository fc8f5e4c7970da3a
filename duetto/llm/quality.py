"""Quality rules by document and by host.

Every document is measured on its whole text.  Rule failures are added up by
host, failure rates are shrunk towards the corpus by an empirical beta prior
(its two parameters fitted to the hosts' rates by their moments), and the hosts'
verdicts are joined back to their documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.llm.common import cut

MIN_WORDS = 50              # base rule: fewer words fail
MAX_REPEAT_PERCENT = 50     # base rule: a larger share of repeated words fails
#: Rules of the method on a document, besides the base: share of symbols to words,
#: share of repeated lines, and mean word length.
MAX_SYMBOLS_PER_WORD = 0.4
MAX_DUP_LINE_SHARE = 0.5
MEAN_WORD_CHARS = (2.0, 12.0)
#: A host whose shrunk failure rate is above this loses all of its documents.
MAX_HOST_RATE = 0.8

STATS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def text_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The figures named in ``STATS``.

    Words are runs of anything but space and the characters 9 to 13, which is
    where ``bytes.split`` splits.  Repeated words stand in a window of three
    words that the text has twice or more.
    """
    if not text:
        return 0, 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    blanks = len(raw) - len(raw.translate(None, b" \t\n\x0b\x0c\r"))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < n - 2:
            seen: set = set()
            twice = {w for w in windows if w in seen or seen.add(w)}
            upto = 0            # words before it are counted
            for i, w in enumerate(windows):
                if w in twice:
                    repeated += i + 3 - max(i, upto)
                    upto = i + 3
    return n, len(text) - blanks, symbols, len(lines), len(lines) - len(set(lines)), repeated


def document_stats(docs: DataFrame, host: str = "source") -> DataFrame:
    """The figures of :func:`text_stats` for every row, with its host."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [text_stats(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("host"),
                 *(pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(STATS)))],
                names=["doc_id", "host", *STATS])

    own = docs.select("doc_id", "text", F.col(host).cast("string").alias("host"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, host string, "
                          + ", ".join(f"{c} bigint" for c in STATS))


def with_rules(stats: DataFrame) -> DataFrame:
    """``stats`` with ``base_failed`` and ``failed`` (a base or document rule)."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / words
    base = ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return (stats.withColumn("base_failed", base)
            .withColumn("failed", base
                        | (F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * words)
                        | (F.col("n_dup_lines") > MAX_DUP_LINE_SHARE * F.col("n_lines"))
                        | (mean < MEAN_WORD_CHARS[0]) | (mean > MEAN_WORD_CHARS[1])))


def host_rates(ruled: DataFrame) -> DataFrame:
    """``host, docs, failures, rate, host_kept``: one row per host, null included.

    The prior is a beta distribution with the mean and variance of the hosts'
    true rates: the variance of the observed ones less what binomial sampling
    explains.  Without spread beyond that, the prior is so strong that every
    host gets the common rate.  ``rate`` is the posterior mean.
    """
    hosts = ruled.groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.col("failed").cast("bigint")).alias("failures"))
    p = F.col("failures") / F.col("docs")
    seen = hosts.agg(
        F.sum("failures").alias("failures"), F.sum("docs").alias("docs"),
        F.var_samp(p).alias("var"), F.avg(1 / F.col("docs")).alias("inv")).first()
    if not seen["docs"]:
        return hosts.withColumns({"rate": F.lit(0.0), "host_kept": F.lit(True)})
    m = seen["failures"] / seen["docs"]
    true_var = (seen["var"] or 0.0) - m * (1 - m) * seen["inv"]
    strength = max(m * (1 - m) / true_var - 1, 1.0) if true_var > 1e-6 else 1e6
    rate = (F.col("failures") + strength * m) / (F.col("docs") + strength)
    return hosts.select("host", "docs", "failures", rate.alias("rate"),
                        (rate <= MAX_HOST_RATE).alias("host_kept"))


def judge_quality(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed, host_rate``.

    ``docs`` has ``doc_id``, ``text`` and the column ``host``; further columns
    are ignored.  A document stays if it fails no rule and its host's verdict is
    to keep.  A null or empty text has no words and fails; documents without
    host are judged together as one host; repeated rows are each judged and
    counted; an empty table gives an empty result.
    """
    ruled = with_rules(cut(document_stats(docs, host)))
    hosts = host_rates(ruled).select(F.col("host").alias("h"), "rate", "host_kept")
    both = ruled.join(hosts, F.col("host").eqNullSafe(F.col("h")), "left")
    return both.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("failed") & F.col("host_kept")).alias("kept"), "failed",
        F.col("rate").alias("host_rate"))
