"""Command-line jobs: the reference's workflow as Spark jobs.

    spark-submit duetto/jobs.py generate OUT_DIR --doctors N --hospitals H --choices K
    spark-submit duetto/jobs.py match DOCTOR_FILE HOSPITAL_FILE --algorithm hospital \
        [--quota 6] [--max-iter R] [--out PATH] [--format text|parquet]

(or ``python -m duetto.jobs ...`` with the package on the path).

``generate`` writes a random market as the two preference files (padded
doctor lines, ragged hospital lines with blanks).  ``match`` reads the two
files, reports pairs listed by one side only, runs the chosen algorithm
(``hospital``: hospital-optimal fast loop, ``doctor``: doctor-optimal,
``doctor-plain``: one choice per round, ``contracts``: budgeted), checks the
result (no blocking pair and consistent counts for the stable algorithms) and
writes the matching.  Nothing is collected to the driver except counters.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):       # run as a script (spark-submit duetto/jobs.py)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F

from duetto.names import DOCTOR, HOSPITAL
from duetto.operators import verify as vf
from duetto.plans.contracts import match_contracts
from duetto.plans.doctor_optimal import match_doctor_optimal
from duetto.plans.hospital_optimal import match_hospital_optimal
from duetto.plans.report import append_trace
from duetto.session import cut_lineage, ensure_checkpoint_dir
from duetto.sources.sinks import write_matching
from duetto.sources.synth import generate_preferences
from duetto.sources.text import (numbered_lines, read_market_text, rescue_market_text,
                                 write_market_text)


def generate(spark: SparkSession, out_dir: str, n_doctors: int, n_hospitals: int,
             choices: int, seed: int = 42) -> dict:
    """Write ``doctors`` and ``hospitals`` preference files under ``out_dir``."""
    doctors = spark.range(n_doctors).select(F.col("id").alias(DOCTOR))
    hospitals = spark.range(n_hospitals).select(F.col("id").alias(HOSPITAL))
    edges = generate_preferences(doctors, n_hospitals, choices, seed)
    write_market_text(edges, doctors, hospitals, f"{out_dir}/doctors", f"{out_dir}/hospitals")
    return {"doctor_file": f"{out_dir}/doctors", "hospital_file": f"{out_dir}/hospitals"}


def match(spark: SparkSession, doctor_file: str, hospital_file: str,
          algorithm: str = "hospital", quota: int = 6, max_iter: int | None = None,
          out: str | None = None, fmt: str = "text", bad_lines: str | None = None,
          journal: str | None = None, traces: str | None = None, run: str | None = None) -> dict:
    """Read a market from its two files, match it, verify, write the result.

    Without ``max_iter`` the loops run to their end.  A stable algorithm that the
    limit ends earlier raises; contracts report whether they converged.  A
    matching that fails its check, or contracts that did not converge, are
    reported and not written.

    With ``bad_lines`` lines that can't be parsed are written there as Parquet and
    list nobody; without, they are an error.  ``journal`` names the journal from which
    ``doctor-plain`` is resumed.  With ``traces`` the changes of each round are added
    to that table under the name ``run``.
    """
    if bad_lines:
        edges, one_sided, bad = rescue_market_text(spark, doctor_file, hospital_file)
        bad.write.mode("overwrite").parquet(bad_lines)
    else:
        edges, one_sided = read_market_text(spark, doctor_file, hospital_file)
    edges = cut_lineage(edges)      # the files are parsed once
    report = {"algorithm": algorithm, "one_sided_pairs": one_sided.count()}
    if bad_lines:
        report["bad_lines"] = spark.read.parquet(bad_lines).count()
    trace = bool(traces)
    if algorithm == "hospital":
        res = match_hospital_optimal(edges, quota, max_iter=max_iter, trace=trace)
    elif algorithm == "doctor":
        res = match_doctor_optimal(edges, quota, max_iter=max_iter, trace=trace)
    elif algorithm == "doctor-plain":
        res = match_doctor_optimal(edges, quota, max_iter=max_iter, accelerate=False, trace=trace,
                                   journal=journal)
    elif algorithm == "contracts":
        res = match_contracts(edges, max_iter=max_iter)
    else:
        raise ValueError(f"unknown algorithm {algorithm!r}")
    report.update(rounds=res.rounds, converged=res.converged,
                  matched=res.matching.count())
    if traces:
        append_trace(res.trace(spark), run or algorithm, traces)
    if algorithm == "contracts":
        report["cycle"] = res.cycle
    else:
        # The stable algorithms are checked like the reference checked them.
        report["blocking_pairs"] = vf.blocking_pairs(edges, res.matching, quota).count()
        report["consistent"] = bool(vf.matching_consistency(edges, res.matching, quota)
                                    .first()["consistent"])
    if out and succeeded(report):
        doctors = read_doctor_ids(spark, doctor_file)
        write_matching(res.matching.select(DOCTOR, HOSPITAL), out, doctors=doctors, fmt=fmt)
        report["out"] = out
    return report


def succeeded(report: dict) -> bool:
    """Whether the loop ended by itself and the matching passed its check."""
    return (report.get("converged", True) and report.get("blocking_pairs", 0) == 0
            and report.get("consistent", True))


def read_doctor_ids(spark: SparkSession, doctor_file: str) -> DataFrame:
    """Every doctor id of a doctor file (one per line, blank lines included)."""
    return numbered_lines(spark, doctor_file).select(F.col("number").alias(DOCTOR))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="duetto.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)
    g = sub.add_parser("generate")
    g.add_argument("out_dir")
    g.add_argument("--doctors", type=int, required=True)
    g.add_argument("--hospitals", type=int, required=True)
    g.add_argument("--choices", type=int, required=True)
    g.add_argument("--seed", type=int, default=42)
    m = sub.add_parser("match")
    m.add_argument("doctor_file")
    m.add_argument("hospital_file")
    m.add_argument("--algorithm", default="hospital",
                   choices=["hospital", "doctor", "doctor-plain", "contracts"])
    m.add_argument("--quota", type=int, default=6)
    m.add_argument("--max-iter", type=int, default=None)
    m.add_argument("--out")
    m.add_argument("--format", default="text", choices=["text", "parquet"])
    m.add_argument("--bad-lines", help="folder for lines that can't be parsed; without it they are an error")
    m.add_argument("--journal", help="name of the journal from which doctor-plain is resumed")
    m.add_argument("--traces", help="table to which the changes of each round are added")
    m.add_argument("--run", help="name of the run in that table")
    a = p.parse_args(argv)
    # Checkpoints of past rounds go when nothing refers to them any more.
    spark = (SparkSession.builder.appName("duetto")
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate())
    ensure_checkpoint_dir(spark)
    if a.cmd == "generate":
        rep = generate(spark, a.out_dir, a.doctors, a.hospitals, a.choices, a.seed)
    else:
        rep = match(spark, a.doctor_file, a.hospital_file, a.algorithm, a.quota,
                    a.max_iter, a.out, a.format, a.bad_lines, a.journal, a.traces, a.run)
    print(json.dumps(rep))
    return 0 if succeeded(rep) else 1


if __name__ == "__main__":
    sys.exit(main())
