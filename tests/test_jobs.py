"""The command-line workflow end to end: generate files, match, verify, write."""

import pytest

import bruteforce as bf
from duetto import jobs
from duetto.names import DOCTOR, DOCTOR_RANK, HOSPITAL, HOSPITAL_RANK
from duetto.session import scratch_path
from duetto.sources.text import read_market_text


def test_generate_then_match_every_algorithm(spark):
    base = scratch_path(spark, "jobs")
    files = jobs.generate(spark, base, n_doctors=60, n_hospitals=9, choices=4, seed=3)
    edges, _ = read_market_text(spark, files["doctor_file"], files["hospital_file"])
    rows = [tuple(r) for r in edges.select(DOCTOR, HOSPITAL, DOCTOR_RANK, HOSPITAL_RANK).collect()]
    for algorithm in ("hospital", "doctor", "doctor-plain"):
        out = f"{base}/match-{algorithm}"
        rep = jobs.match(spark, files["doctor_file"], files["hospital_file"], algorithm,
                         quota=3, out=out)
        assert rep["converged"] and rep["blocking_pairs"] == 0 and rep["consistent"]
        assert rep["one_sided_pairs"] == 0
        lines = [r["value"].split() for r in spark.read.text(out).collect()]
        assert len(lines) == 60                                  # one line per doctor
        got = {int(d): int(h) for d, h in lines if int(h) >= 0}
        want = (bf.hospital_proposing if algorithm == "hospital" else bf.doctor_proposing)(rows, 3)
        assert got == want
    rep = jobs.match(spark, files["doctor_file"], files["hospital_file"], "contracts", max_iter=3)
    assert rep["rounds"] <= 3 and "blocking_pairs" not in rep


def test_main_exit_code(spark):
    base = scratch_path(spark, "jobs-main")
    assert jobs.main(["generate", base, "--doctors", "20", "--hospitals", "4", "--choices", "3"]) == 0
    assert jobs.main(["match", f"{base}/doctors", f"{base}/hospitals", "--quota", "2"]) == 0


def _scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [value")


def test_a_read_market_is_parsed_once(spark, tmp_path):
    from duetto.session import cut_lineage
    from duetto.sources.text import read_market_text, read_preferences_text
    jobs.generate(spark, str(tmp_path / "m"), 40, 6, 4)
    one = read_preferences_text(spark, str(tmp_path / "m" / "doctors"), "doctor_id")
    assert _scans(one) == 1             # numbering the lines reads no second time
    edges, _ = read_market_text(spark, str(tmp_path / "m" / "doctors"), str(tmp_path / "m" / "hospitals"))
    assert _scans(edges) == 2 and _scans(cut_lineage(edges)) == 0


def test_what_fails_its_check_is_not_written(spark, tmp_path):
    import os
    jobs.generate(spark, str(tmp_path / "m"), 60, 6, 4)
    out = tmp_path / "out"
    rep = jobs.match(spark, str(tmp_path / "m" / "doctors"), str(tmp_path / "m" / "hospitals"),
                algorithm="contracts", max_iter=1, out=str(out))
    assert not rep["converged"] and "out" not in rep and not os.path.exists(out)


def test_bad_lines_are_set_aside_and_runs_are_added_to_a_table(spark, tmp_path):
    from duetto.plans.report import convergence_report, read_traces
    good = {"doctors": "1 0\n0 1\n1\n", "hospitals": "0 1 2\n1 0\n"}
    for name, text in good.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "doctors-bad").write_text("1 0\n0 1.5 one\n1\n\n")
    (tmp_path / "hospitals-bad").write_text("0 1 2\r\n-1 +1 0\n 99999999999999999999\n")
    bad = str(tmp_path / "bad")
    with pytest.raises(Exception):
        jobs.match(spark, str(tmp_path / "doctors-bad"), str(tmp_path / "hospitals"))
    got = jobs.match(spark, str(tmp_path / "doctors-bad"), str(tmp_path / "hospitals-bad"), quota=1, bad_lines=bad)
    assert got["bad_lines"] == 2 and got["matched"] == 1
    rows = sorted((r["side"], r["id"], r["line"], r["text"], r["reason"], r["file"].split("/")[-1])
                  for r in spark.read.parquet(bad).collect())
    assert rows == [("doctor_id", 1, 2, "0 1.5 one", "not an integer: 1.5", "doctors-bad"),
                    ("hospital_id", 2, 3, " 99999999999999999999", "beyond 64 bits: 99999999999999999999",
                     "hospitals-bad")]
    traces = str(tmp_path / "traces")
    for algorithm, run in (("hospital", "2024"), ("doctor-plain", "b/ c"), ("hospital", "2024")):
        jobs.match(spark, str(tmp_path / "doctors"), str(tmp_path / "hospitals"), algorithm, quota=1,
                   traces=traces, run=run)
    report = {r["run"]: r for r in convergence_report(read_traces(spark, traces)).collect()}
    assert set(report) == {"2024", "b/ c"}
    assert read_traces(spark, traces).where("run = '2024'").count() == report["2024"]["rounds"]
