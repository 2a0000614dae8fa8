import json
import statistics

import pytest

from tideline.operators import runs
from tideline.sources import readers

WALL = {"B0": [39.0, 40.0, 39.5], "X5": [58.0, 58.5], "A1": [69.0], "ZZ": [20.0, 21.0]}


def records(walls=WALL, step=lambda exp, wall, s: wall / s if s < 7 else None):
    for e, (exp, times) in enumerate(walls.items()):
        for i, wall in enumerate(times):
            yield {
                "exp_id": exp, "desc": f"{exp} run", "run_idx": i + 1, "wall_seconds": wall,
                "start_utc": f"2025-01-0{e + 1}T0{i}", "max_rss_bytes": 1048576.0 * (i + 1),
                "mean_cpu_percent": 5.0 + i, "spark_conf": {"a": "b"},
                **{f"step{s}_s": step(exp, wall, s) for s in range(1, 8)},
            }


def frame(spark, **kw):
    lines = [(json.dumps(r),) for r in records(**kw)]
    text = spark.createDataFrame(lines, "value string")
    from pyspark.sql import functions as F

    return text.select(F.from_json("value", readers.RUN_SCHEMA).alias("r")).select("r.*")


def test_summary(spark):
    got = {r["exp_id"]: r for r in runs.benchmark_summary(frame(spark)).collect()}
    assert list(got) == sorted(WALL)
    base = statistics.mean(WALL["B0"])
    for exp, times in WALL.items():
        assert got[exp]["n_runs"] == len(times) and got[exp]["baseline"] == "B0"
        assert got[exp]["std_wall_s"] == pytest.approx(statistics.pstdev(times))
        assert got[exp]["speedup"] == pytest.approx(base / statistics.mean(times))
        assert got[exp]["step2_speedup"] == pytest.approx(base / statistics.mean(times))
        assert got[exp]["step7_mean_s"] is None and got[exp]["step7_speedup"] is None
    assert got["B0"]["mean_max_rss_mb"] == 2.0 and got["B0"]["mean_cpu_percent"] == 6.0


def test_first_started_is_the_baseline_without_b0(spark):
    walls = {k: v for k, v in WALL.items() if k != "B0"}
    assert runs.benchmark_summary(frame(spark, walls=walls)).first()["baseline"] == "X5"


def test_wall_times_and_speedups(spark):
    times = runs.wall_times(frame(spark)).collect()
    assert [r["exp_id"] for r in times] == ["ZZ", "B0", "X5", "A1"]
    assert times[1]["std"] == pytest.approx(statistics.stdev(WALL["B0"])) and times[3]["std"] is None
    speed = {r["exp_id"]: r["speedup"] for r in runs.wall_speedups(frame(spark)).collect()}
    assert speed["B0"] == 1.0 and speed["A1"] == pytest.approx(39.5 / 69)
    walls = {k: v for k, v in WALL.items() if k != "B0"}
    speed = {r["exp_id"]: r["speedup"] for r in runs.wall_speedups(frame(spark, walls=walls)).collect()}
    assert speed["ZZ"] == 1.0


def test_step_speedups(spark):
    got = runs.step_speedups(frame(spark, step=lambda e, w, s: 0.0 if (e, s) == ("A1", 3) else w * s)).collect()
    assert [r["exp_id"] for r in got] == ["B0", "A1", "X5", "ZZ"]
    assert got[0]["step1_s"] == 1.0 and got[1]["step3_s"] is None
    walls = {k: v for k, v in WALL.items() if k != "B0"}
    got = runs.step_speedups(frame(spark, walls=walls)).collect()
    assert {r["exp_id"]: r["step1_s"] for r in got}["ZZ"] == 1.0


LINES = [
    '{"run_id": "r1", "step": 2, "wall_s": 1.5, "elapsed_s": 9}',
    '  {"run_id": "r1", "step": 2, "elapsed_s": 2}  ',
    '{"run_id": "r1", "step": "2", "wall_s": 100}',
    '{"run_id": "r1", "name": "no", "title": "the step 3", "wall_s": "8", "duration_ms": 500}',
    '{"run_id": "r1", "step": 2.5, "wall_s": 100}',
    '{"run_id": "r1", "msg": "STEP7 done", "seconds": 4}',
    '{"run_id": "r2", "step": 2, "wall_s": 50}',
    '{"run_id": "r1", "step": 4}',
    "not json",
    "",
    '{"run_id": "r1", "step": 1, "wall_s": ',
]


def test_step_seconds(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    assert [tuple(r) for r in runs.step_seconds(lines, "r1").collect()] == [(2, 3.5), (3, 0.5), (7, 4.0)]
    mixed = {r["step"]: r["seconds"] for r in runs.step_seconds(lines).collect()}
    assert mixed[2] == 53.5


def test_run_scan_prefers_json_lines_then_csv(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_runs(spark, str(tmp_path))
    (tmp_path / "summary_agg.csv").write_text("exp_id,mean_wall_s\nB0,1.5\n")
    assert readers.read_runs(spark, str(tmp_path)).first()["mean_wall_s"] == 1.5
    (tmp_path / "summary.csv").write_text("exp_id,wall_seconds\nB0,2.5\nA1,3.5\n")
    assert runs.wall_times(readers.read_runs(spark, str(tmp_path))).count() == 2
    (tmp_path / "summary.jsonl").write_text("broken\n")
    assert readers.read_runs(spark, str(tmp_path)).count() == 2
    lines = [json.dumps(r) for r in records()]
    (tmp_path / "summary.jsonl").write_text("\n".join(["{bad", *lines, ""]))
    got = readers.read_runs(spark, str(tmp_path))
    assert got.count() == len(lines) and got.first()["spark_conf"] == {"a": "b"}
