"""bench.py runs end to end (on the smallest data set) and times every step."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402


def test_bench_runs_every_step(spark, small_dir):
    timings = {}
    bench.run(spark, small_dir, timings)
    assert set(timings) == {"build_silver_gold", *bench.REPORTS, *bench.LANDING}
    assert all(t >= 0 for t in timings.values())
