"""Scores that keep coming; the five programs' parsers."""

import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from framelake.operators import growing, quality
from framelake.plans import commands, programs

SCHEMA = "g string, score double"


def test_fence_of_increments_is_that_of_their_union(spark, tmp_path):
    r = random.Random(1)
    some = lambda: r.choice([r.gauss(100, 30), r.gauss(-3, 5), float(r.randint(-2, 2)), 1e-300 * r.random(), -1e300, 0.0, -0.0, None])
    days = [[(r.choice(["a", "b", None]), some()) for _ in range(n)] for n in (150, 0, 81)] + [[("few", 1.0), ("few", 2.0), ("one", None)]]
    kept, rows = growing.Scores(spark, str(tmp_path / "s"), ["g"]), []
    with pytest.raises(ValueError):
        kept.fence()
    for day in days:
        kept.add(spark.createDataFrame(day, SCHEMA).withColumn("n", F.lit(1)))
        rows += day
        want = {x["g"]: x for x in quality.fence(spark.createDataFrame(rows, SCHEMA), ["g"]).collect()}
        got = {x["g"]: x for x in kept.fence().collect()}
        assert got.keys() == want.keys()
        for g, x in got.items():
            own = [s for h, s in rows if h == g and s is not None]
            assert x["frames_scored"] == len(own) and x["median"] == want[g]["median"] == (statistics.median(own) if len(own) >= 3 else None)
            assert (x["mad"], x["threshold"]) == (want[g]["mad"], want[g]["threshold"])


def test_slots_are_pruned_and_unmarked_increments_left_out(spark, tmp_path):
    kept = growing.Scores(spark, str(tmp_path / "s"), ["g"])
    kept.add(spark.range(2000).select(F.lit("a").alias("g"), (F.exp(F.col("id") / 100) + 1).alias("score")))
    fence = kept.fence()
    plan = fence._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan or "dynamicPruning" in plan or "DynamicPruning" in plan
    # an increment without its mark is not counted
    n = fence.first()["frames_scored"]
    at = kept.increments()[0]
    kept.add(spark.createDataFrame([("a", 5.0)], SCHEMA))
    os.remove(next(f"{kept.folder}/marks/{p}" for p in kept.increments() if p != at))
    assert kept.fence().first()["frames_scored"] == n == 2000


def test_buckets_never_fall(spark):
    r = random.Random(2)
    v = sorted({r.choice([-1, 1]) * 10.0 ** r.uniform(-320, 308) for _ in range(500)} | {0.0, 5e-324, -5e-324, 1.0, float("inf"), float("-inf")})
    got = [x["b"] for x in spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, v double").select("i", growing.bucket_of(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got) and len(set(got)) > 400


# --- commands ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("argv", "program", "args"), [
    (["extract", "--input", "v.avi", "--stride", "3"], "extract", ("v.avi", "data/frames", 3)),
    (["detect", "--metadata", "out/walk/metadata.json", "--dictionary", "DICT_5X5_50"], "detect", ("out", "DICT_5X5_50", None)),
    (["choose", "--detections", "out/", "--min-markers", "2", "--valid-ids", "3", "7", "--rejected", "bad"], "choose", ("out", 2, [3, 7], "bad")),
    (["mask", "--manifest", "s3://b/out/walk/manifest.json", "--device", "cpu"], "mask", ("s3://b/out",)),
    (["sheet", "--num-markers", "8", "--page-format", "A3", "--output-dir", "m"], "sheet", ("m", 8, "A3")),
])
def test_arguments_reach_the_programs(monkeypatch, argv, program, args):
    seen = {}
    for name in commands.ARGUMENTS:
        monkeypatch.setattr(programs, name, lambda *a, name=name, **k: seen.update({name: [*a, *k.values()]}))
    commands.main(argv, spark="session")
    assert list(seen) == [program]
    plain = [x for x in seen[program] if isinstance(x, (str, int, list, type(None)))]
    assert all(x in plain for x in args)


@pytest.mark.parametrize("argv", [[], ["fly"], ["extract"], ["detect", "--metadata", "m", "--dictionary", "DICT_9"], ["mask", "--manifest", "m", "--device", "tpu"], ["sheet", "--page-format", "A9"], ["choose", "--detections", "d", "--valid-ids"], ["extract", "--input", "v", "--stride", "x"]])
def test_wrong_arguments_end_before_a_session_is_made(argv, capsys):
    with pytest.raises(SystemExit) as e:
        commands.main(argv)
    assert e.value.code == 2 and "usage" in capsys.readouterr().err


def test_a_command_from_end_to_end(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("markers:\n  num_markers: 4\n  side_pixels: 60\n")
    commands.main(["sheet", "--config", str(tmp_path / "c.yaml"), "--output-dir", str(tmp_path / "m"), "--dpi", "100"], spark)
    assert len([f for f in os.listdir(tmp_path / "m") if f.endswith(".png")]) == 4 and os.path.exists(tmp_path / "m" / "sheet.pdf")
