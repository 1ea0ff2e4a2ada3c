"""A tracker's stage asks for resources of its own, on a cluster in a process of its own."""

import os
import subprocess
import sys

import numpy as np

from framelake import settings
from framelake.operators import tracking

SCRIPT = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.executor.memory", "700m").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
from framelake import settings
from framelake.operators import tracking
profile = settings.tracker_profile(spark, cpus=2)
rows = [(f"s{s}", i, f"{i}.jpg", 4, 4, bytes(range(48)), None) for s in range(3) for i in range(2)]
df = spark.createDataFrame(rows, "session_id string, frame_index int, filename string, height int, width int, data binary, corners array<array<array<double>>>")
assert len(tracking.masks(df, profile=profile).collect()) == 6
stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
print("profiles", sorted({stages.apply(i).resourceProfileId() for i in range(stages.size())}), profile.id, profile.taskResources["cpus"].amount)
spark.stop()
"""


def test_profile_is_that_of_the_stage():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, timeout=240, cwd=root, env=os.environ | {"PYTHONPATH": root})
    line = next((x for x in got.stdout.splitlines() if x.startswith("profiles")), got.stderr[-2000:])
    assert line == "profiles [0, 1] 1 2.0"


def test_local_mode_has_none(spark):
    assert settings.tracker_profile(spark, "cuda") is None


class Picky(tracking.BoxTracker):
    """A detector that is told by its own thresholds apart: the best box fails on its words, another on its score."""

    def detect(self, rgb):
        return np.array([[0, 0, 9, 9], [1, 1, 5, 5], [2, 2, 4, 4]], float), np.array([0.9, 0.4, 0.41]), np.array([0.3, 0.9, 0.31])


def test_thresholds_hold_where_boxes_come_in():
    boxes, scores = tracking.Session(Picky()).detected(np.zeros((10, 10, 3), np.uint8))
    assert boxes.tolist() == [[2, 2, 4, 4]] and scores.tolist() == [0.41]
    mask, source, _, _ = tracking.Session(Picky()).frame(np.zeros((10, 10, 3), np.uint8), [])
    assert source == "dino" and (mask > 0).sum() == 9
