"""The event-log stage summary tool on a small synthetic log (plain and zstd)."""

import json
import os

import zstandard

from tools.stage_times import stages, task_times


def _events():
    return [
        {"Event": "SparkListenerStageCompleted",
         "Stage Info": {"Stage ID": 3, "Stage Name": "bronze", "Number of Tasks": 2,
                        "Submission Time": 1000, "Completion Time": 4500}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 3,
         "Task Info": {"Launch Time": 1000, "Finish Time": 4000}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 3,
         "Task Info": {"Launch Time": 1000, "Finish Time": 2000}},
    ]


def test_plain_and_zstd_logs(scratch_dir):
    text = "\n".join(json.dumps(e) for e in _events()) + "\n"
    plain = os.path.join(scratch_dir, "plain", "events_1_app")
    os.makedirs(os.path.dirname(plain))
    with open(plain, "w") as f:
        f.write(text)
    packed = os.path.join(scratch_dir, "zstd", "eventlog_v2_app", "events_1_app.zstd")
    os.makedirs(os.path.dirname(packed))
    with open(packed, "wb") as f:
        f.write(zstandard.ZstdCompressor().compress(text.encode()))
    for folder in ("plain", "zstd"):
        root = os.path.join(scratch_dir, folder)
        assert list(stages(root)) == [(3.5, 3, 2, "bronze")]
        assert task_times(root, 3) == [3.0, 1.0]
