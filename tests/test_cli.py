"""Command-line runner end to end (in-process, sharing the test session)."""

import json

from pubspark.__main__ import main
from tests.test_pipeline import ITEMS_1, write_envelope


def test_cli_run_and_reports(spark, scratch_dir, capsys):
    write_envelope(f"{scratch_dir}/in", "20260101T000000", ITEMS_1)
    assert main(["run", f"{scratch_dir}/in", f"{scratch_dir}/out", "--as-of", "2025-01-01"]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (res["run_count"], res["kept_back_count"], res["failed_count"]) == (1, 0, 0)
    assert main(["reports", f"{scratch_dir}/out"]) == 0
    out = capsys.readouterr().out
    assert "== author_publication_stats" in out and "Ana Li" in out
