"""End-to-end batch run over raw envelope files, layered writes, latest-run reads, streaming."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pubspark.analytics_entry import run_reports
from pubspark.plans.batch import quarantine, read_bronze, read_report, read_silver, run_bronze, run_pipeline
from pubspark.sources.lake import latest_run, live_runs
from pubspark.sources.raw import read_envelope_fields, read_raw_envelopes
from pubspark.streaming.landing import start_bronze_stream

ITEMS_1 = [
    {"DOI": "10.1/A", "title": ["Título"], "author": [{"given": "Ana", "family": "Li", "sequence": "first"}],
     "publisher": "P", "type": "journal-article", "is-referenced-by-count": 3,
     "indexed": {"date-parts": [[2024, 1, 1]], "date-time": "2024-01-01T00:00:00Z"}},
    {"DOI": "10.1/b", "title": ["x"], "author": [{"name": "Consortium"}]},
]
ITEMS_2 = [{"DOI": "10.1/c", "title": ["y"], "author": [{"given": "Ana", "family": "Li"}]}]


def write_envelope(folder, run, items):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"metadata_raw_{run}.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"status": "ok", "message": {"items": items}}, f, ensure_ascii=False, indent=2)
    return path


def runs_of(df):
    return sorted(r.run for r in df.collect())


def test_read_envelopes_keeps_item_text(spark, scratch_dir):
    write_envelope(f"{scratch_dir}/in", "20260101T000000", ITEMS_1)
    with open(f"{scratch_dir}/in/empty.json", "w") as f:
        json.dump({"status": "ok"}, f)
    raw = read_raw_envelopes(spark, f"{scratch_dir}/in")
    got = raw.collect()
    assert len(got) == 2
    assert {r.run for r in got} == {"20260101T000000"}
    assert "Título" in got[0].raw_item or "Título" in got[1].raw_item


def test_pipeline_runs_and_latest(spark, scratch_dir):
    inp, out = f"{scratch_dir}/in", f"{scratch_dir}/out"
    write_envelope(inp, "20260101T000000", ITEMS_1)
    write_envelope(inp, "20260102T000000", ITEMS_2)
    res = run_pipeline(spark, inp, out, as_of="2025-01-01")
    assert runs_of(res["runs"]) == ["20260101T000000", "20260102T000000"] == runs_of(res["all_runs"])
    assert runs_of(live_runs(spark, out, "silver/publications")) == runs_of(res["runs"])
    assert runs_of(latest_run(spark, out, "silver/publications")) == ["20260102T000000"]
    latest = read_silver(spark, out, "publications")
    assert [r.doi for r in latest.collect()] == ["10.1/c"]
    everything = read_silver(spark, out, "publications", None)
    assert everything.count() == 3
    rep = read_report(spark, out, "20260101T000000")
    assert rep.count() == 10 and rep.where(F.col("status") == "fail").count() == 0
    assert sorted((r.run, r.status) for r in read_envelope_fields(spark, out).collect()) == [
        ("20260101T000000", "ok"), ("20260102T000000", "ok")]
    # rerun is idempotent: the new build takes the place of the old one
    run_pipeline(spark, inp, out, as_of="2025-01-01")
    assert read_silver(spark, out, "publications", None).count() == 3
    reports = run_reports(spark, out, run="20260101T000000")
    assert [tuple(r) for r in reports["author_publication_stats"].collect()] == [("Ana Li", 1, 1)]


def test_streaming_landing(spark, scratch_dir):
    inp, out = f"{scratch_dir}/landing", f"{scratch_dir}/out"
    write_envelope(inp, "20260101T000000", ITEMS_1)
    q = start_bronze_stream(spark, inp, out, checkpoint_location=f"{scratch_dir}/stream-ckpt")
    q.awaitTermination(120)
    write_envelope(inp, "20260102T000000", ITEMS_2)
    q = start_bronze_stream(spark, inp, out, checkpoint_location=f"{scratch_dir}/stream-ckpt")
    q.awaitTermination(120)
    bronze = read_bronze(spark, out)
    assert sorted(r.doi for r in bronze.collect()) == ["10.1/a", "10.1/b", "10.1/c"]


def test_streaming_refreshes_silver(spark, scratch_dir):
    inp, out = f"{scratch_dir}/landing", f"{scratch_dir}/out"
    write_envelope(inp, "20260101T000000", ITEMS_1)
    write_envelope(inp, "20260102T000000", ITEMS_2)
    q = start_bronze_stream(spark, inp, out, checkpoint_location=f"{scratch_dir}/stream-ckpt",
                            refresh_silver=True, as_of="2025-01-01")
    q.awaitTermination(180)
    pubs = read_silver(spark, out, "publications", None)
    assert sorted((r.run, r.doi) for r in pubs.collect()) == [
        ("20260101T000000", "10.1/a"), ("20260101T000000", "10.1/b"), ("20260102T000000", "10.1/c")]
    assert read_report(spark, out).count() == 20


def test_read_envelopes_json_lines(spark, scratch_dir):
    folder = f"{scratch_dir}/lines"
    os.makedirs(folder)
    with open(f"{folder}/metadata_raw_20260105T000000.jsonl", "w", encoding="utf-8") as f:
        for items in (ITEMS_1, ITEMS_2):
            f.write(json.dumps({"message": {"items": items}}, ensure_ascii=False) + "\n")
    raw = read_raw_envelopes(spark, folder, multi_line=False)
    assert raw.count() == 3
    assert {r.run for r in raw.collect()} == {"20260105T000000"}


def test_rerun_replaces_runs_that_become_empty(spark, scratch_dir):
    inp, out = f"{scratch_dir}/in", f"{scratch_dir}/out"
    with_ids = [{"DOI": "10.1/z", "title": ["t"], "ISSN": ["1"], "issn-type": [{"value": "1", "type": "print"}]}]
    write_envelope(inp, "20260101T000000", with_ids)
    run_pipeline(spark, inp, out, as_of="2025-01-01")
    assert read_silver(spark, out, "identifiers", None).count() == 1
    # the same run re-landed without identifiers: its identifier rows must disappear
    write_envelope(inp, "20260101T000000", [{"DOI": "10.1/z", "title": ["t"]}])
    run_pipeline(spark, inp, out, as_of="2025-01-01")
    assert read_silver(spark, out, "identifiers", None).count() == 0
    assert read_silver(spark, out, "publications", None).count() == 1


def test_broken_envelope_is_quarantined_and_keeps_earlier_rows(spark, scratch_dir):
    inp, out = f"{scratch_dir}/in", f"{scratch_dir}/out"
    write_envelope(inp, "20260101T000000", ITEMS_1)
    write_envelope(inp, "20260102T000000", ITEMS_2)
    run_pipeline(spark, inp, out, as_of="2025-01-01")
    before = read_silver(spark, out, "publications", None).count()
    cut = [f for f in os.listdir(inp) if "20260101" in f][0]
    with open(f"{inp}/{cut}", encoding="utf-8") as f:
        text = f.read()
    with open(f"{inp}/{cut}", "w", encoding="utf-8") as f:
        f.write(text[:-15])
    res = run_pipeline(spark, inp, out, as_of="2025-01-01")
    assert (runs_of(res["runs"]), runs_of(res["kept_back"])) == (["20260102T000000"], ["20260101T000000"])
    assert (res["run_count"], res["kept_back_count"]) == (1, 1)
    assert read_silver(spark, out, "publications", None).count() == before
    assert [(r.run, r.kind) for r in quarantine(spark, out).collect()] == [("20260101T000000", "envelope")]
    with pytest.raises(ValueError):
        run_pipeline(spark, inp, out, as_of="2025-01-01", raise_on_broken=True)
    with open(f"{inp}/{cut}", "w", encoding="utf-8") as f:
        f.write(text)
    assert run_pipeline(spark, inp, out, as_of="2025-01-01")["kept_back_count"] == 0
    assert quarantine(spark, out).count() == 0


def test_broken_item_is_quarantined(spark, scratch_dir):
    inp, out = f"{scratch_dir}/in", f"{scratch_dir}/out"
    write_envelope(inp, "20260101T000000", [*ITEMS_1, "no object"])
    run_pipeline(spark, inp, out, as_of="2025-01-01")
    assert [(r.kind, r.content) for r in quarantine(spark, out).collect()] == [("item", "no object")]
    assert read_silver(spark, out, "publications", None).count() == 2


@pytest.mark.parametrize("name", ["run 1", "a%b", "x#y", "p+q"])
def test_file_names_with_special_characters(spark, scratch_dir, name):
    inp, out = f"{scratch_dir}/in", f"{scratch_dir}/out"
    write_envelope(inp, name, ITEMS_1)
    for _ in range(2):
        assert runs_of(run_pipeline(spark, inp, out, as_of="2025-01-01")["all_runs"]) == [name]
    assert read_silver(spark, out, "publications", name).count() == 2


def test_two_files_of_a_run_in_two_batches_equal_the_batch_run(spark, scratch_dir):
    inp, out, batch = (f"{scratch_dir}/{n}" for n in ("landing", "out", "batch"))
    for prefix, items in (("one_raw_", ITEMS_1), ("two_raw_", ITEMS_2)):
        os.makedirs(inp, exist_ok=True)
        with open(f"{inp}/{prefix}20260101T000000.json", "w", encoding="utf-8") as f:
            json.dump({"message": {"items": items}}, f)
    q = start_bronze_stream(spark, inp, out, checkpoint_location=f"{scratch_dir}/c", max_files_per_trigger=1)
    q.awaitTermination(180)
    run_pipeline(spark, inp, batch, as_of="2025-01-01")
    dois = sorted(r.doi for r in read_bronze(spark, out).collect())
    assert dois == sorted(r.doi for r in read_bronze(spark, batch).collect()) == ["10.1/a", "10.1/b", "10.1/c"]
    run_bronze(spark, out)
    assert sorted(r.doi for r in read_bronze(spark, out).collect()) == dois


def test_stream_keeps_a_broken_run_back_and_other_files_of_it(spark, scratch_dir):
    inp, out = f"{scratch_dir}/landing", f"{scratch_dir}/out"

    def bring(prefix, text):
        os.makedirs(inp, exist_ok=True)
        with open(f"{inp}/{prefix}_raw_20260101T000000.json", "w", encoding="utf-8") as f:
            f.write(text)
        q = start_bronze_stream(spark, inp, out, checkpoint_location=f"{scratch_dir}/c")
        q.awaitTermination(180)
        return sorted(r.doi for r in read_bronze(spark, out).collect())

    one, two = (json.dumps({"message": {"items": i}}) for i in (ITEMS_1, ITEMS_2))
    assert bring("one", one) == ["10.1/a", "10.1/b"]
    assert bring("two", two[:-9]) == ["10.1/a", "10.1/b"]  # broken: the run keeps what it had
    assert [r.kind for r in quarantine(spark, out).collect()] == ["envelope"]
    assert bring("three", two) == ["10.1/a", "10.1/b"]  # still held back by the second file


def test_streamed_files_are_added_to_their_runs(spark, scratch_dir, monkeypatch):
    from pubspark.plans import batch as B
    from pubspark.plans.current import merge_current, read_current

    inp, out = f"{scratch_dir}/landing", f"{scratch_dir}/out"
    again = []
    whole = B._with_other_files
    monkeypatch.setattr(B, "_with_other_files", lambda *a: again.append(a) or whole(*a))

    def bring(name, dois, run="20260101T000000"):
        os.makedirs(inp, exist_ok=True)
        with open(f"{inp}/{name}_raw_{run}.json", "w", encoding="utf-8") as f:
            json.dump({"message": {"items": [{"DOI": d, "title": [name]} for d in dois]}}, f)
        start_bronze_stream(spark, inp, out, checkpoint_location=f"{scratch_dir}/c").awaitTermination(180)

    def held(**kwargs):
        return sorted((r.doi, r.title) for r in read_bronze(spark, out, **kwargs).collect())

    bring("one", ["10.1/a", "10.1/b"])
    bring("other", ["10.1/z"], "20260102T000000")
    bring("two", ["10.1/c"])
    first = [("10.1/a", "one"), ("10.1/b", "one"), ("10.1/c", "two")]
    assert not again and held() == [*first, ("10.1/z", "other")]
    assert held(run="20260101T000000") == first and held(run="latest") == [("10.1/z", "other")]
    assert merge_current(spark, out, buckets=2) is not None and merge_current(spark, out, buckets=2) is None
    bring("three", ["10.1/a"])
    assert merge_current(spark, out, buckets=2) is not None and merge_current(spark, out, buckets=2) is None
    assert sorted(r.doi for r in read_current(spark, out).collect()) == ["10.1/a", "10.1/b", "10.1/c", "10.1/z"]
    assert not again
    # a file that was landed before replaces itself, and only itself
    with open(f"{inp}/two_raw_20260101T000000.json", "w", encoding="utf-8") as f:
        json.dump({"message": {"items": [{"DOI": "10.1/d", "title": ["new"]}]}}, f)
    start_bronze_stream(spark, inp, out, checkpoint_location=f"{scratch_dir}/c2").awaitTermination(180)
    assert len(again) == 1
    assert held() == [("10.1/a", "one"), ("10.1/a", "three"), ("10.1/b", "one"), ("10.1/d", "new"), ("10.1/z", "other")]
    run_bronze(spark, out)
    assert len(held()) == 5


def test_streamed_envelopes_without_a_run_are_left_out(spark, scratch_dir):
    from pubspark.plans.batch import process
    from pubspark.sources.raw import read_envelopes

    os.makedirs(f"{scratch_dir}/in", exist_ok=True)
    for name, items in (("a", ITEMS_1), ("b", ITEMS_2)):
        with open(f"{scratch_dir}/in/raw_{name}.json", "w", encoding="utf-8") as f:
            json.dump({"message": {"items": items}}, f)
    env = read_envelopes(spark, f"{scratch_dir}/in").selectExpr("* EXCEPT (run)", "IF(run = 'a', run, NULL) AS run")
    process(env, f"{scratch_dir}/out", keep_other_files=True, silver=False)
    assert {r.run for r in read_bronze(spark, f"{scratch_dir}/out").collect()} == {"a"}
