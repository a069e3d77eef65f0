import corpus_pipeline as P
from pubspark.llm import personal_data, quality_rules
from pubspark.llm.common import materialize
from tests.llm.edge import SF, documents, edge_docs
from tests.llm.test_chosen_paths import brute
from tests.llm.test_sequence_packing import check


def test_each_stage_against_its_input(spark):
    docs = documents(spark)
    columns = docs.columns
    seen = {}
    for name, stage in P.STAGES[:-1]:
        seen[name] = docs
        docs = materialize(stage(spark, docs, SF), "test")
        assert docs.columns == columns
        seen[name + "+"] = docs
    rows = {k: {r.doc_id: r for r in v.collect()} for k, v in seen.items()}
    assert set(rows["quality_rules+"]) == {i for i, r in rows["quality_rules"].items() if quality_rules.judge(r.text).kept}
    assert set(rows["toxicity+"]) <= set(rows["toxicity"])
    before = rows["near_copies"]
    assert set(rows["near_copies+"]) == {i for i, _, _, kept in brute([(i, r.text) for i, r in before.items()]) if kept}
    after = rows["personal_data+"]
    assert {i: r.text for i, r in after.items()} == {i: personal_data.mask(r.text) for i, r in rows["personal_data"].items()}
    assert all(r.n_chars == len(r.text) for r in after.values())
    check(docs)


def test_run_gives_the_last_stages_rows(spark):
    out = P.run(spark, SF)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0 and [n for n, _ in P.STAGES][-1] == "packing"


def test_edge_documents_pass_all_stages(spark):
    good = "\n".join(" ".join(f"Word{chr(97 + i)}{chr(97 + j)}" for j in range(10)) + "." for i in range(9))
    for rows in ([], [(1, None), (2, ""), (3, good), (3, good), (4, good + " More."), (None, good)]):
        docs = edge_docs(spark, rows)
        for _, stage in P.STAGES[:-1]:
            docs = materialize(stage(spark, docs, SF), "test")
        assert sorted((r.doc_id for r in docs.collect()), key=repr) == ([3, None] if rows else [])
        assert P.STAGES[-1][1](spark, docs, SF).count() == docs.count()
