import duckdb

from pubspark.llm import license_diagonals as L
from tests.llm.edge import DOCS, documents, edge_docs

COLUMNS = "doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score"


def by_sql(table):
    con = duckdb.connect()
    con.register("documents", table)
    return sorted(con.execute(f"SELECT {COLUMNS} FROM ({L.scan_sql()})").fetchall(), key=repr)


def check(df):
    got = sorted((tuple(r) for r in L.scan_licenses(df).select(*COLUMNS.split(", ")).collect()), key=repr)
    assert got == by_sql(df.select("doc_id", "text").toArrow())
    return got


MIT = L.TEMPLATES[0][1]
ROWS = [(1, "Released UNDER the MIT-license; under the mit license. CC BY-NC! cc by nc cc by nc"),
        (2, "Licensed under the Apache License, Version 2.0."), (3, MIT.replace("granted", "granted, yes,")),
        (4, " ".join(MIT.split()[:8])), (5, "GNU General Public License, version 3"), (5, "GNU General Public License, version 3"),
        (6, "gnu general public license version"), (7, "(cc) by é nc"), (8, "under the mit")]


def test_planted_texts_equal_the_sql(spark):
    got = {r[0]: r[1:] for r in check(edge_docs(spark, ROWS))}
    assert got[1][1:6] == (5, 1, 15, "cc-by-nc,mit", "cc-by-nc,mit") and got[1][6] == 1.0
    assert got[2][4] == "apache-2"
    assert got[3][4:6] == ("", "mit") and 0.6 <= got[3][6] < 1
    assert [got[k][5] for k in (4, 5, 6, 7, 8)] == ["", "gpl-3", "", "", ""]


def test_repeated_templates_keep_their_label(spark):
    rows = [(n, " ".join(["cc by sa"] * n)) for n in range(1, 9)] + [(20, " ".join([MIT] * 4)), (21, "cc by sa cc by " * 5 + "cc by")]
    got = {r[0]: r[1:] for r in check(edge_docs(spark, rows))}
    assert all(got[n][5:] == ("cc-by-sa", 1.0) for n in range(1, 9)) and got[20][5] == "mit" and "cc-by-sa" in got[21][5]


def test_documents_and_edges_equal_the_sql(spark):
    check(documents(spark))
    assert len(check(edge_docs(spark))) == len(DOCS)
    assert L.scan_licenses(edge_docs(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = L.scan_licenses(documents(spark))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct"))
