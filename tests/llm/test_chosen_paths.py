import inspect
import random
from collections import Counter, defaultdict
from math import comb

from pubspark.llm import chosen_paths as C
from tests.llm.edge import DOCS, documents, edge_docs


def brute(rows):
    """Set size and component of each row by comparing all texts that share a shingle."""
    sets, holders = [], defaultdict(list)
    for k, (i, t) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
        if i is not None:
            for g in sets[-1]:
                holders[g].append(k)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for k in range(len(rows)):
        shared = Counter(j for g in sets[k] for j in holders[g] if j < k) if rows[k][0] is not None else {}
        for j, n in shared.items():
            if 100 * n >= 85 * (len(sets[k]) + len(sets[j]) - n):
                up[find(k)] = find(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    parts = [None if i is None else low[find(k)] for k, (i, _) in enumerate(rows)]
    return sorted(((i, len(sets[k]), parts[k], i == parts[k]) for k, (i, _) in enumerate(rows)), key=repr)


def check(df, **settings):
    got = sorted((tuple(r) for r in C.near_duplicates(df, **settings).drop("own").collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_documents(spark):
    check(documents(spark))


def test_edges(spark):
    check(edge_docs(spark, DOCS + [(8, "a b"), (9, "A  B\t"), (10, "a b c")]))
    assert C.near_duplicates(edge_docs(spark, [])).count() == 0


def test_hot_group_is_branched_and_dealt(spark):
    r = random.Random(4)
    vocabulary = [f"w{k}" for k in range(3000)]
    base = [r.choice(vocabulary) for _ in range(150)]
    rows = []
    for i in range(300):
        w = base[:]
        for _ in range(r.choice([0, 1, 1, 2, 3, 9])):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(r.choice(vocabulary) for _ in range(60))) for i in range(50)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), node_size=16, depth=4)


def test_recall_bound():
    assert 1 - (1 - C.meeting_probability(0.85, 8)) ** 10 > 0.999


def test_keep_firsts(spark):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (1, "x y z"), (2, "X y z"), (None, "a b c d e f"), (4, None), (1, "q r s t u v")]
    got = C.keep_firsts(edge_docs(spark, rows))
    assert got.columns == edge_docs(spark, rows).columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(3, "a b c d e f"), (1, "x y z"), (None, "a b c d e f"), (4, None), (1, "q r s t u v")], key=repr)


def star(variants, changed, words=150):
    """A source and texts that each differ from it in ``changed`` places, the source's id last."""
    r = random.Random(7)
    base = [f"s{k}" for k in range(words)]
    rows = []
    for i in range(variants):
        w = base[:]
        for k in r.sample(range(1, words // 6), changed):
            w[6 * k] = f"v{i}x{k}"
        rows.append((i, " ".join(w)))
    return [*rows, (variants, " ".join(base))]


def test_star_whose_source_has_no_copies(spark):
    rows = star(3000, 2)  # 0.87 to the source, 0.8 or less to most others
    got = C.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.filter("component_id <> 0").count() == 0


def test_large_nodes_meet_in_full(spark):
    nodes = spark.createDataFrame([(1, i) for i in range(700)] + [(2, i) for i in range(300)], "node long, set_id long")
    classes = spark.range(700).selectExpr("id AS set_id", "IF(id < 400, 0, id) AS component")
    met = defaultdict(set)
    for r in C.deal_all(nodes, classes, 50).groupBy("leaf").agg({"set_id": "collect_list"}).collect():
        assert len(r[1]) < 200
        for i in r[1]:
            met[i].update(r[1])
    assert all(met[i] == set(range(700)) for i in range(400, 700)) and all(met[i] >= set(range(400, 700)) for i in range(400))


def test_groups_without_a_source_in_one_node(spark):
    # pairs of a large template: each pair's two texts are alike, all others below the threshold
    rows = []
    for i in range(50):
        w = [f"t{k}" for k in range(120)]
        for k in range(1, 6):
            w[20 * k] = f"p{i}x{k}"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:-2] + [f"e{i}"]))]
    check(spark.createDataFrame(rows, "doc_id long, text string"), node_size=16, depth=4)


def test_estimates_lose_few_pairs():
    slack = inspect.signature(C.near_duplicates).parameters["slack"].default

    def lost(n, share):
        return sum(comb(n, i) * 0.85 ** i * 0.15 ** (n - i) for i in range(n) if i / n < share)

    assert lost(C.COORDINATES // 2, 0.85 - 1.5 * slack) + lost(C.COORDINATES, 0.85 - slack) < 0.0001


def test_clashing_names_with_a_repeated_row(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, 5, "a", "b"), (1, text, 5, "a", "b"), (2, text, 6, "c", "d"), (3, "other words", 7, "e", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, copy_hash_id long, own_id string, copy_hash string")
    assert sorted(tuple(r) for r in C.keep_firsts(df).collect()) == [rows[0], rows[3]]


def test_roots_tell_classes_apart_that_share_16_bits(spark):
    r = random.Random(2)
    rows = [(i, i, bytes(2 * C.COORDINATES) + r.randbytes(2 * C.WIDE)) for i in range(200)]
    classes = spark.createDataFrame(rows, "set_id long, component long, sig binary")
    found, large = C.leaves(classes, range(4), 16, 4)
    assert found.count() < 20 and large is None  # few pairs share all 32


def test_nodes_of_nearly_one_component_branch_no_further(spark):
    rows = [(i, max(0, i - 295), bytes(2 * C.COORDINATES + 2 * C.WIDE)) for i in range(300)]  # all alike
    classes = spark.createDataFrame(rows, "set_id long, component long, sig binary")
    found, large = C.leaves(classes, range(1), 16, 6, joined=True)
    met = defaultdict(set)
    for row in found.groupBy("leaf").agg({"set_id": "collect_list"}).collect():
        for i in row[1]:
            met[i].update(row[1])
    assert large is None and all(met[i] == set(range(300)) for i in range(296, 300))
    assert found.count() < 2 * 2 * 300  # two children at most


def test_groups_of_texts_alike_are_not_branched_level_by_level(spark):
    # a large group below the threshold to one another: no component lets its nodes stop
    r = random.Random(3)
    base = r.randbytes(2 * C.COORDINATES + 2 * C.WIDE)
    rows = []
    for i in range(900):
        changed = bytearray(base)
        for k in r.sample(range(C.COORDINATES), C.COORDINATES // 4):
            changed[2 * k:2 * k + 2] = r.randbytes(2)
        rows.append((i, i, 150, bytes(changed)))
    settings = {k: v.default for k, v in inspect.signature(C.near_duplicates).parameters.items()}
    classes = spark.createDataFrame(rows, "set_id long, component long, n long, sig binary")
    found, large = C.leaves(classes, range(2, 4), settings["node_size"], settings["depth"])
    assert large is None and found.count() <= 2 * 2 * len(rows)
    met = found.groupBy("leaf").count().agg({"count": "max"}).first()[0]
    assert met > 300


def test_large_sets_do_not_meet_in_one_leaf(spark):
    rows = [(i, i, C.LEAF_SHINGLES // 64, i.to_bytes(2) * (C.COORDINATES + C.WIDE)) for i in range(100)]
    rows += [(100 + i, 100 + i, C.LEAF_SHINGLES // 64, bytes(2 * C.COORDINATES + 2 * C.WIDE)) for i in range(100)]
    classes = spark.createDataFrame(rows, "set_id long, component long, n long, sig binary")
    found, large = C.leaves(classes, range(1), 2048, 2)
    assert found.count() == 0 and large.select("set_id").distinct().count() == 101


def test_links_of_a_leaf_span_what_all_pairs_would(spark):
    r = random.Random(9)
    bases = [[f"{b}w{k}" for k in range(90)] for b in range(4)]
    texts = [""]
    for i in range(400):
        w = bases[i % 4][:r.choice((90, 84, 70))]
        for _ in range(r.choice((0, 1, 2, 3, 5))):
            w[r.randrange(len(w))] = f"v{r.randrange(40)}"
        texts.append(" ".join(w))
    sets = {i: C.shingle_set(t) for i, t in enumerate(texts) if t}
    links = C.spanning_links([{"set_id": i, "shingles": s.tobytes()} for i, s in sets.items()], 85)
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in links:
        both = len(set(sets[i].tolist()) & set(sets[j].tolist()))
        assert 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both) and find(i) != find(j)
        up[find(i)] = find(j)
    low = {}
    for i in sets:
        low[find(i)] = min(low.get(find(i), i), i)
    assert [low[find(i)] for i in sets] == [c for _, _, c, _ in sorted(brute([(i, texts[i]) for i in sets]))]
