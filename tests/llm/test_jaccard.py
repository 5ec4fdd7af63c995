"""Classes against all pairs of a small table."""

import random

import pytest

from waybill.llm import graph, jaccard


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute_force(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in jaccard.similar_classes(df).collect()), key=repr)


def varied(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def near(seed):
    rng = random.Random(seed)
    rows, next_id = [], 100
    for _ in range(6):
        base = " ".join(f"v{rng.randrange(400)}" for _ in range(rng.choice([30, 60, 120])))
        for _ in range(rng.choice([2, 5, 25])):
            rows.append((next_id, varied(rng, base, rng.randrange(5))))
            next_id += 1
    boiler = " ".join(f"b{i}" for i in range(40))
    for i in range(25):  # texts that share most words and still differ
        rows.append((next_id + i, boiler + " " + " ".join(f"u{i}_{k}" for k in range(rng.choice([3, 6, 9, 40])))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, docs, seed):
    rows = near(seed)
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One TWO"), (6, "one two three"), (None, "one two"),
             (7, "É é x"), (8, "é é x"), (9, "a a a a a a a"), (10, "a a a a a")]
    rows += [(rows[0][0], "quite another text under the same id"), rows[1], rows[1]]
    assert got(docs(rows).repartition(3)) == brute_force(rows)


def test_a_chain_links_its_ends(spark, docs):
    words = [f"c{i}" for i in range(60)]
    rows = [(9 - i, " ".join(words[i:i + 50])) for i in range(10)]
    assert got(docs(rows)) == brute_force(rows)
    assert {r[2] for r in got(docs(rows))} == {0}


def test_one_of_each_class_stays(spark, docs):
    rows = near(3) + [(1, None), (2, ""), (2, ""), (None, "lonely words here"), (None, "lonely words here")]
    table = docs(rows, extra="component_id")
    kept = jaccard.one_of_each_class(table)
    assert kept.columns == table.columns
    left = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    classes = brute_force(rows)
    wanted = sorted({(i, c) for i, _, c in classes if i == c}, key=repr)
    assert sorted({(i, i) for i, _ in left}, key=repr) == wanted
    assert len(left) == len(wanted)


def test_empty_and_single(spark, docs):
    assert got(docs([(1, "a")]).limit(0)) == []
    assert got(docs([(3, "a b c d e f")])) == [(3, 2, 3)]
    assert jaccard.one_of_each_class(docs([(1, "a")]).limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 50), (50, 70), (7, 200)]
    labels = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert {labels[i] for i in [*range(21), 200]} == {0} and {labels[i] for i in (100, 50, 70)} == {50}
