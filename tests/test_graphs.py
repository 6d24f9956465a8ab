from __future__ import annotations

import random

from corpusweave.operators import graphs

TRIPLE = "graph string, s string, p string, o string, o_kind string, o_lang string, o_dtype string"


def reached_by_hand(edges):
    nodes, out = {n for e in edges for n in e if n is not None}, {}
    up = {n: {b for a, b in edges if a == n and b is not None} for n in nodes}
    for n in nodes:
        front, depth = up[n], 1
        while front:
            new = {m for m in front if (n, m) not in out}
            out |= {(n, m): depth for m in new}
            front, depth = {x for m in new for x in up[m]}, depth + 1
    return out


def test_closure_and_cycles(spark):
    for seed, n, m in ((1, 30, 28), (2, 12, 30), (3, 60, 59)):
        rng = random.Random(seed)
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(1, None), (None, 2)]
        if seed == 3:
            edges = [(k, k - 1) for k in range(1, n)]  # a chain
        want = reached_by_hand(edges)
        got = graphs.closure(spark.createDataFrame([*edges, edges[0]], "child int, parent int"))
        assert {(r.node, r.ancestor): r.depth for r in got.collect()} == want
        cycle = {a: min(b for x, b in want if x == a and (b, a) in want) for a, b in want if a == b}
        assert {r.node: (r.cycle, r.length) for r in graphs.cycles(got).collect()} == {a: (c, want[a, a]) for a, c in cycle.items()}
    assert graphs.closure(spark.createDataFrame([], "child int, parent int")).count() == 0


def test_closure_settles_each_pair_of_a_tree_once(spark, monkeypatch):
    from corpusweave.plans import registry

    rows, settle = [], registry.settled
    monkeypatch.setattr(registry, "settled", lambda df: (rows.append((d := settle(df)).count()), d)[1])
    edges = [(k, k // 2) for k in range(2, 200)] + [(1000 + k, 999 + k) for k in range(1, 40)]
    want = reached_by_hand(edges)
    got = graphs.closure(spark.createDataFrame(edges, "child int, parent int"))
    assert {(r.node, r.ancestor): r.depth for r in got.collect()} == want and sum(rows) == len(want)
    rng = random.Random(9)
    edges = [(100 * g + rng.randrange(n), 100 * g + rng.randrange(n)) for g in range(40) for n in [rng.randrange(1, 25)] for _ in range(rng.randrange(2 * n))]
    got = graphs.closure(spark.createDataFrame(edges, "child int, parent int")).collect()
    assert {(r.node, r.ancestor): r.depth for r in got} == reached_by_hand(edges) and len(got) == len(reached_by_hand(edges))


def a_graph(rng, name, n=14, extra=0):
    """Triples with blank nodes that chains, trees and equal values link; the names of the blank nodes are by chance."""
    ids = rng.sample(range(1000), n)
    local = random.Random(n)
    rows = [(name, f"_:{ids[k]}", "p", f"_:{ids[local.randrange(k)]}", "bnode", None, None) for k in range(1, n)]
    rows += [(name, f"_:{ids[k]}", "v", str(local.randrange(3)), "literal", local.choice([None, "sk"]), None) for k in range(n) if local.random() < 0.5]
    rows += [(name, "http://e/s", "q", f"_:{ids[n // 2]}", "bnode", None, None), (name, "http://e/s", "q", f"_:{ids[n // 2]}", "iri", None, None)]
    rows += [(name, f"_:{ids[extra]}", "v", "more", "literal", None, None)] if extra else []
    rng.shuffle(rows)
    return rows


def test_graphs_are_compared_by_what_they_say(spark):
    rng = random.Random(4)
    iri = lambda name: [(name, "http://e/s", "q", "http://e/o", "iri", None, None)]
    text = lambda name: [(name, "http://e/s", "q", "http://e/o", "literal", None, None)]
    twins = lambda name, k: [(name, f"_:{k + i}", "v", "1", "literal", None, None) for i in range(3)]
    made = {"a": a_graph(rng, "a"), "b": a_graph(rng, "b"), "c": a_graph(rng, "c", extra=3), "d": a_graph(rng, "d", extra=5), "e": a_graph(rng, "e", 15), "i": iri("i"), "j": iri("j"), "t": text("t"), "u": twins("u", 1), "w": twins("w", 9)}
    rows = [r for x in made.values() for r in x if r[4] != "iri" or r[3].startswith("http")]
    got = {r.graph: (r.triples, r.h0, r.h1) for r in graphs.graph_hashes(spark.createDataFrame([*rows, rows[0]], TRIPLE).repartition(3)).collect()}
    same = lambda x, y: got[x] == got[y]
    assert same("a", "b") and same("i", "j") and same("u", "w")
    assert not any(same(x, y) for x, y in (("a", "c"), ("c", "d"), ("a", "e"), ("i", "t"), ("a", "i")))
    alike = {r.graph: r.alike for r in graphs.graph_hashes(spark.createDataFrame(rows, TRIPLE)).collect()}
    assert alike["u"] == 3 and alike["i"] == 0


def test_no_table_of_nodes_is_broadcast(spark, monkeypatch, tmp_path):
    from corpusweave.plans import registry

    plans, settle = [], registry.settled
    plan = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(registry, "settled", lambda df: (plan(df), settle(df))[1])
    spark.createDataFrame(a_graph(random.Random(5), "a"), TRIPLE).write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(2, 1), (3, 2)], "child int, parent int").write.parquet(str(tmp_path / "e"))
    plan(graphs.graph_hashes(spark.read.parquet(str(tmp_path / "t"))))
    graphs.closure(spark.read.parquet(str(tmp_path / "e")))
    assert sum("SortMergeJoin" in p for p in plans) > 2 and not any("Broadcast" in p for p in plans)
