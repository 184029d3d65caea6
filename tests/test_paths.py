import random
from collections import deque

import pytest

from lodestar.operators import paths


def brute(edges, source):
    """Distance and smallest shortest path from one node to all others."""
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    best, queue = {source: [source]}, deque([source])
    level = [source]
    while level:
        found = {}
        for node in level:
            for nxt in near.get(node, ()):
                if nxt not in best:
                    trail = best[node] + [nxt]
                    if nxt not in found or trail < found[nxt]:
                        found[nxt] = trail
        best.update(found)
        level = list(found)
    return best


@pytest.mark.parametrize("max_hops,min_hops", [(6, 0), (5, 2), (0, 0), (1, 1)])
def test_paths_equal_brute_force(spark, max_hops, min_hops):
    rng = random.Random(max_hops)
    edges = [(i, i + 1) for i in range(12)] + [(rng.randrange(14), rng.randrange(14)) for _ in range(5)]
    edges += [(20, 21), (3, 3)]
    sources, targets = [0, 4, 20], [0, 3, 7, 12, 21, 99]
    frame = spark.createDataFrame([(a, b, "L") for a, b in edges], "src long, dst long, type string")
    ids = [spark.createDataFrame([(x,) for x in part], "id long") for part in (sources, targets)]
    got = {(r["source"], r["target"]): (r["hops"], r["path"]) for r in paths.shortest_paths(
        frame, *ids, max_hops=max_hops, min_hops=min_hops, with_path=True).collect()}
    want = {}
    for s in sources:
        reached = brute([e for e in edges if e[0] != e[1]], s)
        for t in targets:
            if t in reached and min_hops <= len(reached[t]) - 1 <= max_hops:
                want[s, t] = (len(reached[t]) - 1, reached[t])
    assert got == want
    plain = {(r["source"], r["target"]): r["hops"] for r in paths.shortest_paths(
        frame, *ids, max_hops=max_hops, min_hops=min_hops).collect()}
    assert plain == {pair: hops for pair, (hops, _) in want.items()}
    first = [tuple(r) for r in paths.first_path(frame, *ids, max_hops, min_hops, group=1).collect()]
    assert first == [(*pair, *want[pair]) for pair in sorted(want)[:1]]


def test_round_plans_read_files(spark):
    """The result depends on written levels only, so no lineage builds up."""
    frame = spark.createDataFrame([(1, 2, "L"), (2, 3, "L")], "src long, dst long, type string")
    one = spark.createDataFrame([(1,)], "id long")
    plan = paths.reach(frame, one, one, 2, 2)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "Join" not in plan
