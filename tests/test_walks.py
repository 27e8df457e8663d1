"""Walks along links against a plain search, cycles included."""

import random

from tarnbeck.operators.walks import walk


def test_walk(spark):
    r = random.Random(1)
    links = [(g, r.randrange(30), r.randrange(30)) for g in (1, 2) for _ in range(40)] + [(1, 5, None), (2, None, 3), (1, 7, 7)]
    links += [(3, i, i + 1) for i in range(20)]
    starts = [(1, 5), (1, 6), (2, 5), (3, 0), (4, 9), (1, 5)]
    found = walk(spark.createDataFrame(starts, "g long, root long"), spark.createDataFrame(links, "g long, src long, dst long"), ["g"])
    want = set()
    for g, root in set(starts):
        depth, newest = {root: 0}, [root]
        while newest:
            newest = [d for d in dict.fromkeys(d for n in newest for k, s, d in links if k == g and s == n) if d is not None and d not in depth]
            depth |= dict.fromkeys(newest, depth[max(depth, key=depth.get)] + 1)
        want |= {(g, root, n, k) for n, k in depth.items()}
    rows = [tuple(x) for x in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert walk(spark.createDataFrame([], "root long"), spark.createDataFrame([], "src long, dst long")).count() == 0
