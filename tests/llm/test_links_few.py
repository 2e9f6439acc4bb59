import itertools
import random

import numpy as np
import pytest

from riskspark.llm import links


def linked(spark, keys, sets):
    members = spark.createDataFrame([(k, n) for k, nodes in keys.items() for n in nodes], "key long, node long")
    # spread, as novel elements are told apart by the upper half of their bits
    data = {n: np.unique(np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n, s in sets.items()}
    table = spark.createDataFrame([(n, bytearray(d.tobytes()), len(d)) for n, d in data.items()], "node long, data binary, size long")
    labels, _ = links.link(members, table, lambda data: np.frombuffer(data, np.uint64), 80)  # tasks do not have this module
    return {r.node: r.root for r in labels.collect()}


def brute(keys, sets):
    root = {n: n for n in sets}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for nodes in keys.values():
        for a, b in itertools.combinations(nodes, 2):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {n: find(n) for n in sets if find(n) != n}


def test_pairs_of_a_key_of_few_need_no_novel_elements(spark, monkeypatch):
    whole = set(range(100))
    near = whole - set(range(15)) | set(range(200, 215))
    sets = {1: whole, 2: near, 3: near - {99} | {300}}
    asked, novel = [], links.novel_elements
    monkeypatch.setattr(links, "novel_elements", lambda s, homes, e: asked.append(homes.count()) or novel(s, homes, e))
    assert linked(spark, {7: [1, 2, 3]}, sets) == {3: 2}
    assert asked == [0]


@pytest.mark.parametrize("few", [0, links.FEW if hasattr(links, "FEW") else 8])
def test_keys_of_few_and_of_many_lose_no_link(spark, monkeypatch, few):
    monkeypatch.setattr(links, "FEW", few, raising=False)
    rng = random.Random(11)
    keys, sets = {}, {}
    for group, size in enumerate((3, 4, 8, 9, 30, 40)):
        start = 10_000 * group
        middle = set(range(start, start + 60))
        # sets drift off the middle in small clusters that share what the middle lacks
        for cluster in range(size // 2 + 1):
            new = set(range(start + 100 + 20 * cluster, start + 108 + 20 * cluster))
            gone = set(rng.sample(sorted(middle), 8))
            for k in range(2):
                n = start + 2 * cluster + k + 1
                sets[n] = (middle - gone - set(rng.sample(sorted(middle), rng.randint(0, 3)))) | set(rng.sample(sorted(new), rng.randint(5, 8)))
        nodes = [n for n in sets if start < n <= start + 200]
        keys[2 * group] = nodes
        keys[2 * group + 1] = rng.sample(nodes, max(2, len(nodes) // 3))
    assert linked(spark, keys, sets) == brute(keys, sets)
