import random

import numpy as np
import pytest

from riskspark.llm import links


def linked(spark, keys, sets):
    members = spark.createDataFrame([(k, n) for k, nodes in keys.items() for n in nodes], "key long, node long")
    data = {n: np.unique(np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n, s in sets.items()}
    table = spark.createDataFrame([(n, bytearray(d.tobytes()), len(d)) for n, d in data.items()], "node long, data binary, size long")
    labels, _ = links.link(members, table, lambda data: np.frombuffer(data, np.uint64), 80)  # tasks do not have this module
    return {r.node: r.root for r in labels.collect()}


def components(keys, sets):
    root = {n: n for n in sets}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for nodes in keys.values():
        for i, a in enumerate(nodes):
            for b in nodes[i + 1 :]:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {n: find(n) for n in sets if find(n) != n}


def drifted(groups, members, seed):
    """Sets off a few middles that overlap, half of a set in pairs that are linked, of 50 to 120 elements."""
    rng = random.Random(seed)
    sets = {}
    for group in range(groups):
        middle = list(range(20 * group, 20 * group + 100))
        for _ in range(members):
            gone = set(rng.sample(middle, rng.randint(0, 35)))
            one = set(middle) - gone | set(rng.sample(range(1000, 1400), rng.randint(0, 20)))
            sets[len(sets) + 1] = one
            if rng.random() < 0.5:
                sets[len(sets) + 1] = one - set(rng.sample(sorted(one), 4)) | {2000 + len(sets)}
    return sets


@pytest.mark.parametrize("block", [4096, 7])
def test_one_key_of_several_middles_loses_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(links, "BLOCK", block, raising=False)
    sets = drifted(4, 20, 5)
    assert linked(spark, {1: list(sets)}, sets) == components({1: list(sets)}, sets)


def test_nodes_of_two_middles_are_not_all_compared(spark, monkeypatch):
    """Two large components with similarities of about 0.7 across: nearly no pair of them needs its full sets."""
    rng = random.Random(3)
    sets = {}
    for start in (0, 90):
        middle = set(range(start, start + 500))
        for _ in range(40):
            sets[len(sets) + 1] = middle - set(rng.sample(sorted(middle), 15)) | set(rng.sample(range(5000, 6000), 15))
    asked, compared = [], links.compared
    monkeypatch.setattr(links, "compared", lambda pairs, s, e: asked.append(pairs.count()) or compared(pairs, s, e))
    keys = {1: list(sets)}
    assert linked(spark, keys, sets) == components(keys, sets)
    assert sum(asked) < 4 * len(sets), asked


def test_bits_differ_in_at_most_the_elements_that_differ(spark):
    sets = drifted(3, 15, 8)
    data = {n: np.unique(np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n, s in sets.items()}
    table = spark.createDataFrame([(n, bytearray(d.tobytes()), len(d)) for n, d in data.items()], "node long, data binary, size long")
    rows = links.novel_elements(table, table.select("node"), lambda data: np.frombuffer(data, np.uint64)).collect()
    bits = {r.node: np.frombuffer(r.bits, np.uint64).reshape(1, -1) for r in rows}
    assert len(bits) == len(rows) == len(sets)
    for a in sets:
        for b in sets:
            width = min(bits[a].shape[1], bits[b].shape[1])
            ones = int(np.bitwise_count(links._folded(bits[a], width) ^ links._folded(bits[b], width)).sum())
            assert 0.7 * len(sets[a] ^ sets[b]) - 6 <= ones <= len(sets[a] ^ sets[b])
