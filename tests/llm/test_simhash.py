import random
import re

import numpy as np
from scorebook.llm import components as stars
from scorebook.llm import simhash
from scorebook.llm.components import connected_components
from scorebook.llm.simhash import fingerprint, links, one_of_each_group, simhash_groups
from xxhash import xxh64_intdigest

from tests.llm.conftest import prose


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    if len(words) < size:
        shingles = [" ".join(words)]
    else:
        shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits):
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= bits
    label = np.arange(len(prints))
    while True:
        new = np.where(near, label[None, :], len(prints)).min(1)
        if (new == label).all():
            return label
        label = new


def test_fingerprints(odd_rows):
    for _, text, _, _ in odd_rows[:9]:
        assert fingerprint(text) == plain_fingerprint(text)
    assert fingerprint("one TWO") == plain_fingerprint("one two")


def test_trie_join_links_what_all_pairs_link(spark, monkeypatch):
    r = random.Random(3)
    prints = {r.getrandbits(64) for _ in range(200)}
    for p in list(prints)[:60]:
        for _ in range(8):
            prints.add(p ^ sum({1 << r.randint(0, 63) for _ in range(r.randint(1, 5))}))
    prints = np.array(sorted(prints), np.uint64)
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print long")
    for bits, most in ((3, 20_000), (3, 25), (1, 20_000)):
        monkeypatch.setattr(simhash, "GROUP_ROWS", most)
        found = connected_components(links(df, bits)).collect()
        root = {row["node"]: row["root"] for row in found}
        mine = [root.get(int(p), int(p)) for p in prints.view(np.int64)]
        expected = components(prints, bits)
        assert len(set(mine)) == len(set(expected.tolist()))
        assert len(set(zip(mine, expected.tolist(), strict=True))) == len(set(mine))


def test_long_chains_are_one_component(spark):
    chain = [(i, i + 1) for i in range(0, 200)] + [(1000, 1001), (5, 5)]
    found = connected_components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {(row["node"], row["root"]) for row in found} == {(i, 0) for i in range(1, 201)} | {(1001, 1000)}


def test_links_that_are_stars_take_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(stars, "stored", lambda df, label: written.append(label) or df.localCheckpoint())
    rows = [(1, 0), (2, 0), (0, 2), (8, 7), (9, 7), (4, 4)]
    found = connected_components(spark.createDataFrame(rows, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == [(1, 0), (2, 0), (8, 7), (9, 7)]
    assert written == ["links"]
    for rows in ([(2, 0), (2, 1)], [(2, 1), (1, 0)], [(5, -3), (9, 5), (9, 8)]):
        least = min(map(min, rows))
        found = connected_components(spark.createDataFrame(rows, "a long, b long")).collect()
        nodes = {n for row in rows for n in row} - {least}
        assert sorted(map(tuple, found)) == [(n, least) for n in sorted(nodes)]
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_odd_rows(odd, odd_rows, empty):
    found = simhash_groups(odd).collect()
    prints = np.array([plain_fingerprint(t) for _, t, _, _ in odd_rows], np.uint64)
    label = components(prints, 3)
    ids = [i for i, *_ in odd_rows]
    expected = []
    for i, p, k in zip(ids, prints, label, strict=True):
        own = [x for x, other in zip(ids, label, strict=True) if other == k and x is not None]
        expected.append((i, format(int(p), "016x"), min(own, default=None)))
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert simhash_groups(empty).collect() == []


def test_one_of_each_group_stays(odd, empty, odd_rows):
    kept = one_of_each_group(odd)
    assert kept.columns == odd.columns
    prints = np.array([plain_fingerprint(t) for _, t, _, _ in odd_rows], np.uint64)
    assert kept.count() == len(set(components(prints, 3).tolist()))
    assert [r["doc_id"] for r in kept.collect()].count(1) == 1
    assert one_of_each_group(empty).collect() == []


def test_small_edits_are_found(make):
    text = prose(5, 600)
    rows = [(1, text, "en", "a"), (2, text + " end", "en", "a"), (3, prose(6, 600), "en", "a")]
    group = {r["doc_id"]: r["component_id"] for r in simhash_groups(make(rows)).collect()}
    near = np.bitwise_count(np.uint64(fingerprint(text) ^ fingerprint(text + " end"))) <= 3
    assert (group[2] == 1) == near and group[3] == 3
