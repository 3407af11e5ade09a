"""Exact and near duplicates against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from areaprice.llm import components, exact_dedup, simhash


def norm(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(docs, rows, keep):
    groups = {}
    for row in rows:
        groups.setdefault(norm(row[1]), []).append(row[0])
    expected = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(known)
        sha = hashlib.sha256(text.encode()).hexdigest()
        expected += Counter((i, sha, best, len(ids), i == best and at == ids.index(best)) for at, i in enumerate(ids))
    found = exact_dedup.exact_groups(docs, keep).collect()
    assert len(found) == len(rows) and Counter(tuple(row) for row in found) == expected


def test_exact_groups_of_odd_ids(spark):
    made = [("null", "T"), (None, "t"), (None, "t"), ("null", "t"), (None, "u"), (None, "u"), ("", "v"), (None, "V")]
    docs = spark.createDataFrame([(i, text, n) for n, (i, text) in enumerate(made)], "doc_id string, text string, n int")
    found = exact_dedup.exact_groups(docs)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found.collect()) == Counter(
        [("null", "null", 4, True), ("null", "null", 4, False), (None, "null", 4, False), (None, "null", 4, False)]
        + [(None, None, 2, True), (None, None, 2, False), ("", "", 2, True), (None, "", 2, False)]
    )
    kept = exact_dedup.drop_exact(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text.lower()) for r in kept) == [(False, "", "v"), (False, "null", "t"), (True, None, "u")]


def test_collisions_are_told_apart(docs, rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_hash128", lambda text: F.substring(F.md5(text.cast("binary")), 1, 1))
    groups = Counter(norm(row[1]) for row in rows)
    found = exact_dedup.exact_groups(docs).collect()
    assert Counter((row.text_sha256, row.group_size) for row in found if row.kept) == Counter(
        (hashlib.sha256(text.encode()).hexdigest(), n) for text, n in groups.items()
    )


def test_drop_exact_keeps_one_whole_row_of_each_text(docs, rows):
    found = exact_dedup.drop_exact(docs)
    assert found.columns == docs.columns
    kept = found.collect()
    assert sorted(norm(row.text) for row in kept) == sorted({norm(row[1]) for row in rows})
    assert all(tuple(row) in {tuple(r) for r in rows} for row in kept)


def test_nothing(nothing):
    assert exact_dedup.exact_groups(nothing).count() == 0 and exact_dedup.drop_exact(nothing).count() == 0
    assert simhash.near_components(nothing).count() == 0 and simhash.drop_near(nothing).count() == 0


def slow_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def classes(prints, max_bits=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_and_components(docs, rows):
    prints = [slow_fingerprint(row[1]) for row in rows]
    assert [simhash.fingerprint(row[1]) for row in rows] == prints
    found = classes(prints)
    least = {}
    for root, row in zip(found, rows, strict=True):
        if row[0] is not None:
            least[root] = min(row[0], least.get(root, row[0]))
    expected = Counter((row[0], f"{p:016x}", least[root]) for row, p, root in zip(rows, prints, found, strict=True))
    result = simhash.near_components(docs).collect()
    assert Counter((r.row.doc_id, f"{r.fingerprint % 2**64:016x}", r.component_id) for r in result) == expected
    kept = simhash.drop_near(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())


def random_prints(rng, n):
    """Random fingerprints, and chains and clouds of close ones."""
    prints = [rng.getrandbits(64) for _ in range(n)] + [0, 2**64 - 1]
    for _ in range(3 * n):
        near = rng.choice(prints)
        for _ in range(rng.choice([1, 2, 4, 5, 6])):
            near ^= 1 << rng.randrange(64)
        prints.append(near)
    return sorted(set(prints))


@pytest.mark.parametrize("block_rows, max_bits", [(20_000, 4), (2, 4), (2, 3), (20_000, 2)])
def test_links_connect_exactly_the_close(spark, block_rows, max_bits):
    prints = random_prints(random.Random(max_bits), 40)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    distinct = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    found, dense = simhash.links(distinct, max_bits, block_rows=block_rows)
    assert dense.isEmpty() is (block_rows > 2)
    if block_rows == 2:
        found = found.unionByName(simhash._neighbour_links(dense, max_bits))
    pairs = found.collect()
    assert all(((a % 2**64) ^ (b % 2**64)).bit_count() <= max_bits for a, b in pairs)
    roots = {row.node: row.root for row in components.components(found).collect()}
    expected = {}
    for p, root in zip(signed, classes(prints, max_bits), strict=True):
        expected.setdefault(root, []).append(p)
    for members in expected.values():
        assert {roots.get(p, p) for p in members} == {min(members)} if len(members) > 1 else members[0] not in roots


def test_spanning_links_of_a_dense_block_are_few():
    rng = np.random.default_rng(1)
    prints = np.unique(np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 50_000, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 50_000, dtype=np.uint64)))
    a, b = simhash.spanning_links(prints, 4)
    assert len(a) == len(b) == len(prints) - 1


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(7, 7), (300, 200), (None, 5)] * 2
    found = {row.node: row.root for row in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 120)}, 300: 200, 200: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
