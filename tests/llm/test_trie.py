"""Radix tree and conversation trie against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerwatch.llm import trie
from ledgerwatch.llm.art import Full, Indexed, Medium, RadixTree, Small
from ledgerwatch.llm.queries import rebuilt
from ledgerwatch.llm.trie import NOBODY, prefix_trie, turn_sequences

SCHEMA = "conv_id long, turn long, role string, text string, node string, key int, run long"


def test_tree_gives_every_key_in_order():
    rng = random.Random(3)
    keys = {bytes(rng.choice((0, 1, 7, 255)) for _ in range(rng.randrange(12))) for _ in range(500)} | {bytes([b]) for b in range(256)} | {b"x" * 5000, b"x" * 4000}
    keys = list(keys)
    tree = RadixTree()
    for n, key in enumerate(keys):
        tree.insert(key, n)
    assert [n for *_, n in tree.walk() if n >= 0] == sorted(range(len(keys)), key=keys.__getitem__)
    assert {last for *_, last, n in tree.walk() if n >= 0} == {len(k) for k in keys}


@pytest.mark.parametrize("children, layout", [(4, Small), (5, Medium), (16, Medium), (17, Indexed), (48, Indexed), (49, Full), (256, Full)])
def test_layout_grows_with_the_children(children, layout):
    tree = RadixTree()
    for b in range(children):
        tree.insert(bytes([b, 9, 9]), b)
    assert type(tree.root) is layout and len(list(tree.walk())) == children + 1  # paths are one node each


def brute(conversations):
    """Nodes of {conv_id: [(role, text), ...]} as sorted tuples."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = sum(saved[x] for x in children[node]) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    for node, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(conversations[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(cs), len(node), parent, len(cs), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(nodes):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in nodes.select(names).collect()), key=str)


def rows_of(conversations):
    return [(c, n, r, t, "x", 1, 2) for c, turns in conversations.items() for n, (r, t) in enumerate(turns)]


def branching(seed, n):
    """Conversations with shared beginnings, a third of them equal, some a beginning of others, one very long."""
    rng = random.Random(seed)
    some = {c: [(rng.choice("ua"), rng.choice(("hello", "ä", "", "no"))) for _ in range(rng.randrange(1, 6))] for c in range(0, 3 * n, 3)}
    some |= {c: [("u", "same"), ("a", "same again")] for c in range(1, 3 * n, 3)}
    long = [("u", f"t{i % 7}") for i in range(700)]
    return some | {3 * n + 2: long, 3 * n + 5: long[:500], 3 * n + 8: long[:500] + [("a", "other")], 3 * n + 11: long}


@pytest.mark.parametrize("run_bytes", [1, 3_000, 1 << 20])
def test_nodes_are_those_of_brute_force(spark, run_bytes):
    conversations = branching(run_bytes, 60)
    table = spark.createDataFrame(rows_of(conversations), SCHEMA)
    assert found(prefix_trie(turn_sequences(table), run_bytes)) == brute(conversations)


def test_many_equal_conversations_are_hashed_in_blocks(spark):
    ids = [7 * i for i in range(3000)]
    table = spark.createDataFrame(rows_of({c: [("u", "same")] for c in ids}), SCHEMA)
    top, node = sorted(found(prefix_trie(turn_sequences(table))), key=lambda r: r[1])
    assert top == (0, 0, None, 3000, 1, 1, 4 * 2999, NOBODY)
    assert node[-1] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(1, 2, "u", "b", "x", 1, 2), (1, None, None, None, "x", 1, 2), (1, 1, "u", "a", "x", 1, 2), (None, 1, "u", "lost", "x", 1, 2), (2, 0, "", "", "x", 1, 2), (2, 1, "u", "a", "x", 1, 2), (2, 1, "u", "a", "x", 1, 2)]
    expected = brute({1: [("", ""), ("u", "a"), ("u", "b")], 2: [("", ""), ("u", "a"), ("u", "a")]})
    assert found(prefix_trie(turn_sequences(spark.createDataFrame(rows, SCHEMA)))) == expected
    assert found(prefix_trie(turn_sequences(spark.createDataFrame([], SCHEMA)))) == []


def test_rebuilt_conversations(spark):
    rng = random.Random(1)
    original = {c: [(rng.choice("ua"), f"{c}-{i}" if i > 1 else "x") for i in range(rng.randrange(1, 12))] for c in rng.sample(range(-40, 200), 90)}
    expected = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (c - 5 * int(c / 5))
        expected[c] = original.get(first, [])[:h] + turns[h:]
    assert any(not t for t in expected.values())
    table = spark.createDataFrame(rows_of(original), SCHEMA)
    assert found(prefix_trie(rebuilt(turn_sequences(table)), 2_000)) == brute(expected)
    assert trie.WIDTH == 20
