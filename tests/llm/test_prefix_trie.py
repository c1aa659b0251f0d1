"""The prefix trie against plain dictionaries of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowcubes.llm import prefix_trie as P
from flowcubes.llm import radix
from flowcubes.llm.common import prepare

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def identity(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, identity(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[:d - 1]].add(seq[:d])
    out = []
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1].encode()) if node else 0
    for node, m in members.items():
        ids = ",".join(map(str, sorted(c for c in m if made[c] == node)))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node], hashlib.sha256(ids.encode()).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=lambda r: r[:2])


@pytest.fixture(scope="module")
def trie(spark):
    prepare(spark)

    def run(rows, extra=(), **how):
        df = spark.createDataFrame(rows, SCHEMA)
        for name in extra:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return order([tuple(r[c] for c in COLUMNS) for r in P.trie(df, **how).collect()])

    return run


def talk(rng, convs, longest, kinds, copies=0.3):
    rows, known = [], []
    for c in rng.sample(range(convs * 2), convs):
        if known and rng.random() < copies:
            turns = list(rng.choice(known))[:rng.randint(1, longest)]
        else:
            turns = [(rng.choice(["user", "system", None]), rng.choice(kinds)) for _ in range(rng.randint(1, longest))]
        known.append(turns)
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("how", [{}, {"per_task": 40}, {"per_task": 7}, {"segment": 3}, {"segment": 2, "per_task": 25}, {"segment": 1, "per_task": 11}, {"segment": 4, "per_task": 9}])
@pytest.mark.parametrize("kinds", [["a", "é", "", None, "hello"], [f"text {i}" for i in range(300)]])
def test_trie_equals_brute_force(trie, how, kinds):
    rows = talk(random.Random(f"{how}{kinds[0]}"), 60, 14, kinds)
    assert trie(rows, **how) == order(brute(rows))


@pytest.mark.parametrize("how", [{}, {"per_task": 20}, {"segment": 2, "per_task": 20}])
def test_a_hot_conversation_over_many_tasks(trie, how):
    same = [(c, i, "user", t) for c in range(0, 400, 5) for i, t in enumerate(["hi", "there", "you", "too"])]
    more = [(c, 4, "user", "on") for c in range(300, 400, 5)] + [(1000, i, "user", str(i)) for i in range(120)] + [(1001, i, "user", str(i)) for i in range(121)]
    assert trie(same + more, **how) == order(brute(same + more))


def test_nulls_ties_and_extra_columns(trie):
    rows = [(None, 0, "user", "lost"), (10, None, "user", "first"), (10, 0, None, None), (10, 0, "", ""), (10, 0, "a", "b"), (10, 0, "ab", ""), (11, 5, "x", "y"), (11, 5, "x", "y"), (12, None, None, None)]
    assert trie(rows, extra=("depth", "key", "part", "id", "a b.c")) == order(brute(rows))


def test_empty_table_and_turnless_conversations(trie):
    assert trie([]) == []
    alone = [(c, 0, "user", "x") for c in (1, 2, 3, 4, 6, 7, 8, 9)]
    assert trie(alone) == order(brute(alone))
    assert any(zlib.crc32(str(c).encode()) % 9 for c in (1, 2, 3, 4))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=5) | st.binary(min_size=2, max_size=2), max_size=400))
def test_radix_tree_holds_every_key_in_order(keys):
    tree = radix.Tree()
    for i, k in enumerate(keys):
        tree.insert(k, (k, i))
    found, stack = [], [(tree.root, b"")]
    while stack:
        node, above = stack.pop()
        key = above + node.path
        assert all(k == key for k, _ in node.values)
        assert node is tree.root or node.values or sum(1 for _ in node.children()) > 1
        found += [(key, i) for _, i in node.values]
        stack += [(c, key) for c in list(node.children())[::-1]]
    assert found == sorted(((k, i) for i, k in enumerate(keys)), key=lambda x: x[0])


def test_layouts_grow_with_their_children():
    tree = radix.Tree()
    seen = []
    for b in range(256):
        tree.insert(bytes([255 - b, 1]), b)
        kind = tree.root.layout
        seen.append((type(kind).__name__, getattr(kind, "most", 0)))
    assert [seen[i] for i in (0, 3, 4, 15, 16, 47, 48, 255)] == [("Sorted", 4), ("Sorted", 4), ("Sorted", 16), ("Sorted", 16), ("Slotted", 0), ("Slotted", 0), ("Full", 0), ("Full", 0)]
    assert [n.path[0] for n in tree.root.children()] == list(range(256))
