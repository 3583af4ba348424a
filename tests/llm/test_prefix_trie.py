"""The prefix trie against brute force, on nulls, ties, repeats, missing and very long conversations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from spanloom.llm import prefix_trie

ROWS = "conv_id long, turn long, role string, text string, key string, depth int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 3) for r in rows], ROWS)


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(turns.get(c - c % 20 if c >= 0 else c - -(-c % 20), [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out, sums = [], {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves = sum(sums[q][0] for q in children[p]) if children[p] else 1
        sums[p] = leaves, (len(members[p]) - 1) * words + sum(sums[q][1] for q in children[p])
        sha = hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), *sums[p], sha))
    return sorted(out, key=str)


def got(spark, rows, **sizes):
    found = prefix_trie.conversation_trie(frame(spark, rows).repartition(3), **sizes)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def dialogue(rng, convs, longest, vocabulary):
    rows = []
    for c in convs:
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"][:1]), " ".join(rng.choice("abc") for _ in range(rng.randrange(vocabulary)))))
    return rows


def test_nodes_are_those_of_brute_force(spark):
    rng = random.Random(1)
    rows = dialogue(rng, range(300), 7, 2)
    rows += [(c, t, "user", "hot start") for c in range(400, 600) for t in range(rng.randrange(1, 4))]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("shard", [1, 3, 8192])
def test_shards_and_bands_change_nothing(spark, shard):
    rng = random.Random(shard)
    rows = dialogue(rng, range(30), 9, 2) + [(c, t, "user", "same all the way") for c in (40, 41, 45, 52, 53) for t in range(c - 33)]
    assert got(spark, rows, band=2, shard_rows=shard) == brute(rows)


def test_nulls_ties_repeats_and_missing_starts(spark):
    rows = [
        (None, 0, "user", "left out"),
        (0, None, None, None),
        (0, 1, "user", "b c"),
        (0, 1, "user", "a"),
        (0, 1, "user", "a"),
        (7, 2, "user", ""),
        (7, None, "user", "x \t y"),
        (25, 0, "user", "no start here"),
        (26, 0, "user", "no start here"),
        (45, 0, "a", "bc"),
        (46, 0, "ab", "c"),
        (-3, 0, "user", "negative"),
        *[(60 + k % 20, k // 20, "user", "shared") for k in range(100)],
    ]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    assert got(spark, [(21, 0, "user", "x")]) == brute([(21, 0, "user", "x")])


def test_a_very_long_conversation_and_a_very_long_text(spark):
    rows = [(5, t, "user", f"t{t}") for t in range(500)] + [(65, t, "user", f"t{t}") for t in range(450)] + [(65, 450, "user", "word " * 400_000), (66, 0, "user", "x")]
    assert got(spark, rows) == brute(rows)
