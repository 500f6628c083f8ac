import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from outfall.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn, role or "", text or ""))
    for turns in convs.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).digest()))
    convs = {c: [t[1:] for t in turns] for c, turns in convs.items()}
    return {c: convs.get(c - c % 20, [])[: (h := zlib.crc32(str(c).encode()) % 4)] + turns[h:] for c, turns in convs.items()}


def brute(rows):
    members = defaultdict(list)
    full = rebuilt(rows)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        tokens = len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = sum(saved[x] for x in children[node]) + (len(members[node]) - 1) * tokens
    result = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(full[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        result.append((
            min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(result, key=repr)


def conversations(seed, n=200, longest=9, spread=1):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", None, "us"], ["a b", "a b c", "", None, "er x", "x " * 50, "ü v"]
    rows = []
    for c in rng.sample(range(n * 2), n):
        if c % 20 or rng.random() < 0.7:  # some have no first one to share with
            for turn in range(rng.choice([1, 2, 3, longest])):
                rows.append((c * spread, rng.choice([turn, turn, None, 7]), rng.choice(roles[:2] * 3 + roles), rng.choice(texts)))
    return rows


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, prefix_trie.prefix_trie(df, **options).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = conversations(seed) + [(None, 1, "user", "lost"), (3, 1, "user", "x"), (3, 1, "user", "x")]
    assert found(spark, rows) == brute(rows)


def test_small_shards_and_blocks_and_shuffled_joins(spark, monkeypatch):
    """Constants are set in the driver only, so the walk runs here and not in tasks."""
    rows = conversations(3, 60)
    shard = prefix_trie._Shard(0)
    full = rebuilt(rows)
    at = defaultdict(list)
    for c, turns in full.items():
        at[0].append((0, c, b"", 0))
        for pos, (role, text) in enumerate(turns, 1):
            at[pos].append((pos, c, f"{len(role)}:{role}{text}".encode(), len(text.split())))
    whole = list(prefix_trie._Shard(0).walk([r for k in sorted(at) for r in at[k]], None))
    parts = []
    for end in range(0, max(at) + 1):
        parts += shard.walk(at[end], end)
    parts += shard.walk([], None)
    assert sorted(whole, key=repr) == sorted(parts, key=repr)
    assert found(spark, rows, max_rows=0) == brute(rows)


def test_long_conversations_and_far_ids(spark):
    rows = [(c, t, "user", f"turn {min(t, c)}") for c in (0, 5, 7) for t in range(300)]
    rows += conversations(4, 30, spread=1_000_003)
    assert found(spark, rows) == brute(rows)


def test_chains_that_hang_from_chains(spark):
    """Each conversation leaves the one before it a turn later, so that sums go up many steps."""
    rows = [(100 - c, t, "u", f"{t} {'x' if t < c else c}") for c in range(40) for t in range(c + 2)]
    assert found(spark, rows) == brute(rows)


def test_no_rows_and_no_turns(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "a", "b")]) == []
    alone = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4][0]
    rows = [(alone, 0, "user", "gone")]
    assert found(spark, rows) == brute(rows) and found(spark, rows)[0][1] == 0


def test_extra_columns(spark):
    from pyspark.sql import functions as F

    rows = conversations(5, 40)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("pos", "digest", "tokens", "_from", "a.b", "shard")})
    assert sorted(map(tuple, prefix_trie.prefix_trie(df).collect()), key=repr) == brute(rows)
