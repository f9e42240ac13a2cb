import hashlib
import random
import zlib

import pytest
from llm_fixtures import prose

from casegrid.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def slow_nodes(rows, heads=True):
    """The definition on plain sequences: every prefix of every conversation."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, tie, (role, text)))
    convs = {c: [x[3] for x in sorted(t)] for c, t in convs.items()}
    if heads:
        full = {}
        for c, own in convs.items():
            h = zlib.crc32(str(c).encode()) % 9
            home = c - c % 5 if c >= 0 else c + -c % 5
            full[c] = convs.get(home, [])[:h] + own[h:]
        convs = full
    members = {}
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), set()).add(c)
    out = []
    for node, some in members.items():
        below = [x for x in members if x[:len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        ends = ",".join(str(c) for c in sorted(some) if len(convs[c]) == len(node))
        out.append((min(some), len(node), min(members[node[:-1]]) if node else None, len(some), len(kids),
                    len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(frame, **options):
    out = T.trie_nodes(frame, **options)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


def some_rows(seed, n):
    rng = random.Random(seed)
    texts = ["", "a", "b", "ü", prose(rng, 30)]
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice([*texts, None]))
            for c in rng.sample(range(-20, 3 * n), n) for t in range(rng.randrange(1, 9))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [{}, {"shard_convs": 1}, {"shard_convs": 7}, {"shard_turns": 11}])
def test_equals_definition(spark, limits):
    """Shards of any size give the same trie."""
    rows = some_rows(5, 60)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert nodes(frame, span=5, rebuild=T.shared_heads, **limits) == slow_nodes(rows)
    assert nodes(frame, **limits) == slow_nodes(rows, heads=False)


def test_defined_cases(spark):
    rows = [(1, None, "user", "x"), (1, 0, None, None), (1, 0, None, None), (2, 0, "user", "x"), (2, 0, "user", "a"),
            (None, 0, "user", "x"), (3, None, None, None), (3, None, "a", None), (7, 3, "", "u" * 200_000), (5, 1, "r", "t"),
            (10, 0, "r", "t"), (11, 0, "x", "gone"), (4, 2, "1:", ""), (4, 3, "1", ":")]
    extra = spark.createDataFrame([(*r, "z", "z", "z", 1) for r in rows],
                                  SCHEMA + ", node string, shard string, ends string, n int")
    assert nodes(extra, span=5, rebuild=T.shared_heads) == slow_nodes(rows)
    assert nodes(extra) == slow_nodes(rows, heads=False)
    assert nodes(extra.limit(0)) == []
    alone = spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)
    assert nodes(alone) == []


def test_turnless_conversations_end_in_the_root(spark):
    c = next(c for c in range(1, 999) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 3)
    rows = [(c, 0, "user", "one turn, replaced by those of an absent conversation")]
    got = nodes(spark.createDataFrame(rows, SCHEMA), span=5, rebuild=T.shared_heads)
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())] == slow_nodes(rows)


def test_long_chain_and_hot_node(spark):
    """One conversation of many turns, and many conversations with the same turns."""
    rows = [(0, t, "user", f"turn {t}") for t in range(4000)]
    rows += [(c, t, "user", f"same {t}") for c in range(1, 400) for t in range(2)]
    got = nodes(spark.createDataFrame(rows, SCHEMA).repartition(4), shard_convs=16)
    assert len(got) == 1 + 4000 + 2
    by = {(r[0], r[1]): r for r in got}
    assert by[0, 0][3:7] == (400, 2, 2, 398 * 12)
    assert by[1, 2][3:] == (399, 0, 1, 398 * 6, hashlib.sha256(",".join(map(str, range(1, 400))).encode()).hexdigest())
    assert by[0, 3999][3:7] == (1, 1, 1, 0)


def test_query(spark):
    from casegrid.llm.queries import op13_prefix_trie
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = op13_prefix_trie(spark, sf)
    assert sorted((tuple(r) for r in got.select(COLUMNS).collect()), key=str) == slow_nodes(rows)
