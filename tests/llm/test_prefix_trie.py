from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tidelake.llm import prefix_trie
from tidelake.llm.queries import op11_prefix_trie
from tidelake.llm.tables import written

SCHEMA = "conv_id long, turn long, role string, text string, depth long, shard string, p double"


def plain(rows, every=20, most=4):
    """The contract, from (conv_id, turn, role, text) rows."""
    convs = {}
    ordered = [(c, t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c is not None]
    for c, _, _, role, text in sorted(ordered):
        convs.setdefault(c, []).append((role, text))
    members = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % most
        rebuilt = tuple(convs.get(c - c % every, [])[:h] + own[h:])
        for d in range(len(rebuilt) + 1):
            members.setdefault(rebuilt[:d], []).append((c, len(rebuilt) == d))
    result = []
    for node, of in members.items():
        subtree = [n for n in members if n[: len(node)] == node]
        parents = {n[:-1] for n in members if n}
        ends = ",".join(str(c) for c, end in sorted(of) if end)
        result.append((
            min(of)[0],
            len(node),
            min(members[node[:-1]])[0] if node else None,
            len(of),
            sum(n != () and n[:-1] == node for n in members),
            sum(n not in parents for n in subtree),
            sum((len(members[n]) - 1) * len(n[-1][1].split()) for n in subtree if n),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(result, key=str)


def made(seed, conversations=150, words=3):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(400), conversations):
        for turn in range(draw.randrange(1, 7)):
            text = " ".join(draw.choice("ab") for _ in range(draw.randrange(1, words)))
            rows.append((c, draw.choice([turn, None]) if draw.random() < 0.1 else turn, draw.choice(["user", "assistant"]), text))
    return rows


ODD = [
    (20, 0, None, None),
    (20, 0, None, None),
    (20, 1, "", ""),
    (21, 0, "user", "a  b\tc"),
    (21, 0, "user", "a  b\tc"),
    (40, 0, "user", "w " * 30_000),
    (41, None, "user", "first"),
    (41, 0, "user", "second"),
    (None, 0, "user", "of nobody"),
    (77, 5, None, "alone"),
]


def built(df, **limits):
    turns = written(prefix_trie.numbered_turns(df), "places")
    return sorted((tuple(r) for r in prefix_trie.trie(*prefix_trie.share_heads(turns), **limits).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed", range(2))
def test_nodes_as_by_definition(spark, seed):
    rows = made(seed)
    assert built(frame(spark, rows)) == plain(rows)


def test_small_queues_and_shards_give_the_same(spark):
    rows = made(7)
    assert built(frame(spark, rows), one_shard=10, queue_entries=3) == plain(rows)


def test_odd_rows(spark):
    assert built(frame(spark, ODD)) == plain(ODD)


def test_one_conversation_holds_most_turns(spark):
    rows = [(20, i, "user", f"t{i}") for i in range(3000)] + [(20 + i, j, "user", f"t{j}") for i in range(1, 20) for j in range(8)]
    assert [r[:7] for r in built(frame(spark, rows))] == [r[:7] for r in plain_chain(rows)]


def plain_chain(rows):
    """As plain, for a long chain."""
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn, text))
    rebuilt = {c: [text for _, text in sorted(turns)] for c, turns in convs.items()}
    deepest = max(map(len, rebuilt.values()))
    result = []
    for d in range(deepest + 1):
        n = [sum(len(t) >= i for t in rebuilt.values()) for i in range(deepest + 1)]
        result.append((20, d, 20 if d else None, n[d], int(d < deepest), 1, sum(x - 1 for x in n[max(d, 1) :])))
    return sorted(result, key=str)


def test_empty(spark):
    assert built(frame(spark, [])) == []


def test_copies_meet_in_one_digest(spark):
    rows = [(c, 0, "user", "same") for c in range(1, 5000)]
    turns, convs = prefix_trie.whole_conversations(prefix_trie.numbered_turns(frame(spark, rows)))
    found = {r["depth"]: r for r in prefix_trie.trie(turns, convs).collect()}
    wanted = hashlib.sha256(",".join(map(str, range(1, 5000))).encode()).hexdigest()
    assert found[1]["ends_sha256"] == wanted and found[1]["n_convs"] == 4999 and found[0]["n_leaves"] == 1


def test_queue_spills_and_keeps_the_order():
    draw = random.Random(1)
    entries = [(draw.randrange(50), i) for i in range(5000)]
    queue, seen = prefix_trie.SpillingQueue(64), []
    for i, entry in enumerate(entries):
        queue.push(entry)
        if i % 3 == 0:
            first = queue.peek()
            assert first == queue.pop()
            seen.append(first)
    while queue:
        seen.append(queue.pop())
    assert sorted(seen) == sorted(entries)
    assert seen[1667:] == sorted(seen[1667:])


def test_query_is_the_contract(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in op11_prefix_trie(spark, sf).collect()), key=str) == plain(rows)
