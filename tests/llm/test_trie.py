"""Conversation trie against a plain one: odd rows, small shards, queues that spill."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lumenframe.llm import trie
from lumenframe.llm.queries import ORACLE, QUERIES
from tests.compare import differences

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, conv string, pos int, d string, x1 long, band long, shard string, words long"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def plain_turns(rows):
    """Turns (role, text) of each conversation, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            out[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in out.items()}


def plain_trie(turns):
    members = defaultdict(list)
    for c, said in turns.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
    children = Counter(seq[:-1] for seq in members if seq)
    leaves, saved = Counter(), Counter()
    for seq, of in members.items():
        words = len([w for w in seq[-1][1].encode().split() if w]) if seq else 0
        for d in range(len(seq) + 1):
            leaves[seq[:d]] += not children[seq]
            saved[seq[:d]] += (len(of) - 1) * words
    out = []
    for seq, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(turns[c]) == len(seq))
        parent = min(members[seq[:-1]]) if seq else None
        out.append((min(of), len(seq), parent, len(of), children[seq], leaves[seq], saved[seq], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def odd():
    rng = random.Random(3)
    rows = [(0, t, "user", f"first words {t}") for t in range(40)]  # long, and others leave it at any depth
    for c in range(1, 30):
        cut = rng.randint(0, 39)
        rows += [(c, t, "user", f"first words {t}") for t in range(cut)] + [(c, 100 + t, "assistant", rng.choice(["yes it is", "no", ""])) for t in range(rng.randint(0, 9))]
    rows += [(c, t, "user", "copy of all") for c in range(50, 90) for t in range(5)]  # copies
    rows += [(c, 0, "user", "hello") for c in range(100, 140)] + [(c, 1, "user", f"own {c}") for c in range(100, 140)]
    rows += [(200, None, None, None), (200, 3, None, "a  b\t\nc"), (200, 3, "user", None), (200, 3, "user", None), (201, None, "", ""), (-7, 1, "user", "first words 0")]
    rows += [(223, 1, "user", "lost"), (243, 0, "user", "one"), (243, 1, "user", "two"), (262, 2, "user", "kept to two")]
    rows += [(None, 1, "user", "nobody"), (None, None, None, None), (202, 5, "us", "er:x"), (203, 5, "user", ":x"), (204, 1, "user", "漢字 Ünï " * 3000)]
    return rows


@pytest.mark.parametrize(("light", "band", "in_memory"), [(None, None, trie.IN_MEMORY), (1, 2, 3), (3, 5, 1), (1000, 1, 2), (1, 1000, 2)])
def test_trie(spark, light, band, in_memory):
    rows = odd()
    table = spark.createDataFrame([(*r, "c", 1, "d", 2, 3, "s", 4) for r in rows], SCHEMA).repartition(5)
    turns = trie.turn_digests(table)
    found = trie.trie(turns, turns.select("conv").distinct(), light, band, in_memory)
    assert Counter(map(tuple, found.collect())) == plain_trie(plain_turns(rows))


def test_lead(spark):
    rows = odd()
    turns = plain_turns(rows)
    lead = {c: abs(c) % 4 for c in turns}
    wanted = {c: turns.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[: lead[c]] + said[lead[c] :] for c, said in turns.items()}
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conv = F.col("conv")
    given = trie.turn_digests(table)
    led = trie.with_lead(given, F.abs(conv) % 4, conv - conv % 20, 3)
    found = trie.trie(led, given.select("conv").distinct(), 2, 3, 5)
    assert any(not said for said in wanted.values())
    assert Counter(map(tuple, found.collect())) == plain_trie(wanted)


def test_queue_spills_and_keeps_order():
    rng = random.Random(1)
    given = [(-rng.randint(0, 50), rng.randint(-5, 5), 0, 1, rng.randint(0, 9)) for _ in range(5000)]
    queue, totals = trie.SpillingQueue(10), Counter()
    for m in given:
        queue.push(m)
        totals[m[:3]] += m[4]
    assert queue.spills > 100
    for node in sorted(totals):
        assert queue.take(node) == (sum(m[:3] == node for m in given), totals[node])
    assert not queue.heap and not queue.heads


def test_a_message_for_nobody_stops_the_job():
    queue = trie.SpillingQueue()
    queue.push((-3, 1, 1, 1, 1))
    assert queue.take((-4, 0, 0)) == (0, 0)
    with pytest.raises(RuntimeError):
        queue.take((-2, 0, 0))


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(empty).count() == 0
    nobody = spark.createDataFrame([(None, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(nobody).count() == 0


def test_query(spark):
    assert differences(spark, SF_DIR, QUERIES["op12_conversation_trie"], ORACLE["op12_conversation_trie"]) is None
