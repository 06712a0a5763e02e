"""The conversation trie against dictionaries of prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gristmill.llm import conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, _c string, _head int, _turn int, head string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2, 3, "h") for r in rows], SCHEMA)


def turn_id(turn):
    return hashlib.sha256(f"{len(turn[0])}:{turn[0]}{turn[1]}".encode()).digest()[:16]


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, turn_id((role or "", text or "")), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def brute(rows):
    whole = rebuilt(rows)
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)

    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        below = children.get(k, [])
        leaves[k] = sum(leaves[x] for x in below) or 1
        saved[k] = sum(saved[x] for x in below) + ((len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0)
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, [])), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def talks(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        opening = [("system", "be kind")] * (rng.random() < 0.5)
        length = rng.randrange(0, 12)
        turns = opening + [(rng.choice(["user", "assistant", None]), rng.choice(["yes", "no", "", None, "ä" * 3])) for _ in range(length)]
        rows += [(c, rng.choice([i, i, i, None]) if c % 7 == 0 else i, *t) for i, t in enumerate(turns)]
    return rows


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed,limit", [(1, 1), (2, 6), (3, 512)])
def test_against_prefixes(spark, seed, limit):
    rows = talks(seed)
    assert result(conversations.prefix_trie(frame(spark, rows).repartition(4), limit=limit)) == brute(rows)


def test_copies_forks_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK_BITS", 3)
    monkeypatch.setattr(conversations, "PATH_BLOCK", 7)
    chain = [("user", f"t{i}") for i in range(60)]
    rows = [(5 * c, i, *t) for c in range(40) for i, t in enumerate(chain[:30])]  # copies
    rows += [(5 * c, i, *t) for c in range(40, 70) for i, t in enumerate([*chain[:c], ("user", f"fork {c}")])]  # forks at every depth
    rows += [(5 * c, i, *t) for c in range(70, 100) for i, t in enumerate(chain[: c - 69])]  # each a prefix of the next
    rows += [(-5 * c - 5, i, "user", f"{c} {i}") for c in range(3) for i in range(700)]  # long and alone
    assert result(conversations.prefix_trie(frame(spark, rows), limit=20)) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "nobody"), (7, None, None, None), (7, None, "user", "a"), (7, 3, "user", "a"), (7, 3, "user", "a"), (-3, 0, "user", "x"),
            (2**63 - 1, 0, "user", "x"), (-(2**63), 0, "user", "x"), (4, 0, "user", "w " * 50_000)]
    assert result(conversations.prefix_trie(frame(spark, rows))) == brute(rows)
    assert conversations.prefix_trie(frame(spark, [])).collect() == []
    assert conversations.prefix_trie(frame(spark, rows[:1])).collect() == []


def test_no_container_is_larger_than_the_limit(spark, monkeypatch):
    seen = []
    swept = conversations._swept

    def watched(rows):
        seen.extend(r["count"] for r in rows.groupBy("_head").count().collect())
        return swept(rows)

    monkeypatch.setattr(conversations, "_swept", watched)
    rows = [(5 * c, i, "user", f"{(c % 3 if c < 40 else c % 20) if i < 4 else c} {i}") for c in range(80) for i in range(8)]
    assert result(conversations.prefix_trie(frame(spark, rows), limit=20)) == brute(rows)
    assert seen and max(seen) <= 20


def test_ordered_turns_number_each_conversation(spark):
    rows = conversations.ordered_turns(frame(spark, talks(4)), "conv_id", "turn", "role", "text")
    wrong = rows.groupBy("_c").agg(F.min("_at").alias("a"), F.max("_at").alias("b"), F.count_distinct("_at").alias("k"), F.max("_n").alias("n"))
    assert wrong.filter("a <> 1 OR b <> n OR k <> n").count() == 0
