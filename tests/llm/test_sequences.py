"""Prefix trie, exact duplicates and conversation repair against plain versions."""

import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest

pytest.importorskip("riskloom.llm")

from riskloom.llm import conversation_repair, exact_dedup, prefix_trie, queries  # noqa: E402

TURNS = "conv_id long, turn long, role string, text string, at long, pos string, conv string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def stored(spark, folder, table, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{table}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def turns():
    """Conversations with shared beginnings, ties, nulls, repeated rows and clashing columns."""
    rng = random.Random(7)
    rows = []
    for c in [*range(0, 70), -3, -20]:
        if c in (7, 40):
            continue
        for t in range(rng.choice([1, 2, 3, 5, 9, 20, 45])):
            role = ["user", "assistant"][t % 2] if rng.random() < 0.6 else rng.choice(["user", "assistant", "system", "tool", "", None])
            text = rng.choice(["a b.", f"c{t}.", None, "", " x  y\tz! ", "what?\n", "half"])
            rows.append((c, t if rng.random() < 0.97 else None, role, text, 1, "p", "c"))
    return rows + rows[:5] + [(None, 1, "user", "x.", 1, "p", "c"), (None, 2, "assistant", "x.", 1, "p", "c")]


def plain_trie(rows):
    talks = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            talks[c].append((t is not None, t or 0, r or "", x or ""))
    talks = {c: [(r, x) for *_, r, x in sorted(ts)] for c, ts in talks.items()}
    rebuilt = {}
    for c in talks:
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(np.fmod(c, 20))
        rebuilt[c] = talks.get(base, [])[:h] + talks[c][h:]
    nodes, children, found = defaultdict(set), defaultdict(list), {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            nodes[tuple(ts[:d])].add(c)
    for n in nodes:
        if n:
            children[n[:-1]].append(n)
    out = []
    for n in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        leaves = sum(found[k][0] for k in children[n]) or 1
        found[n] = leaves, sum(found[k][1] for k in children[n]) + (len(nodes[n]) - 1) * words
        ends = ",".join(str(c) for c in sorted(nodes[n]) if len(rebuilt[c]) == len(n))
        out.append((min(nodes[n]), len(n), min(nodes[n[:-1]]) if n else None, len(nodes[n]), len(children[n]), *found[n], sha(ends)))
    return sorted(map(repr, out))


def test_prefix_trie(spark, turns, tmp_path):
    sf = stored(spark, tmp_path, "conversations", turns, TURNS)
    found = queries.op11_prefix_trie(spark, sf)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(repr(tuple(r)) for r in found.collect()) == plain_trie(turns)


def test_trie_of_nothing_and_of_silence(spark):
    none = spark.createDataFrame([], "conv_id long, pos long, turn_id string")
    assert prefix_trie.prefix_trie(none).count() == 0
    silent = spark.createDataFrame([(4,), (9,)], "conv_id long")
    assert [tuple(r) for r in prefix_trie.prefix_trie(none, silent).collect()] == [(4, 0, None, 2, 0, 1, 0, sha("4,9"))]
    assert prefix_trie.turn_ids(spark.createDataFrame([], TURNS)).count() == 0


def test_hot_beginning_is_counted_before_it_is_shuffled(spark):
    """A first turn that all conversations share reaches the final aggregate as a row per task."""
    ids = spark.range(4000).selectExpr("id AS conv_id", "1L AS pos", "'same:2' AS turn_id")
    ids = ids.unionAll(spark.range(4000).selectExpr("id", "2L", "concat(id % 7, ':1')")).repartition(4)
    blocks = prefix_trie._blocks(ids)
    plan = prefix_trie._rolled_up(blocks, "count(*) AS n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count(1)") >= 1 and "Expand" in plan
    top = {(r.depth, r.n_convs, r.n_children) for r in prefix_trie.prefix_trie(ids).collect()}
    assert (0, 4000, 1) in top and (1, 4000, 7) in top and len(top) >= 3


def plain_groups(rows):
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc)
    out = []
    for text, docs in groups.items():
        docs = sorted(docs, key=lambda d: (d is None, d or 0))
        out += [(d, docs[0], len(docs), k == 0, sha(text)) for k, d in enumerate(docs)]
    return sorted(map(repr, out))


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdef") * rng.randrange(1, 9) for _ in range(rng.randrange(0, 120))) for _ in range(25)]
    texts += ["".join(rng.choice("ab") for _ in range(40)) for _ in range(30)]  # one length, so that weak fingerprints collide
    rows = []
    for k in range(260):
        text = re.sub(" ", lambda m: rng.choice([" ", "\n\t ", "\r\n", "  "]), rng.choice(texts))
        rows.append((k if rng.random() < 0.9 else None, text, 1, "k"))
    rows += [(None, None, 1, "k"), (500, "", 1, "k"), (501, None, 1, "k"), (502, " \n ", 1, "k"), (503, "\t", 1, "k"), (504, "é " * 5000, 1, "k"), (505, "é  " * 5000, 1, "k")]
    return rows + [(None, "zz", 2, "k"), (None, "zz", 2, "k"), (600, "q", 1, "k"), (600, "q", 1, "k")]


@pytest.mark.parametrize(("chunk", "primes"), [(exact_dedup.CHUNK, exact_dedup.PRIMES), (64, exact_dedup.PRIMES), (16, (2, 3)), (64, (2, 2))])
def test_exact_duplicates(spark, copies, chunk, primes):
    """Also with chunks of a few bytes, and with fingerprints that are no more than a bit or two."""
    docs = spark.createDataFrame(copies, "doc_id long, text string, copy long, exact_key string").repartition(3)
    found = exact_dedup.exact_duplicates(docs, chunk, primes)
    assert sorted(repr((r.doc_id, r.keep_id, r.group_size, r.kept, r.sha256)) for r in found.collect()) == plain_groups(copies)


def test_one_of_each_group_is_left(spark, copies):
    docs = spark.createDataFrame(copies, "doc_id long, text string, copy long, exact_key string").repartition(3)
    left = exact_dedup.drop_exact_duplicates(docs)
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in left.collect()]
    assert left.columns == docs.columns and len(texts) == len(set(texts)) == len({re.sub(r'[\x20\x09-\x0D]+', ' ', r[1] or '') for r in copies})
    assert exact_dedup.drop_exact_duplicates(docs.limit(0)).count() == exact_dedup.exact_duplicates(docs.limit(0)).count() == 0


def test_fingerprints_combine(spark):
    data = np.frombuffer(random.Random(1).randbytes(1000), np.uint8)
    for prime, base in zip(exact_dedup.PRIMES, exact_dedup.BASES, strict=True):
        power = exact_dedup.powers(prime, base, 1000)
        assert [int(x) for x in power[:50]] == [pow(base, k, prime) for k in range(50)]
        whole = int(exact_dedup.chunk_hashes(data, np.array([0, 1000]), prime, power)[0])
        for cut in (1, 13, 500, 999):
            a, b = (int(x) for x in exact_dedup.chunk_hashes(data, np.array([0, cut, 1000]), prime, power))
            assert exact_dedup.combine((a, cut), (b, 1000 - cut), prime, base) == (whole, 1000)


def plain_repair(rows):
    due, after = ["user", "user", "assistant", "user"], [2, 2, 3, 2]
    keeps = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

    @lru_cache(None)
    def best(i, state, inserted):
        if i == len(rows):
            options = [(0, "", ())] if state in (0, 3) else []
        else:
            role, text, fault = rows[i]
            cost, audit, rest = best(i + 1, state, 0)
            options = [(cost + 2, "D" + audit, rest)]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if (role[:1], state) in keeps:
                    cost, audit, rest = best(i + 1, keeps[role[:1], state], 0)
                    options.append((cost + extra, "K" + audit, ((role, text), *rest)))
                cost, audit, rest = best(i + 1, after[state], 0)
                options.append((cost + extra + 1, "R" + audit, ((due[state], text), *rest)))
        if inserted < 3:
            cost, audit, rest = best(i, after[state], inserted + 1)
            options.append((cost + 5, "I" + audit, ((due[state], ""), *rest)))
        return min(options, key=lambda x: x[:2]) if options else (10**9, "", ())

    return best(0, 0, 0)


def plain_repairs(rows):
    sys.setrecursionlimit(100_000)
    talks = defaultdict(list)
    plain = lambda v: " " if v is None else str(v)
    for c, t, r, x, *_ in rows:
        fate, r, x = zlib.crc32(f"{plain(c)}:{plain(t)}".encode()) % 20, plain(r), plain(x)
        x = "" if fate == 1 else re.sub("[.!?]", "", x) if fate == 2 else x
        talks[c] += [] if fate == 0 else [(t is not None, t or 0, "user" if fate == 4 else r, x)] * (2 if fate == 3 else 1)
    out = []
    for c, ts in talks.items():
        ts.sort()
        numbers, seen, judged = [t for some, t, *_ in ts if some], set(), []
        for *_, r, x in ts:
            end = x.strip(" \t\n\x0b\x0c\r")[-1:]
            judged.append((r, x, "blank" if not end else "duplicate" if (r, x) in seen else "" if end in ".!?" else "truncated"))
            seen.add((r, x))
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, left = plain_repair(tuple(judged))
        faults = [sum(f == k for *_, f in judged) for k in ("blank", "duplicate", "truncated")]
        out.append((c, gaps, *faults, illegal, cost, audit, sha("\n".join(f"{r}:{x}" for r, x in left))))
    return sorted(map(repr, out))


@pytest.mark.parametrize("size", [conversation_repair.CHUNK, 4])
def test_conversation_repair(spark, turns, tmp_path, monkeypatch, size):
    """In one chunk, and in chunks so short that their speculative vectors are mostly wrong."""
    sf = stored(spark, tmp_path, "conversations", turns, TURNS)
    whole = conversation_repair.repair
    monkeypatch.setattr(queries, "repair", lambda rows: whole(rows, size))
    found = queries.op13_conversation_repair(spark, sf)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(repr(tuple(r)) for r in found.collect()) == plain_repairs(turns)


def test_repair_of_nothing(spark):
    repaired = conversation_repair.repair(spark.createDataFrame([], TURNS))
    assert repaired.audits.count() == 0 and repaired.turns.count() == 0


def test_speculative_vectors_converge():
    """From any vector, a chunk's costs soon differ from the true ones by a constant; fix-up stops there."""
    rng = np.random.default_rng(3)
    letters = rng.choice([3, 6, 3, 6, 0, 4, 5, 8, 9], (200, 60)).astype(np.uint8)
    lengths = np.full(200, 60)
    guess = conversation_repair.backward(letters, lengths, np.zeros((200, 4), np.int64))
    true_tail = conversation_repair.backward(letters, lengths, np.tile(conversation_repair._END, (200, 1)))[:, 0]
    right = conversation_repair.backward(letters, lengths, true_tail)
    assert (conversation_repair.backward(letters, lengths, true_tail, guess) == right).all()
    shift = guess - right
    parallel = (shift == shift[:, :, :1]).all(2)
    assert parallel[:, 0].mean() > 0.9 and parallel[:, 45].mean() > 0.5
