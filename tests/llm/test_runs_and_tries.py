"""Periodic runs and conversation prefixes against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from terrier.llm import conversation_trie, periodic_runs

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_runs(w):
    """(start, length, period) of every run, from the definition."""
    n, found = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(s, e - p)) for p in range(1, q)):
                found.append((s, e - s, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def word_lists(rng, n):
    for _ in range(n):
        k = rng.choice([1, 2, 2, 3, 5, 50])
        w = [rng.randrange(k) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.randint(1, 14)
            root = [rng.randrange(k) for _ in range(p)]
            if rng.random() < 0.4 and p > 3:  # a repetition inside the repeated words
                root = (root[:2] * 20)[: p - 1] + [9]
            at = rng.randint(0, len(w))
            w[at:at] = (root * 8)[: rng.randint(2 * p, 6 * p + 3)]
        yield w


def test_runs_are_those_of_the_definition():
    rng = random.Random(5)
    for _ in range(300):
        texts = list(word_lists(rng, rng.randint(1, 4)))
        found = periodic_runs.find_runs(np.array([x for w in texts for x in w]), np.array([len(w) for w in texts]))
        assert [tuple(r) for r in found.tolist()] == [(i, *r) for i, w in enumerate(texts) for r in plain_runs(w)]


def test_runs_of_long_texts():
    rng = np.random.default_rng(1)
    root, other = rng.integers(0, 1000, 777), rng.integers(0, 1000, 5000)
    text = np.concatenate((other, np.tile(root, 9), other[::-1], np.zeros(100_000, dtype=int)))
    found = periodic_runs.find_runs(text, np.array([len(text)]))
    assert [100_000, 1] in found[:, 2:].tolist()
    (long,) = [r for r in found.tolist() if r[3] == 777]
    assert (long[1] - 5000, long[2]) == (0, 9 * 777) or long[2] > 9 * 777  # neighbours may happen to fit


def test_collapse_and_its_edge_cases(spark):
    texts = [None, "", "  \t\n ", "a b c", "x x x x x x", "x x x x x", "a b a b a b a b c", "né   x\x1cy né", "A a A a A a A a " * 3]
    rng = random.Random(8)
    texts += [" \n".join(f"w{x}" for x in w) + " " for w in word_lists(rng, 60)]
    rows = [(i, t, "extra") for i, t in enumerate(texts)] + [(3, "a b c", None), (None, "x x x x x x x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3)
    got = sorted(map(tuple, periodic_runs.collapse_runs(docs).collect()), key=repr)
    wanted = []
    for i, t, _ in rows:
        w = WORD.findall(t or "")
        runs = plain_runs(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        wanted.append((i, len(w), runs, " ".join(x for k, x in enumerate(w) if k not in gone)))
    plain = [(i, n, [tuple(r) for r in runs], t) for i, n, runs, t in got]
    assert sorted(plain, key=repr) == sorted(wanted, key=repr)
    report = {r["doc_id"]: r for r in periodic_runs.run_report(periodic_runs.collapse_runs(docs)).collect()}
    assert (report[0]["n_runs"], report[0]["start"], report[0]["exponent_milli"]) == (0, None, None)
    assert report[0]["runs_sha256"] == report[0]["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()
    assert (report[6]["start"], report[6]["length"], report[6]["period"], report[6]["exponent_milli"]) == (0, 8, 2, 4000)
    assert report[6]["runs_sha256"] == hashlib.sha256(b"0,8,2\n").hexdigest()
    assert report[6]["collapsed_sha256"] == hashlib.sha256(b"a b c").hexdigest()
    assert periodic_runs.collapse_runs(docs.limit(0)).count() == 0


def test_planted_repeats(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 40))) for i in range(300)] + [(None, "a b"), (1, None)]
    got = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in periodic_runs.planted_repeats(got).collect() if r["text"] is not None}
    assert found[None] == "a b"
    for i, t in rows[:300]:
        w, h = t.split(), zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        assert found[i].split() == w


def plain_trie(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + v[h:]
    members, below = defaultdict(list), defaultdict(set)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for k in members:
        if k:
            below[k[:-1]].add(k)
    out = {}
    for k in sorted(members, key=len, reverse=True):
        saved = (len(members[k]) - 1) * (len(WORD.findall(k[-1][1])) if k else 0) + sum(out[x][6] for x in below[k])
        ends = ",".join(str(c) for c in sorted(members[k]) if len(rebuilt[c]) == len(k))
        leaves = sum(out[x][5] for x in below[k]) or 1
        above = min(members[k[:-1]]) if k else None
        out[k] = (min(members[k]), len(k), above, len(members[k]), len(below[k]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=repr)


def talk(rng):
    rows = []
    for c in range(240):
        for t in range(70 if c % 21 == 0 else rng.choice([1, 2, 3, 6])):
            said = rng.choice(["x y", "hello  w", "a b", None, ""])
            rows.append((c, None if t == 0 and c % 5 == 0 else t, rng.choice(["a", "b", None]), said))
    return rows


CASES = {
    "mixed": talk(random.Random(3)),
    "empty": [],
    "copies": [(None, 1, "a", "b")] + [(c, 1, "a", "b c") for c in range(200)],
    "repeated rows": [(c, 1, "a", "b") for c in range(9) for _ in range(5)],
    "no first of its family": [(c, 0, "a", "b") for c in range(21, 40)],
}


@pytest.mark.parametrize("shard", [9, 50_000])
@pytest.mark.parametrize("case", list(CASES))
def test_trie_is_that_of_the_definition(spark, case, shard):
    turns = spark.createDataFrame(CASES[case], "conv_id long, turn int, role string, text string")
    turns = turns.selectExpr("*", "'x' AS path", "1 AS words")
    paths = conversation_trie.as_paths(conversation_trie.rebuilt_conversations(turns))
    got = sorted(map(tuple, conversation_trie.prefix_trie(paths, shard_conversations=shard).collect()), key=repr)
    assert got == plain_trie(CASES[case])


def test_splitters_may_be_cut(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "SPLITTER_TURNS", 2)
    monkeypatch.setattr(conversation_trie, "SKELETON_BYTES", 400)
    turns = spark.createDataFrame(CASES["mixed"], "conv_id long, turn int, role string, text string")
    paths = conversation_trie.as_paths(conversation_trie.rebuilt_conversations(turns))
    assert sorted(map(tuple, conversation_trie.prefix_trie(paths, 20).collect()), key=repr) == plain_trie(CASES["mixed"])
