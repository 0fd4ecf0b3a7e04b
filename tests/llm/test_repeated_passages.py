"""Suffix order, and removal of repeated passages, against brute force."""

import hashlib
import random

import numpy as np
import pytest

from terrier.llm import deep_shallow, repeated_passages


def shared_length(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_deep_shallow_order_and_shared_lengths():
    rng, width = random.Random(2), 24
    for _ in range(300):
        bases = [bytes(rng.choice(b"\0ab") for _ in range(width)) for _ in range(3)]
        strings = []
        for _ in range(rng.randint(0, 40)):
            s, k = rng.choice(bases), rng.randint(0, width)
            if rng.random() < 0.5:
                s = s[:k] + bytes(rng.choice(b"\0ab") for _ in range(width - k))
            strings.append(s[: rng.choice([width, rng.randint(0, width)])])
        group = np.array([rng.randint(0, 2) for _ in strings], dtype=np.int64)
        rows = np.zeros((len(strings), width), dtype=np.uint8)
        for i, s in enumerate(strings):
            rows[i, : len(s)] = np.frombuffer(s, dtype=np.uint8)
        order, shared = deep_shallow.sort(rows, np.array([len(s) for s in strings], dtype=np.int64), group, 8)
        assert sorted(order.tolist()) == list(range(len(strings)))
        for k in range(1, len(strings)):
            a, b = order[k - 1], order[k]
            assert group[a] <= group[b]
            assert shared[k] == (shared_length(strings[a], strings[b]) if group[a] == group[b] else -1)
            if group[a] == group[b] and 0 not in strings[a] + strings[b]:
                assert strings[a] <= strings[b]


def test_blind_trie_sorts():
    rng = random.Random(4)
    for _ in range(200):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 30))]
        trie = deep_shallow.BlindTrie()
        for i, s in enumerate(strings):
            trie.add(s, i)
        found = trie.sorted()
        assert [strings[i] for i, _ in found] == sorted(strings)
        for (a, _), (b, n) in zip(found, found[1:]):
            assert n == shared_length(strings[a], strings[b])


def plain_passages(docs, length=100):
    """(doc_id, n_bytes, removed spans, kept) of each document, from the definition."""
    seen, out = set(), []
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for s in range(len(data) - length + 1):
            string = data[s : s + length]
            if string in seen:
                gone[s : s + length] = True
            seen.add(string)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).tolist()
        kept = bytes(np.frombuffer(data, dtype=np.uint8)[~gone])
        out.append((doc_id, len(data), list(zip(edges[0::2], edges[1::2])), kept))
    return sorted(out, key=repr)


def corpus(rng):
    """Copies, near copies, shared passages of all lengths around the limit, inner repetition, periodic and short texts."""
    letters = "abcdefghij klmnopé\n"
    text = lambda n: "".join(rng.choices(letters, k=n))
    passages = [text(n) for n in (98, 99, 100, 101, 150, 400, 900)]
    docs = [None, "", "a", text(99), text(100), "x" * 5000, "x" * 137, "ab" * 900, text(777) * 4]
    for _ in range(60):
        docs.append("".join(rng.choice([text(rng.randint(0, 300)), rng.choice(passages)]) for _ in range(rng.randint(1, 6))))
    for _ in range(60):
        copy = list(rng.choice(docs[9:]))
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(letters)
        docs.append("".join(copy))
    hub = text(260)
    docs += [text(40) + hub + text(40) for _ in range(60)]
    rng.shuffle(docs)
    return list(enumerate(docs))


def removed(spark, docs, **options):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, kept string, mark int").repartition(5)
    rows = repeated_passages.remove_repeated(df, **options).collect()
    return sorted(((r[0], r[1], [tuple(s) for s in r[2]], bytes(r[3])) for r in rows), key=repr)


@pytest.mark.parametrize("block_members", [4, repeated_passages.BLOCK_MEMBERS])
def test_removed_is_that_of_the_definition(spark, block_members):
    docs = corpus(random.Random(block_members))
    assert removed(spark, docs, block_members=block_members) == plain_passages(docs)


def test_long_text_is_taken_in_slices(spark):
    rng = random.Random(1)
    text = "".join(rng.choices("abcdefgh ", k=repeated_passages.SLICE_BYTES + 5000))
    docs = [(1, text), (2, "before " + text[3000:-3000] + " after"), (3, text[-4000:] * 3)]
    assert removed(spark, docs) == plain_passages(docs)


def test_edge_cases(spark):
    rng = random.Random(6)
    a, b = ("".join(rng.choices("abcdef ", k=300)) for _ in range(2))
    assert removed(spark, []) == []
    # Equal rows are one document; a null id comes first.
    got = removed(spark, [(5, a), (5, a), (None, a[50:250]), (7, b + a)])
    assert [(i, n, s) for i, n, s, _ in got] == [
        (5, 300, [(50, 250)]),
        (5, 300, [(50, 250)]),
        (7, 600, [(300, 600)]),
        (None, 200, []),
    ]


def test_report(spark):
    text = "".join(random.Random(9).choices("abcdef ", k=250))
    df = spark.createDataFrame([(1, text), (2, "y" + text + "z")], "doc_id int, text string")
    rows = {r["doc_id"]: r for r in repeated_passages.passage_report(repeated_passages.remove_repeated(df)).collect()}
    assert tuple(rows[1])[:4] == (1, 250, 0, 0) and tuple(rows[2])[:4] == (2, 252, 250, 1)
    assert rows[2]["kept_sha256"] == hashlib.sha256(b"yz").hexdigest()
