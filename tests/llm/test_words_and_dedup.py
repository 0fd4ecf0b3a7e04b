"""Near duplicates, line dedup and their helpers against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from terrier.llm import line_dedup, near_dedup, words
from terrier.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingle_set(text, size):
    found = (text or "").encode().lower().split()
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def brute_components(docs, size, percent):
    sets = {i: shingle_set(t, size) for i, t in docs if i is not None}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_shingles_follow_words():
    texts = ["", None, "One", "a  B\tc\nd a b c d", "x\x1cy  z", "w" * 300 + " " + "w" * 299]
    data = [t.encode() if t else None for t in texts]
    for size in (1, 3, 5):
        values, counts = words.distinct(*words.shingles(*words.hash_words(data), size))
        assert counts.tolist() == [len(shingle_set(t, size)) for t in texts]
    long_a, long_b = words.hash_words([b"w" * 300, b"w" * 299])[0]
    assert long_a != long_b
    assert words.hash_words([b"AbC"])[0] == words.hash_words([b"abc"])[0]


def near_copies(rng):
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, base = [], [rng.choices(vocabulary, k=rng.choice((4, 30, 120, 400))) for _ in range(40)]
    common = rng.choices(vocabulary, k=40)
    for i in range(400):
        text = list(rng.choice(base))
        if i % 3 == 0:
            text = text + common
        for _ in range(rng.choice((0, 0, 1, 2, 5))):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(2000, "one"), (2001, "ONE"), (2002, ""), (2003, None), (2004, " \n")]
    return rows


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, size, percent, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)  # groups are cut even here
    rows = near_copies(random.Random(size))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    got = near_dedup.near_duplicates(docs, shingle_words=size, percent=percent).collect()
    want = brute_components(rows, size, percent)
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_at_the_edges(spark):
    empty = spark.createDataFrame([], DOCS)
    assert near_dedup.near_duplicates(empty).count() == 0
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, text), (3, text), (None, text), (None, None), (9, "other words")]
    docs = spark.createDataFrame([(i, t, "h1", "cid", 1) for i, t in rows], "doc_id long, text string, cid string, h1 string, value long")
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(docs).collect())
    assert got == Counter({(5, 3, False): 2, (3, 3, True): 1, (None, None, True): 2, (9, 9, True): 1})
    kept = near_dedup.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "9", "None", "None"]


def test_shared_values_leave_little_to_chance():
    for percent in (80, 85, 95):
        shared = near_dedup.shared_values(64, percent)
        rng = np.random.default_rng(1)
        assert (rng.binomial(64, percent / 100, 200_000) >= shared).all()


def test_connected_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        assert got[node] == min(seen)
    assert set(got) == set(near)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_lines(rows, share, least):
    total, pages = Counter(), Counter()
    for _, text, site in rows:
        total[site] += 1
        pages.update((site, x) for x in {line.strip(" \t\r") for line in text.split("\n")} - {""}) if text is not None else None
    bad = {k for k, n in pages.items() if n >= least and n > share * total[k[0]]}
    return [
        (i, None if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip(" \t\r")) not in bad)) for i, t, s in rows
    ]


def test_lines_equal_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        site = rng.choice(["hot", "hot", "hot", "b", "c", None])
        lines = [f"line {rng.randrange(400)}" for _ in range(rng.randrange(0, 12))] + ["", " menu\t"] * (i % 2) + ["Menu"] * (i % 40 == 0)
        rows.append((i, "\n".join(lines), site))
    rows += [(900, None, "hot"), (901, "", "hot"), (902, "menu", "alone"), (903, " menu\r", "hot"), (903, " menu\r", "hot")]
    rows.append((904, "x" * 200_000 + "\nmenu", "hot"))
    docs = spark.createDataFrame(
        [(i, t, s, 1, 2) for i, t, s in rows], "doc_id long, text string, source string, total long, lines_before long"
    )
    got = line_dedup.drop_boilerplate_lines(docs)
    assert got.columns == ["doc_id", "text", "source", "total", "lines_before", "lines_dropped"]
    key = lambda x: (x[0], str(x[1]))
    result = got.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in result), key=key) == sorted(brute_lines(rows, 0.1, 3), key=key)
    before = {i: 0 if t is None else t.count("\n") + 1 for i, t, _ in rows}
    assert all(r["lines_before"] == before[r["doc_id"]] for r in result)
    assert line_dedup.drop_boilerplate_lines(spark.createDataFrame([], DOCS)).count() == 0


def test_lines_beside_clashing_columns(spark):
    names = ["boilerplate", "boilerplate_lines", "boilerplate_site", "boilerplate_here", "row", "lines", "here", "site", "pages", "total"]
    rows = [(i, f"menu\nown {i}", "s") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", *[f"doc_id AS {n}" for n in names])
    got = line_dedup.drop_boilerplate_lines(docs).collect()
    assert {(r["doc_id"], r["text"], r["lines_dropped"]) for r in got} == {(i, f"own {i}", 1) for i in range(5)}
    assert all(r[n] == r["doc_id"] for r in got for n in names)


LONG_WORD = "https://example.org/" + "q0" * 40


def test_hash_of_a_word_is_the_same_beside_a_long_word():
    alone = words.hash_words([b"the cat"])[0]
    beside = words.hash_words([b"the cat " + LONG_WORD.encode()])[0]
    assert beside[:2].tolist() == alone.tolist()
    place_65 = words.hash_words([b"w" * 64 + b"a", b"w" * 64 + b"b", b"a" + b"w" * 64])[0]
    assert len(set(place_65.tolist())) == 3


def test_copies_in_partitions_with_and_without_a_long_word(spark):
    rng = random.Random(7)
    text = [f"w{rng.randrange(3000)}" for _ in range(200)]
    near = [*text[:-1], "changed"]
    rows = [(1, " ".join(text)), (2, " ".join(near)), (3, "other " + LONG_WORD), (4, " ".join(text)), (5, " ".join(near))]
    # Two partitions in order; only the second one has a long word.
    docs = spark.createDataFrame(spark.sparkContext.parallelize([(i, t, None, None, None) for i, t in rows], 2), DOCS)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, shingle_words=3, percent=85).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1, 5: 1}


def near_texts(n):
    text = [f"w{i}" for i in range(100)]
    return [" ".join([*text[:-1], f"last{i}"]) for i in range(n)]


def test_second_pass_takes_the_text_of_the_class(spark):
    one, two = near_texts(2)
    rows = [(1, "some other text of the same id"), (1, one), (2, two)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    got = Counter((r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(docs).collect())
    assert got == Counter({(1, 1): 2, (2, 1): 1})


def test_a_class_without_its_shingle_set_fails_the_job(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(near_texts(3))], DOCS)
    all_sets = near_dedup._set_batches

    def without_rows(size):
        made = all_sets(size)

        def run(batches):
            for batch in made(batches):
                yield batch.slice(0, 0)

        return run

    monkeypatch.setattr(near_dedup, "_set_batches", without_rows)
    with pytest.raises(RuntimeError, match="no shingle set"):
        near_dedup.near_duplicates(docs)
