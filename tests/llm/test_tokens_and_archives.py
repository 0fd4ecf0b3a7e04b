"""Packing, token counts, language profiles, fingerprints and archives."""

import gzip
import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from terrier.llm import fingerprints, language_id, packing, token_counts, warc

DOCS = "doc_id long, text string, lang string, length long"
BPE = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, 1) for i, t in rows], DOCS)


ODD_TEXTS = [
    None, "", " ", "Don't we'LL 've ''s 's?!", "ÀÉÎ Straße ΑΣ ΣΟΦΟΣ. İstanbul", "é ́x", "a\x1cb\x1fc", "a b c",
    "日本語 テキスト 123", "😀😀 ok", "<|endoftext|> x", "x" * 30_000, "word " * 5000, "A1b2C3", "​zero", "ﬁ ǅ",
]


def plain_ids(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BPE)
    return [plain.encode(text or "", add_special_tokens=False).ids + [packing.END] for text in texts]


def word_ids(texts):
    ids, counts = packing.WordIds(BPE).texts([(text or "").encode() for text in texts])
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_word_ids_are_the_tokenizers():
    assert word_ids(ODD_TEXTS) == plain_ids(ODD_TEXTS)
    for text in ODD_TEXTS:
        assert word_ids([text]) == plain_ids([text]), text
    assert word_ids(["a <|endoftext|> b"]) == [[320, 49407, 321, 0]]


def test_word_ids_of_random_texts():
    rng = random.Random(11)
    letters = list("aZ19 '\n\t.<|>_-") + ["'s", "'LL", "é", "É", "ß", "ÿ", "×", "÷", "İ", "ª", "\u0301", "\0", "Σ", "日", "😀", "\x85", "\xa0", "<|endoftext|>", "<|STARTOFTEXT|>", "ﬁ", "ẞ"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(0, 14))) for _ in range(4000)]
    for some in (texts, [t.replace("\0", "") for t in texts]):
        assert word_ids(some) == plain_ids(some)


def test_word_ids_of_real_texts(spark, monkeypatch):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = plain_ids(texts)
    monkeypatch.setattr(packing, "STRINGS_AT_ONCE", 50)
    assert word_ids(texts) == want
    assert [x for i in range(0, len(texts), 7) for x in word_ids(texts[i : i + 7])] == want


def test_pieces_and_sequences(spark):
    rng = random.Random(1)
    rows = list(enumerate(ODD_TEXTS)) + [(100 + i, "tea " * rng.randrange(1, 3000)) for i in range(80)] + [(7, "twice"), (7, "twice"), (None, "no id")]
    got = packing.pack_documents(frame(spark, rows), BPE).collect()
    want = []
    for (i, _), plain in zip(rows, plain_ids([text for _, text in rows])):
        ids = np.array(plain, dtype="<u4").tobytes()
        for n, at in enumerate(range(0, len(ids), 8192)):
            part = ids[at : at + 8192]
            want.append((str(i), n, at // 4, len(part) // 4, zlib.crc32(part)))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= math.ceil(sum(x[3] for x in want) / 2048) + 1
    assert packing.pack_documents(frame(spark, []), BPE).count() == 0


def squares(sizes, place):
    return int((np.bincount(place, weights=sizes) ** 2).sum())


def test_local_search_empties_bins():
    """Exchanges of one for one and two for one, and bins that only they can empty."""
    rng = np.random.default_rng(3)
    sizes, start = np.array([6, 2, 3, 1, 8]), np.array([0, 0, 1, 1, 2])
    place = packing.improve(sizes, start, 10)
    assert len(set(place.tolist())) == 2 and np.bincount(place, weights=sizes).max() <= 10
    sizes, place = np.array([3, 3, 5, 4]), np.array([0, 0, 1, 1])
    assert packing._best_change(sizes, place, np.array([4, 1]), 0) == ((0, 1), 2, 1)
    assert packing._best_change(np.array([3, 7]), np.array([0, 1]), np.array([7, 2]), 0) is None
    for _ in range(4):
        sizes = rng.integers(1, 100, 100)
        start = packing.best_fit(sizes, 100)
        loose = np.arange(100)  # every item alone: search must do it all
        assert len(set(packing.improve(sizes, loose, 100).tolist())) <= 1.1 * (start.max() + 1)
        place = packing.improve(sizes, start, 100)
        fill = np.bincount(place, weights=sizes)
        assert fill.max() <= 100 and fill.sum() == sizes.sum()
        assert squares(sizes, place) >= squares(sizes, start) and np.count_nonzero(fill) <= len(set(start.tolist()))


def improving_change_exists(sizes, place, capacity):
    """Whether moving one, or exchanging one for one or two for one, into a bin no emptier raises the squares."""
    fill = np.bincount(place, weights=sizes).astype(int)
    for source in np.flatnonzero((fill > 0) & (fill < capacity)):
        own = np.flatnonzero(place == source)
        for into in np.flatnonzero((fill >= fill[source]) & (fill < capacity)):
            if into == source:
                continue
            gap, there = capacity - fill[into], sizes[place == into]
            given = [int(x) for x in sizes[own]]
            pairs = [a + b for i, a in enumerate(given) for b in given[i + 1 :]]
            if any(g <= gap for g in given) or any(t < g <= gap + t for g in given + pairs for t in there):
                return True
    return False


def test_local_search_ends_where_no_change_is_left():
    rng = np.random.default_rng(7)
    for low, high, n in ((25, 45, 120), (1, 100, 100), (30, 70, 90), (10, 30, 150)):
        sizes = rng.integers(low, high, n)
        place = packing.improve(sizes, packing.best_fit(sizes, 100), 100)
        fewest = -(-int(sizes.sum()) // 100)
        assert len(set(place.tolist())) == fewest or not improving_change_exists(sizes, place, 100)


def test_first_below():
    rng = np.random.default_rng(2)
    for _ in range(200):
        values = rng.integers(0, 9, rng.integers(1, 40))
        at, limit = rng.integers(0, len(values) + 1, 30), rng.integers(0, 11, 30)
        want = [next((i for i in range(a, len(values)) if values[i] < x), len(values)) for a, x in zip(at, limit)]
        assert packing._first_below(values, at, limit).tolist() == want


def test_sequences_of_hard_lengths():
    """Lengths that leave gaps behind: the search must come well below best fit."""
    sizes = np.random.default_rng(0).integers(500, 900, 1500)
    start = packing.best_fit(sizes, 2048)
    place = packing.improve(sizes, start, 2048)
    assert np.bincount(place, weights=sizes).max() <= 2048
    assert len(set(place.tolist())) <= 0.97 * (start.max() + 1)


def best_segmentation(word, scores, unknown):
    text = token_counts.MARK + word
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            score = scores.get(text[start:end])
            if score is not None and best[start][0] + score > best[end][0]:
                best[end] = (best[start][0] + score, best[start][1] + 1)
        if best[end][0] == -math.inf:
            best[end] = (best[end - 1][0] + unknown, best[end - 1][1] + len(text[end - 1].encode()))
    return best[-1][1]


def test_token_counts_equal_plain_forward_scores(spark):
    scores = token_counts.zipf_scores(token_counts.load_pieces(public_tokenizers.path("piece_bpe_32k.model")))
    counter = token_counts.UnigramCounter(scores)
    rng = random.Random(1)
    words = {"".join(rng.choices("etaoinshrdlu.é日", k=rng.randrange(1, 25))) for _ in range(400)} | {"the", "theatre", "😀", "😀a", "a" * 300}
    for word, n in counter.count(words).items():
        assert n == best_segmentation(word, scores, counter.unknown), word
    rows = [(1, None), (2, ""), (3, "the theatre\nthe"), (3, "the theatre\nthe"), (None, "x"), (5, "z" * 50_000), (6, "the " * 30_000)]
    got = token_counts.token_counts(frame(spark, rows), scores).collect()
    one, two = (best_segmentation(w, scores, counter.unknown) for w in ("the", "theatre"))
    assert sorted((str(r["doc_id"]), r["n_pretokens"], r["n_tokens"]) for r in got if r["doc_id"] != 5) == sorted(
        [("1", 0, 0), ("2", 0, 0), ("3", 3, 2 * one + two), ("3", 3, 2 * one + two), ("6", 30_000, 30_000 * one),
         ("None", 1, best_segmentation("x", scores, counter.unknown))]
    )
    assert token_counts.token_counts(frame(spark, []), scores).count() == 0


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs, language_id.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_profile_distance_is_out_of_place():
    def plain(text, profile):
        body = " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split())
        padded, seen = f" {body} ", defaultdict(int)
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                if padded[i : i + n] != " ":
                    seen[padded[i : i + n]] += 1
        code = lambda g: sum((1 if c == " " else ord(c)) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
        top = [code(g) for g in sorted(seen, key=lambda g: (-seen[g], code(g)))][: language_id.PROFILE]
        rank = {g: i for i, g in enumerate(profile)}
        return 1 - sum(min(abs(rank[g] - i), language_id.PROFILE) if g in rank else language_id.PROFILE for i, g in enumerate(top)) / (language_id.PROFILE * len(top))

    texts = {"en": "the cat and the hat of the house", "fr": "le chat et la maison de l'école"}
    profiles = {k: language_id.most_frequent(*language_id.ngrams(language_id.symbols(t))).tolist() for k, t in texts.items()}
    compare = language_id.Profiles(profiles)
    for text in ["The house", "l'Élan 12 de la maison", "zzz", "a" * 5000, "x " * 900]:
        name, score = compare.predict(text)
        want = {k: plain(text, p) for k, p in profiles.items()}
        assert score == pytest.approx(max(want.values())) and want[name] == max(want.values())
    for text in (None, "", " 12 -- 😀"):
        assert compare.predict(text) == ("und", 0.0)


def test_language_at_the_edges(spark):
    rows = [(1, "the cat", "en"), (2, None, "en"), (None, "the cat", None), (5, "!!", "fr"), (5, "!!", "fr")]
    docs = spark.createDataFrame([(i, t, k, 1) for i, t, k in rows], "doc_id long, text string, lang string, score long")
    assert language_id.learn(docs.where("false")) == {}
    assert {r["lang_pred"] for r in language_id.identify(docs, {}).collect()} == {"und"}
    profiles = {"en": language_id.most_frequent(*language_id.ngrams(language_id.symbols("the cat"))).tolist()}
    kept = language_id.keep_identified(docs, profiles)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "None"]
    assert language_id.identify(docs.where("false"), profiles).count() == 0


def test_fingerprints_estimate_similarity():
    rng = random.Random(2)
    for share in (0.0, 0.3, 0.6, 0.9):
        errors = []
        for _ in range(20):
            words = [f"w{rng.randrange(10**6)}" for _ in range(1500)]
            cut = int(len(words) * share)
            other = words[:cut] + [f"v{rng.randrange(10**6)}" for _ in range(len(words) - cut)]
            a, b = (fingerprints.digits_of([" ".join(x).encode()]) for x in (words, other))
            left, right = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (words, other))
            errors.append(fingerprints.likeness(*a, *b)[0] - len(left & right) / len(left | right))
        assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.15
    low, some = fingerprints.digits_of([b"one two", b"one  TWO", b"", None, b"three"])
    assert fingerprints.as_text(low, some)[0] == fingerprints.as_text(low, some)[1] and fingerprints.as_text(low, some)[2:4] == ["", ""]
    assert fingerprints.likeness(low[:1], some[:1], low[2:3], some[2:3])[0] == 0


@pytest.mark.parametrize("n", [0, 1, 2, 137])
def test_edited_texts(spark, n):
    rng = random.Random(n)
    rows = [(i * 3, rng.choice([None, "", "é😀x", " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(1, 60)))])) for i in range(n)]
    docs = frame(spark, rng.sample(rows, n))
    got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(docs).collect()}
    ordered = [(i, t or "") for i, t in sorted(rows, reverse=True)]
    assert len(got) == n
    for k, (i, text) in enumerate(ordered):
        after = ordered[(k + 1) % n][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == len(text)
        prints = [fingerprints.digits_of([t.encode()]) for t in (text, edited, after)]
        assert got[i]["fingerprint"] == fingerprints.as_text(*prints[0])[0]
        assert got[i]["edited_fingerprint"] == fingerprints.as_text(*prints[1])[0]
        assert got[i]["near_edited"] == fingerprints.likeness(*prints[0], *prints[1])[0]
        assert got[i]["near_next"] == fingerprints.likeness(*prints[0], *prints[2])[0]


def test_plain_fingerprints(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, None), (3, "x" * 100_000)]
    got = fingerprints.fingerprints(frame(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"], len(r["fingerprint"])) for r in got) == [("1", 11, 256), ("1", 11, 256), ("3", 100_000, 256), ("None", 0, 0)]


def test_archives(spark, tmp_path):
    tricky = "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n</p>" * 5
    rows = [(4, "u\r\nx", tricky), (2, None, tricky), (9, "c", tricky), (1, "d", "short"), (3, "e", "short"), (5, "f", None), (6, "g", ""),
            (None, "h", tricky), (7, "i", "é" * 50), (8, "j", "é" * 50), (8, "j", "é" * 50), (10, "k", "z" * 3_000_000), (11, "l", "z" * 99)]
    pages = spark.createDataFrame([(i, u, h, "digest") for i, u, h in rows], "page_id long, url string, html string, digest string")
    path = str(tmp_path / "archives")
    warc.write_archives(warc.resolve_revisits(pages), path)
    got = warc.read_archives(spark, path).collect()
    want, first = [], {}
    for i, _, h in rows:
        body = (h or "").encode()
        if len(body) >= 100 and i is not None:
            first[body] = min(i, first.get(body, i))
    for i, _, h in rows:
        body = (h or "").encode()
        again = len(body) >= 100 and first.get(body) is not None and first[body] != i
        want.append((str(i), len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[body] if again else None))
    key = lambda x: (x[0], x[2], str(x[4]))
    assert sorted(((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=key) == sorted(want, key=key)
    stored = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "archives").glob("*.gz"))
    assert stored.count(tricky.encode()) == 1 and stored.count(b"WARC-Type: ") == len(rows)
    empty = str(tmp_path / "none")
    warc.write_archives(warc.resolve_revisits(pages.where("false")), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_damaged_archives_are_refused(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "payload " * 40)], "page_id long, url string, html string")
    path = tmp_path / "a"
    warc.write_archives(warc.resolve_revisits(pages), str(path))
    file = next(path.glob("*.gz"))
    whole = gzip.decompress(file.read_bytes())
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records_in(gzip.compress(whole[:-20])))
    assert [h["WARC-Type"] for h, _ in warc.records_in(gzip.compress(whole) + gzip.compress(whole))] == ["response"] * 2


def test_fingerprints_do_not_depend_on_the_block():
    rng = random.Random(5)
    filler = " ".join(f"f{i}" for i in range(150_000))  # over a block of its own
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(400))
    long_word = "https://example.org/" + "q0" * 40
    texts = [text, filler, text, long_word, filler, text]
    prints = fingerprints.as_text(*fingerprints.digits_of([t.encode() for t in texts]))
    assert prints[0] == prints[2] == prints[5]
    assert prints[0] == fingerprints.as_text(*fingerprints.digits_of([text.encode()]))[0]


def test_near_edited_beside_a_long_word(spark):
    rng = random.Random(6)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(400))
    long_text = text + " https://example.org/" + "q0" * 40
    # Documents follow each other by falling id: 9, 8, 7, 6; the last is followed by the first.
    rows = [(9, text), (8, text), (7, long_text), (6, text)]
    got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(frame(spark, rows)).collect()}
    alone = fingerprints.as_text(*fingerprints.digits_of([text.encode()]))[0]
    assert [got[i]["fingerprint"] for i in (9, 8, 6)] == [alone] * 3
    assert got[9]["near_next"] == 1.0 and got[6]["near_next"] == 1.0
    assert got[8]["near_next"] > 0.9 and got[7]["near_next"] > 0.9
    for i in (9, 8, 7, 6):
        assert got[i]["near_edited"] > 0.4
