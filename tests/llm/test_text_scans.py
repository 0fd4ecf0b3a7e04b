"""Secrets, personal data and decontamination against plain Python."""

import hashlib
import random
import re
import time

import pytest

from terrier.llm import decontaminate, personal_data, secrets

DOCS = "doc_id long, text string, kind string, value string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "kind", "value") for i, t in rows], DOCS)


def digest(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def listed(found, kinds):
    spans = sorted((start, kinds.index(kind), end) for kind, start, end in found)
    return [f"{kinds[k]}:{start}:{end}" for start, k, end in spans]


def plain_secrets(text):
    found = []
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
    for m in re.finditer(rf"({word}|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            found.append(("assign", m.start(), m.end()))
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return listed(found, ["assign", "access", "hex"])


def plain_personal(text):
    found = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(digits[0::2]) + sum(d * 2 - 9 if d > 4 else d * 2 for d in digits[1::2])
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            found.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", m.start(), m.end()))
    return listed(found, ["email", "ip", "card", "phone"])


def noisy(rng, parts, alphabet, n):
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randrange(0, 14)):
            text += rng.choice(parts) if rng.random() < 0.6 else "".join(rng.choices(alphabet, k=rng.randrange(1, 9)))
            text += rng.choice(["", " ", "\n", "é", "😀"])
        rows.append((i, text))
    return rows


def test_base_secrets(spark):
    rng = random.Random(1)
    parts = ["password=hunter22", 'API_KEY: "abcDEF123"', "secret=token:abcdefgh", "toKen=abcdefg", "token==x", "AKIA" + "A1B2" * 4,
             "AKIAAKIA", "0123456789abcdef" * 2, "deadbeef" * 3, "passwd = ab", "ToKeN'='a.b-c_d/e+f="]
    rows = noisy(rng, parts, "akiAKI09abf=:\"' ", 300) + [(900, None), (901, ""), (902, "f" * 300_000), (903, parts[0]), (903, parts[0])]
    got = secrets.find_secrets(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = {i: plain_secrets(t or "") for i, t in rows}
    for r in got:
        spans = want[r["doc_id"]]
        assert r["base_sha256"] == digest(spans)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("like_")] == spans
    assert secrets.find_secrets(frame(spark, [])).count() == 0


def test_learnt_formats_find_unlabelled_secrets(spark):
    rng = random.Random(3)
    digits = "0123456789abcdef"
    key = lambda: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=16))
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randrange(3, 12)))
    rows = []
    for i in range(300):
        prose = " ".join(word() for _ in range(20))
        rows.append((i, f"{prose} token={''.join(rng.choices(digits, k=40))} and AKIA{key()} {prose}"))
    hidden = "ASIA" + key()
    rows += [(500, f"use {hidden} now"), (501, "internationalisations2 underwood_and_oak"), (502, " ".join(word() for _ in range(300)))]
    got = {r["doc_id"]: r for r in secrets.find_secrets(frame(spark, rows)).collect()}
    assert got[500]["spans"] == "like_access:4:24" and got[500]["n_added"] == 1
    assert got[501]["spans"] == "" and got[502]["spans"] == ""
    learnt = secrets.learn({"hex": ["".join(rng.choices(digits, k=32)) for _ in range(200)]})["hex"][0]
    assert len(learnt.next) < 200  # the prefix tree had thousands
    assert learnt.score(secrets.shape("0a1b2c3d4e5f" * 3)) > learnt.score("A" * 36)


def test_base_personal_data(spark):
    rng = random.Random(2)
    parts = ["a.b@c-d.org", "x@y.co_m@z.yy", "me@host", "1.2.3.4", "1.2.3.4.5", "256.1.1.1", "001.02.3.0255", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "378282246310005", "+49 (30) 123-45678", "+1.2", "+123456789012345678", "2024-01-02", "+44 20 7946 0958", "@", "+"]
    rows = noisy(rng, parts, "01259 .-+@()ab", 300) + [(900, None), (901, ""), (902, "9 " * 20_000), (903, "a" * 100_000), (904, "7" * 100_000)]
    rows += [(905, parts[0]), (905, parts[0]), (None, parts[3]), (None, parts[0])]
    got = personal_data.personal_data(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = {i: plain_personal(t or "") for i, t in rows if i is not None}
    for r in got:
        if r["doc_id"] is None:
            assert r["n_email"] + r["n_ip"] == 1
            continue
        spans = want[r["doc_id"]]
        assert r["base_sha256"] == digest(spans), r
        assert [r[f"n_{k}"] for k in personal_data.KINDS] == [sum(s.startswith(k) for s in spans) for k in personal_data.KINDS]
        assert set(spans) <= set(r["spans"].split(",") if r["spans"] else [])
    assert personal_data.personal_data(frame(spark, [])).count() == 0


def test_other_notations_are_judged(spark):
    rows = [(i, f"please mail person{i}@firm{i % 7}.com or call +49 30 1234{i:04d}, thanks") for i in range(200)]
    rows += [(500, "mail jane.doe [at] firm3 [dot] com today"), (501, "nothing of the kind, 12 of 300 pages")]
    got = {r["doc_id"]: r for r in personal_data.personal_data(frame(spark, rows)).collect()}
    assert got[500]["spans"] == "email:5:34" and got[500]["n_added"] == 1 and got[500]["n_email"] == 0
    assert got[501]["spans"] == ""


def test_many_matches_in_a_long_text(spark):
    """Two million characters of numbers, with spans at places that only counting from the beginning gives."""
    rng = random.Random(1)
    numbers = ", ".join(str(rng.randrange(10, 99999)) for _ in range(290_000))
    rows = [(1, f"{numbers} x@y.org {numbers[:3000]}"), (2, "é😀" * 700 + " a.b@c.org,😀 10.0.0.1"), (3, "😀" * 511 + "a@b.co")]
    began = time.monotonic()
    got = {r["doc_id"]: r["spans"] for r in personal_data.personal_data(frame(spark, rows)).collect()}
    assert time.monotonic() - began < 120
    assert got == {1: f"email:{len(numbers) + 1}:{len(numbers) + 8}", 2: "email:1401:1410,ip:1413:1421", 3: "email:511:517"}


def test_expectation_maximisation_recovers_reliabilities():
    rng = random.Random(5)
    accuracy = [0.95, 0.85, 0.7, 0.55]
    counts = {}
    for _ in range(20_000):
        truth = rng.random() < 0.4
        votes = tuple((1 if truth == (rng.random() < a) else -1) for a in accuracy)
        counts[votes] = counts.get(votes, 0) + 1
    prior, tables = personal_data.reliabilities(sorted(counts.items()), rounds=200)
    assert abs(prior - 0.4) < 0.05
    for table, a in zip(tables, accuracy):
        assert abs(table[1][1] - a) < 0.06 and abs(table[-1][0] - a) < 0.06


def plain_windows(docs, items):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    result = []
    for _, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        result.append((len(w), len(hit), sorted(found)))
    return result


@pytest.mark.parametrize("at_once", [decontaminate.BROADCAST_WINDOWS, 40])
def test_windows_equal_brute_force(spark, monkeypatch, at_once):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", at_once)
    for short in (False, True):
        rng = random.Random(7 + short)
        vocabulary = ["the", "of", "Ünder", "a1"] + [f"w{i}" for i in range(60)]
        draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
        items = [(i, draw(rng.randrange(13, 40))) for i in range(20)] + [(20, draw(13)), (21, [])]
        items += [(22, draw(2)), (23, draw(5)), (24, draw(5)), (25, ["w7"]), (26, draw(4)), (27, draw(12))] if short else []
        docs = []
        for i in range(200):
            w = draw(rng.randrange(0, 60))
            if i % 3 == 0:
                src = rng.choice(items)[1]
                a = rng.randrange(0, max(1, len(src) - 12))
                w = w + src[a : a + rng.randrange(5, 30)] + draw(5)
            docs.append((i, rng.choice([" ", ", ", "\n"]).join(w).upper() if i % 5 == 0 else "-".join(w)))
        docs += [(900, None), (901, ""), (902, " ".join(draw(5000))), (903, docs[0][1]), (903, docs[0][1])]
        items = [(i, " ".join(w)) for i, w in items] + [(30, None)]
        bench = spark.createDataFrame(items, "item_id long, text string")
        got = decontaminate.contamination(frame(spark, docs), bench).collect()
        want = {i: x for (i, _), x in zip(docs, plain_windows(docs, items))}
        assert len(got) == len(docs)
        for r in got:
            assert (r["n_words"], r["n_hit"], r["items"]) == want[r["doc_id"]], (short, r["doc_id"])


def test_clashing_columns(spark):
    passage = " ".join(f"q{i}" for i in range(20))
    bench = spark.createDataFrame([(1, passage, "x")], "item_id long, text string, win string")
    names = ["found_spans", "found_id", "found_h1", "h1", "h2", "words", "runs", "win", "length", "items"]
    docs = frame(spark, [(1, f"a {passage} b"), (2, "clean")]).selectExpr("*", *[f"'kept' AS {n}" for n in names])
    edited = decontaminate.remove_spans(docs, bench).collect()
    assert {r["doc_id"]: (r["text"], r["found_spans"], r["win"]) for r in edited} == {1: ("a b", "kept", "kept"), 2: ("clean", "kept", "kept")}
    assert [r["doc_id"] for r in decontaminate.remove_documents(docs, bench).collect()] == [2]


def test_contaminated_documents_and_spans_go(spark):
    passage = " ".join(f"q{i}" for i in range(20))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = frame(spark, [(1, f"Before, {passage.upper()}. After!"), (2, "clean text"), (3, None), (None, f"{passage} x"), (5, " ".join(f"w{i}" for i in range(500)) + " " + passage)])
    kept = decontaminate.remove_documents(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "5"]
    edited = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, bench).collect()}
    assert edited[1] == "Before. After!" and edited[2] == "clean text" and edited[3] is None and edited[None] == " x"
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove_documents(docs, none).count() == 5
    assert decontaminate.contamination(frame(spark, []), bench).count() == 0
