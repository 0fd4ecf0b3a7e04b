"""Secrets in texts: base patterns, and formats learnt from what they find.

The values the base patterns find are labelled credentials. For each kind, the prefix tree of a bounded
sample of them is reduced to a probabilistic automaton by merging states whose statistics are
compatible (Hoeffding bound, recursively). One more automaton is learnt from ordinary words. Every
other token that could be a credential is then scored by the likelihood of its format under each of
them, and reported where a kind explains it as well as it explains its own examples, and better than
ordinary words do.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.session import materialize

KINDS = ("assign", "access", "hex")
#: Expected number of labelled credentials per kind, and of ordinary words, from which automata are learnt.
SAMPLE = 600
#: Longer values are scored, but not learnt from.
LONGEST_EXAMPLE = 128
#: Confidence of the merge test.
ALPHA = 0.05
#: A kind's threshold is this quantile of its examples' likelihoods per character.
QUANTILE = 0.05

_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Tokens that could be a credential: long enough, with a digit and a letter.
_OTHER = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{6,}")
_KEYS = ("password", "passwd", "secret", "token", "api")


def _marks(characters: str) -> bytes:
    return bytes(120 if chr(b) in characters else 32 for b in range(256))


_HEX_MARKS = _marks("0123456789abcdef")
_OTHER_MARKS = _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, value)`` of the base matches; the value is what the keyword or format holds."""
    found = []
    lower = text.lower()
    if any(key in lower for key in _KEYS):
        found += [(m.start(), 0, m.end(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if b"x" * 24 in text.encode("utf-8", "surrogatepass").translate(_HEX_MARKS):
        found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def other_candidates(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """Tokens with a digit and a letter that meet no base span."""
    if b"x" * 20 not in text.encode("utf-8", "surrogatepass").translate(_OTHER_MARKS):
        return []
    found = []
    for m in _OTHER.finditer(text):
        value = m[0]
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            if not any(s < m.end() and m.start() < e for s, _, e, _ in base):
                found.append((m.start(), m.end(), value))
    return found


def shape(value: str) -> str:
    """Format of a value: letters a-f, other small letters, capitals and digits as classes, other characters as such."""
    return "".join(
        "d" if c.isdigit() else "h" if c in "abcdef" else "a" if c.islower() else "A" if c.isupper() else c for c in value
    )


class Automaton:
    """Probabilistic automaton by state merging on the prefix tree of labelled formats."""

    def __init__(self, examples: list[str], alpha: float = ALPHA) -> None:
        # Counts per state: arrivals, endings, and for each symbol the next state with its traversals.
        self.arrived, self.ended = [0], [0]
        self.next: list[dict[str, int]] = [{}]
        self.taken: list[dict[str, int]] = [{}]
        for example in examples:
            state = 0
            self.arrived[0] += 1
            for c in example:
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.taken[state][c] = 0
                    self.arrived.append(0)
                    self.ended.append(0)
                    self.next.append({})
                    self.taken.append({})
                self.taken[state][c] += 1
                state = self.next[state][c]
                self.arrived[state] += 1
            self.ended[state] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()

    def _differ(self, hits_a: int, n_a: int, hits_b: int, n_b: int) -> bool:
        if not n_a or not n_b:
            return False
        return abs(hits_a / n_a - hits_b / n_b) > self.bound * (1 / math.sqrt(n_a) + 1 / math.sqrt(n_b))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if self._differ(self.ended[a], self.arrived[a], self.ended[b], self.arrived[b]):
                return False
            for c in self.taken[a].keys() | self.taken[b].keys():
                if self._differ(self.taken[a].get(c, 0), self.arrived[a], self.taken[b].get(c, 0), self.arrived[b]):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Adds the counts of a subtree to the states it falls together with."""
        todo = [(into, tree)]
        while todo:
            a, b = todo.pop()
            self.arrived[a] += self.arrived[b]
            self.ended[a] += self.ended[b]
            for c, target in self.next[b].items():
                if c in self.next[a]:
                    self.taken[a][c] += self.taken[b][c]
                    todo.append((self.next[a][c], target))
                else:
                    self.next[a][c] = target
                    self.taken[a][c] = self.taken[b][c]

    def _merge_all(self) -> None:
        settled = [0]
        while True:
            settled_set = set(settled)
            open_edges = [(s, c) for s in settled for c in sorted(self.next[s]) if self.next[s][c] not in settled_set]
            if not open_edges:
                break
            state, c = max(open_edges, key=lambda e: self.taken[e[0]][e[1]])
            tree = self.next[state][c]
            for old in settled:
                if self._compatible(old, tree):
                    self.next[state][c] = old
                    self._fold(old, tree)
                    break
            else:
                settled.append(tree)
        number = {s: i for i, s in enumerate(settled)}
        self.arrived, self.ended = [self.arrived[s] for s in settled], [self.ended[s] for s in settled]
        self.taken = [self.taken[s] for s in settled]
        self.next = [{c: number[t] for c, t in self.next[s].items()} for s in settled]

    def score(self, value: str) -> float:
        """Log likelihood per character of a format; steps not seen in any example have a small share of each state."""
        state, total = 0, 0.0
        for c in value:
            seen = self.arrived[state]
            total += math.log((self.taken[state].get(c, 0) + 0.1) / (seen + 10))
            state = self.next[state].get(c, 0)
        return total / max(1, len(value))


def learn(examples: dict[str, list[str]]) -> dict[str, tuple[Automaton, float]]:
    """For each kind (and ``word``) with examples: its automaton and its threshold."""
    found = {}
    for kind, values in examples.items():
        shapes = [shape(v) for v in values]
        if shapes:
            automaton = Automaton(shapes)
            scores = sorted(automaton.score(s) for s in shapes)
            found[kind] = (automaton, scores[int(QUANTILE * len(scores))])
    return found


def kind_of(value: str, automata: dict[str, tuple[Automaton, float]]) -> tuple[str, float] | None:
    """The kind whose format explains a value best, or None if ordinary words do or no kind does well enough."""
    form = shape(value)
    scores = {kind: automaton.score(form) for kind, (automaton, _) in automata.items()}
    kinds = [k for k in KINDS if k in scores and scores[k] >= automata[k][1]]
    if not kinds:
        return None
    best = max(kinds, key=lambda k: scores[k])
    return (best, scores[best]) if scores[best] > scores.get("word", -math.inf) else None


_FOUND = (
    "doc_id {kind}, base array<struct<start:int,kind:int,end:int,value:string>>,"
    " other array<struct<start:int,end:int,value:string>>, word string"
)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))
    other_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))
    for batch in batches:
        bases, others, words = [], [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            base = base_spans(text)
            bases.append([dict(zip(("start", "kind", "end", "value"), s)) for s in base])
            others.append([dict(zip(("start", "end", "value"), s)) for s in other_candidates(text, base)])
            word = _WORD.search(text)
            words.append(word[0] if word and len(word[0]) <= LONGEST_EXAMPLE and not any(c.isdigit() for c in word[0]) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(bases, base_type), pa.array(others, other_type), pa.array(words, pa.string())],
            ["doc_id", "base", "other", "word"],
        )


def _examples(found: DataFrame) -> dict[str, list[str]]:
    """About ``SAMPLE`` distinct credentials per kind and ordinary words, drawn by a hash of the value."""
    labelled = found.select(F.explode("base").alias("s")).select(
        F.element_at(F.array(*map(F.lit, KINDS)), F.col("s.kind") + 1).alias("kind"), F.col("s.value").alias("value")
    )
    words = found.where("word IS NOT NULL").select(F.lit("word").alias("kind"), F.col("word").alias("value"))
    distinct = labelled.unionByName(words).where(F.length("value") <= LONGEST_EXAMPLE).distinct()
    shares = {r["kind"]: SAMPLE / r["n"] for r in distinct.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return {}
    share = F.try_element_at(F.create_map(*[F.lit(x) for kv in shares.items() for x in kv]), F.col("kind"))
    drawn = distinct.where(F.pmod(F.xxhash64("value"), F.lit(1_000_003)) < share * 1_000_003)
    rows = sorted((r["kind"], r["value"]) for r in drawn.collect())
    return {kind: [value for k, value in rows if k == kind] for kind in (*KINDS, "word")}


def _report(automata: dict[str, tuple[Automaton, float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base, other in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                spans = [(s["start"], s["kind"], s["end"], KINDS[s["kind"]]) for s in base]
                text = [f"{name}:{start}:{end}" for start, _, end, name in sorted(spans)]
                digest = hashlib.sha256(",".join(text).encode()).hexdigest()
                for s in other:
                    verdict = kind_of(s["value"], automata)
                    if verdict:
                        spans.append((s["start"], len(KINDS) + KINDS.index(verdict[0]), s["end"], f"like_{verdict[0]}"))
                every = ",".join(f"{name}:{start}:{end}" for start, _, end, name in sorted(spans))
                counts = [sum(s["kind"] == k for s in base) for k in range(len(KINDS))]
                rows.append((*counts, digest, every, len(spans) - len(base)))
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added"],
            )

    return run


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, base spans per kind, their digest, all spans, ``n_added``.

    Spans are ``kind:start:end`` in code points, the end exclusive, by start and kind; those found by
    format are of the kinds ``like_assign``, ``like_access`` and ``like_hex``, after the base kinds.
    Null and empty texts have none; repeated rows and rows without id get a row each; other columns
    are ignored; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    found = materialize(source.mapInArrow(_find, _FOUND.format(kind=kind)), "secret-candidates")
    automata = learn(_examples(found))
    return found.drop("word").mapInArrow(
        _report(automata),
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long",
    )
