"""Personal data in texts by weak supervision, with DataFrame functions only.

Patterns propose spans. Four labelers vote on each for, against or not at all: its shape (regex),
lists of known parts (gazetteer), cue words before it and the characters beside it (context).
Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is for
each kind, without any labelled text. The posteriors then train the span classifier, naive Bayes over
the votes, the length and the form of a span. A span that passes a base pattern and its check is
always reported; the classifier decides on spans in other notations.

Only counts of vote patterns and forms reach the driver; their number is fixed by the labelers
(3 votes, 4 labelers, ``LENGTHS`` and ``FORMS`` buckets, 4 kinds), whatever the size of the input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from terrier.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: Base patterns. A pattern is tried once per run of its characters, not from each of them, and loops
#: don't give back what they took; both leave the matches as they are and keep long texts linear.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Other notations, for the classifier to decide on: bracketed at and dot, eight-part addresses, national numbers.
#: A name has 64 characters at most, a label 63, a domain nine labels, as addresses have; addresses of fewer than
#: eight written parts aren't proposed.
OTHER = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9A-Za-z+(.-])\(?0[0-9]{1,4}\)?(?:[ ./-][0-9]{2,5}){2,5}(?![0-9A-Za-z])",
}
#: A cheap sign without which no pattern of the kind can match.
SIGN = {"email": "@|[\\[(] ?at ?[\\])]", "ip": "[0-9]\\.[0-9]|:[0-9A-Fa-f]{1,4}:", "card": "[0-9][ -]?[0-9]", "phone": "\\+[0-9]|0[0-9]"}

#: Gazetteers: common top-level domains, file endings that look like them, and country calling codes.
DOMAINS = "com org net edu gov int info biz io co eu uk us de fr es it nl be ch at pl pt se no dk fi ie ca au nz jp cn in br mx ru".split()
ENDINGS = "png jpg jpeg gif svg css js json html py txt md zip gz".split()
CALLING = (
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
    " 212 213 216 218 234 254 351 352 353 354 358 359 370 371 372 380 385 386 420 421 852 886 961 962 966 971 972"
).split()
CARD_RANGES = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6011|65|64|62|35)"
CUES = {
    "email": r"e-?mail|contact|write|courriel|correo|schreib|@",
    "ip": r"\bip\b|ipv[46]|address|adresse|direcci|host|server|client|login|from",
    "card": r"card|visa|master|amex|credit|debit|karte|carte|tarjeta|payment|pay",
    "phone": r"phone|tel|call|mobile|cell|fax|whatsapp|ring|anruf|appel|llama|number",
}
COUNTER_CUES = r"version|\bv[0-9.]*$|release|build|isbn|issn|order|invoice|serial|sha|hash|commit|token|\bid\b|ref"
LABELERS = ("shape", "listed", "cue", "edge")
LENGTHS, FORMS = 6, 32
#: Characters before a span in which cue words count.
REACH = 40
#: Characters of the pieces into which a text is cut to look around its spans; more than ``REACH``.
PIECE = 512
#: Matches whose places are summed up together.
MATCHES_AT_ONCE = 256
#: A span in another notation is reported from this probability on.
THRESHOLD = 0.5


def _spans(text: Column, pattern: str) -> Column:
    """``[{start, value}]`` of the leftmost non-overlapping matches; start in code points from 0.

    Starts are summed up block by block, and the blocks' starts over the blocks: an array that grows by one
    element is copied each time, and so stays short.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = _let(
        found,
        lambda values: F.zip_with(
            F.slice(between, F.lit(1), F.size(values)),
            values,
            lambda gap, value: F.struct(F.length(gap).alias("gap"), F.length(value).alias("length"), value.alias("value")),
        ),
    )
    none = F.array().cast("array<int>")

    def starts(summed: Column) -> Column:
        return F.aggregate(
            summed,
            F.struct(F.lit(0).alias("at"), none.alias("starts")),
            lambda acc, block: F.struct(
                (acc["at"] + block["at"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")
            ),
            lambda acc: acc["starts"],
        )

    def moved(summed: Column) -> Column:
        return F.zip_with(
            summed,
            starts(summed),
            lambda block, at: F.transform(block["spans"], lambda s: F.struct((at + s["start"]).alias("start"), s["value"].alias("value"))),
        )

    blocks = _let(pairs, lambda p: F.transform(_every(F.size(p)), lambda first: F.slice(p, first, MATCHES_AT_ONCE)))
    return F.flatten(_let(F.transform(blocks, _within_block), moved))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it occurs in it, also within functions of elements."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _every(n: Column) -> Column:
    """1, 1 + ``MATCHES_AT_ONCE``, ... up to ``n``."""
    return F.when(n > 0, F.sequence(F.lit(1), n, F.lit(MATCHES_AT_ONCE))).otherwise(F.array().cast("array<int>"))


def _within_block(pairs: Column) -> Column:
    """Length of a block of matches and the gaps before them, and its matches with their places in it."""
    none = F.array().cast("array<struct<start:int,value:string>>")
    return F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + p["length"]).alias("at"),
            F.concat(acc["spans"], F.array(F.struct((acc["at"] + p["gap"]).alias("start"), p["value"].alias("value")))).alias("spans"),
        ),
    )


def _around(pieces: Column, span: Column) -> tuple[Column, Column]:
    """The ``REACH`` characters before a span in lower case and the one after it, out of the text's pieces.

    A character of a long text is only found by counting from its beginning, so spans look into short pieces.
    """
    start, end = span["start"], span["start"] + F.length(span["value"])
    piece = lambda at: F.coalesce(F.get(pieces, at), F.lit(""))
    number = lambda at: F.floor(at / PIECE).cast("int")
    ahead = F.concat(piece(number(start) - 1), F.substring(piece(number(start)), F.lit(1), start % PIECE))
    return F.lower(F.right(ahead, F.lit(REACH))), F.substring(piece(number(end)), end % PIECE + 1, F.lit(1))


def _passes_luhn(digits: Column) -> Column:
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(d.try_cast("int") * 2 - F.when(d >= "5", 9).otherwise(0)),
    )
    return F.aggregate(F.filter(doubled, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    """The check a match of the kind's base pattern must pass."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _passes_luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def _votes(kind: str) -> dict[str, Column]:
    value, passed = F.col("value"), F.col("passed")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "email":
        last = F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1))
        shape = _vote(last.rlike("^[a-z]{2,}$"), last.rlike("^[0-9-]") | value.contains(".."))
        listed = _vote(last.isin(DOMAINS), last.isin(ENDINGS))
    elif kind == "ip":
        first = F.regexp_extract(value, r"^([0-9]{1,3})\.", 1).try_cast("int")
        shape = _vote(passed | value.contains(":"), ~passed | value.rlike(r"(?:^|\.)0[0-9]"))
        listed = _vote(first.between(1, 223) & (first != 127), (first == 0) | (first == 127) | (first > 223))
    elif kind == "card":
        shape, listed = _vote(passed, ~passed), _vote(digits.rlike(CARD_RANGES), ~digits.rlike(CARD_RANGES))
    else:
        code = F.lit(False)
        for width in (1, 2, 3):
            code = code | F.substring(digits, 1, width).isin([c for c in CALLING if len(c) == width])
        shape = _vote(F.length(digits).between(9, 15), ~F.length(digits).between(9, 15))
        listed = F.when(value.startswith("+"), _vote(code, ~code)).otherwise(F.lit(0))
    cue = _vote(F.col("before").rlike(CUES[kind]), F.col("before").rlike(COUNTER_CUES))
    beside = F.col("before").rlike(r"[\p{L}\p{N}_]$") | F.col("after").rlike(r"^[\p{L}\p{N}_]")
    return {"shape": shape, "listed": listed, "cue": cue, "edge": _vote(~beside, beside)}


def _labelled(kind: str, base: bool, pieces: Column):
    def label(s: Column) -> Column:
        before, after = _around(pieces, s)
        place = [F.lit(kind).alias("kind"), F.lit(base).alias("base"), s["start"].alias("start"), s["value"].alias("value")]
        return F.struct(*place, before.alias("before"), after.alias("after"))

    return label


def _looking_around(text: Column, pattern: str, kind: str, base: bool):
    return lambda pieces: F.transform(_spans(text, pattern), _labelled(kind, base, pieces))


def _count(kind: str) -> Column:
    return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def candidates(docs: DataFrame) -> DataFrame:
    """Proposed spans of ``docs (doc_id, h1, h2, text)`` with the labelers' votes and the classifier's features."""
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    text, form = F.col("text"), "struct<kind:string,base:boolean,start:int,value:string,before:string,after:string>"
    parts = []
    for kind in KINDS:
        for base, patterns in ((True, BASE), (False, OTHER)):
            if kind in patterns:
                found = _let(pieces, _looking_around(text, patterns[kind], kind, base))
                none = F.array().cast(f"array<{form}>")
                parts.append(F.when(text.rlike(SIGN[kind]), found).otherwise(none))
    spans = docs.select("doc_id", "h1", "h2", F.explode(F.concat(*parts)).alias("s")).select("doc_id", "h1", "h2", "s.*")
    spans = spans.withColumn("end", F.col("start") + F.length("value"))
    passed = votes = None
    for kind in KINDS:
        here = F.col("kind") == kind
        passed = F.when(here, _passes(kind, F.col("value"))) if passed is None else passed.when(here, _passes(kind, F.col("value")))
    spans = spans.withColumn("passed", F.col("base") & passed)
    for name in LABELERS:
        vote = None
        for kind in KINDS:
            ballot = _votes(kind)[name]
            vote = F.when(F.col("kind") == kind, ballot) if vote is None else vote.when(F.col("kind") == kind, ballot)
        spans = spans.withColumn(name, vote)
    shape = F.regexp_replace(F.regexp_replace("value", "[0-9]+", "9"), r"\p{L}+", "a")
    return spans.select(
        "doc_id",
        "h1",
        "h2",
        "kind",
        "base",
        "passed",
        "start",
        "end",
        *LABELERS,
        F.least(F.lit(LENGTHS - 1), F.floor(F.length("value") / 6)).cast("int").alias("size"),
        F.pmod(F.xxhash64(shape), F.lit(FORMS)).cast("int").alias("form"),
    )


def reliabilities(counted: list[tuple[tuple[int, ...], float]], rounds: int = 50) -> tuple[float, list[dict[int, list[float]]]]:
    """Prior of a true span, and for each labeler ``{vote: [P(vote | false), P(vote | true)]}``.

    Expectation-maximisation on ``(votes, count)`` from the start that the sum of the votes is right.
    """
    odds = [1 / (1 + math.exp(-2.0 * sum(votes))) for votes, _ in counted]
    width = len(counted[0][0]) if counted else 0
    prior, tables = 0.5, []
    for _ in range(rounds):
        yes = sum(n * p for (_, n), p in zip(counted, odds))
        total = sum(n for _, n in counted)
        prior = (yes + 1) / (total + 2)
        tables = []
        for i in range(width):
            seen = {v: [1.0, 1.0] for v in (-1, 0, 1)}
            for (votes, n), p in zip(counted, odds):
                seen[votes[i]][0] += n * (1 - p)
                seen[votes[i]][1] += n * p
            sums = [sum(x[k] for x in seen.values()) for k in (0, 1)]
            tables.append({v: [x[0] / sums[0], x[1] / sums[1]] for v, x in seen.items()})
        odds = [posterior(prior, tables, votes) for votes, _ in counted]
    return prior, tables


def posterior(prior: float, tables: list[dict[int, list[float]]], votes: tuple[int, ...]) -> float:
    log_odds = math.log(prior / (1 - prior)) + sum(math.log(t[v][1] / t[v][0]) for t, v in zip(tables, votes))
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, log_odds))))


def train(patterns: list[Row]) -> dict[str, float]:
    """Weights of the span classifier, by ``kind/feature/value``, from the counts of the votes and features."""
    weights: dict[str, float] = {}
    for kind in KINDS:
        rows = [r for r in patterns if r["kind"] == kind]
        ballots: dict[tuple[int, ...], float] = {}
        for r in rows:
            votes = tuple(r[x] for x in LABELERS)
            ballots[votes] = ballots.get(votes, 0) + r["n"]
        prior, tables = reliabilities(sorted(ballots.items()))
        total, seen = [1.0, 1.0], {}
        for r in rows:
            p = posterior(prior, tables, tuple(r[x] for x in LABELERS))
            for k, share in enumerate((1 - p, p)):
                total[k] += r["n"] * share
                for name in (*LABELERS, "size", "form"):
                    seen.setdefault((name, r[name]), [1.0, 1.0])[k] += r["n"] * share
        weights[f"{kind}/prior/"] = math.log(total[1] / total[0])
        for (name, value), (no, yes) in seen.items():
            weights[f"{kind}/{name}/{value}"] = math.log(yes / (total[1] + 2)) - math.log(no / (total[0] + 2))
    return weights


def probability(weights: dict[str, float]) -> Column:
    """The classifier's probability that a candidate is personal data."""
    table = F.create_map(*[F.lit(x) for item in sorted(weights.items()) for x in item])
    features = [F.concat(F.col("kind"), F.lit("/prior/"))]
    features += [F.concat(F.col("kind"), F.lit(f"/{name}/"), F.col(name).cast("string")) for name in (*LABELERS, "size", "form")]
    total = sum((F.coalesce(F.try_element_at(table, f), F.lit(0.0)) for f in features), F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, base spans per kind, their digest, all spans, ``n_added``.

    Spans are ``kind:start:end`` in code points, the end exclusive, ordered by start and kind. Null
    and empty texts have none; repeated rows and rows without id get a row each; other columns are
    ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), text.alias("text")
    )
    proposed = materialize(candidates(source), "pii-candidates")
    # Vote patterns and features: a bounded table by construction.
    patterns = proposed.groupBy("kind", *LABELERS, "size", "form").agg(F.count("*").alias("n")).collect()
    weights = train(patterns)
    base = F.col("base") & F.col("passed")
    judged = proposed.where("base = passed").withColumn("p", F.when(base, 1.0).otherwise(probability(weights)))
    span = F.struct(
        "start", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("order"), "end", "kind", "base"
    )
    per_text = (
        judged.where(F.col("p") >= THRESHOLD)
        .groupBy(F.col("doc_id").alias("d"), F.col("h1").alias("a"), F.col("h2").alias("b"))
        .agg(F.sort_array(F.collect_set(span)).alias("all"))
    )
    is_base = F.filter("all", lambda s: s["base"])
    # A span in another notation inside a base span of its kind adds nothing.
    added = F.filter(
        "all",
        lambda s: s["base"]
        | ~F.exists(is_base, lambda o: (o["kind"] == s["kind"]) & (o["start"] < s["end"]) & (s["start"] < o["end"])),
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b"))
    none = F.array().cast("array<struct<start:int,order:bigint,end:int,kind:string,base:boolean>>")
    rows = source.drop("text").join(per_text, same, "left").select(
        "doc_id", F.coalesce(is_base, none).alias("base_spans"), F.coalesce(added, none).alias("all_spans")
    )
    return rows.select(
        "doc_id",
        *map(_count, KINDS),
        F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"),
        _joined(F.col("all_spans")).alias("spans"),
        (F.size("all_spans") - F.size("base_spans")).cast("long").alias("n_added"),
    )
