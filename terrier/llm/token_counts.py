"""Token counts under a unigram model, with forward scores shared by common prefixes.

The best segmentation of a pre-token's prefix doesn't depend on what follows. The distinct pre-tokens
of a block are therefore walked in sorted order, which is a depth-first walk of their trie: what they
share with the one before is on the stack already, and only the rest is computed. The count at the
end of a pre-token is stored, and documents add up the counts of theirs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text whose distinct pre-tokens form one trie; bounds a task's memory.
BLOCK_CHARS = 4_000_000
#: The mark before each pre-token.
MARK = "▁"
#: A character that is no piece costs so much more than the rarest piece, and counts as its UTF-8 bytes.
UNKNOWN_PENALTY = 10.0


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    """Log probabilities of pieces listed from frequent to rare, in inverse proportion to their rank."""
    total = math.log(sum(1 / (rank + 1) for rank in range(len(pieces))))
    scores: dict[str, float] = {}
    for rank, piece in enumerate(pieces):
        scores.setdefault(piece, -math.log(rank + 1) - total)
    return scores


def load_pieces(model_path: str) -> list[str]:
    """Ordinary pieces of a SentencePiece vocabulary file in the order of their ids."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not special(i)]


class UnigramCounter:
    """Counts tokens of pre-tokens; ties between segmentations go to the longer last piece."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.root: dict = {}
        for piece, score in scores.items():
            node = self.root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = score
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY

    def _step(self, state: tuple, c: str) -> tuple:
        """The state after one more character: best score, its tokens, and the pieces under way."""
        score, tokens, under_way = state
        best, count, still = None, 0, []
        for node, before, n in under_way:  # longest first
            node = node.get(c)
            if node is not None:
                still.append((node, before, n))
                value = node.get("")
                if value is not None and (best is None or before + value > best):
                    best, count = before + value, n + 1
        node = self.root.get(c)
        if node is not None:
            still.append((node, score, tokens))
            value = node.get("")
            if value is not None and (best is None or score + value > best):
                best, count = score + value, tokens + 1
        if best is None:
            best, count = score + self.unknown, tokens + len(c.encode("utf-8", "surrogatepass"))
        return best, count, still

    def count(self, pre_tokens: set[str]) -> dict[str, int]:
        """Tokens of each pre-token, the mark before it included."""
        start = self._step((0.0, 0, []), MARK)
        found, stack, last = {}, [start], ""
        for word in sorted(pre_tokens):
            shared = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                shared += 1
            del stack[shared + 1 :]
            state = stack[-1]
            for c in word[shared:]:
                state = self._step(state, c)
                stack.append(state)
            found[word] = state[1]
            last = word
        return found


def _counts(scores: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnigramCounter(scores)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            start = size = 0
            for i, text in enumerate(texts):
                size += len(text or "")
                if size < BLOCK_CHARS and i + 1 < len(texts):
                    continue
                words = [(t or "").split() for t in texts[start : i + 1]]
                distinct: set[str] = set()
                for w in words:
                    distinct.update(w)
                tokens = counter.count(distinct)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(words)),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array([sum(map(tokens.__getitem__, w)) for w in words], pa.int64()),
                    ],
                    ["doc_id", "n_pretokens", "n_tokens"],
                )
                start, size = i + 1, 0

    return run


def token_counts(docs: DataFrame, scores: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` of each row.

    Pre-tokens are the words between white space. Null and empty texts have none; repeated rows and
    rows without id get a row each; other columns are ignored; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_counts(scores), f"doc_id {kind}, n_pretokens long, n_tokens long")
