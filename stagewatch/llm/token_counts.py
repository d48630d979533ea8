"""Token counts of a unigram model by dynamic programming that is shared along a trie.

The distinct pre-tokens of a stretch of text go into a trie.  The forward score of a node (the best score of any segmentation
of its prefix) depends on the nodes above it only, so it is computed once however many pre-tokens share the prefix; at
terminal nodes the token count of the best segmentation is stored.  The trie is walked depth first in sorted order, so only
the path to the current node is in memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewatch.llm.common import as_bytes

MARK = "▁"
#: Pre-tokens whose counts a task remembers, and bytes of text whose pre-tokens are put into one trie.
REMEMBERED = 400_000
TRIE_BYTES = 4 << 20
#: Bytes beyond which a pre-token is counted anew each time, so that what is remembered is bounded in bytes too.
LONG_WORD = 200
UNKNOWN_PENALTY = 10.0


def zipf_scores(model_file: str) -> dict[str, float]:
    """Log probabilities of the file's ordinary pieces: the piece of rank r has weight 1 / r (the file has ranks only)."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return {piece: -math.log(rank) - total for rank, piece in enumerate(pieces, 1)}


class TrieCounter:
    """Token counts and scores of pre-tokens under a unigram model with byte fallback."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        self.longest = max(map(len, scores))
        #: A character that no piece stands for costs this much and becomes one token per UTF-8 byte.
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY

    def extend(self, word: str, n: int, best: list[float], tokens: list[int]) -> None:
        """Append the forward score of the first ``n`` characters to those of fewer; ties take fewer tokens."""
        scores, last = self.scores, word[n - 1]
        top, count = best[n - 1] + self.unknown, tokens[n - 1] + len(last.encode())
        if last in scores:
            top = -math.inf
        for start in range(max(0, n - self.longest), n):
            score = scores.get(word[start:n])
            if score is not None:
                score += best[start]
                if score > top or score == top and tokens[start] < count - 1:
                    top, count = score, tokens[start] + 1
        best.append(top)
        tokens.append(count)

    def counts(self, pre_tokens: list[str]) -> list[tuple[int, float]]:
        """Terminal (tokens, score) of sorted, distinct pre-tokens: a depth-first walk of their trie."""
        out: list[tuple[int, float]] = []
        best, tokens, path = [0.0], [0], ""
        for word in pre_tokens:
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del best[shared + 1:], tokens[shared + 1:]
            for stop in range(shared + 1, len(word) + 1):
                self.extend(word, stop, best, tokens)
            path = word
            out.append((tokens[-1], best[-1]))
        return out


def token_report(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens, score (sum of the pre-tokens' best log probabilities) per row.

    A pre-token is a word (a run of anything but ASCII white space) behind a word mark.  A null or empty text has none: 0
    tokens, score 0.  Repeated rows count each; no rows in, no rows out.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    scores = docs.sparkSession.sparkContext.broadcast(zipf_scores(model_file))  # one vocabulary: some 32,000 pieces

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TrieCounter(scores.value)
        known: dict[bytes, tuple[int, float]] = {}

        def counted(texts: list[list[bytes]]) -> Iterator[tuple[int, int, float]]:
            new = set().union(*texts).difference(known)
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = set().union(*texts)
            by_text = sorted((MARK + w.decode(), w) for w in new)
            long: dict[bytes, tuple[int, float]] = {}
            for (_, w), result in zip(by_text, counter.counts([t for t, _ in by_text])):
                (known if len(w) <= LONG_WORD else long)[w] = result
            for words in texts:
                found = [known.get(w) or long[w] for w in words]
                yield len(words), sum(n for n, _ in found), math.fsum(s for _, s in found)

        for batch in batches:
            out: list[tuple[int, int, float]] = []
            held: list[list[bytes]] = []
            size = 0
            for text in as_bytes(batch.column(1)):
                held.append((text or b"").split())
                size += len(text or b"")
                if size >= TRIE_BYTES:
                    out += counted(held)
                    held, size = [], 0
            out += counted(held)
            columns = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))]],
                ["doc_id", "n_words", "n_tokens", "score"],
            )

    return rows.mapInArrow(report, f"doc_id {kind}, n_words bigint, n_tokens bigint, score double")
