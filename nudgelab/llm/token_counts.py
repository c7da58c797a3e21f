"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie with failure links. A node knows how many tokens a failing match pops
there, so a word is counted in one walk over its characters, without building pieces. The node
count follows the vocabulary, never the input.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nudgelab.llm.common import as_batch, id_and_text
from nudgelab.llm.words import pieces, split

#: More distinct words a piece shares than with the usual size.
PIECE_BYTES = 16_000_000
_NONE = -1


def load_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin a word and pieces that continue one, from a sentencepiece model.

    Control, unknown and byte pieces are left out. The file is read on the driver only.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    starts, others = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        (starts if piece[0] == "▁" else others).append(piece.lstrip("▁"))
    return [p for p in starts if p], [p for p in others if p]


@dataclass
class Automaton:
    """Transitions by (node, character); node 0 begins a word, node 1 continues it."""

    moves: dict[tuple[int, str], int]
    fail: list[int]
    pops: list[int]

    @classmethod
    def of(cls, starts: Iterable[str], others: Iterable[str]) -> Automaton:
        moves: dict[tuple[int, str], int] = {}
        token = [False, False]
        children: list[list[tuple[str, int]]] = [[], []]
        for root, pieces_ in ((0, starts), (1, others)):
            for piece in pieces_:
                node = root
                for c in piece:
                    if (node, c) not in moves:
                        moves[node, c] = len(token)
                        children[node].append((c, len(token)))
                        token.append(False)
                        children.append([])
                    node = moves[node, c]
                token[node] = True
        fail, pops = [_NONE] * len(token), [0] * len(token)
        queue = deque([0, 1])
        while queue:
            u = queue.popleft()
            for c, v in children[u]:
                queue.append(v)
                if token[v]:
                    fail[v], pops[v] = 1, 1
                    continue
                node, popped = fail[u], pops[u]
                while node != _NONE and (node, c) not in moves:
                    popped += pops[node]
                    node = fail[node]
                if node != _NONE:
                    fail[v], pops[v] = moves[node, c], popped
        return cls(moves, fail, pops)

    def count(self, word: str) -> int:
        """Tokens of a word, or 0 if it cannot be split into pieces."""
        moves, fail, pops = self.moves, self.fail, self.pops
        node, found = 0, 0
        for c in word:
            while (following := moves.get((node, c), _NONE)) == _NONE:
                found += pops[node]
                node = fail[node]
                if node == _NONE:
                    return 0
            node = following
        while node != 1:
            found += pops[node]
            node = fail[node]
            if node == _NONE:
                return 0
        return found


def token_counts(
    docs: DataFrame, vocabulary: tuple[list[str], list[str]], id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Return (doc_id, n_words, n_tokens, n_unknown), one row per row of ``docs``.

    Words end at white space and keep their case. A word that the vocabulary cannot spell is one
    unknown token. Null and empty texts have no tokens; null ids and repeated rows are answered
    like any other; other columns are not read. Each distinct word of a piece is walked once.
    """
    built = Automaton.of(*vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((built.moves, built.fail, built.pops))
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_tokens", "n_unknown")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(*shared.value)
        for piece in pieces(batches, "text", PIECE_BYTES):
            words = split(piece.column("text"), lower=False)
            known = [
                automaton.count(w.decode("utf-8", "replace")) for w in words.vocabulary.to_pylist()
            ]
            tokens = np.array(known, dtype=np.int64)[words.codes]
            unknown = tokens == 0
            total = np.concatenate([[0], np.cumsum(tokens + unknown)])[words.bounds]
            lost = np.concatenate([[0], np.cumsum(unknown)])[words.bounds]
            yield as_batch(
                {
                    "doc_id": piece.column("doc_id"), "n_words": np.diff(words.bounds),
                    "n_tokens": np.diff(total), "n_unknown": np.diff(lost),
                },
                schema,
            )

    kinds = "doc_id long, n_words long, n_tokens long, n_unknown long"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, kinds)


def total_tokens(counts: DataFrame) -> DataFrame:
    """One row with the sums over all documents; 0 for an empty table."""
    return counts.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_words", "n_tokens", "n_unknown")]
    )
