"""Word-piece counts by a linear longest-match automaton.

The vocabulary is a trie, one for pieces that start a word and one for pieces that continue it.
Every node has a failure link, and the number of pieces popped on the way along it: where the
longest match from here is known to end, those pieces are done and matching goes on behind them
(Song et al., 2021). A word's number of greedy longest-match pieces so comes from one pass over its
characters; pieces are never built.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from swipeline.llm.common import batches_of

_ROOT, _REST = 0, 1


class Automaton:
    """Counts pieces of words over ``first`` (pieces that start a word) and ``rest`` (that continue it)."""

    def __init__(self, first: Iterable[str], rest: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        piece = [False, False]
        for root, pieces in ((_ROOT, first), (_REST, rest)):
            for p in pieces:
                node = root
                for c in p:
                    if c not in self.next[node]:
                        self.next[node][c] = len(self.next)
                        self.next.append({})
                        piece.append(False)
                    node = self.next[node][c]
                if p:
                    piece[node] = True
        # fail[v]: the node of what follows the pieces popped from v's string; None if it can't be done.
        self.fail: list[int | None] = [None] * len(self.next)
        self.popped = [0] * len(self.next)
        queue = deque((c, n, root) for root in (_ROOT, _REST) for c, n in self.next[root].items())
        while queue:
            c, node, above = queue.popleft()
            if piece[node]:
                self.fail[node], self.popped[node] = _REST, 1
            else:
                at, n = self.fail[above], self.popped[above]
                while at is not None and c not in self.next[at]:
                    n += self.popped[at]
                    at = self.fail[at]
                if at is not None:
                    self.fail[node], self.popped[node] = self.next[at][c], n
            queue.extend((d, m, node) for d, m in self.next[node].items())

    def count(self, word: str) -> int:
        """The number of pieces; 0 for an empty word, 1 (unknown) where no greedy split exists."""
        if not word:
            return 0
        node, n = _ROOT, 0
        for c in word:
            while c not in self.next[node]:
                n += self.popped[node]
                node = self.fail[node]
                if node is None:
                    return 1
            node = self.next[node][c]
        while node != _REST:
            n += self.popped[node]
            node = self.fail[node]
            if node is None:
                return 1
        return n


@lru_cache(maxsize=2)
def automaton_of(model: str) -> Automaton:
    """The automaton over the pieces of a sentence-piece model.

    Pieces with the mark of a word's start start a word, the others continue it; control, unknown
    and byte pieces are left out.
    """
    from sentencepiece import SentencePieceProcessor

    held = SentencePieceProcessor(model_file=model)
    pieces = [
        held.id_to_piece(i)
        for i in range(held.vocab_size())
        if not (held.is_control(i) or held.is_unknown(i) or held.is_byte(i))
    ]
    mark = "▁"
    return Automaton([p[1:] for p in pieces if p.startswith(mark)], [p for p in pieces if mark not in p])


def counts(texts: list[str | None], automaton: Automaton, known: dict[str, int], room: int = 200_000) -> list[tuple[int, int]]:
    """(words, pieces) of whole texts; ``known`` keeps counts of words, beyond ``room`` it starts anew."""
    split = [(t or "").split() for t in texts]
    if len(known) > room:
        known.clear()
    for word in set().union(*split).difference(known):
        known[word] = automaton.count(word)
    find = known.__getitem__
    return [(len(words), sum(map(find, words))) for words in split]


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_words, n_tokens of every row's whole text.

    Words are separated by white space. A word that greedy longest match can't split is one unknown
    token. A null or empty text has no tokens. Rows count each; an empty table gives no rows; other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = automaton_of(model), {}
        for whole in batches:
            for batch in batches_of(whole, "text", 2 << 20):
                found = np.array(counts(batch.column("text").to_pylist(), automaton, known), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(found[:, 0]), pa.array(found[:, 1])],
                    ["doc_id", "n_words", "n_tokens"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long")
