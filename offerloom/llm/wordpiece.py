"""Token counts by a linear longest-match automaton.

The vocabulary becomes a trie with two roots, one for pieces that begin a word and one for pieces that go on. Each node
has a failure link (where matching goes on after the longest pieces have been popped) and the number of pieces popped
on the way, computed once. Counting then reads each character once; no piece is built. A word that the vocabulary
cannot spell counts as one unknown token.

Null text is the empty text, with no words and no tokens. Words are runs without white space, of any length.
"""

from __future__ import annotations

import functools
import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from offerloom.llm.common import WORD_BREAK, Memo


class LongestMatch:
    """first: pieces that begin a word; later: pieces that go on."""

    BEGIN, GO_ON = 0, 1

    def __init__(self, first: Iterable[str], later: Iterable[str]):
        self.children: list[dict[str, int]] = [{}, {}]
        ends = set()
        for root, pieces in ((self.BEGIN, first), (self.GO_ON, later)):
            for piece in pieces:
                node = root
                for c in piece:
                    if c not in self.children[node]:
                        self.children[node][c] = len(self.children)
                        self.children.append({})
                    node = self.children[node][c]
                if piece:
                    ends.add(node)
        n = len(self.children)
        self.fail: list[int] = [-1] * n
        self.popped: list[int] = [0] * n
        queue = deque((self.BEGIN, self.GO_ON))
        while queue:
            parent = queue.popleft()
            for c, node in self.children[parent].items():
                queue.append(node)
                if node in ends:  # the longest match so far is the whole path: pop it and go on behind it
                    self.fail[node], self.popped[node] = self.GO_ON, 1
                    continue
                back, count = self.fail[parent], self.popped[parent]
                while back >= 0 and c not in self.children[back]:
                    count += self.popped[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[node], self.popped[node] = self.children[back][c], count

    def count(self, word: str) -> int:
        """The number of pieces of a greedy longest match; -1 if there is none."""
        children, fail, popped = self.children, self.fail, self.popped
        node = total = 0
        for c in word:
            while (nxt := children[node].get(c)) is None:
                if fail[node] < 0:
                    return -1
                total += popped[node]
                node = fail[node]
            node = nxt
        while node > self.GO_ON:
            if fail[node] < 0:
                return -1
            total += popped[node]
            node = fail[node]
        return total


@functools.lru_cache(maxsize=2)
def from_model(path: str) -> LongestMatch:
    """The pieces of a sentencepiece model: those with the word mark begin a word, the others go on."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    return LongestMatch([p[1:] for p in pieces if p[0] == "▁"], [p for p in pieces if "▁" not in p])


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, tokens (an unknown word is one) and unknown words."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, counts = re.compile(WORD_BREAK).split, Memo(from_model(model_path).count)
        for batch in batches:
            counts.trim()
            words, tokens, unknown = [], [], []
            for text in batch.column(1).to_pylist():
                each = [counts[w] for w in split(text or "") if w]
                words.append(len(each))
                unknown.append(each.count(-1))
                tokens.append(sum(each) + 2 * unknown[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))], [id_col, "n_words", "n_tokens", "n_unknown"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, n_words long, n_tokens long, n_unknown long")
