"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is cut where no piece can reach across: before each run of spaces and around each newline (checked against the
vocabulary when it is loaded). Inside a cut, an agenda of adjacent symbol pairs, ordered by score and then by
position, merges the best pair first. Cuts repeat, so their ids and decoded texts are kept in a bounded memo. In each
Arrow batch the cuts that are new to the worker are also encoded and decoded by the sentencepiece library; a difference
ends the job. Cuts of over 200 characters aren't kept, so they are encoded and compared each time that they occur.

Null text is the empty text. An empty text has only the begin and end ids. Texts of any length are encoded whole.
"""

from __future__ import annotations

import array
import functools
import hashlib
import heapq
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from offerloom.llm.common import Memo

SPACE = "▁"


class PieceModel:
    """Vocabulary and scores of a merge-type model, read through the library."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.ids, self.score, self.byte_ids, self.text_of = {}, {}, {}, {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece], self.score[piece], self.text_of[i] = i, sp.get_score(i), piece.replace(SPACE, " ")
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids):
            raise ValueError("a piece reaches across a space or a newline; this vocabulary can't be cut into words")
        self.spaced: Memo = Memo(lambda word: self._of(" " + word))
        self.bare: Memo = Memo(self._of)
        self.new: list[tuple[str, bytes, str]] = []
        self.before = sp.encode("\n")  # nothing reaches across a newline, so a cut behind one is encoded by itself

    def merge(self, cut: str) -> list[str]:
        """Symbols left when no adjacent pair is a piece any more; the highest score merges first, the leftmost on ties.

        The agenda of a short cut is a plain list of the pairs' scores; that of a long one is a heap.
        """
        symbols, score = list(cut), self.score
        if len(symbols) > 48:
            return self._merge_long(symbols)
        get, none = score.get, -math.inf
        agenda = [get(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = max(agenda)
            if best == none:
                break
            i = agenda.index(best)
            symbols[i] += symbols[i + 1]
            del symbols[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = get(symbols[i] + symbols[i + 1], none)
            if i:
                agenda[i - 1] = get(symbols[i - 1] + symbols[i], none)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        n, score = len(symbols), self.score
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []

        def add(left: int, right: int) -> None:
            pair = symbols[left] + symbols[right]
            if pair in score:
                heapq.heappush(agenda, (-score[pair], left, right, pair))

        for i in range(n - 1):
            add(i, i + 1)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            if not symbols[left] or after[left] != right or symbols[left] + symbols[right] != pair:
                continue  # one of the two has been merged meanwhile
            symbols[left], symbols[right] = pair, ""
            after[left] = right = after[right]
            if right < n:
                before[right] = left
                add(left, right)
            if before[left] >= 0:
                add(before[left], left)
        return [s for s in symbols if s]

    def encode_cut(self, cut: str) -> list[int]:
        """cut: spaces written as spaces. Symbols outside the vocabulary become their UTF-8 bytes' ids."""
        get, out = self.ids.get, []
        for symbol in self.merge(cut.replace(" ", SPACE)):
            i = get(symbol)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in symbol.encode()]
            else:
                out.append(self.unk)
        return out

    def decode_ids(self, ids: list[int]) -> str:
        """Pieces' texts one after another; runs of byte ids become the characters that they spell."""
        try:
            return "".join([self.text_of[i] for i in ids])
        except KeyError:
            pass
        out, spelled = [], bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                spelled.append(self.byte_of[i])
                continue
            out.append(spelled.decode(errors="replace"))
            spelled.clear()
            if i is not None:
                out.append(self.text_of.get(i, " ⁇ "))
        return "".join(out)

    def _of(self, cut: str) -> tuple[bytes, str]:
        """A cut's ids (unsigned 32-bit) and the text that they decode to."""
        ids = self.encode_cut(cut)
        out = array.array("I", ids).tobytes(), self.decode_ids(ids)
        self.new.append((cut, *out))
        return out

    def differences(self) -> int:
        """How many of the cuts computed since the last call the library encodes or decodes otherwise."""
        new, self.new = self.new, []
        theirs = self.library.encode(["\n" + cut for cut, *_ in new], num_threads=1)
        texts = self.library.decode(theirs, num_threads=1) if new else []
        n = len(self.before)
        return sum(
            (their[:n], array.array("I", their[n:]).tobytes(), text) != (self.before, ids, "\n" + decoded) for (_, ids, decoded), their, text in zip(new, theirs, texts)
        )

    def cuts(self, text: str) -> list[tuple[bytes, str]]:
        """Ids and text of each cut; a space is put before the text first."""
        if not text:
            return []
        out, spaced, bare = [], self.spaced.__getitem__, self.bare.__getitem__
        for k, line in enumerate(text.replace(SPACE, " ").split("\n")):
            if k:
                out.append(bare("\n"))
            words = line.split(" ")
            if "" in words and line or not (line or k):  # runs of spaces
                out += [spaced(c[1:]) if c[0] == " " else bare(c) for c in _CUTS.findall(line if k else " " + line)]
            elif line:
                out.append(bare(words[0]) if k else spaced(words[0]))
                out += map(spaced, words[1:])
        return out

    def encode(self, text: str) -> list[int]:
        return array.array("I", b"".join([c[0] for c in self.cuts(text)])).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.decode_ids(ids)[1:]


_CUTS = re.compile(r" *[^ ]+| +")


@functools.lru_cache(maxsize=2)
def _model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_and_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the number of ids with begin and end, and hashes of the ids and of the decoded text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        begin, end = (i.to_bytes(4, "little") for i in (model.bos, model.eos))
        for batch in batches:
            model.spaced.trim(), model.bare.trim()
            n, ids_hash, text_hash = [], [], []
            for text in batch.column(1).to_pylist():
                cuts = model.cuts(text or "")
                ids = b"".join((begin, *[c[0] for c in cuts], end))
                n.append(len(ids) // 4)
                ids_hash.append(hashlib.sha256(ids).hexdigest())
                text_hash.append(hashlib.sha256("".join([c[1] for c in cuts])[1:].encode()).hexdigest())
            if differ := model.differences():
                raise ValueError(f"agenda and library differ in {differ} words")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())], names)

    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
