"""Packing examples into training sequences: vector bin packing by the dot-product heuristic.

Every item is a vector (tokens, 1 segment, loss-bearing tokens), every open sequence has a vector of what is left. The
item that goes in next is the fitting one with the largest dot product of the two, each scaled by the limits; a sequence
is filled before the next one opens. Items wait in a window of bounded size within their partition, so nothing is
shuffled, no task holds more than its window, and the plan is the same for any number of rows.

`pack_examples` packs whole examples (instruction data). `pack_documents` may cut: full sequences are cut off first,
what remains of each document waits in the window, and an item that is too long for what is left is cut to fit. What
is left at the end of a partition is cut at powers of two, so that no sequence needs padding.
"""

from __future__ import annotations

import array
import functools
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.llm.common import Memo

#: A window holds this many waiting items; placing one costs a pass over the window.
WINDOW = 1024


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss: int = 2048

    def array(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], float)


def best_item(sizes: np.ndarray, left: np.ndarray, limits: np.ndarray, fit: bool = True) -> int:
    """The row of sizes with the largest dot product with what is left, -1 if none fits. Ties: the first row."""
    score = (sizes / limits) @ (left / limits)
    if fit:
        score = np.where((sizes <= left).all(axis=1), score, -1.0)
    k = int(score.argmax()) if len(score) else -1
    return k if k >= 0 and score[k] >= 0 else -1


def fill_one(sizes: np.ndarray, limits: np.ndarray) -> list[int]:
    """Rows for one sequence, in the order in which they go in."""
    left, waiting, chosen = limits.copy(), np.arange(len(sizes)), []
    while len(waiting) and (k := best_item(sizes[waiting], left, limits)) >= 0:
        chosen.append(int(waiting[k]))
        left -= sizes[waiting[k]]
        waiting = np.delete(waiting, k)
    return chosen


def pack_examples(examples: DataFrame, key_cols: list[str], tokens_col: str, loss_col: str, limits: Limits = Limits()) -> DataFrame:
    """Whole examples into sequences: the key columns, tokens and loss tokens, sequence_id, position and offset.

    Null counts are 0. An example beyond a limit fits no sequence: it comes back marked oversized, without one. Equal examples
    are packed one by one. An empty table gives no rows.
    """
    chosen = examples.select(*key_cols, F.coalesce(F.col(tokens_col), F.lit(0)).cast("long").alias("_tokens"), F.coalesce(F.col(loss_col), F.lit(0)).cast("long").alias("_loss"))
    names = [*key_cols, "n_tokens", "n_loss", "sequence_id", "position", "offset", "oversized"]
    schema = ", ".join(f"`{c}` {examples.schema[c].dataType.simpleString()}" for c in key_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most, sequence = limits.array(), TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        sizes = np.zeros((0, 3))

        def close(chosen: list[int]) -> list[tuple]:
            nonlocal sequence, rows, sizes
            out, offset = [], 0
            for position, k in enumerate(chosen):
                out.append((*rows[k], sequence, position, offset, False))
                offset += rows[k][-2]
            sequence += 1
            gone = set(chosen)
            rows = [r for i, r in enumerate(rows) if i not in gone]
            sizes = np.delete(sizes, chosen, axis=0)
            return out

        def packed(least: int) -> list[tuple]:
            out = []
            while len(rows) > least:
                out += close(fill_one(sizes, most))
            return out

        def table(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        types = None
        for batch in batches:
            types = [*(f.type for f in batch.schema), *[pa.int64()] * 3, pa.bool_()]
            out = []
            for start in range(0, batch.num_rows, WINDOW):
                more = [tuple(x.values()) for x in batch.slice(start, WINDOW).to_pylist()]
                fits = [r[-2] <= limits.tokens and r[-1] <= limits.loss and limits.segments > 0 for r in more]
                out += [(*r, None, None, None, True) for r, fit in zip(more, fits) if not fit]
                more = [r for r, fit in zip(more, fits) if fit]
                rows += more
                sizes = np.vstack([sizes, np.array([(r[-2], 1, r[-1]) for r in more], float).reshape(-1, 3)])
                out += packed(WINDOW)
            yield table(out)
        if rows:
            yield table(packed(0))

    return chosen.mapInArrow(run, f"{schema}, n_tokens long, n_loss long, sequence_id long, position long, offset long, oversized boolean")


class Recent(Memo):
    """A memo of two generations: what has been used since the last change is kept at the next."""

    def __init__(self, make: Callable[[str], object], limit: int = 500_000):
        super().__init__(make, limit)
        self.older: dict[str, object] = {}

    def __missing__(self, word: str):
        value = self.older.get(word)
        if value is None:
            return super().__missing__(word)
        self[word] = value
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()


#: A word of letters, maybe with marks after it: the vocabulary's pattern takes the letters (with the space before them) as one
#: piece and the marks as another, unless they begin with an apostrophe. Only letters that have been letters in every version of
#: Unicode, and no apostrophes.
_LETTERS_AND_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏА-я]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
#: A byte-level vocabulary writes bytes as visible characters: those that are so in Latin-1 stay, the others follow from U+0100 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


class ByteTokenizer:
    """Ids of a byte-level vocabulary by the tokenizers library, word by word from a bounded memo. A word that is one piece of the
    vocabulary's pattern goes to the library's model without that pattern, a text that holds a special token's string to the
    library as a whole."""

    def __init__(self, json_path: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(json_path)
        self.special = [t.content for t in library.get_added_tokens_decoder().values()]
        self.whole = lambda text: array.array("I", library.encode(text, add_special_tokens=False).ids).tobytes()
        self.model = library.model
        self.bare, self.spaced = Recent(lambda word: self.word("", word)), Recent(lambda word: self.word(" ", word))
        self.newline = self.whole("\n")

    def word(self, before: str, word: str) -> bytes:
        """Ids of a word after a space or nothing."""
        cut = _LETTERS_AND_MARKS(word)
        if not cut:
            return self.whole(before + word)
        letters, marks = cut.groups()
        if marks:
            return (self.spaced if before else self.bare)[letters] + self.bare[marks]
        shown = (before + letters).encode().decode("latin-1").translate(_SHOWN)
        return array.array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text or _odd_space(text) or any(s in text for s in self.special):
            return self.whole(text)
        out, spaced = [], self.spaced.__getitem__
        for line in text.split("\n"):
            words = line.split(" ")
            out.append(self.newline)
            out.append(self.bare[words[0]])
            out += map(spaced, words[1:])
        return b"".join(out[1:])


#: The vocabulary's pattern lets one space begin a word and takes other white space apart. Single inner spaces and newlines
#: are cut without it; a text with any of these goes to it as a whole.
_ODD_SPACE = ("  ", "\n\n", " \n", "\n ", *"\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def _odd_space(text: str) -> bool:
    return text[0] in " \n" or text[-1] in " \n" or any(map(text.__contains__, _ODD_SPACE))


@functools.lru_cache(maxsize=2)
def _tokenizer(json_path: str) -> ByteTokenizer:
    return ByteTokenizer(json_path)


@dataclass
class Item:
    """A document's ids from start on, as far as they wait."""

    key: object
    ids: memoryview
    start: int
    total: int

    def size(self) -> tuple[int, int, int]:
        return len(self.ids), 1, len(self.ids) - (self.start == 0)  # nothing comes before a document's first id to foretell it from


class DocumentPacker:
    """Cuts and packs the documents of one partition; add() and finish() give finished pieces."""

    def __init__(self, limits: Limits, first_sequence: int):
        self.limits, self.most, self.sequence = limits, limits.array(), first_sequence
        self.items: list[Item] = []
        self.sizes = np.zeros((WINDOW * 2, 3))

    def add(self, key: object, ids: bytes) -> list[tuple]:
        out, view = [], memoryview(ids).cast("I")
        item = Item(key, view, 0, len(view))
        while len(item.ids) >= self.limits.tokens:
            head, item = self.cut(item, self.limits.tokens)
            out += self.close([head])
        if len(item.ids):
            self.put(item)
        while len(self.items) > WINDOW:
            out += self.close(self.fill())
        return out

    def put(self, item: Item) -> None:
        self.sizes[len(self.items)] = item.size()
        self.items.append(item)

    def take(self, k: int) -> Item:
        """The last item takes the place of the one taken."""
        item, last = self.items[k], self.items.pop()
        if k < len(self.items):
            self.items[k], self.sizes[k] = last, self.sizes[len(self.items)]
        return item

    @staticmethod
    def cut(item: Item, n: int) -> tuple[Item, Item]:
        return Item(item.key, item.ids[:n], item.start, item.total), Item(item.key, item.ids[n:], item.start + n, item.total)

    def fill(self) -> list[Item]:
        """Items for one sequence; the last may be cut. At a limit on segments or loss, cut back to a power of two."""
        chosen, left = [], self.most.copy()
        while self.items and left.min() > 0:
            k = best_item(self.sizes[: len(self.items)], left, self.most)
            if k >= 0:
                item = self.take(k)
            else:
                k = best_item(self.sizes[: len(self.items)], left, self.most, fit=False)
                item, rest = self.cut(self.take(k), int(min(left[0], left[2])))
                self.put(rest)
            chosen.append(item)
            left -= item.size()
        n = sum(len(i.ids) for i in chosen)
        if n < self.limits.tokens:
            over = n - (1 << (n.bit_length() - 1))
            while over:
                item = chosen.pop()
                if len(item.ids) > over:
                    kept, item = self.cut(item, len(item.ids) - over)
                    chosen.append(kept)
                over -= len(item.ids)
                self.put(item)
        return chosen

    def close(self, items: list[Item]) -> list[tuple]:
        out, offset = [], 0
        for i in items:
            out.append((i.key, i.start, len(i.ids), zlib.crc32(i.ids), i.total, self.sequence, offset))
            offset += len(i.ids)
        self.sequence += 1
        return out

    def finish(self) -> list[tuple]:
        out = []
        while self.items:
            out += self.close(self.fill())
        return out


def with_lengths(turns: DataFrame, json_path: str, text_col: str = "text") -> DataFrame:
    """turns with n_ids, the number of a text's ids; null text is the empty text. A column n_ids is replaced."""
    kept = turns.drop("n_ids")
    at = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(json_path)
        for batch in batches:
            tokenizer.spaced.trim(), tokenizer.bare.trim()
            n = [len(tokenizer.encode(text or "")) // 4 for text in batch.column(at).to_pylist()]
            yield batch.append_column("n_ids", pa.array(n, pa.int64()))

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("n_ids", T.LongType())]))


def pack_conversations(turns: DataFrame, json_path: str, limits: Limits, taught: str = "assistant", id_col: str = "conv_id", role_col: str = "role") -> DataFrame:
    """Whole conversations into sequences, by tokens (each turn's ids and one that ends it), segments and the tokens that
    bear loss, those of the turns of one role. Turns without a conversation are one; an unknown role bears no loss."""
    sized = with_lengths(turns.select(id_col, role_col, "text"), json_path)
    each = sized.groupBy(id_col).agg(F.sum(F.col("n_ids") + 1).alias("tokens"), F.coalesce(F.sum(F.when(F.col(role_col) == taught, F.col("n_ids") + 1)), F.lit(0)).alias("loss"))
    return pack_examples(each, [id_col], "tokens", "loss", limits)


def pack_documents(docs: DataFrame, json_path: str, end_id: int = 1, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents' ids, each document ended by end_id, cut into pieces and packed; one row per piece.

    Null text is the empty text: its only id is end_id. Texts of any length are cut; repeated rows and null keys are
    packed like others. An empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(json_path)
        packer = DocumentPacker(limits, TaskContext.get().partitionId() << 32)
        end, key_type = array.array("I", [end_id]).tobytes(), None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], key_type), *(pa.array(c, pa.int64()) for c in columns[1:])], names)

        for batch in batches:
            key_type = batch.column(0).type
            tokenizer.spaced.trim(), tokenizer.bare.trim()
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += packer.add(key, tokenizer.encode(text or "") + end)
            yield table(rows)
        if key_type is not None:
            yield table(packer.finish())

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, " + ", ".join(f"`{n}` long" for n in names[1:]))
