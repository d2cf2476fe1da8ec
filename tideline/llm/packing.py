"""Packing token sequences: vector bin packing by the dot-product heuristic under several simultaneous limits."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import small_batches

SEQUENCE = 2048
SEGMENTS = 256
END = 1
#: Open pieces that a task holds before it packs them; what is left over is packed with the next ones.
WINDOW = 4096


#: Fixed value: the vocabulary's special token; the ranks leave its id free.
SPECIAL = {"<|endoftext|>": 50256}


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """Encoder of a byte-level BPE vocabulary given as `.json` for the tokenizers library, or as ranks (`.tiktoken`), which
    give the same ids. The string of a special token in a text is that token, as in the library."""
    if vocabulary.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(vocabulary)
        return lambda text: t.encode(text, add_special_tokens=False).ids
    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    e = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return lambda text: e.encode(text, allowed_special="all")


def dot_product_pack(demand: np.ndarray, capacity: np.ndarray) -> tuple[list[list[int]], np.ndarray]:
    """Bins (lists of items) for demand vectors (items x limits): always place the fitting item with the largest dot
    product of remaining capacity and demand, both as shares of the capacity; a new bin opens when none fits.

    Equal demands are taken as one class, so the choice costs the number of classes, not of items. The second value
    is the use of each bin.
    """
    kinds, inverse = np.unique(demand, axis=0, return_inverse=True)
    inverse = inverse.ravel()
    members = np.argsort(inverse, kind="stable")
    counts = np.bincount(inverse, minlength=len(kinds))
    nexts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    share = kinds / capacity
    bins, used, left = [], [], len(demand)
    while left:
        room, items = capacity.astype(np.float64).copy(), []
        while left:
            fits = (counts > 0) & (kinds <= room).all(axis=1)
            if not fits.any():
                break
            k = int(np.argmax(np.where(fits, share @ (room / capacity), -1.0)))
            items.append(int(members[nexts[k]]))
            nexts[k] += 1
            counts[k] -= 1
            left -= 1
            room -= kinds[k]
        if not items:
            raise ValueError("an item exceeds the capacity")
        bins.append(items)
        used.append(capacity - room)
    return bins, np.array(used).reshape(len(bins), -1)


PIECES = "doc_id long, row_in_task long, start long, length long, ids binary, doc_tokens long, loss_tokens long, loss_mask binary, sequence_id long, offset long, sequence_tokens long"


class Piece(NamedTuple):
    doc: int | None
    row: int
    start: int
    ids: np.ndarray
    tokens: int  # of its document
    mask: np.ndarray | None  # which ids bear loss; None: all

    @property
    def loss(self) -> int:
        return len(self.ids) if self.mask is None else int(self.mask.sum())

    def fitting(self, tokens: int, loss: int) -> int:
        """How many of the first ids keep within both bounds."""
        if self.mask is None:
            return min(tokens, loss, len(self.ids))
        return min(tokens, int(np.searchsorted(np.cumsum(self.mask), loss, side="right")), len(self.ids))

    def cut(self, at: int) -> tuple[Piece, Piece]:
        head, tail = (None, None) if self.mask is None else (self.mask[:at], self.mask[at:])
        return self._replace(ids=self.ids[:at], mask=head), self._replace(start=self.start + at, ids=self.ids[at:], mask=tail)


def _packer(vocabulary: str, size: int, segments: int, loss_limit: int, end: int, turns: bool):
    def encoded(encode, value) -> tuple[np.ndarray, np.ndarray | None]:
        if not turns:
            return np.array([*encode(value or ""), end], "<u4"), None
        parts = [(encode(x["text"] or ""), bool(x["loss"])) for x in value or [] if x is not None]
        mask = [np.full(len(ids), loss) for ids, loss in parts]
        return np.array([*(i for ids, _ in parts for i in ids), end], "<u4"), np.concatenate([*mask, [parts[-1][1] if parts else False]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        base = TaskContext.get().partitionId() << 40
        state = {"sequence": 0, "row": 0}
        open_: list[Piece] = []
        ready: list[tuple] = []

        def put(pieces: list[Piece]) -> None:
            at, total, seq = 0, sum(len(p.ids) for p in pieces), base + state["sequence"]
            state["sequence"] += 1
            for p in pieces:
                ready.append((p.doc, p.row, p.start, len(p.ids), p.ids.tobytes(), p.tokens, p.loss, None if p.mask is None else p.mask.astype(np.uint8).tobytes(), seq, at, total))
                at += len(p.ids)

        def place(last: bool) -> None:
            """Pack the open pieces; a bin with room is filled by cutting the next piece, so only the last few stay short."""
            nonlocal open_
            if not open_:
                return
            demand = np.array([(len(p.ids), 1, p.loss) for p in open_], np.int64)
            bins, _ = dot_product_pack(demand, np.array([size, segments, loss_limit]))
            groups, rest, full = [[open_[i] for i in b] for b in bins], [], []
            donor = len(groups) - 1
            for k, g in enumerate(groups):
                tokens, loss = sum(len(p.ids) for p in g), sum(p.loss for p in g)
                while tokens < size and len(g) < segments:
                    while donor > k and not groups[donor]:
                        donor -= 1
                    if donor <= k:
                        break
                    p = groups[donor].pop()
                    at = p.fitting(size - tokens, loss_limit - loss)
                    if not at:
                        groups[donor].append(p)
                        break
                    head, tail = p.cut(at)
                    g.append(head)
                    if len(tail.ids):
                        groups[donor].append(tail)
                    tokens, loss = tokens + at, loss + head.loss
                if g and (tokens == size or len(g) >= segments or loss == loss_limit):
                    full.append(g)
                else:
                    rest += g
            for g in full:
                put(g)
            open_ = rest
            if last and open_:
                if len(rest) < len(demand) or full:
                    return place(True)
                for g in _powers(rest, size, segments, loss_limit):
                    put(g)
                open_ = []

        def out() -> Iterator[pa.RecordBatch]:
            if ready:
                kinds = {"long": pa.int64(), "binary": pa.binary()}
                names, types = zip(*(x.split() for x in PIECES.split(", ")))
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*ready), types)], list(names))
                ready.clear()

        for b in batches:
            for doc, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids, mask = encoded(encode, value)
                left = Piece(doc, state["row"], 0, ids, len(ids), mask)
                while len(left.ids):  # whole sequences of one document are not packed
                    head, left = left.cut(left.fitting(size, loss_limit))
                    put([head]) if len(head.ids) == size else open_.append(head)
                state["row"] += 1
                if len(open_) >= WINDOW:
                    place(False)
                if len(ready) >= 2048:
                    yield from out()
        place(True)
        yield from out()

    return work


def _powers(pieces: list[Piece], size: int, segments: int, loss_limit: int) -> list[list[Piece]]:
    """Cut the last pieces of a task into sequences whose lengths are powers of two, which need no padding."""
    groups, flat = [], list(reversed(pieces))
    left = sum(len(p.ids) for p in flat)
    while left:
        taken, loss, tokens = [], 0, 0
        while flat and tokens < size and len(taken) < segments and (at := flat[-1].fitting(size - tokens, loss_limit - loss)):
            head, tail = flat.pop().cut(at)
            if len(tail.ids):
                flat.append(tail)
            taken.append(head)
            tokens, loss = tokens + at, loss + head.loss
        over = tokens - (1 << (tokens.bit_length() - 1))
        while over:  # what is over a power of two goes back
            p = taken.pop()
            keep, back = p.cut(max(0, len(p.ids) - over))
            over -= len(back.ids)
            flat.append(back)
            if len(keep.ids):
                taken.append(keep)
        groups.append(taken)
        left -= sum(len(p.ids) for p in taken)
    return groups


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, segments: int = SEGMENTS, loss_limit: int | None = None, end: int = END) -> DataFrame:
    """Pieces of the documents' token ids in sequences, columns PIECES (`ids`: little-endian unsigned 32-bit).

    The text column holds plain texts, every token of which bears loss, or instruction data: an array of turns
    struct<text string, loss boolean>, each encoded on its own, where the tokens of the turns marked bear loss (the end id as
    the last turn does). `loss_mask` has a byte, 0 or 1, for each id of a piece; null: all ones.

    A sequence obeys three limits at once: `size` tokens, `segments` pieces and `loss_limit` loss-bearing tokens. Runs of whole
    sequences within a document are cut off first; the rest is packed by `dot_product_pack` over windows of open pieces
    in each task, remaining room is filled by cutting, and what a task has at its end goes into power-of-two lengths. No
    shuffle: a task packs its own rows. A null text or turn is empty (no text: the end id alone), a null id stays null,
    repeated rows are packed each, an empty table gives an empty result and other columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    turns = rows.schema["text"].dataType.typeName() == "array"
    return rows.mapInArrow(_packer(vocabulary, size, segments, loss_limit or size, end, turns), PIECES)
