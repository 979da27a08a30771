"""Vector bin packing of examples into training sequences by the dot-product heuristic.

Every sequence is limited in tokens, in segments (pieces of examples) and in loss-bearing tokens
at once. An example's ids are cut into items that fit alone; full ones are sequences, the others
wait in a task's window. A sequence is filled with the item whose demand, weighted by the mean
demand of the window, has the largest dot product with what is left of the three limits. Where
none fits whole, one is cut to the rest, so that sequences end exactly at the token limit; the
last segment slot prefers an item that closes the gap. A sequence that the other limits or the end
of a partition leave short is cut back to a power of two, which needs no padding either.

Ids are those of a byte-level BPE, and one ``END`` after each example. Without ``spans`` all ids
but an example's first bear loss; with it, the ids that touch one of the spans ``start:end`` of
code points, comma-joined, as chat formatting gives them, and the end id if a span reaches the end.

A partition is packed as it is read: no shuffle, and no memory beyond the window and one text's
ids. ``sequence_id`` is the partition's number and a count, the same when a task runs again.

A null or empty text is one ``END``. Repeated rows are packed once each, rows without doc_id too.
Only doc_id, text and the named span column are read. An empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm.common import slices, table

#: Closes every example.
END = 0
WINDOW = 1024
#: Texts are encoded in parts of about so many characters.
PART_CHARS = 500_000
#: Sequences of a partition are numbered in the lower bits.
COUNT_BITS = 36

# Fixed value: the one special string of the vocabulary, found in texts by default.
SPECIAL = {"<|endoftext|>": 50256}

SCHEMA = (
    "doc_id long, start long, length long, ids binary, n_loss long, doc_tokens long, "
    "sequence_id long, offset long, segment int"
)


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


class Encoder:
    """Ids of whole texts from a ranks file; one per worker."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL
        )
        #: UTF-8 bytes of each id.
        self.widths = np.zeros(max(SPECIAL.values()) + 1, np.int64)
        for token, i in (*ranks.items(), *SPECIAL.items()):
            self.widths[i] = len(token)

    @classmethod
    def of(cls, path: str, pattern: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path, pattern)
        return cls._made[path]

    def ids(self, text: str) -> np.ndarray:
        """The text's ids and ``END``."""
        allowed = set(SPECIAL)
        out = [self.encoding.encode_to_numpy(p, allowed_special=allowed) for p in parts(text)]
        return np.concatenate([*out, np.array([END], np.uint32)]).astype("<u4")


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """The text in parts, cut before single blanks between words: there the splitter always
    begins a new token, and it does not look back."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        while cut + 1 < len(text) and not (
            text[cut] == " " and not text[cut - 1].isspace() and not text[cut + 1].isspace()
        ):
            cut += 1
        if cut + 1 >= len(text):
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def trained(text: str, ids: np.ndarray, widths: np.ndarray, spans: str | None) -> np.ndarray:
    """Which ids bear loss."""
    raw = text.encode()
    stop = np.cumsum(np.append(widths[ids[:-1]], 1))
    start = np.concatenate([[0], stop[:-1]])
    if stop[-1] != len(raw) + 1:
        raise ValueError("ids do not cover the text")
    # Where each code point begins among the bytes.
    first = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    first = np.append(first, [len(raw), len(raw) + 1])
    flags = np.zeros(len(ids), bool)
    for span in filter(None, (spans or "").split(",")):
        a, b = (first[min(int(x), len(first) - 2)] for x in span.split(":"))
        # A span up to the end of the text has the closing id as well.
        flags |= (start < b + (b == len(raw))) & (stop > a)
    return flags


class Item:
    """A stretch of one example's ids, with the running count of its loss-bearing ones."""

    __slots__ = ("doc", "start", "ids", "loss", "total")

    def __init__(self, doc: int | None, start: int, ids: np.ndarray, loss: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.loss, self.total = doc, start, ids, loss, total

    def __len__(self) -> int:
        return len(self.ids)

    def n_loss(self) -> int:
        return int(self.loss[-1] - self.loss[0])

    def reach(self, tokens: int, loss: int) -> int:
        """Ids from the start that keep both limits."""
        return min(tokens, len(self), int(np.searchsorted(self.loss, self.loss[0] + loss, "right")) - 1)

    def split(self, k: int) -> tuple[Item, Item]:
        return (
            Item(self.doc, self.start, self.ids[:k], self.loss[: k + 1], self.total),
            Item(self.doc, self.start + k, self.ids[k:], self.loss[k:], self.total),
        )


class Packer:
    """The window of one task: items in, sequences (lists of items) out."""

    def __init__(self, limits: Limits, window: int = WINDOW) -> None:
        self.limits, self.window = limits, window
        self.items: list[Item] = []

    def add(self, item: Item) -> Iterator[list[Item]]:
        while len(item):
            k = item.reach(self.limits.tokens, self.limits.loss)
            head, item = item.split(k) if k < len(item) else (item, item.split(k)[1])
            if k == self.limits.tokens:
                yield [head]
            else:
                self.items.append(head)
        if len(self.items) >= self.window:
            yield from self.pack(self.window // 4)

    def pack(self, leave: int = 0) -> Iterator[list[Item]]:
        """Sequences until at most ``leave`` items wait."""
        while len(self.items) > leave:
            # Demands as arrays, with room for what cutting adds: at most two items a segment.
            n, more = len(self.items), 2 * self.limits.segments
            room = n + max(n, 2 * more)
            self.size, self.loss = np.zeros((2, room), np.int64)
            self.size[:n] = [len(i) for i in self.items]
            self.loss[:n] = [i.n_loss() for i in self.items]
            self.free = np.arange(room) < n
            demand = self.size[:n].mean() / self.limits.tokens, self.loss[:n].mean() / self.limits.loss
            while len(self.items) + more <= room and self.free.sum() > leave:
                yield self._fill(demand)
            self.items = [i for i, f in zip(self.items, self.free.tolist(), strict=False) if f]

    def _wait(self, item: Item) -> None:
        at = len(self.items)
        self.items.append(item)
        self.size[at], self.loss[at], self.free[at] = len(item), item.n_loss(), True

    def _fill(self, demand: tuple[float, float]) -> list[Item]:
        most = self.limits
        tokens, segments, losses = most.tokens, most.segments, most.loss
        chosen: list[Item] = []
        while tokens and segments:
            n = len(self.items)
            size, loss, free = self.size[:n], self.loss[:n], self.free[:n]
            fits = free & (size <= tokens) & (loss <= losses)
            if segments == 1:
                fits &= size == tokens
            # Every item asks for one segment, so that dimension's share of the product is the same
            # for all and only counts in whether there is one left.
            value = size * (demand[0] * tokens / most.tokens**2) + loss * (demand[1] * losses / most.loss**2)
            value[~fits] = -1.0
            at = int(value.argmax()) if n else 0
            if n and fits[at]:
                piece, rest = self.items[at], None
            else:
                at, k = self._longest_start(tokens, losses)
                if not k:
                    break
                piece, rest = self.items[at].split(k)
            free[at] = False
            chosen.append(piece)
            tokens -= len(piece)
            segments -= 1
            losses -= piece.n_loss()
            if rest is not None and len(rest):
                self._wait(rest)
        held = most.tokens - tokens
        if tokens and held:
            for item in self._cut_back(chosen, held - (1 << (held.bit_length() - 1))):
                self._wait(item)
        return chosen

    def _longest_start(self, tokens: int, losses: int) -> tuple[int, int]:
        """The item to cut and how many ids it gives: the most, and of those the longest item."""
        n = len(self.items)
        size, loss, free = self.size[:n], self.loss[:n], self.free[:n]
        sure = free & (size >= tokens) & ((loss <= losses) | (tokens <= losses))
        if sure.any():
            return int(np.where(sure, size, -1).argmax()), tokens
        reach = [(self.items[i].reach(tokens, losses), int(size[i]), -i) for i in np.flatnonzero(free).tolist()]
        k, _, at = max(reach, default=(0, 0, 0))
        return -at, k

    @staticmethod
    def _cut_back(chosen: list[Item], excess: int) -> list[Item]:
        """Takes so many ids off the end of a sequence."""
        back = []
        while excess:
            last = chosen.pop()
            if len(last) > excess:
                kept, last = last.split(len(last) - excess)
                chosen.append(kept)
            excess -= len(last)
            back.append(last)
        return back


def pack(
    docs: DataFrame, ranks: str, pattern: str, limits: Limits = Limits(), spans: str | None = None,
    window: int = WINDOW,
) -> DataFrame:
    """One row per piece: its example and place there, its ids, its sequence and place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, made = Encoder.of(ranks, pattern), Packer(limits, window), 0
        base = TaskContext.get().partitionId() << COUNT_BITS

        def rows(sequences: Iterator[list[Item]]) -> Iterator[tuple]:
            nonlocal made
            for sequence in sequences:
                offset = 0
                for k, i in enumerate(sequence):
                    yield (i.doc, i.start, len(i), i.ids.tobytes(), i.n_loss(), i.total, base + made, offset, k)
                    offset += len(i)
                made += 1

        def items(batch: pa.RecordBatch) -> Iterator[list[Item]]:
            marks = batch.column("spans").to_pylist()
            for doc, text, own in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), marks, strict=True
            ):
                ids = encoder.ids(text or "")
                if spans is None:
                    running = _all_but_first(len(ids))
                else:
                    running = np.append(0, np.cumsum(trained(text or "", ids, encoder.widths, own)))
                yield from packer.add(Item(doc, 0, ids, running, len(ids)))

        for batch in slices(batches):
            yield _table(list(rows(items(batch))))
        yield _table(list(rows(packer.pack())))

    column = F.col(f"`{spans}`") if spans else F.lit(None)
    given = docs.select(F.col("doc_id").cast("long"), "text", column.cast("string").alias("spans"))
    return given.mapInArrow(run, SCHEMA)


def _all_but_first(n: int) -> np.ndarray:
    """The running count where only the first id bears no loss."""
    return np.maximum(np.arange(-1, n), 0)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids", "n_loss", "doc_tokens", "sequence_id", "offset", "segment"]
    kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4 + [pa.int32()]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def op11_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    import public_tokenizers

    packed = pack(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "segment", "n_loss",
    )
