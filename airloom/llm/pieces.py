"""SentencePiece encoding and decoding with a batched numpy Viterbi.

Distinct stretches of a text between blanks are sorted by length, and those of equal length advance
together, a character at a time: the hashes of all substrings that end there probe the sorted
piece keys, the lattice keeps the admissible pieces, and a vectorised maximum stores the pointer
back. The model's pieces come from merges, so a path is admissible, and the only one, if all its
neighbouring pieces stay as they are when the merges are applied to the two of them; that makes
the result equal the library's. Pair verdicts are remembered.

Characters that no piece has become byte pieces. Blanks are ``▁``, with one put before the text.
Decoding joins the pieces' bytes, takes that one blank off and replaces what is not UTF-8. A text
with ``▁`` in it comes back with blanks in those places, as with the library; all others round-trip
exactly. Null and empty texts have no ids and come back empty. Repeated rows get a row each, an
empty table gives none; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from airloom.llm.common import documents, slices, table

BLANK = "▁"
CACHED_WORDS = 150_000
CACHED_PAIRS = 1_000_000
#: Longer words are not remembered, so that the number of words bounds the memory.
KEPT_CHARS = 64
#: Bits of a piece key that say whether there can be such a piece.
SEEN_BITS = 20
#: Fewer words of a length advance one by one.
FEW = 6

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORDS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


class Pieces:
    """A model file's pieces, and everything learnt from them so far in this worker."""

    _made: dict[str, Pieces] = {}

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.vocab_size()
        self.text = [model.id_to_piece(i) for i in range(self.size)]
        plain = [
            i
            for i in range(self.size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.score = {self.text[i]: model.get_score(i) for i in plain}
        self.id = {self.text[i]: i for i in plain}
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.id):
            raise ValueError("pieces reach over blanks: texts can't be cut there")
        self.longest = max(map(len, self.id))
        self.byte_id = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        raw = [
            bytes([int(self.text[i][3:5], 16)])
            if model.is_byte(i)
            else b""
            if model.is_control(i)
            else self.text[i].replace(BLANK, " ").encode()
            for i in range(self.size)
        ]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_length = np.array(list(map(len, raw)), np.int64)
        self.raw_start = np.cumsum(self.raw_length) - self.raw_length
        # Only pieces that the merges themselves arrive at can be part of a result.
        reached = [p for p in self.id if self.merge(p) == [p]]
        keys = np.array([self._hash(p) for p in reached], np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array([self.id[p] for p in reached])[order]
        self.seen = np.zeros(1 << SEEN_BITS, bool)
        self.seen[(self.keys >> np.uint64(64 - SEEN_BITS)).astype(np.int64)] = True
        self.reached = {p: self.id[p] for p in reached}
        # Verdicts on pairs: sorted ones, of which the first is none, and those of the last words.
        self.pairs, self.verdicts = np.array([-1]), np.array([False])
        self.fresh: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Pieces:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def merge(self, text: str) -> list[str]:
        """Merges of neighbours, the best score first and the leftmost of equal ones."""
        parts = list(text)
        while len(parts) > 1:
            scores = [self.score.get(a + b, -np.inf) for a, b in zip(parts, parts[1:], strict=False)]
            best = max(scores)
            if best == -np.inf:
                break
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def stays(self, left: int, right: int) -> bool:
        """Whether two neighbouring pieces are what merging their characters gives."""
        a, b = self.text[left], self.text[right]
        return a + b not in self.reached and self.merge(a + b) == [a, b]

    def stay(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The same for many pairs, remembered; beside a character without a piece all stay."""
        out = (left < 0) | (right < 0)
        ask = np.flatnonzero(~out)
        if not len(ask):
            return out
        keys, inverse = np.unique(left[ask] * self.size + right[ask], return_inverse=True)
        place = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        new = self.pairs[place] != keys
        verdicts = self.verdicts[place]
        for i, k in zip(np.flatnonzero(new).tolist(), keys[new].tolist(), strict=True):
            if k not in self.fresh:
                self.fresh[k] = self.stays(*divmod(k, self.size))
            verdicts[i] = self.fresh[k]
        out[ask] = verdicts[inverse]
        return out

    def remember_pairs(self) -> None:
        """Files the verdicts of the last words among the sorted ones."""
        if len(self.pairs) + len(self.fresh) > CACHED_PAIRS:
            self.pairs, self.verdicts = self.pairs[:1], self.verdicts[:1]
        pairs = np.concatenate([self.pairs, np.fromiter(self.fresh.keys(), np.int64)])
        order = np.argsort(pairs, kind="stable")
        verdicts = np.concatenate([self.verdicts, np.fromiter(self.fresh.values(), bool)])
        self.pairs, self.verdicts, self.fresh = pairs[order], verdicts[order], {}

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of words of one length, 32 bits each."""
        n, length = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, length)
        prefix = np.zeros((length + 1, n), np.uint64)
        for j in range(length):
            prefix[j + 1] = prefix[j] * _BASE + codes[:, j] + np.uint64(1)
        powers = np.ones(self.longest + 1, np.uint64)
        powers[1:] = np.multiply.accumulate(np.full(self.longest, _BASE))
        # The last piece of each prefix, -1 for a character without one, and the pieces' lengths.
        last = np.full((length + 1, n), -1, np.int64)
        back = np.zeros((length + 1, n), np.int64)
        for j in range(1, length + 1):
            for size in range(1, min(self.longest, j) + 1):
                i = j - size
                key = prefix[j] - prefix[i] * powers[size]
                found = np.full(n, -1, np.int64)
                # Most stretches are no piece, and their keys' first bits tell.
                near = np.flatnonzero(self.seen[(key >> np.uint64(64 - SEEN_BITS)).astype(np.int64)])
                place = np.minimum(np.searchsorted(self.keys, key[near]), len(self.keys) - 1)
                found[near] = np.where(self.keys[place] == key[near], self.key_ids[place], -1)
                # Within a stretch a prefix always has a path, so only pieces need be looked at.
                rows = np.flatnonzero((found >= 0) | (size == 1))
                if i and len(rows):
                    rows = rows[self.stay(last[i, rows], found[rows])]
                longer = rows[back[j, rows] < size]
                back[j, longer], last[j, longer] = size, found[longer]
        # All paths are followed back together; a finished one stays at 0.
        at, rows, steps = np.full(n, length), np.arange(n), []
        while at.any():
            steps.append(np.where(at > 0, last[at, rows], -2))
            at = at - back[at, rows]
        path = np.array(steps[::-1]).T
        ids, counts = path[path != -2].astype("<i4"), (path != -2).sum(axis=1)
        stops = 4 * np.cumsum(counts)
        raw = ids.tobytes()
        out = [raw[b - 4 * c : b] for b, c in zip(stops.tolist(), counts.tolist(), strict=True)]
        for k in np.flatnonzero((path == -1).any(axis=1)).tolist():
            out[k] = self._path(words[k], back[:, k].tolist(), last[:, k].tolist())
        return out

    def _alone(self, word: str) -> bytes:
        """The same for one word."""
        last, back = [-1] * (len(word) + 1), [0] * (len(word) + 1)
        for j in range(1, len(word) + 1):
            for size in range(min(self.longest, j), 0, -1):
                i = j - size
                found = self.reached.get(word[i:j], -1)
                if found < 0 and size > 1:
                    continue
                if i == 0 or found < 0 or last[i] < 0 or self.stays(last[i], found):
                    back[j], last[j] = size, found
                    break
        return self._path(word, back, last)

    def _path(self, word: str, back: list[int], last: list[int]) -> bytes:
        out: list[int] = []
        j = len(word)
        while j:
            if last[j] >= 0:
                out.append(last[j])
            else:
                out.extend(self.byte_id[b] for b in reversed(word[j - 1].encode()))
            j -= back[j]
        return np.array(out[::-1], "<i4").tobytes()

    def learn(self, words: set[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for same in by_length.values():
            found = self._together(same) if len(same) >= FEW else map(self._alone, same)
            self.words.update(zip(same, found, strict=True))
        self.remember_pairs()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [_WORDS.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        new = set(chain.from_iterable(split)) - self.words.keys()
        if len(self.words) + len(new) > CACHED_WORDS:
            self.words.clear()
            new = set(chain.from_iterable(split))
        self.learn(new)
        get = self.words.__getitem__
        out = [np.frombuffer(b"".join(map(get, words)), "<i4") for words in split]
        for word in [w for w in new if len(w) > KEPT_CHARS]:
            del self.words[word]
        return out

    def decode(self, ids: np.ndarray) -> str:
        length = self.raw_length[ids]
        stops = np.cumsum(length)
        total = int(stops[-1]) if len(ids) else 0
        shift = np.repeat(self.raw_start[ids] - (stops - length), length)
        text = self.raw[shift + np.arange(total)].tobytes().decode(errors="replace")
        return text.removeprefix(" ")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(path)
        for batch in slices(batches):
            ids = pieces.encode([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _lists(ids)], ["doc_id", "ids"]
            )

    return documents(docs).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, text) from rows (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(path)
        for batch in batches:
            texts = [
                pieces.decode(np.array(ids or [], np.int32)) for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def _lists(ids: list[np.ndarray]) -> pa.Array:
    stops = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(stops, np.concatenate([*ids, np.zeros(0, np.int32)]))


DIGESTS = "doc_id long, n_bytes long, n_tokens long, ids_sha256 string, round_trip boolean"


def digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Tokens of every document, a digest of their ids (32 bits each, little-endian), and whether
    decoding them gives the text again; the ids too, if asked for."""
    names = [c.split(" ")[0] for c in DIGESTS.split(", ")] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(path)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = pieces.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(list(map(len, ids)), pa.int64()),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids]),
                    pa.array([pieces.decode(x) == t for x, t in zip(ids, texts, strict=True)], pa.bool_()),
                    *([_lists(ids)] if with_ids else []),
                ],
                names,
            )

    return documents(docs).mapInArrow(run, DIGESTS + ", ids array<int>" * with_ids)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"), model_path())


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The last stage: what is kept as token ids, with their number and digest."""
    return digests(docs, model_path(), with_ids=True)
