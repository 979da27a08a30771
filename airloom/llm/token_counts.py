"""Token counts, huge documents by overlapping chunks that are spliced where both agree.

A document longer than ``chunk_chars`` is cut into chunks of that length; each also reads
``overlap`` characters of the next one. Both chunks are encoded with offsets. They are spliced at
a proven stable common boundary: a token start, in the text after white space, at the same place
in both, before which the left chunk and from which the right chunk is used. White space belongs
to no token, normalisation does not reach across it and the splitter keeps no state but its place,
so from there on both see the same text. Where an overlap has no such place, it is doubled, until
one is found or the left chunk reaches the end of the text.

Other documents are encoded by words, which white space separates for the same reason; counts of
distinct words are remembered up to ``CACHED_WORDS`` of them.

A null text is empty and has no tokens. Repeated rows get a row each; an empty table gives none.
Only doc_id and text are read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from airloom.llm.common import documents, slices, table

CHUNK_CHARS = 32_768
OVERLAP = 512
LIMIT = 2048
CACHED_WORDS = 400_000
#: Longer words are not remembered, so that the number of words bounds the memory.
KEPT_BYTES = 64

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunks long, n_widened long"


class Counter:
    """Counts tokens with one tokenizer file; one per worker, kept between tasks."""

    _made: dict[str, Counter] = {}

    def __init__(self, path: str) -> None:
        # One thread per task; Spark runs as many tasks as there are cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, int] = {}

    @classmethod
    def of(cls, path: str) -> Counter:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def by_words(self, texts: list[bytes]) -> list[int]:
        split = [t.split() for t in texts]
        known = self.known
        new = list({w for words in split for w in words if w not in known})
        if len(known) + len(new) > CACHED_WORDS:
            known.clear()
            new = list({w for words in split for w in words})
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        known.update(zip(new, map(len, encoded), strict=True))
        out = [sum(map(known.__getitem__, words)) for words in split]
        for word in [w for w in new if len(w) > KEPT_BYTES]:
            del known[word]
        return out

    def starts(self, text: str, begin: int, end: int) -> list[int]:
        """Where the tokens of a part of the text start."""
        encoded = self.tokenizer.encode(text[begin:end], add_special_tokens=False)
        return [begin + a for a, _ in encoded.offsets]

    def by_chunks(self, text: str, chunk: int, overlap: int) -> tuple[int, int, int]:
        """Tokens, chunks and widened overlaps of one long text."""
        total, widened, proven = 0, 0, 0  # tokens that start before ``proven`` are counted
        left_at, left = 0, self.starts(text, 0, chunk + overlap)
        cuts = range(chunk, len(text), chunk)
        for cut in cuts:
            reach, right = overlap, self.starts(text, cut, cut + chunk + overlap)
            while not (common := _stable(text, left, proven) & _stable(text, right, cut + 1)):
                if cut + reach >= len(text):
                    return total + sum(a >= proven for a in left), len(cuts) + 1, widened
                widened += 1
                reach *= 2
                left = self.starts(text, left_at, cut + reach)
                if reach > chunk + overlap:
                    right = self.starts(text, cut, cut + reach)
            at = min(common)
            total += sum(proven <= a < at for a in left)
            proven, left_at, left = at, cut, right
        return total + sum(a >= proven for a in left), len(cuts) + 1, widened


def _stable(text: str, starts: list[int], least: int) -> set[int]:
    """Token starts after white space, none before ``least``."""
    return {a for a in starts if a >= max(least, 1) and text[a - 1] in " \t\n\v\f\r"}


def count_tokens(
    docs: DataFrame,
    path: str,
    limit: int = LIMIT,
    chunk_chars: int = CHUNK_CHARS,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Per document its UTF-8 bytes and the tokens that the tokenizer file gives its whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(path)
        for batch in slices(batches):
            texts = [(t or "") for t in batch.column("text").to_pylist()]
            short = [i for i, t in enumerate(texts) if len(t) <= chunk_chars]
            raw = [t.encode() for t in texts]
            found = dict(zip(short, counter.by_words([raw[i] for i in short]), strict=True))
            rows = [
                (found[i], 1, 0) if i in found else counter.by_chunks(t, chunk_chars, overlap)
                for i, t in enumerate(texts)
            ]
            n = [r[0] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(map(len, raw), pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([x > limit for x in n], pa.bool_()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chunks", "n_widened"],
            )

    return documents(docs).mapInArrow(count, SCHEMA)


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return count_tokens(table(spark, folder, "documents"), path)
