"""Secret scans: candidates by pattern, false positives removed by a random forest.

Every run of at least ``MIN_LENGTH`` key characters with a digit is a finding, and so is every value
assigned to a secret name, whatever its length and characters: what is between quotes on a line, or
else all up to white space, without closing marks. A value inside another is part of it. Features are
the length, the character transitions (changes of class, and the mean log probability of its
letter pairs in dictionary words), the dictionary coverage, and the path and neighbouring words,
hashed. The dictionary and letter pairs come from all documents. The forest is trained from
labelled findings; ``weak_labels`` makes labels where people have not: provider key formats and
values with a digit assigned to secret names are secrets, digit runs and values after other names are not.
Training reads at most ``TRAINING_ROWS`` findings, of each label those with the smallest hashes: a
label may fill half of them, and what the other leaves. Both labels weigh the same, however many
findings they have. Every finding is scored.

A null text has no findings, a null path is empty. Repeated rows give their findings each. An
empty table gives no rows; with labels of one kind only, that kind is the verdict. Only doc_id,
text and the path column are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm.common import materialize, slices, table

MIN_LENGTH = 16
TRAINING_ROWS = 20_000
THRESHOLD = 0.5
#: A dictionary word occurs in one of so many documents at least, so the dictionary's size depends
#: on the length of documents, not on their number.
WORD_SHARE = 1 / 1000
HASHED = 24

KEY = re.compile(rf"[A-Za-z0-9_/+=-]{{{MIN_LENGTH},}}")
# Provider formats, names of secrets and of things that look like them.
PROVIDER = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-.{10,})$"
SECRET_NAMES = r"(?i)(token|secret|passw(or)?d|api_?key|credential)[\"' ]*[:=][\"' ]*$"
#: What makes a text worth searching for ASSIGNED.
NAMED = ("token", "secret", "passw", "api", "credential")
ASSIGNED = re.compile(
    r"""(?:token|secret|passw(?:or)?d|api_?key|credential)["' ]*[:=]+ *"""
    r"""(?:(["'])(?P<quoted>(?:\\.|(?!\1)[^\\\n])+)\1|["']?(?P<bare>[^\s"']\S*))""",
    re.IGNORECASE,
)
OTHER_NAMES = r"(?i)(sha(1|256)?|md5|checksum|commit|revision|uuid|order|invoice|id)[\"' ]*[:=][\"' ]*$"

NUMBERS = [
    "length", "digit_share", "upper_share", "lower_share", "other_share", "class_changes",
    "entropy", "pair_score", "dictionary_coverage", "assigned", "quoted",
]


def document_words(docs: DataFrame) -> DataFrame:
    """Lower-case words of 4 to 12 letters and the number of documents that have them."""
    word = re.compile(r"(?<![A-Za-z0-9])[a-z]{4,12}(?![A-Za-z0-9])")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                counts.update(set(word.findall(text or "")))
            if len(counts) > 500_000:
                yield _counted(counts)
                counts.clear()
        yield _counted(counts)

    def _counted(counts: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
            ["word", "n"],
        )

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")
    )


def dictionary(docs: DataFrame) -> dict[str, int]:
    total = docs.count()
    common = document_words(docs).filter(F.col("n") >= max(3, WORD_SHARE * total))
    return {r["word"]: r["n"] for r in common.collect()}


class Language:
    """Letter pairs and words of a dictionary."""

    def __init__(self, words: dict[str, int]) -> None:
        pairs = np.ones((128, 128))
        for word, n in words.items():
            codes = word.encode()
            np.add.at(pairs, (list(codes[:-1]), list(codes[1:])), math.log1p(n))
        self.pairs = np.log(pairs / pairs.sum(axis=1, keepdims=True))
        self.words = set(words)

    def pair_score(self, text: str) -> float:
        # Beyond ASCII all bytes count as one.
        codes = np.minimum(np.frombuffer(text.lower().encode(), np.uint8), 127)
        return float(self.pairs[codes[:-1], codes[1:]].mean() if len(codes) > 1 else self.pairs.mean())

    def coverage(self, text: str) -> float:
        """Share of characters in dictionary words, longest first from the left."""
        low, at, covered = text.lower(), 0, 0
        while at < len(low):
            size = next((k for k in range(12, 3, -1) if low[at : at + k] in self.words), 0)
            covered += size
            at += size or 1
        return covered / len(text)


def _kinds(text: str) -> str:
    return "".join("d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in text)


def _entropy(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def _places(text: str) -> list[tuple[int, int]]:
    """Bounds of all candidates: runs of key characters, and values assigned to secret names."""
    found = set()
    for m in KEY.finditer(text):
        value = m.group()
        if not any(c.isdigit() for c in value):
            continue
        # A name glued on by = belongs to the context.
        rest = value.rpartition("=")[2] if "=" in value.rstrip("=") else value
        if len(rest) < MIN_LENGTH:
            rest = value
        found.add((m.end() - len(rest), m.end()))
    low = text.lower()
    if any(name in low for name in NAMED):
        for m in ASSIGNED.finditer(text):
            if m["quoted"]:
                found.add(m.span("quoted"))
            else:
                value = m["bare"].rstrip("\"',;.)]}>") or m["bare"]
                found.add((m.start("bare"), m.start("bare") + len(value)))
    return sorted(found)


def findings(docs: DataFrame, language: Language, path: str = "source") -> DataFrame:
    """All candidates with place, context and numeric features."""
    shared = docs.sparkSession.sparkContext.broadcast(language)
    fields = ["doc_id", "start", "end", "candidate", "path", "before", "left_word", "right_word", *NUMBERS]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        know = shared.value
        for batch in slices(batches):
            rows = []
            for doc, text, where in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "text", "path")), strict=True
            ):
                for start, end in _places(text or ""):
                    rest = text[start:end]
                    before = text[max(0, start - 40) : start]
                    after = text[end : end + 40]
                    kinds = _kinds(rest)
                    n = len(rest)
                    rows.append(
                        (
                            doc, start, end, rest, where or "", before,
                            (re.findall(r"\w+", before) or [""])[-1].lower(),
                            (re.findall(r"\w+", after) or [""])[0].lower(),
                            float(n), *(kinds.count(k) / n for k in "dulo"),
                            sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n,
                            _entropy(rest), know.pair_score(rest), know.coverage(rest),
                            float(bool(re.search(r"[:=][\"' ]*$", before))),
                            float(before[-1:] in "\"'" and after[:1] == before[-1:] != ""),
                        )
                    )
            columns = list(zip(*rows, strict=True)) or [()] * len(fields)
            kinds_of = [pa.int64()] * 3 + [pa.string()] * 5 + [pa.float64()] * len(NUMBERS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds_of, strict=True)], fields
            )

    schema = "doc_id long, start long, end long, candidate string, path string, before string, "
    schema += "left_word string, right_word string, " + ", ".join(f"{n} double" for n in NUMBERS)
    given = F.col(path).cast("string") if path in docs.columns else F.lit("")
    return docs.select("doc_id", "text", given.alias("path")).mapInArrow(find, schema)


def weak_labels(found: DataFrame) -> DataFrame:
    """Findings that rules decide: ``label`` 1 for secrets, 0 for others."""
    assigned = F.col("before").rlike(SECRET_NAMES) & F.col("candidate").rlike("[0-9]")
    secret = F.col("candidate").rlike(PROVIDER) | assigned
    other = F.col("candidate").rlike(r"^[0-9 -]+$") | F.col("before").rlike(OTHER_NAMES)
    label = F.when(secret, 1.0).when(other, 0.0)
    return found.withColumn("label", label).filter(F.col("label").isNotNull())


def _hashed(column: str, buckets: int) -> list[Column]:
    place = F.pmod(F.xxhash64(column), F.lit(buckets))
    return [(place == i).cast("double").alias(f"{column}_{i}") for i in range(buckets)]


def features(found: DataFrame) -> DataFrame:
    """Adds the vector of numbers, path and neighbouring words."""
    hashed = [
        c for name, n in (("path", 8), ("left_word", HASHED), ("right_word", 8)) for c in _hashed(name, n)
    ]
    names = [f"{c}_{i}" for c, n in (("path", 8), ("left_word", HASHED), ("right_word", 8)) for i in range(n)]
    wide = found.select("*", *hashed)
    return VectorAssembler(inputCols=[*NUMBERS, *names], outputCol="features").transform(wide).drop(*names)


def classify(found: DataFrame, labelled: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """``probability`` and ``is_secret`` for every finding, from a forest on labelled ones."""
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(counts) < 2:
        only = F.lit(next(iter(counts), 0.0))
        return found.withColumn("probability", only).withColumn("is_secret", only >= THRESHOLD)
    order = F.xxhash64("candidate", "before", "doc_id", "start")
    parts = []
    for label, n in sorted(counts.items()):
        taken = min(n, max(rows // 2, rows - (sum(counts.values()) - n)))
        part = labelled.filter(F.col("label") == label).orderBy(order).limit(taken)
        parts.append(part.withColumn("weight", F.lit(1.0 / taken)))
    sample = materialize(parts[0].unionByName(parts[1]), "labelled-findings")
    forest = RandomForestClassifier(numTrees=20, maxDepth=6, maxBins=16, seed=7, weightCol="weight")
    model = forest.fit(features(sample))
    scored = model.transform(features(found)).withColumn(
        "probability_", vector_to_array("probability")[1]
    )
    return (
        scored.drop("probability", "rawPrediction", "prediction", "features")
        .withColumnRenamed("probability_", "probability")
        .withColumn("is_secret", F.col("probability") >= THRESHOLD)
    )


def scan(docs: DataFrame, path: str = "source") -> DataFrame:
    found = materialize(findings(docs, Language(dictionary(docs)), path), "findings")
    return classify(found, weak_labels(found))


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents")).select(
        "doc_id", "start", "end", "candidate", "path", F.round("probability", 6).alias("probability"),
        "is_secret",
    )
