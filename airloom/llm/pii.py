"""PII: patterns, and bootstrapped contextual extraction of identifiers that no pattern knows.

Base spans come from fixed patterns per kind, leftmost and not overlapping within a kind; matches
that fail their check are dropped without a retry. Places are sums of the lengths of matches and of
the gaps between them.

Base matches are the seeds. Tokens with digits or ``@`` are the instances, the words left and
right of them the lexical patterns. Spark scores the pattern-instance graph in rounds: a pattern's
confidence is the summed score of what it stands next to over all occurrences of its word in all
texts, so common words score low; an instance has the best confidence of its patterns, a seed
always 1. Instances that are no base match, next to a pattern of enough confidence and different
supporters, are added as spans of kind ``id``.

Only DataFrame functions are used. A null text is empty; texts without words have no spans.
Repeated rows get a row each. An empty table gives no rows. Only doc_id and text are read; the
stage keeps every column and masks the spans of the text, overlapping ones as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm.common import GIVEN, SPACE, SPACES, WORD, carried, documents, materialize, table, texts
from airloom.session import broadcast_checked

# What the kinds look like, in the order that ties follow. The forms with \\G and
# possessive repeats match the same as [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ ,
# [0-9]+(\.[0-9]+){3} and [0-9]([\x20-]?[0-9])+ , in linear time and without recursion.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Texts without a match of this need not be searched.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})"
INSTANCE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
TRIM = r"^[^A-Za-z0-9+]+|[^A-Za-z0-9]+$"

ROUNDS = 3
#: Confidence and number of different instances that a pattern needs.
CONFIDENCE = 0.6
SUPPORT = 5
BLANK = r"[\x20\x09-\x0D]"


def _matches(pattern: str, hint: str) -> Column:
    """Array of (start, end, value, before, after) of all matches of a pattern."""
    none = F.array().cast("array<string>")
    some = texts().rlike(hint)
    hits = F.when(some, F.regexp_extract_all(texts(), F.lit(pattern), F.lit(0))).otherwise(none)
    gaps = F.when(some, F.split(texts(), pattern, -1)).otherwise(none)
    return F.struct(hits.alias("hits"), gaps.alias("gaps"))


def _blocks(column: str | Column, n: Column) -> Column:
    """An array cut into blocks of about the square root of its length, so that growing one block
    at a time costs no more than the root for each element."""
    size = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
    at = F.sequence(F.lit(0), F.greatest(F.ceil(n / size).cast("int") - 1, F.lit(0)))
    return F.transform(at, lambda i: F.slice(column, i * size + 1, size))


def _starting(lengths: Column, total) -> Column:
    """How much comes before each element: the running sum, itself not included."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    return F.aggregate(
        lengths,
        zero,
        lambda a, x: F.struct((a["at"] + total(x)).alias("at"), F.concat(a["starts"], F.array(a["at"])).alias("starts")),
        lambda a: a["starts"],
    )


def _placed(found: str) -> Column:
    """Starts of the matches: all gaps and matches before them."""
    lengths = F.zip_with(
        F.slice(f"{found}.gaps", F.lit(1), F.size(f"{found}.hits")),
        f"{found}.hits",
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("hit")),
    )
    blocks = _blocks(lengths, F.size(f"{found}.hits"))

    def total(x: Column) -> Column:
        return x["gap"] + x["hit"]

    def whole(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda a, x: a + total(x))

    within = F.zip_with(
        blocks,
        _starting(F.transform(blocks, whole), lambda x: x),
        lambda block, before: F.zip_with(block, _starting(block, total), lambda x, at: before + at + x["gap"]),
    )
    return F.flatten(within)


def _luhn(digits: Column) -> Column:
    backwards = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(backwards, i, F.lit(1)).cast("int") * (2 - i % 2)
        return total + digit - F.when(digit > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.when(
            F.length(digits).between(14, 19), _luhn(digits)
        ).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _word(gap: Column, side: str) -> Column:
    """The word next to a match, lower-cased, without marks around it; empty if there is none."""
    # The blanks beside the match, however many, and the word behind them.
    if side == "left":
        word = F.regexp_replace(F.rtrim(gap, F.lit(SPACES.decode())), rf"(?s)\A.*{BLANK}", "")
    else:
        word = F.regexp_extract(F.ltrim(gap, F.lit(SPACES.decode())), rf"\A({WORD}|)", 1)
    return F.coalesce(F.lower(F.regexp_replace(word, r"^[\p{Punct}]+|[.,;!?\"')]+$", "")), F.lit(""))


def scan(docs: DataFrame, *kept: str) -> DataFrame:
    """One row per document: ``base``, its sorted base spans, and ``instances``, its tokens with
    digits or @ and the words beside them. ``key`` tells apart texts with one doc_id."""
    out = docs.withColumn("key", F.xxhash64(texts()))
    out = out.withColumns(
        {
            **{f"{k}_found": _matches(v, HINTS[k]) for k, v in KINDS.items()},
            "id_found": _matches(INSTANCE, "[0-9@]"),
        }
    )
    out = out.withColumns({f"{k}_starts": _placed(f"{k}_found") for k in [*KINDS, "id"]})
    spans = []
    for order, kind in enumerate(KINDS):
        every = F.zip_with(
            f"{kind}_found.hits",
            f"{kind}_starts",
            lambda hit, start: F.struct(
                start.alias("start"),
                F.lit(order).alias("order"),
                (start + F.length(hit)).alias("end"),
                F.lit(kind).alias("kind"),
                _valid(kind, hit).alias("valid"),
            ),
        )
        spans.append(F.filter(every, lambda s: s["valid"]))
    trimmed = F.zip_with(
        F.transform("id_found.hits", lambda h: F.struct(h.alias("h"), F.regexp_replace(h, TRIM, "").alias("v"))),
        F.transform(
            "id_starts",
            lambda s, i: F.struct(
                s.alias("s"),
                _word(F.get("id_found.gaps", i), "left").alias("left"),
                _word(F.get("id_found.gaps", i + 1), "right").alias("right"),
            ),
        ),
        lambda a, b: F.struct(
            (b["s"] + F.instr(a["h"], a["v"]) - 1).alias("start"),
            (b["s"] + F.instr(a["h"], a["v"]) - 1 + F.length(a["v"])).alias("end"),
            F.lower(a["v"]).alias("value"),
            b["left"].alias("left"),
            b["right"].alias("right"),
        ),
    )
    return out.select(
        *kept,
        "key",
        F.array_sort(F.concat(*spans)).alias("base"),
        F.filter(trimmed, lambda x: F.length(x["value"]) >= 5).alias("instances"),
    )


def occurrences(scanned: DataFrame) -> DataFrame:
    """A row per instance and place; ``seed`` if it overlaps a base span."""
    one = scanned.select("doc_id", "key", "base", F.explode("instances").alias("x"))
    overlaps = F.exists("base", lambda b: (b["start"] < F.col("x.end")) & (b["end"] > F.col("x.start")))
    return one.select("doc_id", "key", "x.*", overlaps.alias("seed"))


def _patterns() -> Column:
    """The patterns beside an instance: its side and word."""
    sides = F.array(
        F.struct(F.lit("left").alias("side"), F.col("left").alias("word")),
        F.struct(F.lit("right").alias("side"), F.col("right").alias("word")),
    )
    return F.explode(F.filter(sides, lambda p: p["word"] != ""))


def word_counts(docs: DataFrame, words: DataFrame) -> DataFrame:
    """How often the given words occur in all texts, cleaned as those beside instances are."""
    every = docs.select(F.explode(F.array_remove(F.split(texts(), SPACE), "")).alias("w"))
    cleaned = every.groupBy("w").agg(F.count("*").alias("n")).select(
        F.lower(F.regexp_replace("w", r"^[\p{Punct}]+|[.,;!?\"')]+$", "")).alias("word"), "n"
    )
    return cleaned.join(broadcast_checked(words), "word", "left_semi").groupBy("word").agg(
        F.sum("n").alias("n_word")
    )


def bootstrap(
    docs: DataFrame,
    found: DataFrame,
    rounds: int = ROUNDS,
    confidence: float = CONFIDENCE,
    support: int = SUPPORT,
) -> DataFrame:
    """Patterns (side, word) that are confident after the given rounds."""
    edges = materialize(
        found.select("value", "seed", _patterns().alias("p"))
        .groupBy("value", "p.side", "p.word")
        .agg(F.count("*").alias("n"), F.max("seed").alias("seed")),
        "pii-edges",
    )
    # Only patterns with enough different instances can pass; the others need no counts.
    wide = edges.groupBy("side", "word").agg(F.count("*").alias("size")).filter(F.col("size") >= support)
    wide = materialize(wide, "pii-patterns")
    totals = materialize(word_counts(docs, wide.select("word").distinct()), "pii-words")
    edges = materialize(
        edges.join(broadcast_checked(wide), ["side", "word"])
        .join(broadcast_checked(totals), "word")
        .withColumn("score", F.col("seed").cast("double")),
        "pii-edges",
    )
    for _ in range(rounds):
        scored = edges.groupBy("side", "word").agg(
            F.least(F.lit(1.0), F.sum(F.col("n") * F.col("score")) / F.max("n_word")).alias("conf"),
            F.sum((F.col("score") >= confidence).cast("int")).alias("support"),
        )
        patterns = materialize(scored.filter(F.col("support") >= support), "pii-patterns")
        best = edges.join(patterns, ["side", "word"]).groupBy("value").agg(F.max("conf").alias("best"))
        edges = materialize(
            edges.join(best, "value", "left")
            .withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("best", F.lit(0.0))))
            .drop("best"),
            "pii-edges",
        )
    return patterns.filter(F.col("conf") >= confidence).select("side", "word")


def discovered(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """Spans of unseen identifiers, gathered per document."""
    found = materialize(occurrences(scanned), "pii-instances")
    patterns = bootstrap(docs, found)
    unseen = found.filter(~F.col("seed")).select("doc_id", "key", "start", "end", _patterns().alias("p"))
    span = F.struct(
        "start", F.lit(len(KINDS)).alias("order"), "end", F.lit("id").alias("kind"), F.lit(True).alias("valid")
    )
    return (
        unseen.select("doc_id", "key", "start", "end", "p.side", "p.word")
        .join(broadcast_checked(materialize(patterns, "pii-confident")), ["side", "word"], "left_semi")
        .groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k"))
        .agg(F.collect_set(span).alias("added"))
    )


def find(docs: DataFrame, *kept: str) -> DataFrame:
    """The kept columns, ``base`` and ``spans``: base spans and those the method adds."""
    scanned = materialize(scan(docs, *dict.fromkeys(["doc_id", *kept])), "pii-scan")
    added = broadcast_checked(materialize(discovered(docs, scanned), "pii-added"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k"))
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(
        F.array_sort(F.concat("base", "added"))
    )
    return scanned.join(added, same, "left").select(*kept, "base", spans.alias("spans"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_pii_bootstrap(spark: SparkSession, folder: str) -> DataFrame:
    found = find(documents(table(spark, folder, "documents")), "doc_id")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


def mask(text: Column, spans: str) -> tuple[Column, Column]:
    """``merged``, the spans with overlapping ones as one, of the first one's kind; and the text
    with every one of them replaced by its kind in angle brackets.

    A span starts a new one if it starts at or behind the end of all before it. Both the ends
    before and the pieces of text are made block by block.
    """
    n = F.size(spans)
    blocks = _blocks(spans, n)

    def furthest(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda a, s: F.greatest(a, s["end"]))

    def running(lengths: Column, of) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends"))
        return F.aggregate(
            lengths,
            zero,
            lambda a, x: F.struct(F.greatest(a["at"], of(x)).alias("at"), F.concat(a["ends"], F.array(a["at"])).alias("ends")),
            lambda a: a["ends"],
        )

    before = F.flatten(
        F.zip_with(
            blocks,
            running(F.transform(blocks, furthest), lambda x: x),
            lambda block, so_far: F.transform(running(block, lambda s: s["end"]), lambda e: F.greatest(e, so_far)),
        )
    )
    seen = F.zip_with(
        spans, before,
        lambda s, e: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), e.alias("before")),
    )
    # A merged span ends where the next one's text before it begins to count: at its ``before``.
    first = F.filter(seen, lambda s: s["start"] >= s["before"])
    parts = _blocks("merged", F.size("merged"))

    def replaced(block: Column) -> Column:
        low = F.get(block, F.lit(0))["before"]
        own = F.substring(text, low + 1, F.get(block, F.size(block) - 1)["start"] - low)
        pieces = F.transform(
            block,
            lambda s: F.concat(F.substring(own, s["before"] - low + 1, s["start"] - s["before"]), F.lit("<"), s["kind"], F.lit(">")),
        )
        return F.when(F.size(block) > 0, F.array_join(pieces, "")).otherwise("")

    rest = F.substring(text, F.col("masked_to") + 1, F.length(text))
    whole = F.concat(F.array_join(F.transform(parts, replaced), ""), rest)
    return first, F.when(F.size("merged") == 0, text).otherwise(whole)


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with all spans masked, and the columns they came with, whatever their names."""
    merged, masked = mask(F.col(f"{GIVEN}.text"), "spans")
    found = find(carried(docs, "doc_id", "text"), GIVEN).withColumns(
        {"merged": merged, "masked_to": F.aggregate("spans", F.lit(0), lambda a, s: F.greatest(a, s["end"]))}
    )
    own = {"text": masked}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.length(masked).cast(docs.schema["n_chars"].dataType)
    return found.select(*[own.get(c, F.col(f"{GIVEN}.`{c}`")).alias(c) for c in docs.columns])
