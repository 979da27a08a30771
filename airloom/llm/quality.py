"""Quality rules: base counts of a text and its divergence from its language.

Every document gets two histograms: of character classes and of its language's common words. The
references are the same histograms summed over all documents of a language that pass the base
rules. A document is rejected when the Jensen-Shannon distance (square root of the divergence in
bits) to either reference is above its threshold and both are long enough to be judged.

Null text counts as empty; a document without words fails the base rules. A null or unknown
language has its own reference of character classes and no common words. Repeated rows get a row
each. An empty table gives no rows. Only doc_id, text and lang are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm.common import GIVEN, SPACE, WORD, carried, documents, materialize, table, texts
from airloom.session import broadcast_checked

# Common words of the languages, as they are written within a sentence.
COMMON_WORDS = {
    "en": "the of and to in is that for it as was with".split(),
    "fr": "le la les de des du et un une en que dans".split(),
    "de": "der die das und in zu den von mit ist des ein".split(),
    "es": "el la los las de del y en que un una por".split(),
}

# Counted character classes; the other characters in words are one more.
CLASSES = {"n_symbols": r"[#*$%&|<>]", "n_capitals": r"[A-Z]", "n_digits": r"[0-9]"}

#: Repeated windows that are searched for one by one in a text.
FEW = 12
#: Shortest document and reference, in words, that divergence judges.
MIN_WORDS = 60
MIN_REFERENCE_WORDS = 2000
#: Largest accepted distances. A few words scatter more than many do: that of words is widened by
#: WORD_NOISE over the square root of their number.
MAX_CLASS_DISTANCE = 0.32
MAX_WORD_DISTANCE = 0.19
WORD_NOISE = 1.0


def histograms(docs: DataFrame) -> DataFrame:
    """Adds ``words``, ``n_words``, ``word_chars``, a column per class, ``class_counts`` and
    ``word_counts``, whose last entry counts all other words."""
    every = sorted({w for words in COMMON_WORDS.values() for w in words})
    listed = F.array().cast("array<string>")
    for name, words in COMMON_WORDS.items():
        listed = F.when(F.col("lang") == name, F.array(*map(F.lit, words))).otherwise(listed)
    out = docs.withColumn("words", F.array_remove(F.split(texts(), SPACE), ""))
    out = out.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "common": F.filter("words", lambda w: w.isin(every)),
            **{k: F.regexp_count(texts(), F.lit(v)).cast("long") for k, v in CLASSES.items()},
        }
    )
    rest = F.col("word_chars")
    for k in CLASSES:
        rest = rest - F.col(k)
    out = out.withColumns(
        {
            "class_counts": F.array(*CLASSES, rest),
            "word_counts": F.transform(
                listed,
                lambda w: (F.size("common") - F.size(F.array_remove("common", w))).cast("long"),
            ),
        }
    )
    others = F.aggregate("word_counts", F.col("n_words"), lambda a, x: a - x)
    return out.withColumn("word_counts", F.concat("word_counts", F.array(others))).drop("common")


def repeated_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words in 3-word windows found twice or more in the text.

    Windows are hashed; equal neighbours among the sorted hashes are the repeated ones. Where they
    are few, their places are looked up; otherwise hashes are sorted with their places.
    """
    grams = F.transform(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
    )
    some = F.size(F.array_distinct("grams")) < F.size("grams")
    again = F.array_distinct(
        F.filter("ordered", lambda h, i: F.coalesce(F.get("ordered", i - 1) == h, F.lit(False)))
    )
    looked_up = F.filter(
        F.transform("grams", lambda h, i: F.when(F.array_contains("again", h), i)),
        lambda i: i.isNotNull(),
    )

    def twin(e: Column, i: Column) -> Column:
        before, after = F.get("placed", i - 1)["h"], F.get("placed", i + 1)["h"]
        return F.coalesce(before == e["h"], F.lit(False)) | F.coalesce(after == e["h"], F.lit(False))

    few = F.size("again") <= FEW
    placed = F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    merged = F.sort_array(F.transform(F.filter("placed", twin), lambda e: e["i"]))
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, x: F.struct(
            (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")
        ),
        lambda a: a["n"].cast("long"),
    )
    out = df.withColumn("grams", grams).withColumn("ordered", F.when(some, F.sort_array("grams")))
    out = out.withColumn("again", again).withColumn("placed", F.when(~few, placed))
    out = out.withColumn("places", F.when(few, looked_up).otherwise(merged))
    counted = F.coalesce(covered, F.lit(0).cast("long"))
    return out.withColumn("n_repeat_words", counted).drop(
        "grams", "ordered", "again", "placed", "places"
    )


def base_rules(docs: DataFrame) -> DataFrame:
    """Histograms, the contract's counts, and ``base_failed``."""
    lines = F.filter(F.split(texts(), "\n", -1), lambda x: x.rlike(WORD))
    out = repeated_words(histograms(docs)).withColumn("lines", lines)
    too_short = F.col("n_words") < 50
    repeats = 100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    return out.withColumns(
        {
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "base_failed": too_short | repeats,
        }
    ).drop("lines", "words")


def _shares(counts: str, total: Column) -> Column:
    return F.transform(counts, lambda x: x / F.nullif(total, F.lit(0)))


def references(counted: DataFrame) -> DataFrame:
    """Per language the histograms, as shares, of all documents that pass the base rules."""
    longest = max(map(len, COMMON_WORDS.values())) + 1
    zero = F.lit(0).cast("long")

    def summed(column: str, n: int) -> Column:
        return F.array(*[F.sum(F.coalesce(F.get(column, F.lit(i)), zero)) for i in range(n)])

    sums = (
        counted.filter(~F.col("base_failed"))
        .groupBy(F.col("lang").alias("ref_lang"))
        .agg(
            F.sum("n_words").alias("ref_n_words"),
            F.sum("word_chars").alias("ref_chars"),
            summed("class_counts", len(CLASSES) + 1).alias("classes"),
            summed("word_counts", longest).alias("words"),
        )
    )
    return sums.select(
        "ref_lang",
        "ref_n_words",
        _shares("classes", F.col("ref_chars")).alias("ref_classes"),
        _shares("words", F.col("ref_n_words")).alias("ref_words"),
    )


def distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance, from 0 to 1, of two arrays of shares; the shorter is padded."""
    zero = F.lit(0.0)

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(zero)

    def both(x: Column, y: Column) -> Column:
        x, y = F.coalesce(x, zero), F.coalesce(y, zero)
        return part(x, y) + part(y, x)

    summed = F.aggregate(F.zip_with(p, q, both), zero, lambda a, x: a + x)
    return F.sqrt(F.greatest(summed / 2, zero))


def judge(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    min_reference_words: int = MIN_REFERENCE_WORDS,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    word_noise: float = WORD_NOISE,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """The given rows, without the columns in ``drop``, with counts, both distances,
    ``base_failed`` and ``kept``.

    Texts are read once and never shuffled: the counts are written, the references summed from
    them, a row per language, and broadcast if they prove small.
    """
    counted = materialize(base_rules(docs).drop(*drop), "counted-rules")
    seen = materialize(references(counted), "language-references")
    out = counted.join(
        broadcast_checked(seen), F.col("lang").eqNullSafe(F.col("ref_lang")), "left"
    )
    out = out.withColumns(
        {
            "p_classes": _shares("class_counts", F.col("word_chars")),
            "p_words": _shares("word_counts", F.col("n_words")),
        }
    ).withColumns(
        {
            "class_distance": distance("p_classes", "ref_classes"),
            "word_distance": F.when(F.size("p_words") > 1, distance("p_words", "ref_words")),
        }
    )
    far = (F.coalesce(F.col("class_distance"), F.lit(0.0)) > max_class_distance) | (
        F.coalesce(F.col("word_distance"), F.lit(0.0))
        > max_word_distance + F.lit(word_noise) / F.sqrt(F.greatest("n_words", F.lit(1)))
    )
    judged = (F.col("n_words") >= min_words) & (F.col("ref_n_words") >= min_reference_words)
    rejected = F.coalesce(judged & far, F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~rejected).drop(
        "class_counts", "word_counts", "p_classes", "p_words",
        "ref_lang", "ref_n_words", "ref_classes", "ref_words",
    )


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(table(spark, folder, "documents"), "lang")
    return judge(docs, drop=("text",)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass, with the columns they came with, whatever their names."""
    given = carried(docs, "text", "lang")
    return judge(given, drop=("text",)).filter("kept").select(f"{GIVEN}.*")


def _common_sql() -> str:
    rows = [f"('{lang}', '{w}')" for lang, words in COMMON_WORDS.items() for w in words]
    return f"select * from (values {', '.join(rows)}) as v(lang, bin)"


_WORD = r"[^\x20\x09-\x0D]+"

SQL = f"""
with words as (
    select doc_id, lang, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w
    from documents),
places as (select doc_id, w, unnest(range(1, len(w) - 1)) as i from words where len(w) > 2),
grams as (
    select doc_id, i, count(*) over (partition by doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) as n
    from places),
again as (
    select doc_id, count(distinct i + k) as n
    from grams, (select unnest([0, 1, 2]) as k) where n > 1 group by doc_id),
lines as (
    select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as l
    from words),
counts as (
    select doc_id, lang, w, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
           {", ".join(f"len(regexp_extract_all(t, '{v}'))::bigint as {k}" for k, v in CLASSES.items())},
           (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(again.n, 0) as n_repeat_words
    from words join lines using (doc_id) left join again using (doc_id)),
base as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts),
listed as (
    select doc_id, base.lang, 'word' as kind, bin, len(list_filter(w, lambda x: x = bin)) as n, n_words as total
    from base join ({_common_sql()}) using (lang)),
bins as (
    select doc_id, lang, 'class' as kind, unnest([{", ".join(f"'{k}'" for k in CLASSES)}, 'rest']) as bin,
           unnest([{", ".join(CLASSES)}, word_chars - {" - ".join(CLASSES)}]) as n, word_chars as total
    from base
    union all select * from listed
    union all select doc_id, lang, kind, '', total - sum(n), total from listed group by doc_id, lang, kind, total),
refs as (
    select b.lang, kind, bin, sum(n) / nullif(sum(total), 0) as q, sum(n_words) as ref_n_words
    from bins b join base using (doc_id) where not base_failed group by b.lang, kind, bin),
shares as (
    select doc_id, b.kind, n / nullif(total, 0) as p, q, ref_n_words
    from bins b join refs r on b.lang is not distinct from r.lang and b.kind = r.kind and b.bin = r.bin),
distances as (
    select doc_id, kind, max(ref_n_words) as ref_n_words, sqrt(greatest(sum(
        case when p > 0 then p * log2(2 * p / (p + q)) else 0 end
        + case when q > 0 then q * log2(2 * q / (p + q)) else 0 end) / 2, 0)) as d
    from shares where p is not null group by doc_id, kind),
far as (
    select distinct doc_id from distances join base using (doc_id)
    where n_words >= {MIN_WORDS} and ref_n_words >= {MIN_REFERENCE_WORDS}
      and d > case kind when 'class' then {MAX_CLASS_DISTANCE}
                        else {MAX_WORD_DISTANCE} + {WORD_NOISE} / sqrt(n_words) end)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and doc_id not in (select doc_id from far) as kept
from base"""
