"""Operators against brute force, on small frames with nulls, ties, repeated rows and long texts."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airloom.llm import (
    chat, components, decontaminate, near_dedup, pieces, pii, quality, secret_scan,
    substring_dedup, suffix_dedup, token_counts,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, root long"
LETTERS = "the of and thin erst onha nding tion re ly ou ea".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choices(LETTERS, k=r.randint(1, 3))) for _ in range(n))


def corpus():
    """Texts with shared passages, copies, near copies, edges; columns that clash with inner ones."""
    line = prose(70, "line")
    texts = [prose(120, i) for i in range(12)]
    texts += [prose(20, f"a{i}") + " " + line + "\n" + prose(20, f"b{i}") for i in range(25)]
    base = prose(300, "base").split()
    for i in range(12):
        words = list(base)
        words[(i * 37) % 300] = f"edit{i}"
        texts.append(" ".join(words))
    texts += [texts[0], texts[0], "", " \n\t", "one", "one", "two words", None, None, "a " * 400]
    texts += [prose(4000, "long"), "é漢 ü\x0b" + prose(90, "u"), "漢字" * 300, prose(60, "x").upper()]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    texts = corpus()
    rows = [(i, t, ["en", "fr", None][i % 3], "s", 0, 7, 9) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


@pytest.mark.parametrize("shard", [400_000, 500])
def test_substring_dedup(docs, shard):
    texts = by_id(docs)
    words = {i: WORD.findall(t) for i, t in texts.items()}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][j : j + 50]), i)
    found = substring_dedup.dedup(docs, shard_words=shard).collect()
    assert len(found) == docs.count()
    for row in found:
        own = words[row["doc_id"]]
        gone = [False] * len(own)
        for j in range(len(own) - 49):
            if first[tuple(own[j : j + 50])] < row["doc_id"]:
                gone[j : j + 50] = [True] * 50
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        assert (row["n_words"], row["n_removed"], row["kept"]) == (len(own), sum(gone), kept)


@pytest.mark.parametrize("shard", [2_000_000, 2_000])
def test_suffix_dedup(docs, shard):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    seen = Counter(t[j : j + 200] for _, t in rows for j in range(len(t) - 199))
    wanted = []
    for i, t in rows:
        gone = bytearray(len(t))
        for j in range(len(t) - 199):
            if seen[t[j : j + 200]] > 1:
                gone[j : j + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        wanted.append((i, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    found = suffix_dedup.dedup(docs, shard_bytes=shard).collect()
    assert sorted(wanted) == sorted((*tuple(r)[:4], bytes(r["kept"])) for r in found)


def test_radix_groups_are_the_repeated_windows():
    r = np.random.default_rng(1)
    values = r.integers(0, 2, 3000).astype(np.uint64)
    starts = np.arange(3000 - 12)
    found, member = suffix_dedup.radix_groups(values, starts, 12)
    windows = Counter(values[s : s + 12].tobytes() for s in starts)
    assert sorted(found) == [s for s in starts if windows[values[s : s + 12].tobytes()] > 1]
    same = {}
    for s, g in zip(found.tolist(), member.tolist(), strict=True):
        assert same.setdefault(g, values[s : s + 12].tobytes()) == values[s : s + 12].tobytes()


def test_automaton_statistics():
    r = random.Random(3)
    automaton, known = substring_dedup.Automaton(), []
    for _ in range(30):
        words = [r.randint(0, 3) for _ in range(r.randint(1, 25))]
        grams = {tuple(k[a:b]) for k in known for a in range(len(k)) for b in range(a + 1, len(k) + 1)}
        wanted = [
            max((n for n in range(1, min(6, i + 1) + 1) if tuple(words[i + 1 - n : i + 1]) in grams), default=0)
            for i in range(len(words))
        ]
        assert automaton.statistics(words, 6) == wanted
        automaton.add(words)
        known.append(words)


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def components_of(sets, percent):
    ids = sorted(sets)
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_dedup(docs, size, percent, monkeypatch):
    # Small limits send the near copies through blocks and forests too.
    monkeypatch.setattr(near_dedup, "SMALL", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    sets = {i: shingles(t, size) for i, t in by_id(docs).items()}
    wanted = components_of(sets, percent)
    found = near_dedup.classes(docs, size, percent).collect()
    assert len(found) == docs.count()
    for r in found:
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), wanted[r["doc_id"]])


def test_links_beside_refused_best_edges(spark, monkeypatch):
    # The smallest of a bucket is a little too far from two others, which are linked.
    monkeypatch.setattr(near_dedup, "SMALL", 1)
    monkeypatch.setattr(near_dedup, "BANDS", 2)
    monkeypatch.setattr(near_dedup, "_SEEDS", near_dedup._SEEDS[: 2 * near_dedup.ROWS])
    r = random.Random(11)
    base = [f"w{r.randrange(10**9)}" for _ in range(1800)]
    texts = [" ".join(base)]
    for name in "xy":
        words = list(base)
        for i in range(49):
            words[20 + 36 * i] = f"{name if i else 'same'}{i}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = components_of({i: shingles(t, 3) for i, t in enumerate(texts)}, 85)
    assert wanted == {0: 0, 1: 1, 2: 1}
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.classes(docs).collect()} == wanted


@pytest.mark.parametrize("n", [12, 60, 170, 650, 3000, 20000])
def test_odd_sketches_keep_links_and_drop_others(n):
    r = np.random.default_rng(n)
    near, kept = 0.85, {}
    for share in (0.7, near, 0.9):
        results = []
        for _ in range(60):
            x = r.permutation(np.unique(r.integers(0, 2**64, 2 * n, dtype=np.uint64)))
            other = int(n * (1 - share) / (1 + share))
            grown = r.integers(0, max(1, int(0.1 * other) + 1))
            a, b = np.sort(x[:n]), np.sort(x[other - grown : n + other])
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            m, s = near_dedup.odd_sketch(a)
            k, t = near_dedup.odd_sketch(b)
            surplus = near_dedup._surpluses(s, t[None, :], np.array([m + k]), len(a), np.array([len(b)]), near)[0]
            results.append((true, surplus >= 0))
        assert all(passed for true, passed in results if true >= near)
        kept[share] = sum(passed for _, passed in results)
    if n > 12:
        assert kept[0.7] == 0


@pytest.mark.parametrize("task_links", [10**6, 7])
def test_components(spark, task_links):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + r.randint(0, 50), 100 + r.randint(0, 50)) for _ in range(40)]
    edges += [(500, i) for i in range(501, 560)] + [(7, 7)]
    found = {x["node"]: x["component"] for x in components.components(spark.createDataFrame(edges, "a long, b long"), task_links).collect()}
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        top[y] = x
    assert found == {n: find(n) for n in list(top)}


def test_components_of_a_long_path_take_few_levels(spark, monkeypatch):
    r = random.Random(5)
    names = r.sample(range(10**9), 100_001)
    links = [(min(a, b), max(a, b)) for a, b in zip(names, names[1:], strict=False)]
    links += [(5 * 10**9, 5 * 10**9 + i) for i in range(1, 300)]
    levels, contracted = [], components._contracted

    def counted(links, level):
        levels.append(level)
        return contracted(links, level)

    monkeypatch.setattr(components, "_contracted", counted)
    found = components.components(spark.createDataFrame(links, "a long, b long"), 1000)
    sizes = {x["component"]: x["count"] for x in found.groupBy("component").count().collect()}
    assert sizes == {min(names): 100_001, 5 * 10**9: 300}
    assert len(levels) <= 8


def test_token_counts(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = by_id(docs)
    for chunk, overlap in ((32_768, 512), (80, 8)):
        for r in token_counts.count_tokens(docs, path, 100, chunk, overlap).collect():
            text = texts[r["doc_id"]]
            n = len(library.encode(text, add_special_tokens=False))
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 100)


def test_chunks_of_odd_texts():
    import public_tokenizers

    counter = token_counts.Counter.of(public_tokenizers.path("word_bpe_49k.json"))
    r = random.Random(4)
    odd = ["a" * 700, "x's" * 300, "é " * 200, "́ ́a" * 90, "<|endoftext|> " * 40, "aa " + "b" * 900 + " c"]
    odd += ["".join(r.choice(" \n\ta'sé漢1.,!\x1c\x85") for _ in range(2000)) for _ in range(4)]
    for text in odd:
        whole = len(counter.tokenizer.encode(text, add_special_tokens=False))
        assert counter.by_chunks(text, 60, 4)[0] == whole
        assert counter.by_words([text.encode()]) == [whole]
    assert counter.by_chunks("aa " + "b" * 900 + " c", 60, 4)[2] > 0


def test_decontamination(spark, docs):
    rare = prose(40, "item")
    texts = ["start " + prose(900, "d1") + " " + rare.upper() + "! " + prose(900, "d2"), rare[: len(rare) // 2], "Two, words"]
    rows = [(1000 + i, t) for i, t in enumerate(texts)]
    given = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    items = [(1, rare, "x"), (1, rare, "x"), (2, "two words", "x"), (3, None, "x"), (4, "", "x"), (5, prose(30, "none"), "x")]
    items = spark.createDataFrame(items, "item_id long, text string, doc_id string")

    def words(text):
        return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())

    def sets(text):
        w = words(text)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}

    wanted = set()
    for d in given.distinct().collect():
        for i in items.distinct().collect():
            want = sets(i["text"])
            n = len(want & sets(d["text"]))
            if want and n >= 0.8 * len(want) - 1e-9:
                wanted.add((d["doc_id"], i["item_id"], n, len(want)))
    assert {(1000, 1), (1002, 2)} <= {w[:2] for w in wanted}
    for limit in (10**9, 0):
        assert {tuple(r) for r in decontaminate.contained(given, items, broadcast_bytes=limit).collect()} == wanted
    assert decontaminate.contained(given, items.limit(0)).count() == 0


def test_pieces(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    texts = by_id(docs)
    encoded = pieces.encode(docs, pieces.model_path())
    for r in encoded.collect():
        assert r["ids"] == library.encode(texts[r["doc_id"]])
    assert all(r["text"] == texts[r["doc_id"]] for r in pieces.decode(encoded, pieces.model_path()).collect())
    assert all(r["round_trip"] for r in pieces.digests(docs, pieces.model_path()).collect())


def test_pieces_of_odd_texts():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    own = pieces.Pieces.of(pieces.model_path())
    r = random.Random(6)
    odd = [" " * k + "the" + " " * (k % 7) for k in range(30)] + ["a" * 90, "\n\n\t", "ﬁ Ａ №", "\x00😀 é"]
    odd += ["".join(r.choice("then ing") for _ in range(200)) for _ in range(40)]
    for text in odd:
        ids = own.encode([text])[0]
        assert ids.tolist() == library.encode(text)
        assert own.decode(ids) == text
    words = ["".join(r.choice("thenig") for _ in range(9)) for _ in range(200)]
    assert own._together(words) == [own._alone(w) for w in words]
    assert own.decode(own.encode(["a▁b"])[0]) == "a b"


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def valid(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "phone":
            return 10 <= len(digits) <= 15
        if kind == "card":
            parts = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            return 14 <= len(digits) <= 19 and sum(p - 9 * (p > 9) for p in parts) % 10 == 0
        return True

    found = [
        (m.start(), order, m.end(), kind)
        for order, (kind, pattern) in enumerate(KINDS.items())
        for m in re.finditer(pattern, text)
        if valid(kind, m.group())
    ]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


def test_pii_base(spark, tmp_path):
    r = random.Random(8)
    alphabet = ["@", ".", "a", "b-", "+1", "12", "255", " ", "(499) ", "4", "1.2.3.4", "x@y.z", "_", "é", "-", "000", "\n"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(400)]
    texts += [None, "", "4" * 3000, "a@" * 900, "1." * 1500, "+" + "1(" * 900 + "1", "a" * 9000 + "@b.c_d@e.f"]
    texts += ["call +1 (499) 555-6503 or 4111 1111 1111 1111, mail x.y@mail2.example.com at 10.0.0.256 or 010.1.1.1"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for row in pii.op6_pii_bootstrap(spark, str(tmp_path)).collect():
        spans = base_spans(texts[row["doc_id"]] or "")
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), texts[row["doc_id"]]
        assert [row[f"n_{k}"] for k in KINDS] == [sum(s.startswith(k) for s in spans) for k in KINDS]
        assert set(spans) <= set(row["spans"].split(","))


def test_pii_bootstrap_and_mask(spark):
    rows = [(i, f"{prose(20, i)} passport: user{i}@mail.example.com {prose(20, -i)}") for i in range(30)]
    rows += [(100 + i, f"{prose(9, i)} passport: AB{i}4711Q {prose(5, i)} number {i}12345") for i in range(4)]
    rows += [(200, None), (201, ""), (100, rows[30][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs, "doc_id").collect()}
    for i in range(4):
        (span,) = found[100 + i]
        assert span["kind"] == "id"
        assert rows[30 + i][1][span["start"] : span["end"]] == f"AB{i}4711Q"
    masked = {r["doc_id"]: r["text"] for r in pii.stage(spark, docs, "").collect()}
    assert masked[0] == rows[0][1].replace("user0@mail.example.com", "<email>")
    assert masked[102] == rows[32][1].replace("AB24711Q", "<id>")
    assert masked[201] == ""


def test_words_behind_long_gaps_are_context(spark):
    def doc(i, gap):
        return f"{prose(20, i)} passport:{gap}user{i}@mail.example.com {prose(20, -i)}"

    rows = [(i, doc(i, " ")) for i in range(30)] + [(100, f"{prose(9, 1)} passport:{' ' * 300}AB4711Q\n\n{prose(9, 2)}")]
    found = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()}
    (span,) = found[100]
    assert rows[30][1][span["start"] : span["end"]] == "AB4711Q"


def test_texts_full_of_matches(spark):
    r = random.Random(14)
    pieces_ = [r.choice(["10.0.0.1", "+1 499 555 65 03", "a@b.cd", "x", "4111 1111 1111 1111", "12"]) for _ in range(6000)]
    text = " é ".join(pieces_)
    docs = spark.createDataFrame([(1, text), (2, "+1 499 a@b.cd")], "doc_id long, text string")
    spans = {x["doc_id"]: x["base"] for x in pii.find(docs, "doc_id").collect()}[1]
    assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in spans] == base_spans(text)
    masked, at, kinds = [], 0, [s for s in spans]
    for s in kinds:
        if s["start"] >= at:
            masked += [text[at : s["start"]], f"<{s['kind']}>"]
        at = max(at, s["end"])
    (row,) = (x for x in pii.stage(spark, docs, "").collect() if x["doc_id"] == 1)
    assert row["text"] == "".join(masked) + text[at:]


def test_mask_merges_overlaps(spark):
    text = "ab+1 (499) 555-65 03 03@x.yz end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = pii.stage(spark, docs, "").collect()
    spans = [tuple(map(int, s.split(":")[1:])) for s in base_spans(text)]
    assert row["text"].count("<") < len(spans) + 1
    assert row["text"].startswith("ab<") and row["text"].endswith(" end")


def test_quality_counts(docs):
    for r in quality.judge(docs).collect():
        text = r["text"] or ""
        words = WORD.findall(text)
        grams = Counter(zip(words, words[1:], words[2:], strict=False))
        again = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        wanted = (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(again),
        )
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == wanted
        assert r["base_failed"] == (len(words) < 50 or 100 * len(again) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_quality_verdict(spark):
    r = random.Random(9)
    common = quality.COMMON_WORDS["en"]

    def text(clean):
        words = [r.choice(common) if clean and r.random() < 0.4 else prose(1, r.random()) for _ in range(150)]
        return " ".join(words) if clean else " | ".join(w.upper() for w in words)

    rows = [(i, text(i % 10 > 0), "en") for i in range(60)]
    found = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {x["doc_id"] for x in found.filter("not kept").collect()} == set(range(0, 60, 10))


def test_distance(spark):
    frame = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0], [0.5, 0.5])], "a array<double>, b array<double>, c array<double>")
    row = frame.select(quality.distance("a", "b").alias("x"), quality.distance("c", "c").alias("y"), quality.distance("a", "c").alias("z")).first()
    assert row["x"] == pytest.approx(1.0) and row["y"] == 0.0
    # Of (1, 0) and (1/2, 1/2): their mean is (3/4, 1/4).
    wanted = (np.log2(4 / 3) + 0.5 * np.log2(2 / 3) + 0.5 * np.log2(2)) / 2
    assert row["z"] == pytest.approx(wanted**0.5, abs=1e-9)


def test_chat(spark):
    rows = [(1, t, ["anna", "bo", "system", None][t % 4], f"m{t}") for t in range(200)]
    rows += [(2, 0, "system", "s"), (3, None, "anna", None), (3, 1, "bo", "<|im_end|>"), (None, 1, "bo", "x"), rows[0]]
    found = chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 64).collect()
    assert {(r["conv_id"], r["perspective"]) for r in found} == {(1, "anna"), (1, "bo"), (1, "unknown"), (3, "anna"), (3, "bo")}
    own = sorted((r for r in found if (r["conv_id"], r["perspective"]) == (1, "bo")), key=lambda r: r["part"])
    # The repeated message is there twice.
    assert [r["n_messages"] for r in own] == [64, 64, 64, 9]
    whole = "".join(r["text"] for r in own)
    assert re.findall(r"m\d+", whole) == ["m0", *(f"m{t}" for t in range(200))]
    assert whole.startswith("<|im_start|>user name=anna\nm0<|im_end|>\n" * 2 + "<|im_start|>assistant\nm1<|im_end|>\n")
    said = [r["text"][int(a) : int(b)] for r in own for a, b in (s.split(":") for s in r["mask"].split(","))]
    assert said == [f"m{t}<|im_end|>" for t in range(1, 200, 4)]
    for limit in (1000, 7):
        hot = [(5, None, "a", "ok"), (5, 3, "b", "x")] * 40 + [(5, 3, "b", f"y{t % 20}") for t in range(60)]
        hot = spark.createDataFrame(hot, "conv_id long, turn long, role string, text string")
        placed = sorted(tuple(r) for r in chat.numbered(hot, limit).collect())
        wanted = sorted((r["turn"] is not None, r["role"], r["text"]) for r in hot.collect())
        assert sorted((r[3], *r[1:3]) for r in placed) == [(i, role, text) for i, (_, role, text) in enumerate(wanted)]
    (third,) = (r for r in found if (r["conv_id"], r["perspective"]) == (3, "anna"))
    assert third["text"] == "<|im_start|>assistant\n<|im_end|>\n<|im_start|>user name=bo\n<| im_end |><|im_end|>\n"


def test_secret_scan(spark):
    r = random.Random(11)

    def hexes(n):
        return "".join(r.choice("0123456789abcdef") for _ in range(n))

    rows, secret = [], {}
    for i in range(300):
        value = hexes(40)
        kind = i % 3
        before = ['token = "', "checksum: ", "order "][kind]
        value = value if kind < 2 else "".join(r.choice("0123456789") for _ in range(16))
        rows.append((i, f"{prose(15, i)} {before}{value} {prose(15, -i)}", "src"))
        secret[i] = kind == 0
    rows += [(900, None, None), (901, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    words = secret_scan.dictionary(docs)
    found = secret_scan.findings(docs, secret_scan.Language(words))
    # The forest learns from half of the findings and is held to the other half.
    train = secret_scan.weak_labels(found.filter("doc_id % 2 = 0"))
    held = secret_scan.classify(found.filter("doc_id % 2 = 1"), train).collect()
    right = sum(x["is_secret"] == secret[x["doc_id"]] for x in held)
    assert len(held) == 150 and right >= 0.95 * len(held)
    for x in held:
        assert rows[x["doc_id"]][1][x["start"] : x["end"]] == x["candidate"]


def test_rare_secrets_are_trained_on(spark):
    r = random.Random(12)
    rows = [(i, f"{prose(9, i)} " + " ".join(f"order {r.randrange(10**15, 10**16)}" for _ in range(200)), "hot") for i in range(20)]
    values = ["AKIA" + "".join(r.choices("ABCDEFGH2345", k=15)) + "7", *("".join(r.choices("0123456789abcdef", k=40)) for _ in range(3))]
    rows += [(100 + i, f'{prose(9, -i)} token = "{v}" {prose(9, i)}', "src") for i, v in enumerate(values)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secret_scan.findings(docs, secret_scan.Language(secret_scan.dictionary(docs)))
    judged = secret_scan.classify(found, secret_scan.weak_labels(found), rows=50)
    assert judged.count() == 4004
    assert {x["candidate"] for x in judged.filter("is_secret").collect()} == set(values)


def test_assigned_values_of_any_kind_are_findings(spark):
    key = "0123456789abcdef0123"
    texts = ["password = hunter2.", 'api_key: "p@ss wörd"', "Secret='x'", "token=correcthorse, then", f'token = "{key}"', 'password = "" # none']
    rows = [(i, t, "src") for i, t in enumerate(texts)] + [(9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secret_scan.findings(docs, secret_scan.Language({}))
    wanted = [(0, "hunter2"), (1, "p@ss wörd"), (2, "x"), (3, "correcthorse"), (4, key)]
    assert sorted((x["doc_id"], x["candidate"]) for x in found.collect()) == wanted
    assert all(texts[x["doc_id"]][x["start"] : x["end"]] == x["candidate"] for x in found.collect())
    assert secret_scan.classify(found, secret_scan.weak_labels(found)).count() == 5


@pytest.mark.parametrize(
    "run",
    [
        lambda d: substring_dedup.dedup(d),
        lambda d: suffix_dedup.dedup(d),
        lambda d: near_dedup.classes(d),
        lambda d: quality.judge(d),
        lambda d: pii.find(d, "doc_id"),
        lambda d: pieces.digests(d, pieces.model_path()),
        lambda d: secret_scan.scan(d),
        lambda d: chat.rotate(d.select(F.col("doc_id").alias("conv_id"), F.col("key").alias("turn"), F.col("lang").alias("role"), "text")),
    ],
)
def test_empty_tables(empty, run):
    assert run(empty).count() == 0
