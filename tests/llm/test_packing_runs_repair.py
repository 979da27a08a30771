"""Packing, runs and repair against the library, brute force and SQL."""

import hashlib
import os
import random
import sys
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

from airloom.llm import packing, periodic_runs, queries, repair

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from check import mismatch  # noqa: E402

DOCS = "doc_id long, text string, length long, spans string, runs string"
TURNS = "conv_id long, turn long, role string, text string, blank string, block int"


# Packing


@pytest.fixture(scope="module")
def tokens():
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*library.encode(text or "", add_special_tokens=False).ids, 0]


def packed(docs, limits=packing.Limits(), **more):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack(docs, path, public_tokenizers.PATTERN, limits, **more)


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choices("the of and thin erst onha".split(), k=r.randint(1, 3))) for _ in range(n))


def texts():
    odd = [None, "", " ", "\n\n", "a", "a", "<|endoftext|>", "x <|endoftext|><|endoft", "é漢 ü\x0b😀 's I'm", "z" * 9000]
    return [*odd, *(prose(n, n) for n in (1, 5, 80, 300, 700, 700, 900, 4000)), *(prose(30, -i) for i in range(60))]


@pytest.mark.parametrize(
    "limits", [packing.Limits(), packing.Limits(64, 3, 64), packing.Limits(100, 50, 20), packing.Limits(1, 1, 1)]
)
def test_packing_is_whole_and_within_limits(spark, tokens, limits):
    given = list(enumerate(texts()))
    rows = [(i, t, 3, None, "x") for i, t in given] + [(None, "no id", 1, None, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    pieces = packed(docs, limits, window=16).collect()
    wanted = {i: tokens(t) for i, t in [*given, (None, "no id")]}
    found, sequences = {}, {}
    for p in pieces:
        found.setdefault(p["doc_id"], []).append((p["start"], np.frombuffer(p["ids"], "<u4").tolist(), p["length"]))
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"], p["n_loss"], p["segment"]))
        assert p["doc_tokens"] == len(wanted[p["doc_id"]])
    assert set(found) == set(wanted)
    for i, own in found.items():
        own.sort()
        assert [x for _, ids, _ in own for x in ids] == wanted[i]
        assert [s for s, _, _ in own] == np.cumsum([0] + [n for _, _, n in own])[:-1].tolist()
        assert all(len(ids) == n > 0 for _, ids, n in own)
    for own in sequences.values():
        own.sort()
        held = sum(n for _, n, _, _ in own)
        assert [o for o, *_ in own] == np.cumsum([0] + [n for _, n, *_ in own])[:-1].tolist()
        assert held <= limits.tokens and len(own) <= limits.segments and sum(x[2] for x in own) <= limits.loss
        assert held == limits.tokens or held & (held - 1) == 0
    if limits == packing.Limits():
        # Whole examples first: few are cut beyond what their length asks for.
        assert len(pieces) < sum(-(-len(w) // limits.tokens) for w in wanted.values()) + 40


def test_packing_counts_loss_from_spans(spark, tokens):
    text = "user: héllo there\nassistant: fine, thänks 😀"
    a = text.index("fine")
    rows = [(1, text, 0, f"{a}:{len(text)}", None), (2, text, 0, "0:4", None), (3, text, 0, None, None), (4, "", 0, "0:0", None)]
    pieces = packed(spark.createDataFrame(rows, DOCS), spans="spans").collect()
    total = {}
    for p in pieces:
        total[p["doc_id"]] = total.get(p["doc_id"], 0) + p["n_loss"]
    tail = len(tokens(" " + text[a:]))
    assert total == {1: tail, 2: 1, 3: 0, 4: 1} and tail > 5


def test_texts_in_parts_have_the_ids_of_the_whole(tokens):
    import public_tokenizers

    encoder = packing.Encoder.of(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    r = random.Random(5)
    for seed in range(20):
        text = "".join(r.choice([" ", "  ", "a", "'s", "é", "\n", "1", ".", "<|endoftext|>"]) for _ in range(900))
        ids = [encoder.encoding.encode(p, allowed_special="all") for p in packing.parts(text, 30)]
        assert len(ids) > 5 and sum(ids, []) + [0] == tokens(text) == encoder.ids(text).tolist()


def test_packing_runs_alike_again(spark, tmp_path):
    rows = [(i, t, 3, None, "x") for i, t in enumerate(texts())]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    one, two = (sorted(packing.op11_vector_packing(spark, str(tmp_path)).collect()) for _ in range(2))
    assert one == two
    assert sum(r["length"] for r in one) == sum(r["doc_tokens"] for r in one if r["start"] == 0)


# Runs


def runs_of(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(
        (s, n, q) for s, n, q in found
        if not any(p < q and t <= s and t + m >= s + n for t, m, p in found)
    )


def periodic_texts():
    r = random.Random(21)
    out = [None, "", " \n", "a", "a " * 5, "a " * 6, "ab " * 700, "a b\ta b\na b  a b a", "x " + "p q r " * 9 + "p y"]
    for k in range(150):
        words = r.choices("abc", k=r.randint(0, 90))
        at = r.randint(0, len(words))
        words[at:at] = r.choices("abcdefg", k=r.randint(1, 9)) * r.randint(1, 7)
        out.append(" ".join(words))
    return out


def test_runs_are_those_of_brute_force(spark):
    given = list(enumerate(periodic_texts()))
    rows = [(i, t, 0, None, "x") for i, t in given] + [(3, "a", 0, None, None)] * 2
    found = periodic_runs.find(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len(rows)
    for r in found:
        words = (given[r["doc_id"]][1] or "").split()
        wanted = runs_of(words)
        assert [(x["start"], x["length"], x["period"]) for x in r["runs"]] == wanted
        gone = {i for s, n, q in wanted for i in range(s + q, s + n)}
        assert r["collapsed"].decode() == " ".join(w for i, w in enumerate(words) if i not in gone)
        assert r["n_words"] == len(words)


def test_planted_runs_query(spark, tmp_path):
    given = [(i * 7919, prose(40 + i, i)) for i in range(120)] + [(None, "a b"), (5, None)]
    spark.createDataFrame(given, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    planted = 0
    for r in periodic_runs.op12_periodic_runs(spark, str(tmp_path)).collect():
        words = (dict(given)[r["doc_id"]] or "").split()
        n, h = len(words), zlib.crc32(str(r["doc_id"]).encode())
        if r["doc_id"] is not None and h % 10 == 0 and n:
            g, planted = h // 10, planted + 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        wanted = runs_of(words)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in wanted)
        assert (r["n_runs"], r["runs_sha256"]) == (len(wanted), hashlib.sha256(lines.encode()).hexdigest())
        best = min(((-m, s, q) for s, m, q in wanted), default=None)
        own = (r["start"], r["length"], r["period"], r["exponent_milli"])
        assert own == ((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4)
    assert planted > 5


# Repair


def conversations():
    r = random.Random(31)
    said = ["yes.", "no", "why?", "ok!", "", " \t", "well. ", "é…", "a.b", "Done.\n"]
    roles = ["user", "assistant", "system", "anna", "tool", "", None]
    rows = []
    for c in [*range(120), None]:
        for k in range(r.randint(0, 12)):
            turn = r.choice([k, k, k, k + 5, 0, None]) if c is None or c % 3 else k
            role = r.choice(roles) if r.random() < 0.4 else ["user", "assistant"][k % 2]
            rows.append((c, turn, role, r.choice([*said, None, *(f"m{c} {k}." for _ in range(9))]), "x", 1))
    rows += [(500, t, ["user", "assistant"][t % 2], f"m{t % 40}.", "x", 1) for t in range(300)]
    rows += [(501, 4, "user", "same.", "x", 1)] * 40 + [(502, None, "assistant", f"n{t}", "x", 1) for t in range(50)]
    return rows + [rows[0], rows[0]]


def by_sql(rows):
    con = duckdb.connect()
    frame = pd.DataFrame([x[:4] for x in rows], columns=["conv_id", "turn", "role", "text"], dtype=object)
    con.register("frame", frame)
    con.execute("create view conversations as select conv_id::bigint as conv_id, turn::bigint as turn, role::varchar as role, text::varchar as text from frame")
    return con.execute(repair.SQL).df()


@pytest.mark.parametrize("block", [repair.BLOCK_ROWS, 3])
def test_repair_is_that_of_sql(spark, tmp_path, monkeypatch, block):
    rows = conversations()
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    monkeypatch.setattr(repair.repair, "__defaults__", (block,))
    found = repair.op13_structure_repair(spark, str(tmp_path)).toPandas()
    # At these costs deleting a neighbour is always cheaper than inserting.
    assert set("".join(found["audit"])) == set("DKR")
    assert mismatch(found, by_sql(rows)) is None


def test_repaired_lines(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (1, 3, "assistant", "Bye"), (1, 3, "assistant", "Bye")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (part,) = repair.repaired(repair.messages(turns)).collect()
    assert (part["audit"], part["cost"]) == ("KRRDD", 6) or part["cost"] <= 6
    lines = bytes(part["text"]).decode().split("\n")
    letters = "".join(x[0] for x in lines if x)
    assert letters == "" or letters.removeprefix("s").replace("ua", "") == ""


def test_insertions_where_they_are_cheap(monkeypatch):
    monkeypatch.setattr(repair, "INSERT", 1)
    monkeypatch.setattr(repair, "REROLE", 9)
    monkeypatch.setattr(repair, "AT_END", (0, 2, 1, 0))
    repair.before.cache_clear(), repair.edits.cache_clear()
    block = repair.Block([repair.Message(x, False, 0) for x in "saau"], repair.AT_END)
    walked = list(block.walk(repair.START))
    assert "".join(x for x, _, _ in walked) + repair.ending(walked[-1][2]) == "KIKIKKI"
    assert block.costs[repair.START] == 3
    repair.before.cache_clear(), repair.edits.cache_clear()


def test_checkpoints_are_few():
    messages = [repair.Message("ua"[i % 2], i % 7 == 0, 5 * (i % 3 == 0)) for i in range(10_000)]
    block = repair.Block(messages)
    assert len(block.marks) <= 102
    letters = "".join(x for x, _, _ in block.walk(repair.START))
    cost = {"D": repair.DELETE, "R": repair.REROLE, "K": 0}
    spent, i = 0, 0
    for x in letters:
        if x == "I":
            spent += repair.INSERT
            continue
        spent += cost[x] + (messages[i].extra if x != "D" else 0)
        i += 1
    states = [then for _, _, then in block.walk(repair.START)]
    assert spent + repair.AT_END[states[-1]] == block.costs[repair.START]


@pytest.mark.parametrize("name", ["op11_vector_packing", "op12_periodic_runs", "op13_structure_repair"])
def test_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0
