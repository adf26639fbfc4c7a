"""Conversation repair, shingle classes and whitening against brute force."""

import functools
import hashlib
import math
import random
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakledger.llm import conversations, jaccard, whitening
from . import samples

# ---- conversations

TURNS = "conv_id long, turn long, role string, text string"
FOLLOWS = {"": "u", "s": "u", "u": "a", "a": "u"}


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        dealt = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if dealt:
            text = "" if dealt == 1 else re.sub("[.!?]", "", text) if dealt == 2 else text
            out += [(conv, turn, "user" if dealt == 4 else role, text)] * (2 if dealt == 3 else 1)
    return out


def brute_repair(rows):
    """rows: damaged (turn, role, text) of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))

    @functools.lru_cache(None)
    def best(i, state, inserts):
        """(cost, audit) of the rest; state: the last role initial."""
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, ""))
        if inserts < 3:
            cost, audit = best(i, FOLLOWS[state], inserts + 1)
            ways.append((cost + 3, "I" + audit))
        if i < len(rows):
            cost, audit = best(i + 1, state, 0)
            ways.append((cost + 4, "D" + audit))
            if faults[i] not in ("blank", "duplicate"):
                extra, initial = 3 * (faults[i] == "truncated"), rows[i][1][:1]
                if initial == FOLLOWS[state] or initial == "s" and state == "":
                    cost, audit = best(i + 1, initial, 0)
                    ways.append((cost + extra, "K" + audit))
                cost, audit = best(i + 1, FOLLOWS[state], 0)
                ways.append((cost + 3 + extra, "R" + audit))
        return min(ways, default=(10 ** 9, ""))

    sys.setrecursionlimit(20_000)
    cost, audit = best(0, "", 0)
    lines, state, left = [], "", iter(rows)
    for letter in audit:
        if letter == "I":
            state = FOLLOWS[state]
            lines.append({"u": "user:", "a": "assistant:"}[state])
            continue
        _, role, text = next(left)
        if letter != "D":
            state = role[:1] if letter == "K" else FOLLOWS[state]
            lines.append(f"{role if letter == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{text}")
    turns = {t for t, *_ in rows if t is not None}
    best.cache_clear()
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal,
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_conversations(rows):
    damaged = brute_damage(rows)
    return {conv: brute_repair([r[1:] for r in damaged if r[0] == conv]) for conv in {r[0] for r in rows}}


def talk(seed, conversations_=40, longest=14):
    pick = random.Random(seed)
    rows = []
    for conv in [*range(conversations_), None]:
        for k in range(pick.randrange(longest)):
            turn = pick.choice([k, k, k, k, k, k - 1, k + 3, None])
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "umbra"])
            text = pick.choice(["Yes.", "No", " ", "", None, "Why? \n", f"Line {k}.", f"line {k}", "été!", "a\nb"])
            rows += [(conv, turn, role, text)] * pick.choice([1, 1, 1, 1, 2])
    return rows


def got(df):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert df.columns == names
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("piece_rows", [1 << 16, 1, 3])
def test_conversations_by_brute_force(spark, piece_rows):
    rows = talk(7)
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("part", "number", "codes", "first", "times", "audit", "conv")})
    assert got(conversations.repair(df, piece_rows=piece_rows)) == brute_conversations(rows)


def test_one_long_conversation_over_many_partitions(spark):
    pick = random.Random(3)
    rows = [(5, k // 2, pick.choice(["user", "assistant", "system"]), pick.choice([f"t{k}.", f"t{k}", "same.", ""])) for k in range(700)]
    rows += [(9, None, None, None)] * 60 + [(k, 0, "user", "Hi.") for k in range(20, 60)]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert got(conversations.repair(spark.createDataFrame(rows, TURNS), piece_rows=64)) == brute_conversations(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_conversations_of_an_empty_table(spark):
    assert conversations.repair(spark.createDataFrame([], TURNS)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_tables_multiply_to_the_same_audit(seed):
    pick, walker = random.Random(seed), conversations.Walker()
    codes = bytes(pick.randrange(9) for _ in range(pick.choice([1, 2, 5, 40])))
    cuts = sorted({0, len(codes), *[pick.randrange(len(codes) + 1) for _ in range(3)]})
    parts = [codes[a:b] for a, b in zip(cuts, cuts[1:])]
    tables = [walker.table(p) for p in parts]
    whole = functools.reduce(conversations.product, tables)
    assert whole == walker.table(codes)
    for entry in range(4):
        for leave in range(4):
            if whole[4 * entry + leave] < conversations.FAR:
                states = [entry, *conversations.crossings(tables, entry, leave), leave]
                assert "".join(walker.audit(p, a, b) for p, a, b in zip(parts, states, states[1:])) == walker.audit(codes, entry, leave)


# ---- classes by shingles


def brute_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[k:k + 5]) for k in range(len(words) - 4)} or ({" ".join(words)} if words else set())


def brute_classes(rows):
    sets = {}
    for doc, text in rows:
        sets.setdefault(frozenset(brute_shingles(text)), []).append(doc)
    keys = [k for k in sets if k]
    parent = list(range(len(keys)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for i, a in enumerate(keys):
        for j in range(i):
            if 100 * len(a & keys[j]) >= 80 * len(a | keys[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, a in enumerate(keys):
        ids = [d for d in sets[a] if d is not None]
        if ids:
            least[find(i)] = min(min(ids), least.get(find(i), min(ids)))
    return {(d, len(a), least.get(find(i))) for i, a in enumerate(keys) for d in sets[a]} | {(d, 0, d) for d in sets.get(frozenset(), [])}


def near_copies(seed):
    """Families of texts with a few words changed, chains of changes, and passages that many texts share."""
    pick = random.Random(seed)
    rows, number = [], 0
    notice = samples.prose(900, 40)
    for family in range(12):
        base = samples.prose(100 * seed + family, pick.choice([9, 12, 30, 80, 200])).split()
        for _ in range(pick.choice([1, 2, 5, 25])):
            words = list(base)
            for _ in range(pick.choice([0, 0, 1, 2, 4])):
                words[pick.randrange(len(words))] = f"new{pick.randrange(50)}"
            if pick.random() < 0.3:
                base = words
            rows.append((number, " ".join(words) + (" " + notice if pick.random() < 0.3 else "")))
            number += 1
    return rows


@pytest.mark.parametrize("rounds", [jaccard.ROUNDS, 0])
def test_classes_by_brute_force(spark, rounds):
    rows = near_copies(1) + [(10_000 + (d or 0), t) if d is not None else (None, t) for d, t, *_ in samples.rows()]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("n", "fp", "a", "b", "token", "kind", "chunk", "n_shingles")})
    out = {tuple(r) for r in jaccard.classes(df, rounds=rounds).collect()}
    assert out == brute_classes(rows)


def test_classes_in_small_chunks_and_blocks(spark, monkeypatch):
    for name, value in (("CHUNK_BYTES", 600), ("CHUNK_TOKENS", 50), ("SLOT_TOKENS", 100), ("BLOCK", 3), ("HASH_BYTES", 64)):
        monkeypatch.setattr(jaccard, name, value)
    rows = near_copies(2)
    assert {tuple(r) for r in jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == brute_classes(rows)


def test_classes_of_an_empty_table(spark):
    assert jaccard.classes(samples.empty(spark)).count() == 0


def test_word_hashes_tell_words_apart():
    hasher, pick = jaccard.Hasher(), random.Random(2)
    texts = ["".join(pick.choice("ab \n\tcé") for _ in range(pick.randrange(60))).encode() for _ in range(200)] + [b"", b"x" * 300_000 + b" y"]
    seen = {}
    begin, found = hasher.words(np.frombuffer(b"\n".join(texts), np.uint8))
    words = re.findall(rb"[^\x20\x09-\x0D]+", b"\n".join(texts))
    assert len(words) == len(found) == len(begin)
    for word, h in zip(words, found.tolist()):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


# ---- whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(seed, n=400, size=12):
    pick = np.random.default_rng(seed)
    base = pick.standard_normal((n, size)) @ np.diag(np.linspace(0.2, 3, size)) + pick.standard_normal(size)
    rows = [(k, [float(c) for c in v], 0) for k, v in enumerate(base.astype(np.float32))]
    nan, none = list(rows[0][1]), list(rows[1][1])
    nan[3], none[5] = float("nan"), None
    return [*rows, rows[4], (None, rows[5][1], 1), (n, nan, 0), (n + 1, none, 0), (n + 2, None, 0), (n + 3, [float("inf")] * size, 0), (n + 4, rows[0][1][:3], 0)]


def brute_white(rows, size):
    kept = [(k, v) for k, v, _ in rows if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    z = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    values, turn = np.linalg.eigh(z.T @ z / n)
    values, turn = values[::-1], turn[:, ::-1]
    return kept, n, [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x], z @ turn / np.sqrt(np.where(values > 0, values, 1)), values / values.sum()


@pytest.mark.parametrize("size", [12, 3])
def test_whitening_against_an_eigensolver(spark, size):
    rows = [r if r[1] is None else (r[0], r[1][:size], r[2]) for r in vectors(3)]
    rows = [r for r in rows if r[1] is None or len(r[1]) == size or size == 12]
    kept, n, deviation, white, share = brute_white(rows, size)
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("x") for c in ("x", "n", "place", "component")})
    out = whitening.whiten(df).collect()
    count = min(8, size)
    assert len(out) == len(kept) * count and {r["n"] for r in out} == {n} and len({r["identity_error"] for r in out}) == 1
    assert out[0]["identity_error"] < 1e-9
    want = {}
    for (key, _), d, w in zip(kept, deviation, white):
        want.setdefault(key, (d, w))
    flip = {}
    for r in out:
        d, w = want[r["vec_id"]]
        k = r["component"] - 1
        assert r["deviation"] == d and math.isclose(r["explained"], share[k], rel_tol=1e-9)
        if abs(w[k]) > 1e-3:
            assert flip.setdefault(k, np.sign(w[k] * r["whitened"])) == np.sign(w[k] * r["whitened"])
        assert math.isclose(abs(r["whitened"]), abs(w[k]), abs_tol=1e-7)
    assert not whitening.whiten(spark.createDataFrame([], VECTORS)).collect()


def test_whitening_of_vectors_without_variance(spark):
    rows = [(k, [1.0, 2.0, float(k)], 0) for k in range(5)]
    out = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(out) == 15 and all((r["whitened"] is None) == (r["component"] > 1) for r in out)
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5], 0)] * 3, VECTORS)).collect()
    assert len(same) == 6 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in same)


@pytest.mark.parametrize("spectrum", [[5, 5, 5, 5, 5, 5, 5, 5, 5, 5, 1, 0], np.geomspace(1, 1e-12, 30), np.ones(20), np.r_[1e6, np.ones(40)], np.linspace(1, 1.001, 64)])
def test_feast_finds_the_leading_eigenvalues(spectrum):
    spectrum = np.sort(np.asarray(spectrum, float))[::-1]
    turn = np.linalg.qr(np.random.default_rng(1).standard_normal((len(spectrum), len(spectrum))))[0]
    v = turn @ np.diag(spectrum) @ turn.T
    v = (v + v.T) / 2
    values, vectors_ = whitening.feast(v, 8)
    assert np.allclose(values, spectrum[:8], rtol=1e-9, atol=1e-13 * spectrum[0])
    assert np.allclose(v @ vectors_, vectors_ * values, atol=1e-12 * spectrum[0]) and np.allclose(vectors_.T @ vectors_, np.eye(8), atol=1e-10)
    for shift in (0.5, 1.0005, 2.5, 7.0):
        assert whitening.inertia(v - shift * np.eye(len(v))) == (spectrum > shift).sum() or np.abs(spectrum - shift).min() < 1e-9
