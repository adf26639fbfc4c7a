"""Exact Jaccard join of documents' word shingles, by set relations; the result is the class of every document.

Tokens are hashed shingles in order of document frequency. Two passes count how many sets hold each token: tasks cut their sets into
chunks, send each chunk's different tokens to slots of the hash range, and get back those that another set has too. A set of which less
than the threshold is shared links with nothing and is gone; after the second pass few others are left.

Index: a posting says at which position of its set a prefix token stands. A list is read in blocks, and the position (with the size)
of a posting rules out whole stretches of others before any set is looked at; parities of tokens, compared a word at a time, rule out
most of the rest. Answers: a set that is linked with a leader carries its difference from that leader. What the leader shares with
another set then bounds, or with the difference gives, what the set shares with it, so its own tokens are not read again.

As classes are wanted, not pairs, a list is compared only while it holds sets of different classes: first all with one leader, then
each set outside the list's largest class with its best partner, until no class grows, then whatever pair is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.shipping import by_value
from .common import checkpoint, stored, utf8
from .components import components, in_tasks

SHINGLE = 5
#: Sets link from this many percent of their union on.
PERCENT = 80
#: Bytes of text, and tokens, of one chunk; tokens of one slot of the hash range.
CHUNK_BYTES = 8 << 20
CHUNK_TOKENS = 1 << 21
SLOT_TOKENS = 1 << 21
#: Bytes of text hashed at once.
HASH_BYTES = 1 << 17
#: Bits of a set's sketch.
SKETCH = 1024
#: Postings on either side of one block of a list.
BLOCK = 4096
#: Rounds of best partners before all that is left is compared.
ROUNDS = 6
#: Postings, pairs or links of one task: these tables are small beside the documents, so tasks follow their rows.
ROWS_PER_TASK = 200_000

DOC, TOKENS, CHUNK, SHARED, SET = range(5)
WIRE = "kind int, slot long, chunk long, doc_id {kind}, n long, fp long, a binary, b binary, c binary, d binary, e binary"
SETS = "kind int, doc_id {kind}, n long, fp long, tokens array<long>, sketch binary"

# Multipliers of the hashes: odd numbers from the fractional parts of square roots, by rule.


def _odd(k: int) -> int:
    from math import isqrt

    return isqrt(k << 128) % (1 << 64) | 1


FACTORS = [_odd(k * k + 1) for k in range(1, 33)]
BASE, STIR, STIR_AGAIN = _odd(3), _odd(7), _odd(11)


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers spread over all 64 bits; different ones stay different."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(STIR)
    x ^= x >> np.uint64(29)
    x *= np.uint64(STIR_AGAIN)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out, have = np.ones(n, np.uint64), 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


class Hasher:
    """Hashes of the words of a run of bytes, whole arrays at a time: polynomials from prefix sums, stirred."""

    def __init__(self) -> None:
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        self._grow(HASH_BYTES)

    def _grow(self, n: int) -> None:
        self.up, self.down = _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)

    def words(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where each word begins, its hash)"""
        inside = np.zeros(len(text) + 2, np.int8)
        inside[1:-1] = ~self.space[text]
        edges = np.flatnonzero(np.diff(inside))
        begin, end = edges[::2], edges[1::2]
        out, at = np.empty(len(begin), np.uint64), 0
        while at < len(begin):
            last = max(int(np.searchsorted(end, begin[at] + HASH_BYTES, "right")), at + 1)
            base = begin[at]
            part = text[base:end[last - 1]]
            if len(part) > len(self.up):
                self._grow(len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.up[:len(part)], out=sums[1:])
            b = begin[at:last] - base
            out[at:last] = (sums[end[at:last] - base] - sums[b]) * self.down[b]
            at = last
        return begin, mixed(out)

    def shingles(self, texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        """(token, number of its text) of every shingle, repeats included; a text of fewer words is one shingle."""
        ends = np.cumsum([len(t) + 1 for t in texts])
        text = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
        begin, word = self.words(text)
        owner = np.searchsorted(ends, begin, "right").astype(np.int32)
        count = np.bincount(owner, minlength=len(texts))
        first = np.cumsum(count) - count
        full = len(word) - size + 1
        tokens, owners = np.empty(0, np.uint64), np.empty(0, np.int32)
        if full > 0:
            tokens = word[:full] * np.uint64(FACTORS[0])
            for k in range(1, size):
                tokens = tokens + word[k:k + full] * np.uint64(FACTORS[k])
            same = owner[:full] == owner[size - 1:]
            tokens, owners = tokens[same], owner[:full][same]
        short = np.flatnonzero((count > 0) & (count < size))
        single = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = count[short] > k
            single[has] += word[first[short[has]] + k] * np.uint64(FACTORS[k])
        return mixed(np.concatenate([tokens, single])), np.concatenate([owners, short.astype(np.int32)])


def _planes(a: np.ndarray) -> bytes:
    """Byte by byte, so that what is the same in most numbers compresses."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _numbers(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _rising(a: np.ndarray) -> bytes:
    return _planes(np.diff(a, prepend=np.uint64(0)))


def _risen(raw: bytes) -> np.ndarray:
    return np.cumsum(_numbers(raw, np.uint64), dtype=np.uint64)


def _starts(sorted_values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]]) if len(sorted_values) else np.empty(0, np.int64)


def needed(n: np.ndarray) -> np.ndarray:
    """Tokens that a set of n shares at least with any set it links with."""
    return (PERCENT * n + 99) // 100


def _sent(chunk: int, token: np.ndarray, ref: np.ndarray, n: np.ndarray, fp: np.ndarray, slots: int) -> Iterator[dict]:
    """Rows of a chunk: its sets and the tokens that several of them hold, and the different tokens by slot."""
    starts = _starts(token)
    count = np.diff(np.r_[starts, len(token)])
    many = np.repeat(count > 1, count)
    yield {"kind": CHUNK, "slot": 0, "chunk": chunk, "a": _planes(n.astype(np.int64)), "b": _planes(fp), "c": _rising(token[starts][count > 1]),
           "d": _planes(count[count > 1].astype(np.int64)), "e": _planes(ref[many].astype(np.int32))}
    different, mark = token[starts], np.where(count > 1, -count, ref[starts]).astype(np.int32)
    bounds = np.array([(k << 64) // slots for k in range(1, slots)], np.uint64)
    cuts = np.r_[0, np.searchsorted(different, bounds), len(different)]
    for slot, (i, j) in enumerate(zip(cuts, cuts[1:])):
        if j > i:
            yield {"kind": TOKENS, "slot": slot, "chunk": chunk, "a": _rising(different[i:j]), "b": _planes(mark[i:j])}


def _batch(rows: list[dict], target: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in target], schema=target)


def _chunk_number(number: int) -> int:
    return TaskContext.get().partitionId() << 32 | number


def _from_texts(kind: str, size: int, slots: int):
    target = to_arrow_schema(StructType.fromDDL(WIRE.format(kind=kind)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, number, ids, texts, held = Hasher(), 0, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            chunk = _chunk_number(number)
            token, ref = hasher.shingles(texts, size)
            order = np.argsort(token, kind="stable")
            token, ref = token[order], ref[order]
            new = np.r_[True, (token[1:] != token[:-1]) | (ref[1:] != ref[:-1])][:len(token)]
            token, ref = token[new], ref[new]
            n = np.bincount(ref, minlength=len(texts))
            stirred = mixed(token ^ np.uint64(BASE))
            low = np.bincount(ref, (stirred & np.uint64(0xFFFFFFFF)).astype(np.float64), len(texts))
            high = np.bincount(ref, (stirred >> np.uint64(32)).astype(np.float64), len(texts))
            fp = mixed((high.astype(np.uint64) << np.uint64(32)) + low.astype(np.uint64) + n.astype(np.uint64) * np.uint64(STIR))
            yield pa.RecordBatch.from_arrays(
                [pa.array([DOC] * len(ids), pa.int32()), pa.array([0] * len(ids), pa.int64()), pa.array([chunk] * len(ids), pa.int64()), pa.array(ids, target.field("doc_id").type),
                 pa.array(n), pa.array(fp.view(np.int64)), *[pa.nulls(len(ids), pa.binary())] * 5], schema=target)
            # Of equal sets of the chunk one is sent.
            filled = np.flatnonzero(n)
            if len(filled):
                first = filled[np.unique(fp[filled], return_index=True)[1]]
                place = np.full(len(texts), -1, np.int32)
                place[first] = np.arange(len(first), dtype=np.int32)
                keep = place[ref] >= 0
                for row in _sent(chunk, token[keep], place[ref[keep]], n[first], fp[first], slots):
                    yield _batch([row], target)

        for batch in batches:
            for key, raw in zip(batch.column("doc_id").to_pylist(), batch.column("raw")):
                raw = raw.as_py()
                ids.append(key)
                texts.append(raw)
                held += len(raw) + 16
                if held >= CHUNK_BYTES:
                    yield from flush()
                    ids, texts, held, number = [], [], 0, number + 1
        if ids:
            yield from flush()
    return run


def _from_sets(kind: str, slots: int):
    target = to_arrow_schema(StructType.fromDDL(WIRE.format(kind=kind)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, parts = 0, 0, []

        def flush() -> Iterator[pa.RecordBatch]:
            token = np.concatenate([t for _, _, t in parts])
            ref = np.repeat(np.arange(len(parts), dtype=np.int32), [len(t) for _, _, t in parts])
            order = np.argsort(token, kind="stable")
            for row in _sent(_chunk_number(number), token[order], ref[order], np.array([n for n, _, _ in parts]), np.array([f for _, f, _ in parts], np.int64).view(np.uint64), slots):
                yield _batch([row], target)

        for batch in batches:
            for n, fp, tokens in zip(batch.column("n").to_pylist(), batch.column("fp").to_pylist(), batch.column("tokens")):
                parts.append((n, fp, tokens.values.to_numpy(zero_copy_only=False).view(np.uint64)))
                held += len(parts[-1][2])
                if held >= CHUNK_TOKENS:
                    yield from flush()
                    number, held, parts = number + 1, 0, []
        if parts:
            yield from flush()
    return run


def _matched(kind: str):
    """Rows in order of kind and slot: each slot's tokens that more than one set has go back to their chunks, the rest passes."""
    target = to_arrow_schema(StructType.fromDDL(WIRE.format(kind=kind)))

    def back(blobs: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        token, mark = np.concatenate([t for _, t, _ in blobs]), np.concatenate([m for _, _, m in blobs])
        order = np.argsort(token, kind="stable")
        starts = _starts(token[order])
        sets = np.add.reduceat(np.where(mark < 0, -mark, 1)[order].astype(np.int64), starts)
        df = np.empty(len(token), np.int64)
        df[order] = np.repeat(sets, np.diff(np.r_[starts, len(token)]))
        at = 0
        for chunk, t, m in blobs:
            own = df[at:at + len(t)]
            shared = own > 1
            at += len(t)
            if shared.any():
                yield _batch([{"kind": SHARED, "slot": 0, "chunk": chunk, "a": _rising(t[shared]), "b": _planes(m[shared]), "c": _planes(own[shared])}], target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, blobs = None, []
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            passing = batch.filter(pa.array(kinds != TOKENS))
            if passing.num_rows:
                yield passing
            for row in batch.filter(pa.array(kinds == TOKENS)).select(["slot", "chunk", "a", "b"]).to_pylist():
                if blobs and row["slot"] != slot:
                    yield from back(blobs)
                    blobs = []
                slot = row["slot"]
                blobs.append((row["chunk"], _risen(row["a"]), _numbers(row["b"], np.int32)))
        if blobs:
            yield from back(blobs)
    return run


def sketch(tokens: np.ndarray) -> bytes:
    """Parities of the tokens' cells: two sets differ in at least as many tokens as their sketches do in bits."""
    cells = np.bincount((tokens >> np.uint64(20)).astype(np.int64) & (SKETCH - 1), minlength=SKETCH)
    return np.packbits((cells & 1).astype(np.uint8)).tobytes()


def _gathered(kind: str):
    """Rows in order of chunk: documents pass; of each chunk's sets those that share enough, with their shared tokens from the rarest."""
    target = to_arrow_schema(StructType.fromDDL(SETS.format(kind=kind)))

    def sets(chunk: dict, shared: list[dict]) -> Iterator[pa.RecordBatch]:
        n, fp = _numbers(chunk["a"], np.int64), _numbers(chunk["b"], np.uint64)
        if not shared:
            return
        token = np.concatenate([_risen(r["a"]) for r in shared])
        mark = np.concatenate([_numbers(r["b"], np.int32) for r in shared])
        df = np.concatenate([_numbers(r["c"], np.int64) for r in shared])
        several, times, refs = _risen(chunk["c"]), _numbers(chunk["d"], np.int64), _numbers(chunk["e"], np.int32)
        of_several = np.zeros(len(several), np.int64)
        of_several[np.searchsorted(several, token[mark < 0])] = df[mark < 0]
        one = mark >= 0
        token = np.concatenate([token[one], np.repeat(several, times)])
        ref = np.concatenate([mark[one], refs])
        df = np.concatenate([df[one], np.repeat(of_several, times)])
        enough = np.bincount(ref, minlength=len(n)) >= needed(n)
        keep = enough[ref]
        token, ref, df = token[keep], ref[keep], df[keep]
        order = np.lexsort((token, df, ref))
        token, ref = token[order], ref[order]
        starts = _starts(ref)
        rows = [{"kind": SET, "n": int(n[ref[i]]), "fp": int(fp[ref[i:i + 1]].view(np.int64)[0]), "tokens": token[i:j].view(np.int64), "sketch": sketch(token[i:j])}
                for i, j in zip(starts, np.r_[starts[1:], len(ref)])]
        for k in range(0, len(rows), 256):
            yield _batch(rows[k:k + 256], target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shared = None, []
        for batch in batches:
            documents = batch.filter(pa.array(batch.column("kind").to_numpy() == DOC))
            if documents.num_rows:
                yield pa.RecordBatch.from_arrays([documents.column("kind"), documents.column("doc_id"), documents.column("n"), documents.column("fp"),
                                                  pa.nulls(documents.num_rows, target.field("tokens").type), pa.nulls(documents.num_rows, pa.binary())], schema=target)
            for row in batch.filter(pa.array(batch.column("kind").to_numpy() != DOC)).to_pylist():
                if row["kind"] == CHUNK:
                    if now is not None:
                        yield from sets(now, shared)
                    now, shared = row, []
                else:
                    shared.append(row)
        if now is not None:
            yield from sets(now, shared)
    return run


def _sharing(sent: DataFrame, kind: str) -> DataFrame:
    """What chunks sent -> documents, and the sets that share enough of their tokens with others."""
    parts = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.when(F.col("kind") == TOKENS, F.xxhash64("slot")).otherwise(F.xxhash64("chunk", "doc_id"))
    met = sent.repartition(parts, key).sortWithinPartitions("kind", "slot").mapInArrow(_matched(kind), WIRE.format(kind=kind))
    back = F.when(F.col("kind") == DOC, F.xxhash64("chunk", "doc_id")).otherwise(F.xxhash64("chunk"))
    return met.repartition(parts, back).sortWithinPartitions("chunk", "kind").mapInArrow(_gathered(kind), SETS.format(kind=kind))


def _slots(df: DataFrame, tokens: float) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(tokens // SLOT_TOKENS) + 1)


def _links(inter: Column, n: Column, m: Column) -> Column:
    return (100 + PERCENT) * inter >= PERCENT * (n + m)


def _possible(n: Column, pos: Column, m: Column, other: Column) -> Column:
    """Positions of a common token (no earlier one is common) and sizes that let two sets link."""
    size = 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)
    return size & _links(F.least(n - pos, m - other), n, m)


def postings(sets: DataFrame) -> DataFrame:
    """(token, fp, n, pos, alone) of the sets' prefix tokens that others share: two sets that link have one of them in common.

    alone: the tokens that no other set has; they stand first."""
    alone = F.col("n") - F.size("tokens")
    prefix = F.col("n") - F.floor((PERCENT * F.col("n") + 99) / 100) + 1 - alone
    listed = sets.select("fp", "n", alone.alias("alone"), F.posexplode(F.slice("tokens", F.lit(1), prefix.cast("int"))).alias("k", "token"))
    return listed.select("token", "fp", "n", (F.col("alone") + F.col("k")).alias("pos"), "alone")


def _contested(listed: DataFrame, tasks: int) -> DataFrame:
    """Of postings with comp: the tokens whose lists hold several classes, with the largest class and the numbers of postings."""
    by_comp = in_tasks(listed.groupBy("token", "comp").agg(F.count("*").alias("k")), tasks)
    lists = by_comp.groupBy("token").agg(F.max(F.struct("k", "comp")).alias("top"), F.sum("k").alias("k"), F.count("*").alias("comps")).where("comps > 1")
    return in_tasks(lists.select("token", F.col("top.comp").alias("main"), "k", (F.col("k") - F.col("top.k")).alias("rest")), tasks)


def _led(listed: DataFrame, tasks: int) -> DataFrame:
    """Pairs (a, b) of each posting with its list's leader, the set of least hash; one leader wins in most lists of its like."""
    rank = F.struct(F.xxhash64("fp").alias("rank"), F.col("fp").alias("leader"), F.col("n").alias("m"), F.col("pos").alias("other"))
    leaders = listed.groupBy("token").agg(F.min(rank).alias("l"), F.count("*").alias("k")).where("k > 1").select("token", "l.leader", "l.m", "l.other")
    met = listed.join(leaders, "token").where("fp <> leader").where(_possible(F.col("n"), F.col("pos"), F.col("m"), F.col("other")))
    pairs = in_tasks(met, tasks).select(F.col("fp").alias("a"), F.col("leader").alias("b"), F.col("n").alias("na"), F.col("m").alias("nb"))
    return in_tasks(pairs.distinct(), tasks)


def _compared(best: bool):
    """Blocks of lists: pairs of a posting outside the largest class with one of another class that positions, sizes and sketches allow."""
    target = to_arrow_schema(StructType.fromDDL("a long, b long, na long, nb long"))

    def block(rest: dict, every: dict) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 22) // (len(every["fp"]) * (SKETCH // 64)))
        m, other = every["n"], every["n"] - every["pos"]
        for k in range(0, len(rest["fp"]), step):
            q = slice(k, k + step)
            n = rest["n"][q, None]
            both = n + m
            can = rest["comp"][q, None] != every["comp"]
            can &= every["main"] | (rest["fp"][q, None] < every["fp"]) | best
            can &= 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
            can &= (100 + PERCENT) * np.minimum(n - rest["pos"][q, None], other) >= PERCENT * both
            x, y = np.nonzero(can)
            if not len(x):
                continue
            apart = np.empty(len(x), np.int64)
            for s in range(0, len(x), 1 << 18):
                t = slice(s, s + (1 << 18))
                apart[t] = np.bitwise_count(rest["sketch"][q][x[t]] ^ every["sketch"][y[t]]).sum(axis=1)
            apart += rest["alone"][q][x] + every["alone"][y]
            sizes = both[x, y]
            near = (100 + PERCENT) * (sizes - apart) >= 2 * PERCENT * sizes  # twice the overlap is at most the sizes less the bits apart
            x, y, apart, sizes = x[near], y[near], apart[near], sizes[near]
            if best and len(x):
                order = np.lexsort((every["fp"][y], apart / sizes, x))
                x, y = x[order], y[order]
                first = _starts(x)
                x, y = x[first], y[first]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in (rest["fp"][q][x], every["fp"][y], rest["n"][q][x], m[y])], schema=target)

    def columns(batch: pa.RecordBatch) -> dict:
        out = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp", "n", "pos", "alone", "comp", "rest", "main")}
        raw = batch.column("sketch")
        out["sketch"] = np.frombuffer(b"".join(raw.to_pylist()), np.uint64).reshape(-1, SKETCH // 64)
        return out

    def groups(held: list[dict]) -> Iterator[pa.RecordBatch]:
        whole = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
        starts = _starts(whole["key"])
        for i, j in zip(starts, np.r_[starts[1:], len(whole["key"])]):
            side = whole["rest"][i:j]
            rest = {c: v[i:j][side] for c, v in whole.items()}
            every = {c: v[i:j][~side] for c, v in whole.items()}
            if len(rest["fp"]) and len(every["fp"]):
                yield from block(rest, every)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = columns(batch)
            cut = int(np.flatnonzero(now["key"] == now["key"][-1])[0])  # the last key may go on in the next batch
            if cut:
                yield from groups([*held, {c: v[:cut] for c, v in now.items()}])
                held = []
                now = {c: v[cut:] for c, v in now.items()}
            elif held and held[-1]["key"][-1] != now["key"][0]:
                yield from groups(held)
                held = []
            held.append(now)
        if held:
            yield from groups(held)
    return run


def _blocks(listed: DataFrame, sets: DataFrame, best: bool, tasks: int) -> DataFrame:
    """Pairs (a, b, na, nb), a < b, from the contested lists; long lists are cut into blocks, each compared in a group of its own."""
    lists = _contested(listed, tasks)
    cut = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    met = listed.join(lists.select("token", "main", cut("k").alias("cuts"), cut("rest").alias("rest_cuts")), "token")
    met = in_tasks(met.withColumn("is_main", F.col("comp") == F.col("main")), tasks)
    own = lambda c: F.pmod(F.xxhash64("fp"), F.col(c)).cast("int")
    every = met.withColumn("i", own("cuts")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("rest_cuts") - 1))).withColumn("rest", F.lit(False))
    rest = met.where("not is_main").withColumn("j", own("rest_cuts")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).withColumn("rest", F.lit(True))
    both = every.unionByName(rest).select(F.xxhash64("token", "i", "j").alias("key"), "fp", "n", "pos", "alone", "comp", "rest", F.col("is_main").alias("main"))
    drawn = in_tasks(both.join(sets.select("fp", "sketch"), "fp"), tasks)
    found = drawn.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(_compared(best), "a long, b long, na long, nb long")
    turned = F.col("a") > F.col("b")
    pairs = [F.when(turned, F.col(x)).otherwise(F.col(y)).alias(y) for x, y in (("b", "a"), ("a", "b"), ("nb", "na"), ("na", "nb"))]
    return in_tasks(found.select(*pairs).distinct(), tasks)


def _direct(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs with inter and linked, from the tokens of both, which stay as ta and tb."""
    mine = sets.select(F.col("fp").alias("a"), F.col("tokens").alias("ta"))
    other = sets.select(F.col("fp").alias("b"), F.col("tokens").alias("tb"))
    inter = F.size(F.array_intersect("ta", "tb")).cast("long")
    met = pairs.join(mine, "a").join(other, "b").withColumn("inter", inter)
    return met.withColumn("linked", _links(F.col("inter"), F.col("na"), F.col("nb")))


def _decided(pairs: DataFrame, sets: DataFrame, homes: DataFrame, known: DataFrame, tasks: int) -> DataFrame:
    """pairs (a, b, na, nb) -> (a, b, inter or null, linked): from a's leader's answer about b where there is one, else from the tokens."""
    led = in_tasks(pairs.join(homes, pairs["a"] == homes["fp"], "left").drop("fp"), tasks)
    asked = known.select(F.col("a").alias("ka"), F.col("b").alias("kb"), F.col("inter").alias("of_leader"))
    met = led.join(asked, (led["leader"] == asked["ka"]) & (led["b"] == asked["kb"]), "left").drop("ka", "kb")
    least = F.col("of_leader") - F.size("lacks")
    most = F.col("of_leader") + F.size("adds")
    bound = F.when(_links(least, F.col("na"), F.col("nb")), True).when(~_links(most, F.col("na"), F.col("nb")), False)
    met = checkpoint(in_tasks(met.withColumn("bound", bound), tasks))
    by_count = met.where("bound is not null").select("a", "b", F.lit(None).cast("long").alias("inter"), F.col("bound").alias("linked"))
    other = sets.select(F.col("fp").alias("b"), F.col("tokens").alias("tb"))
    derived = met.where("bound is null and of_leader is not null").join(other, "b")
    inter = (F.col("of_leader") - F.size(F.array_intersect("lacks", "tb")) + F.size(F.array_intersect("adds", "tb"))).cast("long")
    derived = derived.withColumn("inter", inter).select("a", "b", "inter", _links(F.col("inter"), F.col("na"), F.col("nb")).alias("linked"))
    plain = _direct(met.where("bound is null and of_leader is null").select("a", "b", "na", "nb"), sets).select("a", "b", "inter", "linked")
    return checkpoint(in_tasks(by_count.unionByName(derived).unionByName(plain), tasks))


def _either_way(pairs: DataFrame) -> DataFrame:
    return pairs.select("a", "b", "inter").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "inter")).where("inter is not null")


def linked(sets: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """sets (fp, n, tokens, sketch), different ones -> (node, root): the smallest fp each can reach; sets without links are not listed."""
    listed = checkpoint(postings(sets))
    tasks = listed.count() // ROWS_PER_TASK + 1
    listed = in_tasks(listed, tasks)
    first = _direct(_led(listed, tasks), sets)
    lacks, adds = F.array_except("tb", "ta"), F.array_except("ta", "tb")
    slim = checkpoint(in_tasks(first, tasks).select("a", "b", "na", "nb", "inter", "linked", F.when(F.col("linked"), lacks).alias("lacks"), F.when(F.col("linked"), adds).alias("adds")))
    nearest = F.struct((F.col("inter") / (F.col("na") + F.col("nb") - F.col("inter"))).alias("share"), F.col("b").alias("leader"), "lacks", "adds")
    homes = slim.where("linked").groupBy("a").agg(F.max_by(nearest, F.struct(nearest["share"], nearest["leader"])).alias("h"))
    homes = checkpoint(in_tasks(homes.select(F.col("a").alias("fp"), "h.leader", "h.lacks", "h.adds"), tasks))
    known = _either_way(slim)
    tested = slim.select("a", "b", "linked")
    for turn in range(rounds + 1):
        roots = components(tested.where("linked").select("a", "b"), ROWS_PER_TASK)
        now = listed.join(roots, listed["fp"] == roots["node"], "left").select("token", "fp", "n", "pos", "alone", F.coalesce("root", "fp").alias("comp"))
        pairs = _blocks(checkpoint(in_tasks(now, tasks)), sets, turn < rounds, tasks)
        done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        found = _decided(in_tasks(pairs.join(done, ["a", "b"], "left_anti"), tasks), sets, homes, known, tasks)
        grown = found.where("linked").limit(1).count()
        tested = tested.unionByName(found.select("a", "b", "linked"))
        known = known.unionByName(_either_way(found))
        if turn < rounds and not grown:
            rounds = turn + 1  # no class grows by best partners any more: what is left is compared whole, and that is all
        if turn >= rounds:
            break
    return components(tested.where("linked").select("a", "b"), ROWS_PER_TASK)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: the number of different shingles, and the smallest doc_id that links reach.

    Null and empty texts and texts without a word have no shingles and link with nothing: their class is their own id. A text of fewer
    words is one shingle. Repeated rows give equal rows. Rows without an id link like others, and are never the smallest; a class
    without any id has a null one. An empty table gives an empty one; other columns are not read. Shingles, and sets of them, are told
    apart by 64-bit hashes.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    letters = slim.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    raw = slim.select("doc_id", utf8("text").alias("raw"))
    seen = stored(_sharing(raw.mapInArrow(_from_texts(kind, size, _slots(docs, letters / 6)), WIRE.format(kind=kind)), kind), "shingles")
    rows = seen.where(F.col("kind") == DOC).select("doc_id", "n", F.when(F.col("n") > 0, F.col("fp")).otherwise(F.xxhash64("doc_id")).alias("fp"))
    different = seen.where(F.col("kind") == SET).select("n", "fp", "tokens").dropDuplicates(["fp"])
    held = checkpoint(different)
    tokens = held.agg(F.sum(F.size("tokens")).alias("n")).first()["n"] or 0
    again = _sharing(held.mapInArrow(_from_sets(kind, _slots(docs, tokens)), WIRE.format(kind=kind)), kind)
    sets = checkpoint(again.where(F.col("kind") == SET).select("fp", "n", "tokens", "sketch"))
    roots = linked(sets, rounds)
    by_set = rows.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = by_set.join(roots, by_set["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fp").alias("set"), "component_id")
    met = rows.join(named, (rows["fp"] == named["set"]) & (rows["n"] > 0), "left")
    return met.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


by_value(__name__)
