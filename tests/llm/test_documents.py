"""Document operators against brute force, with nulls, empty tables, repeats and clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakledger.llm import components, decontaminate, langid, packing, pii, quality, queries, secrets, simhash
from . import samples

public_tokenizers = pytest.importorskip("public_tokenizers")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def same(df, other):
    key = lambda r: tuple(map(repr, r))
    return sorted(map(key, df.collect())) == sorted(map(key, other.collect()))


# ---- packing


def test_packing_rebuilds_every_document(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    got = packing.pack(samples.documents(spark), path).collect()
    sequences = collections.defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] and 0 < r["length"] <= 2048
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // 2048) + 1
    want = collections.Counter()
    for doc_id, text, *_ in samples.rows():
        ids = np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.update((doc_id, k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 2048)))
    assert want == collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in got)


def test_packing_takes_empty_tables_and_clashes(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.pack(samples.empty(spark), path).count() == 0
    assert packing.pack(samples.clashing(spark), path).count() == packing.pack(samples.documents(spark), path).count()


@pytest.mark.parametrize("seed", range(12))
def test_packed_holds_just_the_histogram(seed):
    pick = random.Random(seed)
    top = pick.choice([40, 300, 2048])
    histogram = collections.Counter(min(2048, int(pick.expovariate(1 / top)) + 1) for _ in range(pick.choice([1, 5, 400, 3000])))
    runs = packing.packed(histogram)
    held = collections.Counter()
    for times, lengths, room in runs:
        assert times > 0 and sum(a * b for a, b in lengths) == 2048 - room and room >= 0
        for length, n in lengths:
            held[length] += times * n
    assert held == histogram
    best_fit = sum(r[0] for r in packing.best_fit([], sorted(((k, n) for k, n in histogram.items()), reverse=True), 2048))
    assert sum(r[0] for r in runs) <= best_fit + 1
    taken = collections.defaultdict(list)
    for length, first, last, *_ in packing.places(runs):
        taken[length].append((first, last))
    for length, n in histogram.items():
        spans = sorted(taken[length])
        assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, encode, pick = Tokenizer.from_file(path), packing.Encoder(path), random.Random(5)
    signs = [chr(c) for c in [*range(1, 0x24F), 0x2028, 0x3000, 0x4E00, 0x301, 0x2009]] + list("  \n\n'''sstrevmlld 0123abc") * 12
    for _ in range(3000):
        text = "".join(pick.choice(signs) for _ in range(pick.randint(0, 24)))
        if pick.random() < 0.1:
            text += pick.choice(["<|endoftext|>", " " * 30 + "x", "\n \n\t x", "y" * 500, " " * 500, "\u4f60\u597d" * 5])
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_takes_other_files_whole():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    encode, tokenizer = packing.Encoder(path), Tokenizer.from_file(path)
    assert encode.single is None
    for text in ("Some words, 12 of THEM\n", "", "\u4f60\u597d"):
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


# ---- near duplicates


def brute_fingerprint(text):
    from xxhash import xxh64_intdigest
    words = plain_words(ascii_lower(text))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius=2):
    """{fp: smallest linked fp's position} by comparing all pairs."""
    distinct = sorted(set(prints))
    parent = {p: p for p in distinct}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p
    for k, a in enumerate(distinct):
        for b in distinct[k + 1:]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {p: find(p) for p in distinct}


def test_near_duplicates_by_brute_force(spark):
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(samples.clashing(spark)).collect()}
    prints = [(d, brute_fingerprint(t)) for d, t, *_ in samples.rows()]
    group = brute_groups([p for _, p in prints])
    least = {}
    for d, p in prints:
        if d is not None:
            least[group[p]] = min(d, least.get(group[p], d))
    assert got == {(d, f"{p:016x}", least.get(group[p])) for d, p in prints}
    assert simhash.near_duplicates(samples.empty(spark)).count() == 0


@pytest.mark.parametrize("divide_above", [512, 20])
def test_links_connect_dense_clouds_as_all_pairs_do(spark, divide_above):
    pick = random.Random(9)
    prints = set()
    for size in (2, 3, 40, 150, 400):  # clouds around a centre, with members on both sides of the radius
        centre = pick.getrandbits(64)
        for _ in range(size):
            p = centre
            for _ in range(pick.choice([1, 1, 2, 3])):
                p ^= 1 << pick.choice(range(14 if size > 40 else 64))
            prints.add(p)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long").repartition(3), divide_above=divide_above)
    assert all(((a ^ b) & (2 ** 64 - 1)).bit_count() > 0 for a, b in edges.collect())
    roots = {r["node"] % 2 ** 64: r["root"] for r in components.components(edges).collect()}
    want = brute_groups(prints)
    mine, theirs = collections.defaultdict(set), collections.defaultdict(set)
    for p in prints:
        mine[roots.get(p, ("alone", p))].add(p)
        theirs[want[p]].add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


@pytest.mark.parametrize("sizes", [(2, 5), (5, 2), (2, 64), (2,)])
def test_zero_is_not_near_the_lanes_a_bucket_lacks(sizes):
    """A bucket holds zero as its second member, alone or beside a larger one; no two members are near."""
    pick = random.Random(11)
    fp, bucket = [], []
    for number, size in enumerate(sizes):
        fp += [0xFFFFFFFF, 0] if size == 2 else [pick.getrandbits(64) for _ in range(size)]
        bucket += [number] * size
    assert [x.tolist() for x in simhash._within(np.array(fp, np.uint64), np.array(bucket), 2)] == [[], []]


def test_components_of_chains_stars_and_repeats(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(5, 5), (200, 201), (201, 200), (None, 3)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(31)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(spark):
    docs = samples.clashing(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    groups = simhash.near_duplicates(samples.documents(spark))
    assert sorted(ids) == sorted({r["component_id"] for r in groups.collect()})  # the rows without an id have components with one
    assert simhash.one_of_each(samples.empty(spark)).count() == 0


def test_rows_that_repeat_an_id_are_told_apart_by_text(spark):
    a, b = samples.prose(1, 60), samples.prose(2, 60)
    rows = [(1, a, "en", "s", 1), (5, a, "en", "s", 1), (5, b, "en", "s", 1), (5, b, "en", "s", 1), (None, b, "en", "s", 1), (None, samples.prose(3, 60), "en", "s", 1)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, samples.DOCS)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(1, a), (5, b), (0, samples.prose(3, 60))])


# ---- quality


def test_quality_base_by_brute_force(spark):
    got = {r["doc_id"]: r for r in quality.judge(samples.clashing(spark)).where("doc_id is not null").collect()}
    for doc_id, text, *_ in samples.rows():
        if doc_id is None:
            continue
        words, lines = plain_words(text), [x for x in (text or "").split("\n") if plain_words(x)]
        windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
        often = collections.Counter(windows)
        again = len({k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)})
        r = got[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), again)
        assert r["base_failed"] == (len(words) < 10 or 100 * again > 20 * len(words))
    assert quality.judge(samples.empty(spark)).count() == 0


def furniture(spark):
    """Twelve different documents of one host that end with a shared line, one of little else, and thirty copies of a text."""
    foot = "Printed  on paper, copy 17 of this  notice and others"
    rows = [(k, samples.prose(100 + k, 30) + "\n" + foot.replace("17", str(k)).upper(), "en", "h", 1) for k in range(12)]
    rows.append((50, "just three words\n" + foot, "en", "h", 1))
    copied = samples.prose(7, 30) + "\n" + samples.prose(8, 30) + "\n" + samples.prose(9, 30)
    rows += [(100 + k, copied, "en", "h", 1) for k in range(30)]
    return spark.createDataFrame(rows, samples.DOCS)


def test_common_lines_go_and_depleted_documents_too(spark):
    docs = furniture(spark)
    got = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert [got[k]["n_removed_words"] for k in range(12)] == [10] * 12 and all(got[k]["kept"] for k in range(12))
    assert got[50]["n_removed_words"] == 10 and not got[50]["kept"] and not got[50]["base_failed"]
    assert all(got[100 + k]["kept"] and got[100 + k]["n_removed_words"] == 0 for k in range(30))
    cleaned = {r["doc_id"]: r for r in quality.clean(docs).collect()}
    assert set(cleaned) == {*range(12), *range(100, 130)}
    assert cleaned[3]["text"] == samples.prose(103, 30) and cleaned[3]["n_chars"] == len(cleaned[3]["text"])
    assert cleaned[100]["text"] == docs.where("doc_id = 100").first()["text"] and cleaned[100]["n_chars"] == 1


def test_every_line_of_a_block_of_furniture_goes(spark):
    """Inner lines of a block always stand between the same neighbours, and its last one before the end."""
    foot = ["About this site and its makers", "Terms of use and privacy", "Contact the editors by letter", "All rights are with the authors", "Printed on grey paper here"]
    rows = [(k, samples.prose(300 + k, 60) + "\n" + "\n".join(foot), "en", "h", 1) for k in range(40)]
    rows.append((90, "just three words\n" + "\n".join(foot), "en", "h", 1))
    docs = spark.createDataFrame(rows, samples.DOCS)
    got = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert {r["n_removed_words"] for r in got.values()} == {sum(len(x.split()) for x in foot)}
    assert not got[90]["kept"] and not got[90]["base_failed"] and all(got[k]["kept"] for k in range(40))
    assert {r["doc_id"]: r["text"] for r in quality.clean(docs).collect()} == {k: samples.prose(300 + k, 60) for k in range(40)}


def test_a_line_repeated_inside_one_document_is_not_common(spark):
    often = "\n".join(f"{samples.prose(500 + k, 8)}\n{k}" for k in range(15))
    rows = [(1, often, "en", "h", 1), *((k, samples.prose(600 + k, 30) + f"\n{k}", "en", "h", 1) for k in range(2, 5))]
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, samples.DOCS)).collect()}
    assert {r["n_removed_words"] for r in got.values()} == {0}  # four documents show a number alone
    more = spark.createDataFrame([*rows, (5, samples.prose(700, 30) + "\n77", "en", "h", 1)], samples.DOCS)
    assert {r["doc_id"]: r["n_removed_words"] for r in quality.judge(more).collect()} == {1: 15, **{k: 1 for k in range(2, 6)}}


@pytest.mark.parametrize("often, common", [(9, False), (10, True)])
def test_the_limit_is_a_share_of_the_hosts_documents(spark, often, common):
    rows = [(k, samples.prose(900 + k, 12) + ("\nTerms of use" if k < often else ""), "en", "h", 1) for k in range(200)]
    rows += [(1000 + k, samples.prose(901, 12) + "\nTerms of use", "en", "h", 1) for k in range(50)]  # copies count neither way
    found = quality.judge(spark.createDataFrame(rows, samples.DOCS)).where("n_removed_words > 0").count()
    assert found == (often + 50 if common else 0)


def test_rows_of_a_host_do_not_raise_the_limit(spark):
    foot = "Terms of use and privacy"
    few = spark.createDataFrame([(k, samples.prose(800 + k, 30) + "\n" + foot, "en", "h", 1) for k in range(10)], samples.DOCS)
    many = spark.range(1000, 12000).select(F.col("id").alias("doc_id"), F.lit(samples.prose(9, 20)).alias("text"), F.lit("en").alias("lang"), F.lit("h").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    found = quality.judge(few.unionByName(many)).where("n_removed_words > 0").collect()
    assert {r["doc_id"]: r["n_removed_words"] for r in found} == {k: 5 for k in range(10)}


def test_quality_clean_keeps_columns_and_repeats(spark):
    docs = samples.clashing(spark)
    kept = quality.clean(docs)
    assert kept.schema.names == docs.schema.names
    assert [r["doc_id"] for r in kept.collect()].count(2) == 2
    assert quality.clean(samples.empty(spark)).count() == 0


# ---- decontamination


def brute_hits(text, tests):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t))
    words, hit, items = fold(text), set(), set()
    for item, test in tests:
        test = fold(test)
        for k in range(max(1, len(test) - 9) if test else 0):
            window = test[k:k + 10]
            for j in range(len(words) - len(window) + 1):
                if words[j:j + len(window)] == window:
                    hit |= set(range(j, j + len(window)))
                    items.add(str(item))
    return len(words), len(hit), sorted(items)


@pytest.mark.parametrize("at_once", [1_000_000, 20])
def test_decontamination_by_brute_force(spark, at_once):
    tests = [tuple(r) for r in samples.benchmark(spark).collect()]
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"])
                 for r in decontaminate.find(samples.clashing(spark), samples.benchmark(spark), at_once=at_once).collect())
    want = [(str(d), *brute_hits(t, tests)) for d, t, *_ in samples.rows()]
    assert got == sorted((*w, w[2] > 0) for w in want) and any(w[2] for w in want)
    assert decontaminate.find(samples.empty(spark), samples.benchmark(spark)).count() == 0
    assert decontaminate.find(samples.documents(spark), samples.benchmark(spark).limit(0)).where("contaminated").count() == 0


def test_copies_of_a_benchmark_item_are_scanned_once(spark, monkeypatch):
    scans, scan = [], decontaminate._scan
    monkeypatch.setattr(decontaminate, "_scan", lambda docs, items, *a: (scans.append(items), scan(docs, items, *a))[1])
    tests = samples.benchmark(spark)
    many = tests.unionByName(tests.where("item_id = 1").crossJoin(spark.range(500)).select("item_id", "text"))
    once = decontaminate.find(samples.documents(spark), tests, at_once=1000)
    found = decontaminate.find(samples.documents(spark), many, at_once=1000)
    assert len(scans) == 2 and sorted(scans[0]) == sorted(scans[1]) and same(once, found)


def test_decontaminated_texts_hold_no_window(spark):
    docs, tests = samples.clashing(spark), samples.benchmark(spark)
    clean = decontaminate.clean(docs, tests)
    assert clean.columns == docs.columns and decontaminate.find(clean, tests).where("contaminated").count() == 0
    sliced = decontaminate.clean(docs, tests, at_once=20)
    assert sorted(map(repr, sliced.collect())) == sorted(map(repr, clean.collect()))
    before = {r["doc_id"]: r["text"] for r in docs.where("doc_id is not null").collect()}
    after = {r["doc_id"]: r["text"] for r in clean.where("doc_id is not null").collect()}
    assert set(before) - set(after) == {27}  # "one" is a benchmark item
    words = before[29].split()
    assert after[29].split() == words[:50] + words[75:]
    assert all(after[d] == before[d] for d in after if d not in (10, 29, 30))


# ---- personal data and secrets


def brute_private(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = sum(sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and doubled % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def brute_secrets(text):
    out = [("assign", *m.span()) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_base_spans_by_brute_force():
    pick, ranks = random.Random(3), public_tokenizers.path("byte_bpe_50k.tiktoken")
    parts = ["a@b.c", "@", ".", "1", "22", "255.", "256", "+1", " (555)", "-", "4111 1111 1111 1111", "4111111111111111", " ", "x", "\u00e9", "+", "@d.e", "1.2.3.4", "password", '="',
             "TOKEN: ", "abcdef0123456789", "AKIA", "ABCDEFGHIJKLMNOP", "api_key", "\u017fecret=", "abc123abc123", ".5", '"', "Passwd", "account no: ", "12345678", "0"]
    for _ in range(8000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 14)))
        assert [s for s in pii.spans_of(text) if s[0] in pii.KINDS[:4]] == brute_private(text)
        assert [s for s in secrets.spans_of(text, ranks, public_tokenizers.PATTERN) if s[0] != "token"] == brute_secrets(text)


def test_added_kinds():
    spans = lambda t: [(k, t[a:b]) for k, a, b in pii.spans_of(t)]
    assert spans("IBAN: GB82 WEST 1234 5698 7654 32 thanks") == [("account", "GB82 WEST 1234 5698 7654 32")]
    assert spans("IBAN: GB82 WEST 1234 5698 7654 33") == []
    for calm in ("account: 2024-01-15", "account 2020-2021", "acct no 2020 2021 2022", "account 15-01-2024", "Konto 20240115"):
        assert spans(calm) == []
    assert spans("acct no 2020 4455 1234") == [("account", "2020 4455 1234")] and spans("account: 99887766") == [("account", "99887766")]
    assert spans("ssn 123-45-6789, ssn 000-45-6789") == [("ssn", "123-45-6789")]
    assert ("login", "ann:pw") in spans("ftp://ann:pw@host.example/x") and spans(None) == spans("") == []
    assert pii.masked("mail a.b@c.example now") == "mail [EMAIL] now" and pii.masked(None) is None
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    found = lambda t: [k for k, *_ in secrets.spans_of(t, ranks, pattern)]
    assert found("see Zx9QkP4vRt7LmW2sYb8NcJ3h ok") == ["token"]
    for calm in ("the straightforwardness_of_2_identifiers", "550E8400-E29B-41D4-A716-446655440000", "D41D8CD98F00B204E9800998ECF8427E", "2024-01-01-2025-01-01-2026", "internationalization"):
        assert found(calm) == []


def test_random_strings_of_letters_only():
    ranks, pattern, pick = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, random.Random(2)
    found = lambda t: [k for k, *_ in secrets.spans_of(t, ranks, pattern)]
    for letters in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/"):
        for _ in range(50):
            assert found("see " + "".join(pick.choice(letters) for _ in range(32)) + " ok") == ["token"]
    for calm in ("straightforwardnesses", "AbstractSingletonProxyFactoryBean", "MAX_CONNECTIONS_PER_ROUTE", "Kraftfahrzeughaftpflichtversicherung", "/usr/local/share/documentation", "--------------------"):
        assert found(calm) == []


def test_span_queries_and_masking(spark):
    docs = samples.clashing(spark).unionByName(spark.createDataFrame([(900, "x@y.example and +1 (555) 010-9999", "en", "s", 34)], samples.DOCS), allowMissingColumns=True)
    r = queries._span_columns(pii.find(docs), ["email", "ip", "card", "phone"]).where("doc_id = 900").first()
    assert (r["n_email"], r["n_phone"], r["spans"]) == (1, 1, "email:0:11,phone:16:33") and r["base_sha256"] == hashlib.sha256(r["spans"].encode()).hexdigest()
    masked = pii.clean(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert masked.where("doc_id = 900").first()["text"] == "[EMAIL] and [PHONE]" and masked.where("text is null").count() == 2
    assert pii.clean(samples.empty(spark)).count() == pii.find(samples.empty(spark)).count() == 0


# ---- language


def test_language_by_held_out_accuracy(spark):
    pools = {"aa": "karo melu tipa sono", "bb": "wrxt gghj plmk zzqv", "cc": "\u00e9l\u00e8ve \u00e7a \u00f1u b\u00eate"}
    rows = []
    for n in range(300):
        lang = sorted(pools)[n % 3]
        pick = random.Random(n)
        rows.append((n, " ".join(pick.choice(pools[lang].split()) + pick.choice(pools[lang].split()) for _ in range(pick.randint(2, 30))), lang))
    docs = spark.createDataFrame([*rows, (901, None, "aa"), (902, "12 !?", "aa"), (903, "", None)], "doc_id long, text string, lang string")
    filters = langid.learn(docs.where("doc_id % 5 <> 0"))
    got = {r["doc_id"]: r for r in langid.predict(docs, filters, ["doc_id"]).collect()}
    held = [r for r in rows if r[0] % 5 == 0]
    assert sum(got[d]["lang_pred"] == lang for d, _, lang in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values()) and all(got[k]["lang_pred"] == "und" for k in (901, 902, 903))
    nothing = langid.learn(docs.where("lang is null"))
    assert {r["lang_pred"] for r in langid.predict(docs, nothing, ["doc_id"]).collect()} == {"und"}
    learned = langid.Filters({"x": np.arange(5, dtype=np.uint64)})
    total, _ = learned.shares(["a" * 9, "word " * 200_000])  # longer than what is worked on at once
    assert total.tolist() == [9 + 8, 200_000 * (4 + 3)]


def test_every_language_is_learned_also_from_one_document(spark):
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 3 * 300)]
    pools = {f"l{k:03}": letters[3 * k:3 * k + 3] for k in range(300)}  # no two share a letter
    rows = [(k, " ".join("".join(random.Random(f"{k}{w}").choices(pool, k=4)) for w in range(30)), lang) for k, (lang, pool) in enumerate(pools.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, langid.learn(docs), ["doc_id"]).collect()}
    assert got == {k: lang for k, _, lang in rows}
