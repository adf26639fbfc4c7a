"""The pipeline against plain Python, and the SQL twins at the smallest scale."""

import collections
import re

import numpy as np
import pytest

import corpus_pipeline
from peakledger.llm import oracle, pii, queries
from . import samples
from .test_documents import ascii_lower, brute_fingerprint, brute_groups, plain_words

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_pipeline_by_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer
    mail = " write to ann@mail.example or +1 (555) 010-9999 today"
    rows = [*samples.rows(), (800, samples.rows()[12][1] + mail, "en", "src1", 5), (801, samples.rows()[13][1].upper(), "en", "src1", 5)]
    rows = [r for r in rows if r[0] is not None]
    spark.createDataFrame(rows, samples.DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    samples.benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    tests = [tuple(r) for r in samples.benchmark(spark).collect()]

    def passes(text):
        words = plain_words(text)
        often = collections.Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
        again = {k + j for k in range(len(words) - 4) if often[tuple(words[k:k + 5])] > 1 for j in range(5)}
        return len(words) >= 10 and 100 * len(again) <= 20 * len(words)

    kept = {d: t for d, t, *_ in rows if passes(t)}
    prints = {d: brute_fingerprint(t) for d, t in kept.items()}
    group, least = brute_groups(list(prints.values())), {}
    for d, p in prints.items():
        least[group[p]] = min(d, least.get(group[p], d))
    kept = {d: t for d, t in kept.items() if least[group[prints[d]]] == d}
    expected = {}
    for d, text in kept.items():
        fold = [ascii_lower(w) for w in text.split()]
        hit = set()
        for _, test in tests:
            test = re.findall(r"[a-z0-9]+", ascii_lower(test))
            for k in range(max(1, len(test) - 9) if test else 0):
                window = test[k:k + 10]
                hit |= {j + i for j in range(len(fold)) if fold[j:j + len(window)] == window for i in range(len(window))}
        if not hit or (len(hit) <= 0.5 * len(fold) and len(fold) - len(hit) >= 10):
            expected[d] = " ".join(w for k, w in enumerate(text.split()) if k not in hit)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids, used = collections.defaultdict(list), collections.defaultdict(int)
    for r in sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == len(ids[r["doc_id"]]) and r["length"] * 4 == len(r["ids"])
        ids[r["doc_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048 and all(x[-1] == 0 for x in ids.values())
    got = {d: " ".join(tokenizer.decode(x[:-1], skip_special_tokens=False).split()) for d, x in ids.items()}
    assert got == {d: " ".join(pii.masked(t).split()) for d, t in expected.items()}
    assert "[EMAIL] or [PHONE] today" in got[800] and 801 not in got and 20 not in got


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    samples.benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (samples.clashing(spark), samples.empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "simhash near duplicates", "benchmark decontamination", "personal data", "best-fit packing"]


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_sql_twins(spark, name):
    import duckdb
    sf_dir = "/root/testdata/sf0.001"
    twin = duckdb.connect()
    for table in ("documents", "pages"):
        twin.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    mine = queries.QUERIES[name](spark, sf_dir)
    theirs = twin.sql(f"SELECT {', '.join(mine.columns)} FROM ({oracle.SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, mine.collect()))) == sorted(map(repr, theirs))
