"""Centroid clusters, toxicity and phrases against SQL, brute force and held-out rows, with odd cases."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import phrases, queries, subword, va_file
from oracle_compare import compare, duck_connection
from test_llm import docs, odd, prose  # noqa: F401

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_va_file_clusters", "op13_phrase_mining"])
def test_queries_equal_their_sql(spark, name):
    r = compare(spark, duck_connection(SF), name, queries.QUERIES[name](spark, SF), queries.ORACLE_SQL[name])
    assert r["ok"], r


def brute_clusters(rows, k, rounds, dim, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (key(r), r[1]))[:k]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((gap(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(own[j]) for x in zip(*own[j], strict=True)] if own[j] else c for j, c in enumerate(centroids)]
    done = [(i, *nearest(v)) for i, v in kept]
    inertia = collections.Counter()
    for _, d, c in done:
        inertia[c] += d
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    return collections.Counter((i, c, d, inertia[c], sum(inertia.values()), digest(c)) for i, d, c in done)


@pytest.mark.parametrize("k, rounds, spread", [(4, 3, 1.0), (16, 0, 0.01), (9, 2, 40000.0)])
def test_clusters_equal_brute_force(spark, k, rounds, spread):
    r = random.Random(k)
    rows = [(i, [r.gauss(i % 5, 1) * spread for _ in range(6)]) for i in range(150)]
    rows += [(i, [0.5 * (i % 2)] * 6) for i in range(200, 260)]                        # ties and repeated vectors
    rows += [(3, rows[0][1]), (3, rows[0][1]), (None, rows[1][1]), (None, None), (300, []), (301, [1.0] * 5), (302, [1.0] * 7),
             (303, [1.0] * 5 + [None]), (304, [1.0] * 5 + [math.nan]), (305, [1.0] * 5 + [math.inf]), (306, [-math.inf] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("cluster", "_id", "_x", "cells", "c")})
    out = va_file.cluster(spark, df, k=k, rounds=rounds, dim=6).drop("n_candidates").collect()
    assert collections.Counter(map(tuple, out)) == brute_clusters(rows, k, rounds, 6)


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(1, [0.1, 0.2]), (2, [5.0, 6.0])], "vec_id long, embedding array<float>")
    out = va_file.cluster(spark, few, dim=2)
    assert sorted(r.distance for r in out.collect()) == [0, 0]
    none = va_file.cluster(spark, few.where("vec_id > 5"), dim=2)
    assert none.count() == 0 and none.dtypes == out.dtypes
    with pytest.raises(Exception, match="exact below"):
        va_file.cluster(spark, spark.createDataFrame([(1, [1e30, 0.0])], few.schema), dim=2)


def test_intervals_hold_distances_and_leave_few_candidates():
    r = np.random.default_rng(2)
    x = np.floor(64 * r.normal(size=(3000, 64)) / 8).astype(np.int32)
    edge = np.sort(np.hstack((x.min(0)[:, None], np.linspace(*np.quantile(x, [0.002, 0.998], axis=0), va_file.CELLS - 1, axis=1).astype(int),
                              x.max(0)[:, None] + 1)), 1)
    cells = np.stack([np.searchsorted(edge[d, 1:-1], x[:, d], "right") for d in range(64)], 1).astype(np.uint8)
    assert (va_file._unpack(va_file._pack(cells), 64) == cells).all()
    near = va_file.Nearest(edge, x[:16].astype(np.int64))
    best, size = near.assign(cells, x)
    assert (best == ((x[:, None, :].astype(int) - x[None, :16]) ** 2).sum(2).argmin(1)).all() and size.mean() < 4


def test_toxicity_held_out_and_misspelled(spark):
    r = random.Random(3)
    parts = "an the er on re he ti nd st en ou ing of ble ion ly wh".split()
    known = ["".join(r.choice(parts) for _ in range(r.randrange(1, 5))) for _ in range(3000)]
    text = lambda n: [known[min(int(r.expovariate(1 / 150)), 2999)] for _ in range(n)]
    rows = []
    for i in range(1200):
        w = text(r.randrange(5, 400))
        if i % 4 == 0:
            for _ in range(1 + len(w) // 100):
                w.insert(r.randrange(len(w)), r.choice(["blockhead", "nitwit", "scoundrel"]))
        rows.append(" ".join(w))
    texts = rows + [" ".join([*text(9), w, *text(5), f"x{w}"]) for w in ("blockheads", "nitwitts", "scoundrell")] + ["", None, f"{known[0]} " * 50_000]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(1200)] + [(1, None), (None, 1)], "doc_id long, toxic int")
    out = {x.doc_id: x.score for x in subword.score(spark, docs(spark, texts), labels, F.col("doc_id") % 5 != 0, ["doc_id"]).collect()}
    assert sum((out[i] >= 0.5) == (i % 4 == 0) for i in range(0, 1200, 5)) >= 0.98 * 240
    assert all(out[i] >= 0.5 for i in range(1200, 1203)) and all(out[i] < 0.5 for i in range(1203, 1206)), [out[i] for i in range(1200, 1206)]


def test_toxicity_odd_rows_and_labels(spark, odd):  # noqa: F811
    labels = spark.createDataFrame([(2, 1), (4, 0), (4, 1), (5, 0), (None, 1)], "doc_id long, toxic int")
    own = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = subword.score(spark, odd, labels, F.lit(True), ["doc_id", "_row"]).collect()
    assert len(out) == 8 and all(0 <= x.score <= 1 and x._row == 7 for x in out) and len({x.score for x in out if x.doc_id == 4}) == 1
    assert subword.score(spark, odd.limit(0), labels, F.lit(True), ["doc_id"]).count() == 0
    assert {x.score for x in subword.score(spark, odd, labels.limit(0), F.lit(True), ["doc_id"]).collect()} == {0.5}
    assert {x.score for x in subword.score(spark, odd, labels, F.col("toxic") == 1, ["doc_id"]).collect()} == {0.999}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == own


def brute_phrases(rows, max_words, min_count, top, percent):
    f = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        n, found = sum(v for p, v in c.items() if len(p) == 1), []
        for p, a in c.items():
            if len(p) < 2 or a < min_count or any(
                    100 * b >= percent * a for q, b in c.items() if len(q) > len(p) and b >= min_count
                    and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("max_words, top", [(3, 40), (4, 2000)])
def test_phrases_equal_brute_force(spark, monkeypatch, max_words, top):
    monkeypatch.setattr(phrases, "DENSE", 50)  # these run in the driver only; the workers' tiles are tested below
    r = random.Random(4)
    seps = [" ", " ", " ", "\t", " , ", ". ", "\n", "\x0b", "; ", "\x1f", "  "]
    texts = ["".join(f"{r.choice('aAbBcdé日')}{r.choice(['', '1'])}{r.choice(seps)}" for _ in range(r.randrange(200))) for _ in range(120)]
    rows = [(r.choice(["en", "de", None]), t) for t in texts] + [("en", None), (None, ""), ("fr", "one two"), ("x", " . ")] + [("en", "Fox jumps over it")] * 30
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit(7) for c in ("h1", "n", "word", "a", "rank")})
    out = phrases.mine(spark, df, max_words=max_words, min_count=5, top=top)
    assert sorted(map(tuple, out.collect())) == brute_phrases(rows, max_words, 5, top, 50)
    assert phrases.mine(spark, df.limit(0)).count() == 0


def test_pairs_in_dense_and_sparse_tiles():
    r = np.random.default_rng(5)
    a = np.concatenate((r.integers(0, 300, 100_000), r.integers(0, 60_000, 20_000)))
    b = np.concatenate((r.integers(0, 200, 100_000), r.integers(0, 60_000, 20_000)))
    got = phrases.counted(a, b)
    assert len(got[0]) == len({*zip(*(x.tolist() for x in got[:2]), strict=True)})
    assert dict(zip(zip(got[0].tolist(), got[1].tolist(), strict=True), got[2].tolist(), strict=True)) == collections.Counter(zip(a.tolist(), b.tolist(), strict=True))
    assert all(len(x) == 0 for x in phrases.counted(a[:0], a[:0]))


def test_words_of_equal_hashes_are_told_apart(spark, monkeypatch):
    """A vocabulary in which two words share a hash is counted again, with other hashes for them."""
    seen, real = [], phrases.vocabulary

    def clashing(d, rehashed):
        seen.append(len(rehashed))
        out = real(d, rehashed)
        first = out.where("word = 'aa'").select("h1").first()[0]
        return out.withColumn("h1", F.when(F.col("word") == "bb", F.lit(first)).otherwise(F.col("h1"))) if len(seen) == 1 else out

    monkeypatch.setattr(phrases, "vocabulary", clashing)
    df = spark.createDataFrame([("en", "aa bb cc")] * 12, "lang string, text string")
    assert [r.phrase for r in phrases.mine(spark, df).collect()] == ["aa bb cc"] and seen == [0, 1]
