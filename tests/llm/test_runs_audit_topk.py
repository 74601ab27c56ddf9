"""Operators 11 to 13 beside plain versions, with nulls, ties, repeated rows, long texts, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodloom.llm import divergence, runs, topk
from moodloom.llm.queries import op11_periodic_runs, op13_top_k, with_cycles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df, *columns):
    return Counter(tuple(row[c] for c in columns) for row in df.collect())


# Operator 11.


def plain_runs(words, min_words=6, exponent=4):
    found, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i : i + length]
            if j > i and length >= max(min_words, exponent * q):
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts():
    rng = random.Random(3)
    texts = [None, "", " \t\n", "a", "a " * 5, "a " * 6, "a b " * 4, "x " + "a b c " * 9 + "a b y", "a b " * 8, "é\x1cü " * 7]
    for _ in range(60):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 90))]
        if rng.random() < 0.7 and words:
            begin, p = rng.randrange(len(words)), rng.randint(1, 9)
            for i in range(begin, len(words)):
                words[i] = words[begin + (i - begin) % p]
        texts.append(rng.choice([" ", "\n", " \x0b "]).join(words))
    unit = [f"w{rng.randrange(900)}" for _ in range(700)]
    texts.append(" ".join(unit * 5 + ["end"] * 40))
    texts.append(" ".join(f"v{rng.randrange(3000)}" for _ in range(30_000)))
    return texts


def test_runs_equal_a_plain_search(spark):
    texts = periodic_texts()
    rows = [(i // 2 or None, text, "x", 1) for i, text in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[7], rows[7]], "doc_id long, text string, runs string, n_words int").repartition(3)
    expected = Counter()
    for doc_id, text, *_ in [*rows, rows[7], rows[7]]:
        words = WORD.findall(text or "")
        found = plain_runs(words) if len(words) < 10_000 else []
        expected[doc_id, len(words), tuple(found), collapsed(words, found)] += 1
    got = Counter(
        (r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in runs.find_runs(docs).collect()
    )
    assert got == expected
    assert sum(len(key[2]) > 0 for key in expected) > 20 and any((0, 3500, 700) in key[2] for key in expected)


def test_runs_of_text_ids_and_of_nothing(spark):
    docs = spark.createDataFrame([("k", "a " * 8)], "key string, body string")
    row = runs.find_runs(docs, id_column="key", text_column="body").first()
    assert (row["doc_id"], row["runs"][0]["length"], row["collapsed"]) == ("k", 8, "a")
    assert runs.find_runs(docs.limit(0), id_column="key", text_column="body").count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(np.zeros(9, "i8"), 6, 2)


def test_runs_query(spark, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 200))) for _ in range(150)] + ["", None]
    rows = [(i, text) for i, text in enumerate(texts)] + [(None, "a " * 9), (-3, "b " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    expected = Counter()
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = plain_runs(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{l},{q}\n" for s, l, q in found)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, found))]
        milli = 1000 * best[1] // best[2] if found else None
        expected[(doc_id, len(found), *best, milli, *digests)] += 1
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    result = op11_periodic_runs(spark, str(tmp_path))
    assert rows_of(result, *names) == expected
    kinds = dict(result.dtypes)
    assert all(kinds[c] == ("string" if "sha256" in c else "bigint") for c in names)
    assert with_cycles(docs.limit(0)).count() == 0


# Operator 12.


def plain_audit(rows, min_docs, top):
    docs, occurrences, total = defaultdict(set), Counter(), Counter()
    groups = {(lang or "", source or "") for lang, source, _ in rows}
    for i, (lang, source, text) in enumerate(rows):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for term in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered):
            docs[lang or "", term].add(i)
            occurrences[lang or "", source or "", term] += 1
            total[lang or "", term] += 1
    kept = defaultdict(list)
    for (lang, term), held in docs.items():
        if len(held) >= min_docs:
            kept[lang].append(term)
    out = Counter()
    shares = {}
    for lang, source in groups:
        n = sum(occurrences[lang, source, t] for t in kept[lang])
        shares[lang, source] = {t: 1 + 10**9 * (occurrences[lang, source, t] + 5) // (n + 5 * len(kept[lang])) for t in kept[lang]}
    for lang, source in groups:
        n = sum(total[lang, t] for t in kept[lang])
        usual = {t: 1 + 10**9 * (total[lang, t] + 5) // (n + 5 * len(kept[lang])) for t in kept[lang]}
        mine = shares[lang, source]
        pairs = [(-sum(abs(mine[t] - shares[g][t]) for t in mine), g[1]) for g in groups if g[0] == lang and g[1] != source]
        terms = [(usual[t] - mine[t], t) for t in mine if occurrences[lang, source, t] and mine[t] > usual[t]]
        ordered = [("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode())))]
        ordered.append(("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top]))
        for part, items in ordered:
            for rank, (value, item) in enumerate(items, 1):
                out[lang, source, part, item, -value, rank] += 1
    return out


@pytest.fixture(scope="module")
def sourced():
    rng = random.Random(4)
    vocabulary = ["the", "The", "the,", "(the)", "état", "ÉTAT", "日本", "a-a-b", "x_y", "don't", " z", *(f"t{i}k" for i in range(30))]
    rows = []
    for lang, sources in (("en", ["s1", "s2", "s3", None]), ("fr", ["s1", "S1"]), (None, ["lone"]), ("rare", ["p", "q", "r"])):
        for _ in range(70 if lang != "rare" else 3):
            source = rng.choice(sources)
            words = rng.choices(vocabulary, [1 + (hash_of(w, source) % 5) for w in vocabulary], k=rng.randint(0, 60))
            rows.append((lang, source, rng.choice([" ", "\n\t "]).join(words)))
    rows += [("en", "wordless", "12 34 -- !"), ("en", "void", None), ("en", "s1", "the " * 600), rows[0], rows[0]]
    rows += [("en", "s2", "a,b;" * 3000), ("fr", "s1", "x" * 100_000)]
    return rows


def hash_of(word, source):
    return zlib.crc32(f"{word}{source}".encode())


@pytest.mark.parametrize("min_docs, top, small", [(30, 50, False), (2, 5, True)])
def test_audit_equals_a_plain_version(spark, sourced, monkeypatch, min_docs, top, small):
    if small:  # several blocks, parts and tiles, and shuffled joins
        for name, value in (("CELLS", 20), ("TILE", 2), ("BLOCK_BYTES", 3000), ("ROWS_AT_ONCE", 7), ("LOT_BLOCKS", 3), ("BUCKET_BYTES", 500), ("PACK_ROWS", 50)):
            monkeypatch.setattr(divergence, name, value)
        monkeypatch.setattr("moodloom.llm.common.if_small.__defaults__", (0,))
    schema = "lang string, source string, text string, term string, block long, share int"
    docs = spark.createDataFrame([(*row, "t", 1, 2) for row in sourced], schema).repartition(4)
    names = ("lang", "source", "part", "item", "value", "rank")
    found = divergence.audit_sources(docs, min_docs, top)
    assert rows_of(found, *names) == plain_audit(sourced, min_docs, top)
    assert [dict(found.dtypes)[c] for c in ("value", "rank")] == ["bigint", "int"]


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit_sources(empty).count() == 0
    blank = spark.createDataFrame([("en", "a", ""), ("en", "b", None), ("de", "a", "1 2")], empty.schema)
    names = ("lang", "source", "part", "item", "value", "rank")
    assert rows_of(divergence.audit_sources(blank), *names) == {("en", "a", "pair", "b", 0, 1): 1, ("en", "b", "pair", "a", 0, 1): 1}


def test_shares_hold_large_counts(spark):
    big = 9 * 10**18
    row = spark.range(1).select(divergence.share(F.lit(big), F.lit(big), F.lit(7)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (big + 5) // (big + 35)


# Operator 13.


def plain_top(rows, k):
    usable = [
        (key, vec_id, [math.floor(256 * x) for x in vector])
        for key, (vec_id, vector) in enumerate(rows)
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    out = Counter()
    for key, query_id, q in usable:
        if query_id is None or query_id % 50:
            continue
        score = lambda v: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, v))))
        scores = [(-score(v), i is None, i or 0, i) for other, i, v in usable if other != key]
        for rank, (found, _, _, i) in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1):
            out[query_id, rank, i, -found] += 1
    return out


def vector_rows():
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=12).astype("f4").tolist()) for i in range(400)]
    rows += [(400 + i, rows[i % 7][1]) for i in range(60)]  # ties
    rows += [(500 + i, (-np.abs(rng.normal(size=12))).tolist()) for i in range(3)]
    rows += [(550, [0.0] * 12), (600, []), (601, [1.0, 2.0]), (650, [0.001] * 12), rows[50], rows[50], rows[3], (None, rows[9][1])]
    rows += [(700, None), (701, [None] * 12), (702, [float("nan")] * 12), (750, [float("inf")] * 12)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int, key string, rank string, score string"


@pytest.mark.parametrize("shard, step, block, k", [(2048, 1024, 256, 5), (64, 16, 4, 5), (10, 3, 2, 12)])
def test_top_k_equals_a_plain_search(spark, monkeypatch, shard, step, block, k):
    for name, value in (("SHARD_ROWS", shard), ("STEP", step), ("QUERY_ROWS", block)):
        monkeypatch.setattr(topk, name, value)
    rows = vector_rows()
    table = spark.createDataFrame([(*row, 1, "k", "r", "s") for row in rows], SCHEMA).repartition(3)
    found = topk.search_top_k(table, F.col("vec_id") % 50 == 0, k)
    assert rows_of(found, "query_id", "rank", "vec_id", "score") == plain_top(rows, k)
    assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}


def test_top_k_of_few_rows_and_of_huge_values(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(0, [1.0])], [(0, []), (50, [])], [(0, None)], [(0, [1e30, -3.0]), (1, [1e30, 5.5]), (2, [-1e300, 1.0]), (50, [1e9, 1e8])]):
        table = spark.createDataFrame(rows, schema)
        found = topk.search_top_k(table, F.col("vec_id") % 50 == 0)
        assert rows_of(found, "query_id", "rank", "vec_id", "score") == plain_top(rows, 5)


def test_essential_terms_alone_are_traversed():
    rng = np.random.default_rng(5)
    matrix = np.zeros((4000, 40))
    matrix[np.arange(4000), rng.integers(0, 40, 4000)] = rng.integers(1, 9, 4000)
    matrix[::100, 0] = 500
    shard = topk.Shard(matrix)
    read = []
    shard.postings = [[(CountedRows(rows, read), values) for rows, values in side] for side in shard.postings]
    query = np.ones((1, 40))
    query[0, 0] = 50
    ((rows, scores),) = shard.search(query, 5, np.array([-1]))
    plain = matrix @ query[0]
    assert scores.tolist() == sorted(plain, reverse=True)[:5] and rows.tolist() == np.lexsort((np.arange(4000), -plain))[:5].tolist()
    assert sum(read) < 100  # all other postings stay unread once five rows are known


def test_few_rows_of_dense_vectors_are_scored_one_by_one(monkeypatch):
    rng = np.random.default_rng(6)
    matrix, queries = np.floor(rng.normal(size=(4000, 32)) * 256), np.floor(rng.normal(size=(50, 32)) * 256)
    scored, competitive = [], topk.Shard.competitive

    def counted(*args):
        scored.append(competitive(*args))
        return scored[-1]

    monkeypatch.setattr(topk.Shard, "competitive", counted)
    found = topk.Shard(matrix).search(queries, 5, np.full(50, -1))
    for (rows, scores), plain in zip(found, queries @ matrix.T):
        best = np.lexsort((np.arange(4000), -plain))[:5]
        assert rows.tolist() == best.tolist() and scores.tolist() == plain[best].tolist()
    assert sum(len(q) for q, _ in scored) < 0.01 * 50 * 4000


class CountedRows(np.ndarray):
    def __new__(cls, rows, read):
        out = rows.view(cls)
        out.read = read
        return out

    def __getitem__(self, key):
        part = np.asarray(self)[key]
        self.read.append(len(part))
        return part


def test_top_k_query(spark, tmp_path):
    rows = vector_rows()
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert rows_of(op13_top_k(spark, str(tmp_path)), "query_id", "rank", "vec_id", "score") == plain_top(rows, 5)
