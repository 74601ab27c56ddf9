"""Each dealt operator beside a plain version on a small table with nulls, copies, empty and long texts."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from moodloom.llm import (
    decontaminate,
    licenses,
    packing,
    passages,
    quality,
    seeds,
    simhash,
    suffixes,
    token_counts,
    token_files,
    toxicity,
)
from moodloom.llm.queries import TOKENIZER
from moodloom.sources.staging import staging_path

SCHEMA = "doc_id long, text string, hash string, start int, words string, uid int, owner string, fp string"


def corpus():
    rng = random.Random(5)
    vocabulary = ["the", "of", "and", "über", "École", "naïve", *(f"w{i}" for i in range(400))]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, item = prose(70), "Q: " + prose(14)
    texts = [prose(rng.randint(1, 120)) for _ in range(30)]
    texts += [texts[3], texts[3], texts[4].upper()]
    texts += [f"{prose(20)} {passage} {prose(9)}", f"{passage} {prose(30)}", f"{prose(5)}\n{passage}."]
    texts += [f"{prose(8)} {item.upper()} {prose(8)}", item, "Alpha, BETA!"]
    texts += ["", None, None, "   \n\t ", "a", "a a a a a a a a", "line one two\nline one two\n\nline one two"]
    texts += ["x" * 5000, prose(6000), "ab" * 400, "spam " * 60, "# * $ | < > & % " * 10, "<|endoftext|> x", "½ ² _a_ 日本語 z"]
    texts += ["Released under the MIT License.\nother text here", "licensed under the apache license version 2.0", "éa" * 60]
    rows = [(i * 3 % 101, text) for i, text in enumerate(texts)]
    return [*rows, rows[0], (None, prose(60)), (None, texts[5])], [(1, item), (2, "alpha beta"), (3, None), (4, "?!"), (5, prose(30))]


@pytest.fixture(scope="module")
def tables(spark):
    rows, items = corpus()
    docs = spark.createDataFrame([(*row, "h", 1, "w", 2, "o", "f") for row in rows], SCHEMA)
    bench = spark.createDataFrame([(*item, "w", 3) for item in items], "item_id long, text string, window_id string, n int")
    return docs.repartition(5).cache(), bench, rows, items


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def found(df, *columns):
    return Counter(tuple(row[c] for c in columns) for row in df.collect())


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontaminate(tables, nothing, monkeypatch, broadcast):
    docs, bench, rows, items = tables
    if not broadcast:
        monkeypatch.setattr(decontaminate, "if_small", lambda table, *sizes: table)
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for s in range(max(len(w) - 9, 1)) if w else ():
            windows[tuple(w[s : s + 10])].add(str(item))
    expected = Counter()
    for doc_id, text in rows:
        w, hit, ids = words(text), set(), set()
        for s in range(len(w)):
            for n in range(1, 11):
                if tuple(w[s : s + n]) in windows and s + n <= len(w):
                    hit |= set(range(s, s + n))
                    ids |= windows[tuple(w[s : s + n])]
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        expected[doc_id, len(w), len(hit), len(ids), digest, bool(hit)] += 1
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert found(decontaminate.decontaminate(docs, bench), *names) == expected
    assert sum(n for row, n in expected.items() if row[5]) >= 3
    assert decontaminate.decontaminate(nothing, bench).count() == 0
    assert found(decontaminate.decontaminate(docs, bench.limit(0)), "contaminated") == {(False,): len(rows)}


def test_quality(tables, nothing):
    docs, _, rows, _ = tables
    expected = Counter()
    for doc_id, text in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
        n_symbols = len(re.findall(r"[#*$%&|<>]", text))
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        expected[doc_id, len(w), sum(map(len, w)), n_symbols, len(lines) - len(set(lines)), len(covered), failed] += 1
    ledger = quality.build_ledger(docs).withColumn("base_failed", quality.fails(quality.POLICIES[0].mask))
    names = ("doc_id", *quality.MEASURES[:5], "base_failed")
    assert found(ledger, *names) == expected
    judged = quality.apply_policy(ledger, quality.POLICIES[-1])
    assert judged.where("base_failed and kept").count() == 0 and judged.where("kept").count() > 5
    effects = {row["rule"]: row["n_failed"] for row in quality.ablations(ledger, quality.POLICIES[-1]).collect()}
    assert effects["few_words"] == ledger.where("n_words < 50").count()
    assert quality.build_ledger(nothing).count() == 0


def test_licenses(tables, nothing):
    docs, _, rows, _ = tables

    def grams(text):
        w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
        return {tuple(w[i : i + 2]) for i in range(max(len(w) - 1, 1))} if w else set()

    expected = Counter()
    for doc_id, text in rows:
        for line, part in enumerate((text or "").split("\n")):
            a = grams(part)
            for name, template in licenses.TEMPLATES.items():
                b = grams(template)
                if a and 2 * len(a & b) / (len(a) + len(b)) >= 0.8:
                    expected[doc_id, line, name, len(a & b)] += 1
    assert found(licenses.scan_licenses(docs), "doc_id", "line", "license_id", "n_common") == expected and expected
    assert licenses.scan_licenses(nothing).count() == 0


def test_wrapped_and_embedded_licenses(spark):
    grant, gpl, bsd = (licenses.TEMPLATES[n] for n in ("MIT-grant", "GPL-3.0-header", "BSD-redistribution"))
    wrap = lambda text, n=8: "\n".join(" * " + " ".join(text.split()[i : i + n]) for i in range(0, len(text.split()), n))
    texts = [
        "This project is released under the MIT License, see the LICENSE file for details.",
        f"Copyright someone\n\n{wrap(grant)}\n\nThe above notice shall be kept.",
        f"code\n{wrap(gpl)}\nmore code {'x y z ' * 50}\n{wrap(bsd, 5)}",
        f"{'the of in and ' * 200}Released under the\nMIT License. Text between. Released under the MIT License.",
        "of the license under the terms of the work " * 30,
    ]
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[0]), (0, texts[0])], "doc_id long, text string")
    expected = {(0, 0, "MIT"): 1, (1, 2, "MIT-grant"): 1, (2, 1, "GPL-3.0-header"): 1, (2, 2 + len(wrap(gpl).split("\n")), "BSD-redistribution"): 1}
    expected |= {(3, 0, "MIT"): 1, (3, 1, "MIT"): 1, (None, 0, "MIT"): 1}
    result = licenses.scan_licenses(docs)
    assert found(result, "doc_id", "line", "license_id") == expected
    assert result.where("dice < 1").count() == 0
    one_word = spark.createDataFrame([("W", "Details!")], "license_id string, text string")
    assert found(licenses.scan_licenses(docs, one_word), "doc_id", "line", "license_id") == {(0, 0, "W"): 1, (None, 0, "W"): 1}


def test_many_licenses_in_one_text(spark):
    filler = "some words of code that belong to no notice at all"
    notices = [licenses.TEMPLATES["MIT"], licenses.TEMPLATES["Apache-2.0"], "Use of this\nsource code is governed by a BSD-style license that can be found in the LICENSE file."]
    text = "\n".join(part for i in range(300) for part in (filler, notices[i % 3]))
    docs = spark.createDataFrame([(1, text), (2, filler)], "doc_id long, text string")
    got = Counter(licenses.scan_licenses(docs).select("license_id", "dice").collect())
    assert got == {("MIT", 1.0): 100, ("Apache-2.0", 1.0): 100, ("BSD-use", 1.0): 100}


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def test_token_counts_and_files(spark, tables, nothing):
    docs, _, rows, _ = tables
    encode = library().encode
    ids = [(doc_id, text or "", encode(text or "", add_special_tokens=False).ids) for doc_id, text in rows]
    expected = Counter((doc_id, len(text.encode()), len(x), len(x) > 512) for doc_id, text, x in ids)
    counted = token_counts.count_tokens(docs, TOKENIZER)
    assert found(counted, "doc_id", "n_bytes", "n_tokens", "over_limit") == expected
    path = staging_path(spark, "test-tokens")
    token_files.write_tokens(docs, path, TOKENIZER, end_id=2)
    ordered = sorted(ids, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    start, want = 0, Counter()
    for doc_id, _, x in ordered:
        whole = np.array([*x, 2], "<u4").tobytes()
        want[doc_id, start, len(x) + 1, bytearray(whole).hex()] += 1
        start += len(x) + 1
    read = token_files.read_tokens(spark, path).withColumn("ids", F.lower(F.hex("ids")))
    assert found(read, "doc_id", "start", "n_tokens", "ids") == want
    assert token_files.read_document(spark, path, rows[7][0]).count() == 1
    empty = staging_path(spark, "test-tokens")
    token_files.write_tokens(nothing, empty, TOKENIZER, end_id=2)
    assert token_files.read_tokens(spark, empty).count() == 0 == token_counts.count_tokens(nothing, TOKENIZER).count()


def test_blocks_of_another_dictionary_are_an_error(spark):
    paths = [staging_path(spark, "test-tokens") for _ in range(2)]
    for path, word in zip(paths, ("one", "two")):
        docs = spark.createDataFrame([(i, f"{word} {i} " * 30) for i in range(40)], "doc_id long, text string")
        token_files.write_tokens(docs, path, TOKENIZER, end_id=2)
    spark.read.schema(token_files.BLOCKS).parquet(f"{paths[1]}/blocks").write.mode("append").parquet(f"{paths[0]}/blocks")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_tokens(spark, paths[0]).count()


def test_batches_are_balanced_by_bytes():
    sizes = [len(p.encode()) for p in ("日" * 10, "a" * 10, "é" * 10)]
    assert list(token_counts.balanced(sizes, 40)) == [slice(0, 2), slice(2, 3)]


def test_long_texts_are_split_without_a_change():
    text = "one two's  three\n\n x1 " * 9_000
    parts = token_counts.safe_parts(text)
    assert len(parts) > 1 and "".join(parts) == text
    encode = library().encode
    assert sum(len(encode(p).ids) for p in parts) == len(encode(text).ids)


def test_packing(tables, nothing):
    docs, _, rows, _ = tables
    encode = library().encode
    packed = packing.pack_documents(docs, TOKENIZER, 0).collect()
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for p in packed:
        by_sequence[p.sequence_id].append((p.offset, p.length))
        by_document[p.doc_id].append(p)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end and length > 0
            end += length
        assert end <= 1024
    single = [(d, t) for d, t in rows if len([1 for r in rows if r[0] == d]) == 1]
    for doc_id, text in single:
        pieces = sorted(by_document[doc_id], key=lambda p: p.start)
        ids = np.array([*encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        assert b"".join(bytes(p.ids) for p in pieces) == ids and all(p.doc_tokens * 4 == len(ids) for p in pieces)
    full = sum(1024 - sum(n for _, n in s) for s in by_sequence.values())
    assert full < 1024 and packing.pack_documents(nothing, TOKENIZER, 0).count() == 0


def print_of(text):
    w = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(len(w) - 2, 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(tables, nothing, monkeypatch):
    docs, _, rows, _ = tables
    prints = [print_of(text) for _, text in rows]
    component = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= 2:
                    component[i] = component[j] = min(component[i], component[j])
    least = {c: min((rows[i][0] for i in range(len(rows)) if component[i] == c and rows[i][0] is not None), default=None) for c in component}
    expected = Counter((rows[i][0], simhash.signed(prints[i]), least[component[i]]) for i in range(len(rows)))
    for bucket in (simhash.LARGE_BUCKET, 1):
        monkeypatch.setattr(simhash, "LARGE_BUCKET", bucket)
        assert found(simhash.near_duplicates(docs), "doc_id", "fp", "component_id") == expected
    assert simhash.near_duplicates(nothing).count() == 0


def test_bit_sliced_distances():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, (150, 4), dtype="u8")
    near = base.copy()
    for i in range(150):
        for b in rng.choice(256, rng.integers(30, 70), replace=False):
            near[i, b // 64] ^= np.uint64(1 << int(b % 64))
    prints = np.concatenate([base, near])
    for bucket in (np.zeros(300, int), np.arange(300) // 70):
        i, j = simhash.close_pairs(prints, bucket, 48)
        distance = np.bitwise_count(prints[:, None] ^ prints[None]).sum(axis=2)
        want = {(a, b) for a in range(300) for b in range(a + 1, 300) if distance[a, b] <= 48 and bucket[a] == bucket[b]}
        assert set(zip(i.tolist(), j.tolist())) == want


def test_shortest_tree():
    rng = np.random.default_rng(3)
    left, right = rng.integers(0, 60, (2, 80))
    length = rng.integers(1, 6, 80)
    taken = simhash.shortest_tree(60, left, right, length)
    group = list(range(60))
    total = 0
    for k in np.argsort(length, kind="stable"):
        a, b = group[left[k]], group[right[k]]
        if a != b:
            total += length[k]
            group = [a if g == b else g for g in group]
    assert length[taken].sum() == total and len(taken) == 60 - len(set(group))


def shingle_set(text, size=5):
    parts = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split()
    return {tuple(parts[i : i + size]) for i in range(max(len(parts) - size + 1, 1))} if parts else set()


def classes_of(texts, similarity=0.8):
    """The first place of each text's class, by all pairs."""
    sets, group = [shingle_set(text) for text in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = sets[i] | sets[j]
            if not both or len(sets[i] & sets[j]) >= similarity * len(both):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


def test_similar_texts(spark, nothing):
    rng = random.Random(8)
    texts = ["", None, " ", "one two", "ONE two", "one two three four five six"]
    for _ in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(60, 300))]
        texts.append(" ".join(base))
        for share in (0.005, 0.01, 0.03, 0.05, 0.08):
            texts.append(" ".join(rng.choice(["new", "other"]) if rng.random() < share else w for w in base))
    rows = [(i, text) for i, text in enumerate(texts)]
    docs = spark.createDataFrame([*rows, (None, texts[6]), (None, "alone"), rows[7]], "doc_id long, text string").withColumn("key", F.lit("k"))
    result = simhash.near_duplicates(docs, simhash.WIDE, 5, similarity=0.8).collect()
    assert len(result) == len(texts) + 3
    got = {r.doc_id: r.component_id for r in result if r.doc_id is not None}
    assert [got[i] for i in range(len(texts))] == classes_of(texts)
    assert sorted(str(r.component_id) for r in result if r.doc_id is None) == ["6", "None"]
    assert simhash.near_duplicates(nothing, simhash.WIDE, 5, similarity=0.8).count() == 0


def variants(rng, bases, copies, n):
    """Texts of ``n`` words that differ from their base in none to two words, so about half of the pairs are similar."""
    out = []
    for b in range(bases):
        base = [f"b{b}w{rng.randrange(10_000)}" for _ in range(n)]
        for _ in range(copies):
            changed = list(base)
            for k in rng.sample(range(n), rng.randrange(3)):
                changed[k] = f"x{rng.randrange(10_000)}"
            out.append(" ".join(changed))
    return out


@pytest.mark.parametrize("large", [simhash.LARGE_BUCKET, 20])
def test_failed_links_hide_no_others(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE_BUCKET", large)  # the smaller one cuts the buckets into blocks
    texts = variants(random.Random(12), 12, 14, 60)
    scheme = simhash.Scheme(4, 56, 1, 1, False)  # two buckets
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = simhash.near_duplicates(docs, scheme, 5, similarity=0.8).collect()
    prints = np.array([simhash.fingerprint(text, 5, words=4) for text in texts], "u8")
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            one, two = shingle_set(texts[i]), shingle_set(texts[j])
            close = (prints[i, 0] ^ prints[j, 0]) & np.uint64(1) == 0 and np.bitwise_count(prints[i] ^ prints[j]).sum() <= 56
            if close and len(one & two) >= 0.8 * len(one | two):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    assert [r.component_id for r in sorted(got, key=lambda r: r.doc_id)] == group


def test_repeated_blocks_are_near_duplicates(spark):
    rng = random.Random(13)
    rows = []
    for i in range(6):
        once, block = ([f"w{rng.randrange(90_000)}" for _ in range(n)] for n in (104, 54))
        rows += [(2 * i, " ".join(once + block)), (2 * i + 1, " ".join(once + block * 10))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(docs, simhash.WIDE, 5, similarity=0.8)
    assert set(found(got, "doc_id", "component_id")) == {(i, i - i % 2) for i in range(12)}


def test_pipeline(spark):
    import corpus_pipeline as cp

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame([(None, None), (9_000_001, None), (9_000_002, "")], "doc_id long, text string")
    docs = docs.unionByName(odd, allowMissingColumns=True).select(*docs.columns)
    columns = docs.columns
    for name, step in cp.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        docs = cp.stage(step(spark, docs, folder), name)
        if name == "packing":
            tokens = docs.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
            assert tokens.where("n <> all").count() == 0 and tokens.count() == len(before)
            continue
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        assert set(after) <= set(before)
        if name == "near_duplicates":
            ids = sorted(i for i in before if i is not None)
            kept = {ids[g] for g in classes_of([before[i] for i in ids])}
            assert {i for i in after if i is not None} == kept
    assert docs.count() > 100


def test_pipeline_drops_by_id_and_text(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(14)
    item, clean, other, copy = (" ".join(f"w{rng.randrange(90_000)}" for _ in range(60)) for _ in range(4))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, item), (None, other), (5, item), (5, clean), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = cp.drop_contaminated(spark, docs, str(tmp_path))
    assert found(left, "doc_id", "text") == {(None, other): 1, (5, clean): 1, (6, None): 1}
    docs = spark.createDataFrame([(1, copy), (5, copy), (5, clean), (6, None)], "doc_id long, text string")
    assert found(cp.drop_near_duplicates(spark, docs, str(tmp_path)), "doc_id", "text") == {(1, copy): 1, (5, clean): 1, (6, None): 1}


@pytest.mark.parametrize("length", [50, 137, 138, 200])
def test_suffixes(tables, nothing, length):
    docs, _, rows, _ = tables
    order = lambda d: seeds.NO_ID if d is None else d
    first = {}
    for doc_id, text in sorted(rows, key=lambda r: -order(r[0])):
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            first[data[p : p + length]] = order(doc_id)
    expected = Counter()
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < order(doc_id):
                gone[p : p + length] = [True] * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        expected[doc_id, len(data), spans, kept.hex()] += 1
    result = suffixes.remove_repeats(docs, length).withColumns({"kept": F.lower(F.hex("kept")), "removed": F.size("removed")})
    assert found(result, "doc_id", "n_bytes", "removed", "kept") == expected
    assert suffixes.remove_repeats(nothing).count() == 0


def test_suffix_order():
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.integers(97, 99, 3000), np.zeros(64, int)]).astype("u1")
    at = np.arange(3000)
    ordered = suffixes.Suffixes(data, 50).merge_sort(at, np.array([0, 1000]), np.array([1000, 2000]))
    for part in (ordered[:1000], ordered[1000:]):
        texts = [data[p : p + 50].tobytes() for p in part]
        assert texts == sorted(texts)


def test_passages(tables, nothing, spark):
    docs, _, rows, _ = tables
    result = passages.repeated_passages(docs).collect()
    pairs = {(r.doc_id, r.other_doc_id) for r in result}
    ids = [doc_id for doc_id, _ in rows]
    assert {(max(a, b), min(a, b)) for a, b in ((ids[33], ids[34]), (ids[34], ids[35]), (ids[33], ids[35]))} & pairs
    texts = dict(rows)
    for r in result:
        if r.doc_id is not None and r.similarity == 1 and r.other_doc_id is not None:
            part = texts[r.doc_id].encode()[r.start : r.end].decode()
            assert words(part) == words(texts[r.other_doc_id])[r.other_start_word :][: r.n_words]
    left = passages.remove_passages(docs)
    assert left.columns == docs.columns and left.where("text is null").count() == 2
    assert passages.repeated_passages(nothing).count() == 0 == passages.remove_passages(nothing).count()


def test_chains_are_in_order_and_skip_strays():
    x, y = [0, 10, 20, 30, 40], [100, 110, 5, 130, 140]
    assert passages.chains(x, y) == [[0, 1, 3, 4]]


def test_fuzzy_passage(spark):
    rng = random.Random(9)
    prose = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    passage = prose(120)
    changed = list(passage)
    for k in range(6, 120, 15):
        changed[k] = "other"
    del changed[50:52]
    rows = [(1, prose(40) + passage), (2, prose(30) + changed + prose(30)), (3, prose(200)), (4, passage[:30] + prose(50))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    (only,) = passages.repeated_passages(docs).collect()
    assert (only.doc_id, only.other_doc_id, only.start_word) == (2, 1, 30) and 110 <= only.n_words <= 120
    assert 0.8 <= only.similarity < 1


def test_recall_of_fuzzy_passages(spark):
    """Planted passages of 40 to 100 words with 10 to 20% of the words changed, the first and last not among them."""
    rng = random.Random(12)
    prose = lambda n: [f"v{rng.randrange(20_000)}" for _ in range(n)]
    rows, planted = [], []
    for n in (40, 50, 60, 100):
        for percent in (10, 15, 20):
            for _ in range(20):
                passage = prose(n)
                changed = list(passage)
                for k in rng.sample(range(1, n - 1), n * percent // 100):
                    changed[k] = f"other{rng.randrange(10**6)}"
                first = len(rows)
                rows += [(first, prose(40) + passage + prose(20)), (first + 1, prose(30) + changed + prose(30))]
                planted.append((n, percent, first + 1))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    result = passages.repeated_passages(docs).collect()
    covered = {}
    for r in result:
        assert r.other_doc_id == r.doc_id - 1 and r.n_words >= 40 and r.similarity >= 0.8
        covered[r.doc_id] = len(range(max(r.start_word, 30), r.start_word + r.n_words))
    shares = defaultdict(list)
    for n, percent, doc_id in planted:
        shares[n, percent].append(covered.get(doc_id, 0) >= 0.9 * n)
    assert all(np.mean(cell) >= 0.9 for cell in shares.values()), {k: np.mean(v) for k, v in shares.items()}


def test_every_fifth_word_changed(spark):
    rng = random.Random(13)
    prose = lambda n: [f"v{rng.randrange(20_000)}" for _ in range(n)]
    passage = prose(60)
    changed = [f"x{k}" if k % 5 == 0 else w for k, w in enumerate(passage)]
    docs = spark.createDataFrame([(1, " ".join(passage)), (2, " ".join(prose(9) + changed + prose(9)))], "doc_id long, text string")
    (only,) = passages.repeated_passages(docs).collect()
    assert only.n_words >= 54 and only.similarity >= 0.8


def test_passage_whose_parts_occur_earlier(spark):
    """The first places of the seeds lie in two texts that hold half of it each, the last ones in the whole earlier copy."""
    rng = random.Random(14)
    prose = lambda n: [f"v{rng.randrange(20_000)}" for _ in range(n)]
    one, two = prose(30), prose(30)
    rows = [(1, prose(9) + one + prose(9)), (2, prose(9) + two + prose(9)), (3, prose(20) + one + two), (4, one + two + prose(20))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    assert found(passages.repeated_passages(docs), "doc_id", "other_doc_id", "start_word", "n_words") == Counter([(4, 3, 0, 60)])


@pytest.mark.parametrize("times", [1, 30])
@pytest.mark.parametrize("changed", [(), (9, 23, 37, 52)])
def test_passage_whose_copy_lies_between_others(spark, times, changed):
    """Every seed of the passage comes in texts before and after its one copy, none of them with 40 words of it."""
    passage = [f"p{i}" for i in range(60)]
    copy = [f"c{i}" if i in changed else word for i, word in enumerate(passage)]

    def parts(first):
        pieces = [" ".join(passage[i : i + 30]) for i in range(0, 40, 10)] * times
        return [(first + n, f"l{first + n} {piece} r{first + n}") for n, piece in enumerate(pieces)]

    rows = [*parts(0), (1000, "the copy " + " ".join(copy)), *parts(2000), (5000, " ".join(passage) + " its end")]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    found = found.where("doc_id = 5000").select("other_doc_id", "start_word", "n_words", "n_equal").collect()
    assert [tuple(row) for row in found] == [(1000, 0, 60, 60 - len(changed))]


def test_passages_with_other_words_between(spark):
    rng = random.Random(10)
    prose = lambda n: [f"v{rng.randrange(50_000)}" for _ in range(n)]
    rows, expected = [], set()
    for i, (n, between) in enumerate(((60, 100), (60, 200), (500, 1500))):
        one, two = prose(n), prose(n)
        for k in range(2):
            rows.append((2 * i + k, prose(20) + one + prose(between) + two + prose(20)))
        expected |= {(2 * i + 1, 2 * i, 20, n), (2 * i + 1, 2 * i, 20 + n + between, n)}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    assert set(found(passages.repeated_passages(docs), "doc_id", "other_doc_id", "start_word", "n_words")) == expected


def test_best_runs():
    blocks = [(0, 60, 0, 60, 60, 0), (70, 130, 70, 130, 60, 2), (400, 405, 430, 435, 5, 1), (900, 960, 950, 1010, 60, 3)]
    assert passages.best_runs(np.array(blocks), 0.8) == [(0, 1), (2, 2), (3, 3)]


def test_toxicity(spark, nothing):
    rng = random.Random(4)
    mild, harsh = [f"nice{i}" for i in range(200)], ["vilewort", "grimslur"]
    rows = []
    for i in range(600):
        w = [rng.choice(mild) for _ in range(rng.randint(3, 60))]
        if i % 4 == 0:
            w.insert(rng.randrange(len(w)), rng.choice(harsh))
        rows.append((i, " ".join(w), int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(600, None), (601, ""), (None, "grimslur")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(602, None)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, labels)
    scored = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(scored[i].predicted == rows[i][2] for i in held) > 0.97 * len(held)
    assert scored[600].score == scored[601].score < 0.5 and scored[None].predicted == 1
    assert docs.where(toxicity.held_out()).count() == len(held) + 1 + sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in (600, 601))
    blank = toxicity.train_toxicity(docs, labels.limit(0))
    assert all(0 <= r.score <= 1 for r in toxicity.score_toxicity(docs, blank).collect())
    assert toxicity.score_toxicity(nothing, model).count() == 0


def test_a_waiting_worker_forgets_all_but_its_first_words():
    from moodloom.llm.encoder import Encoder

    worker = Encoder(TOKENIZER)
    before = worker.encode(["first second third", "fourth fifth sixth"])
    first = list(worker.known)[:2]
    worker.trim(2)
    assert list(worker.known) == first
    assert worker.encode(["first second third", "fourth fifth sixth"]) == before


def test_seeds_that_no_text_asks_for_go_before_their_words(spark, monkeypatch):
    rows = {}

    def staged(df, name):
        found = df.localCheckpoint()
        rows[name] = found.count()
        return found

    monkeypatch.setattr(passages, "stage", staged)
    schema = "uid long, place long, seed long"
    mine = spark.createDataFrame([(9, 0, 1), (9, 20, 2), (9, 20, 2), (9, 70, 3), (9, 85, 4)], schema)
    theirs = [(uid, 100 + at, seed) for uid in range(20, 60) for at, seed in ((0, 1), (20, 2))]  # later than the text that asks
    theirs += [(uid, at, 5 + at) for uid in range(1, 6) for at in range(0, 60, 2)]  # seeds in pairs that nobody asks for
    theirs = spark.createDataFrame([*theirs, (7, 5, 1), (7, 25, 2)], schema)
    met = passages.meeting_seeds(mine, theirs, 40)
    assert [tuple(row) for row in met.select("uid", "at", "first_uid", "first_at").collect()] == [(9, 0, 7, 5)]
    assert (rows["later-pairs"], rows["earlier-pairs"], rows["meeting-pairs"]) == (2, 1, 1)


def test_two_seeds_meet_once_a_block_and_only_about_equally_far_apart(spark):
    schema = "uid long, place long, seed long"
    repeated = [(place, 1 + (place >= 40)) for place in range(80)]  # two seeds, each at forty places in a row
    mine = spark.createDataFrame([(9, *row) for row in repeated] + [(8, 0, 3), (8, 40, 4)], schema)
    far = [(uid, at, seed) for uid in range(10) for at, seed in ((3, 3), (11, 4))]  # 8 words apart, where the text has 40
    theirs = spark.createDataFrame([(7, *row) for row in repeated] + [(7, 600, 3), (7, 630, 4), *far], schema)
    met = [tuple(row) for row in passages.meeting_seeds(mine, theirs, 40).collect()]
    assert {(uid, first_uid) for uid, _, first_uid, _ in met} == {(9, 7), (8, 7)}
    assert len(met) < 20  # each two equal seeds of both texts made 640,000 rows


def test_seeds_beside_their_first_and_last_earlier_text(spark):
    rng = random.Random(8)
    line = " ".join(f"c{i}" for i in range(12))
    docs = [(uid, f"{line} " * rng.randint(1, 2) + " ".join(rng.choice("abcdefgh") for _ in range(30))) for uid in range(12)]
    units = spark.createDataFrame([*docs, docs[3]], "uid long, text string")
    shared = seeds.shared_places(units.dropDuplicates(), passages.word_hashes, 4, 3, 2)
    found_rows = {(r.uid, r.first_uid, r.places >> 32, r.places & 0xFFFFFFFF) for r in seeds.earlier_seeds(shared).collect()}
    places = defaultdict(lambda: defaultdict(list))
    for r in shared.collect():
        places[r.seed][r.uid].append(r.place)
    expected = set()
    for of in places.values():
        for uid in of:
            before = [u for u in of if u < uid]
            expected |= {(uid, u, place, min(of[u])) for place in of[uid] for u in (min(before), max(before)) if before} if before else set()
    assert found_rows == expected and expected


def test_a_run_of_one_word_is_found_in_an_earlier_text_between_the_first_and_the_last(spark):
    line = " ".join(f"c{i}" for i in range(13))
    own = lambda uid, n: " ".join(f"u{uid}x{i}" for i in range(n))
    lengths = {1: 8, 2: 50, 3: 8}  # of the run of one word; only the second text has enough of it
    rows = [(uid, f"{line} {'nt ' * n}{own(uid, 40)}") for uid, n in lengths.items()]
    rows.append((4, f"{line} {own(4, 20)} {'nt ' * 50}{own(5, 60)}"))
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.other_doc_id) for r in found} == {(4, 2)}


def lined_texts(rng, n, line, others):
    """Texts that share a line, with own words around it, and ``others`` that repeat some of the words of a text before them."""
    rows = [f"{' '.join(f'u{i}x{rng.randrange(900)}' for _ in range(30))} {line} {' '.join(f'v{i}x{k}' for k in range(60))}" for i in range(n)]
    for _ in range(others):
        own = rows[rng.randrange(1, n - 1)].split()
        rows.append(" ".join(w if rng.random() < 0.88 else f"y{rng.randrange(9_000)}" for w in own))
    return list(enumerate(rows))


def test_pairs_of_texts_with_a_common_line_are_not_written(spark, monkeypatch):
    rows = {}

    def staged(df, name):
        found = df.localCheckpoint()
        rows[name] = max(rows.get(name, 0), found.count())
        return found

    monkeypatch.setattr(passages, "stage", staged)
    line = " ".join(f"c{i}" for i in range(24))
    docs = spark.createDataFrame(lined_texts(random.Random(16), 50, line, 0), "doc_id long, text string")
    assert passages.repeated_passages(docs).count() == 0
    assert rows["met"] <= 2 * 50 and rows["block-words"] <= 2 * 50  # 1,222 pairs of blocks before


@pytest.mark.parametrize("group", [1, passages.GROUP_BLOCKS])
def test_blocks_meet_in_groups(spark, monkeypatch, group):
    monkeypatch.setattr(passages, "GROUP_BLOCKS", group)
    monkeypatch.setattr(passages, "MET_AT_ONCE", 7)
    monkeypatch.setattr(passages, "BLOCKS_AT_ONCE", 3)
    rng = random.Random(17)
    rows = lined_texts(rng, 12, " ".join(f"c{i}" for i in range(24)), 10)
    rows += [(100 + i, " ".join(f"w{rng.randrange(300)}" for _ in range(700)) + " " + rows[i][1]) for i in range(12, 16)]
    units = spark.createDataFrame(rows, "uid long, text string")
    shared = seeds.shared_places(units, passages.word_hashes, 4, 3, 2).cache()
    mine, theirs = shared.where("kind > 1").select("uid", "place", "seed"), shared.select("uid", "place", "seed")
    expected, texts = set(), {uid: text.split() for uid, text in rows}
    reach = sum(passages.pair_span(40)) + 4 + passages.MARGIN
    block = lambda uid, at: texts[uid][max(at // 512 * 512 - 64, 0) : (at // 512 + 1) * 512 + reach]
    met = passages.meeting_seeds(mine, theirs, 40).collect()
    for uid, at, first_uid, first_at in met:
        gains = np.where(np.isin(block(uid, at), block(first_uid, first_at)), 0.2, -0.8)
        total = np.concatenate([[0], gains.cumsum()])
        if any((total[i + 40 :] > total[i] - 1e-6).any() for i in range(len(total))):
            expected.add((uid, first_uid))
    pairs = passages.alike_pairs(units.withColumn("owner", F.col("uid")), *passages.asked_seeds(mine, theirs, 40), 40, 0.8).collect()
    assert {(r.uid, r.first_uid) for r in pairs} == expected and len(pairs) == len(expected)
    assert 0 < len(expected) < len({(uid, first_uid) for uid, _, first_uid, _ in met})


def test_passages_are_the_same_without_broadcasts(spark, monkeypatch):
    rng = random.Random(18)
    rows = [*lined_texts(rng, 8, " ".join(f"c{i}" for i in range(24)), 8), (40, None), (41, "")]
    docs = spark.createDataFrame([*rows, rows[9], (None, rows[10][1]), (2, rows[11][1])], "doc_id int, text string")
    expected = found(passages.repeated_passages(docs), "doc_id", "start", "end", "other_doc_id", "n_equal"), found(passages.remove_passages(docs), "doc_id", "text")
    monkeypatch.setattr(passages, "if_small", lambda table, *sizes: table)
    assert found(passages.repeated_passages(docs), "doc_id", "start", "end", "other_doc_id", "n_equal") == expected[0] != Counter()
    assert found(passages.remove_passages(docs), "doc_id", "text") == expected[1]


def short_variants(rng, n):
    """Texts of few words, of which many pairs are similar but have fingerprints far apart."""
    texts = []
    for i in range(n):
        own = [f"s{i}w{k}" for k in range(8)]
        texts += [" ".join(own), " ".join([*own, f"s{i}x"]), " ".join([*own[1:], f"s{i}y", f"s{i}z"])]
    line = " ".join(f"c{k}" for k in range(30))
    return texts + [f"{line} " + " ".join(f"t{i}w{rng.randrange(9_000)}" for _ in range(rng.randrange(1, 12))) for i in range(40)]


def test_no_similar_pair_is_missed(spark, monkeypatch, tmp_path):
    import corpus_pipeline as cp

    monkeypatch.setattr(simhash, "LOOKED_AT", 1)
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(simhash, "PREFIXES_A_PART", 100)
    texts = short_variants(random.Random(19), 60)
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[3]), (5, texts[5])], "doc_id long, text string")
    classes = classes_of(texts)
    far = {i for i in range(len(texts)) if classes[i] != i}
    near = {r.doc_id for r in simhash.near_duplicates(docs, simhash.WIDE, 5, similarity=0.8).collect() if r.doc_id not in (None, r.component_id)}
    assert near < far  # fingerprints alone miss some
    left = cp.drop_near_duplicates(spark, docs, str(tmp_path))
    assert found(left, "doc_id") == Counter([(i,) for i in range(len(texts)) if i not in far] + [(None,)] + [(5,)] * (5 not in far))
    assert simhash.near_duplicates(docs.limit(0), simhash.WIDE, 5, similarity=0.8, whole=True).count() == 0
