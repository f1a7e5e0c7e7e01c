"""The ten text operators on small fixtures: brute force, exact round trips, and odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.llm import bpe, common, forest, lm, minhash, multiset, packing, quality, substring, urlrank, warc
from quadrille.llm.queries import URL_RULES, vocabulary_path

DOCS = "doc_id long, text string, lang string, node string, runs string, key string"


def frame(spark, rows):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, "en", "x", "y", "z") for i, t in rows], DOCS)


def corpus(seed=3, n=60):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    words = lambda k: [rnd.choice(vocabulary) for _ in range(k)]
    passage = words(60)
    rows = []
    for i in range(n):
        w = words(rnd.choice([0, 3, 20, 80, 200]))
        if i % 4 == 0:
            at = rnd.randint(0, len(w))
            w = w[:at] + passage + w[at:]
        rows.append((i, rnd.choice([" ", "\n", "\t "]).join(w)))
    rows += [(n + k, rows[k][1]) for k in range(8)]  # exact copies
    for k in range(8, 16):  # near copies
        w = rows[k][1].split()
        if len(w) > 40:
            w[len(w) // 2] = "changed"
        rows.append((n + k, " ".join(w)))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "a"), (904, "a"), (None, "null id " * 20), (None, "null id " * 20), (905, "same " * 300), (906, "same " * 200), (907, "x" * 30000)]
    rows += [(908, "one id " + " ".join(passage)), (908, "one id with another text")]
    rows += [(909, " ".join(passage[:35])), (909, " ".join(passage[:35]))]
    return rows


def split(text):
    return (text or "").encode().split()


# ---------------------------------------------------------------- shared helpers


def test_words_and_hashes_agree_with_split():
    import pyarrow as pa

    rows = [t for _, t in corpus()] + ["  lead", "trail \r", "a\x0bb\x0cc", "naïve\u00a0word", "y" * 100 + " " + "y" * 100]
    texts = common.Texts(pa.array(rows))
    seen = {}
    for i, j in texts.chunks(500):
        words = common.Words(texts, i, j)
        hashes = words.hashes()
        flat = [w for t in rows[i:j] for w in split(t)]
        assert words.n == len(flat) and list(words.counts) == [len(split(t)) for t in rows[i:j]]
        for w, h in zip(flat, hashes.tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_ngram_hashes_name_windows():
    rnd = np.random.default_rng(1)
    words = rnd.integers(0, 5, 300).astype(np.uint64)
    for n in (1, 2, 5, 12, 35):
        got = common.ngram_hashes(words, n)
        keys = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        pairs = set(zip(keys, got.tolist()))
        assert len(got) == len(keys) and len(pairs) == len(set(keys)) == len(set(got.tolist()))


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (10, 11), (11, 12), (5, 4), (20, 20), (30, 31)], "a long, b long")
    got = {r.node: r.root for r in common.components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 10: 10, 11: 10, 12: 10, 30: 30, 31: 30}
    assert common.components(edges.where("a > 99")).count() == 0


def test_components_never_stop_halfway(spark):
    path = spark.range(40).selectExpr("id * 7 % 41 as a", "(id + 1) * 7 % 41 as b")
    with pytest.raises(RuntimeError):
        common.components(path, most=1)
    assert {r.root for r in common.components(path).collect()} == {0}


# ---------------------------------------------------------------- 1


def brute_repeats(rows, least):
    texts = [split(t) for _, t in rows]
    seen = Counter(tuple(w[k : k + least]) for w in texts for k in range(len(w) - least + 1))
    out = []
    for (i, _), w in zip(rows, texts):
        covered = [False] * len(w)
        for k in range(len(w) - least + 1):
            if seen[tuple(w[k : k + least])] > 1:
                covered[k : k + least] = [True] * least
        kept = b" ".join(x for x, gone in zip(w, covered) if not gone)
        out.append((i, len(w), sum(covered), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("least,seed", [(35, 12), (8, 3), (5, 5)])
def test_substring_dedup_equals_brute_force(spark, least, seed):
    rows = corpus()
    got = substring.remove_repeats(frame(spark, rows), least, seed).collect()
    assert sorted(map(str, ((r.doc_id, r["__n_words"], r["__n_removed"], r["__sha256"]) for r in got))) == sorted(map(str, brute_repeats(rows, least)))


def test_clashing_names(spark):
    rows = [(1, "a b c d e f g", 1), (2, "a b c d e f g", 2), (3, "x y z", 3), (3, "x y z", 3)]
    docs = spark.createDataFrame([(*r, *"pqrst") for r in rows], "doc_id long, text string, __id long, __rk string, __text string, __runs string, __kept string, keep string")
    cut = substring.cut_repeats(docs, 5, 3)
    assert cut.columns == docs.columns and sorted((r.doc_id, r.text, r["__id"], r["__kept"]) for r in cut.collect()) == [(1, "", 1, "s"), (2, "", 2, "s"), (3, "x y z", 3, "s"), (3, "x y z", 3, "s")]
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id, r["__id"], r.keep) for r in kept.collect()) == [(1, 1, "t"), (3, 3, "t")]


def test_substring_cut_keeps_rows_and_columns(spark):
    docs = frame(spark, corpus())
    cut = substring.cut_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert substring.cut_repeats(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- 2


def test_warc_round_trip(spark, tmp_path):
    big, other = "<p>" + "é" * 600, "<p>" + "z" * 1200
    pages = [(1, "http://a/", big), (7, "http://b/", big), (3, None, big), (4, "http://c/", "small"), (5, "http://d/", "small"), (6, "http://e/", None), (8, "http://f/\r\n", other), (9, "http://g/", ""), (None, "http://h/", other), (10, "http://i/", "q" * 5000), (10, "http://i/", "q" * 5000)]
    pages += [(100 + k, f"http://x/{k}", f"<html><body>page {k} " + "word " * 40 + "</body></html>") for k in range(60)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    for n in (100_000, 0):  # joined by broadcast, and by shuffle
        folder = str(tmp_path / f"w{n}")
        done = warc.write_archives(frame, folder, broadcast_groups=n).collect()
        assert sum(r.records for r in done) == len(pages)
        got = warc.read_archives(spark, folder).collect()
        payload = Counter((p, hashlib.sha1((h or "").encode()).hexdigest(), len((h or "").encode())) for p, _, h in pages)
        assert Counter((r.page_id, r.payload_digest, r.payload_bytes) for r in got) == payload
        kinds = {r.page_id: (r.record_type, r.refers_to) for r in got if r.page_id != 10}
        assert kinds[7] == ("response", None) and kinds[1] == kinds[3] == ("revisit", 7)
        assert kinds[4] == kinds[5] == kinds[6] == ("response", None)
        assert kinds[8] == ("response", None) and kinds[None] == ("revisit", 8)
        assert sorted((r.record_type, r.refers_to or 0) for r in got if r.page_id == 10) == [("response", 0), ("revisit", 10)]
        texts = {r.page_id: bytes(r.payload).decode() for r in got if r.record_type == "response"}
        assert texts[7] == big and texts[100].startswith("<html>")
    data = open(done[0].archive, "rb").read()
    assert data[:4] == b"\x5d\x2a\x4d\x18"
    assert len(list(warc.read_archive(data))) == done[0].records


def test_warc_of_many_and_long_records(spark, tmp_path):
    import time

    # Reading is linear in the archive: ten times the records in about ten times the time.
    archives = [warc.dictionary_frame(b"") + b"".join(__import__("zstandard").ZstdCompressor().compress(warc.build_record(k, "http://a/", bytes(str(k), "ascii") * 400, None, False)) for k in range(n)) for n in (400, 4000)]
    took = []
    for data, n in zip(archives, (400, 4000)):
        start = time.perf_counter()
        assert sum(1 for _ in warc.read_archive(data)) == n
        took.append(time.perf_counter() - start)
    assert took[1] < 1.0 and took[1] < 40 * max(took[0], 0.005)
    with pytest.raises(ValueError):
        list(warc.read_archive(archives[0][:-5]))
    long = "é" * 3_000_000 + "end"
    pages = spark.createDataFrame([(1, "u", long, "x", 5), (2, "u", "short", "y", 6)], "page_id long, url string, html string, payload string, refers_to int")
    warc.write_archives(pages, str(tmp_path / "w"), bytes_per_archive=1000).collect()
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert got == {1: long, 2: "short"}
    assert [warc._arrow_name(x) for x in ("s3a://b/x", "gs://b/x", "file:///tmp/x", "file:/tmp/x", "/tmp/x")] == ["s3://b/x", "gs://b/x", "/tmp/x", "/tmp/x", "/tmp/x"]


def test_warc_without_pages(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(empty, str(tmp_path / "w")).collect()
    assert warc.read_archives(spark, str(tmp_path / "w")).count() == 0


# ---------------------------------------------------------------- 3


def shingle_counts(text):
    w = split(text)
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def jaccard(x, y):
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in set(x) | set(y)) for i in x if i in y)


def test_probability_jaccard_and_its_estimate():
    rnd = random.Random(5)
    x = {k: rnd.randint(1, 4) for k in range(60)}
    y = {k: rnd.randint(1, 4) for k in range(15, 75)}
    true = jaccard(Counter(x), Counter(y))
    assert math.isclose(minhash.probability_jaccard(x, y), true)
    slots = 8192
    sides = [minhash.prob_minhash(np.zeros(len(s), np.int64), common.mix(np.array(list(s), np.uint64)), np.array(list(s.values())), 1, slots)[0] for s in (x, y)]
    assert abs((sides[0] == sides[1]).mean() - true) < 0.025


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus(seed=8, n=90)
    sets = [shingle_counts(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.8:
                root[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    want = Counter()
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        for i in ids:
            want[(i, min(known) if known else None, len(ids))] += 1
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == want
    kept = minhash.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns and kept.count() == len(groups)


def test_near_duplicates_of_a_large_group(spark):
    rnd = random.Random(2)
    base = [f"w{rnd.randint(0, 9999)}" for _ in range(120)]
    rows = [(0, " ".join(base))]
    for k in range(1, 150):
        w = list(base)
        w[rnd.randrange(len(w))] = f"edit{k}"
        rows.append((k, " ".join(w)))
    rows += [(1000 + k, " ".join(f"u{k}-{i}" for i in range(50))) for k in range(20)]
    got = minhash.near_duplicates(frame(spark, rows)).groupBy("class_id").count().collect()
    assert {r.class_id: r["count"] for r in got} == {0: 150} | {1000 + k: 1 for k in range(20)}
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


def family(n, own=2, single=12, shared=100):
    """n couples on one template: alike within a couple (0.803), less so across couples (0.774)."""
    base = " ".join(f"t{k}" for k in range(shared))
    couple = lambda c: " ".join(f"c{c}-{k}" for k in range(own))
    alone = lambda i: " ".join(f"s{i}-{k}" for k in range(single))
    return [(i, f"{base} {couple(i // 2)} {alone(i)}") for i in range(2 * n)]


def test_near_duplicates_in_a_family_of_many_open_nodes(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 50)  # several blocks in a bucket
    rows = family(160)
    sets = [shingle_counts(t) for _, t in rows[:4]]
    assert jaccard(sets[0], sets[1]) >= 0.8 > jaccard(sets[0], sets[2])
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    right = sum(r.class_id == r.doc_id // 2 * 2 and r.class_size == 2 for r in got)
    assert len(got) == len(rows) and right == len(rows)


def test_near_duplicates_in_a_bucket_of_over_a_thousand_nodes(spark):
    """Against all pairs: families of several classes each, all on one template."""
    rows = family(520, own=2, single=6, shared=52)
    sets = [set(zip(*(t.split()[k:] for k in range(5)))) for _, t in rows]
    # Shingles occur once, so the similarity is plain Jaccard; alike within a couple, less across.
    assert len(sets[0] & sets[1]) / len(sets[0] | sets[1]) >= 0.8 > len(sets[0] & sets[2]) / len(sets[0] | sets[2])
    assert all(len(sets[i] & sets[j]) == 48 for i in range(0, 1040, 37) for j in range(1, 1040, 41) if i // 2 != j // 2)
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == 1040 and all(r.class_id == r.doc_id // 2 * 2 and r.class_size == 2 for r in got)


def test_groups_of_sorted_batches():
    import pyarrow as pa

    keys = sorted(random.Random(1).choices(range(12), k=100))
    table = pa.table({"a": keys, "b": list(range(100))})
    for size in (1, 3, 7, 100):
        got = [(g["a"][0].as_py(), g["b"].to_pylist()) for g in common.groups(iter(table.to_batches(max_chunksize=size)), ["a"])]
        assert got == [(k, [i for i, x in enumerate(keys) if x == k]) for k in sorted(set(keys))]
    assert list(common.groups(iter([]), ["a"])) == []


def test_short_signatures_follow_the_least_similarity():
    assert minhash.far(0.8) == 80
    for least in (0.6, 0.7, 0.8, 0.9):
        p = (1 - least) * 15 / 16
        missed = sum(math.comb(256, k) * p**k * (1 - p) ** (256 - k) for k in range(minhash.far(least) + 1, 257))
        assert missed < 1e-5


# ---------------------------------------------------------------- 4 and 10


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def odd_texts():
    rnd = random.Random(4)
    letters = "abc  ABCxyz'sSΣσ \n\t\x1c\x1f\x85 éÉñ1²½Ⅷ漢字ß İı!#$<|>_-'re ́\U0001f600"
    rows = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(800)]
    return rows + ["", "<|endoftext|>a<|startoftext|> b", "x<|endoftext|", "a" * 3000, "ΑΣ ΣΑΣ", "I'll don't we're 'S", "ab" * 900]


def test_bpe_equals_the_library(library):
    own = bpe.WordBpe(vocabulary_path())
    for text in odd_texts() + [t for _, t in corpus() if t]:
        want = library.encode(text, add_special_tokens=False).ids
        got = np.frombuffer(own.encode(text), "<u4")
        assert got.tolist() == want
        assert own.decode_many(got, np.array([len(got)]))[0].decode() == library.decode(want, skip_special_tokens=False)


def test_bpe_refuses_other_files(tmp_path):
    import json

    spec = json.load(open(vocabulary_path()))
    for part, value in (("normalizer", {"type": "NFKC"}), ("decoder", {"type": "ByteLevel"}), ("pre_tokenizer", {"type": "Whitespace"}), ("model", spec["model"] | {"byte_fallback": True})):
        (tmp_path / "other.json").write_text(json.dumps(spec | {part: value}))
        with pytest.raises(ValueError, match=part):
            bpe.WordBpe(str(tmp_path / "other.json"))


def test_bpe_table_of_words_is_bounded(library):
    own = bpe.WordBpe(vocabulary_path())
    own.words.keep = 10
    text = " ".join(t for _, t in corpus() if t)
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.words) <= 10 and len(own.words.old) <= 10


def test_bpe_documents(spark, library):
    rows = corpus()
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_digests(frame(spark, rows), vocabulary_path()).collect()}
    whole = bpe.encode_documents(frame(spark, rows), vocabulary_path()).collect()
    assert {(r.doc_id, len(r.ids), hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r.decoded.encode()).hexdigest()) for r in whole} == digests
    assert bpe.encode_digests(frame(spark, []), vocabulary_path()).count() == 0


@pytest.mark.parametrize("capacity", [16, 64, 2048])
def test_packing(spark, library, capacity):
    rows = corpus()
    got = packing.pack(frame(spark, rows), vocabulary_path(), capacity).toPandas()
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want[(i, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    ids = [None if np.isnan(i) else int(i) for i in got.doc_id]
    assert Counter(zip(ids, got.piece, got.start, got.length, got.ids_crc32)) == want
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() <= capacity
    sizes = sorted(got.length, reverse=True)
    bins = []
    for n in sizes:  # best-fit decreasing, one by one
        fit = [k for k, gap in enumerate(bins) if gap >= n]
        if fit:
            k = min(fit, key=lambda k: bins[k])
            bins[k] -= n
        else:
            bins.append(capacity - n)
    assert got.sequence_id.nunique() == len(bins)
    assert packing.pack(frame(spark, []), vocabulary_path(), capacity).count() == 0


# ---------------------------------------------------------------- 5


def test_forest_recall_ties_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((3000, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    rows += [(5000 + k, vectors[0].tolist()) for k in range(40)]  # copies of a query's vector
    rows += [(9000, None), (9100, [0.0] * 16), (9200, [None] * 16), (9300, [float("nan")] * 16), (9400, [float("inf")] * 16), (9500, [1.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("block", F.lit(2))
    for block_rows in (512, 1 << 20):
        got = forest.search(df, F.col("vec_id") % 100 == 0, block_rows=block_rows, chunk_rows=16).toPandas()
        valid = {i: np.array(v) for i, v in rows if i is not None and i < 9000}
        ids = np.array(sorted(valid))
        matrix = np.stack([valid[i] for i in ids])
        hits = total = 0
        for q in ids[ids % 100 == 0]:
            d = np.sqrt(((matrix - valid[q]) ** 2).sum(axis=1))
            order = [ids[k] for k in np.lexsort((ids, d)) if ids[k] != q][:10]
            mine = got[got.query_id == q].sort_values("rank")
            assert mine["rank"].tolist() == list(range(1, 11))
            hits += len(set(order) & set(mine.vec_id))
            total += 10
            if q == 0:
                assert mine.vec_id.tolist() == [5000 + k for k in range(10)] and mine.score.abs().max() == 0
        assert hits / total >= 0.9
    assert set(got.query_id) == set(ids[ids % 100 == 0])
    assert forest.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    few = forest.search(df.where("vec_id < 4"), F.col("vec_id") % 100 == 0)
    assert few.count() == 3


def embeddings_of(folder):
    import pyarrow.dataset as ds

    table = ds.dataset(f"/root/testdata/{folder}/embeddings.parquet").to_table()
    return table["vec_id"].to_numpy(), np.array(table["embedding"].to_pylist(), float)


def forest_recall(ids, vectors, step, k=10):
    """Recall against brute force and the share of rows that are compared, of a forest over all rows."""
    made = forest.Forest(vectors, forest.TREES, forest.BITS)
    asked = np.flatnonzero(ids % step == 0)
    hits, compared = [], []
    for q, found in zip(asked, made.candidates(vectors[asked], max(forest.FEWEST, int(forest.SHARE * len(ids))), forest.REACH)):
        d = ((vectors - vectors[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits.append(len(set(np.argsort(d)[:k].tolist()) & set(found.tolist())) / k)
        compared.append(len(found) / len(ids))
    return float(np.mean(hits)), float(np.mean(compared))


@pytest.mark.parametrize("folder,step", [("sf0.01", 10), ("sf0.1", 25), ("check_s", 100)])
def test_forest_recall_on_the_tables(folder, step):
    import os

    if not os.path.exists(f"/root/testdata/{folder}/embeddings.parquet"):
        pytest.skip("no tables")
    ids, vectors = embeddings_of(folder)
    recall, compared = forest_recall(ids, vectors, step)
    print(folder, len(ids), recall, compared)
    assert recall >= 0.9 and compared <= max(0.2, 1.2 * forest.FEWEST / len(ids))


def test_forest_touches_few_rows_of_clustered_vectors():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((200, 64))
    vectors = np.repeat(centres, 50, axis=0) + 0.1 * rng.standard_normal((10_000, 64))
    recall, compared = forest_recall(np.arange(10_000), vectors, 200)
    assert recall >= 0.97 and compared <= 0.2


def test_forest_query_reaches_its_recall(spark):
    import os

    if not os.path.exists("/root/testdata/sf0.1/embeddings.parquet"):
        pytest.skip("no tables")
    ids, vectors = embeddings_of("sf0.1")
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    for block_rows in (1 << 15, 700):  # one block, and several
        got = forest.search(df, F.col("vec_id") % 100 == 0, block_rows=block_rows, chunk_rows=8).toPandas()
        hits = 0
        for q in np.flatnonzero(ids % 100 == 0):
            d = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
            d[q] = np.inf
            mine = got[got.query_id == ids[q]].sort_values("rank")
            hits += len(set(ids[np.argsort(d)[:10]]) & set(mine.vec_id))
            assert np.array_equal(mine.score, [np.sqrt(((vectors[ids == i][0] - vectors[q]) ** 2).sum()) for i in mine.vec_id])
        assert len(got) == 10 * (ids % 100 == 0).sum() and hits / len(got) >= 0.9


def test_forest_repeated_rows(spark):
    rows = [(k, [float(k % 7), 1.0]) for k in range(60)] * 3 + [(100, [0.0, 1.0])] * 5 + [(100, [3.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = forest.search(df, F.col("vec_id") % 100 == 0).toPandas()
    assert got.groupby("query_id").vec_id.nunique().to_dict() == {0: 10, 100: 10}
    assert got[got.query_id == 0].sort_values("rank").vec_id.tolist() == [7, 14, 21, 28, 35, 42, 49, 56, 100, 1]


# ---------------------------------------------------------------- 6


def test_url_rules(spark):
    pages = [(1, "HTTP://WWW.Example.ORG/es/x?q#f", None), (2, "http://example.org/en/12", None), (3, "http://example.org/en/2", ""), (4, "http://a.com/fr/1", None), (5, "http://a.com/de/1", None), (6, "nothing", None), (7, None, None), (8, "http://b.net", None), (9, "http://notexample.org/es/1", None), (10, "x://h?y=/z", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("trust", F.lit("t"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlrank.judge(df, URL_RULES).collect()}
    assert got[1] == ("www.example.org", "/es/x", "example.org/es/", "block")
    assert got[2][2:] == ("example.org/en/1", "block") and got[3][2:] == ("org/", "allow")
    assert got[4][2:] == ("com/fr/", "allow") and got[5][2:] == ("com/de/", "block")
    assert got[6] == got[7] == ("", "", None, "allow")
    assert got[8] == ("b.net", "", None, "allow") and got[9][2:] == ("org/", "allow") and got[10][:2] == ("h", "")
    assert urlrank.judge(df.limit(0), URL_RULES).count() == 0


def test_equally_long_rules(spark):
    df = spark.createDataFrame([(1, "http://a.org/x", None), (1, "http://a.org/x", None)], "page_id long, url string, html string")
    for rules in ([("allow", "a.org", "/x"), ("block", "a.org", "/x")], [("block", "a.org", "/x"), ("allow", "a.org", "/x")]):
        assert [r.verdict for r in urlrank.judge(df, rules).collect()] == ["block", "block"]


def test_trust_and_distrust_spread(spark):
    edges = [("good", "friend", 1), ("friend", "far", 1), ("shady", "bad", 3), ("shadier", "shady", 1), ("mixed", "bad", 1), ("good", "mixed", 5)]
    seeds = spark.createDataFrame([("good", 1.0, 0.0), ("bad", 0.0, 1.0), ("alone", 0.5, 0.0)], "host string, s double, b double")
    graph = spark.createDataFrame(edges, "src string, dst string, links long")
    got = {r.host: r for r in urlrank.propagate(seeds, graph, rounds=12).collect()}
    back, out = Counter(), Counter()
    for a, b, n in edges:
        out[a] += n
        back[b] += n
    hosts = {x for e in edges for x in e[:2]} | {"alone"}
    t0, d0 = {h: {"good": 1.0, "alone": 0.5}.get(h, 0.0) for h in hosts}, {h: float(h == "bad") for h in hosts}
    t, d = dict(t0), dict(d0)
    for _ in range(12):
        st, sd = sum(t[h] for h in hosts if not out[h]), sum(d[h] for h in hosts if not back[h])
        t, d = (
            {h: 0.15 * t0[h] + 0.85 * (sum(t[a] * n / out[a] for a, b, n in edges if b == h) + st * t0[h] / 1.5) for h in hosts},
            {h: 0.15 * d0[h] + 0.85 * (sum(d[b] * n / back[b] for a, b, n in edges if a == h) + sd * d0[h]) for h in hosts},
        )
    assert all(math.isclose(got[h].trust, t[h], abs_tol=1e-12) and math.isclose(got[h].distrust, d[h], abs_tol=1e-12) for h in hosts)
    settled = urlrank.propagate(seeds, graph).collect()
    assert math.isclose(sum(r.trust for r in settled), 1.5) and math.isclose(sum(r.distrust for r in settled), 1.0)
    more = {r.host: r for r in urlrank.propagate(seeds, graph, tolerance=1e-9).collect()}
    assert all(abs(r.trust - more[r.host].trust) < 1e-3 for r in settled)
    pages = [(1, "http://x.org/1", '<a href="http://friend.net/a">'), (2, "http://friend.net/", "<a href='//far.net/'>"), (3, "http://shady.net/", "<a HREF=http://bad.com/de/1>"), (4, "http://bad.com/de/2", ""), (5, "http://far.net/", None), (6, "http://alone.net/", '<a href="/own">')]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    verdict = {r.host: r.verdict for r in urlrank.judge(df, URL_RULES).collect()}
    assert verdict == {"x.org": "allow", "friend.net": "allow", "shady.net": "block", "bad.com": "block", "far.net": "allow", "alone.net": "allow"}


# ---------------------------------------------------------------- 7


def test_multiset_hash(spark):
    rows = [(1, "one.\ntwo. three\nfour"), (2, "four\none.\nthree\ntwo."), (3, "one.\ntwo. three"), (4, ""), (5, None), (6, "one.\none.\ntwo."), (7, "four")]
    prints = {r.doc_id: r.fingerprint for r in multiset.fingerprint(frame(spark, rows)).collect()}
    assert all(len(v) == 1 + multiset.LONGS + multiset.WIDE for v in prints.values()) and prints[7][-1] > 0
    assert prints[1] == prints[2] and prints[4] == prints[5] and set(prints[4]) == {0}
    assert len({tuple(v) for v in prints.values()}) == 5
    pair = spark.createDataFrame([(prints[3], prints[7], prints[1])], "a array<long>, b array<long>, c array<long>")
    r = pair.select(multiset.combine(F.col("a"), F.col("b")).alias("sum"), multiset.combine(F.col("c"), F.col("b"), -1).alias("less")).first()
    assert r["sum"] == prints[1] and r["less"] == prints[3]
    # The lanes are sums of one paragraph's lanes; wide ones modulo 2**32.
    many, one = (multiset.fingerprint(frame(spark, [(1, "\n".join("p" for _ in range(n)))])).first().fingerprint for n in (70000, 1))
    assert many[0] == 70000 and max(one[-multiset.WIDE :]) > 1 << 24
    assert many[-multiset.WIDE :] == [x * 70000 % (1 << 32) for x in one[-multiset.WIDE :]]
    assert many[1 : 1 + multiset.LONGS] == [x * 70000 for x in one[1 : 1 + multiset.LONGS]]


def test_multiset_fingerprints_of_edits_equal_those_of_the_edited_texts(spark):
    rows = [(i, t) for i, t in corpus(seed=21) if i is not None and i < 905]
    got = {r.doc_id: r for r in multiset.fingerprint_edits(frame(spark, rows)).collect()}
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda x: x[0])
    edited = [(i, t[: len(t) - len(t) // 4] + ordered[(k + 1) % len(ordered)][1][: len(t) // 4]) for k, (i, t) in enumerate(ordered)]
    as_text = lambda f: ".".join(format(x & (1 << 64) - 1, "x") for x in f)
    own, other = ({r.doc_id: r.fingerprint for r in multiset.fingerprint(frame(spark, x)).collect()} for x in (rows, edited))

    def likeness(f, g):  # from the definition
        if f == g:
            return 1.0
        x, y = (np.array([v for w in p[1 : 1 + multiset.LONGS] for v in (2 * (w & 0xFFFFFFFF) - p[0], 2 * ((w >> 32) & 0xFFFFFFFF) - p[0])], float) for p in (f, g))
        return float(np.clip(x @ y / np.sqrt((x @ x) * (y @ y)), 0, 1)) if (x @ x) * (y @ y) else 0.0

    for k, (i, _) in enumerate(ordered):
        assert got[i].fingerprint == as_text(own[i]) and got[i].edited_fingerprint == as_text(other[i])
        follows = ordered[(k + 1) % len(ordered)][0]
        assert math.isclose(got[i].near_edited, likeness(own[i], other[i]), abs_tol=1e-9) and math.isclose(got[i].near_next, likeness(own[i], own[follows]), abs_tol=1e-9)


def test_multiset_of_ids_that_fill_many_ranges(spark):
    rnd = random.Random(8)
    rows = [(7, f"text {k % 150} " + "x " * rnd.randint(0, 20)) for k in range(300)] + [(None, f"none {k}") for k in range(200)] + [(k, f"id {k}") for k in range(40)]
    got = multiset.fingerprint_edits(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((i, len(t)) for i, t in rows)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    edit = lambda t, u: digest(t[: len(t) - len(t) // 4] + u[: len(t) // 4])
    of = {i: [t for j, t in rows if j == i] for i in {i for i, _ in rows}}
    seen = {}
    for r in got:
        seen.setdefault(r.doc_id, []).append(r.edited_sha256)
    for i in range(8, 39):
        assert seen[i] == [edit(f"id {i}", f"id {i + 1}")]
    assert seen[39][0] in {edit("id 39", t) for t in of[None]} and seen[6][0] in {edit("id 6", t) for t in of[7]}
    for i, after in ((7, "id 8"), (None, "id 0")):  # every row is followed by another of its id, but one, by the next id
        ends = [x for x in seen[i] if x not in {edit(t, u) for t in of[i] for u in of[i]}]
        assert len(ends) <= 1 and all(x in {edit(t, after) for t in of[i]} for x in ends)


def test_multiset_in_many_ranges(spark, monkeypatch):
    rows = corpus(seed=22)
    whole = {(r.doc_id, r.edited_sha256, r.near_next) for r in multiset.fingerprint_edits(frame(spark, rows)).collect()}
    monkeypatch.setattr(multiset, "RANGE_BYTES", 1000)
    assert {(r.doc_id, r.edited_sha256, r.near_next) for r in multiset.fingerprint_edits(frame(spark, rows)).collect()} == whole


def test_multiset_edits(spark):
    rows = [(i, t) for i, t in corpus()]
    got = multiset.fingerprint_edits(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    unique = {i for i, n in Counter(i for i, _ in rows).items() if n == 1 and i is not None}
    ordered = sorted(((i, t or "") for i, t in rows if i is not None), key=lambda x: x[0])
    for k, (i, t) in enumerate(ordered[:-1]):
        if i in unique and ordered[k + 1][0] in unique:
            n = len(t) // 4
            edited = t[: len(t) - n] + ordered[k + 1][1][:n]
            r = next(r for r in got if r.doc_id == i)
            assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    alone = multiset.fingerprint_edits(frame(spark, [(5, "abcd efgh")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcd efab").hexdigest() and alone.near_next == 1.0
    assert multiset.fingerprint_edits(frame(spark, [])).count() == 0


def test_multiset_is_native(spark):
    plan = multiset.fingerprint_edits(frame(spark, corpus()))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_likeness_grows_with_what_is_shared(spark):
    lines = [f"line number {k}" for k in range(80)]
    rows = [(k, "\n".join(lines[k:] + [f"other {i}" for i in range(k)])) for k in (0, 20, 40, 80)]
    prints = multiset.fingerprint(frame(spark, rows))
    first = prints.where("doc_id = 0").select(F.col("fingerprint").alias("g"))
    got = {r.doc_id: r.near for r in prints.crossJoin(first).select("doc_id", multiset.likeness_of(F.col("fingerprint"), F.col("g")).alias("near")).collect()}
    assert got[0] == 1.0 and abs(got[20] - 0.75) < 0.15 and abs(got[40] - 0.5) < 0.2 and got[80] < 0.25


# ---------------------------------------------------------------- 8


def test_language_model_base_is_exact(spark):
    rows = corpus(seed=11)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    words = lambda t: (t or "").encode().lower().split()
    counts = Counter()
    for i, t in rows:
        if not held(i):
            counts.update(words(t))
            counts["end"] += 1
    total, scale = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    for head in (1 << 20, 8):  # all words frequent, or nearly all rare
        got = lm.score_documents(frame(spark, rows), quality.remainder(F.col("doc_id"), 10) == 0, head=head, filter_bits=1 << 20).collect()
        assert len(got) == len(rows)
        want = Counter()
        for i, t in rows:
            w = [*words(t), "end"]
            want[(i, held(i), len(w), sum(counts[x] > 0 for x in w), total, round(sum(math.log10((counts[x] + 0.1) / scale) for x in w), 6))] += 1
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
        assert all(r.score <= 0 for r in got)
    assert lm.score_documents(frame(spark, []), F.lit(False), filter_bits=1 << 20).count() == 0


def test_filter_returns_what_was_stored(spark):
    texts = spark.createDataFrame([("alpha beta " * 50 + "gamma",), ("beta gamma delta",)], "text string")
    model, _, _ = lm.train(texts, filter_bits=1 << 22)
    import pyarrow as pa

    token, before, _ = lm.tokens(common.Texts(pa.array(["alpha beta gamma delta never"])), 0, 1)
    counts = model.means[0][model.levels(token, 0)]
    assert [round(x) for x in counts[:5]] == [50, 51, 2, 1, 0] or counts[4] == 0
    assert model.means[1][model.levels(lm.pairs(before, token), 1)][1] > 40


def test_thresholds_rise_when_bits_do_not_suffice(spark):
    texts = spark.createDataFrame([(" ".join(f"w{i % 900}" for i in range(k, k + 900)),) for k in range(20)], "text string")
    small, _, _ = lm.train(texts, filter_bits=1 << 13)
    large, _, _ = lm.train(texts, filter_bits=1 << 22)
    assert small.shape.least > large.shape.least == (1, 2)


def test_pairs_seen_once_enter_the_filter(spark):
    train = [f"left{k} right{k} left{k}x right{k}x" for k in range(300)]
    rows = list(enumerate(train)) + [(1000, "left5 right5 left9 right9"), (1001, "left5 right9 left9 right5"), (None, None), (None, None)]
    got = lm.score_documents(frame(spark, rows), F.col("doc_id") >= 1000).collect()
    assert len(got) == len(rows)
    seen, swapped = (next(r for r in got if r.doc_id == i) for i in (1000, 1001))
    assert seen.held_out and math.isclose(seen.base_score, swapped.base_score)
    assert seen.score > swapped.score + 0.001


def test_whole_filter_base_is_exact_and_score_near_exact_counts(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK", 2000)  # many chunks, each asking every range
    rows = corpus(seed=12)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    words = lambda t: [*(t or "").encode().lower().split(), "end"]
    one = Counter(x for i, t in rows if not held(i) for x in words(t))
    total, scale = sum(one.values()), sum(one.values()) + 0.1 * (len(one) + 1)
    got = lm.score_documents(frame(spark, rows), quality.remainder(F.col("doc_id"), 10) == 0).collect()
    want = Counter((i, held(i), len(words(t)), sum(one[x] > 0 for x in words(t)), total, round(sum(math.log10((one[x] + 0.1) / scale) for x in words(t)), 6)) for i, t in rows)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score <= 0 for r in got)
    # The score by brute force, from exact counts quantised by the definition and weights fitted by the definition.
    grams = lambda t, k: [tuple(x) for x in zip(*((["end"] * (k - 1) + words(t))[i:] for i in range(k)))]
    counted = [Counter(g for i, t in rows if not held(i) for g in grams(t, k)) for k in (1, 2)]
    counted.append(Counter(g for i, t in rows if not held(i) for g in grams(t, 2 + 1)[1:]))
    level = lambda n: 1 + math.floor(math.log(n) / math.log(1.5) + 1e-9) if n else 0
    means = []
    for c in counted:
        by = {}
        for n in c.values():
            by.setdefault(level(n), []).append(n)
        means.append({0: 0.0} | {k: sum(v) / len(v) for k, v in by.items()})
    mean = lambda k, g: means[k][level(counted[k][g])]

    def steps(t):
        """For each token P1 and (entry, context, level of context) of the orders two and three."""
        w = words(t)
        for i, x in enumerate(w):
            v = w[i - 1] if i else "end"
            two = (mean(1, (v, x)), mean(0, (v,)), level(counted[0][(v,)]))
            u = w[i - 2] if i > 1 else "end"
            three = (mean(2, (u, v, x)), mean(1, (u, v)), level(counted[1][(u, v)])) if i else (0.0, 0.0, 0)
            yield (mean(0, (x,)) + 0.1) / scale, two, three

    def fitted(samples):
        found = np.zeros((lm.LEVELS, lm.RATIOS), np.int64)
        for lower, (entry, context, at) in samples:
            p = min(1.0, (entry - 1 if entry - 1 >= 1 - 1e-9 else 0) / max(1.0, context - 1))
            found[at, int(np.clip(np.round(4 * np.log2(p / lower)) + 16, 1, lm.RATIOS - 1)) if p > 0 else 0] += 1
        return lm.fit_weights(found)

    def blend(lower, step, weights, own=0):
        entry, context, at = step
        l = weights[at] if context > own else 0.0  # noqa: E741
        return (1 - l) * lower + l * min(1.0, max(0.0, entry - own) / max(1.0, context - own))

    train = [s for i, t in rows if not held(i) for s in steps(t)]
    second = fitted((p1, two) for p1, two, _ in train)
    third = fitted((blend(p1, two, second, 1), three) for p1, two, three in train)
    expected = Counter((i, round(sum(math.log10(blend(blend(p1, two, second), three, third)) for p1, two, three in steps(t)), 4)) for i, t in rows)
    assert sum((Counter((r.doc_id, round(r.score, 4)) for r in got) & expected).values()) >= 0.97 * len(rows)  # the filter may err in some lookups


def test_packed_names():
    rnd = np.random.default_rng(2)
    h = np.unique(rnd.integers(0, 1 << 64, 5000, dtype=np.uint64))
    for n in (1, 2, 24, 1000):
        bucket, name = lm.placed(h, n)
        assert [int(x) * n >> 64 for x in h.tolist()] == bucket.tolist()
        assert (name < 1 << 40).all() and all((np.diff(name[bucket == b].astype(np.int64)) > 0).all() for b in set(bucket.tolist()))
        part = name[bucket == bucket[-1]]
        assert np.array_equal(lm.unpack(lm.pack(part)), part)
    assert len(lm.unpack(lm.pack(h[:0]))) == 0


def test_triples_tell_what_pairs_do_not(spark):
    rnd = random.Random(9)
    train = []
    for _ in range(400):  # what follows "m" depends on the word before it
        first = rnd.choice("ab")
        train.append(f"{first} m {'x' if first == 'a' else 'y'}")
    rows = list(enumerate(train)) + [(1000, "a m x"), (1001, "a m y")]
    got = {r.doc_id: r.score for r in lm.score_documents(frame(spark, rows), F.col("doc_id") >= 1000).where("doc_id >= 1000").collect()}
    assert got[1000] > got[1001] + 1


def test_segments_hold_every_entry():
    n = np.ones(200_000, np.int64)
    h = common.mix(np.arange(len(n), dtype=np.uint64))
    n[:1000] = 1000
    h, n = lm.add_up(h, n)
    data = np.zeros(1000, np.uint8)
    spots = np.random.default_rng(5).integers(0, 8000, 900)
    lm._set(data, spots, page=1 << 10)
    assert np.array_equal(np.flatnonzero(np.unpackbits(data, bitorder="little")), np.unique(spots))
    made = lm.segment(h, n)
    assert (made.levels(h, 0) >= made.shape.level(n, 0)).all()
    other = common.mix(np.arange(len(n), 2 * len(n), dtype=np.uint64))
    assert (made.levels(other, 0) > 0).mean() < 1e-3


# ---------------------------------------------------------------- 9


def test_quality_votes(spark):
    rnd = random.Random(6)
    good = lambda: " ".join(rnd.choice(["the", "river", "runs", "over", "green", "stones", "and", "birds", "sing"]) for _ in range(40)) + "."
    bad = lambda: "!!! ".join(rnd.choice(["BUY", "NOW", "$$$", "###"]) for _ in range(40))
    rows = [(i, good() if i % 3 else bad()) for i in range(300)] + [(900, None), (901, ""), (None, "x"), (902, "y" * 20000)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 300, 2)] + [(0, None), (None, 1), (77777, 1), (2, 1)], "doc_id long, quality int")
    docs = frame(spark, rows)
    model = quality.fit(docs, labels, quality.remainder(F.col("doc_id"), 4) != 2)
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all((r.score >= 0.7) == bool(r.doc_id % 3) for r in got if r.doc_id is not None and r.doc_id < 300)
    assert len({r.score for r in got if r.doc_id in (900, 901)}) == 1
    assert quality.score(docs.limit(0), model).count() == 0
    # By brute force: every cosine, neighbours one by one, ties to the earlier.
    import pyarrow as pa

    for r in got[::17]:
        row = quality.features(common.Texts(pa.array([r.text], pa.string())), 0, 1)
        near = (model.project(row)[0].astype(np.float64) @ model.vectors.T.astype(np.float64)).round(6)
        chosen = sorted(range(len(near)), key=lambda i: (-near[i], i))[: model.neighbours]
        weight = np.exp((near[chosen] - near[chosen].max()) * model.sharpness)
        if (model.project(row) != 0).any() and len(set(near[chosen])) == len(chosen):
            assert abs(r.score - (weight * model.labels[chosen]).sum() / weight.sum()) < 1e-3
    clash = docs.withColumn("score", F.lit("mine")).withColumn("y", F.lit(1))
    assert quality.score(clash, model).schema["score"].dataType.typeName() == "double"
    unlabelled = quality.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in quality.score(docs, unlabelled).collect()} == {0.5}


def test_neighbours_and_their_ties():
    rnd = np.random.default_rng(1)
    cosines = rnd.integers(0, 6, (200, 40)).astype(np.float32)
    for k in (1, 5, 40):
        want = [sorted(sorted(range(40), key=lambda i: (-row[i], i))[:k]) for row in cosines]
        assert quality.nearest(cosines, k).tolist() == want


def test_scores_do_not_depend_on_the_batch():
    import pyarrow as pa

    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["the", "river", "BUY", "$$$", "stones"]) for _ in range(rnd.randint(1, 60))) for _ in range(700)]
    rows = quality.features(common.Texts(pa.array(texts)), 0, len(texts))
    _, _, v = np.linalg.svd(rows, full_matrices=False)
    model = quality.Model(np.ones(rows.shape[1], np.float32), v[:16].T.astype(np.float32), np.zeros((0, 16), np.float32), np.arange(700) % 2, 9, 30.0)
    model.vectors = model.project(rows)
    whole = model.scores(rows)
    for size in (1, 3, 100, 513):
        assert np.array_equal(np.concatenate([model.scores(rows[i : i + size]) for i in range(0, 700, size)]), whole)


@pytest.mark.skipif(not __import__("os").path.exists("/root/testdata/sf0.01/labels.parquet"), reason="no tables")
def test_quality_of_held_out_documents(spark):
    from quadrille.llm import queries

    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    got = queries.op9_quality_votes(spark, "/root/testdata/sf0.01").where("held_out").join(labels, "doc_id").where("quality is not null").toPandas()
    assert len(got) > 30 and (got.predicted == got.quality).mean() >= 0.95
