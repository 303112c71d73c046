"""Cases in which a bound must not cut a result."""

from __future__ import annotations

import random
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationhour.llm import compression_quality, decontamination, sharding, substring_dedup
from stationhour.llm.staging import stage

SMALL = "/root/testdata/sf0.001"


def words(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def test_long_overlaps_are_whole(spark):
    rng = random.Random(1)
    item = words(rng, 400)
    before, after = words(rng, 300), words(rng, 300)
    changed = [w if i % 7 else "other" for i, w in enumerate(item)]
    docs = spark.createDataFrame([(1, " ".join(before + item + after)), (2, " ".join(before + changed + after)), (3, " ".join(item[:13] + after)),
                                  (4, " ".join(before + item + after[:5] + item[100:150]))], "doc_id long, text string")
    tests = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: (r.matched_words, r.first_word, r.overlap_words) for r in decontamination.contaminated(docs, tests).collect()}
    assert got[1] == (400, 300, 400) and got[3][:2] == (13, 0) and got[4] == (400, 300, 400)
    assert got[2][0] == sum(1 for i in range(400) if i % 7) and got[2][2] >= 398


def test_alignments_in_parts():
    rng = random.Random(2)
    bench = [" ".join(words(rng, n)) for n in (15, 40, 200)]
    texts = [" ".join([*words(rng, 5), *bench[i].split(), *words(rng, 5)]) for i in (0, 1, 2, 2)]

    data = [t.encode() for t in texts]
    flat, bounds = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    items = decontamination.Items([0, 1, 2], bench, 13, 0.8)
    whole = [x.tolist() for x in items.overlaps(flat, bounds)]
    assert [x.tolist() for x in items.overlaps(flat, bounds, cells=20)] == whole
    assert whole == [[0, 1, 2, 3], [0, 1, 2, 2], [15, 40, 200, 200], [5] * 4, [15, 40, 200, 200]]


def plain_pairs(texts, items, least=13, share=0.8):
    """(row, item) that share a window, by trying every place against every place."""
    out = set()
    for (i, t), (j, b) in product(texts, items):
        x, y = (t or "").casefold().split(), (b or "").casefold().split()
        n = min(least, len(y))
        need = n - decontamination.allowed(n, share)
        where = {}
        for q, w in enumerate(y):
            where.setdefault(w, []).append(q)
        lines = {}
        for p, w in enumerate(x):
            for q in where.get(w, ()):
                lines.setdefault(p - q, []).append(p)
        for d, hits in lines.items():
            low, high = max(0, d), min(len(x), len(y) + d) - n
            held = set(hits)
            if n and len(hits) >= need and any(sum(p + k in held for k in range(n)) >= need for p in range(low, high + 1)):
                out.add((i, j))
                break
    return out


def test_pairs_match_brute_force(spark):
    docs, tests = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in tests.collect()]
    want = plain_pairs(texts, items)
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, tests).collect()} == want and want
    assert {r.doc_id for r in decontamination.decontaminate(docs, tests).collect()} == {i for i, _ in texts} - {i for i, _ in want}


def test_a_text_over_the_bound_is_passed_over(spark, monkeypatch):
    docs = [(i, f"{'good clean sentences here' if i % 2 else 'bad $$$ spam click'} number {i} " * 5) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    repeated = docs + [(3, docs[3][1])] * 50
    huge = [(i, t * 400 if i in (0, 1, 2, 3, 4, 5, 6, 7) else t) for i, t in docs]
    plain = compression_quality.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels, sample_bytes=20_000)
    assert plain == compression_quality.fit(spark.createDataFrame(repeated, "doc_id long, text string"), labels, sample_bytes=20_000)
    model = compression_quality.fit(spark.createDataFrame(huge, "doc_id long, text string"), labels, sample_bytes=20_000)
    assert model.good and model.bad and model.slope
    scored = compression_quality.classify_quality(spark.createDataFrame(huge, "doc_id long, text string"), labels, sample_bytes=20_000).collect()
    assert sum(r.predicted == r.doc_id % 2 for r in scored) >= 0.9 * len(scored)


def test_shards_of_rows_without_an_order(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.create_map(F.lit("k"), F.col("id")).alias("m"))
    out = sharding.shuffle_into_shards(docs, shards=3, bucket_bytes=500).collect()
    assert sorted(r.doc_id for r in out) == list(range(200)) and all(r.m == {"k": r.doc_id} for r in out)
    for s in range(3):
        own = sorted((r.slot, r.doc_id) for r in out if r.shard == s)
        assert [slot for slot, _ in own] == list(range(len(own))) and [i for _, i in own] != sorted(i for _, i in own)


@pytest.mark.parametrize("length", [1, 5, 13])
def test_sketch_never_underestimates(spark, length):
    """Every window that is found twice in the table has counters of two or more in all rows, wherever its copies are."""
    rows = [(i, " ".join(str((i * 7 + j * j) % 23) for j in range(40 + i))) for i in range(60)] + [(99, None), (98, "")]
    staged = stage(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    hot = substring_dedup.repeated_counters(substring_dedup.window_sketches(staged, length), 4).collect()
    by_chunk = {}
    for r in hot:
        places = substring_dedup._unpacked(r.counters).astype(np.uint64) | np.uint64(r.part << 24)
        by_chunk.setdefault(r.chunk, set()).update(places.tolist())
    seen, own = Counter(), {}
    for r in staged.table.collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        h = substring_dedup.Words(data, np.array([0, len(data)]), length).hashes
        seen.update(map(tuple, h.T.tolist()))
        own.setdefault(r[staged.chunk], []).append(h)
    assert max(seen.values()) > 1
    for chunk, hashes in own.items():
        for h in hashes:
            estimate = np.array([[p in by_chunk.get(chunk, ()) for p in substring_dedup.counters_of(h, k, staged.shards).tolist()]
                                 for k in range(substring_dedup.ROWS)]).all(axis=0)
            repeated = np.array([seen[tuple(x)] > 1 for x in h.T.tolist()], bool)
            assert estimate[repeated].all()
            assert (estimate & ~repeated).sum() == 0  # so few windows hardly collide in 2**32 counters


def test_shared_phrase_is_not_one_group(spark):
    """A phrase in all documents, other words around it: a shard gets a window at most once from each chunk, however many documents have it."""
    phrase = " ".join(f"p{i}" for i in range(6))
    full = " ".join(f"f{i}" for i in range(13))
    rows = [(i, f"{' '.join(f'a{i}x{j}' for j in range(12))} {phrase} {' '.join(f'b{i}x{j}' for j in range(12))} {full} {full}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    staged = stage(docs)
    counters = substring_dedup.repeated_counters(substring_dedup.window_sketches(staged, 13), 4)
    found = substring_dedup.estimated_repeats(staged, 13, counters).filter("shard >= 0").collect()
    sent = Counter(tuple(x) for r in found for x in np.frombuffer(r.hashes, np.uint64).reshape(2, -1).T.tolist())
    # the thirteen words, and the turns of them that the second copy of a document makes; nothing around the phrase
    assert len(sent) == 13 and max(sent.values()) <= staged.chunks
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeated_words(docs).collect()}
    assert got == {i: (56, 26 if i else 0) for i in range(400)}


def test_packed_counters():
    rng = np.random.default_rng(7)
    for n in (0, 1, 5, 4000):
        own = np.unique(rng.integers(0, substring_dedup.COUNTERS, n).astype(np.uint64))
        assert (substring_dedup._unpacked(substring_dedup._packed(own)) == own).all()
    edge = np.array([0, 1, 255, 256, 65_535, 65_536, substring_dedup.COUNTERS - 1], np.uint64)
    assert (substring_dedup._unpacked(substring_dedup._packed(edge)) == edge).all()


def test_equal_first_halves_are_told_apart():
    known = np.array([[1, 1, 1, 5], [2, 3, 9, 1]], np.uint64)
    wanted = np.array([[1, 1, 1, 5, 5, 0], [9, 3, 4, 1, 2, 2]], np.uint64)
    assert substring_dedup._pairs_among(known, wanted).tolist() == [True, True, False, True, False, False]
