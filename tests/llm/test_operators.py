from __future__ import annotations

import binascii
import random
import struct
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import brute
from stationhour.llm import (compression_quality, decontamination, html_text, jaccard_join, language_id, packing, quality_rules, sharding,
                             substring_dedup, suffix_dedup)

SMALL = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")

LETTERS = "a b c d e f g h i j k l m n o p q r s"
MESSY = [
    (1, LETTERS + " one ending"), (2, LETTERS + " another one"), (3, None), (4, ""), (5, " \t\n "), (6, "word"), (None, LETTERS),
    (None, LETTERS), (7, LETTERS), (7, LETTERS), (8, "aaaa" * 100), (9, "aaaa" * 60 + " é" * 40), (10, "x y " * 30),
    (11, "line\nline\n\nline\r\nline \nx"), (12, "# $5 % & | <b> *"), (13, "日本語 テキスト " * 20), (14, "don't we'll 'sx ''s \x1c   \u0085 ok"),
    (15, " ".join(f"long{i}" for i in range(40_000))), (16, "Word " * 3), (17, "the <|endoftext|> end"),
]


def frame(spark, rows=MESSY, parts=3):
    """Rows with extra columns whose names clash with results."""
    full = [(i, t, "x", 1, 2.0, "k") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, n_words string, shard int, ratio double, `__row` string").repartition(parts)


@pytest.fixture(scope="module")
def messy(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("messy") / "docs")
    frame(spark).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [(1, "x")]).filter("false")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["messy", "small"])
def test_repeated_words(which, request):
    docs = request.getfixturevalue(which)
    out = substring_dedup.remove_repeated_words(docs)
    got = sorted((brute.key(r.doc_id), r.n_words, r.n_removed, brute.sha(r.kept_text.encode())) for r in out.collect())
    assert got == brute.repeated_words(pairs(docs))
    assert set(docs.columns) - {"text"} <= set(out.columns)


@pytest.mark.parametrize("which", ["messy", "small"])
def test_repeated_bytes(which, request):
    docs = request.getfixturevalue(which)
    got = sorted((brute.key(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept_bytes)))
                 for r in suffix_dedup.remove_repeated_bytes(docs).collect())
    assert got == brute.repeated_bytes(pairs(docs))


@pytest.mark.parametrize("length", [3, 8, 12, 16, 50])
def test_radix_groups_follow_the_bytes(length):
    import numpy as np

    rng = random.Random(length)
    texts = [b"abcdefghij" * 30, b"abcdefghix" * 9, bytes(rng.choice(b"ab") for _ in range(400)), bytes(rng.randrange(256) for _ in range(300)), b"\xff" * 70 + b"\x00" * 70]
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.array(rng.sample(range(len(data) - length), len(data) - length))
    ranks = suffix_dedup.radix_groups(data, at, length)
    windows = [data[i:i + length].tobytes() for i in at]
    place = {w: k for k, w in enumerate(sorted(set(windows)))}
    assert ranks.tolist() == [place[w] for w in windows]
    assert suffix_dedup.radix_groups(data, at[:1], length).tolist() == [0]


def test_radix_passes_leave_finished_groups(monkeypatch):
    """Each pass reads the next digit of those suffixes alone that share all digits so far."""
    import numpy as np

    read = []
    real = suffix_dedup._eights

    class Digits:
        def __init__(self, digits):
            self.digits = digits

        def __getitem__(self, key):
            read.append(len(key))
            return self.digits[key]
    monkeypatch.setattr(suffix_dedup, "_eights", lambda *a: (Digits(real(*a)[0]), real(*a)[1]))
    data = np.frombuffer(b"".join([b"same" * 8, b"same" * 6 + b"other bytes"] + [bytes([65 + i]) * 32 for i in range(20)]), np.uint8)
    at = np.array([0, 32] + [67 + 32 * i for i in range(20)])
    assert len(set(suffix_dedup.radix_groups(data, at, 32).tolist())) == 22
    assert read == [22, 2, 2, 2]


def test_cut_text_stays_text(spark, tmp_path):
    spark.createDataFrame([(1, "x" + "é" * 60), (2, "é" * 60 + "end"), (3, None)], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r.text for r in suffix_dedup.cut_repeats(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert got == {1: "x" + "é" * 60, 2: "end", 3: ""}


@pytest.mark.parametrize("which", ["messy", "small", "fuzz"])
def test_jaccard(which, request, spark, tmp_path):
    if which == "fuzz":
        random.seed(5)
        v = [f"w{i}" for i in range(40)]
        base = [[random.choice(v) for _ in range(random.choice([3, 5, 6, 7, 8, 9, 10, 11, 12, 14, 20, 30, 60, 90]))] for _ in range(40)]
        rows = []
        for i in range(500):
            w = list(random.choice(base))
            for _ in range(random.choice([0, 1, 1, 1, 2, 3])):
                w[random.randrange(len(w))] = random.choice([*v, f"z{random.randrange(9999)}"])
            if random.random() < 0.2:
                w = base[0][:8] + w
            rows.append((i, " ".join(w)))
        frame(spark, rows).write.parquet(str(tmp_path / "d"))
        docs = spark.read.parquet(str(tmp_path / "d"))
    else:
        docs = request.getfixturevalue(which)
    got = sorted((brute.key(r.doc_id), r.n_shingles, -1 if r.component_id is None else r.component_id)
                 for r in jaccard_join.near_duplicates(docs).collect())
    assert got == brute.groups(pairs(docs))


def test_keep_one(messy):
    kept = jaccard_join.keep_one(messy)
    assert kept.columns == messy.columns
    rows = pairs(kept)
    assert [r for r in rows if r[1] == LETTERS] == [] and (1, LETTERS + " one ending") in rows  # one of the linked stays
    assert Counter(i for i, _ in rows if i in (3, 4, 5, 6, 16)) == {3: 1, 4: 1, 5: 1, 6: 1, 16: 1}


def test_boundary_follows_cost():
    assert jaccard_join.size_boundary(80, 1) <= jaccard_join.size_boundary(80, 24) <= jaccard_join.size_boundary(80, 1000)


def test_shards(messy, spark):
    out = sharding.shuffle_into_shards(messy, shards=5, bucket_bytes=2000).collect()
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 5)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert Counter((r.doc_id, r.text) for r in out) == Counter(pairs(messy))
    place = {r.doc_id: r.shard for r in out}
    assert all(place[r.doc_id] == r.shard for r in out)  # the key decides
    grown = {r.doc_id: r.shard for r in sharding.shuffle_into_shards(messy, shards=6).collect()}
    assert grown == {r.doc_id: r.grown_shard for r in out}
    other = {(r.doc_id, r.text): r.slot for r in sharding.shuffle_into_shards(messy, shards=1, seed=3).collect()}
    assert other != {(r.doc_id, r.text): r.slot for r in sharding.shuffle_into_shards(messy, shards=1, seed=4).collect()}


def test_packing(messy, small):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    for docs in (messy, small):
        out = packing.pack(docs, VOCABULARY, with_ids=True).collect()
        expected = Counter(tuple(t.encode(x or "", add_special_tokens=False).ids + [0]) for _, x in pairs(docs))
        documents, current = [], []
        by_sequence = defaultdict(list)
        for r in out:  # in order within a task
            assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *r.ids))
            assert r.start == len(current)
            current += r.ids
            by_sequence[r.sequence_id].append(r)
            if len(current) == r.doc_tokens:
                documents.append(tuple(current))
                current = []
        assert Counter(documents) == expected
        lengths, padded = [], []
        for rows in by_sequence.values():
            at = 0
            for r in sorted(rows, key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
            assert at <= 1024
            lengths.append(at)
            padded.append(at if at & (at - 1) == 0 else 1024)
            assert {r.padded_length for r in rows} == {padded[-1]}
        assert sum(lengths) >= 0.97 * sum(padded)


def test_ids_of_every_low_character():
    """Every code point below U+0300, alone and between letters, digits, blanks and signs, gives the ids of ``tokenizers``."""
    import numpy as np
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    odd = [chr(c) for c in range(0x300)]
    texts = odd + [f"ab{c}cd {c}x 1{c}2 {c}{c} '{c} ,{c}. don't{c}s\n{c}" for c in odd] + ["".join(odd[i:i + 64]) for i in range(0, 0x300, 64)] + ["ə schwa ʃ"]
    raw = [x.encode() for x in texts]
    ids, at = packing.encoder_of(VOCABULARY).documents(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for x, a, b in zip(texts, at[:-1], at[1:], strict=True):
        assert ids[a:b].tolist() == t.encode(x, add_special_tokens=False).ids + [0], ascii(x)


def test_window_choice_is_optimal():
    import numpy as np

    def cost(d, size, cut):
        k = -(-d // size)
        return k * size - d + (k - 1) * cut

    random.seed(2)
    for _ in range(50):
        ends = np.unique(random.sample(range(1, 120), random.randint(1, 30)))
        penalty = np.array([random.choice([0.0, 0.5]) for _ in ends])
        chosen = packing.choose_windows(ends, penalty, size=16, cut=3.0, reach=2)
        assert chosen[0] == 0 and chosen[-1] == ends[-1] and (np.diff(chosen) <= 16).all() and (np.diff(chosen) > 0).all()
        if (np.diff(np.concatenate([[0], ends])) > 16).any():
            continue
        best = {0: 0.0}
        for e, p in zip(ends.tolist(), penalty.tolist(), strict=True):
            best[e] = p + min(best[j] + cost(e - j, 16, 3.0) for j in best if e - j <= 32)
        charge = dict(zip(ends.tolist(), penalty.tolist(), strict=True))
        total, last = 0.0, 0
        for c in chosen[1:].tolist():
            total += 16 - (c - last) + charge.get(c, 3.0)
            last = c
        assert total == pytest.approx(best[ends[-1]])


def test_seeds_find_substitutions(spark, messy, empty):
    random.seed(4)
    v = [f"t{i}" for i in range(500)]
    item = [random.choice(v) for _ in range(40)]
    filler = lambda n: [f"f{random.randrange(10**6)}" for _ in range(n)]
    changed = list(item)
    for i in (3, 9, 17, 25, 33):
        changed[i] = "changed"
    broken = item[:6] + ["x"] + item[7:9] + ["x"] + item[10:13]  # 11 of 13, no long run
    rows = [(80, filler(9) + broken + filler(9)), (90, filler(9) + broken[:10] + ["y"] + broken[11:] + filler(9)), (1, filler(30) + item + filler(5)), (2, filler(3) + changed), (3, filler(50)), (4, item[10:23] + filler(9)),
            (5, filler(4) + item[:8] + filler(9)), (6, [w.upper() for w in item]), (7, item[:6] + filler(20) + item[20:26])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").unionByName(messy.select("doc_id", "text"))
    tests = spark.createDataFrame([(70, " ".join(item)), (71, None), (72, ""), (None, "too short")], "item_id long, text string")
    for block in (1 << 20, 10):
        got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(docs, tests, block_bytes=block).collect()}
        assert set(got) == {(1, 70), (2, 70), (4, 70), (6, 70), (80, 70)}
        assert (got[1, 70].matched_words, got[1, 70].first_word, got[1, 70].overlap_words) == (40, 30, 40)
        assert got[2, 70].matched_words == 35
    left = decontamination.decontaminate(docs, tests, block_bytes=10)
    assert Counter(r.doc_id for r in left.collect()) == Counter(r.doc_id for r in docs.collect() if r.doc_id not in (1, 2, 4, 6, 80) or len(r.text or "") < 60)
    assert decontamination.contaminated(docs, tests.filter("false")).count() == 0
    assert decontamination.contaminated(empty, tests).count() == 0


def test_capitals_beyond_ascii(spark):
    """A copy in capitals, with letters that one byte does not hold and letters that capitals write as two."""
    item = ("Über die Straße fährt ein älterer Zug später über Köln zurück größer müßig garçon déjà élève forêt hôtel "
            "señor mañana corazón ὁδός λόγος").split()
    rows = [(1, "x y z " + " ".join(item).upper() + " w"), (2, " ".join(item[:13]).upper()), (3, "\n".join(item[8:])), (4, " ".join(item[:9]).upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # bytes that are no UTF-8 in another text, and in the passage's neighbourhood
    odd = spark.sql("select 5L doc_id, cast(concat(x'FF20C320', cast('%s' as binary)) as string) text" % " ".join(item).upper())
    tests = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: (r.matched_words, r.first_word, r.overlap_words) for r in decontamination.contaminated(docs.union(odd), tests).collect()}
    assert got == {1: (23, 3, 23), 2: (13, 0, 13), 3: (15, 0, 15), 5: (23, 2, 23)}
    assert [r.doc_id for r in decontamination.decontaminate(docs, tests).collect()] == [4]


def test_masks_meet_two_substitutions():
    from itertools import combinations

    for gone in combinations(range(13), 2):
        assert any(all(p + o not in gone for o in m) for m in decontamination.MASKS for p in range(13 - m[-1]))


def _pieces_of(texts, bench, **given):
    import numpy as np

    raw = [t.encode() for t in texts]
    items = decontamination.Items(list(range(len(bench))), bench, given.get("least", 13), given.get("share", 0.8))
    row, item, matched, first, words = items.overlaps(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    return {(r, i): (m, f, w) for r, i, m, f, w in zip(*(x.tolist() for x in (row, item, matched, first, words)), strict=True)}


@pytest.mark.parametrize("least, share", [(13, 0.8), (20, 0.8), (13, 0.6), (4, 0.5)])
def test_short_items_meet_all_substitutions(least, share):
    """All substitutions that the share allows, and one more, in items of every length up to ``least``; items of all lengths in one block."""
    from itertools import combinations

    bench = [" ".join(f"w{n}x{j}" for j in range(n)) for n in range(1, least + 1)] + ["", None]
    for n in range(1, least + 1):
        most = decontamination.allowed(n, share)
        for k in (range(most + 2) if n <= 13 else (most, most + 1)):
            gone = list(combinations(range(n), k))
            if len(gone) > 400:
                gone = random.Random(n).sample(gone, 400)
            texts = [" ".join(["before"] * 3 + ["y" if j in g else f"W{n}x{j}" for j in range(n)] + ["after"] * 2) for g in gone]
            expected = {(i, n - 1): (n - k, 3, n) for i in range(len(gone))} if k <= most else {}
            assert _pieces_of(texts, bench, least=least, share=share) == expected, (n, k)


def test_short_items_in_tables(spark):
    tests = spark.createDataFrame([(1, "What is it?"), (2, "one two three four five six seven"), (3, "Paris"), (4, None), (5, "")], "item_id long, text string")
    rows = [(1, "he asked what is it? again"), (2, "what is\nit?"), (3, "what is it"), (4, "so one two THREE x five six seven so"), (5, "one two x four x six seven"),
            (6, "paris"), (7, "in paris, once"), (8, "what"), (9, "is it?"), (10, None), (11, "what is this it?")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = sorted((r.doc_id, r.item_id, r.matched_words, r.first_word) for r in decontamination.contaminated(docs, tests).collect())
    assert got == [(1, 1, 3, 2), (2, 1, 3, 0), (4, 2, 6, 1), (6, 3, 1, 0)]
    assert sorted(r.doc_id for r in decontamination.decontaminate(docs, tests).collect()) == [3, 5, 7, 8, 9, 10, 11]


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = compression_quality.classify_quality(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_quality_edges(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 1)], "doc_id long, quality int")
    rows = compression_quality.classify_quality(messy, labels).collect()
    assert len(rows) == len(MESSY) and all(0 <= r.score <= 1 for r in rows)
    assert compression_quality.classify_quality(empty, labels.filter("false")).count() == 0


def test_quality_rules(messy, empty, spark):
    trusted = spark.createDataFrame([(1,), (2,), (15,), (None,)], "doc_id long")
    rows = quality_rules.apply_rules(messy, trusted).collect()
    got = sorted((brute.key(r.doc_id), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in rows)
    assert got == sorted((brute.key(i), brute.base_counts(t)) for i, t in MESSY)
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality_rules.apply_rules(empty, trusted).count() == 0
    assert {r.kept or r.base_failed for r in quality_rules.apply_rules(messy, trusted.filter("false")).collect()} == {True}


def test_quality_rules_tell_labels_apart(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality_rules.apply_rules(docs, labels.filter("quality = 1 and doc_id % 2 = 0")).join(labels, "doc_id").filter("not base_failed").collect()
    unseen = [r for r in rows if r.doc_id % 2]
    assert sum(r.kept for r in unseen if r.quality == 1) >= 0.99 * sum(r.quality == 1 for r in unseen)
    assert sum(r.kept for r in unseen if r.quality == 0) <= 0.1 * sum(r.quality == 0 for r in unseen)


def test_quality_rules_count_all_trusted(small, spark):
    """Target and threshold follow from every trusted text, of which there is no more than one in a part here."""
    docs = small.select("doc_id", "text").orderBy("doc_id").limit(300).cache()
    every = docs.select("doc_id")
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    model = quality_rules.fit(docs, every.unionByName(every), buckets=512, parts=300)
    weights = np.frombuffer(model.weights, np.float32).reshape(301, 512)
    assert np.allclose(weights[0], weights[0][0], atol=0.05)     # the corpus is its own target
    measured = quality_rules.measure(docs, model)
    got = [r.unseen for r in measured.collect()]
    for lost in (0.0, 0.5, 0.77):
        assert np.isclose(quality_rules.threshold(measured, every, lost, 0.0), min(0.0, np.quantile(got, lost)), atol=1e-12)
    each = quality_rules.gram_counts(docs.withColumn("part", F.expr("CAST(doc_id % 3 AS INT)")), 512, part="part", parts=3)
    assert [x.sum() for x in each] == [sum(max(0, len(t) - 3) for i, t in texts.items() if i % 3 == k) for k in range(3)]


def test_quality_rules_look_at_little_text_at_once(small):
    """Texts are counted in slices far smaller than a task's share of them; the counts don't depend on the slices."""
    rows = small.select("text").toArrow()
    few, whole = [[np.concatenate(x) for x in zip(*[quality_rules.base_counts(d, b) for _, _, d, b in quality_rules.V.slices(rows, "text", limit)])]
                  for limit in (quality_rules._SLICE, 1 << 24)]
    assert quality_rules._SLICE <= 1 << 18 and all((a == b).all() for a, b in zip(few, whole, strict=True))


def test_language(small, messy, empty):
    out = language_id.identify(small, declared=F.col("lang"), host=F.col("source"))
    rows = out.collect()
    assert sum(r.lang == r.predicted_lang for r in rows) >= 0.98 * len(rows) and all(r.accepted for r in rows)
    bare = language_id.identify(messy, declared=F.lit(None), host=F.col("shard"), suffix=F.lit(None)).collect()
    assert len(bare) == len(MESSY) and not any(r.accepted for r in bare if not (r.text or "").strip())
    assert language_id.identify(empty, declared=F.col("n_words")).count() == 0


def test_language_by_text_alone_after_learning(small, spark):
    """A wrong declaration on some texts does not carry the day."""
    wrong = small.withColumn("lang", F.when(F.col("doc_id") % 10 == 3, F.lit("xx")).otherwise(F.col("lang")))
    rows = language_id.identify(wrong.withColumn("true", F.lit(0)), declared=F.col("lang")).select("doc_id", "predicted_lang").collect()
    truth = {r.doc_id: r.lang for r in small.collect()}
    assert sum(truth[r.doc_id] == r.predicted_lang for r in rows) >= 0.97 * len(rows)


def test_languages_are_learnt(small, spark):
    """A fifth language is learnt from its declarations; another name of a language and one stray declaration are not languages."""
    random.seed(7)
    words = ["".join(random.choice("kaeiouwzptln") for _ in range(random.randint(2, 9))) for _ in range(400)]
    more = [(10**6 + i, " ".join(random.choices(words, k=80)), "xk" if i < 24 else None) for i in range(30)]
    stray = small.withColumn("lang", F.when((F.col("lang") == "fr") & (F.col("doc_id") % 3 == 0), F.lit("fra")).otherwise(F.col("lang")))
    docs = stray.select("doc_id", "text", "lang").union(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    got = {r.doc_id: r for r in language_id.identify(docs, declared=F.col("lang")).collect()}
    assert all(got[i].predicted_lang == "xk" and got[i].accepted for i, _, _ in more)
    truth = {r.doc_id: r.lang for r in small.collect()}
    assert sum(got[i].predicted_lang == x for i, x in truth.items()) >= 0.97 * len(truth)
    assert {r.predicted_lang for r in got.values()} == {"de", "en", "es", "fr", "xk"}


def test_query_answers_documents_and_pages(spark):
    from stationhour.llm.queries import QUERIES

    rows = QUERIES["op9_language_id"](spark, SMALL).collect()
    for name in ("documents", "pages"):
        key = "doc_id" if name == "documents" else "page_id"
        own = [r for r in rows if r[key] is not None]
        assert Counter(r[key] for r in own) == Counter(r[0] for r in spark.read.parquet(f"{SMALL}/{name}.parquet").select(key).collect())
        assert sum(r.declared_lang == r.predicted_lang for r in own if r.declared_lang) >= 0.9 * len(own)


def test_page_evidence(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    plain = html_text.extract(pages.withColumn("source_html", F.col("html"))).select(
        "page_id", "url", "text", *[c.alias(n) for c, n in zip(language_id.page_evidence(F.col("source_html"), F.col("url")), ("declared", "suffix", "host"))])
    rows = language_id.identify(plain, declared=F.col("declared"), suffix=F.col("suffix"), host=F.col("host")).collect()
    assert {r.suffix for r in rows} <= {"com", "net", "org"} and all("." in r.host for r in rows)
    assert sum(r.declared == r.predicted_lang for r in rows if r.text) >= 0.9 * sum(bool(r.text) for r in rows)


PAGE = """<!DOCTYPE html><html><head><title>Title</title><style>p{x}</style></head><body><header class="site"><h2>Site</h2></header>
<nav><a href=/>Home</a></nav><div class="cookie-notice"><p>We use cookies, and we say so at some length here.</p></div>
%s<div id="comments"><p>A comment of a reader, of quite some length, for sure it is.</p></div><form><p>Your mail</p></form>
<footer>&copy; someone</footer>"""


def test_main_text():
    body = ("<h1>Head &amp; line</h1><p>One  is\n long enough to be content, with <a href=x>a link</a> in it.<p>Short."
            "<p>Two &lt;b&gt; also&nbsp;long enough to be content in this page of ours.</p>")
    expected = "Head & line\nOne is long enough to be content, with a link in it.\nShort.\nTwo <b> also long enough to be content in this page of ours."
    assert html_text.main_text(PAGE % f"<article>{body}<div class='ad'>Buy</div></article>") == expected
    assert html_text.main_text(PAGE % f"<div class='content'>{body}</div>") == expected
    assert html_text.main_text("just text") == "just text"
    for nothing in ("", "<p>", "<script>var a='<p>x</p>'</script>", "<", "<!--", "<article>"):
        assert html_text.main_text(nothing) in ("", "<", "<!--")


def test_extract(spark):
    rows = [(1, "u", PAGE % "<article><p>Text</article>", "own"), (2, None, None, "own"), (3, "u", "", None), (3, "u", "", None), (None, "u", "<p>" + "word " * 100_000, "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert Counter((r.page_id, r.text[:9], r.n_chars) for r in got.collect()) == {(1, "Text", 4): 1, (2, "", 0): 1, (3, "", 0): 2, (None, "word word", 499_999): 1}
    assert html_text.extract(pages.filter("false")).count() == 0


def test_empty_tables(empty):
    assert substring_dedup.remove_repeated_words(empty).count() == 0
    assert suffix_dedup.remove_repeated_bytes(empty).count() == 0
    assert suffix_dedup.cut_repeats(empty).count() == 0
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert jaccard_join.keep_one(empty).count() == 0
    assert sharding.shuffle_into_shards(empty).count() == 0
    assert packing.pack(empty, VOCABULARY).count() == 0
