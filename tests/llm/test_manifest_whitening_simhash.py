from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stationhour.llm import embedding_whitening, merkle, queries, simhash

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ---------------------------------------------------------------- manifest

def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values) -> str:
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(leaves, fanout):
    """(root, the steps of each leaf's path)."""
    paths, place, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, j in enumerate(place):
            run = j // fanout * fanout
            paths[i].append(("".join(nodes[run:j]), "".join(nodes[j + 1:run + fanout])))
        nodes = [H(*nodes[a:a + fanout]) for a in range(0, len(nodes), fanout)]
        place = [j // fanout for j in place]
    return nodes[0], paths


def plain_manifest(rows, fanout):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, plain_leaf(r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g])], fanout) for g in order}
    root, above = plain_tree([trees[g][0] for g in order], fanout)
    return sorted((i if has else -1, g or "", leaf, trees[g][0], root, tuple(path + above[k]))
                  for k, g in enumerate(order) for (has, i, leaf), path in zip(sorted(groups[g]), trees[g][1], strict=True))


def manifest_rows(out):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.lang or "", r.leaf, r.subroot, r.root, tuple(tuple(s) for s in r.path)) for r in out.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "doc_id long, source string, lang string, n_chars long, text string, leaf int, `group` string").repartition(3)


MESSY = [(1, "a", "en", 3, "abc"), (2, None, "en", None, None), (3, "a", "en", 0, ""), (3, "a", "en", 0, ""), (3, "b", "en", 0, "Z"),
         (None, "a", "en", 1, "x"), (7, "é", "Ünï", 2, "日本"), (8, "s", None, 1, "-"), (9, "s", "", 1, "long " * 50_000), (-4, "s", "en", 1, "NEG")]


@pytest.mark.parametrize("levels, fanout", [(1, 2), (2, 2), (1, 8), (4, 8), (1, 3)])
def test_manifest_matches_a_plain_tree(spark, monkeypatch, levels, fanout):
    """Few levels a window make several rounds of blocks."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = MESSY + [(100 + i, f"s{i % 3}", random.Random(i).choice(["en", "de", "fr", "it"]), i, f"text {i}") for i in range(25)]
    assert manifest_rows(merkle.manifest(frame(spark, rows), fanout=fanout)) == plain_manifest(rows, fanout)


def test_manifest_of_few_rows(spark):
    one = merkle.manifest(frame(spark, [(5, None, None, None, None)])).first()
    assert one.leaf == one.subroot == one.root == H("1:5----") and one.path == []
    assert merkle.manifest(frame(spark, [(5, None, None, None, None)]).filter("false")).count() == 0


def test_a_changed_text_leads_to_another_root(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r for r in queries.op11(spark, SMALL).collect()}
    assert set(found) == set(texts)
    for i, r in found.items():
        changed = zlib.crc32(str(i).encode()) % 3 == 0 and re.search("[A-Z]", texts[i] or "") is not None
        assert r.verified == (not changed) == (r.folded_root == r.root)
    assert len({r.root for r in found.values()}) == 1 and not all(r.verified for r in found.values())


def test_manifest_windows_stay_in_blocks(spark):
    plan = merkle.manifest(frame(spark, MESSY))._jdf.queryExecution().toString()
    assert "hashpartitioning(group" in plan and "block" in plan and "BatchEvalPython" not in plan
    assert not re.search(r"Exchange SinglePartition", plan)


# ---------------------------------------------------------------- whitening

def plain_components(vectors, scale, shift):
    x = np.unique(np.array([[int(np.floor(scale * c)) + shift for c in v] for v in vectors], np.int64), axis=0)
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s) / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    return n, s, e[::-1], q[:, ::-1]


def check_whitened(rows, vectors, count, scale=64.0, shift=1_000_000):
    """``vectors``: those that remain, by id."""
    n, s, e, q = plain_components(list(vectors.values()), scale, shift)
    by = {(r.vec_id, r.component): r for r in rows}
    k = sum(1 for v in e[:count] if v > 1e-9 * e[0])
    assert set(by) == {(i, c) for i in vectors for c in range(1, k + 1)}
    x = {i: np.array([int(np.floor(scale * c)) + shift for c in v], object) for i, v in vectors.items()}
    for c in range(k):
        want = np.array([float(((n * x[i] - s) / n).astype(float) @ q[:, c]) for i in vectors]) / np.sqrt(e[c])
        got = np.array([by[i, c + 1].whitened for i in vectors])
        gaps = [abs(e[c] - e[o]) for o in range(len(e)) if o != c]
        if min(gaps, default=1) > 1e-3 * e[0]:  # else any turn within the equal eigenvalues will do
            assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-7
    for i in vectors:
        r = by[i, 1]
        assert r.n == n and r.deviation == sum(int(d) ** 2 for d in n * x[i] - s)
        assert abs(r.explained - e[0] / e.sum()) < 1e-9 and r.identity_error < 1e-8


EMBEDDINGS = "vec_id long, embedding array<float>, label int, n string, whitened int, v double"


def embeddings(spark, vectors):
    vectors = [(i, v and [c if c is None else float(c) for c in v]) for i, v in vectors]
    return spark.createDataFrame([(i, v, 0, "users", 3, 0.5) for i, v in vectors], EMBEDDINGS).repartition(3)


def test_whitening_of_messy_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(i, (rng.standard_normal(5) * [3, 2, 1, 0.5, 0]).astype(np.float32).tolist()) for i in range(60)]
    good += [(1000 + i, good[0][1]) for i in range(40)]  # repeated
    bad = [(2000, None), (2001, []), (2002, [1.0, None, 2.0, 3.0, 4.0]), (2003, [float("nan")] * 5), (2004, [float("inf"), 0, 0, 0, 0]), (2005, [1.0, 2.0])]
    out = embedding_whitening.whiten(embeddings(spark, good + bad), count=16)
    assert out.columns == ["vec_id", "label", "v", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitened(out.collect(), dict(good), 16)  # the last dimension has no spread


def test_whitening_of_equal_eigenvalues(spark):
    points = [(2 * i + s, [(float(i == j) * (1 - 2 * s)) * (4.0 if i < 2 else 1.0) for j in range(6)]) for i in range(6) for s in range(2)]
    rows = embedding_whitening.whiten(embeddings(spark, points), count=4).collect()
    explained = sorted({(r.component, round(r.explained, 9)) for r in rows})
    both, rest = 16 / (2 * 16 + 4), 1 / (2 * 16 + 4)  # each axis apart
    assert [c for c, _ in explained] == [1, 2, 3, 4]
    assert [e for _, e in explained] == pytest.approx([both, both, rest, rest], abs=1e-3)
    assert max(r.identity_error for r in rows) < 1e-9


def test_whitening_without_spread_or_rows(spark):
    same = embeddings(spark, [(i, [1.0, 2.0]) for i in range(5)])
    assert embedding_whitening.whiten(same).count() == 0
    assert embedding_whitening.whiten(same.filter("false")).count() == 0
    assert embedding_whitening.whiten(embeddings(spark, [(1, None), (2, [])])).count() == 0


def test_whitening_of_very_large_entries(spark):
    rows = [(i, [float(1e15 * i), float(i % 3)]) for i in range(7)]
    out = embedding_whitening.whiten(embeddings(spark, rows), count=1).collect()
    assert len(out) == 7 and all(r.deviation is None or r.deviation >= 0 for r in out) and any(r.deviation is None for r in out)
    assert abs(out[0].explained - 1) < 1e-9


def test_whitening_query(spark):
    rows = queries.op12(spark, SMALL).collect()
    given = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    check_whitened(rows, {i: v for i, v in given.items() if v and all(c is not None and np.isfinite(c) for c in v)}, 16)


# ---------------------------------------------------------------- fingerprints

def plain_fingerprint(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i:i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components_of(prints, bits=2):
    """Smallest place reachable by links, of each place."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


TEXTS = [(1, None), (2, ""), (3, " \t\n "), (4, "Word"), (5, "word"), (6, "two words"), (7, "a b c"), (8, "A  b\nc"), (9, "é É ﬁ x\u0085y \x1c z"), (10, "x y " * 30),
         (None, "lonely text of no id at all"), (None, "a b c"), (11, " ".join(f"w{i}" for i in range(150_000))), (12, "日本語 テキスト " * 20), (12, "a b c")]


def texts(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, 1, "f") for i, t in rows], "doc_id long, text string, component_id int, fingerprint string").repartition(3)


def test_fingerprints_and_classes(spark):
    got = sorted((r.doc_id or -1, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in simhash.near_duplicates(texts(spark)).collect())
    prints = [plain_fingerprint(t) for _, t in TEXTS]
    of = plain_components_of(prints)
    least = {c: min([i for (i, _), o in zip(TEXTS, of, strict=True) if o == c and i is not None], default=-1) for c in of}
    assert got == sorted((i or -1, f"{p:016x}", least[c]) for (i, _), p, c in zip(TEXTS, prints, of, strict=True))
    assert simhash.near_duplicates(texts(spark).filter("false")).count() == 0


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(4000))
    whole = simhash.fingerprint(text, 3)
    monkeypatch.setattr(simhash, "_COUNTED_AT_ONCE", 7)
    assert simhash.fingerprint(text, 3) == whole == plain_fingerprint(text)


def test_postings_share_the_guaranteed_bytes():
    for bits in (2, 4):
        keys = simhash.postings(bits)
        for flipped in combinations(range(8), bits):
            assert any(not set(flipped) & set(k) for k in keys)


@pytest.mark.parametrize("bits", [2, 4])
@pytest.mark.parametrize("longest", [1, 3, 1 << 30])
def test_links_join_all_near_fingerprints(spark, bits, longest):
    """Chains, clouds around one fingerprint, far ones; short and long lists lead to the same classes."""
    rng = random.Random(11)
    prints = {0, (1 << 64) - 1}
    for _ in range(6):
        centre = rng.getrandbits(64)
        prints |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(25)}
        for _ in range(8):
            centre ^= sum(1 << b for b in rng.sample(range(64), bits))
            prints.add(centre)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(s,) for s in signed], "print long"), bits, longest).collect()
    place = {s: i for i, s in enumerate(signed)}
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for r in found:
        assert bin(prints[place[r.src]] ^ prints[place[r.dst]]).count("1") <= bits  # every link is one
        a, b = find(place[r.src]), find(place[r.dst])
        parent[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(prints))] == plain_components_of(prints, bits)


def test_simhash_query(spark):
    rows = {r.doc_id: r for r in queries.op13(spark, SMALL).collect()}
    given = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    prints = [plain_fingerprint(t) for _, t in given]
    of = plain_components_of(prints)
    for (i, _), p, c in zip(given, prints, of, strict=True):
        assert (rows[i].fingerprint, rows[i].component_id) == (f"{p:016x}", given[c][0])
