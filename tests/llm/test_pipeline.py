from __future__ import annotations

import sys
from pathlib import Path

import pytest

import brute
import corpus_pipeline
from stationhour.llm.queries import ORACLES, QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent / "scripts"))

from check_oracles import connect, differences  # noqa: E402

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(name, spark):
    assert differences(QUERIES[name](spark, SMALL), ORACLES[name], connect(SMALL)) == []


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, rows = docs.columns, [(r.doc_id, r.text) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == {i for i, _ in rows}
            break
        assert docs.columns == columns
        got = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "jaccard_join":
            assert {i for i, _ in got} == {c for _, _, c in brute.groups(rows)}
        elif name == "suffix_dedup":
            marks = {i: bytes(x for x, y in zip(w, m) if not y) for i, w, m in brute.covered(rows, lambda t: (t or "").encode(), 50)}
            assert {i: t for i, t in got} == {i: t.decode("utf-8", "ignore") for i, t in marks.items()}
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        else:
            assert {i for i, _ in got} <= {i for i, _ in rows} and len(got) >= 0.8 * len(rows)
        rows = got


ODD = [(1, "A clean text of the usual kind, which is long enough to tell its language by the words that it is made of.", "en", "s"), (2, None, "en", "s"), (3, "", None, None),
       (4, "  ", "en", "s"), (5, "1 2 3", "en", "s"), (None, "Another text without any id that is also long enough to tell what language it is.", "en", None),
       (6, "The very same words again and again in this long text. " * 3000, "en", "s"), (7, "Twice the same row of the table, word for word and id for id, as it may come.", "en", "s"),
       (7, "Twice the same row of the table, word for word and id for id, as it may come.", "en", "s")]


def odd(spark, rows=ODD):
    full = [(i, t, lang, source, len(t or ""), "theirs", 0.5, "mine", 9) for i, t, lang, source in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, accepted string, Confidence double, chunk string, `row` int")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_handle_odd_rows(spark, tmp_path, name, stage):
    odd(spark).repartition(2).write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    out = stage(spark, docs, SMALL)
    rows = out.collect()
    empty = stage(spark, docs.filter("doc_id = -1"), SMALL)
    assert empty.count() == 0
    if name == "packing":
        assert {r.doc_id for r in rows} == {i for i, *_ in ODD} and sum(r.doc_id == 7 and r.start == 0 for r in rows) == 2
        return
    assert out.columns == docs.columns == empty.columns
    assert all((r.accepted, r.Confidence, r.chunk, r["row"]) == ("theirs", 0.5, "mine", 9) for r in rows)
    ids = sorted(str(r.doc_id) for r in rows)
    every = sorted(str(i) for i, *_ in ODD)
    kept = {"language_id": ["1", "6", "7", "7", "None"], "jaccard_join": sorted(set(every))}.get(name, every)
    assert ids == kept


def test_queries_are_registered():
    numbers = {n.split("_")[0] for n in QUERIES}
    assert {f"op{i}" for i in range(1, 14)} <= numbers
