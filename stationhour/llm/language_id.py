"""Language of a text from several kinds of evidence, fused by Bayes' rule.

* Text: a multinomial over hashed byte trigrams for each language, learnt from all texts that declare it.
* Declared language (a markup attribute or a column): how often texts of a language declare what, counted over the corpus.
* Address suffix and host: priors smoothed from the host to its suffix and from the suffix to all texts, as weighted counts by
  grouped aggregation.

Rejected are texts that a background of even trigrams, of small prior, explains better than every language does, and those
whose best language stays below the least confidence.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stationhour.llm import vectors as V
from stationhour.llm.staging import free_name
from stationhour.session import write_shared

# What texts are held against where none declares a language.
LANGUAGES = ("de", "en", "es", "fr")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _trigrams(data: np.ndarray, bounds: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of each byte trigram, A-Z lower-cased, everything but letters one blank."""
    n = len(data) - 2
    if n <= 0:
        return (np.empty(0, np.int64),) * 2
    plain = np.where(_LETTER[data], _LOWER[data], np.uint8(32)).astype(np.uint32)
    code = plain[:n] << 16 | plain[1:n + 1] << 8 | plain[2:]
    keep = V.window_starts(bounds, len(data), 3) & ~((plain[1:n + 1] == 32) & ((plain[:n] == 32) | (plain[2:] == 32)))
    at = np.flatnonzero(keep)
    bucket = (V.mix(code[at].astype(np.uint64)) >> np.uint64(40)).astype(np.int64) % buckets
    return bucket, np.searchsorted(bounds, at, "right") - 1


def normal_language(declared: Column) -> Column:
    """The primary part of a language tag in lower case; blank is null."""
    tag = F.lower(F.regexp_extract(F.trim(declared.cast("string")), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.when(F.length(tag) > 0, tag)


def learn(docs: DataFrame, text: str, declared: str, languages: Sequence[str], buckets: int) -> np.ndarray:
    """Counts of the trigrams, a row for each language; from every text that declares it."""
    languages = list(languages)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages) + 1, buckets), np.int64)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            known = pd.Categorical(batch.column(1).to_pandas(), categories=languages).codes.astype(np.int64)
            for a, b, data, bounds in V.slices(table, text):
                bucket, doc = _trigrams(data, bounds, buckets)
                flat = (known[a:b][doc] + 1) * buckets + bucket
                total += np.bincount(flat, minlength=total.size).reshape(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(languages)), pa.int32()), pa.array([x.tobytes() for x in total[1:]], pa.binary())],
                                         names=["number", "counts"])

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"number": [key[0]], "counts": [sum(np.frombuffer(x, np.int64) for x in rows.counts).tobytes()]})

    sums = docs.select(text, declared).mapInArrow(count, "number int, counts binary").groupBy("number").applyInPandas(add, "number int, counts binary")
    table = np.zeros((len(languages), buckets))
    for r in sums.collect():  # one row a language
        table[r.number] = np.frombuffer(r.counts, np.int64)
    return table


def even_out(counts: np.ndarray) -> np.ndarray:
    """Probabilities of the trigrams from their counts."""
    return (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * counts.shape[1])


def distinct(counts: np.ndarray, texts: Sequence[int], least: float = 0.1, rounds: int = 50) -> list[int]:
    """Rows that no mixture of the other rows explains: languages, without other names of them and declarations on texts of all kinds.

    Smaller rows are tried first. The distance is in nats a trigram, less what chance makes of it in a row of so many trigrams
    and ``texts``, each of which repeats words of its own.
    """
    part = even_out(counts)
    kept = [i for i in range(len(counts)) if counts[i].any()]
    for i in sorted(kept, key=lambda i: counts[i].sum()):
        others = part[[j for j in kept if j != i]]
        if not len(others):
            break
        at = np.flatnonzero(counts[i])
        own, others = counts[i, at] / counts[i].sum(), others[:, at]
        share = np.full(len(others), 1 / len(others))
        for _ in range(rounds):
            share = share * (others @ (own / (share @ others)))
        if (own * np.log(own / (share @ others))).sum() - (len(at) - 1) / (2 * counts[i].sum()) - 3 / texts[i] < least:
            kept.remove(i)
    return kept


def declared_languages(docs: DataFrame, declared: str, texts: int = 5) -> dict[str, int]:
    """Values that at least ``texts`` rows declare, in order, and by how many rows; tags of two or three letters, a row each."""
    found = docs.filter(F.col(declared).isNotNull()).groupBy(declared).count().filter(F.col("count") >= texts)
    return dict(sorted(tuple(r) for r in found.collect()))


def identify(docs: DataFrame, text: str = "text", declared: Column | None = None, suffix: Column | None = None,
             host: Column | None = None, languages: Sequence[str] | None = None, buckets: int = 1 << 14, strength: float = 10.0,
             temper: float = 0.34, least: float = 0.5, noise: float = 1e-3) -> DataFrame:
    """``docs`` with predicted_lang, confidence (its posterior) and accepted.

    ``declared``, ``suffix`` and ``host`` are columns with further evidence, null where there is none; ``strength`` is how many
    texts a parent's prior weighs, ``temper`` scales the text's evidence as trigrams overlap, ``noise`` is the background's prior. Null, empty and letterless texts carry no text
    evidence and are rejected with the language their other evidence favours. ``languages`` are learnt if not given: the declared
    values of at least five texts which no mixture of the others explains. Other declared values count as one more value. Repeated rows get equal answers. Input columns with the names of the result are replaced; rows are kept as they are, repeated
    ones too. Where no text declares a language, all are taken as equal.
    """
    made = {"predicted_lang", "confidence", "accepted"}
    columns = [c for c in docs.columns if c.lower() not in made]
    d, s, h, like, n = (free_name(docs.columns, x) for x in ("__declared", "__suffix", "__host", "__like", "__grams"))
    null = F.lit(None).cast("string")
    given = docs.withColumns({d: normal_language(declared if declared is not None else null),
                              s: (suffix if suffix is not None else null).cast("string"),
                              h: (host if host is not None else null).cast("string")}).select(*columns, d, s, h)
    texts = declared_languages(given, d) if languages is None else {}
    found = list(texts if languages is None else languages)
    counts = learn(given, text, d, found or LANGUAGES, buckets)
    rows = range(len(found)) if languages is not None else distinct(counts, list(texts.values()))
    languages = [found[i] for i in rows] or list(LANGUAGES)
    model = np.log(even_out(counts[list(rows)] if len(rows) else counts if not found else np.zeros((len(LANGUAGES), buckets))))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema)
    even, names = -np.log(buckets), [*given.columns, like, n]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for a, b, data, bounds in V.slices(table, text):
                bucket, doc = _trigrams(data, bounds, buckets)
                values = np.stack([np.bincount(doc, weights=w[bucket] - even, minlength=b - a) for w in model], axis=1) * temper
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns, pa.ListArray.from_arrays(np.arange(0, values.size + 1, len(languages), dtype=np.int32), pa.array(values.reshape(-1))),
                     pa.array(np.bincount(doc, minlength=b - a).astype(np.int64))], names=names)

    # texts are scored where they are read; what the priors need is the evidence of each row without its text
    scored = given.mapInArrow(score, f"{fields}, {like} array<double>, {n} long")
    top = F.array_max(like)
    soft = F.transform(like, lambda x: F.exp(x - top))
    part = F.transform(soft, lambda x: x / F.aggregate(soft, F.lit(0.0), lambda a, y: a + y))
    counted = [F.sum(F.when(F.col(n) > 0, part[i]).otherwise(0.0)).alias(f"l{i}") for i in range(len(languages))]
    known = F.when(F.col(d).isin(languages), F.col(d)).when(F.col(d).isNotNull(), F.lit("other"))
    sums = write_shared(scored.groupBy(F.col(s).alias("suffix"), F.col(h).alias("host"), known.alias("said")).agg(*counted), "language_counts")
    weights = [f"l{i}" for i in range(len(languages))]

    def added(*keys):
        return sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in weights])

    # declared values: at most one row a language and two more
    said = {r.said: np.array([r[c] for c in weights]) for r in added("said").collect()}
    everything = sum(said.values(), np.zeros(len(languages)))
    base = [F.lit(float(x)) for x in (everything + 1) / (everything.sum() + len(languages))]
    # a value that all its declared texts agree on says much, one spread over the languages says little
    evidence = {x: np.log((said[x] + 0.1) / (everything + 0.1 * (len(languages) + 2))) for x in [*languages, "other"] if x in said}

    def smoothed(parent: list[Column]) -> Column:
        total = sum(map(F.col, weights[1:]), F.col(weights[0]))
        return F.array(*[(F.col(c) + strength * p) / (total + strength) for c, p in zip(weights, parent, strict=True)])

    s2, of_suffix, s3, h3, of_host = (free_name(docs.columns, x) for x in ("__s2", "__of_suffix", "__s3", "__h3", "__of_host"))
    by_suffix = added("suffix").filter(F.col("suffix").isNotNull()).select(F.col("suffix").alias(s2), smoothed(base).alias(of_suffix))
    hosts = added("suffix", "host").filter(F.col("host").isNotNull()).join(by_suffix, F.col("suffix") == F.col(s2), "left")
    parent = [F.coalesce(F.col(of_suffix)[i], base[i]) for i in range(len(languages))]
    by_host = hosts.select(F.col("suffix").alias(s3), F.col("host").alias(h3), smoothed(parent).alias(of_host))
    by_suffix, by_host = _small(by_suffix, "suffix_priors"), _small(by_host, "host_priors")

    joined = (scored.join(by_suffix, F.col(s) == F.col(s2), "left")
              .join(by_host, F.col(s).eqNullSafe(F.col(s3)) & (F.col(h) == F.col(h3)), "left"))
    prior = F.coalesce(of_host, of_suffix, F.array(*base))
    said_by = F.array(*[F.lit(0.0)] * len(languages))
    for x, p in evidence.items():
        said_by = F.when(known == x, F.array(*[F.lit(float(v)) for v in p])).otherwise(said_by)
    post = free_name(docs.columns, "__post")
    total = F.zip_with(F.zip_with(like, prior, lambda x, y: x + F.log(y)), said_by, lambda x, y: x + y)
    best = F.array_position(post, F.array_max(post)).cast("int")
    weight = F.aggregate(F.transform(post, lambda x: F.exp(x - F.array_max(post))), F.lit(0.0), lambda a, y: a + y)
    return (joined.withColumn(post, total)
            .withColumn("predicted_lang", F.element_at(F.array(*[F.lit(x) for x in languages]), best))
            .withColumn("confidence", 1.0 / weight)
            .withColumn("accepted", (F.col(n) > 0) & (F.array_max(like) > float(np.log(noise))) & (F.col("confidence") >= least))
            .select(*columns, "predicted_lang", "confidence", "accepted"))


def _small(priors: DataFrame, name: str, rows: int = 100_000) -> DataFrame:
    """Written priors; broadcast if they have few ``rows``, else joined as the planner sees fit (it splits hot hosts)."""
    written = write_shared(priors, name)
    return F.broadcast(written) if written.count() <= rows else written


def page_evidence(html: Column, url: Column) -> tuple[Column, Column, Column]:
    """(declared language, address suffix, host) of web pages."""
    tag = F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z_-]+)", 1)
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    host = F.when(F.length(host) > 0, host)
    return F.when(F.length(tag) > 0, tag), F.regexp_extract(host, r"([^.]+)$", 1), host
