"""Language of web pages from several kinds of evidence."""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import quoted, staged, text_or_empty, with_package

#: Hashed byte trigrams that the text model tells apart.
TRIGRAMS = 1 << 16
#: A text speaks as so many independent trigrams at most; neighbouring trigrams overlap.
TEXT_WEIGHT = 40.0
#: Pages that a host's own counts must outweigh, and a domain's.
HOST_WEIGHT = 5.0
DOMAIN_WEIGHT = 10.0

HIDDEN = re.compile(r"<(script|style|template|noscript)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
TAG = re.compile(r"<[^>]*>")
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]+)", re.I)


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-case text's bytes, white space runs as one blank."""
    octets = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode(), np.uint8).astype(np.uint32)
    if len(octets) < 3:
        return np.zeros(0, np.int64)
    mixed = (octets[:-2] << 16 | octets[1:-1] << 8 | octets[2:]) * np.uint32(2654435761)
    return (mixed >> np.uint32(16)).astype(np.int64)


def visible(page: str) -> str:
    return markup.unescape(TAG.sub(" ", HIDDEN.sub(" ", page)))


def declared(page: str) -> str:
    found = DECLARED.search(page)
    return found[1].lower() if found else "none"


def address(url: str) -> tuple[str, str, str]:
    """Host, domain (its last two labels) and suffix; empty where the address has none."""
    try:
        host = (urlsplit(url if "//" in url else "//" + url).hostname or "").rstrip(".")
    except ValueError:
        host = ""
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1]


def fit_texts(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities of trigrams in each, from all labelled texts.

    Tasks count trigrams per language; a grouped sum adds them, and one number per trigram and
    language is collected. Texts without a language are left out.
    """
    with_package(docs.sparkSession)
    rows = docs.select(F.col(quoted(lang_column)).cast("string").alias("lang"), text_or_empty(text_column).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                own = seen.setdefault(lang, np.zeros(TRIGRAMS, np.int64))
                at, n = np.unique(trigrams(text), return_counts=True)
                own[at] += n
        for lang, own in seen.items():
            used = np.nonzero(own)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used)), pa.array(used), pa.array(own[used])], ["lang", "cell", "n"]
            )

    sums = rows.where("lang is not null").mapInArrow(count, "lang string, cell bigint, n bigint")
    sums = sums.groupBy("lang", "cell").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r.lang for r in sums})
    counts = np.full((len(langs), TRIGRAMS), 0.5)
    place = {lang: k for k, lang in enumerate(langs)}
    for row in sums:
        counts[place[row.lang], row.cell] += row.n
    return langs, np.log(counts / counts.sum(1, keepdims=True))


def identify_languages(
    pages: DataFrame,
    docs: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    lang_column: str = "lang",
    text_column: str = "text",
) -> DataFrame:
    """Posterior language of every page, fused from text, markup, address suffix and host.

    The text model comes from ``docs`` (labelled texts), tempered by ``TEXT_WEIGHT``. By the texts'
    votes over all pages, grouped counts give how each declared language and each suffix go with a
    language, and a prior per host, smoothed towards its domain's and that towards all
    pages'; a page's own vote is left out of its prior. Evidence is added up as logarithms. Returns ``id``,
    ``lang``, ``probability``, ``text_lang``, ``declared``, ``suffix`` and ``host``.

    Pages are parsed once; after that only ids, names and a number per language move. Counts are
    combined on the map side, so a host with a third of the pages is one row per task, and written before the
    join that brings them back: both of its sides are plain exchanges then, and adaptive execution splits the host.

    Defined cases: a page without text is judged by the rest; without address or declaration these count
    as values of their own; null columns are empty; repeated rows are judged alike; of equally likely languages the
    first by name counts; a page of any length is judged by all of its text; no labelled text gives
    pages without language (``und``, probability 0); an empty table gives an empty table.
    """
    spark = with_package(pages.sparkSession)
    langs, table = fit_texts(docs, lang_column, text_column)
    model = spark.sparkContext.broadcast(table.astype(np.float32))
    rows = pages.select(
        F.col(quoted(id_column)).cast("bigint").alias("id"), text_or_empty(url_column).alias("url"), text_or_empty(html_column).alias("html")
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, url, page in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "html"))):
                found = trigrams(visible(page))
                scores = np.zeros(len(langs))
                if len(found) and langs:
                    scores = model.value[:, found].astype(np.float64).mean(1) * min(TEXT_WEIGHT, len(found))
                    scores -= scores.max()
                best = langs[int(scores.argmax())] if len(found) and langs else None
                out.append((doc, *address(url), declared(page), best, scores.tolist()))
            types = [pa.int64(), *[pa.string()] * 5, pa.list_(pa.float64())]
            columns = zip(*out) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], PARSED)

    parsed = staged(
        rows.mapInArrow(parse, "id bigint, host string, domain string, suffix string, declared string, text_lang string, scores array<double>"),
        "pages",
    )
    if not langs:
        return parsed.select("id", F.lit("und").alias("lang"), F.lit(0.0).alias("probability"), "text_lang", "declared", "suffix", "host")
    votes = parsed.groupBy("host", "domain", "suffix", "declared", "text_lang").count()
    votes = staged(votes.where("text_lang is not null"), "votes")
    known = F.array(*[F.lit(lang) for lang in langs])

    def tallies(*keys: str) -> DataFrame:
        """Votes per key as an array in the order of ``langs``."""
        cells = [F.sum(F.when(F.col("text_lang") == lang, F.col("count")).otherwise(0)) for lang in langs]
        return staged(votes.groupBy(*keys).agg(F.array(*cells).alias("n_" + keys[0])), "tallies")

    overall = votes.groupBy("text_lang").agg(F.sum("count").alias("n")).collect()
    seen = {r.text_lang: r.n for r in overall}
    base = [(seen.get(lang, 0) + 1) / (sum(seen.values()) + len(langs)) for lang in langs]
    total = F.array(*[F.lit(float(seen.get(lang, 0))) for lang in langs])
    base_column = F.array(*[F.lit(b) for b in base])
    joined = parsed
    for keys in (("host",), ("domain",), ("suffix",), ("declared",)):
        joined = joined.join(tallies(*keys), keys[0], "left")
    none = F.array(*[F.lit(0).cast("bigint") for _ in langs])
    own = F.transform(known, lambda lang: F.when(lang == F.col("text_lang"), 1).otherwise(0))
    for name in ("n_host", "n_domain", "n_suffix", "n_declared"):
        joined = joined.withColumn(name, F.zip_with(F.coalesce(name, none), own, lambda n, o: (n - o).cast("double")))

    def smoothed(counts, prior, weight: float):
        size = F.aggregate(counts, F.lit(0.0), lambda a, n: a + n)
        return F.zip_with(counts, prior, lambda n, p: (n + weight * p) / (size + weight))

    def association(counts):
        """P(value | language) up to a factor that all languages share, from votes for it and for all."""
        return F.zip_with(counts, total, lambda n, t: F.log((n + 0.5) / (t + 1.0)))

    joined = joined.withColumn("domain_prior", smoothed(F.col("n_domain"), base_column, DOMAIN_WEIGHT))
    joined = joined.withColumn("prior", F.transform(smoothed(F.col("n_host"), F.col("domain_prior"), HOST_WEIGHT), lambda p: F.log(p)))
    plus = lambda a, b: a + b
    evidence = F.zip_with("scores", "prior", plus)
    for name in ("n_suffix", "n_declared"):
        evidence = F.zip_with(evidence, association(F.col(name)), plus)
    joined = joined.withColumn("evidence", evidence).withColumn("top", F.array_max("evidence"))
    weight = F.aggregate(F.transform("evidence", lambda e: F.exp(e - F.col("top"))), F.lit(0.0), plus)
    at = F.array_position("evidence", F.col("top")).cast("int")
    return joined.select(
        "id", F.element_at(known, at).alias("lang"), (1 / weight).alias("probability"), "text_lang", "declared", "suffix", "host"
    )


PARSED = ["id", "host", "domain", "suffix", "declared", "text_lang", "scores"]
