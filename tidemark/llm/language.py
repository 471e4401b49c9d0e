"""Language identification by Bayesian evidence fusion.

Four kinds of evidence meet as log probabilities over the languages of the model:

* text: multinomial likelihoods of hashed letter trigrams, fitted on a bounded sample of
  labelled documents and tempered, as trigrams of one text are not independent;
* the language declared in the markup, right with probability ``TRUST``;
* the address suffix, a country code that belongs to a language;
* the host: how its other pages' texts read, a prior smoothed through its levels. A host's
  shares are pulled to its domain's, those to the suffix's, those to all pages', each by
  ``STRENGTH`` pages. The sums per level are grouped aggregations of the text posteriors.

A text alone is the case without the other three. The languages of the model are a closed
set in which one always looks best, so a text also has to fit its language: its mean log
likelihood per trigram may not lie below a floor, fitted per language on texts held out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import set_aside, ship_package, small, stored
from tidemark.llm.url_lists import url_host

#: Documents of each language the trigram model is fitted on at most; slots of a trigram's hash; pseudo-counts.
SAMPLE, SLOTS, SMOOTHING = 5_000, 1 << 14, 0.5
#: Share of a trigram's evidence that counts; trust in the markup; pages a parent level weighs.
TEMPER, TRUST, STRENGTH = 0.25, 0.9, 10.0
#: A text is rejected if no language reaches this probability, or if it has no letters.
ACCEPT = 0.5
#: Standard deviations that a text's mean log likelihood may lie below the median of its language.
SLACK = 10.0
#: Country codes whose pages are mostly in one language (fixed values).
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "uk": "en", "us": "en", "au": "en"}
NOT_LETTERS = re.compile(r"[\W\d_]+")


def trigram_slots(text: str) -> np.ndarray:
    """Hash slots of all letter trigrams of the whole text; words are framed by blanks."""
    words = NOT_LETTERS.sub(" ", text.lower()).strip()
    if not words:
        return np.zeros(0, np.int64)
    code = np.frombuffer(f" {words} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    mixed = (code[:-2] * np.uint64(0x9E3779B1) + code[1:-1] * np.uint64(0x85EBCA77) + code[2:] * np.uint64(0xC2B2AE3D)) & np.uint64(0xFFFFFFFF)
    return ((mixed ^ mixed >> np.uint64(15)) % np.uint64(SLOTS)).astype(np.int64)


@dataclass
class TrigramModel:
    languages: list[str]
    weights: np.ndarray  # log likelihood, languages x slots
    # Mean log likelihood per trigram of held-out texts: median, variance between texts, variance within
    usual: np.ndarray = field(default_factory=lambda: np.zeros((0, 3)))

    def log_likelihood(self, text: str) -> np.ndarray | None:
        """Tempered log likelihood of a text in each language; None without letters."""
        slots = trigram_slots(text)
        if not len(slots):
            return None
        return TEMPER * (self.weights @ np.bincount(slots, minlength=SLOTS))

    def fits(self, score: np.ndarray, trigrams: int) -> np.ndarray:
        """Whether a text of so many trigrams and this ``log_likelihood`` reads like texts of each language."""
        median, between, within = self.usual.T
        # Halfway to even slots at least, so that long texts with foreign passages stay.
        floor = np.minimum(median - SLACK * np.sqrt(between + within / trigrams), (median - math.log(SLOTS)) / 2)
        return score / TEMPER / trigrams >= floor

    def posterior(self, text: str, log_prior: np.ndarray | None = None) -> np.ndarray | None:
        score = self.log_likelihood(text)
        if score is None:
            return None
        return softmax(score if log_prior is None else score + log_prior)


def softmax(score: np.ndarray) -> np.ndarray:
    e = np.exp(score - score.max())
    return e / e.sum()


def fit_trigrams(documents: DataFrame, sample: int = SAMPLE) -> TrigramModel:
    """Fit on at most ``sample`` labelled documents (text, lang) of each language, picked by a hash.

    Counting runs where the documents are; the driver gets one row per language. Documents
    without language or text teach nothing; without any, the model knows no language. What is
    usual in a language is measured on each half of its documents with the counts of the other.
    """
    ship_package(documents.sparkSession)
    some = documents.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    # Of a language with many documents twice the sample goes on, so that no task ranks more.
    large = some.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") > 2 * sample).collect()
    spread = F.pmod(F.col("hash"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = some.withColumn("hash", F.xxhash64("doc_id", "text"))
    if large:
        share = F.create_map(*[F.lit(x) for r in large for x in (r["lang"], 2.0 * sample / r["n"])])[F.col("lang")]
        some = some.where(spread <= F.coalesce(share, F.lit(1.0)))
    order = Window.partitionBy("lang").orderBy("hash", "doc_id", "text")
    picked = some.withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], np.ndarray] = {}
        for batch in small(batches):
            for language, half, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "half", "text"))):
                held = seen.setdefault((language, half), np.zeros(SLOTS, np.int64))
                held += np.bincount(trigram_slots(text), minlength=SLOTS)
        for (language, half), held in seen.items():
            at = np.flatnonzero(held)
            yield pa.record_batch({"lang": pa.array([language] * len(at)), "slot": pa.array(half * SLOTS + at, pa.int64()), "n": pa.array(held[at], pa.int64())})

    half = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(2)).cast("int")  # copies of a text stay together
    taught = stored(picked.select("lang", half.alias("half"), "text"), "language-sample")
    counted = taught.mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    rows = counted.groupBy("lang").agg(F.collect_list(F.struct("slot", "n")).alias("c")).orderBy("lang").collect()
    table = np.zeros((len(rows), 2 * SLOTS))
    for line, row in zip(table, rows):
        pairs = np.array([(c["slot"], c["n"]) for c in row["c"]], np.int64).reshape(-1, 2)
        np.add.at(line, pairs[:, 0], pairs[:, 1])
    halves = table.reshape(-1, 2, SLOTS)
    languages = [r["lang"] for r in rows]
    return TrigramModel(languages, log_shares(halves.sum(axis=1)), usual_likelihood(taught, languages, log_shares(halves[:, ::-1])))


def log_shares(counts: np.ndarray) -> np.ndarray:
    smooth = counts + SMOOTHING
    return np.log(smooth / smooth.sum(axis=-1, keepdims=True))


def usual_likelihood(taught: DataFrame, languages: list[str], held_out: np.ndarray) -> np.ndarray:
    """A row per language: median, variance between and within texts of the mean log likelihood per trigram.

    ``held_out`` (languages x 2 x slots) has for each half of ``taught`` (lang, half, text) the
    weights of the other. A language with texts in one half only has even weights for them.
    The variance between texts comes from the quartiles, which odd texts do not move.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {x: i for i, x in enumerate(languages)}
        for batch in small(batches):
            found = []
            for language, half, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "half", "text"))):
                slots = trigram_slots(text)
                if language in place and len(slots):
                    each = held_out[place[language], half][slots]
                    found.append((language, float(each.mean()), float(each.var())))
            if found:
                yield pa.record_batch([pa.array(c) for c in zip(*found)], names=["lang", "mean", "variance"])

    measured = taught.mapInArrow(measure, "lang string, mean double, variance double").groupBy("lang").agg(
        F.percentile_approx("mean", [0.25, 0.5, 0.75]).alias("q"), F.avg("variance").alias("within")
    )
    usual = {r["lang"]: (r["q"][1], ((r["q"][2] - r["q"][0]) / 1.349) ** 2, r["within"]) for r in measured.collect()}
    return np.array([usual.get(x, (-math.log(SLOTS), 0.0, 0.0)) for x in languages]).reshape(-1, 3)


def text_posteriors(rows: DataFrame, model: TrigramModel, whole: bool = False) -> DataFrame:
    """``rows`` (any columns, ``text``) with ``text_log``: log posterior by text alone, null without letters.

    With ``whole``, ``text`` stays, and ``text_fits`` says for each language whether the text reads like one of its texts.
    """
    fields = [f for f in rows.schema.fields if whole or f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            if batch.num_rows:
                found = [model.log_likelihood(t or "") if model.languages else None for t in batch.column("text").to_pylist()]
                logs = [None if s is None else np.log(np.maximum(softmax(s), 1e-12)) for s in found]
                columns = {f.name: batch.column(f.name) for f in fields} | {"text_log": pa.array(logs, pa.list_(pa.float64()))}
                if whole:
                    long = [len(trigram_slots(t or "")) for t in batch.column("text").to_pylist()]
                    columns["text_fits"] = pa.array([None if s is None else model.fits(s, n).tolist() for s, n in zip(found, long)], pa.list_(pa.bool_()))
                yield pa.record_batch(columns)

    wanted = [f"`{f.name}`" for f in fields] + ([] if whole else ["text"])
    return rows.select(*wanted).mapInArrow(run, f"{schema}, text_log array<double>" + (", text_fits array<boolean>" if whole else ""))


def detect(documents: DataFrame, model: TrigramModel) -> DataFrame:
    """``documents`` with predicted_lang and lang_prob by the text alone; both null if it has no letters."""
    columns = [c for c in documents.columns if c not in ("predicted_lang", "lang_prob")]
    fields = {f.name: f.dataType.simpleString() for f in documents.schema.fields}
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            if batch.num_rows:
                found = [model.posterior(t or "") if model.languages else None for t in batch.column("text").to_pylist()]
                yield pa.record_batch([
                    *(batch.column(c) for c in columns), pa.array([None if p is None else model.languages[int(p.argmax())] for p in found], pa.string()),
                    pa.array([None if p is None else float(p.max()) for p in found], pa.float64()),
                ], names=[*columns, "predicted_lang", "lang_prob"])

    return documents.select(*columns).mapInArrow(run, ", ".join(f"`{c}` {fields[c]}" for c in columns) + ", predicted_lang string, lang_prob double")


def keep_identified(documents: DataFrame, model: TrigramModel, accept: float = ACCEPT) -> DataFrame:
    """The rows whose text is in one of the languages with probability ``accept`` or more, all columns as they are.

    The probability fuses the text, the declared ``lang`` and a prior of the ``source``, how
    its texts read, pulled to that of all by ``STRENGTH`` texts; either column may be missing.
    Texts without letters go, and texts that do not fit the language found, whatever is
    declared. Texts that fit no language count for no source. A model without languages keeps
    everything.
    """
    n = len(model.languages)
    if not n:
        return documents
    columns = documents.columns
    source = F.col("source").cast("string") if "source" in columns else F.lit(None).cast("string")
    claim = F.col("lang") if "lang" in columns else F.lit(None).cast("string")
    read = text_posteriors(documents.select(source.alias("of"), "text"), model, whole=True).where("exists(text_fits, x -> x)")
    levels = stored(read.groupBy("of").agg(*[F.sum(F.exp(F.col("text_log")[i])).alias(f"h{i}") for i in range(n)]), "source-shares")
    even = even_shares(levels, n)
    prior = F.array(*smoothed([F.col(f"h{i}") for i in range(n)], [F.lit(e) for e in even]))
    priors = levels.where("of is not null").select("of", prior.alias("of_prior"))
    rows, given = set_aside(documents, ["text"], of=source, claim=claim)
    rows = text_posteriors(rows, model, whole=True).join(priors, "of", "left")
    score = fused(F.coalesce("of_prior", F.array(*map(F.lit, even))), F.col("text_log"), [F.col("claim")], model.languages)
    best = F.array_max("fused_score")
    fits = F.element_at("text_fits", F.array_position("fused_score", best).cast("int"))
    sure = 1 / F.aggregate("fused_score", F.lit(0.0), lambda a, s: a + F.exp(s - best)) >= accept
    return rows.where("text_log is not null").withColumn("fused_score", score).where(sure & fits).select(*given)


def smoothed(sums: list[Column], parent: list[Column]) -> list[Column]:
    """Shares of a level, pulled to its parent's by ``STRENGTH`` texts."""
    whole = sum(sums[1:], sums[0])
    return [(s + STRENGTH * p) / (whole + STRENGTH) for s, p in zip(sums, parent)]


def even_shares(levels: DataFrame, n: int) -> list[float]:
    """Shares of all texts by the sums h0, h1... of ``levels``, with one more text per language."""
    total = levels.agg(*[F.coalesce(F.sum(f"h{i}"), F.lit(0.0)).alias(f"g{i}") for i in range(n)]).first()
    return [(total[i] + 1.0) / (sum(total) + n) for i in range(n)]


def fused(prior: Column, text_log: Column, claims: list[Column], languages: list[str]) -> Column:
    """Log probabilities, not yet summing to one, by a prior, the text and any claims; what is null is missing."""

    def named(claim: Column, language: str) -> Column:
        """Log probability of a claim if the page is in ``language``; 0 without a claim the model knows."""
        right, wrong = math.log(TRUST), math.log((1 - TRUST) / max(1, len(languages) - 1))
        return F.when(claim.isin(languages), F.when(claim == language, right).otherwise(wrong)).otherwise(0.0)

    return F.array(*[sum((named(c, x) for c in claims), F.log(prior[i]) + F.coalesce(text_log[i], F.lit(0.0))) for i, x in enumerate(languages)])


def markup_text(html: Column) -> Column:
    """Visible text: scripts, styles, comments and tags go."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"&[a-zA-Z#0-9]+;", " ")


def markup_language(html: Column) -> Column:
    """Primary subtag of the declared language; null if there is none."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1))
    return F.when(found != "", found)


def fuse(pages: DataFrame, model: TrigramModel) -> DataFrame:
    """(page_id, host, declared, text_lang, language, probability) of pages (page_id, url, html).

    A page without letters, markup language and host gets the shares of all pages; a null
    address or html is missing evidence. Without any page that has letters the host prior is
    even. Pages that repeat count as often as they are. With a model without languages,
    language and probability are null.
    """
    n = len(model.languages)
    host = url_host(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), markup_language(F.col("html")).alias("declared"), markup_text(F.col("html")).alias("text"))
    rows = stored(text_posteriors(rows, model), "page-texts")
    if not n:
        return rows.select("page_id", "host", "declared", *(F.lit(None).cast(k).alias(c) for c, k in (("text_lang", "string"), ("language", "string"), ("probability", "double"))))
    labels = F.split("host", "[.]")
    rows = rows.withColumn("suffix", F.element_at(labels, -1)).withColumn("domain", F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.col("host")))
    shares = [F.exp(F.col("text_log")[i]) for i in range(n)]
    levels = rows.where("text_log is not null and host is not null").groupBy("suffix", "domain", "host").agg(*[F.sum(s).alias(f"h{i}") for i, s in enumerate(shares)])
    levels = stored(levels, "host-shares")
    even = even_shares(levels, n)
    by_suffix = levels.groupBy("suffix").agg(*[F.sum(f"h{i}").alias(f"s{i}") for i in range(n)])
    by_domain = levels.groupBy("suffix", "domain").agg(*[F.sum(f"h{i}").alias(f"d{i}") for i in range(n)])
    of_suffix = by_suffix.select("suffix", *[c.alias(f"ps{i}") for i, c in enumerate(smoothed([F.col(f"s{i}") for i in range(n)], [F.lit(e) for e in even]))])
    of_domain = by_domain.join(of_suffix, "suffix").select("domain", "suffix", *[c.alias(f"pd{i}") for i, c in enumerate(smoothed([F.col(f"d{i}") for i in range(n)], [F.col(f"ps{i}") for i in range(n)]))])
    of_host = levels.join(of_domain, ["suffix", "domain"]).select("host", F.array(*smoothed([F.col(f"h{i}") for i in range(n)], [F.col(f"pd{i}") for i in range(n)])).alias("prior"))
    prior = F.coalesce("prior", F.array(*map(F.lit, even)))
    nation = F.create_map(*[F.lit(x) for pair in SUFFIX_LANGUAGE.items() for x in pair])[F.col("suffix")]
    score = fused(F.col("prior"), F.col("text_log"), [F.col("declared"), F.col("nation")], model.languages)
    best = F.array_max("score")
    place = F.array_position("score", best).cast("int")
    name = F.array(*map(F.lit, model.languages))
    top = F.array_max("text_log")
    return (
        rows.join(of_host, "host", "left").withColumn("prior", prior).withColumn("nation", nation).withColumn("score", score)
        .select(
            "page_id", "host", "declared", F.element_at(name, F.array_position("text_log", top).cast("int")).alias("text_lang"),
            F.element_at(name, place).alias("language"),
            (1 / F.aggregate("score", F.lit(0.0), lambda a, s: a + F.exp(s - best))).alias("probability"),
        )
    )


def op7_language_fusion(spark: SparkSession, documents: DataFrame, pages: DataFrame) -> DataFrame:
    return fuse(pages, fit_trigrams(documents))
