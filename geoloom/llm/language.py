"""Language identification by Bayesian fusion of evidence.

For each row the logarithm of every language's likelihood is summed over
* the text: byte trigrams of its letters under one multinomial per language, all of them,
  tempered so that they count as at most TEXT_EVIDENCE independent trigrams;
* the declared language, from a column or the markup's ``lang`` attribute, and
* the address suffix: how often each value goes with each language, by grouped counts;
* the host: a prior of host, registered domain and all hosts, each smoothed towards the next.
Counts are sums of the posteriors that the text alone gives, over all rows, by map-side
combined aggregation. A row's own share is taken out of its host's counts, so that a host
with one page tells nothing. Texts are read once; what is joined are their scores, with
tables of hosts whose size decides the join. "und" competes as uniform noise.

Defined results
* null or empty text, or one without letters: language "und", not accepted.
* null host, declaration or address: no such evidence; the prior of all hosts applies.
* very long text: every trigram counts, tempered to TEXT_EVIDENCE of them like any longer text.
* a language that too few rows declare: its texts go to the likeliest other language or to
  noise; declared codes still count as evidence.
* null id and repeated rows: one result row each. Ties, equal scores: the first language by code.
* empty table: empty result. Other columns are ignored or, in ``keep_accepted``, kept.
* no labelled row to fit on: every language is uniform, nothing is accepted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import discard, quoted, stash, with_row_key

UND = "und"
#: A language is modelled if at least so many rows and this share of those with a code declare it.
LEAST_ROWS, LEAST_SHARE = 5, 0.001
#: The bound on labelled rows of each language that the trigram model is fitted on.
FIT_ROWS = 1500
#: Trigrams that a text counts as at most; prior rows that smooth each level of the hosts.
TEXT_EVIDENCE, HOST_SMOOTHING, VALUE_SMOOTHING = 60.0, 5.0, 2.0
#: The share of noise that every language is mixed with.
NOISE = 0.15
#: Least posterior of an accepted language.
LEAST_POSTERIOR = 0.5
BUCKETS = 1 << 16

_LETTERS = bytes(c | 0x20 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def trigrams(text: bytes) -> np.ndarray:
    """Buckets of the byte trigrams of a text's letters, words set off by single spaces."""
    words = text.decode("utf-8", "replace").lower().encode().translate(_LETTERS).split()
    if not words:
        return np.zeros(0, np.uint16)
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    code = (b[:-2] * 0x9E37 + b[1:-1]) * 0x85EB + b[2:]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


@dataclass(frozen=True)
class Model:
    """Log-probabilities by language (and last "und") and bucket."""

    languages: tuple[str, ...]
    logp: np.ndarray


def declared_languages(labelled: DataFrame, lang_col: str = "lang") -> tuple[str, ...]:
    """The two-letter codes that enough rows declare, by a count over all rows."""
    found = labelled.select(_code(quoted(lang_col).cast("string")).alias("code")).filter("code is not null").groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()  # 26^2 codes at most
    least = max(LEAST_ROWS, LEAST_SHARE * sum(r.n for r in found))
    return tuple(sorted(r.code for r in found if r.n >= least))


def fit(labelled: DataFrame, languages: tuple[str, ...] | None = None, rows: int = FIT_ROWS, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> Model:
    """A model of ``languages`` (by default those that enough rows declare), from the labelled
    rows of at most ``rows`` ids of each, drawn by a digest of the id. Ids are drawn before any
    text is read; only counts by bucket reach the driver."""
    languages = declared_languages(labelled, lang_col) if languages is None else languages

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                total[lang] += np.bincount(trigrams(text.as_py() or b""), minlength=BUCKETS)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["lang", "bucket", "n"])

    if not languages:
        return Model((), np.full((1, BUCKETS), -math.log(BUCKETS), np.float32))
    code = _code(quoted(lang_col).cast("string")).alias("lang")
    told = labelled.select(quoted(id_col).alias("id"), code)
    drawn = reduce(DataFrame.unionByName, (told.filter((F.col("lang") == one) & F.col("id").isNotNull()).orderBy(F.xxhash64("id"), "id").limit(rows) for one in languages))
    # at most ``rows`` ids of each language, which bounds this broadcast
    slim = labelled.select(quoted(id_col).alias("id"), code, quoted(text_col).cast("binary").alias("text"))
    sample = slim.join(F.broadcast(drawn.distinct()), ["id", "lang"]).select("lang", "text")
    counts = np.zeros((len(languages) + 1, BUCKETS))
    for r in sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[languages.index(r.lang), r.bucket] = r.n
    # what no language has is as rare as can be; noise has every bucket alike
    used = max(1, int((counts.sum(axis=0) > 0).sum()))
    smooth = 0.5 / BUCKETS * used
    logp = np.log(counts + smooth / used) - np.log(counts.sum(axis=1, keepdims=True) + smooth / used * BUCKETS)
    # some of any text is noise (numbers' units, addresses, names): a few rare trigrams must
    # not make a language less likely than noise alone
    logp = np.log((1 - NOISE) * np.exp(logp) + NOISE / BUCKETS)
    logp[-1] = -math.log(BUCKETS)
    if not counts.any():
        logp[:] = -math.log(BUCKETS)
    return Model(languages, logp.astype(np.float32))


def text_scores(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with the binary column ``text`` replaced by ``ll``, the tempered
    log-likelihoods, and ``post``, the posteriors that they alone give (null without letters)."""
    at = rows.columns.index("text")
    names = [c for c in rows.columns if c != "text"]
    by_bucket = np.ascontiguousarray(model.logp.T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, posts = [], []
            for text in batch.column(at):
                codes = trigrams(text.as_py() or b"")
                if not len(codes):
                    out.append(None)
                    posts.append(None)
                    continue
                total = np.zeros(by_bucket.shape[1])
                for i in range(0, len(codes), 1 << 16):
                    total += by_bucket[codes[i : i + (1 << 16)]].sum(axis=0, dtype=np.float64)
                total *= min(1.0, TEXT_EVIDENCE / len(codes))
                raised = np.exp(total - total.max())
                out.append(total)
                posts.append(raised / raised.sum())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns) if i != at), *(pa.array(x, pa.list_(pa.float64())) for x in (out, posts))], [*names, "ll", "post"])

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes if name != "text")
    return rows.mapInArrow(run, f"{schema}, ll array<double>, post array<double>")


def posterior(logs: Column) -> Column:
    """Probabilities from logarithms known up to a constant."""
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def _sums(n: int) -> list[Column]:
    return [F.sum(F.col("post")[i]).alias(f"c{i}") for i in range(n)]


def _vector(n: int, one) -> Column:
    return F.array(*[one(i) for i in range(n)])


def _code(value: Column) -> Column:
    """A two-letter code, in lower case, from a declaration such as en-GB or a suffix."""
    code = F.regexp_extract(F.lower(F.trim(value)), r"^([a-z]{2})(?:[-_].*)?$", 1)
    return F.when(code != "", code)


def host_of(address: Column) -> Column:
    host = F.regexp_extract(F.lower(address), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    return F.when(host != "", host)


def markup_language(markup: Column) -> Column:
    """The lang attribute of the first html element."""
    found = F.regexp_extract(markup, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3}(?:[-_][a-z0-9]+)*)", 1)
    return F.when(found != "", found)


def markup_text(markup: Column) -> Column:
    """Markup without scripts, styles, comments, tags and entities."""
    bare = F.regexp_replace(markup, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"&#?\w{1,10};", " ")


def fuse(scored: DataFrame, languages: tuple[str, ...]) -> DataFrame:
    """Add ``lang``, ``posterior``, ``accepted`` to stored rows of ``ll, post, declared,
    suffix, host`` and any other columns."""
    n = len(languages) + 1
    flat = F.array(*[F.lit(0.0)] * n)
    known = scored
    voters = known.filter("ll is not null")
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    domain = F.when(domain != "", domain)

    # the prior of all hosts, of a domain, of a host
    everyone = voters.agg(*_sums(n)).select(_vector(n, lambda i: F.coalesce(F.col(f"c{i}"), F.lit(0.0))).alias("all_c"))
    hosts, _ = stash(voters.filter("host is not null").groupBy("host").agg(*_sums(n)).select("host", domain.alias("domain"), _vector(n, lambda i: F.col(f"c{i}")).alias("post")), "host-counts")
    domains, _ = stash(hosts.filter("domain is not null").groupBy("domain").agg(*_sums(n)).select("domain", _vector(n, lambda i: F.col(f"c{i}")).alias("domain_c")), "domain-counts")
    priors, _ = stash(hosts.join(domains, "domain", "left").select("host", F.col("post").alias("host_c"), "domain_c"), "host-priors")
    # declared values and suffixes: at most 26^2 codes each, so their counts fit a literal
    total = [x or 0.0 for x in everyone.first().all_c]
    rows = sum(total)
    base = [(c + 1) / (rows + n) for c in total]

    def evidence(column: str) -> Column:
        counts = {r[column]: [r[f"c{i}"] for i in range(n)] for r in voters.filter(f"{column} is not null").groupBy(column).agg(*_sums(n)).toLocalIterator()}
        mass = sum(map(sum, counts.values()))
        of_language = [sum(c[i] for c in counts.values()) for i in range(n)]
        out = flat
        for code, c in sorted(counts.items()):
            share = sum(c) / mass
            logs = [math.log((c[i] + VALUE_SMOOTHING * share) / (of_language[i] + VALUE_SMOOTHING)) for i in range(n)]
            out = F.when(F.col(column) == code, F.array(*map(F.lit, logs))).otherwise(out)
        return out

    def smoothed(counts: Column, prior: Column, i: int) -> Column:
        """The level's share without the row's own vote."""
        own = F.coalesce(F.col("post")[i], F.lit(0.0))
        c = F.greatest(counts[i] - own, F.lit(0.0))
        of = F.greatest(F.aggregate(counts, F.lit(0.0), lambda a, b: a + b) - F.when(F.col("ll").isNotNull(), 1.0).otherwise(0.0), F.lit(0.0))
        return F.when(counts.isNull(), prior).otherwise((c + HOST_SMOOTHING * prior) / (of + HOST_SMOOTHING))

    joined = known.join(priors, "host", "left")
    joined = joined.withColumn("domain_p", _vector(n, lambda i: smoothed(F.col("domain_c"), F.lit(base[i]), i)))
    joined = joined.withColumn("host_p", _vector(n, lambda i: smoothed(F.col("host_c"), F.col("domain_p")[i], i)))
    joined = joined.withColumn("declared_l", evidence("declared")).withColumn("suffix_l", evidence("suffix"))
    fused = joined.withColumn("fused", posterior(_vector(n, lambda i: F.coalesce(F.col("ll")[i], F.lit(0.0)) + F.col("declared_l")[i] + F.col("suffix_l")[i] + F.log(F.col("host_p")[i]))))
    best = F.array_max("fused")
    lang = F.element_at(F.array(*map(F.lit, (*languages, UND))), F.array_position("fused", best).cast("int"))
    lang = F.when(F.col("ll").isNull(), UND).otherwise(lang)
    fused = fused.withColumn("lang", lang).withColumn("posterior", F.when(F.col("ll").isNull(), 0.0).otherwise(best))
    return fused.withColumn("accepted", (F.col("lang") != UND) & (F.col("posterior") >= LEAST_POSTERIOR)).select(*[c for c in scored.columns if c not in ("ll", "post", "declared", "suffix", "host")], "lang", "posterior", "accepted", "host", "declared", "suffix", F.col("host_p").alias("host_prior"))


def identify(rows: DataFrame, keys: dict[str, Column], text: Column, host: Column, declared: Column, suffix: Column, model: Model) -> DataFrame:
    """Identify the language of every row; ``keys`` are columns to carry along by name."""
    slim = rows.select(*[c.alias(k) for k, c in keys.items()], host.alias("host"), _code(declared).alias("declared"), _code(suffix).alias("suffix"), text.cast("binary").alias("text"))
    scored, _ = stash(text_scores(slim, model), "language-scores")
    return fuse(scored, model.languages)


def _document_evidence(docs: DataFrame) -> dict[str, Column]:
    """Documents declare a language in ``lang``; ``source`` is their host, or its address."""
    names = {c.lower() for c in docs.columns}
    source = F.col("source").cast("string") if "source" in names else F.lit(None).cast("string")
    text = F.col("text").cast("string")
    return {"text": text, "host": F.coalesce(host_of(source), F.lower(source)), "declared": F.col("lang").cast("string") if "lang" in names else F.lit(None).cast("string"), "suffix": F.regexp_extract(F.coalesce(host_of(source), F.lit("")), r"\.([a-z]{2})$", 1)}


def identify_documents(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, lang, posterior, accepted and the evidence, for each row of doc_id, text,
    lang, source."""
    return identify(docs, {"doc_id": F.col("doc_id").cast("long")}, model=fit(docs) if model is None else model, **_document_evidence(docs))


def identify_pages(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, lang, posterior, accepted and the evidence, for rows of page_id, url, html."""
    html, host = F.col("html").cast("string"), host_of(F.col("url").cast("string"))
    return identify(pages, {"page_id": F.col("page_id").cast("long")}, text=markup_text(html), host=host, declared=markup_language(html), suffix=F.regexp_extract(host, r"\.([a-z]{2})$", 1), model=model)


def keep_accepted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, all columns as they are. Decisions are
    stored by row key before any is filtered, so that the filter is not put into the scores'
    expressions, and texts are neither stored nor exchanged while the rejected are few."""
    table, key = with_row_key(docs, "keyed-documents")
    decided = identify(table, {"decided_row": F.col(key)}, model=fit(docs) if model is None else model, **_document_evidence(docs))
    decided, path = stash(decided.select("decided_row", "accepted"), "language-decisions")
    gone, _ = stash(decided.filter(~F.col("accepted")).select(F.col("decided_row").alias(key)), "rejected")
    discard(docs.sparkSession, path)
    return table.join(gone, key, "left_anti").drop(key)
