"""Language by fusing evidence.

A text's likelihoods under models of character trigrams meet what else is known
of its source: the language its markup declares, the suffix of its address, and
a prior of its host. How far each of these can be trusted is counted over the
whole corpus, in sums of the text's own posterior by declared language, by
suffix, and by host and domain; a host's prior is smoothed by its domain's, and
that by the corpus's. A page never counts as evidence about itself.
"""

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tracemill.llm.common import pieces, table, text_of
from tracemill.session import spool

# Labelled documents of each language used for fitting, at most.
MAX_DOCS = 500
# Trigrams are counted by hash in so many buckets.
BUCKETS = 1 << 15
SMOOTHING = 0.5
# A text weighs as much as so many words at most: words are not independent witnesses.
MAX_WORDS = 30
# Weight, in pages, of a domain's prior for its host and of the corpus's for a domain, and of even odds for the rest.
HOST_WEIGHT, EVEN_WEIGHT = 5.0, 2.0
CACHE_WORDS = 300_000


def buckets_of(word: str) -> list[int]:
    padded = f" {word.lower()} "
    raw = [padded[i : i + 3] for i in range(len(padded) - 2)]
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in raw]


class Model:
    """Languages and the log probability of each trigram bucket in them."""

    def __init__(self, languages: list[str], log_p: np.ndarray):
        self.languages, self.log_p = languages, log_p


class Scorer:
    """Log likelihoods of texts; words are scored once in a task."""

    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def word(self, word: str) -> int:
        number = self.cache.get(word)
        if number is None:
            number = self.cache[word] = len(self.cache)
            self.rows.append(self.model.log_p[buckets_of(word)].sum(axis=0))
        return number

    def texts(self, texts: list[str]) -> np.ndarray:
        if not self.cache or len(self.cache) > CACHE_WORDS:
            self.cache, self.rows, self.table = {}, [], np.empty((0, len(self.model.languages)))
        words = [t.split() for t in texts]
        numbers = [np.fromiter(map(self.word, w), np.int64, len(w)) for w in words]
        if self.rows:
            self.table = np.concatenate([self.table, np.array(self.rows)])
            self.rows = []
        out = np.zeros((len(texts), len(self.model.languages)))
        for k, n in enumerate(numbers):
            if len(n):
                out[k] = self.table[n].sum(axis=0) * min(1.0, MAX_WORDS / len(n))
        return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trigram models of the labelled languages, from up to `MAX_DOCS` documents each, those of lowest hash.

    Rows without a language, id or word are passed over; without any there is
    no language to choose.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).dropna()
    languages = [r["lang"] for r in known.select("lang").distinct().orderBy("lang").collect()]
    ids = [
        known.filter(F.col("lang") == lang).select("id", "lang").distinct().orderBy(F.xxhash64("id"), "id").limit(MAX_DOCS)
        for lang in languages
    ]
    if not ids:
        return Model([], np.empty((BUCKETS, 0)))
    sample = reduce(DataFrame.union, ids)  # MAX_DOCS rows a language at most
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), text_of(text_col).alias("text"))
    rows = rows.join(F.broadcast(sample), ["id", "lang"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {lang: np.zeros(BUCKETS, np.int64) for lang in languages}
        for batch in pieces(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in text.split():
                    for bucket in buckets_of(word):
                        counts[lang][bucket] += 1
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["lang", "bucket", "n"])

    sums = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.full((BUCKETS, len(languages)), SMOOTHING)
    for lang, bucket, n in sums.collect():
        counts[bucket, languages.index(lang)] += n
    return Model(languages, np.log(counts / counts.sum(axis=0)))


def page_text(html: Column) -> Column:
    """What a page says: without scripts, styles, comments and tags."""
    html = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    html = F.regexp_replace(html, r"<[^>]*>", " ")
    return F.regexp_replace(html, r"&[a-zA-Z]+;|&#[0-9]+;", " ")


def declared_language(html: Column) -> Column:
    """The main part of the lang attribute of the html tag, in lower case; null if there is none."""
    lang = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-zA-Z]+)", 1))
    return F.nullif(lang, F.lit(""))


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(host, F.lit(""))


def evidence(model: Model, rows: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` and declared, suffix, host, domain, with l0, l1, ...: the text's log likelihoods."""

    @F.pandas_udf("array<double>")
    def likelihoods(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            parts = [scorer.texts(list(texts.iloc[a : a + 256])) for a in range(0, len(texts), 256)]
            yield pd.Series(list(np.concatenate(parts)) if parts else [], dtype=object)

    n = len(model.languages)
    scored = rows.select(*keep, "declared", "suffix", "host", "domain", likelihoods("text").alias("l"))
    return spool(scored.select("*", *[F.get("l", F.lit(i)).alias(f"l{i}") for i in range(n)]).drop("l"), "likelihoods")


def _softmax(logs: list[Column]) -> list[Column]:
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    powers = [F.exp(x - top) for x in logs]
    total = reduce(lambda a, b: a + b, powers)
    return [p / total for p in powers]


def fuse(model: Model, rows: DataFrame) -> DataFrame:
    """Adds `language` and `confidence` to what `evidence` gave; both null if no language is known.

    Sums are joined back by key; those of hosts may be many and hosts may be
    hot, so both sides are written tables that Spark may split. Ties go to the
    first language by name.
    """
    n, languages = len(model.languages), model.languages
    if not n:
        return rows.withColumns({"language": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
    logs = [F.col(f"l{i}") for i in range(n)]
    rows = rows.withColumns({f"p{i}": p for i, p in enumerate(_softmax(logs))})
    sums = [F.sum(f"p{i}").alias(f"s{i}") for i in range(n)]
    total = rows.agg(*sums, F.count("*").alias("n")).collect()[0]
    prior = [((total[f"s{i}"] or 0) + EVEN_WEIGHT / n) / (total["n"] + EVEN_WEIGHT) for i in range(n)]

    for key in ("declared", "suffix", "domain", "host"):
        known = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(*sums)
        known = spool(known.select(F.col(key).alias(f"{key}_key"), *[F.col(f"s{i}").alias(f"{key}_{i}") for i in range(n)]), f"{key}-sums")
        rows = rows.join(known, rows[key] == known[f"{key}_key"], "left").drop(f"{key}_key")

    own = [F.col(f"p{i}") for i in range(n)]
    others = lambda key: [F.greatest(F.coalesce(F.col(f"{key}_{i}") - own[i], F.lit(0.0)), F.lit(0.0)) for i in range(n)]
    add = lambda columns: reduce(lambda a, b: a + b, columns)

    def smoothed(counts: list[Column], behind: list[Column]) -> list[Column]:
        return [(c + HOST_WEIGHT * b) / (add(counts) + HOST_WEIGHT) for c, b in zip(counts, behind)]

    of_host = smoothed(others("host"), smoothed(others("domain"), [F.lit(p) for p in prior]))

    def trust(key: str) -> list[Column]:
        """log P(key's value | language) up to a constant: counts over the language's total, towards even odds."""
        counts, even = others(key), [F.lit(EVEN_WEIGHT * p) for p in prior]
        return [
            F.when(F.col(key).isNull(), 0.0).otherwise(F.log((c + e) / F.lit((total["n"] + EVEN_WEIGHT) * p)))
            for c, e, p in zip(counts, even, prior)
        ]

    fused = [x + d + s + F.log(h) for x, d, s, h in zip(logs, trust("declared"), trust("suffix"), of_host)]
    rows = rows.withColumns({f"f{i}": f for i, f in enumerate(_softmax(fused))})
    best = F.greatest(*[F.col(f"f{i}") for i in range(n)]) if n > 1 else F.col("f0")
    name = reduce(lambda rest, i: F.when(F.col(f"f{i}") == best, languages[i]).otherwise(rest), reversed(range(n)), F.lit(None))
    return rows.withColumns({"language": name.cast("string"), "confidence": best})


def identify_pages(pages: DataFrame) -> DataFrame:
    """Pages as rows to score: null html as empty, null or odd addresses without host and suffix."""
    host = host_of(F.col("url"))
    rows = pages.select("page_id", text_of("html").alias("html"), host.alias("host"))
    names = F.split("host", r"\.")
    return rows.select(
        F.lit(None).cast("long").alias("doc_id"),
        "page_id",
        page_text(F.col("html")).alias("text"),
        declared_language(F.col("html")).alias("declared"),
        F.when(F.size(names) > 1, F.element_at(names, -1)).alias("suffix"),
        "host",
        F.when(F.size(names) > 1, F.array_join(F.slice(names, -2, 2), ".")).otherwise(F.col("host")).alias("domain"),
    )


def identify_documents(docs: DataFrame) -> DataFrame:
    """Documents as rows to score: their source is their host; their own label isn't used."""
    none = F.lit(None).cast("string")
    return docs.select(
        "doc_id",
        F.lit(None).cast("long").alias("page_id"),
        text_of("text").alias("text"),
        none.alias("declared"),
        none.alias("suffix"),
        F.col("source").alias("host"),
        F.col("source").alias("domain"),
    )


def identify(model: Model, rows: DataFrame) -> DataFrame:
    """(doc_id, page_id, language, confidence), a row per input row."""
    scored = fuse(model, evidence(model, rows, ["doc_id", "page_id"]))
    return scored.select("doc_id", "page_id", "language", "confidence")


def op9_language_fusion(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = identify_pages(table(spark, sf_dir, "pages")).unionByName(identify_documents(docs))
    return identify(fit(docs), rows)
