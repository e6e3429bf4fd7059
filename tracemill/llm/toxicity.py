"""Toxicity by compression distance.

Two zstandard dictionaries are trained on windows of labelled text: the toxic one
on windows of toxic documents, namely on the words of their running text that
begin as words over-represented in toxic documents do (by a lower bound of the
log odds), each as often as it occurs; the ordinary one on windows of ordinary
documents, and once more on those of them that the toxic one would shorten. The toxic compressor is given both, so that a window without anything
toxic takes the same bytes under either. A window of a text, two words that
follow each other, is compressed under each; the bytes by which the toxic one is
shorter are summed over the text and taken per distinct word, against a threshold
calibrated on labelled documents by dictionaries that haven't seen them.
"""

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tracemill.llm.common import free_name, table, text_of, words_of

# At most so many labelled documents of each class are used for fitting, of each a
# run of so many words from a place its text decides, and so many ordinary windows.
MAX_TOXIC, MAX_ORDINARY = 1500, 6000
FIT_WORDS = 1000
MAX_WINDOWS = 60_000
# Beginnings of words are looked at from this many characters on. One is toxic from this
# many toxic documents and this log odds ratio on, less so many standard errors.
LEAST_BEGINNING = 5
MIN_DOCS, MIN_LOG_ODDS, ERRORS = 3, 1.2, 2.0
TOXIC_BYTES, ORDINARY_BYTES = 4096, 16384
# Bytes of the ordinary dictionary trained on windows the toxic one shortens by more than so many bytes.
CONFUSED_BYTES, CONFUSED_SAVING = 4000, 1
# A window is so many words of running text; ordinary dictionaries learn from longer ones.
WINDOW_WORDS, TRAIN_WORDS = 2, 3
# Words a text is taken to have besides its own, so that one window in a short text isn't everything.
MORE_WORDS = 5
# Folds of the learnt documents by which the threshold is calibrated.
FOLDS = 4
# Shorter matches with a dictionary aren't used.
MIN_MATCH = 6
# Bytes all dictionaries end with and every window ends with, so that zstandard
# compresses even a window of a few bytes and doesn't store it.
FRAME = bytes(range(128, 168))
# What is known of this many words is kept at a time in one task.
CACHE_WORDS = 300_000


def window_bytes(words: Iterable[str]) -> bytes:
    return f" {' '.join(words)} ".encode("utf-8", "surrogatepass")


def windows(words: list[str], size: int = WINDOW_WORDS) -> Iterator[tuple[str, ...]]:
    """The runs of `size` words, each sharing one word with the next; a shorter text is one window."""
    for i in range(0, max(1, len(words) - size + 1), max(1, size - 1)):
        yield tuple(words[i : i + size])


def beginnings(word: str) -> Iterator[str]:
    """The beginnings of a word up to all of it; a short word is its own."""
    return (word[:k] for k in range(min(LEAST_BEGINNING, len(word)), len(word) + 1))


def over_represented(toxic: list[list[str]], ordinary: list[list[str]]) -> dict[str, float]:
    """Beginnings of words of toxic documents with the lower bound of their log odds ratio, where it is large enough."""
    in_toxic = Counter(b for doc in toxic for b in {b for w in set(doc) for b in beginnings(w)})
    least = min(MIN_DOCS, len(toxic))
    in_toxic = {b: n for b, n in in_toxic.items() if n >= least}
    in_ordinary = Counter(b for doc in ordinary for b in {b for w in set(doc) for b in beginnings(w) if b in in_toxic})
    found = {}
    for beginning, n in in_toxic.items():
        t, o = n + 0.5, in_ordinary[beginning] + 0.5
        odds = math.log(t / (len(toxic) - n + 0.5)) - math.log(o / (len(ordinary) - in_ordinary[beginning] + 0.5))
        weight = odds - ERRORS * math.sqrt(1 / t + 1 / o)
        if weight > MIN_LOG_ODDS:
            found[beginning] = weight
    return found


def train_dictionary(size: int, samples: list[bytes]) -> bytes:
    """A zstandard dictionary trained on the samples; the samples themselves where they are too few to train on."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=16, d=6, level=19).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


class Distance:
    """Compression lengths of windows under the two dictionaries; made once in a task."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.compressors = [self._compressor(ordinary), self._compressor(toxic + ordinary)]
        self.runs = {toxic[i : i + MIN_MATCH] for i in range(len(toxic) - MIN_MATCH + 1)}
        self.known: dict[str, bool] = {}

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(content + FRAME, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        params = zstandard.ZstdCompressionParameters.from_level(
            19,
            dict_size=len(content) + len(FRAME),
            source_size=128,
            min_match=MIN_MATCH,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        return zstandard.ZstdCompressor(dict_data=data, compression_params=params)

    def saved(self, window: Iterable[str]) -> int:
        """Bytes the toxic dictionary saves on a window."""
        content = window_bytes(window) + FRAME
        plain, toxic = (len(c.compress(content)) for c in self.compressors)
        return plain - toxic

    def shares(self, word: str) -> bool:
        """Whether the toxic dictionary has a match for a part of the word; without one it saves nothing there."""
        known = self.known.get(word)
        if known is None:
            content = window_bytes((word,))
            known = any(content[i : i + MIN_MATCH] in self.runs for i in range(len(content) - MIN_MATCH + 1))
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = known
        return known

    def text(self, words: list[str]) -> float:
        """The bytes saved on the distinct windows by the number of distinct words."""
        distinct = set(words)
        shared = {w for w in distinct if self.shares(w)}
        if not shared:
            return 0.0
        found = {w for w in windows(words) if not shared.isdisjoint(w)}
        return sum(max(0, self.saved(w)) for w in found) / (MORE_WORDS + len(distinct))


class Model:
    """What a fit yields: two dictionaries and the calibrated threshold."""

    def __init__(self, ordinary: bytes = b"", toxic: bytes = b"", threshold: float = 1.0):
        self.ordinary, self.toxic, self.threshold = ordinary, toxic, threshold

    def probability(self, distance: float) -> float:
        """A logistic curve through 0.5 at the threshold; 0 where nothing toxic was learnt."""
        if not self.toxic:
            return 0.0
        return 1 / (1 + math.exp(-8 * (distance / self.threshold - 1)))


def dictionaries(toxic: list[list[str]], ordinary: list[list[str]]) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary trained on documents given as their words; empty ones if no word is toxic."""
    marks = over_represented(toxic, ordinary)
    if not marks:
        return b"", b""

    def marked(word: str) -> bool:
        return any(b in marks for b in beginnings(word))

    learnt = train_dictionary(TOXIC_BYTES, [window_bytes((w,)) for d in toxic for w in d if marked(w)])
    plain = dict.fromkeys(w for d in ordinary for w in windows(d, TRAIN_WORDS))
    plain = sorted(plain, key=lambda w: zlib.crc32(window_bytes(w)))[:MAX_WINDOWS]
    usual = train_dictionary(ORDINARY_BYTES, list(map(window_bytes, plain)))
    distance = Distance(usual, learnt)
    others = (w for w in plain if any(map(distance.shares, w)) and not any(map(marked, w)))
    confused = [window_bytes(w) for w in others if distance.saved(w) > CONFUSED_SAVING]
    return train_dictionary(CONFUSED_BYTES, confused) + usual, learnt


def fit_words(toxic: list[list[str]], ordinary: list[list[str]]) -> Model:
    """Dictionaries from all documents, the threshold from distances to those made without a document's fold.

    A document is its words in order. Equal documents count once.
    """
    toxic, ordinary = ([list(d) for d in dict.fromkeys(map(tuple, docs)) if d] for docs in (toxic, ordinary))
    model = Model(*dictionaries(toxic, ordinary))
    if not model.toxic:
        return model
    scored = []
    for fold in range(FOLDS):
        rest = [[d for i, d in enumerate(docs) if i % FOLDS != fold] for docs in (toxic, ordinary)]
        distance = Distance(*dictionaries(*rest))
        scored += [(distance.text(d), y) for y, docs in ((1, toxic), (0, ordinary)) for d in docs[fold::FOLDS]]
    model.threshold = best_threshold(sorted(scored))
    return model


def fit_run(text: str) -> list[str]:
    """At most `FIT_WORDS` words of a text that follow each other, from a place its text decides."""
    words = words_of(text)
    more = len(words) - FIT_WORDS
    start = zlib.crc32(text.encode("utf-8", "surrogatepass")) % (more + 1) if more > 0 else 0
    return words[start : start + FIT_WORDS]


def best_threshold(scored: list[tuple[float, int]]) -> float:
    """The middle of the cut with the most right answers, classes weighted alike; never 0."""
    n = Counter(y for _, y in scored)
    right, best, at = 1.0, -1.0, 1.0
    for i, (value, y) in enumerate(scored):
        below = scored[i - 1][0] if i else 0.0
        if value > below and right > best:
            best, at = right, (value + below) / 2
        right += 1 / n[0] if y == 0 else -1 / n[1]
    return at


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on labelled documents whose crc32(id) mod 5 isn't 0.

    The sample is bounded by `MAX_TOXIC` and `MAX_ORDINARY`: the labelled ids
    with the lowest hash, and `FIT_WORDS` words of each. Null or missing labels and
    ids are passed over; a document with several labels is toxic if one of them is.
    """
    fold = F.crc32(F.col("id").cast("string")) % 5
    known = (
        labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & (fold != 0))
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    chosen = [
        row
        for toxic, most in ((1, MAX_TOXIC), (0, MAX_ORDINARY))
        for row in known.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("id"), "id").limit(most).collect()
    ]
    if not any(r["toxic"] for r in chosen):
        return Model()
    sample = docs.sparkSession.createDataFrame(chosen, known.schema)

    @F.pandas_udf("array<string>")
    def run_of(texts: pd.Series) -> pd.Series:
        return texts.map(fit_run)

    rows = (
        docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("body"))
        .join(F.broadcast(sample), "id")  # MAX_TOXIC + MAX_ORDINARY rows at most
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"), F.min("body").alias("body"))
        .select("id", "toxic", run_of("body").alias("words"))
        .orderBy(F.xxhash64("id"), "id")
        .toArrow()
    )
    is_toxic = rows.column("toxic").to_pylist()
    words = rows.column("words").to_pylist()
    return fit_words(*[[w for w, toxic in zip(words, is_toxic) if toxic == y] for y in (1, 0)])


def score(model: Model, text: Column) -> Column:
    """The toxicity of each text, 0 to 1; a null or empty text has 0 or the curve's foot.

    Every two words that follow each other in the whole text are a window, so the
    order and number of texts don't change a score.
    """

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        distance = Distance(model.ordinary, model.toxic)
        for texts in batches:
            yield texts.map(lambda t: model.probability(distance.text(words_of(t)))).astype("float64")

    return scored(text_of(text))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores below the threshold, columns as they were.

    Works row by row: repeated rows, null ids and extra columns stay as they are.
    """
    name = free_name(docs, "toxicity")
    return docs.withColumn(name, score(model, F.col(text_col))).filter(F.col(name) < threshold).drop(name)


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        score(model, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
