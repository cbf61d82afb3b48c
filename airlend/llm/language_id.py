"""Language identification by word-first backoff.

Training counts the words of all labelled documents by language, and from these counts the character n-grams
of words, with "^" and "$" at their ends. All counts are kept, as staged tables. Only the MAX_WORDS most frequent
words and the MAX_GRAMS most frequent n-grams over all languages are sent to the executors (some 45 MB for each
10 languages, words as an Arrow array that is searched without objects for each word); the other words of the texts, and the n-grams of those that training has not met, are looked up
by joins, so what is sent changes the work and not the result.

A word of a text that the model knows is scored by its smoothed log frequency in each language. Others back
off: every 4-gram of the word that is known is scored by its log frequency among 4-grams, each unknown one by
its two 3-grams, these by 2-grams, these by single characters; the word's score is their mean. The language
with the largest sum over the words is predicted, of equal ones the first by name. `score` is the mean over the
words of the probability of that language given the word alone, all languages being equally likely before.

Documents whose text is null, empty or without a letter get `und` and 0.0, and so do all if there is nothing to
learn from. Rows without text or language teach nothing. Repeated rows count each; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlend.llm.common import lean, stage

MAX_WORDS = 400_000
MAX_GRAMS = 100_000
LONGEST = 4
SMOOTHING = 0.5
UNDETERMINED = "und"
#: Characters of text handled at once.
SLICE_CHARS = 2_000_000

_WORDS = re.compile(r"[^\W\d_]+")
_COUNTS = "lang string, word string, n long"


def _slices(texts: list[str | None]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text or "")
        size += len(part[-1])
        if size > SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """How many words each text has, their codes in order, and the word of each code."""
    words: list[str] = []
    sizes = []
    for text in texts:
        found = _WORDS.findall(text.lower())
        sizes.append(len(found))
        words += found
    coded = pa.array(words, pa.string()).dictionary_encode()
    return np.array(sizes, "i8"), coded.indices.to_numpy().astype("i8"), coded.dictionary.to_pylist()


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, at = batch["lang"].dictionary_encode(), 0
        names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        for texts in _slices(batch["text"].to_pylist()):
            sizes, words, known = _coded(texts)
            of = np.repeat(codes[at : at + len(texts)], sizes)
            at += len(texts)
            cells, n = np.unique(of.astype("i8") * max(len(known), 1) + words, return_counts=True)
            lang = pa.array(names, pa.string()).take(pa.array(cells // max(len(known), 1)))
            word = pa.array(known, pa.string()).take(pa.array(cells % max(len(known), 1)))
            yield pa.RecordBatch.from_arrays([lang, word, pa.array(n, pa.int64())], ["lang", "word", "n"])


def count_words(docs: DataFrame) -> DataFrame:
    """lang, word, n over all labelled rows; docs has text and lang."""
    rows = docs.select(docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    return rows.mapInArrow(lean(_word_counts), _COUNTS).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def count_grams(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, gram, n: the n-grams of all counted words, as often as the words."""
    marked = F.concat(F.lit("^"), "word", F.lit("$"))

    def of_size(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length("marked") - (n - 1)), lambda i: F.substring("marked", i, n))

    grams = [of_size(n) for n in range(1, longest + 1)]
    # Every marked word has three characters at least, so only the longest n-grams may be missing.
    grams = [g if n <= 3 else F.when(F.length("marked") >= n, g) for n, g in enumerate(grams, 1)]
    lists = F.flatten(F.filter(F.array(*grams), lambda g: g.isNotNull()))
    rows = words.withColumn("marked", marked).select("lang", "n", F.explode(lists).alias("gram"))
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Head:
    """What is sent to the executors: rows of log frequencies of the most frequent words and n-grams."""

    words: pa.Array
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray


@dataclass
class Model:
    """words: word, scores. grams: gram, scores. scores: log frequencies in each of langs."""

    langs: list[str] = field(default_factory=list)
    words: DataFrame | None = None
    grams: DataFrame | None = None
    head: Head | None = None
    #: Whether the head holds all n-grams.
    all_grams: bool = True


def _parts(word: str) -> set[str]:
    """The n-grams that a word can back off to."""
    marked = f"^{word}$"
    return {marked[at : at + n] for n in range(1, LONGEST + 1) for at in range(len(marked) - n + 1)}


def _backoff(word: str, get: Callable[[str], np.ndarray | None], unmet: np.ndarray) -> np.ndarray:
    """The mean log frequencies of a word's longest known n-grams."""
    found: list[np.ndarray] = []

    def add(gram: str) -> None:
        scores = get(gram)
        if scores is not None:
            found.append(scores)
        elif len(gram) == 1:
            found.append(unmet)  # a character never met: equally likely in all languages
        else:
            add(gram[:-1])
            add(gram[1:])

    marked = f"^{word}$"
    n = min(LONGEST, len(marked))
    for at in range(len(marked) - n + 1):
        add(marked[at : at + n])
    return np.mean(found, axis=0)


def _by_language(counts: DataFrame, key: str, langs: list[str]) -> DataFrame:
    """key, n: its counts in each of langs, total."""
    n = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)) for lang in langs]
    return counts.groupBy(key).agg(F.array(*n).alias("n"), F.sum("n").alias("total"))


def _logs(totals: Column, distinct: int) -> Column:
    """Smoothed log frequencies of the counts `n` among `totals` by language."""
    return F.zip_with("n", totals, lambda n, of: F.log((n + SMOOTHING) / (of + SMOOTHING * (distinct + 1))))


def _most_frequent(scored: DataFrame, key: str, most: int, langs: int) -> tuple[pa.Array, np.ndarray]:
    """The keys whose total lies above a bound that leaves at most `most` of them, and their scores."""
    step = F.floor(F.log2("total") * 16).cast("int")  # some hundred steps for any number of words
    sizes = sorted(((row["step"], row["n"]) for row in scored.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, taken = None, 0
    for at, n in sizes:
        if taken + n > most:
            break
        least, taken = at, taken + n
    if least is None:
        return pa.array([], pa.string()), np.zeros((0, langs))
    table = scored.where(step >= least).select(key, "scores").toArrow()
    scores = table["scores"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return table[key].combine_chunks().cast(pa.string()), scores.reshape(table.num_rows, langs)


def train(docs: DataFrame, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """A model from all rows with text and lang."""
    counted = stage(count_words(docs), "counted")
    totals = {row["lang"]: row["n"] for row in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return Model()
    words = stage(_by_language(counted, "word", langs), "words")
    grams = stage(_by_language(count_grams(counted), "gram", langs), "grams")
    of_all = F.array(*[F.lit(float(totals[lang])) for lang in langs])
    words = words.select("word", "total", _logs(of_all, words.count()).alias("scores"))
    size = F.length("gram")
    sums = [F.sum(F.col("n")[k]).cast("double") for k in range(len(langs))]
    of_size = {row["size"]: row["n"] for row in grams.groupBy(size.alias("size")).agg(F.array(*sums).alias("n")).collect()}
    totals_of = F.array(*[F.array(*map(F.lit, of_size.get(n, [0.0] * len(langs)))) for n in range(1, LONGEST + 1)])
    n_grams = grams.count()
    grams = grams.select("gram", "total", _logs(F.get(totals_of, size - 1), n_grams).alias("scores"))
    frequent, frequent_scores = _most_frequent(words, "word", max_words, len(langs))
    parts, part_scores = _most_frequent(grams, "gram", max_grams, len(langs))
    head = Head(frequent, frequent_scores, {gram: k for k, gram in enumerate(parts.to_pylist())}, part_scores)
    return Model(langs, words.drop("total"), grams.drop("total"), head, n_grams <= max_grams)


def _lists(values: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(values) + 1, dtype="i4") * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), pa.float64()))


def _shares(scores: np.ndarray) -> np.ndarray:
    """The probability of each language given the word alone."""
    share = np.exp(scores - scores.max(axis=1, keepdims=True))
    return share / share.sum(axis=1, keepdims=True)


def _frequent_words(texts: DataFrame, model: Model, shared: Broadcast) -> DataFrame:
    """k1, k2, sums and shares over the words of the head, size, has (a letter), rest: the other words, how often."""
    count = len(model.langs)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        head_shares = _shares(head.word_scores) if len(head.words) else head.word_scores
        for batch in batches:
            at = 0
            for texts in _slices(batch["text"].to_pylist()):
                sizes, codes, words = _coded(texts)
                of = np.repeat(np.arange(len(texts)), sizes)
                lettered = np.array([any(map(str.isalpha, w)) for w in words], bool)
                has = np.zeros(len(texts), bool)
                has[of[lettered[codes]]] = True
                names = pa.array(words, pa.string())
                row = pc.fill_null(pc.index_in(names, value_set=head.words), -1).to_numpy()[codes]
                met = row >= 0
                sums, shares = (
                    np.stack([np.bincount(of[met], table[row[met], k], len(texts)) for k in range(count)], axis=1)
                    for table in (head.word_scores, head_shares)
                )
                cells, n = np.unique(of[~met] * max(len(words), 1) + codes[~met], return_counts=True)
                text, word = cells // max(len(words), 1), cells % max(len(words), 1)
                pairs = pa.StructArray.from_arrays(
                    [names.take(pa.array(word)), pa.array(n, pa.int64())], ["word", "n"]
                )
                offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype("i4")
                rest = pa.ListArray.from_arrays(pa.array(offsets), pairs)
                keys = [batch[k].slice(at, len(texts)) for k in ("k1", "k2")]
                at += len(texts)
                columns = [*keys, _lists(sums), _lists(shares), pa.array(sizes, pa.int64()), pa.array(has), rest]
                yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "sums", "shares", "size", "has", "rest"])

    schema = "k1 long, k2 int, sums array<double>, shares array<double>, size long, has boolean, rest array<struct<word:string,n:long>>"
    return stage(texts.mapInArrow(lean(scored), schema), "frequent").dropDuplicates(["k1", "k2"])


def _word_scores(words: DataFrame, model: Model, shared: Broadcast) -> DataFrame:
    """word, scores of distinct words: those of the model, or else from n-grams."""
    found = stage(words.join(model.words, "word", "left"), "looked_up")
    unseen = found.where(F.col("scores").isNull()).select("word")
    count = len(model.langs)

    def rare_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.grams
        for batch in batches:
            pairs = [(w, g) for w in batch["word"].to_pylist() for g in _parts(w) if g not in known]
            columns = [pa.array([pair[k] for pair in pairs], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "gram"])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, unmet = shared.value, np.zeros(count)
        for batch in batches:
            scores = []
            for word, rare in zip(batch["word"].to_pylist(), batch["rare"].to_pylist()):
                others = {x["gram"]: np.array(x["scores"]) for x in rare or ()}

                def get(gram: str) -> np.ndarray | None:
                    at = head.grams.get(gram)
                    return others.get(gram) if at is None else head.gram_scores[at]

                scores.append(_backoff(word, get, unmet))
            columns = [batch["word"], _lists(np.array(scores).reshape(len(scores), count))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "scores"])

    if model.all_grams:
        rows = unseen.withColumn("rare", F.lit(None).cast("array<struct<gram:string,scores:array<double>>>"))
    else:
        parts = unseen.mapInArrow(lean(rare_parts), "word string, gram string").join(model.grams, "gram")
        parts = parts.groupBy("word").agg(F.collect_list(F.struct("gram", "scores")).alias("rare"))
        rows = unseen.join(parts, "word", "left")
    backed = rows.mapInArrow(lean(scored), "word string, scores array<double>")
    return found.where(F.col("scores").isNotNull()).unionByName(backed)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of docs with lang_pred and score (both replaced if they are there)."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(F.struct(*[docs[c] for c in kept]).alias("_row"), docs["text"].cast("string").alias("text"))
    columns = [F.col("_row")[c].alias(c) for c in kept]
    if not model.langs:
        return rows.select(*columns, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    # What is predicted depends on the text alone, so texts are keyed by 96 bits of hash.
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumns({"k1": F.xxhash64("text"), "k2": F.hash("text")})
    shared = docs.sparkSession.sparkContext.broadcast(model.head)
    texts = _frequent_words(rows.select("k1", "k2", "text"), model, shared)
    rest = texts.select("k1", "k2", F.explode("rest").alias("x")).select("k1", "k2", "x.word", "x.n")
    scores = _word_scores(rest.select("word").distinct(), model, shared)
    powers = F.transform("scores", lambda x: F.exp(x - F.array_max("scores")))
    scores = scores.withColumn("powers", powers)
    total = F.aggregate("powers", F.lit(0.0), lambda a, x: a + x)
    scores = stage(scores.withColumn("share", F.transform("powers", lambda x: x / total)).drop("powers"), "others")
    count = range(len(model.langs))
    found = rest.join(scores, "word").groupBy("k1", "k2")
    found = found.agg(
        F.array(*[F.sum(F.col("n") * F.col("scores")[k]) for k in count]).alias("more_sums"),
        F.array(*[F.sum(F.col("n") * F.col("share")[k]) for k in count]).alias("more_shares"),
    )
    texts = texts.drop("rest").join(found, ["k1", "k2"], "left")

    def both(one: str, other: str) -> Column:
        return F.coalesce(F.zip_with(one, other, lambda a, b: a + b), F.col(one))

    texts = texts.withColumns({"sums": both("sums", "more_sums"), "shares": both("shares", "more_shares")})
    best = F.array_position("sums", F.array_max("sums")).cast("int")
    langs = F.array(*map(F.lit, model.langs))
    lang = F.when(F.col("has"), F.element_at(langs, best)).otherwise(UNDETERMINED)
    score = F.when(F.col("has"), F.element_at("shares", best) / F.col("size")).otherwise(0.0)
    told = stage(texts.select("k1", "k2", lang.alias("lang_pred"), score.alias("score")), "languages")
    shared.unpersist()  # all that reads it is staged
    return rows.drop("text").join(told, ["k1", "k2"], "left").select(*columns, "lang_pred", "score")
