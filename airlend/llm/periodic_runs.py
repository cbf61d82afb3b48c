"""Finds stretches of words that repeat with a period, and collapses each to its first period.

A run is a stretch of consecutive words with least period q (words q apart are equal) and length of at least
max(least, repeats * q), which no neighbouring word extends keeping the period.

Periods up to SHORT are found by direct scans: the places at which words q apart are equal, in stretches. Longer ones
are found by minimizers on scales P = 2 * SHORT, 4 * SHORT, ..., each for periods from P / 2 (not included) to P. On a
scale the hashes of P words on are compared in windows of P / 2 places, and the least of each window (the leftmost of
equal ones) is chosen. In a run a window and the one a period later are equal, so they choose places a period apart;
a run of four periods holds such a pair on its scale. Words of P places, no shorter than the period, do not occur
twice within a period, so the earlier place is the last one chosen before with the same hash. Each such pair at
a distance of the scale is a seed: its lag is extended to both sides as far as words are equal, once for each stretch.
Equal hashes of different words only make seeds whose stretch turns out too short. A stretch that also has a shorter
period is found on that period's scale with the same bounds, and only the shortest period is kept.

With `repeats` below 4 longer runs could hold no pair, so that is refused. The documents of a batch go through the
scales together, longest first, with a word of its own between two of them that equals no other; on each scale only
documents that can hold its periods are left. The work is a sorting of each scale's chosen places and some passes over
the words for each doubling of the period, whatever the text: a text of one word or two takes no longer than prose.

A null text is a text without words. Documents are independent rows: repeated ones have equal results, ids may be
null, other columns are kept as they are. Columns named as the results (`runs`, `n_words`, `collapsed`) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Least number of words of a run and of its periods.
LEAST = 6
REPEATS = 4
#: Periods up to here are found by direct scans.
SHORT = 8
#: Bytes of text that go through the scales together (a longer document goes alone).
TOGETHER = 4_000_000

RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"
#: Words are separated by ASCII space, tab, line feed, vertical tab, form feed and carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes in order; sums and products wrap around."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _window_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places of the least hash, leftmost of equal ones, of all windows; width is a power of two."""
    least, place = hashes, np.arange(len(hashes))
    step = 1
    while step < width and len(least) > step:
        left = least[:-step] <= least[step:]
        place = np.where(left, place[:-step], place[step:])
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    return place if step == width else place[:0]


def _agreement(words: np.ndarray, x: int, y: int, step: int) -> int:
    """How many words from x and y on (step 1), or before them (step -1), are equal."""
    room = len(words) - y if step > 0 else x
    found, chunk = 0, 64
    while found < room:
        n = min(chunk, room - found)
        if step > 0:
            differ = words[x + found : x + found + n] != words[y + found : y + found + n]
        else:
            differ = (words[x - found - n : x - found] != words[y - found - n : y - found])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            return found + at
        found, chunk = found + n, chunk * 2
    return found


def _direct(words: np.ndarray, period: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of stretches of this period with at least `least` words."""
    equal = np.zeros(max(len(words) - period, 0) + 2, np.int8)
    equal[1:-1] = words[:-period] == words[period:] if len(words) > period else 0
    edges = np.flatnonzero(np.diff(equal))
    starts, lengths = edges[::2], edges[1::2] - edges[::2] + period
    long = lengths >= least
    return starts[long], lengths[long]


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs by start and period, in words of documents one after another.

    `words` are whole numbers from 0, `sizes` the documents' lengths, largest first. After each document stands a
    number that occurs nowhere else. Starts are counted in the whole.
    """
    if repeats < 4:
        raise ValueError("runs have at least four periods")
    found: dict[tuple[int, int], int] = {}

    def keep(start: int, length: int, period: int) -> None:
        found[start, length] = min(period, found.get((start, length), period))

    for period in range(1, SHORT + 1):
        for start, length in zip(*_direct(words, period, max(least, repeats * period))):
            keep(int(start), int(length), period)

    ends = np.cumsum(sizes + 1)
    hashes = _mixed(words.astype(np.uint64), np.uint64(1))
    width = 1
    scale = 2 * SHORT
    # The least period of a scale is scale / 2 + 1.
    while (fit := int(np.searchsorted(-sizes, -repeats * (scale // 2 + 1), "right"))) > 0:
        words, hashes = words[: ends[fit - 1]], hashes[: ends[fit - 1]]
        while width < scale:
            hashes = _mixed(hashes[:-width], hashes[width:])
            width *= 2
        place = np.unique(_window_minima(hashes, scale // 2))
        chosen = hashes[place]
        order = np.lexsort((place, chosen))
        place, chosen = place[order], chosen[order]
        lag = np.diff(place)
        seed = (chosen[1:] == chosen[:-1]) & (lag > scale // 2) & (lag <= scale)
        x, lag = place[:-1][seed], lag[seed]
        order = np.lexsort((x, lag))
        last, upto = 0, 0
        for x, q in zip(x[order].tolist(), lag[order].tolist()):
            if q == last and x < upto:  # within the stretch found last
                continue
            right = _agreement(words, x, x + q, 1)
            left = _agreement(words, x, x + q, -1)
            last, upto = q, x + right
            if left + right + q >= max(least, repeats * q):
                keep(x - left, left + right + q, q)
        scale *= 2
    return sorted((start, length, period) for (start, length), period in found.items())


def _documents(texts: list[bytes | None]) -> list[tuple[list, int, bytes]]:
    """Runs, number of words and collapsed text of each."""
    split = [(text or b"").split() for text in texts]  # at the bytes of SPACES
    order = sorted(range(len(split)), key=lambda k: -len(split[k]))
    known: dict[bytes, int] = {}
    sizes = np.array([len(split[k]) for k in order], np.int64)
    words = np.empty(int(sizes.sum()) + len(order), np.int64)
    at = 0
    for k in order:
        n = len(split[k])
        words[at : at + n] = [known.setdefault(word, len(known)) for word in split[k]]
        at += n + 1
    ends = np.cumsum(sizes + 1)
    words[ends - 1] = len(known) + np.arange(len(order))
    runs: list[list] = [[] for _ in split]
    for start, length, period in find_runs(words, sizes):
        doc = int(np.searchsorted(ends, start, "right"))
        first = int(ends[doc]) - len(split[order[doc]]) - 1
        runs[order[doc]].append((start - first, length, period))
    found = []
    for text, mine in zip(split, runs):
        n = len(text)
        if mine:
            gone = np.zeros(n + 1, np.int64)
            for start, length, period in mine:
                gone[start + period] += 1
                gone[start + length] -= 1
            text = [text[i] for i in np.flatnonzero(np.cumsum(gone[:n]) == 0)]
        found.append((mine, n, b" ".join(text)))
    return found


def collapse_runs(docs: DataFrame) -> DataFrame:
    """All columns, and runs (array of start, length, period, by start and period; word numbers from 0), n_words and
    collapsed: the words left, joined by one space, when a run keeps its first period only."""
    own = ("runs", "n_words", "collapsed")
    others = [field for field in docs.schema if field.name not in own]
    names = [field.name for field in others]
    rows = docs.select(*names, F.col("text").cast("string").cast("binary").alias("_text"))
    results = T._parse_datatype_string(f"runs {RUN}, n_words long, collapsed string")
    types = [
        pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])),
        pa.int64(),
        pa.string(),
    ]

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["_text"]
            lo = 0
            while lo < len(batch):
                hi, total = lo, 0
                while hi < len(batch) and (hi == lo or total < TOGETHER):
                    total += len(texts[hi].as_py() or b"")
                    hi += 1
                found = _documents(texts.slice(lo, hi - lo).to_pylist())
                runs = [[dict(zip(("start", "length", "period"), run)) for run in mine] for mine, _, _ in found]
                cells = (runs, [n for _, n, _ in found], [text for _, _, text in found])
                made = [pa.array(c, pa.binary()).cast(pa.string()) if t == pa.string() else pa.array(c, t) for c, t in zip(cells, types)]
                yield pa.RecordBatch.from_arrays([*(batch[name].slice(lo, hi - lo) for name in names), *made], names=[*names, *own])
                lo = hi

    return rows.mapInArrow(collapsed, T.StructType([*others, *results.fields]))


def longest(runs: Column) -> Column:
    """The run of greatest length, of equally long ones the first, then of the least period; NULL without runs."""
    order = F.transform(runs, lambda run: F.struct(-run["length"], run["start"], run["period"], run.alias("run")))
    return F.array_min(order)["run"]


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text: the words of a tenth of the documents, chosen by a hash of doc_id, repeat from some place on.

    With h the crc32 of the decimal doc_id, g = h div 10 and n words: where h mod 10 is 0 and n > 0, each word i >= a
    becomes word a + (i - a) mod p, with a = g mod n and p = 1 + (n - a) div (3 + g mod 8). Others keep their text.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    text = F.col("text").cast("string")
    words = F.filter(F.split(text, SPACES), lambda word: word != "")
    rows = docs.select("doc_id", text.alias("text"), h.alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    rows = rows.withColumns({"g": F.floor(F.col("h") / 10), "a": F.expr("IF(n > 0, pmod(floor(h / 10), n), 0)")})
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + pmod(g, 8))"))
    repeated = F.expr(
        "array_join(concat(slice(words, 1, int(a)), slice(flatten(array_repeat(slice(words, int(a) + 1, int(p)),"
        " int((n - a + p - 1) div p))), 1, int(n - a))), ' ')"
    )
    return rows.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))
