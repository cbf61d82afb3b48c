"""Finds secrets: three patterns, and character Markov models for strings that no pattern names.

Candidates are runs of at least MIN_LENGTH characters of an alphabet of 66. Two first-order Markov models, one
of random strings and one of ordinary identifiers, give a candidate's log-likelihood ratio; at THRESHOLD or
more it is a `markov` span, unless it overlaps a pattern's span or is a number. The models are counts of character pairs in
labelled samples (token, random), backed off to single characters where little was seen. `labelled_samples` makes
such samples. Random ones are keys written in hex, base 64 (both alphabets) and upper case. Ordinary ones are the words of up to
SAMPLE_DOCS documents, those with the least hash of id and text, without what the patterns match, and identifiers
made of these words and of NAMES: paths, camel case, upper snake, hyphenated, with dates, versions and numbers;
only this fit is bounded, every text is scanned as a whole.

Everything is expressed in DataFrame functions; the fitted ratio table (66 x 66) becomes a literal. Positions are
code points, the end exclusive. Null texts are empty and have no spans; `redact` leaves them null. Rows are
handled one by one, so repeated rows repeat; all columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlend.llm.common import stage

#: Fixed patterns and the length that a match (or its group) must have.
PATTERNS = {
    "assign": (
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # runs are maximal, so the shorter ones can be left out at once
}
METHOD = "markov"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
MIN_LENGTH = 16
THRESHOLD = 12.0
SAMPLE_DOCS = 2_000
SAMPLE_KEYS = 6_000
#: Pairs after a character that its single-character frequencies weigh as much as.
BACKOFF = 10.0
#: The same as a share of the pairs after that character: one never seen after a frequent one decides nothing alone.
BACKOFF_SHARE = 0.02
#: Identifiers made of NAMES.
SAMPLE_NAMES = 20_000
NAMES = """
access action address admin agent album alert amount answer application archive array article asset async
attribute audio author average batch binary block branch browser buffer button cache callback camera cancel
capture category channel character chart check child class click cloud cluster code collection color command
comment compare component content context controller copy count country create current customer dashboard data
debug default delete deploy description device dialog directory display document domain download driver
duplicate editor element email enable engine entity entry error event exchange execute export extension factory
feature field file filter final folder font format frame function gateway generate global graph group hash
header height history home host icon image import input instance integer interface internal item iterator item
job journal key kernel keyboard label language layer layout length level library license limit line link list
listener load local location lock login logger loop machine manager map margin master match matrix memory menu
merge message method metric middle mobile mode monitor mouse name native network next notice number object
offset operation option output override owner page panel parent password path pattern pending phone picture
pixel platform player plugin point policy position prefix preview price print private process product profile
project property protocol provider proxy public publish quality queue quick random range rate read receive
record refresh region register remote remove render replace report repository reset resource restore result
return review role root route rule sample save scale schedule schema scope screen script search second section
security select send sequence session setting shape share signal simple single snapshot socket sort source space
stack stage standard start state static status step storage store stream string style submit summary switch
symbol sync system tab tag target task team template text thread time timer title toggle token tool total track
transaction transfer tree trigger type unit upload user utility validate value vector vendor video view virtual
visible volume warning watch weight widget width window worker wrapper write xml year zone
""".split()
MARK = "[SECRET]"

#: Elements that a pass over an array gathers at a time, and characters of a text that are cut out at a time.
GATHERED, CUT_CHARS = 256, 1_024

_SPAN = "struct<start:int,rank:int,end:int,kind:string>"
_TOKEN = "struct<start:int,rank:int,end:int,kind:string,token:string>"
_CANDIDATE = rf"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}"


def _scanned(items: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """The state and the found elements (of type `kind`; nulls are left out) of a pass over an array.

    `step` gives the next state and an element. Elements are gathered GATHERED at a time, so that a pass over very many of
    them does not copy them again for each.
    """
    none, nested = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def one(state: Column, item: Column) -> Column:
        following, element = step(state["state"], item)
        few = F.when(element.isNull(), state["few"]).otherwise(F.concat(state["few"], F.array(element)))
        full = F.size(state["few"]) >= GATHERED
        return F.struct(
            following.alias("state"),
            F.when(full, F.array_compact(F.array(element))).otherwise(few).alias("few"),
            F.when(full, F.concat(state["all"], F.array(state["few"]))).otherwise(state["all"]).alias("all"),
        )

    done = lambda s: F.struct(s["state"].alias("state"), F.flatten(F.concat(s["all"], F.array(s["few"]))).alias("found"))
    return F.aggregate(items, F.struct(start.alias("state"), none.alias("few"), nested.alias("all")), one, done)


def _matches(text: Column, pattern: str, group: int, least: int, kind: str, rank: int) -> Column:
    """Spans, with what they cover, of the leftmost non-overlapping matches whose group has at least `least` characters."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    # The last element is the text after the last match: it has no match and gives no span.
    between = F.transform(F.split(text, pattern, -1), F.length)
    triples = F.zip_with(
        between,
        F.zip_with(whole, part, lambda w, g: F.struct(w.alias("token"), F.length(g).alias("size"))),
        lambda gap, found: F.struct(gap.alias("gap"), found.alias("found")),
    )

    def step(at: Column, triple: Column) -> tuple[Column, Column]:
        token = triple["found"]["token"]
        begin = at + triple["gap"]
        end = begin + F.coalesce(F.length(token), F.lit(0))
        names = {"start": begin, "rank": F.lit(rank), "end": end, "kind": F.lit(kind), "token": token}
        span = F.struct(*[column.alias(name) for name, column in names.items()]).cast(_TOKEN)
        return end, F.when(triple["found"]["size"] >= least, span)

    spans = _scanned(triples, F.lit(0), step, _TOKEN)["found"]
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{_TOKEN}>"))


def _span(token: Column) -> Column:
    return F.struct(*[token[name].alias(name) for name in ("start", "rank", "end", "kind")])


def _free(base: Column, tokens: Column) -> Column:
    """The tokens that overlap no span of base: one pass over both by start, and one back."""
    ranks = len(PATTERNS)

    def ahead(reach: Column, x: Column) -> tuple[Column, Column]:
        own = x["rank"] < ranks
        return F.when(own, F.greatest(reach, x["end"])).otherwise(reach), F.when(own | (x["start"] >= reach), x)

    def back(least: Column, x: Column) -> tuple[Column, Column]:
        own = x["rank"] < ranks
        return F.when(own, F.least(least, x["start"])).otherwise(least), F.when(~own & (x["end"] <= least), x)

    every = F.array_sort(F.concat(base, F.transform(tokens, _span)))
    one_way = _scanned(every, F.lit(0), ahead, _SPAN)["found"]
    return F.reverse(_scanned(F.reverse(one_way), F.lit(2**31 - 1), back, _SPAN)["found"])


def _identifiers(rows: DataFrame) -> DataFrame:
    """token: three words a, b and c of each row put together in one of twelve ways, chosen like its numbers by r."""
    a, b, c, r = F.lower("a"), F.lower("b"), F.lower("c"), F.xxhash64("a", "b", "c", "r")
    first = lambda word: F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, 2, 1_000_000))

    def number(shift: int, least: int, most: int, digits: int = 1) -> Column:
        return F.format_string(f"%0{digits}d", least + F.pmod(F.shiftright(r, shift), F.lit(most - least + 1)))

    year, month, day = number(8, 1990, 2029, 4), number(16, 1, 12, 2), number(20, 1, 28, 2)
    hour, minute, many, one = number(28, 0, 23, 2), number(36, 0, 59, 2), number(44, 0, 999), number(52, 0, 9)
    ways = [
        F.concat_ws("/", a, b, c),
        F.concat(a, first(b), first(c)),
        F.upper(F.concat_ws("_", a, b, c)),
        F.concat(a, F.lit("_"), b, F.lit("_"), year, F.lit("_"), c, F.lit("_v"), one),
        F.concat_ws("-", a, b, c),
        F.concat_ws("/", a, year, month, b),
        F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit("T"), hour, F.lit("-"), minute, F.lit("-"), day, F.lit("Z")),
        F.concat(first(a), first(b), first(c)),
        F.concat_ws("-", a, b, many),
        F.concat_ws("-", a, year, month, day, b),
        F.concat(first(a), F.lit("/"), first(b), F.lit("_"), many, F.lit("/"), c, one),
        F.concat_ws("_", a, b, c),
    ]
    way = F.pmod(r, F.lit(len(ways)))
    return rows.select(F.coalesce(*[F.when(way == k, made) for k, made in enumerate(ways)]).alias("token"))


def labelled_samples(docs: DataFrame) -> DataFrame:
    """token, random: generated keys, the words of a bounded sample of documents, and generated identifiers."""
    spark: SparkSession = docs.sparkSession
    digest = F.sha2(F.col("id").cast("string"), 256)
    keys = spark.range(SAMPLE_KEYS).select(
        F.when(F.col("id") % 4 == 0, digest)
        .when(F.col("id") % 4 == 1, F.translate(F.base64(F.unhex(digest)), "=", ""))
        .when(F.col("id") % 4 == 2, F.translate(F.base64(F.unhex(digest)), "+/=", "-_"))
        .otherwise(F.upper(F.translate(F.base64(F.unhex(digest)), "+/=", "")))
        .alias("token"),
        F.lit(True).alias("random"),
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(text.alias("text"), F.xxhash64(docs["doc_id"], text).alias("at"))
    # At most SAMPLE_DOCS numbers of each task and in all; then the texts, from where they lie.
    least = rows.select("at").distinct().orderBy("at").limit(SAMPLE_DOCS)
    chosen = rows.join(F.broadcast(least), "at", "left_semi").dropDuplicates(["at"])
    clear = F.col("text")
    for pattern, _, _ in PATTERNS.values():
        clear = F.regexp_replace(clear, pattern, " ")
    # Words of letters and low lines only: what has digits may be a secret.
    words = F.regexp_extract_all(clear, F.lit(r"(?<![A-Za-z0-9+/_-])[A-Za-z_]{4,}(?![A-Za-z0-9+/_-])"), F.lit(0))
    chosen = stage(chosen.select(words.alias("words")), "sample_words")
    threes = F.transform(
        F.filter(F.transform("words", lambda _, k: k), lambda k: (k % 3 == 0) & (k + 2 < F.size("words"))),
        lambda k: F.struct(*[F.get("words", k + n).alias(name) for n, name in enumerate("abc")], k.alias("r")),
    )
    names = F.array(*map(F.lit, NAMES))
    picked = [F.get(names, F.pmod(F.xxhash64("id", F.lit(name)), F.lit(len(NAMES))).cast("int")).alias(name) for name in "abc"]
    made = _identifiers(chosen.select(F.inline(threes))).unionByName(
        _identifiers(spark.range(SAMPLE_NAMES).select(*picked, F.col("id").cast("int").alias("r")))
    )
    plain = chosen.select(F.explode("words").alias("token")).unionByName(made)
    return keys.unionByName(plain.withColumn("random", F.lit(False)))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios, random against ordinary, of all pairs of ALPHABET, row by row."""
    size = len(ALPHABET)
    at = F.sequence(F.lit(1), F.length("token") - 1)
    pairs = samples.where(F.length("token") > 1).select("random", F.explode(F.transform(at, lambda i: F.substring("token", i, 2))).alias("pair"))
    # At most 2 x 66 x 66 rows.
    known = pairs.where(F.col("pair").rlike(r"^[A-Za-z0-9+/_-]{2}$")).groupBy("random", "pair").count().collect()
    counts = {kind: [[0.0] * size for _ in range(size)] for kind in (True, False)}
    for row in known:
        counts[row["random"]][ALPHABET.index(row["pair"][0])][ALPHABET.index(row["pair"][1])] += row["count"]

    def steps(pairs: list[list[float]]) -> list[float]:
        seen = [1 + sum(row[k] for row in pairs) for k in range(size)]
        # A tenth is spread evenly, so that one character never seen decides nothing alone.
        single = [0.9 * n / sum(seen) + 0.1 / size for n in seen]
        weights = [max(BACKOFF, BACKOFF_SHARE * sum(row)) for row in pairs]
        return [(n + b * p) / (sum(row) + b) for row, b in zip(pairs, weights) for n, p in zip(row, single)]

    ratios = [math.log(r / p) for r, p in zip(steps(counts[True]), steps(counts[False]))]
    return ratios


def ratio(token: Column, ratios: list[float]) -> Column:
    """The log-likelihood ratio of a token over ALPHABET."""
    table = F.split(F.lit(",".join(f"{x:.6g}" for x in ratios)), ",").cast("array<double>")
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    def step(state: Column, code: Column) -> Column:
        # The first character follows none.
        more = F.when(state["last"] < 0, 0.0).otherwise(F.get(table, state["last"] * len(ALPHABET) + code))
        return F.struct((state["sum"] + more).alias("sum"), code.alias("last"))

    return F.aggregate(codes, F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("last")), step, lambda s: s["sum"])


def find(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """The documents with `base` and `spans`: arrays of (start, rank, end, kind), sorted."""
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).withColumn("t", text)
    for rank, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        rows = rows.withColumn(kind, F.transform(_matches(F.col("t"), pattern, group, least, kind, rank), _span))
    rows = rows.withColumn("base", F.array_sort(F.concat(*PATTERNS)))
    # Digits alone are a number, not a key.
    random = lambda c: c["token"].rlike("[A-Za-z]") & (ratio(c["token"], ratios) >= threshold)
    tokens = _matches(F.col("t"), _CANDIDATE, 0, MIN_LENGTH, METHOD, len(PATTERNS))
    rows = rows.withColumn("random", F.filter(tokens, random))
    added = F.when(F.size("random") > 0, _free(F.col("base"), F.col("random"))).otherwise(F.array().cast(f"array<{_SPAN}>"))
    rows = rows.withColumn("added", added)
    names = [c for c in docs.columns if c not in ("base", "spans")]
    spans = F.array_sort(F.concat("base", "added")).alias("spans")
    return rows.select(*[F.col("row")[c].alias(c) for c in names], "base", spans)


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(found: DataFrame, mark: str = MARK) -> DataFrame:
    """Texts with MARK for every span (one for those that overlap); `base` and `spans` are dropped."""
    text = F.col("text").cast("string")

    def step(at: Column, span: Column) -> tuple[Column, Column]:
        before = F.struct(at.alias("start"), span["start"].alias("end"))
        return F.greatest(at, span["end"]), F.when(span["start"] >= at, before)

    def piece(start: Column, end: Column) -> Column:
        first, last = (F.floor(x / CUT_CHARS).cast("int") for x in (start, end))
        near = F.array_join(F.slice("_cut", first + 1, last - first + 1), "")
        return near.substr(start - first * CUT_CHARS + 1, end - start)

    # A piece is cut out of the few parts that it lies in, not of the whole text.
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT_CHARS}}}"), F.lit(0))
    rows = found.withColumn("_apart", F.when(F.size("spans") > 0, _scanned(F.col("spans"), F.lit(0), step, "struct<start:int,end:int>")))
    rows = rows.withColumn("_cut", F.when(F.size("spans") > 0, cut))
    kept = F.transform("_apart.found", lambda x: F.concat(piece(x["start"], x["end"]), F.lit(mark)))
    masked = F.concat(F.array_join(kept, ""), piece(F.col("_apart.state"), F.length(text)))
    masked = F.when(F.size("spans") > 0, masked).otherwise(text)
    return rows.withColumn("text", masked).select(*[c for c in found.columns if c not in ("base", "spans")])
