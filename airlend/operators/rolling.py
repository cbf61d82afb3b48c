"""Aggregates over the N days before and after a subscriber's loans.

With t the second of a loan, the frames are

    back,  [t - N days, t)
    ahead, [t, t + N days]

Time is cut into blocks. Every row goes to its own block and to the blocks that hold loans whose windows reach it,
so a block with its halo has all that its loans look at, and one shuffle by subscriber and block serves all windows
of all aggregates. A subscriber is spread over as many tasks as there are blocks in the history.

Within a block every frame starts at the block's edge and only its end moves, so a row enters each frame once: the
work is rows times windows, however many rows a frame holds.

Where the loans are given apart from the points and a subscriber has at most PAIRED of them in a block, frames cost more
than they save: each point of the block is paired with these loans, and the pairs within reach are added up by a hash
aggregate. A point meets at most PAIRED loans, so this too is linear in the points. Blocks with more loans take frames.

* A sum over a window is the sum up to its end less the sum up to its start.
* Least and greatest values can't be subtracted. For a window of N days time is also cut into spans of N days. A window
  lies in two of them: its part in the loan's own span is a running value that starts anew in each span, forwards
  in time, and its part in the span before is one backwards in time. A value that starts anew in each span is the
  greatest of (span, value): a later span beats all earlier ones. Whole numbers are packed with their span into one
  BIGINT for that, which raises an error from 2^40 on (ten thousand million, in cents); other types are compared as
  structs, which is slower.

Sums are exact for exact numbers, and callers pass no others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlend.functions.columns import DAY_SECONDS

#: Rows that belong to no frame are dealt to so many groups of their own.
UNPLACED_SLOTS = 1_024
#: Below all blocks of times that a timestamp can have.
UNPLACED_BLOCK = -(10**9)
#: Packed values lie between -HALF and HALF, which leaves 22 bits for spans: spans of a day in all times of a timestamp.
HALF = 2**40
#: Up to so many loans of a subscriber and block are paired with its points; frames take about as long as 15 to 30 pairs.
PAIRED = 32


def rolling(
    points: DataFrame,
    partials: Mapping[str, str],
    windows: Sequence[int],
    ahead: Sequence[str] = (),
    back: bool = True,
    results: DataFrame | None = None,
    block_days: int | None = None,
) -> DataFrame:
    """The rows with a payload: the payload's fields, `{partial}_back_{N}` and `{partial}_ahead_{N}`.

    points     msisdn, epoch (seconds) and one column per partial: what the row adds to it, NULL for nothing
    results    msisdn, epoch and payload, a struct: where aggregates are wanted, for loans that are among the
               points. Without it the points have a payload column, NULL where none are wanted
    partials   partial name -> 'sum', 'min' or 'max'; over no rows a sum is 0, the others are NULL
    ahead      the partials wanted ahead
    block_days length of a block, twice the longest window if None. Shorter blocks spread a subscriber over more tasks
               and copy rows more often: a row has about 1 + reach / block_days copies, where reach is the longest
               window, counted once for each direction

    Rows without subscriber or time belong to no frame. Those with a payload come back with their frames empty:
    sums 0, the others NULL.
    """
    windows = sorted(set(windows))
    if windows[0] < 1:
        raise ValueError("a window has at least one day")
    packed = [name for name in partials if isinstance(points.schema[name].dataType, T.IntegralType)]
    frames = _Frames(partials, windows, ahead, back, packed)
    block_days = block_days or 2 * windows[-1]
    if results is None:
        return frames.results(frames.blocked(points, block_days))
    if not _kept_by_grouping(results.schema["payload"].dataType):
        return frames.results(frames.blocked(points.unionByName(results, allowMissingColumns=True), block_days))
    no_points = (f"CAST(NULL AS {points.schema[name].dataType.simpleString()}) AS {name}" for name in frames.names)
    wanted = frames.blocked(results.selectExpr("msisdn", "epoch", *no_points, "payload"), block_days)
    return frames.paired_or_framed(frames.copies(points, block_days), wanted.drop(*frames.names))


def _kept_by_grouping(dtype: T.DataType) -> bool:
    """Whether values of the type can be grouped by and come back as they were (-0.0 would not)."""
    if isinstance(dtype, T.StructType):
        return all(_kept_by_grouping(field.dataType) for field in dtype)
    if isinstance(dtype, T.ArrayType):
        return _kept_by_grouping(dtype.elementType)
    return not isinstance(dtype, (T.DoubleType, T.FloatType, T.MapType, T.VariantType))


class _Frames:
    """The frames of one set of windows. The many columns are SQL text: one call to the driver's JVM per projection."""

    def __init__(
        self, partials: Mapping[str, str], windows: Sequence[int], ahead: Sequence[str], back: bool, packed: Sequence[str]
    ) -> None:
        self.windows, self.packed = windows, packed
        self.back = list(partials) if back else []
        self.ahead = list(ahead)
        used = [name for name in partials if name in self.back or name in self.ahead]
        self.sums = [name for name in used if partials[name] == "sum"]
        # A least value is the negated greatest of the negated values.
        self.extremes = {name: partials[name] for name in used if partials[name] != "sum"}
        self.names = [*self.sums, *self.extremes]

    def _checked(self, name: str) -> str:
        if name not in self.extremes or name not in self.packed:
            return name
        return f"IF(abs({name}) < {HALF}L, {name}, IF({name} IS NULL, NULL, raise_error('too large: ' || {name})))"

    def blocked(self, rows: DataFrame, block_days: int) -> DataFrame:
        """msisdn, block, epoch, the partials and payload (in the row's own block only): one row for each block that
        the row belongs to, all rows of a block in one task."""
        length = block_days * DAY_SECONDS
        first, last = self._first_and_last(block_days)
        placed = "(msisdn IS NOT NULL AND epoch IS NOT NULL)"
        slot = f"{UNPLACED_BLOCK}L - pmod(xxhash64(payload), {UNPLACED_SLOTS})"
        copies = rows.filter(f"{placed} OR payload IS NOT NULL").selectExpr(
            "msisdn",
            f"IF({placed}, epoch, NULL) AS epoch",
            *(f"IF({placed}, {self._checked(name)}, NULL) AS {name}" for name in self.names),
            "payload",
            f"explode(IF({placed}, sequence({first}, {last}), array({slot}))) AS block",
        )
        own = f"epoch IS NULL OR block = floor(epoch / {length})"
        # A copy that adds nothing and asks for nothing is not sent.
        adds = " OR ".join(f"{name} IS NOT NULL" for name in self.names)
        sent = copies.selectExpr("msisdn", "block", "epoch", *self.names, f"IF({own}, payload, NULL) AS payload")
        # Dealt out here, before the many columns that the frames need are made.
        return sent.filter(f"payload IS NOT NULL OR {adds}").repartition("msisdn", "block")

    def copies(self, points: DataFrame, block_days: int) -> DataFrame:
        """The same as `blocked`, for points without payload and not yet dealt out: the joins that use them do that
        alike, in one shuffle."""
        first, last = self._first_and_last(block_days)
        placed = points.filter("msisdn IS NOT NULL AND epoch IS NOT NULL")
        # A name for a column that has it already would be dropped in one use only, and the plans would differ.
        cells = {name: self._checked(name) for name in self.names}
        checked = (name if cell == name else f"{cell} AS {name}" for name, cell in cells.items())
        sent = placed.selectExpr("msisdn", "epoch", *checked, f"explode(sequence({first}, {last})) AS block")
        return sent.filter(" OR ".join(f"{name} IS NOT NULL" for name in self.names))

    def _first_and_last(self, block_days: int) -> tuple[str, str]:
        """SQL of the first and the last block that a row belongs to."""
        length, reach = block_days * DAY_SECONDS, self.windows[-1] * DAY_SECONDS
        first = f"floor((epoch - {reach if self.ahead else 0}L) / {length})"
        return first, f"floor((epoch + {reach if self.back else 0}L) / {length})"

    def paired_or_framed(self, points: DataFrame, results: DataFrame) -> DataFrame:
        """The results of points and of rows with a payload that are dealt to blocks alike: by pairs for a subscriber
        with few of the latter in a block, by frames for others."""
        group = "PARTITION BY msisdn, block ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND"
        # Which of equal times comes first makes no difference: their aggregates are the same.
        numbered = results.selectExpr(
            "msisdn",
            "block",
            "epoch",
            "payload",
            f"row_number() OVER ({group} CURRENT ROW) AS number",
            f"count(1) OVER ({group} UNBOUNDED FOLLOWING) AS in_block",
        )
        many = numbered.filter(f"in_block > {PAIRED}").select("msisdn", "block", "epoch", "payload")
        crowded = many.select("msisdn", "block").distinct().hint("shuffle_hash")
        rows = points.join(crowded, ["msisdn", "block"], "left_semi").unionByName(many, allowMissingColumns=True)
        framed = self.results(rows)
        paired = self.pairs(points, numbered.filter(f"in_block <= {PAIRED}"))
        kinds = ((field.name, field.dataType.simpleString()) for field in framed.schema)
        return framed.union(paired.selectExpr(*(f"CAST({name} AS {kind}) AS {name}" for name, kind in kinds)))

    def pairs(self, points: DataFrame, few: DataFrame) -> DataFrame:
        """The same as `results`, for few numbered rows with a payload in each block."""
        reach = self.windows[-1] * DAY_SECONDS
        back, ahead = (reach if self.back else 0), (reach if self.ahead else -1)
        at = few.select("msisdn", "block", "epoch", "payload", "number").alias("at").hint("shuffle_hash")
        near = at.join(
            points.alias("point"),
            F.expr(
                "at.msisdn = point.msisdn AND at.block = point.block"
                f" AND point.epoch BETWEEN at.epoch - {back}L AND at.epoch + {ahead}L"
            ),
            "left",
        )
        pairs = near.selectExpr(
            "at.msisdn", "at.block", "at.number", "at.payload", "point.epoch - at.epoch AS after", *self.names
        )

        def cell(days: int, direction: str, name: str):
            far = days * DAY_SECONDS
            within = f"after BETWEEN -{far}L AND -1L" if direction == "back" else f"after BETWEEN 0L AND {far}L"
            value = f"{self.extremes.get(name, 'sum')}(CASE WHEN {within} THEN {name} END)"
            value = f"coalesce({value}, 0)" if name in self.sums else value
            return F.expr(f"{value} AS {name}_{direction}_{days}")

        wanted = [(n, "back", name) for n in self.windows for name in self.back]
        wanted += [(n, "ahead", name) for n in self.windows for name in self.ahead]
        found = pairs.groupBy("msisdn", "block", "number", "payload").agg(*(cell(*one) for one in wanted))
        return found.selectExpr("payload.*", *(f"{name}_{direction}_{n}" for n, direction, name in wanted))

    def results(self, rows: DataFrame) -> DataFrame:
        """The payload's fields and all aggregates."""
        forwards = "PARTITION BY msisdn, block ORDER BY epoch RANGE BETWEEN UNBOUNDED PRECEDING AND"
        backwards = "PARTITION BY msisdn, block ORDER BY epoch DESC RANGE BETWEEN UNBOUNDED PRECEDING AND"

        def sums(names: Sequence[str], end: str, name: str) -> list[str]:
            names = [n for n in names if n in self.sums]
            cells = [f"'{n}', sum({n}) OVER ({forwards} {end})" for n in names]
            return [f"named_struct({', '.join(cells)}) AS {name}"] if cells else []

        def extremes(frame: str, direction: str, days: int, name: str) -> list[str]:
            cells = []
            for n in self.extremes:
                sign = "+" if self.extremes[n] == "max" else "-"
                if n in self.packed:
                    pair = f"{direction}span_{days} * {2 * HALF}L {sign} {n}"
                else:
                    pair = f"IF({n} IS NULL, NULL, struct({direction}span_{days} AS span, {sign}{n} AS value))"
                cells.append(f"'{n}', max({pair}) OVER ({frame})")
            return [f"named_struct({', '.join(cells)}) AS {name}"] if cells and self.back else []

        far = {n: n * DAY_SECONDS for n in self.windows}
        earlier = [
            cell for n in self.windows for cell in extremes(f"{backwards} {far[n]} FOLLOWING", "-", n, f"before_{n}")
        ]
        pieces = [
            *sums(self.sums, "1 PRECEDING", "upto"),
            *(c for n in self.windows for c in sums(self.back, f"{far[n] + 1} PRECEDING", f"start_{n}")),
            *(c for n in self.windows for c in sums(self.ahead, f"{far[n]} FOLLOWING", f"end_{n}")),
            *(c for n in self.windows for c in extremes(f"{forwards} 1 PRECEDING", "", n, f"own_{n}")),
        ]
        kept = ["payload"]
        if earlier:
            spans = [f"floor(epoch / {days * DAY_SECONDS}) AS span_{days}" for days in self.windows]
            rows = rows.selectExpr("*", *spans).selectExpr("*", *earlier)
            kept += [f"{name}_{n}" for n in self.windows for name in ("span", "before")]
        found = rows.selectExpr(*kept, *pieces)
        cells = [self._result(n, "back", name) for n in self.windows for name in self.back]
        cells += [self._result(n, "ahead", name) for n in self.windows for name in self.ahead]
        return found.filter("payload IS NOT NULL").selectExpr("payload.*", *cells)

    def _result(self, days: int, direction: str, name: str) -> str:
        """SQL of one aggregate from its pieces."""
        as_name = f"AS {name}_{direction}_{days}"
        if name in self.sums:
            end, start = ("upto", f"start_{days}") if direction == "back" else (f"end_{days}", "upto")
            return f"coalesce({end}.{name}, 0) - coalesce({start}.{name}, 0) {as_name}"
        if direction == "ahead":
            raise ValueError(f"only sums are taken ahead, not {name}")

        def value(pair: str, span: str) -> str:
            if name not in self.packed:
                return f"IF({pair}.span = {span}, {pair}.value, NULL)"
            return f"IF(abs({pair} - {span} * {2 * HALF}L) < {HALF}L, {pair} - {span} * {2 * HALF}L, NULL)"

        own, before = value(f"own_{days}.{name}", f"span_{days}"), value(f"before_{days}.{name}", f"(1 - span_{days})")
        best = f"greatest({own}, {before})"
        return f"{best} {as_name}" if self.extremes[name] == "max" else f"-{best} {as_name}"
