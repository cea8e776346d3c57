"""One UTC instant for text in many notations, precisions and zones.

Every value is turned into the array of its valid interpretations (an instant and the notation it was read
in): one regular expression per notation, all inside the JVM. What a source declares (zone, order of day and
month) leaves at most one interpretation, but for wall clocks that occur twice; a source without declaration
keeps one for each declared zone. A Viterbi pass over each source's record order chooses among those left,
with a price on switches of notation and on backward jumps. Records with one interpretation separate the
chain, so only the stretches between them are searched; chains are cut into blocks of 2^``BLOCK_BITS`` order keys, so
that no task holds more than one block of one source, and stretches that reach over a cut are settled by what the ways through
each block cost, which gives the same choice as one pass over the whole chain.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.runtime import shuffle_width, stage_table

BLOCK_BITS = 14
#: Price of reading two neighbours in different notations, and of going back in time (per doubling of the seconds).
SWITCH_PRICE, BACK_PRICE = 1.0, 0.5
#: Declared zones tried for a source that declares none; a larger table of sources is refused.
MOST_SOURCES = 10_000

# Offsets in minutes of the zone abbreviations, and the month names of mail dates.
ABBREVIATIONS = {"GMT": 0, "UTC": 0, "EST": -300, "EDT": -240, "CET": 60, "CEST": 120, "KST": 540, "JST": 540}
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_ZONE = r"\s*(Z|z|[+-]\d{2}:?\d{2})?"
_ISO = rf"^(\d{{4}})[-./](\d{{1,2}})[-./](\d{{1,2}})\.?(?:(?:[Tt]|\s+){_CLOCK})?{_ZONE}$"
_SHORT = rf"^(\d{{2}})[-./](\d{{1,2}})[-./](\d{{1,2}})\.?(?:\s+{_CLOCK})?{_ZONE}$"
_LAST = rf"^(\d{{1,2}})[-./](\d{{1,2}})[-./](\d{{4}})(?:,?\s+{_CLOCK}(?:\s*([AaPp])\.?[Mm]\.?)?)?{_ZONE}$"
_MAIL = rf"^(?:[A-Za-z]{{3,9}},?\s+)?(\d{{1,2}})\s+([A-Za-z]{{3}})[a-z]*\.?,?\s+(\d{{4}})(?:\s+{_CLOCK})?\s*(?:([+-]\d{{2}}:?\d{{2}}|Z)|([A-Za-z]{{3,4}}))?$"
_WORDS = rf"^([A-Za-z]{{3}})[a-z]*\.?\s+(\d{{1,2}}),?\s+(\d{{4}})(?:,?\s+{_CLOCK}(?:\s*([AaPp])\.?[Mm]\.?)?)?$"
_KOREAN = rf"^(\d{{4}})(?:년|\.)\s*(\d{{1,2}})(?:월|\.)\s*(\d{{1,2}})(?:일|\.)\s*(?:(오전|오후)\s*)?(?:{_CLOCK})?$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$"
_EPOCH = r"^(\d{10}|\d{13}|\d{16})$"
_TRIM = r"(?U)^[\s\x{FEFF}]+|[\s\x{FEFF}]+$"


@dataclass(frozen=True)
class Field:
    """A text column to read. zone, order: the columns of the sources' table that declare it (order may be None: year first)."""

    column: str
    zone: str
    order: str | None = None


#: Notation, pattern, and what the pattern's groups are rewritten to: year|month|day|hour|minute|second|fraction|half|zone.
_NOTATIONS = [
    ("year-first", _ISO, "$1|$2|$3|$4|$5|$6|$7||$8"),
    ("number", _EPOCH, "$1"),
    ("mail", _MAIL, "$3|$2|$1|$4|$5|$6|$7||$8$9"),
    ("month-first", _LAST, "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    ("compact", _COMPACT, "$1|$2|$3|$4|$5|$6|||"),
    ("two-digit", _SHORT, "20$1|$2|$3|$4|$5|$6|$7||$8"),
    ("korean", _KOREAN, "$1|$2|$3|$5|$6|$7|$8|$4|"),
    ("month-name", _WORDS, "$3|$1|$2|$4|$5|$6|$7|$8|"),
]
_CANDIDATES = "array<struct<instant:bigint,notation:string>>"
_HALF_HOUR = 1_800_000_000


def _wall(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column, fraction: Column) -> Column:
    """Microseconds of the wall clock since 1970, NULL if there is no such date or time. Digits beyond microseconds are cut."""
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    days = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    ok = (year >= 1) & month.between(1, 12) & (day >= 1) & (day <= days) & hour.between(0, 23) & minute.between(0, 59) & second.between(0, 59)
    micros = F.rpad(F.substring(fraction, 1, 6), 6, "0").cast("bigint")
    return F.when(ok, ((F.unix_date(F.make_date(year, month, day)).cast("bigint") * 24 + hour) * 60 + minute) * 60_000_000 + second.cast("bigint") * 1_000_000 + micros)


def _shown(instant: Column, zone: Column) -> Column:
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(instant), zone))


def _at_zone(wall: Column, zone: Column) -> Column:
    """Every instant at which clocks in ``zone`` show ``wall``: one, two (clocks set back) or none (set forward)."""
    first = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(wall), zone))
    out = F.array(first)
    for halves in (4, 1, 2):
        second = first + halves * _HALF_HOUR
        out = F.when(_shown(second, zone) == wall, F.array(first, second)).otherwise(out)
    return F.when(_shown(first, zone) == wall, out).otherwise(F.array().cast("array<bigint>"))


def _as_candidates(instants: Column, notation: Column) -> Column:
    pick = lambda k: F.struct(instants[k].alias("instant"), notation.alias("notation"))
    return F.when(F.size(instants) == 2, F.array(pick(0), pick(1))).when(F.size(instants) == 1, F.array(pick(0))).otherwise(F.array().cast(_CANDIDATES))


def interpretations(values: DataFrame, zones: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and ``cands array<struct<instant, notation>>`` of ``values`` (with ``text``, ``_zone``, ``_order``), instants in microseconds.

    Values without zone are read in ``_zone``, or, where that is NULL, in each of ``zones``; numeric dates that
    end with the year in ``_order`` (ymd: not at all), or, where that is NULL, in both orders. Each step is a
    projection of its own, so that nothing is matched twice.
    """
    empty = F.array().cast(_CANDIDATES)
    text, order = F.col("text"), F.col("_order")
    canon = F.lit(None).cast("string")
    for name, pattern, groups in reversed(_NOTATIONS):
        canon = F.when(text.rlike(pattern), F.concat(F.lit(name + "|"), F.regexp_replace(text, pattern, groups))).otherwise(canon)
    out = values.select(*keep, "_zone", "_order", F.length("text").alias("_n"), F.split(canon, r"\|", -1).alias("_p"))
    p = lambda i: F.get(F.col("_p"), F.lit(i))
    number = lambda i: p(i).try_cast("int")
    month = F.when(p(2).rlike("^[0-9]"), number(2)).otherwise(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(p(2))).cast("int"))
    kind, clock = p(0), F.coalesce(p(4), F.lit("")) != ""
    hour, late = number(4), p(8).isin("p", "P", "오후")
    hour = F.when(p(8) == "", hour).when(hour.between(1, 12), hour % 12 + F.when(late, 12).otherwise(0)).otherwise(F.when(clock, F.lit(99)))
    digits = F.regexp_replace(p(9), "[^0-9]", "")
    names = F.create_map(*(F.lit(v) for kv in ABBREVIATIONS.items() for v in kv))
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    signed = F.when((minutes <= 18 * 60) & (F.substring(digits, 3, 2).try_cast("int") < 60), F.when(p(9).startswith("-"), -minutes).otherwise(minutes))
    offset = F.when(F.upper(p(9)) == "Z", 0).when(F.length(digits) == 4, signed).otherwise(F.try_element_at(names, F.upper(p(9))))
    scale = F.when(F.col("_n") == 10, 1_000_000).when(F.col("_n") == 13, 1_000).otherwise(1).cast("bigint")
    out = out.select(
        *keep, "_zone", "_order", kind.alias("_kind"), number(1).alias("_y"), month.alias("_mo"), number(3).alias("_d"),
        F.coalesce(hour, F.lit(0)).alias("_h"), F.coalesce(number(5), F.lit(0)).alias("_mi"), F.coalesce(number(6), F.lit(0)).alias("_s"), F.coalesce(p(7), F.lit("")).alias("_f"),
        (F.coalesce(p(9), F.lit("")) != "").alias("_zoned"), F.when(F.coalesce(p(9), F.lit("")) != "", offset.cast("bigint")).alias("_offset"), F.when(kind == "number", p(1).try_cast("bigint") * scale).alias("_t"),
    )
    rest = [F.col(c) for c in ("_h", "_mi", "_s", "_f")]
    y, mo, d, last = F.col("_y"), F.col("_mo"), F.col("_d"), F.col("_kind") == "month-first"
    straight = F.when((F.col("_kind") != "number") & (~last | order.isNull() | (order == "mdy")), _wall(y, mo, d, *rest))
    swapped = F.when(last & (order.isNull() | (order == "dmy")), _wall(y, d, mo, *rest))
    out = out.select(*keep, "_zone", "_kind", "_zoned", "_offset", "_t", straight.alias("_w1"), swapped.alias("_w2"))
    zone, zoned = F.col("_zone"), F.col("_zoned")
    known = lambda w: F.when(F.col(w).isNull() | zoned | zone.isNull(), F.lit(None)).otherwise(_at_zone(F.col(w), zone))
    out = out.select("*", known("_w1").alias("_a1"), known("_w2").alias("_a2"))

    def read(wall: str, instants: str, notation: Column) -> Column:
        w = F.col(wall)
        fixed = F.when(F.col("_offset").isNotNull(), F.array(F.struct((w - F.col("_offset") * 60_000_000).alias("instant"), notation.alias("notation")))).otherwise(empty)
        tried = F.flatten(F.transform(F.array(*map(F.lit, zones)).cast("array<string>"), lambda z: _as_candidates(_at_zone(w, z), F.concat_ws(" ", notation, z))))
        return F.when(w.isNull(), empty).when(zoned, fixed).when(zone.isNotNull(), _as_candidates(F.col(instants), notation)).otherwise(tried)

    of_number = F.array(F.struct(F.col("_t").alias("instant"), F.col("_kind").alias("notation")))
    straight, swapped = read("_w1", "_a1", F.col("_kind")), read("_w2", "_a2", F.lit("day-first"))
    both = F.when(F.col("_t").isNotNull(), of_number).when(F.col("_w2").isNull(), straight).when(F.col("_w1").isNull(), swapped).otherwise(F.concat(straight, swapped))
    return out.select(*keep, both.alias("cands"))


#: Readings of one value: instants and the notations they were read in.
Readings = tuple[np.ndarray, np.ndarray]


def _prices(a: Readings, b: Readings) -> np.ndarray:
    """Price of every reading of b after every reading of a."""
    back = np.maximum(0, a[0][:, None] - b[0][None, :]) / 1e6
    return SWITCH_PRICE * (a[1][:, None] != b[1][None, :]) + BACK_PRICE * np.log2(1 + back)


def _best_path(values: list[Readings], before: Readings | None, after: Readings | None, first: int | None = None, last: int | None = None) -> list[int]:
    """Cheapest reading of each value; ties go to the earlier one. ``before``, ``after``: decided neighbours. ``first``, ``last``: readings that are fixed."""
    costs = _prices(before, values[0])[0] if before is not None else np.zeros(len(values[0][0]))
    if first is not None:
        costs = np.where(np.arange(len(costs)) == first, costs, np.inf)
    back = []
    for prev, here in zip(values, values[1:], strict=False):
        step = costs[:, None] + _prices(prev, here)
        back.append(step.argmin(axis=0))
        costs = step.min(axis=0)
    if after is not None:
        costs = costs + _prices(values[-1], after)[:, 0]
    path = [int(costs.argmin()) if last is None else last]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def _path_costs(values: list[Readings]) -> np.ndarray:
    """Cheapest price between every reading of the first value and every one of the last."""
    k = len(values[0][0])
    costs = np.where(np.eye(k, dtype=bool), 0.0, np.inf)
    for prev, here in zip(values, values[1:], strict=False):
        costs = (costs[:, :, None] + _prices(prev, here)[None, :, :]).min(axis=1)
    return costs


#: part: NULL for a decided row; of an open row, whether it stands before the first single reading of its block, after the last one, or in a
#: block without any; the row that tells a block's first and last single reading has no id.
LEAD, TRAIL, WHOLE, BLOCK = range(4)
_CHOSEN = "id bigint, field_name string, instant bigint, n_valid int, chain bigint, block bigint, part int, instants array<bigint>, notations array<string>"
_NAMES = ["id", "field_name", "instant", "n_valid", "chain", "block", "part", "instants", "notations"]
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string())]


def _readings(instants: list[int], notations: list[str]) -> Readings:
    return np.array(instants, np.int64), np.array(notations, object)


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input is sorted by (chain, block, id). Stretches between two single readings of a block are searched; those at its borders are handed on."""
    open_rows: list[tuple[int, str, list[int], list[str]]] = []
    at: tuple | None = None
    first: tuple[int, str] | None = None
    before: tuple[int, str] | None = None
    out: list[tuple] = []

    def hand_on(part: int) -> None:
        out.extend((i, f, None, len(set(t)), *at, part, t, n) for i, f, t, n in open_rows)
        open_rows.clear()

    def single(value: tuple[int, str]) -> None:
        nonlocal first, before
        if open_rows and before is None:
            hand_on(LEAD)
        elif open_rows:
            values = [_readings(t, n) for _, _, t, n in open_rows]
            path = _best_path(values, _readings([before[0]], [before[1]]), _readings([value[0]], [value[1]]))
            out.extend((i, f, t[k], len(set(t)), None, None, None, None, None) for (i, f, t, _), k in zip(open_rows, path, strict=True))
            open_rows.clear()
        first, before = first or value, value

    def close() -> None:
        nonlocal first, before
        if at is not None:
            if open_rows:
                hand_on(WHOLE if before is None else TRAIL)
            if first is not None:
                out.append((None, None, None, None, *at, BLOCK, [first[0], before[0]], [first[1], before[1]]))
        first = before = None

    def flush() -> Iterator[pa.RecordBatch]:
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], _NAMES)
            out.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        ids, fields, cands = (batch.column(batch.schema.get_field_index(n)) for n in ("id", "field_name", "cands"))
        chain, block = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("chain", "block"))
        n = np.diff(cands.offsets.to_numpy())
        wide, singles = np.flatnonzero(n > 1), np.flatnonzero(n == 1)
        # a row matters if it has several readings, is the nearest single one before or after such, or the first or last single one of its block
        starts = np.concatenate([[0], np.flatnonzero((np.diff(chain) != 0) | (np.diff(block) != 0)) + 1])
        near = set(wide.tolist()) | set(starts.tolist())
        if len(singles):
            k = np.searchsorted(singles, wide)
            near |= set(singles[np.clip(k - 1, 0, None)].tolist()) | set(singles[np.clip(k, None, len(singles) - 1)].tolist())
            low, high = np.searchsorted(singles, starts), np.searchsorted(singles, np.append(starts[1:], len(n)))
            some = high > low
            near |= set(singles[low[some]].tolist()) | set(singles[high[some] - 1].tolist())
        flat = cands.flatten()
        start = np.concatenate([[0], np.cumsum(n)])
        instants, notations = flat.field("instant"), flat.field("notation")
        for r in sorted(near):
            if (chain[r], block[r]) != at:
                close()
                at = (int(chain[r]), int(block[r]))
            here = slice(int(start[r]), int(start[r + 1]))
            times, names = instants[here].to_pylist(), notations[here].to_pylist()
            if len(times) == 1:
                single((times[0], names[0]))
            elif times:
                open_rows.append((ids[r].as_py(), fields[r].as_py(), times, names))
        # a plain neighbour that was skipped lies between two singles and changes nothing
        plain = np.flatnonzero(n <= 1)
        if len(plain):
            take = pa.array(plain)
            where = pa.array(np.where(n[plain] == 1, start[plain], 0), mask=n[plain] == 0)
            value = instants.take(where) if len(instants) else pa.nulls(len(plain), pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(take), fields.take(take), value, pa.array(n[plain].astype(np.int32)), *(pa.nulls(len(plain), t) for t in _TYPES[4:])], _NAMES)
        yield from flush()
    close()
    yield from flush()


def _edges(pdf: pd.DataFrame) -> tuple[Readings | None, Readings | None]:
    """First and last single reading of a block."""
    told = pdf[pdf["part"] == BLOCK]
    if told.empty:
        return None, None
    t, n = told["instants"].iloc[0], told["notations"].iloc[0]
    return _readings(t[:1], n[:1]), _readings(t[1:], n[1:])


def _open_parts(pdf: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame, list[Readings]]]:
    for part in (LEAD, TRAIL, WHOLE):
        rows = pdf[pdf["part"] == part].sort_values("id", kind="stable")
        if len(rows):
            yield part, rows, [_readings(t, n) for t, n in zip(rows["instants"], rows["notations"], strict=True)]


def _summarise(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row for a block: its first and last single reading, and for each open part its outer readings and what ways between them cost."""
    first, last = _edges(pdf)
    told: dict = {"first": first and [first[0].tolist(), first[1].tolist()], "last": last and [last[0].tolist(), last[1].tolist()]}
    for part, _, values in _open_parts(pdf):
        costs = _path_costs(values)
        if part == LEAD:
            costs = (costs + _prices(values[-1], first)[:, 0][None, :]).min(axis=1, keepdims=True)
        if part == TRAIL:
            costs = (_prices(last, values[0])[0][:, None] + costs).min(axis=0, keepdims=True)
        told[str(part)] = [[v[0].tolist(), v[1].tolist()] for v in (values[0], values[-1])] + [costs.tolist()]
    return pd.DataFrame({"chain": [pdf["chain"].iloc[0]], "block": [pdf["block"].iloc[0]], "told": [json.dumps(told)]})


def _settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """Readings at the borders of a chain's blocks, chosen over all stretches that reach across them: ``block, part, low, high``."""
    out: list[tuple] = []
    # pieces of the stretch that is open: (block, part, costs), and what arrives at the last piece's last readings
    pieces: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    ends: Readings | None = None
    costs = np.zeros(0)

    def add(block: int, part: int, told: list) -> None:
        nonlocal ends, costs
        (f, g), (t, u), way = told[0], told[1], np.array(told[2])
        if ends is None:
            arrive, came = (np.zeros(way.shape[0]), np.zeros(way.shape[0], np.int64))
        else:
            step = costs[:, None] + _prices(ends, _readings(f, g))
            arrive, came = step.min(axis=0), step.argmin(axis=0)
            if part == TRAIL:
                raise AssertionError("a stretch cannot go on before a single reading")
        total = arrive[:, None] + way
        pieces.append((block, part, came, total.argmin(axis=0)))
        costs, ends = total.min(axis=0), _readings(t, u)

    def close(after: Readings | None) -> None:
        nonlocal ends, costs
        if pieces:
            high = int((costs + (_prices(ends, after)[:, 0] if after is not None else 0)).argmin())
            for block, part, came, low_of in reversed(pieces):
                low = int(low_of[high])
                out.append((block, part, None if part == TRAIL else low, None if part == LEAD else high))
                high = int(came[low]) if len(came) else 0
        pieces.clear()
        ends, costs = None, np.zeros(0)

    for block, told in sorted(zip(pdf["block"], map(json.loads, pdf["told"]), strict=True)):
        if str(WHOLE) in told:
            add(block, WHOLE, told[str(WHOLE)])
            continue
        if str(LEAD) in told:
            add(block, LEAD, told[str(LEAD)])
            close(None)
        else:
            close(_readings(*told["first"]))
        if str(TRAIL) in told:
            add(block, TRAIL, told[str(TRAIL)])
        # without open rows the next stretch follows this block's last single reading
        elif told["last"]:
            single = _readings(*told["last"])
            ends, costs = single, np.zeros(1)
            pieces.append((block, BLOCK, np.zeros(0, np.int64), np.zeros(1, np.int64)))
    close(None)
    return pd.DataFrame([(pdf["chain"].iloc[0], *o) for o in out if o[1] != BLOCK], columns=["chain", "block", "part", "low", "high"])


def _decide(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows of a block's open parts with the outer readings that were settled."""
    first, last = _edges(pdf)
    rows = []
    for part, part_rows, values in _open_parts(pdf):
        low, high = (None if pd.isna(x) else int(x) for x in (part_rows["low"].iloc[0], part_rows["high"].iloc[0]))
        path = _best_path(values, last if part == TRAIL else None, first if part == LEAD else None, low, high)
        rows += [(i, f, int(v[0][k]), n) for i, f, n, v, k in zip(part_rows["id"], part_rows["field_name"], part_rows["n_valid"], values, path, strict=True)]
    return pd.DataFrame(rows, columns=["id", "field_name", "instant", "n_valid"])


def _across_blocks(chosen: DataFrame) -> DataFrame:
    """``id, field_name, instant, n_valid`` of the open rows at the borders of blocks.

    The way through a block matters to its neighbours only by what it costs between its outer readings, so blocks are
    searched side by side, their outer readings are settled along each chain (one row per block), and blocks are searched again between these.
    """
    # rows that tell of a block get numbers too, so that ids stay whole numbers in pandas
    told = chosen.where("part IS NOT NULL").withColumns({"id": F.coalesce("id", F.lit(0)), "n_valid": F.coalesce("n_valid", F.lit(0)), "instant": F.lit(0).cast("bigint")})
    blocks = stage_table(told.groupBy("chain", "block").applyInPandas(_summarise, "chain bigint, block bigint, told string"), "blocks")
    settled = blocks.groupBy("chain").applyInPandas(_settle, "chain bigint, block bigint, part int, low int, high int")
    rows = told.where(F.col("part") == BLOCK).withColumns({"low": F.lit(None).cast("int"), "high": F.lit(None).cast("int")}).unionByName(told.where(F.col("part") != BLOCK).join(settled, ["chain", "block", "part"]))
    return rows.groupBy("chain", "block").applyInPandas(_decide, "id bigint, field_name string, instant bigint, n_valid int")


def normalise_instants(records: DataFrame, sources: DataFrame, fields: list[Field], block_bits: int = BLOCK_BITS) -> DataFrame:
    """``id, field_name, instant, n_valid`` for each non-blank value of ``fields`` in ``records`` (``id, source, …``).

    instant: microseconds since 1970 UTC of the chosen interpretation, NULL if there is none. n_valid: different
    instants the value may mean (0: not a time, or never shown by clocks of its zone; 2 or more: undecided by
    what its source declares, ``instant`` is then the choice of the Viterbi pass). ``id`` must be unique and grow
    in record order. Blank values (NULL, empty, white space) give no row. A NULL or undeclared source leaves
    values without zone undecided. ``sources`` (``source`` and the columns that ``fields`` name) is a
    configuration table; more than ``MOST_SOURCES`` rows are refused. Other columns are ignored.
    """
    wanted = list(dict.fromkeys(c for f in fields for c in (f.zone, f.order) if c))
    declared = sources.select("source", *wanted).where(F.col("source").isNotNull()).dropDuplicates(["source"])
    rows = declared.limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} declared sources")
    side = F.broadcast(declared.select(F.col("source").alias("_source"), *(F.col(c).alias(f"_{c}") for c in wanted), F.lit(True).alias("_known")))
    parts = [F.struct(F.lit(f.column).alias("field_name"), F.regexp_replace(f.column, _TRIM, "").alias("text"), F.lit(k).alias("k")) for k, f in enumerate(fields)]
    long = records.select("id", F.col("source").alias("_s"), F.explode(F.array(*parts)).alias("v")).select("id", "_s", "v.*").where(F.length("text") > 0)
    long = long.join(side, F.col("_s") == F.col("_source"), "left")

    def by_field(pick) -> Column:
        out = F.lit(None).cast("string")
        for k, f in enumerate(fields):
            out = F.when(F.col("k") == k, pick(f)).otherwise(out)
        return out

    zone = by_field(lambda f: F.col(f"_{f.zone}"))
    order = by_field(lambda f: F.when(F.col("_known"), F.col(f"_{f.order}")) if f.order else F.lit("ymd"))
    zones = sorted({r[f.zone] for f in fields for r in rows if r[f.zone]})
    chain, block = F.xxhash64("_s", "k"), F.shiftright("id", block_bits)
    narrow = interpretations(long.select("id", "field_name", "text", zone.alias("_zone"), order.alias("_order"), chain.alias("chain"), block.alias("block")), zones, ["id", "field_name", "chain", "block"])
    laid = narrow.repartition(shuffle_width(records.sparkSession, records), "chain", "block").sortWithinPartitions("chain", "block", "id")
    chosen = stage_table(laid.mapInArrow(_choose, _CHOSEN), "instants")
    decided = chosen.where("part IS NULL").select("id", "field_name", "instant", "n_valid")
    if not chosen.where(F.col("part") != BLOCK).limit(1).count():
        return decided
    return decided.unionByName(_across_blocks(chosen))


def instant_text(micros: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS`` in UTC, whatever the session's zone; NULL stays NULL."""
    seconds = F.floor(micros / 1_000_000).cast("bigint")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86_400).cast("int"))
    rest = F.pmod(seconds, F.lit(86_400))
    clock = F.format_string("%02d:%02d:%02d.%06d", F.floor(rest / 3600).cast("int"), F.floor(rest % 3600 / 60).cast("int"), (rest % 60).cast("int"), F.pmod(micros, F.lit(1_000_000)))
    return F.when(micros.isNotNull(), F.concat(day.cast("string"), F.lit(" "), clock))
