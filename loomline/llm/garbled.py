"""Text that was decoded with the wrong character encoding: where it is, and what it was.

For every pair of encodings (written in, read as) the garbled form of every character of the repertoire is computed once, and
all forms go into one Aho-Corasick automaton. A text is scanned once; the longest leftmost matches are replaced by
the original characters and nothing else is touched, so correct text beside a garbled span stays as it is. Forms that
could also be correct text (single accented pairs, letters of one other script, those of Chinese characters) count only
where a neighbour or the rest of the text is garbled too.

Covered: UTF-8 read in any of ``READINGS`` (twice for the two commonest), Korean bytes read as Latin, UTF-8 and Latin text read in a double-byte encoding
(there one character may come from parts of two, so whole runs are turned back), and Cyrillic or Greek bytes read as Latin-1 where a
whole word shows it. Not covered: one Latin single-byte encoding read as another (a single accented letter for a single accented letter).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOST = "�"


def _read(data: bytes, encoding: str) -> str | None:
    """Decodes as programs do; the five bytes that windows-1252 leaves open pass through."""
    if encoding != "cp1252":
        try:
            return data.decode(encoding)
        except UnicodeDecodeError:
            return None
    return "".join(bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in data)


#: Single-byte encodings that UTF-8 is read in.
COMMON = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "iso8859-15")
READINGS = (*COMMON, "cp1251", "koi8_r")
#: (written in, read as), applied from left to right; several steps are repeated garbling.
PAIRS: list[tuple[tuple[str, str], ...]] = [
    *(((("utf-8", wrong),) * 2) for wrong in ("cp1252", "latin-1")),
    *((("utf-8", wrong),) for wrong in COMMON),
    *((("euc_kr", wrong),) for wrong in ("cp1252", "latin-1")),
]
#: Read as a double-byte encoding: one character may come out as a single, otherwise correct one.
DOUBLE_BYTE = ("cp949", "gb18030", "big5", "shift_jis")
#: Several characters of this repertoire make up the texts: Latin letters and signs, typographic marks, kana, Hangul; and Greek and Cyrillic (beside Chinese).
WIDE = [(0x370, 0x3FF), (0x400, 0x45F)]
RANGES = [(0xA0, 0x17F), (0x2009, 0x2027), (0x202F, 0x203A), (0x20AC, 0x20AC), (0x2116, 0x2122), (0x2190, 0x2195), (0x3000, 0x3015), (0x3041, 0x30FE), (0x33A0, 0x33C4), (0xAC00, 0xD7A3)]
LATIN = [chr(c) for a, b in ((0xA1, 0x17F), (0x2013, 0x2026), (0x20AC, 0x20AC)) for c in range(a, b + 1)]


def _characters(ranges: list[tuple[int, int]]) -> list[str]:
    return [chr(c) for a, b in ranges for c in range(a, b + 1)]


def _han() -> Iterator[str]:
    """Chinese characters of the common national character sets."""
    for c in map(chr, range(0x4E00, 0xA000)):
        for encoding in ("gb2312", "euc_kr", "shift_jis"):
            try:
                c.encode(encoding)
            except UnicodeEncodeError:
                continue
            yield c
            break


def _is_weak(form: str) -> bool:
    """Correct text can hold such a form: letters of a script other than Latin only."""
    other = all(c.isalpha() and not ("a" <= c.lower() <= "z" or "\u00c0" <= c <= "\u024f") for c in form)
    return other and not any(a.islower() and b.isupper() for a, b in zip(form, form[1:], strict=False))


def _garble(char: str, steps: tuple[tuple[str, str], ...]) -> str | None:
    for written, read in steps:
        try:
            char = _read(char.encode(written), read)
        except UnicodeEncodeError:
            return None
        if char is None:
            return None
    return char


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Garbled form -> (form, original from UTF-8 or None, original from a Korean encoding or None)."""
    found: dict[str, list] = {}
    for steps in PAIRS:
        korean = steps[0][0] == "euc_kr"
        for c in _characters(RANGES):
            form = _garble(c, steps)
            if form is None or len(form) < 2 or form.isascii():
                continue
            value = found.setdefault(form, [form, None, None])
            value[1 + korean] = value[1 + korean] or c
    # two bytes of a Korean encoding that happen to be valid UTF-8: letters that no language of the repertoire has
    for c in (*range(0x1C0, 0x1CD), *range(0x1DD, 0x218), *range(0x21C, 0x240)):
        try:
            found[chr(c)] = [chr(c), chr(c).encode().decode("cp949"), None]
        except UnicodeDecodeError:
            continue
    out = ahocorasick.Automaton()
    for form, value in found.items():
        out.add_word(form, tuple(value))
    out.make_automaton()
    return out


@lru_cache(maxsize=1)
def wide_automaton() -> ahocorasick.Automaton:
    """The same for the scripts and readings that ``automaton`` leaves out: form -> (form, whether correct text can hold it, (encodings of ``READINGS`` as bits, original), …)."""
    found: dict[str, dict[str, int]] = {}
    doubtful = set()
    for k, wrong in enumerate(READINGS):
        for chinese, chars in ((False, _characters(WIDE if wrong in COMMON else [*WIDE, *RANGES])), (True, _han())):
            for c in chars:
                form = _garble(c, (("utf-8", wrong),))
                if form is None or len(form) < 2 or form.isascii():
                    continue
                originals = found.setdefault(form, {})
                originals[c] = originals.get(c, 0) | 1 << k
                if chinese or _is_weak(form):
                    doubtful.add(form)
    out = ahocorasick.Automaton()
    for form, originals in found.items():
        out.add_word(form, (form, form in doubtful, *((bits, c) for c, bits in originals.items())))
    out.make_automaton()
    return out


@lru_cache(maxsize=1)
def latin_as_double_byte() -> dict[str, str]:
    """Characters that a Latin one (or a windows-1252 one with the ASCII letter after it) becomes when read in a double-byte encoding."""
    out: dict[str, str] = {}
    for c in LATIN:
        for wrong in DOUBLE_BYTE:
            form = _garble(c, (("utf-8", wrong),))
            if form and len(form) == 1 and not form.isascii() and form not in LATIN:
                out.setdefault(form, c)
        try:
            byte = c.encode("cp1252")
        except UnicodeEncodeError:
            continue
        for letter in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
            form = _read(byte + letter.encode(), "cp949")
            if form and len(form) == 1 and "가" <= form <= "힣":
                out.setdefault(form, c + letter)
    for pair in product("äöüßéèêëàâçîïôûùñáíóú", repeat=2):
        form = _read("".join(pair).encode("cp1252"), "cp949")
        if form and len(form) == 1:
            out.setdefault(form, "".join(pair))
    return out


_HANGUL = regex.compile(r"\p{Hangul}")
_KANA = regex.compile(r"[\p{Hiragana}\p{Katakana}\p{Han}。、「」ー]")
_LATIN_LETTER = regex.compile(r"\p{Latin}")
#: A word of letters from the upper half of Latin-1 only; no language of Latin script writes four in a row.
_UPPER_HALF = regex.compile(r"(?<![\p{L}\p{M}])[\u00c0-\u00ff\u00a8\u00b8]+(?![\p{L}\p{M}])")
#: A capital beyond ASCII inside a word.
_UGLY = regex.compile(r"(?V1)\p{Ll}[\p{Lu}--[A-Z]]|[\p{Lu}--[A-Z]]\p{Ll}+[\p{Lu}--[A-Z]]")
_CONTROL = regex.compile(r"[\x80-\x84\x86-\x9f]")
_EAST = regex.compile(r"[\p{Hangul}\p{Han}\p{Hiragana}\p{Katakana}]")
_RUN = regex.compile(r"[^\x00-\x7f]{2,}")
_MIXED = regex.compile(r"(?<=[A-Za-z])[^\x00-\x7f]|[^\x00-\x7f](?=[A-Za-z])")

Span = tuple[int, int, str]


def _covered(spans: list[Span]) -> int:
    return sum(b - a for a, b, _ in spans)


def _spans(text: str) -> tuple[list[Span], list[Span], bool]:
    """Accepted matches, those that are UTF-8, and whether some are Korean read as Latin. Forms of a Korean encoding are two signs or accented letters, which correct text can hold too: they
    count if two stand beside each other, if one fills a word of its own, or if the text holds two that count."""
    found: list[tuple[int, int, str | None, str | None]] = []
    end = 0
    for last, (form, utf, korean) in automaton().iter_long(text):
        first = last - len(form) + 1
        if first >= end:
            if len(form) > 1 or _stands_in_korean(text, first):
                found.append((first, last + 1, utf, korean))
            end = last + 1
    if not found:
        return [], [], False
    only = [k for k, (_, _, utf, korean) in enumerate(found) if utf is None]
    counts = set()
    for k in only:
        a, b = found[k][:2]
        beside = any(found[j][3] is not None and (found[j][1] == a or found[j][0] == b) for j in (k - 1, k + 1) if 0 <= j < len(found))
        before, after = text[a - 1 : a], text[b : b + 1]
        word = not (before.isalpha() and not _EAST.match(before)) and not (after.isalpha() and not _EAST.match(after))
        hangul = "가" <= found[k][3] <= "힣"
        if beside and hangul or word and hangul and (text[a:b].isupper() or not text[a:b].isalpha()):
            counts.add(k)
    is_korean = len(counts) >= 2 and len(counts) >= sum(1 for _, _, _, korean in found if korean is None)
    out = []
    for k, (a, b, utf, korean) in enumerate(found):
        if utf is None:
            if k in counts or is_korean:
                out.append((a, b, korean))
        else:
            out.append((a, b, korean if is_korean and korean else utf))
    return out, [(a, b, utf) for a, b, utf, _ in found if utf is not None], bool(counts)


def _stands_in_korean(text: str, at: int) -> bool:
    """Whether a single letter stands among Korean or lost text and not beside a Latin letter."""
    return (LOST in text or bool(_HANGUL.search(text))) and not _LATIN_LETTER.search(text[max(0, at - 1) : at] + text[at + 1 : at + 2])


def _wide_spans(text: str, taken: list[Span]) -> list[Span]:
    """Forms of the other scripts outside of ``taken``. Doubtful ones count beside another span, or if a certain one is in the text."""
    found, end = [], 0
    for last, (form, doubtful, *originals) in wide_automaton().iter_long(text):
        first = last - len(form) + 1
        if first >= end and not any(a < last + 1 and first < b for a, b, _ in taken):
            found.append((first, last + 1, doubtful, originals))
            end = last + 1
    if not found:
        return []
    sure = bool(taken) or not all(f[2] for f in found)
    ends, starts = {f[1] for f in found} | {b for _, b, _ in taken}, {f[0] for f in found} | {a for a, _, _ in taken}
    kept = [f for f in found if not f[2] or sure or f[0] in ends or f[1] in starts]
    # the encoding that explains most of the forms decides where several do
    votes = [sum(any(bits >> k & 1 for bits, _ in f[3]) for f in kept) for k in range(len(READINGS))]
    best = votes.index(max(votes))
    return [(a, b, next((c for bits, c in originals if bits >> best & 1), originals[0][1])) for a, b, _, originals in kept]


def _lost_back(run: str) -> str | None:
    """The original of a run of Korean double-byte characters that spells UTF-8 but for some lost bytes.

    Each replacement character stands for one byte. A first byte can be told from the two that follow if one syllable of the national
    character set fits only; what cannot be told is one replacement character. At least half of the characters must come back.
    """
    data = bytearray()
    for c in run:
        try:
            data += b"\xff" if c == LOST else c.encode("cp949")
        except UnicodeEncodeError:
            return None
    out, i, good = [], 0, 0
    while i < len(data):
        size = 3 if 0xE0 <= data[i] < 0xF0 else 2 if 0xC2 <= data[i] < 0xE0 else 1
        try:
            char = bytes(data[i : i + size]).decode("utf-8")
        except UnicodeDecodeError:
            char = None
        if char is not None:
            out.append(char)
            good += "\uac00" <= char <= "\ud7a3"
            i += size
            continue
        follow = data[i + 1 : i + 3]
        if data[i] == 0xFF and len(follow) == 2 and all(0x80 <= b < 0xC0 for b in follow):
            fits = [s for s in (_syllable(lead, follow) for lead in range(0xEA, 0xEE)) if s]
            out.append(fits[0] if len(fits) == 1 else LOST)
            i += 3
            continue
        if not out or out[-1] != LOST:
            out.append(LOST)
        i += 1
    return "".join(out) if good >= 2 and 2 * good >= len(out) else None


def _syllable(lead: int, follow: bytes) -> str | None:
    try:
        char = bytes([lead, *follow]).decode("utf-8")
        char.encode("euc_kr")
    except UnicodeError:
        return None
    return char if "\uac00" <= char <= "\ud7a3" else None


@lru_cache(maxsize=1 << 16)
def _may_begin(char: str) -> bool:
    """Whether the character's bytes in one of the double-byte encodings may begin a UTF-8 sequence (or were lost)."""
    if char == LOST:
        return True
    for wrong in ("cp949", "gb18030", "shift_jis"):
        try:
            data = char.encode(wrong)
        except UnicodeEncodeError:
            continue
        if 0xC2 <= data[0] <= 0xF4 and (len(data) == 1 or 0x80 <= data[1] <= 0xBF):
            return True
    return False


def _run_back(run: str) -> str | None:
    """The original of a run of double-byte characters if it spells UTF-8."""
    if LOST in run:
        return _lost_back(run)
    for wrong in ("cp949", "gb18030", "shift_jis"):
        try:
            back = run.encode(wrong).decode("utf-8")
        except UnicodeError:
            continue
        if back != run and len(back) < len(run) * 2 and all(c >= "가" and c <= "힣" or c in LATIN or c.isascii() or wrong == "shift_jis" and _KANA.match(c) for c in back):
            return back
    return None


def repair(text: str) -> tuple[bool, str, bool]:
    """Whether the text holds a garbled span; the text with the spans replaced; whether all of it could be recovered."""
    if text.isascii():
        return False, text, True
    if not _maybe().search(text):
        return _finish(text, [])
    spans, of_utf, korean = _spans(text)
    # the same signs may be bytes of Korean, UTF-8 in one reading or another, or another script's own bytes: what explains more of them counts
    ways = [spans if korean else sorted(spans + _wide_spans(text, spans)), _other_script(text)]
    if korean:
        wide = _wide_spans(text, [])
        ways.append(sorted(wide + [s for s in of_utf if not any(a < s[1] and s[0] < b for a, b, _ in wide)]))
    if ways[0]:
        ways += [_whole_runs(text, reading) for reading in READINGS]
    spans = max(ways, key=lambda w: (_covered(w), -len(_UGLY.findall(_replaced(text, w)))))
    return _finish(text, spans)


@lru_cache(maxsize=1)
def _maybe() -> re.Pattern:
    """What every form begins with (or is, if it is one letter), and four letters of the upper half of Latin-1 in a row: texts without it need no scan."""
    begins, single = {}, set()
    for one in (automaton(), wide_automaton()):
        for form in one.keys():
            if len(form) > 1:
                begins.setdefault(form[0], set()).add(form[1])
            else:
                single.add(form)
    same: dict[str, set] = {}
    for first, second in begins.items():
        same.setdefault("".join(sorted(second)), set()).add(first)
    some = lambda chars: "[" + "".join(map(re.escape, sorted(chars))) + "]"
    return re.compile("|".join([*(some(firsts) + some(seconds) for seconds, firsts in same.items()), some(single), "[\u00c0-\u00ff\u00a8\u00b8]{4}"]))


def _finish(text: str, spans: list[Span]) -> tuple[bool, str, bool]:
    if not spans or LOST in text:
        spans = sorted(spans + _double_byte(text, spans))
    lost = LOST in text and not _lost_filled(text, spans) or bool(_CONTROL.search("".join(_between(text, spans))))
    if not spans and not lost:
        return False, text, True
    return True, _replaced(text, spans), not lost


def _replaced(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for a, b, original in spans:
        if a < at:
            continue
        out += [text[at:a], original]
        at = b
    return "".join([*out, text[at:]])


def _lost_filled(text: str, spans: list[Span]) -> bool:
    """Whether every replacement character lies in a span whose original is known in full."""
    return LOST not in "".join(_between(text, spans)) and not any(LOST in original for _, _, original in spans)


def _other_script(text: str) -> list[Span]:
    """Words of Cyrillic or Greek bytes read as Latin-1."""
    words = list(_UPPER_HALF.finditer(text))
    if all(len(m[0]) < 4 for m in words) or not _UPPER_HALF.sub("", text).isascii():
        return []
    best: list[Span] = []
    most = 0.0
    for written, script, common in (("cp1251", r"\p{Cyrillic}+", "оеаинтсрвл"), ("cp1253", r"\p{Greek}+", "αοιετσνηυρ")):
        try:
            back = [m[0].encode("latin-1").decode(written) for m in words]
        except UnicodeDecodeError:
            continue
        # a word has no capital but its first letter; Korean bytes read so have one in every second place
        if all(regex.fullmatch(script, b) and b[1:].islower() for b in back):
            letters = "".join(back).lower()
            share = sum(c in common for c in letters) / len(letters)
            if share > most:
                best, most = [(m.start(), m.end(), b) for m, b in zip(words, back, strict=True)], share
    return best


def _whole_runs(text: str, reading: str) -> list[Span]:
    """Runs of signs beyond ASCII that are UTF-8 as a whole in one reading."""
    out = []
    for m in _RUN.finditer(text):
        data = _bytes(m[0], reading)
        if data is None:
            continue
        try:
            out.append((m.start(), m.end(), data.decode("utf-8")))
        except UnicodeDecodeError:
            continue
    return out


def _bytes(text: str, reading: str) -> bytes | None:
    """The bytes that ``_read`` showed as ``text``."""
    try:
        return text.encode(reading)
    except UnicodeEncodeError:
        if reading != "cp1252":
            return None
    try:
        return b"".join(bytes([ord(c)]) if ord(c) in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else c.encode(reading) for c in text)
    except UnicodeEncodeError:
        return None


def _between(text: str, spans: list[Span]) -> Iterator[str]:
    at = 0
    for a, b, _ in spans:
        yield text[at:a]
        at = b
    yield text[at:]


def _double_byte(text: str, taken: list[Span]) -> list[Span]:
    first = _EAST.search(text)
    if not first:
        return []
    out = []
    latin = latin_as_double_byte()
    if first[0] in latin and all(c in latin for c in _EAST.findall(text)):
        out = [(m.start(), m.end(), latin[m[0]]) for m in _EAST.finditer(text)] if _MIXED.search(text) else []
    if not out:
        for m in _RUN.finditer(text):
            if _may_begin(m[0][0]) and _EAST.search(m[0]) and (back := _run_back(m[0])) is not None:
                out.append((m.start(), m.end(), back))
    return [s for s in out if not any(a < s[1] and s[0] < b for a, b, _ in taken)]


_FOUND = "id bigint, field_name string, text string, repaired string, recovered boolean"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        rows = []
        for c in range(1, batch.num_columns):
            name = batch.schema.names[c]
            for i, text in zip(ids, batch.column(c).to_pylist(), strict=True):
                if text is not None:
                    hit, fixed, whole = repair(text)
                    if hit:
                        rows.append((i, name, text, fixed, whole))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()), strict=True)], ["id", "field_name", "text", "repaired", "recovered"])


def garbled_fields(records: DataFrame, fields: list[str], id_column: str = "id") -> DataFrame:
    """``id, field_name, text, repaired, recovered`` for each field that holds a garbled span.

    recovered is false where characters are lost for good (replacement characters, stray control codes); what can be repaired
    is repaired all the same. NULL, empty and correct texts give no row. Texts are scanned whole. Nothing is shuffled.
    """
    # ASCII text cannot be garbled in these encodings
    wide = [F.when(F.col(f).rlike(r"[^\x00-\x7f]"), F.col(f)).alias(f) for f in fields]
    some = records.select(F.col(id_column).cast("bigint").alias("id"), *wide).where(F.coalesce(*map(F.col, fields)).isNotNull())
    return some.mapInArrow(_scan, _FOUND)
