"""Sentence boundaries across languages and scripts (problem 4).

A pushdown automaton walks over the marks of each line. Its stack holds open quotation marks and brackets, and a second
one the open levels of lists from line to line, which each sentence comes out with; a terminator counts only while the stack is empty, or where it closes a quotation that
the next sentence follows. A trie of abbreviations, the digits around a full stop and the case of what follows decide
what a full stop is. Thai has no terminators: there a blank ends a sentence unless what stands beside it needs it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Marks, abbreviations and words that go on a sentence.
PAIRS = {"(": ")", "（": "）", "[": "]", "［": "］", "【": "】", "〔": "〕", "{": "}", "「": "」", "『": "』", "〈": "〉", "《": "》", "“": "”", "‘": "’", "«": "»", "„": "“", "‹": "›", "｢": "｣", "〝": "〟"}
QUOTES = "“”„\"«»「」『』‘’‹›〝〟｢｣"
ALWAYS = "。！？｡‼⁇⁈⁉।॥።॥"  # end a sentence without a blank after them
NEED_BLANK = ".!?؟؛．…۔"
#: Never the end of a sentence: a name, number or further text goes on after them.
OPEN_ABBREVIATIONS = (
    "dr mr mrs ms mx prof st sr rev hon gen col capt lt sgt messrs no nos vol vols ver fig figs p pp ch sec art arts par ed eds vs cf e.g i.e viz ca approx dept est tel "
    "nr abs bd hrsg hr fr str mio mrd tsd z b z.b d h d.h u a u.a s vgl ggf bzw evtl inkl zzgl bsp geb gest jh sog "
    "m mm mme mlle me mgr av bd éd env n chap apr jan feb febr mar aug sept oct nov dec "
    "डॉ श्री प्रो पं रु कु सं د أ م ص ดร นพ พ.ศ ค.ศ รศ ผศ"
)
#: May end a sentence: they do where a capital follows.
CLOSING_ABBREVIATIONS = "a.m p.m u.k u.s u.n e.u d.c etc usw co inc ltd corp bros jr al ph.d b.a m.a n.y j.-c apt ave blvd"
NUMBERED = {"no", "nos", "p", "pp", "art", "arts", "s", "a", "h", "m", "b", "z", "u", "d", "n", "ed", "sec", "ch", "mar", "par", "fig", "me", "av", "est", "ms"}
GERMAN = re.compile(r"\b(?:der|die|das|und|in|zu|von|am|im|mit|für|laut|nach|sitzung|auflage|lesen|platz)\b", re.I)
JA_GOES_ON = re.compile(r"(?:と|って|、|，|,|は|が|の|を|に|も|で|など|라|고|이라|라며)")
THAI_GOES_ON = re.compile(
    r"(?:เพื่อ|ใน|และ|ที่|หรือ|แต่|ซึ่ง|โดย|เมื่อ|จาก|กับ|ของ|แก่|ตาม|ด้วย|ว่า|จน|ถึง|เพราะ|หาก|ถ้า|ให้|ต่อ|สำหรับ|ระหว่าง|ภายใน|รวม|คือ|เป็น|อยู่|ไปยัง|แล้ว|ณ|ทั้ง|พร้อม|ขณะ|ก่อน|หลัง|ได้แก่|เช่น|ๆ|ฯ)"
)
THAI_UNITS = re.compile(r"(?:คน|ล้าน|พัน|หมื่น|แสน|ร้อย|บาท|แห่ง|ปี|ราย|ชิ้น|เปอร์เซ็นต์|ครั้ง|วัน|เดือน|ชั่วโมง|นาที|วินาที|โมง|น\.|เล่ม|หน้า|ฉบับ|โครงการ|เมตร|กิโล|หลัง|ห้อง|ตัว|องค์|รูป|เรื่อง|ประเทศ|จังหวัด|มกราคม|กุมภาพันธ์|มีนาคม|เมษายน|พฤษภาคม|มิถุนายน|กรกฎาคม|สิงหาคม|กันยายน|ตุลาคม|พฤศจิกายน|ธันวาคม)")

_CLOSE = {}
for _o, _c in PAIRS.items():
    _CLOSE.setdefault(_c, []).append(_o)
_MARKS = re.compile("[" + re.escape("".join({*PAIRS, *_CLOSE, *ALWAYS, *NEED_BLANK, '"'})) + "]")
_BLANKS = " \t\r　 ​‎‏  ﻿\x0b\x0c\x85    "
_NOT_BLANK = re.compile("[^" + _BLANKS + "]")
_BEFORE_LEVEL = re.compile("[" + _BLANKS + "\\-–—*•・#]*")
_LIST_MARK = re.compile(r"\s*(?:[-–—*•・◆■□●○▶▷※]\s*)?(?:[（(]?\s*(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,4}|[一二三四五六七八九十]{1,3})\s*[.)）．、]\s)")
_ITEM = re.compile(r"(?:([-–—*•・◆■□●○▶▷※])[\s　]*(?=\S)|([（(])?(?:(\d{1,3})|([a-zA-Z])|([一二三四五六七八九十]))([.)）．、])(?=[\s　]|(?<=[)）．、])\S))")
_CJK = re.compile(r"[぀-ヿ㐀-鿿豈-﫿ｦ-ﾟ々〆]")
_THAI = re.compile(r"[฀-๿]")
_WORD_END = re.compile(r"(?:[^\W\d_](?:[̀-ͯऀ-ःऺ-ॏॢॣ])*\.?[-’']?)+$")


def _trie(words: str) -> dict:
    root: dict = {}
    for word in words.split():
        node = root
        for ch in reversed(word):
            node = node.setdefault(ch, {})
        node[""] = word
    return root


_OPEN, _CLOSING = _trie(OPEN_ABBREVIATIONS), _trie(CLOSING_ABBREVIATIONS)


def _ends_with(trie: dict, line: str, stop: int) -> str | None:
    """The longest abbreviation that ends before stop and begins a word."""
    node, at, found = trie, stop - 1, None
    while at >= 0 and (node := node.get(line[at].lower())) is not None:
        if "" in node and (at == 0 or not (line[at - 1].isalnum() or line[at - 1] == ".")):
            found = node[""]
        at -= 1
    return found


class _Open:
    """The stack of open marks; the topmost one of a kind is found without going through it."""

    def __init__(self):
        self.marks: list[tuple[int, str]] = []
        self.of: dict[str, list[int]] = {}  # heights at which marks of a kind stand

    def push(self, at: int, ch: str) -> None:
        self.of.setdefault(ch, []).append(len(self.marks))
        self.marks.append((at, ch))

    def close(self, kinds: list[str]) -> int | None:
        """Takes down the stack as far as the topmost mark of these kinds and gives its place; None if none is open."""
        height = max((self.of[k][-1] for k in kinds if self.of.get(k)), default=-1)
        if height < 0:
            return None
        at = self.marks[height][0]
        while len(self.marks) > height:
            self.of[self.marks.pop()[1]].pop()
        return at


def _matches(line: str, marks: list[int]) -> dict[int, int]:
    """Position of each mark that opens -> position of the mark that closes it; unmatched marks are left out."""
    stack = _Open()
    out: dict[int, int] = {}
    for at in marks:
        ch = line[at]
        opened = None
        if ch == '"':
            opened = stack.close(['"'])
            if opened is None:
                stack.push(at, ch)
        elif ch in _CLOSE:
            if ch == "’" and at + 1 < len(line) and line[at + 1].isalpha() and at and line[at - 1].isalpha():
                continue  # an apostrophe
            opened = stack.close(_CLOSE[ch])
        if opened is not None:
            out[opened] = at
        elif ch in PAIRS:
            stack.push(at, ch)
    return out


class Levels:
    """The open levels of lists, line by line: (indent, kind of marker, ordinal)."""

    def __init__(self):
        self.stack: list[tuple[int, str, int]] = []

    def line(self, line: str) -> int:
        """How many levels are open in a line. An item opens one or goes on with the one it belongs to; text left of an item closes it."""
        body = _skip(line, 0)
        if body >= len(line):
            return len(self.stack)
        m = _ITEM.match(line, body)
        if not m:
            while self.stack and body <= self.stack[-1][0]:
                self.stack.pop()
            return len(self.stack)
        kind, ordinal = self._marker(m)
        while self.stack and self.stack[-1][0] > body:
            self.stack.pop()
        # the level this item goes on with, which may lie below levels that weren't indented
        same = [k for k, (indent, other, _) in enumerate(self.stack) if indent == body and other == kind]
        if same:
            del self.stack[same[-1] :]
        self.stack.append((body, kind, ordinal))
        return len(self.stack)

    @staticmethod
    def _marker(m: re.Match) -> tuple[str, int]:
        bullet, opened, number, letter, han, closed = m.groups()
        if bullet:
            return bullet, 0
        kind = ("(" if opened else "") + ("0" if number else "a" if letter and letter.islower() else "A" if letter else "一") + {"）": ")", "．": "."}.get(closed, closed)
        return kind, int(number) if number else ord(letter) if letter else "一二三四五六七八九十".index(han) + 1


def _skip(line: str, at: int) -> int:
    m = _NOT_BLANK.search(line, at)
    return m.start() if m else len(line)


def _upper_next(line: str, at: int) -> bool:
    """A sentence can begin at this place of a script with case."""
    while at < len(line) and (line[at] in QUOTES or line[at] in PAIRS or line[at] in "¿¡-–—"):
        at = _skip(line, at + 1)
    return at < len(line) and not _lower(line, at) and line[at].isalnum()


_CAMEL = re.compile(r"[^\W\d_]?[a-zà-ÿ]{1,2}[A-Z]")


@lru_cache(maxsize=4)
def _german(line: str) -> bool:
    return bool(GERMAN.search(line))


@lru_cache(maxsize=4)
def _holds_cjk(line: str) -> bool:
    return bool(_CJK.search(line))


def _lower(line: str, at: int) -> bool:
    """A word in lower case; a name like eBook isn't one."""
    return line[at].islower() and not _CAMEL.match(line, at)


def _full_stop(line: str, at: int, after: int, start: int) -> bool:
    """Whether the full stop at `at` ends a sentence; `after` is the next character that isn't blank."""
    if after >= len(line):
        return True
    if after == at + 1:
        # no blank: a word or bracket ends, and a word with a capital begins
        if not (at and (line[at - 1].islower() or line[at - 1] in ")）") and _capital_word(line, after)):
            return False
        return not _ends_with(_OPEN, line, at)
    before, follow = line[at - 1] if at else " ", line[after]
    if follow in ",;:、，)）]":
        return False
    word = _ends_with(_OPEN, line, at)
    if word and not (word in NUMBERED and not _number_or_name(word, line, at, follow)):
        return False
    closing = _ends_with(_CLOSING, line, at)
    if closing:
        return _upper_next(line, after) and not follow.isdigit()
    if before.isdigit():
        head = at
        while head and (line[head - 1].isdigit() or line[head - 1] in ".,"):
            head -= 1
        number = line[head:at]
        if follow.isdigit() or _CJK.match(follow):
            return False
        if _BEFORE_LEVEL.fullmatch(line, start, head):
            return False  # a list level or an ordinal at the beginning
        if len(number) <= 3 and _german(line):
            return False
        return not _lower(line, after)
    if before.isupper() and before.isascii() and (at < 2 or not line[at - 2].isalnum()):
        if at >= 2 and line[at - 2] == ".":
            return follow.isupper()
        return False  # an initial
    return not _lower(line, after)


def _capital_word(line: str, at: int) -> bool:
    """A capital and a small letter, after an opening mark or not; or a mixed name like eBook."""
    word = line[max(0, at - 80) : at].rsplit(None, 1)
    if word and ("://" in word[-1] or "www." in word[-1] or "@" in word[-1]):
        return False  # inside an address
    if at < len(line) and line[at] in "\"“«„":
        at = _skip(line, at + 1)
    two = line[at : at + 2]
    return (len(two) == 2 and two[0].isupper() and (two[1].islower() or two[1] == " ")) or bool(_CAMEL.match(line, at))


def _number_or_name(word: str, line: str, at: int, follow: str) -> bool:
    """Short words that are also ordinary ends: they count as abbreviations before a number, or in their usual case."""
    typed = line[at - len(word) : at]
    if word in {"no", "nos", "ed", "sec", "ch", "mar", "par", "fig", "me", "est", "art", "arts", "p", "pp", "s", "n"}:
        return follow.isdigit() or follow in "(" or (word in {"n", "p", "s"} and follow.islower())
    if word in {"m", "ms"}:
        return typed[0].isupper()
    if word in {"a", "h", "b", "z", "u", "d"}:
        return True
    return follow.isdigit() or follow.isupper()


def _thai_blanks(line: str, low: int, high: int) -> Iterator[int]:
    """Starts of sentences after blanks in a Thai stretch of a line, outside of quotations and brackets."""
    for m in re.finditer(f"[{_BLANKS}]+", line[low:high]):
        before, after = low + m.start() - 1, low + m.end()
        if before < low or after >= high or not _THAI.match(line[after]):
            continue
        last = line[before]
        rest = line[after : after + 16]
        if THAI_GOES_ON.match(rest):
            continue
        if last.isdigit():
            if THAI_UNITS.match(rest):
                continue
        elif not (_THAI.match(last) or last in ")）”»\"’"):
            continue
        elif last in "”»\"’":
            continue
        yield after


def line_starts(line: str) -> list[int]:
    """Where the sentences of one line begin, its first one included; [] for a blank line."""
    first = _skip(line, 0)
    if first >= len(line):
        return []
    starts = [first]
    marks = [m.start() for m in _MARKS.finditer(line)]
    thai = bool(_THAI.search(line))
    pairs = _matches(line, [i for i in marks if line[i] in PAIRS or line[i] in _CLOSE or line[i] == '"']) if marks else {}
    closers = set(pairs.values())
    list_mark = _LIST_MARK.match(line)
    i, covered = 0, list_mark.end() if list_mark and list_mark.end() < len(line) else 0
    thai_from = first
    while i < len(marks):
        at = marks[i]
        i += 1
        if at < covered:
            continue
        ch = line[at]
        if at in pairs:
            close = pairs[at]
            if thai:
                starts += _thai_blanks(line, thai_from, at)
                thai_from = max(first, close)
            while i < len(marks) and marks[i] <= close:
                i += 1
            covered = close + 1
            inner = close - 1
            while inner > at and line[inner] in _BLANKS + QUOTES + ")）":
                inner -= 1
            if line[close] in QUOTES and line[inner] in ALWAYS + NEED_BLANK and not thai:
                after = _skip(line, close + 1)
                if after < len(line) and line[after] not in ALWAYS + NEED_BLANK:
                    if line[after].isupper() and after > close + 1 or after == close + 1 and _capital_word(line, after) or (after > close + 1 and line[after].isdigit() and line[after - 1] in _BLANKS and line[close] in '"”“»'):
                        starts.append(after)
                    elif _CJK.match(line[after]) and line[at] in "「『" and at == starts[-1] and not JA_GOES_ON.match(line, after):
                        starts.append(after)
            continue
        if ch not in ALWAYS and ch not in NEED_BLANK:
            continue
        stop = at
        while stop + 1 < len(line) and line[stop + 1] in ALWAYS + "!?؟…":
            stop += 1
        if ch == ".":
            while stop + 1 < len(line) and line[stop + 1] == ".":
                stop += 1
        run = line[at : stop + 1]
        while i < len(marks) and marks[i] <= stop:
            i += 1
        end = stop + 1
        while end < len(line) and (line[end] in "”’»」』）)】\"" and end not in pairs and end not in closers):
            end += 1
        after = _skip(line, end)
        if after >= len(line):
            break
        follow = line[after]
        if any(c in ALWAYS for c in run):
            if "…" in run and not any(c in "。！？" for c in run):
                continue
            if run[-1] in "！" and follow.isdigit() and after > end and _holds_cjk(line):
                continue
            if follow in "、，,；;」』）)":
                continue
            starts.append(after)
        elif "…" in run or run.startswith(".."):
            if any(c in "!?" for c in run) and after > end or after > end and follow.isupper() or after > end and _upper_next(line, after) and follow in QUOTES + "".join(PAIRS):
                starts.append(after)
        elif ch == "．":
            if not (line[at - 1 : at].isdigit() and follow.isdigit()):
                starts.append(after)
        elif ch == ".":
            if _full_stop(line, at, after, starts[-1]):
                starts.append(after)
        elif ch in "!?":
            near = (line[at - 1] if at else " ") + follow
            if after > end and not _lower(line, after) and follow not in ",;:":
                starts.append(after)
            elif after == end and (_CJK.search(near) and (not follow.isascii() or follow.isupper()) or _capital_word(line, after)):
                starts.append(after)
        elif after > end:
            starts.append(after)
    if thai:
        starts += _thai_blanks(line, thai_from, len(line))
        starts = sorted(set(starts))
    return starts


def sentence_spans(text: str | None) -> list[tuple[int, int, int, int, bool]]:
    """(line_no, list level, start, end, first of its line) of every sentence, in code points; null and blank texts have none."""
    out: list[tuple[int, int, int, int, bool]] = []
    at, levels = 0, Levels()
    for number, line in enumerate((text or "").split("\n"), 1):
        starts, level = line_starts(line), levels.line(line)
        for k, start in enumerate(starts):
            end = starts[k + 1] if k + 1 < len(starts) else len(line)
            out.append((number, level, at + start, at + start + len(line[start:end].rstrip(_BLANKS)), k == 0))
        at += len(line) + 1
    return out


SPANS = "field string, rec_id string, line_no int, list_level int, start_pos int, end_pos int, is_first boolean, sentence string"


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for field, rec_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            for line_no, level, start, end, is_first in sentence_spans(text):
                rows.append((field, rec_id, line_no, level, start, end, is_first, text[start:end]))
            if len(rows) > 50_000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 8
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["field", "rec_id", "line_no", "list_level", "start_pos", "end_pos", "is_first", "sentence"])


def sentence_units(texts: DataFrame) -> DataFrame:
    """texts (field, rec_id, text) -> one row a sentence with its span; no shuffle, rows without text give none."""
    return texts.select("field", "rec_id", "text").where("text is not null").mapInArrow(_split, SPANS)


def corpus_texts(docs: DataFrame, baskets: DataFrame) -> DataFrame:
    of_docs = docs.select(F.lit("doc_body").alias("field"), F.col("doc_id").alias("rec_id"), F.col("body").alias("text"))
    of_baskets = baskets.select(F.lit("basket_text").alias("field"), F.col("basket_id").cast("string").alias("rec_id"), "text")
    return of_docs.unionByName(of_baskets)


def inner_starts(docs: DataFrame, baskets: DataFrame) -> DataFrame:
    """(field, rec_id, start_pos) of each sentence that isn't the first of its line; a doc read twice counts once."""
    found = sentence_units(corpus_texts(docs, baskets)).where("not is_first")
    return found.select("field", "rec_id", "start_pos").distinct()
