"""Personal information inside free text (problem 10): a linear-chain conditional random field.

Texts are cut into tokens (words, runs of digits, single ideographs, kana and hangul), each with hashed features of its
word, shape, neighbours, name list and the spans of a few patterns. The field is trained by its gradient on the labelled
table, and Viterbi decodes whole batches of sequences in numpy. What it tags is checked exactly for its kind
(an e-mail address has an at sign and a host, and so on) and becomes a mention or a placeholder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from weftline.llm.pii_labels import HALLS, labelled_table
from weftline.runtime import spread

KINDS = ["email", "phone", "id_number", "address", "person"]
LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
DIMS = 1 << 17
AREA = 1 << 17  # tokens, with padding, that are decoded together; a longer sequence is decoded alone and whole

_WIDE = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)} | {0x3000: 0x20, 0xA0: 0x20} | {ord(c): "-" for c in "‐‑‒–—―−－"}
_TOKEN = re.compile(r"[A-Za-zÀ-ɏ]+|[0-9]+|[぀-ヿ㐀-鿿々〆𠀀-𯿿가-힣]|[^\W\d_]+|\d+|[^\s]")
_SENTENCE_END = frozenset("。！？｡।؟!?")

# Patterns and cue words that features look at.
_AT = r"(?:\s?\[at\]\s?|\s?\(at\)\s?|[@★])"
_DOT = r"(?:\.|\s?\[dot\]\s?|\s?\(dot\)\s?)"
EMAIL = re.compile(rf"[A-Za-z0-9](?:[A-Za-z0-9._+-]*[A-Za-z0-9])?{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+")
NUMBER = re.compile(r"(?<![A-Za-z0-9.,/-])(?:[A-Z]{2} ?)?[+(]?\d(?:[ .()/-]{0,2}\d)*(?: ?[A-D](?![A-Za-z]))?")
STREET = re.compile(r"\b(?:St|Street|Row|Lane|Road|Rd|Avenue|Ave|Close|Apt|Flat|rue|quai|avenue|chemin|boulevard|place|wohnt|habite)\b|丁目|番地|番(?=\d)|\d号|路(?=\d)|(?:straße|str\.|weg|gasse|platz|tor|hag)\b")
HONORIFIC = re.compile(r"さん|様|氏|先生|館長|学芸員(?=[がはも])|の両氏|の署名|の三人|先生|女士|씨|관장|님")
LEFT_CUE = re.compile(r"受付は|署名は|担当は|委員に|委員は|講師の|応じた|申し込みは|問い合わせは|联系人|署名|联系|서명은|문의는|담당|\b(?:Ms|Mr|Mrs|Mme|Dr|Prof|Frau|Herr|Curator|Director|Monsieur|Madame|signed|Signed|by|signé|gezeichnet|sagte|lancé|said|ask for|to|Ask|gibt|Contact|M)\b[.:]?|डॉ\.|श्री|ऐसा|د\.|السيد|คุณ|ติดต่อ")
PHONE_CUE = re.compile(r"電話|携帯|連絡先|tel|fax|call|phone|telefon|unter|renseignements|tél|电话|手机|致电|전화|연락처|फ़ोन|هاتف|โทร|desk", re.I)
ID_CUE = re.compile(r"個人番号|マイナンバー|免許|旅券|パスポート|身份证|护照|주민등록|NI no|insurance|passport|SSN|social|ausweis|steuer|sécurité|passeport", re.I)
OTHER_CUE = re.compile(r"ISBN|法人|管理番号|整理番号|公告|予算|円|catalogue|lots?|ref\.|cote|inventar|등록번호|登记|क्रमांक|رقم|pounds|room|no\.", re.I)
MAIL_CUE = re.compile(r"e-?mail|メール|邮箱|이메일|ईमेल|البريد|อีเมล|courriel|anmeldung|contact", re.I)
INSTITUTION = re.compile(r"\b(?:Gallery|Museum|Hall|Playhouse|Library|House|Office|Foundation|Prize|Review|Council)\b|記念館|美術館|博物館")
NOT_PERSON = re.compile(r"[㐀-鿿]{0,3}(?:賞|記念館|文庫|基金|財団)|[町市村]|記念|\b(?:Prize|Foundation|Gallery|Museum|Hall|Sons)\b|-Stiftung|-Preis|& ")
BEFORE_NOT_PERSON = re.compile(r"\b(?:St|prix|fondation|Prix)\.? $")


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1


@lru_cache(maxsize=400_000)
def _word_ids(word: str) -> tuple[int, int, int, int]:
    """Word, shape, affixes and script class of a token, as hashes."""
    if word.isdigit():
        return _hash("#" + str(min(len(word), 14))), _hash(f"d{min(len(word), 14)}"), _hash("d" + word[0]), 1
    first = word[0]
    if first.isalpha() and first < "ɐ":
        low = word.lower()
        shape = ("X" if first.isupper() else "x") + ("X" if word.isupper() and len(word) > 1 else "x") + str(min(len(word), 8))
        return _hash(low), _hash(shape), _hash(low[-3:]), 2
    if "぀" <= first <= "ゟ":
        return _hash(word), _hash("hira"), _hash("hira"), 3
    if "゠" <= first <= "ヿ":
        return _hash(word), _hash("kata"), _hash("kata"), 4
    if "㐀" <= first <= "鿿" or first in "々〆" or first >= "𠀀":
        return _hash(word), _hash("kanji"), _hash("kanji"), 5
    if "가" <= first <= "힣":
        return _hash(word), _hash("hangul"), _hash("hangul"), 6
    if word.isalpha():
        return _hash(word), _hash("other"), _hash(word[-2:]), 7
    return _hash(word), _hash(word), _hash(word), 8


@lru_cache(maxsize=100_000)
def _number_form(value: str) -> tuple[int, int]:
    """How many digits a number has, and its form with their counts, as a hash."""
    return sum(ch.isdigit() for ch in value), _hash("form" + re.sub(r"\d+", lambda d: str(len(d[0])), value))


class Names:
    """Name list: spans of listed names in a text, whole words where the script has words."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.kind: dict[str, int] = {}
        for text, kind in rows:
            if text and text.strip():
                self.kind[text.strip()] = 1 if kind == "family" else 2
        self.wide = [t for t in self.kind if not t.isascii()]
        self.automaton = ahocorasick.Automaton()
        for t in self.wide:
            self.automaton.add_word(t, (len(t), self.kind[t]))
        if self.wide:
            self.automaton.make_automaton()
        self.low = {t.lower(): k for t, k in self.kind.items() if t.isascii()}

    def flags(self, text: str, words: list[str], which: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each token of a text its place in a listed name, if any; which: the tokens as places in words."""
        out = np.zeros(len(which), np.int64)
        if self.wide:
            for end, (size, kind) in self.automaton.iter_long(text):
                a, b = np.searchsorted(starts, (end - size + 1, end + 1))
                out[a:b] = kind * 2 + 1
                if a < b:
                    out[a] = kind * 2
        if self.low:
            listed = np.array([2 * self.low.get(t.lower(), 0) if len(t) > 2 and t[0] < "ɐ" else 0 for t in words] or [0], np.int64)
            if listed.any():
                found = listed[which]
                out = np.where(found > 0, found, out)
        return out


_UP = np.arange(1, 33)
_DOWN = _UP[::-1]


class Coded:
    """Tokens of one long text with their features; sequences end at line feeds and sentence ends."""

    def __init__(self, text: str, names: Names):
        self.text = text = text.translate(_WIDE)
        self.found: dict[re.Pattern, tuple[np.ndarray, np.ndarray]] = {}
        spans = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
        self.starts = np.array([a for a, _ in spans], np.int64)
        self.ends = np.array([b for _, b in spans], np.int64)
        tokens = [text[a:b] for a, b in spans]
        n = len(tokens)
        # each distinct token is looked at once
        place: dict[str, int] = {}
        which = np.fromiter((place.setdefault(t, len(place)) for t in tokens), np.int64, n)
        ids = np.array([_word_ids(t) for t in place], np.int64).reshape(len(place), 4)[which]
        breaks = np.zeros(n, bool)
        if n:
            breaks[0] = True
            feeds = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 10)
            at = np.searchsorted(self.starts, feeds)
            breaks[at[at < n]] = True
            stops = [i + 1 for i, t in enumerate(tokens) if t in _SENTENCE_END and not (t in "!?" and text[self.ends[i] : self.ends[i] + 1] in "\"”'")]
            breaks[[i for i in stops if i < n]] = True
        self.first = np.flatnonzero(breaks)
        self.length = np.diff(np.r_[self.first, n])
        self.sequence = np.cumsum(breaks) - 1
        self.features = self._features(names.flags(text, list(place), which, self.starts), ids)

    def _spans(self, pattern: re.Pattern) -> np.ndarray:
        """First token and the one after the last of each match; each pattern goes over the text once."""
        if pattern not in self.found:
            places = np.array([m.span() for m in pattern.finditer(self.text)], np.int64).reshape(-1, 2)
            self.found[pattern] = places, np.searchsorted(self.starts, places)
        return self.found[pattern][1]

    def _mark(self, pattern: re.Pattern, kind: int, flags: np.ndarray) -> None:
        for a, b in self._spans(pattern).tolist():
            if a < b:
                flags[a:b] = kind * 2 + 1
                flags[a] = kind * 2

    def _near(self, pattern: re.Pattern, forward: bool, reach: int) -> np.ndarray:
        """Distance in tokens to the next (or from the last) match inside the sequence; 0 for none."""
        n = len(self.starts)
        out = np.zeros(n, np.int64)
        spans = self._spans(pattern)
        spans = spans[spans[:, 0] < n]
        at = self.sequence[spans[:, 0]]
        if forward:
            lows = np.maximum(spans[:, 0] - reach, self.first[at])
            for a, low in zip(spans[:, 0].tolist(), lows.tolist()):
                out[low:a] = _DOWN[-(a - low) :] if a > low else 0
        else:
            highs = np.minimum(spans[:, 1] + reach, (self.first + self.length)[at])
            for b, high in zip(spans[:, 1].tolist(), highs.tolist()):
                if high > b:
                    out[b:high] = _UP[: high - b]
        return out

    def _features(self, gaz: np.ndarray, ids: np.ndarray) -> np.ndarray:
        n = len(ids)
        if not n:
            return np.zeros((0, 1), np.int32)
        word, shape, affix, script = ids.T
        inside = np.zeros(n, bool)
        inside[1:] = self.sequence[1:] == self.sequence[:-1]

        def shift(x: np.ndarray, k: int) -> np.ndarray:
            out = np.full(n, -7, np.int64)
            if k < 0:
                out[-k:] = x[:k]
                out[np.arange(n) + k < self.first[self.sequence]] = -7
            else:
                out[: n - k or None] = x[k:] if k < n else -7
                out[np.arange(n) + k >= (self.first + self.length)[self.sequence]] = -7
            return out

        flags = np.zeros(n, np.int64)
        self._mark(NUMBER, 2, flags)
        digits = np.zeros(n, np.int64)
        forms = np.zeros(n, np.int64)
        for (a, b), (low, high) in zip(self._spans(NUMBER).tolist(), self.found[NUMBER][0].tolist()):
            digits[a:b], forms[a:b] = _number_form(self.text[low:high])
        self._mark(EMAIL, 1, flags)
        street = np.zeros(n, np.int64)
        self._mark(STREET, 1, street)
        hon, left = self._near(HONORIFIC, True, 9), self._near(LEFT_CUE, False, 4)
        cues = np.minimum(self._near(PHONE_CUE, False, 12), 1) + 2 * np.minimum(self._near(ID_CUE, False, 12), 1) + 4 * np.minimum(self._near(OTHER_CUE, False, 5), 1) + 8 * np.minimum(self._near(MAIL_CUE, False, 4), 1)
        street_near = np.minimum(self._near(STREET, True, 14), 1) + 2 * np.minimum(self._near(STREET, False, 10), 1)
        blank = np.zeros(n, np.int64)
        blank[1:] = self.starts[1:] > self.ends[:-1]
        # the token after the run of name-like tokens
        namelike = (script >= 3) & (script <= 6)
        other = np.where(namelike & (script == 5), n, np.arange(n))
        ahead = np.r_[np.minimum.accumulate(other[::-1])[::-1][1:], n]
        follow = np.where(ahead < (self.first + self.length)[self.sequence], word[np.minimum(ahead, n - 1)], -7)
        w1, w2, w_1, w_2 = shift(word, 1), shift(word, 2), shift(word, -1), shift(word, -2)
        s1, s_1 = shift(shape, 1), shift(shape, -1)
        g1, g_1 = shift(gaz, 1), shift(gaz, -1)
        c1, c_1 = shift(script, 1), shift(script, -1)
        f1, f_1 = shift(flags, 1), shift(flags, -1)
        b1 = shift(blank, 1)
        columns = [
            (word,), (w_1,), (w1,), (w_2,), (w2,), (w_1, word), (word, w1), (w_2, w_1), (w1, w2), (shape,), (s_1, shape, s1), (affix,), (script, c_1, c1),
            (gaz,), (gaz, g_1, g1), (gaz, w1), (gaz, w_1), (flags,), (flags, f_1, f1), (flags, w_1), (flags, cues), (flags, digits, cues), (forms, cues), (forms,),
            (street, shape), (street_near, shape), (street_near, flags, c_1), (hon, script), (hon, gaz), (left, shape), (left, script, s1), (follow, script), (follow, gaz),
            (blank, b1, shape), (shift(word, -3), script), (shift(word, 3), script), (w_1, shape), (w1, shape), (s1, w2, shape), (s_1, w_2),
        ]
        out = np.empty((n, len(columns) + 1), np.int32)
        with np.errstate(over="ignore"):
            for k, parts in enumerate(columns):
                h = np.full(n, np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)), np.uint64)
                for part in parts:
                    h = (h ^ part.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
                    h ^= h >> np.uint64(29)
                out[:, k] = (h % np.uint64(DIMS - 1)).astype(np.int32)
        out[:, -1] = DIMS - 1
        return out


class Field:
    """Weights of features and transitions."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, begin: np.ndarray):
        self.weights, self.moves, self.begin = weights, moves, begin

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), len(LABELS)), np.float32)
        held = np.empty((4096, len(LABELS)), np.float32)
        for low in range(0, len(features), 4096):
            part = out[low : low + 4096]
            # one feature of all tokens at a time, so that what is summed up stays in the cache
            for column in np.ascontiguousarray(features[low : low + 4096].T):
                np.take(self.weights, column, axis=0, out=held[: len(part)], mode="clip")
                part += held[: len(part)]
        return out

    def viterbi(self, coded: Coded) -> np.ndarray:
        """The best label of every token; sequences of like length are decoded together."""
        emit = self.scores(coded.features)
        best = np.zeros(len(emit), np.int64)
        order = np.argsort(coded.length, kind="stable")
        low = 0
        while low < len(order):
            # sequences of up to a quarter more tokens than the shortest, in all AREA at most
            most = max(int(coded.length[order[low]] * 1.25), 8)
            high = int(np.searchsorted(coded.length[order], most, "right"))
            high = max(low + 1, min(high, low + AREA // most))
            part = order[low:high]
            low = high
            lengths, firsts = coded.length[part], coded.first[part]
            width = int(lengths[-1])
            rows = firsts[:, None] + np.minimum(np.arange(width), lengths[:, None] - 1)
            score = emit[rows[:, 0]] + self.begin
            back = np.zeros((width, len(part), len(LABELS)), np.int8)
            for t in range(1, width):
                total = score[:, :, None] + self.moves
                choice = total.argmax(axis=1)
                new = np.take_along_axis(total, choice[:, None, :], axis=1)[:, 0] + emit[rows[:, t]]
                alive = (t < lengths)[:, None]
                back[t] = np.where(alive, choice, np.arange(len(LABELS)))
                score = np.where(alive, new, score)
            label = score.argmax(axis=1)
            for t in range(width - 1, -1, -1):
                alive = t < lengths
                best[rows[alive, t]] = label[alive]
                label = back[t][np.arange(len(part)), label].astype(np.int64)
        return best


def _allowed() -> np.ndarray:
    """I-x follows B-x or I-x only."""
    ok = np.zeros((len(LABELS), len(LABELS)), np.float32)
    for i, a in enumerate(LABELS):
        for j, b in enumerate(LABELS):
            if b[0] == "I" and a[2:] != b[2:]:
                ok[i, j] = -1e4
    return ok


def train(rows: list[tuple[str, list[tuple[int, int, str]]]], names: Names, epochs: int = 6, batch: int = 96, rate: float = 0.25, decay: float = 1e-6, seed: int = 3) -> Field:
    """Maximises the conditional likelihood of the labelled rows by AdaGrad on mini-batches of forward-backward gradients."""
    rng = np.random.default_rng(seed)
    size = len(LABELS)
    weights, seen = np.zeros((DIMS, size), np.float32), np.full((DIMS, size), 1e-2, np.float32)
    limits = _allowed()
    moves, moves_seen = np.zeros((size, size), np.float32), np.full((size, size), 1e-2, np.float32)
    begin = np.array([-1e4 if x[0] == "I" else 0 for x in LABELS], np.float32)
    chunks = []
    order = np.argsort([len(t) for t, _ in rows], kind="stable")
    for low in range(0, len(order), batch):
        part = [rows[i] for i in order[low : low + batch]]
        text, spans, at = [], [], 0
        for t, marks in part:
            text.append(t.replace("\n", " "))
            spans += [(at + a, at + b, k) for a, b, k in marks]
            at += len(t) + 1
        coded = Coded("\n".join(text), names)
        gold = np.zeros(len(coded.starts), np.int64)
        for a, b, k in spans:
            i, j = np.searchsorted(coded.starts, (a, b))
            gold[i:j] = LABELS.index(f"I-{k}")
            gold[i] = LABELS.index(f"B-{k}")
        chunks.append((coded, gold))
    for _ in range(epochs):
        for c in rng.permutation(len(chunks)):
            coded, gold = chunks[c]
            emit = weights[coded.features].sum(axis=1)
            lengths, firsts = coded.length, coded.first
            width, count = int(lengths.max()), len(lengths)
            rows_at = firsts[:, None] + np.minimum(np.arange(width), lengths[:, None] - 1)
            alive = np.arange(width) < lengths[:, None]
            step = np.exp(moves + limits)
            e = np.exp(emit - emit.max(axis=1, keepdims=True))[rows_at]
            forward, scale = np.zeros((width, count, size)), np.zeros((width, count))
            forward[0] = np.exp(begin) * e[:, 0]
            scale[0] = forward[0].sum(axis=1)
            forward[0] /= scale[0][:, None]
            for t in range(1, width):
                f = (forward[t - 1] @ step) * e[:, t]
                scale[t] = f.sum(axis=1)
                forward[t] = f / scale[t][:, None]
            backward = np.ones((width, count, size))
            pair = np.zeros((size, size))
            for t in range(width - 2, -1, -1):
                live = alive[:, t + 1]
                w = e[:, t + 1] * backward[t + 1] / scale[t + 1][:, None]
                backward[t] = np.where(live[:, None], w @ step.T, 1.0)
                pair += (forward[t][live].T @ w[live]) * step
            marginal = (forward * backward).transpose(1, 0, 2)[alive]
            marginal /= marginal.sum(axis=1, keepdims=True)
            flat = rows_at[alive]
            grad = -marginal
            grad[np.arange(len(flat)), gold[flat]] += 1
            ids = coded.features[flat]
            uniq, where = np.unique(ids, return_inverse=True)
            where = where.reshape(ids.shape)
            total = np.zeros((len(uniq), size), np.float32)
            for label in range(size):
                total[:, label] = np.bincount(where.ravel(), np.repeat(grad[:, label], ids.shape[1]), len(uniq))
            total -= decay * len(flat) * weights[uniq]
            seen[uniq] += total**2
            weights[uniq] += rate * total / np.sqrt(seen[uniq])
            inner = np.ones(len(gold), bool)
            inner[firsts] = False
            here = np.flatnonzero(inner)
            observed = np.zeros((size, size))
            np.add.at(observed, (gold[here - 1], gold[here]), 1)
            g = (observed - pair).astype(np.float32)
            moves_seen += g**2
            moves += rate * g / np.sqrt(moves_seen)
    return Field(weights, moves + limits, begin)


@lru_cache(maxsize=2)
def trained(per_carrier: int = 24, seed: int = 11) -> Field:
    """The field of the labelled table. A third of the table's own names stand in a name list while it is trained, as some do in use."""
    from weftline.llm import pii_labels as L

    some = [(n, "family") for n in L.JA_FAMILY[::3]] + [(n, "given") for n in L.JA_GIVEN[::3]]
    some += [(n, "family") for n in (L.EN_FAMILY + L.DE_FAMILY + L.FR_FAMILY)[::3]] + [(n, "given") for n in (L.EN_GIVEN + L.DE_GIVEN + L.FR_GIVEN)[::3]]
    return train(labelled_table(per_carrier, seed), Names(some))


def checked(kind: str, text: str, start: int, end: int) -> int | None:
    """The exact check of a tagged span: where the mention begins, or None where it can't be of its kind."""
    span = text[start:end]
    if kind == "email":
        m = EMAIL.search(text, max(0, start - 40), end + 40)
        while m and m.end() <= start:
            m = EMAIL.search(text, m.end(), end + 40)
        return m.start() if m and m.start() < end else None
    digits = sum(ch.isdigit() for ch in span)
    if kind == "phone":
        lead = re.search(r"[+(\d]", span)
        return start + lead.start() if lead and digits >= 7 else None
    if kind == "id_number":
        lead = re.search(r"[A-Z0-9]", span)
        return start + lead.start() if lead and digits >= 6 else None
    if kind == "address":
        return start if digits or re.search(r"[一二三四五六七八九十]丁目", span) else None
    if NOT_PERSON.match(text, end) or BEFORE_NOT_PERSON.search(text[max(0, start - 12) : start]) or not any(ch.isalpha() for ch in span) or any(ch.isdigit() for ch in span):
        return None
    if any(span.endswith(h) for h in HALLS) or INSTITUTION.search(span):
        return None
    return start + re.search(r"[^\W\d_]", span).start()


def _parts(kind: str, text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """A person's span cut where a sentence ends inside it, after a whole word and a full stop."""
    if kind == "person":
        base, low = start, start
        for m in re.finditer(r"(?<=[^\W\d_]{3})[.!?…][\"”»]?\s+", text[start:end]):
            yield low, base + m.start()
            low = base + m.end()
        start = low
    if start < end:
        yield start, end


def mentions(texts: list[str | None], field: Field, names: Names) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of each text, in code points; null and blank texts have none."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    whole = "\n".join("" if t is None else t for t in texts)
    if not whole.strip():
        return out
    coded = Coded(whole, names)
    labels = field.viterbi(coded)
    offsets = np.cumsum([0, *(len(t or "") + 1 for t in texts)])
    tagged = np.flatnonzero(labels)
    i = 0
    while i < len(tagged):
        a = tagged[i]
        kind = LABELS[labels[a]][2:]
        b = a
        while i + 1 < len(tagged) and tagged[i + 1] == b + 1 and LABELS[labels[b + 1]] == f"I-{kind}" and coded.sequence[b + 1] == coded.sequence[a]:
            i += 1
            b = tagged[i]
        i += 1
        for start, end in _parts(kind, coded.text, int(coded.starts[a]), int(coded.ends[b])):
            begin = checked(kind, coded.text, start, end)
            if begin is not None:
                doc = int(np.searchsorted(offsets, start, "right")) - 1
                out[doc].append((kind, begin - int(offsets[doc]), end - int(offsets[doc])))
    return [sorted(set(rows), key=lambda r: (r[1], r[0])) for rows in out]


TEXTS = 400  # texts decoded together
PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID]", "address": "[ADDRESS]", "person": "[PERSON]"}


def redact(text: str | None, found: list[tuple[str, int, int]]) -> str | None:
    """Mentions replaced by placeholders, the rest unchanged; of overlapping mentions the first by position goes."""
    if text is None:
        return None
    out, at = [], 0
    for kind, start, end in found:
        if start >= at:
            out += [text[at:start], PLACEHOLDER[kind]]
            at = end
    return "".join([*out, text[at:]])


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """Texts in groups of a bounded number and length."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
        ids.append(doc_id)
        texts.append(text)
        size += len(text or "")
        if len(ids) >= TEXTS or size > 200_000:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _tag(field, names_rows: list[tuple[str, str]], redacting: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, model = Names(names_rows), field.value
        for batch in batches:
            for ids, texts in _groups(batch):
                # copies are decoded once
                distinct = list(dict.fromkeys(t for t in texts if t))
                found = dict(zip(distinct, mentions(distinct, model, names)))
                if redacting:
                    clean = [redact(t, found.get(t, [])) for t in texts]
                    counts = [len(found.get(t, [])) for t in texts]
                    yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(clean, pa.string()), pa.array(counts, pa.int32())], ["doc_id", "text", "n_mentions"])
                    continue
                rows = [(i, k, a, b) for i, t in zip(ids, texts) for k, a, b in found.get(t, [])]
                columns = list(zip(*rows)) or [()] * 4
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "kind", "start_pos", "end_pos"])

    return run


def _run(documents: DataFrame, name_list: DataFrame, redacting: bool, schema: str) -> DataFrame:
    spark = documents.sparkSession
    # the list of names is a fixed table; the model has DIMS x 11 weights whatever the input is
    names = [(r[0], r[1]) for r in name_list.select("name_text", "name_kind").where("name_text is not null").collect()]
    field = spark.sparkContext.broadcast(trained())
    return spread(documents.select("doc_id", "text"), "doc_id").mapInArrow(_tag(field, names, redacting), schema)


def personal_mentions(documents: DataFrame, name_list: DataFrame) -> DataFrame:
    """(doc_id, kind, start_pos, end_pos) of every mention in every text, copies too; no shuffle but where there are fewer partitions than cores."""
    return _run(documents, name_list, False, "doc_id bigint, kind string, start_pos int, end_pos int")


def redacted_documents(documents: DataFrame, name_list: DataFrame) -> DataFrame:
    """(doc_id, text, n_mentions) with placeholders; a null text stays null."""
    return _run(documents, name_list, True, "doc_id bigint, text string, n_mentions int")
