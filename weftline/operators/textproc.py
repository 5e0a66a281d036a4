"""Units to baskets: dictionary entities, tokens, noun runs, compounds, node sets and dictionary candidates."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Set
from itertools import accumulate, groupby

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.config import Config
from weftline.functions import scalars as S
from weftline.runtime import cut

Token = tuple[str, str, str, str]  # surface, part of speech, its kind, lemma

# Parts of speech that make noun runs, and endings of words that may belong into a dictionary.
NOUN, NOUN_KINDS, SUFFIX, SUFFIX_KIND, PREFIX = "名詞", ("普通名詞", "固有名詞"), "接尾辞", "名詞的", "接頭辞"
VERB, VERB_KIND_DROPPED = "動詞", "非自立可能"
RUN_PARTS = {(NOUN, kind) for kind in NOUN_KINDS} | {(SUFFIX, SUFFIX_KIND)}
SHORT_KANA_OR_LATIN = re.compile("^[ぁ-んァ-ヶa-zA-Z]{1,2}$")
CANDIDATE_ENDING = (
    "(博物館|美術館|劇場|音楽堂|文化会館|図書館|資料館|記念館|会館|ホール|法|条例|計画|戦略|制度|事業|基金|助成金|補助金|センター|機構|財団|協会|"
    "振興会|審議会|委員会|庁|省|部会|遺産|芸術祭|ビエンナーレ|トリエンナーレ)$"
)

LATIN_WORD = re.compile(r"[a-zà-ÿ]{3,}")
LATIN_STOP = frozenset("the and for with that this from les des une aux est der die das und mit von los las del una que por para".split())


def latin_tokens(text: str) -> list[Token]:
    """Words of Latin scripts as common nouns; a stopword or anything but one blank between two words is a token that breaks runs."""
    out: list[Token] = []
    at = 0
    for hit in LATIN_WORD.finditer(text.lower()):
        gap = text[at : hit.start()]
        word = hit[0]
        if out and gap != " ":
            out.append((gap, "記号", "", gap))
        out.append((word, "記号" if word in LATIN_STOP else NOUN, "普通名詞", word))
        at = hit.end()
    return out


def morpheme_tokens(text: str) -> list[Token]:
    """A morphological analyser's tokens, where one is installed; else kanji and katakana stretches as common nouns beside Latin words."""
    try:
        from sudachipy import Dictionary, SplitMode
    except ImportError:
        return _stretches(text)
    global _ANALYSER
    if _ANALYSER is None:
        _ANALYSER = Dictionary().create(mode=SplitMode.C)
    return [(m.surface(), *m.part_of_speech()[:2], m.normalized_form()) for i in range(0, len(text), 2000) for m in _ANALYSER.tokenize(text[i : i + 2000])]


_ANALYSER = None
_STRETCH = re.compile(r"[一-龥々]{2,}|[ァ-ヶー]{2,}|[a-zA-Zà-ÿ]{3,}")


def _stretches(text: str) -> list[Token]:
    out: list[Token] = []
    at = 0
    for hit in _STRETCH.finditer(text):
        if out and hit.start() > at:
            out.append((text[at : hit.start()], "記号", "", ""))
        out.append((hit[0], NOUN, "普通名詞", hit[0].lower()))
        at = hit.end()
    return out


class Aliases:
    """Dictionary names in a text, by one pass of an automaton over all of them."""

    def __init__(self, entities: list[tuple[str, list[str]]]):
        owner: dict[str, str] = {}
        for entity, aliases in entities:
            for alias in aliases:
                if alias:
                    owner.setdefault(unicodedata.normalize("NFKC", alias), entity)
        # the longer name first, of equal lengths the one listed first
        self.names = sorted(owner, key=len, reverse=True)
        self.owners = [owner[n] for n in self.names]
        self.automaton = ahocorasick.Automaton()
        for rank, name in enumerate(self.names):
            self.automaton.add_word(name, rank)
        if self.names:
            self.automaton.make_automaton()

    def find(self, text: str) -> tuple[list[str], str]:
        """Entity ids, and the text with their mentions blanked out. A mention that overlaps a longer one isn't one."""
        if not self.names:
            return [], text
        hits = sorted((rank, last + 1 - len(self.names[rank])) for last, rank in self.automaton.iter(text))
        taken = bytearray(len(text))
        ids: dict[str, None] = {}
        for rank, start in hits:
            span = slice(start, start + len(self.names[rank]))
            if not any(taken[span]):
                taken[span] = b"\x01" * len(self.names[rank])
                ids[self.owners[rank]] = None
        return list(ids), "".join(" " if t else ch for ch, t in zip(text, taken)) if ids else text


class Analyser:
    """Entities, runs of nouns and the terms of a unit, by a dictionary, stopwords and a tokenizer."""

    def __init__(self, entities: list[tuple[str, list[str]]], stopwords: set[str], cfg: Config, tokenize: Callable[[str], list[Token]] = morpheme_tokens):
        self.aliases, self.stop, self.cfg, self.tokenize = Aliases(entities), frozenset(stopwords), cfg, tokenize
        # a lemma that is long enough, holds a content character and isn't one or two letters of kana or Latin
        self.lemma = re.compile(rf"(?!{SHORT_KANA_OR_LATIN.pattern[1:-1]}\Z)(?=[\s\S]*{S.CONTENT_CHARACTER})[\s\S]{{{cfg.min_term_len},}}")

    def is_term(self, surface: str, lemma: str) -> bool:
        return not self.stop & {surface, lemma} and bool(self.lemma.match(lemma))

    def role(self, token: Token) -> str:
        """What a token is to runs: `part` of one, a `word` of its own, or a `gap`."""
        surface, pos, kind, lemma = token
        if (pos, kind) in RUN_PARTS:
            return "part" if surface.strip() else "gap"
        lone = pos in self.cfg.keep_pos and pos not in (NOUN, PREFIX) and (pos, kind) != (VERB, VERB_KIND_DROPPED)
        return "word" if lone and self.is_term(surface, lemma) else "gap"

    def runs(self, unit: str) -> tuple[list[str], list[list[list[str]]]]:
        """(entity ids, runs of [surface, lemma]): parts side by side are a run, a suffix in it by its surface."""
        ids, rest = self.aliases.find(unit)
        out: list[list[list[str]]] = []
        for role, tokens in groupby(self.tokenize(rest), self.role):
            words = [[surface, surface if pos == SUFFIX else lemma] for surface, pos, _, lemma in tokens]
            out += [words] if role == "part" else [[w] for w in words] if role == "word" else []
        return ids, out

    def nodes(self, runs: list, frequent: Set[str]) -> list[str]:
        """Term ids of the runs: from the left, the longest frequent compound that isn't a stopword, else a single term."""
        terms: set[str] = set()
        usable = frequent - self.stop
        for run in runs:
            left = [tuple(pair) for pair in run]
            while left:
                grown = list(accumulate(lemma for _, lemma in left[: self.cfg.compound_max_len]))
                size = max((n for n, word in enumerate(grown, 1) if n > 1 and word in usable), default=1)
                if size > 1 or ((NOUN in self.cfg.keep_pos) and self.is_term(*left[0])):
                    terms.add("t:" + grown[size - 1])
                del left[:size]
        return sorted(terms)


def unit_rows(docs: DataFrame, unit: str = "sentence") -> DataFrame:
    """(doc_id, date, unit, text) of docs (doc_id, title, body, date); a doc without body has no units."""
    text = S.analysis_text(F.col("title"), F.col("body"))
    return docs.select("doc_id", "date", F.posexplode(S.units(text, unit)).alias("unit", "text")).where("text is not null")


ANALYSED = "doc_id string, date string, unit int, text string, entities array<string>, runs array<array<array<string>>>"


def analysed_units(units: DataFrame, analyser: Analyser) -> DataFrame:
    """Units with entities and runs, written once since both passes read them."""

    def run(frames):
        for frame in frames:
            done = [analyser.runs(t) for t in frame["text"]]
            yield frame.assign(entities=[d[0] for d in done], runs=[d[1] for d in done])

    return cut(units.select("doc_id", "date", "unit", "text").mapInPandas(run, ANALYSED), "units")


def candidate_words(runs, max_len: int):
    """All contiguous parts of 2 to max_len tokens of each run, joined."""
    lemma = lambda run: F.transform(run, lambda t: t[1])
    sizes = F.sequence(F.lit(2), F.lit(max_len))

    def parts(run):
        words = lemma(run)
        each = lambda n: F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1))), lambda i: i + n - 1 <= F.size(words)), lambda i: F.array_join(F.slice(words, i, n), ""))
        return F.flatten(F.transform(sizes, each))

    return F.flatten(F.transform(runs, parts))


def compound_frequency(analysed: DataFrame, cfg: Config) -> DataFrame:
    """(word, freq) of every occurrence in the corpus, units that are dropped later included."""
    words = analysed.select(F.explode(candidate_words(F.col("runs"), cfg.compound_max_len)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("freq")).where(F.col("freq") >= cfg.compound_min_freq)


def build_baskets(docs: DataFrame, analyser: Analyser, cfg: Config) -> DataFrame:
    """(doc_id, date, unit, nodes, text) of units with at least two nodes.

    Each unit gets those of its own candidate compounds that are frequent, by a join, whatever their number.
    """
    analysed = analysed_units(unit_rows(docs, cfg.unit), analyser)
    words = analysed.select("doc_id", "unit", F.explode(F.array_distinct(candidate_words(F.col("runs"), cfg.compound_max_len))).alias("word"))
    own = words.join(compound_frequency(analysed, cfg).select("word"), "word", "left_semi").groupBy("doc_id", "unit").agg(F.collect_set("word").alias("known"))
    known = analysed.join(own, ["doc_id", "unit"], "left")

    def run(frames):
        for frame in frames:
            terms = [analyser.nodes(r, frozenset(k if k is not None else ())) for r, k in zip(frame["runs"], frame["known"])]
            nodes = [sorted({*e, *t}) for e, t in zip(frame["entities"], terms)]
            yield frame[["doc_id", "date", "unit", "text"]].assign(nodes=nodes)

    rows = known.mapInPandas(run, "doc_id string, date string, unit int, text string, nodes array<string>")
    return rows.where(F.size("nodes") >= 2).select("doc_id", "date", "unit", "nodes", "text")


def dictionary_candidates(baskets: DataFrame, known: DataFrame, min_count: int = 3, top: int = 50) -> DataFrame:
    """(list, word, n, rank): words by baskets that hold them; list A ends like an institution, B is four characters or more.

    known (alias) are names the dictionary has, compared in the same normal form.
    """
    from pyspark.sql.window import Window

    terms = baskets.select(F.explode("nodes").alias("node")).where("node like 't:%'").groupBy("node").agg(F.count("*").alias("n"))
    words = terms.select(F.substring("node", 3, 1000).alias("word"), "n").where(F.col("n") >= min_count)
    fresh = words.join(known.select(S.normalize_text_udf("alias").alias("word")).distinct(), "word", "left_anti")
    ends = F.col("word").rlike(CANDIDATE_ENDING)
    listed = fresh.withColumn("list", F.when(ends, "A").when(F.length("word") >= 4, "B")).where("list is not null")
    # two lists only, and only their heads are kept: the limit comes before the window
    heads = [listed.where(F.col("list") == x).orderBy(F.desc("n"), "word").limit(top) for x in "AB"]
    return heads[0].unionByName(heads[1]).withColumn("rank", F.row_number().over(Window.partitionBy("list").orderBy(F.desc("n"), "word")))


def make_analyser(entities: DataFrame, stopwords: set[str], cfg: Config, tokenize=morpheme_tokens) -> Analyser:
    """The dictionary is a small file-based table, collected once."""
    rows = [(r.id, list(r.aliases or []) + ([r.label] if r.label else [])) for r in entities.select("id", "label", "aliases").collect()]
    return Analyser([(i, list(dict.fromkeys(a))) for i, a in rows], stopwords, cfg, tokenize)


def entity_mentions(units: DataFrame, analyser: Analyser) -> DataFrame:
    """(doc_id, unit, entity): which entities each unit names."""

    def run(frames: pd.DataFrame):
        for frame in frames:
            rows = [(d, u, e) for d, u, t in zip(frame["doc_id"], frame["unit"], frame["text"]) for e in analyser.aliases.find(t)[0]]
            yield pd.DataFrame(rows, columns=["doc_id", "unit", "entity"])

    return units.select("doc_id", "unit", "text").mapInPandas(run, "doc_id string, unit int, entity string")
