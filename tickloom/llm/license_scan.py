"""License scans: license texts and notices found by templates with optional and replaceable regions.

A template is wording with markup: `<<beginOptional>>…<<endOptional>>` may be absent, also nested, and
`<<var;name="…";original="…";match="…">>` may be replaced, by `.{m,n}` (m to n words of any kind) or by
one of the wordings `a b|c d`. Everything else is mandatory. All templates are compiled into one token
automaton without empty moves: every word of a template is a state, with the states that may follow it.
A text is matched at each word that can begin a template; a template is accepted there, with its
longest reading, if all of its mandatory wording stands in the text word for word. Only words count:
runs of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case; so punctuation,
white space, comment signs and line breaks never matter. Plain phrases are templates without markup.

Defined cases: a null or empty text has no words and no matches; every place counts, also repeated and
overlapping ones; a template that ends before the text does is accepted, one that is cut off by the
text's end is not; places of equal label are all listed, in order of place and template; an empty table
gives an empty result. Whole texts are read, however long. `scan` keeps all columns and gives its own
names that are free; repeated rows are scanned alike.

Texts are independent: one pass, no shuffle, and a task holds one text's words at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_names, text_or_empty
from tickloom.llm.license_templates import TEMPLATES

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARK = re.compile(r"<<(.*?)>>", re.DOTALL)
_ANY = re.compile(r"\.\{(\d+),(\d+)\}")
#: Sets of states whose followers are remembered; a text can't make a task hold more.
REMEMBERED = 100_000
#: Mandatory words at which a match scores one half.
HALF = 4.0

SPAN = "struct<label string, base boolean, start long, words long, mandatory long>"


@dataclass(frozen=True)
class Template:
    """Wording with markup, and the label of texts that hold it; `base` marks plain phrases."""

    label: str
    markup: str
    base: bool = False


#: The phrases that every scan counts, and their labels.
PHRASES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
)


@dataclass(frozen=True)
class Word:
    text: bytes


@dataclass(frozen=True)
class Any:
    least: int
    most: int


@dataclass(frozen=True)
class Choice:
    """One of some sequences; an optional region is a choice between it and nothing."""

    ways: tuple[tuple, ...]


def words_of(text: bytes) -> list[bytes]:
    # bytes.lower changes A-Z alone.
    return _WORD.findall(text.lower())


def _plain(text: str) -> tuple:
    return tuple(Word(w) for w in words_of(text.encode()))


def parse(markup: str) -> tuple:
    """The regions of a template: words, any words, and choices, in order."""
    open_: list[list] = [[]]
    for number, part in enumerate(_MARK.split(markup)):
        if number % 2 == 0:
            open_[-1] += _plain(part)
        elif part == "beginOptional":
            open_.append([])
        elif part == "endOptional":
            if len(open_) == 1:
                raise ValueError("endOptional without beginOptional")
            region = tuple(open_.pop())
            open_[-1].append(Choice((region, ())))
        elif part.startswith("var;"):
            match = re.search(r'match="([^"]*)"', part)
            if match is None:
                raise ValueError(f"a replaceable region needs match: {part}")
            if words := _ANY.fullmatch(match[1]):
                open_[-1].append(Any(int(words[1]), int(words[2])))
            else:
                open_[-1].append(Choice(tuple(_plain(way) for way in match[1].split("|"))))
        else:
            raise ValueError(f"unknown markup: {part}")
    if len(open_) > 1:
        raise ValueError("beginOptional without endOptional")
    return tuple(open_[0])


def mandatory_words(regions: Iterable) -> int:
    return sum(isinstance(region, Word) for region in regions)


class Automaton:
    """The states of all templates as bits: which word enters them, what may follow, where they end."""

    def __init__(self, templates: Sequence[Template]):
        self.templates = list(templates)
        self.mandatory: list[int] = []
        self.enters: dict[bytes, int] = {}  # word -> states that it enters
        self.any = 0  # states that any word enters
        self.follow: list[int] = []
        self.ends: list[int] = []  # state -> template that may end there, or -1
        self.first = self.last = 0
        for number, template in enumerate(self.templates):
            regions = parse(template.markup)
            start = len(self.follow)
            empty, first, last = self._sequence(regions)
            if empty or first & self.any:
                raise ValueError(f"a template begins with stated words: {template.markup[:60]!r}")
            self.ends += [number if last >> s & 1 else -1 for s in range(start, len(self.follow))]
            self.first |= first
            self.last |= last
            self.mandatory.append(mandatory_words(regions))
        self.starters = {w for w, states in self.enters.items() if states & self.first}
        self._after: dict[int, int] = {}

    # Each gives: whether nothing matches it, its first states, its last states.

    def _sequence(self, regions: Iterable) -> tuple[bool, int, int]:
        empty, first, last = True, 0, 0
        for region in regions:
            skip, starts, stops = self._region(region)
            self._link(last, starts)
            if empty:
                first |= starts
            last = stops | (last if skip else 0)
            empty = empty and skip
        return empty, first, last

    def _region(self, region) -> tuple[bool, int, int]:
        if isinstance(region, Word):
            state = self._state()
            self.enters[region.text] = self.enters.get(region.text, 0) | state
            return False, state, state
        if isinstance(region, Any):
            states = [self._state() for _ in range(region.most)]
            for a, b in zip(states, states[1:]):
                self._link(a, b)
            self.any |= sum(states)
            first = states[0] if states else 0
            return region.least == 0, first, sum(states[max(region.least, 1) - 1 :])
        ways = [self._sequence(way) for way in region.ways]
        first = last = 0
        for _, starts, stops in ways:
            first |= starts
            last |= stops
        return any(way[0] for way in ways), first, last

    def _state(self) -> int:
        self.follow.append(0)
        return 1 << (len(self.follow) - 1)

    def _link(self, froms: int, to: int) -> None:
        for state in _bits(froms):
            self.follow[state] |= to

    def _followers(self, states: int) -> int:
        known = self._after.get(states)
        if known is None:
            known = 0
            for state in _bits(states):
                known |= self.follow[state]
            if len(self._after) >= REMEMBERED:
                self._after.clear()
            self._after[states] = known
        return known

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(start, template, words) of every place, the longest reading of each template."""
        starters, enters, any_, last = self.starters, self.enters, self.any, self.last
        for start in [i for i, w in enumerate(words) if w in starters]:
            states, at = self.first & enters[words[start]], start
            found: dict[int, int] = {}
            while states:
                at += 1
                for state in _bits(states & last):
                    found[self.ends[state]] = at - start
                if at == len(words):
                    break
                states = self._followers(states) & (enters.get(words[at], 0) | any_)
            for template in sorted(found):
                yield start, template, found[template]


def _bits(states: int) -> Iterator[int]:
    while states:
        low = states & -states
        yield low.bit_length() - 1
        states ^= low


@lru_cache(4)
def automaton(templates: tuple[Template, ...]) -> Automaton:
    return Automaton(templates)


def all_templates() -> tuple[Template, ...]:
    return PHRASES + tuple(Template(label, markup) for label, markup in TEMPLATES)


def spans(text: str = "text", templates: tuple[Template, ...] | None = None) -> Column:
    """A struct of n_words and the accepted `spans` (label, base, start, words, mandatory) of a text."""
    templates = all_templates() if templates is None else tuple(templates)

    @F.pandas_udf(f"n_words long, spans array<{SPAN}>")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = automaton(templates)
        for batch in batches:
            counts, found = [], []
            for text in batch:
                words = words_of(text)
                counts.append(len(words))
                found.append([
                    {"label": machine.templates[t].label, "base": machine.templates[t].base,
                     "start": start, "words": length, "mandatory": machine.mandatory[t]}
                    for start, t, length in machine.matches(words)
                ])
            yield pd.DataFrame({"n_words": counts, "spans": pd.Series(found, dtype=object)})

    return scanned(text_or_empty(text).cast("binary"))


def scan(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] | None = None):
    """`docs` with two more columns, and their names: the count of words and the accepted spans."""
    both, n_words, found = free_names(docs, "scanned", "n_words", "spans")
    rows = docs.withColumn(both, spans(text, templates))
    rows = rows.select(*docs.columns, F.col(f"{both}.n_words").alias(n_words), F.col(f"{both}.spans").alias(found))
    return rows, n_words, found


def label_list(found: Column) -> Column:
    """The distinct labels of spans, sorted, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda s: s["label"]))), ",")


def score_of(found: Column) -> Column:
    """m / (m + HALF) for the longest accepted wording of m mandatory words; 0 without a match."""
    most = F.coalesce(F.array_max(F.transform(found, lambda s: s["mandatory"])), F.lit(0))
    return most / (most + HALF)


def summary(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    rows, n_words, found = scan(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")))
    base = F.filter(found, lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"])
    return rows.select(
        "doc_id",
        F.col(n_words).alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        label_list(base).alias("base_labels"),
        label_list(F.col(found)).alias("labels"),
        score_of(F.col(found)).alias("score"),
    )
