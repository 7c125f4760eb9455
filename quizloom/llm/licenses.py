"""Licence scans by templates compiled to token automata.

A template is mandatory words with optional regions ``[[...]]``, which may nest, and replaceable ones ``<<name:2-9>>`` of so many words. All templates become
one automaton over words: an optional region is passed over by an empty step, a replaceable one counts words of any kind. At each word that begins a
template the automaton runs until it has no state left; it accepts where all mandatory wording of a template stood, exactly and in order.
Sets of states are made deterministic as texts meet them.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import small_batches, thrifty
from quizloom.llm.license_templates import TEMPLATES

#: Words: what is neither ASCII punctuation nor white space nor a control; A-Z count as a-z.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
MARKUP = re.compile(r"\[\[|\]\]|<<[^:<>]*:(\d+)-(\d+)>>")
#: Sets of states that are remembered.
REMEMBERED = 50_000
#: Phrases of the base scan and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
SPANS = "array<struct<label:string,base:boolean,start:bigint,stop:bigint,wording:bigint>>"
Part = bytes | tuple[int, int] | list  # a word, a replaceable region, an optional one


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LETTERS).split()


def parse(markup: str) -> list[Part]:
    """The parts of a template. It must begin and end with a mandatory word."""
    stack: list[list[Part]] = [[]]
    at = 0
    for m in MARKUP.finditer(markup):
        stack[-1] += words_of(markup[at : m.start()])
        at = m.end()
        if m[0] == "[[":
            stack.append([])
        elif m[0] == "]]":
            if len(stack) == 1:
                raise ValueError(f"a region ends that has not begun: {markup[:60]!r}")
            region = stack.pop()
            stack[-1] += [region] if region else []
        else:
            stack[-1].append((int(m[1]), int(m[2])))
    parts = stack[0] + words_of(markup[at:])
    if len(stack) > 1 or not parts or not all(isinstance(parts[k], bytes) for k in (0, -1)):
        raise ValueError(f"a template begins and ends with words, and every region ends: {markup[:60]!r}")
    return parts


class Automaton:
    """Templates (label, markup, whether of the base scan) as one automaton over words."""

    def __init__(self, templates: list[tuple[str, str, bool]]):
        self.labels = [(label, base) for label, _, base in templates]
        self.steps: list[dict[bytes | None, set[int]]] = [{}]  # by state, then word; None: any word
        self.skips: list[set[int]] = [set()]
        self.accepts: dict[int, int] = {}
        self.wording = []
        for number, (_, markup, _) in enumerate(templates):
            parts = parse(markup)
            self.wording.append(sum(isinstance(p, bytes) for p in parts))
            self.accepts[self._add(parts, 0)] = number
        self.vocabulary = {w for s in self.steps for w in s if w is not None}
        self.start = self._closed({0})
        self.first = {w for s in self.start for w in self.steps[s]}
        self.seen: dict[frozenset, dict] = {}

    def _state(self) -> int:
        self.steps.append({})
        self.skips.append(set())
        return len(self.steps) - 1

    def _step(self, state: int, word: bytes | None) -> int:
        to = self._state()
        self.steps[state].setdefault(word, set()).add(to)
        return to

    def _add(self, parts: list[Part], state: int) -> int:
        for p in parts:
            if isinstance(p, bytes):
                state = self._step(state, p)
            elif isinstance(p, list):
                end = self._add(p, state)
                after = self._state()
                self.skips[end].add(after)
                self.skips[state].add(after)
                state = after
            else:
                after, (least, most) = self._state(), p
                for k in range(most + 1):
                    if k >= least:
                        self.skips[state].add(after)
                    if k < most:
                        state = self._step(state, None)
                state = after
        return state

    def _closed(self, states: set[int]) -> frozenset[int]:
        todo, out = list(states), set(states)
        while todo:
            new = self.skips[todo.pop()] - out
            out |= new
            todo += new
        return frozenset(out)

    def _next(self, states: frozenset[int], word: bytes | None) -> tuple[frozenset[int], list[int]]:
        """The states after a word (None: one of no template), and the templates they accept."""
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        known = self.seen.setdefault(states, {})
        if word not in known:
            to = self._closed({x for s in states for w in (word, None) for x in self.steps[s].get(w, ())})
            known[word] = to, [self.accepts[s] for s in to if s in self.accepts]
        return known[word]

    def scan(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(start, template, stop) of every place where a template's wording stands, the longest such place of each start."""
        out, vocabulary = [], self.vocabulary
        for at in [i for i, w in enumerate(words) if w in self.first]:
            states, to, ends = self.start, at, {}
            while states and to < len(words):
                w = words[to]
                states, accepted = self._next(states, w if w in vocabulary else None)
                to += 1
                ends.update(dict.fromkeys(accepted, to))
            out += [(at, n, end) for n, end in sorted(ends.items())]
        return out


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, phrases: dict[str, str] | None = None, text: str = "text") -> DataFrame:
    """Add n_words and spans (array of label, base, start, stop, wording, by start) to each row; the text column goes.

    A span is a place where a template (label, markup) accepts, from the word ``start`` up to before ``stop``, with ``wording`` mandatory words; the phrases (phrase to label) are templates without
    regions, marked ``base``. Of one template the longest place of each start counts; places may overlap. A null or empty text has no
    words and no spans. Rows stand for themselves: repeated rows stay repeated, an empty table gives none. Columns with the names of added ones are replaced. A text is read once, whole;
    from a word on no more is read than the longest template can take.
    """
    small_batches(docs.sparkSession)
    rules = [(label, phrase, True) for phrase, label in (PHRASES if phrases is None else phrases).items()]
    rules += [(label, markup, False) for label, markup in (TEMPLATES if templates is None else templates)]
    automaton = Automaton(rules)
    rest = [c for c in docs.columns if c not in (text, "n_words", "spans")]
    source = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias("__text"))
    span = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("stop", pa.int64()), ("wording", pa.int64())])

    def run(batches):
        for batch in batches:
            sizes, found = [], []
            for t in batch.column("__text").to_pylist():
                words = words_of(t)
                sizes.append(len(words))
                found.append([dict(zip(("label", "base", "start", "stop", "wording"), (*automaton.labels[n], at, end, automaton.wording[n]), strict=True)) for at, n, end in automaton.scan(words)])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(span))], [*rest, "n_words", "spans"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]] + ["n_words bigint", f"spans {SPANS}"]
    return source.mapInArrow(thrifty(run), ", ".join(fields))


def labels(spans: Column, base: bool = False) -> Column:
    """Labels of the spans (of the base scan only), distinct, sorted, joined by commas."""
    found = F.filter(spans, lambda s: s["base"]) if base else spans
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda s: s["label"]))), ",")


def score(spans: Column) -> Column:
    """How much wording backs the best span: w / (w + 1) for w mandatory words; 0 without a span."""
    most = F.coalesce(F.array_max(F.transform(spans, lambda s: s["wording"])), F.lit(0))
    return most / (most + 1)


def as_pattern(parts: list[Part]) -> str:
    """The template as a regular expression over words that are each followed by a space."""
    return "".join(p.decode() + " " if isinstance(p, bytes) else f"(?:{as_pattern(p)})?" if isinstance(p, list) else f"(?:[^ ]+ ){{{p[0]},{p[1]}}}" for p in parts)


def license_sql() -> str:
    """SQL for the query's rows: templates as regular expressions, which another engine matches."""
    rules = [(label, phrase, True) for phrase, label in PHRASES.items()] + [(label, markup, False) for label, markup in TEMPLATES]
    parsed = [(label, parse(markup), base) for label, markup, base in rules]
    hits = ", ".join(f"CASE WHEN regexp_matches(line, ' {as_pattern(parts)}') THEN {{'label': '{label}', 'base': {base}, 'wording': {sum(isinstance(p, bytes) for p in parts)}}} END" for label, parts, base in parsed)
    places = " + ".join(f"list_filter(range(len(words) - {len(p) - 1}), lambda i: words[i+1:i+{len(p)}] = [{', '.join(repr(w.decode()) for w in p)}])" for _, p, base in parsed if base).replace(" + ", " || ")
    return rf"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents),
line AS (SELECT *, ' ' || array_to_string(words, ' ') || ' ' AS line FROM w),
found AS (SELECT doc_id, words, {places} AS places, list_filter([{hits}], lambda h: h IS NOT NULL) AS hits FROM line)
SELECT doc_id, len(words) AS n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
       array_to_string(list_sort(list_distinct(list_transform(list_filter(hits, lambda h: h.base), lambda h: h.label))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_transform(hits, lambda h: h.label))), ',') AS labels,
       coalesce(list_max(list_transform(hits, lambda h: h.wording)), 0)::DOUBLE / (coalesce(list_max(list_transform(hits, lambda h: h.wording)), 0) + 1)::DOUBLE AS score
FROM found
"""
