"""License scans: template markup compiled into token automata, run over whole texts.

A template is a license text in which ``[[ ... ]]`` encloses wording that may be absent (it may
nest) and ``{{n}}`` stands for a replaceable region of up to ``n`` words. Everything else is
mandatory and must match word for word. Words are what is left of the lower-cased text between
separators, so line ends, punctuation and markup do not matter.

Each template becomes a nondeterministic automaton over words. An automaton is started only where
its anchor stands, the literal words that every match contains nearest to its beginning, found by a
byte search; the words before the anchor are walked backwards and those after it forwards, so no
text is walked in full by Python code.

Defined results: a null text is empty; empty texts have no words, no labels and score 0; ids may be
null or repeat (one row per input row); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases whose words count wherever they stand one after another.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_WARRANTY = (
    " this software is provided by {{16}} as is and any express or implied warranties including but not limited to the"
    " implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{16}} be"
    " liable for any direct indirect incidental special exemplary or consequential damages including but not limited to"
    " procurement of substitute goods or services loss of use data or profits or business interruption however caused and on"
    " any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any"
    " way out of the use of this software even if advised of the possibility of such damage"
)
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met"
)
_BSD_CONDITIONS = (
    " [[ 1 ]] redistributions of source code must retain the above copyright notice this list of conditions and the following"
    " disclaimer [[ 2 ]] redistributions in binary form must reproduce the above copyright notice this list of conditions"
    " and the following disclaimer in the documentation and or other materials provided with the distribution"
)
_NO_ENDORSEMENT = (
    " neither the name of {{16}} nor the names of its contributors may be used to endorse or promote products derived from"
    " this software without specific prior written permission"
)
_MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this {{8}} to deal in the {{4}}"
    " without restriction including without limitation the rights to use copy modify merge publish distribute"
    " sublicense and or sell copies of the {{4}}"
)
_MIT_NOTICE = (
    " and to permit persons to whom the {{4}} is furnished to do so subject to the following conditions the above copyright"
    " notice and this permission notice [[ including the next paragraph ]] shall be included in all copies or substantial"
    " portions of the {{4}}"
)
_MIT_WARRANTY = (
    " the {{4}} is provided as is without warranty of any kind express or implied including but not limited to the warranties"
    " of merchantability fitness for a particular purpose and noninfringement in no event shall the {{6}} be liable for any"
    " claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in"
    " connection with the {{4}} or the use or other dealings in the {{4}}"
)
_ISC = (
    "permission to use copy modify and or distribute this {{3}} for any purpose with or without fee is hereby"
    " granted provided that the above copyright notice and this permission notice appear in all copies"
)

#: Notices and license bodies by label: the whole wording, but for optional and free words.
TEMPLATES = {
    "apache-2.0": ("licensed under the apache license version 2.0 [[ the license ]]",),
    "mit": ("[[ this {{4}} is ]] [[ released ]] under the [[ terms of the ]] mit license", _MIT + _MIT_NOTICE + _MIT_WARRANTY),
    "json": (_MIT + _MIT_NOTICE + " the {{4}} shall be used for good not evil" + _MIT_WARRANTY,),
    "gpl-3.0": (
        "[[ this {{6}} is ]] licensed under the gnu general public license [[ as published by the free software"
        " foundation ]] [[ either ]] version 3 [[ of the license ]] [[ or at your option any later version ]]",
    ),
    "gpl-2.0": (
        "licensed under the gnu general public license [[ as published by the free software foundation ]]"
        " [[ either ]] version 2 [[ of the license ]] [[ or at your option any later version ]]",
    ),
    "cc-by-nc-4.0": (
        "[[ licensed under ]] [[ a ]] [[ the ]] cc by nc 4.0",
        "creative commons attribution noncommercial 4.0 international [[ public ]] license",
    ),
    "cc-by-sa-4.0": (
        "[[ licensed under ]] [[ a ]] [[ the ]] cc by sa 4.0",
        "creative commons attribution sharealike 4.0 international [[ public ]] license",
    ),
    "bsd-2-clause": (_BSD + _BSD_CONDITIONS + _WARRANTY,),
    "bsd-3-clause": (_BSD + _BSD_CONDITIONS + " [[ 3 ]]" + _NO_ENDORSEMENT + _WARRANTY,),
    "bsd-4-clause": (
        _BSD + _BSD_CONDITIONS + " [[ 3 ]] all advertising materials mentioning features or use of this software must display the"
        " following acknowledgement this product includes software developed by {{16}} [[ 4 ]]" + _NO_ENDORSEMENT + _WARRANTY,
    ),
    "isc": (
        _ISC + " the {{3}} is provided as is and {{8}} disclaims all warranties with regard to this {{3}} including all implied"
        " warranties of merchantability and fitness in no event shall {{8}} be liable for any special direct indirect or"
        " consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of"
        " contract negligence or other tortious action arising out of or in connection with the use or performance of this {{3}}",
    ),
}

#: Titles and first sentences of licenses, for texts that go on in words of their own or break off.
OPENINGS = {
    "apache-2.0-opening": ("apache license version 2.0 january 2004 [[ http www apache org licenses ]]",),
    "bsd-opening": (_BSD,),
    "isc-opening": (_ISC,),
    "mit-opening": (_MIT,),
}

#: What a label is worth: a template's whole wording, the opening of a license, or a phrase alone.
TEMPLATE_SCORE, OPENING_SCORE, PHRASE_SCORE = 1.0, 0.75, 0.5

# Bytes: ASCII letters become lower case, all other ASCII but digits separates.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


@dataclass(frozen=True)
class Automaton:
    """States 0 … n-1; ``steps[s]``: (word or None for any word, next state); ``free[s]``: states
    reached without a word; accepting state ``n-1``. ``anchor``: literal words on every path, with
    the automata of what comes before (reversed) and after them."""

    steps: tuple[tuple[tuple[bytes | None, int], ...], ...]
    free: tuple[frozenset[int], ...]

    def ends(self, words: list[bytes], at: int, step: int) -> bool:
        """Whether the automaton accepts a run of words from ``at`` on, walking by ``step``."""
        states = set(self.free[0])
        last = len(self.steps) - 1
        while last not in states:
            if not 0 <= at < len(words):
                return False
            word = words[at]
            following = {to for s in states for wanted, to in self.steps[s] if wanted is None or wanted == word}
            if not following:
                return False
            states = set().union(*(self.free[s] for s in following))
            at += step
        return True


_MARKUP = re.compile(r"\[\[|\]\]|\{\{\d+\}\}")


def parse(template: str) -> list:
    """The template as a list of words (bytes), whole numbers (that many free words) and lists (optional parts)."""
    stack: list[list] = [[]]
    at = 0
    for mark in [*_MARKUP.finditer(template), None]:
        stack[-1].extend(words_of(template[at: mark.start() if mark else len(template)]))
        if mark is None:
            break
        at = mark.end()
        if mark[0] == "[[":
            stack.append([])
        elif mark[0] == "]]":
            if len(stack) == 1:
                raise ValueError(f"]] without [[ in {template!r}")
            inner = stack.pop()
            stack[-1].append(inner)
        else:
            stack[-1].append(int(mark[0][2:-2]))
    if len(stack) != 1:
        raise ValueError(f"[[ without ]] in {template!r}")
    return stack[0]


def compile_parts(parts: list) -> Automaton:
    steps: list[list[tuple[bytes | None, int]]] = [[]]
    jumps: list[set[int]] = [set()]

    def state() -> int:
        steps.append([])
        jumps.append(set())
        return len(steps) - 1

    def build(items: list, at: int) -> int:
        for item in items:
            if isinstance(item, bytes):
                to = state()
                steps[at].append((item, to))
                at = to
            elif isinstance(item, int):
                opened = [at]
                for _ in range(item):
                    to = state()
                    steps[at].append((None, to))
                    opened.append(to)
                    at = to
                for s in opened[:-1]:
                    jumps[s].add(at)
            else:
                end = build(item, at)
                jumps[at].add(end)
                at = end
        return at

    end = build(parts, 0)
    if end != len(steps) - 1:  # the last state accepts
        to = state()
        jumps[end].add(to)

    def reach(s: int) -> frozenset[int]:
        seen, todo = {s}, [s]
        while todo:
            for to in jumps[todo.pop()] - seen:
                seen.add(to)
                todo.append(to)
        return frozenset(seen)

    return Automaton(tuple(map(tuple, steps)), tuple(reach(s) for s in range(len(steps))))


def _turned(parts: list) -> list:
    return [_turned(x) if isinstance(x, list) else x for x in reversed(parts)]


@dataclass(frozen=True)
class Matcher:
    anchor: bytes
    before: Automaton
    after: Automaton
    anchor_words: int

    @classmethod
    def of(cls, template: str) -> Matcher:
        parts = parse(template)
        runs, start = [], None
        for i, part in enumerate([*parts, None]):
            if isinstance(part, bytes):
                start = i if start is None else start
            elif start is not None:
                runs.append((start, i))
                start = None
        if not runs:
            raise ValueError(f"no mandatory wording in {template!r}")
        # The run of most words, then letters, is the rarest.
        a, b = max(runs, key=lambda r: (r[1] - r[0], sum(map(len, parts[r[0]: r[1]])), -r[0]))
        return cls(
            b" " + b" ".join(parts[a:b]) + b" ", compile_parts(_turned(parts[:a])), compile_parts(parts[b:]), b - a
        )

    def found(self, line: bytes, words: list[bytes]) -> bool:
        return any(
            self.before.ends(words, first - 1, -1) and self.after.ends(words, first + self.anchor_words, 1)
            for first in _places(line, self.anchor)
        )


def _places(line: bytes, phrase: bytes) -> Iterator[int]:
    """The numbers of the words at which the phrase begins, counted on from one to the next."""
    at, counted, words = line.find(phrase), 0, 0
    while at >= 0:
        words += line.count(b" ", counted, at + 1)
        counted = at + 1
        yield words - 1
        at = line.find(phrase, at + 1)


_SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
    openings: Mapping[str, tuple[str, ...]] = OPENINGS,
) -> DataFrame:
    """Per row: ``n_words``, places of phrases (``n_base``, ``first_word``, ``last_word``, words from 0),
    ``base_labels``, ``labels`` (those, and the templates and openings that match) and ``score``: the worth of the best label."""
    wanted = [(b" " + b" ".join(words_of(p)) + b" ", label) for p, label in phrases.items()]

    def one(line: bytes, words: list[bytes], matchers, beginnings) -> tuple:
        places, labels = [], set()
        for phrase, label in wanted:
            if here := list(_places(line, phrase)):
                places += here
                labels.add(label)
        matched = {label for label, several in matchers if any(m.found(line, words) for m in several)}
        opened = {label for label, several in beginnings if any(m.found(line, words) for m in several)}
        score = TEMPLATE_SCORE if matched else OPENING_SCORE if opened else PHRASE_SCORE if labels else 0.0
        return (
            len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)), ",".join(sorted(labels | matched | opened)), score,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers, beginnings = (
            [(label, [Matcher.of(t) for t in several]) for label, several in given.items()] for given in (templates, openings)
        )
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                words = words_of(text.as_py() or "")
                rows.append(one(b" " + b" ".join(words) + b" ", words, matchers, beginnings))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", *names]
            )

    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, {_SCHEMA}")
