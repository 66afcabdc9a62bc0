"""Licences of documents: phrases and tags by an Aho-Corasick automaton, expressions by a
shunting-yard parser.

One automaton looks for all notice phrases and tags at once in a text's words. Behind a tag such
as ``SPDX-License-Identifier:`` stands a licence expression, whose ``and``, ``or`` and ``with``
are put in order by a shunting-yard and evaluated to how freely the text may be used: of ``or``
the freer side counts, of ``and`` the stricter, and ``with`` adds a permission.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

#: Phrases of the contract and their labels (fixed values).
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Further notice phrases, with the identifier of the licence they name.
NOTICES = {
    "gnu general public license version 2": "GPL-2.0",
    "gnu general public license version 3": "GPL-3.0",
    "gnu lesser general public license": "LGPL-3.0",
    "gnu affero general public license": "AGPL-3.0",
    "apache license version 2 0": "Apache-2.0",
    "mit license": "MIT",
    "isc license": "ISC",
    "bsd 2 clause": "BSD-2-Clause",
    "bsd 3 clause": "BSD-3-Clause",
    "mozilla public license": "MPL-2.0",
    "eclipse public license": "EPL-2.0",
    "cc0 1 0": "CC0-1.0",
    "cc by 4 0": "CC-BY-4.0",
    "cc by sa 4 0": "CC-BY-SA-4.0",
    "cc by nc 4 0": "CC-BY-NC-4.0",
    "cc by nd 4 0": "CC-BY-ND-4.0",
    "all rights reserved": "All-Rights-Reserved",
}

TAGS = ("spdx license identifier", "license expression")

#: What the base phrases stand for where no longer notice begins at the same word.
BASE_NAMES = {"gpl": "GPL", "apache": "Apache", "cc-by": "CC-BY", "mit": "MIT"}

#: How freely a text under a licence may be used, from 0 to 1, by the start of its identifier.
FREEDOM = {
    "CC0": 1.0, "MIT": 1.0, "ISC": 1.0, "BSD": 0.95, "Apache": 0.95, "CC-BY-NC": 0.1, "CC-BY-ND": 0.1,
    "CC-BY-SA": 0.4, "CC-BY": 0.9, "MPL": 0.6, "EPL": 0.6, "LGPL": 0.5, "AGPL": 0.1, "GPL": 0.2,
    "All-Rights-Reserved": 0.0,
}
UNKNOWN = 0.3
EXCEPTION = 0.1  # what a ``with`` clause adds

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                 for b in range(256))
_WORDS = re.compile(rb"[^ ]+")
_EXPRESSION = re.compile(rb"\s*:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+\-]*)")
_STRENGTH = {"or": 1, "and": 2, "with": 3}


def freedom(identifier: str) -> float:
    fitting = [k for k in FREEDOM if identifier.lower().startswith(k.lower())]
    return FREEDOM[max(fitting, key=len)] if fitting else UNKNOWN


def evaluate(expression: str) -> tuple[float, list[str]] | None:
    """Freedom and identifiers of a licence expression; None if it is not well formed.

    The expression ends where something stands that can't belong to it, such as the end of a
    comment. A shunting-yard: operators wait on a stack while stronger ones are carried out.
    """
    values: list[float] = []
    waiting: list[str] = []
    names: list[str] = []
    after_value, at = False, 0

    def carry_out() -> bool:
        operator = waiting.pop()
        if len(values) < 2:
            return False
        right, left = values.pop(), values.pop()
        values.append({"or": max(left, right), "and": min(left, right),
                       "with": min(1.0, left + EXCEPTION)}[operator])
        return True

    while token := _TOKEN.match(expression, at):
        at, word = token.end(), token[1]
        operator = word.lower() if word.lower() in _STRENGTH else None
        if word == "(":
            if after_value:
                break
            waiting.append(word)
        elif word == ")":
            if not after_value:
                return None
            if "(" not in waiting:
                break
            while waiting[-1] != "(":
                if not carry_out():
                    return None
            waiting.pop()
        elif operator:
            if not after_value:
                return None
            while waiting and waiting[-1] != "(" and _STRENGTH[waiting[-1]] >= _STRENGTH[operator]:
                if not carry_out():
                    return None
            waiting.append(operator)
            after_value = False
        else:
            if after_value:
                break
            values.append(freedom(word))
            if not (waiting and waiting[-1] == "with"):
                names.append(word)
            after_value = True
    if not after_value or "(" in waiting:
        return None
    while waiting:
        if not carry_out():
            return None
    return (values[0], names) if len(values) == 1 else None


def automaton() -> ahocorasick.Automaton:
    """All phrases and tags as words between blanks, with what each stands for."""
    found = ahocorasick.Automaton()
    meaning: dict[str, list] = {}
    for phrase, label in BASE.items():
        meaning.setdefault(phrase, [None, None, False])[0] = label
    for phrase, name in NOTICES.items():
        meaning.setdefault(phrase, [None, None, False])[1] = name
    for phrase in TAGS:
        meaning.setdefault(phrase, [None, None, False])[2] = True
    for phrase, (label, name, tag) in meaning.items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, label, name, tag))
    found.make_automaton()
    return found


def scan(text: bytes, phrases: ahocorasick.Automaton) -> tuple:
    """Words, base places, first and last of them, base labels, all labels, and the score."""
    plain = text.translate(_LETTERS)
    words = plain.split()
    line = f" {b' '.join(words).decode()} "
    base, named, tags, labels = {}, {}, [], set()  # by where they begin in the line
    for end, (size, label, name, tag) in phrases.iter(line):
        at = end + 1 - size
        if label:
            base[at] = label
        if name:
            labels.add(f"spdx:{name}")
            named.setdefault(at, []).append(freedom(name))
        if tag:
            tags.append(line.count(" ", 0, end) - 1)  # the tag's last word
    scores = [s for found in named.values() for s in found]
    scores += [freedom(BASE_NAMES[label]) for at, label in base.items() if at not in named]
    if tags:
        ends = [m.end() for m in _WORDS.finditer(plain)]
        for word in tags:
            behind = _EXPRESSION.match(text, ends[word])
            if behind and (meant := evaluate(behind[1].decode())) is not None:
                scores.append(meant[0])
                labels.update(f"spdx:{name}" for name in meant[1])
    starts = (line.count(" ", 0, min(base)), line.count(" ", 0, max(base))) if base else (None, None)
    found = set(base.values())
    return (len(words), len(base), *starts, ",".join(sorted(found)), ",".join(sorted(found | labels)), min(scores, default=0.0))


_STRUCT = StructType([StructField(n, LongType()) for n in ("n_words", "n_base", "first_word", "last_word")]
                     + [StructField(n, StringType()) for n in ("base_labels", "labels")]
                     + [StructField("score", DoubleType())])
_ARROW = pa.struct([(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")]
                   + [(n, pa.string()) for n in ("base_labels", "labels")] + [("score", pa.float64())])


@F.arrow_udf(_STRUCT)
def _scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    phrases = automaton()
    for texts in batches:
        rows = [scan(t or b"", phrases) for t in texts.cast(pa.large_binary()).to_pylist()]
        columns = zip(*rows, strict=True) if rows else [()] * len(_ARROW)
        yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)],
                                         fields=list(_ARROW))


def license_scan(text: Column) -> Column:
    """A struct with a text's licences.

    ``n_words``; ``n_base`` places of ``BASE`` phrases, ``first_word`` and ``last_word`` of them
    (words from 0; null if there are none); ``base_labels`` and ``labels`` (sorted, joined by
    commas); ``score``: how freely the text may be used, the least over all licences found, 0 if
    there are none. A base phrase counts as its family's licence unless a longer notice begins at the
    same word. A tag is a tag's words with a colon behind them; one whose expression is not well
    formed adds nothing. A null or empty text has no words. Phrases may overlap, each place counts.
    Long texts are scanned in one go, equal texts have equal results, no rows give none.
    """
    return _scanned(text)
