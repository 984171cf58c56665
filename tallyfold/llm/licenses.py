"""Licence scans: an Aho-Corasick automaton finds notice phrases and identifier tags, and a
shunting-yard parser evaluates the licence expressions that follow the tags.

Texts are lower-cased in A-Z and read as words of letters, digits and non-ASCII characters, so
phrases are found whatever stands between their words. An expression is graded by its parts:
2 open, 1 share-alike, 0 closed; AND takes the lower grade, OR the higher, and WITH an
exception lifts a share-alike licence. All notices of a document hold together.

Defined cases: a null or empty text has no words and nothing found; a malformed expression
gives no grade, and no labels; repeated rows get a result each; an empty table gives an empty
result. Only doc_id and text are read, so names of other columns cannot clash.
"""

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and labels of the base rule.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Phrases added here, with the grade of what they say.
ADDED = {
    "apache license": "apache",
    "mit license": "mit",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "proprietary and confidential": "proprietary",
}
TAG = "spdx license identifier"
GRADES = {
    "cc-by": 2, "apache": 2, "mit": 2, "bsd": 2, "cc0": 2, "public-domain": 2, "isc": 2, "zlib": 2, "unlicense": 2,
    "0bsd": 2, "gpl": 1, "lgpl": 1, "agpl": 1, "mpl": 1, "cc-by-sa": 1, "epl": 1, "cddl": 1,
    "cc-by-nc": 0, "cc-by-nd": 0, "reserved": 0, "proprietary": 0,
}
# How sure a document with one such finding carries a licence.
TRUST = {"tag": 1.0, "phrase": 0.9, "reserved": 0.6}

OUTPUT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, grade int, expressions array<string>"
)

_READ = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_AFTER_TAG = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)", re.IGNORECASE | re.ASCII)
_TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+-]*)")
_RANK = {"or": 1, "and": 2, "with": 3}


class Malformed(ValueError):
    pass


def grade_of(name: str) -> int:
    """Grade of an identifier, by the longest known family it starts with; unknown ones are closed."""
    name = name.lower()
    fits = [k for k in GRADES if name == k or name.startswith((f"{k}-", f"{k}."))]
    return GRADES[max(fits, key=len)] if fits else 0


def tokens(expression: str) -> list[str]:
    """The tokens up to the first character that cannot belong to an expression."""
    out, at = [], 0
    while m := _TOKEN.match(expression, at):
        out.append(m[1])
        at = m.end()
    return out


def postfix(parts: list[str]) -> list[str]:
    """Shunting-yard: operands and operators in order of evaluation.

    Reads the longest start that is an expression; prose may follow on the same line.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand_next = True
    for part in parts:
        word = part.lower()
        if operand_next:
            if part == "(":
                waiting.append(part)
                continue
            if part == ")" or word in _RANK:
                raise Malformed(part)
            out.append(part)
            operand_next = False
        elif part == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                break
            waiting.pop()
        elif word in _RANK:
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand_next = True
        else:
            break
    if operand_next or "(" in waiting:
        raise Malformed("unfinished")
    return out + waiting[::-1]


def evaluate(expression: str) -> tuple[int, list[str]]:
    """Grade and licence identifiers of an expression."""
    stack: list[tuple[int, list[str]]] = []
    for part in postfix(tokens(expression)):
        if part in _RANK:
            (right, names), (left, before) = stack.pop(), stack.pop()
            if part == "with":  # the right side names an exception, not a licence
                stack.append((2 if left == 1 else left, before))
            else:
                stack.append((min(left, right) if part == "and" else max(left, right), before + names))
        else:
            stack.append((grade_of(part), [part.lower()]))
    return stack[0]


def automaton() -> ahocorasick.Automaton:
    """Phrases as words between single spaces, so that only whole words match."""
    found = ahocorasick.Automaton()
    for phrase, label in {**ADDED, **BASE}.items():
        found.add_word(f" {phrase} ", (phrase, label, phrase in BASE))
    found.add_word(f" {TAG} ", (TAG, "", False))
    found.make_automaton()
    return found


def scan_text(text: str | None, phrases: ahocorasick.Automaton) -> tuple:
    """One result row (without the id) for a whole text."""
    raw = text or ""
    words = raw.encode().translate(_READ).split()
    read = b" ".join([b"", *words, b""]).decode()
    places: list[int] = []
    base, labels, tagged, doubt, grades, expressions = set(), set(), False, 1.0, [], []
    counted = at = 0
    hits = sorted((end - len(value[0]) - 1, value) for end, value in phrases.iter(read))
    for start, (phrase, label, is_base) in hits:
        counted, at = counted + read.count(" ", at, start), start
        if phrase == TAG:
            tagged = True
            continue
        if is_base:
            places.append(counted)
            base.add(label)
        if label not in labels:
            doubt *= 1 - TRUST["reserved" if label == "reserved" else "phrase"]
            grades.append(GRADES[label])
        labels.add(label)
    for m in _AFTER_TAG.finditer(raw) if tagged else ():
        try:
            grade, names = evaluate(m[1])
        except Malformed:
            continue
        doubt = 1 - TRUST["tag"]
        grades.append(grade)
        labels.update(names)
        expressions.append(m[1].strip())
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        1.0 - doubt,
        min(grades, default=None),
        expressions,
    )


def scan(docs: DataFrame) -> DataFrame:
    """Licence findings per document; see OUTPUT for the columns."""
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.int32(), pa.list_(pa.string())]
    names = [c.split()[0] for c in OUTPUT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = automaton()
        for batch in batches:
            rows = [scan_text(text, phrases) for text in batch["text"].to_pylist()]
            columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
            found = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *found], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, OUTPUT)
