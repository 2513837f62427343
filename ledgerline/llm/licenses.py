"""Operator 8: licence scans.

One Aho-Corasick automaton finds notice phrases and identifier tags in a single
pass over each text's words.  Where a tag (``SPDX-License-Identifier``) stands,
the licence expression that follows it is read from the original text, brought to
postfix order by a shunting-yard parser (``WITH`` binds tighter than ``AND``,
``AND`` tighter than ``OR``) and evaluated to a permissiveness.  An operator or operand in
lower case that isn't a listed identifier is prose and ends the expression.

Map-only over (id, text): no shuffle, no skew.  The phrase list is a parameter
and is not corpus-sized."""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.text import map_texts, words

#: Base notice phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: The method's own notice phrases.
NOTICES = {
    "apache license": "apache", "mit license": "mit", "bsd license": "bsd",
    "mozilla public license": "mpl", "lesser general public license": "lgpl",
    "creative commons attribution": "cc-by", "public domain": "public-domain",
    "creative commons zero": "cc0", "cc0": "cc0", "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd", "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
TAG = "spdx license identifier"
#: How freely a text under a label may be used: 1 free, 0 not at all.
OPENNESS = {
    "public-domain": 1.0, "cc0": 1.0, "mit": 0.95, "bsd": 0.95, "apache": 0.9, "cc-by": 0.85, "cc-by-sa": 0.6,
    "mpl": 0.6, "lgpl": 0.5, "gpl": 0.35, "cc-by-nc": 0.2, "cc-by-nd": 0.2, "reserved": 0.0,
    "artistic": 0.7, "boost": 0.95, "cddl": 0.6, "epl": 0.6, "eupl": 0.45, "gfdl": 0.4, "lppl": 0.7, "ms-pl": 0.7,
    "ms-rl": 0.55, "odbl": 0.5, "ofl": 0.7, "osl": 0.4, "python": 0.9, "ruby": 0.85, "sspl": 0.2, "vim": 0.8, "zlib": 0.95,
}
#: Label of an expression's licence identifier, by its longest fitting beginning.
IDENTIFIERS = {
    "0bsd": "bsd", "afl": "apache", "agpl": "gpl", "apache": "apache", "artistic": "artistic", "bsd": "bsd",
    "bsl": "boost", "cc-by": "cc-by", "cc-by-nc": "cc-by-nc", "cc-by-nc-nd": "cc-by-nc", "cc-by-nc-sa": "cc-by-nc",
    "cc-by-nd": "cc-by-nd", "cc-by-sa": "cc-by-sa", "cc0": "cc0", "cddl": "cddl", "cecill": "gpl",
    "cecill-b": "bsd", "cecill-c": "lgpl", "cpl": "epl", "ecl": "apache", "epl": "epl", "eupl": "eupl",
    "gfdl": "gfdl", "gpl": "gpl", "isc": "mit", "lgpl": "lgpl", "lppl": "lppl", "mit": "mit", "mit-0": "mit",
    "mpl": "mpl", "ms-pl": "ms-pl", "ms-rl": "ms-rl", "ncsa": "mit", "odbl": "odbl", "odc-by": "cc-by",
    "ofl": "ofl", "openssl": "bsd", "osl": "osl", "pddl": "public-domain", "php": "bsd", "postgresql": "mit",
    "psf": "python", "python": "python", "ruby": "ruby", "sspl": "sspl", "unicode": "mit",
    "unlicense": "public-domain", "upl": "mit", "vim": "vim", "w3c": "mit", "wtfpl": "public-domain",
    "x11": "mit", "zlib": "zlib", "zpl": "bsd",
}
#: Words that end every exception that may stand after WITH.
EXCEPTION_ENDS = ("exception", "addition", "linking", "note", "permission")
UNKNOWN = 0.5  # openness of an identifier or label that is not listed
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
TAG_TEXT = re.compile(r"spdx[^0-9a-z\x80-\U0010ffff]+license[^0-9a-z\x80-\U0010ffff]+identifier[ \t]*[:=]?[ \t]*")
TOKEN = re.compile(r"[ \t]*(\(|\)|[0-9A-Za-z.+-]+(?::[0-9A-Za-z.+-]+)?)")


def to_postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: postfix order of an expression, None if it is malformed."""
    out, held, operand = [], [], True  # operand: one is due
    for t in tokens:
        op = t.lower()
        if op in PRECEDENCE:
            if operand:
                return None
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[op]:
                out.append(held.pop())
            held.append(op)
            operand = True
        elif t == "(":
            if not operand:
                return None
            held.append(t)
        elif t == ")":
            if operand:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        else:
            if not operand:
                return None
            out.append(t)
            operand = False
    if operand or "(" in held:
        return None
    return out + held[::-1]


def in_prose(token: str) -> bool:
    """Whether an operand can't be told from a word of running text: a lower-case word (or one
    with a capital first letter) without a digit that is no listed identifier."""
    return token[1:].islower() and token.isalpha() and identifier_label(token) is None


def read_expression(text: str, at: int) -> list[str]:
    """Tokens of the longest well-formed expression that starts at ``at``.  The first operand
    may be any word; after a lower-case operator, or in a group, prose ends the expression."""
    tokens, ends, depth = [], [], 0
    operand = True
    while m := TOKEN.match(text, at):
        t = m[1].rstrip(".") or m[1]
        is_op = t.lower() in PRECEDENCE
        if (t == "(" or not (is_op or t == ")")) != operand or t == ")" and not depth:
            break
        if operand and t != "(" and tokens:
            after = next((x for x in reversed(tokens) if x != "("), "")
            if after.lower() == "with":
                if not t.lower().startswith("licenseref") and not any(e in t.lower().split("-") for e in EXCEPTION_ENDS):
                    break
            elif in_prose(t):
                break
        depth += (t == "(") - (t == ")")
        operand = is_op or t == "("
        tokens.append(t)
        at = m.end()
        if not operand and not depth:
            ends.append(len(tokens))
        if t != m[1]:
            break  # a full stop ends the sentence
    return tokens[:ends[-1]] if ends else []


def identifier_label(token: str) -> str | None:
    t = token.lower()
    fits = [k for k in IDENTIFIERS if t == k or t.startswith(k + "-") or t.startswith(k + "+")]
    return IDENTIFIERS[max(fits, key=len)] if fits else None


def evaluate(postfix: list[str]) -> tuple[float, set[str]]:
    """(openness, labels): ``or`` lets the reader choose the freer side, ``and``
    binds to the stricter, ``with`` (an exception) goes half way towards free.  The label of
    an identifier that isn't listed is the identifier itself, in lower case."""
    stack: list[tuple[float, set[str]]] = []
    for t in postfix:
        if t in PRECEDENCE:
            (b, right), (a, left) = stack.pop(), stack.pop()
            if t == "with":  # the exception isn't a licence
                stack.append(((1 + a) / 2, left))
            else:
                stack.append(((max if t == "or" else min)(a, b), left | right))
        else:
            label = identifier_label(t) or t.lower()
            stack.append((OPENNESS.get(label, UNKNOWN), {label}))
    return stack[0]


@lru_cache(maxsize=4)
def automaton(phrases: tuple[str, ...]):
    found = ahocorasick.Automaton()
    for p in phrases:
        found.add_word(f" {p} ", p)
    found.make_automaton()
    return found


def scan(data: bytes, base: dict[str, str], notices: dict[str, str]) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, expressions."""
    found_words = words(data)
    text = " " + b" ".join(found_words).decode() + " "
    starts, base_labels, labels, tagged = [], set(), set(), False
    at_char = at_word = 0
    for end, phrase in automaton((*base, *[p for p in notices if p not in base], TAG)).iter(text):
        if phrase == TAG:
            tagged = True
            continue
        if phrase in base:
            start = end - len(phrase) - 1
            if start >= at_char:
                at_word += text.count(" ", at_char, start)
                at_char, word = start, at_word
            else:  # a longer phrase that ended later began earlier
                word = text.count(" ", 0, start)
            starts.append(word)
            base_labels.add(base[phrase])
        labels.add(base.get(phrase) or notices[phrase])
    opennesses, expressions, noticed, judged = [], [], set(labels), set()
    if tagged:
        original = data.decode()
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in original)
        for m in TAG_TEXT.finditer(lowered):
            tokens = read_expression(original, m.end())
            if tokens and (postfix := to_postfix(tokens)):
                openness, of = evaluate(postfix)
                opennesses.append(openness)
                labels |= of
                judged |= of
                expressions.append(" ".join(tokens))
    # notices bind beside expressions, but for those that name a licence the expressions judge already
    opennesses += [OPENNESS.get(x, UNKNOWN) for x in noticed - judged]
    score = 1.0 - min(opennesses) if opennesses else 0.0
    return (len(found_words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, expressions)


SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
          "base_labels string, labels string, score double, expressions array<string>")


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 base: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """Licence evidence of every row.

    ``n_base`` counts the places where a base phrase's words stand one after
    another (overlaps count), ``first_word``/``last_word`` are the smallest and
    largest of their start words (NULL without any).  ``labels`` adds the method's
    notices and the identifiers of tagged expressions.  ``score`` is how restrictive the
    strictest of them is (1 - openness; 0 without a licence); a notice of a licence that an
    expression names is judged within the expression alone.  ``expressions`` are those that
    were read, in order.
    Malformed expressions are passed over; NULL and empty texts find nothing."""
    base = {" ".join(k.split()): v for k, v in (BASE if base is None else base).items()}
    notices = {" ".join(k.split()): v for k, v in (NOTICES if notices is None else notices).items()}
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]

    def rows(ids, texts):
        columns = list(zip(*(scan(t, base, notices) for t in texts)))
        yield pa.RecordBatch.from_arrays(
            [ids, *(pa.array(c, kind) for c, kind in zip(columns, types))], names)
    return map_texts(df, id_col, text_col, SCHEMA, rows)
