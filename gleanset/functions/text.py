"""Whole-word matching over title and body, as column expressions."""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word character is any letter or number of any script, or the underscore.
# Java's own \w is ASCII only and (?U)\w counts combining marks.
WORD = r"[\p{L}\p{N}_]"


# From so many terms on, a vocabulary is one walk down a trie instead of a pattern per term.
TRIE_TERMS = 200
_MAP_BUCKETS = 256


def escape_term(term: str) -> str:
    """The term as a literal inside a Java regular expression."""
    return "".join(c if c.isalnum() or ord(c) > 127 else "\\" + c for c in term)


def term_pattern(terms: Sequence[str], case_sensitive: bool = False, whole_word: bool = True) -> str:
    """One pattern that finds any of the terms.

    ``whole_word=False`` finds them inside longer words as well.
    """
    flags = "" if case_sensitive else "(?iu)"
    if len(terms) >= TRIE_TERMS:
        body = trie_body(terms if case_sensitive else [same_case(t) for t in terms])
    else:
        body = "|".join(escape_term(t) for t in terms)
        if len(terms) > 1:
            body = f"(?:{body})"
    if not whole_word:
        return flags + body
    return f"{flags}(?<!{WORD}){body}(?!{WORD})"


def trie_body(terms: Sequence[str]) -> str:
    """A pattern of the terms folded into a trie; at any place it finds the longest that fits.

    It is put together from the back: sorted terms share a stem as far as they agree.
    """
    words = sorted({t for t in terms if t})

    def branch(low: int, high: int, depth: int) -> str:
        """Pattern of what follows the first ``depth`` characters of ``words[low:high]``."""
        ended = len(words[low]) == depth
        begin, ways = low + ended, []
        while begin < high:
            end = begin + 1
            while end < high and words[end][depth] == words[begin][depth]:
                end += 1
            # Characters that all of them share make one step.
            first, last = words[begin], words[end - 1]
            stem = depth + 1
            while stem < len(first) and stem < len(last) and first[stem] == last[stem]:
                stem += 1
            ways.append(escape_term(first[depth:stem]) + branch(begin, end, stem))
            begin = end
        if not ways:
            return ""
        body = "|".join(ways)
        return f"(?:{body})" + ("?" if ended else "") if ended or len(ways) > 1 else body

    return branch(0, len(words), 0)


def _same_case(c: str) -> str:
    """The character that stands for all those (?iu) equates with this one: upper, then lower case."""
    up = c.upper()
    low = (up if len(up) == 1 else c).lower()
    return low[0] if len(low) > 1 else low


@lru_cache(maxsize=1)
def _case_classes() -> dict[str, str]:
    """Every cased character that is not its own stand-in, with its stand-in."""
    all_cased = (chr(n) for n in range(0x1E944) if not 0xD800 <= n < 0xE000)
    return {c: _same_case(c) for c in all_cased if _same_case(c) != c}


def same_case(term: str) -> str:
    return "".join(map(_same_case, term))


def search_text(title: str | Column = "title", text: str | Column = "text") -> Column:
    """Title, newline, body; a missing part counts as empty but the newline stays."""
    title = F.col(title) if isinstance(title, str) else title
    text = F.col(text) if isinstance(text, str) else text
    return F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))


def any_term(
    text: Column,
    terms: Sequence[str],
    case_sensitive: bool = False,
    whole_word: bool = True,
) -> Column:
    """True when at least one non-empty term occurs."""
    terms = [t for t in terms if t]
    if not terms:
        return F.lit(False)
    return text.rlike(term_pattern(terms, case_sensitive, whole_word))


def term_matches(text: Column, term: str, case_sensitive: bool = False) -> Column:
    """Does the word or phrase occur as a whole?  An empty term never does."""
    return any_term(text, [term], case_sensitive)


def folded(text: Column) -> Column:
    """Text in which every character that (?iu) equates with an ASCII letter is that letter."""
    return F.lower(F.translate(text, "\u0130\u0131\u017f\u212a", "iisk"))


def find_matches(text: Column, terms: Sequence[str], case_sensitive: bool = False) -> Column:
    """The terms that occur, in vocabulary order; a term listed twice is returned twice.

    A plain substring test goes before each pattern.  It is many times cheaper,
    and no whole-word hit of an ASCII term fails it.  Large vocabularies are found by one walk
    down a trie: see :func:`find_many`.
    """
    if len(terms) >= TRIE_TERMS:
        return find_many(text, terms, case_sensitive)
    searched = text if case_sensitive else folded(text)
    none = F.array().cast("array<string>")
    found = [none]
    for t in terms:
        if not t:
            continue
        hit = term_matches(text, t, case_sensitive)
        if t.isascii():
            hit = searched.contains(t if case_sensitive else t.lower()) & hit
        found.append(F.when(hit, F.array(F.lit(t))).otherwise(none))
    return F.concat(*found)


def find_many(text: Column, terms: Sequence[str], case_sensitive: bool = False) -> Column:
    """:func:`find_matches` for large vocabularies, in one pass over the text.

    At every place where a word may begin the trie tells the longest term that ends with a word.
    The other terms that begin there are beginnings of that one, so they are known beforehand:
    those after which it goes on with no word character.
    """
    fold = (lambda t: t) if case_sensitive else same_case
    places: dict[str, list[int]] = defaultdict(list)
    for i, t in enumerate(terms, start=1):
        if t:
            places[fold(t)].append(i)
    if not places:
        return F.array().cast("array<string>")
    # A map is searched from its start to its end, so the terms are dealt over many small ones.
    buckets: list[dict[str, list[int]]] = [{} for _ in range(_MAP_BUCKETS)]
    for t in places:
        found = [i for n in range(1, len(t) + 1) if t[:n] in places and not _word_at(t, n) for i in places[t[:n]]]
        buckets[zlib.crc32(t.encode()) % _MAP_BUCKETS][t] = found
    flags = "" if case_sensitive else "(?iu)"
    pattern = f"{flags}(?<!{WORD})(?=({trie_body(list(places))})(?!{WORD}))"
    begun = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(1))
    if not case_sensitive:
        swaps = _case_classes()
        spelled = {c for t in places for c in t}
        swaps = {c: to for c, to in swaps.items() if to in spelled}
        one, other = "".join(swaps), "".join(swaps.values())
        begun = F.transform(begun, lambda c: F.translate(c, one, other))
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,array<int>>>")
    listed = F.from_json(F.lit(json.dumps(list(terms))), "array<string>")
    hits = F.transform(
        F.array_distinct(begun),
        lambda c: F.element_at(
            F.element_at(table, (F.crc32(c.cast("binary")) % _MAP_BUCKETS + 1).cast("int")), c
        ),
    )
    order = F.array_sort(F.array_distinct(F.flatten(F.filter(hits, lambda h: h.isNotNull()))))
    return F.transform(order, lambda i: F.element_at(listed, i))


def _word_at(term: str, place: int) -> bool:
    """Does a word character stand there?  As :data:`WORD` has it: a letter, a number, or the underscore."""
    return place < len(term) and (term[place] == "_" or unicodedata.category(term[place])[0] in "LN")


def matching_batches(
    text: Column,
    batches: Sequence[Sequence[str]],
    case_sensitive: bool = False,
    whole_word: bool = True,
) -> Column:
    """Numbers, from 1, of the batches with at least one term in the text."""
    none = F.array().cast("array<int>")
    hits = [
        F.when(any_term(text, b, case_sensitive, whole_word), F.array(F.lit(i))).otherwise(none)
        for i, b in enumerate(batches, start=1)
    ]
    return F.concat(none, *hits)
