"""Text rewriting, link handling, snippets and match marking as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from placetime.functions import values

# Markup, limits and token forms that results depend on.
MARK_OPEN = "<mark class='search-match'>"
MARK_CLOSE = "</mark>"
SNIPPET_LEAD = 50
SNIPPET_TAIL = 200
ELLIPSIS = "…"
BREAKS = (" ", ",", ":")
TURTLE_TOKENS = r"\d*\+|\d*\-|F|L|R|\[|\]|\|"


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- tokens and rewriting -----------------------------------------------------

def extract_tokens(text: Column | str, pattern: str = TURTLE_TOKENS) -> Column:
    """All matches of a pattern, in order."""
    return F.regexp_extract_all(_c(text), F.lit(pattern), F.lit(0))


def rewrite(text: Column | str, rules: dict[str, str], rounds: int = 1, limit: int = 10_000) -> Column:
    """Replace every character that has a rule, all at once, ``rounds`` times.

    A text that grows to more than ``limit`` times its bytes fails the job. A character of a rule first turns
    into an escape and a number, so no replacement is replaced again in the same round; escapes that the text
    holds are escaped too. Escape and numbers are private-use characters that no rule has.
    """
    if any(len(key) > 1 for key in rules):
        raise ValueError("rules rewrite single characters")
    rules = {key: value for key, value in rules.items() if key}
    taken = set("".join([*rules, *rules.values()]))
    free = (chr(c) for c in range(0xE000, 0xF8FF) if chr(c) not in taken)
    escape, own, *numbers = (next(free) for _ in range(len(rules) + 2))
    start = _c(text)

    def once(current: Column) -> Column:
        current = F.replace(current, F.lit(escape), F.lit(escape + own))
        for key, number in zip(rules, numbers, strict=True):
            current = F.replace(current, F.lit(key), F.lit(escape + number))
        for value, number in zip(rules.values(), numbers, strict=True):
            current = F.replace(current, F.lit(escape + number), F.lit(value))
        return F.replace(current, F.lit(escape + own), F.lit(escape))

    def checked(current: Column) -> Column:
        grown = F.octet_length(current) > limit * F.greatest(F.octet_length(start), F.lit(1)).cast("long")
        return F.when(grown, F.raise_error(F.lit(f"the text grows more than {limit} times")).cast("string")).otherwise(current)

    return reduce(lambda current, _round: values.let(once(current), checked), range(rounds), start)


def split_escaped(text: Column | str, separator: str, escape: str) -> Column:
    """Split on a separator unless escaped; drop the escapes and a trailing empty part."""
    sep, esc = (rf"\x{{{ord(ch):x}}}" for ch in (separator, escape))
    field = rf"((?:[^{sep}{esc}]++|{esc}.)*+)"
    complete = F.regexp_replace(_c(text), rf"(?s)^((?:[^{esc}]++|{esc}.)*+){esc}$", "$1")
    # every field ends at a separator or at the end, where one empty match follows
    parts = F.regexp_extract_all(complete, F.lit(rf"(?s){field}(?:{sep}|$)"), F.lit(1))
    kept = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(kept, lambda part: F.regexp_replace(part, rf"(?s){esc}(.)", "$1"))


# --- links --------------------------------------------------------------------

def link_page(href: Column | str) -> Column:
    return F.split_part(_c(href), F.lit("#"), F.lit(1))


def link_is_page(href: Column | str) -> Column:
    """True when the link has no anchor, so it names the whole page."""
    return ~F.contains(_c(href), F.lit("#"))


def add_parameter(href: Column | str, name: str, value: Column | str) -> Column:
    """Add ``name=value`` in front of any anchor; the value is used as it is."""
    href = _c(href)
    page = link_page(href)
    anchor = F.substring(href, F.length(page) + 1, F.length(href))
    # a question mark in the very first place does not start a parameter list
    joint = F.when(F.instr(page, "?") > 1, F.lit("&")).otherwise(F.lit("?"))
    return F.concat(page, joint, F.lit(f"{name}="), _c(value), anchor)


def path_of(url: Column | str) -> Column:
    """Path of an absolute URL without its leading slash."""
    return F.regexp_extract(_c(url), r"^[a-z]+://[^/?#]*/?([^?#]*)", 1)


def shared_prefix(page_path: Column | str, listing_path: Column | str) -> Column:
    """Number of leading segments of one path that the other starts with, on a segment border."""
    mine, other = F.split(_c(page_path), "/"), F.split(_c(listing_path), "/")
    return F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.size(mine)),
            lambda k: F.when(F.slice(mine, F.lit(1), k) == F.slice(other, F.lit(1), k), k).otherwise(0),
        )
    )


# --- matches --------------------------------------------------------------------

def regex_quote(term: Column | str) -> Column:
    """The term as a pattern that matches only itself."""
    inner = F.replace(_c(term), F.lit(r"\E"), F.lit(r"\E\\E\Q"))
    return F.concat(F.lit(r"\Q"), inner, F.lit(r"\E"))


def mark_all(text: Column | str, term: Column | str) -> Column:
    """Wrap each match of the literal term, ignoring case."""
    pattern = F.concat(F.lit("(?iu)("), regex_quote(term), F.lit(")"))
    return F.when(F.length(_c(term)) == 0, _c(text)).otherwise(
        F.regexp_replace(_c(text), pattern, F.lit("<mark>$1</mark>"))
    )


def unmark(text: Column | str, term: Column | str) -> Column:
    """Remove the marks whose text equals the term, ignoring case."""
    pattern = F.concat(F.lit("(?iu)<mark>("), regex_quote(term), F.lit(")</mark>"))
    return F.regexp_replace(_c(text), pattern, F.lit("$1"))


def snippet(text: Column | str, query: Column | str) -> Column:
    """Text around the first match, cut at spaces, commas or colons, with the match marked.

    Without a match the text stays as it is. A tail without a break is kept whole.
    """
    text, query = _c(text), _c(query)
    marks = len(MARK_OPEN) + len(MARK_CLOSE)

    def since_break(value: Column) -> Column:
        return F.least(*(F.length(F.substring_index(value, sign, -1)) for sign in BREAKS))

    def until_break(value: Column) -> Column:
        return F.least(*(F.length(F.substring_index(value, sign, 1)) for sign in BREAKS))

    def around(at: Column) -> Column:
        head = F.substring(text, F.lit(1), at - 1)
        begin = F.when(at - 1 < SNIPPET_LEAD, 0).otherwise(at - 1 - since_break(head))
        return F.when(at > 0, values.let(begin, lambda b: cut(at, b))).otherwise(text)

    def cut(at: Column, begin: Column) -> Column:
        # the text from the cut on, with the match marked
        marked = F.concat(
            F.substring(text, begin + 1, at - 1 - begin), F.lit(MARK_OPEN),
            F.substring(text, at, F.length(query)), F.lit(MARK_CLOSE),
            F.substring(text, at + F.length(query), F.length(text)),
        )
        return values.let(marked, lambda m: values.let(
            F.substring(m, F.lit(marks + SNIPPET_TAIL + 1), F.length(m)), lambda tail: close(m, tail)
        ))

    def close(marked: Column, tail: Column) -> Column:
        return values.let(until_break(tail), lambda n: F.concat(
            F.substring(marked, F.lit(1), marks + SNIPPET_TAIL + n),
            F.when(n < F.length(tail), F.lit(ELLIPSIS)).otherwise(F.lit("")),
        ))

    return values.let(F.instr(F.lower(text), F.lower(query)), around)
