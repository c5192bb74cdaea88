"""Text columns: cleaning, source normalisation, sentences, tokens and terms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv

# A terminator ends a sentence only before white space, so "99.9%" and addresses stay whole.  The possessive
# quantifiers keep the matcher iterative: text with very many inner dots must not deepen its stack.
SENTENCE = r"[^.!?\n]+(?:[.!?]+[^.!?\s][^.!?\n]*+)*+[.!?]*"
TOKEN_AND_GAP = r"[^ \n]+[ \n]*"
TERM = r"[a-z0-9]+"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``; plain nesting would evaluate it at every mention."""
    return F.transform(F.array(value), body)[0]


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that each is evaluated once per row.

    Filters on an ordinary column are pushed below it together with a copy of its expression.  A
    one-element explode stops that, and costs no shuffle and no extra rows.
    """
    values = F.struct(*[c.alias(n) for n, c in columns.items()])
    spread = df.select("*", F.explode(F.array(values)).alias("_once"))
    return spread.select(*df.columns, *[F.col(f"_once.{n}").alias(n) for n in columns])


def exploded(df: DataFrame, keep: list, array: str, position: str, item: str) -> DataFrame:
    """One row per element of ``array``, rows with an empty array dropped.

    An inner explode would let the optimizer infer a filter on the array and evaluate the whole
    expression behind it a second time below; the outer one with a filter on the element does not.
    """
    return df.select(*keep, F.posexplode_outer(array).alias(position, item)).where(F.col(position).isNotNull())


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def clean_text(text: Column) -> Column:
    """Unify line ends, limit blank lines, squeeze blanks, blank out all but printable ASCII, strip.

    The order is part of the definition: characters blanked out at the end may leave double spaces.
    A plain search tells first whether a step has anything to do; most texts skip most patterns.
    """
    def step(value: Column, marks: list[str], change) -> Column:
        return let(value, lambda v: F.when(any_of([F.contains(v, F.lit(m)) for m in marks]), change(v)).otherwise(v))

    unified = step(text, ["\r"], lambda v: F.replace(F.replace(v, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")))
    limited = step(unified, ["\n\n\n"], lambda v: F.regexp_replace(v, r"\n{3,}", "\n\n"))
    squeezed = step(limited, ["  ", "\t"], lambda v: F.regexp_replace(v, r"[ \t]{2,}", " "))
    printable = F.regexp_replace(squeezed, r"[^\x20-\x7E\n]", " ")
    return F.btrim(printable, F.lit(" \n"))


def strip(text: Column) -> Column:
    """Strip all Unicode white space on both sides."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse_spaces(text: Column) -> Column:
    """Every run of white space becomes one space."""
    return F.regexp_replace(text, r"(?U)\s+", " ")


def strip_page_marks(text: Column) -> Column:
    """Remove ``Page N of M`` marks."""
    return F.regexp_replace(text, r"Page \d+ of \d+", "")


def starts_with_marker(text: Column, markers: tuple[str, ...], window: int) -> Column:
    """Whether any marker occurs in the first ``window`` characters."""
    head = F.substring(text, 1, window)
    return any_of([F.contains(head, F.lit(m)) for m in markers])


def is_non_contract(clean_lower: Column) -> Column:
    return starts_with_marker(clean_lower, fv.NON_CONTRACT_MARKERS, fv.MARKER_WINDOW)


def is_long_enough(clean: Column, minimum: int = fv.MIN_CLEAN_CHARS) -> Column:
    return F.length(clean) >= minimum


def sentences(clean: Column) -> Column:
    """Sentences of a cleaned text, trimmed, without empty ones."""
    found = F.regexp_extract_all(clean, F.lit(SENTENCE), F.lit(0))
    return F.filter(F.transform(found, lambda s: F.trim(s)), lambda s: s != "")


def token_count(text: Column) -> Column:
    """Number of runs of non-white-space in a cleaned, trimmed text."""
    return F.when(text == "", 0).otherwise(F.size(F.split(text, r"[ \n]+")))


def sentence_tokens(sentence: Column) -> Column:
    """The same for one trimmed sentence; where blanks are single, they only need counting."""
    single = F.length(sentence) - F.length(F.replace(sentence, F.lit(" "), F.lit(""))) + 1
    return F.when(F.contains(sentence, F.lit("  ")), F.size(F.split(sentence, " +"))).otherwise(single)


def terms(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def file_stem(path: Column) -> Column:
    """Last path step without its suffix."""
    name = F.regexp_extract(path, r"([^/]+)/*$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def preview(text: Column, size: int, mark: str = "...") -> Column:
    """First ``size`` characters, with a mark when something was cut off."""
    return F.concat(F.substring(text, 1, size), F.when(F.length(text) > size, F.lit(mark)).otherwise(F.lit("")))
