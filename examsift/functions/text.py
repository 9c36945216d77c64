"""Text functions as Column expressions; all run inside the JVM.

Null text counts as empty. White space, digits and word borders are Unicode's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from examsift.functions.constants import NAME_JOINERS, NO_NAMES, STOPWORDS

#: Joins the words of an n-gram; no token contains it.
GRAM = "\u0001"
_NUMBER = r"\d+(?:[.,:/-]\d+)*(?:%| percent)?"
_BLANK = r"\[[^\]]*blank[^\]]*\]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body (or a lambda in it) uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def squeeze(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "), "^ | $", "")


def match_form(text: Column) -> Column:
    """Lower case, bracketed blanks as the word ``blank``, everything but a-z, 0-9 and % as a space."""
    lower = F.regexp_replace(F.lower(squeeze(text)), _BLANK, "blank")
    return squeeze(F.regexp_replace(lower, "[^a-z0-9%]+", " "))


def tokens(text: Column) -> Column:
    """Words of ASCII letters (with inner ' and -) and numbers (with a per cent sign or word), in lower case and order."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(?U)[A-Za-z][A-Za-z'-]*|{_NUMBER}"), 0)
    return F.transform(found, F.lower)


def content_tokens(text: Column) -> Column:
    """Tokens of three letters or more that are no stopwords; duplicates and order kept."""
    bare = F.transform(tokens(text), lambda t: F.regexp_replace(t, "^'+|'+$", ""))
    return F.filter(bare, lambda t: (F.length(t) > 2) & ~t.isin(STOPWORDS))


def ngrams(words: Column, n: int) -> Column:
    """Distinct runs of ``n`` words as strings joined by GRAM; empty for fewer words."""
    none = F.array().cast("array<string>")

    def runs(w: Column) -> Column:
        last = F.size(w) - (n - 1)
        return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), GRAM)))).otherwise(none)

    return F.coalesce(let(words, runs), none)


def labeled_choices(text: Column) -> Column:
    """Texts behind the labels ``A.`` to ``F.``, each up to the next label; trimmed of blanks, ; and , and not empty."""
    # a label needs white space (or the start) before and white space behind it
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)(^|\s)[A-F]\.\s+", "\u0002")
    bodies = F.transform(F.split(marked, "\u0002"), lambda p, i: F.when(i > 0, F.regexp_replace(squeeze(p), "^[ ;,]+|[ ;,]+$", "")))
    return F.filter(bodies, lambda b: F.coalesce(b != "", F.lit(False)))


def structure_text(text: Column) -> Column:
    """The text before its list of choices."""
    return squeeze(F.split(F.coalesce(text, F.lit("")), r"(?i)\bChoices\s*:", 2)[0])


def abstract_structure(text: Column) -> Column:
    """The text with each run of words, numbers and blanks as one W; punctuation stays."""
    words = F.regexp_replace(F.coalesce(text, F.lit("")), f"(?i){_BLANK}", " BLANK ")
    words = F.regexp_replace(words, rf"(?U)\b{_NUMBER}", " NUM ")
    words = F.regexp_replace(words, "[A-Za-z]+", " W ")
    return squeeze(F.regexp_replace(words, r"(?U)(?:\s*W\s*)+", " W "))


def match_choices(choices: Column) -> Column:
    """Choices in match form, empty ones dropped, duplicates kept."""
    return F.filter(F.transform(choices, match_form), lambda c: c != "")


def distinctive_terms(text: Column) -> Column:
    """Numbers and capitalised names of a text in match form, distinct and sorted.

    A name of a single word must have four letters or more and be none of NO_NAMES; words such as "of"
    may stand in a name, also at its end.
    """
    text = F.coalesce(text, F.lit(""))
    numbers = F.regexp_extract_all(text, F.lit(rf"(?U)\b{_NUMBER}\b"), 0)
    unlabelled = F.regexp_replace(text, r"(?U)\b[A-F]\.", " ")
    joiners = "|".join(NAME_JOINERS)
    names = F.transform(F.regexp_extract_all(unlabelled, F.lit(rf"(?U)\b[A-Z][a-z]+(?:\s+(?:{joiners}|[A-Z][a-z]+))*"), 0), squeeze)

    def is_name(name: Column) -> Column:
        own = F.filter(F.split(name, " "), lambda w: ~F.lower(w).isin(NAME_JOINERS))
        alone = F.element_at(own, 1)
        return F.when(F.size(own) == 0, False).when(F.size(own) == 1, ~alone.isin(NO_NAMES) & (F.length(alone) > 3)).otherwise(True)

    terms = F.transform(F.concat(numbers, F.filter(names, is_name)), match_form)
    return F.array_sort(F.array_distinct(F.filter(terms, lambda t: t != "")))


# --- parts of a record: each takes the columns of a typed item or source, any of which may be a null literal


def passage_texts(passage: Column, passages: Column) -> Column:
    """Texts of the single passage and of the list of passages that are not blank, in order."""
    several = F.coalesce(F.transform(passages, lambda p: p["text"]), F.array().cast("array<string>"))
    return F.filter(F.concat(F.array(passage), several), lambda p: F.coalesce(squeeze(p) != "", F.lit(False)))


def choice_texts(answer_groups: Column, *fallbacks: Column) -> Column:
    """Texts of all choices of all groups; without any, the labelled choices of the first fallback text that has some."""
    none = F.array().cast("array<string>")
    inner = F.flatten(F.transform(answer_groups, lambda g: F.coalesce(F.transform(g["choices"], lambda c: c["text"]), none)))
    ways = F.array(F.filter(F.coalesce(inner, none), lambda t: t.isNotNull()), *map(labeled_choices, fallbacks))
    return F.coalesce(F.get(F.filter(ways, lambda w: F.size(w) > 0), F.lit(0)), none)


def kept(*texts: Column) -> list[Column]:
    """The texts that are not blank, the others null."""
    return [F.when(squeeze(t) != "", t) for t in texts]


def item_text(stimulus: Column, passages: Column, stem: Column, choices: Column) -> Column:
    """Main text of an item: what is not blank of stimulus, passages, stem and choices."""
    (stimulus, stem) = kept(stimulus, stem)
    return squeeze(F.concat_ws(" ", stimulus, passages, stem, choices))


def item_structure_text(stimulus: Column, passages: Column, stem: Column) -> Column:
    (stimulus, stem) = kept(stimulus, stem)
    return squeeze(F.concat_ws(" ", stimulus, passages, stem))
