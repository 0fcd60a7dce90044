"""Column expressions for the title → lemma-bag path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's morphological tag filter), in the
# reference's order; each entry is one dropped tag id or an inclusive id range:
# qub 592, dig 151, ign 0, interp 235, ppron12 429-461 and 800, ppron3 462-508,
# winien 705-723, siebie 594-598, pred 573, prep 578-591, conj 148, comp 99,
# brev 97 and 801.
DROPPED_TAGS = (592, 151, 0, 235, (429, 461), 800, (462, 508), (705, 723), (594, 598), 573,
                (578, 591), 148, 99, 97, 801)

WORD_PATTERN = r"(\p{L}+)"


def tokenize(text: Column | str, lower: bool = False) -> Column:
    """Letter runs of the whole text as written, in order (array<string>).

    The analyser and the stop list see the surface form; ``lower=True`` folds case first
    (for lexicons that hold lower-cased words only)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text) if lower else text, F.lit(WORD_PATTERN), 1)


def tag_is_dropped(tag: Column | str) -> Column:
    tag = F.col(tag) if isinstance(tag, str) else tag
    single = [t for t in DROPPED_TAGS if isinstance(t, int)]
    cond = tag.isin(*single)
    for entry in DROPPED_TAGS:
        if isinstance(entry, tuple):
            cond = cond | tag.between(*entry)
    return cond


def lemma_base(lemma: Column | str) -> Column:
    """Text before the first ':' of a lemma (whole lemma when there is none)."""
    lemma = F.col(lemma) if isinstance(lemma, str) else lemma
    return F.split_part(lemma, F.lit(":"), F.lit(1))
