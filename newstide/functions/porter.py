"""Porter stemming of columns.

Each step looks at the longest suffix of its list and rewrites the word when the part
before the suffix (the stem) is long enough. The measure ``m`` counts vowel-consonant
sequences; ``y`` is a vowel after a consonant and a consonant elsewhere, which the
patterns below spell out. Tasks stem each different word of a batch of documents once and
remember it, as texts repeat their words.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The word up to and including its first vowel.
_TO_VOWEL = "^(?:[^aeiou][^aeiouy]*[aeiouy]|[aeiou])"
HAS_VOWEL = _TO_VOWEL
M_OVER_0 = _TO_VOWEL + "[aeiou]*[^aeiou]"
M_OVER_1 = M_OVER_0 + "[^aeiouy]*[aeiouy][aeiou]*[^aeiou]"
# consonant, vowel, consonant other than w, x, y at the end; or a two-letter vowel-consonant
CVC = "(?:[^aeiouy]|(?:^|[aeiou]|[^aeiouy]y)y)[aeiouy][^aeiouwxy]$|^[aeiou][^aeiou]$"

# Words the rules would treat wrongly.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Suffix and replacement, for stems with m > 0.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "fulli": "ful",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
# Suffixes dropped from stems with m > 1; "ion" only after s or t.
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]

#: words whose stems a worker remembers
REMEMBERED = 250_000

_HAS_VOWEL, _M_OVER_0, _M_OVER_1, _CVC = map(re.compile, (HAS_VOWEL, M_OVER_0, M_OVER_1, CVC))
_DOUBLE = re.compile("[^aeiouy]$|[^aeiouy]yy$")
# only after a consonant that is not the first letter
_FINAL_Y = re.compile("(?:.[^aeiouy]|[aeiou]y|[^aeiouy]yy)y$")


def _longest(suffixes) -> Callable[[str], str | None]:
    """The longest of the suffixes that a word ends in."""
    by_length = sorted(suffixes, key=len, reverse=True)
    ends = tuple(by_length)
    return lambda w: next(s for s in by_length if w.endswith(s)) if w.endswith(ends) else None


_SUFFIX_2, _SUFFIX_3, _SUFFIX_4 = _longest(STEP_2), _longest(STEP_3), _longest(STEP_4)


def _plurals(w: str) -> str:
    if not w.endswith("s") or w.endswith("ss") and not w.endswith("sses"):
        return w
    return w[:-2] if w.endswith(("sses", "ies")) and not (w.endswith("ies") and len(w) == 4) else w[:-1]


def _past_and_gerund(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _M_OVER_0.search(w[:-3]) else w
    n = 2 if w.endswith("ed") else 3 if w.endswith("ing") else 0
    return _tidy(w[:-n]) if n and _HAS_VOWEL.search(w[:-n]) else w


def _tidy(w: str) -> str:
    """A word that lost its ``ed`` or ``ing``."""
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if w[-1:] == w[-2:-1] and _DOUBLE.search(w):
        return w if w[-1] in "lsz" else w[:-1]
    return w + "e" if _M_OVER_0.search(w) and not _M_OVER_1.search(w) and _CVC.search(w) else w


def _step_2(w: str) -> str:
    # what "alli" leaves may carry another suffix of this step
    if w.endswith("alli") and _M_OVER_0.search(w[:-4]):
        w = w[:-2]
    if w.endswith("logi"):
        return w[:-1] if _M_OVER_0.search(w[:-3]) else w
    return _replaced(w, _SUFFIX_2(w), STEP_2)


def _replaced(w: str, suffix: str | None, table: dict[str, str]) -> str:
    if suffix is None or not _M_OVER_0.search(w[: -len(suffix)]):
        return w
    return w[: -len(suffix)] + table[suffix]


def _step_4(w: str) -> str:
    suffix = _SUFFIX_4(w)
    if suffix is None or suffix == "ion" and w[-4:-3] not in ("s", "t"):
        return w
    return w[: -len(suffix)] if _M_OVER_1.search(w[: -len(suffix)]) else w


def _final_e(w: str) -> str:
    stem = w[:-1]
    drop = w.endswith("e") and (_M_OVER_1.search(stem) or _M_OVER_0.search(stem) and not _CVC.search(stem))
    return stem if drop else w


def stemmed(w: str) -> str:
    """The stem of a lower-case word."""
    if w in IRREGULAR:
        return IRREGULAR[w]
    if len(w) <= 2:
        return w
    w = _past_and_gerund(_plurals(w))
    if w.endswith("y") and _FINAL_Y.search(w):
        w = w[:-1] + "i"
    w = _step_2(w)
    w = _final_e(_step_4(_replaced(w, _SUFFIX_3(w), STEP_3)))
    return w[:-1] if w.endswith("ll") and _M_OVER_1.search(w[:-1]) else w


class _Stems(dict):
    """The stem of a word, remembered by the worker."""

    def __missing__(self, word: str | None) -> str | None:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = stem = None if word is None else stemmed(word)
        return stem


_STEMS = _Stems()


@F.arrow_udf(ArrayType(StringType()))
def stem_words(words: pa.Array) -> pa.Array:
    """Stem every lower-case word of an array; of a batch's words each is looked up once."""
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    found = words.flatten().dictionary_encode()
    stems = pa.array(map(_STEMS.__getitem__, found.dictionary.to_pylist()), pa.string()).take(found.indices)
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, stems, mask=words.is_null())


def stem(word: Column) -> Column:
    return F.get(stem_words(F.array(word)), F.lit(0))
