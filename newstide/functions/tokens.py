"""Word tokenization and cleaning, as column expressions over whole texts.

The rules are those of Treebank-style word tokenization, reduced to what can survive
the later alphanumeric filter: a mark that always becomes a token of its own is dropped
later anyway, so only words are looked for. A period followed by a space or a closing
mark ends a sentence, unless it belongs to one of the abbreviations given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from newstide.functions.binding import bound

# The English stop words, in their usual order.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours "
    "yourself yourselves he him his himself she she's her hers herself it it's its "
    "itself they them their theirs themselves what which who whom this that that'll "
    "these those am is are was were be been being have has had having do does did doing "
    "a an the and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in out on off "
    "over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can "
    "will just don don't should should've now d ll m o re ve y ain aren aren't couldn "
    "couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't "
    "ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn "
    "wasn't weren weren't won won't wouldn wouldn't"
).split()

# --- where a token may start and end --------------------------------------------------
#
# One pass over the text finds the runs of letters and digits that are tokens of their
# own, which is all the later filter lets through.

_RUN = r"[\p{L}\p{N}]"
_WORD = r"[\p{L}\p{N}_]"
_SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
# marks that are always tokens of their own
_MARK = r";@#$%&?!*\"«“‘„`»”’\[\](){}<>"
# a period ends a sentence before white space, a closing mark or the end
_FINAL_PERIOD = rf"\.(?=[{_SPACE})\";}}\]*:@'({{\[]|$)"
# a comma or colon parts words unless a digit follows
_PLAIN_END = rf"[{_SPACE}{_MARK}]|$|\.\.|[:,](?!\p{{Nd}})|{_FINAL_PERIOD}"
# clitics leave the word they lean on, also before a closing apostrophe
_CLOSED = rf"(?={_PLAIN_END}|'(?:{_PLAIN_END}))"
_END = rf"{_PLAIN_END}|'(?={_PLAIN_END})|'(?:[sSmMdD]|ll|LL|re|RE|ve|VE){_CLOSED}"

_AFTER_MARK = rf"(?<![^{_SPACE}{_MARK}])"
_START = rf"(?:{_AFTER_MARK}|(?<=\.\.)|(?<=[:,])(?!\p{{Nd}}))"

# a negation keeps its "n't" here, so that the rest of the word can be told
_NEGATION = rf"(?:(?<=n)'t|(?<=N)'T){_CLOSED}"
# the two cheap conditions come first: most positions of a text fail one of them
TOKEN = rf"(?={_RUN})(?<!{_RUN}){_START}({_RUN}++(?:{_NEGATION})?+)(?={_END})"

# A Unicode non-character: it cannot occur in interchanged text, parts no words and is no letter.
_ATTACHED = "\ufdd2"


def _paired(text: Column) -> Column:
    """Marks that pair up from the left, written as single ones that do the same.

    Two dashes and two apostrophes part words like other marks, the apostrophes also after
    a sentence's period. Of two commas or colons the first parts words and the second
    clings to what follows. What is left of an odd run is an ordinary mark again.
    """
    # an apostrophe opens a single character that is no clitic
    opened = F.regexp_replace(text, rf"'([^\P{{L}}mtsdnMTSDN]|[\p{{N}}_])([^\p{{L}}\p{{N}}_]|\z)", "' $1$2")
    dashes = F.replace(opened, F.lit("--"), F.lit("&"))
    quotes = F.replace(dashes, F.lit("''"), F.lit('"'))
    return F.regexp_replace(quotes, "([:,])[:,]", f"$1{_ATTACHED}")


# Words written as one that are two tokens.
FUSED_WORDS = {
    "cannot": ("can", "not"), "gimme": ("gim", "me"), "gonna": ("gon", "na"),
    "gotta": ("got", "ta"), "lemme": ("lem", "me"), "wanna": ("wan", "na"),
}


def abbreviated(text: Column, abbreviations: Sequence[str], mark: str = _ATTACHED) -> Column:
    """The text with the period of known abbreviations replaced by a mark that ends nothing.

    ``abbreviations`` are lower-case types, tried at the start of a word only; periods at the
    end of a text or before anything but white space are left.
    """
    if not abbreviations:
        return text
    types = "|".join(rf"\Q{t}\E" for t in sorted(abbreviations, key=lambda t: (-len(t), t)))
    return F.regexp_replace(text, rf"(?iu)(?<![\p{{L}}\p{{N}}.])({types})\.(?=[{_SPACE}])", f"$1{mark}")


def _split_fused(tokens: Column) -> Column:
    fused = F.array(*[F.lit(w) for w in FUSED_WORDS])
    parts = F.create_map(
        *[x for w, pair in FUSED_WORDS.items() for x in (F.lit(w), F.array(*[F.lit(p) for p in pair]))]
    )
    split = F.flatten(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(parts, t), F.array(t))))
    return F.when(F.arrays_overlap(tokens, fused), split).otherwise(tokens)


def words(text: Column, abbreviations: Sequence[str] = ()) -> Column:
    """Lower-case alphanumeric tokens in order; everything else is dropped.

    A token counts only as a whole: "5.3" and "well-known" hold other marks and go, and so
    does "Inc." where "inc" is one of ``abbreviations``.
    """
    found = F.transform(
        F.regexp_extract_all(_paired(abbreviated(text, abbreviations)), F.lit(TOKEN), F.lit(1)),
        lambda t: F.lower(F.when(t.endswith("'t") | t.endswith("'T"), F.substring(t, F.lit(1), F.length(t) - 3)).otherwise(t)),
    )
    return bound(found, _split_fused)


def content_words(
    text: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS, abbreviations: Sequence[str] = ()
) -> Column:
    """Tokens without stop words and without tokens that start an address."""
    # filtering keeps repeated tokens, which a set difference would lose
    return F.filter(
        words(text, abbreviations), lambda t: (t != "") & ~t.isin(list(stop_words)) & ~t.startswith("http")
    )


def token_counts(tokens: Column) -> Column:
    """Array of ``(token, n)`` of one document, without a shuffle.

    Sorting the document's own tokens puts equal ones side by side; a run's length is
    the distance to the next run.
    """
    sized = F.struct(F.sort_array(tokens).alias("t"), F.size(tokens).alias("n"))

    def runs(doc: Column) -> Column:
        indices = F.when(doc["n"] > 0, F.sequence(F.lit(1), doc["n"])).otherwise(
            F.array().cast("array<int>")
        )
        starts = F.filter(
            indices,
            lambda i: (i == 1) | (F.get(doc["t"], i - 1) != F.get(doc["t"], F.greatest(i - 2, F.lit(0)))),
        )
        return F.struct(doc["t"].alias("t"), doc["n"].alias("n"), starts.alias("at"))

    def counted(doc: Column) -> Column:
        return F.transform(
            doc["at"],
            lambda at, k: F.struct(
                F.get(doc["t"], at - 1).alias("token"),
                (F.coalesce(F.get(doc["at"], k + 1), doc["n"] + 1) - at).cast("bigint").alias("n"),
            ),
        )

    return bound(bound(sized, runs), counted)
