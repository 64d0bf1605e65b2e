"""Text cleaning and readability scores as native column expressions.

Character classes are written out explicitly so that Spark (Java regex)
and other engines (RE2) agree with Python's Unicode ``\\s`` and ``\\w``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: code points Python's str.isspace() treats as whitespace
WS = (r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# the same set as characters, for trimming
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")
# word characters: letters, numbers and underscore
WORD = r"[\p{L}\p{N}_]"

# fixed values: regular expressions of the cleaning chain and the counters
TAG_RE = r"<[^>]+>"
_TAG = r"<[^>]++>"        # the same matches; an unclosed bracket gives nothing back
URL_RE = "http" + WORD + "+"
HANDLE_RE = "@" + WORD + "+"
ISOLATED_LETTER_RE = WS + "[a-z]" + WS
MULTI_SPACE_RE = WS + WS + "+"
WORD_SPLIT_RE = r"[ \n.?!,]"
SENTENCE_SPLIT_RE = r"[.?!]"

# fixed values: English stopwords (the common 179-word NLTK list)
ENGLISH_STOPWORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be been "
    "being have has had having do does did doing a an the and but if or because as until while of at "
    "by for with about against between into through during before after above below to from up down "
    "in out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will just don "
    "don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn "
    "doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn "
    "needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_tags(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), _TAG, "")


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: all leading/trailing Unicode whitespace (one linear ``btrim``)."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def normalise(c: Column | str) -> Column:
    """Cleaning stages before stopword removal, in order:
    lower -> tags -> ``http\\w+`` -> ``@\\w+`` -> isolated letters -> runs of 2+ spaces."""
    t = F.lower(_c(c))
    t = F.regexp_replace(t, _TAG, "")
    t = F.regexp_replace(t, URL_RE, "")
    t = F.regexp_replace(t, HANDLE_RE, "")
    t = F.regexp_replace(t, ISOLATED_LETTER_RE, " ")
    return F.regexp_replace(t, MULTI_SPACE_RE, " ")


def drop_words(c: Column | str, stopwords: Sequence[str]) -> Column:
    """Split on single spaces, drop listed words, re-join (column-expression form)."""
    stop = F.array(*[F.lit(w) for w in stopwords])
    return F.array_join(F.filter(F.split(_c(c), " ", -1), lambda w: ~F.array_contains(stop, w)), " ")


def clean_text(df: DataFrame, col: str, out: str = "clean",
               stopwords: Sequence[str] = ENGLISH_STOPWORDS) -> DataFrame:
    """Full cleaning chain; stopwords go through Spark's hash-set StopWordsRemover."""
    tmp_in, tmp_out = f"__{out}_tok", f"__{out}_kept"
    d = df.withColumn(tmp_in, F.split(normalise(col), " ", -1))
    d = StopWordsRemover(inputCol=tmp_in, outputCol=tmp_out, stopWords=list(stopwords),
                         caseSensitive=True).transform(d)
    return d.withColumn(out, strip_ws(F.array_join(F.col(tmp_out), " "))).drop(tmp_in, tmp_out)


def clean_text_expr(c: Column | str, stopwords: Sequence[str] = ENGLISH_STOPWORDS) -> Column:
    """Same chain as :func:`clean_text` as one column expression."""
    return strip_ws(drop_words(normalise(c), stopwords))


def n_words(c: Column | str) -> Column:
    """Pieces of a split on ``[ \\n.?!,]`` (empty pieces count; empty text -> 1)."""
    return F.size(F.split(_c(c), WORD_SPLIT_RE, -1))


def n_sentences(c: Column | str) -> Column:
    return F.size(F.split(_c(c), SENTENCE_SPLIT_RE, -1))


def ari(cleaned: Column | str) -> Column:
    """Automated readability index on *cleaned* text."""
    ch, w, s = F.length(_c(cleaned)).cast("double"), n_words(cleaned).cast("double"), n_sentences(cleaned)
    return F.lit(4.71) * (ch / w) + F.lit(0.5) * (w / s) - F.lit(21.43)


def eflaw(raw: Column | str) -> Column:
    """McAlpine EFLAW on raw text: (W + S*W) / S."""
    w, s = n_words(raw).cast("double"), n_sentences(raw).cast("double")
    return (w + s * w) / s


def clri(raw: Column | str) -> Column:
    """Coleman-Liau index on raw text."""
    ch, w, s = F.length(_c(raw)).cast("double"), n_words(raw).cast("double"), n_sentences(raw).cast("double")
    return F.lit(0.0588) * (F.lit(100.0) * ch / w) - F.lit(0.296) * (F.lit(100.0) * s / w) - F.lit(15.8)


def readability(df: DataFrame, col: str) -> DataFrame:
    """ARI (cleaned), EFLAW and CLRI (raw) in one projection."""
    d = clean_text(df, col, "__clean")
    return d.withColumns({"ari": ari("__clean"), "eflaw": eflaw(col), "clri": clri(col)}).drop("__clean")
