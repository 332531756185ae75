"""Column expressions for text: line splitting, tokenisers, bigram building, IP and key helpers.

Everything here returns a ``Column`` built from Spark SQL built-ins (regex, higher-order
array functions), so it runs inside whole-stage code generation on the JVM. No Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour (do not change).
# ---------------------------------------------------------------------------
# Line terminators of a text-file scan: CRLF, CR, LF.
LINE_BREAK = "\r\n|\r|\n"
# Java's \s (ASCII whitespace): space, tab, LF, vertical tab, form feed, CR.
JAVA_WHITESPACE = "[ \t\n\u000b\f\r]+"
# Delimiters of java.util.StringTokenizer's default constructor: space, tab, LF, CR, FF.
TOKENIZER_DELIMS = "[ \t\n\r\f]+"
# Java's \W (ASCII non-word characters).
NON_WORD = "\\W+"
# Characters that end a sentence when they close a token.
SENTENCE_END = (".", "?", "!")
# Characters that Java's '.' does not match (line terminators), used by String.matches.
_JAVA_DOT_EXCLUDED = "\n\r\u0085\u2028\u2029"
# A token is a word when the whole token matches ".*[a-zA-Z].*" (Java semantics), i.e. it holds
# an ASCII letter and no character that '.' refuses.
WORD_TOKEN = f"^[^{_JAVA_DOT_EXCLUDED}]*[a-zA-Z][^{_JAVA_DOT_EXCLUDED}]*\\z"
ASCII_LETTER = "[a-zA-Z]"
# Most word tokens are of lower-case letters and digits only: nothing to strip or to exclude.
PLAIN_WORD = "^[0-9]*[a-z][a-z0-9]*\\z"
DOT_EXCLUDED = f"[{_JAVA_DOT_EXCLUDED}]"
# Characters removed from a word token.
NON_ALNUM = "[^a-zA-Z0-9]+"
# Marker standing for a sentence end inside a token array (never survives stripping).
SENTENCE_MARK = "|"
# Number of first-character classes: 0-9, A-Z, a-z.
FIRST_CHAR_CLASSES = 62


_REGEX_META = set(".$|()[]{}^?*+\\")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_lines(text) -> Column:
    """Lines of a text the way a Hadoop/Spark text scan cuts a file.

    CRLF, CR and LF end a line; a final terminator does not start a new empty line;
    an empty text has no lines; blank lines in the middle are kept.
    """
    t = _col(text)
    body = F.regexp_replace(t, f"(?:{LINE_BREAK})\\z", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(body, LINE_BREAK, -1))


def java_split(value, pattern: str) -> Column:
    """``String.split(regex)`` of Java: trailing empty strings dropped, a leading one kept.

    ``""`` gives ``[""]``, a value made only of separators gives ``[]``. Spark's
    ``split`` keeps trailing empties, hence the trim first.
    """
    v = _col(value)
    if len(pattern) == 1 and pattern not in _REGEX_META:
        # A literal one-character separator: trailing separators go with rtrim, no regex pass.
        body = F.rtrim(v, F.lit(pattern))
    else:
        body = F.regexp_replace(v, f"(?:{pattern})+\\z", "")
    return (
        F.when(v == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, pattern, -1))
    )


def whitespace_words(line) -> Column:
    """``line.split("\\\\s+")``: the word-count tokeniser (keeps one leading empty word)."""
    return java_split(line, JAVA_WHITESPACE)


def space_tokens(line) -> Column:
    """``line.split(" ")``: the streaming-bigram tokeniser (double spaces give empty tokens)."""
    return java_split(line, " ")


def lower_word_tokens(text) -> Column:
    """``text.toLowerCase().split("\\\\W+")`` without empty strings: the word-window tokeniser."""
    return F.filter(F.split(F.lower(_col(text)), NON_WORD, -1), lambda x: x != "")


def lower_word_count(text) -> Column:
    """``size(lower_word_tokens(text))`` without building the array: maximal runs of \\w."""
    return F.regexp_count(F.lower(_col(text)), F.lit("\\w+"))


def space_token_count(line) -> Column:
    """``size(space_tokens(line))`` by counting blanks: no regex, no array."""
    v = _col(line)
    body = F.rtrim(v, F.lit(" "))
    blanks = F.length(body) - F.length(F.replace(body, F.lit(" "), F.lit("")))
    return F.when(v == "", F.lit(1)).when(body == "", F.lit(0)).otherwise(blanks + 1)


def tokenizer_tokens(line) -> Column:
    """``new StringTokenizer(line.toLowerCase())``: never yields empty tokens."""
    return F.filter(F.split(F.lower(_col(line)), TOKENIZER_DELIMS, -1), lambda x: x != "")


def is_word(token) -> Column:
    """Same as ``rlike(WORD_TOKEN)``, as two unanchored searches (no backtracking)."""
    t = _col(token)
    return t.rlike(ASCII_LETTER) & ~t.rlike(DOT_EXCLUDED)


def is_sentence_end(token) -> Column:
    return F.substring(_col(token), -1, 1).isin(*SENTENCE_END)


def strip_punctuation(token) -> Column:
    return F.regexp_replace(_col(token), NON_ALNUM, "")


def classify_token(token, lowercase: bool = True) -> Column:
    """Word -> stripped lower-case word; sentence end -> ``SENTENCE_MARK``; other -> NULL.

    NULL tokens are skipped without resetting the previous word (commas, numbers, empties).
    """
    t = F.lower(_col(token)) if lowercase else _col(token)
    return (
        F.when(t.rlike(PLAIN_WORD), t)
        .when(is_word(t), strip_punctuation(t))
        .when(is_sentence_end(t), F.lit(SENTENCE_MARK))
    )


def kept_tokens(tokens, lowercase: bool = True) -> Column:
    """Classified tokens without the skipped ones: stripped words and ``SENTENCE_MARK``."""
    return F.filter(F.transform(_col(tokens), lambda t: classify_token(t, lowercase)), lambda x: x.isNotNull())


def pairs_of_kept(kept) -> Column:
    """Array of ``struct(w1, w2)``: each word paired with the previous kept word (no mark between).

    ``kept`` should be a column reference (project ``kept_tokens`` first): it is used three times.
    """
    k = _col(kept)
    nxt = F.slice(k, 2, F.greatest(F.size(k), F.lit(1)))
    pairs = F.zip_with(k, nxt, lambda a, b: F.struct(a.alias("w1"), b.alias("w2")))
    return F.filter(
        pairs,
        lambda p: p["w2"].isNotNull() & (p["w1"] != SENTENCE_MARK) & (p["w2"] != SENTENCE_MARK),
    )


def bigram_pairs(tokens, lowercase: bool = True) -> Column:
    """Array of ``struct(w1, w2)`` for a token array, following the bigram rules.

    Each word pairs with the previous word; a sentence end resets; other tokens are skipped
    without reset. Works on one array, so it never crosses the array's boundary. Pass
    ``lowercase=False`` when the tokens are lower-case already. In a DataFrame prefer projecting
    :func:`kept_tokens` and then :func:`pairs_of_kept`, which classifies each token once.
    """
    return pairs_of_kept(kept_tokens(tokens, lowercase))


def drop_last_component(ip) -> Column:
    """``SUBSTRING(ip, 0, LAST_INDEX_OF(ip, '.'))``: drop the last dotted part; no dot -> NULL."""
    c = _col(ip)
    return F.when(F.instr(c, ".") > 0, F.regexp_replace(c, "\\.[^.]*\\z", ""))


def first_char_class(key) -> Column:
    """Monotone class of the first character: 0-9 -> 0-9, A-Z -> 10-35, a-z -> 36-61.

    Below '0' (and the empty key) -> 0, between '9' and 'A' -> 9, between 'Z' and 'a' -> 35,
    above 'z' -> 61, so class order agrees with byte order of the keys.
    """
    k = _col(key)
    cp = F.ascii(k)
    return (
        F.when((k == "") | (cp < 48), F.lit(0))
        .when(cp <= 57, cp - 48)
        .when(cp < 65, F.lit(9))
        .when(cp <= 90, cp - 65 + 10)
        .when(cp < 97, F.lit(35))
        .when(cp <= 122, cp - 97 + 36)
        .otherwise(F.lit(FIRST_CHAR_CLASSES - 1))
    )


def first_char_bucket(key, num_buckets: int) -> Column:
    """``(int)(class / 62.0 * n)``: the first-character partition of a key (0..n-1)."""
    return F.floor(first_char_class(key).cast("double") / float(FIRST_CHAR_CLASSES) * num_buckets).cast("int")


def strict_long(s) -> Column:
    """``Long.parseLong``: optional sign and digits only (no blanks), else NULL."""
    c = _col(s)
    return F.when(c.rlike("^[+-]?[0-9]+\\z"), c.try_cast("long"))


def strict_int(s) -> Column:
    """``Integer.parseInt`` with NULL on failure (Pig's cast)."""
    c = _col(s)
    return F.when(c.rlike("^[+-]?[0-9]+\\z"), c.try_cast("int"))
