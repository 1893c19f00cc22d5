"""Text functions, Column in, Column out; all run inside code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space as Python's str.split() and str.strip() know it, and line ends as str.splitlines() does.
SPACE = r"\t-\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The same characters for Spark's regular expressions: one look at a character's type, where the list is tried entry by entry.
GAP = r"\x{1c}-\x{1f}\p{IsWhite_Space}"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]"
# Captions. Lines that begin so, hold an arrow, or are digits alone carry no speech.
CAPTION_HEADERS = r"^(WEBVTT|Kind:|Language:|NOTE|STYLE)"
DIGITS_ONLY = r"^[\p{Nd}²³¹⁰-⁹₀-₉]+$"
INLINE_TAG = r"<[^>]+>"
SPEAKER_LABEL = r"^[A-Za-z][A-Za-z .'\-]{0,40}:[" + SPACE + r"]+"
PARENTHESIS = r"\([^)]*\)"
# Topics.
SENTENCE_END = rf"(?<=[.!?])[{GAP}]+"
NO_SPEECH = "(no speech isolated)"
TOPIC_WORDS = 15
NGRAM = 4
RATE_UNITS = {"K": 1024, "M": 1024**2, "G": 1024**3}
#: Seconds before the second try, and what each further wait is multiplied by. Fixed values.
BACKOFF_BASE, BACKOFF_FACTOR = 5.0, 2.0


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once; inside a lambda a plain expression would be computed for every element."""
    return F.transform(F.array(value), use)[0]


def once(rows: DataFrame, keep: Sequence[str], value: Column) -> DataFrame:
    """The columns `keep` and the fields of `value`, an array of one struct, computed once a row.

    An optimizer that merges projections would compute an expression again wherever its result is used, in filters and sort
    keys too; it doesn't merge across a generator.
    """
    return rows.select(*keep, F.inline(value))


def words(text: Column) -> Column:
    """The words of a text as an array, split at Unicode white space; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{GAP}]+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def strip(text: Column) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(text, f"^[{GAP}]+|[{GAP}]+$", "")


def repetition_of(tokens: Column, n: int = NGRAM) -> Column:
    """1 - distinct n-grams / n-grams of an array of words; 0.0 if it has fewer than n.

    N-grams are compared as joined strings: words hold no space, so that is the same, and distinct arrays are slow. The
    array is bound, so that neither a lambda nor a filter that Catalyst moves below computes it once an n-gram.
    """

    def of(w: Column) -> Column:
        count = F.size(w) - (n - 1)
        grams = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(count > 0, F.lit(1.0) - F.size(F.array_distinct(grams)) / count).otherwise(F.lit(0.0))

    return bound(tokens, of)


def repetition_score(text: Column, n: int = NGRAM) -> Column:
    return repetition_of(words(text), n)


def first_sentence(text: Column) -> Column:
    return F.split(text, SENTENCE_END, 2)[0]


def topic(text: Column, max_words: int = TOPIC_WORDS) -> Column:
    """The first sentence, its first words and three dots if it is longer, a fixed phrase if there is no text."""
    clean = strip(F.coalesce(text, F.lit("")))

    def of(sentence: Column) -> Column:
        return bound(words(sentence), lambda parts: F.when(sentence == "", F.lit(NO_SPEECH)).when(F.size(parts) > max_words, F.concat(F.array_join(F.slice(parts, 1, max_words), " "), F.lit("..."))).otherwise(sentence))

    return bound(first_sentence(clean), of)


def titled(title: Column, text: Column) -> Column:
    """A title that isn't empty, else the topic of the text."""
    return F.coalesce(F.nullif(title, F.lit("")), topic(text))


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), LINE_END)


def caption_text(text: Column) -> Column:
    """The speech in a caption file: cue lines without tags and speaker labels, joined, without parentheses, spaced once."""
    stripped = F.transform(lines(text), strip)
    spoken = F.filter(stripped, lambda line: (line != "") & ~line.rlike(CAPTION_HEADERS) & ~line.contains("-->") & ~line.rlike(DIGITS_ONLY))
    plain = F.transform(spoken, lambda line: F.regexp_replace(F.regexp_replace(line, INLINE_TAG, ""), SPEAKER_LABEL, ""))
    joined = F.regexp_replace(F.array_join(plain, " "), PARENTHESIS, "")
    return strip(F.regexp_replace(joined, f"[{GAP}]+", " "))


def normalised(text: Column) -> Column:
    """Lower case, no punctuation (category P), runs of white space as one space, stripped: what error rates compare."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\p{P}", "")
    return strip(F.regexp_replace(bare, f"[{GAP}][{GAP}]+", " "))


def last_line(text: Column) -> Column:
    """The last line that isn't blank, stripped; null if there is none."""
    return F.try_element_at(F.filter(F.transform(lines(text), strip), lambda x: x != ""), F.lit(-1))


def tail(text: Column, n: int = 500) -> Column:
    """The last n characters of a stripped text."""
    return F.right(strip(text), F.lit(n))


def preview(text: Column, n: int = 300) -> Column:
    return F.substring(text, 1, n)


def stem(name: Column) -> Column:
    """A file name without its last extension; names that begin with their only dot are whole."""
    return F.regexp_extract(name, r"^(.+?)(\.[^.]+)?$", 1)


def parent(path: Column) -> Column:
    """A path without its last part; a single part stands in the folder `.`."""
    return F.when(path.contains("/"), F.regexp_extract(path, "^(.*)/[^/]*$", 1)).otherwise(F.lit("."))


def relative_to(path: Column, root: Column) -> Column:
    """The rest of a path below a root; null if it isn't below."""
    base = F.concat(F.regexp_replace(root, "/+$", ""), F.lit("/"))
    return F.when(F.startswith(path, base), F.substr(path, F.length(base) + 1))


def rate_limit(value: Column) -> Column:
    """Bytes a second of values such as 5M, 800K or 2048, truncated."""
    clean = F.upper(strip(value))
    unit = F.regexp_extract(clean, "([KMG])$", 1)
    factor = F.lit(1)
    for name, times in RATE_UNITS.items():
        factor = F.when(unit == name, F.lit(times)).otherwise(factor)
    return (F.regexp_replace(clean, "[KMG]$", "").cast("double") * factor).cast("long")


def first_truthy(*columns: Column) -> Column:
    """The first that is neither null nor empty; the last as it is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns[:-1]], columns[-1])


def language(value: Column) -> Column:
    """Null for null, blank or `auto` in any case, else stripped."""
    clean = strip(value)
    return F.when((clean == "") | (F.lower(clean) == "auto"), F.lit(None)).otherwise(clean)


def backoff(base: Column, factor: Column, attempts: Column) -> Column:
    """Waits between attempts: base * factor^(i-1), one less than the attempts; none for a single one."""
    steps = F.when(attempts > 1, F.sequence(F.lit(1), F.greatest(attempts - 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda i: base * F.pow(factor, i - 1))


def utc_now() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
