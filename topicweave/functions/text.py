"""Column expressions for text: tokenizers, markup removal, spelling clean-up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicweave.functions import lexicon


def matches(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def words(text: Column) -> Column:
    """Lower-case words; punctuation dropped, inner apostrophes kept."""
    return matches(F.lower(text), lexicon.WORD_PATTERN)


def word_char_runs(text: Column) -> Column:
    """Lower-case runs of word characters (letters, digits, underscore)."""
    return matches(F.lower(text), lexicon.WORD_CHAR_PATTERN)


def sentences(text: Column) -> Column:
    return _drop_blank(F.split(F.lower(text), lexicon.SENTENCE_BREAK))


def split_on(pattern: str) -> Callable[[Column], Column]:
    """Tokenizer that cuts at every match of ``pattern``."""
    return lambda text: _drop_blank(F.split(F.lower(text), pattern))


def ngrams(size: int) -> Callable[[Column], Column]:
    """Tokenizer for runs of ``size`` neighbouring words, built inside the row."""
    return lambda text: _runs(words(text), size, " ")


def char_shingles(size: int) -> Callable[[Column], Column]:
    """Tokenizer for overlapping character runs over letters and digits only."""
    return lambda text: _runs(matches(F.lower(text), r"[\p{L}\p{N}]"), size, "")


def _runs(parts: Column, size: int, sep: str) -> Column:
    """Neighbours joined by zipping shifted copies; the lambda sees only its arguments, so ``parts`` is built once."""
    length = F.greatest(F.size(parts) - F.lit(size - 1), F.lit(0))
    out = F.slice(parts, F.lit(1), length)
    for shift in range(1, size):
        out = F.zip_with(out, F.slice(parts, F.lit(shift + 1), length), lambda a, b: F.concat_ws(sep, a, b))
    return out


def html_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles, comments and tags removed, common named and all numeric entities decoded once."""
    out = html
    for pattern in lexicon.HTML_HIDDEN:
        # possessive, so that long tags need no deep stack
        out = F.regexp_replace(out, pattern.replace("]|\"[", "]++|\"[").replace("')*>", "')*+>"), " ")
    out = numeric_entities(out)
    for entity, char in lexicon.HTML_ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def numeric_entities(text: Column) -> Column:
    """``&#8217;`` and ``&#x2019;`` as characters; numbers that name none stay as they are. One pass over the parts behind each ``&#``."""
    def decoded(part: Column) -> Column:
        number = F.regexp_extract(part, r"^([xX][0-9A-Fa-f]{1,6}|[0-9]{1,7});", 1)
        whole = F.when(F.lower(number).startswith("x"), F.conv(F.substring(number, 2, 6), 16, 10)).otherwise(number)
        code = whole.try_cast("int")
        named = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(named, F.concat(char, F.substr(part, F.length(number) + 2))).otherwise(F.concat(F.lit("&#"), part))

    parts = F.split(text, "&#")
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), decoded)
    return F.when(F.contains(text, F.lit("&#")), F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))).otherwise(text)


def strip_possessives(text: Column) -> Column:
    """``'s`` before a blank becomes a blank, then every other ``'s`` goes."""
    return F.regexp_replace(F.regexp_replace(text, "'s ", " "), "'s", "")


def recode(value: Column, mapping: dict[str, str]) -> Column:
    out = value
    for old, new in mapping.items():
        out = F.when(value == old, F.lit(new)).otherwise(out)
    return out


def unquote(line: Column) -> Column:
    """Drop double quotes and the line end."""
    return F.rtrim(F.regexp_replace(line, '["\r\n]', ""))


def singular(word: Column) -> Column:
    """Ordered suffix rules; the first rule that matches decides."""
    out = word
    for pattern, replacement in reversed(lexicon.PLURAL_RULES):
        fixed = word if replacement is None else F.regexp_replace(word, pattern, replacement)
        out = F.when(word.rlike(pattern), fixed).otherwise(out)
    return out


def normalize_word(word: Column, overrides: dict[str, str] | None = None) -> Column:
    """Override if there is one, suffix rules otherwise."""
    table = lexicon.WORD_OVERRIDES if overrides is None else overrides
    return recode_or(word, table, singular(word))


def recode_or(value: Column, mapping: dict[str, str], default: Column) -> Column:
    if not mapping:
        return default
    branches = None
    for old, new in mapping.items():
        branches = F.when(value == old, F.lit(new)) if branches is None else branches.when(value == old, F.lit(new))
    return branches.otherwise(default)


def is_integer(word: Column) -> Column:
    """True when the word reads back unchanged after a cast to a whole number."""
    return F.coalesce(word.try_cast("bigint").cast("string") == word, F.lit(False))


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def after_first_line(text: Column) -> Column:
    at = F.locate("\n", text)
    return F.when(at == 0, F.lit("")).otherwise(F.substring(text, at + F.lit(1), F.length(text)))


def _drop_blank(parts: Column) -> Column:
    return F.filter(parts, lambda p: p != "")
