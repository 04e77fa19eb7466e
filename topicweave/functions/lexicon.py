"""Word lists, recodes, suffix rules and patterns."""

from __future__ import annotations

# Function words removed before counting, one string per language.
STOP_WORDS_BY_LANGUAGE = {
    "en": "a an and are as at be been but by can for from had has have he her his i if in is it its no not of on "
          "or our she so that the their they this to was we were what when which who will with you",
    "fr": "au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui ma mais mes mon ne nous on "
          "ou par pas pour que qui sa se ses son sur un une vous",
    "de": "aber als am auch auf aus bei das dem den der die ein eine er es für hat ich im ist mit nach nicht noch "
          "oder sich sie sind über um und von war wie wir zu zum zur",
    "es": "al como con del el ella ellos entre era esta este fue ha la las lo los más me mi muy no nos o para pero "
          "por que se sin sobre su sus también un una y ya yo",
}

# Category spellings that name the same section.
CATEGORY_RECODES = {
    "THE WORLDPOST": "WORLDPOST",
    "ARTS & CULTURE": "ARTS",
}

# 0-based positions of unusable rows in the public news file.
BAD_ARTICLE_POSITIONS = (
    102405, 77834, 105740, 93455, 90134, 97302, 88856, 95001, 118557,
    69179, 116796, 113471, 90950, 100426, 72277, 120153, 120410, 82270,
    120926, 101479, 118891, 56945, 50804, 118900, 102272, 87180, 110989,
    91299, 122807, 112572, 37830, 94408, 40910, 124879, 95445, 89050,
    92381, 92127, 96233, 119028, 123134,
)

# Plural forms and repairs that no suffix rule gets right.
WORD_OVERRIDES = {
    "children": "child",
    "feet": "foot",
    "geese": "goose",
    "knives": "knife",
    "leaves": "leaf",
    "lives": "life",
    "men": "man",
    "mice": "mouse",
    "news": "news",
    "polouse": "police",
    "religiou": "religious",
    "series": "series",
    "teeth": "tooth",
    "wives": "wife",
    "wolves": "wolf",
    "women": "woman",
}

# Fixed values: (pattern, replacement), tried in order; the first match decides and later rules are skipped.
PLURAL_RULES = (
    ("^.{1,3}$", None),
    ("(ss|us|is)$", None),
    ("ies$", "y"),
    ("(ch|sh|ss|x|z)es$", "$1"),
    ("s$", ""),
)

# Markup entities decoded in page text, the ampersand last.
HTML_ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&copy;", "\u00a9"),
    ("&reg;", "\u00ae"),
    ("&middot;", "\u00b7"),
    ("&laquo;", "\u00ab"),
    ("&raquo;", "\u00bb"),
    ("&ndash;", "\u2013"),
    ("&mdash;", "\u2014"),
    ("&lsquo;", "\u2018"),
    ("&rsquo;", "\u2019"),
    ("&ldquo;", "\u201c"),
    ("&rdquo;", "\u201d"),
    ("&hellip;", "\u2026"),
    ("&euro;", "\u20ac"),
    ("&amp;", "&"),
)

# What no page shows, in the order of removal: scripts, styles, comments, tags with quoted attributes, other tags.
HTML_HIDDEN = (
    r"(?is)<script[^>]*>.*?</script>",
    r"(?is)<style[^>]*>.*?</style>",
    r"(?s)<!--.*?-->",
    r"""<[A-Za-z/!?](?:[^<>"']|"[^"]*"|'[^']*')*>""",
    r"<[^>]+>",
)

# Token patterns, accepted by Java and RE2 alike.
WORD_PATTERN = r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)*"
WORD_CHAR_PATTERN = r"[\p{L}\p{N}_]+"
SENTENCE_BREAK = r"[.!?]+\s+"


def stop_word_list(languages=("en", "fr", "de", "es")) -> list[str]:
    return sorted({w for lang in languages for w in STOP_WORDS_BY_LANGUAGE[lang].split()})
