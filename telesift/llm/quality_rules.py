"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too much of its text goes too.

Everything is built-in column expressions over one row, so there is no shuffle, no Python and no state to lose.

Defined results
    A null text counts as no text: all counts 0, `base_failed` true, `kept` false, `cleaned_text` null. Blank lines
    are neither judged nor counted as lost and stay in the cleaned text. A text without a word has `lost_share` 0.
    Repeated rows are judged one by one and all come back. An empty table gives an empty table with all columns.
    Input columns come back unchanged, but for those whose name (in any case) is one of RESULT_COLUMNS: the result wins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: Signs that prose does not hang on every few words: symbols, and runs of closing marks.
NOISE = r"[#*$%&|<>{}\[\]^~=_\\]|!!+|\?\?+|\.{4,}"
#: What ends a sentence, a clause or a quotation.
LINE_END = r"[.!?:;,…\"'”’»)\]]" + SPACE + "*$"
#: Separators of menus and table rows.
SEPARATORS = r"[|•»›·]| [>/-] "
#: Standing phrases of sites rather than of texts, as whole words. What also says something else in prose (a cookie, a sign in
#: the window) only counts with the words it has on sites.
BOILERPLATE = (
    "(^|[^a-z])((all rights reserved|(use|uses|using|accept|our) cookies|cookie (policy|settings|notice)|privacy policy|terms of (use|service)"
    "|(enable|require|requires) javascript|javascript is|lorem ipsum|click here|subscribe (to|now|here)|newsletters?|read more|share this"
    "|skip to (main )?content)([^a-z]|$)|(sign (in|up)|log ?in)( (to|with|now|here|or)([^a-z]|$)|[^a-z ]|$))"
)

RESULT_COLUMNS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines",
    "n_punctuation_lines", "n_navigation_lines", "n_boilerplate_lines", "lost_share", "cleaned_text", "kept",
)


@dataclass(frozen=True)
class LineRules:
    """Bounds of the rules. A share is of the line's words, but `max_lost` of the text's word characters.

    Separators and noise fail a line by their share, standing phrases only one of at most `phrase_line_words`, so that a whole
    text written as one line doesn't go for a few words of it.
    """

    min_words: int = 20
    max_repeat_percent: int = 30
    max_noise_share: float = 0.25
    short_line_words: int = 4
    min_separators: int = 3
    min_separator_share: float = 0.2
    phrase_line_words: int = 30
    max_lost: float = 0.3


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda word: word != "")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _with(value: Column, use) -> Column:
    """use(value), with the value worked out once: an array of one element carries it into a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column) -> Column:
    """How many words lie in eight-word windows that the text has twice or more.

    Windows are compared by 64-bit hashes, built up from one word over four to eight. Where all four-word hashes differ,
    as in most texts, that ends it. Else equal eight-word hashes are brought together by sorting, and the lengths of the
    stretches they cover are added up.
    """
    step = lambda keys, by, n: F.slice(F.transform(keys, by), 1, F.greatest(n, F.lit(0)))

    def of_fours(fours: Column) -> Column:
        eights = step(fours, lambda key, i: F.xxhash64(key, F.get(fours, i + 4)), F.size(fours) - 4)
        pairs = F.transform(eights, lambda key, i: F.struct(key.alias("key"), i.alias("at")))
        return F.when(F.size(F.array_distinct(fours)) == F.size(fours), 0).otherwise(_with(F.sort_array(pairs), of_sorted))

    def of_sorted(pairs: Column) -> Column:
        same = lambda pair, i: F.coalesce(pair["key"] == F.get(pairs, i)["key"], F.lit(False))
        found = F.filter(pairs, lambda pair, i: same(pair, i - 1) | same(pair, i + 1))
        return _with(F.sort_array(F.transform(found, lambda pair: pair["at"])), covered)

    def covered(at: Column) -> Column:
        reach = F.transform(at, lambda p, i: F.least(F.coalesce(F.get(at, i + 1) - p, F.lit(8)), F.lit(8)))
        return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

    def of_ones(ones: Column) -> Column:
        four = lambda key, i: F.xxhash64(key, F.get(ones, i + 1), F.get(ones, i + 2), F.get(ones, i + 3))
        return _with(step(ones, four, F.size(ones) - 3), of_fours)

    return F.when(F.size(words) < 9, 0).otherwise(_with(F.transform(words, lambda word: F.xxhash64(word)), of_ones))


def _verdict(line: Column, rules: LineRules, found: Column) -> Column:
    """'' for a good or blank line, else the rule it fails.

    `found` says what the whole text has at all: a rule whose signs it lacks is not looked at line by line.
    """
    short = f"^{SPACE}*{WORD}+({SPACE}+{WORD}+){{0,{rules.short_line_words - 2}}}{SPACE}*$"
    words, separators = _count(line, WORD + "+"), _count(line, SEPARATORS)
    return (
        F.when(found["separators"] & (separators >= rules.min_separators) & (separators >= words * rules.min_separator_share), "navigation")
        .when(found["noise"] & line.rlike(WORD) & (_count(line, NOISE) >= words * rules.max_noise_share), "punctuation")
        .when(line.rlike(short) & ~line.rlike(LINE_END), "navigation")
        .when(found["boilerplate"] & F.lower(line).rlike(BOILERPLATE) & (words <= rules.phrase_line_words), "boilerplate")
        .otherwise("")
    )


def line_first(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """All rows with their counts, the text without its failing lines, and the verdict `kept`."""
    taken = {c.lower() for c in RESULT_COLUMNS}
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken or c == text]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.select(*keep, words_of(whole).alias("__words"), F.split(whole, "\n", -1).alias("__lines"), whole.alias("__whole"))
    found = F.struct(
        F.col("__whole").rlike(SEPARATORS).alias("separators"),
        F.col("__whole").rlike(NOISE).alias("noise"),
        F.lower("__whole").rlike(BOILERPLATE).alias("boilerplate"),
    )
    split = base.select(
        *keep, "__words", "__lines", "__whole", found.alias("__found"),
        F.filter("__lines", lambda line: line.rlike(WORD)).alias("__full"),
    )
    judged = F.transform("__lines", lambda line: F.struct(line.alias("line"), _verdict(line, rules, F.col("__found")).alias("rule")))
    counted = split.select(
        *keep,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        _count(F.col("__whole"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("__words")).cast("long").alias("n_repeat_words"),
        F.size("__full").cast("long").alias("n_lines"),
        judged.alias("__judged"),
    )
    failing = lambda rule: F.size(F.filter("__judged", lambda x: x["rule"] == rule)).cast("long")
    chars = lambda text: F.length(F.regexp_replace(text, SPACE + "+", ""))
    left = F.array_join(F.transform(F.filter("__judged", lambda x: x["rule"] == ""), lambda x: x["line"]), "\n")
    cleaned = counted.select(
        *keep,
        *[c for c in RESULT_COLUMNS[:5]],
        ((F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))).alias("base_failed"),
        "n_lines",
        *[failing(rule).alias(f"n_{rule}_lines") for rule in ("punctuation", "navigation", "boilerplate")],
        F.when(F.col(f"`{text}`").isNotNull(), left).alias("cleaned_text"),
    )
    lost = F.when(F.col("word_chars") == 0, 0.0).otherwise(
        1 - chars(F.coalesce("cleaned_text", F.lit(""))) / F.col("word_chars")
    )
    return (
        cleaned.withColumn("lost_share", lost)
        .withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= rules.max_lost))
        .select(*keep, *RESULT_COLUMNS)
    )


def drop_rejected(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The kept documents in their own columns, without their failing lines; `n_chars` follows the text."""
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    # Columns under other names, so that none meets a result's.
    judged = line_first(docs.select(*[F.col(f"`{c}`").alias(name) for c, name in names.items()]), rules, names[text])
    new = {text: F.col("cleaned_text")}
    if n_chars in docs.columns:
        new[n_chars] = F.length("cleaned_text").cast(docs.schema[n_chars].dataType)
    row = F.struct("kept", *[new.get(c, F.col(name)).alias(name) for c, name in names.items()])
    # An array of one row or none instead of a filter, which Spark would work out from the text a second time.
    kept = judged.select(F.explode(F.filter(F.array(row), lambda r: r["kept"])).alias("row"))
    return kept.select(*[F.col(f"row.{name}").alias(c) for c, name in names.items()])
