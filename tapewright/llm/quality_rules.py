"""Quality rules by line-first cleaning, in DataFrame functions only.

Every line is judged by its punctuation, by marks of navigation and by marks of boilerplate, which hold in any language;
English phrases count in short lines only. Failing lines go, and a document that loses too much of its text with them is
rejected. Nothing is shuffled: all work stays in one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE_CLASS, clash

RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines", "kept_words", "base_failed", "kept", "clean_text")

# Phrases that mark a short line as boilerplate (matched in any case).
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "uses cookies",
    "lorem ipsum", "enable javascript", "javascript is disabled", "powered by", "subscribe to our newsletter",
)

SYMBOLS = r"[#*$%&|<>{}\[\]=~^`\\]"
SEPARATORS = r"[|»›•·]"
CLOSING, ENDING = "\"'”’»)]", (".", "!", "?", ":", ";", ",", "…", "。", "！", "？")


@dataclass(frozen=True)
class LineRules:
    """Thresholds. Shares are of a line's characters without white space, or of a document's words.

    max_symbol_share, max_shout_share: of symbols, and of marks that follow ! or ? (times 12). min_separators: of menus in
    one line, which hold one for each separator_chars characters too. menu_words: a menu over lines is three lines in a row
    or more of so few words each, none of which ends in punctuation. max_notice_words: a line of more words is no
    boilerplate, whatever phrase or copyright mark it holds.
    """

    max_symbol_share: float = 0.1
    max_shout_share: float = 0.3
    min_separators: int = 3
    separator_chars: int = 60
    menu_words: int = 3
    max_notice_words: int = 12
    min_words: int = 50
    max_repeat_percent: int = 50
    min_kept_share: float = 0.5


def _words(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE_CLASS}+", -1), lambda w: w != "")


def _at_most(line: Column, n_words: int) -> Column:
    """Whether a line has at most so many words, and 20 characters for each; longer lines are never split."""
    return (F.length(line) <= 20 * n_words) & (F.size(_words(line)) <= n_words)


def _marked(line: Column, rules: LineRules) -> Column:
    """True for a line that fails by symbols, shouting or separators."""
    bare = F.regexp_replace(line, f"{SPACE_CLASS}+", "")
    count = lambda pattern: F.length(bare) - F.length(F.regexp_replace(bare, pattern, ""))
    separators = count(SEPARATORS)
    menu = (separators >= rules.min_separators) & (separators * rules.separator_chars >= F.length(bare))
    return (count(SYMBOLS) > rules.max_symbol_share * F.length(bare)) | (count(r"(?<=[!?])[!?]") * 12 > rules.max_shout_share * F.length(bare)) | menu


def _notice(line: Column, rules: LineRules) -> Column:
    """True for a short line with a copyright mark or a boilerplate phrase."""
    return _at_most(line, rules.max_notice_words) & line.rlike(rf"(?i)©|\(c\) ?\d{{4}}|\b(?:{'|'.join(BOILERPLATE)})\b")


def _item(line: Column, rules: LineRules) -> Column:
    """True for a line that may be an item of a menu over lines."""
    last = F.right(F.rtrim(F.regexp_replace(line, f"{SPACE_CLASS}+", ""), F.lit(CLOSING)), F.lit(1))
    return _at_most(line, rules.menu_words) & ~last.isin(*ENDING)


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: LineRules = LineRules(), carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: the id, base counts, the cleaned text and the verdict.

    Columns: id, the carried columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_failed_lines, kept_words,
    base_failed, kept, clean_text. A null or empty text has no words: all counts are 0, base_failed is true, kept is
    false. A null id stays null. Repeated rows each get their own equal result; other columns are not read. Carried columns
    that are named as one of the result's are an error.

    Items of menus (three lines in a row or more) go first, then lines that equal an earlier line, then lines that fail a
    rule of their own. kept is false if base_failed, else it says whether the kept lines hold at least min_kept_share of the
    document's words. Time is linear in the text but for sorting its words. Repeated 3-word windows are found by 64-bit
    hashes within the document.
    """
    clash(carry, id_col, RESULT)
    text = F.coalesce(F.col(text_col), F.lit(""))
    marks = text.rlike(SYMBOLS)
    for mark in ("»", "›", "•", "·", "!!", "??", "!?", "?!"):
        marks |= F.contains(text, F.lit(mark))
    step = docs.select(F.col(id_col).alias("id"), text.alias("t"), _words(text).alias("w"), F.split(text, "\n", -1).alias("l"), marks.alias("marks"), *carry)
    with_word = F.filter("l", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n, hashed = F.size("w"), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))
    spans = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    step = step.select("id", "t", "w", "marks", n.alias("n_words"), F.length(F.array_join("w", "")).alias("word_chars"), with_word.alias("l"), F.transform(spans, hashed).alias("h"), *carry)
    step = step.withColumn("repeats", F.size("h") > F.size(F.array_distinct("h"))).withColumn("items", F.transform("l", lambda x: _item(x, rules)))
    # where a text has repeats: each window as one number, hash bits above, its place below; sorted, equal hash bits are neighbours
    step = step.withColumn("low", F.expr("shiftleft(1L, length(bin(n_words))) - 1")).withColumn("high", F.bitwise_not("low"))
    packed = F.sort_array(F.transform("h", lambda h, i: h.bitwiseAND(F.col("high")).bitwiseOR(i.cast("long"))))
    step = step.withColumn("s", F.when(F.col("repeats"), packed))
    like = lambda x, i: x.bitwiseXOR(F.get("s", i)).bitwiseAND(F.col("high")) == 0
    maybe = F.filter("s", lambda x, i: like(x, i + 1) | like(x, i - 1))
    on = lambda i: F.coalesce(F.get("items", i), F.lit(False))
    in_menu = lambda i: on(i) & ((on(i - 1) & (on(i - 2) | on(i + 1))) | (on(i + 1) & on(i + 2)))
    left = F.when(F.exists("items", lambda x: x), F.filter("l", lambda _, i: ~in_menu(i))).otherwise(F.col("l"))
    step = step.withColumn("maybe", F.transform(maybe, lambda x: x.bitwiseAND(F.col("low")).cast("int"))).withColumn("once", F.array_distinct(left))
    exact = F.array_sort(F.transform("maybe", lambda i: F.struct(F.get("h", i).alias("h"), i.alias("p"))))
    step = step.withColumn("exact", exact).withColumn("n_dup_lines", F.size("l") - F.size(F.array_distinct("l")))
    near = lambda x, i: F.coalesce(F.get("exact", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("exact", i + 1)["h"] == x["h"], F.lit(False))
    again = F.filter("exact", near)
    stays = lambda x: ~((F.col("marks") & _marked(x, rules)) | _notice(x, rules))
    step = step.withColumn("again", again).withColumn("stay", F.filter("once", stays))
    positions = F.flatten(F.transform("again", lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
    repeats = F.when(F.size("again") > 0, F.size(F.array_distinct(positions))).otherwise(0)
    whole = F.size("stay") == F.size("l")
    step = step.withColumn("n_repeat_words", repeats).withColumn("whole", whole).withColumn("clean_text", F.array_join("stay", "\n"))
    symbols = F.when(F.col("marks"), F.length("t") - F.length(F.regexp_replace("t", r"[#*$%&|<>]", ""))).otherwise(0)
    base_failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    kept_words = F.when(F.col("whole"), F.col("n_words")).otherwise(F.size(_words(F.col("clean_text"))))
    out = step.select(
        F.col("id").alias(id_col), *carry, F.col("n_words").cast("long"), F.col("word_chars").cast("long"), symbols.cast("long").alias("n_symbols"),
        F.col("n_dup_lines").cast("long"), F.col("n_repeat_words").cast("long"), (F.size("l") - F.size("stay")).cast("long").alias("n_failed_lines"),
        kept_words.cast("long").alias("kept_words"), base_failed.alias("base_failed"), "clean_text",
    )
    # a generator of one row, so that no filter on the results is moved below and the counts made once for each use
    out = out.select(F.inline(F.array(F.struct(*out.columns))))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("kept_words") >= rules.min_kept_share * F.col("n_words")))
