"""Line-first quality rules (operator 4), DataFrame functions only.

A document is cut into lines at ``\\n``.  Every line that holds a word is judged
on its own; failing lines are removed, and a document that loses more than
``max_loss`` of its words, or that fails the base rules, is rejected.

Line rules, first hit names the reason:

* ``punctuation``: more than ``max_punct`` of the line's non-space characters
  are punctuation or symbols (decorated or shouted text), or the line has
  ``min_open_words`` words or more and no sentence end in it;
* ``navigation``: ``min_separators`` menu separators or more;
* ``boilerplate``: one of the fixed notices in ``BOILERPLATE``.

Defined results: null text counts as empty; an empty text, or one without a
word, has all counts 0, fails the base rules (fewer than 20 words) and is not
kept.  Repeated rows are judged each on its own.  Everything is computed inside
the row, without a shuffle, so a hot source or very long text moves no data;
other columns pass through untouched and the operator's own are prefixed (``prefix``);
a column that starts with the prefix raises ValueError.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract.
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30

# Notices that carry no content, matched anywhere in the lower-cased line.
BOILERPLATE = (
    "all rights reserved", "licensed under", "terms of service", "terms of use",
    "privacy policy", "cookie policy", "accept cookies", "uses cookies",
    "subscribe to our newsletter", "sign up for", "enable javascript",
    "click here", "follow us on", "share this", "powered by", "lorem ipsum",
    "permission is hereby granted", "spdx-license-identifier",
)


def words_of(text: Column) -> Column:
    """Words of a text: maximal runs without ASCII white space."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def _repeat_words(words: Column, n: Column, wins: Column, pos: Column) -> Column:
    """Words inside windows at the sorted starts ``pos``, each word once."""
    gaps = F.transform(pos, lambda p, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get(pos, k + 1) - p, F.lit(WINDOW))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)


def base_counts(df: DataFrame, text: str, p: str) -> DataFrame:
    """The contract's counts, as columns ``{p}n_words`` ... of ``df``."""
    w, wins, s = F.col(f"{p}words"), F.col(f"{p}wins"), F.col(f"{p}sorted")
    df = df.withColumn(f"{p}text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn(f"{p}words", words_of(F.col(f"{p}text")))
    n = F.size(w)
    df = (df.withColumn(f"{p}n_words", n.cast("long"))
          .withColumn(f"{p}word_chars", F.length(F.array_join(w, "")).cast("long"))
          .withColumn(f"{p}n_symbols",
                      F.regexp_count(F.col(f"{p}text"), F.lit(SYMBOLS)).cast("long"))
          .withColumn(f"{p}lines", F.filter(F.split(F.col(f"{p}text"), "\n"),
                                            lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
          .withColumn(f"{p}wins", F.when(n >= WINDOW, F.transform(
              F.sequence(F.lit(1), n - (WINDOW - 1)),
              lambda i: F.xxhash64(F.slice(w, i, WINDOW))))))
    df = df.withColumn(f"{p}n_dup_lines",
                       (F.size(f"{p}lines") - F.size(F.array_distinct(f"{p}lines"))).cast("long"))
    # Only a text with a repeated window pays for sorting its windows.
    df = df.withColumn(f"{p}sorted", F.when(
        F.size(F.array_distinct(wins)) < F.size(wins),
        F.array_sort(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn(f"{p}pos", F.array_sort(F.transform(
        F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])),
        lambda x: x["i"])))
    return (df.withColumn(f"{p}n_repeat_words", F.coalesce(
        _repeat_words(w, n, wins, F.col(f"{p}pos")), F.lit(0).cast("long")))
        .withColumn(f"{p}base_failed",
                    (F.col(f"{p}n_words") < MIN_WORDS)
                    | (100 * F.col(f"{p}n_repeat_words") > REPEAT_PERCENT * F.col(f"{p}n_words"))))


def line_verdict(line: Column, max_punct: float, min_open_words: int,
                 min_separators: int) -> Column:
    """Reason for which a line fails, null if it passes."""
    low = F.lower(line)
    solid = F.length(F.regexp_replace(line, SPACE_RUN, ""))
    punct = F.regexp_count(line, F.lit(r"[!-/:-@\[-`{-~]"))
    notice = F.lit(False)
    for phrase in BOILERPLATE:
        notice = notice | F.contains(low, F.lit(phrase))
    open_end = (~line.rlike(r"[.!?:;…。！？]")
                & (F.size(words_of(line)) >= min_open_words))
    return (F.when(F.regexp_count(line, F.lit(r"[|»›·•]")) >= min_separators, "navigation")
            .when(punct > max_punct * solid, "punctuation")
            .when(notice, "boilerplate")
            .when(open_end, "punctuation"))


def quality_rules(df: DataFrame, text: str = "text", prefix: str = "qr_",
                  max_punct: float = 0.15, min_open_words: int = 40,
                  min_separators: int = 3, max_loss: float = 0.5) -> DataFrame:
    """Every input row with its counts, cleaned text, line verdicts and verdict.

    Added, each with ``prefix``: ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words`` (long), ``base_failed``, ``kept``
    (boolean), ``failed_lines`` (array of line and reason), ``clean_text``
    (passing lines joined by ``\\n``), ``lost_words`` (long).
    """
    p = prefix
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed", "kept", "failed_lines", "clean_text", "lost_words"]
    clash = {c.lower() for c in df.columns if c.lower().startswith(p.lower())}
    if clash:
        raise ValueError(f"columns start with {p!r}: {sorted(clash)}; choose another prefix")
    out = base_counts(df, text, p)
    out = out.withColumn(f"{p}judged", F.transform(F.col(f"{p}lines"), lambda x: F.struct(
        x.alias("line"),
        line_verdict(x, max_punct, min_open_words, min_separators).alias("reason"))))
    out = (out
           .withColumn(f"{p}failed_lines", F.filter(f"{p}judged", lambda x: x["reason"].isNotNull()))
           .withColumn(f"{p}clean_text", F.array_join(F.transform(
               F.filter(f"{p}judged", lambda x: x["reason"].isNull()), lambda x: x["line"]), "\n")))
    lost = F.aggregate(F.col(f"{p}failed_lines"), F.lit(0).cast("long"),
                       lambda a, x: a + F.size(words_of(x["line"])))
    out = out.withColumn(f"{p}lost_words", lost)
    out = out.withColumn(f"{p}kept", ~F.col(f"{p}base_failed")
                         & (F.col(f"{p}lost_words") <= max_loss * F.col(f"{p}n_words")))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(p + c) for c in own])
