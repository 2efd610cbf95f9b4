"""Quality rules with cutoffs whose false rejections are bounded, in DataFrame functions only.

Each text gets counts of words, word characters, symbols, repeated lines and repeated words.
Fixed base rules reject at once. The other rules compare a ratio with a cutoff that labelled
rows choose, per stratum (a band of word counts) and rule:

* A cutoff c rejects texts with a ratio of more than c. On the good labelled rows of the
  stratum, n of them, k would be rejected.
* The cutoff is safe if P(Binomial(n, limit) <= k) is at most delta / tests, where tests is
  the number of all strata, rules and cutoffs tried (Bonferroni). So with probability
  1 - delta no chosen cutoff rejects more than limit of the good texts of its stratum. Each
  rule gets an equal part of the allowed false rejections, so their union keeps the limit.
* The smallest safe cutoff is chosen; a rule without one rejects nothing in that stratum.

The tests count over all labelled rows. Only these counts, a few hundred numbers, come to
the driver. Null texts count as empty: no words, rejected by the base rules. Labels of null
or unknown ids are ignored, repeated labels of an id count once as the lowest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import UPPER, WORD_BREAKS, stored, without

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
BREAKS = " \t\n\x0b\x0c\r"

# False rejections allowed among good texts of a stratum, and the risk of exceeding them.
LIMIT = 0.03
DELTA = 0.05
# Upper ends of the bands of word counts.
BANDS = (50, 150, 400, 1000, 3000)
CUTOFFS = tuple(round(0.02 * i, 2) for i in range(1, 41))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeated(placed: str, x: Column, j: Column) -> Column:
    """Whether the window at x has the hash of the one before or after it."""
    before = F.when(j > 0, F.get(F.col(placed), j - 1)["h"] == x["h"])
    after = F.get(F.col(placed), j + 1)["h"] == x["h"]
    return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))


def _cover(seen: Column, start: Column) -> Column:
    """Adds the words that a window from start covers beyond the earlier windows' end."""
    end = start + WINDOW
    return F.struct(
        end.alias("end"),
        (seen["n"] + F.least(F.lit(WINDOW), end - seen["end"])).alias("n"),
    )


def text_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """df with COUNTS, n_lines (lines that have a word) and n_upper (letters A-Z)."""
    own = without(df, [*COUNTS, "n_lines", "n_upper"])
    whole = own.withColumn("_text", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    split = whole.withColumn(
        "_words", F.filter(F.split("_text", f"[{WORD_BREAKS}]+"), lambda w: w != "")
    ).withColumn(
        "_lines",
        F.filter(F.split("_text", "\n"), lambda line: F.trim(line, F.lit(BREAKS)) != ""),
    )
    hashed = split.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    windows = hashed.withColumn(
        "_windows",
        F.slice(
            F.transform(
                "_hashes",
                lambda h, i: F.xxhash64(h, *[F.get("_hashes", i + k) for k in range(1, WINDOW)]),
            ),
            F.lit(1),
            F.greatest(F.lit(0), F.size("_hashes") - (WINDOW - 1)),
        ),
    )
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    # Only texts with a repeated window pay for the sort.
    placed = windows.withColumn(
        "_placed",
        F.when(
            some,
            F.sort_array(
                F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            ),
        ),
    ).withColumn(
        "_places",
        F.sort_array(
            F.transform(
                F.filter("_placed", lambda x, j: _repeated("_placed", x, j)), lambda x: x["i"]
            )
        ),
    )
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    upper = F.char_length("_text") - F.char_length(F.translate("_text", UPPER, ""))
    symbols = F.char_length("_text") - F.char_length(F.translate("_text", SYMBOLS, ""))
    counted = placed.select(
        *[F.col(f"`{c}`") for c in own.columns],
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate("_places", start, _cover, lambda seen: seen["n"]), F.lit(0))
        .cast("long")
        .alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        upper.cast("long").alias("n_upper"),
    )
    return counted


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "capitals": ("n_upper", "word_chars"),
}


def stratum() -> Column:
    return sum(((F.col("n_words") > end).cast("int") for end in BANDS), F.lit(0))


def binomial_tail(n: int, k: int, p: float) -> float:
    """P(Binomial(n, p) <= k), exact up to rounding."""
    if k >= n:
        return 1.0
    if k >= n * p:
        return 1.0  # about a half or more: never small enough, so no need to sum
    total = 0.0
    for i in range(k, -1, -1):
        term = math.exp(
            math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p)
        )
        total += term
        if term <= total * 1e-17:
            break
    return total


def choose_cutoffs(
    above: dict[tuple[int, str], list[int]], limit: float = LIMIT, delta: float = DELTA
) -> dict[tuple[int, str], float]:
    """The smallest safe cutoff by stratum and rule.

    above: for each stratum and rule, the number of good rows, then how many of them exceed
    each of CUTOFFS.
    """
    share = limit / len(RULES)
    risk = delta / ((len(BANDS) + 1) * len(RULES) * len(CUTOFFS))
    chosen = {}
    for at, (n, *exceed) in above.items():
        for cutoff, k in zip(CUTOFFS, exceed, strict=True):
            if n and binomial_tail(n, k, share) <= risk:
                chosen[at] = cutoff
                break
    return chosen


def good_above(good: DataFrame) -> dict[tuple[int, str], list[int]]:
    """What choose_cutoffs needs, counted over all good rows with their text_counts."""
    sums = [F.count(F.lit(1)).alias("n")] + [
        F.count_if(_share(*parts) > cutoff).alias(f"{rule}_{i}")
        for rule, parts in RULES.items()
        for i, cutoff in enumerate(CUTOFFS)
    ]
    rows = good.groupBy(stratum().alias("stratum")).agg(*sums).collect()
    return {
        (row["stratum"], rule): [row["n"], *(row[f"{rule}_{i}"] for i in range(len(CUTOFFS)))]
        for row in rows
        for rule in RULES
    }


def rejected(chosen: dict[tuple[int, str], float]) -> Column:
    """Whether a row with text_counts exceeds a chosen cutoff of its stratum."""
    verdict = F.lit(False)
    for (band, rule), cutoff in sorted(chosen.items()):
        verdict |= (stratum() == band) & (_share(*RULES[rule]) > cutoff)
    return verdict


def apply_rules(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    limit: float = LIMIT,
    delta: float = DELTA,
) -> DataFrame:
    """df without its text, with text_counts, base_failed, kept.

    labels has id_col and quality (1: good).
    """
    named = without(df, ["base_failed", "kept"])
    counted = stored(without(text_counts(named, text), [text]), "text_counts")
    once = labels.groupBy(F.col(id_col).alias("_id")).agg(F.min("quality").alias("_quality"))
    good = once.where("_quality = 1").select("_id")
    # A good row that the base rules reject is lost whatever the cutoffs are.
    judged = counted.where(~base_failed()).join(
        good, F.col(f"`{id_col}`") == good["_id"], "left_semi"
    )
    chosen = choose_cutoffs(good_above(judged), limit, delta)
    return counted.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & ~rejected(chosen)
    )
