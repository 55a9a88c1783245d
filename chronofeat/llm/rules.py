"""Quality rules: text measures, and decision lists learned from labelled rows."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofeat.llm.common import WORD, Scratch, shielded

#: At most about this many labelled rows are read for fitting, chosen by a hash of their id.
MAX_LABELLED = 10_000
#: Quantiles of the labelled rows of a class that give thresholds, with the middles between them.
CUTS = 32
MAX_RULES = 12
MAX_CONDITIONS = 4
#: A rule must be right on this part of the held-out rows that it covers, smoothed.
MIN_PRECISION = 0.9
#: Fewer labelled rows than this covered by a rule are no evidence.
MIN_COVER = 5

_SPACES = r"[\x20\x09-\x0D]+"
#: Bits of a word's place beside its window's hash; longer texts are sorted by words.
_PLACE = 22

FEATURES = (
    "n_words",
    "mean_word",
    "symbol_rate",
    "upper_rate",
    "mark_rate",
    "digit_rate",
    "dup_line_rate",
    "repeat_rate",
    "distinct_rate",
    "line_words",
)


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with the text's counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    and n_upper, n_marks, n_digits, n_lines, n_distinct for the learned rules.

    Words are runs of anything but ASCII white space. A repeat word lies in a window of three words
    that occurs twice or more in the text, the first time included. Null and empty texts count zero
    everywhere; repeated rows are counted each, and an empty table stays empty. Columns of these
    names are replaced; rows are neither joined nor shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(WORD)))
    df = docs.withColumns(
        {
            "_words": F.array_remove(F.split(text, _SPACES), ""),
            "_lines": lines,
            # What the counts of characters need, taken out in one pass; it is short.
            "_signs": F.regexp_replace(text, r"[^\p{Lu}0-9!?#*$%&|<>]+", ""),
        }
    )
    signs = F.col("_signs")
    others = lambda chars: F.length(F.translate(signs, chars, ""))
    words, windows = F.col("_words"), F.size("_words") - 2
    at = lambda i: F.get(words, i)
    starts = F.sequence(F.lit(0), windows - 1)
    hashes = F.transform(starts, lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": (F.length(signs) - others("#*$%&|<>")).cast("long"),
            "n_upper": others("0123456789!?#*$%&|<>").cast("long"),
            "n_marks": (F.length(signs) - others("!?")).cast("long"),
            "n_digits": (F.length(signs) - others("0123456789")).cast("long"),
            "n_distinct": F.size(F.array_distinct("_words")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            # Equal windows have equal hashes: if all hashes differ, nothing repeats.
            "_hashes": F.when(windows > 0, hashes),
        }
    )
    df = df.withColumn(
        "_may_repeat", (windows > 0) & (F.size(F.array_distinct("_hashes")) < F.size("_hashes"))
    )
    # Hash and place in one number each: sorting brings equal windows together.
    packed = F.transform("_hashes", lambda h, i: F.shiftleft(h, _PLACE).bitwiseOR(i.cast("long")))
    short = F.col("_may_repeat") & (windows < 2**_PLACE)
    df = df.withColumn("_packed", F.when(short, F.sort_array(packed)))
    pack = F.col("_packed")
    part = lambda k: F.shiftrightunsigned(F.get(pack, k), _PLACE)
    place = lambda k: F.get(pack, k).bitwiseAND(F.lit(2**_PLACE - 1)).cast("int")
    later = F.filter(F.sequence(F.lit(1), F.size(pack) - 1), lambda k: part(k) == part(k - 1))
    df = df.withColumn("_later", F.when(F.size(pack) > 1, later))

    def alike(i: Column, j: Column) -> Column:
        return (at(i) == at(j)) & (at(i + 1) == at(j + 1)) & (at(i + 2) == at(j + 2))

    # Where shortened hashes of different windows collide, the words themselves are sorted.
    later = F.col("_later")
    exact = F.forall(later, lambda k: alike(place(k), place(k - 1)))
    slow = F.col("_may_repeat") & ~F.coalesce(exact, F.lit(False))
    window = lambda i: F.struct(at(i), at(i + 1), at(i + 2), i.alias("place"))
    df = df.withColumn("_sorted", F.when(slow, F.array_sort(F.transform(starts, window))))
    ordered = F.col("_sorted")
    last = F.size(ordered) - 1

    def same(i: Column, j: Column) -> Column:
        a, b = F.get(ordered, i), F.get(ordered, j)
        return (a["col1"] == b["col1"]) & (a["col2"] == b["col2"]) & (a["col3"] == b["col3"])

    repeated = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: ((i > 0) & same(i, i - 1)) | ((i < last) & same(i, i + 1)),
    )
    places = F.transform(repeated, lambda i: F.get(ordered, i)["place"])
    quick = F.array_distinct(
        F.concat(F.transform(later, lambda k: place(k - 1)), F.transform(later, place))
    )
    places = F.when(last > 0, places).when(F.size(later) > 0, quick)
    df = df.withColumn("_places", F.sort_array(places))
    # Each place covers three words, or as many as there are up to the next place.
    found = F.col("_places")
    gaps = F.zip_with(
        found, F.slice(found, F.lit(2), F.size(found)), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3))
    )
    total = F.aggregate(gaps, F.lit(0), lambda a, b: a + b)
    # A filter on a measure must not be pushed below the steps that compute it: its expression would
    # be unfolded into them and evaluated anew for every word. A condition on a row number, which
    # always holds, stops that.
    total = F.when(F.monotonically_increasing_id() >= 0, F.coalesce(total, F.lit(0)))
    df = df.withColumn("n_repeat_words", total.cast("long"))
    own = ("_words", "_lines", "_signs", "_hashes", "_may_repeat", "_packed", "_later", "_sorted")
    return df.drop(*own, "_places")


def features() -> dict[str, Column]:
    """Rates from the counts of `measure`; a rate over nothing is 0."""

    def rate(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": rate("word_chars", "n_words"),
        "symbol_rate": rate("n_symbols", "n_words"),
        "upper_rate": rate("n_upper", "word_chars"),
        "mark_rate": rate("n_marks", "n_words"),
        "digit_rate": rate("n_digits", "word_chars"),
        "dup_line_rate": rate("n_dup_lines", "n_lines"),
        "repeat_rate": rate("n_repeat_words", "n_words"),
        "distinct_rate": rate("n_distinct", "n_words"),
        "line_words": rate("n_words", "n_lines"),
    }


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self, columns: dict[str, Column]) -> Column:
        value = columns[self.feature]
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules, each a conjunction that rejects; a text that none covers is kept."""

    rules: tuple[Rule, ...] = ()

    def verdict(self) -> Column:
        """`kept` as an ordered conditional expression over the counts of `measure`."""
        if not self.rules:
            return F.lit(True)
        columns = features()
        first, *rest = [covers(rule, columns) for rule in self.rules]
        chain = F.when(first, F.lit(False))
        for rule in rest:
            chain = chain.when(rule, F.lit(False))
        return chain.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, rule))}" for rule in self.rules)


def covers(rule: Rule, columns: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.column(columns) for c in rule])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    target: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_labelled: int = MAX_LABELLED,
) -> DecisionList:
    """Sequential covering of the rows labelled 0, from counts that Spark gathers per threshold.

    Two thirds of the labelled rows grow rules: conditions are added greedily by information gain
    over a histogram of (feature, bin, label). The last third prunes: the prefix of a rule with the
    best (hits - misses) / covered stays. A rule whose precision there is too low is given up, and the
    next one starts from another feature; the list ends when none is left or nothing bad remains.
    Rows that a rule covers leave both parts. Null labels and ids are ignored; of several labels of a
    document each counts. Without labelled rows of both classes the list is empty and keeps all.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "rules")
    labels = labels.select(F.col(id_col).alias("_id"), F.col(target).cast("int").alias("_good"))
    labels = labels.where(F.col("_id").isNotNull() & F.col("_good").isNotNull())
    number = labels.count()
    if number > max_labelled:
        share = int(2**30 * max_labelled / number)
        labels = labels.where(F.pmod(F.xxhash64("_id"), F.lit(2**30)) < share)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(labels, "_id")
    held_out = F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(3)) == 0
    measured = measure(rows)
    table = scratch.keep(
        measured.select(
            (F.col("_good") <= 0).alias("bad"),
            held_out.alias("held_out"),
            *[c.alias(name) for name, c in features().items()],
        ),
        "labelled",
    )
    rules: list[Rule] = []
    cuts = _cuts(table)
    usable = dict(cuts)
    while usable and len(rules) < MAX_RULES:
        left = _uncovered(table, rules)
        grown = _grow(left.where(~F.col("held_out")), usable)
        if not grown:
            break
        rule = _prune(left.where("held_out"), grown)
        if rule is None:
            del usable[grown[0].feature]
        else:
            rules.append(rule)
            usable = dict(cuts)
    scratch.drop(table)
    return DecisionList(tuple(rules))


def _plain() -> dict[str, Column]:
    return {name: F.col(name) for name in FEATURES}


def _uncovered(table: DataFrame, rules: list[Rule]) -> DataFrame:
    for rule in rules:
        table = table.where(~covers(rule, _plain()))
    return table


def _cuts(table: DataFrame) -> dict[str, list[float]]:
    marks = [k / (CUTS + 1) for k in range(1, CUTS + 1)]
    row = table.agg(
        F.count_if("bad").alias("bad"),
        F.count_if(~F.col("bad")).alias("good"),
        # Quantiles of either class, so that a rare class has thresholds of its own.
        *[
            F.percentile_approx(F.when(F.col("bad") == side, F.col(f)), marks).alias(f"{f}_{side}")
            for f in FEATURES
            for side in (True, False)
        ],
    ).first()
    if not row["bad"] or not row["good"]:
        return {}
    found = {f: sorted({*row[f"{f}_True"], *row[f"{f}_False"]}) for f in FEATURES}
    middles = {f: [(a + b) / 2 for a, b in zip(v, v[1:], strict=False)] for f, v in found.items()}
    return {f: sorted({*found[f], *middles[f]}) for f in FEATURES}


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    """Add the condition of highest gain until the rule is pure, or nothing helps."""
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        covered = rows.where(covers(tuple(rule), _plain())) if rule else rows
        counts = _histogram(covered, cuts)
        bad, good = map(sum, next(iter(counts.values())))
        if not bad or (rule and not good):
            break
        best, best_gain = [], 1e-6
        for feature in cuts:
            of_bad, of_good = counts[feature]
            low_bad = low_good = 0
            for k, cut in enumerate(cuts[feature]):
                low_bad, low_good = low_bad + of_bad[k], low_good + of_good[k]
                for above, b, g in (
                    (False, low_bad, low_good),
                    (True, bad - low_bad, good - low_good),
                ):
                    if b < MIN_COVER:
                        continue
                    gain = b * (log2(b / (b + g)) - log2(bad / (bad + good)))
                    if gain > best_gain + 1e-9:
                        best, best_gain = [], gain
                    if gain > best_gain - 1e-9:
                        best.append(Condition(feature, above, cut))
        if not best:
            break
        # Of equally good cuts of the first such feature the middle one is furthest from both sides.
        best = [c for c in best if (c.feature, c.above) == (best[0].feature, best[0].above)]
        rule.append(best[len(best) // 2])
    return tuple(rule)


def _histogram(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, tuple[list, list]]:
    """Rows per bin and label of each feature, from one aggregation; bin k ends at the k-th cut."""

    def bin_of(feature: str) -> Column:
        all_cuts = F.from_json(F.lit(json.dumps(cuts[feature])), "array<double>")
        below = F.filter(all_cuts, lambda cut: F.col(feature) > cut)
        return F.struct(F.lit(feature).alias("feature"), F.size(below).alias("bin"))

    counted = (
        rows.select("bad", F.explode(F.array(*map(bin_of, cuts))).alias("b"))
        .groupBy("b.feature", "b.bin", "bad")
        .count()
    )
    out = {f: ([0] * (len(cuts[f]) + 1), [0] * (len(cuts[f]) + 1)) for f in cuts}
    for r in counted.collect():  # features x bins x 2 rows at most
        out[r["feature"]][0 if r["bad"] else 1][r["bin"]] = r["count"]
    return out


def _prune(rows: DataFrame, rule: Rule) -> Rule | None:
    prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
    if not prefixes:
        return None
    columns = _plain()
    row = rows.agg(
        *[
            F.count_if(covers(p, columns) & (F.col("bad") == side)).alias(f"{k}_{side}")
            for k, p in enumerate(prefixes)
            for side in (True, False)
        ]
    ).first()
    best, best_worth = None, None
    for k, prefix in enumerate(prefixes):
        hits, misses = row[f"{k}_True"], row[f"{k}_False"]
        if hits + misses == 0 or (hits + 1) / (hits + misses + 1) < MIN_PRECISION:
            continue
        worth = (hits - misses) / (hits + misses)
        if best_worth is None or worth > best_worth:
            best, best_worth = prefix, worth
    return best


def judge(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """`measure` plus base_failed and kept: not base_failed, and no rule of the list covers it."""
    out = measure(docs, text_col).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & rules.verdict())


def verdict_column(
    docs: DataFrame, rules: DecisionList, name: str, text_col: str = "text"
) -> DataFrame:
    """`docs` with `judge`'s verdict in column `name`, its own columns as they were."""
    docs, own = shielded(docs)
    judged = judge(docs, rules, own[text_col])
    return judged.select(*[F.col(o).alias(c) for c, o in own.items()], F.col("kept").alias(name))
