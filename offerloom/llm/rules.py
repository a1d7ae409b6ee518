"""Quality rules: an ordered decision list, learned from labelled statistics by sequential covering.

Every text becomes a row of counts and ratios, with DataFrame functions only. On a bounded sample of labelled texts, rules
for low quality are grown one by one: a rule is a conjunction of thresholds, each added where it gains most information;
its last conditions are pruned on held-out labels; what it covers is set aside before the next rule is grown. The list is
emitted as one conditional expression, so applying it costs no more than its comparisons.

Words are runs without space, tab to carriage return. Null text is the empty text: no words, no lines, counts of zero
(ratios zero), and rejected like any text under 50 words. Repeated rows and null ids are judged like any other row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import WORD_BREAK, set_aside

_SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["mean_word_chars", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "distinct_ratio", "upper_ratio", "digit_ratio", "longest_run_ratio"]
#: At most so many labelled texts are learned from, taken in order of a hash of the id.
TRAINING_ROWS = 20_000


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with COUNTS and FEATURES. Extra columns stay; one with a name of ours is replaced."""
    stripped = F.btrim(F.col("_text"), F.lit(_SPACES))
    df, own = set_aside(docs)
    df = df.withColumn("_text", F.coalesce(own[text_col], F.lit("")))
    df = df.withColumns({
        "_words": F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, WORD_BREAK)),
        "_lines": F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(_SPACES)) != ""),
    })
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.char_length("_text") - F.char_length(F.translate("_text", SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_distinct": F.size(F.array_distinct("_words")),
        "_upper": F.char_length(F.regexp_replace("_text", r"\P{Lu}+", "")),
        "_digits": F.char_length("_text") - F.char_length(F.translate("_text", "0123456789", "")),
        "_n_lines": F.size("_lines"),
        "_longest": F.coalesce(F.array_max(F.transform("_lines", F.char_length)), F.lit(0)),
        "_windows": F.when(F.size("_words") < 3, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size("_words") - 3), lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)))
        ),
    })
    df = df.withColumn("n_repeat_words", _covered(F.col("_windows")))

    def share(of: Column, whole: Column) -> Column:
        return F.when(whole > 0, of / whole).otherwise(0.0)

    ratios = {
        "mean_word_chars": share(F.col("word_chars"), F.col("n_words")),
        "symbol_ratio": share(F.col("n_symbols"), F.col("n_words")),
        "dup_line_ratio": share(F.col("n_dup_lines"), F.col("_n_lines")),
        "repeat_ratio": share(F.col("n_repeat_words"), F.col("n_words")),
        "distinct_ratio": share(F.col("_distinct"), F.sqrt("n_words")),
        "upper_ratio": share(F.col("_upper"), F.col("word_chars")),
        "digit_ratio": share(F.col("_digits"), F.col("word_chars")),
        "longest_run_ratio": share(F.col("_longest"), F.char_length("_text")),
    }
    kept = [column for c, column in own.items() if c not in (*COUNTS, *FEATURES)]
    # a generator of one row: a filter on a count must not be moved below it, where the count would be computed again for each mention
    return df.select(*kept, F.inline(F.array(F.struct(*COUNTS, *(v.alias(k) for k, v in ratios.items())))))


def _covered(windows: Column) -> Column:
    """Words in three-word windows whose hash occurs twice or more. Only texts with a repeat are sorted."""
    ordered = F.array_sort(F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        at = F.transform(s, lambda x, i: F.when((x["g"] == F.get(s, i - 1)["g"]) | (x["g"] == F.get(s, i + 1)["g"]), x["i"]))
        return F.size(F.array_distinct(F.flatten(F.transform(F.filter(at, lambda p: p.isNotNull()), lambda p: F.array(p, p + 1, p + 2)))))

    # a one-element array binds the sorted windows, so that they are sorted once
    counted = F.get(F.transform(F.array(ordered), repeated), F.lit(0))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(counted).cast("long")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) > self.cut if self.above else F.col(self.feature) <= self.cut

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, FEATURES.index(self.feature)]
        return v > self.cut if self.above else v <= self.cut


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _cuts(v: np.ndarray, bad: np.ndarray, most: int) -> np.ndarray:
    """Midpoints between neighbouring values of different labels; evenly chosen ones if there are more than `most`."""
    order = np.lexsort((bad, v))
    v, bad = v[order], bad[order]
    at = np.nonzero((v[1:] > v[:-1]) & ((bad[1:] != bad[:-1]) | (np.diff(v, prepend=v[0])[:-1] == 0)))[0]
    middle = np.unique((v[at] + v[at + 1]) / 2)
    return middle if len(middle) <= most else middle[np.linspace(0, len(middle) - 1, most).astype(int)]


def grow(x: np.ndarray, bad: np.ndarray, conditions: int, cuts: int) -> Rule:
    """Adds the condition with the largest information gain until no good text is covered or nothing is gained."""
    rule: Rule = ()
    inside = np.ones(len(x), bool)
    while len(rule) < conditions:
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        if not n or not p:
            break
        best, best_gain = None, 1e-9
        for k, name in enumerate(FEATURES):
            for cut in _cuts(x[inside, k], bad[inside], cuts):
                for above in (True, False):
                    c = Condition(name, above, float(cut))
                    now = inside & c.holds(x)
                    p1, n1 = (now & bad).sum(), (now & ~bad).sum()
                    if p1 and (gain := p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))) > best_gain:
                        best, best_gain = c, gain
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(x)
    return rule


def prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """Without the last conditions whose loss raises (bad - good) / (bad + good) on held-out texts."""
    def worth(r: Rule) -> float:
        c = covers(r, x)
        p, n = (c & bad).sum(), (c & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=rule)


def learn_list(x: np.ndarray, bad: np.ndarray, rules: int = 8, conditions: int = 4, cuts: int = 48, precision: float = 0.97) -> list[Rule]:
    """Rules for low quality in order. A rule that isn't precise on all rows left, or hardly covers any, ends the list."""
    held_out = np.arange(len(x)) % 3 == 2
    left, out = np.ones(len(x), bool), []
    while len(out) < rules and (left & bad).any():
        a, b = left & ~held_out, left & held_out
        rule = prune(grow(x[a], bad[a], conditions, cuts), x[b], bad[b]) if a.any() else ()
        if not rule:
            break
        inside = left & covers(rule, x)
        p = (inside & bad).sum()
        if p < max(2, 0.002 * len(x)) or p < precision * inside.sum():
            break
        out.append(rule)
        left &= ~inside
    return out


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most `rows` labelled texts; labels without an id or a grade are passed over. The sample is broadcast: its size is bounded by `rows`."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    sample = usable.select(F.col("doc_id").alias(id_col), "quality", F.coalesce("toxic", F.lit(0)).alias("toxic"))
    sample = sample.orderBy(F.xxhash64(id_col), id_col, "quality", "toxic").limit(rows)
    return docs.select(id_col, text_col).join(F.broadcast(sample), id_col)


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text") -> list[Rule]:
    """The decision list for these labels; empty (keep all) without labels or without low quality among them."""
    sample = statistics(training_rows(docs, labels, rows, id_col, text_col), text_col).filter(~base_failed())
    got = sorted((r[id_col], r["quality"], *(r[f] for f in FEATURES)) for r in sample.select(id_col, "quality", *FEATURES).collect())
    if not got:
        return []
    table = np.array([r[1:] for r in got], float)
    return learn_list(table[:, 1:], table[:, 0] < 1)


def verdict(rules: list[Rule]) -> Column:
    """The list as an ordered conditional expression: false for the first rule that holds, else true."""
    out = None
    for rule in rules:
        holds = rule[0].column()
        for c in rule[1:]:
            holds = holds & c.column()
        out = F.when(holds, False) if out is None else out.when(holds, False)
    return F.lit(True) if out is None else out.otherwise(True)


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """docs with COUNTS, FEATURES, base_failed and kept."""
    return statistics(docs, text_col).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))
