"""Secret scans through a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: alternatives, each a set of trigrams that a
match must contain. The index holds postings (trigram, document) for the trigrams that any query names, from lower-cased
texts. Postings are intersected per alternative; documents that satisfy one are verified with the rule's expression. A
rule with an alternative without trigrams is verified on every document.

Spans are in code points, end exclusive; matches are leftmost and don't overlap within a kind. Null text is the empty
text, without secrets. Repeated rows and null ids are scanned like any other row. Texts are scanned whole.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import parted, saved


@dataclass(frozen=True)
class SecretRule:
    """kind, a regular expression, and what a match must have to count: `least` characters in `group`."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0
    base: bool = False


#: Base kinds in the order in which ties at one start are listed, then the kinds that this operator adds.
RULES = (
    SecretRule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, base=True),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 18, base=True),
    SecretRule("hex", r"[0-9a-f]{16,}", base=True),
    SecretRule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    SecretRule("git_token", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]*"),
    SecretRule("cloud_key", r"AIza[0-9A-Za-z_-]{35}"),
    SecretRule("pay_key", r"(?:sk|rk)_live_[0-9A-Za-z]{16,}"),
)

#: More alternatives than this are taken as "anything", and so are classes of more characters than that.
MOST_ALTERNATIVES, MOST_CHARACTERS = 64, 8
_ANYTHING = ((None,),)


def _characters(members: list) -> list[str] | None:
    """The characters of a small class; None if they are many, or told by what they aren't."""
    if any(kind not in (op.LITERAL, op.RANGE) for kind, _ in members):
        return None
    ranges = [(value, value) if kind is op.LITERAL else value for kind, value in members]
    if sum(last - first + 1 for first, last in ranges) > MOST_CHARACTERS:
        return None
    return [chr(c) for first, last in ranges for c in range(first, last + 1)]


def _alternatives(tree: parser.SubPattern) -> tuple[tuple[str | None, ...], ...]:
    """What a match looks like: alternatives of literal stretches, None for a stretch that isn't known."""
    out: tuple[tuple[str | None, ...], ...] = ((),)
    for kind, value in tree:
        if kind is op.LITERAL:
            part = ((chr(value),),)
        elif kind is op.IN and (characters := _characters(value)):
            part = tuple((c,) for c in characters)
        elif kind is op.BRANCH:
            part = tuple(a for branch in value[1] for a in _alternatives(branch))
        elif kind is op.SUBPATTERN:
            part = _alternatives(value[-1])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, inner = value
            once = _alternatives(inner)
            if most == 1:
                part = ((), *once) if least == 0 else once
            else:
                part = tuple((*a, None) for a in once) if least else _ANYTHING
        elif kind is op.AT:
            part = ((),)
        else:  # a large class, any character, a look-around or a reference
            part = _ANYTHING
        if len(out) * len(part) > MOST_ALTERNATIVES:
            part = _ANYTHING
        out = tuple((*a, *b) for a in out for b in part)
    return out


def trigram_query(regex: str) -> list[frozenset[str]] | None:
    """Alternatives, each the lower-case trigrams that a match must contain; None if some match needs none."""
    out: set[frozenset[str]] = set()
    for stretches in _alternatives(parser.parse(regex)):
        runs = "".join("\0" if s is None else s for s in stretches).lower().split("\0")
        grams = frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2))
        if not grams:
            return None
        out.add(grams)
    return sorted((a for a in out if not any(b < a for b in out)), key=sorted)


def postings(docs: DataFrame, handle: Column, text: Column, grams: list[str]) -> DataFrame:
    """The inverted index for these trigrams: (gram, handle), once for each text that has it in any case."""
    lower = docs.select(handle.alias("handle"), F.lower(text).alias("lower"))
    has = F.filter(F.array(*map(F.lit, grams)), lambda g: F.contains(F.col("lower"), g))
    return lower.select("handle", F.explode(has).alias("gram"))


@dataclass(frozen=True)
class Index:
    """Postings as a table in the shared folder, and the trigrams that they are of."""

    table: DataFrame
    grams: frozenset[str]


def _grams(rules: tuple[SecretRule, ...]) -> frozenset[str]:
    return frozenset(g for r in rules for alternative in trigram_query(r.regex) or [] for g in alternative)


def index(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Postings of the trigrams that these rules name, written once; any rules that need no other trigrams can be scanned for
    with them."""
    grams, text = _grams(rules), F.coalesce(F.col(text_col), F.lit(""))
    return Index(saved(postings(docs, F.xxhash64(F.col(id_col), text), text, sorted(grams)), "postings"), grams)


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(handle, kinds): the documents in all posting lists of some alternative of a kind's query.

    The queries are the rule set's own and few, so their table is broadcast."""
    rows = [(kind, n, g, len(grams)) for kind, query in queries.items() for n, grams in enumerate(query) for g in sorted(grams)]
    terms = index.sparkSession.createDataFrame(rows, "kind string, alternative int, gram string, needed int")
    met = index.join(F.broadcast(terms), "gram").groupBy("handle", "kind", "alternative", "needed").agg(F.countDistinct("gram").alias("found"))
    return met.filter("found = needed").groupBy("handle").agg(F.collect_set("kind").alias("kinds"))


def spans(text: Column, rule: SecretRule, number: int) -> Column:
    """Array of (start, number, stop) of the rule's matches, from the lengths of matches and of the gaps between them."""
    whole = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group))
    row = F.arrays_zip(F.slice(F.split(text, rule.regex, -1), F.lit(1), F.size(whole)).alias("gap"), whole.alias("match"), counted.alias("value"))
    row = F.transform(row, lambda x: F.struct(F.char_length(x["gap"]).alias("gap"), F.char_length(x["match"]).alias("match"), F.char_length(x["value"]).alias("value")))
    kind = "struct<start:int,kind:int,stop:int>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        one = F.struct(begin.alias("start"), F.lit(number).alias("kind"), (begin + x["match"]).alias("stop"))
        return F.struct((begin + x["match"]).alias("at"), F.when(x["value"] >= rule.least, F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(row, start, step, lambda acc: acc["out"])


def scan(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", held: Index | None = None) -> DataFrame:
    """One row per document: counts of the base kinds, spans of base and of all kinds by start and kind. held: index() of the same
    docs, for these rules or for more; without it postings are made for this scan."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    handle = F.xxhash64(F.col(id_col), text)  # of both, so that rows without an id don't share one
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not None}
    grams = _grams(rules)
    if held and not grams <= held.grams:
        raise ValueError(f"the index has no postings of {sorted(grams - held.grams)}")
    met = held.table.filter(F.col("gram").isin(sorted(grams))) if held else postings(docs, handle, text, sorted(grams))
    found = saved(candidates(met, indexed), "candidates")
    # few texts are candidates: the others aren't moved
    none, likely = parted(docs.select(F.col(id_col), text.alias("_text"), handle.alias("handle")), F.col("handle"), found.select("handle"))
    rows = none.withColumn("kinds", F.lit(None).cast("array<string>")).unionByName(likely.join(found, "handle", "left"))

    def verified(rule: SecretRule, number: int) -> Column:
        none = F.array().cast("array<struct<start:int,kind:int,stop:int>>")
        likely = F.col("_text").rlike(rule.regex)
        if queries[rule.kind] is not None:
            likely = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False)) & likely
        return F.when(likely, spans(F.col("_text"), rule, number)).otherwise(none)

    rows = rows.select(id_col, *(verified(r, n).alias(f"_{n}") for n, r in enumerate(rules)))
    names = F.array(*(F.lit(r.kind) for r in rules))

    def told(numbers: list[int]) -> Column:
        ordered = F.array_sort(F.concat(*(F.col(f"_{n}") for n in numbers)))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")

    base = [n for n, r in enumerate(rules) if r.base]
    return rows.select(
        id_col,
        *(F.size(f"_{n}").cast("long").alias(f"n_{rules[n].kind}") for n in base),
        F.sha2(told(base), 256).alias("base_sha256"),
        told(list(range(len(rules)))).alias("spans"),
    )
