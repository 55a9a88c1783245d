"""Secret scans through a trigram index."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofeat.llm.common import Scratch, restored, shielded
from chronofeat.llm.trigrams import candidates, postings, text_key, trigram_query


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern` whose `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def either_case(*words: str) -> str:
    """An alternation of ASCII words in which each letter may stand in either case."""
    return "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in words)


_KEYS = either_case("password", "passwd", "secret", "token", "api_?key")

BASE_RULES = (
    Rule("assign", rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Runs of this class of 24 or more characters are the maximal runs that are long enough.
    Rule("hex", r"[0-9a-f]{24,}"),
)

#: Forms of well-known credentials beside the base rules.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url", r"://[^/:@\x00-\x20]+:[^/:@\x00-\x20]+@"),
)

RULES = BASE_RULES + MORE_RULES

#: What follows a key's BEGIN line: its headers, and then either base64 and white space up to the END
#: line, or, where no END follows, lines of at least 16 characters that are base64 and not plain
#: words, with a shorter one as the last. Repeats are possessive, so time is linear and long keys need
#: no deep stack.
_LINE_END = r"[ \t\r]*+\n[ \t]*+"
_NO_WORD = r"(?=[A-Za-z]*+[0-9+/=])"
_KEY_BODY = (
    rf"(?:{_LINE_END}Proc-Type:[^\n]*+{_LINE_END}DEK-Info:[^\n]*+(?:{_LINE_END})?+)?+"
    r"(?:[A-Za-z0-9+/=\s\\]*+-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{_LINE_END}{_NO_WORD}[A-Za-z0-9+/]{{16,}}+=*+(?=\s|\Z))++"
    rf"(?:{_LINE_END}{_NO_WORD}[A-Za-z0-9+/]{{1,15}}+=*+(?=[ \t\r]*(?:\n|\Z)))?+)?+"
)
#: The rules by which texts are cleaned: of a private key not only the BEGIN line goes.
CLEAN_RULES = tuple(
    replace(r, pattern=r.pattern + _KEY_BODY) if r.kind == "pem" else r for r in RULES
)

SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
_STEP = 256


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """`docs` with a column `spans`: (start, rank, end, kind) by start, then by the rules' order.

    Positions are code points, the end is exclusive. Each rule's regular expression yields a Boolean
    trigram query; posting lists of a block-partitioned inverted index are intersected, and only the
    texts that remain are matched against the expression. Rules without a mandatory trigram (runs of
    hexadecimal digits) are matched against every text. Null and empty texts have no spans; every row
    is kept, repeated ones too; an empty table gives none. A column named `spans` is replaced.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {kind: query for kind, query in queries.items() if query is not None}
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.drop("spans")
    allowed = F.array().cast("array<string>")
    if indexed:
        scratch = Scratch(docs.sparkSession, "secrets")
        named = sorted({t for query in indexed.values() for clause in query for t in clause})
        index = scratch.keep(postings(docs, text_col, named), "postings")
        # Written, so that the join can split a text with many copies, and broadcast a short list.
        hits = scratch.keep(
            candidates(index, indexed).select(
                F.col("key").alias("_key"), F.array_join("rules", " ").alias("_rules")
            ),
            "hits",
        )
        scratch.drop(index)
        found = found.withColumn("_own_key", text_key(text))
        found = found.join(hits, F.col("_own_key") == F.col("_key"), "left").drop("_own_key", "_key")
        allowed = F.coalesce(F.split("_rules", " "), allowed)
    else:
        found = found.withColumn("_rules", allowed)
    # Rules are applied one after another; a column is read twice wherever it must not be inlined.
    for rank, rule in enumerate(rules):
        wanted = F.lit(True) if queries[rule.kind] is None else F.array_contains(allowed, rule.kind)
        found = _apply(found, text, rule, rank, wanted)
    spans = F.array_sort(F.concat(*[F.col(f"_spans{k}") for k in range(len(rules))]))
    found = found.withColumn("spans", spans)
    return found.drop("_rules", *[f"_spans{k}" for k in range(len(rules))])


def _apply(df: DataFrame, text: Column, rule: Rule, rank: int, wanted: Column) -> DataFrame:
    pattern = F.lit(rule.pattern)
    hit = wanted & F.regexp_like(text, pattern)
    size = F.size
    lengths = lambda a: F.transform(a, F.length)
    df = df.withColumn("_hit", hit)
    df = df.withColumn(
        "_parts",
        F.when(
            F.col("_hit"),
            F.struct(
                lengths(F.split(text, rule.pattern, -1)).alias("gaps"),
                lengths(F.regexp_extract_all(text, pattern, F.lit(0))).alias("whole"),
                lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("part"),
            ),
        ),
    )
    # Exclusive prefix sums of gap + match, in blocks of 256, so that long lists stay linear.
    gaps, whole, part = F.col("_parts.gaps"), F.col("_parts.whole"), F.col("_parts.part")
    df = df.withColumn(
        "_steps", F.zip_with(F.slice(gaps, F.lit(1), size(whole)), whole, lambda g, m: g + m)
    )
    steps = F.col("_steps")
    add = lambda a, b: a + b
    zero = F.lit(0)
    blocks = F.sequence(zero, F.floor((size(steps) - 1) / _STEP).cast("int"))
    df = df.withColumn(
        "_sums",
        F.when(
            size(steps) > 0,
            F.transform(
                blocks,
                lambda b: F.aggregate(F.slice(steps, b * _STEP + 1, F.lit(_STEP)), zero, add),
            ),
        ),
    )
    sums = F.col("_sums")
    df = df.withColumn(
        "_before",
        F.when(
            size(sums) > 0,
            F.transform(
                F.sequence(zero, size(sums) - 1),
                lambda b: F.aggregate(F.slice(sums, F.lit(1), b), zero, add),
            ),
        ),
    )

    def span(k: Column) -> Column:
        block = F.floor(k / _STEP).cast("int")
        within = F.slice(steps, block * _STEP + 1, k - block * _STEP)
        start = F.get(F.col("_before"), block) + F.aggregate(within, zero, add) + F.get(gaps, k)
        return F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            (start + F.get(whole, k)).alias("end"),
            F.lit(rule.kind).alias("kind"),
        )

    places = F.filter(
        F.sequence(zero, size(whole) - 1), lambda k: F.get(part, k) >= F.lit(rule.least)
    )
    spans = F.when((size(whole) > 0) & (size(F.col("_before")) > 0), F.transform(places, span))
    df = df.withColumn(f"_spans{rank}", F.coalesce(spans, F.array().cast(SPAN)))
    return df.drop("_hit", "_parts", "_steps", "_sums", "_before")


def spans_text(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with each maximal run of overlapping spans replaced by `mark`; `spans` is dropped."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"),
        )

    done = F.aggregate(
        "spans", start, step, lambda a: F.concat(a["out"], text.substr(a["at"] + 1, F.length(text)))
    )
    clean = F.when(F.size("spans") == 0, F.col(text_col)).otherwise(done)
    return docs.withColumn(text_col, clean).drop("spans")


def clean_secrets(
    docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars"
) -> DataFrame:
    """All rows and columns of `docs`, secrets replaced; `size_col` follows texts that changed.

    A private key goes with its body and its END line (`CLEAN_RULES`).
    """
    renamed, own = shielded(docs)
    found = find_secrets(renamed, CLEAN_RULES, own[text_col])
    found = found.withColumn("_dirty", F.size("spans") > 0)
    clean = redact(found, own[text_col])
    if size_col in own:
        kind = docs.schema[size_col].dataType
        size = F.when(F.col("_dirty"), F.length(own[text_col]).cast(kind))
        clean = clean.withColumn(own[size_col], size.otherwise(F.col(own[size_col])))
    return restored(clean, own)
