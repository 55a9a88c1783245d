"""Boolean trigram queries from regular expressions, and an inverted index that answers them."""

from __future__ import annotations

import re._parser as regex_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A clause is a set of trigrams that must all occur; a query is a list of alternative clauses.
Clause = frozenset[str]

#: Exact strings are followed up to this many at once; beyond it a query only gets weaker.
MAX_STRINGS = 64

#: Distinct texts per block of the index, about; bounds every posting list.
BLOCK = 16_384


def trigram_query(pattern: str) -> list[Clause] | None:
    """Clauses one of which any matching text satisfies, in lower case; None: no trigram is mandatory."""
    exact, query = _sequence(regex_parser.parse(pattern))
    if exact is not None:
        query = _grams(exact)
    if any(not clause for clause in query):
        return None
    return [c for c in query if not any(other < c for other in query)]


def _grams(strings: set[str]) -> list[Clause]:
    clauses = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings)]
    return [frozenset()] if not all(clauses) else clauses


def _both(left: list[Clause], right: list[Clause]) -> list[Clause]:
    if len(left) * len(right) > MAX_STRINGS:
        return left
    return list(dict.fromkeys(a | b for a in left for b in right))


def _sequence(items) -> tuple[set[str] | None, list[Clause]]:
    """Either all strings that the items match, or the clauses they demand."""
    strings, query, whole = {""}, [frozenset()], True
    for op, argument in items:
        exact, demand = _item(str(op), argument)
        if exact is not None and len(strings) * len(exact) <= MAX_STRINGS:
            strings = {a + b for a in strings for b in exact}
        else:
            query, whole = _both(_both(query, _grams(strings)), demand), False
            strings = exact if exact is not None and len(exact) <= MAX_STRINGS else {""}
    if whole:
        return strings, []
    return None, _both(query, _grams(strings))


def _item(op: str, argument) -> tuple[set[str] | None, list[Clause]]:
    anything = [frozenset()]
    if op == "LITERAL":
        return {chr(argument).lower()}, anything
    if op == "IN":
        if all(str(kind) == "LITERAL" for kind, _ in argument):
            return {chr(value).lower() for _, value in argument}, anything
    if op == "SUBPATTERN":
        exact, query = _sequence(argument[3])
        return exact, query or anything
    if op == "BRANCH":
        found = [_sequence(branch) for branch in argument[1]]
        if all(exact is not None for exact, _ in found):
            return set().union(*(exact for exact, _ in found)), anything
        return None, [c for exact, q in found for c in (q if exact is None else _grams(exact))]
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, body = argument
        exact, query = _sequence(body)
        if exact is not None and (low, high) in ((0, 1), (1, 1)):
            return exact | ({""} if low == 0 else set()), anything
        if low >= 1:
            return None, query if exact is None else _grams(exact)
    return None, anything


def text_key(text: Column) -> Column:
    """Posting entries name texts by this hash; texts that share it only become candidates together."""
    return F.xxhash64(text)


def postings(docs: DataFrame, text_col: str, trigrams: list[str]) -> DataFrame:
    """The inverted index: (block, trigram, keys), for the trigrams that the queries name.

    Texts are spread over blocks by their key, so a list holds about `BLOCK` keys at most, however
    common its trigram is. Copies of a text collapse before the shuffle.
    """
    blocks = max(1, -(-docs.count() // BLOCK))
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    present = F.array_compact(
        F.array(*[F.when(F.contains(F.col("_lower"), F.lit(t)), F.lit(t)) for t in trigrams])
    )
    entries = docs.select(
        text_key(F.coalesce(F.col(text_col), F.lit(""))).alias("key"), text.alias("_lower")
    )
    entries = entries.select("key", F.explode(present).alias("trigram"))
    entries = entries.withColumn("block", F.pmod("key", F.lit(blocks)))
    return entries.groupBy("block", "trigram").agg(F.collect_set("key").alias("keys"))


def candidates(index: DataFrame, queries: dict[str, list[Clause]]) -> DataFrame:
    """(key, rules): the texts that satisfy each rule's query, by intersecting posting lists."""
    lists = index.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("lists")
    )
    none = F.array().cast("array<bigint>")

    def keys_of(trigram: str) -> Column:
        return F.coalesce(F.element_at("lists", F.lit(trigram)), none)

    def answer(query: list[Clause]) -> Column:
        found = none
        for clause in query:
            first, *rest = sorted(clause)
            hits = keys_of(first)
            for trigram in rest:
                hits = F.array_intersect(hits, keys_of(trigram))
            found = F.array_union(found, hits)
        return found

    found = None
    for rule, query in queries.items():
        hits = lists.select(F.explode(answer(query)).alias("key"), F.lit(rule).alias("rule"))
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy("key").agg(F.collect_set("rule").alias("rules"))
