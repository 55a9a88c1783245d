"""Exact dedup, SimHash near-dedup, line dedup and connected components against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chronofeat.llm.common import repeat_rows
from chronofeat.llm.components import components
from chronofeat.llm import digest_index
from chronofeat.llm.digest_index import DigestIndex
from chronofeat.llm import lines as lines_module
from chronofeat.llm.lines import (
    SHINGLE,
    band_keys,
    drop_repeated_lines,
    line_components,
    shingle_hashes,
)
from chronofeat.llm.simhash import compare, fingerprint, keep_one, near_duplicates

DOCS = "doc_id long, text string, kept string, fp string, _digest string, text_sha256 string"


def docs_of(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], DOCS)


ODD = [
    (1, "same text"),
    (2, "same text"),
    (2, "same text"),
    (None, "same text"),
    (3, None),
    (4, ""),
    (None, "alone"),
    (5, "long " * 40_000),
]


def union_find(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    path = [(i, i + 1) for i in range(100, 140)]
    pairs = path + [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(200, 200)]
    got = components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    real = [(a, b) for a, b in pairs if a != b]
    assert dict(map(tuple, got)) == union_find(real, linked)
    assert len(got) == len(linked)


def test_no_links_give_no_components(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_exact_verdicts_on_odd_rows(spark):
    got = sorted(map(tuple, DigestIndex(spark).verdicts(docs_of(spark, ODD)).collect()), key=repr)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    same, empty = sha("same text"), sha("")
    wanted = [
        (1, 2, 4, False, same),
        (2, 2, 4, True, same),
        (2, 2, 4, False, same),
        (None, 2, 4, False, same),
        (3, 4, 2, False, empty),
        (4, 4, 2, True, empty),
        (None, None, 1, True, sha("alone")),
        (5, 5, 1, True, sha("long " * 40_000)),
    ]
    assert got == sorted(wanted, key=repr)


def test_index_persists_and_repeats_safely(spark):
    index = DigestIndex(spark, buckets=4)
    index.verdicts(docs_of(spark, [(1, "a"), (2, "b")]))
    opened = DigestIndex(spark, index.path, buckets=4)
    later = docs_of(spark, [(3, "a"), (4, "c"), (2, "b")])
    once = sorted((r.doc_id, r.keep_id, r.kept) for r in opened.verdicts(later).collect())
    again = sorted((r.doc_id, r.keep_id, r.kept) for r in opened.verdicts(later).collect())
    assert once == again == [(2, 2, True), (3, 1, False), (4, 4, True)]
    assert opened.read().count() == 3
    assert sorted(opened.compact().read().select("keep_id").collect()) == [(1,), (2,), (4,)]


def test_buckets_are_stored_and_two_writers_do_no_harm(spark, monkeypatch):
    monkeypatch.setattr(digest_index, "BUCKET_ROWS", 1)
    index = DigestIndex(spark)
    index.verdicts(docs_of(spark, [(k, f"text {k}") for k in range(300)])).collect()
    assert index.buckets == 512
    opened = DigestIndex(spark, index.path)
    assert opened.buckets == 512
    held = opened.read().where("keep_id < 5").select("digest", "keep_id")
    held.repartition(512, "digest").write.insertInto(opened.table)  # a second writer's batch
    spark.catalog.refreshTable(opened.table)
    judged = opened.verdicts(docs_of(spark, [(3, "text 3"), (900, "text 3")])).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in judged) == [(3, 3, True), (900, 3, False)]
    smaller = opened.compact()
    assert smaller.read().count() == 300 and smaller.buckets == 512
    later = opened.verdicts(docs_of(spark, [(1000, "new")]))
    opened.close()
    assert not spark.catalog.tableExists(opened.table)
    assert [r.kept for r in later.collect()] == [True]  # readable without the table's name


def test_index_side_of_the_anti_join_is_not_shuffled(spark):
    index = DigestIndex(spark, buckets=4)
    new = spark.createDataFrame([(bytearray(b"x"), 1)], "digest binary, keep_id long")
    new = new.repartition(4, "digest")
    joined = new.join(index.read().select("digest").hint("merge"), "digest", "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_keep_new_returns_whole_rows_once(spark):
    docs = docs_of(spark, ODD)
    kept = DigestIndex(spark).keep_new(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.kept, r.text_sha256) for r in kept.collect()), key=repr)
    assert got == sorted([(2, "x", "w"), (4, "x", "w"), (5, "x", "w"), (None, "x", "w")], key=repr)


@pytest.mark.parametrize("operator", ["exact", "near", "lines"])
def test_empty_tables(spark, operator):
    docs = docs_of(spark, [])
    found = {
        "exact": lambda: DigestIndex(spark).verdicts(docs),
        "near": lambda: near_duplicates(docs),
        "lines": lambda: line_components(docs),
    }[operator]()
    assert found.count() == 0


def test_repeat_rows_in_blocks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 9000)], "k string, n long")
    got = repeat_rows(df, "n", "i").groupBy("k").agg(F.count("i"), F.min("i"), F.max("i")).collect()
    assert sorted(map(tuple, got)) == [("a", 1, 0, 0), ("b", 9000, 0, 8999)]


def slow_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize(
    "text", ["", " \t\x0b", "One", "É Ä one two", "a b c d", "a b a b a b a b", "x y z " * 9000]
)
def test_fingerprint_is_the_majority_of_all_shingles(text):
    assert fingerprint(text) % 2**64 == slow_fingerprint(text)


def test_dense_tiles_keep_connectivity():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 3, dtype=np.uint64)
    near = [b ^ np.uint64(1 << int(k)) for b in base for k in rng.integers(0, 64, 60)]
    tile = np.unique(np.array(near, np.uint64))
    found = {(int(x), int(y)) for a, b in compare(tile, tile, 4) for x, y in zip(a, b, strict=True)}
    every = [
        (int(x), int(y)) for x in tile for y in tile if bin(int(x) ^ int(y)).count("1") <= 4
    ]
    nodes = [int(x) for x in tile]
    assert union_find(found, nodes) == union_find(every, nodes)
    assert len(found) < len(every)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(60):
        text = [rng.choice(words) for _ in range(rng.choice((3, 40, 400)))]
        for _ in range(rng.choice((1, 1, 3))):
            rows.append((len(rows), " ".join(text)))
            text[rng.randrange(len(text))] = rng.choice(words)
    rows += [(1000, None), (1001, ""), (1000, None)]
    got = near_duplicates(docs_of(spark, rows)).collect()
    prints = {d: slow_fingerprint(t or "") for d, t in rows}
    pairs = [
        (a, b) for a in prints for b in prints if bin(prints[a] ^ prints[b]).count("1") <= 4
    ]
    wanted = union_find(pairs, list(prints))
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == wanted
    assert {r.doc_id for r in got if r.kept} == set(wanted.values())


def test_keep_one_returns_whole_rows(spark):
    docs = docs_of(spark, ODD)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.fp) for r in kept.collect()), key=repr)
    assert got == sorted([(1, "y"), (3, "y"), (5, "y"), (None, "y")], key=repr)


def slow_lines(rows):
    """Kept line and size of each line's component, from all pairs."""
    places = {}
    for doc, text in rows:
        for number, line in enumerate((text or "").split("\n")):
            line = line.strip(" ").lower()
            if re.search(r"[^\x20\x09-\x0D]", line):
                places.setdefault(line, []).append((doc, number))
    sets = {
        n: {n[i : i + SHINGLE] for i in range(len(n) - SHINGLE + 1)} or {n} for n in places
    }
    pairs = [
        (a, b)
        for a in sets
        for b in sets
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    root = union_find(pairs, list(sets))
    groups = {}
    for line, own in places.items():
        groups.setdefault(root[line], []).extend(own)
    return {
        p: (*min(groups[root[line]]), len(groups[root[line]]))
        for line, own in places.items()
        for p in own
    }


def test_lines_equal_brute_force(spark):
    rng = random.Random(4)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda".split()
    lines = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(30)]
    lines += ["short line", "Short line ", "漢字" * 30, "漢字" * 30 + "字", "q" * 3000]
    rows = []
    for doc in range(40):
        own = [rng.choice(lines) for _ in range(4)]
        own[0] = own[0].replace("gamma", "GAMMA!", 1)
        rows.append((doc, "\n".join([*own, "", "  "])))
    rows += [(50, None), (51, "")]
    got = line_components(docs_of(spark, rows)).collect()
    found = {
        (r.doc_id, r.line_no): (r.keep_doc_id, r.keep_line_no, r.copies) for r in got
    }
    assert found == slow_lines(rows)
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.keep_doc_id, r.keep_line_no)) for r in got)


def test_lines_of_long_tokens_equal_brute_force(spark):
    rng = random.Random(106)
    rows = []
    for doc in range(300):
        sizes = [70] + [4] * 9 if doc < 150 else rng.choices((22, 23, 24), k=rng.randrange(8, 17))
        words = ["".join(rng.choice("abcdefghijklmnop0123") for _ in range(n)) for n in sizes]
        line = " ".join(words)
        near = line + "z" if doc % 2 else line.rsplit(" ", 1)[0]
        rows.append((doc, f"{line}\n{near}"))
    got = line_components(docs_of(spark, rows)).collect()
    found = {(r.doc_id, r.line_no): (r.keep_doc_id, r.keep_line_no, r.copies) for r in got}
    wanted = slow_lines(rows)
    assert found == wanted
    assert any(copies == 2 for _, _, copies in wanted.values())


def test_shingle_hashes_and_keys():
    rng = random.Random(7)
    lines = ["", "short", "x" * 11, "x" * 12, "漢字é😀" * 9]
    lines += ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 90))) for _ in range(200)]
    hashes, counts = shingle_hashes(lines)
    of = {}
    at = 0
    for line, n in zip(lines, counts.tolist(), strict=True):
        assert n == max(0, len(line) - SHINGLE + 1)
        for i in range(n):
            assert of.setdefault(line[i : i + SHINGLE], hashes[at + i]) == hashes[at + i]
        at += n
    assert at == len(hashes) and len(set(of.values())) == len(of)
    keys = band_keys(lines)
    assert [len(k) > 0 for k in keys] == [n > 0 for n in counts]
    assert len(keys[3]) == 1 and max(map(len, keys)) <= 8
    again = band_keys(lines[::-1])[::-1]  # a line's keys do not depend on its neighbours
    assert all((a == b).all() for a, b in zip(keys, again, strict=True))


def test_a_bucket_of_many_unlike_lines(spark):
    """Lines that share a long passage and no more, in one bucket: all pairs across it are tried."""
    rng = random.Random(12)
    passage = "a passage that many lines share, word for word, and that holds the smallest hashes "
    tail = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    rows = [(k, passage + tail(60)) for k in range(600)]
    rows += [(600 + k, rows[k][1] + "z") for k in range(0, 600, 60)]
    got = line_components(docs_of(spark, rows)).collect()
    found = {(r.doc_id, r.line_no): (r.keep_doc_id, r.keep_line_no, r.copies) for r in got}
    assert found == slow_lines(rows)


def test_components_of_a_bucket_meet_in_chunks(spark, monkeypatch):
    """Whatever the chunks, all nodes that similar lines connect are connected, and no others."""
    monkeypatch.setattr(lines_module, "CHUNK", 3)
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(80)) for _ in range(6)]
    texts = [rng.choice(base)[: rng.randint(66, 80)] for _ in range(40)]
    texts = list(dict.fromkeys(texts))
    rows = [(key, n, n) for key in (1, 2) for n in range(len(texts))]
    rooted = spark.createDataFrame(rows, "key long, node long, root long")
    named = spark.createDataFrame(list(enumerate(texts)), "node long, norm string")
    got = [tuple(r) for r in lines_module._linked_across(rooted, named).collect()]
    sets = [lines_module.shingles(t) for t in texts]
    n = range(len(texts))
    pairs = [(a, b) for a in n for b in n if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert pairs and set(got) <= set(pairs)
    assert union_find(got, list(n)) == union_find(pairs, list(n))


def test_documents_without_repeated_lines(spark):
    rows = [(1, "keep me once\nfirst own"), (2, "second own\n\nkeep me once"), (3, None)]
    got = {r.doc_id: r.text for r in drop_repeated_lines(docs_of(spark, rows)).collect()}
    assert got == {1: "keep me once\nfirst own", 2: "second own\n", 3: None}


def test_lines_run_without_python(spark, monkeypatch):
    """Signatures, prints and verification are DataFrame operations only."""

    def refuse(*args, **kwargs):
        raise AssertionError("Python on the executors")

    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(docs_of(spark, [])), name, refuse)
    text = "a line that is long enough to have quite a few shingles"
    got = line_components(docs_of(spark, [(1, text), (2, text + "s"), (3, "short")])).collect()
    assert {r.doc_id: (r.keep_doc_id, r.copies) for r in got} == {1: (1, 2), 2: (1, 2), 3: (3, 1)}


def test_similar_lines_share_a_bucket_and_pass_the_prints(spark):
    rng = random.Random(31)
    letters = "abcdefghijklmnopqrstuvwxyz éあ😀"
    rows, similar = [], []
    for k in range(400):
        line = "".join(rng.choice(letters) for _ in range(rng.choice((12, 20, 60, 300, 3000))))
        near = line + "".join(rng.choice(letters) for _ in range(rng.randint(1, 1 + len(line) // 5)))
        x, y = lines_module.shingles(line), lines_module.shingles(near)
        if len(x & y) >= 0.8 * len(x | y):
            similar.append((2 * k, 2 * k + 1))
        rows += [(2 * k, line), (2 * k + 1, near)]
    named = spark.createDataFrame(rows, "node long, norm string")
    keys = {}
    for r in lines_module._buckets(named).collect():
        keys.setdefault(r.node, set()).add(r.key)
    assert len(similar) > 150 and all(keys[a] & keys[b] for a, b in similar)
    pairs = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(400)], "a long, b long")
    possible = lines_module._possible(pairs, lines_module._prints(named))
    found = {(r.a, r.b): r.sizes for r in possible.collect()}
    assert set(similar) <= set(found) and len(found) < 400
    sets = [lines_module.shingles(line) for _, line in rows]
    assert all(n == len(sets[a]) + len(sets[b]) for (a, b), n in found.items())
    verified = lines_module._verified(possible, named).collect()
    assert sorted((r.a, r.b) for r in verified) == similar
