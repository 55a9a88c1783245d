"""The pipeline against a brute-force version of its stages on the smallest tables."""

from __future__ import annotations

import array
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from chronofeat.llm.packing import cut_pieces
from chronofeat.llm.rules import judge, learn
from chronofeat.llm.secrets import RULES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_print(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams if g]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_clean(text):
    spans = sorted(
        m.span()
        for rule in RULES
        for m in re.finditer(rule.pattern, text)
        if len(m[rule.group]) >= rule.least
    )
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rules = learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = judge(docs, rules).where("kept").select("doc_id", "text").collect()
    by_text = {}
    for r in good:
        by_text[r.text] = max(r.doc_id, by_text.get(r.text, r.doc_id))
    left = {d: t for t, d in by_text.items()}
    prints = {d: slow_print(t) for d, t in left.items()}
    root = {d: d for d in left}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in left:
        for b in left:
            if bin(prints[a] ^ prints[b]).count("1") <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    left = {d: slow_clean(t) for d, t in left.items() if find(d) == d}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    wanted = set()
    for d, t in left.items():
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        for piece, (at, n) in enumerate(cut_pieces(len(ids), 1024)):
            wanted.add((d, piece, at, n, zlib.crc32(array.array("I", ids[at : at + n]).tobytes())))

    got = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == wanted
    assert len(got) == len(wanted)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        ends = [0, *[o + n for o, n in sorted(parts)]]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 1024


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Documents with nulls, ties, repeated rows, a very long text and clashing columns."""
    text = " ".join(f"word{i}" for i in range(200))
    secret = text + " token = abcdefghijk"
    rows = [
        (1, text), (2, text), (2, text), (None, text), (3, None), (4, ""), (None, None),
        (5, secret), (6, " ".join(f"long{i}" for i in range(60_000))), (None, text[::-1]),
    ]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, "
        "kept string, spans string, _digest string, _rules string, n_words string, fp string"
    )
    rows = [(d, t, None, "s", None, *"abcdef") for d, t in rows]
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_on_odd_rows(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage_table(stage(spark, docs, odd), name)
        if name != "best_fit_packing":
            assert docs.columns == columns
            assert docs.where("kept = 'a' and spans = 'b' and fp = 'f'").count() == docs.count()
        sizes.append(docs.select("doc_id").distinct().count())
    assert sizes[0] == 5  # null and empty texts are too short
    assert Counter(r.doc_id for r in docs.where("piece = 0").collect())[2] <= 1


def test_stages_on_no_rows(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage_table(stage(spark, docs, odd), name)
        assert docs.count() == 0


def test_exact_stage_keeps_the_largest_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)["exact_dedup"](spark, docs, SF)
    best = {}
    for r in docs.collect():
        key = hashlib.sha256((r.text or "").encode()).digest()
        best[key] = max(r.doc_id, best.get(key, r.doc_id))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(best.values())
