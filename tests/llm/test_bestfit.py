from __future__ import annotations

import bisect
import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeward.llm import bestfit
from lakeward.llm.queries import QUERIES
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def tokenizer():
    out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out.encode_special_tokens = True
    return out


def cut(n, context=bestfit.CONTEXT):
    """Lengths of the pieces of a document of n tokens: what is left over first."""
    first = (n - 1) % context + 1
    return [first, *[context] * ((n - first) // context)]


def plain(lengths, context):
    """Sequences used by best fit, item by item, from the longest."""
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        if at < len(gaps):
            gap = gaps.pop(at)
        else:
            gap, n = context, n + 1
        bisect.insort(gaps, gap - length)
    return n


def filled(counts, context):
    """The sequences of a plan, each checked to be gapless and not too long."""
    places = bestfit.Places(bestfit.plan(counts, context))
    sequences = {}
    for length, n in counts.items():
        if n:
            at, offset = places.of(np.full(n, length), np.arange(n))
            for a, o in zip(at.tolist(), offset.tolist(), strict=True):
                sequences.setdefault(a, []).append((o, length))
    for items in sequences.values():
        items.sort()
        ends = list(itertools.accumulate(n for _, n in items))
        assert [o for o, _ in items] == [0, *ends[:-1]] and ends[-1] <= context
    assert sum(map(len, sequences.values())) == sum(counts.values())
    return list(sequences.values())


@settings(max_examples=400, deadline=None)
@given(st.sampled_from([7, 10, 16, 30, 1024]), st.dictionaries(st.integers(1, 1024), st.integers(0, 30), max_size=12))
def test_plan_needs_no_more_than_best_fit_of_items(context, counts):
    own: dict[int, int] = {}
    for length, n in counts.items():
        own[(length - 1) % context + 1] = n
    items = [n for n, c in own.items() for _ in range(c)]
    found = filled(own, context)
    assert len(found) <= plain(items, context)


def most_pairs(items, context):
    """The most pairs that fit, by trying all."""
    if len(items) < 2:
        return 0
    first, rest = items[0], items[1:]
    best = most_pairs(rest, context)
    for i, other in enumerate(rest):
        if first + other <= context:
            best = max(best, 1 + most_pairs(rest[:i] + rest[i + 1 :], context))
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(11, 30), max_size=8))
def test_large_items_form_the_most_pairs(items):
    counts = {n: items.count(n) for n in items}
    found = filled(counts, 30)
    assert sum(len(s) == 2 for s in found) == most_pairs(items, 30) and all(len(s) <= 2 for s in found)


def test_the_plan_does_not_grow_with_the_counts():
    few, many = ({n: c for n in range(1, 1025)} for c in (3, 10**9))
    assert len(bestfit.plan(many)) < 4 * 1024 and len(bestfit.plan(few)) < 4 * 1024


def check(rows, docs, tokenizer):
    by_sequence, by_doc, texts = {}, {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for spans in by_sequence.values():
        spans.sort()
        ends = list(itertools.accumulate(n for _, n in spans))
        assert [o for o, _ in spans] == [0, *ends[:-1]] and ends[-1] <= bestfit.CONTEXT
    for doc_id, text in docs:
        texts.setdefault(doc_id, []).append([*tokenizer.encode(text or "", add_special_tokens=False).ids, bestfit.END])
    want, total = {}, 0
    for doc_id, copies in texts.items():
        for ids in copies:
            at = 0
            total += len(ids)
            for piece, length in enumerate(cut(len(ids))):
                data = np.array(ids[at : at + length], "<u4").tobytes()
                want.setdefault(doc_id, []).append((piece, at, length, zlib.crc32(data)))
                at += length
    assert {d: sorted(p) for d, p in by_doc.items()} == {d: sorted(p) for d, p in want.items()}
    return len(by_sequence), -(-total // bestfit.CONTEXT)


def test_whole_table_round_trip(spark, documents, tokenizer):
    rows = QUERIES["op11_best_fit"](spark, SF_DIR).collect()
    used, least = check(rows, documents, tokenizer)
    assert used <= least + 2
    assert used <= plain([r["length"] for r in rows], bestfit.CONTEXT)


def test_odd_rows(spark, make_docs, tokenizer):
    rows = [(1, None), (2, ""), (3, "a <|endoftext|> b"), (4, "x" * 30_000), (5, "word " * 20_000), (None, "one"), (7, "two"), (7, "two"), (7, None), (None, "one")]
    docs = make_docs(rows)
    clash = docs.withColumn("piece", docs.lang).withColumn("length", docs.lang).withColumn("part", docs.lang)
    check(bestfit.best_fit(clash).collect(), rows, tokenizer)
    assert bestfit.best_fit(docs.where("false")).collect() == []


def test_many_equal_rows_in_many_tasks(spark, make_docs, tokenizer):
    rows = [(i, "the same text") for i in range(3000)]
    used, least = check(bestfit.best_fit(make_docs(rows).repartition(13)).collect(), rows, tokenizer)
    length = len(tokenizer.encode("the same text", add_special_tokens=False).ids) + 1
    assert used == -(-3000 // (bestfit.CONTEXT // length)) and used >= least
