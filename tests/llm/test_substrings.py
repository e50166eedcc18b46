from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeward.llm import substrings
from lakeward.llm.automaton import SuffixAutomaton
from lakeward.llm.queries import QUERIES
from tests.conftest import rows_of
from tests.llm import brute
from tests.llm.conftest import SF_DIR


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.text(alphabet="ab", max_size=12), st.integers(0, 9)), max_size=6),
    st.text(alphabet="abc", max_size=12),
    st.integers(1, 4),
)
def test_automaton_knows_the_first_document_of_each_window(references, text, width):
    automaton = SuffixAutomaton()
    for words, doc in references:
        automaton.add(words, doc)
    automaton.close()
    want = [
        min((d for w, d in references if text[i : i + width] in w), default=None) for i in range(len(text) - width + 1)
    ]
    assert automaton.least_documents(text, width) == want


def test_least_of_each():
    values = np.random.default_rng(1).integers(0, 99, 200)
    for width in (1, 2, 3, 26):
        assert substrings._least_of_each(values, width).tolist() == [min(values[i : i + width]) for i in range(201 - width)]


def passages(seed):
    """Documents of a small vocabulary with shared passages, some of which overlap or repeat in one document."""
    rng = random.Random(seed)
    make = lambda n: [rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(n)]
    shared = [make(rng.randint(45, 120)) for _ in range(4)]
    out = []
    for i in range(25):
        words = make(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            a = rng.randint(0, 40)
            words += passage[a : a + rng.randint(40, 120)] + make(rng.randint(0, 30))
        out.append((i * 3 % 25, rng.choice([" ", "  ", "\n"]).join(words)))
    return [*out, (4, out[3][1]), out[6], (None, out[2][1]), (90, None), (91, ""), (92, "same " * 400), (93, "same " * 300)]


def test_odd_rows_and_shared_passages(spark, make_docs):
    for seed in (1, 2):
        rows = passages(seed)
        assert rows_of(substrings.kept_digest(make_docs(rows))) == sorted(brute.kept(rows), key=repr)
    assert rows_of(substrings.kept_digest(make_docs(rows).where("false"))) == []


def test_tiles_of_a_hot_anchor(spark, make_docs, monkeypatch):
    monkeypatch.setattr(substrings, "TILE", 4)
    rng = random.Random(5)
    core = [str(rng.randint(0, 999)) for _ in range(55)]
    rows = [(i, " ".join([str(rng.randint(0, 9)) for _ in range(30)] + core + [str(rng.randint(0, 9))])) for i in range(30)]
    assert rows_of(substrings.kept_digest(make_docs(rows))) == sorted(brute.kept(rows), key=repr)


def test_whole_table_equals_brute_force(spark, documents):
    assert rows_of(QUERIES["op9_substring_dedup"](spark, SF_DIR)) == sorted(brute.kept(documents), key=repr)


def test_removal_keeps_rows_columns_and_untouched_white_space(spark, make_docs):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = make_docs([(1, "a  b\n" + passage), (2, f"c  {passage}\td"), (3, passage), (4, None)])
    clash = docs.withColumn("spans", docs.lang).withColumn("start", docs.n_chars)
    out = {r["doc_id"]: r for r in substrings.remove_repeats(clash).collect()}
    assert substrings.remove_repeats(clash).columns == clash.columns
    assert [out[i]["text"] for i in (1, 2, 3, 4)] == ["a  b\n" + passage, "c d", "", None]
    assert (out[2]["n_chars"], out[3]["n_chars"]) == (3, 0)
