import uuid

import pytest

from cartcast.llm import rollups
from cartcast.session import scratch_path


@pytest.fixture
def rollup(llm):
    return rollups.Rollup(llm, scratch_path(llm, f"rollup-{uuid.uuid4().hex}"))


def totals(r):
    return {(x["source"], x["lang"], x["version"]): (x["n_docs"], x["n_tokens"], x["n_chars"]) for x in r.totals().collect()}


def test_signed_batches_and_idempotent_commits(rollup, make):
    docs = rollups.measured(make([(0, "a b c"), (1, "d e"), (2, None), (3, "x1 y2")]))  # sources src0, src1, src2, src0
    assert rollup.commit("b1", rollups.inserts(docs, "words-1"))
    first = totals(rollup)
    assert first == {("src0", "en", "words-1"): (2, 5, 10), ("src1", "en", "words-1"): (1, 2, 3),
                     ("src2", "en", "words-1"): (1, 0, 0)}
    assert not rollup.commit("b1", rollups.inserts(docs, "words-1")) and totals(rollup) == first
    rollup.commit("b2", rollups.deletes(docs.filter("doc_id = 1"), "words-1"))
    rollup.commit("b3", rollups.revisions(docs.filter("doc_id = 3"), "words-1", "letters-1"))
    want = {("src0", "en", "words-1"): (1, 3, 5), ("src0", "en", "letters-1"): (1, 2, 5), ("src2", "en", "words-1"): (1, 0, 0)}
    assert totals(rollup) == want
    small = rollup.compact(rollup.path + "-compact")
    assert totals(small) == want
    assert not small.commit("b2", rollups.deletes(docs, "words-1")) and totals(small) == want


def test_a_write_that_died_is_not_counted(rollup, make):
    docs = rollups.measured(make([(0, "a b")]))
    rollup.commit("b1", rollups.inserts(docs, "words-1"))
    jvm, root, fs = rollup._files()
    fs.delete(jvm.org.apache.hadoop.fs.Path(root, "batch=b1/_SUCCESS"), False)
    assert rollup.committed() == [] and totals(rollup) == {}
    assert rollup.commit("b1", rollups.inserts(docs, "words-1"))
    assert totals(rollup) == {("src0", "en", "words-1"): (1, 2, 3)}


def test_edge_cases(rollup, make, llm):
    docs = llm.createDataFrame([(None, None, None, None), (1, "a", None, None), (1, "a", None, None)],
                               "doc_id long, text string, source string, lang string")
    marked = rollups.marked_copies(rollups.measured(docs)).collect()
    assert len(marked) == 3 and not any(r["is_copy"] for r in marked)
    docs = rollups.measured(docs)
    assert totals(rollup) == {}
    assert rollup.commit("empty", rollups.inserts(docs.limit(0), "words-1")) and totals(rollup) == {}
    rollup.commit("b1", rollups.inserts(docs, "words-1"))
    assert totals(rollup) == {(None, None, "words-1"): (3, 2, 2)}
    with pytest.raises(ValueError):
        rollup.commit("../x", rollups.inserts(docs, "words-1"))


def test_copies_are_marked_after_the_first(make):
    rows = make([(5, "same"), (3, "same"), (9, "same"), (1, "other"), (None, "same"), (4, None), (2, "")])
    got = {r["doc_id"]: r["is_copy"] for r in rollups.marked_copies(rollups.measured(rows)).collect()}
    assert got == {5: True, 3: False, 9: True, 1: False, None: False, 4: True, 2: False}


def test_copies_of_a_hot_text_equal_brute_force(make, rollup):
    rows = [(i * 7 % 500, "hot") for i in range(300)] + [(i, f"t{i % 40}") for i in range(500, 700)]
    rows += [(None, "t1"), (None, "hot"), (600, "hot"), (9, None), (8, "")]
    least = {}
    for d, t in rows:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    want = sorted((str(d), d is not None and d > least[t or ""]) for d, t in rows)
    marked = rollups.marked_copies(rollups.measured(make(rows)))
    assert sorted((str(r["doc_id"]), r["is_copy"]) for r in marked.collect()) == want
    assert rollups.marked_copies(rollups.measured(make(rows).limit(0))).count() == 0


def test_a_very_long_text_is_counted_whole(make, rollup):
    docs = rollups.measured(make([(1, "ab1 cd\n" * 300_000)]))
    rollup.commit("b", rollups.inserts(docs, "words-1"))
    rollup.commit("c", rollups.inserts(docs, "letters-1"))
    assert totals(rollup) == {("src0", "en", v): (1, 600_000, 2_100_000) for v in ("words-1", "letters-1")}
