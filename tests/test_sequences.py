import random

import pytest

from cartcast.operators.sequences import frequent_sequences


def contains(history, pattern):
    """history: list of (date, set) ascending; greedy earliest match."""
    i = 0
    for _, items in history:
        if i < len(pattern) and set(pattern[i]) <= items:
            i += 1
    return i == len(pattern)


def brute(rows, least, max_items):
    by = {}
    for e, d, x in rows:
        by.setdefault(e, {}).setdefault(d, set()).add(x)
    histories = [sorted(h.items()) for h in by.values()]
    items = sorted({x for _, _, x in rows})
    found, level = {}, [((x,),) for x in items]
    while level:
        keep = {}
        for p in set(level):
            n = sum(contains(h, p) for h in histories)
            if n >= least:
                keep[p] = n
        found.update(keep)
        level = []
        for p in keep:
            if max_items is None or sum(map(len, p)) < max_items:
                level += [(*p, (x,)) for x in items]
                level += [(*p[:-1], (*p[-1], x)) for x in items if x > p[-1][-1]]
    return found


def got(spark, rows, least, max_items=None):
    df = spark.createDataFrame([(e, d, x, "z") for e, d, x in rows], "who long, day int, thing string, sequence string")
    out = frequent_sequences(df, "who", "day", "thing", least, max_items).collect()
    found = {tuple(tuple(s) for s in r["sequence"]): r["freq"] for r in out}
    assert len(found) == len(out)
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(e, d, x) for e in range(25) for d in range(4) for x in "abcd" if rng.random() < 0.45]
    rows += rows[:10]
    want = brute(rows, 6, None)
    assert max(sum(map(len, p)) for p in want) >= 4
    assert got(spark, rows, 6) == want


def test_planted_patterns_of_five_items(spark):
    """Every history holds <(ab) c (de)> hidden in noise, on other dates."""
    rng = random.Random(3)
    rows = []
    for e in range(40):
        days = sorted(rng.sample(range(100), 5))
        for day, items in zip(days, ("n", "ab", "c", "m", "de")):
            rows += [(e, day, x) for x in items]
        rows.append((e, rng.randrange(100), f"noise{rng.randrange(300)}"))
    found = got(spark, rows, 40)
    assert found[(("a", "b"), ("c",), ("d", "e"))] == 40
    assert max(sum(map(len, p)) for p in found) == 7  # n, (ab), c, m, (de)
    assert got(spark, rows, 40, max_items=5) == {p: n for p, n in found.items() if sum(map(len, p)) <= 5}


def test_a_later_end_of_the_last_set_still_grows(spark):
    # b first ends on day 2, but (bc) only occurs on day 4
    rows = [(1, 1, "a"), (1, 2, "b"), (1, 4, "b"), (1, 4, "c"), (2, 1, "a"), (2, 3, "b"), (2, 3, "c")]
    assert got(spark, rows, 2)[(("a",), ("b", "c"))] == 2


def test_hot_history_nulls_and_empty(spark):
    rows = [(1, d, x) for d in range(300) for x in "ab"] + [(2, 0, "a"), (2, 1, "b"), (None, 0, "a"), (3, None, "a")]
    found = got(spark, rows, 2, max_items=2)
    assert found == {(("a",),): 2, (("b",),): 2, (("a",), ("b",)): 2}
    assert got(spark, [], 1) == {}
    with pytest.raises(ValueError):
        got(spark, rows, 0)


def test_packs_hold_whole_entities(spark, monkeypatch):
    """Entities of any length cross the packs' limit; nothing per pattern and
    entity is stored, whatever the number of levels."""
    from cartcast.operators import sequences as S
    rng = random.Random(5)
    rows = [(e, d, x) for e in range(40) for d in range(rng.randrange(1, 30)) for x in "abc" if rng.random() < 0.3]
    batches = list(S._packs(iter([S.pa.RecordBatch.from_pydict(
        {"start": [k % 7 == 0 for k in range(a, a + 10)], "t": [k % 7 for k in range(a, a + 10)], "i": [0] * 10})
        for a in range(0, 70, 10)])))
    assert len(batches) == 1 and S.np.frombuffer(batches[0]["e"][0].as_py(), "int32").max() == 9
    monkeypatch.setattr(S, "PART_ROWS", 12)
    packs = [S.np.frombuffer(b["e"][0].as_py(), "int32") for b in S._packs(iter([S.pa.RecordBatch.from_pydict(
        {"start": [k % 7 == 0 for k in range(a, a + 10)], "t": [k % 7 for k in range(a, a + 10)], "i": [0] * 10})
        for a in range(0, 70, 10)]))]
    assert len(packs) > 2 and all(len(p) % 7 == 0 for p in packs) and sum(map(len, packs)) == 70
    stored = []
    monkeypatch.setattr(S, "saved_table", lambda df, name, keep=S.saved_table: stored.append(name) or keep(df, name))
    found = got(spark, rows, 12)
    assert found == brute(rows, 12, None) and max(sum(map(len, p)) for p in found) >= 3
    assert stored == ["sequence-items", "sequence-lines"]
