import random

import numpy as np
import xxhash

from cartcast.llm import simhash


def brute_print(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) > len(hs))


def brute_components(ids, prints):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return {d: least[find(i)] for i, d in enumerate(ids)}


def test_golay_neighbours_share_an_index():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1 << 23, 500)
    own = simhash.nearby_indices(v)
    assert {len(set(r)) for r in own.tolist()} <= {1, 6}
    for _ in range(20):
        i, j = rng.integers(0, 23, 2)
        near = simhash.nearby_indices(v ^ (1 << i) ^ (1 << j))
        assert all(set(a) & set(b) for a, b in zip(own.tolist(), near.tolist()))


def test_linked_prints_share_a_key():
    rng = random.Random(2)
    for _ in range(300):
        p = rng.getrandbits(64)
        q = p
        for b in rng.sample(range(64), 3):
            q ^= 1 << b
        rows, keys = simhash.fuzzy_keys(np.array([p, q], np.uint64))
        assert set(keys[rows == 0]) & set(keys[rows == 1])


def cluster(rng, n, spread):
    base = rng.getrandbits(64)
    out = []
    for _ in range(n):
        p = base
        for b in rng.sample(range(64), rng.randint(0, spread)):
            p ^= 1 << b
        out.append(p)
    return out


def test_components_equal_brute_force(llm):
    rng = random.Random(3)
    prints = sorted({p for n in (60, 40, 5, 5) for p in cluster(rng, n, 4)} | {rng.getrandbits(64) for _ in range(50)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = brute_components(signed, prints)
    frame = llm.createDataFrame([(p,) for p in signed], "fp long")
    for hot in (4096, 3):  # 3: the linear way for oversized keys
        got = {r["fp"]: r["root"] for r in simhash.link_fingerprints(frame, hot).collect()}
        assert got == want


def test_documents_equal_brute_force(make):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(rng.choices(words, k=60)) for _ in range(8)]
    rows = [(i, t) for i, t in enumerate(base + [t + " tail" for t in base] + base[:3])]
    rows += [(100, None), (101, ""), (102, " \n "), (103, "One Two"), (104, "one two"), (105, "É é")]
    out = {r["doc_id"]: r for r in simhash.simhash_near_dedup(make(rows)).collect()}
    prints = [brute_print(t) for _, t in rows]
    assert [int(out[i]["fingerprint"], 16) for i, _ in rows] == prints
    want = brute_components([i for i, _ in rows], prints)
    assert {i: out[i]["component_id"] for i, _ in rows} == want


def test_long_text_repeated_rows_and_empty_table(make, llm):
    text = "lorem ipsum dolor " * 60_000
    assert simhash.fingerprint(text) == brute_print(text)
    out = simhash.simhash_near_dedup(make([(7, "a b c d"), (7, "a b c d"), (None, "a b c d")])).collect()
    assert [r["component_id"] for r in out] == [7, 7, 7]
    assert simhash.simhash_near_dedup(make([(1, "x")]).limit(0)).count() == 0
