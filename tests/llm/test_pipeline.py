import hashlib
import random

from pyspark.sql import functions as F

import corpus_pipeline as cp
from cartcast.llm import packing
from cartcast.llm.common import documents, saved, table

from .test_packing import gapless
from .test_suffixes import brute as brute_passages

SF = "/root/testdata/sf0.001"


def test_stages_on_the_given_tables(llm):
    docs = documents(llm, SF)
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in cp.STAGES[:-1]:
        before = docs
        docs = saved(stage(llm, docs, SF), "stage")
        assert docs.columns == list(cp.TABLE) and docs.dtypes == before.select(*cp.TABLE).dtypes
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= ids and docs.count() == len(now) > 0
        if stage is cp.quality_stage:
            bad = {r["doc_id"] for r in table(llm, SF, "labels").filter("quality = 0").collect()}
            assert not bad & now and len(now) > len(ids) * 0.6
        if stage is cp.passage_stage:
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            kept = {r["doc_id"]: r["text"] for r in docs.collect()}
            for d, n, gone, _, sha in brute_passages(rows):
                if not gone:
                    assert hashlib.sha256(kept[d].encode()).hexdigest() == sha
                else:
                    assert n - gone - 8 <= len(kept[d].encode()) <= n - gone
            assert now == ids
        ids = now
    out = cp.STAGES[-1][1](llm, docs, SF).collect()
    assert {r["doc_id"] for r in out} == ids
    gapless([(r["sequence_id"], r["offset"], r["length"]) for r in out])


def test_near_duplicates_keep_the_smallest_id(llm, make):
    rng = random.Random(1)
    text = [" ".join(rng.choices([f"w{i}" for i in range(500)], k=120)) for _ in range(3)]
    rows = [(5, text[0]), (2, text[0]), (9, text[1]), (7, text[1]), (7, text[1]), (None, text[2]), (None, text[2])]
    got = cp.near_duplicate_stage(llm, make(rows), SF).collect()
    assert sorted((r["doc_id"] or -1) for r in got) == [-1, 2, 7]


def test_near_duplicates_of_null_and_repeated_ids_differ_by_text(llm, make):
    rng = random.Random(3)
    text = [" ".join(rng.choices([f"w{i}" for i in range(500)], k=120)) for _ in range(8)]
    rows = ([(None, t) for t in text[:4]] + [(7, t) for t in text[4:7]]
            + [(None, text[0]), (7, text[4]), (3, text[5]), (9, text[7]), (9, text[6])])
    for order in (rows, rows[::-1]):
        got = cp.near_duplicate_stage(llm, make(order), SF).collect()
        assert sorted(r["text"] for r in got) == sorted(text)
        assert {r["text"]: r["doc_id"] for r in got} == dict(zip(text, [None] * 4 + [7, 3, 7, 9]))
    same = make([(None, text[0])] * 3 + [(4, text[1])] * 3).withColumn("source", F.lit("s"))
    got = cp.near_duplicate_stage(llm, same, SF).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in got) == [(-1, text[0]), (4, text[1])]


def test_odd_rows_pass_through(llm, make):
    rows = [(1, None), (2, ""), (None, "x"), (3, "y " * 50_000), (3, "y " * 50_000)]
    frame = make(rows)
    for _, stage in cp.STAGES[:-1]:
        assert stage(llm, frame, SF).columns == list(cp.TABLE)
        assert stage(llm, frame.limit(0), SF).count() == 0
    assert cp.passage_stage(llm, frame, SF).count() == 5
    assert cp.packing_stage(llm, frame.limit(0), SF).count() == 0
    assert packing.CAPACITY == 2048
