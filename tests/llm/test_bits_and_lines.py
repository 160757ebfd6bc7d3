"""Tables of bits, overlaps along a line, and pipeline stages on repeated ids."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from transitwx.llm import bits, decontamination


def test_rows_without_and_only_some_keys(spark):
    rows = [(i % 5000 if i % 7 else None, f"r{i}", True, b"x") for i in range(9000)]
    df = spark.createDataFrame(rows, "`a.b` long, __key string, __Maybe boolean, __bits binary").repartition(4)
    keys = spark.createDataFrame([(i,) for i in range(0, 5000, 3)] + [(None,)], "k long")
    gone = {i for i in range(0, 5000, 3)} | {None}
    want = sorted(r[1] for r in rows if r[0] not in gone)
    for few in (keys, keys.limit(0)):
        left, held = bits.without(df, "a.b", few), bits.only(df, "a.b", few)
        assert left.columns == held.columns == df.columns
        assert left.count() + held.count() == len(rows)
        if few is keys:
            assert sorted(r["__key"] for r in left.collect()) == want
    known, flag = bits.in_bits(df, "a.b", keys)
    found = known.groupBy(flag).count().collect()
    assert {r[0]: r[1] for r in found}[True] < 1.15 * (len(rows) - len(want)) + 0.07 * len(rows)


def longest(doc, item, shift, identity):
    same = [i + shift for i in range(len(item)) if 0 <= i + shift < len(doc) and doc[i + shift] == item[i]]
    best = (0, 0, 0)
    for i, a in enumerate(same):
        for j in range(i, len(same)):
            n = same[j] - a + 1
            if j - i + 1 >= identity * n and n > best[1]:
                best = (a, n, j - i + 1)
    return best


def test_overlaps_are_the_longest_of_their_line():
    rng = random.Random(2)
    for _ in range(400):
        doc, item = (np.array([rng.randrange(3) for _ in range(rng.randrange(1, 50))]) for _ in range(2))
        shift = rng.randrange(-len(item), len(doc))
        identity = Fraction(rng.choice([1, 2, 3, 4, 5]), 5)
        assert decontamination.overlap(doc, item, shift, identity) == longest(doc.tolist(), item.tolist(), shift, identity)
    same = [True] * 10 + [False] * 20 + [i % 5 != 2 for i in range(25)]
    doc = np.arange(55)
    assert decontamination.overlap(doc, np.where(same, doc, -1), 0, Fraction(4, 5))[1] == 25


def plain_contamination(docs, items, masks):
    """Every pair of texts, every line with a masked hit."""
    import re

    def words(t):
        return [w.lower() for w in re.findall(r"[A-Za-z0-9]+", t or "")]

    out = {}
    for d, text in docs:
        for i, item in items:
            a, b = words(text), words(item)
            runs = list(masks) + (["1" * len(b)] if 0 < len(b) < 8 else [])
            for shift in range(-len(b) + 1, len(a)):
                hit = any(
                    all(m == "0" or a[p + shift + k] == b[p + k] for k, m in enumerate(mask))
                    for mask in runs
                    for p in range(max(0, -shift), min(len(b), len(a) - shift) - len(mask) + 1)
                )
                at, n, same = longest(a, b, shift, Fraction(4, 5)) if hit else (0, 0, 0)
                if n and n >= min(13, len(b)):
                    out[d, i] = max(out.get((d, i), (0, 0, 0)), (n, same, -at))
    return {(d, i, -at, n, same) for (d, i), (n, same, at) in out.items()}


def test_contamination_equals_brute_force(spark):
    rng = random.Random(8)
    pool = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(pool, k=rng.choice([3, 9, 25, 40])))) for i in range(12)] + [(50, None), (51, ""), (3, "w1 w2 w3")]
    docs = [(None, items[2][1]), (90, ""), (91, None)]
    for d in range(30):
        w = rng.choices(pool, k=30)
        item = items[rng.randrange(12)][1].split()
        item = [x if rng.random() > 0.12 else "zz" for x in item[rng.randrange(3) :]]
        docs.append((d, " ".join(w[:12] + item + w[12:])))
    table = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, words string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_contamination(table, bench).drop("item_words").collect()
    assert {tuple(r) for r in got} == plain_contamination(docs, items, decontamination.MASKS)
    assert len(got) > 8


@pytest.fixture(scope="module")
def repeated(spark):
    rows = [(i % 40 if i % 9 else None, " ".join(f"t{i}x{j}" for j in range(5 + i % 3)), f"s{i % 4}", i) for i in range(120)]
    return spark.createDataFrame(
        [(*r, 1, 2, "k") for r in rows], "doc_id long, text string, source string, nth long, position long, copy long, id string"
    )


def test_mixing_takes_rows_of_one_id_once_each(spark, repeated):
    got = corpus_pipeline.mixed(spark, repeated, "")
    assert got.columns == repeated.columns
    plan = corpus_pipeline.mixing.plan_mix(repeated)
    copies = corpus_pipeline.mixing.training_order(plan).where("2 * words >= size")
    assert got.count() == copies.count()
    assert got.groupBy("nth").count().agg(F.max("count")).first()[0] <= 3


def test_near_dedup_keeps_one_row_of_an_id(spark, repeated):
    got = corpus_pipeline.distinct(spark, repeated, "")
    assert got.columns == repeated.columns
    assert got.count() == repeated.select("doc_id").distinct().count()
