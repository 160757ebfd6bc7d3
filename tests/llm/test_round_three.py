"""Alignment, quality rules and whitening against plain versions: nulls, empty and
long texts, ties, repeated rows, empty tables and columns with clashing names."""

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from transitwx.llm import alignment, quality_rules, whitening
from transitwx.llm.queries import TOKENIZER_A, TOKENIZER_B
from transitwx.llm.tokens import plain_table, slices, words_of

needs_vocabularies = pytest.mark.skipif(not os.path.exists(TOKENIZER_A), reason="no vocabulary files")

TEXTS = [
    "The quick brown fox, the quick brown fox!",
    "",
    None,
    " ",
    "  two  spaces and a tab\there ",
    "line one here\nline one here\n\n \nother line\nline one here",
    "<|endoftext|> and <s> </s> <unk> <0x41> are plain text",
    "Ünï çödé ﬁ ① 漢字 é \U0001f600  x y\x00z",
    "low ▁ block",
    "it's we'll  'tis '' x'd 12 345 6",
    "a b c a b c a a a a",
    "word " * 400,
    "#$%& *** <<>> ||| " * 30,
    "The quick brown fox, the quick brown fox!",
]
SCHEMA = "doc_id long, text string, row long, pairs string, n_words string, failed string, id string"


def corpus():
    rng = random.Random(3)
    pool = ["".join(rng.choice("abcdefghijklmnoß") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    rows = list(enumerate(TEXTS)) + [(None, "no id here at all"), (3, "again three"), (3, "again three")]
    rows += [(100 + i, " ".join(rng.choices(pool, k=rng.choice([1, 3, 60, 200])))) for i in range(40)]
    return rows + [(999, " ".join(rng.choices(pool, k=60_000)))]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, 7, "x", "y", "z", "w") for i, t in rows], SCHEMA).repartition(4)


# ---- alignment


def plain_links(text, a_model, b_model, letters):
    """Ids of both kinds, groups as text and links, token by token."""
    nothing = 0, 0, [], []
    if not text:
        return nothing
    a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
    a_bytes = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a]
    b_bytes = [
        bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()
        for i in b
    ]
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return nothing
    groups, links, i, j, at_a, at_b, own_a, own_b = [], [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            at_a, own_a, i = at_a + len(a_bytes[i]), [*own_a, a[i]], i + 1
        else:
            at_b, own_b, j = at_b + len(b_bytes[j]), [*own_b, b[j]], j + 1
        if at_a == at_b:
            groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
            links.append((own_a[-1], own_b[-1]))
            own_a, own_b = [], []
    return len(a), len(b), groups, links


@needs_vocabularies
@pytest.mark.parametrize("popular", [alignment.POPULAR, 20, 0])
def test_links_equal_plain_merge(spark, docs, rows, popular):
    a_model = tokenizers.Tokenizer.from_file(TOKENIZER_A)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=TOKENIZER_B)
    found = [plain_links(t, a_model, b_model, alignment.byte_letters()) for _, t in rows]
    counts = Counter(x for *_, links in found for x in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    want = [
        (i, n_a, n_b, len(g), len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x),
         hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for (i, _), (n_a, n_b, g, x) in zip(rows, found, strict=True)
    ]
    got = [tuple(r) for r in alignment.link_profile(docs, TOKENIZER_A, TOKENIZER_B, most=popular).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert any(not r[1] and t for r, (_, t) in zip(want, rows, strict=True))


@needs_vocabularies
def test_groups_cover_all_tokens(docs):
    for r in alignment.align(docs, TOKENIZER_A, TOKENIZER_B).collect():
        for ids, cuts in ((r["a_ids"], r["a_cuts"]), (r["b_ids"], r["b_cuts"])):
            assert (cuts[-1] if cuts else 0) == len(ids)
            assert all(x < y for x, y in zip(cuts, cuts[1:], strict=False))


@needs_vocabularies
def test_no_texts(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.link_profile(empty, TOKENIZER_A, TOKENIZER_B).count() == 0


@needs_vocabularies
def test_encoder_agrees_with_the_file_everywhere(monkeypatch):
    a_model = tokenizers.Tokenizer.from_file(TOKENIZER_A)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=TOKENIZER_B)
    monkeypatch.setattr(alignment, "LONG_TEXT", 50)
    tools = alignment.Pair(TOKENIZER_A, TOKENIZER_B)
    points = [*range(1, 0x600), *range(0x2000, 0x2100), *range(0x3000, 0x3020), 0xFEFF, 0x1F600]
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}1 {chr(c)} {chr(c)}'s\n{chr(c)}x y" for c in points]
    texts.append(" ".join(texts))
    for text in texts:
        (a, b), (n_a, _) = tools.encode([text])
        if n_a[0]:
            assert a.tolist() == a_model.encode(" " + text, add_special_tokens=False).ids
            assert b.tolist() == b_model.encode(text)


@pytest.mark.parametrize("piece", [1, 2, 7, 1000])
def test_pieces_of_the_merge_path(piece):
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 80, rng.integers(0, 60))) for _ in range(2))
        i, j = alignment.diagonals(a, b, piece)
        assert (np.diff(i + j)[:-1] == piece).all() and i[-1] + j[-1] == len(a) + len(b)
        at_a, at_b = alignment.common_ends(a, b, piece)
        assert a[at_a].tolist() == b[at_b].tolist() == np.intersect1d(a, b).tolist()


# ---- quality rules


def plain_measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    twice = {i + d for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for d in range(3)}
    letters = sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", x)) for x in w)
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(twice), len(lines), letters,
    )


def test_measures_equal_plain_counts(docs, rows):
    got = sorted((tuple(r) for r in quality_rules.ledger(docs).drop("failed").collect()), key=str)
    assert got == sorted(((i, *plain_measures(t)) for i, t in rows), key=str)


def test_bits_policies_and_ablation(spark, docs, rows):
    entries = quality_rules.ledger(docs)
    got = entries.withColumn("kept", quality_rules.passes(quality_rules.CURRENT)).collect()
    base = quality_rules.BASE.mask()
    for r in got:
        assert bool(r["failed"] & base) == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (r["failed"] == 0)
    table = quality_rules.ablation(entries).collect()
    assert len(table) == sum(len(p.rules) for p in quality_rules.POLICIES)
    rules = {r.name: r for r in quality_rules.RULES}
    for row in table:
        policy = next(p for p in quality_rules.POLICIES if p.version == row["policy"])
        others = sum(rules[n].mask for n in policy.rules if n != row["rule"])
        assert row["texts"] == len(rows) and row["words"] == sum(r["n_words"] for r in got)
        assert row["kept_texts"] == sum(not r["failed"] & policy.mask() for r in got)
        assert row["failed_texts"] == sum(bool(r["failed"] & rules[row["rule"]].mask) for r in got)
        assert row["kept_texts_without"] == sum(not r["failed"] & others for r in got)
        assert row["kept_words_without"] == sum(r["n_words"] for r in got if not r["failed"] & others)
    empty = quality_rules.ledger(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and quality_rules.ablation(empty).count() == 0


def test_words_of_two_letters_in_no_order_differ():
    """Thue-Morse words and their opposites, equal under every polynomial hash."""
    import pyarrow as pa

    bits = [bin(i).count("1") % 2 for i in range(4096)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    texts = pa.array([f"{one[:n]} {two[:n]}" for n in (8, 16, 63, 64, 65, 2048, 4096)])
    for _, part in slices(texts):
        w = words_of(part, plain_table(), 2)
        for h in w.hashes:
            assert len(set(h.tolist())) == len(h) == 14


# ---- whitening


def vector_rows(n=400, d=24, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.linspace(0.2, 3, d) + rng.normal(size=d)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(None, x[0].tolist()), (7, x[7].tolist()), (n, None), (n + 1, [float("nan")] * d), (n + 2, [None] * d)]
    return rows + [(n + 3, [float("inf")] * d), (n + 4, x[1].tolist()[: d - 3]), (n + 5, [])]


VECTORS = "vec_id long, embedding array<double>, n string, y string, whitened string, component string"


def as_integers(rows, d):
    ok = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    y = [np.floor(64 * np.array(v + [0.0] * (d - len(v)))).astype(int) for _, v in ok]
    return [i for i, _ in ok], np.array(y)


@pytest.mark.parametrize("d", [3, 24, 90])
def test_whitening_equals_dense_eigenvectors(spark, d):
    rows = vector_rows(d=d)
    table = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], VECTORS).repartition(3)
    whitened, model, error = whitening.whiten(table)
    got = whitening.component_rows(whitened, model, error).collect()
    ids, y = as_integers(rows, d)
    n, k = len(y), min(d, 32)
    e, u = np.linalg.eigh(np.cov(y.T, bias=True))
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    exact = ((n * y - y.sum(axis=0)) ** 2).sum(axis=1)
    want = (y - y.mean(axis=0)) @ u / np.sqrt(e)
    for c in range(k):
        rows_c = [r for r in got if r["component"] == c + 1]
        assert Counter((r["vec_id"], r["deviation"]) for r in rows_c) == Counter(zip(ids, exact.tolist(), strict=True))
        assert sorted(abs(r["whitened"]) for r in rows_c) == pytest.approx(sorted(np.abs(want[:, c])), rel=1e-7, abs=1e-9)
        assert rows_c[0]["explained"] == pytest.approx(e[c] / np.trace(np.cov(y.T, bias=True)), rel=1e-9)
    assert error < 1e-9


def test_jacobi_davidson_locks_near_and_equal_values():
    rng = np.random.default_rng(4)
    for values in (np.geomspace(1, 1e-6, 200), np.r_[np.full(40, 2.0), np.linspace(1, 0, 160)], np.full(60, 3.0)):
        q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
        a = (q * values) @ q.T
        calls = []
        found, u = whitening.jacobi_davidson(lambda x, a=a: calls.append(x.shape[1]) or a @ x, len(values), 32)
        assert found == pytest.approx(np.sort(values)[::-1][:32], abs=1e-13 * values.max())
        assert np.abs(u.T @ u - np.eye(32)).max() < 1e-12
        assert np.linalg.norm(a @ u - u * found, axis=0).max() < 1e-12 * values.max()
        assert len(calls) < 150


def test_what_does_not_vary_has_no_components(spark):
    same = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], "vec_id long, embedding array<float>")
    for table in (same, same.limit(0), same.limit(1)):
        assert whitening.component_rows(*whitening.whiten(table)).count() == 0
    line = spark.createDataFrame([(i, [i / 8, 1.0, i / 4]) for i in range(9)], "vec_id long, embedding array<float>")
    got = whitening.component_rows(*whitening.whiten(line))
    assert got.agg(F.max("component"), F.count("*")).first() == (1, 9)


def test_deviations_beyond_64_bits_are_null(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 0.25]), (3, [0.0, 0.5])]
    whitened, model, error = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert {r["id"]: r["deviation"] for r in whitened.collect()}[1] is None
    assert error < 1e-4
