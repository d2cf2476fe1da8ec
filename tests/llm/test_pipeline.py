"""Each stage of the pipeline on its own input, against a plain version."""

from collections import Counter, defaultdict

import corpus_pipeline as P
import numpy as np
import pytest
from test_nearcopies import groups
from test_repeats import slow

from tideline.llm import mixing, toxicity
from tideline.llm import queries as Q


@pytest.fixture(scope="module")
def kept(spark, sf, tmp_path_factory):
    """The input and every stage's output, written and read again."""
    root, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        stage(spark, out[-1], sf).write.parquet(f"{root}/{name}")
        out.append(spark.read.parquet(f"{root}/{name}"))
    return out


def test_columns(kept):
    assert all(sorted(d.columns) == sorted(P.COLUMNS) for d in kept[:-1])


def test_toxicity(spark, sf, kept):
    model = Q.toxicity_model(spark, kept[0], sf)
    low = {r.id for r in toxicity.score(kept[0], model).collect() if r.score < 0.7}
    assert {r.doc_id for r in kept[1].collect()} == low and 0 < len(low) < kept[0].count()


def test_simhash(kept):
    group = groups([(r.doc_id, r.text) for r in kept[1].collect()])
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted(set(group.values()))


def test_repeats(kept):
    before = kept[2].collect()
    want = {r.doc_id: k.decode("utf-8", "ignore") for r, (_, _, _, k) in zip(before, slow([(r.text or "").encode() for r in before], 200))}
    after = {r.doc_id: r for r in kept[3].collect()}
    assert {d: r.text for d, r in after.items()} == want
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_mixing(spark, sf, kept):
    rate = {r.row: r.rate for r in mixing.mix(kept[3], spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    n = Counter(r.doc_id for r in kept[4].collect())
    assert all(np.floor(rate[d]) <= n[d] <= np.ceil(rate[d]) for d in rate) and set(n) <= set(rate)


def test_packing(kept):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter(tuple([*t.encode(r.text, add_special_tokens=False).ids, 1]) for r in kept[4].collect())
    rows = defaultdict(list)
    for r in kept[5].collect():
        rows[r.sequence_id >> 40, r.row_in_task].append(r)
    got = Counter()
    for ps in rows.values():
        ps.sort(key=lambda r: r.start)
        got[tuple(np.frombuffer(b"".join(bytes(p.ids) for p in ps), "<u4").tolist())] += 1
    assert got == want


def test_run(spark, sf, kept):
    got = P.run(spark, sf)
    assert got.columns == kept[5].columns and abs(got.count() - kept[5].count()) <= 2


@pytest.fixture(scope="module")
def odd(spark):
    """Null, repeated and missing ids, null, empty, blank, short and very long texts, and columns with the operators' own names."""
    long = " ".join(f"word{k % 9973}x{k % 7}" for k in range(120_000))
    rows = [(1, "some plain words in a row"), (1, "some plain words in a row"), (1, "another text under the same id"), (None, "no id here"), (None, None), (2, None), (2, ""), (3, " "), (4, long), (5, "x")]
    assert len(long) > 1 << 20
    rows = [(i, t, "en", None, None, "a", 1.5, 7, "b") for i, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, near_key string, score double, row int, id string").repartition(3).persist()


def test_toxicity_edges(spark, sf, odd):
    got = P.toxicity_stage(spark, odd, sf)
    assert got.columns == list(P.COLUMNS) and got.count() <= odd.count()
    kept = Counter((r.doc_id, r.text) for r in got.collect())
    assert not kept - Counter((r.doc_id, r.text) for r in odd.collect()) and kept[None, None] == kept[2, None]
    assert P.toxicity_stage(spark, odd.limit(0), sf).count() == 0


def test_repeats_edges(spark, sf, odd):
    got = P.repeats_stage(spark, odd, sf).collect()
    want = [k.decode() for *_, k in slow([(r.text or "").encode() if r.doc_id != 4 else b"" for r in odd.collect()], 200)]
    assert sorted(r.text for r in got if r.doc_id != 4) == sorted(w for w, r in zip(want, odd.collect()) if r.doc_id != 4)
    assert len(got) == odd.count() and all(r.n_chars == len(r.text) for r in got)
    assert P.repeats_stage(spark, odd.limit(0), sf).count() == 0


def test_mixing_edges(spark, sf, odd):
    rate = Counter()
    for r in mixing.mix(odd.select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")).collect():
        rate[r.row] += int(np.ceil(r.rate))
    n = Counter(r.doc_id for r in P.mixing_stage(spark, odd, sf).collect())
    assert all(n[d] <= rate[d] for d in n)
    assert P.mixing_stage(spark, odd.limit(0), sf).count() == 0


def test_packing_edges(spark, sf, odd):
    got = P.packing_stage(spark, odd, sf).collect()
    assert sum(r.length for r in got) == sum(r.doc_tokens for r in got if r.start == 0) and sum(r.start == 0 for r in got) == odd.count()
    assert P.packing_stage(spark, odd.limit(0), sf).count() == 0
