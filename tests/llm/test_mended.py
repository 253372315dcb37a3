"""Cases that once crashed or were slow: string ids, clashing names, letters beyond U+30000, groups of half-alike texts."""

import random

import numpy as np
import pytest

from aloft.llm import langid, line_dedup, mixing, near_dedup, ranked_search


def half_alike(n, words=100, edits=2, seed=5):
    """Texts with a common base and their own words at some places: most pairs lie at 0.65 to 0.75."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for k, at in enumerate(r.sample(range(words), edits)):
            own[at] = f"x{i}_{k}"
        out.append(" ".join(own))
    return out


def components(texts):
    sets = [{" ".join(w[i:i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    seen = {}
    for s in sets:
        for x in s:
            seen[x] = seen.get(x, 0) + 1
    column = {x: i for i, x in enumerate(x for x, n in seen.items() if n > 1)}
    m = np.zeros((len(sets), len(column)), dtype=np.float32)
    for i, s in enumerate(sets):
        for x in s:
            if x in column:
                m[i, column[x]] = 1
    size = np.array([len(s) for s in sets])
    common = (m @ m.T).astype(np.int64)
    linked = 100 * common >= 75 * (size[:, None] + size[None, :] - common)
    label = np.arange(len(sets))
    while True:
        least = np.where(linked, label[None, :], len(sets)).min(axis=1)
        least = np.minimum(label, least)
        if (least == label).all():
            similar = common / (size[:, None] + size[None, :] - common)
            return label, similar[np.triu_indices(len(sets), 1)]
        label = least


def test_a_large_group_of_half_alike_texts(spark):
    texts = half_alike(3000)
    want, similar = components(texts)
    assert np.mean((similar >= 0.65) & (similar < 0.75)) > 0.6
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.report(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want.tolist()


@pytest.mark.parametrize("flops", [0, 10 ** 9], ids=["one by one", "by a product"])
def test_intersections_both_ways(monkeypatch, flops):
    texts = half_alike(60, words=40, edits=1, seed=3) + ["a b c d e f", "z"]
    sets = [near_dedup.shingle_set(t) for t in texts]
    rows = [[i, i, len(s), bytes(64), bytes(256), bytes(128), s.tobytes()] for i, s in enumerate(sets)]
    one, two = near_dedup.Block(rows[:30]), near_dedup.Block(rows[30:])
    u, v = (x.ravel() for x in np.meshgrid(np.arange(30), np.arange(32)))
    monkeypatch.setattr(near_dedup, "FLOPS_A_SHINGLE", flops)
    monkeypatch.setattr(near_dedup, "COLUMNS", 7)
    want = [len(np.intersect1d(sets[a], sets[30 + b])) for a, b in zip(u, v)]
    assert one.common(two, u, v).tolist() == want


def test_small_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    texts = half_alike(150, seed=9) + half_alike(60, words=60, edits=1, seed=11)
    want, _ = components(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.report(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want.tolist()


DOCS = [("b", "the cat and the dog went to the old house by the river one day", "en", "a", 3),
        ("a", "der Hund und die Katze gingen eines Tages zum alten Haus am Fluss", "de", "b", 3),
        (None, None, None, None, None), ("c", "", "en", None, 0)]


def test_string_ids(spark):
    docs = spark.createDataFrame(DOCS, "doc_id string, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in langid.report(docs).collect()} == {"a", "b", "c", None}
    assert langid.keep_identified(docs).columns == docs.columns
    assert {r["doc_id"] for r in mixing.mix(docs).collect()} == {"a", "b", "c", None}
    assert {r["doc_id"] for r in line_dedup.report(docs).collect()} == {"a", "b", "c", None}
    assert {r["doc_id"] for r in near_dedup.report(docs).collect()} == {"a", "b", "c", None}
    items = spark.createDataFrame([("i", "the river")], "item_id string, text string")
    assert [r["doc_id"] for r in ranked_search.search(docs, items).collect()] == ["b"]


def test_clashing_columns(spark, tmp_path):
    docs = spark.createDataFrame([(*DOCS[0], 7, 8), (*DOCS[1], 7, 8)],
                                 "doc_id string, text string, lang string, source string, n_chars long, TAKEN int, near_th_own int")
    mixed = mixing.mixed_documents(docs)
    mixed.write.parquet(str(tmp_path / "mixed"))
    assert [c for c in mixed.columns if c.lower() == "taken"] == ["taken"]
    kept = near_dedup.dedup(docs)
    assert kept.columns == docs.columns and {r["near_th_own"] for r in kept.collect()} == {8}


def test_letters_of_the_last_planes():
    _, has = langid.counts(["\U00030000\U000311AB", "12 -"])
    assert has.tolist() == [True, False]
