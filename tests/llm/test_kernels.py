"""The parts that run inside tasks, against plain Python."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aloft.llm import decontaminate, langid, line_dedup, lyndon, minimizers, near_dedup, textops, tokens

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.text(alphabet="ab é\n\t▁𝕏.", max_size=40), max_size=8)


@given(TEXTS)
def test_words_stay_in_their_rows(texts):
    data, offsets = textops.utf8(pa.array(texts, pa.string()))
    starts, ends, first = textops.words(data, offsets)
    got = [[bytes(data[s:e]) for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first[:-1], first[1:])]
    assert got == [WORD.findall(t.encode()) for t in texts]


def test_utf8_of_nulls_slices_and_no_rows():
    a = pa.array(["x", None, "", "été"]).slice(1)
    data, offsets = textops.utf8(a)
    assert bytes(data) == "été".encode() and offsets.tolist() == [0, 0, 0, 5]
    assert textops.utf8(pa.array([], pa.string()))[1].tolist() == [0]
    assert textops.utf8(pa.chunked_array([], pa.string()))[1].tolist() == [0]


def test_window_hashes_depend_on_content_only():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, 500).astype(np.uint64) + 7
    h = textops.window_hash(x, 5)
    seen = {}
    for i in range(len(h)):
        assert seen.setdefault(tuple(x[i:i + 5]), h[i]) == h[i]
    assert len(set(h.tolist())) == len(seen)


@given(st.lists(st.integers(0, 5), min_size=1, max_size=60), st.integers(1, 20))
def test_window_argmin(values, w):
    v = textops.mix(np.array(values, dtype=np.uint64) + np.uint64(1))
    got = textops.window_argmin(v, w)
    top = (v >> np.uint64(24)).tolist()
    want = [max(range(i, i + w), key=lambda k: (-top[k], k)) for i in range(len(values) - w + 1)]
    assert got.tolist() == want


@given(st.lists(st.binary(max_size=30), max_size=6))
def test_suffix_order(segments):
    text, base = b"".join(segments), np.cumsum([0, *map(len, segments)])
    suffixes = [(segments[k][i:], int(base[k]) + i) for k in range(len(segments)) for i in range(len(segments[k]))]
    order = lyndon.suffix_order(segments)
    assert sorted(order) == list(range(len(text)))
    by_place = {p: s for s, p in suffixes}
    assert [by_place[p] for p in order] == sorted(s for s, _ in suffixes)


@given(st.lists(st.text(alphabet="ab", min_size=4, max_size=14), min_size=1, max_size=5))
def test_repeated_starts(texts):
    segments, w = [t.encode() for t in texts], 4
    n_win = [len(s) - w + 1 for s in segments]
    all_ = [s[i:i + w] for s, n in zip(segments, n_win) for i in range(n)]
    want = [[i for i in range(n) if all_.count(s[i:i + w]) > 1] for s, n in zip(segments, n_win)]
    assert [sorted(x) for x in lyndon.repeated_starts(segments, n_win, w)] == want


@given(st.lists(st.lists(st.integers(0, 3), max_size=30), max_size=5))
def test_super_windows_cover_every_window_once(rows):
    values = textops.mix(np.array([x for r in rows for x in r], dtype=np.uint64) + np.uint64(9))
    offsets = np.cumsum([0, *map(len, rows)])
    row, start, n, key, dig, anchor = minimizers.super_windows(values, offsets, 6, 3)
    windows = sorted((r, s + i) for r, s, m in zip(row.tolist(), start.tolist(), n.tolist()) for i in range(m))
    assert windows == sorted((r, i) for r in range(len(rows)) for i in range(len(rows[r]) - 5))
    assert all(values[offsets[r] + s + a:][:3].tolist() for r, s, a in zip(row, start, anchor))
    grams = textops.window_hash(values, 3)
    assert [int(grams[offsets[r] + s + a]) for r, s, a in zip(row, start, anchor)] == key.tolist()
    # equal windows have the same key
    of = {}
    for r, s, m, k in zip(row.tolist(), start.tolist(), n.tolist(), key.tolist()):
        for i in range(m):
            assert of.setdefault(tuple(rows[r][s + i:s + i + 6]), k) == k


def test_odd_sketches_estimate_high_similarities():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    for share in (1.0, 0.95, 0.85, 0.75):
        other = base.copy()
        k = int(400 * (1 - share))
        other[:k] = rng.integers(0, 1 << 62, k).astype(np.uint64)
        true = (400 - k) / (400 + k)
        both = np.concatenate([base, other])
        s = near_dedup.odd_sketches(near_dedup.samples(both, np.array([0, 400, 800])))
        far = int(np.bitwise_count(s[0] ^ s[1]).sum())
        assert abs(near_dedup.ESTIMATE[far] - true) < 0.15


def test_shingles():
    texts = ["A b c d e f", "a b", "", "x y z w v", "a  b"]
    sets = [set(near_dedup.shingle_set(t).tolist()) for t in texts]
    assert [len(s) for s in sets] == [2, 1, 0, 1, 1]
    assert sets[1] == sets[4] and not sets[0] & sets[3]
    data, offsets = textops.utf8(pa.array(texts))
    values, first = near_dedup.shingles(data, offsets)
    assert [set(values[a:b].tolist()) for a, b in zip(first[:-1], first[1:])] == sets


@given(st.lists(st.text(alphabet="a \n\r", max_size=30), max_size=6))
def test_lines(texts):
    data, offsets = textops.utf8(pa.array(texts, pa.string()))
    row, s, e, n = line_dedup.lines_of(data, offsets)
    got = [(int(r), bytes(data[a:b]), int(m)) for r, a, b, m in zip(row, s, e, n)]
    assert got == [(r, x, len(WORD.findall(x))) for r, t in enumerate(texts) for x in t.encode().split(b"\n")
                   if WORD.findall(x)]


PIECES = ["a", "b", "in", "the", " ", "  ", "\n", "é", "▁", "𝕏", "1", "<s>", "</s>", "<0x0A>", "th", "er", "\t", "ß", "     ",
          ".", "--", "Т", "\x00", "llll", "ñ", "。"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_token_counts_equal_the_library(text):
    import sentencepiece
    global SP
    try:
        SP
    except NameError:
        SP = sentencepiece.SentencePieceProcessor(model_file=tokens.model_path())
    c = tokens.counter(tokens.model_path())
    counts = c.all_prefixes(text)
    assert counts.tolist() == [len(SP.encode(text[:p])) for p in range(len(text) + 1)]
    assert c.count(text) == counts[-1]
    for limit in (0, 1, 3, 7):
        total, chars = c.fitting(text, limit)
        assert total == counts[-1]
        assert chars == max(p for p, n in enumerate(counts) if n <= limit)


def test_token_counts_of_spaces_and_long_words():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=tokens.model_path())
    c = tokens.counter(tokens.model_path())
    rnd = random.Random(3)
    for n in range(60):
        assert c.count(" " * n) == len(sp.encode(" " * n))
    for alphabet in ("ab", "aeinrst", "0123456789", "xX▁ "):
        text = "".join(rnd.choice(alphabet) for _ in range(3000))
        assert c.count(text) == len(sp.encode(text))


def brute_decontaminate(texts, items, window=13):
    wanted = {}
    for item, text in items:
        w = decontaminate.fold_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wanted.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for t in texts:
        w, hit, found = decontaminate.fold_words(t), set(), set()
        for k, ids in wanted.items():
            for i in range(len(w) - len(k) + 1):
                if tuple(w[i:i + len(k)]) == k:
                    hit.update(range(i, i + len(k)))
                    found |= ids
        out.append((len(w), len(hit), sorted(str(x) for x in found)))
    return out


WORDS = st.lists(st.sampled_from(["a", "B", "c", "é", "7", "-", "x"]), max_size=12).map(" ".join)


@settings(deadline=None)
@given(st.lists(st.one_of(st.none(), WORDS), max_size=6), st.lists(st.one_of(st.none(), WORDS), max_size=4))
def test_suffix_search_finds_all_windows(texts, items):
    items = list(enumerate(items))
    query = decontaminate.QuerySuffixes(items, 3)
    got = [(n, sum(e - s for s, e in spans), sorted(found)) for n, spans, found in decontaminate.match_shard(texts, query)]
    assert got == brute_decontaminate(texts, items, 3)


def test_ngram_counts_do_not_cross_rows():
    both, has = langid.counts(["Ab c", "", None, "12 !"], 1 << 12)
    one, _ = langid.counts(["ab  c"], 1 << 12)
    assert (both[0] == one[0]).all() and has.tolist() == [True, False, False, False]
    # letters a, b, c: 3 + boundary spaces; every 1-gram that is a letter counts
    assert both[0].sum() > 0 and both[3].sum() == both[1].sum()


def test_kmeans_is_deterministic_and_separates():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.05, (20, 8)) for c in (np.eye(8)[0], np.eye(8)[3])])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = langid.kmeans(x, 2), langid.kmeans(x, 2)
    assert (a == b).all() and set((x @ a.T).argmax(axis=1)[:20]) != set((x @ a.T).argmax(axis=1)[20:])


@pytest.mark.parametrize("pairs, want", [([], []), ([(3, 5), (0, 2)], [[0, 2], [3, 5]]), ([(0, 4), (1, 2), (4, 6)], [[0, 6]])])
def test_merge_runs(pairs, want):
    assert minimizers.merge_runs(pairs) == want


def test_digest_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
