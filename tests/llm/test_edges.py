"""Every operator on nulls, empty and long texts, ties, repeated rows, no rows and clashing columns."""

import hashlib
import random
import re

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from aloft.llm import (debruijn, decontaminate, langid, line_dedup, lyndon, mixing, near_dedup, nn_descent, tokens,
                       url_filter)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
W = re.compile(rb"[^\x20\x09-\x0D]+")

EN = ("the of and to in that was is for on with as his they be at one have this from or had by hot but some "
      "what there we can out other were all your when up use word how said an each she which do their time if").split()
DE = ("der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
      "dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor").split()


def sentence(words, seed, n):
    x, out = seed * 7919 + 13, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(words[(x >> 8) % len(words)])
    return " ".join(out)


def rows():
    base = sentence(EN, 1, 120)
    edited = base.split()
    edited[60] = "changed"
    passage = sentence(DE, 5, 70)
    lines = "\n".join(sentence(EN, 50 + i, 12) for i in range(4))
    texts = [
        (0, base, "en", "a"), (1, base, "en", "a"), (2, " ".join(edited), "en", None),
        (3, "x " + passage + " y", "de", "b"), (4, sentence(DE, 9, 30) + " " + passage, "de", "b"),
        (5, None, None, "c"), (6, "", "en", "c"), (7, " \n\t ", "en", None), (8, "12 34 !!", "de", "d"),
        (9, "kurz", "de", "d"), (10, "kurz", "de", "d"), (11, "a b c d", None, "é"),
        (12, lines + "\nown line of twelve", "en", "é"), (13, "first\n" + lines, "en", "é"),
        (14, sentence(EN, 77, 9000), "en", "long"), (15, sentence(EN, 78, 2000) + " " + base, "en", "long"),
        (None, base, "en", "a"), (None, None, None, None), (16, "wort " * 400, "de", "b"),
    ]
    out = [(i, t, la, s, None if t is None else len(t)) for i, t, la, s in texts]
    out.append(out[3])  # a repeated row
    out += [(100 + i, sentence(EN if i % 2 else DE, 200 + i, 40), "en" if i % 2 else "de", "train", 0) for i in range(40)]
    return out


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edges") / "documents.parquet")
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return W.findall((t or "").encode())


def test_substring_dedup(docs):
    all_ = rows()
    first = {}
    for i, t, *_ in all_:
        w = words(t)
        for k in range(len(w) - 49):
            if i is not None:
                first[tuple(w[k:k + 50])] = min(i, first.get(tuple(w[k:k + 50]), i))
    want = []
    for i, t, *_ in all_:
        w = words(t)
        gone = set()
        for k in range(len(w) - 49):
            if i is not None and first[tuple(w[k:k + 50])] < i:
                gone.update(range(k, k + 50))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in debruijn.report(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(n for _, _, n, _ in want) > 100


@pytest.mark.parametrize("hot", [1000, 0])
def test_byte_dedup(docs, hot):
    """With and without suffix arrays (hot=0: all keys go the way of very hot ones)."""
    texts = [(t or "").encode() for _, t, *_ in rows()]
    seen = {}
    for b in texts:
        for k in range(len(b) - 199):
            seen[b[k:k + 200]] = seen.get(b[k:k + 200], 0) + 1
    want = []
    for (i, *_), b in zip(rows(), texts):
        cover = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                cover[k:k + 200] = b"\1" * 200
        kept = bytes(x for x, c in zip(b, cover) if not c)
        want.append((i, len(b), sum(cover), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in lyndon.report(docs, hot=hot).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_near_dedup(docs):
    sets = [(i, set(near_dedup.shingle_set((t or "")).tolist())) for i, t, *_ in rows()]
    parent = list(range(len(sets)))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, (_, s) in enumerate(sets):
        for b, (_, u) in enumerate(sets[:a]):
            if s and u and 100 * len(s & u) >= 75 * len(s | u):
                parent[find(a)] = find(b)
    heads = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            heads[find(k)] = min(i, heads.get(find(k), i))
    want = [(i, len(s), (heads.get(find(k)) if s else i), i == (heads.get(find(k)) if s else i))
            for k, (i, s) in enumerate(sets)]
    got = [tuple(r) for r in near_dedup.report(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = near_dedup.dedup(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 0 in ids and 1 not in ids and 2 not in ids and 9 in ids and 10 not in ids
    assert ids.count(3) == 1 and {5, 6, 7} <= set(ids)


def runs_deleted(rows_):
    """(id, lines, deleted lines, digest) by comparing every place with all earlier ones."""
    used = {}
    for i, t in rows_:
        used[i, t] = [(k, x, len(words(x.decode()))) for k, x in enumerate((t or "").encode().split(b"\n")) if words(x.decode())]
    order = sorted(used, key=lambda r: (r[0] is None, r[0] or 0))
    places = [(r, p) for r in order for p in range(len(used[r]))]
    gone = {r: set() for r in order}
    for at, (r, p) in enumerate(places):
        for s, q in places[:at]:
            n = total = 0
            while p + n < len(used[r]) and q + n < len(used[s]) and used[r][p + n][1] == used[s][q + n][1]:
                total += used[r][p + n][2]
                n += 1
            if total >= 20:
                gone[r].update(range(p, p + n))
    out = []
    for r in rows_:
        out_lines = {used[r][p][0] for p in gone[r]}
        left = b"\n".join(x for k, x in enumerate((r[1] or "").encode().split(b"\n")) if k not in out_lines)
        out.append((r[0], len(used[r]), len(out_lines), hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_maximal_line_runs(spark, seed):
    r = random.Random(seed)
    pool = [" ".join(f"{c}{k}" for k in range(n)) for c, n in zip("abcdefgh", (1, 2, 3, 7, 11, 19, 20, 35))]
    docs = [(i, "\n".join(r.choice(pool) for _ in range(r.randrange(9)))) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(tuple(x) for x in line_dedup.report(frame).collect()) == sorted(runs_deleted(docs))


def test_a_copied_text_that_ends_in_short_lines_is_emptied(spark):
    text = "\n".join(" ".join(f"{c}{k}" for k in range(n)) for c, n in (("a", 3), ("b", 100), ("c", 80), ("d", 5), ("e", 1)))
    frame = spark.createDataFrame([(1, text), (2, text), (3, "new line\n" + text + "\nanother"), (4, "d0 d1 d2 d3 d4")],
                                  "doc_id long, text string")
    assert [tuple(r)[1:3] for r in line_dedup.report(frame).orderBy("doc_id").collect()] == [(5, 0), (5, 5), (7, 5), (1, 0)]
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup(frame).collect()} == {
        1: text, 3: "new line\nanother", 4: "d0 d1 d2 d3 d4"}


def test_line_dedup(docs):
    want = runs_deleted([(i, t) for i, t, *_ in rows()])
    got = [tuple(r) for r in line_dedup.report(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    left = {r["doc_id"]: r for r in line_dedup.dedup(docs).collect()}
    assert 1 not in left and 0 in left and left[13]["text"] == "first" and left[13]["n_chars"] == 5
    assert left[5]["text"] is None and left[6]["text"] == ""


def test_token_counts(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=tokens.model_path())
    got = {(r["doc_id"], r["n_bytes"]): r for r in tokens.report(docs).collect()}
    for i, t, *_ in rows():
        r = got[i, len((t or "").encode())]
        n = len(sp.encode(t or ""))
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 4096)
        assert len(sp.encode((t or "")[:r["limit_chars"]])) <= 4096
    arrays = {r["doc_id"]: r["prefix_tokens"] for r in tokens.prefix_counts(docs.select("doc_id", "text")).collect()}
    assert arrays[9] == [len(sp.encode("kurz"[:p])) for p in range(5)] and arrays[5] == [0]


def test_language_id(docs):
    clash = docs.withColumnsRenamed({"source": "score", "n_chars": "rejected"})
    kept = langid.keep_identified(clash)
    assert kept.columns == clash.columns
    assert kept.where("score = 'a'").count() == 3
    got = {r["doc_id"]: r for r in langid.report(docs).collect()}
    for i in (5, 6, 7, 8):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    right = [(got[100 + i]["lang_pred"] == ("en" if i % 2 else "de")) for i in range(40)]
    assert sum(right) >= 38 and all(0 <= r["score"] <= 1 for r in got.values())
    assert {r["lang_pred"] for r in got.values()} == {"en", "de", "und"}
    unlabelled = langid.report(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_held_out_accuracy(spark):
    data = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in langid.report(data).collect()}
    true = {r["doc_id"]: r["lang"] for r in data.select("doc_id", "lang").collect()}
    test = [i for i, r in got.items() if r["held_out"]]
    assert sum(got[i]["lang_pred"] == true[i] for i in test) / len(test) > 0.97
    assert sum(r["rejected"] for r in got.values()) <= 0.005 * len(got)


def test_foreign_texts_are_rejected_and_held_out_ones_stay(spark):
    data = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(data)
    scripts = [(0x3B1, 25), (0x430, 32), (0x4E00, 3000), (0xAC00, 3000), None]
    texts = []
    for s, script in enumerate(scripts):
        letters = "qxzjkvwyb" if script is None else "".join(chr(script[0] + i) for i in range(script[1]))
        for i in range(10):
            spell = sentence(list(letters), 1000 * s + i, 1500).split()
            texts.append(" ".join("".join(spell[5 * w:5 * w + 5]) for w in range(300)))
    assert all(rejected for _, _, rejected in model.predict(texts, langid.REJECT_FACTOR))
    clean = [r["text"] for r in data.where(langid.held_out(F.col("doc_id"))).select("text").collect()]
    assert sum(r for _, _, r in model.predict(clean, langid.REJECT_FACTOR)) <= 0.01 * len(clean)


def test_decontamination(spark, docs):
    passage = " ".join(sentence(DE, 5, 70).split()[10:40])
    items = spark.createDataFrame([(7, passage), (7, passage), (2, "KURZ"), (3, None), (None, "kurz"), (4, "!!")],
                                  "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.report(docs, items).collect()}
    assert (got[3]["n_hit"], got[3]["n_items"], got[3]["contaminated"]) == (30, 1, True)
    assert got[3]["items_sha256"] == hashlib.sha256(b"7").hexdigest()
    assert (got[9]["n_hit"], got[9]["n_items"]) == (1, 1) and got[0]["n_hit"] == 0
    assert (got[5]["n_words"], got[5]["contaminated"]) == (0, False)
    blocks = {r["doc_id"]: r for r in decontaminate.report(docs, items, block_words=4).collect()}
    assert blocks == got
    clash = docs.withColumnsRenamed({"source": "items", "n_chars": "N_hit"})
    kept = decontaminate.decontaminate(clash, items)
    assert kept.columns == clash.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert not {3, 9, 10} & set(ids) and {0, 5, 6, 14} <= set(ids)
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == docs.count()


def test_mixing(docs):
    got = mixing.mix(docs).collect()
    by = {}
    for r in got:
        by.setdefault(r["source"], []).append(r)
    assert len(got) == len(rows())
    total = sum(r["size"] for r in got)
    order = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None]
    weights = dict(zip(order, [5, 2, 1] * 9))
    size = {s: sum(r["size"] for r in by[s]) for s in by}
    open_, target = set(by), {}
    left = float(total)
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * size[s]}
        if not above:
            target.update(share)
            break
        for s in above:
            target[s] = 3.0 * size[s]
        left -= sum(3.0 * size[s] for s in above)
        open_ -= above
    for s, rs in by.items():
        assert rs[0]["source_size"] == size[s] and abs(rs[0]["target"] - target[s]) < 1e-6
        assert sum(r["taken"] for r in rs) == int(target[s] + 1e-9)
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in rs)
    again = mixing.mix(docs.repartition(5), bucket_rows=3).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)
    out = mixing.mixed_documents(docs.withColumnRenamed("n_chars", "taken"))
    assert out.columns == ["doc_id", "text", "lang", "source", "taken", "epochs", "part_words"]


def test_url_filter(spark):
    urls = [(1, "http://a.example.NET/en/x?q"), (2, "https://net/"), (3, "http://xnet/"), (4, "http://b.net"),
            (5, None), (6, "no scheme/net/"), (7, "x://example.com/de/#a"), (8, "x://q.org/fr/"), (8, "x://q.org/fr/"),
            (None, "http://" + "a." * 3000 + "net/y"), (9, ""), (10, "http://example.com/de?x"), (11, "http://u:p@e.net/é"),
            (12, "a://b://c.net/")]
    pages = spark.createDataFrame(urls, "page_id long, url string").selectExpr("*", "1 as host", "2 as verdict")
    got = url_filter.judge_urls(pages, url_filter.rule_table(spark))
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    found = {r["page_id"]: r for r in got.collect()}
    assert got.count() == len(urls)
    want = {1: ("example.net/en/", "allow"), 2: ("net/", "block"), 3: (None, "allow"), 4: (None, "allow"), 5: (None, "allow"),
            6: (None, "allow"), 7: ("example.com/de/", "block"), 8: ("org/fr/", "allow"), None: ("net/", "block"),
            9: (None, "allow"), 10: (None, "allow"), 11: ("net/", "block"), 12: (None, "allow")}
    assert {i: (r["rule"], r["verdict"]) for i, r in found.items()} == want
    assert (found[1]["host"], found[1]["path"], found[5]["host"], found[12]["host"]) == ("a.example.net", "/en/x", "", "b:")
    assert url_filter.judge_urls(pages.limit(0), url_filter.rule_table(spark)).count() == 0


def test_near_vectors(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 16))
    near = base[:20] + rng.normal(size=(20, 16)) * 0.02
    vs = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near]))]
    vs += [(200 + i, (base[0] + rng.normal(size=16) * 0.01).tolist()) for i in range(30)]  # saturates lists
    vs += [(300, vs[5][1]), (5, vs[5][1]), (None, vs[6][1])]  # copies, a repeated row, a null id
    odd = [(400, None), (401, [0.0] * 16), (402, [float("nan")] * 16), (403, [float("inf")] + [1.0] * 15),
           (404, [None] + [1.0] * 15), (405, [1.0, 2.0]), (406, [])]
    others = [(410, [1.0, 2.0, 3.0]), (411, [2.0, 4.0, 6.0]), (412, [1.0, 2.0, 3.0]), (413, [-1.0, 0.0, 1.0])]  # another length
    df = spark.createDataFrame(vs + odd + others, "vec_id long, embedding array<float>").selectExpr("*", "1 as kept")
    x = np.array([np.float32(v) for _, v in vs], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    comp = list(range(len(vs)))
    for _ in range(len(vs)):
        new = [min([comp[k], *(comp[j] for j in np.flatnonzero(link[k]))]) for k in range(len(vs))]
        if new == comp:
            break
        comp = new
    head = {c: min(vs[k][0] for k in range(len(vs)) if comp[k] == c and vs[k][0] is not None) for c in set(comp)}
    want = [(i, int(link[k].sum()), head[comp[k]], i == head[comp[k]]) for k, (i, _) in enumerate(vs)]
    want += [(i, 0, i, True) for i, _ in odd]
    want += [(410, 2, 410, True), (411, 2, 410, False), (412, 2, 410, False), (413, 0, 413, True)]
    got = [tuple(r) for r in nn_descent.report(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert nn_descent.report(df.limit(0)).count() == 0
    assert nn_descent.report(df.where("vec_id >= 400")).count() == len(odd) + len(others)


def test_near_vectors_of_any_size(spark):
    df = spark.createDataFrame([(1, [1e300, 1e300]), (2, [1e299, 1e299]), (3, [1e-300, 1e-300]), (4, [5e-324, 0.0])],
                               "vec_id long, embedding array<double>")
    got = nn_descent.near_vectors(df).collect()
    assert sorted(tuple(r)[:3] for r in got) == [(1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4)] and {r["recall"] for r in got} == {1.0}


def test_near_vectors_audit_of_few_links(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24))
    pair = x[:1] + rng.normal(size=(1, 24)) * 0.01
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([x, pair]))], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in nn_descent.near_vectors(df).collect()}
    assert got[3000]["component_id"] == 0 and got[3000]["recall"] == 1.0
    assert sum(r["n_links"] for r in got.values()) == 2
    none = nn_descent.near_vectors(df.where("vec_id < 3000")).first()
    assert none["n_links"] == 0 and none["recall"] is None  # no link to measure it with


def test_near_vectors_saturated_lists_grow(spark):
    import numpy as np
    rng = np.random.default_rng(6)
    x = np.concatenate([c + rng.normal(size=(20, 32)) * 0.01 for c in rng.normal(size=(12, 32))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    _, classes, lengths = nn_descent.classes_of(df)
    graph, longer = nn_descent.descend(classes, None, lengths[32], 32, range(3), 8, 0.95)
    # groups of 20: lists of 8 and 16 are full of links, lists of 32 reach beyond the group
    assert {r["k"] for r in longer.collect()} == {32}
    assert nn_descent._saturated(graph, 8, longer, 0.95).count() == 0


def test_near_vectors_bridges_between_saturated_groups(spark):
    import numpy as np
    rng = np.random.default_rng(11)
    a, b = np.zeros(64), np.zeros(64)
    a[0], b[0], b[1] = 1, 0.946, np.sqrt(1 - 0.946 ** 2)
    x = np.concatenate([c + rng.normal(size=(600, 64)) * 0.004 for c in (a, b, -a)])  # more than a block each
    x = np.float32(x).astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    assert link[:600, 600:1200].any() and not link[:1200, 1200:].any()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    want = [(i, int(link[i].sum()), 0 if i < 1200 else 1200, i in (0, 1200)) for i in range(1800)]
    assert sorted(tuple(r) for r in nn_descent.report(df).collect()) == want


def test_near_vectors_audit_sees_lost_pairs_beside_a_large_group(spark):
    import numpy as np
    rng = np.random.default_rng(12)
    large = np.eye(1, 64)[0] + rng.normal(size=(300, 64)) * 0.004
    one = rng.normal(size=(100, 64))
    x = np.concatenate([large, one, one + rng.normal(size=(100, 64)) * 0.05])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows, classes, _ = nn_descent.classes_of(df)
    named = rows.toDF("vid", "node")
    pairs = F.when(F.col("vid") < 400, F.col("vid")).otherwise(F.col("vid") - 100)
    group = F.when(F.col("vid") < 300, 0)
    share = {}
    for name, label in (("all", F.coalesce(group, pairs)), ("lost", F.coalesce(group, F.col("vid")))):
        labels = named.select("node", label.cast("long").alias("component"))
        share[name] = nn_descent.audit(labels, classes, 0.95)
    assert share["all"] == 1.0 and share["lost"] == 0.0


def test_near_vectors_keeps_looking_until_the_recall_holds(spark, monkeypatch):
    shares = iter([0.5, 0.9, 0.9, 0.9, 0.9, 1.0])
    monkeypatch.setattr(nn_descent, "audit", lambda *_: next(shares))
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert {r["recall"] for r in nn_descent.near_vectors(df).collect()} == {1.0}


@pytest.mark.parametrize("run", [debruijn.report, lyndon.report, near_dedup.report, line_dedup.report, tokens.report,
                                 langid.report, mixing.mix, near_dedup.dedup, line_dedup.dedup])
def test_no_rows(none, run):
    assert run(none).count() == 0


def test_no_documents_to_decontaminate(spark, none):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontaminate.report(none, items).count() == 0


def test_pipeline_stages_agree_with_operators(spark, docs, tmp_path):
    """Each stage drops what its operator says, on what the stage before kept."""
    spark.createDataFrame([(1, " ".join(sentence(DE, 205, 40).split()[:20])), (2, sentence(DE, 206, 40))],
                          "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    sf = str(tmp_path)
    kept, frames = docs, {}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"stage{k}")
        step(spark, kept, sf).write.parquet(path)
        kept = frames[name] = spark.read.parquet(path)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "decontamination", "mixing"]
    for n in names[:-1]:
        assert frames[n].columns == docs.columns
    ids = {n: {r["doc_id"] for r in f.select("doc_id").collect()} for n, f in frames.items()}
    assert not {5, 6, 7, 8} & ids["language_id"] and {0, 1, 9, 14} <= ids["language_id"]
    assert 1 not in ids["line_dedup"] and 0 in ids["line_dedup"]
    assert 106 in ids["near_dedup"] and 106 not in ids["decontamination"]
    assert {100, 101} <= ids["decontamination"]
    mixed = {r["doc_id"]: r for r in frames["mixing"].collect()}
    plan = {r["doc_id"]: r["taken"] for r in mixing.mix(frames["decontamination"]).collect()}
    assert {i: r["taken"] for i, r in mixed.items()} == {i: n for i, n in plan.items() if n > 0}
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == frames["mixing"].columns and out.count() == len(mixed)
