"""Language identification by nearest centroid over TF-IDF character n-grams.

A text is a normalised TF-IDF vector of hashed character 1-, 2- and 3-grams
(lower-cased, everything but letters is one space).  Every language has several
centroids, found by spherical k-means on a sample of its labelled documents.
The language of the nearest centroid by cosine is the prediction.  Its distance is
judged against what training texts of that language and of like length (a power of two
of n-grams) have: a text is rejected where it exceeds their median by more than
``reject_factor`` times what their farthest per cent does.  A length class of fewer than
``CLASS_ROWS`` texts takes in the next shorter ones; texts shorter than all that were
learned have no limit.

* Document frequencies and distances count all training documents.  Only the clustering is
  fitted on a bounded sample: about ``sample_per_lang`` documents of a language
  with the smallest hash of their id (fewer where a language has fewer).
* The model (idf and centroids) is as large as the number of languages and is
  sent to the tasks; texts never meet outside their input split, but for the
  sample of one language.
* A text that is null or has no letter is ``und`` with score 0 and rejected.  So
  is every text when nothing can be learned (no labelled rows).  Texts are used
  whole; a null id counts as not held out and is not trained on; repeated rows are
  judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.llm import textops
from aloft.llm.common import free_name

DIM = 4096
CENTROIDS = 4
SAMPLE_PER_LANG = 1500
REJECT_FACTOR = 2.0
#: length classes, training texts a class needs, and bins of the distances counted in it
CLASSES = 40
CLASS_ROWS = 100
BINS = 1000
ROUNDS = 12
UND = "und"

_LETTER = np.zeros(0x110000, dtype=np.uint32)
_ALPHA_READY = False


def _letters() -> np.ndarray:
    """code point -> itself for letters, else a space (built once per process)."""
    global _ALPHA_READY
    if not _ALPHA_READY:
        _LETTER[:] = 0x20
        letters = [c for c in range(len(_LETTER)) if chr(c).isalpha()]
        _LETTER[letters] = letters
        _ALPHA_READY = True
    return _LETTER


def counts(texts: list[str | None], dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts of each text (rows x dim), and whether it has a letter."""
    lowered = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) + 2 for t in lowered], dtype=np.int64)
    raw = "".join(f" {t} " for t in lowered).encode("utf-32-le", "surrogatepass")
    code = _letters()[np.frombuffer(raw, dtype=np.uint32)]
    row = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    letter = code != 0x20
    has = np.bincount(row[letter], minlength=len(texts)) > 0
    # runs of spaces count as one
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    keep[np.r_[0, np.cumsum(sizes)[:-1]]] = True
    code, row, letter = code[keep].astype(np.uint64), row[keep] * dim, letter[keep]
    out = np.zeros(len(texts) * dim, dtype=np.int64)
    shift = np.uint64(64 - (dim - 1).bit_length())
    h = np.zeros(len(code), dtype=np.uint64)
    for n in range(3):
        if n >= len(code):
            break
        h = h[: len(code) - n] * textops.MULT_B + code[n:] * textops.MULT_A
        same = row[n:] == row[: len(row) - n]
        same &= letter[n:] | letter[: len(letter) - n]
        gram = (textops.mix(h) >> shift).astype(np.int64)
        out += np.bincount((row[: len(row) - n] + gram)[same], minlength=len(out))
    return out.reshape(len(texts), dim), has


def _batches(texts: list[str | None], limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` characters (a longer text stands alone)."""
    offsets = np.cumsum([0, *(len(t or "") + 2000 for t in texts)])
    yield from textops.chunks(offsets, limit)


def vectors(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (np.log1p(count) * idf).astype(np.float32)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def length_class(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(count.sum(axis=1), 1)).astype(np.int64), CLASSES - 1)


def distance_places(hist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Median and farthest per cent of each length class from counts (CLASSES x BINS) of distances
    (infinite: shorter than every text counted)."""
    size = hist.sum(axis=1)
    middle, far = np.full(len(hist), np.inf), np.full(len(hist), np.inf)
    for c in range(len(hist)):
        if not size[:c + 1].any():
            continue
        low = c
        while low and size[low:c + 1].sum() < CLASS_ROWS:
            low -= 1
        few = size[low:c + 1].sum() < CLASS_ROWS
        upto = np.cumsum(hist.sum(axis=0) if few else hist[low:c + 1].sum(axis=0))
        middle[c], far[c] = ((np.searchsorted(upto, q * upto[-1]) + 1) / hist.shape[1] for q in (0.5, 0.99))
    return middle, far


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # centroids x dim, unit length
    middle: np.ndarray  # centroids x length classes: its language's median distance
    farthest: np.ndarray  # the same, at the farthest per cent

    def predict(self, texts: list[str | None], reject_factor: float):
        """(language, score, rejected) of each text."""
        out: list[tuple[str, float, bool]] = []
        for i, j in _batches(texts):
            count, has = counts(texts[i:j], len(self.idf))
            if not len(self.languages):
                out += [(UND, 0.0, True)] * (j - i)
                continue
            cosine = vectors(count, self.idf) @ self.centroids.T
            best = cosine.argmax(axis=1)
            middle, far_at = (a[best, length_class(count)] for a in (self.middle, self.farthest))
            # infinite where the length was not learned
            limit = np.where(np.isinf(middle), np.inf, middle + reject_factor * (far_at - np.where(
                np.isinf(middle), 0, middle)))
            for k, ok in enumerate(has):
                c = float(min(1.0, max(0.0, cosine[k, best[k]])))
                far = 1.0 - c > limit[k]
                out.append((self.languages[best[k]], c, bool(far)) if ok else (UND, 0.0, True))
        return out


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means with farthest-first starts; deterministic for ordered rows."""
    start = [x.mean(axis=0)]
    near = x @ (start[0] / max(np.linalg.norm(start[0]), 1e-12))
    start = [x[near.argmax()]]
    near = x @ start[0]
    while len(start) < min(k, len(x)):
        at = int(near.argmin())
        if near[at] > 1 - 1e-6:
            break
        start.append(x[at])
        near = np.maximum(near, x @ x[at])
    c = np.array(start)
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        new = np.stack([x[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, c, atol=1e-5):
            break
        c = new
    return c


def held_out(doc_id: Column) -> Column:
    """The contract's test fold: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, dim: int = DIM, k: int = CENTROIDS, sample_per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Learn from the labelled documents (doc_id, text, lang) outside the test fold."""
    rows = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
        & ~held_out(F.col("doc_id")))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(dim, dtype=np.int64), 0
        for b in batches:
            texts = b.column(0).to_pylist()
            for i, j in _batches(texts):
                df += (counts(texts[i:j], dim)[0] > 0).sum(axis=0)
            n += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()), pa.array([n, *df], pa.int64())],
                                         ["gram", "n"])

    found = rows.select("text").mapInArrow(frequencies, "gram int, n long").groupBy("gram").agg(
        F.sum("n").alias("n")).collect()  # dim + 1 rows at any size
    df = np.zeros(dim + 1)
    for r in found:
        df[r["gram"] + 1] = r["n"]
    idf = np.log((1 + df[0]) / (1 + df[1:])) + 1

    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n_lang"))
    # a uniform number in [0, 1) from the id; ids below sample/size are the sample
    place = F.shiftrightunsigned(F.xxhash64(F.lit("langid"), "doc_id"), 11) / F.lit(float(1 << 53))
    sample = rows.join(F.broadcast(sizes), "lang").where(place * F.col("n_lang") < sample_per_lang)

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            for i, j in _batches(texts):
                v = vectors(counts(texts[i:j], dim)[0], idf)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                     pa.array([x.tobytes() for x in v], pa.binary())], ["lang", "doc_id", "v"])

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "v"])
        x = np.stack([np.frombuffer(b, dtype=np.float32) for b in group["v"]])
        x = x[np.linalg.norm(x, axis=1) > 0]
        if not len(x):
            return pd.DataFrame({"lang": [], "c": []})
        c = kmeans(x, k)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "c": [v.astype(np.float32).tobytes() for v in c]})

    embedded = T.StructType([T.StructField("lang", T.StringType()), T.StructField("doc_id", docs.schema["doc_id"].dataType),
                             T.StructField("v", T.BinaryType())])
    learned = (sample.select("lang", "doc_id", "text").mapInArrow(embed, embedded)
               .groupBy("lang").applyInPandas(cluster, "lang string, c binary").collect())
    learned.sort(key=lambda r: (r["lang"], bytes(r["c"])))  # k rows a language
    languages = [r["lang"] for r in learned]
    centroids = np.stack([np.frombuffer(r["c"], dtype=np.float32) for r in learned]) if learned else np.zeros(
        (0, dim), np.float32)
    names = sorted(set(languages))
    at = np.array([names.index(x) for x in languages], dtype=np.int64)
    if not names:
        return Model(idf, languages, centroids, np.zeros((0, CLASSES)), np.zeros((0, CLASSES)))
    sent = docs.sparkSession.sparkContext.broadcast((idf, centroids, at))

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, centroids, at = sent.value
        hist = np.zeros(len(names) * CLASSES * BINS, dtype=np.int64)
        for b in batches:
            texts = b.column(0).to_pylist()
            for i, j in _batches(texts):
                count, has = counts(texts[i:j], dim)
                cosine = vectors(count, idf) @ centroids.T
                gap = np.clip(1 - cosine.max(axis=1), 0, 1)
                place = np.minimum((gap * BINS).astype(np.int64), BINS - 1)
                place += (at[cosine.argmax(axis=1)] * CLASSES + length_class(count)) * BINS
                np.add.at(hist, place[has], 1)
        used = np.flatnonzero(hist)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(hist[used])], ["place", "n"])

    hist = np.zeros(len(names) * CLASSES * BINS, dtype=np.int64)
    for r in rows.select("text").mapInArrow(distances, "place long, n long").groupBy("place").agg(
            F.sum("n").alias("n")).collect():  # at most languages x classes x bins
        hist[r["place"]] = r["n"]
    places = [distance_places(h) for h in hist.reshape(len(names), CLASSES, BINS)]
    return Model(idf, languages, centroids, np.stack([places[i][0] for i in at]), np.stack([places[i][1] for i in at]))


def identify(docs: DataFrame, model: Model, reject_factor: float = REJECT_FACTOR) -> DataFrame:
    """``docs`` with lang_pred, score and rejected."""
    docs = docs.drop("lang_pred", "score", "rejected")
    names = docs.columns
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few vectors a language
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = sent.value.predict(b.column(b.schema.get_field_index("text")).to_pylist(), reject_factor)
            lang, score, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in names), pa.array(lang, pa.string()),
                 pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                [*names, "lang_pred", "score", "rejected"])

    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""
    model = train(docs, **options)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """The documents whose language is recognised (columns of ``docs``)."""
    model = train(docs, **options)
    if not {"lang_pred", "score", "rejected"} & {c.lower() for c in docs.columns}:
        return identify(docs, model).where(~F.col("rejected")).select(*docs.columns)
    row, = free_name(docs, "identified_row")
    packed = docs.select(F.struct(*docs.columns).alias(row), "text")
    return identify(packed, model).where(~F.col("rejected")).select(f"{row}.*")
