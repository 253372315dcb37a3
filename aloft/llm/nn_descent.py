"""Embedding near-dedup by NN-descent.

1. Equal vectors form a class; classes are compared.  Vectors that are null, zero, or
   hold null or non-finite components link with nothing.  Vectors of different lengths have
   no cosine: each length is a graph of its own.
2. A neighbour graph starts from sign-random-projection buckets: every class gets its
   nearest ones among a block of its bucket, in several tables.
3. Each round joins the neighbours of every class (both directions) with one another:
   neighbours of neighbours that are nearer than a list's last entry replace it.
   Rounds go on until few lists change.  The number of tables follows the number of
   buckets: a link at the threshold shares a bucket of one of them with chance ``recall``.
4. A list can be saturated: all its entries are links, so more may exist.  The lists of such classes
   are doubled in length and rounds go on, until their last entries are below the threshold or
   they are ``LONGEST`` entries long.
5. Edges at the threshold are confirmed in double precision and kept; their connected
   components are the groups.  Classes whose lists are still saturated (those of large groups) are
   compared with those of all other components, in cells; a pair of cells is left out only where the
   angle between their centres less both radii excludes a link.  Links found there join components.
6. Recall is audited against brute force: a sample of classes that have links and one of classes that
   have none are compared with all classes, and the samples grow until they hold ``AUDIT_LINKED`` classes
   with true links, or ``AUDIT_MOST`` classes each.  The share of links found is estimated for classes of few
   and of many links apart, each sampled class standing for as many as its sample does.  Until both reach
   ``recall`` further tables, blocks dealt anew and rounds follow; past ``MAX_TURNS`` an error is raised.
   Where no sampled class has a link, recall is not measured, and null.
7. Numbers of links: the classes of a component are compared with one another in blocks,
   and each task returns numbers, not pairs.

Lists around a class with very many neighbours and large components are cut into
blocks dealt to different tasks; no group is gathered in one.  Vectors are divided by their largest
component before their norm is taken, so that it neither overflows nor vanishes.  Null vec_ids take part
in links but never name a component that has another id; repeated ids are rows of their own.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aloft.llm.common import stage
from aloft.llm.components import components

THRESHOLD = 0.95
#: length of a neighbour list at first, and the length up to which saturated lists are doubled
NEIGHBOURS = 8
LONGEST = 32
#: rows aimed at in a bucket of a table, and most in a block of one
BUCKET = 128
BLOCK = 512
#: entries of one class's neighbourhood joined in one task
FAN = 64
#: rounds end when fewer than this share of the list entries changes
SETTLED = 0.01
RECALL = 0.995
#: classes in each of the audit's samples at first and at most, and classes with true links wanted in both
AUDIT = 500
AUDIT_MOST = 8000
AUDIT_LINKED = 30
#: turns of tables and rounds after which a recall that is still too low is an error
MAX_TURNS = 30
#: cells whose centres are compared in one task
CELLS = 4096
#: slack (radians) of the bound on cells, far above the rounding of single precision
SLACK = 2e-3


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), -1)


def classes_of(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding"):
    """(rows, classes, lengths): rows have vid, cid (null: links with nothing); classes have cid, m (their
    vectors), dim (their length), unit (doubles) and small (floats) of the unit vector; lengths: number of
    classes by dim."""
    v = vectors.select(F.col(id_col).alias("vid"), F.col(vector_col).cast("array<double>").alias("e"))
    bad = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    sound = F.coalesce(F.col("e").isNotNull() & ~bad & F.exists("e", lambda x: x != 0), F.lit(False))
    v = v.withColumn("e", F.when(sound, F.col("e")))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            units, smalls, dims = [], [], []
            for x in b.column(2).to_pylist():
                x = np.array(x)
                x = x / np.abs(x).max()
                x /= np.linalg.norm(x)
                units.append(x.tobytes())
                smalls.append(x.astype(np.float32).tobytes())
                dims.append(len(x))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(dims, pa.int32()), pa.array(units, pa.binary()),
                 pa.array(smalls, pa.binary())], ["cid", "m", "dim", "unit", "small"])

    rows = stage(v, "vectors")
    numbered = stage(rows.where("e is not null").groupBy("e").agg(F.count(F.lit(1)).alias("m"))
                     .select(F.monotonically_increasing_id().alias("cid"), "m", "e"), "vector-classes")
    classes = stage(numbered.mapInArrow(unit, "cid long, m long, dim int, unit binary, small binary"), "unit-vectors")
    named = rows.join(numbered.select("e", "cid"), "e", "left").select("vid", "cid")
    lengths = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect()}
    return named, classes, lengths


def _best(sim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k largest entries of each row."""
    k = min(k, sim.shape[1])
    cols = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    return np.repeat(np.arange(len(sim)), k), cols.ravel()


def _grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Consecutive rows with equal values in the first ``n_keys`` (long) columns, as tables."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)], axis=1)
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        edges = [0, *cut.tolist(), b.num_rows]
        if rest and any(rest[-1].column(i)[-1].as_py() != keys[0, i] for i in range(n_keys)):
            yield pa.Table.from_batches(rest)
            rest = []
        for s, e in zip(edges[:-1], edges[1:]):
            if e == b.num_rows:
                rest.append(b.slice(s, e - s))
            else:
                yield pa.Table.from_batches([*rest, b.slice(s, e - s)])
                rest = []
    if rest:
        yield pa.Table.from_batches(rest)


def _column(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy()


def _small(t: pa.Table, name: str = "small") -> np.ndarray:
    return np.frombuffer(b"".join(t.column(name).to_pylist()), dtype=np.float32).reshape(t.num_rows, -1)


def _bits(n: int) -> int:
    """Projection bits of a table over ``n`` classes."""
    return max(0, (n // BUCKET).bit_length())


def tables_for(n: int, threshold: float, recall: float) -> int:
    """Tables in one of which a link at the threshold shares a bucket with chance ``recall``."""
    share = (1 - np.arccos(threshold) / np.pi) ** _bits(n)
    return 1 if share >= recall else int(np.ceil(np.log1p(-recall) / np.log1p(-share)))


def _seed(classes: DataFrame, n: int, dim: int, tables: range, k: int) -> DataFrame:
    """Candidate edges (u, v, s) from blocks of projection buckets."""
    bits = _bits(n)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = [np.random.default_rng(1000 + t).standard_normal((dim, bits)).astype(np.float32) for t in tables]
        for b in batches:
            x = _matrix(b.column(1), np.float32)
            for t, p in zip(tables, planes):
                key = ((x @ p) > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.astype(np.int64) * (1 << 20) + t), b.column(0), b.column(1)], ["bucket", "cid", "small"])

    dealt = classes.select("cid", "small").mapInArrow(deal, "bucket long, cid long, small binary")
    sizes = stage(dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "nn-buckets")
    dealt = dealt.join(sizes, "bucket").withColumn(
        "block", F.pmod(F.xxhash64("bucket", "cid"), F.expr(f"(size + {BLOCK} - 1) div {BLOCK}")))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, 2):
            if t.num_rows < 2:
                continue
            cid, x = _column(t, "cid"), _small(t)
            sim = x @ x.T
            np.fill_diagonal(sim, -2)
            r, c = _best(sim, k)
            r, c = r[sim[r, c] > -2], c[sim[r, c] > -2]
            yield pa.RecordBatch.from_arrays([pa.array(cid[r]), pa.array(cid[c]), pa.array(sim[r, c])], ["u", "v", "s"])

    return (dealt.select("bucket", "block", "cid", "small").repartition("bucket", "block")
            .sortWithinPartitions("bucket", "block").mapInArrow(near, "u long, v long, s float"))


def _nearest(edges: DataFrame, k: int, longer: DataFrame | None = None) -> DataFrame:
    """The k nearest entries of each list; of the lists in ``longer`` (u, k) their own number."""
    over = Window.partitionBy("u").orderBy(F.desc("s"), "v")
    placed = edges.groupBy("u", "v").agg(F.max("s").alias("s")).withColumn("place", F.row_number().over(over))
    placed = placed.where(F.col("place") <= (k if longer is None else LONGEST))
    if longer is not None:
        placed = placed.join(longer, "u", "left").where(F.col("place") <= F.coalesce("k", F.lit(k)))
    return placed.select("u", "v", "s")


def _round(graph: DataFrame, classes: DataFrame, k: int, deal: int, longer: DataFrame | None = None) -> DataFrame:
    """Candidates from joining the neighbours of every class with one another; ``deal`` numbers the
    deals of large neighbourhoods into parts."""
    most = k if longer is None else LONGEST
    last = graph.groupBy("u").agg(F.min("s").alias("last"), F.count(F.lit(1)).alias("n"))
    size = F.lit(k) if longer is None else F.coalesce("k", F.lit(k))
    last = (last if longer is None else last.join(longer, "u", "left")).select(
        "u", F.when(F.col("n") < size, -2.0).otherwise(F.col("last")).cast("float").alias("last"))
    around = (graph.select(F.col("u").alias("w"), F.col("v").alias("x"))
              .unionByName(graph.select(F.col("v").alias("w"), F.col("u").alias("x"))).distinct())
    sizes = stage(around.groupBy("w").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "nn-sizes")
    have = stage(classes.select("cid", "small").join(last, F.col("cid") == F.col("u"), "left").select(
        "cid", "small", F.coalesce("last", F.lit(-2.0).cast("float")).alias("last")), "nn-last")
    lists = (around.join(sizes, "w").withColumn(
        "part", F.pmod(F.xxhash64("w", "x", F.lit(deal)), F.expr(f"(size + {FAN} - 1) div {FAN}")))
        .join(have, F.col("x") == F.col("cid")).select("w", "part", "cid", "small", "last"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, ss, held = [], [], [], 0
        for t in _grouped(batches, 2):
            if t.num_rows < 2:
                continue
            cid, x, bound = _column(t, "cid"), _small(t), _column(t, "last")
            sim = x @ x.T
            np.fill_diagonal(sim, -2)
            r, c = _best(sim, most)
            ok = sim[r, c] > bound[r]
            us.append(cid[r[ok]]), vs.append(cid[c[ok]]), ss.append(sim[r[ok], c[ok]])
            held += int(ok.sum())
            if held > 50_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(a)) for a in (us, vs, ss)], ["u", "v", "s"])
                us, vs, ss, held = [], [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)) for a in (us, vs, ss)], ["u", "v", "s"])

    return (lists.repartition("w", "part").sortWithinPartitions("w", "part")
            .mapInArrow(local, "u long, v long, s float"))


def _saturated(graph: DataFrame, k: int, longer: DataFrame | None, threshold: float) -> DataFrame:
    """(u, k) of the lists that are full and whose last entry is a link."""
    full = graph.groupBy("u").agg(F.min("s").alias("last"), F.count(F.lit(1)).alias("n")).where(F.col("last") >= threshold - 1e-4)
    own = full.withColumn("k", F.lit(k)) if longer is None else full.join(longer, "u", "left").withColumn(
        "k", F.coalesce("k", F.lit(k)))
    return own.where(F.col("n") >= F.col("k")).select("u", "k")


def descend(classes: DataFrame, graph: DataFrame | None, n: int, dim: int, tables: range, k: int, threshold: float,
            longer: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The neighbour graph (u, v, s) after seeding ``tables`` and descending until settled, and (u, k) of the lists
    that were made longer because they were saturated."""
    seeds = _seed(classes, n, dim, tables, k)
    graph = stage(_nearest(seeds if graph is None else graph.unionByName(seeds), k, longer), "nn-graph")
    deal = tables.start * 1000
    while True:
        found = _round(graph, classes, k, deal, longer)
        deal += 1
        new = stage(_nearest(graph.unionByName(found), k, longer), "nn-graph")
        changed = new.join(graph, ["u", "v"], "left_anti").count()
        graph = new
        if changed > SETTLED * n * k:
            continue
        # settled: lists that are full of links get twice the length, and the rounds go on
        short = stage(_saturated(graph, k, longer, threshold).where(F.col("k") < LONGEST).select(
            "u", F.least(F.col("k") * 2, F.lit(LONGEST)).alias("k")), "nn-longer")
        if short.isEmpty():
            return graph, longer
        longer = short if longer is None else stage(
            longer.unionByName(short).groupBy("u").agg(F.max("k").alias("k")), "nn-lengths")


def links_of(graph: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Edges (a < b) of the graph whose cosine in double precision reaches the threshold."""
    near = graph.where(F.col("s") >= threshold - 1e-4).select(
        F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    side = classes.select("cid", "unit")
    both = near.join(side.toDF("a", "x"), "a").join(side.toDF("b", "y"), "b").select("a", "b", "x", "y")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if t.num_rows:
                ok = (_matrix(t.column(2), np.float64) * _matrix(t.column(3), np.float64)).sum(axis=1) >= threshold
                yield pa.RecordBatch.from_arrays([t.column(0).filter(pa.array(ok)), t.column(1).filter(pa.array(ok))],
                                                 ["a", "b"])

    return both.mapInArrow(confirm, "a long, b long")


def bridges(graph: DataFrame, classes: DataFrame, labels: DataFrame, dim: int, threshold: float, k: int,
            longer: DataFrame | None = None) -> DataFrame:
    """Links (a, b) between components, one or more for every two that are linked by classes with saturated lists."""
    full = _saturated(graph, k, longer, threshold).select(F.col("u").alias("cid"))
    found = labels.select(F.col("node").alias("cid"), "component").join(full, "cid")
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    rows = found.join(stage(sizes, "nn-full"), "component").join(classes.select("cid", "unit"), "cid")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(999).standard_normal((dim, 40))
        for b in batches:
            if b.num_rows:
                bits = np.ceil(np.log2(np.maximum(b.column(1).to_numpy() / BLOCK, 1))).astype(np.int64)
                side = (_matrix(b.column(3), np.float64) @ planes > 0) & (np.arange(40) < bits[:, None])
                key = side @ (1 << np.arange(40, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(key), b.column(2), b.column(3)],
                                                 ["component", "key", "cid", "unit"])

    keyed = stage(rows.select("component", "size", "cid", "unit").mapInArrow(
        deal, "component long, key long, cid long, unit binary"), "nn-keyed")
    sizes = keyed.groupBy("component", "key").agg(F.count(F.lit(1)).alias("size"))
    members = stage(keyed.join(sizes, ["component", "key"]).withColumn(
        "chunk", F.pmod(F.xxhash64("cid"), F.expr(f"(size + {BLOCK} - 1) div {BLOCK}")))
        .select(F.xxhash64("component", "key", "chunk").alias("cell"), "component", "cid", "unit"), "nn-members")

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, 1):
            x = np.frombuffer(b"".join(t.column("unit").to_pylist())).reshape(t.num_rows, -1)
            c = x.mean(axis=0)
            c = c / np.linalg.norm(c) if np.linalg.norm(c) > 0 else x[0]
            radius = float(np.arccos(np.clip((x @ c).min(), -1, 1)))
            yield pa.RecordBatch.from_arrays(
                [t.column("cell").combine_chunks()[:1], t.column("component").combine_chunks()[:1],
                 pa.array([radius]), pa.array([c.astype(np.float32).tobytes()], pa.binary())],
                ["cell", "component", "radius", "small"])

    cells = stage(members.repartition("cell").sortWithinPartitions("cell").mapInArrow(
        centre, "cell long, component long, radius double, small binary"), "nn-cells")
    parts = max(1, -(-cells.count() // CELLS))
    dealt = cells.withColumn("part", F.pmod(F.col("cell"), F.lit(parts))).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>"))).select(
        F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "cell", "component",
        "radius", "small")
    reach = float(np.arccos(threshold)) + SLACK

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, 2):
            cell, comp, radius, part = (_column(t, c) for c in ("cell", "component", "radius", "part"))
            x = _small(t)
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            one, two = np.flatnonzero(part == i), np.flatnonzero(part == j)
            for at in range(0, len(one), BLOCK):
                a = one[at:at + BLOCK]
                angle = np.arccos(np.clip(x[a] @ x[two].T, -1, 1))
                near = (angle <= radius[a][:, None] + radius[two][None, :] + reach) & (
                    comp[a][:, None] != comp[two][None, :])
                if i == j:
                    near &= cell[a][:, None] < cell[two][None, :]
                r, c = np.nonzero(near)
                yield pa.RecordBatch.from_arrays([pa.array(cell[a][r]), pa.array(cell[two][c])], ["p", "q"])

    pairs = stage(dealt.repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(close, "p long, q long"),
                  "nn-cell-pairs")
    sides = pairs.select("p", "q", F.col("p").alias("cell")).unionByName(
        pairs.select("p", "q", F.col("q").alias("cell"))).join(members, "cell")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, 2):
            cid, cell, comp = _column(t, "cid"), _column(t, "cell"), _column(t, "component")
            x = np.frombuffer(b"".join(t.column("unit").to_pylist())).reshape(t.num_rows, -1)
            one, two = (np.flatnonzero(cell == t.column(c)[0].as_py()) for c in ("p", "q"))
            r, c = np.nonzero((x[one] @ x[two].T >= threshold) & (comp[one][:, None] != comp[two][None, :]))
            # one link joins two components; their numbers are counted afterwards
            _, first = np.unique(np.stack([comp[one][r], comp[two][c]]), axis=1, return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(cid[one][r[first]]), pa.array(cid[two][c[first]])], ["a", "b"])

    return (sides.select("p", "q", "cell", "component", "cid", "unit").repartition("p", "q")
            .sortWithinPartitions("p", "q").mapInArrow(compare, "a long, b long"))


def _true_shares(ids: np.ndarray, units: np.ndarray, labels: DataFrame, classes: DataFrame, threshold: float) -> list:
    """(class, its true links, those inside its component) of the sampled classes that have any."""
    sent = classes.sparkSession.sparkContext.broadcast((ids, units))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = sent.value
        for b in batches:
            if b.num_rows:
                cid = b.column(0).to_numpy()
                x = _matrix(b.column(1), np.float64)
                for at in range(0, len(ids), BLOCK):
                    i, j = np.nonzero((x @ q[at:at + BLOCK].T >= threshold) & (cid[:, None] != ids[None, at:at + BLOCK]))
                    yield pa.RecordBatch.from_arrays([pa.array(cid[i]), pa.array(ids[at:at + BLOCK][j])], ["a", "b"])

    true = classes.select("cid", "unit").mapInArrow(scan, "a long, b long")
    label = labels.select("node", "component")
    return (true.join(label.toDF("a", "ca"), "a", "left").join(label.toDF("b", "cb"), "b", "left").groupBy("b")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("ca") == F.col("cb")).alias("found"))).collect()


def audit(labels: DataFrame, classes: DataFrame, threshold: float, sample: int = AUDIT) -> float | None:
    """Estimated share of the true links (brute force against all) that lie in one component: of classes of few links
    and of many (more than a list holds at first), whichever is less.  None if no sampled class has a link."""
    place = F.shiftrightunsigned(F.xxhash64(F.lit("audit"), "cid"), 11) / F.lit(float(1 << 53))
    named = classes.select("cid", "unit").join(labels.select(F.col("node").alias("cid"), F.lit(True).alias("linked")), "cid", "left")
    strata = stage(named.select("cid", "unit", F.coalesce("linked", F.lit(False)).alias("linked"), place.alias("place")), "nn-strata")
    sizes = {r["linked"]: r["n"] for r in strata.groupBy("linked").agg(F.count(F.lit(1)).alias("n")).collect()}
    while True:
        ids, units, weight = [], [], {}
        for linked, n in sizes.items():
            share = min(1.0, sample / n)
            chosen = strata.where((F.col("linked") == linked) & (F.col("place") < share)).limit(2 * sample).collect()  # bounded
            for r in chosen:
                ids.append(r["cid"]), units.append(r["unit"])
                weight[r["cid"]] = n / len(chosen)
        if not ids:
            return None
        found = _true_shares(np.array(ids), np.stack([np.frombuffer(u) for u in units]), labels, classes, threshold)
        if len(found) >= AUDIT_LINKED or sample >= AUDIT_MOST or sample >= max(sizes.values()):
            break
        sample = min(AUDIT_MOST, 4 * sample)
    shares = []
    for many in (False, True):
        own = [(weight[r["b"]], r["found"] / r["n"]) for r in found if (r["n"] > NEIGHBOURS) == many]
        if own:
            shares.append(sum(w * x for w, x in own) / sum(w for w, _ in own))
    return min(shares, default=None)


def count_links(classes: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """(cid, others): vectors of other classes linked to a class, counted over its whole component."""
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    rows = (labels.join(stage(sizes, "nn-components"), "component")
            .withColumn("blocks", F.expr(f"(size + {BLOCK} - 1) div {BLOCK}"))
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
            .join(classes, F.col("node") == F.col("cid")))
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid",
        "m", "unit")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, 3):
            cid, m, block = _column(t, "cid"), _column(t, "m"), _column(t, "block")
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            x = np.frombuffer(b"".join(t.column("unit").to_pylist())).reshape(t.num_rows, -1)
            one, two = np.flatnonzero(block == i), np.flatnonzero(block == j)
            linked = (x[one] @ x[two].T >= threshold) & (cid[one][:, None] != cid[two][None, :])
            ids, n = cid[one], linked @ m[two]
            if i != j:
                ids, n = np.concatenate([ids, cid[two]]), np.concatenate([n, m[one] @ linked])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n.astype(np.int64))], ["cid", "others"])

    return (dealt.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
            .mapInArrow(count, "cid long, others long").groupBy("cid").agg(F.sum("others").alias("others")))


def components_of(classes: DataFrame, n: int, dim: int, threshold: float, k: int, recall: float) -> tuple[DataFrame, float | None]:
    """(node, component) of the linked classes of one length, and the recall as audited."""
    graph, labels, share, longer = None, None, None, None
    tables = tables_for(n, threshold, recall)
    for turn in range(MAX_TURNS):
        graph, longer = descend(classes, graph, n, dim, range(turn * tables, (turn + 1) * tables), k, threshold, longer)
        links = links_of(graph, classes, threshold)
        labels = stage(components(links), "nn-labels")
        more = stage(bridges(graph, classes, labels, dim, threshold, k, longer), "nn-bridges")
        if not more.isEmpty():
            labels = stage(components(links.unionByName(more)), "nn-labels")
        share = audit(labels, classes, threshold)
        if share is None or share >= recall:
            return labels, share
    raise RuntimeError(f"near-dedup found {share:.4f} of the sampled links after {MAX_TURNS} turns, not {recall}")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 threshold: float = THRESHOLD, k: int = NEIGHBOURS, recall: float = RECALL) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, recall (as audited, the least of all lengths; null
    where no link was there to measure it)."""
    rows, classes, lengths = classes_of(vectors, id_col, vector_col)
    labels = vectors.sparkSession.createDataFrame([], "node long, component long")
    others = vectors.sparkSession.createDataFrame([], "cid long, others long")
    shares = []
    for dim, n in lengths.items():
        own = classes.where(F.col("dim") == dim) if len(lengths) > 1 else classes
        found, share = components_of(own, n, dim, threshold, k, recall)
        shares.append(share)
        labels, others = labels.unionByName(found), others.unionByName(count_links(own, found, threshold))
    share = min((x for x in shares if x is not None), default=None)
    found = (classes.select("cid", "m").join(labels, F.col("cid") == F.col("node"), "left")
             .join(others, "cid", "left")
             .select("cid", (F.col("m") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "cid").alias("component")))
    found = stage(found, "nn-found")
    named = rows.join(found, "cid", "left")
    heads = stage(named.where("cid is not null").groupBy("component").agg(F.min("vid").alias("head")), "nn-heads")
    out = named.join(heads, "component", "left")
    component = F.when(F.col("cid").isNull(), F.col("vid")).otherwise(F.col("head"))
    return out.select(F.col("vid").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vid").eqNullSafe(component).alias("kept"),
                      F.lit(share).cast("double").alias("recall"))


def report(vectors: DataFrame) -> DataFrame:
    return near_vectors(vectors).select("vec_id", "n_links", "component_id", "kept")
