"""Embedding near-duplicates with an inverted multi-index.

Vectors are halved and each half has a codebook of its own; the two nearest codewords
name a cell of the product grid. A vector visits the cells nearest to it in the order
of the multi-sequence algorithm, as many as a measured target recall needs, and what
it meets there is verified by its cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import checkpointed, freeing, joined_evenly, tune
from siltline.llm.components import components
from siltline.llm.simhash import forest

#: Rows the codebooks are learned from, rows whose links are first measured by brute force, and the recall they must reach.
TRAIN_ROWS, PROBE_ROWS, TARGET = 16_384, 512, 0.995
#: Probing goes on, in blocks of so many components at most, until so many probe classes have links or all are probed.
LINKED, PROBE_VALUES = 200, 1 << 19
#: Vectors of one cell held at once, and visitors met by one task.
MEMBERS, VISITORS = 1024, 65_536
#: Cells whose distances to some vectors are sorted at once, over all these vectors.
CELLS = 1 << 22


def halves(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of the unit vectors, in double precision."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cut = vectors.shape[1] // 2
    return unit[:, :cut], unit[:, cut:]


def distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centers."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(1), 0)


def codebook(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centers of x by k-means."""
    r = np.random.default_rng(seed)
    centers = x[r.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = distances(x, centers).argmin(1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[r.integers(0, len(x), k)])
    return centers


class Grid:
    """The product of two codebooks; cell (i, j) has number i * k + j."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books, self.k = (first, second), len(first)

    def visits(self, vectors: np.ndarray, most: int) -> np.ndarray:
        """The most cells nearest to each vector, nearest first.

        In the merge of two sorted sequences of distances, the cell of ranks (a, b) comes
        after (a + 1) * (b + 1) - 1 others, so only cells with (a + 1) * (b + 1) <= most can be among them.
        """
        most = min(most, self.k * self.k)
        a, b = np.divmod(np.arange(self.k * self.k), self.k)
        ok = (a + 1) * (b + 1) <= most
        a, b = a[ok], b[ok]
        out = np.empty((len(vectors), most), np.int64)
        step = max(1, min(512, CELLS // len(a)))
        for lo in range(0, len(vectors), step):
            part = halves(vectors[lo : lo + step])
            d = [distances(x, c) for x, c in zip(part, self.books, strict=True)]
            order = [x.argsort(1, kind="stable") for x in d]
            d = [np.take_along_axis(x, o, 1) for x, o in zip(d, order, strict=True)]
            near = (d[0][:, a] + d[1][:, b]).argsort(1, kind="stable")[:, :most]
            out[lo : lo + step] = np.take_along_axis(order[0], a[near], 1) * self.k + np.take_along_axis(order[1], b[near], 1)
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _true_links(probe, grid, least: float):
    """(q, rank, n): the n links of probe vector q that need the cells nearest to it up to rank."""

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = probe.value
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        books, k = grid.value.books, grid.value.k
        near: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            if not len(batch):
                continue
            own = batch.column(0).to_numpy()
            x = _matrix(batch.column(1))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            cell = grid.value.visits(x, 1)[:, 0]
            met = []
            for lo in range(0, len(x), 256):
                y, q = np.nonzero(x[lo : lo + 256] @ unit.T >= least)
                y += lo
                ok = own[y] != ids[q]
                met.append(np.stack([q[ok], cell[y[ok]]], 1))
            pairs, n = np.unique(np.concatenate(met), axis=0, return_counts=True)
            ranks = []
            for q, c in pairs.tolist():
                if q not in near:
                    near[q] = [distances(h, b)[0] for h, b in zip(halves(vectors[q : q + 1]), books, strict=True)]
                    near[q].append(np.sort(near[q][1]))
                first, second, ordered = near[q]
                far = first[c // k] + second[c % k] + 1e-12  # a tie counts as nearer
                ranks.append(int(np.searchsorted(ordered, far - first, "right").sum()) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(ids[pairs[:, 0]], pa.int64()), pa.array(ranks, pa.int64()), pa.array(n, pa.int64())], ["q", "rank", "n"])

    return rows


def _at(ranks: np.ndarray, weights: np.ndarray, target: float) -> int:
    """The least rank up to which the share target of the weights lies."""
    order = ranks.argsort(kind="stable")
    total = np.cumsum(weights[order])
    return int(ranks[order][min(np.searchsorted(total, target * total[-1]), len(order) - 1)])


def cells_needed(classes: DataFrame, grid, total: int, width: int, least: float, target: float, probe_rows: int) -> int:
    """How many cells each class must visit so that the share target of the probes' links is met.

    Blocks of classes, in the order of a hash, are compared with all until LINKED of them
    have links, or none is left to probe: then all links are known, and without any a
    class need visit its own cell only. The share must hold over all links and also with
    each linked class weighing the same, so that a few large groups don't settle it.
    """
    spark, every = classes.sparkSession, 1 << 40
    place = F.pmod(F.xxhash64("rep", F.lit(2)), F.lit(every))
    found, linked, done, size = [], 0, 0, probe_rows
    while done < every and linked < LINKED:
        size = max(1, min(size, PROBE_VALUES // width))
        upto = min(every, done + max(1, int(size / total * every)))
        asked = classes.where((place >= done) & (place < upto)).orderBy("rep").select("rep", "vec").toArrow()  # about size rows
        done, size = upto, size * 4
        if not len(asked):
            continue
        probe = spark.sparkContext.broadcast((asked["rep"].to_numpy(), _matrix(asked["vec"].combine_chunks())))
        links = classes.select("rep", "vec").mapInArrow(_true_links(probe, grid, least), "q long, rank long, n long")
        links = links.groupBy("q", "rank").agg(F.sum("n").alias("n"))
        shares = links.join(links.groupBy("q").agg(F.sum("n").alias("all")), "q")
        per = shares.groupBy("rank").agg(F.sum("n").alias("n"), F.sum(F.col("n") / F.col("all")).alias("share"))
        per = per.toArrow()  # a row for each rank
        probe.destroy()
        if len(per):
            found.append(np.stack([per[c].to_numpy().astype(np.float64) for c in ("rank", "n", "share")]))
            linked += round(found[-1][2].sum())
    if not found:
        return 1
    ranks, n, share = np.concatenate(found, 1)
    return 1 + max(_at(ranks, n, target), _at(ranks, share, target))


def _place(grid, most: int):
    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                visits = grid.value.visits(_matrix(batch.column(2)), most)
                cells = pa.ListArray.from_arrays(np.arange(len(batch) + 1, dtype=np.int32) * visits.shape[1], visits.ravel())
                yield pa.RecordBatch.from_arrays([*batch.columns, cells], [*batch.schema.names, "visits"])

    return rows


def _meet(least: float):
    """Over rows sorted by (cell, part, role): members of a cell, then its visitors. Rows (a, b, n): n more links for a; a and b connect."""

    def met(members: list[pa.RecordBatch], visitors: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not members:  # a block that no member was dealt to
            return
        m, v = (pa.Table.from_batches(x).combine_chunks() for x in (members, visitors))
        mid, vid = m["rep"].to_numpy(), v["rep"].to_numpy()
        mn, vn = m["n"].to_numpy(), v["n"].to_numpy()
        mv = np.stack(m["visits"].to_numpy())
        vcell = np.stack(v["visits"].to_numpy())[:, 0]
        x, y = (_matrix(t["vec"].combine_chunks()) for t in (v, m))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        more_v, more_m = np.zeros(len(vid), np.int64), np.zeros(len(mid), np.int64)
        places = np.unique(np.concatenate([vid, mid]))
        at_v, at_m = np.searchsorted(places, vid), np.searchsorted(places, mid)
        links = []
        for lo in range(0, len(vid), 1024):
            i, j = np.nonzero(x[lo : lo + 1024] @ y.T >= least)
            i += lo
            ok = vid[i] != mid[j]
            i, j = i[ok], j[ok]
            more_v += np.bincount(i, mn[j], len(vid)).astype(np.int64)
            unseen = ~(mv[j] == vcell[i][:, None]).any(1)  # the member never visits the visitor's cell
            more_m += np.bincount(j[unseen], vn[i[unseen]], len(mid)).astype(np.int64)
            links.append((at_v[i], at_m[j]))
        root = forest(len(places), iter(links))
        moved = np.flatnonzero(root != np.arange(len(root)))
        hit_v, hit_m = np.flatnonzero(more_v), np.flatnonzero(more_m)
        a = np.concatenate([vid[hit_v], mid[hit_m], places[moved]])
        b = np.concatenate([vid[hit_v], mid[hit_m], places[root[moved]]])
        n = np.concatenate([more_v[hit_v], more_m[hit_m], np.zeros(len(moved), np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], ["a", "b", "n"])

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members, visitors, held = None, [], [], 0
        for batch in batches:
            if not len(batch):
                continue
            key = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
            cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(key)], strict=True):
                cell, part, role = key[lo].tolist()
                if (cell, part) != now:
                    if visitors:
                        yield from met(members, visitors)
                    now, members, visitors, held = (cell, part), [], [], 0
                (visitors if role else members).append(batch.slice(lo, hi - lo))
                held += (hi - lo) * role
                if held >= 8192:
                    yield from met(members, visitors)
                    visitors, held = [], 0
        if visitors:
            yield from met(members, visitors)

    return rows


def _found(classes: DataFrame, total: int, width: int, least: float, target: float, train_rows: int, probe_rows: int) -> DataFrame:
    """The links of classes of one length, as _meet gives them."""
    spark = classes.sparkSession
    chosen = F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(1 << 40)) < int(min(1.0, train_rows / total) * (1 << 40))
    sample = classes.where(chosen).orderBy("rep").select("vec").toArrow()["vec"].combine_chunks()  # about train_rows rows
    sample = _matrix(sample) if len(sample) else _matrix(classes.limit(1).select("vec").toArrow()["vec"].combine_chunks())
    k = max(1, min(1024, int(np.sqrt(total / 32)), len(sample)))
    grid = spark.sparkContext.broadcast(Grid(*(codebook(h, k, seed) for seed, h in enumerate(halves(sample)))))
    most = cells_needed(classes, grid, total, width, least, target, probe_rows)
    placed = checkpointed(classes.select("rep", "n", "vec").mapInArrow(_place(grid, most), f"rep long, n long, vec {classes.schema['vec'].dataType.simpleString()}, visits array<long>"))
    members = placed.withColumn("cell", F.col("visits")[0])
    visitors = placed.withColumn("cell", F.explode("visits")).withColumn("visits", F.slice("visits", 1, 1))  # where a visitor is a member
    parts = members.groupBy("cell").agg(F.ceil(F.count("*") / MEMBERS).alias("blocks"))
    parts = parts.join(visitors.groupBy("cell").agg(F.ceil(F.count("*") / VISITORS).alias("lanes")), "cell")
    block = F.pmod(F.xxhash64("rep", F.lit(3)), "blocks")
    lane = F.pmod(F.xxhash64("rep", F.lit(4)), "lanes")
    columns = ["cell", "part", "role", "rep", "n", "vec", "visits"]
    left = members.join(parts, "cell").withColumn("part", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("lanes") - 1), lambda x: block * F.col("lanes") + x)))
    right = visitors.join(parts, "cell").withColumn("part", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda x: x * F.col("lanes") + lane)))
    both = left.withColumn("role", F.lit(0).cast("long")).select(columns).unionAll(right.withColumn("role", F.lit(1).cast("long")).select(columns))
    both = both.repartition("cell", "part").sortWithinPartitions("cell", "part", "role")
    return checkpointed(both.mapInArrow(_meet(least), "a long, b long, n long"))


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9, target: float = TARGET,
    train_rows: int = TRAIN_ROWS, probe_rows: int = PROBE_ROWS,
) -> DataFrame:
    """Every vector's links: the id, n_links (other rows with cosine >= least found), component_id (least id reached) and kept.

    Equal vectors are one class and count as links of each other without being paired.
    The codebooks are learned from about train_rows classes; the links of about
    probe_rows classes, or of as many more as it takes to find enough links, are found
    by brute force against all, and each class then visits as many cells as the share
    target of those links needs. Every class is indexed and is a query; a link is
    verified in double precision. Full cells and busy cells are split over several tasks.

    Vectors link with those of their own length; each length has a grid of its own.
    Vectors that are null, empty, zero, or that hold a null or non-finite component link
    with nothing and keep themselves. Rows that repeat an id and vector are vectors of
    their own. Null ids never name a component unless it holds nothing else. An empty
    table gives no rows; other columns are not read. Cells equally near are visited in the order of
    their codewords' distances, then of their numbers; a cosine of exactly least links.
    """
    spark = vectors.sparkSession
    tune(spark)
    kind = vectors.schema[vector_col].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # floats travel as such; all sums are of doubles
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(kind).alias("vec"))
    rows = rows.withColumn("vec", F.when(F.size("vec") == 1, F.transform("vec", F.signum).cast(kind)).otherwise(F.col("vec")))  # one component: only its sign counts
    fine = F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = fine & F.exists("vec", lambda x: x != 0)
    good = rows.where(fine)
    grouped = checkpointed(good.groupBy("vec").agg(F.count("*").alias("n"), F.min("id").alias("least")))
    for seed in range(64):  # a number for each vector: of hashes the first that tells all apart
        classes = grouped.withColumn("rep", F.xxhash64(F.lit(seed), "vec"))
        if classes.agg(F.count("*") == F.count_distinct("rep")).first()[0]:
            break
    else:
        raise RuntimeError("no hash tells the vectors apart")
    sizes = classes.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("total")).where("size > 1 and total > 1").collect()
    found = spark.createDataFrame([], "a long, b long, n long")
    for size, total in sizes:
        found = found.unionAll(_found(classes.where(F.size("vec") == size), total, size, least, target, train_rows, probe_rows))
    counts = found.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("more"))
    roots = components(found.where("n = 0").select("a", "b"))
    classes = classes.drop("vec").join(counts, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left").withColumn("root", F.coalesce("root", "rep"))
    classes = checkpointed(classes)
    sizes = classes.agg(F.count("*"), F.sum("n")).first()
    named = checkpointed(classes.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("_n")))
    classes = joined_evenly(classes, named, "root", sizes[0]).select("rep", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id", F.col("n").alias("_n"))
    classes = checkpointed(classes)
    linked = joined_evenly(good.select("id", F.xxhash64(F.lit(seed), "vec").alias("rep")), classes, "rep", sizes[1] or 0).select("id", "n_links", "component_id")
    lone = rows.where(~F.coalesce(fine, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    component = F.coalesce("component_id", "id")
    return linked.unionByName(lone).select(
        F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )
