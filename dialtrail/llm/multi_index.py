"""Near copies among embeddings by an inverted multi-index.

Unit vectors are cut into halves, each half with a codebook of its own; the pair
of nearest codes is a vector's cell on the product grid. A vector asks for its
neighbours in the cells nearest to it, in the order of the multi-sequence
traversal: by the sum over both halves of the squared distance to the code's
border, which is what a neighbour must at least have moved to lie there. The
traversal ends at the target recall: where the cells' costs, or the number of
cells visited, reach what the target share of neighbours needs. Both are fitted
with the codebooks, on neighbours of each kind that data may hold: the true ones
within the sample, and ones just at the threshold, moved towards other vectors or
anywhere; the kind that needs most decides. Every pair that meets is verified by
its cosine in double precision.

Cells are ordered, and a vector asks only cells from its own on, so a pair meets
at one place. Equal vectors are one from the start, with a count. Large cells
are cut into blocks, and only counts and links that join two groups are written.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtrail.llm.components import components
from dialtrail.llm.runs import whole_runs
from dialtrail.operators.staging import staged

THRESHOLD = 0.95
TARGET_RECALL = 0.98
# Vectors that codebooks and traversal are fitted on: so many, or SAMPLE_OF_CODE
# for each code if that is more; every vector is indexed.
SAMPLE, SAMPLE_OF_CODE = 16_384, 32
FIT_ROUNDS = 12
# Codes of a half: a power of two near sqrt(vectors) / 4, so a cell holds some
# 16 vectors on average up to 2 ** 28 vectors, where the sample is 2 ** 17.
LEAST_CODES, MOST_CODES = 8, 4096
# Of the sample: vectors whose true neighbours are looked for, pairs of them, and
# pairs of each kind whose cells are counted.
COMPARED, PAIRS, RANKED = 4096, 1 << 15, 1024
FEWEST_PAIRS = 50  # a kind with fewer in the sample tells nothing
BLOCK_MEMBERS = 2048
BLOCK_ASKING = 32_768


def usable(embedding: str) -> Column:
    """Not null, all components finite, one of them not zero."""
    finite = F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    """(rows, width) unit vectors; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    out /= np.abs(out).max(axis=1, keepdims=True, initial=1e-300)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _square_distances(x, codes):
    apart = (x**2).sum(axis=1)[:, None] - 2 * x @ codes.T + (codes**2).sum(axis=1)
    return np.maximum(apart, 0)


def _codebook(x: np.ndarray, k: int, rng) -> np.ndarray:
    """k codes by Lloyd's rounds; a code without vectors takes a far one."""
    codes = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(FIT_ROUNDS):
        apart = _square_distances(x, codes)
        nearest = apart.argmin(axis=1)
        count = np.bincount(nearest, minlength=len(codes))
        sums = np.zeros_like(codes)
        np.add.at(sums, nearest, x)
        codes = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], codes)
        lone = np.flatnonzero(count == 0)
        codes[lone] = x[np.argsort(-apart.min(axis=1), kind="stable")[: len(lone)]]
    return np.unique(codes, axis=0)


@dataclass
class Index:
    width: int
    codes: list[np.ndarray]
    radius: float = 0.0  # squared; the costliest cell of a traversal
    visits: int = 1 << 62  # cells of a traversal

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The cell of each vector, and per half the squared distance it must
        move to come into the reach of each code."""
        own, costs = [], []
        for half, codes in zip((x[:, : self.width // 2], x[:, self.width // 2 :]), self.codes):
            apart = _square_distances(half, codes)
            nearest = apart.argmin(axis=1)
            between = _square_distances(codes, codes)[nearest]
            ahead = apart - apart[np.arange(len(x)), nearest][:, None]
            costs.append(np.where(between > 0, ahead**2 / np.maximum(4 * between, 1e-300), 0))
            own.append(nearest)
        return own[0] * len(self.codes[1]) + own[1], costs

    def traversal(self, costs: list[np.ndarray], row: int) -> np.ndarray:
        """Cells in the order of their costs' sum, as far as the target recall."""
        first, second = costs[0][row], costs[1][row]
        a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        sorted_b = second[b]
        reach = np.searchsorted(sorted_b, self.radius - first[a], side="right")
        a, reach = a[reach > 0], reach[reach > 0]
        i = np.repeat(a, reach)
        j = b[np.arange(len(i)) - np.repeat(np.cumsum(reach) - reach, reach)]
        order = np.argsort(first[i] + second[j], kind="stable")[: self.visits]
        return (i * len(self.codes[1]) + j)[order]

    def needed(self, x: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What it takes to reach the cell of ``near[i]`` from ``x[i]``: its cost,
        and for RANKED of them the number of cells up to it."""
        cell, _ = self.cells(near)
        _, costs = self.cells(x)
        i, j = np.divmod(cell, len(self.codes[1]))
        rows = np.arange(len(x))
        cost = costs[0][rows, i] + costs[1][rows, j]
        visits = []
        for r in np.linspace(0, len(x) - 1, min(RANKED, len(x))).astype(int):
            ahead = np.searchsorted(np.sort(costs[1][r]), cost[r] - costs[0][r], side="right")
            visits.append(int(ahead.sum()))
        return cost, np.array(visits)


def _true_pairs(sample: np.ndarray, threshold: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different vectors of the sample at the threshold or nearer."""
    some = sample[rng.permutation(len(sample))[:COMPARED]]
    a, b = [np.zeros(0, int)], [np.zeros(0, int)]
    for at in range(0, len(some), 512):
        i, j = np.nonzero(some[at : at + 512] @ some.T >= threshold)
        other = i + at != j
        a.append(i[other] + at)
        b.append(j[other])
    a, b = np.concatenate(a), np.concatenate(b)
    drawn = rng.permutation(len(a))[:PAIRS]
    return some[a[drawn]], some[b[drawn]]


def _moved(sample: np.ndarray, towards: np.ndarray, threshold: float):
    """Vectors and their neighbours just at the threshold in a direction; a vector
    that lies in the direction itself is left out."""
    aside = towards - (towards * sample).sum(axis=1, keepdims=True) * sample
    norm = np.linalg.norm(aside, axis=1, keepdims=True)
    some = norm[:, 0] > 1e-9
    aside = aside[some] / norm[some]
    return sample[some], threshold * sample[some] + max(0.0, 1 - threshold**2) ** 0.5 * aside


def fit(sample: np.ndarray, k: int, threshold: float, recall: float, seed: int = 5) -> Index:
    """Codebooks of the sample's halves, and where the traversal ends: neighbours
    of each kind are out of its radius, or behind its last visit, for half of the
    share that ``recall`` leaves."""
    rng = np.random.default_rng(seed)
    width = sample.shape[1]
    halves = sample[:, : width // 2], sample[:, width // 2 :]
    index = Index(width, [_codebook(h, k, rng) for h in halves])
    drawn = sample[rng.permutation(len(sample))[:SAMPLE]]
    kinds = [
        _moved(drawn, rng.normal(size=drawn.shape), threshold),
        _moved(drawn, drawn[rng.permutation(len(drawn))], threshold),
        _true_pairs(sample, threshold, rng),
    ]
    radii, visits = [0.0], [1.0]
    for number, (x, near) in enumerate(kinds):
        if len(x) and (number == 0 or len(x) >= FEWEST_PAIRS):
            cost, cells = index.needed(x, near)
            radii.append(np.quantile(cost, (1 + recall) / 2))
            visits.append(np.quantile(cells, (1 + recall) / 2))
    index.radius, index.visits = float(max(radii)) + 1e-12, int(np.ceil(max(visits)))
    return index


def codes_for(vectors: int) -> int:
    wanted = max(1.0, vectors**0.5 / 4)
    return int(min(MOST_CODES, max(LEAST_CODES, 2 ** round(np.log2(wanted)))))


MEMBERS = "node bigint, n bigint, embedding array<double>, cell bigint, asks boolean, home boolean"


def _places(classes: DataFrame, shared, width: int) -> DataFrame:
    """Each vector as a member of its cell, and as asking in the cells of its
    traversal from its own on."""

    def run(batches):
        index = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                own, costs = index.cells(unit_rows(some.column("embedding"), width))
                rows, cells = [], []
                for r in range(some.num_rows):
                    asked = index.traversal(costs, r)
                    asked = asked[asked >= own[r]]
                    rows.append(np.full(len(asked), r))
                    cells.append(asked)
                for asks, row, cell in (
                    (False, np.arange(some.num_rows), own),
                    (True, np.concatenate(rows), np.concatenate(cells)),
                ):
                    taken = some.take(pa.array(row, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(taken.column(c) for c in ("node", "n", "embedding")),
                            pa.array(cell, pa.int64()),
                            pa.array(np.full(len(row), asks)),
                            pa.array(cell == own[row]),
                        ],
                        names=["node", "n", "embedding", "cell", "asks", "home"],
                    )

    return classes.select("node", "n", "embedding").mapInArrow(run, MEMBERS)


def _in_blocks(places: DataFrame) -> DataFrame:
    """Members and asking vectors of a cell meet block by block."""
    sizes = (
        places.groupBy("cell")
        .agg(F.count_if(~F.col("asks")).alias("_m"), F.count_if("asks").alias("_a"))
        .filter("_m > 0")
    )
    member_blocks = F.ceil(F.col("_m") / BLOCK_MEMBERS).cast("bigint")
    asking_blocks = F.greatest(F.lit(1), F.ceil(F.col("_a") / BLOCK_ASKING)).cast("bigint")
    here = F.xxhash64("node")
    own = F.when(F.col("asks"), F.pmod(here, asking_blocks)).otherwise(
        F.pmod(here, member_blocks)
    )
    other = F.when(F.col("asks"), member_blocks).otherwise(asking_blocks)
    return (
        places.join(sizes, "cell")
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), other - 1)))
        .withColumns(
            {
                "members": F.when(F.col("asks"), F.col("_other")).otherwise(F.col("_own")),
                "asking": F.when(F.col("asks"), F.col("_own")).otherwise(F.col("_other")),
            }
        )
        .drop("_m", "_a", "_own", "_other")
    )


LINKS = "a bigint, b bigint, n bigint"


def _links(blocks: DataFrame, width: int, threshold: float) -> DataFrame:
    """Rows (a, null, n): n vectors linked to a, met in one block. Rows (a, b,
    null): links that join the vectors met in one block."""
    keys = ["cell", "members", "asking"]

    def run(batches):
        for table, starts in whole_runs(batches, keys):
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                group = table.slice(s, e - s)
                asks = group.column("asks").to_numpy()
                if asks.all() or not asks.any():
                    continue
                node, n = group.column("node").to_numpy(), group.column("n").to_numpy()
                x = unit_rows(group.column("embedding"), width)
                members = np.flatnonzero(~asks)
                label = members.copy()
                linked = np.zeros(len(node), np.int64)
                a, b = [], []
                asking = np.flatnonzero(asks)
                # The own cell is asked as well: there the smaller node asks.
                home = group.column("home").to_numpy()
                for at in range(0, len(asking), 1024):
                    some = asking[at : at + 1024]
                    hit = x[some] @ x[members].T >= threshold
                    hit &= ~home[some, None] | (node[some][:, None] < node[members])
                    linked[some] += hit @ n[members]
                    linked[members] += n[some] @ hit
                    for r in np.flatnonzero(hit.any(axis=1)).tolist():
                        met = np.flatnonzero(hit[r])
                        labels, first = np.unique(label[met], return_index=True)
                        a += [node[some[r]]] * len(labels)
                        b += node[members[met[first]]].tolist()
                        if len(labels) > 1:
                            label[np.isin(label, labels)] = labels[0]
                got = np.flatnonzero(linked)
                yield _rows(node[got], None, linked[got])
                yield _rows(a, b, None)

    return blocks.mapInArrow(run, LINKS)


def _rows(a, b, n):
    nothing = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(a, pa.int64()),
            nothing if b is None else pa.array(b, pa.int64()),
            nothing if n is None else pa.array(n, pa.int64()),
        ],
        names=["a", "b", "n"],
    )


def near_copies(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row (stages data).

    Vectors that are null, zero, or hold null or non-finite components link with
    nothing. Vectors of different lengths are compared as if the shorter ended
    in zeros. Equal vectors are always linked; equal rows are vectors of their
    own. Of links between different vectors about ``recall`` are found, more of
    those well above the threshold. A missing vec_id is no one's component
    unless all of a component lack theirs. No rows give no rows.
    """
    rows = vectors.select(
        F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>")
    )
    fit_rows = rows.filter(usable("embedding"))
    classes = staged(
        fit_rows.groupBy("embedding")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    count, width = classes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    width = max(2, width or 2)
    codes = codes_for(count)
    sample = (
        classes.select("embedding")
        .orderBy(F.xxhash64("embedding"), "embedding")
        .limit(max(SAMPLE, SAMPLE_OF_CODE * codes))
        .toArrow()
    )
    unlinked = rows.select(
        "vec_id",
        F.lit(0).cast("bigint").alias("n_links"),
        F.col("vec_id").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    if not count:
        return unlinked
    index = fit(unit_rows(sample.column("embedding"), width), codes, threshold, recall)
    shared = vectors.sparkSession.sparkContext.broadcast(index)
    places = staged(_places(classes, shared, width), "places")
    keys = ["cell", "members", "asking"]
    links = staged(
        _links(
            _in_blocks(places).repartition(*keys).sortWithinPartitions(*keys), width, threshold
        ),
        "links",
    )
    degree = links.filter(F.col("b").isNull()).groupBy("a").agg(F.sum("n").alias("others"))
    found = components(links.filter(F.col("b").isNotNull()))
    named = staged(
        classes.join(degree, F.col("node") == F.col("a"), "left")
        .drop("a")
        .join(found, "node", "left")
        .select(
            "embedding",
            "first_id",
            (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "named",
    )
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_vector = named.join(smallest, "component").select("embedding", "n_links", "component_id")
    linked = fit_rows.join(by_vector, "embedding").select(
        "vec_id",
        "n_links",
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
    others = rows.filter(~usable("embedding")).select("vec_id")
    return linked.unionByName(
        others.select(
            "vec_id",
            F.lit(0).cast("bigint").alias("n_links"),
            F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    )
