"""Near-duplicate vectors with spherical-cap filters.

Filters are the directions of a structured random product code: after a pseudo-rotation a vector is cut into blocks, and a
direction is one random codeword per block. A vector passes all filters whose cap holds it; they are list-decoded block by block,
with the best that the open blocks can still add as bound, so the many directions are never listed. Two vectors of
the wanted cosine pass several common filters. The number of directions grows with the number of vectors, so a filter holds few
vectors whatever the size of the table. Each vector's cap is as high as it takes to hold a fixed number of filters, which is
calibrated on random pairs at the threshold.

Tight groups are folded before anything is joined: vectors with the same nearest direction that lie within half the
threshold's angle of one centre are all linked with each other, so they travel as one class with a radius. Classes
that share a filter meet with 8-bit sketches, of which rounding errors are carried as bounds; what may be near is
verified on the vectors themselves. Two classes whose radii settle it are linked as a whole; the others are compared member
by member, in blocks that give back counts. Pairs of vectors never become rows, pairs of classes do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairngraph.llm.ann import cosines, rotate
from cairngraph.llm.common import components, stored
from cairngraph.llm.registry import query, table
from cairngraph.llm.vectors import by_groups, good_rows, pieces, units, usual_length

SLACK = 1e-7  # of angles between class centres
LOAD = 8  # vectors in a filter, on average
MERGE = 4096  # local classes that are folded at once
BLOCK = 2048  # classes of one filter, or members of one class, that are compared at once


class Filters:
    """The directions and the caps for about `n` vectors of `dim` components and pairs of at least `cosine`."""

    def __init__(self, n: int, dim: int, cosine: float, blocks: int = 2, seed: int = 7):
        self.dim, self.blocks = dim, blocks
        self.width = max(1 << (dim - 1).bit_length(), 4 * blocks)
        self.words = max(64, math.ceil((30 * n / LOAD) ** (1 / blocks)))
        rng = np.random.Generator(np.random.PCG64(seed))
        codes = rng.standard_normal((blocks, self.words, self.width // blocks))
        self.codes = codes / np.sqrt((codes * codes).sum(2, keepdims=True)) / math.sqrt(blocks)
        self.seed = seed
        self.count = self._calibrated(cosine, rng)

    def _calibrated(self, cosine: float, rng: np.random.Generator, pairs: int = 1000) -> int:
        """How many filters a vector's cap must hold for random pairs at the threshold to share one."""
        x = units(rng.standard_normal((pairs, self.dim)))
        other = rng.standard_normal((pairs, self.dim))
        other -= (other * x).sum(1, keepdims=True) * x
        size = np.sqrt((other * other).sum(1, keepdims=True))
        y = units(cosine * x + math.sqrt(1 - cosine * cosine) * other / np.where(size > 1e-9, size, np.inf))
        total = self.words**self.blocks
        self.count = 32
        while True:
            (ra, ca, na), (rb, cb, nb) = self.decode(x), self.decode(y)
            common, i, j = np.intersect1d(ra * total + ca, rb * total + cb, return_indices=True)
            need = np.full(pairs, total)
            np.minimum.at(need, common // total, np.maximum(na[i], nb[j]) + 1)
            wanted = int(1.25 * np.sort(need)[pairs - 3])  # all pairs but a few in a thousand, and a quarter more
            if wanted <= self.count or self.count >= total:
                return min(max(wanted, 16), total)
            self.count = min(2 * self.count, total)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The directions in the cap of each row: row, direction and rank, by row and nearest first."""
        # a cap's height is the row's own: it holds `count` directions
        out = []
        step = max(1, min(512, 2_000_000 // self.words))
        share = min(0.5, 3 * self.count / self.words**self.blocks)
        for at in range(0, len(x), step):
            open_rows, height = np.arange(at, min(at + step, len(x))), NormalDist().inv_cdf(1 - share) / math.sqrt(self.width)
            while len(open_rows):
                row, code, product = self._decode(x[open_rows], height)
                enough = (np.bincount(row, minlength=len(open_rows)) >= self.count) | (height < -1)
                order = np.lexsort((code, -product, row))
                row, code = row[order], code[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row)
                keep = enough[row] & (rank < self.count)
                out.append((open_rows[row[keep]], code[keep], rank[keep]))
                open_rows = open_rows[~enough]
                height -= 0.25 / math.sqrt(self.width)
        if not out:
            return (np.zeros(0, np.int64),) * 3
        row, code, rank = (np.concatenate(c) for c in zip(*out, strict=True))
        order = np.argsort(row, kind="stable")
        return row[order], code[order], rank[order]

    def _decode(self, x: np.ndarray, height: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, direction and product of every direction at `height` or above it."""
        y = rotate(np.pad(x, ((0, 0), (0, self.width - x.shape[1]))), self.seed)
        part = self.width // self.blocks
        scores = [y[:, k * part : (k + 1) * part] @ self.codes[k].T for k in range(self.blocks)]
        top = [s.max(1) for s in scores]
        total = sum(top)
        row, code, got = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x))
        rest = total.copy()
        for s, t in zip(scores, top, strict=True):
            rest = rest - t
            # codewords that can be part of a long enough sum at all, by row
            r, word = np.nonzero(s >= (height - (total - t) - 1e-12)[:, None])
            first = np.searchsorted(r, np.arange(len(x) + 1))
            count = np.diff(first)[row]
            back = np.repeat(np.arange(len(row)), count)
            word = word[np.arange(len(back)) - np.repeat(np.cumsum(count) - count, count) + first[row[back]]]
            now = got[back] + s[row[back], word]
            keep = now + rest[row[back]] >= height
            row, code, got = row[back][keep], (code[back] * self.words + word)[keep], now[keep]
        return row, code, got


def _angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Angles of unit vectors, row by row; exact for small ones, too."""
    d = x - y
    return 2 * np.arcsin(np.minimum(np.sqrt((d * d).sum(-1)) / 2, 1.0))


def _gathered(key: np.ndarray, x: np.ndarray, reach: float) -> np.ndarray:
    """For every row the first row of its class: rows of equal `key` within an angle of `reach` from it."""
    lead = np.arange(len(key))
    order = np.argsort(key, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1], [True]]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        rows = order[a:b]
        while len(rows) > 1:
            near = x[rows] @ x[rows[0]] >= math.cos(reach)
            near[0] = True
            lead[rows[near]] = rows[0]
            rows = rows[~near]
    return lead


def _coded(filters: Filters, dim: int, reach: float, kind: str):
    """Every row with a number of its own; rows that take part with their local class, its first row with all of the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for whole in batches:
            for batch in pieces(whole, dim):
                n = batch.num_rows
                key = (int(batch.column("split")[0].as_py()) << 32) + number + np.arange(n)
                number += n
                at, x = good_rows(batch, dim)
                some = (x != 0).any(1)
                at, x = at[some], x[some]
                local = pa.nulls(n, pa.int64())
                rows: dict[str, list] = {c: [None] * n for c in ("x", "best", "filters", "center", "radius", "size", "least")}
                if len(at):
                    unit = units(x)
                    row, code, rank = filters.decode(unit)
                    best = code[rank == 0]
                    lead = _gathered(best, unit, reach)
                    members = np.argsort(lead, kind="stable")
                    edges = np.flatnonzero(np.append(True, lead[members][1:] != lead[members][:-1]))
                    groups = np.split(members, edges[1:])
                    begin = np.searchsorted(row, np.arange(len(at) + 1))
                    ids = batch.column("vec_id").take(pa.array(at)).to_numpy()
                    for group in groups:
                        if len(group) > 1:
                            center = units(unit[group].mean(0, keepdims=True))
                            angle = _angles(unit[group], center)
                            far = group[angle > reach]
                            group, angle = group[angle <= reach], angle[angle <= reach]
                            lead[far] = far
                            if len(group):
                                lead[group] = group[0]
                        else:
                            far = group[:0]
                        for rows_of, around, radius in [(group, "center", None), *[(far[i : i + 1], None, 0.0) for i in range(len(far))]]:
                            if not len(rows_of):
                                continue
                            g = at[rows_of[0]]
                            passed = np.concatenate([code[begin[r] : begin[r + 1]] for r in rows_of.tolist()])
                            rows["best"][g] = int(best[rows_of[0]])
                            rows["filters"][g] = np.unique(passed)
                            rows["size"][g] = len(rows_of)
                            rows["least"][g] = int(ids[rows_of].min())
                            rows["radius"][g] = 0.0
                            if around and len(rows_of) > 1:
                                rows["center"][g] = center[0].tobytes()
                                rows["radius"][g] = float(angle.max())
                    values = x.astype(kind)
                    for i, g in enumerate(at.tolist()):
                        rows["x"][g] = values[i].tobytes()
                    mask = np.ones(n, bool)
                    mask[at] = False
                    held = np.zeros(n, np.int64)
                    held[at] = key[at[lead]]
                    local = pa.array(held, mask=mask)
                yield pa.record_batch(
                    {
                        "key": pa.array(key, pa.int64()),
                        "vec_id": batch.column("vec_id"),
                        "local": local,
                        "x": pa.array(rows["x"], pa.binary()),
                        "best": pa.array(rows["best"], pa.int64()),
                        "filters": pa.array(rows["filters"], pa.list_(pa.int64())),
                        "center": pa.array(rows["center"], pa.binary()),
                        "radius": pa.array(rows["radius"], pa.float64()),
                        "size": pa.array(rows["size"], pa.int64()),
                        "least": pa.array(rows["least"], pa.int64()),
                    }
                )

    return run


def _matrix(center: list, x: list, kind: str) -> np.ndarray:
    """Unit vectors: a class's centre, or the one vector it has."""
    rows = [np.frombuffer(c) if c is not None else units(np.frombuffer(v, kind).astype(np.float64)[None, :])[0] for c, v in zip(center, x, strict=True)]
    return np.array(rows)


def _sketch(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit components, their scale, and how far the sketch is from the vector."""
    scale = np.abs(unit).max(1) / 127
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.sqrt(((code * scale[:, None] - unit) ** 2).sum(1))
    return code, scale, error


def _merged(reach: float, kind: str):
    """Local classes of one nearest direction, folded into classes."""

    def step(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = rows.num_rows
        unit = _matrix(rows.column("center").to_pylist(), rows.column("x").to_pylist(), kind)
        radius, size, least, local = (rows.column(c).to_numpy().copy() for c in ("radius", "size", "least", "local"))
        group = np.zeros(n, np.int64)
        group[starts] = 1
        group = np.cumsum(group)
        lead = np.arange(n)
        several = np.flatnonzero(np.bincount(group)[group] > 1)
        several = several[np.lexsort((local[several], -size[several], group[several]))]
        edges = np.flatnonzero(np.append(True, np.diff(group[several]) != 0)) if len(several) else []
        for members in np.split(several, edges[1:]) if len(several) else []:
            while len(members) > 1:
                near = _angles(unit[members], unit[members[0]]) + radius[members] + SLACK <= reach
                near[0] = True
                lead[members[near]] = members[0]
                members = members[~near]
        order = np.argsort(lead, kind="stable")
        edges = np.flatnonzero(np.append(True, lead[order][1:] != lead[order][:-1]))
        filters = rows.column("filters").to_pylist()
        center, x = rows.column("center").to_pylist(), rows.column("x").to_pylist()
        code, scale, error = _sketch(unit)
        out = []
        for members in np.split(order, edges[1:]):
            first = members[0] if len(members) == 1 else lead[members[0]]
            many = len(members) > 1
            out.append(
                {
                    "class": int(local[first]),
                    "locals": local[members].tolist(),
                    "filters": np.unique(np.concatenate([filters[m] for m in members])).tolist() if many else filters[first],
                    "center": unit[first].tobytes() if many else center[first],
                    "x": None if many else x[first],
                    "radius": float((_angles(unit[members], unit[first]) + radius[members]).max()) + SLACK if many else float(radius[first]),
                    "size": int(size[members].sum()),
                    "least": int(least[members].min()),
                    "code": code[first].tobytes(),
                    "scale": float(scale[first]),
                    "error": float(error[first]),
                }
            )
        yield pa.RecordBatch.from_pylist(out, schema=MERGED)

    return step


MERGED = pa.schema(
    {
        "class": pa.int64(), "locals": pa.list_(pa.int64()), "filters": pa.list_(pa.int64()), "center": pa.binary(), "x": pa.binary(),
        "radius": pa.float64(), "size": pa.int64(), "least": pa.int64(), "code": pa.binary(), "scale": pa.float64(), "error": pa.float64(),
    }
)


def _met(theta: float):
    """Pairs of classes in a filter that may hold linked vectors."""

    def near(i: np.ndarray, j: np.ndarray, dot: np.ndarray, radius: np.ndarray, error: np.ndarray) -> np.ndarray:
        bound = dot + error[i] * (1 + error[j]) + error[j] * (1 + error[i]) + error[i] * error[j] + 1e-5
        return bound >= np.cos(np.minimum(theta + radius[i] + radius[j] + SLACK, np.pi))

    def step(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = rows.num_rows
        code = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.int8).reshape(n, -1)
        unit = code.astype(np.float32) * rows.column("scale").to_numpy().astype(np.float32)[:, None]
        radius, error = rows.column("radius").to_numpy(), rows.column("error").to_numpy()
        cls, block = rows.column("class").to_numpy(), rows.column("block").to_numpy()
        ends = np.append(starts[1:], n)
        found = []
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            if b - a <= 64:
                continue
            sides = [a + np.flatnonzero(block[a:b] == k) for k in np.unique(block[a:b])]
            left, right = sides[0], sides[-1]
            dot = unit[left] @ unit[right].T
            loose = np.cos(min(theta + radius[left].max() + radius[right].max() + SLACK, np.pi))
            i, j = np.nonzero(dot >= loose - 3 * error[a:b].max() - 1e-5 - error[a:b].max() ** 2 * 3)
            i, j, dot = left[i], right[j], dot[i, j]
            keep = near(i, j, dot, radius, error) & (cls[i] != cls[j])
            found.append((i[keep], j[keep]))
        # small groups: each row with those after it in its group
        end = np.repeat(ends, ends - starts)
        small = np.repeat(ends - starts <= 64, ends - starts)
        count = np.where(small, end - np.arange(n) - 1, 0)
        total = np.cumsum(count)
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + 400_000, "right")))
            c = count[at:to]
            i = np.repeat(np.arange(at, to), c)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
            keep = near(i, j, np.einsum("ij,ij->i", unit[i], unit[j]), radius, error) & (cls[i] != cls[j])
            found.append((i[keep], j[keep]))
            at = to
        i, j = (np.concatenate(c) for c in zip(*found, strict=True))
        pair = np.unique(np.stack([np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j])], 1), axis=0)
        if len(pair):
            yield pa.record_batch({"a": pair[:, 0].copy(), "b": pair[:, 1].copy()})

    return step


def _verified(cosine: float, theta: float, kind: str):
    """Pairs of classes that are linked as a whole (`sure`) or have to be compared by members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one = [_matrix(batch.column(f"center_{s}").to_pylist(), batch.column(f"x_{s}").to_pylist(), kind) for s in "ab"]
            size = [batch.column(f"size_{s}").to_numpy() for s in "ab"]
            angle = _angles(*one)
            spread = batch.column("radius_a").to_numpy() + batch.column("radius_b").to_numpy()
            sure, perhaps = angle + spread <= theta - SLACK, angle - spread <= theta + SLACK
            both = np.flatnonzero((size[0] == 1) & (size[1] == 1))
            if len(both):
                x = [np.array([np.frombuffer(v, kind) for v in batch.column(f"x_{s}").take(pa.array(both)).to_pylist()], np.float64) for s in "ab"]
                sure[both] = perhaps[both] = cosines(*x) >= cosine
            keep = pa.array(sure | perhaps)
            out = {c: batch.column(c).filter(keep) for c in ("a", "b", "size_a", "size_b")}
            yield pa.record_batch(out | {"sure": pa.array(sure).filter(keep)})

    return run


def _members(cosine: float, kind: str):
    """Links of the members of two classes, a block of each: counts by member, and once the pair of classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = ("a", "b", "left", "right")
            for a, b, left, right in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                x, y = (np.array([np.frombuffer(r["x"], kind) for r in side], np.float64) for side in (left, right))
                i, j = np.nonzero(units(x) @ units(y).T >= cosine - 1e-9)
                linked = np.concatenate([cosines(x[i[k : k + 50_000]], y[j[k : k + 50_000]]) >= cosine for k in range(0, len(i), 50_000)] or [np.zeros(0, bool)])
                i, j = i[linked], j[linked]
                if not len(i):
                    continue
                counts = []
                for side, rows in ((left, i), (right, j)):
                    at, n = np.unique(rows, return_counts=True)
                    counts += [(side[k]["key"], c) for k, c in zip(at.tolist(), n.tolist(), strict=True)]
                key, n = zip(*counts, strict=True)
                m = len(key)
                yield pa.record_batch(
                    {
                        "key": pa.array([*key, None], pa.int64()),
                        "n": pa.array([*n, 0], pa.int64()),
                        "a": pa.array([None] * m + [a], pa.int64()),
                        "b": pa.array([None] * m + [b], pa.int64()),
                    }
                )

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """`vec_id`, `n_links`, `component_id` and `kept` for every row of `vectors` (`vec_id`, `embedding`).

    Two rows link if their cosine is found to be `cosine` or more; every row counts, those that share an id or are alike,
    too. `component_id` is the least id reachable by links, itself included; the row of that id is `kept`. Rows whose
    vector is null, zero, of another length than the most frequent one or holds null or non-finite components, and rows with
    a null id, link with nothing and are kept. An empty table gives no row; other columns are ignored. No link is found
    that is none; of pairs right at the threshold about one in a thousand is missed, of closer ones fewer.
    """
    if not 0.5 <= cosine < 1:
        raise ValueError("cosine must lie between 0.5 and 1")
    floats = dict(vectors.dtypes)["embedding"] == "array<float>"
    kind, wide = ("<f4", "array<float>") if floats else ("<f8", "array<double>")
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(wide).alias("embedding"))
    dim = usual_length(plain)
    alone = plain.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not dim:
        return alone
    theta = math.acos(cosine)
    reach = theta / 2 - SLACK
    filters = Filters(plain.filter(F.size("embedding") == dim).count(), dim, cosine)
    coded = stored(
        plain.withColumn("split", F.spark_partition_id()).mapInArrow(
            _coded(filters, dim, reach, kind),
            "key long, vec_id long, local long, x binary, best long, filters array<long>, center binary, radius double, size long, least long",
        )
    )
    firsts = coded.filter("best is not null").select("local", "best", "filters", "center", "x", "radius", "size", "least")
    crowded = firsts.groupBy("best").agg(F.ceil(F.count(F.lit(1)) / MERGE).alias("parts")).filter("parts > 1")
    firsts = firsts.join(crowded, "best", "left").withColumn("part", F.pmod(F.xxhash64("local"), F.coalesce("parts", F.lit(1)))).drop("parts")
    merged = firsts.repartition("best", "part").sortWithinPartitions("best", "part")
    classes = stored(
        merged.mapInArrow(
            by_groups(["best", "part"], _merged(reach, kind), 8192),
            "class long, locals array<long>, filters array<long>, center binary, x binary, radius double, size long, least long, "
            "code binary, scale double, error double",
        )
    )
    passed = classes.select("class", "code", "scale", "error", "radius", F.explode("filters").alias("filter"))
    hot = classes.select(F.explode("filters").alias("filter")).groupBy("filter").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")).filter("blocks > 1")
    dealt = passed.join(hot, "filter", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")
    keys = ["filter", "low", "high"]
    met = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(by_groups(keys, _met(theta)), "a long, b long").distinct()
    for side in "ab":
        sides = classes.select(F.col("class").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("center", "x", "radius", "size")])
        met = met.join(sides, side)
    pairs = stored(met.mapInArrow(_verified(cosine, theta, kind), "a long, b long, size_a long, size_b long, sure boolean"))
    open_pairs = pairs.filter("not sure")
    asked = open_pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    of_class = classes.select("class", "size", F.explode("locals").alias("local"))
    packed = (
        coded.select("key", "local", "x")
        .join(of_class.join(asked, "class", "left_semi"), "local")
        .groupBy("class", F.pmod(F.xxhash64("key"), F.ceil(F.col("size") / BLOCK)).alias("block"))
        .agg(F.collect_list(F.struct("key", "x")).alias("rows"))
    )
    blocks = lambda size: F.sequence(F.lit(0).cast("long"), F.ceil(F.col(size) / BLOCK) - 1)
    grid = open_pairs.select("a", "b", F.explode(blocks("size_a")).alias("i"), "size_b").select("a", "b", "i", F.explode(blocks("size_b")).alias("j"))
    grid = grid.join(packed.select(F.col("class").alias("a"), F.col("block").alias("i"), F.col("rows").alias("left")), ["a", "i"])
    grid = grid.join(packed.select(F.col("class").alias("b"), F.col("block").alias("j"), F.col("rows").alias("right")), ["b", "j"])
    counted = stored(grid.select("a", "b", "left", "right").mapInArrow(_members(cosine, kind), "key long, n long, a long, b long"))
    by_member = counted.filter("key is not null").groupBy("key").agg(F.sum("n").alias("own"))
    sure = pairs.filter("sure")
    by_class = (
        sure.select(F.explode(F.array(F.struct(F.col("a").alias("class"), F.col("size_b").alias("n")), F.struct(F.col("b").alias("class"), F.col("size_a").alias("n")))).alias("s"))
        .groupBy("s.class")
        .agg(F.sum("s.n").alias("of_others"))
    )
    links = sure.select("a", "b").unionByName(counted.filter("key is null").select("a", "b"))
    tied = classes.select("class", "locals", "size", "least").join(components(links).withColumnRenamed("id", "class"), "class", "left")
    tied = tied.withColumn("component", F.coalesce("component", "class"))
    least = tied.groupBy("component").agg(F.min("least").alias("component_id"))
    known = tied.join(least, "component").join(by_class, "class", "left").filter("size > 1 or component_id <> least or of_others is not null or component <> class")
    known = known.select(F.explode("locals").alias("local"), (F.col("size") - 1 + F.coalesce("of_others", F.lit(0))).alias("shared"), "component_id")
    rows = coded.select("key", "vec_id", "local").join(known, "local", "left").join(by_member, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id",
        (F.coalesce("shared", F.lit(0)) + F.coalesce("own", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


ORACLE = r"""
with recursive v as (
  select vec_id, cast(embedding as double[]) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), l as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.9
), r as (
  select vec_id as a, vec_id as b from embeddings
  union
  select r.a, l.b from r join l on r.b = l.a
), n as (select a, count(*) as n from l group by a)
select e.vec_id, coalesce(max(n.n), 0) as n_links, min(r.b) as component_id, e.vec_id = min(r.b) as kept
from embeddings e join r on e.vec_id = r.a left join n on e.vec_id = n.a group by e.vec_id
"""


@query("op13_near_vectors", ORACLE)
def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
