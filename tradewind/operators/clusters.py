"""K-means with all starts fitted in the same passes, reproducible to the last bit.

Points are whole numbers, so a cluster's sums are exact and its centre does not depend on the order
of addition. The centres of all starts, a few hundred numbers, stay with the driver; each pass finds every
point's nearest centre of every start in one aggregation. Starts that have settled leave the passes, and after a few passes only the best goes on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import first_match

MOST_PASSES = 40
#: Squared moves of a start's centres, in deviations, below which it has settled.
TOLERANCE = 1e-4
#: Passes after which only the best start goes on.
RACE = 5
Centre = tuple[float, ...]


@dataclass(frozen=True)
class Clusters:
    """Centres in the units of the axes, and what a unit of each axis weighs (one over its deviation)."""

    axes: list[str]
    scales: list[float]
    centres: list[Centre]

    def nearest(self) -> Column:
        """Number of the nearest centre, the first of equally near ones."""
        return _nearest(self.axes, self.scales, [[F.lit(x) for x in c] for c in self.centres])


def _nearest(axes: list[str], scales: list[float], centres: list[list[Column]]) -> Column:
    def distance(centre: list[Column]) -> Column:
        parts = [(F.col(a).cast("double") - c) * F.lit(s) for a, c, s in zip(axes, centre, scales)]
        total = parts[0] * parts[0]
        for part in parts[1:]:
            total = total + part * part
        return total

    measured = [distance(c) for c in centres]
    least = F.least(*measured) if len(measured) > 1 else measured[0]
    return first_match([(d == least, F.lit(c)) for c, d in enumerate(measured)])


def fit(
    points: DataFrame, axes: list[str], weight: str, k: int, starts: int = 10, most_passes: int = MOST_PASSES, race: int = RACE, tolerance: float = TOLERANCE,
) -> Clusters:
    """The best of several starts over distinct points of whole numbers with whole weights.

    The points in the order of the MD5 of their coordinates give the starts: the first k of them one, the
    next k another. A start has settled after a pass whose squared scaled moves add up to ``tolerance`` at most, and
    stays as that pass left it. After ``race`` passes the best start goes on alone, the one with the least sum of squared
    scaled distances to its means; ``most_passes`` bounds it. A centre without points stays where it is.
    """
    times = F.col(weight).cast("decimal(38,0)")
    sums = [f(F.col(a)) for a in axes for f in (lambda x: F.sum(x * times).cast("double"), lambda x: F.sum(x.cast("decimal(19,0)") * x * times).cast("double"))]
    total, *measured = points.agg(F.sum(times).cast("double"), *sums).first()
    if not total:
        return Clusters(axes, [0.0] * len(axes), [])
    spreads = [measured[2 * i + 1] / total - (measured[2 * i] / total) * (measured[2 * i] / total) for i in range(len(axes))]
    scales = [1.0 / v ** 0.5 if v > 0 else 0.0 for v in spreads]

    mark = F.md5(F.concat_ws("|", *axes))
    first = [tuple(float(r[a]) for a in axes) for r in points.orderBy(mark, *axes).limit(k * starts).collect()]
    fitted = {s: first[s * k:(s + 1) * k] for s in range(max(len(first) // k, 1))}
    cost, moving = {}, set(fitted)
    # centres are joined as columns: passes that differ in them alone share their generated code
    width = len(fitted[0])
    names = [[f"c{c}_{i}" for i in range(len(axes))] for c in range(width)]
    layout = ", ".join(["start", *[n for own in names for n in own]])
    dealt = points.withColumn("start", F.explode(F.array(*[F.lit(s) for s in fitted])))
    near = _nearest(axes, scales, [[F.col(n) for n in own] for own in names])
    for passed in range(most_passes):
        if passed == race:
            best = min(fitted, key=lambda s: (cost[s], s))
            moving &= {best}
            fitted = {best: fitted[best]}
        if not moving:
            break
        rows = ", ".join(f"({s}, {', '.join(f'{x!r}D' for c in fitted[s] for x in c)})" for s in sorted(moving))
        centres = points.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS centres({layout})")
        met = dealt.join(F.broadcast(centres), "start").select(*axes, weight, "start", near.alias("cluster"))
        found = {(r["start"], r["cluster"]): r for r in met.groupBy("start", "cluster").agg(F.sum(times).cast("double").alias("n"), *[c.alias(f"m{i}") for i, c in enumerate(sums)]).collect()}  # k rows a start
        for s in list(moving):
            means, spent, shift = [], 0.0, 0.0
            for c, centre in enumerate(fitted[s]):
                row = found.get((s, c))
                mean = centre if row is None else tuple(row[f"m{2 * i}"] / row["n"] for i in range(len(axes)))
                means.append(mean)
                shift += sum(((m - was) * scales[i]) * ((m - was) * scales[i]) for i, (m, was) in enumerate(zip(mean, centre)))
                if row is not None:
                    spent += sum((row[f"m{2 * i + 1}"] - row["n"] * m * m) * scales[i] * scales[i] for i, m in enumerate(mean))
            if shift <= tolerance:
                moving.discard(s)
            fitted[s], cost[s] = means, spent
    best = min(fitted, key=lambda s: (cost[s], s))
    return Clusters(axes, scales, fitted[best])
