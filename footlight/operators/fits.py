"""Many boosted fits of one training table side by side, each in its own task.

A search fits the same rows with many parameter sets, and a fit is up to hundreds of trees, each on the margins of those before it.  As
Spark jobs that is a job per level of each tree, whatever the rows.  While a training table has at most ``boosting.VALUES`` feature values,
which one task can hold, Spark deals the fits to tasks instead, with the rows each of them needs, and a task grows the
trees of its fit.  Larger tables are fitted one after the other by ``boosting.fit``, over all their partitions.

The trees are those of ``boosting.fit``: cut points are quantiles weighted by curvature and found anew for every tree, categories are
ordered by their mean target, the first of equal splits counts, and a leaf's weight is the penalised Newton step.  Gradients and curvature
are rounded to a grid as fine as their sum can be told, so sums do not depend on the order of the rows, and what two features together
sum to is what each of them does: features are summed in groups.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from footlight.operators import boosting
from footlight.session import materialise

SCORES = "fit int, trees int, label double, predicted_prob double"
AREAS = "fit int, trees int, auc double"
# What a fit needs of a row, and the form in which it is sent.
KINDS = {"x": np.float64, "label": np.float64, "fold": np.float64, "held": np.uint8}
# A gain of a smaller share of what the two sides explain is rounding, as those below ``boosting.LEAST_GAIN``.
ROUNDING = 1e-12
# Cells of a group of features that are summed in one pass over the rows: at most, and one per so many rows of a node.
CELLS, SPARE = 1 << 13, 4
# Sums of few nodes are told by lanes, as additions to one place wait for each other.
LANES = 16
# Of more than so many rows, each so-manieth tells roughly how large the nodes are, and the larger of two nodes is what the smaller leaves.
FEW, STEP = 1 << 12, 8


def bounded(training: DataFrame) -> bool:
    """Whether one task can hold the table; see ``boosting.VALUES``."""
    row = training.agg(F.count(F.lit(1)), F.max(F.size(vector_to_array("features")))).first()
    return (row[0] or 0) * (row[1] or 0) < boosting.VALUES


def categories(training: DataFrame) -> dict[int, int]:
    """{feature: number of categories}, from the attributes that the assembler gives the vector."""
    attributes = training.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    return {a["idx"]: int(a["num_vals"]) if "num_vals" in a else len(a["vals"]) for a in attributes.get("nominal", [])}


def fit_each(training: DataFrame, fits: list[tuple[int, dict]], bins: int) -> DataFrame:
    """(fit, trees, label, predicted_prob): the rows of the fold that each fit leaves out, scored by it; written once.

    A fit is (fold, arguments of ``boosting.fit``); rows of ``is_holdout`` in the other folds decide when it stops.  A fit whose fold is
    empty has one row without label.
    """
    run = _run(fits, categories(training), bins)
    return materialise(_dealt(training, fits).applyInArrow(run, SCORES), "fold_scores")


def area_each(training: DataFrame, fits: list[tuple[int, dict]], bins: int) -> DataFrame:
    """(fit, trees, auc): what ``evaluate.roc_auc`` says of the scores of ``fit_each``, told by the task that has them.

    So a search that goes on from these areas waits for its own fits only, and not for jobs behind those of other searches.
    """
    run = _run(fits, categories(training), bins)

    def summed(table: pa.Table) -> pa.Table:
        scores = run(table).to_pydict()
        found = area(scores["label"], scores["predicted_prob"])
        return pa.table([pa.array([scores["fit"][0]], pa.int32()), pa.array([scores["trees"][0]], pa.int32()), pa.array([found], pa.float64())], names=["fit", "trees", "auc"])

    return _dealt(training, fits).applyInArrow(summed, AREAS)


def area(label: list, score: list) -> float | None:
    """Chance that a positive outscores a negative, ties counting half; none when a class is missing.  The counts are exact."""
    if label[0] is None:
        return None
    _, place = np.unique(score, return_inverse=True)
    pos = np.bincount(place, label)
    neg = np.bincount(place) - pos
    pairs = np.sum(pos) * np.sum(neg)
    return float(np.sum(pos * (np.cumsum(neg) - neg / 2)) / pairs) if pairs else None


def _dealt(training: DataFrame, fits: list[tuple[int, dict]]) -> GroupedData:
    """The rows for each fit, one fit to a task."""
    held = F.coalesce(F.col("is_holdout"), F.lit(False)).alias("held")
    rows = training.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"), F.col("fold").cast("double").alias("fold"), held)
    # Each batch of rows crosses the network as one row of bytes: a fit takes all of them anyway.
    each = rows.mapInArrow(_packed, ", ".join(f"{name} binary" for name in KINDS)).withColumn("fit", F.explode(F.lit(list(range(len(fits))))))
    return each.repartitionById(len(fits), F.col("fit")).groupBy("fit")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b for b in batches if b.num_rows):
        columns = {"x": batch["x"].flatten(), **{name: batch[name] for name in KINDS if name != "x"}}
        values = [np.asarray(columns[name].to_numpy(zero_copy_only=False), kind) for name, kind in KINDS.items()]
        yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in values], names=list(KINDS))


def _unpacked(table: pa.Table) -> dict[str, np.ndarray]:
    return {name: np.concatenate([np.frombuffer(v.as_buffer(), kind) for v in table[name]]) for name, kind in KINDS.items()}


def _run(fits: list[tuple[int, dict]], nominal: dict[int, int], bins: int) -> Callable[[pa.Table], pa.Table]:
    def scored(table: pa.Table) -> pa.Table:
        fit = table["fit"][0].as_py()
        left_out, params = fits[fit]
        rows = _unpacked(table)
        y, fold = rows["label"], rows["fold"]
        x = rows.pop("x").reshape(len(y), -1)
        # Training rows first, then hold-out rows, then those to score; inside, an order that does not depend on the exchange.
        part = np.where(fold == left_out, 2, np.where(rows["held"], 1, 0))
        order = np.lexsort([*x.T, y, part])
        sizes = np.bincount(part, minlength=3)
        # Mixed, as additions to one place wait for each other and equal rows go to one.
        mixed, ends = np.random.default_rng(len(y)), np.cumsum(sizes)
        order = np.concatenate([mixed.permutation(order[end - size : end]) for end, size in zip(ends, sizes)])
        rows["x"] = x[order]
        del x
        trees, margin = boosted(rows.pop("x"), y[order], int(sizes[0]), int(sizes[1]), nominal, bins, **params)
        label = y[order][len(y) - sizes[2] :]
        if not len(label):
            label, margin = [None], [0.0]
        n = len(label)
        with np.errstate(over="ignore"):
            p = 1 / (1 + np.exp(-np.asarray(margin)))
        columns = [pa.array([fit] * n, pa.int32()), pa.array([trees] * n, pa.int32()), pa.array(label, pa.float64()), pa.array(p)]
        return pa.table(columns, names=["fit", "trees", "label", "predicted_prob"])

    return scored


def boosted(
    x: np.ndarray, y: np.ndarray, n: int, n_held: int, nominal: dict[int, int], bins: int, rounds: int, rate: float, depth: int,
    alpha: float = 0.0, lam: float = 0.0, min_gain: float = 0.0, min_rows: int = 1, subsample: float = 1.0, patience: int = boosting.PATIENCE,
) -> tuple[int, np.ndarray]:
    """(number of trees, margins of the rows after the first ``n`` to learn from and ``n_held`` to stop by); see ``boosting.fit``."""
    if subsample != 1:
        raise ValueError("rows are not drawn here")
    margin = np.zeros(len(y))
    rest, held = slice(n + n_held, None), slice(n, n + n_held)
    kept, losses, trees = margin[rest].copy(), [], 0
    if not n:
        return 0, kept
    most = min(bins, n) - 1
    width = max([min(bins, n), *nominal.values()])
    codes = np.zeros((x.shape[1], len(y)), np.uint8 if width <= 256 else np.uint16 if width <= 65536 else np.int64)
    moving = []  # features whose cut points depend on the weights
    for f in range(x.shape[1]):
        if f in nominal:
            codes[f] = x[:, f]
            continue
        values, place = np.unique(x[:, f], return_inverse=True)
        seen = np.bincount(place[:n], minlength=len(values)) > 0
        if np.sum(seen) - 1 > most:
            moving.append((f, values, place, seen))
        else:
            codes[f] = np.searchsorted(cuts(values[seen], None, most), values)[place]

    def noted() -> None:
        """The loss of the trees so far, and their margins if it is the lowest."""
        nonlocal kept
        m = margin[held]
        losses.append(float(np.mean(np.log1p(np.exp(-np.abs(m))) + np.maximum(m, 0) - y[held] * m)))
        if len(losses) == 2 or (len(losses) > 2 and losses[-1] < min(losses[1:-1])):
            kept = margin[rest].copy()

    del x
    room = Room()
    p, step = room("p", float, n), room("step", float, len(y))
    for _ in range(rounds):
        if n_held:
            noted()
            found = boosting.best_length(losses, patience)
            if found is not None:
                return found, kept
        with np.errstate(over="ignore"):
            np.exp(np.negative(margin[:n], out=p), out=p)
        np.divide(1, np.add(1, p, out=p), out=p)
        g = np.subtract(p, y[:n], out=room("g", float, n))
        h = np.subtract(1, p, out=room("h", float, n))
        np.maximum(np.multiply(p, h, out=h), boosting.LEAST_H, out=h)
        for f, values, place, seen in moving:
            between = cuts(values[seen], np.bincount(place[:n], h, len(values))[seen], most)
            np.searchsorted(between, values).astype(codes.dtype).take(place, out=codes[f], mode="clip")
        leaf = grow(codes, g, h, width, nominal, depth, min_gain, min_rows, alpha, room)
        leaves = int(np.max(leaf[:n])) + 1
        total_g, total_h = room.totals(leaf[:n], leaves, g, h)
        weights = -np.copysign(np.maximum(np.abs(total_g) - alpha, 0), total_g) / (total_h + lam)
        if not weights.any():
            break
        trees += 1
        margin += (rate * weights).take(leaf, out=step, mode="clip")
    if n_held and len(losses) == trees:
        noted()
    return (boosting._best(losses), kept) if len(losses) > 1 else (trees, margin[rest])


def cuts(values: np.ndarray, weights: np.ndarray | None, most: int) -> np.ndarray:
    """At most ``most`` cut points between sorted values, where the running weight comes nearest to equal strides; few values need no weights."""
    if len(values) - 1 <= most:
        return (values[:-1] + values[1:]) / 2
    upto = np.cumsum(weights)
    strides = np.arange(1, most + 1)
    # Behind value i the weight is nearer to the stride than behind value i + 1; a cut lies behind the one before it.
    at = np.searchsorted(upto[:-1] + upto[1:], 2 * upto[-1] / (most + 1) * strides, side="right")
    at = np.maximum.accumulate(at - strides) + strides
    at = at[at < len(values) - 1]
    return (values[at] + values[at + 1]) / 2


class Room:
    """Arrays by name that are used again: to fetch fresh memory for each takes longer than what is done in it."""

    def __init__(self):
        self.kept: dict[str, np.ndarray] = {}
        self.upto = self.lanes = np.arange(0)

    def __call__(self, name: str, kind: type, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.kept or self.kept[name].size < size:
            self.kept[name] = np.empty(size, kind)
        return self.kept[name][:size].reshape(shape)

    def line(self, n: int) -> np.ndarray:
        """The numbers below ``n``, not to be changed."""
        if len(self.upto) < n:
            self.upto = np.arange(n)
            self.lanes = self.upto % LANES
        return self.upto[:n]

    def totals(self, place: np.ndarray, n: int, *values: np.ndarray) -> list[np.ndarray]:
        """Sums of each of the values by place, one of ``n``; as additions to one place wait for each other, each place is summed in lanes."""
        self.line(len(place))
        at = np.multiply(place, LANES, out=self("laned", int, len(place)))
        at += self.lanes[: len(place)]
        return [np.bincount(at, v, n * LANES).reshape(n, LANES).sum(axis=1) for v in values]


def exact(values: np.ndarray, out: np.ndarray) -> np.ndarray:
    """``values`` rounded to a grid on which no sum of some of them is rounded, whatever their order; it is as fine as the sum of all can be told."""
    total = float(np.sum(np.abs(values, out=out)))
    far = 1.5 * 2.0 ** math.frexp(total)[1]
    return np.subtract(np.add(values, far, out=out), far, out=out)


def grouped(widths: list[int], most: int) -> list[tuple[int, ...]]:
    """The features in groups of at most ``most`` cells, the product of their widths; a wider feature is a group of its own."""
    groups: list[list] = []  # cells, features
    for f in sorted(range(len(widths)), key=lambda f: -widths[f]):
        room = [own for own in groups if own[0] * widths[f] <= most]
        if room:
            own = min(room)
            own[0] *= widths[f]
            own[1].append(f)
        else:
            groups.append([widths[f], [f]])
    return [tuple(fs) for _, fs in groups]


def grow(
    codes: np.ndarray, g: np.ndarray, h: np.ndarray, width: int, nominal: dict[int, int], depth: int, min_gain: float, min_rows: int,
    alpha: float, room: Room,
) -> np.ndarray:
    """The leaf of every row of one tree, grown on the first rows, those with a gradient ``g`` and curvature ``h``.

    ``codes`` has a line per feature.  A node is not split where ``alpha`` outweighs every leaf that could lie below it: whatever the
    splits, the weights there are 0.
    """
    features, m = codes.shape
    named, kinds = list(nominal), max(nominal.values(), default=0)
    widths = [int(w) + 1 for w in codes.max(axis=1)]
    g, h = exact(g, room("exact_g", float, len(g))), exact(h, room("exact_h", float, len(g)))
    joint: dict[tuple, np.ndarray] = {}  # codes of groups of features
    leaf, rows = room("leaf", int, m), room.line(m)
    node = room("node", int, m)
    node[:] = 0
    size = np.abs(g, out=room("size", float, len(g)))
    nodes, leaves, live = 1, 0, m  # rows that are in their leaf have the number behind those of the nodes
    own_g = np.array([np.sum(g)])  # sums of the nodes that can be split

    def end(ends: np.ndarray) -> None:
        """The nodes marked become leaves; the other nodes are numbered anew."""
        nonlocal codes, g, h, size, rows, node, nodes, leaves, live
        if not ends.any():
            return
        at = np.flatnonzero(np.append(ends, False).take(node))
        leaf[rows.take(at)] = (leaves - 1 + np.cumsum(ends)).take(node.take(at))
        leaves += int(np.sum(ends))
        number = np.where(ends, nodes - np.sum(ends), np.cumsum(~ends) - 1)
        nodes -= int(np.sum(ends))
        node[:] = np.append(number, nodes).take(node, out=room("taken", int, len(node)), mode="clip")
        live -= len(at)
        if not nodes or live > 0.75 * len(node):
            return
        on = np.flatnonzero(node < nodes)
        # Most rows are in their leaf: the others move together, in their order.
        own = on[: np.searchsorted(on, len(g))]
        kept = room("codes", codes.dtype, features, m)
        joint.clear()
        for f in range(features):
            codes[f].take(on, out=kept[f, : len(on)], mode="clip")
        codes, rows = kept, rows.take(on)
        node[: len(on)] = node.take(on)
        node = node[: len(on)]
        g, h, size = g.take(own), h.take(own), size.take(own)

    def tally(sums: list[np.ndarray], place: np.ndarray, some: np.ndarray | None = None) -> None:
        """The sums by node, feature and code of all rows to learn from, or of ``some``; ``place`` is their node."""
        n, count = len(place), len(sums[0])
        weights = [v if v is None or some is None else v.take(some) for v in (g, h, None)]
        at = room("at", int, n)
        for group in grouped(widths, min(CELLS, n // (SPARE * count))):
            own = [widths[f] for f in group]
            cells = math.prod(own)
            if len(group) > 1 and group not in joint:
                code = codes[group[0], : len(g)].astype(np.uint16)
                for f in group[1:]:
                    np.multiply(code, np.uint16(widths[f]), out=code)
                    np.add(code, codes[f, : len(g)], out=code, casting="unsafe")
                joint[group] = code
            code = joint[group] if len(group) > 1 else codes[group[0], : len(g)]
            code = code if some is None else code.take(some)
            if live == m and nodes == 1:
                np.copyto(at, code)
            else:
                np.add(np.multiply(place, cells, out=at), code, out=at)
            for s, v in zip(sums, weights):
                each = np.bincount(at, v, (count + 1) * cells)[: count * cells].astype(float, copy=False)
                for f, w in zip(group, own):
                    each = each.reshape(count, w, -1)
                    s[:, f, :w] = each[:, :, 0] if f == group[-1] else each @ np.ones(each.shape[2])
                    s[:, f, w:] = 0
                    each = np.ones(w) @ each if f != group[-1] else each

    gone, whole = 0, None  # the last nodes, that are not split; sums of the nodes above
    for _ in range(depth):
        ends = np.arange(nodes) >= nodes - gone
        # Some of the rows tell what is worth a look at all of them, and which nodes are large; the tree does not depend on it.
        step = STEP if len(g) > FEW else 1
        seen = node[: len(g) : step]
        count = np.bincount(seen, minlength=nodes + 1) if whole else None
        if alpha and (step == 1 or np.any(step * np.bincount(seen, size[::step], nodes + 1)[: nodes - gone] + np.abs(own_g) <= 4 * alpha)):
            # No leaf below has a larger sum than the gradients of one sign; the margin is that of rounding.
            most = room.totals(node[: len(g)], nodes + 1, size)[0]
            ends[: nodes - gone] |= (most[: nodes - gone] + np.abs(own_g)) / 2 * (1 + 1e-9) <= alpha
        alive = np.flatnonzero(~ends)
        end(ends)
        if not nodes:
            return leaf
        n, shape = len(g), (nodes, features, width)
        sums = [room(f"sums_{i}", float, *shape) for i in range(3 if min_rows > 1 else 2)]
        direct = np.ones(nodes, bool)
        if whole:
            # Of two nodes below one, the larger is what the other leaves of it: sums are exact.
            count = count[alive]
            pair = np.flatnonzero(alive[:-1] ^ 1 == alive[1:])
            larger = pair + (count[pair + 1] > count[pair])
            direct[larger] = False
        if whole and np.sum(count[direct]) < 0.7 * np.sum(count):
            some = np.flatnonzero(np.append(direct, False).take(node[:n]))
            few = [np.empty((int(np.sum(direct)), features, width)) for _ in sums]
            tally(few, (np.cumsum(direct) - 1).take(node.take(some)), some)
            for s, own, above in zip(sums, few, whole):
                s[direct] = own
                s[larger] = above[alive[larger] >> 1] - s[2 * pair + 1 - larger]
        else:
            tally(sums, node[:n])
        # Sums of few rows are as soon told as kept.
        whole = [s.copy() for s in sums] if n > max(FEW, sums[0].size) else None
        if named:
            part = [s[:, named, :kinds] for s in sums]
            with np.errstate(invalid="ignore", divide="ignore"):
                order = np.argsort(np.where(part[1] > 0, -part[0] / part[1], np.inf), axis=2, kind="stable")
            places = order + np.arange(0, order.size, kinds).reshape(nodes, len(named), 1)
            for s, own in zip(sums, part):
                s[:, named, :kinds] = own.ravel().take(places)
        upto = [np.cumsum(s, axis=2, out=s) for s in sums]
        gl, hl = (u[:, :, :-1] for u in upto[:2])
        ga, ha = (u[:, :, -1:] for u in upto[:2])
        left, right, rest = (room(name, float, nodes, features, width - 1) for name in ("left", "right", "rest"))
        with np.errstate(invalid="ignore", divide="ignore"):
            np.divide(np.multiply(gl, gl, out=left), hl, out=left)
            np.square(np.subtract(ga, gl, out=right), out=right)
            np.divide(right, np.subtract(ha[:, :1], hl, out=rest), out=right)
            sides = np.add(left, right, out=left)
        # Every row has curvature: a side without any has no rows.
        barred = (hl <= 0) | (hl >= ha)
        if min_rows > 1:
            nl, na = upto[2][:, :, :-1], upto[2][:, :, -1:]
            barred |= (nl < min_rows) | (na - nl < min_rows)
        np.copyto(sides, -1.0, where=barred)
        sides = sides.reshape(nodes, -1)
        best = np.argmax(sides, axis=1)
        top = sides[np.arange(nodes), best]
        total = ha[:, 0, 0]
        gain = top - ga[:, 0, 0] ** 2 / total
        splits = (gain > ROUNDING * top) & (gain >= max(min_gain, boosting.LEAST_GAIN) * total)
        feature, last = np.divmod(best, width - 1)
        beyond = np.arange(width) > last[:, None]
        for i, f in enumerate(named):
            own = np.flatnonzero(feature == f)
            beyond[own, :kinds] = np.argsort(order[own, i], axis=1) > last[own, None]
        below = gl[np.arange(nodes), feature, last]
        own_g = np.stack([below, ga[:, 0, 0] - below], axis=1)[splits].ravel()
        whole = [s[splits] for s in whole] if whole else None
        gone = int(np.sum(~splits))
        if gone == nodes:
            end(~splits)
            return leaf
        # The next node of each row; nodes that are not split come behind those that are, and then rows that are in their leaf.
        split = 2 * (nodes - gone)
        following = np.where(splits[:, None], 2 * (np.cumsum(splits) - 1)[:, None] + beyond, (split - 1 + np.cumsum(~splits))[:, None])
        following = np.append(following.ravel(), np.full(width, split + gone))
        at, side = room("places", int, len(node)), room("side", codes.dtype, len(node))
        if live == m and nodes == 1:
            np.copyto(at, codes[feature[0]])
        else:
            np.append(feature * m, 0).take(node, out=at, mode="clip")
            at += room.line(len(node))
            codes.ravel().take(at, out=side, mode="clip")
            np.add(np.multiply(node, width, out=at), side, out=at)
        following.take(at, out=node, mode="clip")
        nodes = split + gone
    if live == m:
        return node
    on = np.flatnonzero(node < nodes)
    leaf[rows.take(on)] = node.take(on) + leaves
    return leaf
