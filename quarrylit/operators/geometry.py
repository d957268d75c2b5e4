"""Boxes: areas and overlaps as expressions; order-dependent merges and grid components per page, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

LEAST_IOU = 0.02
GRID = 240
LEAST_CELLS = 1200
PAD = 12.0
MOST_OF_PAGE = 0.70


def area(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["x1"] - b["x0"]) * F.greatest(F.lit(0.0), b["y1"] - b["y0"])


def intersection(a: Column, b: Column) -> Column:
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union, 0 for empty boxes."""
    inner = intersection(a, b)
    union = area(a) + area(b) - inner
    return F.when(union > 0, inner / union).otherwise(0.0)


def pairs_on_page(boxes: DataFrame, key: str = "page", box_id: str = "box_id") -> DataFrame:
    """Overlapping pairs of a page's boxes (key, a, b, iou).  A page has few boxes; its pairs are the result, not a by-product."""
    one = boxes.select(key, F.col(box_id).alias("a"), F.struct("x0", "y0", "x1", "y1").alias("ba"))
    two = boxes.select(key, F.col(box_id).alias("b"), F.struct("x0", "y0", "x1", "y1").alias("bb"))
    met = one.join(two, key).where((F.col("a") < F.col("b")) & (intersection(F.col("ba"), F.col("bb")) > 0))
    return met.select(key, "a", "b", iou(F.col("ba"), F.col("bb")).alias("iou"))


def box_kind(rasters: Column, vectors: Column, box: Column) -> Column:
    """What a box overlaps: raster, vector, mixed or unknown."""
    hit = lambda boxes: F.exists(boxes, lambda b: iou(b, box) > 0)
    return F.when(hit(rasters) & hit(vectors), "mixed").when(hit(rasters), "raster").when(hit(vectors), "vector").otherwise("unknown")


def _iou(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    size = np.clip(np.minimum(a[2:], b[:, 2:]) - np.maximum(a[:2], b[:, :2]), 0, None).prod(1)
    union = np.clip(a[2:] - a[:2], 0, None).prod() + np.clip(b[:, 2:] - b[:, :2], 0, None).prod(1) - size
    return np.divide(size, union, out=np.zeros(len(b)), where=union > 0)


def merged(boxes: np.ndarray, least: float = LEAST_IOU) -> np.ndarray:
    """Every box in order takes in those behind it that overlap it, again and again until nothing changes."""
    now = [b.astype(float) for b in boxes]
    changed = True
    while changed:
        changed, out = False, []
        while now:
            box, rest = now[0], now[1:]
            while rest:
                hit = _iou(box, np.array(rest)) > least
                if not hit.any():
                    break
                i = int(np.argmax(hit))
                other = rest.pop(i)
                box = np.concatenate((np.minimum(box[:2], other[:2]), np.maximum(box[2:], other[2:])))
                changed = True
            out.append(box)
            now = rest
        now = out
    return np.array(now).reshape(-1, 4)


def _per_page(rows: DataFrame, key: str, order: list[str], made, number: str) -> DataFrame:
    """Applies made(boxes of some pages, where each page begins) -> (boxes, the page of each) to whole pages, which a task reads one
    after another: sorted rows, no group object."""
    kind = rows.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the page that may go on in the next batch
        now: pa.Array | None = None

        def out(pages: pa.Array, begins: np.ndarray, table: np.ndarray) -> Iterator[pa.RecordBatch]:
            boxes, of = made(table, begins)
            if len(boxes):
                n = np.arange(len(of)) - np.searchsorted(of, of)
                yield pa.RecordBatch.from_arrays([pages.take(pa.array(of)).cast(to_arrow_type(kind)), pa.array(n), *(pa.array(boxes[:, i]) for i in range(4))], names=[key, number, "x0", "y0", "x1", "y1"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.stack([np.asarray(batch.column(i).cast(pa.float64())) for i in range(1, 5)], 1)
            code = batch.column(0).dictionary_encode("encode").indices.to_numpy()
            begins = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
            pages = batch.column(0).take(pa.array(begins))
            if now is not None:
                more = pages[0].as_py() == now[0].as_py()
                if more and len(pages) == 1:
                    held.append(table)
                    continue
                before = sum(len(t) for t in held)
                begins = np.concatenate(([0], begins[1:] + before if more else begins + before))
                pages = pages if more else pa.concat_arrays([now, pages])
                table = np.concatenate([*held, table])
            yield from out(pages[:-1], begins[:-1], table[: begins[-1]])
            now, held = pages[-1:], [table[begins[-1] :]]
        if now is not None:
            yield from out(now, np.array([0]), np.concatenate(held))

    schema = T.StructType([T.StructField(key, kind)]).add(number, "long")
    for c in ("x0", "y0", "x1", "y1"):
        schema = schema.add(c, "double")
    sorted_ = rows.select(key, "x0", "y0", "x1", "y1", *(F.col(c).alias(f"__{c}") for c in order)).repartition(key).sortWithinPartitions(key, *(f"__{c}" for c in order))
    return sorted_.select(key, "x0", "y0", "x1", "y1").mapInArrow(run, schema)


def _each(made):
    """made(boxes of a page) -> boxes, for several pages."""

    def many(table: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done = [made(page) for page in np.split(table, begins[1:])] if len(begins) else []
        return np.concatenate([np.zeros((0, 4)), *done]), np.repeat(np.arange(len(done)), [len(d) for d in done])

    return many


def merge(boxes: DataFrame, key: str = "page", box_id: str = "box_id") -> DataFrame:
    """Per page the merged boxes, numbered in order."""
    return _per_page(boxes, key, [box_id], _each(merged), "box_no")


def grid_components(grid: np.ndarray) -> np.ndarray:
    """Numbers from 1 for the four-connected components of set cells, 0 elsewhere: least labels spread until they rest."""
    label = np.where(grid, np.arange(1, grid.size + 1).reshape(grid.shape), 0)
    while True:
        up = np.where(grid, label, grid.size + 1)
        wide = np.pad(up, 1, constant_values=grid.size + 1)
        least = np.minimum.reduce([wide[1:-1, 1:-1], wide[:-2, 1:-1], wide[2:, 1:-1], wide[1:-1, :-2], wide[1:-1, 2:]])
        least = np.where(grid, least, 0)
        if (least == label).all():
            return np.where(grid, np.unique(label, return_inverse=True)[1].reshape(grid.shape) + (0 if (label == 0).any() else 1), 0)
        label = least


#: The most shapes of a page that are compared with each other; more are drawn.
FEW = 200


def _cells_of(shapes: np.ndarray, sx: float, sy: float, cells: int) -> tuple[np.ndarray, ...]:
    """The cells that shapes cover: first column and row, and those behind the last."""
    x0, y0 = (np.maximum(0, (shapes[:, k] * f).astype(int)) for k, f in ((0, sx), (1, sy)))
    x1, y1 = (np.minimum(cells, np.ceil(shapes[:, k] * f).astype(int) + 1) for k, f in ((2, sx), (3, sy)))
    return x0, y0, x1, y1


def regions(shapes: np.ndarray, width: float, height: float, *, cells: int = GRID, least: int = LEAST_CELLS, pad: float = PAD, most: float = MOST_OF_PAGE) -> np.ndarray:
    """Boxes of the components that shapes make on a page's grid, padded, without small ones and those that fill the page."""
    if not len(shapes):
        return np.zeros((0, 4))
    sx, sy = cells / width, cells / height
    x0, y0, x1, y1 = _cells_of(shapes, sx, sy, cells)
    out = []
    for rows in _touching(x0, y0, x1, y1, cells):
        left, top, right, bottom = x0[rows].min(), y0[rows].min(), x1[rows].max(), y1[rows].max()
        if (right - left) * (bottom - top) < least:
            continue
        part = np.zeros((bottom - top, right - left), bool)
        for i in rows:
            part[y0[i] - top : y1[i] - top, x0[i] - left : x1[i] - left] = True
        if part.sum() < least:
            continue
        box = (max(0, left / sx - pad), max(0, top / sy - pad), min(width, right / sx + pad), min(height, bottom / sy + pad))
        if (box[2] - box[0]) * (box[3] - box[1]) <= most * width * height:
            out.append(box)
    return np.array(out, float).reshape(-1, 4)


def _touching(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray, cells: int) -> list[np.ndarray]:
    """Groups of rectangles of cells that are four-connected, by their first cell in reading order.

    A few rectangles are compared with each other; many are drawn on the grid, whose size is bounded."""
    good = np.flatnonzero((x1 > x0) & (y1 > y0))
    if len(good) > FEW:
        grid = np.zeros((cells, cells), bool)
        for i in good:
            grid[y0[i] : y1[i], x0[i] : x1[i]] = True
        label = grid_components(grid)
        of = label[y0[good], x0[good]]
    else:
        a, b, c, d = (v[good] for v in (x0, y0, x1, y1))
        wide = np.minimum(c[:, None], c) - np.maximum(a[:, None], a)
        high = np.minimum(d[:, None], d) - np.maximum(b[:, None], b)
        meet = ((wide > 0) & (high >= 0)) | ((wide >= 0) & (high > 0))
        of = np.arange(len(good))
        while True:
            least = np.where(meet, of, len(good)).min(1) if len(good) else of
            if (least == of).all():
                break
            of = least
    groups = [good[of == k] for k in np.unique(of)]
    return sorted(groups, key=lambda g: min((int(y0[i]), int(x0[i])) for i in g))


def regions_of_pages(shapes: np.ndarray, begins: np.ndarray, width: float, height: float, *, cells: int = GRID, least: int = LEAST_CELLS, pad: float = PAD, most: float = MOST_OF_PAGE) -> tuple[np.ndarray, np.ndarray]:
    """The `regions` of many pages at once, and the page of each; pages of many shapes are gone through one by one."""
    size = np.diff(np.append(begins, len(shapes)))
    page = np.repeat(np.arange(len(begins)), size)
    sx, sy = cells / width, cells / height
    x0, y0, x1, y1 = _cells_of(shapes, sx, sy, cells)
    good = (x1 > x0) & (y1 > y0)
    many = np.bincount(page[good], minlength=len(begins)) > FEW
    use = np.flatnonzero(good & ~many[page])
    page, x0, y0, x1, y1 = (v[use] for v in (page, x0, y0, x1, y1))
    # the pairs of a page that touch: each shape and the k-th behind it
    left, right = [], []
    first = np.arange(len(use))
    for k in range(1, FEW):
        first = first[first + k < len(use)]
        first = first[page[first] == page[first + k]]
        if not len(first):
            break
        second = first + k
        wide = np.minimum(x1[first], x1[second]) - np.maximum(x0[first], x0[second])
        high = np.minimum(y1[first], y1[second]) - np.maximum(y0[first], y0[second])
        meet = ((wide > 0) & (high >= 0)) | ((wide >= 0) & (high > 0))
        left.append(first[meet])
        right.append(second[meet])
    of = np.arange(len(use))
    if left:
        a, b = np.concatenate(left), np.concatenate(right)
        while (of[a] != of[b]).any():  # the least label of each component
            lower = np.minimum(of[a], of[b])
            np.minimum.at(of, a, lower)
            np.minimum.at(of, b, lower)
            of = of[of]
    boxes, pages = np.zeros((0, 4)), np.zeros(0, int)
    if len(use):
        order = np.lexsort((x0, y0, of))
        page, x0, y0, x1, y1 = (v[order] for v in (page, x0, y0, x1, y1))
        at = np.flatnonzero(np.concatenate(([True], np.diff(of[order]) != 0)))
        l, t, r, b = np.minimum.reduceat(x0, at), np.minimum.reduceat(y0, at), np.maximum.reduceat(x1, at), np.maximum.reduceat(y1, at)  # noqa: E741
        keep = (r - l) * (b - t) >= least
        unsure = np.flatnonzero(keep & (np.maximum.reduceat((x1 - x0) * (y1 - y0), at) < least))
        until = np.append(at[1:], len(page))
        for g in unsure:  # no shape is large enough by itself: their cells are counted
            part = np.zeros((b[g] - t[g], r[g] - l[g]), bool)
            for i in range(at[g], until[g]):
                part[y0[i] - t[g] : y1[i] - t[g], x0[i] - l[g] : x1[i] - l[g]] = True
            keep[g] = part.sum() >= least
        boxes = np.stack((np.maximum(0, l / sx - pad), np.maximum(0, t / sy - pad), np.minimum(width, r / sx + pad), np.minimum(height, b / sy + pad)), 1)
        keep &= (boxes[:, 2] - boxes[:, 0]) * (boxes[:, 3] - boxes[:, 1]) <= most * width * height
        # in reading order of their first cells
        order = np.lexsort((x0[at], y0[at], page[at]))
        order = order[keep[order]]
        boxes, pages = boxes[order], page[at][order]
    if many.any():
        slow = [(p, regions(shapes[begins[p] : begins[p] + size[p]], width, height, cells=cells, least=least, pad=pad, most=most)) for p in np.flatnonzero(many)]
        boxes, pages = np.concatenate([boxes, *(made for _, made in slow)]), np.concatenate([pages, *(np.full(len(made), p) for p, made in slow)])
        order = np.argsort(pages, kind="stable")
        boxes, pages = boxes[order], pages[order]
    return boxes, pages


def vector_regions(shapes: DataFrame, *, width: float, height: float, key: str = "page", **limits) -> DataFrame:
    """Per page the regions of its drawn shapes."""
    return _per_page(shapes, key, [], lambda table, begins: regions_of_pages(table, begins, width, height, **limits), "region")
