"""Product codes of vectors: a small codebook for each part of the vector, refined in rounds over all vectors.

A round's assignment follows Drake and Hamerly. Each part keeps its b closest entries in order: an upper bound on the distance to the first, lower bounds on
those to the others, and one lower bound for all entries outside the list. When the entries have moved, the bounds give way by as much; where the
first entry's bound stays strictly below that of another, that one and all after it cannot be nearer. The uncertain ones, as
many as it takes, are compared by exact integer distances, ties to the lower index. b shrinks to what nearly all parts needed.

Vectors, codes and bounds are a table that each round reads and writes anew; only the codebooks (parts x entries) pass through the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import parts, small
from tillsight.operators.ordinal import join_null_safe
from tillsight.session import discard, materialise

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Share of parts, one in so many, that may need more than the next round's b entries.
RARE = 16
#: Components beyond this have squared distances that do not fit in 64 bits.
LARGEST = 1 << 26

_STATE = "vec_id long, label long, x binary, code binary, bounds binary, error long, depths array<long>"
_EMPTY = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("x", pa.binary()), ("code", pa.binary()), ("bounds", pa.binary()),
                    ("error", pa.int64()), ("depths", pa.list_(pa.int64()))])


def _split(dim: int, n_parts: int) -> list[slice]:
    edges = [i * dim // n_parts for i in range(n_parts + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _exact(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x from each entry, or from an entry each where ``book`` is as long as x and has three axes."""
    if book.ndim == 3:
        d = x[:, None, :] - book
        return np.einsum("nkd,nkd->nk", d, d)
    top = max(np.abs(x).max(initial=0), np.abs(book).max(initial=0))
    if (2 * int(top)) ** 2 * max(x.shape[1], 1) < 1 << 52:
        # Small enough for every step to be exact in doubles.
        a, c = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in book], axis=1)


def _down(d: np.ndarray) -> np.ndarray:
    return np.nextafter(np.asarray(d, dtype=np.float32), np.float32(-np.inf))


def _up(d: np.ndarray) -> np.ndarray:
    return np.nextafter(np.asarray(d, dtype=np.float32), np.float32(np.inf))


def nearest(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The b closest entries of each row, in order, and bounds: upper for the first, lower for the others, and for all outside the list."""
    d = _exact(x, book)
    order = np.argsort(d, axis=1, kind="stable")
    root = np.sqrt(np.take_along_axis(d, order[:, : b + 1], axis=1).astype(np.float64))
    bounds = np.full((len(x), b + 1), np.float32(np.inf))
    bounds[:, : root.shape[1]] = _down(root)
    bounds[:, 0] = _up(root[:, 0])
    return order[:, :b].astype(np.uint8), bounds


def reassign(x: np.ndarray, book: np.ndarray, moved: np.ndarray, ids: np.ndarray, bounds: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists and bounds after the entries ``moved`` so far, cut to b entries; also how many entries each row had to look at (all: one more than the list)."""
    k, width = len(book), ids.shape[1]
    bounds = bounds.copy()
    bounds[:, 0] = _up(bounds[:, 0] + _up(moved[ids[:, 0]]))
    if width > 1:
        bounds[:, 1:width] = _down(bounds[:, 1:width] - _up(moved[ids[:, 1:]]))
    bounds[:, width] = _down(bounds[:, width] - _up(moved.max(initial=0)))
    # From the end on, no bound is above the one after it.
    lower = np.minimum.accumulate(bounds[:, :0:-1], axis=1)[:, ::-1]
    bounds[:, 1:] = lower
    sure = bounds[:, :1] < lower
    depth = np.where(sure.any(axis=1), sure.argmax(axis=1) + 1, width + 1)
    ids = ids.copy()
    for z in range(2, width + 1):
        rows = np.flatnonzero(depth == z)
        if len(rows):
            d = _exact(x[rows], book[ids[rows, :z]])
            # By distance, ties to the lower index: these z entries are now in order, and all others are farther than the first.
            order = np.lexsort((ids[rows, :z], d), axis=1)
            ids[rows, :z] = np.take_along_axis(ids[rows, :z], order, axis=1)
            root = np.sqrt(np.take_along_axis(d, order, axis=1).astype(np.float64))
            bounds[rows, :z] = _down(root)
            bounds[rows, 0] = _up(root[:, 0])
            bounds[rows, 1:] = np.minimum.accumulate(bounds[rows, :0:-1], axis=1)[:, ::-1]
    rows = np.flatnonzero(depth > width)
    fresh_ids, fresh = nearest(x[rows], book, width)
    ids[rows, : fresh_ids.shape[1]], bounds[rows] = fresh_ids, fresh
    if b < width:
        # What leaves the list lies outside it from now on.
        bounds[:, b] = bounds[:, b:].min(axis=1)
        ids, bounds = ids[:, :b], bounds[:, : b + 1]
    return ids, bounds, np.minimum(depth, k)


def _pack(ids: list[np.ndarray], bounds: list[np.ndarray]) -> pa.Array:
    n = len(ids[0])
    rows = np.concatenate([np.concatenate([i, np.ascontiguousarray(b).view(np.uint8).reshape(n, -1)], axis=1) for i, b in zip(ids, bounds)], axis=1)
    return _binary(rows)


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    flat = rows.view(np.uint8).reshape(len(rows), -1) if len(rows) else np.zeros((0, 1), np.uint8)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(flat.shape[1]), len(flat), [None, pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), -1)


def _assign(books: list[np.ndarray], moved: list[np.ndarray] | None, width: int, b: int):
    """A round's assignment. Lists have ``width`` entries and are cut to ``b``; without ``moved`` there are none yet."""
    edges = np.cumsum([0, *[c.shape[1] for c in books]])
    cuts = [slice(i, j) for i, j in zip(edges, edges[1:])]
    each = width + 4 * (width + 1)

    def run(batches):
        for batch in parts(batches, 1 << 20):
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), np.int32).astype(np.int64)
            state = None if moved is None else _matrix(batch.column("bounds"), np.uint8)
            depths = np.zeros(len(books[0]) + 1, dtype=np.int64)
            all_ids, all_bounds, error = [], [], np.zeros(len(x), dtype=np.int64)
            for p, (cut, book) in enumerate(zip(cuts, books)):
                if state is None:
                    ids, bounds = nearest(x[:, cut], book, b)
                    depths[-1] += len(x)
                else:
                    own = np.ascontiguousarray(state[:, p * each: (p + 1) * each])
                    near = np.ascontiguousarray(own[:, width:]).view(np.float32)
                    ids, bounds, depth = reassign(x[:, cut], book, moved[p], own[:, :width], near, b)
                    depths += np.bincount(depth, minlength=len(depths))[: len(depths)]
                all_ids.append(ids)
                all_bounds.append(bounds)
                d = x[:, cut] - book[ids[:, 0]]
                error += (d * d).sum(axis=1)
            none = pa.nulls(len(x) - 1, pa.list_(pa.int64()))
            counted = pa.chunked_array([pa.array([depths.tolist()], pa.list_(pa.int64())), none]).combine_chunks()
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"), batch.column("x"), _binary(np.stack([i[:, 0] for i in all_ids], axis=1)),
                _pack(all_ids, all_bounds), pa.array(error), counted], schema=_EMPTY)

    return run


def _sums(n_parts: int, k: int):
    """For each part and entry: how many parts of vectors it has, and the sums of their components."""
    def run(batches):
        count, total = np.zeros(n_parts * k, dtype=np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), np.int32).astype(np.int64)
            code = _matrix(batch.column("code"), np.uint8).astype(np.int64)
            cuts = _split(x.shape[1], n_parts)
            total = [np.zeros((k, c.stop - c.start), dtype=np.int64) for c in cuts] if total is None else total
            for p, cut in enumerate(cuts):
                count[p * k: (p + 1) * k] += np.bincount(code[:, p], minlength=k)
                order = np.argsort(code[:, p], kind="stable")
                first = np.flatnonzero(np.diff(code[order, p], prepend=-1))
                total[p][code[order[first], p]] += np.add.reduceat(x[order, cut], first, axis=0)
        if total is not None:
            rows = [(p, e, int(count[p * k + e]), total[p][e].tolist()) for p in range(n_parts) for e in range(k) if count[p * k + e]]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], names=["part", "entry", "n", "s"])

    return run


def _moved_books(state: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks whose entries are the floor of their parts' means; unused ones stay."""
    k = len(books[0])
    sums = state.select("x", "code").mapInArrow(_sums(len(books), k), "part int, entry int, n long, s array<long>")
    rows = sums.select("part", "entry", "n", F.posexplode("s").alias("i", "v")).groupBy("part", "entry", "i").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    out = [book.copy() for book in books]
    for r in rows.collect():  # one row per part, entry and component
        out[r.part][r.entry, r.i] = r.v // r.n
    return out


def _next_b(state: DataFrame, b: int, k: int) -> int:
    """The least number of entries that suffices for all but one part in ``RARE``; at least an eighth of all entries, and never more than before."""
    rows = state.where("depths IS NOT NULL").select(F.posexplode("depths").alias("depth", "n")).groupBy("depth").agg(F.sum("n").alias("n")).collect()
    counts = {r.depth: r.n for r in rows}
    total, beyond, want = sum(counts.values()), 0, k
    while want > max(2, k // 8) and (beyond + counts.get(want, 0)) * RARE <= total:
        beyond += counts.get(want, 0)
        want -= 1
    return min(b, want)


def kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x) of the rows whose vector is usable: x holds floor(4096 * component) as 32-bit integers."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("e"))
    fine = F.coalesce(F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False)) & (F.size("e") > 0)
    scaled = F.transform("e", lambda c: F.floor(c.cast("double") * SCALE))
    x = F.transform(scaled, lambda c: F.when(F.abs(c) <= LARGEST, c.cast("int")).otherwise(
        F.raise_error(F.lit(f"vector_codes: a component is beyond {LARGEST // SCALE}")).cast("int")))
    return v.where(fine).select("vec_id", "label", x.alias("x"))


def _packed():
    def run(batches):
        for batch in parts(batches):
            rows = batch.column("x")
            data = [np.asarray(r, dtype=np.int32).tobytes() for r in rows.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(data, pa.binary())], names=["vec_id", "label", "x"])

    return run


def fit_codes(vectors: DataFrame, n_parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray], list[int]]:
    """State after the last assignment (vec_id, label, code binary, error), the codebooks, and the b of each assignment.

    Vectors that are null, empty, or hold a null, NaN or infinite component are left out; so are those whose length differs from that of the least
    vec_id. The length is cut into parts as equal as it goes. Rows of one vec_id count each; the first codebooks take them in the order of their components, a null vec_id last. With fewer
    vectors than ``entries`` there are as many entries as vectors. Components beyond 16,384 raise an error. Other columns are ignored.
    """
    rows = materialise(kept(vectors), "vectors")
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
    if not first:
        return rows.select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(0).cast("long").alias("error")), [], []
    dim = len(first[0].x)
    if any(len(r.x) != dim for r in first):
        first = rows.where(F.size("x") == dim).orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
    start = np.array([r.x for r in first], dtype=np.int64)
    books = [start[:, cut] for cut in _split(dim, n_parts)]
    k = len(start)
    state = materialise(rows.where(F.size("x") == dim).mapInArrow(_packed(), "vec_id long, label long, x binary"), "packed")
    discard(rows)
    width, used, moved = 0, [], None
    for step in range(rounds + 1):
        b = min(k, max(2, k // 4)) if step == 0 else _next_b(state, width, k) if step > 1 else width
        new = materialise(state.mapInArrow(_assign(books, moved, width, b), _STATE), "codes")
        discard(state)  # superseded: its vectors and bounds are in the new table
        state, width = new, b
        used.append(b)
        if step < rounds:
            after = _moved_books(state, books)
            moved = [np.sqrt(((c - o) ** 2).sum(axis=1).astype(np.float64)) for c, o in zip(after, books)]
            books = after
    return state.select("vec_id", "label", "code", "error"), books, used


def coded(vectors: DataFrame, n_parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Per usable vector: vec_id, code (two hex digits per part), error, label_error (of all with this label, nulls together), codebooks_sha256."""
    state, books, _ = fit_codes(vectors, n_parts, entries, rounds)
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book.tolist() for c in entry).encode()).hexdigest()
    sums = state.groupBy("label").agg(F.sum("error").alias("label_error"))
    return join_null_safe(state, small(sums, 1_000_000), ["label"]).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
