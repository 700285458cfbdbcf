"""Near-duplicate embeddings by lattice hashing.

A vector is scaled to length one and projected by ``TABLES`` random matrices onto
``BLOCKS`` groups of eight numbers; every group is decoded to the nearest point of the
E8 lattice, and the points of a table are its cell. A vector is stored in its own cell of
each table and probes that cell and the ``PROBES`` neighbouring cells it is nearest to,
a neighbour being one lattice step of one group. Every stored vector that a probe meets
is verified by cosine in double precision. Equal vectors of a label are one class.

A cell is cut into blocks of ``BLOCK`` stored and of ``BLOCK`` probing vectors and every
pair of blocks is a group of its own, so no task holds a cell. A group leaves the link
counts of its vectors and a spanning forest of its links, never its pairs. A pair of
vectors can meet in several tables; its cells tell which meeting is the first, and only
that one is counted.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.common import lookup, with_rows
from barline.llm.simhash import components
from barline.plans import land

THRESHOLD = 0.98
TABLES = 6
BLOCKS = 2
SCALE = 1.6
PROBES = 8
BLOCK = 256
SEED = 7
_LAST = 2**63 - 1


@cache
def lattice_steps() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of 1 or -1, or eight halves with an
    even number of minus signs."""
    steps = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            step = np.zeros(8)
            step[i], step[j] = a, b
            steps.append(step)
    halves = np.array(list(itertools.product((0.5, -0.5), repeat=8)))
    return np.vstack([steps, halves[(halves < 0).sum(axis=1) % 2 == 0]])


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest point with whole entries of even sum: round, and move the entry that
    rounding has moved most if the sum is odd."""
    point = np.rint(x)
    off = x - point
    worst = np.abs(off).argmax(axis=-1)[..., None]
    step = np.where(np.take_along_axis(off, worst, -1) < 0, -1.0, 1.0)
    odd = point.sum(axis=-1, keepdims=True) % 2
    np.put_along_axis(point, worst, np.take_along_axis(point, worst, -1) + step * odd, -1)
    return point


def nearest_point(x: np.ndarray) -> np.ndarray:
    """The point of E8 nearest to each row of eight: of two cosets, the nearer point."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(-1) <= ((x - half) ** 2).sum(-1)
    return np.where(nearer[..., None], whole, half)


@cache
def _tables(dim: int, tables: int, blocks: int, seed: int) -> tuple[np.ndarray, ...]:
    """Projections, offsets and the odd numbers that turn a cell into a code."""
    rng = np.random.default_rng([seed, dim])
    wide = tables * blocks * 8
    mixers = rng.integers(0, 2**63, (tables, blocks, 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return rng.standard_normal((dim, wide)), rng.uniform(0, 2, wide), mixers


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest entry is taken out first, so nothing overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cell_codes(
    units: np.ndarray,
    tables: int = TABLES,
    blocks: int = BLOCKS,
    scale: float = SCALE,
    probes: int = PROBES,
    seed: int = SEED,
) -> np.ndarray:
    """Per row and table the code of the own cell and of the cells it probes beside it.

    A step of the lattice changes a code by a number that depends on the step alone.
    """
    n = len(units)
    matrix, offset, mixers = _tables(units.shape[1], tables, blocks, seed)
    at = (units @ matrix / scale + offset).reshape(n, tables, blocks, 8)
    point = nearest_point(at)
    doubled = (2 * point).astype(np.int64).astype(np.uint64)
    own = (doubled * mixers).sum(axis=(2, 3), dtype=np.uint64)
    steps = lattice_steps()
    # The nearest neighbour is the step with the largest product with what decoding left.
    gain = ((at - point) @ steps.T).reshape(n, tables, -1)
    best = np.argpartition(-gain, probes, axis=2)[:, :, :probes] if probes else gain[:, :, :0].astype(int)
    change = np.einsum("tbk,sk->tbs", mixers, (2 * steps).astype(np.int64).astype(np.uint64))
    moved = np.take_along_axis(change.reshape(1, tables, -1), best, axis=2)
    return np.concatenate([own[:, :, None], own[:, :, None] + moved], axis=2).reshape(n, -1).view(np.int64)


def _signatures(vector: Column, **how) -> Column:
    def codes(vectors: pd.Series) -> pd.Series:
        out: list[np.ndarray | None] = [None] * len(vectors)
        lengths: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            lengths.setdefault(len(v), []).append(i)
        for rows in lengths.values():
            for start in range(0, len(rows), 1024):
                part = rows[start : start + 1024]
                units = unit_rows(np.stack([np.asarray(vectors.iloc[i], np.float64) for i in part]))
                for i, code in zip(part, cell_codes(units, **how), strict=True):
                    out[i] = code
        return pd.Series(out, dtype=object)

    return F.pandas_udf(codes, "array<bigint>")(vector)


def usable(vector: str) -> Column:
    """Vectors with a direction: not null, finite entries only, one of them not zero."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(finite & F.exists(values, lambda c: c != 0), F.lit(False))


def _spanning(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between the vectors ``left`` and ``right``."""
    tree = {v: v for v in [*left.tolist(), *right.tolist()]}

    def top(v: int) -> int:
        while tree[v] != v:
            tree[v] = tree[tree[v]]
            v = tree[v]
        return v

    out = []
    for i, j in np.argwhere(links).tolist():
        a, b = int(left[i]), int(right[j])
        x, y = top(a), top(b)
        if x != y:
            tree[x] = y
            out.append((a, b))
    return out


def verified_group(
    rows: pd.DataFrame, table: int, threshold: float, tables: int
) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """Forest and link counts of one group: stored vectors against probing ones."""
    probing = rows["_probe"].to_numpy(bool)
    if probing.all() or not probing.any():
        return [], {}
    ids = rows["_v"].to_numpy(np.int64)
    units = unit_rows(np.stack([np.asarray(v, np.float64) for v in rows["_vec"]]))
    left, right = np.flatnonzero(~probing), np.flatnonzero(probing)
    near = units[left] @ units[right].T >= threshold - 1e-9
    near &= ids[left][:, None] != ids[right][None, :]
    i, j = np.nonzero(near)
    if not len(i):
        return [], {}
    a, b = left[i], right[j]
    raw = np.stack([np.asarray(v, np.float64) for v in rows["_vec"]])
    raw /= np.abs(raw).max(axis=1, keepdims=True)
    norm = np.sqrt((raw * raw).sum(axis=1))
    sure = np.concatenate(
        [
            np.einsum("nd,nd->n", raw[a[s : s + 8192]], raw[b[s : s + 8192]])
            for s in range(0, len(a), 8192)
        ]
    ) / (norm[a] * norm[b])
    linked = sure >= threshold
    near[i[~linked], j[~linked]] = False
    a, b = a[linked], b[linked]
    if not len(a):
        return [], {}
    # Where else do the two meet? a is stored here and b probes.
    codes = np.stack([np.asarray(c, np.int64) for c in rows["_codes"]]).reshape(len(rows), tables, -1)
    counts: dict[int, int] = {}
    weight = rows["_w"].to_numpy(np.int64)
    for s in range(0, len(a), 8192):
        x, y = a[s : s + 8192], b[s : s + 8192]
        stored_x = (codes[x, :, :1] == codes[y]).any(axis=2)
        stored_y = (codes[y, :, :1] == codes[x]).any(axis=2)
        earlier = (stored_x | stored_y)[:, :table].any(axis=1)
        # In one table, the meeting that stores the smaller id comes first.
        first = ~earlier & ((ids[x] < ids[y]) | ~stored_y[:, table])
        for one, other in ((x, y), (y, x)):
            for v, w in zip(ids[one[first]].tolist(), weight[other[first]].tolist(), strict=True):
                counts[v] = counts.get(v, 0) + w
    return _spanning(near, ids[left], ids[right]), counts


def meetings(
    signed: DataFrame,
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    probes: int = PROBES,
    block: int = BLOCK,
) -> DataFrame:
    """Forest links (``_a``, ``_b``) and link counts (``_a``, null, ``_n``) of all groups.

    ``signed`` holds ``_v``, ``_w``, ``_label``, ``_dim``, ``_vec`` and ``_codes`` per class.
    """
    keys = ["_label", "_dim", "_table", "_cell"]
    each = signed.select("_v", "_run", "_label", "_dim", F.posexplode("_codes").alias("_at", "_cell"))
    rows = each.select(
        "_v",
        "_run",
        "_label",
        "_dim",
        F.floor(F.col("_at") / F.lit(1 + probes)).cast("int").alias("_table"),
        "_cell",
        (F.col("_at") % F.lit(1 + probes) == 0).alias("_own"),
    )
    counts = rows.groupBy(*keys).agg(
        F.count_if("_own").alias("_stored"), F.count(F.lit(1)).alias("_probing")
    )
    # Cells that store a vector and that another one probes as well.
    useful = counts.where("_stored > 0 and _probing > 1")
    n_blocks = lambda n: F.ceil(F.col(n) / F.lit(float(block))).cast("bigint")
    sized = lookup(
        rows,
        useful.select(*keys, n_blocks("_stored").alias("_m"), n_blocks("_probing").alias("_k")),
        keys,
    )
    roles = F.when(F.col("_own"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(True)))
    both = sized.withColumn("_probe", F.explode(roles))
    mine = F.pmod(F.xxhash64("_v", F.lit(7)), F.when(F.col("_probe"), F.col("_k")).otherwise(F.col("_m")))
    others = F.when(F.col("_probe"), F.col("_m")).otherwise(F.col("_k"))
    dealt = (
        both.withColumns({"_mine": mine, "_with": F.sequence(F.lit(0).cast("bigint"), others - 1)})
        .withColumn("_with", F.explode("_with"))
        .withColumns(
            {
                "_i": F.when(F.col("_probe"), F.col("_with")).otherwise(F.col("_mine")),
                "_j": F.when(F.col("_probe"), F.col("_mine")).otherwise(F.col("_with")),
            }
        )
        .select(
            "_v", "_probe", "_table", "_cell", F.xxhash64(*keys, "_i", "_j").alias("_group")
        )
    )
    names = ["_group", "_table", "_cell"]
    columns = [*names, "_v", "_probe", "_w", "_vec", "_codes"]
    carried = signed.select("_v", "_w", "_vec", "_codes")

    def found(rows: pd.DataFrame) -> pd.DataFrame:
        a, b, n = [], [], []
        if len(rows):
            marks = rows[names].to_numpy(np.int64)
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            for start, stop in itertools.pairwise([0, *cuts.tolist(), len(rows)]):
                if stop - start > 1:
                    part = rows.iloc[start:stop]
                    forest, links = verified_group(part, int(marks[start, 1]), threshold, tables)
                    a += [x for x, _ in forest] + list(links)
                    b += [y for _, y in forest] + [-1] * len(links)
                    n += [0] * len(forest) + list(links.values())
        return pd.DataFrame({"_a": a, "_b": b, "_n": n}, dtype="int64")

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Groups arrive sorted by their keys; one may span several batches."""
        held = pd.DataFrame(columns=columns)
        for batch in batches:
            rows = pd.concat([held, batch], ignore_index=True) if len(held) else batch
            if not len(rows):
                continue
            last = rows[names].to_numpy(np.int64)
            whole = int(np.flatnonzero((last != last[-1]).any(axis=1)).max(initial=-1)) + 1
            held = rows.iloc[whole:]
            yield found(rows.iloc[:whole])
        yield found(held)

    return land(
        dealt.join(carried, "_v")
        .select(columns)
        .repartition(*names)
        .sortWithinPartitions(*names)
        .mapInPandas(verified, "_a bigint, _b bigint, _n bigint"),
        "meetings",
    )


def near_duplicates(
    table: DataFrame,
    vector: str = "embedding",
    label: str = "label",
    vec_id: str = "vec_id",
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    blocks: int = BLOCKS,
    scale: float = SCALE,
    probes: int = PROBES,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept.

    Vectors are compared only under equal labels that are not null and at equal length.
    A vector that is null, empty or zero, or holds null or an entry that is not finite, links
    with nothing: no links, a component of its own, kept. Repeated rows are vectors of
    their own. A null vec_id counts as larger than all others; a component of null ids has
    a null component_id and its rows are kept. An empty table gives an empty result. Other
    columns are not looked at.
    """
    how = {"tables": tables, "blocks": blocks, "scale": scale, "probes": probes, "seed": seed}
    usual = F.col(label).isNotNull() & usable(vector)
    rows = land(
        with_rows(
            table.select(
                F.col(vec_id).cast("bigint").alias("_id"),
                F.when(usual, F.col(label)).alias("_label"),
                F.when(usual, F.col(vector)).alias("_vec"),
            )
        ),
        "vectors",
    )
    rank = F.coalesce(F.col("_id"), F.lit(_LAST))
    digest = {f"_h{s}": F.xxhash64(F.lit(s), F.col("_vec")) for s in (1, 2)}
    keys = ["_label", "_h1", "_h2"]
    marked = rows.where(F.col("_vec").isNotNull()).withColumns({"_rank": rank, **digest})
    classes = land(
        marked.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_w"), F.min("_row").alias("_v"), F.min("_rank").alias("_least")
        ),
        "vector-classes",
    )
    signed = land(
        rows.select(F.col("_row").alias("_v"), "_run", "_label", "_vec")
        .join(classes.select("_v", "_w", "_least"), "_v")
        .withColumns({"_dim": F.size("_vec"), "_codes": _signatures(F.col("_vec"), **how)}),
        "lattice-cells",
    )
    met = meetings(signed, threshold, tables, probes, block)
    labels = components(met.where("_b >= 0").select("_a", "_b").distinct()).withColumnRenamed("_fp", "_v")
    links = met.where("_b < 0").groupBy(F.col("_a").alias("_v")).agg(F.sum("_n").alias("_links"))
    named = land(
        signed.select("_v", "_run", "_w", "_least")
        .join(labels, "_v", "left")
        .join(links, "_v", "left")
        .withColumns(
            {
                "_label": F.coalesce("_label", "_v"),
                "_links": F.col("_w") - 1 + F.coalesce("_links", F.lit(0)),
            }
        ),
        "named-classes",
    )
    least = named.groupBy("_label").agg(F.min("_least").alias("_component"))
    of_class = lookup(named.select("_v", "_label", "_links", "_run"), least, ["_label"]).select(
        "_v", "_links", "_component"
    )
    of_row = lookup(marked.select("_row", "_run", *keys), classes.select(*keys, "_v"), keys)
    linked = lookup(of_row.select("_row", "_run", "_v"), of_class, ["_v"]).select(
        "_row", "_links", "_component"
    )
    component = F.when(F.col("_links").isNull(), F.col("_id")).otherwise(
        F.when(F.col("_component") < _LAST, F.col("_component"))
    )
    return (
        rows.select("_row", "_id")
        .join(linked, "_row", "left")
        .select(
            F.col("_id").alias("vec_id"),
            F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"),
            component.alias("component_id"),
            F.col("_id").eqNullSafe(component).alias("kept"),
        )
    )


ORACLE = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS one, b.vec_id AS other
    FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
),
reached AS (
    SELECT vec_id AS one, vec_id AS other FROM embeddings
    UNION
    SELECT r.one, l.other FROM reached r JOIN links l ON l.one = r.other
)
SELECT e.vec_id,
       (SELECT count(*) FROM links l WHERE l.one = e.vec_id) AS n_links,
       c.component_id,
       e.vec_id = c.component_id AS kept
FROM embeddings e
JOIN (SELECT one, min(other) AS component_id FROM reached GROUP BY one) c ON c.one = e.vec_id
"""
